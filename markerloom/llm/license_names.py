"""Names, notices and identifiers of licences, written out by rule from short fixed lists."""

from __future__ import annotations

from itertools import product

# Identifiers of the public SPDX list, without version suffixes such as "-only".
SPDX = (
    "0BSD AFL-3.0 AGPL-3.0 Apache-1.1 Apache-2.0 Artistic-1.0 Artistic-2.0 BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 BlueOak-1.0.0 CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0"
    " CC-BY-NC-3.0 CC-BY-NC-4.0 CC-BY-NC-ND-3.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-3.0 CC-BY-NC-SA-4.0 CC-BY-ND-3.0 CC-BY-ND-4.0 CC-BY-SA-2.0 CC-BY-SA-2.5 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1 CPL-1.0 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2"
    " GFDL-1.2 GFDL-1.3 GPL-1.0 GPL-2.0 GPL-3.0 ISC LGPL-2.0 LGPL-2.1 LGPL-3.0 LPPL-1.3c MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0 OFL-1.1 OSL-3.0 PostgreSQL Python-2.0 Ruby UPL-1.0 Unicode-DFS-2016 Unlicense Vim W3C WTFPL X11 Zlib ZPL-2.1"
).split()

# How licences are spoken of, in canonical form.
_STEMS = {
    "MIT": ("mit", "mit x11", "expat", "expat mit"), "ISC": ("isc",), "0BSD": ("bsd zero clause", "zero clause bsd", "0bsd"), "Unlicense": ("unlicense", "the unlicense"), "WTFPL": ("wtfpl", "do what the fuck you want to public"),
    "Zlib": ("zlib", "zlib libpng"), "PostgreSQL": ("postgresql",), "BSD-2-Clause": ("bsd 2 clause", "2 clause bsd", "simplified bsd", "freebsd", "two clause bsd", "bsd two clause"),
    "BSD-3-Clause": ("bsd 3 clause", "3 clause bsd", "new bsd", "modified bsd", "revised bsd", "three clause bsd", "bsd three clause", "bsd new"), "BSD-4-Clause": ("bsd 4 clause", "4 clause bsd", "original bsd"),
}
_VERSIONED = {
    "Apache": (("apache", "apache software", "asl", "al"), ("2.0", "1.1")), "MPL": (("mozilla public", "mpl"), ("2.0", "1.1")), "EPL": (("eclipse public", "epl"), ("1.0", "2.0")), "BSL": (("boost software", "boost", "bsl"), ("1.0",)),
    "Artistic": (("artistic", "perl artistic"), ("1.0", "2.0")), "CDDL": (("common development and distribution", "cddl"), ("1.0", "1.1")), "EUPL": (("european union public", "eupl"), ("1.1", "1.2")), "AFL": (("academic free", "afl"), ("3.0",)),
    "OFL": (("sil open font", "open font", "ofl", "sil ofl"), ("1.1",)), "UPL": (("universal permissive", "upl"), ("1.0",)), "ODbL": (("open database", "odbl"), ("1.0",)),
}
_GNU = {
    "GPL": (("gnu general public", "general public", "gnu gpl", "gpl"), ("1.0", "2.0", "3.0")), "LGPL": (("gnu lesser general public", "gnu library general public", "lesser general public", "gnu lgpl", "lgpl"), ("2.0", "2.1", "3.0")),
    "AGPL": (("gnu affero general public", "affero general public", "gnu agpl", "agpl"), ("3.0",)), "GFDL": (("gnu free documentation", "gfdl", "gnu fdl"), ("1.2", "1.3")),
}
_CREATIVE = {"by": "attribution", "sa": "sharealike", "nc": "noncommercial", "nd": "noderivatives"}
_APACHE_MORE = "the license you may not use this file except in compliance with the license you may obtain a copy of the license at"
_APACHE_REST = (
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"
    " see the license for the specific language governing permissions and limitations under the license"
)
_MPL_MORE = "if a copy of the mpl was not distributed with this file you can obtain one at"

#: What stands before a licence's name in a notice, and what may follow it; both on canonical text.
_VERB = "(?:released|licensed|distributed|available|published|provided|offered|covered|shared|governed|usable|redistributable|dedicated to the public domain|subject to)"
PHRASE = (
    r"^(?:(?:(?:[a-z0-9]+ ){0,8}(?:is|are|was|were|be) )?(?:dual |also |now |made |hereby )?" + _VERB + r" (?:under |by |to )?(?:the |an? |one of the )?(?:terms (?:and conditions )?of |conditions of )?(?:the |an? )?"
    r"|(?:.* )?is free software (?:and )?you (?:can|may) redistribute it and or modify it under (?:the )?terms of (?:the )?)(.+?)"
    r"(?: (?:this [a-z]+|[a-z0-9]+) is distributed in the hope that it will be useful.*| (?:please )?see (?:the )?(?:license|copying|license txt|license md)(?: file)?(?: for (?:more |further )?(?:details|information|the full text))?| unless otherwise (?:noted|stated|specified))?$"
)


def _numbers(version: str) -> list[str]:
    """Canonical spellings of a version: "2 0", and "2" for a whole one."""
    return [version.replace(".", " "), *([version[:-2]] if version.endswith(".0") else [])]


def _versions(stems: tuple[str, ...], version: str) -> list[str]:
    marks = (" version ", " v ", " v", " ", " ver ")
    out = []
    for stem, number in product(stems, _numbers(version)):
        for mark in marks:
            out += [f"{stem}{mark}{number}", f"{stem}{mark}{number} license", f"{stem} license{mark}{number}"]
        if " " not in stem:
            out += [f"{stem}v{number}", f"{stem}{number}"]
    return out


def names() -> dict[str, str]:
    """Canonical names of licences, as they end a notice, and what each of them means."""
    found: dict[str, str] = {}
    for license_id, stems in _STEMS.items():
        for stem in stems:
            for form in (stem, f"{stem} license", f"{stem} open source license", f"{stem} style license", f"{stem} public license"):
                found[form] = license_id
            found[f"{stem} style license that can be found in the license file or at https opensource org licenses {license_id.lower()}"] = license_id
    for family, (stems, versions) in _VERSIONED.items():
        for version in versions:
            for form in _versions(stems, version):
                found[form] = f"{family}-{version}"
    for family, (stems, versions) in _GNU.items():
        for version in versions:
            for form, tail in product(_versions(stems, version), ("", " or later", " or any later version", " or newer", " or at your option any later version", " only", " as published by the free software foundation")):
                found[form + tail] = f"{family}-{version}"
            for stem, number in product(stems, _numbers(version)):
                head = f"{stem} license as published by the free software foundation"
                for each in (f"{head} either version {number} of the license or at your option any later version", f"{head} version {number} of the license", f"{head} version {number}", f"{head} either version {number} or at your option any later version"):
                    found[each] = f"{family}-{version}"
    for kinds in ("by", "by sa", "by nc", "by nc sa", "by nd", "by nc nd"):
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            words = " ".join(_CREATIVE[k] for k in kinds.split())
            parted = words.replace("sharealike", "share alike").replace("noncommercial", "non commercial").replace("noderivatives", "no derivatives")
            for stem in (f"cc {kinds}", f"creative commons {kinds}", f"creative commons {words}", f"creative commons {parted}"):
                for number, tail in product(_numbers(version), ("", " license", " international", " international license", " unported", " unported license", " international public license")):
                    found[f"{stem} {number}{tail}"] = f"CC-{kinds.replace(' ', '-').upper()}-{version}"
    for form in ("cc0", "cc0 1 0", "cc0 1 0 universal", "creative commons zero", "cc0 license", "creative commons zero 1 0", "creative commons cc0 1 0 universal", "cc0 1 0 universal public domain dedication"):
        found[form] = "CC0-1.0"
    for site in ("http www apache org licenses license 2 0", "https www apache org licenses license 2 0"):
        for head in ("apache license version 2 0", "apache license 2 0"):
            for tail in (_APACHE_MORE, f"{_APACHE_MORE} {site}", f"{_APACHE_MORE} {site} {_APACHE_REST}"):
                found[f"{head} {tail}"] = "Apache-2.0"
    for site in ("http mozilla org mpl 2 0", "https mozilla org mpl 2 0", "http www mozilla org mpl 2 0", "https www mozilla org mpl 2 0"):
        for head in ("mozilla public license v 2 0", "mozilla public license version 2 0"):
            found[f"{head} {_MPL_MORE} {site}"] = "MPL-2.0"
    return found
