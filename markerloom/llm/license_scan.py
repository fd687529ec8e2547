"""Licence scan in DataFrame expressions only: canonical texts, hashed and joined to known digests.

A text becomes canonical by lower case, dropped copyright statements (lines such as "Copyright (c)
2020 Somebody", not every line that mentions the word), one space for every run of ASCII
punctuation and white space, and one spelling for equivalent words. Its digest is then hash-joined
to the digests of known licences: full texts in ``licenses/`` and notices.

Documents mostly carry notices and not whole texts, so every line and every paragraph that speaks of
a licence is looked up too: its digest among the known ones, the name behind a phrase such as "this
project is released under the" or "is free software; you can redistribute it", and the identifiers of
an SPDX line, joined by OR, AND or WITH. Suffixes such as ``-only`` and "or later" name no other id.

Defined results: a null text has a null digest and no licence; an empty text (or one of copyright
lines alone) has the digest of the empty string, which no known licence has; repeated rows are
judged each on its own; a very long text is digested whole; an empty table gives an empty table;
further columns are carried along, but those that bear the name of a result are replaced.
"""

from __future__ import annotations

import hashlib
import json
import re
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from markerloom.llm import license_names

# Notices of one line. Full texts lie in ``licenses/``, names and identifiers in ``license_names``.
_ONE_LINE = [
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."), ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."), ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
#: Equivalent spellings, applied in order, also inside longer words ("licences").
SPELLINGS = (("licence", "license"), ("sub license", "sublicense"), ("non infringement", "noninfringement"), ("merchantibility", "merchantability"), ("acknowledgement", "acknowledgment"), ("organisation", "organization"))
COPYRIGHT = ("copyright", "(c)", "©", "all rights reserved")
# A whole line that is a copyright statement, in lower case: the mark and then a year or a holder. A
# body line that happens to start with the word ("copyright notice", "copyright holders be") is none.
# Both engines read these patterns, so they use no look-ahead and spell out white space and borders.
_WHITE, _MARKS = r"[\x20\t\x0b\f\r]", r"^[\x20\t\x0b\f\r\x21-\x27*+,./:;<=|\x2d]*"
_WORD = rf"(?:portions{_WHITE}+)?copyright"
STATEMENT = (
    rf"{_MARKS}(?:{_WORD}{_WHITE}*[:,]?{_WHITE}*(?:\(c\)|©)|©|\(c\){_WHITE}*(?:copyright(?:[^\p{{L}}\p{{N}}_]|$)|[\[{{<]?(?:[0-9][0-9][0-9][0-9]|yyyy|year))|all rights reserved[\x20\t\x0b\f\r.*/#]*$)"
)
HOLDER = rf"{_MARKS}{_WORD}{_WHITE}*:?{_WHITE}+[\p{{L}}0-9\[{{<]"
BODY = (
    rf"{_MARKS}{_WORD}{_WHITE}*:?{_WHITE}+(?:the (?:software|library|program|work)|(?:notices?|holders?|owners?|laws?|licen[sc]e[sd]?|statements?|protection|interests?|rights?|treat(?:y|ies)|act|and|or|in|on|is|are|to|of|for|that|this|may|shall"
    r"|with|as|under|which|permission|disclaimers?|infringement|symbol|status|materials?|works?|line|claims?|resulting|conditions?|information|management|term|doctrines?|exceptions?|registration|ownership|if)(?:[^\p{L}\p{N}_]|$))"
)
_GAPS = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
#: Between paragraphs: a line without letters or digits (it may hold comment marks), or several.
PARAGRAPH = r"\n[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]*\n"
#: An SPDX line, in lower case, up to what no expression holds.
SPDX_LINE = r"spdx-license-identifier:[\x20\t]*([a-z0-9.+()\x20\t-]+)"
SPDX_JOINT = r"[\x20\t]+(?:or|and|with)[\x20\t]+"
SPDX_TAIL = r"(?:-only|-or-later|\+)$"
SPEAKS = ("licen", "public domain", "gpl", "cc by", "cc-by", "cc0")


def canonical(text: Column) -> Column:
    """The canonical form that digests are taken of; null for null."""
    mentions = lambda line: line.contains(COPYRIGHT[0]) | line.contains(COPYRIGHT[1]) | line.contains(COPYRIGHT[2]) | line.contains(COPYRIGHT[3])
    statement = lambda line: line.rlike(STATEMENT) | (line.rlike(HOLDER) & ~line.rlike(BODY))
    lines = F.filter(F.split(F.lower(text), "\n"), lambda line: ~(mentions(line) & statement(line)))
    out = F.regexp_replace(F.array_join(lines, "\n"), _GAPS, " ")
    for other, usual in SPELLINGS:
        out = F.replace(out, F.lit(other), F.lit(usual))
    return F.trim(out)


_TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "BSD-2-Clause": ("BSD 2-Clause License", 'BSD 2-Clause "Simplified" License'),
    "BSD-3-Clause": ("BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "The BSD 3-Clause License"),
}
#: Wordings in which genuine copies of one licence differ.
_WORDINGS = {
    "ISC": (("and/or distribute", "and distribute"),),
    "BSD-2-Clause": ((r"(?m)^\s*\d\. ", "* "), (r"COPYRIGHT(\s+)HOLDER(\s+)OR", r"COPYRIGHT\1OWNER\2OR")),
    "BSD-3-Clause": ((r"(?m)^\s*\d\. ", "* "), (r"COPYRIGHT(\s+)HOLDER(\s+)OR", r"COPYRIGHT\1OWNER\2OR"), (r"the(\s+)copyright(\s+)holder(\s+)nor", r"the\1copyright\2holders\3nor")),
}
_APPENDIX = re.compile(r"(END OF TERMS AND CONDITIONS).*", re.S)
_LINE_BREAK = re.compile(r"(?<=\S)[ \t]*\n[ \t]*(?=\S)")


def full_texts() -> list[tuple[str, str]]:
    """``(license_id, body)`` of the full texts, with usual titles, wordings and without appendix."""
    found: dict[tuple[str, str], None] = {}
    for file in sorted(resources.files("markerloom.llm").joinpath("licenses").iterdir(), key=lambda f: f.name):
        name, bodies = file.name.removesuffix(".txt"), [file.read_text(encoding="utf-8")]
        for pattern, other in _WORDINGS.get(name, ()):
            bodies += [re.sub(pattern, other, body) for body in bodies]
        bodies += [_APPENDIX.sub(r"\1", body) for body in bodies]
        bodies += [body.replace("http://", "https://") for body in bodies]
        # statements end where their line does, so texts of one line a paragraph are known besides
        bodies += [_LINE_BREAK.sub(" ", body) for body in bodies]
        found |= {(name, f"{title}\n\n{body}" if title else body): None for body in bodies for title in ("", *_TITLES.get(name, ()))}
    return list(found)


def notices() -> list[tuple[str, str]]:
    """``(license_id, body)`` of notices that may be a document of their own: one line, or an SPDX line."""
    tails = ("", "-only", "-or-later", "+")
    return _ONE_LINE + [(x, f"SPDX-License-Identifier: {x}{tail}") for x in license_names.SPDX for tail in tails]


def _known() -> list[tuple[str, str]]:
    """All built-in bodies; the plain MIT text leads."""
    return sorted(full_texts(), key=lambda x: (x[0] != "MIT", len(x[1]))) + notices()


KNOWN: list[tuple[str, str]] = _known()


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """``(license_id, license_digest)``, one row per digest (the smallest id where two agree)."""
    rows = spark.createDataFrame(known or KNOWN, "license_id string, body string")
    return rows.groupBy(F.md5(canonical(F.col("body"))).alias("license_digest")).agg(F.min("license_id").alias("license_id"))


def _constant_map(entries: dict[str, str]) -> Column:
    """A map as one constant, which the plan holds once."""
    return F.from_json(F.lit(json.dumps(entries)), "map<string,string>")


def _spoken_ids(text: Column, digests: dict[str, str]) -> Column:
    """Ids that the lines and paragraphs of a text speak of: known bodies, names behind a phrase, SPDX lines."""
    by_digest, by_name = _constant_map(digests), _constant_map(license_names.names())
    by_spdx = _constant_map({x.lower(): x for x in license_names.SPDX})
    speaks = lambda u: F.lower(u).rlike("|".join(SPEAKS))
    units = F.when(speaks(text), F.array_distinct(F.filter(F.concat(F.split(text, "\n"), F.split(text, PARAGRAPH)), speaks)))
    expression = lambda u: F.trim(F.translate(F.regexp_extract(F.lower(u), SPDX_LINE, 1), "()\t", "   "))
    listed = lambda u: F.transform(F.split(expression(u), SPDX_JOINT), lambda x: F.try_element_at(by_spdx, F.regexp_replace(F.trim(x), SPDX_TAIL, "")))
    plain = F.transform(units, lambda u: F.struct(canonical(u).alias("c"), listed(u).alias("spdx")))
    ids = F.flatten(F.transform(plain, lambda p: F.concat(F.array(F.try_element_at(by_digest, F.md5(p["c"])), F.try_element_at(by_name, F.regexp_extract(p["c"], license_names.PHRASE, 1))), p["spdx"])))
    return F.filter(F.coalesce(ids, F.array().cast("array<string>")), lambda x: x.isNotNull())


def scan_licenses(docs: DataFrame, text: str = "text", known: list[tuple[str, str]] | None = None) -> DataFrame:
    """Add ``digest``, ``license_id`` (of the entire text) and ``notices`` (ids its parts speak of, comma-joined).

    The known table is as long as ``known`` (the built-in texts and notices by default), a fixed list, which bounds what is broadcast.
    """
    table = known_digests(docs.sparkSession, known)
    digests = {row["license_digest"]: row["license_id"] for row in table.collect()}
    digested = docs.drop("digest", "license_id", "notices", "license_digest").withColumn("digest", F.md5(canonical(F.col(text))))
    named = digested.join(F.broadcast(table), digested["digest"] == table["license_digest"], "left").drop("license_digest")
    return named.withColumn("notices", F.array_join(F.array_sort(F.array_distinct(_spoken_ids(F.coalesce(F.col(text), F.lit("")), digests))), ","))


def op1_license_scan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan_licenses(docs).select("doc_id", "digest", "license_id", "notices")


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _duck_canonical(text: str) -> str:
    mentions = " OR ".join(f"contains(x, '{word}')" for word in COPYRIGHT)
    statement = f"regexp_matches(x, {_quoted(STATEMENT)}) OR (regexp_matches(x, {_quoted(HOLDER)}) AND NOT regexp_matches(x, {_quoted(BODY)}))"
    out = f"regexp_replace(array_to_string(list_filter(string_split(lower({text}), chr(10)), lambda x: NOT (({mentions}) AND ({statement}))), chr(10)), '{_GAPS}', ' ', 'g')"
    for other, usual in SPELLINGS:
        out = f"replace({out}, '{other}', '{usual}')"
    return f"trim({out})"


def plain_canonical(text: str) -> str:
    """The canonical form once more, by itself: what the SQL's known digests are taken of."""
    import regex

    statement = lambda x: regex.search(STATEMENT, x) or (regex.search(HOLDER, x) and not regex.search(BODY, x))
    lines = [x for x in text.lower().split("\n") if not (any(w in x for w in COPYRIGHT) and statement(x))]
    out = regex.sub(_GAPS, " ", "\n".join(lines))
    for other, usual in SPELLINGS:
        out = out.replace(other, usual)
    return out.strip(" ")


def oracle() -> str:
    """The same rules in SQL: digests of whole texts, and what lines and paragraphs speak of."""
    digests: dict[str, str] = {}
    for license_id, body in KNOWN:
        key = hashlib.md5(plain_canonical(body).encode()).hexdigest()
        digests[key] = min(license_id, digests.get(key, license_id))
    values = lambda rows: ", ".join(f"('{k}', '{v}')" for k, v in rows.items())
    speaks = lambda x: " OR ".join(f"contains(lower({x}), '{word}')" for word in SPEAKS)
    return f"""
    WITH known AS (SELECT * FROM (VALUES {values(digests)}) v(k, license_id)), names AS (SELECT * FROM (VALUES {values(license_names.names())}) v(k, license_id)), spdx AS (SELECT * FROM (VALUES {values({x.lower(): x for x in license_names.SPDX})}) v(k, license_id)),
    d AS (SELECT row_number() OVER () AS rid, doc_id, text, md5({_duck_canonical('text')}) AS digest FROM documents),
    units AS (SELECT DISTINCT rid, u FROM (SELECT rid, unnest(list_concat(string_split(text, chr(10)), string_split_regex(text, '{PARAGRAPH}'))) AS u FROM d) WHERE {speaks('u')}),
    plain AS (SELECT rid, u, {_duck_canonical('u')} AS c FROM units),
    listed AS (SELECT rid, regexp_replace(trim(unnest(string_split_regex(trim(translate(regexp_extract(lower(u), '{SPDX_LINE}', 1), '()' || chr(9), '   ')), '{SPDX_JOINT}'))), '{SPDX_TAIL}', '') AS k FROM units),
    spoken AS (SELECT rid, license_id FROM plain JOIN known ON k = md5(c) UNION SELECT rid, license_id FROM plain JOIN names ON k = regexp_extract(c, {_quoted(license_names.PHRASE)}, 1) UNION SELECT rid, license_id FROM listed JOIN spdx USING (k)),
    noted AS (SELECT rid, string_agg(license_id, ',' ORDER BY license_id) AS notices FROM spoken GROUP BY rid)
    SELECT doc_id, digest, license_id, coalesce(notices, '') AS notices FROM d LEFT JOIN known ON k = digest LEFT JOIN noted USING (rid)"""
