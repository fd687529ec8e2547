"""The SQL of the text scans against the operators on made-up rows that tell their rules apart."""

import random
import textwrap

import duckdb
import pyarrow as pa
import pytest

from markerloom.llm import license_scan, secret_scan

APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GPL = """{name} is free software: you can redistribute it and/or modify
it under the terms of the GNU {kind} as published by
the Free Software Foundation, either version {version} of the License, or
(at your option) any later version.

{name} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""


def commented(text, mark):
    return "\n".join(f"{mark} {line}".rstrip() for line in text.split("\n"))


NOTICES = [
    ("SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"), ("// SPDX-License-Identifier: MPL-2.0", "MPL-2.0"), ("# SPDX-License-Identifier: MIT OR Apache-2.0", "Apache-2.0,MIT"), ("/* SPDX-License-Identifier: GPL-2.0 */", "GPL-2.0"),
    ("SPDX-License-Identifier: (LGPL-2.1-or-later AND MIT) OR GPL-3.0-only", "GPL-3.0,LGPL-2.1,MIT"), ("SPDX-License-Identifier: GPL-2.0+ WITH Classpath-exception-2.0", "GPL-2.0"), ("SPDX-License-Identifier: Nobody-9.9", ""),
    (APACHE, "Apache-2.0"), (commented("Copyright 2021 The Authors\n\n" + APACHE, "#"), "Apache-2.0"), (commented("Copyright 2021 The Authors\n" + APACHE, " *"), "Apache-2.0"),
    (GPL.format(name="This program", kind="General Public License", version=3), "GPL-3.0"), (commented("This file is part of Foo.\n\n" + GPL.format(name="Foo", kind="General Public License", version=2), "//"), "GPL-2.0"),
    (GPL.format(name="This library", kind="Lesser General Public License", version="2.1"), "LGPL-2.1"), (GPL.format(name="This program", kind="Affero General Public License", version=3), "AGPL-3.0"),
    (textwrap.fill(GPL.format(name="This program", kind="General Public License", version=3).replace("\n\n", " "), 60), "GPL-3.0"), (MPL, "MPL-2.0"), (commented(MPL, "#"), "MPL-2.0"),
    ("This project is released under the MIT license.", "MIT"), ("prose before\nThe source code is available under the terms of the GNU GPL v3 or later.\nprose after", "GPL-3.0"), ("All content is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
    ("This data set is made available under the Open Database License (ODbL) 1.0", ""), ("These files are distributed under the Boost Software License, Version 1.0.", "BSL-1.0"), ("The crate is dual licensed under the Apache License 2.0", "Apache-2.0"), ("Licensed under the EUPL, Version 1.2", "EUPL-1.2"),
    ("Use of this source code is governed by an MIT-style license that can be found in the LICENSE file or at https://opensource.org/licenses/MIT.", "MIT"), ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    ("A driving licence is issued under the law.", ""), ("He was released under the terms of a licence nobody had read", ""), ("License: see below", ""), (None, ""), ("", ""), ("Copyright (c) 2020 Somebody", ""),
    ("copyright notices are dull\nReleased under the MIT License.", "MIT"), ("Released under the MIT Licence.\n\nLicensed under CC BY-NC 4.0.", "CC-BY-NC-4.0,MIT"),
]


def in_duck(sql, rows):
    con = duckdb.connect()
    con.register("rows", pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())}))
    con.execute("CREATE TABLE documents AS SELECT * FROM rows")
    return con.execute(sql)


def test_notices_and_their_sql(spark):
    texts = [t for t, _ in NOTICES] + [body for _, body in license_scan.KNOWN[::9]] + ["Copyright (c) 1999 A. Body\n" + body for _, body in license_scan.KNOWN[::23]]
    rows = list(enumerate(texts))
    got = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "digest", "license_id", "notices").orderBy("doc_id").collect()
    assert [r.notices for r in got[: len(NOTICES)]] == [n for _, n in NOTICES]
    want = in_duck(license_scan.oracle(), rows).fetchall()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("text,name", [("SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"), ("SPDX-License-Identifier: MPL-2.0", "MPL-2.0"), ("Copyright 2020 X\nReleased under the MIT License.", "MIT")])
def test_whole_documents_of_one_notice(spark, text, name):
    assert license_scan.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().license_id == name


def test_secrets_and_their_sql(spark):
    rng = random.Random(5)
    alphabets = ["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "abcdefghijklmnopqrstuvwxyz0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"]
    harmless = ["123e4567-e89b-12d3-a456-426614174000", "EXAMPLE", "example", "abcdefghij", "0123456789", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]
    words = ["the", "Donaudampfschifffahrtsgesellschaft", "password = ", "token:", "AKIA", "é", "\n", "key=", "top-10-best-python-libraries-of-2023"]
    texts = [None, ""]
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(1, 5)):
            kind = rng.random()
            parts.append("".join(rng.choice(rng.choice(alphabets[:4]) if kind < 0.1 else alphabets[k]) for k in [rng.randrange(5)] for _ in range(rng.randint(15, 45))) if kind < 0.5 else rng.choice(harmless) if kind < 0.7 else rng.choice(words))
            parts.append(rng.choice(["", "", " ", "_", "=", "-"]))
        texts.append("".join(parts))
    rows = list(enumerate(texts))
    found = secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", secret_scan.spans_text(secret_scan.F.col("secret_spans")).alias("spans")).collect()
    want = in_duck(secret_scan.oracle(), rows).fetchdf()
    assert {r.doc_id: r.spans for r in found} == dict(zip(want.doc_id, want.spans))
    assert sum("entropy" in r.spans for r in found) > 50
