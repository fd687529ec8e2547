"""Licence scan on genuine texts, as people wrap them."""

import hashlib
import re
import textwrap

from markerloom.llm import license_scan

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""


def wrapped(text, width):
    return "\n\n".join(textwrap.fill(" ".join(p.split()), width) for p in text.split("\n\n"))


def scanned(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.license_id, r.digest) for r in license_scan.scan_licenses(df).orderBy("doc_id").collect()]


def test_genuine_texts_however_wrapped(spark):
    texts, want = [], []
    for name, title, body in (("MIT", "The MIT License (MIT)", MIT), ("ISC", "ISC License", ISC)):
        forms = [body, body.replace("\n\n", "\n"), *[wrapped(body, w) for w in range(20, 100)]]
        for head in ("", "Copyright (c) 2020-2023, Some Body <a@b.c>\n\n", f"{title}\n\n# © Some Body. All rights reserved.\n\n", "Copyright The Foo Authors\nCopyright 2001 École\nAll rights reserved.\n\n"):
            texts += [head + form for form in forms]
            want += [name] * len(forms)
    assert [x for x, _ in scanned(spark, texts)] == want
    short = [MIT.split(" IN NO EVENT")[0], MIT.replace("copyright notice", "notice"), ISC + " More."]
    assert [x for x, _ in scanned(spark, short)] == [None] * 3


def test_every_full_text_is_found(spark):
    texts = license_scan.full_texts()
    names = {name for name, _ in texts}
    assert names >= {"MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "Unlicense", "CC0-1.0"}
    assert [x for x, _ in scanned(spark, [body for _, body in texts])] == [name for name, _ in texts]
    # a statement ends where its line does, so those of the GNU texts may not be wrapped anew
    free = [(name, body) for name, body in texts if "GPL" not in name and not re.search(r"(?m)^[-=]+$", body)]
    more = [(name, wrapped(body, w)) for name, body in free for w in (50, 66, 72, 79)]
    assert [x for x, _ in scanned(spark, [body for _, body in more])] == [name for name, _ in more]


def test_prose_about_copyright_keeps_its_text(spark):
    got = scanned(spark, ["A talk on copyright and art.", "copyright law is hard", "(c) third point of a list", "Copyright 2001"])
    empty = hashlib.md5(b"").hexdigest()
    assert [d == empty for _, d in got] == [False, False, False, True]
