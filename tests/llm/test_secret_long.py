"""The secret scan on very long candidates and on texts with very many matches."""

import random
import re
import time

from pyspark.sql import functions as F

from markerloom.llm import secret_scan


def scanned(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = secret_scan.scan_secrets(df).select(F.size("base_spans").alias("base"), "secret_spans", secret_scan.redact(F.col("text"), F.col("secret_spans")).alias("clean"))
    return found.first()


def test_long_candidate_is_judged_whole(spark):
    rng = random.Random(1)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    blob = "".join(rng.choice(letters) for _ in range(200_000))
    began = time.time()
    r = scanned(spark, "see " + blob + " end")
    assert [(s["start"], s["end"]) for s in r.secret_spans] == [(4, 4 + len(blob))] and r.clean == "see [SECRET] end"
    assert time.time() - began < 120


def test_very_many_matches(spark):
    text = "".join(f"é password=hunter{k:06d} is" for k in range(100_000))
    began = time.time()
    r = scanned(spark, text)
    want = [(m.start(), m.end()) for m in re.finditer(r"password=hunter\d+", text)]
    assert r.base == 100_000 and [(s["start"], s["end"]) for s in r.secret_spans] == want
    assert r.clean == re.sub(r"password=hunter\d+", "[SECRET]", text)
    assert time.time() - began < 120


def test_overlapping_and_touching_spans_are_blanked_like_one_by_one(spark):
    rng = random.Random(2)
    for _ in range(20):
        text = "".join(rng.choice("aé中 b") for _ in range(60))
        spans = sorted({(a := rng.randint(0, 50), rng.randint(0, 2), a + rng.randint(1, 9)) for _ in range(rng.randint(1, 12))})
        out, at = "", 0
        for start, _, end in spans:
            if start >= at:
                out += text[at:start] + "#"
            at = max(at, end)
        df = spark.createDataFrame([(text, spans)], f"t string, s {secret_scan.SPAN}")
        assert df.select(secret_scan.redact(F.col("t"), F.col("s"), "#")).first()[0] == out + text[at:]
