"""Entropy of every class of characters, and harmless strings beside secrets."""

import random

from pyspark.sql import functions as F

from markerloom.llm import secret_scan

LOWER, UPPER, BOTH = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def redacted(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.r for r in secret_scan.scan_secrets(df).withColumn("r", secret_scan.redact(F.col("text"), F.col("secret_spans"))).orderBy("doc_id").collect()]


def test_every_class_is_scanned(spark):
    rng = random.Random(7)
    for alphabet, least in ((UPPER + "234567", 196), (LOWER + "0123456789", 196), (BOTH, 190)):
        keys = ["".join(rng.choice(alphabet) for _ in range(40)) for _ in range(200)]
        got = redacted(spark, [f"x {key} y" for key in keys])
        assert sum("[SECRET]" in text for text in got) >= least
    hexes = "9F86D081884C7D659A2FEAA0C55AD015A3BF4F1B"
    got = redacted(spark, [f"SIGNING_KEY={hexes}", f"Signing_key_{hexes}", f"{hexes}=="])
    assert all("[SECRET]" in text and hexes[5:-5] not in text for text in got)


def test_harmless_strings_hide_no_secret_beside_them(spark):
    key = "q9Zr7Xb2Lw8Kp4Vn6Td1Mf3Hs5Gy0Jc"
    uuid = "123E4567-e89b-12d3-a456-426614174000"
    got = redacted(spark, [f"example_{key}", f"{key}/EXAMPLE", f"{uuid}_{key}", f"0123456789{key}"])
    assert all("[SECRET]" in text and key[5:-5] not in text for text in got)
    fine = [uuid, BOTH + "0123456789+/", UPPER + "234567", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", "Donaudampfschifffahrtsgesellschaft", "top-10-best-python-libraries-of-2023", "12345678901234567890123", "internationalization/configuration_manager"]
    assert redacted(spark, fine) == fine
