"""Filter audit: masks by hand, all orders by a plain walk, retractions as files arrive."""

import itertools
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from markerloom.llm import filter_audit as fa

SCHEMA = "doc_id long, text string, source string, mask string, n long"
LABELS = "doc_id long, quality int, toxic int"
TEXTS = [None, "", "few words", "a b " * 40, " ".join(f"w{k}" for k in range(60)), " ".join(f"W{k}" for k in range(60)), " ".join(f"w{k}" for k in range(60)) + " 5 %", "A B C ü" * 30, "w " * 5000]


def documents(seed, n=150):
    rng = random.Random(seed)
    rows = [(k, rng.choice(TEXTS), rng.choice(["a", "b", "", None]), "x", 1) for k in rng.sample(range(1000), n)]
    rows += [(None, "few words", "a", "x", 1), (None, "lonely", "a", "x", 1), (None, "lonely", "b", "x", 1), (-4, "few words", "b", "x", 1), (-4, "few words", "a", None, None), (-4, "few words", "a", None, None)]
    labels = [(r[0], rng.choice([0, 1, None]), rng.choice([0, 1, None])) for r in rows if rng.random() < 0.6] + [(None, 1, 1), (-4, 1, 0), (-4, 0, 1)]
    rng.shuffle(rows)
    return rows, labels


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), bool(re.search(r"[#$%&*|]", text))]


def plain(rows, labels):
    """Every order walked document by document."""
    last = 2**63 - 1
    least = {}
    for i, text, *_ in rows:
        least[text or ""] = min(least.get(text or "", last), last if i is None else i)
    rated = {}
    for i, good, toxic in labels:
        g, t = rated.get(i, (0, 0))
        rated[i] = (g or int(good == 1), t or int(toxic == 1))
    parts = {}
    for i, text, source, *_ in rows:
        e = (last if i is None else i) > least[text or ""]
        good, toxic = rated.get(i, (0, 0)) if i is not None else (0, 0)
        parts.setdefault(source or "", []).append((dict(zip("ABCDE", [*fails(text or ""), e], strict=True)), good, toxic))
    out, shares = {}, {}
    for part, docs in parts.items():
        for order in map("".join, itertools.permutations("ABCDE")):
            left = list(docs)
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                bad = [d for d in docs if d[0][f]]
                out[part, order, step] = [len(left), len(gone), len(bad) - len(gone), sum(sum(d[0].values()) == 1 for d in bad), sum(d[1] for d in gone), sum(d[2] for d in gone)]
                shares[part, f] = shares.get((part, f), 0) + len(gone)
    return sorted((*k, *v, shares[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def found(counters):
    return sorted(map(tuple, fa.report(counters).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley").collect()))


def write(spark, rows, path, files):
    """One file after another, so that the stream meets them in this order."""
    for k in range(files):
        spark.createDataFrame(rows[k::files], SCHEMA).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.01)


@pytest.mark.parametrize("files", [1, 3])
def test_equals_plain_walk(spark, tmp_path, files):
    rows, labels = documents(files)
    write(spark, rows, str(tmp_path / "docs"), 4)
    got = fa.follow(spark, str(tmp_path / "docs"), spark.createDataFrame(labels, LABELS), str(tmp_path / "run"), files)
    assert found(got) == plain(rows, labels)


def test_smaller_ids_retract_earlier_masks(spark, tmp_path):
    docs, run = str(tmp_path / "docs"), str(tmp_path / "run")
    rows, labels = [], [(k, k % 2, 1 - k % 2) for k in range(10)]
    known = spark.createDataFrame(labels, LABELS)
    for k in (9, 5, 7, 2, 1):
        new = [(k, "one text", f"s{k % 3}", "x", 1), (k, f"text of {k}", "s0", "x", 1), (None, "one text", "s1", "x", 1)]
        rows += new
        write(spark, new, docs, 1)
        assert found(fa.follow(spark, docs, known, run)) == plain(rows, labels)
    signed = spark.read.parquet(f"{run}/signed")
    assert signed.filter("n < 0").count() > 0


def test_hot_text_reaches_its_state_as_few_rows(spark, tmp_path):
    rows = [(k, "copied", f"s{k % 2}", "x", 1) for k in range(4000)]
    write(spark, rows, str(tmp_path / "docs"), 2)
    got = fa.follow(spark, str(tmp_path / "docs"), spark.createDataFrame([], LABELS), str(tmp_path / "run"))
    assert {(r.part, r.mask): r.n for r in got.filter("n <> 0").collect()} == {("s0", 1): 1, ("s0", 17): 1999, ("s1", 17): 2000}


def test_masks(spark):
    for text in TEXTS[1:]:
        want = sum(1 << k for k, f in enumerate(fails(text)) if f)
        assert spark.createDataFrame([(text,)], "text string").select(fa.text_mask(F.col("text"))).first()[0] == want


def test_empty_table(spark, tmp_path):
    write(spark, [], str(tmp_path / "docs"), 1)
    assert found(fa.follow(spark, str(tmp_path / "docs"), spark.createDataFrame([], LABELS), str(tmp_path / "run"))) == []
