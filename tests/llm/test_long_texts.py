"""Very long texts, rows without id and repeated ids."""

import random

import numpy as np
from pyspark.sql import functions as F

from markerloom.llm import embedding_dedup, language_id, license_scan, mixing, ngram_join, quality, topk

MIT_LINES = ["Released under the MIT License."]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows(df, *columns):
    return sorted(map(tuple, (df.select(*columns) if columns else df).collect()))


def test_texts_of_hundreds_of_thousands_of_words(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(150_000)]
    near = list(words)
    for at in rng.sample(range(len(words)), 2000):
        near[at] = "odd"
    data = [(1, " ".join(words), "en", "a", 0), (2, " ".join(near), "en", "a", 0), (3, " ".join(reversed(words)), "en", "b", 0), (4, "short text", "en", "b", 0)]
    docs = spark.createDataFrame(data, DOCS)
    assert rows(ngram_join.jaccard_classes(docs), "doc_id", "component_id") == [(1, 1), (2, 1), (3, 3), (4, 4)]
    assert rows(docs.select("doc_id", mixing.count_words(F.col("text")))) == [(1, 150_000), (2, 150_000), (3, 150_000), (4, 2)]
    assert {r.lang_pred for r in language_id.identify(docs, docs).collect()} == {"en"}
    labels = spark.createDataFrame([(1, 1), (4, 0)], "doc_id long, quality int")
    scores = quality.score_quality(docs, labels).collect()
    assert len(scores) == 4 and all(np.isfinite(r.score) for r in scores)
    long = spark.createDataFrame([(1, "\n".join([data[0][1], *MIT_LINES, data[2][1]])), (2, "\n".join(MIT_LINES))], "doc_id long, text string")
    got = {r.doc_id: (r.license_id, r.notices) for r in license_scan.scan_licenses(long).collect()}
    assert got == {1: (None, "MIT"), 2: ("MIT", "MIT")}


def test_repeated_ids_of_vectors(spark):
    data = [(20, [5.0, 1.0]), (20, [1.0, 5.0]), (1, [1.0, 4.0]), (1, [1.0, 4.0]), (2, [4.0, 1.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = topk.exact_top_k(df.select("vec_id", topk.scaled(F.col("embedding")).alias("vector")), F.col("vec_id") == 20, k=3)
    # one query, of the lesser vector; its own rows are no candidates, repeated others are each
    assert [(r.rank, r.vec_id) for r in got.orderBy("rank").collect()] == [(1, 1), (2, 1), (3, 2)]


def test_only_pairs_that_may_link_are_recomputed():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(300, 8))
    b = np.concatenate([a[:40] + rng.normal(scale=0.02, size=(40, 8)), rng.normal(size=(200, 8))])
    i, j = embedding_dedup.linked_pairs(a, b, 0.98)
    cosine = (a @ b.T) / np.linalg.norm(a, axis=1)[:, None] / np.linalg.norm(b, axis=1)[None, :]
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(cosine >= 0.98)), strict=True))


def test_pipeline_keeps_good_documents_without_id(spark):
    import corpus_pipeline as cp

    text = "kan los mira rupel tedor " * 30
    other = " ".join(f"word{k} of" for k in range(90))
    docs = spark.createDataFrame([(None, other, "en", "a", 1), (None, other, "en", "b", 1), (None, text, "en", "a", 1), (7, text, "en", "a", 1), (9, "b " * 40, "en", "a", 1), (9, "a c d e f " * 40, "en", "a", 1)], DOCS)
    got = cp.near_duplicates(spark, docs, "").collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.text[:4]) for r in got) == [(-1, "word"), (7, "kan "), (9, "a c ")]
