"""Corpus operators: brute force, round trips, held-out accuracy and odd input."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from markerloom.llm import embedding_dedup, language_id, license_scan, mixing, ngram_join, packing, quality, queries, secret_scan, suffix_dedup, topk

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"
WORDS = [a + b for a in ("ka", "lo", "mi", "ru", "te") for b in ("n", "s", "ra", "pel", "dor")]


def made_docs(seed=1, n=60):
    """Texts with exact and near copies, repeats, nulls, blanks and a long one."""
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 80))) for _ in range(n)]
    for k in range(0, n, 6):
        words = texts[k].split()
        texts += [texts[k], " ".join(words[:-1] + ["odd"]), texts[k].upper(), texts[k] + "\n\t tail"]
    texts += [None, "", " \n ", "one", "one", "two words", "é ñ ü 中文 x", " ".join(WORDS * 120)]
    return [(k, t, "en", f"s{k % 3}", None) for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(made_docs(), DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows(df, *columns):
    return sorted(map(tuple, (df.select(*columns) if columns else df).collect()))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(same_as_sql, name):
    same_as_sql(name)


# ---- 1 licences ----
def test_license_scan(spark, empty):
    mit = license_scan.KNOWN[0][1]
    text = "Copyright (c) 2020 Somebody\n" + mit.upper().replace(",", " ,").replace("SUBLICENSE", "SUB-LICENSE")
    data = [(1, text), (2, "prose\nReleased under the MIT license\nmore"), (3, None), (4, ""), (5, "Copyright 2001"), (6, mit + " extra"), (6, mit + " extra")]
    got = {r.doc_id: r for r in license_scan.scan_licenses(spark.createDataFrame(data, "doc_id long, text string").withColumn("license_digest", F.lit("x"))).collect()}
    assert got[1].license_id == "MIT" and got[2].license_id is None and got[2].notices == "MIT"
    assert got[3].digest is None and got[4].digest == got[5].digest == hashlib.md5(b"").hexdigest() and got[6].license_id is None
    assert license_scan.scan_licenses(empty).count() == 0


# ---- 2 top-k ----
def test_topk_with_ties_odd_vectors_and_few_rows(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(300, 8)).tolist()
    data = [(k, v) for k, v in enumerate(base)] + [(1000 + k, base[0]) for k in range(120)] + [(2000, None), (2020, [1.0, None]), (2040, [float("nan")] * 8), (2060, [float("inf")] * 8), (2080, []), (2100, [0.5])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = topk.exact_top_k(df.select("vec_id", topk.scaled(F.col("embedding")).alias("vector")), F.col("vec_id") % 20 == 0, k=7, tile_rows=50, block_rows=5, n_pivots=4, n_rings=3)
    held = {i: [math.floor(64 * x) for x in v] + [0] * (8 - len(v)) for i, v in data if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in (i for i in held if i % 20 == 0):
        best = sorted((-sum(a * b for a, b in zip(held[q], v, strict=True)), i) for i, v in held.items() if i != q)[:7]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert rows(got) == sorted(want)
    few = topk.exact_top_k(df.filter("vec_id < 3").select("vec_id", topk.scaled(F.col("embedding")).alias("vector")), F.col("vec_id") == 0)
    assert few.count() == 2
    assert topk.exact_top_k(df.limit(0).select("vec_id", topk.scaled(F.col("embedding")).alias("vector")), F.lit(True)).count() == 0


# ---- 3 mixing ----
def test_mix_reaches_targets(spark, docs, empty):
    sized = docs.select("doc_id", mixing.count_words(F.col("text")).alias("size"), F.array("source").alias("sources"))
    got = mixing.mix_sources(sized, mixing.contract_targets, bucket_docs=4).select("doc_id", "size", "taken", F.get("mixed.members", F.lit(0)).alias("m")).collect()
    texts = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs.collect()}
    taken, target = {}, {}
    for r in got:
        assert r["size"] == texts[r.doc_id] and r.taken in (0, r["size"], 2 * r["size"])
        taken[r.m.source] = taken.get(r.m.source, 0) + r.taken
        target[r.m.source] = r.m.target
    assert len(got) == len(texts) and all(abs(taken[s] - target[s]) <= 0.01 * target[s] for s in target)
    assert mixing.mix_sources(empty.select("doc_id", F.lit(1).cast("long").alias("size"), F.array("source").alias("sources")), mixing.contract_targets).count() == 0
    nulls = spark.createDataFrame([(1, 10, None), (2, 10, "a"), (2, 10, "a")], "doc_id long, size long, source string")
    assert mixing.mix_sources(nulls.select("doc_id", "size", F.array("source").alias("sources")), mixing.contract_targets).count() == 3


def test_water_filling_and_flow():
    got = mixing.water_filled({"a": 10, "b": 100, None: 10}, 1.5, 2.0, (3.0, 1.0, 2.0))
    assert got == {"a": 20.0, None: 20.0, "b": 140.0}
    flow = mixing.route([(("x", "y"), 10), (("x",), 5)], {"x": 12, "y": 8}, 2)
    assert sum(f.get("x", 0) for f in flow) == 12 and sum(f.get("y", 0) for f in flow) == 8
    assert sum(flow[0].values()) + sum(flow[1].values()) == 20 and sum(flow[0].values()) <= 20
    # everything fits the first pass only if the shared pattern serves y
    flow = mixing.route([(("x", "y"), 10), (("x",), 5)], {"x": 5, "y": 10}, 2)
    assert [sum(f.values()) for f in flow] == [10, 5]


# ---- 4 embeddings ----
def test_embedding_dedup_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 16))
    data = [(k, v.tolist(), k % 2) for k, v in enumerate(base)]
    data += [(100 + k, (base[k % 10] + rng.normal(scale=0.05, size=16)).tolist(), (k % 10) % 2) for k in range(60)] + [(200 + k, base[1].tolist(), 1) for k in range(30)]
    data += [(300, None, 1), (301, [0.0] * 16, 1), (302, [float("nan")] * 16, 1), (303, [None] * 16, 1), (304, base[1].tolist(), None), (305, [], 0), (306, [1.0], 0)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    ok = {i: (np.array(v), lab) for i, v, lab in data if lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    links = {i: [j for j, (w, m) in ok.items() if j != i and m == lab and len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= 0.98] for i, (v, lab) in ok.items()}
    want = []
    for i, *_ in data:
        seen, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        want.append((i, len(links.get(i, [])), min(seen), min(seen) == i))
    assert rows(embedding_dedup.near_duplicates(df, tile_rows=16)) == sorted(want)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_quantisation_bound_is_rigorous():
    rng = np.random.default_rng(8)
    u = rng.normal(size=(200, 24))
    u /= np.linalg.norm(u, axis=1)[:, None]
    codes, scale, size, miss = embedding_dedup.quantised(u)
    approx = (codes.astype(float) @ codes.T.astype(float)) * scale[:, None] * scale[None, :]
    assert (np.abs(u @ u.T - approx) <= size[:, None] * miss[None, :] + miss[:, None] + 1e-12).all()


# ---- 5 n-grams ----
def brute_classes(data, n=5):
    sets = {}
    for i, t, *_ in data:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j]:
                o = len(sets[i] & sets[j])
                if 100 * o >= 75 * (len(sets[i]) + len(sets[j]) - o):
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
    return sorted((i, len(s), find(i)) for i, s in sets.items())


def test_jaccard_classes_match_brute_force(docs, empty):
    want = brute_classes(made_docs())
    assert rows(ngram_join.jaccard_classes(docs), "doc_id", "n_shingles", "component_id") == want
    # small tiles take the paths that large inputs take
    assert rows(ngram_join.jaccard_classes(docs, tile_rows=64, tile_bytes=1 << 12, exact_rows=3), "doc_id", "n_shingles", "component_id") == want
    assert ngram_join.jaccard_classes(empty).count() == 0


def test_jaccard_star_linked_only_through_its_centre(spark):
    rng = random.Random(4)
    core = [f"w{k}" for k in range(120)]
    data = [(50, " ".join(core), None, None, None)]
    for k in range(25):
        words = list(core)
        for at in rng.sample(range(120), 4):
            words[at] = f"x{k}-{at}"
        data.append((k, " ".join(words), None, None, None))
    want = brute_classes(data)
    assert rows(ngram_join.jaccard_classes(spark.createDataFrame(data, DOCS), exact_rows=5), "doc_id", "n_shingles", "component_id") == want


def test_bitmap_bound_never_loses_a_pair():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 2**63, rng.integers(1, 300)).astype(np.uint64)) for _ in range(30)]
    sets += [np.unique(np.concatenate([s[: int(len(s) * 0.9)], rng.integers(0, 2**63, 3).astype(np.uint64)])) for s in sets]
    sets.sort(key=len)
    n, signs = np.array([len(s) for s in sets]), [ngram_join.signature(s) for s in sets]
    i, j = ngram_join.candidates(signs, n, signs, n, 75, 175)
    found = set(zip(i.tolist(), j.tolist(), strict=True))
    for a in range(len(sets)):
        for b in range(len(sets)):
            o = len(np.intersect1d(sets[a], sets[b]))
            assert (a, b) in found or 175 * o < 75 * (n[a] + n[b])
    assert (ngram_join.overlaps(sets[:9], sets) == [[len(np.intersect1d(a, b)) for b in sets] for a in sets[:9]]).all()


# ---- 6 repeated strings ----
def test_repeated_strings_match_brute_force(spark, empty):
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdé ") for _ in range(150))
    noise = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    texts = [noise(300), passage + noise(40), noise(30) + passage, passage[:110] + noise(20) + passage[20:], "ab" * 200, "x" * 99, "x" * 230, None, "", noise(500)]
    texts += [texts[0], texts[5], texts[0][:250] + "zz", noise(10) + passage[5:105]]
    data = [(k, t, None, None, None) for k, t in enumerate(texts)]
    seen, want = set(), []
    for k, t in enumerate(texts):
        b = (t or "").encode()
        covered = [False] * len(b)
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                covered[p : p + 100] = [True] * 100
            seen.add(b[p : p + 100])
        kept = bytes(x for x, c in zip(b, covered, strict=True) if not c)
        runs = sum(c and (i == 0 or not covered[i - 1]) for i, c in enumerate(covered))
        want.append((k, len(b), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    df = spark.createDataFrame(data, DOCS).repartition(3, "doc_id")
    assert rows(suffix_dedup.repeated_strings(df), *columns) == sorted(want)
    assert rows(suffix_dedup.repeated_strings(df, bucket_bytes=200), *columns) == sorted(want)
    # texts cut into segments, also where the last one is longer than a segment
    for size in (90, 150):
        assert rows(suffix_dedup.repeated_strings(df, segment_bytes=size), *columns) == sorted(want)
    assert suffix_dedup.repeated_strings(empty).count() == 0


def test_a_string_in_every_document_goes_past_the_bucket_of_its_name(spark):
    rng = random.Random(10)
    footer = "-" * 400 + "".join(rng.choice("abcdefgh ") for _ in range(200))
    noise = lambda: "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 120)))
    data = [(k, noise() + footer, None, None, None) for k in range(120)]
    got = {r.doc_id: r for r in suffix_dedup.repeated_strings(spark.createDataFrame(data, DOCS).repartition(4), bucket_bytes=4096).collect()}
    assert got[0].n_removed == 300 + 100 - 100 or got[0].n_removed > 0
    assert all(got[k].n_removed >= len(footer) for k in range(1, 120))
    block = suffix_dedup._sent(np.zeros(500, np.int64), np.arange(500), np.zeros(500, np.uint64), 3)
    dest, names = block.column("dest").to_pylist(), block.column("names").to_pylist()
    assert [len(n) // 4 for d, n in zip(dest, names, strict=True) if d < 8] == [1] and sum(d >= 8 for d in dest) == 1


def test_difference_cover_and_segments():
    assert suffix_dedup.covers(suffix_dedup.MODULUS, suffix_dedup.COVER)
    text = "".join(map(str, range(100)))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": [text, None]})
    parts = [x for block in suffix_dedup._segments(iter([batch]), 9, 50) for x in block]
    starts = [o + k for d, o, b, *_ in parts if d == 1 for k in range(min(50, len(b) - 9))]
    assert starts == list(range(len(text) - 9)) and all(text.encode()[o : o + len(b)] == b for d, o, b, *_ in parts if d == 1)
    assert [last for d, *_, last, _ in parts if d == 1] == [False, False, False, True] and [last for d, *_, last, _ in parts if d == 2] == [True]


# ---- 7 language ----
def test_language_id(spark, docs, empty):
    table = spark.read.parquet(f"{SF}/../sf0.01/documents.parquet")
    got = language_id.op7_language_id(spark, "/root/testdata/sf0.01").join(table.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert len(got) > 100 and (got["lang"] == got["lang_pred"]).mean() > 0.95 and got["score"].between(0, 1).all()
    odd = spark.createDataFrame([(1, None, "en"), (2, "", "en"), (3, "123 !?", "en"), (4, "the and of", None), (5, "x " * 90000, "en")], "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    out = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(odd, odd).collect()}
    assert out[1] == out[2] == out[3] == ("und", 0.0) and out[4][0] == out[5][0] == "en"
    assert language_id.identify(empty, empty).count() == 0
    assert {r.lang_pred for r in language_id.identify(odd, odd.limit(0)).collect()} == {"und"}


# ---- 8 packing ----
def test_packing_round_trip(spark, docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = packing.pack(docs, length=64, shard_pieces=40).collect()
    texts = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2] for r in docs.collect()}
    cover, fill = {}, {}
    for r in got:
        ids = texts[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(texts[r.doc_id]) and r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        cover.setdefault(r.doc_id, []).append((r.start, r.length))
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d, ids in texts.items():
        at = 0
        for start, n in sorted(cover[d]):
            assert start == at
            at += n
        assert at == len(ids)
    for parts in fill.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 64
    assert packing.pack(empty).count() == 0


def test_best_fit_matches_plain_search():
    rng = random.Random(2)
    lengths = [rng.randint(1, 4096) for _ in range(500)]
    sequences, offsets = packing.best_fit(lengths, 4096)
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [(room, k) for k, room in enumerate(rooms) if room >= n]
        if fits:
            rooms[min(fits)[1]] -= n
        else:
            rooms.append(4096 - n)
    fill = {}
    for n, s in zip(lengths, sequences, strict=True):
        fill[s] = fill.get(s, 0) + n
    assert sorted(4096 - f for f in fill.values()) == sorted(rooms)


def test_words_encode_as_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["", " a  b\n\tc ", "It's DON'T 've", "<|endoftext|> x", "É é ß İ Σ ΑΣ.", "a\u0085b\xa0c", "...!! $%& 12ab34"]
    words, tokenizer = packing.WordIds(path, keep=3), Tokenizer.from_file(path)
    texts += ["'tis (\"'s) x'Y", "<|ENDOFTEXT|>é<|endoftext|>y", "\u2260=\u0338", "a\x0bb\x0c c\x1cd", "\x00a'", " ", "don'"]
    rng = random.Random(1)
    texts += ["".join(rng.choice("aBz'\u2019 \n\t.,-1é中İΣ\u0301<|>_\xa0\x0b") for _ in range(rng.randint(0, 14))) for _ in range(1000)]
    for _ in range(2):
        assert [x.tolist() for x in words.encode(texts, 2)] == [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    # a long text is read in stretches; the result is that of the whole
    long = " ".join(texts) + "x" * 300 + " tail"
    (_, ids), (_, last) = packing._token_runs(words, pa.array([long, None]), 2, most=64)
    assert ids.tolist() == tokenizer.encode(long, add_special_tokens=False).ids + [2] and last.tolist() == [2]


# ---- 9 secrets ----
def test_secret_scan_cases(spark, empty):
    key = "q9Zr7Xb2Lw8Kp4Vn6Td1Mf3Hs5Gy0Jc"
    data = [(1, 'é password = "hunter22x"'), (2, "token=abc secret=abcdef"), (3, "AKIA" + "A" * 16 + " " + "0af" * 8), (4, None), (5, ""), (6, f"id {key} end"), (7, "123e4567-e89b-12d3-a456-426614174000"), (8, "API_KEY: x12345; apikey=654321"), (9, "secret=token:abcdefg")]
    got = {r.doc_id: r for r in secret_scan.scan_secrets(spark.createDataFrame(data, "doc_id long, text string").withColumn("base_spans", F.lit(1))).withColumn("s", secret_scan.spans_text(F.col("secret_spans"))).withColumn("r", secret_scan.redact(F.col("text"), F.col("secret_spans"))).collect()}
    assert got[1].s == "assign:2:23" and got[2].s == "assign:10:23" and got[3].s == "access:0:20,hex:21:45"
    assert got[4].s == got[5].s == got[7].s == got[9].s == "" and got[6].s.startswith("entropy:3:") and got[8].s == "assign:0:15,assign:17:30"
    assert got[1].r == 'é [SECRET]"' and got[6].r == "id [SECRET] end" and got[4].r is None and got[3].r == "[SECRET] [SECRET]"
    assert secret_scan.scan_secrets(empty).count() == 0


def test_sliding_entropy_matches_direct_count(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice("aB3dE6gH9") for _ in range(rng.randint(20, 70))) for _ in range(20)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [(r[0]["first"], r[0]["last"]) for r in df.select(secret_scan._hot_range(F.col("t"), F.lit(2.9))).collect()]
    for t, (first, last) in zip(texts, got, strict=True):
        hot = []
        for i in range(19, len(t)):
            win = t[i - 19 : i + 1]
            if round(-sum(win.count(c) / 20 * math.log2(win.count(c) / 20) for c in set(win)), 6) >= 2.9:
                hot.append(i)
        assert (first, last) == ((hot[0], hot[-1]) if hot else (-1, -1))


# ---- 10 quality ----
def test_quality(spark, empty):
    sf = "/root/testdata/sf0.01"
    got = quality.op10_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    right = (got["quality"] == got["predicted"]).groupby(got["quality"]).mean()
    assert right[1] > 0.9 and right[0] > 0.85 and got["score"].between(0, 1).all()
    odd = spark.createDataFrame([(1, None), (2, ""), (2, ""), (3, "x y " * 50000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, None), (9, 1)], "doc_id long, quality int")
    out = quality.score_quality(odd, labels).collect()
    assert len(out) == 4 and all(0 <= r.score <= 1 for r in out)
    assert {r.score for r in quality.score_quality(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.score_quality(empty, labels).count() == 0


# ---- pipeline ----
def test_pipeline_stages(spark, empty):
    import corpus_pipeline as cp

    data = made_docs(n=30) + [(500, "password = hunter2222 " + "then kan los mira " * 9, "en", "s1", 3)]
    docs = spark.createDataFrame(data, DOCS).withColumn("score", F.lit("clash")).withColumn("lang_pred", F.col("doc_id")).withColumn("secret_spans", F.lit(1)).withColumn("times", F.lit(9)).withColumn("class", F.lit(None).cast("string"))
    lang = cp.language(spark, docs, "")
    assert lang.columns == docs.columns and {r.doc_id for r in lang.collect()} == {i for i, t, *_ in data if t and any(map(str.isalpha, t))}
    single = cp.near_duplicates(spark, lang, "")
    held = {r.doc_id for r in lang.collect()}
    assert {r.doc_id for r in single.collect()} == {i for i, _, c in brute_classes([d for d in data if d[0] in held]) if i == c}
    clean = cp.secrets(spark, single, "")
    assert clean.columns == docs.columns and "[SECRET]" in clean.filter("doc_id = 500").first().text and clean.filter("doc_id = 500").first().n_chars == len(clean.filter("doc_id = 500").first().text)
    mixed = cp.source_mix(spark, clean, "")
    assert {(r.score, r.secret_spans, r.times) for r in mixed.collect()} == {("clash", 1, 9)} and mixed.filter("lang_pred <> doc_id").count() == 0
    assert mixed.columns == docs.columns and max(r["count"] for r in mixed.groupBy("doc_id").count().collect()) <= 2
    packed = cp.pack(spark, mixed, "")
    assert packed.select(F.sum("length")).first()[0] == packed.filter("start = 0").select(F.sum("doc_tokens")).first()[0]
    out = empty
    for _, stage in cp.STAGES:
        out = stage(spark, out, "")
    assert out.count() == 0


def test_rows_without_id(spark):
    text = "kan los mira rupel tedor " * 30
    df = spark.createDataFrame([(None, text, None, None, None), (None, "x " * 80, "en", "a", 1), (4, text, "en", None, None)], DOCS)
    assert rows(ngram_join.jaccard_classes(df).filter("doc_id = 4"), "component_id") == [(4,)] and ngram_join.jaccard_classes(df).count() == 3
    assert rows(suffix_dedup.repeated_strings(df).filter("doc_id = 4"), "n_removed") == [(len(text) - 25,)]
    assert packing.pack(df).filter("start = 0").count() == 3 and secret_scan.scan_secrets(df).count() == 3
    assert language_id.identify(df, df).count() == 3
    vectors = spark.createDataFrame([(None, [1.0, 2.0], 1), (None, [3.0, 1.0], 1), (5, [1.0, 2.0], 1)], "vec_id long, embedding array<double>, label int")
    assert rows(embedding_dedup.near_duplicates(vectors).filter("vec_id = 5"), "n_links", "component_id") == [(0, 5)]
    assert topk.exact_top_k(vectors.select("vec_id", topk.scaled(F.col("embedding")).alias("vector")), F.lit(True)).count() == 0
    mixed = mixing.mix_sources(df.select("doc_id", mixing.count_words(F.col("text")).alias("size"), F.array("source").alias("sources")), mixing.contract_targets)
    assert mixed.count() == 3
