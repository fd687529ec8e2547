"""Operators that settle things in rounds, against the same done one after another; numbering and order."""

import random

from pyspark.sql import functions as F

from markerloom.functions import scalars as s
from markerloom.operators import aggregates as a
from markerloom.operators import iterative as it
from markerloom.operators import joins as j
from markerloom.operators import sets
from markerloom.operators.numbering import with_row_number
from markerloom.sources import readers as rd

CHAIN = "id int, score long, tname string, tsize long, tstrand string, tstart long, tend long, qname string, qsize long, qstrand string, qstart long, qend long"


def rows(df, *columns):
    return sorted(map(tuple, (df.select(*columns) if columns else df).collect()))


def one_after_another(data):
    """(id, taken contig) of chains (id, target, its size, query, its size), in order of their ids."""
    taken, out = set(), []
    for k, t, t_size, q, q_size in sorted(data):
        if t not in taken and q not in taken:
            out.append((k, t if t_size <= q_size else q))
            taken.add(out[-1][1])
    return out


def chained(spark, data):
    full = [(k, 10**9, t, t_size, "+", 0, 1, q, q_size, "+", 0, 1) for k, t, t_size, q, q_size in data]
    return spark.createDataFrame(full, CHAIN)


def test_long_chains_of_dependent_rows_are_settled(spark):
    # each row waits for the one before it; the query is taken of every second row, else the target
    takes_target = [(k, f"c{k}", 5, f"c{k + 1}", 6) for k in range(320)]
    takes_query = [(k, f"d{k}", 6, f"d{k + 1}", 5) for k in range(1000, 1300)]
    got = rows(it.full_haplotypes(chained(spark, takes_target + takes_query), 1, 100), "id", "contig")
    assert got == one_after_another(takes_target + takes_query) and len(got) == 320 + 150


def test_random_haplotypes_equal_one_after_another(spark):
    rng = random.Random(3)
    data = [(k, f"c{rng.randint(0, 60)}", rng.randint(1, 9), f"e{rng.randint(0, 60)}", rng.randint(1, 9)) for k in range(400)]
    want = one_after_another(data)
    for component_rows in (500_000, 0):  # by components, and by rounds alone
        assert rows(it.full_haplotypes(chained(spark, data), 1, 100, component_rows), "id", "contig") == want
    assert rows(it.full_haplotypes(chained(spark, []), 1, 100)) == []


LA = "line int, contig string, start_pos long, end_pos long, orientation string, chr long, orig_start long, alt_start long, orig_end long, alt_end long, prev_contig string, prev_type string, prev_score long, next_contig string, next_type string, next_score long, map_score long"


def test_propagate_goes_on_until_nothing_changes(spark):
    # of every contig m1, m2, ... one row per chromosome; the one before it settles it, pass after pass
    data, line = [], 0
    for chromosome, score in ((1, 9), (2, 3)):
        for k in range(7):
            line += 1
            name = lambda i: f"m{i}" if i else f"u{chromosome}"
            data.append((line, name(k), 1, 10, "+", chromosome, 1, 1, 10, 10, name(k - 1) if k else "null", "paf" if k else "null", score if k else 0, "null", "null", 0, 0))
    la = spark.createDataFrame(data, LA)
    assert rows(it.propagate(la).filter("chr = 2"), "contig") == [("u2",)]
    assert it.propagate(la, max_rounds=3).filter("chr = 2").count() > 1


def best_chain(parts):
    """The best score over all increasing runs of parts, tried one by one."""
    best = 0.0
    for mask in range(1, 1 << len(parts)):
        run = [p for k, p in enumerate(parts) if mask >> k & 1]
        total = sum(p[2] for p in run)
        for (q0, t0, n0), (q1, t1, _) in zip(run, run[1:]):
            gaps = q1 - (q0 + n0), t1 - (t0 + n0)
            if min(gaps) < 0:
                break
            total -= sum(12 + g for g in gaps if g > 0)
        else:
            best = max(best, total)
    return best


def test_best_chain_of_all_runs(spark):
    rng, data, want = random.Random(7), [], {}
    for group in range(12):
        parts, q = [], 0
        for _ in range(7):
            q += rng.randint(0, 60)
            n = rng.randint(20, 60)
            parts.append((q, rng.randint(0, 500), n))
            q += n
        data += [(f"q{group}", 9999, q, q + n, "+", "t", 9999, t, t + n, 60, n, f"{n}M") for q, t, n in parts]
        want[f"q{group}"] = best_chain(parts)
    paf = spark.createDataFrame(data, "qname string, qlen long, qstart long, qend long, strand string, tname string, tlen long, tstart long, tend long, mapq long, as_score long, cigar string")
    got = {r.qname: r.top for r in it.chain_paf(paf).groupBy("qname").agg(F.max("as_score").alias("top")).collect()}
    assert got == want


def test_numbers_follow_the_order(spark):
    rng = random.Random(1)
    data = [(rng.randint(0, 50), k) for k in range(500)]
    got = with_row_number(spark.createDataFrame(data, "x int, y int").repartition(7), ["-x", "y"], "n").collect()
    assert [(r.x, r.y) for r in sorted(got, key=lambda r: r.n)] == sorted(data, key=lambda d: (-d[0], d[1])) and sorted(r.n for r in got) == list(range(1, 501))
    assert with_row_number(spark.createDataFrame([], "x int"), ["x"]).count() == 0


def test_sorts_order_their_rows(spark):
    df = spark.createDataFrame([(k, (k * 37) % 11, f"ctg{(k * 29) % 40}") for k in range(40)], "line int, as_score int, contig string").repartition(5)
    got = [(r.as_score, r.line) for r in sets.sort_desc(df, "as_score").collect()]
    assert got == sorted(got, key=lambda x: (-x[0], x[1]))
    got = [(r.as_score, r.line) for r in s.sort_by_score(df).collect()]
    assert got == sorted(got, key=lambda x: (-x[0], x[1]))
    got = [int(r.contig[3:]) for r in s.natural_sort(df, "contig").collect()]
    assert got == sorted(got)


def test_unlinked_markers_have_no_distance(spark):
    df = spark.createDataFrame([(0.1,), (0.5,), (0.7,), (None,)], "r double")
    got = df.select(*[s.map_distance(F.col("r"), m).alias(m) for m in ("kosambi", "haldane")]).collect()
    assert round(got[0].kosambi, 4) == 10.1366 and round(got[0].haldane, 4) == 11.1572
    assert all(r.kosambi is None and r.haldane is None for r in got[1:])


def test_fractional_weights_are_normalised(spark):
    prox = spark.createDataFrame([("a", 1, "a", 1, 0.25), ("b", 1, "b", 1, 0.5), ("a", 1, "b", 1, 0.1)], "contig1 string, pos1 long, contig2 string, pos2 long, weight double")
    assert {(r.contig1, r.contig2): round(r.weight, 4) for r in a.normalise_proximity(prox).collect()} == {("a", "a"): 100.0, ("b", "b"): 100.0, ("a", "b"): 20.0}
    assert a.normalise_proximity(prox.filter("contig1 <> contig2")).first().weight is None


def test_long_cigars(spark):
    text = "".join(f"{k % 50 + 1}M{k % 3 + 1}{'ID'[k % 2]}" for k in range(100_000)) + "5M2M"
    got = spark.createDataFrame([(text,)], "c string").select(s.cigar_blocks(F.col("c")).alias("b")).select(F.size("b").alias("n"), F.element_at("b", -1).alias("last"), F.aggregate("b", F.lit(0).cast("bigint"), lambda acc, x: acc + x["size"]).alias("size")).first()
    assert got.n == 100_001 and tuple(got["last"]) == (7, 0, 0) and got["size"] == sum(k % 50 + 1 for k in range(100_000)) + 7


def test_lifting_through_overlapping_blocks_takes_the_best(spark):
    kind = CHAIN.replace("id int", "id long") + ", blocks array<struct<size:bigint,dt:bigint,dq:bigint>>"
    chains = spark.createDataFrame([
        (1, 50, "t", 9000000, "+", 100, 400, "q", 1000, "+", 0, 260, [(100, 50, 10), (150, 0, 0)]),
        (2, 90, "t", 9000000, "+", 180, 3000180, "r", 5000000, "-", 0, 3000000, [(3000000, 0, 0)]),
    ], kind)
    points = spark.createDataFrame([("t", p) for p in (101, 180, 181, 220, 251, 260, 2000000, 3000181)], "contig string, pos long")
    got = {r.pos: (r.lifted_name, r.lifted_pos) for r in j.liftover_chain(points, chains).collect()}
    assert got == {101: ("q", 1), 180: ("q", 80), 181: ("r", 5000000), 220: ("r", 4999961), 251: ("r", 4999930), 260: ("r", 4999921), 2000000: ("r", 3000181)}


def test_readers_on_signs_in_headers_and_line_ends(spark, tmp_path):
    (tmp_path / "f.fa").write_text(">x a>b >c\nAC\nGT\n>y\nTT\n")
    assert rows(rd.read_fasta(spark, str(tmp_path / "f.fa"))) == [("x", "ACGT"), ("y", "TT")]
    (tmp_path / "w.fa").write_bytes(b">x\r\nAC\r\nGT\r\n>y\r\nTT\r\n")
    assert rows(rd.read_fasta(spark, str(tmp_path / "w.fa"))) == [("x", "ACGT"), ("y", "TT")]
    for end in (b"\n", b"\r\n"):
        text = end.join([b"# c", b"7 t 1 4 q 1 4 + 90", b"ACGT", b"AC-T", b"", b"8 t 5 8 q 5 8 - 80", b"AAAA", b"AAAT", b""])
        (tmp_path / "a.axt").write_bytes(text)
        assert rows(rd.read_axt(spark, str(tmp_path / "a.axt")), "id", "score", "tseq", "qseq") == [(7, 90, "ACGT", "AC-T"), (8, 80, "AAAA", "AAAT")]
    (tmp_path / "c.chain").write_text("# made up\nchain 9 my t 10\nchain 9 t 10 + 0 9 q 10 - 1 10 4\n5\t1\t0\n3\n\nchain 8 t 10 + 0 5 z 10 + 1 6 5\n5\n")
    got = rd.read_chain(spark, str(tmp_path / "c.chain")).filter("id IS NOT NULL")
    assert rows(got, "id", "qname") == [(4, "q"), (5, "z")]
    (tmp_path / "empty").write_text("")
    for reader in (rd.read_fasta, rd.read_chain, rd.read_axt):
        assert reader(spark, str(tmp_path / "empty")).count() == 0
