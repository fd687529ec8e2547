"""Hand-computed tables for operators beyond SQL, and invariants."""

import pytest
from pyspark.sql import functions as F

from markerloom.functions import scalars as s
from markerloom.operators import aggregates as a
from markerloom.operators import iterative as it
from markerloom.operators import joins as j
from markerloom.operators import linkage as lk
from markerloom.operators import sets
from markerloom.operators import windows as w
from markerloom.operators.components import connected_components
from markerloom.sources import readers as rd
from markerloom.sources import writers as wr


def rows(df, *columns):
    return sorted(map(tuple, (df.select(*columns) if columns else df).collect()))


def test_leading_int(spark):
    df = spark.createDataFrame([("12-30",), ("500*",), ("x",), (None,), ("-7a",)], "c string")
    assert [r[0] for r in df.select(s.leading_int(F.col("c"))).collect()] == [12, 500, 0, 0, -7]


def test_reverse_complement_twice_is_identity_and_unknown_letters_raise(spark):
    df = spark.createDataFrame([("ACGTNRYacgt",), ("",), (None,)], "c string")
    once = df.select("c", s.reverse_complement(F.col("c")).alias("r"))
    assert all(r[0] == r[1] for r in once.select("c", s.reverse_complement(F.col("r"))).collect())
    assert spark.createDataFrame([("AZ",)], "c string").select(s.reverse_complement(F.col("c"), permissive=True)).first()[0] is None
    with pytest.raises(Exception, match="IUPAC"):
        spark.createDataFrame([("AZ",)], "c string").select(s.reverse_complement(F.col("c"))).collect()


def test_cigar_blocks(spark):
    df = spark.createDataFrame([("10M2I3D5M4M1I",), ("3I7M",)], "c string")
    got = [[tuple(b) for b in r[0]] for r in df.select(s.cigar_blocks(F.col("c"))).collect()]
    assert got == [[(10, 2, 3), (9, 1, 0)], [(0, 3, 0), (7, 0, 0)]]
    with pytest.raises(Exception, match="CIGAR"):
        spark.createDataFrame([("10M2S",)], "c string").select(s.cigar_blocks(F.col("c"))).collect()


def test_liftover_first_row_wins_and_inverse_undoes(spark):
    agp = spark.createDataFrame([(1, "A", 1, 100, "W", "c", 1, 100, "-"), (2, "B", 1, 100, "W", "c", 50, 149, "+")], "line int, obj string, obj_beg long, obj_end long, ctype string, contig string, contig_beg long, contig_end long, orientation string")
    points = spark.createDataFrame([("c", 1), ("c", 60), ("c", 120), ("c", 500), ("d", 1)], "contig string, pos long")
    got = {(r.contig, r.pos): (r.lifted_name, r.lifted_pos) for r in j.liftover(points, agp).collect()}
    assert got == {("c", 1): ("A", 100), ("c", 60): ("A", 41), ("c", 120): ("B", 71), ("c", 500): (None, None), ("d", 1): (None, None)}
    assert rows(j.liftover_unmatched(points, agp)) == [("c", 500, "position outside"), ("d", 1, "contig absent")]


def test_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(0, 40)] + [(100, 101), (101, 100), (7, 7)], "src long, dst long")
    got = dict(rows(connected_components(edges)))
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}
    assert rows(connected_components(edges.limit(0))) == []


def test_groups_of_packed_genotypes(spark):
    from markerloom.plans.fixtures import fixture

    geno = fixture(spark, "/root/testdata/sf0.01", "geno")
    groups = lk.separate_chromosomes(lk.pairwise_lod(geno, 40, 5), geno, 5, 2)
    got = rows(groups.join(geno, "marker_id").groupBy("lg").agg(F.count_distinct(F.col("marker_id") % 12)))
    assert [g for g, _ in got] == list(range(1, 13)) and all(n == 1 for _, n in got)


def test_join_singles_iterates(spark):
    groups = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 0)], "marker_id long, lg long")
    lod = spark.createDataFrame([(1, 2, 9.0), (2, 3, 8.0), (3, 4, 1.0)], "a long, b long, lod double")
    assert rows(lk.join_singles(groups, lod, 5, 1)) == [(1, 1), (2, 1), (3, 0), (4, 0)]
    assert rows(lk.join_singles(groups, lod, 5, 1, iterate=True)) == [(1, 1), (2, 1), (3, 1), (4, 0)]


def test_trim_edges(spark):
    data = [(k, 1, float(x), float(x)) for k, x in enumerate([0, 1, 30, 31, 32, 33, 34, 35, 36, 90], 1)]
    df = spark.createDataFrame(data, "line int, lg int, male_cm double, female_cm double")
    got = w.trim_edges(df, 20, 30)
    assert [r.line for r in got.filter("qc").orderBy("line").collect()] == [3, 4, 5, 6, 7, 8, 9]
    assert got.filter("line = 3").first().male_cm == 0.0
    assert w.trim_edges(df, 99, 30).filter("NOT qc").count() == 0
    assert rows(w.trim_report(got)) == [(1, 0, 0, 3)]


def test_clean_map_prunes_shortest_and_merges(spark):
    data = [("c", 1, 1), ("c", 20000, 1), ("c", 20500, 2), ("c", 20600, 2), ("c", 21000, 1), ("c", 50000, 1), ("d", 5, 3), ("e", 1, 0)]
    df = spark.createDataFrame([(k, *x) for k, x in enumerate(data)], "line int, contig string, pos long, chr long")
    assert rows(w.clean_map(df), "contig", "start", "end", "chr", "n") == [("c", 1, 50000, 1, 4), ("d", 5, 5, 3, 1)]


def test_map_to_bed_and_join_intervals(spark):
    iv = spark.createDataFrame([("c", 1, 10, 100, 1), ("c", 2, 201, 300, 2)], "contig string, run long, start long, end long, chr long")
    lengths = spark.createDataFrame([("c", 500)], "contig string, length long")
    assert rows(w.join_intervals(iv, lengths), "start", "end", "chr") == [(1, 150, 1), (151, 500, 2)]


BED = "contig string, start_s string, end_s string, orientation string, chr long"


def test_cut_bed(spark):
    bed = spark.createDataFrame([("c", "1", "400-500", "?", 1), ("c", "401-501", "1000*", "?", 2), ("d", "1", "900*", "?", 2)], BED)
    sites = [("c", 200, 250), ("c", 430, 440), ("c", 460, 470), ("x", 50, 50)]
    got = rows(w.cut_bed(bed, spark.createDataFrame(sites, "contig string, cut_lo long, cut_hi long")), "contig", "start_s", "end_s", "chr")
    assert got == sorted([
        ("c", "1-1", "199-250", 1), ("c", "200-251", "429-440", 1), ("c", "430-441", "459-470", 1), ("c", "430-441", "459-470", 2), ("c", "460-471", "1000-1000*", 2),
        ("d", "1", "900*", 2), ("x", "1", "49-50", 1), ("x", "1", "49-50", 2), ("x", "50-51", "N*", 1), ("x", "50-51", "N*", 2),
    ])
    crossing = spark.createDataFrame([("c", 300, 600), ("c", 390, 420)], "contig string, cut_lo long, cut_hi long")
    got = rows(w.cut_bed(bed, crossing), "contig", "start_s", "end_s", "chr")
    assert ("c", "1-1", "401-420", 1) in got and len([r for r in got if r[0] == "c"]) == 2


LA = "line int, contig string, start_pos long, end_pos long, orientation string, chr long, orig_start long, alt_start long, orig_end long, alt_end long, prev_contig string, prev_type string, prev_score long, next_contig string, next_type string, next_score long, map_score long"


def test_remove_overlaps_moves_cut_points(spark):
    bed = spark.createDataFrame([("c", "1", "100-100", "?", 1), ("c", "101-101", "200*", "?", 1)], BED)
    la = spark.createDataFrame([
        (1, "c", 1, 100, "+", 1, 1, 1, 100, 95, "null", "null", 0, "x", "chain1", 5, 0),
        (2, "c", 101, 200, "+", 2, 101, 101, 200, 200, "null", "null", 0, "null", "null", 0, 0),
    ], LA)
    got = {r.line: (r.start_pos, r.end_pos) for r in w.remove_overlaps(bed, la).collect()}
    assert got == {1: (1, 100), 2: (101, 200)}
    la = la.withColumn("end_pos", F.when(F.col("line") == 1, 90).otherwise(F.col("end_pos"))).withColumn("alt_end", F.when(F.col("line") == 1, 92).otherwise(F.col("alt_end")))
    got = {r.line: (r.start_pos, r.end_pos) for r in w.remove_overlaps(bed, la).collect()}
    assert got == {1: (1, 90), 2: (93, 200)}


def test_agp_objects_are_contiguous(spark):
    from markerloom.plans.fixtures import fixture

    la = fixture(spark, "/root/testdata/sf0.001", "la")
    for make in (w.make_agp, w.make_agp2, w.make_agp_full, w.make_agp_full2):
        at = {}
        for r in make(la).orderBy("obj", "part_no").collect():
            end, part = at.get(r.obj, (0, 0))
            assert (r.obj_beg, r.part_no) == (end + 1, part + 1)
            at[r.obj] = (r.obj_end, r.part_no)


CHAIN = "id int, score long, tname string, tsize long, tstrand string, tstart long, tend long, qname string, qsize long, qstrand string, qstart long, qend long"


def test_full_haplotypes_blocks_later_chains(spark):
    chains = spark.createDataFrame([
        (1, 90000, "a", 1000, "+", 0, 1000, "b", 5000, "+", 0, 1000),
        (2, 80000, "b", 5000, "+", 0, 900, "a", 1000, "+", 0, 900),
        (3, 70000, "a", 1000, "+", 0, 950, "c", 900, "-", 10, 890),
        (4, 60000, "c", 900, "+", 0, 900, "d", 800, "-", 0, 790),
    ], CHAIN)
    got = rows(it.full_haplotypes(chains, 50, 100), "id", "contig", "partner", "aligned_start", "aligned_end", "partner_aligned_start", "partner_aligned_end")
    assert got == [(1, "a", "b", 1, 1000, 1, 1000), (4, "c", "d", 1, 900, 11, 800)]


def test_scored_haplotypes(spark):
    records = spark.createDataFrame([(9, "a", 1, 5000, "b"), (8, "b", 1, 5000, "a"), (7, "c", 1, 5000, "b"), (0, "d", 1, 9000, "c")], "score long, contig string, start long, end long, partner string")
    assert rows(it.scored_haplotypes(records), "contig") == [("a",), ("c",)]


def test_propagate_settles_ambiguous_pieces(spark):
    la = spark.createDataFrame([
        (1, "u", 1, 10, "+", 1, 1, 1, 10, 10, "null", "null", 0, "m", "paf", 9, 0),
        (2, "m", 1, 10, "+", 1, 1, 1, 10, 10, "u", "paf", 9, "null", "null", 0, 0),
        (3, "v", 1, 10, "+", 2, 1, 1, 10, 10, "null", "null", 0, "m", "paf", 3, 0),
        (4, "m", 1, 10, "+", 2, 1, 1, 10, 10, "v", "paf", 3, "null", "null", 0, 0),
    ], LA)
    got = {r.line: (r.next_contig, r.next_score) for r in it.propagate(la).collect()}
    assert got == {1: ("m", 9), 2: ("null", 0), 3: ("null", 0)}


def test_propagate_links_spreads(spark):
    la = spark.createDataFrame([(1, "u", 1, 10, "+", 1, 1, 1, 10, 10, "null", "null", 4, "null", "null", 0, 0), (2, "v", 1, 10, "+", 2, 1, 1, 10, 10, "null", "null", 4, "null", "null", 0, 0)], LA)
    links = spark.createDataFrame([(1, "u", "+", "p", "+", 7), (1, "p", "+", "q", "+", 6), (1, "u", "+", "r", "+", 3), (1, "v", "+", "r", "+", 3), (1, "r", "+", "t", "+", 5)], "file_no int, contig1 string, o1 string, contig2 string, o2 string, score long")
    got = rows(it.propagate_links(la, links), "contig", "chr")
    assert got == [("p", 1), ("q", 1), ("r", 1), ("r", 2), ("t", 1), ("t", 2), ("u", 1), ("v", 2)]


PAF = "qname string, qlen long, qstart long, qend long, strand string, tname string, tlen long, tstart long, tend long, mapq long, as_score long, cigar string"


def test_chain_paf(spark):
    paf = spark.createDataFrame([
        ("q", 1000, 0, 100, "+", "t", 1000, 0, 100, 60, 100, "100M"), ("q", 1000, 110, 200, "+", "t", 1000, 105, 195, 60, 90, "90M"),
        ("q", 1000, 0, 50, "-", "t", 1000, 0, 50, 60, 50, "50M"), ("q", 1000, 900, 950, "+", "z", 1000, 0, 50, 60, 0, "50M"),
    ], PAF)
    got = rows(it.chain_paf(paf), "qstart", "qend", "strand", "as_score", "cigar", "chained")
    assert got == [(0, 50, "-", 50, "50M", 1), (0, 100, "+", 100, "100M", 1), (0, 200, "+", 151, "100M10I5D90M", 2), (110, 200, "+", 90, "90M", 1)]
    overlapping = spark.createDataFrame([("q", 1000, 0, 100, "+", "t", 1000, 0, 100, 60, 100, "100M"), ("q", 1000, 90, 190, "+", "t", 1000, 95, 195, 60, 100, "100M")], PAF)
    assert rows(it.chain_paf(overlapping).filter("chained = 2"), "as_score", "cigar") == [(173, "100M5D90M")]


def test_filter_outliers_flags_the_far_marker(spark):
    data = [("L", k * 100, 0.5 * k + (40.0 if k == 50 else 0.0)) for k in range(100)]
    df = spark.createDataFrame(data, "lg string, pos long, male_cm double")
    got = {r.pos: (r.penalty, r.qc) for r in w.filter_outliers(df).collect()}
    assert got[5000][1] == "FAIL" and sum(q == "FAIL" for p, (_, q) in got.items() if p < 8000) == 1


def test_same_rows_counts_repeats(spark):
    one, two = spark.createDataFrame([(1, "a"), (1, "a")], "x int, y string"), spark.createDataFrame([(1, "a")], "x int, y string")
    assert rows(sets.same_rows(one, two)) == [(2, 1, False)] and rows(sets.same_rows(one, one)) == [(2, 2, True)]


def test_partition_independence(spark):
    from markerloom.plans.fixtures import fixture

    got = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got.append(rows(it.propagate(fixture(spark, "/root/testdata/sf0.001", "la"), max_rounds=2), "line", "next_contig"))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got[0] == got[1]


def test_readers_on_odd_files(spark, tmp_path):
    (tmp_path / "t.txt").write_text("# c\na\t1\nb\t2\n")
    assert rows(rd.read_table(spark, str(tmp_path / "t.txt"), "n string, v int")) == [("a", 1), ("b", 2)]
    assert rows(rd.read_table(spark, str(tmp_path / "t.txt"), "n string, v int", skip=2, line=True)) == [(3, "b", 2)]
    (tmp_path / "f.fa").write_text(">x first\nAC\nGT\n>y\n>z\nTT\n")
    assert rows(rd.read_fasta(spark, str(tmp_path / "f.fa"))) == [("x", "ACGT"), ("y", ""), ("z", "TT")]
    (tmp_path / "c.chain").write_text("chain 9 t 10 + 0 9 q 10 - 1 10 4\n5\t1\t0\n3\n\n")
    assert [tuple(b) for b in rd.read_chain(spark, str(tmp_path / "c.chain")).first().blocks] == [(5, 1, 0), (3, 0, 0)]
    wr.write_by_key(spark.createDataFrame([("a", 1), ("b", 2)], "n string, k int"), "k", str(tmp_path / "k"))
    assert sorted(p.name for p in (tmp_path / "k").iterdir() if p.is_dir()) == ["k=1", "k=2"]


def test_proximity_without_diagonal_counts_as_zero(spark):
    prox = spark.createDataFrame([("a", 1, "a", 1, 10), ("a", 1, "b", 1, 4), ("b", 1, "b", 1, 30)], "contig1 string, pos1 long, contig2 string, pos2 long, weight long")
    got = {(r.contig1, r.contig2): round(r.weight, 4) for r in a.normalise_proximity(prox).collect()}
    assert got == {("a", "a"): 100.0, ("a", "b"): 13.3333, ("b", "b"): 100.0}
