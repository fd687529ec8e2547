"""Sequences in chunks against whole strings: read, assembled and written across borders of chunks and parts."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from markerloom.operators import windows as w
from markerloom.sources import readers, writers

TURN = str.maketrans("ACGTNacgtn", "TGCANtgcan")
AGP = "obj string, obj_beg long, obj_end long, part_no long, ctype string, contig string, contig_beg long, contig_end long, orientation string, gap_length long"


def made(seed, n=12):
    rng = random.Random(seed)
    contigs = {f"c{k}": "".join(rng.choice("ACGTacgtN") for _ in range(rng.choice([1, 59, 60, 61, 240, rng.randint(300, 1500)]))) for k in range(n)}
    parts, objects = [], {}
    for o in range(3):
        text = ""
        for p in range(1, rng.randint(3, 9)):
            if rng.random() < 0.3:
                gap = rng.choice([1, 100, 700])
                parts.append((f"o{o}", 0, 0, p, "U", None, None, None, None, gap))
                text += "N" * gap
                continue
            name = rng.choice(list(contigs)[:9])
            lo = rng.randint(1, len(contigs[name]))
            hi = rng.randint(lo, len(contigs[name]))
            sign = rng.choice("+-?")
            parts.append((f"o{o}", 0, 0, p, "W", name, lo, hi, sign, None))
            cut = contigs[name][lo - 1 : hi]
            text += cut[::-1].translate(TURN) if sign == "-" else cut
        objects[f"o{o}"] = text
    used = {p[5] for p in parts}
    return contigs, parts, objects | {c: s for c, s in contigs.items() if c not in used}


def whole(df, name):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r[name], r.chunk)):
        out[r[name]] = out.get(r[name], "") + r.seq
    return out


@pytest.mark.parametrize("seed,chunk", [(1, 60), (2, 240), (3, 1 << 20)])
def test_chunks_equal_whole_strings(spark, tmp_path, seed, chunk):
    contigs, parts, objects = made(seed)
    source = tmp_path / "in.fa"
    source.write_text("; no record yet\n" + "".join(f">{c} some words\n" + "\n".join(s[k : k + 70] for k in range(0, len(s), 70)) + "\n\n" for c, s in contigs.items()) + ">empty\n")
    chunks = readers.read_fasta_chunks(spark, str(source), chunk)
    assert whole(chunks, "contig") == contigs | {"empty": ""}
    assert chunks.filter(F.length("seq") > chunk).count() == 0
    built = w.build_fasta_chunks(chunks, spark.createDataFrame(parts, AGP), True, chunk)
    assert whole(built, "name") == objects | {"empty": ""}
    writers.write_fasta_chunks(built.repartition(5), str(tmp_path / "out"), contig="name")
    text = "".join(open(f).read() for f in sorted(glob.glob(f"{tmp_path}/out/part-*")))
    assert text == "".join(f">{o}\n" + "".join(s[k : k + 60] + "\n" for k in range(0, len(s), 60)) for o, s in sorted((objects | {"empty": ""}).items()))


def test_missing_sequence_raises(spark):
    chunks = spark.createDataFrame([("a", 0, "ACGT")], "contig string, chunk long, seq string")
    for part in (("o", 0, 0, 1, "W", "b", 1, 2, "+", None), ("o", 0, 0, 1, "W", "a", 3, 9, "+", None)):
        with pytest.raises(Exception, match="sequence not found"):
            w.build_fasta_chunks(chunks, spark.createDataFrame([part], AGP), chunk=60).collect()


def test_a_gap_longer_than_a_chunk(spark):
    built = w.build_fasta_chunks(spark.createDataFrame([("a", 0, "ACGT")], "contig string, chunk long, seq string"), spark.createDataFrame([("o", 0, 0, 1, "U", None, None, None, None, 1000), ("o", 0, 0, 2, "W", "a", 1, 4, "-", None)], AGP), chunk=60)
    assert whole(built, "name") == {"o": "N" * 1000 + "ACGT"} and built.count() == 17
