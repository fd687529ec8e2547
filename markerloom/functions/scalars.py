"""Column expressions: numbers in text, bins, orientation, sequences, CIGAR strings, map distances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The IUPAC letters and their complements.
BASES = "ACGTYRSWKMBVDHNacgtyrswkmbvdhn"
COMPLEMENTS = "TGCARYSWMKVBHDNtgcaryswmkvbhdn"


def leading_int(col: Column) -> Column:
    """The whole number a text begins with, else 0 (``12-30`` is 12, ``500*`` is 500, ``x`` is 0)."""
    return F.coalesce(F.regexp_extract(col, r"^\s*([-+]?\d+)", 1).try_cast("bigint"), F.lit(0).cast("bigint"))


def after_dash(col: Column) -> Column:
    """The number after the first dash, or the leading one where there is no dash."""
    return leading_int(F.when(col.contains("-"), F.substring_index(col, "-", -1)).otherwise(col))


def half_sum(a: Column, b: Column) -> Column:
    return F.floor((a + b) / 2).cast("bigint")


def lg_cutoff(df: DataFrame, max_lg: int, col: str = "lg") -> DataFrame:
    """Linkage groups numbered above ``max_lg`` become 0; null stays null."""
    return df.withColumn(col, F.when(F.col(col) > max_lg, F.lit(0)).otherwise(F.col(col)).cast("bigint"))


def bed_key(bed: DataFrame) -> DataFrame:
    """Add ``sm`` and ``em``, the middle of each piece's start and end bounds."""
    lo, hi, elo, ehi = leading_int(F.col("start_s")), after_dash(F.col("start_s")), leading_int(F.col("end_s")), after_dash(F.col("end_s"))
    sm = F.when(lo == 1, F.lit(1).cast("bigint")).otherwise(half_sum(lo, hi))
    em = F.when(F.col("end_s").contains("*"), ehi).otherwise(half_sum(elo, ehi))
    return bed.withColumn("sm", sm).withColumn("em", em)


def piece_key(df: DataFrame, start: str = "start_alt", end: str = "end_alt") -> DataFrame:
    """Add ``orig_start``, ``alt_start``, ``orig_end``, ``alt_end`` from ``orig/alt`` texts."""
    for name, col in (("start", start), ("end", end)):
        df = df.withColumn(f"orig_{name}", leading_int(F.substring_index(col, "/", 1))).withColumn(f"alt_{name}", leading_int(F.substring_index(col, "/", -1)))
    return df


def reverse_complement(col: Column, permissive: bool = False) -> Column:
    """Reversed complement with case kept; letters outside the IUPAC code raise, or give null."""
    turned = F.translate(F.reverse(col), BASES, COMPLEMENTS)
    bad = col.rlike(f"[^{BASES}]")
    return F.when(bad, F.lit(None).cast("string") if permissive else F.raise_error(F.concat(F.lit("no IUPAC sequence: "), F.substring(col, 1, 40))).cast("string")).otherwise(turned)


def to_bin(col: Column, size: int) -> Column:
    """First position of the bin of ``size`` that holds a 1-based position."""
    return (F.lit(1) + size * F.floor((col - 1) / size)).cast("bigint")


def sort_by_score(paf: DataFrame) -> DataFrame:
    """Rows with an alignment score, best first; ``line`` settles ties where there is one."""
    ties = ["line"] if "line" in paf.columns else [c for c in paf.columns if c != "as_score"]
    return paf.filter(F.col("as_score").isNotNull()).orderBy(F.desc("as_score"), *ties)


def filter_mapq(df: DataFrame, q: int = 1) -> DataFrame:
    return df.filter(F.col("mapq") >= q)


def has_flag(col: Column, mask: int) -> Column:
    return col.bitwiseAND(F.lit(mask)) != 0


def extract_umi(sam: DataFrame, shortest: int = 16, longest: int = 24, size: int = 16) -> DataFrame:
    """First reads whose barcode is soft-clipped at the read's start: contig, position, barcode.

    On the reverse strand the clip ends the CIGAR and the barcode is the reverse complement of the
    last ``size`` bases.
    """
    clips = [f"{n}S" for n in range(shortest, longest + 1)]
    back = has_flag(F.col("flag"), 16)
    clip = F.when(back, F.substring("cigar", -3, 3)).otherwise(F.substring("cigar", 1, 3))
    umi = F.when(back, reverse_complement(F.expr(f"right(seq, {size})"), permissive=True)).otherwise(F.substring("seq", 1, size))
    return sam.filter(has_flag(F.col("flag"), 64) & clip.isin(clips)).select("contig", "pos", umi.alias("umi"))


def drop_trivial_self(axt: DataFrame, radius: int = 5000) -> DataFrame:
    """Drop alignments of a sequence to itself that start or end within ``radius`` of each other."""
    near = (F.abs(F.col("tstart") - F.col("qstart")) <= radius) | (F.abs(F.col("tend") - F.col("qend")) <= radius)
    return axt.filter(~((F.col("tname") == F.col("qname")) & near))


def split_self(axt: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Alignments of a sequence to itself, and all others."""
    return axt.filter("tname = qname"), axt.filter("tname <> qname")


def filter_identity(df: DataFrame, lo: float, hi: float | None = None) -> DataFrame:
    kept = df.filter(F.col("identity") >= lo)
    return kept if hi is None else kept.filter(F.col("identity") <= hi)


def sex_average(df: DataFrame, a: str = "male_cm", b: str = "female_cm") -> DataFrame:
    """Add ``cm``, the mean of two map positions, or the one that is there."""
    both = (F.col(a) + F.col(b)) * 0.5
    return df.withColumn("cm", F.coalesce(both, F.col(a), F.col(b)))


def unpivot_sex(df: DataFrame, ids: list[str]) -> DataFrame:
    """One row per marker and sex: ``sex`` and ``cm``."""
    wide = df.select(*ids, F.col("male_cm").alias("male"), F.col("female_cm").alias("female"))
    return wide.unpivot(ids, ["male", "female"], "sex", "cm")


def paf_to_chain(paf: DataFrame, factor: int = 33) -> DataFrame:
    """Chain headers of alignments; hits of a sequence to itself are dropped.

    On the minus strand the target's coordinates count from its other end.
    """
    minus = F.col("strand") == "-"
    return paf.filter("qname <> tname").select(
        (F.col("as_score") * factor).alias("score"), F.col("qname").alias("tname"), F.col("qlen").alias("tsize"), F.lit("+").alias("tstrand"), F.col("qstart").alias("tstart"), F.col("qend").alias("tend"),
        F.col("tname").alias("qname"), F.col("tlen").alias("qsize"), F.col("strand").alias("qstrand"),
        F.when(minus, F.col("tlen") - F.col("tend")).otherwise(F.col("tstart")).alias("qstart"), F.when(minus, F.col("tlen") - F.col("tstart")).otherwise(F.col("tend")).alias("qend"),
    )


def cigar_blocks(cigar: Column) -> Column:
    """``array<struct<size,dt,dq>>``: aligned blocks and the gaps that follow them.

    An insertion leaves a gap on the first side (``dt``), a deletion on the second (``dq``); gaps
    before the first match have a block of size 0, adjoining matches are one block. Operations
    other than M, I and D raise.
    """
    kind = "struct<size:bigint,dt:bigint,dq:bigint>"
    # a run of matches with the gaps behind it, or gaps before the first match
    block = r"((?:\d+M)+)((?:\d+[ID])*)|^((?:\d+[ID])+)"
    runs = F.regexp_extract_all(cigar, F.lit(block), F.lit(0))
    total = lambda x, op: F.aggregate(F.regexp_extract_all(x, F.lit(rf"(\d+){op}"), F.lit(1)), F.lit(0).cast("bigint"), lambda acc, n: acc + n.cast("bigint"))
    blocks = F.transform(runs, lambda x: F.struct(total(x, "M").alias("size"), total(x, "I").alias("dt"), total(x, "D").alias("dq")))
    known = (cigar != "") & (F.regexp_replace(cigar, r"\d+[MID]", "") == "")
    return F.when(known, blocks).when(cigar.isNotNull(), F.raise_error(F.concat(F.lit("unknown CIGAR: "), F.substring(cigar, 1, 40))).cast(f"array<{kind}>"))


def map_distance(fraction: Column, method: str = "kosambi") -> Column:
    """Centimorgans of a recombination fraction by Kosambi, Haldane or Morgan.

    Unlinked markers (a fraction of 0.5 and more) have no finite distance by the first two: null.
    """
    linked = F.when(fraction < 0.5, fraction)
    if method == "kosambi":
        return F.lit(25.0) * F.ln((1 + 2 * linked) / (1 - 2 * linked))
    if method == "haldane":
        return F.lit(-50.0) * F.ln(1 - 2 * linked)
    if method == "morgan":
        return F.lit(100.0) * fraction
    raise ValueError(method)


# In version order a tilde comes before the end of a name, letters after it, then all other signs.
_SIGNS = "".join(c for c in map(chr, range(1, 127)) if not c.isalnum() and c != "~")


def version_key(col: Column) -> Column:
    """Array of (text, digits' number, digits) of a name, which compares as ``sort -V`` compares names.

    Numbers of any length compare by value: leading zeros go, then the longer one is greater. An end
    mark closes every text and the name.
    """
    ranked = lambda text: F.concat(F.translate(text, "~" + _SIGNS, "\x01" + "".join(chr(256 + ord(c)) for c in _SIGNS)), F.lit("\x02"))
    digits = lambda run: F.regexp_replace(F.regexp_extract(run, r"([0-9]*)$", 1), "^0+", "")
    part = lambda run: F.struct(ranked(F.regexp_extract(run, r"^([^0-9]*)", 1)).alias("text"), F.length(digits(run)).alias("size"), digits(run).alias("digits"))
    runs = F.filter(F.regexp_extract_all(col, F.lit(r"[^0-9]*[0-9]*"), F.lit(0)), lambda run: run != "")
    return F.concat(F.transform(runs, part), F.array(part(F.lit(""))))


def natural_key(col: Column) -> list[Column]:
    """Sort keys of version order: ``c1.2`` before ``c1.10``, whatever the number of parts.

    Names without their file suffixes come first in order, then whole names, then plain text; empty
    names and those that begin with a dot lead. Letters beyond ASCII come by code point.
    """
    dots = F.when(col == "", 0).when(col == ".", 1).when(col == "..", 2).when(col.startswith("."), 3).otherwise(4)
    stem = F.when(col.startswith("."), F.concat(F.lit("."), F.regexp_replace(F.substring(col, 2, 1 << 30), r"(\.[A-Za-z~][A-Za-z0-9~]*)*$", ""))).otherwise(F.regexp_replace(col, r"(\.[A-Za-z~][A-Za-z0-9~]*)*$", ""))
    return [dots, version_key(stem), version_key(col), col]


def natural_sort(df: DataFrame, col: str) -> DataFrame:
    """Rows in version order of ``col`` (as ``sort -V``), null first."""
    return df.orderBy(*natural_key(F.col(col)))


def validate_fasta(df: DataFrame) -> DataFrame:
    """``(contig, problem)``: sequences with letters other than ACGTN, missing and repeated names."""
    letters = df.filter(~F.coalesce(F.col("seq"), F.lit("")).rlike("^[ACGTNacgtn]*$")).select("contig", F.lit("letters").alias("problem"))
    nameless = df.filter(F.coalesce(F.col("contig"), F.lit("")) == "").select("contig", F.lit("no name").alias("problem"))
    repeated = df.groupBy("contig").count().filter("count > 1").select("contig", F.lit("repeated name").alias("problem"))
    return letters.unionAll(nameless).unionAll(repeated)
