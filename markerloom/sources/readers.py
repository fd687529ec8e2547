"""Readers of the text formats: tables, sequences, alignments. Gzip is read transparently."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from markerloom.operators.scans import Ordered

#: Letters of a sequence in one row: a multiple of the usual widths of a line.
CHUNK = 60 * 16384

def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text with ``file`` and ``line``, the number of a line in its file from 1.

    Partitions keep file order, so a line's number is its place in its partition plus what earlier
    partitions of the file hold; only those counts, one per partition, meet in one task.
    """
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("m"))
    part = F.shiftright("m", 33)
    keyed = raw.withColumn("part", part)
    counts = keyed.groupBy("file", "block", "part").agg(F.count("*").alias("n"), F.min("m").alias("least"))
    order = W.partitionBy("file").orderBy("block", "part").rowsBetween(W.unboundedPreceding, -1)
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0))).select("file", "block", "part", "least", "before")
    return keyed.join(before, ["file", "block", "part"]).select("value", "file", (F.col("before") + F.col("m") - F.col("least") + 1).alias("line"))


def read_table(spark: SparkSession, path: str, schema: str, sep: str = "\t", comment: str = "#", skip: int = 0, line: bool = False) -> DataFrame:
    """Delimited text by position; comment lines and the first ``skip`` lines of each file left out.

    ``line`` adds the line number (after comments are counted) for operators that need file order.
    """
    if not skip and not line:
        return spark.read.csv(path, schema=schema, sep=sep, comment=comment, ignoreLeadingWhiteSpace=True)
    lines = _numbered(spark, path).filter((F.col("line") > skip) & ~F.col("value").startswith(comment))
    fields = F.from_csv("value", schema, {"sep": sep})
    out = lines.select("line", fields.alias("f")).select(*(["line"] if line else []), "f.*")
    return out


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """``(contig, seq)``: one row per record, named by the first word of its header.

    A record begins with ``>`` at the start of a line; further such signs in a header are text.
    """
    records = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("value")).filter(F.trim("value") != "")
    head = F.substring_index("value", "\n", 1)
    body = F.when(F.col("value").contains("\n"), F.expr("substring(value, length(substring_index(value, '\n', 1)) + 2)")).otherwise(F.lit(""))
    return records.select(F.regexp_extract(head, r"^\s*(\S*)", 1).alias("contig"), F.regexp_replace(body, r"\s", "").alias("seq"))


def read_fasta_chunks(spark: SparkSession, path: str, chunk: int = CHUNK) -> DataFrame:
    """``(contig, chunk, seq)``: records of any length, ``chunk`` letters a row (fewer in a record's last).

    Lines are placed by running sums over ranges of a file, so no record is held as one string. A
    record without letters is one empty chunk; lines before the first header are left out.
    """
    lines = _numbered(spark, path)
    head = F.col("value").startswith(">")
    lines = lines.select("file", "line", head.alias("head"), F.when(head, F.regexp_extract("value", r"^>\s*(\S*)", 1)).alias("name"), F.when(head, F.lit("")).otherwise(F.regexp_replace("value", r"\s", "")).alias("seq"))
    placed = Ordered(lines, ["file"], ["line"]).scan(sums={"record": F.col("head").cast("bigint")}, last={"contig": "name"})
    placed = placed.keep("record > 0 AND (head OR seq <> '')").grouped("file", "record").scan(sums={"upto": F.length("seq").cast("bigint")})
    rows = placed.df.withColumn("at", F.col("upto") - F.length("seq"))
    return chunked(rows, ["file", "record", "contig"], chunk).select("contig", "chunk", "seq")


def chunked(pieces: DataFrame, by: list[str], chunk: int, at: str = "at", seq: str = "seq") -> DataFrame:
    """Pieces of sequences of ``by``, which begin ``at`` letters from 0, as rows of whole chunks: adds ``chunk``."""
    start, size = F.col(at), F.length(seq)
    numbers = F.sequence(F.expr(f"`{at}` div {chunk}"), F.expr(f"greatest(`{at}`, `{at}` + length(`{seq}`) - 1) div {chunk}"))
    spread = pieces.select(*by, start.alias("_at"), F.col(seq).alias("_seq"), size.alias("_size"), F.explode(numbers).alias("chunk"))
    lo = F.greatest(F.col("_at"), F.col("chunk") * chunk)
    hi = F.least(F.col("_at") + F.col("_size"), (F.col("chunk") + 1) * chunk)
    cut = F.substring("_seq", (lo - F.col("_at") + 1).cast("int"), (hi - lo).cast("int"))
    parts = spread.select(*by, "chunk", F.struct(lo.alias("at"), cut.alias("seq")).alias("part")).groupBy(*by, "chunk").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return parts.select(*by, "chunk", F.array_join(F.col("parts.seq"), "").alias("seq"))


def extract_markers(genotypes: DataFrame, header: int = 6) -> DataFrame:
    """Number, contig and position of the marker rows after the pedigree header; needs ``line``."""
    rows = genotypes.filter(F.col("line") > header)
    return rows.select((F.col("line") - header).alias("marker_id"), "contig", "pos")


def with_file_number(df: DataFrame, pattern: str = r"(\d+)[^/]*$", name: str = "number") -> DataFrame:
    """Add the number that each row's file name holds."""
    return df.withColumn(name, F.regexp_extract(F.input_file_name(), pattern, 1).try_cast("int"))


_PAF = ["qname", "qlen", "qstart", "qend", "strand", "tname", "tlen", "tstart", "tend", "matches", "block", "mapq"]


def read_paf(spark: SparkSession, path: str) -> DataFrame:
    """Twelve fixed columns, ``as_score`` (AS:i:) and ``cigar`` (cg:Z:) where given."""
    f = F.split("value", "\t")
    tag = lambda t: F.get(F.filter(f, lambda x: x.startswith(t)), F.lit(0))
    columns = [F.get(f, F.lit(i)) if c in ("qname", "strand", "tname") else F.get(f, F.lit(i)).try_cast("bigint") for i, c in enumerate(_PAF)]
    rows = spark.read.text(path).filter("value <> ''")
    return rows.select(*[c.alias(n) for c, n in zip(columns, _PAF, strict=True)], F.substring(tag("AS:i:"), 6, 20).try_cast("bigint").alias("as_score"), F.regexp_replace(tag("cg:Z:"), "^cg:Z:", "").alias("cigar"))


_CHAIN = ["score", "tname", "tsize", "tstrand", "tstart", "tend", "qname", "qsize", "qstrand", "qstart", "qend", "id"]


def read_chain(spark: SparkSession, path: str) -> DataFrame:
    """Chain headers with their block lines as ``blocks array<struct<size,dt,dq>>``.

    A record begins with ``chain`` at the start of a line, so records are read whole and apart.
    Comment lines are left out, and so is text without a header of twelve fields.
    """
    parts = spark.read.option("lineSep", "\nchain ").text(path).select(F.regexp_replace("value", r"^(?:#[^\n]*\n|\s*\n)*chain ", "").alias("value"))
    records = parts.filter(F.col("value").rlike(r"^\s*[-+0-9.]+\s"))
    lines = F.filter(F.split("value", "\r?\n"), lambda x: (F.trim(x) != "") & ~x.startswith("#"))
    head = F.split(F.trim(F.get(lines, F.lit(0))), r"\s+")
    columns = [F.get(head, F.lit(i)) if c in ("tname", "tstrand", "qname", "qstrand") else F.get(head, F.lit(i)).try_cast("bigint") for i, c in enumerate(_CHAIN)]
    number = lambda x, i: F.coalesce(F.get(F.split(F.trim(x), r"\s+"), F.lit(i)).try_cast("bigint"), F.lit(0).cast("bigint"))
    blocks = F.transform(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), lambda x: F.struct(number(x, 0).alias("size"), number(x, 1).alias("dt"), number(x, 2).alias("dq")))
    return records.select(*[c.alias(n) for c, n in zip(columns, _CHAIN, strict=True)], blocks.alias("blocks"))


def read_axt(spark: SparkSession, path: str) -> DataFrame:
    """Three-line records: header fields and both sequences; records are parted by empty lines.

    A file whose lines end in CR LF is one piece to the reader, which this cuts into records.
    """
    read = spark.read.option("lineSep", "\n\n").text(path)
    records = read.select(F.explode(F.split("value", r"\r?\n[ \t]*\r?\n")).alias("value")).filter(F.trim("value") != "")
    lines = F.filter(F.split("value", "\r?\n"), lambda x: (F.trim(x) != "") & ~x.startswith("#"))
    head = F.split(F.get(lines, F.lit(0)), " ")
    at = lambda i: F.get(head, F.lit(i))
    number = lambda i: at(i).try_cast("bigint")
    rows = records.filter(F.size(lines) >= 3)
    return rows.select(number(0).alias("id"), at(1).alias("tname"), number(2).alias("tstart"), number(3).alias("tend"), at(4).alias("qname"), number(5).alias("qstart"), number(6).alias("qend"), at(7).alias("strand"), number(8).alias("score"), F.get(lines, F.lit(1)).alias("tseq"), F.get(lines, F.lit(2)).alias("qseq"))
