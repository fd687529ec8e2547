"""Writers of the text formats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, sep: str = "\t") -> None:
    """Delimited gzip text without header."""
    df.write.option("compression", "gzip").csv(path, sep=sep)


def write_by_key(df: DataFrame, key: str, path: str) -> None:
    """One folder of delimited text per value of ``key``."""
    df.write.option("compression", "gzip").partitionBy(key).csv(path, sep="\t")


def write_fasta(df: DataFrame, path: str, contig: str = "contig", seq: str = "seq") -> None:
    """Records of a header line and a sequence line."""
    df.select(F.concat(F.lit(">"), F.col(contig), F.lit("\n"), F.coalesce(F.col(seq), F.lit("")))).write.text(path)


def write_fasta_chunks(chunks: DataFrame, path: str, width: int = 60, contig: str = "contig", seq: str = "seq") -> None:
    """Records of wrapped lines from rows of (name, ``chunk``, sequence), whatever a record's length.

    Rows are range partitioned by name and chunk, so the files in their order are one FASTA file.
    Chunks hold a multiple of ``width`` letters but for a record's last, so lines go on across rows.
    """
    lines = F.regexp_replace(F.coalesce(F.col(seq), F.lit("")), f"(.{{{width}}})(?=.)", "$1\n")
    head = F.concat(F.lit(">"), F.col(contig))
    value = F.when(F.col("chunk") > 0, lines).when(lines == "", head).otherwise(F.concat(head, F.lit("\n"), lines))
    dealt = chunks.repartitionByRange(contig, "chunk").sortWithinPartitions(contig, "chunk")
    dealt.select(value.alias("value")).write.text(path)
