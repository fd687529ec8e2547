"""Row numbers of a total order without sorting a whole table in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markerloom.plans.staging import Staging, dealt_by_range


def with_row_number(df: DataFrame, order: list[str], name: str = "line", kept: list[str] | None = None, rows: int = 0) -> DataFrame:
    """Add ``name``: each row's place, from 1, in the order of the SQL expressions ``order``.

    Only the columns ``kept`` (none named: all) are written and returned. ``rows`` says about how many
    rows there are, if known.

    Rows are range partitioned and sorted inside their partition, where Spark's increasing ids count
    them; the written table fixes that. Partitions are as many as ``rows`` need, so that none is sorted
    out of memory; their sizes, one number each, give each one its offset. Rows equal in all of ``order`` come in any order.
    """
    keys = [F.expr(o) for o in order]
    kept = kept or df.columns
    ranges = dealt_by_range(df, rows, *keys).sortWithinPartitions(*keys)
    staged = Staging(df.sparkSession, "numbered").put(ranges.select(*kept, F.monotonically_increasing_id().alias("_place")), "dealt")
    # the id holds the partition above its lower 33 bits and the row's number in it below
    part = F.shiftright("_place", 33).cast("int")
    sizes = {r["part"]: r["n"] for r in staged.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before, offsets = 0, []
    for p in sorted(sizes):
        offsets.append((p, before + 1 - (p << 33)))
        before += sizes[p]
    known = F.broadcast(df.sparkSession.createDataFrame(offsets, "_part int, _offset bigint"))
    numbered = staged.withColumn("_part", part).join(known, "_part").withColumn(name, F.col("_place") + F.col("_offset"))
    return numbered.select(name, *[c for c in kept if c != name])
