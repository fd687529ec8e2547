"""Row order over groups of any size: neighbours and running sums without a window per group.

A window over one chromosome, or over a whole table, is one task. Here rows are dealt to ranges of
(group, order) first; windows look at one range's share of a group, and what crosses borders is
handed on as one small row for each range and group: its first and last row and its sums.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from markerloom.plans.staging import Staging, dealt, dealt_by_range

_PART = "_range"


class Ordered:
    """A table in order inside groups of ``by`` (none: the whole table is one group).

    ``order`` names columns. Rows equal in all of them come in any order, which stays the same for
    one object: the table is written once, and the ranges with it. ``size`` says about how many rows
    there are, if known; ranges, and the tasks that scan them, are then as many as these need.
    """

    def __init__(self, df: DataFrame, by: list[str], order: list[str], size: int = 0):
        self.by, self.order, self.size = by, order, size
        self.staging = Staging(df.sparkSession, "ordered")
        ranges = dealt_by_range(df, size, *by, *order).sortWithinPartitions(*by, *order)
        self.written = True  # what a scan reads twice is written, or follows from what is by plain columns
        self.rows = self.staging.put(ranges.withColumn(_PART, F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()), "dealt")

    @property
    def df(self) -> DataFrame:
        return self.rows.drop(_PART, "_row")

    def select(self, **columns: Column) -> Ordered:
        """Add plain columns; the order stays."""
        return self._with(self.rows.withColumns(columns))

    def through(self, step: Callable[[DataFrame], DataFrame]) -> Ordered:
        """Apply a step that neither drops nor repeats rows, such as a left join with one row a key."""
        return self._with(step(self.rows), written=False)

    def keep(self, condition: Column | str) -> Ordered:
        """Only rows that meet ``condition``, in the same order."""
        return self._with(self.rows.filter(condition))

    def only(self, *columns: str) -> Ordered:
        """No columns but these; the order stays."""
        return self._with(self.rows.select(*columns, _PART, "_row"))

    def kept(self) -> Ordered:
        """The table as it is now, written, so that what follows does not compute it again."""
        return self._with(self.staging.put(self.rows, "kept"), written=True)

    def grouped(self, *by: str) -> Ordered:
        """The same order with groups of ``by``, each of which must be a run of rows."""
        out = self._with(self.rows)
        out.by = list(by)
        return out

    def _with(self, rows: DataFrame, written: bool | None = None) -> Ordered:
        out = object.__new__(Ordered)
        out.by, out.order, out.size, out.staging, out.rows = self.by, self.order, self.size, self.staging, rows
        out.written = self.written if written is None else written
        return out

    def scan(self, before: dict[str, Column | str] | None = None, after: dict[str, Column | str] | None = None, sums: dict[str, Column] | None = None, last: dict[str, Column | str] | None = None) -> Ordered:
        """Add values of the row ``before`` and ``after`` each one in its group, and running ``sums`` with its own.

        ``last`` adds the latest value that is not null, the row's own included. Missing neighbours
        give null. Sums count null as 0.
        """
        before, after, sums, last = before or {}, after or {}, sums or {}, last or {}
        cells = {**{f"_b_{k}": v for k, v in before.items()}, **{f"_a_{k}": v for k, v in after.items()}, **{f"_s_{k}": F.coalesce(v, F.lit(0)) for k, v in sums.items()}, **{f"_l_{k}": v for k, v in last.items()}}
        rows = self.rows.withColumns({k: F.col(v) if isinstance(v, str) else v for k, v in cells.items()})
        rows = rows if self.written else self.staging.put(rows, "cells")
        keys = [_PART, *self.by]
        local = W.partitionBy(*keys).orderBy("_row")
        upto = local.rowsBetween(W.unboundedPreceding, W.currentRow)
        near = dealt(rows, self.size, *keys) if self.size else rows
        if before:
            near = near.withColumn("_before", F.lag(F.struct(*[f"_b_{k}" for k in before])).over(local))
        if after:
            near = near.withColumn("_after", F.lead(F.struct(*[f"_a_{k}" for k in after])).over(local))
        for k in sums:
            near = near.withColumn(f"_upto_{k}", F.sum(f"_s_{k}").over(upto))
        for k in last:
            near = near.withColumn(f"_known_{k}", F.last(f"_l_{k}", ignorenulls=True).over(upto))
        ends = []
        if before:
            ends.append(F.max_by(F.struct(*[f"_b_{k}" for k in before]), "_row").alias("_b"))
        if after:
            ends.append(F.min_by(F.struct(*[f"_a_{k}" for k in after]), "_row").alias("_a"))
        ends += [F.sum(f"_s_{k}").alias(f"_t_{k}") for k in sums] + [F.max_by(f"_l_{k}", F.when(F.col(f"_l_{k}").isNotNull(), F.col("_row"))).alias(f"_e_{k}") for k in last]
        # one row for each range and group; a group has no more of them than there are ranges
        carried = W.partitionBy(*self.by).orderBy(_PART)
        earlier = carried.rowsBetween(W.unboundedPreceding, -1)
        cross = rows.groupBy(*keys).agg(*ends)
        if before:
            cross = cross.withColumn("_cb", F.lag("_b").over(carried))
        if after:
            cross = cross.withColumn("_ca", F.lead("_a").over(carried))
        for k in sums:
            cross = cross.withColumn(f"_cs_{k}", F.coalesce(F.sum(f"_t_{k}").over(earlier), F.lit(0)))
        for k in last:
            cross = cross.withColumn(f"_cl_{k}", F.last(f"_e_{k}", ignorenulls=True).over(earlier))
        cross = cross.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in cross.columns if c.startswith("_c")])
        same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
        joined = near.join(cross, same, "left")
        new = {k: F.coalesce("_before", "_cb")[f"_b_{k}"] for k in before} | {k: F.coalesce("_after", "_ca")[f"_a_{k}"] for k in after}
        new |= {k: F.col(f"_upto_{k}") + F.col(f"_cs_{k}") for k in sums} | {k: F.coalesce(f"_known_{k}", f"_cl_{k}") for k in last}
        kept = [c for c in self.rows.columns if c not in new]
        return self._with(joined.select(*kept, *[v.alias(k) for k, v in new.items()]), written=False)
