"""Passes that settle pieces lying in several chromosomes; later ones look only at what the last one touched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from markerloom.operators.aggregates import assign_by_margin
from markerloom.operators.scans import Ordered
from markerloom.plans.staging import Staging, small_side

#: Share of changed rows up to which the next pass looks only at what they touch, and not at the whole table.
FEW = 0.01
_PIECE = ("contig", "orig_start", "orig_end")
_SIDES = {"prev": "before", "next": "after"}


def _near(row: str | Column) -> Column:
    """What a row knows of a neighbour: its row, its piece and how many rows that has."""
    return F.struct((F.col(row) if isinstance(row, str) else row).alias("_row"), "piece", "n")


def _side(df: DataFrame, rows: int) -> DataFrame:
    """A join's side of up to ``rows`` rows; as ``small_side``, but none are counted."""
    return F.broadcast(df) if rows <= 500_000 else df


def _homes(rows: DataFrame, score_diff: float, bridge: bool) -> DataFrame:
    """``(piece, home)`` of ambiguous pieces that their neighbours settle; ``rows`` has all rows of its pieces."""
    linked = {side: F.when(F.col(f"{near}.piece.contig") == F.col(f"{side}_contig"), F.col(f"{near}.n")) == 1 for side, near in _SIDES.items()}
    one, two = (F.when(linked[side], F.col(f"{side}_score") + F.col("map_score")) for side in _SIDES)
    both = F.when(linked["prev"] & linked["next"], F.col("prev_score") + F.col("next_score") + F.col("map_score"))
    score = F.greatest(one, two, both) if bridge else F.greatest(one, two)
    scores = rows.filter("n > 1").select("piece", "chr", score.alias("score")).filter("score IS NOT NULL")
    return assign_by_margin(scores, score_diff).select("piece", F.col("chr").alias("home")).filter("home IS NOT NULL")


def _events(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row for each ``_row`` that is dropped or loses a link: it lies, or its neighbour, outside a piece's home.

    A link into a row outside its home is lost on both of its sides.
    """
    asked = rows.filter("n > 1").select("piece", "chr", "_row", F.lit(None).cast("bigint").alias("other"), F.lit("own").alias("at"))
    for side, near in _SIDES.items():
        linked = rows.filter((F.col(f"{near}.piece.contig") == F.col(f"{side}_contig")) & (F.col(f"{near}.n") > 1))
        asked = asked.unionAll(linked.select(f"{near}.piece", "chr", "_row", F.col(f"{near}._row"), F.lit(side)))
    is_own, is_prev, is_next = (F.col("at") == at for at in ("own", "prev", "next"))
    # a row without chromosome is not in its home, but cuts no link
    out = asked.join(chosen, "piece").filter(F.when(is_own, ~F.col("home").eqNullSafe(F.col("chr"))).otherwise(F.col("home") != F.col("chr")))
    this = F.struct("_row", is_own.alias("drop"), is_prev.alias("no_prev"), is_next.alias("no_next"))
    that = F.struct(F.col("other").alias("_row"), F.lit(False).alias("drop"), is_next.alias("no_prev"), is_prev.alias("no_next"))
    ends = out.select(F.inline(F.array(this, that))).filter("_row IS NOT NULL")
    return ends.groupBy("_row").agg(*[F.max(c).alias(c) for c in ("drop", "no_prev", "no_next")])


def _applied(rows: DataFrame, events: DataFrame, how: str) -> DataFrame:
    """``rows`` with links nulled; ``_gone`` marks dropped rows and ``_changed`` all that differ from before."""
    new = {}
    for side in _SIDES:
        lost = F.coalesce(f"no_{side}", F.lit(False))
        new |= {f"{side}_{c}": F.when(lost, "null").otherwise(F.col(f"{side}_{c}")) for c in ("contig", "type")}
        new[f"{side}_score"] = F.when(lost, 0).otherwise(F.col(f"{side}_score")).cast("bigint")
    differs = gone = F.coalesce("drop", F.lit(False))
    for name, value in new.items():
        differs = differs | ~value.eqNullSafe(F.col(name))
    return rows.join(events, "_row", how).withColumns(new | {"_gone": gone, "_changed": differs}).drop("drop", "no_prev", "no_next")


class Settling:
    """A table ``la`` in ``line`` order, and passes over it.

    Each row holds its piece's number of rows and its neighbours, so a pass is a few joins. A pass can
    change a row only if the one before changed it or a neighbour, or a row count or home of their
    pieces. So a pass after one of few changes reads the rows these touch, all rows of their pieces and
    the neighbours of those; what it changes is kept as a ``patch`` of small size over the ``base``.
    """

    def __init__(self, la: DataFrame, score_diff: float, bridge: bool, few: float = FEW):
        self.columns, self.score_diff, self.bridge = la.columns, score_diff, bridge
        self.staging, size = Staging(la.sparkSession, "settling"), la.count()
        self.few = few * size
        self.order = Ordered(self._counted(la), [], ["line"], size)
        self.base: DataFrame | None = None
        self.patch: DataFrame | None = None
        self.changed: DataFrame | None = None
        self.changes = self.patched = 0  # rows changed last, and rows of the patch at most

    @property
    def df(self) -> DataFrame:
        return self._rows().select(*self.columns)

    def step(self) -> bool:
        """One pass; whether it changed anything."""
        if self.changed is None or self.changes > self.few:
            self._whole()
        else:
            self._touched()
        self.changes = self.changed.count()
        return self.changes > 0

    @staticmethod
    def _counted(rows: DataFrame) -> DataFrame:
        return rows.withColumn("n", F.count("*").over(W.partitionBy(*_PIECE)))

    def _rows(self) -> DataFrame:
        """The table as it is now."""
        if self.base is None:
            return self.order.df
        rows = self.base.filter("NOT _gone")
        if self.patch is None:
            return rows
        return rows.join(_side(self.patch.select("_row"), self.patched), "_row", "left_anti").unionByName(self.patch.filter("NOT _gone"))

    def _whole(self) -> None:
        """A pass over the whole table."""
        order, old = self.order, (self.base, self.patch)
        if self.base is not None:
            now = self._rows().select(*self.columns, "_range", "_row")
            order = order.through(lambda _: self._counted(now))
        near = _near("_row")
        beside = order.select(piece=F.struct(*_PIECE)).scan(before={"before": near}, after={"after": near})
        rows = self.staging.put(beside.rows, "beside")
        chosen = small_side(self.staging.put(_homes(rows, self.score_diff, self.bridge), "chosen"))
        events = small_side(self.staging.put(_events(rows, chosen), "events"))
        self.base, self.patch, self.patched = self.staging.put(_applied(rows, events, "left"), "base"), None, 0
        self.changed = self.base.filter("_changed")
        for table in (rows, *old):
            self.staging.drop(table)

    def _touched(self) -> None:
        """A pass over what the changed rows touch."""
        before = self._rows()
        if self.patch is not None:  # the base has the changes of a whole pass, the patch not yet those of a small one
            hit = _side(self.changed.select("_row"), self.changes)
            before = before.join(hit, "_row", "left_anti").unionByName(self.changed.filter("NOT _gone"))
        touched = self.staging.put(self._moved_up(before), "touched")
        count = touched.count()
        patch = touched.unionByName(self.changed.filter("_gone"))
        if self.patch is not None:
            patch = patch.unionByName(self.patch.join(_side(patch.select("_row"), count + self.changes), "_row", "left_anti"))
        old, self.patch = self.patch, self.staging.put(patch, "patch")
        self.patched += count + self.changes
        self.staging.drop(old)
        dirty = _side(touched.select("piece").distinct(), count)
        rows = self._rows()
        for k, piece in enumerate(("piece", "before.piece", "after.piece")):
            rows = rows.join(dirty.select(F.col("piece").alias(f"_p{k}")), F.col(piece) == F.col(f"_p{k}"), "left")
        rows = rows.filter("_p0 IS NOT NULL OR _p1 IS NOT NULL OR _p2 IS NOT NULL").withColumn("_own", F.col("_p0").isNotNull())
        rows = self.staging.put(rows.drop("_p0", "_p1", "_p2"), "region")
        chosen = _side(_homes(rows.filter("_own"), self.score_diff, self.bridge), count)
        rows = rows.drop("_own")
        self.changed = self.staging.put(_applied(rows, _events(rows, chosen), "inner").filter("_changed"), "changed")

    def _moved_up(self, rows: DataFrame) -> DataFrame:
        """Rows of ``rows`` that the changed rows touch, with neighbours and counts as they are without dropped rows."""
        gone = self.changed.filter("_gone")
        lost = _side(gone.groupBy("piece").agg(F.count("*").alias("k")), self.changes)
        flags = lambda before, after: (F.lit(before).alias("fix_before"), F.lit(after).alias("fix_after"))
        ends = gone.select("before.*", *flags(False, True)).unionAll(gone.select("after.*", *flags(True, False))).filter("_row IS NOT NULL")
        border = ends.join(gone.select("_row"), "_row", "left_anti").groupBy(F.col("_row").alias("at"), "piece", "n").agg(F.max("fix_before").alias("fix_before"), F.max("fix_after").alias("fix_after"))
        # dropped rows next to each other lie between two rows of the border
        near = _near("at")
        border = Ordered(border, [], ["at"]).scan(before={"new_before": near}, after={"new_after": near}).df.drop("piece", "n")
        marks = self.changed.filter("NOT _gone").select(F.col("_row").alias("_at")).join(border, F.col("_at") == F.col("at"), "full")
        marks = _side(marks.withColumn("at", F.coalesce("at", "_at")).drop("_at"), 3 * self.changes)
        rows = rows.join(marks, F.col("_row") == F.col("at"), "left")
        rows = rows.withColumns({near: F.when(F.col(f"fix_{near}"), F.col(f"new_{near}")).otherwise(F.col(near)) for near in _SIDES.values()})
        for k, piece in enumerate(("piece", "before.piece", "after.piece")):
            rows = rows.join(lost.select(F.col("piece").alias(f"_p{k}"), F.col("k").alias(f"_k{k}")), F.col(piece) == F.col(f"_p{k}"), "left")
        rows = rows.filter("at IS NOT NULL OR _k0 IS NOT NULL OR _k1 IS NOT NULL OR _k2 IS NOT NULL")
        fewer = lambda n, k: (F.col(n) - F.coalesce(k, F.lit(0))).alias("n")
        new = {near: F.when(F.col(near).isNotNull(), F.struct(f"{near}._row", f"{near}.piece", fewer(f"{near}.n", f"_k{k}"))) for k, near in enumerate(_SIDES.values(), 1)}
        names = [c for c in self.base.columns if c not in ("n", *new)]
        return rows.select(*names, fewer("n", "_k0"), *[v.alias(c) for c, v in new.items()])
