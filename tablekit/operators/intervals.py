"""Sets of time intervals per key: merge, subtract, intersect, align to a grain.

An interval is a row with ``start`` and ``end`` (timestamps without a zone, the end not included) and key columns.
A key may hold any share of the rows: sweeps run inside cells of a calendar grain, and what a cell needs of the
earlier ones comes from one summary row for each key and cell.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablekit.errors import InvalidSpec
from tablekit.plans.windows import AT, across, before, inside, running_sum, tag
from tablekit.session import materialize

# Grains, how a slot of one is written (texts sort like times), and its length as an interval.
GRAINS = {
    "hour": ("yyyy-MM-dd'T'HH", "INTERVAL 1 HOUR"),
    "day": ("yyyy-MM-dd", "INTERVAL 1 DAY"),
    "month": ("yyyy-MM", "INTERVAL 1 MONTH"),
}
#: Grain of the cells in which a sweep runs.
CELL = "month"


def instant(value: str | date | datetime) -> datetime:
    if isinstance(value, datetime):
        return value
    return datetime(value.year, value.month, value.day) if isinstance(value, date) else datetime.fromisoformat(value)


def _checked(grain: str) -> str:
    if grain not in GRAINS:
        raise InvalidSpec(f"grain {grain!r}; expected one of {sorted(GRAINS)}")
    return grain


def floor(column: Column, grain: str) -> Column:
    return F.date_trunc(_checked(grain), column).cast("timestamp_ntz")


def ceiling(column: Column, grain: str) -> Column:
    low = floor(column, grain)
    return F.when(low == column, low).otherwise(low + F.expr(GRAINS[grain][1]))


def slot(column: Column, grain: str) -> Column:
    """The text of the slot that a time lies in."""
    return F.date_format(column, GRAINS[_checked(grain)][0])


def valid(df: DataFrame) -> DataFrame:
    """Without intervals that are empty, end before they start, or lack an end."""
    return df.where(F.col("start") < F.col("end"))


def align(df: DataFrame, grain: str, inward: bool = False) -> DataFrame:
    """Intervals widened to whole slots, or with ``inward`` cut to the whole slots inside (none: no row)."""
    if inward:
        return valid(df.withColumns({"start": ceiling(F.col("start"), grain), "end": floor(F.col("end"), grain)}))
    return valid(df).withColumns({"start": floor(F.col("start"), grain), "end": ceiling(F.col("end"), grain)})


def merge(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The fewest intervals per key that cover the same time: overlapping and adjacent ones become one."""
    given = valid(df.select(*keys, "start", "end"))
    cell = [F.date_trunc(CELL, "start")]
    tagged = tag(given, keys, cell)
    # Islands inside a cell: a start beyond every earlier end begins one.
    earlier = inside("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.coalesce((F.col("start") > F.max("end").over(earlier)).cast("int"), F.lit(1))
    upto = inside("start", "end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = tagged.withColumn("__fresh", fresh).withColumn("__island", F.sum("__fresh").over(upto))
    islands = numbered.groupBy(AT, "__island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    islands = materialize(islands, "islands")  # written, because it is read twice
    # An island goes on from an earlier cell if any earlier end reaches its start.
    reach = islands.groupBy(AT).agg(F.max("end").alias("__reach"))
    reach = reach.select(AT, F.max("__reach").over(before(keys)).alias("__reach"))
    joined = islands.join(reach, AT).select(
        *[F.col(f"{AT}.k{i}").alias(k) for i, k in enumerate(keys)], "start", "end",
        F.coalesce((F.col("start") > F.col("__reach")).cast("int"), F.lit(1)).alias("__first"),
    )
    joined = materialize(joined, "islands")
    runs = running_sum(joined, keys, [F.col("start")], cell, F.col("__first"), "__run")
    return runs.groupBy(*keys, "__run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("__run")


def _swept(left: DataFrame, right: DataFrame, keys: Sequence[str], covered: bool) -> DataFrame:
    """Time of ``left`` that ``right`` covers, or does not, by a sweep over the ends of both."""

    def ends(df: DataFrame, name: str, other: str) -> DataFrame:
        edge = F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("by")), F.struct(F.col("end").alias("at"), F.lit(-1).alias("by")))
        return valid(df).select(*keys, F.inline(edge)).select(*keys, "at", F.col("by").alias(name), F.lit(0).alias(other))

    both = ends(left, "__l", "__r").unionByName(ends(right, "__r", "__l"))
    # Equal ends cancel before they travel.
    steps = both.groupBy(*keys, "at").agg(F.sum("__l").alias("__l"), F.sum("__r").alias("__r"))
    steps = materialize(tag(steps, keys, [F.date_trunc(CELL, "at")]), "steps")
    cells = steps.groupBy(AT).agg(
        F.sum("__l").alias("__ls"), F.sum("__r").alias("__rs"), F.min("at").alias("__from")
    )
    cells = cells.select(
        AT, F.coalesce(F.sum("__ls").over(before(keys)), F.lit(0)).alias("__l0"),
        F.coalesce(F.sum("__rs").over(before(keys)), F.lit(0)).alias("__r0"), F.lead("__from").over(across(keys)).alias("__then"),
    )
    upto = inside("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = steps.withColumns(
        {"__lu": F.sum("__l").over(upto), "__ru": F.sum("__r").over(upto), "__next": F.lead("at").over(inside("at"))}
    ).join(cells, AT)
    open_left, open_right = F.col("__l0") + F.col("__lu") > 0, F.col("__r0") + F.col("__ru") > 0
    # The next end closes a stretch, in whichever cell it lies.
    stretches = swept.where(open_left & (open_right if covered else ~open_right))
    return merge(stretches.select(*keys, F.col("at").alias("start"), F.coalesce("__next", "__then").alias("end")), keys)


def subtract(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Time that ``left`` covers and ``right`` does not, merged, per key."""
    return _swept(left, right, keys, covered=False)


def intersect(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Time that both cover, merged, per key."""
    return _swept(left, right, keys, covered=True)


def slots(df: DataFrame, grain: str) -> DataFrame:
    """A row for each slot that an interval touches: its key columns and ``slot`` (the slot's start)."""
    wide = align(df, grain)
    listed = F.sequence(F.col("start"), F.col("end") - F.expr(GRAINS[grain][1]), F.expr(GRAINS[grain][1]))
    return wide.select(*[c for c in df.columns if c not in ("start", "end")], F.explode(listed).alias("slot"))


def gaps(log: DataFrame, start: str | date | datetime, end: str | date | datetime, grain: str, models: Sequence[str] | None = None) -> DataFrame:
    """``model``, ``start``, ``end``: whole slots of ``[start, end)`` that a model's logged intervals do not cover.

    ``models`` names the models to look at, some of which may have no log row; without it all of the log.
    """
    known = log.select("model").distinct()
    if models is not None:
        known = log.sparkSession.createDataFrame([(m,) for m in models], "model string").distinct()
        log = log.join(known, "model", "left_semi")
    first, last = F.lit(instant(start)).cast("timestamp_ntz"), F.lit(instant(end)).cast("timestamp_ntz")
    asked = align(known.select("model", first.alias("start"), last.alias("end")), grain)
    # A slot counts as loaded only if it is covered as a whole.
    loaded = align(merge(log.select("model", "start", "end"), ["model"]), grain, inward=True)
    return subtract(asked, loaded, ["model"])
