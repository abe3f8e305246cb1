"""Join shapes Spark has no keyword for, or plans badly when the inputs are large."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, TimestampNTZType, TimestampType
from pyspark.sql.window import Window

from tablekit.errors import InvalidSpec
from tablekit.plans.windows import AT, before, inside, tag


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    on: str,
    values: Sequence[str],
    bucket: Column,
    tie: str | None = None,
) -> DataFrame:
    """For each left row the latest right row of the same key with ``right.on <= left.on``.

    ``keys`` and ``on`` have the same names on both sides; ``values`` come from the right side and
    are NULL where nothing precedes, and where a key is NULL. ``tie`` orders right rows with equal ``on``. Both sides are
    unioned and the last right row is carried forward inside ``(key, bucket)``; what earlier
    buckets carry comes from one summary row per bucket, so a hot key spreads over its buckets.
    """
    extra = [c for c in left.columns if c not in keys and c != on]
    payload = F.struct(*[F.col(v).alias(v) for v in values])
    order_tie = F.col(tie) if tie else F.lit(None).cast("bigint")
    lefts = left.select(*keys, on, F.struct(*extra).alias("__left"), F.lit(1).alias("__side"))
    rights = right.select(
        *keys, on, payload.alias("__right"), order_tie.alias("__tie"), F.lit(0).alias("__side")
    ).where(F.col(on).isNotNull())
    rights = rights.dropna(subset=list(keys))
    both = tag(lefts.unionByName(rights, allowMissingColumns=True), keys, [bucket])

    # max_by skips rows whose ordering is NULL, so left rows only keep their bucket in the summary.
    at = F.when(F.col("__side") == 0, F.struct(on, "__tie"))
    summary = both.groupBy(AT).agg(F.max_by("__right", at).alias("__last"))
    carried = summary.select(AT, F.last("__last", ignorenulls=True).over(before(keys)).alias("__carried"))

    upto = inside(on, "__side", "__tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = both.withColumn("__local", F.last("__right", ignorenulls=True).over(upto)).where("__side = 1")
    joined = local.join(carried, AT)
    hit = F.coalesce("__local", "__carried")
    return joined.select(
        *keys, on, *[F.col("__left")[c].alias(c) for c in extra], *[hit[v].alias(v) for v in values]
    )


#: Points of a cell that are joined in one piece. Nearly all of them match the cell's intervals, so pieces cost one copy of an
#: interval for so many pairs.
SPLIT_ROWS = 20_000
#: Cells of a level that make one of the next, as a power of two. More means fewer levels, on which points are
#: listed, and more cells for an interval.
FAN_BITS = 2
FAN = 1 << FAN_BITS
#: Levels of cells at most: FAN ** MOST_LEVELS cells on the lowest.
MOST_LEVELS = 20


def _number(column: Column, kind: DataType) -> Column:
    """A double that never decreases along the column's order; NULL for NaN."""
    if isinstance(kind, NumericType):
        return F.nanvl(column.cast("double"), F.lit(None).cast("double"))
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, TimestampType):
        return F.unix_micros(column).cast("double")
    if isinstance(kind, TimestampNTZType):
        epoch = F.lit("1970-01-01").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", epoch, column).cast("double")
    raise InvalidSpec(f"a range over {kind.simpleString()}")


def cover(first: Column, last: Column, levels: int) -> Column:
    """The fewest cells that make up the cells ``first`` to ``last`` of the lowest level.

    Structs of ``level`` and ``node``, where a node of a level holds FAN nodes of the level below; at most 2 FAN - 2 on
    each level: those before the first whole parent and after the last.
    """

    def run(level: Column, low: Column, end: Column) -> Column:
        nodes = F.when(low < end, F.sequence(low, end - 1)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(nodes, lambda n: F.struct(level.alias("level"), n.alias("node")))

    def ends(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("bigint"), level * FAN_BITS)
        low = F.call_function("shiftright", first + size - 1, level * FAN_BITS)
        high = F.call_function("shiftright", last + 1, level * FAN_BITS)
        whole = F.call_function("shiftleft", F.shiftright(low + FAN - 1, FAN_BITS), F.lit(FAN_BITS))
        after = F.call_function("shiftleft", F.shiftright(high, FAN_BITS), F.lit(FAN_BITS))
        return F.concat(run(level, low, F.least(whole, high)), run(level, F.greatest(after, whole), high))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), ends))


def range_join(
    points: DataFrame,
    intervals: DataFrame,
    point: str,
    low: str,
    high: str,
    keys: Sequence[str] = (),
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Pairs with ``low <= point <= high`` (and equal ``keys``), planned as an equi-join, for intervals of any length.

    The range of the points is cut into as many cells as there are points, rounded up to a power of FAN, and every
    FAN of them make a larger one, level by level. An interval is listed under the few cells that make it up, a point
    under its cell on each level that any interval uses; so no pair meets twice, and long intervals cost no more than
    short ones. A cell with more than ``split_rows`` points of a key is dealt to several
    pieces by a hash of the point's row; its intervals go to each. (Rows equal in all columns stay together: count
    them first.) Points and ends may be numbers, dates or timestamps; NULL and NaN match nothing.
    """
    kinds = {c: df.schema[c].dataType for df, c in ((points, point), (intervals, low), (intervals, high))}
    x = _number(F.col(point), kinds[point])
    finite = F.when(F.abs(x) < float("inf"), x)
    facts = points.agg(F.count(x).alias("n"), F.min(x).alias("least"), F.max(x).alias("most"), F.min(finite).alias("low"), F.max(finite).alias("high")).first()
    levels = min(-(-max(facts.n, 1).bit_length() // FAN_BITS), MOST_LEVELS)
    cells = 1 << levels * FAN_BITS
    bottom, top = facts.low or 0.0, facts.high or 0.0

    def cell(value: Column) -> Column:
        inside = F.least(F.greatest(value, F.lit(bottom)), F.lit(top))
        share = (inside - F.lit(bottom)) / F.lit(top - bottom) if top > bottom else F.lit(0.0)
        return F.least(F.floor(share * F.lit(float(cells))), F.lit(cells - 1)).cast("bigint")

    ends = [_number(F.col(c), kinds[c]) for c in (low, high)]
    # An end that is NaN or NULL matches nothing; an interval beyond all points is left out.
    meets = (F.col(low) <= F.col(high)) & (ends[0] <= F.lit(facts.most)) & (ends[1] >= F.lit(facts.least))
    listed = intervals.where(meets).withColumn("__at", F.explode(cover(cell(ends[0]), cell(ends[1]), levels)))
    used = sorted(r[0] for r in listed.select("__at.level").distinct().collect())  # at most MOST_LEVELS numbers
    placed = points.where(x.isNotNull()).withColumn("__cell", cell(x))
    at = [F.struct(F.lit(k).alias("level"), F.shiftright(F.col("__cell"), k * FAN_BITS).alias("node")) for k in used]
    nowhere = F.array().cast("array<struct<level:int,node:bigint>>")

    def spread(df: DataFrame) -> DataFrame:
        return df.withColumn("__at", F.explode(F.array(*at) if at else nowhere)).drop("__cell")

    # Cells with many points: counted on the lowest level first, so a frequent value is one row.
    counts = spread(placed.groupBy(*keys, "__cell").agg(F.count(F.lit(1)).alias("__n")))
    heavy = counts.groupBy(*keys, "__at").agg(F.sum("__n").alias("__n")).where(F.col("__n") > split_rows)
    heavy = heavy.select(*keys, "__at", F.ceil(F.col("__n") / split_rows).cast("int").alias("__pieces"))
    pieces = F.coalesce("__pieces", F.lit(1))
    row = F.xxhash64(*[F.col(f"`{c}`") for c in points.columns])
    left = spread(placed).join(heavy, [*keys, "__at"], "left").withColumn("__piece", F.pmod(row, pieces).cast("int"))
    right = listed.join(heavy, [*keys, "__at"], "left").withColumn("__piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    joined = left.drop("__pieces").join(right.drop("__pieces"), [*keys, "__at", "__piece"])
    return joined.where(F.col(point).between(F.col(low), F.col(high))).drop("__at", "__piece")


def not_in(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """SQL ``left_key NOT IN (SELECT right_key ...)`` with its NULL rules.

    Spark plans the SQL form by broadcasting the right side whatever its size. Here two one-row
    facts about the right side decide the NULL cases and the rest is an ordinary anti join.
    """
    rows, nulls = F.count(F.lit(1)).alias("rows"), F.count_if(F.col(right_key).isNull()).alias("nulls")
    facts = right.agg(rows, nulls).select(F.struct("rows", "nulls")).scalar()
    keys = right.where(F.col(right_key).isNotNull()).select(F.col(right_key).alias("__k"))
    unmatched = left.join(keys, F.col(left_key) == F.col("__k"), "left_anti")
    unmatched = unmatched.withColumn("__facts", facts)
    rows, nulls = F.col("__facts.rows"), F.col("__facts.nulls")
    return unmatched.where((rows == 0) | ((nulls == 0) & F.col(left_key).isNotNull())).drop("__facts")
