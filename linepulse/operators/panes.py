"""Sliding control limits from panes of time.

Points are summed up once per group and pane (a quarter of an hour): their number, total, steps between
neighbours, and the first and last value. Summaries of following panes merge in order, so the
limits of any trailing window come from its panes and no point is sorted or read again. A pane is
the unit of work: a group with most of the points covers as many shuffle keys as it has panes, and
only the panes of a group, whose number time bounds, meet in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linepulse.operators.limits import ORDER, UNIT, XMR_FACTOR

PANE = "pane_start"


def summaries(
    points: DataFrame,
    group: Sequence[str] = UNIT,
    order: Sequence[str] = ORDER,
    value: str = "result",
    minutes: int = 15,
) -> DataFrame:
    """One row per group and pane with points: n, total, steps, first and last.

    The first column of `order` is the time. Points at the same place of the order follow each
    other by value; copies of a point are counted before the shuffle. Points without a time or
    value are left out.
    """
    seconds = minutes * 60
    at = F.unix_seconds(F.col(order[0]))
    keys, place = [*group, PANE], [*order, value]
    known = points.filter(F.col(value).isNotNull() & F.col(order[0]).isNotNull()).select(
        *group, *place, (at - F.pmod(at, F.lit(seconds))).alias(PANE)
    )
    counted = known.groupBy(*keys, *place).agg(F.count("*").alias("copies"))
    inside = W.partitionBy(*keys).orderBy(*place)
    step = F.abs(F.col(value) - F.lag(value).over(inside))
    return (
        counted.repartition(*keys)
        .withColumn("step", step)
        .groupBy(*keys)
        .agg(
            F.sum("copies").alias("n"),
            F.sum(F.col(value) * F.col("copies")).alias("total"),
            F.coalesce(F.sum("step"), F.lit(0.0)).alias("steps"),
            F.min_by(value, F.struct(*place)).alias("first"),
            F.max_by(value, F.struct(*place)).alias("last"),
        )
    )


def merged(
    parts: DataFrame, group: Sequence[str] = UNIT, hours: int = 24, minutes: int = 15
) -> DataFrame:
    """For each pane the count, total and sum of moving ranges of the window that ends with it."""
    across = W.partitionBy(*group).orderBy(PANE)
    seam = F.abs(F.col("first") - F.lag("last").over(across))
    window = across.rangeBetween(-(hours * 3600 - minutes * 60), 0)
    joined = parts.withColumn("seam", F.coalesce(seam, F.lit(0.0)))
    return joined.select(
        *group,
        PANE,
        F.sum("n").over(window).alias("n"),
        F.sum("total").over(window).alias("total"),
        # the seam before the window's first pane leads out of it
        (F.sum(F.col("steps") + F.col("seam")).over(window) - F.first("seam").over(window)).alias("range_sum"),
    )


def sliding_limits(
    points: DataFrame,
    group: Sequence[str] = UNIT,
    order: Sequence[str] = ORDER,
    value: str = "result",
    hours: int = 24,
    minutes: int = 15,
    scale: float = 100.0,
    low: float = 0.0,
    high: float = 100.0,
) -> DataFrame:
    """Limits and mean of the points of the trailing `hours`, at the end of every pane with points.

    `window_end` is that end; a window holds the points from `hours` before it up to, not including,
    it. A window of one point has a mean and no limits. Several indicators go in one pass with their
    name in `group`.
    """
    sums = merged(summaries(points, group, order, value, minutes), group, hours, minutes)
    mean = F.col("total") / F.col("n")
    spread = F.try_divide(F.col("range_sum"), F.col("n") - 1) * XMR_FACTOR
    some = F.col("n") > 1
    return sums.select(
        *group,
        F.timestamp_seconds(F.col(PANE) + minutes * 60).alias("window_end"),
        F.col("n").alias("points"),
        F.when(some, F.least(F.lit(high), (mean + spread) * scale)).alias("ucl"),
        F.when(some, F.greatest(F.lit(low), (mean - spread) * scale)).alias("lcl"),
        mean.alias("mean"),
    )
