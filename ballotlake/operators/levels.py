"""Per-level summaries over a day axis: re-aggregation (A2), day offset,
running totals (W1/W2), the empty level (A22) and GROUPING SETS (A6)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.dates import days_from


def running_total(df: DataFrame, partition_cols: Sequence[str], order_col: str,
                  value_col: str, out_col: str) -> DataFrame:
    """``sum(value) OVER (PARTITION BY p ORDER BY o NULLS FIRST RANGE
    BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)``.

    The frame is written out: peers (equal order values) share a total and
    rows with a null order value come first, so they count in every later
    total. All rows of a group meet in one task; ``running_total_by_range`` is
    for large groups and for an empty partition list.
    """
    order = F.col(order_col).asc_nulls_first()
    w = (Window.partitionBy(*partition_cols) if partition_cols else Window).orderBy(order)
    w = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out_col, F.sum(value_col).over(w))


#: Days of a range in ``running_total_by_range``.
RANGE_DAYS = 64


def running_total_by_range(df: DataFrame, partition_cols: Sequence[str], order_col: str, value_col: str,
                           out_col: str, width: int = RANGE_DAYS) -> DataFrame:
    """:func:`running_total` in two passes, for groups too large for one task
    (no partition columns: everything is one group).

    The order axis (a number) is cut into ranges of ``width``. Pass one adds up
    each range and gives it the sum of all earlier ones; only these sums, a row
    per range, meet by group. Pass two adds up inside each range, a task each.
    Peers are in one range; null order values are a range of their own, before
    all others.
    """
    keys = [*partition_cols, "__range"]
    rows = df.withColumn("__range", F.floor(F.col(order_col) / F.lit(width)))
    sums = rows.groupBy(*keys).agg(F.sum(value_col).alias("__sum"))
    group = Window.partitionBy(*partition_cols) if partition_cols else Window
    earlier = group.orderBy(F.col("__range").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.sum("__sum").over(earlier).alias("__before"))
    same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    joined = rows.join(before, same).drop(*[f"__k{i}" for i in range(len(keys))])
    inside = running_total(joined, keys, order_col, value_col, "__inside")
    total = F.when(F.col("__before").isNull(), F.col("__inside")).otherwise(
        F.col("__before") + F.coalesce("__inside", F.lit(0)))
    return inside.withColumn(out_col, total).drop("__range", "__before", "__inside")


def by_day_at_level(base: DataFrame, level: Sequence[str], anchor_date: str,
                    date_col: str = "DateDT", count_col: str = "votesOnDate",
                    days_col: str = "DaysFromElection", to_date_col: str = "votesToDate") -> DataFrame:
    """Counts per (level, day), the day offset to ``anchor_date`` and the
    running total within the level. Output is one row per (level keys, day),
    bounded by the number of calendar days per group."""
    # Map-side partial sums reach the exchange (days x groups), never the
    # rows of a county; the window then moves one row per group and day.
    agg = (base.groupBy(*level, date_col)
           .agg(F.sum(count_col).cast("long").alias(count_col))
           .withColumn(days_col, days_from(date_col, anchor_date)))
    total = running_total if level else running_total_by_range
    return total(agg, list(level), days_col, count_col, to_date_col)


def by_day_grouping_sets(base: DataFrame, levels: Mapping[str, Sequence[str]], anchor_date: str,
                         date_col: str = "DateDT", count_col: str = "votesOnDate",
                         days_col: str = "DaysFromElection", to_date_col: str = "votesToDate",
                         level_col: str = "level") -> DataFrame:
    """All levels (name -> keys) in one aggregate: ``GROUP BY GROUPING SETS``
    over the union of level keys, then one window partitioned by (grouping id, keys).

    A rolled-up key is null; ``grouping_id`` tells it apart from a genuine
    null group (e.g. an unmatched precinct), so both survive.
    """
    keys: list[str] = []
    for lv in levels.values():
        for k in lv:
            if k not in keys:
                keys.append(k)
    sets = [[*lv, date_col] for lv in levels.values()]
    agg = (base.groupingSets(sets, *keys, date_col)
           .agg(F.sum(count_col).cast("long").alias(count_col),
                F.grouping_id(*keys, date_col).alias("_gid")))
    # Level label from the grouping id (bit i set <=> key i rolled up).
    label = None
    for name, lv in levels.items():
        gid = 0
        for i, k in enumerate([*keys, date_col]):
            if k not in lv and k != date_col:
                gid |= 1 << (len(keys) - i)
        cond = F.col("_gid") == gid
        label = F.when(cond, name) if label is None else label.when(cond, name)
    agg = agg.withColumn(level_col, label).withColumn(days_col, days_from(date_col, anchor_date))
    out = running_total(agg, ["_gid", *keys], days_col, count_col, to_date_col)
    return out.drop("_gid")
