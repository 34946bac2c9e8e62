"""Pivot-sum with a declared value list (A3) and fold of unlisted values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def pivot_sum(df: DataFrame, keys: Sequence[str], pivot_col: str, value_col: str,
              values: Sequence[str] = ("democratic", "republican", "other"),
              fold_into: str | None = "other", aliases: Mapping[str, str] | None = None) -> DataFrame:
    """One column per listed value holding ``sum(value_col)``.

    Written as conditional sums in a single aggregate (partial + final,
    one shuffle on ``keys``) instead of ``pivot()``, whose plan first
    groups by ``keys + pivot_col`` and needs a second exchange. A value
    that never occurs in a group gives null, as pivot does.

    ``fold_into``: values not in the list (and null) are summed into that
    column; ``None`` drops them (the reference behaviour).
    """
    listed = [v for v in values]
    p = F.col(pivot_col)
    aggs = []
    for v in listed:
        cond = p == F.lit(v)
        if fold_into is not None and v == fold_into:
            others = [x for x in listed if x != fold_into]
            cond = cond | p.isNull() | ~p.isin(*others) if others else F.lit(True)
        out = (aliases or {}).get(v, v)
        aggs.append(F.sum(F.when(cond, F.col(value_col))).alias(out))
    return df.groupBy(*keys).agg(*aggs)
