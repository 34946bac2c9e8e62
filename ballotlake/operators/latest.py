"""Latest row per key with ties (W3, replacing max + join-back, J4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def latest_per_key(df: DataFrame, key: str | Sequence[str], order_col: str,
                   keep_ties: bool = True, tiebreak: Sequence[str] = (), distinct: bool = True) -> DataFrame:
    """Rows whose ``order_col`` is the maximum of their key (null counts as
    lowest). Null keys are dropped: they can never identify a person.

    With ties: rows are made distinct first (hashed by the whole row, so a
    hot key spreads), the maximum per key is a partially aggregated ``max``
    joined back on the key, which AQE splits when it is skewed. No task
    receives all rows of a key.
    ``keep_ties=False`` keeps exactly one row per key using ``tiebreak``
    columns (which must make the order total): a window, whose partial group
    limit forwards one row per key and map task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rows = df.dropna(subset=keys)
    if not keep_ties:
        w = Window.partitionBy(*keys).orderBy(F.col(order_col).desc(), *[F.col(c).asc() for c in tiebreak])
        return rows.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") == 1).drop("__r")
    if distinct:
        rows = rows.distinct()
    best = rows.groupBy(*keys).agg(F.max(order_col).alias("__best"))
    return (rows.join(best, keys).filter(F.col(order_col).eqNullSafe(F.col("__best")))
            .select(*df.columns))
