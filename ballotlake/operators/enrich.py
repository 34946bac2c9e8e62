"""Left enrichment from lookup tables (J1, J2, J8, J9, J11, J13) and the
checks that keep them honest (B11: a duplicated map key multiplies rows)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

_HIT = "__map_hit"


def left_enrich(df: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left",
                broadcast_lookup: bool = False) -> DataFrame:
    """Equi-join on ``keys``; misses keep the row with null map columns.

    ``broadcast_lookup`` is only for lookups whose size is fixed by
    construction (a literal table); data-derived maps are left to AQE, which
    broadcasts them at runtime only when their measured size is under
    ``spark.sql.autoBroadcastJoinThreshold``.
    """
    right = F.broadcast(lookup) if broadcast_lookup else lookup
    return df.join(right, list(keys), how)


def left_enrich_with_report(df: DataFrame, lookup: DataFrame, keys: Sequence[str],
                            broadcast_lookup: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(enriched, unmatched)``: the second frame lists the input rows that
    found no map row, from the same join (no second join)."""
    marked = lookup.withColumn(_HIT, F.lit(True))
    j = left_enrich(df, marked, keys, "left", broadcast_lookup)
    return j.drop(_HIT), j.filter(F.col(_HIT).isNull()).select(*df.columns)


def duplicate_keys(lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once in a lookup (lazy; empty when unique)."""
    return (lookup.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") > 1))


def assert_unique(lookup: DataFrame, keys: Sequence[str]) -> None:
    """Raise if the lookup has a duplicated key (one small aggregate job)."""
    dup = duplicate_keys(lookup, keys).limit(5).collect()
    if dup:
        raise ValueError(f"lookup keys {list(keys)} are not unique, e.g. {dup}")


def first_per_key(lookup: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """One row per key: the one with the smallest ``order_col`` (a total
    order), via ``min(struct)`` with map-side partial aggregation."""
    rest = [c for c in lookup.columns if c not in keys and c != order_col]
    best = F.min(F.struct(F.col(order_col), *[F.col(c) for c in rest])).alias("__b")
    return lookup.groupBy(*keys).agg(best).select(*keys, "__b.*")
