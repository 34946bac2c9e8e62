"""Nesting rows into arrays of structs.

``nest`` is for groups whose size is bounded by construction (days per
precinct, modes per race). ``nest_parts`` is for groups that grow with the
data (voters on a street, history of one id): a column of the row says which
part of its group it belongs to. Nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def struct_of(fields: Sequence[str | Column]) -> Column:
    return F.struct(*[F.col(f) if isinstance(f, str) else f for f in fields])


def nest(df: DataFrame, keys: Sequence[str], fields: Sequence[str | Column], name: str,
         extra_aggs: Sequence[Column] = ()) -> DataFrame:
    """``groupBy(keys).agg(sort_array(collect_list(struct(fields))))``.

    ``sort_array`` orders by the struct's fields left to right, so the
    array order is deterministic (first field first, nulls first).
    """
    return df.groupBy(*keys).agg(*extra_aggs, F.sort_array(F.collect_list(struct_of(fields))).alias(name))


def nest_parts(df: DataFrame, keys: Sequence[str], fields: Sequence[str | Column], name: str,
               part: Column, part_col: str = "part") -> DataFrame:
    """Like ``nest`` with one output row per (keys, ``part``).

    ``part`` is a column of the row itself (an election year, a block of
    house numbers, ``row_bucket``), so the shape of the output does not
    depend on how many rows a key has, no count is needed first, and the
    parts of a hot key land on different tasks.
    """
    return (df.withColumn(part_col, part).groupBy(*keys, part_col)
            .agg(F.sort_array(F.collect_list(struct_of(fields))).alias(name)))


def row_bucket(cols: Sequence[str], buckets: int = 64) -> Column:
    """One of a fixed number of hash buckets of the given columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int")


def json_text(c: str | Column, keep_nulls: bool = True) -> Column:
    """``to_json`` that writes null fields (``"x":null``) when asked, so the
    text is stable across engines."""
    col = F.col(c) if isinstance(c, str) else c
    return F.to_json(col, {"ignoreNullFields": "false"} if keep_nulls else {})


def compute_once(df: DataFrame, expr: Column, name: str) -> DataFrame:
    """Add ``expr`` as column ``name``, evaluated once per row.

    Catalyst copies a projected expression into every filter pushed below
    the projection (and may split a parse per extracted field), so an
    expensive parse (``from_csv``/``from_json`` of a text column) can run
    several times per row. Producing the value from a generator stops
    that: filters on generator output stay above it. ``inline_outer`` of a
    one-element array adds no inferred filter and no rows."""
    return df.select("*", F.inline_outer(F.array(F.struct(expr.alias(name)))))
