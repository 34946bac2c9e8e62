"""Connected components of an edge table by alternating large and small
stars, each round a pair of aggregations and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written


def _smallest(pairs: DataFrame, keep: str) -> DataFrame:
    """(u, v, m): ``m`` the smallest of u and its neighbours in ``pairs``."""
    m = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return pairs.join(m, "u").where(keep)


def _star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _smallest(both, "v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    small = _smallest(down, "true")
    out = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
           .unionByName(small.select("u", F.col("m").alias("v"))))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` edges -> ``(node, component)`` with the smallest node id
    reachable, for every node that has an edge to another one.

    Each round maps the edges to stars around smaller nodes; it ends when a
    round changes nothing, when every edge points at its component's
    smallest node. A node with very many neighbours is pre-aggregated
    (``min``) before the shuffle, and its edge rows meet one row of minima
    in a join that adaptive execution may split. Rounds are written tables.
    Self-loops and null ends are ignored; no edges give no rows.
    """
    cur = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .distinct(), "edges")
    state = None
    while True:
        sign = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == state or sign[0] == 0:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                cur.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        state = sign
        cur = written(_star(cur), "stars")
