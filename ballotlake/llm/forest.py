"""Operator 7: near-duplicate vectors with a forest of random-projection
trees.

Each tree halves the vectors of a label again and again by a random
hyperplane through the label's mean; vectors within a margin of a plane go
to both sides (spill), so close vectors rarely part in a tree and hardly
ever in all. Vectors are compared by cosine inside leaves only, in double
precision, and links are joined into components.

Planes depend on (seed, tree, node) alone and the depth on the number of
distinct vectors of the label, so no tree is gathered anywhere: a vector
finds its leaves by itself. Equal vectors collapse into one node with a
weight. Leaves larger than a block are dealt over pairs of blocks. Links
inside a leaf are not emitted as pairs: each block pair yields one number
per vector (links first seen here) and a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import written

MEMBER = "label int, node long, w long, place string, seen array<string>, vec binary"


def _plane(seed: int, tree: int, path: int, dim: int, cache: dict) -> np.ndarray:
    key = (tree, path, dim)
    if key not in cache:
        if len(cache) > 4096:
            cache.clear()
        v = np.random.default_rng([seed, tree, path, dim]).standard_normal(dim)
        cache[key] = v / np.linalg.norm(v)
    return cache[key]


def _leaves(trees: int, margin: float, seed: int):
    """Rows of distinct unit vectors -> one row per (vector, leaf) with the
    leaves of earlier trees."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict = {}
        for pdf in batches:
            out = []
            for row in zip(pdf["label"], pdf["node"], pdf["w"], pdf["vec"], pdf["mean"], pdf["depth"]):
                label, node, w, vec, mean, depth = row
                x = np.frombuffer(vec) - np.asarray(mean)
                seen: list[str] = []
                for t in range(trees):
                    paths = [1]
                    for _ in range(depth):
                        nxt = []
                        for p in paths:
                            d = float(_plane(seed, t, p, len(x), cache) @ x)
                            if d > -margin:
                                nxt.append(2 * p + 1)
                            if d <= margin:
                                nxt.append(2 * p)
                        paths = nxt
                    here = [f"{t}:{p}:{len(x)}" for p in paths]
                    for i, leaf in enumerate(here):
                        out.append((label, node, w, leaf, [*seen, *here[:i]], vec))
                    seen += here
            yield pd.DataFrame(out, columns=["label", "node", "w", "place", "seen", "vec"])

    return run


def _compare(threshold: float):
    """One leaf, or a pair of blocks of it -> per vector the weight of links
    first seen here, and a spanning forest of the links."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["side", "node"]).reset_index(drop=True)
        vec = np.stack([np.frombuffer(v) for v in pdf["vec"]])
        node, w = pdf["node"].to_numpy(), pdf["w"].to_numpy()
        cross = int((pdf["side"] == 0).sum()) if pdf["two"].iloc[0] else 0
        close = (vec @ vec.T) >= threshold
        if cross:  # only pairs between the two blocks
            close[:cross, :cross] = False
            close[cross:, cross:] = False
        np.fill_diagonal(close, False)
        new = close.copy()
        where: dict[str, list[int]] = {}
        for i, s in enumerate(pdf["seen"]):
            for leaf in s:
                where.setdefault(leaf, []).append(i)
        for ix in where.values():
            if len(ix) > 1:
                new[np.ix_(ix, ix)] = False
        n = new @ w
        edge = _forest(close)
        a = pd.DataFrame({"node": node, "n": n, "other": pd.array([None] * len(node), "Int64")})[n > 0]
        b = pd.DataFrame({"node": node[edge[:, 0]], "n": 0, "other": pd.array(node[edge[:, 1]], "Int64")})
        return pd.concat([a, b], ignore_index=True)

    return run


def _forest(close: np.ndarray) -> np.ndarray:
    """Edges of a spanning forest (breadth first) of a symmetric matrix."""
    left = np.ones(len(close), bool)
    out = []
    for root in range(len(close)):
        if not left[root] or not close[root].any():
            continue
        left[root] = False
        queue = [root]
        while queue:
            i = queue.pop()
            nxt = np.flatnonzero(close[i] & left)
            left[nxt] = False
            out += [(i, j) for j in nxt]
            queue += nxt.tolist()
    return np.array(out, dtype=np.int64).reshape(-1, 2)


def _usable(vec: Column) -> Column:
    """Not null, without null or non-finite components, not zero."""
    inf = float("inf")
    ok = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    return F.coalesce(vec.isNotNull() & ok & F.exists(vec, lambda x: x != 0), F.lit(False))


def _units() -> object:
    """Unit vectors in double precision, as bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for v in pdf.pop("vec"):
                x = np.asarray(v, np.float64)
                x = x / np.abs(x).max()
                out.append((x / np.linalg.norm(x)).tobytes())
            yield pdf.assign(vec=out)

    return run


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                 threshold: float = 0.98, trees: int = 6, leaf: int = 256, block: int = 1024,
                 margin: float | None = None, seed: int = 11) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Vectors of equal, non-null label and equal length are linked when found
    together in a leaf with a cosine of ``threshold`` or more, in double
    precision; ``n_links`` counts the other vectors linked directly,
    ``component_id`` is the smallest id reachable and ``kept`` says whether
    that is the row's own. ``margin`` defaults to half the chord of the
    threshold angle projected on a random direction, doubled: a linked pair
    parts at a plane only if its projections differ by twice that, two
    standard deviations and astride the margin.

    Null vectors, zero vectors and vectors with null or non-finite
    components, rows without label: no links, own component. Null id: no
    links, component null, not kept. Equal vectors: linked with each other.
    Repeated ids: rows of one component entry each. No rows: none. Extra
    columns are ignored and may have any name.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("int").alias("label"),
                          F.col(embedding).cast("array<double>").alias("vec"))
    good = rows.where(_usable(F.col("vec")) & F.col("label").isNotNull() & F.col("id").isNotNull())
    unit = written(good.mapInPandas(_units(), "id long, label int, vec binary"), "units")
    same = written(unit.groupBy("label", "vec").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("w")), "nodes")
    dim = F.octet_length("vec") / 8
    size = same.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    flat = (good.select("label", F.size("vec").alias("dim"), F.posexplode(F.transform(
        "vec", lambda x: x / F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, y: a + y * y)))).alias("i", "x"))
        .groupBy("label", "dim", "i").agg(F.avg("x").alias("x")))
    mean = flat.groupBy("label", "dim").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))),
                                                        lambda s: F.round(s["x"], 9)).alias("mean"))
    depth = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / float(leaf)))).cast("int")
    known = (same.withColumn("dim", dim.cast("int"))
             .join(mean.join(size, "label").select("label", "dim", "mean", depth.alias("depth")), ["label", "dim"]))
    chord = float(np.sqrt(2 - 2 * threshold))
    width = margin if margin is not None else chord / 8.0
    member = written(known.select("label", "node", "w", "vec", "mean", "depth")
                     .mapInPandas(_leaves(trees, width, seed), MEMBER), "leaves")
    # Leaves larger than a block: every vector goes to its block's pairs with all blocks.
    count = member.groupBy("label", "place").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"),
                                                 F.count(F.lit(1)).alias("members")).where("members > 1")
    m = member.join(count, ["label", "place"]).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    m = m.select("label", "place", "node", "w", "seen", "vec", F.least("mine", "other").alias("b1"),
                 F.greatest("mine", "other").alias("b2"), (F.col("mine") > F.col("other")).cast("int").alias("side"),
                 (F.col("mine") != F.col("other")).alias("two"))
    found = written(m.groupBy("label", "place", "b1", "b2").applyInPandas(
        _compare(threshold), "node long, n long, other long"), "found")
    links = found.where("other is null").groupBy("node").agg(F.sum("n").alias("n"))
    comp = components(found.where("other is not null").select(F.col("node").alias("u"), F.col("other").alias("v")))
    named = (same.join(links, "node", "left").join(comp, "node", "left")
             .select("label", "vec", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"),
                     F.coalesce("component", "node").alias("component_id")))
    per_id = written(unit.join(named, ["label", "vec"]).select("id", "n_links", "component_id"), "per-vector")
    per_id = per_id.groupBy("id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = rows.select("id").join(per_id, "id", "left")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component_id", "id").alias("component_id"),
                      F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"))
