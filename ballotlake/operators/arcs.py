"""Simplification on shared arcs.

Neighbouring features walk their common border twice. Thinned ring by ring
the two copies can part; here rings are cut into arcs at junctions, every
arc is thinned alone, in one direction whichever ring it comes from, and
the rings are put together again. So a common border stays common.

A vertex is a junction if its occurrences, in whatever ring, don't all have
the same two neighbours. That is the undirected degree of the vertex, found
without a list of its edges: the smaller neighbours are all equal and so are
the larger ones, or not (four extremes, combined before the shuffle).

Where a ring is cut depends on its points only, so cuts are found per
geometry (a hash of 128 bits) and neither ids nor their uniqueness matter.
Vertices move as single points; whole geometries move at most once, to meet
their cuts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .geometry import MULTI, RING, let

_CUTS = "array<struct<poly:int,ring:int,pos:int>>"


def _known(ring: Column) -> Column:
    return F.filter(ring, lambda p: p.isNotNull() & p.x.isNotNull() & p.y.isNotNull())


def open_ring(ring: Column) -> Column:
    """The ring without null vertices, repeated neighbours and the closing
    vertex."""
    runs = let(_known(ring), lambda r: F.filter(r, lambda p, i: (i == 0) | (p != F.get(r, i - 1))))
    return let(runs, lambda r: F.when((F.size(r) > 1) & (F.get(r, F.lit(0)) == F.get(r, F.size(r) - 1)),
                                      F.slice(r, 1, F.size(r) - 1)).otherwise(r))


def _steps(ring: Column) -> Column:
    """Each vertex of an open ring with its smaller and larger neighbour."""
    def step(r, n):
        def at(i):
            before, after = F.get(r, F.when(i == 0, n - 1).otherwise(i - 1)), F.get(r, F.when(i == n - 1, 0).otherwise(i + 1))
            return F.least(before, after).alias("lo"), F.greatest(before, after).alias("hi")
        return F.transform(r, lambda p, i: F.struct(p.alias("p"), *at(i)))
    return let(ring, lambda r: F.when(F.size(r) >= 3, let(F.size(r), lambda n: step(r, n))))


def _geometry_key(geometry: str) -> list[Column]:
    return [F.xxhash64(F.lit(i), F.col(geometry)).alias(f"_g{i}") for i in (1, 2)]


def vertex_steps(features: DataFrame, geometry: str = "geometry") -> DataFrame:
    """``_g1, _g2, poly, ring, pos, p, lo, hi``: every vertex of every ring
    with its neighbours. Rings of fewer than three vertices have none."""
    polys = features.select(*_geometry_key(geometry), F.posexplode(geometry).alias("poly", "_rings"))
    rings = polys.select("_g1", "_g2", "poly", F.posexplode("_rings").alias("ring", "_r"))
    steps = rings.select("_g1", "_g2", "poly", "ring", F.posexplode_outer(_steps(open_ring(F.col("_r")))).alias("pos", "_s"))
    return steps.where("_s is not null").select("_g1", "_g2", "poly", "ring", "pos", "_s.*")


def junctions(steps: DataFrame) -> DataFrame:
    """``p``: the vertices at which arcs end."""
    return (steps.groupBy("p").agg(*[f(c).alias(f"{n}_{c}") for c in ("lo", "hi") for n, f in
                                     (("min", F.min), ("max", F.max))])
            .where("min_lo <> max_lo or min_hi <> max_hi").select("p"))


def with_cuts(features: DataFrame, geometry: str = "geometry") -> DataFrame:
    """``geometry, row, _cuts``: the geometry, all other columns as one
    struct (null: no others) and the places of junctions in the rings (null:
    none). One list per distinct geometry, not longer than that geometry;
    copies of a geometry are merged before the shuffle."""
    steps = vertex_steps(features, geometry)
    at = (steps.select("_g1", "_g2", "poly", "ring", "pos", "p").join(junctions(steps), "p")
          .groupBy("_g1", "_g2").agg(F.collect_set(F.struct("poly", "ring", "pos")).cast(_CUTS).alias("_cuts")))
    others = [F.col(f"`{c}`") for c in features.columns if c != geometry]
    rows = features.select(F.col(geometry).alias("geometry"), (F.struct(*others) if others else F.lit(None)).alias("row"),
                           *_geometry_key(geometry))
    return rows.join(at, ["_g1", "_g2"], "left").drop("_g1", "_g2")


def _ring_arcs(ring: Column, cuts: Column) -> Column:
    """An open ring -> its arcs in order as ``struct(arc, flipped)``: ``arc``
    runs in the smaller of both directions. A ring without cuts is one arc
    from its smallest vertex."""
    places = F.when(F.size(cuts) > 0, cuts).otherwise(
        F.array((F.array_position(ring, F.array_min(ring)) - 1).cast("int")))

    def arcs(r, c):
        n = F.size(r)
        ends = F.concat(F.slice(c, 2, F.size(c) - 1), F.array(F.get(c, F.lit(0)) + n))
        walked = let(F.concat(r, r, F.slice(r, 1, 1)), lambda w: F.transform(
            F.arrays_zip(c.alias("a"), ends.alias("b")), lambda e: F.slice(w, e["a"] + 1, e["b"] - e["a"] + 1)))
        return F.transform(walked, lambda a: let(F.reverse(a), lambda back: F.struct(
            F.when(back < a, back).otherwise(a).alias("arc"), (back < a).alias("flipped"))))

    return let(places, lambda c: arcs(ring, c))


def _cuts_of(cuts: Column, poly: Column, ring: Column) -> Column:
    mine = F.filter(cuts, lambda c: (c["poly"] == poly) & (c["ring"] == ring))
    return F.coalesce(F.sort_array(F.transform(mine, lambda c: c["pos"])), F.array().cast("array<int>"))


def arc_table(features: DataFrame, geometry: str = "geometry") -> DataFrame:
    """The distinct arcs of all rings: ``arc`` (points, in the smaller
    direction) and ``n_rings``, how often rings walk along it. 2 is an inner
    border, 1 an outer one; more means features that overlap or repeat.
    Null and empty geometries and rings below three vertices have none."""
    polys = with_cuts(features.select(geometry), geometry).select("_cuts", F.posexplode("geometry").alias("poly", "_rings"))
    rings = polys.select("_cuts", "poly", F.posexplode("_rings").alias("ring", "_r"))
    arcs = F.when(F.size(open_ring(F.col("_r"))) >= 3, let(open_ring(F.col("_r")), lambda r: _ring_arcs(
        r, _cuts_of(F.col("_cuts"), F.col("poly"), F.col("ring")))))
    return (rings.select(F.explode_outer(arcs).alias("_a")).where("_a is not null")
            .groupBy("_a.arc").agg(F.count(F.lit(1)).alias("n_rings")))


def thin_arc(arc: Column, area: float) -> Column:
    """The arc without vertices of small effective area; its ends stay.

    In rounds, every vertex whose triangle with its two neighbours is below
    ``area`` and smaller than the neighbours' (ties by x, y) goes, until none
    does. Each one changes the area beside the arc by less than ``area``. An
    arc keeps 3 vertices, a closed one 4, so no ring falls flat: a round that
    would leave fewer isn't taken.
    """
    def tri(a, i):
        p, q, r = F.get(a, i - 1), F.get(a, i), F.get(a, i + 1)
        return F.abs((q.x - p.x) * (r.y - p.y) - (r.x - p.x) * (q.y - p.y)) / 2

    def round_(a, least):
        sizes = F.transform(a, lambda p, i: F.when((i > 0) & (i < F.size(a) - 1), F.struct(
            tri(a, i).alias("area"), p.x.alias("x"), p.y.alias("y"))))

        def goes(m, i):
            own = F.get(m, i)
            return (own["area"] < F.lit(float(area))) & F.coalesce(own < F.get(m, i - 1), F.lit(True)) \
                & F.coalesce(own < F.get(m, i + 1), F.lit(True))

        kept = let(sizes, lambda m: F.filter(a, lambda p, i: ~F.coalesce(goes(m, i), F.lit(False))))
        return let(kept, lambda k: F.struct(F.when(F.size(k) >= least, k).otherwise(a).alias("a"),
                                            ((F.size(k) == F.size(a)) | (F.size(k) < least)).alias("done")))

    def run(a):
        least = F.when(F.get(a, F.lit(0)) == F.get(a, F.size(a) - 1), 4).otherwise(3)
        return F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(a), F.lit(1))),
                           F.struct(a.alias("a"), F.lit(False).alias("done")),
                           lambda acc, _: F.when(acc["done"], acc).otherwise(round_(acc["a"], least)),
                           lambda acc: acc["a"])

    return let(arc, run)


def _thin_ring(ring: Column, cuts: Column, area: float) -> Column:
    def whole(r):
        parts = F.transform(_ring_arcs(r, cuts), lambda e: let(thin_arc(e["arc"], area), lambda t: let(
            F.when(e["flipped"], F.reverse(t)).otherwise(t), lambda a: F.slice(a, 1, F.size(a) - 1))))
        return F.flatten(parts)

    closed = let(_known(ring), lambda k: F.get(k, F.lit(0)) == F.get(k, F.size(k) - 1))
    return let(open_ring(ring), lambda r: F.when(F.size(r) < 3, ring).otherwise(
        let(whole(r), lambda k: F.when(closed, F.concat(k, F.slice(k, 1, 1))).otherwise(k)))).cast(RING)


def simplify_shared(features: DataFrame, area: float, geometry: str = "geometry") -> DataFrame:
    """``features`` with every border thinned by effective area (``thin_arc``)
    and common borders still equal.

    Rings start at their first junction (without one, at their smallest
    vertex), keep their direction and stay closed if they were. Rings of
    fewer than three different neighbouring vertices, null and empty
    geometries stay as they are; null vertices and repeated neighbours go.
    Repeated and null ids don't matter; all other columns are carried.
    """
    cut = with_cuts(features, geometry)
    thin = F.transform("geometry", lambda poly, i: F.transform(poly, lambda ring, j: _thin_ring(
        ring, _cuts_of(F.col("_cuts"), i, j), area))).cast(MULTI)
    return cut.select(*[(thin if c == geometry else F.col("row").getField(c)).alias(c) for c in features.columns])
