"""Polygon operators (C6) as per-row array expressions.

A feature's geometry is one row: ``array<array<array<struct<x,y>>>>``
(polygons -> rings -> vertices), the multi-polygon form; a polygon is a
one-element multi-polygon. Centroid, box and thinning are higher-order
functions over that array (``transform`` / ``aggregate`` / ``filter``), so
they run inside whole-stage code generation with no shuffle and no Python.
Rings may be closed (last = first, as in GeoJSON) or open; the shoelace
sums wrap around, which adds a zero term for closed rings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

POINT = "struct<x:double,y:double>"
RING = f"array<{POINT}>"
MULTI = f"array<array<{RING}>>"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` as a lambda variable.

    Catalyst inlines projected expressions into their uses; an array
    expression used inside another lambda would then be rebuilt for every
    element. Binding it through a one-element ``transform`` keeps it a
    variable."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def points_from_flat(c, dims: int = 2) -> Column:
    """``[x0, y0, x1, y1, ...]`` -> ring of structs (extra dims ignored)."""
    arr = _col(c)
    n = F.floor(F.size(arr) / dims).cast("int")
    idx = F.sequence(F.lit(0), n - 1)
    return F.when(n > 0, F.transform(idx, lambda i: F.struct(
        F.element_at(arr, i * dims + 1).cast("double").alias("x"),
        F.element_at(arr, i * dims + 2).cast("double").alias("y")))).otherwise(F.array().cast(RING))


def points_from_pairs(c) -> Column:
    """GeoJSON position list ``[[x, y], ...]`` -> ring of structs."""
    return F.transform(_col(c), lambda p: F.struct(p[0].cast("double").alias("x"), p[1].cast("double").alias("y")))


def multipolygon_from_coords(coords, geom_type) -> Column:
    """GeoJSON coordinates given as JSON text + geometry type -> MULTI."""
    poly = F.from_json(_col(coords), "array<array<array<double>>>")
    multi = F.from_json(_col(coords), "array<array<array<array<double>>>>")
    as_multi = F.when(_col(geom_type) == "Polygon", F.array(poly)).otherwise(multi)
    return F.transform(as_multi, lambda polygon: F.transform(polygon, points_from_pairs))


def _with_next(ring: Column) -> Column:
    """``[{p: v_i, q: v_(i+1)}]`` with the last vertex paired to the first.
    The ring is referenced a fixed number of times (never per element), so
    an inlined ring expression is not re-evaluated for every vertex."""
    n = F.size(ring)
    rot = F.concat(F.slice(ring, 2, F.greatest(n - 1, F.lit(1))), F.slice(ring, 1, 1))
    return F.arrays_zip(ring.alias("p"), rot.alias("q"))


def _cross_terms(ring: Column, fn) -> Column:
    """``sum_i fn(p_i, p_next)`` over the ring, wrapping around, folded
    left to right."""
    return F.aggregate(_with_next(ring), F.lit(0.0),
                       lambda acc, e: acc + F.coalesce(fn(e["p"], e["q"]), F.lit(0.0)))


def ring_area2(ring) -> Column:
    """Twice the signed area (positive = counter-clockwise)."""
    return _cross_terms(_col(ring), lambda p, q: p.x * q.y - q.x * p.y)


def ring_moments(ring) -> Column:
    """struct(a2, mx, my): twice the signed area and the first moments
    ``sum (x_i + x_j) * cross`` / ``sum (y_i + y_j) * cross``."""
    r = _col(ring)
    return F.struct(
        ring_area2(r).alias("a2"),
        _cross_terms(r, lambda p, q: (p.x + q.x) * (p.x * q.y - q.x * p.y)).alias("mx"),
        _cross_terms(r, lambda p, q: (p.y + q.y) * (p.x * q.y - q.x * p.y)).alias("my"))


def ring_centroid(ring) -> Column:
    """Area-weighted centre of one ring: struct(x, y, area). A ring with
    zero area (collinear vertices) falls back to the vertex mean."""
    return let(_col(ring), _ring_centroid)


def _ring_centroid(r: Column) -> Column:
    # Moments are taken around the first vertex: at real coordinates the raw
    # products of a small ring cancel to noise.
    return let(F.get(r, F.lit(0)), lambda o: let(
        F.transform(r, lambda p: F.struct((p.x - o.x).alias("x"), (p.y - o.y).alias("y"))),
        lambda moved: let(ring_moments(moved), lambda m: _centroid_from(r, o, m))))


def _centroid_from(r: Column, o: Column, m: Column) -> Column:
    n = F.nullif(F.size(r), F.lit(0))
    mean_x = F.aggregate(r, F.lit(0.0), lambda a, p: a + p.x) / n
    mean_y = F.aggregate(r, F.lit(0.0), lambda a, p: a + p.y) / n
    return F.struct(
        F.when(m.a2 != 0, m.mx / (F.lit(3.0) * m.a2) + o.x).otherwise(mean_x).alias("x"),
        F.when(m.a2 != 0, m.my / (F.lit(3.0) * m.a2) + o.y).otherwise(mean_y).alias("y"),
        F.abs(m.a2 / 2).alias("area"))


def feature_centroid(multi) -> Column:
    """Centre of mass of a multi-polygon: every ring's centroid weighted by
    its area, outer rings (index 0 of each polygon) adding and holes
    subtracting, whatever their orientation. Zero total area falls back to
    the mean of all vertices."""
    return let(_col(multi), _feature_centroid)


def _feature_centroid(m: Column) -> Column:
    rings = F.flatten(F.transform(m, lambda poly: F.transform(
        poly, lambda ring, k: F.struct(F.when(k == 0, F.lit(1.0)).otherwise(F.lit(-1.0)).alias("sign"),
                                       ring_centroid(ring).alias("c")))))
    return let(rings, lambda rs: _combine_rings(m, rs))


def _combine_rings(m: Column, rs: Column) -> Column:
    w = F.aggregate(rs, F.lit(0.0), lambda a, r: a + r.sign * r.c.area)
    sx = F.aggregate(rs, F.lit(0.0), lambda a, r: a + r.sign * r.c.area * r.c.x)
    sy = F.aggregate(rs, F.lit(0.0), lambda a, r: a + r.sign * r.c.area * r.c.y)
    pts = F.flatten(F.flatten(m))
    n = F.size(pts)
    mx = F.aggregate(pts, F.lit(0.0), lambda a, p: a + p.x) / n
    my = F.aggregate(pts, F.lit(0.0), lambda a, p: a + p.y) / n
    return F.struct(F.when(w != 0, sx / w).otherwise(mx).alias("x"),
                    F.when(w != 0, sy / w).otherwise(my).alias("y"))


def geojson_geometry(multi) -> Column:
    """GeoJSON text of a geometry: ``Polygon`` for one polygon, else
    ``MultiPolygon``."""
    return let(F.transform(_col(multi), lambda poly: F.transform(poly, lambda ring: F.transform(
        ring, lambda p: F.array(p.x, p.y)))), lambda m: F.when(
            F.size(m) == 1, F.to_json(F.struct(F.lit("Polygon").alias("type"), F.get(m, F.lit(0)).alias("coordinates"))))
        .otherwise(F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), m.alias("coordinates")))))


def vertices(multi) -> Column:
    return F.flatten(F.flatten(_col(multi)))


def feature_bbox(multi) -> Column:
    """struct(minX, minY, maxX, maxY) over all vertices."""
    pts = vertices(multi)
    xs = F.transform(pts, lambda p: p.x)
    ys = F.transform(pts, lambda p: p.y)
    return F.struct(F.array_min(xs).alias("minX"), F.array_min(ys).alias("minY"),
                    F.array_max(xs).alias("maxX"), F.array_max(ys).alias("maxY"))


def boxes(df: DataFrame, key: str, bbox_col: str = "bbox", total_key: str = "STATE") -> DataFrame:
    """Box per key plus one over everything, from per-feature boxes
    (partial aggregation; one GROUPING SETS pass). Output ``key, minX,
    minY, maxX, maxY`` with the overall row keyed ``total_key``."""
    b = F.col(bbox_col)
    g = (df.groupingSets([[key], []], key)
         .agg(F.min(b.minX).alias("minX"), F.min(b.minY).alias("minY"),
              F.max(b.maxX).alias("maxX"), F.max(b.maxY).alias("maxY"),
              F.grouping_id(key).alias("__g")))
    return g.select(F.when(F.col("__g") == 1, F.lit(total_key)).otherwise(F.col(key).cast("string")).alias(key),
                    "minX", "minY", "maxX", "maxY")


def thin_ring(ring, tolerance: float, min_vertices: int = 4) -> Column:
    """Grid thinning: of each run of neighbouring vertices in one cell of
    ``tolerance`` the smallest (x, y) stays. The ring is cyclic, so neither
    its start nor its direction matters and a border walked by two
    neighbours thins to the same vertices. A closed ring stays closed; one
    that would keep fewer than ``min_vertices`` stays as it was. Error is at
    most one cell diagonal."""
    return let(_col(ring), lambda r: _thin(r, tolerance, min_vertices))


def _thin(r: Column, tolerance: float, min_vertices: int) -> Column:
    n = F.size(r)
    closed = (n > 1) & (F.get(r, F.lit(0)) == F.get(r, n - 1))
    kept = let(F.when(closed, F.slice(r, 1, F.greatest(n - 1, F.lit(0)))).otherwise(r),
               lambda o: _run_minima(o, tolerance))
    whole = let(kept, lambda k: F.when(closed, F.concat(k, F.slice(k, 1, 1))).otherwise(k))
    return let(whole, lambda k: F.when(F.size(k) < F.least(n, F.lit(min_vertices)), r).otherwise(k))


def _run_minima(o: Column, tolerance: float) -> Column:
    n, unit = F.size(o), F.lit(float(tolerance))

    def cell(p):
        return F.struct(F.floor(p.x / unit), F.floor(p.y / unit))

    before = F.concat(F.slice(o, -1, 1), F.slice(o, 1, F.greatest(n - 1, F.lit(0))))
    marked = F.transform(F.arrays_zip(o.alias("p"), before.alias("q")),
                         lambda e, i: F.when(cell(e["p"]) != cell(e["q"]), i))
    starts = F.filter(marked, lambda i: i.isNotNull())
    return let(starts, lambda s: let(F.concat(o, o), lambda twice: F.transform(
        F.arrays_zip(s.alias("a"), F.concat(F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(0))),
                                            F.transform(F.slice(s, 1, 1), lambda i: i + n)).alias("b")),
        lambda e: F.array_min(F.slice(twice, e["a"] + 1, e["b"] - e["a"])))))


def thin_feature(multi, tolerance: float, min_vertices: int = 4) -> Column:
    return F.transform(_col(multi), lambda poly: F.transform(poly, lambda ring: thin_ring(ring, tolerance,
                                                                                            min_vertices)))


def measure_rollup(df: DataFrame, key: str | Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Per-key sums of measures with missing values as 0 (uniformly,
    first row of a key included). Floating measures are summed as decimals
    of six places, so the sum does not depend on the order of the rows."""
    keys = [key] if isinstance(key, str) else list(key)
    kind = dict(df.dtypes)
    exact = {m: F.col(m).cast("decimal(28,6)") if kind[m] in ("double", "float") else F.col(m) for m in measures}
    return df.groupBy(*keys).agg(*[F.sum(F.coalesce(c, F.lit(0))).alias(m) for m, c in exact.items()])
