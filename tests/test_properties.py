"""Property tests: geometry and similarity invariants, hot-key handling."""

import math

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ballotlake.functions.similarity import similarity
from ballotlake.operators import geometry as G
from ballotlake.operators.nest import nest_parts, row_bucket
from ballotlake.operators.latest import latest_per_key


def _regular(cx, cy, r, k, rot, closed=True):
    pts = [(cx + r * math.cos(rot + 2 * math.pi * i / k), cy + r * math.sin(rot + 2 * math.pi * i / k))
           for i in range(k)]
    return pts + [pts[0]] if closed else pts


@settings(max_examples=15, deadline=None)
@given(cx=st.floats(-100, 100), cy=st.floats(-100, 100), r=st.floats(0.01, 50), k=st.integers(3, 40),
       rot=st.floats(0, 6.283), closed=st.booleans(), clockwise=st.booleans())
def test_convex_centroid_is_centre_and_inside_box(spark, cx, cy, r, k, rot, closed, clockwise):
    pts = _regular(cx, cy, r, k, rot, closed)
    if clockwise:
        pts = pts[::-1]
    df = spark.createDataFrame([([{"x": x, "y": y} for x, y in pts],)], f"ring {G.RING}")
    row = df.select(G.ring_centroid("ring").alias("c"),
                    G.feature_bbox(F.array(F.array("ring"))).alias("b")).first()
    tol = 1e-7 * max(1.0, r, abs(cx), abs(cy))
    assert abs(row.c.x - cx) < tol and abs(row.c.y - cy) < tol
    assert row.b.minX - tol <= row.c.x <= row.b.maxX + tol and row.b.minY - tol <= row.c.y <= row.b.maxY + tol
    assert math.isclose(row.c.area, 0.5 * k * r * r * math.sin(2 * math.pi / k), rel_tol=1e-6)


@settings(max_examples=10, deadline=None)
@given(k=st.integers(20, 400), tol=st.sampled_from([0.001, 0.01, 0.1, 0.5]))
def test_thinning_error_bound(spark, k, tol):
    pts = _regular(0.3, -0.2, 1.0, k, 0.1)
    df = spark.createDataFrame([([{"x": x, "y": y} for x, y in pts],)], f"ring {G.RING}")
    out = df.select(G.thin_ring("ring", tol).alias("t")).first().t
    kept = [(p.x, p.y) for p in out]
    assert (kept[0] == kept[-1]) == (pts[0] == pts[-1])
    assert len(kept) >= min(4, len(pts))
    assert set(kept) <= set(pts)
    # every dropped vertex shares a grid cell with a kept vertex (error <= cell diagonal)
    cell = lambda p: (math.floor(p[0] / tol), math.floor(p[1] / tol))
    kept_cells = {cell(p) for p in kept}
    if len(kept) != len(pts):
        assert all(cell(p) in kept_cells for p in pts)


@settings(max_examples=20, deadline=None)
@given(a=st.text(alphabet="ABC XYZ", max_size=12), b=st.text(alphabet="ABC XYZ", max_size=12))
def test_similarity_symmetric_bounded(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    s1, s2 = df.select(similarity("a", "b"), similarity("b", "a")).first()
    assert s1 == s2 and 0 <= s1 <= 100
    assert (s1 == 100) == (a == b) or (len(a) == 0 and len(b) == 0)


def test_hot_key_is_split_and_whole(spark):
    # key 0 holds a third of all rows
    n = 30_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                               F.col("id").alias("v"))
    out = nest_parts(df, ["k"], ["v"], "vs", row_bucket(["v"], 16))
    sizes = out.filter(F.col("k") == 0).select(F.size("vs").alias("s")).collect()
    assert len(sizes) == 16 and max(r.s for r in sizes) <= 10_000 / 16 * 1.3
    assert out.select(F.sum(F.size("vs"))).first()[0] == n


def test_latest_with_hot_key(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
                                    (F.col("id") % 5).alias("o"), F.col("id").alias("v"))
    out = latest_per_key(df, "k", "o")
    hot = out.filter(F.col("k") == 7).collect()
    assert {r.o for r in hot} == {4} and len(hot) == len({i for i in range(0, 20_000, 3) if i % 5 == 4})


def test_latest_agrees_with_rank(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"),
                                    F.when(F.col("id") % 50 != 8, F.col("id") % 5).alias("o"), (F.col("id") % 11).alias("v"))
    a = sorted(map(str, latest_per_key(df, "k", "o").collect()))
    df.createOrReplaceTempView("lpk")
    b = sorted(map(str, spark.sql("SELECT DISTINCT k, o, v FROM (SELECT *, rank() OVER (PARTITION BY k ORDER BY o DESC) r"
                                  " FROM lpk) WHERE r = 1").collect()))
    assert a == b and len(a) > 0


def test_nested_history_hot_id(spark):
    from ballotlake.plans.people import nested_history
    # a third of the rows: one id, one date, ids with the same residue
    hist = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40).alias("id"),
                                    F.col("id").alias("rowId"), F.to_date(F.lit("2024-11-05")).alias("election"))
    prof = spark.range(50).select(F.col("id"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    for part in (None, F.floor(F.col("rowId") / 500)):
        out = nested_history(prof, hist, fields=("rowId", "election"), part=part)
        assert out.select(F.sum(F.size("voterHistory"))).first()[0] == 6000
        none = out.filter(F.col("voterHistory").isNull()).collect()
        assert sorted(r.id for r in none) == list(range(40, 50))                  # no history, one row each
    assert out.filter(F.col("id") == 7).agg(F.max(F.size("voterHistory"))).first()[0] <= 500


def test_small_ring_centre_at_real_coordinates(spark):
    x, y, d = -84.39, 33.75, 1e-4
    ring = [{"x": x + a * d, "y": y + b * d} for a, b in ((0, 0), (1, 0), (1, 1), (0, 1))]
    c = spark.createDataFrame([(ring,)], f"ring {G.RING}").select(G.ring_centroid("ring").alias("c")).first().c
    assert abs(c.x - (x + d / 2)) < 1e-6 * d and abs(c.y - (y + d / 2)) < 1e-6 * d


def test_shared_border_thins_alike(spark):
    border = [(10 + 0.07 * i, math.sin(i / 5)) for i in range(60)]
    a, b = border + [(30.0, 40.0), (-5.0, 40.0)], border[::-1] + [(-5.0, -40.0), (30.0, -40.0)]
    a, b = a[17:] + a[:17], b[5:] + b[:5]
    df = spark.createDataFrame([([{"x": x, "y": y} for x, y in r],) for r in (a, b)], f"ring {G.RING}")
    one, two = ({(p.x, p.y) for p in r.t} & set(border) for r in df.select(G.thin_ring("ring", 0.3).alias("t")).collect())
    assert one == two and 4 < len(one) < 60


def test_geojson_geometry(spark):
    import json
    df = spark.createDataFrame([([[[{"x": 0.0, "y": 1.0}]]],), ([[[{"x": 0.0, "y": 1.0}]], [[{"x": 2.0, "y": 3.0}]]],)],
                               f"g {G.MULTI}")
    got = [json.loads(r[0]) for r in df.select(G.geojson_geometry("g")).collect()]
    assert got == [{"type": "Polygon", "coordinates": [[[0.0, 1.0]]]},
                   {"type": "MultiPolygon", "coordinates": [[[[0.0, 1.0]]], [[[2.0, 3.0]]]]}]
