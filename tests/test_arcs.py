"""Simplification on shared arcs: common borders stay common, rings stay
closed, and no more area goes than the tolerance allows."""

import random

import pytest
from pyspark.sql import functions as F

from ballotlake.operators import arcs as A
from ballotlake.operators.geometry import MULTI

TOLERANCE = 0.9


def ring(points, closed=True):
    points = [(float(x), float(y)) for x, y in points]
    return [{"x": x, "y": y} for x, y in (points + points[:1] if closed else points)]


def features(spark, rows):
    return spark.createDataFrame(rows, f"id string, geometry {MULTI}")


def points(multi):
    return multi and [[[(p["x"], p["y"]) for p in r] for r in poly] for poly in multi]


def area(r):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:] + r[:1])) / 2


def edges(r):
    return [frozenset(e) for e in zip(r, r[1:])]


def grid_map(n=4, steps=9, seed=3):
    """n x n cells of side 10 whose common borders wiggle; each cell's ring
    starts anywhere, every other one runs backwards."""
    rnd = random.Random(seed)

    def line(x0, y0, dx, dy):
        return [(x0 + dx * 10 * i / steps + (rnd.uniform(-.8, .8) if dy and 0 < i < steps else 0),
                 y0 + dy * 10 * i / steps + (rnd.uniform(-.8, .8) if dx and 0 < i < steps else 0))
                for i in range(steps + 1)]

    level = {(i, j): line(10 * i, 10 * j, 1, 0) for i in range(n) for j in range(n + 1)}
    steep = {(i, j): line(10 * i, 10 * j, 0, 1) for i in range(n + 1) for j in range(n)}
    rows = {}
    for i in range(n):
        for j in range(n):
            r = (level[i, j][:-1] + steep[i + 1, j][:-1] + level[i, j + 1][::-1][:-1] + steep[i, j][::-1][:-1])
            k = rnd.randrange(len(r))
            rows[f"{i}/{j}"] = (r[k:] + r[:k])[::-1 if (i + j) % 2 else 1]
    return rows


def thinned(arc, tolerance):
    """The rounds of thin_arc, vertex by vertex."""
    least = 4 if arc[0] == arc[-1] else 3
    while True:
        size = {i: (abs((arc[i][0] - arc[i - 1][0]) * (arc[i + 1][1] - arc[i - 1][1])
                        - (arc[i + 1][0] - arc[i - 1][0]) * (arc[i][1] - arc[i - 1][1])) / 2, *arc[i])
                for i in range(1, len(arc) - 1)}
        gone = {i for i, s in size.items() if s[0] < tolerance
                and all(j not in size or s < size[j] for j in (i - 1, i + 1))}
        if not gone or len(arc) - len(gone) < least:
            return arc
        arc = [p for i, p in enumerate(arc) if i not in gone]


@pytest.fixture(scope="module")
def mapped(spark):
    rows = grid_map()
    got = {r["id"]: points(r["geometry"])[0][0] for r in A.simplify_shared(
        features(spark, [(k, [[ring(r)]]) for k, r in rows.items()]).repartition(5), TOLERANCE).collect()}
    return rows, got


def test_borders_stay_common(mapped):
    rows, got = mapped
    count = {}
    for r in got.values():
        assert r[0] == r[-1] and len(r) >= 4
        for e in edges(r):
            count[e] = count.get(e, 0) + 1
    assert len(count) < 0.8 * len({e for r in rows.values() for e in edges(r + r[:1])})  # it thins
    borders = 0
    for k, r in rows.items():
        for other, q in rows.items():
            common = set(r) & set(q)
            if k < other and len(common) > 1:
                borders += 1
                kept = common & set(got[k])
                assert kept == common & set(got[other]) and 3 <= len(kept) < len(common)
                assert sum(e <= common for e in edges(got[k])) == len(kept) - 1
                assert all(count[e] == 2 for e in edges(got[k]) if e <= common)
    assert borders == 24


def test_area_within_tolerance(mapped):
    rows, got = mapped
    for k, r in rows.items():
        new = got[k][:-1]
        assert set(new) <= set(r)
        assert abs(area(new) - area(r)) <= TOLERANCE * (len(r) - len(new)) + 1e-9
        assert (area(new) > 0) == (area(r) > 0)  # direction kept
    whole = sum(abs(area(r)) for r in rows.values())
    assert abs(sum(abs(area(r[:-1])) for r in got.values()) - whole) < 0.05 * whole


def test_arcs_against_brute_force(spark, mapped):
    rows, got = mapped
    neighbours = {}
    for r in rows.values():
        for a, p, b in zip(r[-1:] + r[:-1], r, r[1:] + r[:1]):
            neighbours.setdefault(p, set()).add(frozenset((a, b)))
    ends = {p for p, s in neighbours.items() if len(s) > 1}
    count = {}
    for k, r in rows.items():
        at = [i for i, p in enumerate(r) if p in ends]
        new = []
        for a, b in zip(at, at[1:] + [at[0] + len(r)]):
            arc = (r + r + r[:1])[a:b + 1]
            low = min(arc, arc[::-1])
            count[tuple(low)] = count.get(tuple(low), 0) + 1
            t = thinned(low, TOLERANCE)
            new += (t if low == arc else t[::-1])[:-1]
        assert got[k] == new + new[:1]
    table = A.arc_table(features(spark, [(k, [[ring(r)]]) for k, r in rows.items()])).collect()
    assert {tuple((p["x"], p["y"]) for p in r["arc"]): r["n_rings"] for r in table} == count
    assert set(count.values()) == {1, 2}


def test_other_geometries(spark):
    isle = [(20, 0), (21, 0), (22, .01), (23, 0), (23, 5), (20, 5)]
    bar = [(1, 1), (2, 2)]
    doubled = [(30, 0), (30, 0), (31, 0), (31, 0), (31, 9), (30, 9)]
    rows = [("isle", [[ring(isle)]]), ("isle", [[ring(isle)]]), (None, [[ring(isle, closed=False)]]),
            ("turned", [[ring(isle[3:] + isle[:3])], [ring(isle[::-1])]]), ("empty", []), ("null", None),
            ("bar", [[ring(bar)]]), ("no ring", [[]]), ("void", [[[]]]), ("doubled", [[ring(doubled)]]),
            ("hole", [[ring([(100, 100), (200, 100), (200, 200), (100, 200)]),
                       [{"x": 1.0, "y": None}] + ring([(120, 120), (130, 120), (130, 130)])]])]
    df = features(spark, rows).withColumn("_g1", F.lit("mine")).withColumn("pos", F.lit(1))
    got = A.simplify_shared(df, 1.0)
    assert got.columns == df.columns and got.schema["geometry"].dataType == df.schema["geometry"].dataType
    by = {}
    for r in got.collect():
        by.setdefault(r["id"], []).append(points(r["geometry"]))
    thin = [(20.0, 0.0), (23.0, 0.0), (23.0, 5.0), (20.0, 5.0)]
    back = [thin[0], *thin[:0:-1]]
    assert by["isle"] == [[[thin + thin[:1]]]] * 2 and by[None] == [[[thin]]]
    assert by["turned"] == [[[thin + thin[:1]], [back + back[:1]]]]
    assert by["empty"] == [[]] and by["null"] == [None] and by["no ring"] == [[[]]] and by["void"] == [[[[]]]]
    assert by["bar"] == [[[[(1.0, 1.0), (2.0, 2.0), (1.0, 1.0)]]]]
    assert by["doubled"] == [[[[(30.0, 0.0), (31.0, 0.0), (31.0, 9.0), (30.0, 9.0), (30.0, 0.0)]]]]
    assert len(by["hole"][0][0][0]) == 5 and len(by["hole"][0][0][1]) == 4
    assert A.simplify_shared(df.limit(0), 1.0).count() == 0 and A.arc_table(df.limit(0)).count() == 0


def test_many_copies_and_a_long_arc(spark):
    """A third of the features are one geometry; one border is long."""
    rnd = random.Random(9)
    long = [(i, rnd.uniform(0, 1)) for i in range(1200)]
    cell = [(0, 50), (10, 50), (10, 60), (5, 60.001), (0, 60)]
    rows = [("c", [[ring(cell)]])] * 300 + [("l", [[ring(long + [(1199, -9), (0, -9)])]]),
                                           ("u", [[ring(long[::-1] + [(0, 9), (1199, 9)])]])]
    got = [(r["id"], points(r["geometry"])[0][0]) for r in A.simplify_shared(features(spark, rows), 0.4).collect()]
    assert len(got) == 302 and len({tuple(r) for i, r in got if i == "c"}) == 1
    border = {i: [p for p in r if p in set((float(x), y) for x, y in long)] for i, r in got if i != "c"}
    assert set(border["l"]) == set(border["u"]) and len(set(border["l"])) < 900
