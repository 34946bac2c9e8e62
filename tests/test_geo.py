"""Features, centroids, boxes, thinning, rollups (fixture T9; B22)."""

import json
import math

from pyspark.sql import functions as F

from ballotlake.operators import geometry as G
from ballotlake.plans import geography as GG
from ballotlake.sources import read_features
from tests.conftest import write

COUNTS = GG.REGISTRATION_COUNTS
PROPS = "ID string, CNTY string, CTYNAME string, PRECINCT_I string, PRECINCT_N string, " + \
    ", ".join(f"{c} long" for c in COUNTS)


def feat(cty, pid, name, geom, reg=None):
    props = {"ID": f"{cty}-{pid}", "CNTY": "1", "CTYNAME": cty, "PRECINCT_N": name}
    if pid is not None:
        props["PRECINCT_I"] = pid
    for i, c in enumerate(COUNTS):
        if reg is not None:
            props[c] = reg + i
    return {"type": "Feature", "properties": props, "geometry": geom}


SQUARE = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]}
LSHAPE = {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 1], [1, 1], [1, 2], [0, 2], [0, 0]]]}
HOLE = {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]],
                                           [[1, 1], [1, 2], [2, 2], [2, 1], [1, 1]]]}
TWO = {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]],
                                               [[[2, 0], [3, 0], [3, 1], [2, 1], [2, 0]]]]}
LINE = {"type": "Polygon", "coordinates": [[[0, 0], [1, 1], [2, 2], [0, 0]]]}


def _features(spark, tmp_path):
    fc = {"type": "FeatureCollection", "features": [
        feat("fulton", "01a", "Square", SQUARE, reg=None),     # first of county, counts missing (B22)
        feat("Fulton", "02", "L", LSHAPE, reg=10),
        feat("COBB", "03", "Hole", HOLE, reg=1),
        feat("COBB", "04", "Two", TWO, reg=2),
        feat("COBB", None, "Line", LINE, reg=3),
    ]}
    p = write(str(tmp_path / "precincts.json"), json.dumps(fc))
    return read_features(spark, p, PROPS)


def test_ids_and_centroids(spark, tmp_path):
    f = GG.precinct_features(_features(spark, tmp_path))
    got = {r.PRECINCT_N: r for r in f.collect()}
    assert got["Square"].id == "FULTON##01A" and got["Square"].CTYNAME == "FULTON"
    assert got["Line"].id == "COBB"                                   # no PRECINCT_I
    assert got["Square"].centroid == [0.5, 0.5]
    cx, cy = got["L"].centroid
    assert math.isclose(cx, 5 / 6) and math.isclose(cy, 5 / 6)
    hx, hy = got["Hole"].centroid                                      # (16*2 - 1*1.5) / 15
    assert math.isclose(hx, (16 * 2 - 1.5) / 15) and math.isclose(hy, (16 * 2 - 1.5) / 15)
    assert got["Two"].centroid == [1.5, 0.5]
    assert got["Line"].centroid == [0.75, 0.75]                        # zero area -> vertex mean


def test_boxes_and_labels(spark, tmp_path):
    fs = _features(spark, tmp_path)
    boxes = {r.county: r.bbox for r in GG.county_boxes(fs).collect()}
    assert boxes == {"FULTON": [0.0, 0.0, 2.0, 2.0], "COBB": [0.0, 0.0, 4.0, 4.0], "STATE": [0.0, 0.0, 4.0, 4.0]}
    lab = {(r.county, r.precinct) for r in GG.id_to_name(fs).collect()}
    assert ("FULTON", "01a") in lab and ("COBB", None) in lab


def test_demographics(spark, tmp_path):
    fs = _features(spark, tmp_path)
    pre = {r.id: r for r in GG.precinct_demographics(fs).collect()}
    assert pre["FULTON##01A"].REG20 is None
    cty = {r.CTYNAME: r for r in GG.county_demographics(fs).collect()}
    assert cty["FULTON"].REG20 == 10 and cty["FULTON"].UKNOWNREG2 == 10 + 18     # missing -> 0 (B22)
    assert cty["COBB"].REG20 == 1 + 2 + 3 and cty["COBB"].id == "COBB"


def test_thinning_circle(spark):
    n = 5000
    pts = [[math.cos(2 * math.pi * i / n), math.sin(2 * math.pi * i / n)] for i in range(n)] + [[1.0, 0.0]]
    df = spark.createDataFrame([(json.dumps([pts]),)], "c string").select(
        G.multipolygon_from_coords(F.col("c"), F.lit("Polygon")).alias("g"))
    out = df.select(G.thin_feature("g", 0.01).alias("t")).first().t[0][0]
    assert 4 <= len(out) < n / 5
    assert (out[0].x, out[0].y) == (out[-1].x, out[-1].y)
    far = [[10 + x, 10 + y] for x, y in pts]                        # all vertices in one cell
    df2 = spark.createDataFrame([(json.dumps([far]),)], "c string").select(
        G.multipolygon_from_coords(F.col("c"), F.lit("Polygon")).alias("g"))
    tiny = df2.select(G.thin_feature("g", 100.0).alias("t")).first().t[0][0]
    assert len(tiny) == n + 1                                       # < 4 would remain: keep original


def test_county_collections_split(spark, tmp_path):
    f = GG.precinct_features(_features(spark, tmp_path))
    cc = GG.county_collections(f).collect()
    assert sum(len(r.features) for r in cc) == 5
    assert {r.CTYNAME for r in cc} == {"FULTON", "COBB"}


def test_feature_lines_reader(spark, tmp_path):
    from ballotlake.sources import read_feature_lines
    lines = "\n".join(json.dumps(feat("fulton", pid, f"n{pid}", SQUARE, reg=1)) for pid in ("01", "02"))
    p = write(str(tmp_path / "lines/f.geojsonl"), lines + "\n")
    f = GG.precinct_features(read_feature_lines(spark, p, PROPS))
    assert sorted(r.id for r in f.collect()) == ["FULTON##01", "FULTON##02"]
