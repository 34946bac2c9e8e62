"""Documents cut into records by many tasks."""

import json
import random

import pytest
from pyspark.sql import functions as F

from ballotlake.sources import read_features, read_json_array, read_large_features, read_large_json_array
from ballotlake.sources.records import json_records, read_pieces
from tests.conftest import write

PROPS = "ID string, CTYNAME string, REG20 long, odd string"
ODD = ['}', '{', '"', '\\', '}{"\\"}', 'a}b{c', '\\"}', '[{', '', 'é漢}', '\n}\t{', "\\\\", '},{"type":"Feature"}']


def collection(n, indent=None):
    rnd = random.Random(n)
    feats = []
    for i in range(n):
        x, y = rnd.random(), rnd.random()
        ring = [[x, y], [x + 1, y], [x + 1, y + 1], [x, y]]
        feats.append({"type": "Feature", "properties": {"ID": str(i), "CTYNAME": rnd.choice(ODD), "REG20": i, "odd": rnd.choice(ODD)},
                      "geometry": {"type": "Polygon", "coordinates": [ring]}})
    return json.dumps({"type": "FeatureCollection", "name": "{ } \"", "crs": {"type": "name", "properties": {"name": "x}"}},
                       "features": feats, "last": {"a": {}}}, indent=indent)


@pytest.fixture
def small_splits(spark):
    """Byte ranges of a few hundred bytes, as a large file would have."""
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1",
            "spark.sql.files.minPartitionNum": "64"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rows(df):
    return sorted(json.dumps(r.asDict(recursive=True), sort_keys=True) for r in df.collect())


@pytest.mark.parametrize("indent", [None, 2])
def test_one_file_of_200_features(spark, tmp_path, small_splits, indent):
    p = write(str(tmp_path / "f.geojson"), collection(200, indent))
    large = read_large_features(spark, p, PROPS)
    assert rows(large) == rows(read_features(spark, p, PROPS)) and large.count() == 200
    pieces = read_pieces(spark, p)
    assert pieces.rdd.getNumPartitions() > 1 and pieces.select("range").distinct().count() > 10
    assert pieces.groupBy(F.spark_partition_id()).count().count() > 1


def test_many_files(spark, tmp_path, small_splits):
    for n in (0, 1, 17, 40):
        write(str(tmp_path / f"d/{n}.geojson"), collection(n))
    p = str(tmp_path / "d")
    assert rows(read_large_features(spark, p, PROPS)) == rows(read_features(spark, p, PROPS))


def test_json_arrays(spark, tmp_path, small_splits):
    rnd = random.Random(3)
    data = [{"s": rnd.choice(ODD), "n": i, "o": {"x": {"y": rnd.choice(ODD)}}, "l": [{"z": i}, {"z": 1}]} for i in range(120)]
    schema = "s string, n long, o struct<x:struct<y:string>>, l array<struct<z:long>>"
    p = write(str(tmp_path / "a.json"), json.dumps(data))
    assert rows(read_large_json_array(spark, p, schema)) == rows(read_json_array(spark, p, schema))
    for text in ("[]", "", " \n"):
        assert read_large_json_array(spark, write(str(tmp_path / "e.json"), text), schema).count() == 0


def test_every_place_a_range_can_end(spark, tmp_path):
    """One small document under ranges of any length."""
    p = write(str(tmp_path / "a.json"), json.dumps([{"a": "}"}, {"b": {"c": "\\\"{"}}, {"d": []}]))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for n in (1, 2, 3, 5, 7, 11, 64):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
            got = sorted(r.record for r in json_records(spark, p, 0).collect())
            assert [json.loads(g) for g in got] == [{"a": "}"}, {"b": {"c": "\\\"{"}}, {"d": []}]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_cut_off_document(spark, tmp_path):
    p = write(str(tmp_path / "f.geojson"), collection(5)[:-160])
    assert [r.complete for r in json_records(spark, p, 1).collect()].count(False) == 1
    with pytest.raises(Exception, match="cut off by the end of"):
        read_large_features(spark, p, PROPS).collect()
