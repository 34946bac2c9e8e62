"""Writers and readers round trips."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from ballotlake.sinks import persisted, write_csv, write_json_lines, write_parquet, write_split_by
from ballotlake.sources import read_json_array, read_parquet


def test_json_array_reader(spark, tmp_path):
    p = tmp_path / "summary.json"
    p.write_text('[{"county":"A","n":1},{"county":"B","n":2,"s":"x"}]')
    back = read_json_array(spark, str(p), "county string, n int, s string")
    assert sorted(map(tuple, back.collect())) == [("A", 1, None), ("B", 2, "x")]


def test_partitioned_parquet_append_with_drift(spark, tmp_path):
    out = str(tmp_path / "hist.parquet")
    a = spark.createDataFrame([(1, dt.date(2020, 11, 3), "D")], "id int, election date, party string")
    b = spark.createDataFrame([(2, dt.date(2024, 5, 21), "R", "S1")], "id int, election date, party string, "
                                                                        "ballotStyle string")
    write_parquet(a, out, ["election"])
    write_parquet(b, out, ["election"], mode="append")
    back = read_parquet(spark, out)
    assert set(back.columns) == {"id", "party", "ballotStyle", "election"}
    pruned = back.filter(F.col("election") == dt.date(2024, 5, 21))
    assert pruned.count() == 1
    assert "PartitionFilters: [isnotnull(election" in pruned._jdf.queryExecution().executedPlan().toString()


def test_json_csv_split(spark, tmp_path):
    df = spark.createDataFrame([("A", 1), ("B", 2), ("A", 3)], "county string, n int")
    write_json_lines(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 3
    write_csv(df, str(tmp_path / "c"))
    firsts = {open(f).readline().strip() for f in glob.glob(str(tmp_path / "c/part-*.csv"))} - {""}
    assert firsts == {'"county","n"'}
    write_split_by(df, str(tmp_path / "s"), "county")
    assert sorted(x for x in os.listdir(str(tmp_path / "s")) if x.startswith("county=")) == ["county=A", "county=B"]
    with persisted(df) as p:
        assert p.count() == 3 and p.is_cached
    assert not df.is_cached


def test_refresh_replaces_only_its_elections(spark, tmp_path):
    from ballotlake.plans.people import HISTORY_SCHEMA, refresh_history
    out = str(tmp_path / "history")

    def history(*rows):
        return spark.createDataFrame([(i, "c", e, 1, None, p, None, True, False, False) for i, e, p in rows], HISTORY_SCHEMA)

    a, b = dt.date(2020, 11, 3), dt.date(2022, 5, 24)
    refresh_history(history((1, a, "D"), (2, a, "R")), out)
    refresh_history(history((1, b, "D")), out)
    once = sorted((r.id, r.election, r.party) for r in read_parquet(spark, out).collect())
    refresh_history(history((1, b, "D")), out)                               # a rerun doubles nothing
    assert sorted((r.id, r.election, r.party) for r in read_parquet(spark, out).collect()) == once
    refresh_history(history((1, b, "NP"), (7, b, "R")), out)                  # a correction leaves the others
    got = sorted((r.id, r.election, r.party) for r in read_parquet(spark, out).collect())
    assert got == [(1, a, "D"), (1, b, "NP"), (2, a, "R"), (7, b, "R")]


def test_refresh_refuses_drift_by_name(spark, tmp_path):
    import pytest
    from ballotlake.plans.people import HISTORY_SCHEMA, refresh_history
    from ballotlake.sinks import refresh_parquet
    out = str(tmp_path / "history")
    empty = spark.createDataFrame([], HISTORY_SCHEMA)
    with pytest.raises(ValueError, match="missing column party string; unexpected column Party string"):
        refresh_history(empty.withColumnRenamed("party", "Party__").withColumnRenamed("Party__", "Party"), out)
    with pytest.raises(ValueError, match="column id is bigint, not int"):
        refresh_history(empty.withColumn("id", F.col("id").cast("long")), out)
    # Without a declared contract the stored dataset is it.
    df = spark.createDataFrame([(1, "x", "A")], "n int, s string, k string")
    refresh_parquet(df, out + "2", ["k"])
    refresh_parquet(df.select("k", "s", "n"), out + "2", ["k"])
    with pytest.raises(ValueError, match="unexpected column t int"):
        refresh_parquet(df.withColumn("t", F.lit(1)), out + "2", ["k"])
    assert [tuple(r) for r in read_parquet(spark, out + "2").collect()] == [(1, "x", "A")]
