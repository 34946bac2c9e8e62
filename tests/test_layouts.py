"""J5-J7 over bucketed tables, P5/L1 over a lookup layout."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ballotlake.plans import people as P
from ballotlake.plans import standins as S
from ballotlake.sinks import write_bucketed, write_for_lookup

SF = "/root/testdata/sf0.01"


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture
def no_broadcast(spark):
    """As between two large tables."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_joins_without_exchange(spark, tmp_path, no_broadcast):
    profiles, history = S.profiles(spark, SF), S.history(spark, SF)
    p = write_bucketed(profiles, "layout_profiles", "id", 8, str(tmp_path / "p"))
    h = write_bucketed(history, "layout_history", "id", 8, str(tmp_path / "h"))
    try:
        for f in (P.with_last_voted, P.participation_summary, lambda a, b: P.last_voted(b),
                  lambda a, b: a.join(b, "id", "left")):
            flat, laid = f(profiles, history), f(p, h)
            plan = laid._jdf.queryExecution().executedPlan().toString()
            assert not re.search(r"\b(Shuffle|Broadcast)?Exchange\b", plan), plan
            assert "Exchange" in flat._jdf.queryExecution().executedPlan().toString()
            assert rows(flat) == rows(laid)
        # A file per bucket, and another number of buckets needs an exchange again.
        assert len({r[0] for r in p.select(F.input_file_name()).distinct().collect()}) <= 8
    finally:
        spark.sql("DROP TABLE layout_profiles")
        spark.sql("DROP TABLE layout_history")


def _rows_read(df):
    """Rows that the scan handed on, by Spark's own metric."""
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().executedPlan()
        plan.executeCollect()
        leaf = plan.collectLeaves().head()
        return leaf.metrics().apply("numOutputRows").value()
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")


def test_lookup_skips_files(spark, tmp_path):
    rnd = random.Random(8)
    last = [f"Name{i}" for i in range(800)]
    data = [(i, rnd.choice(last) if i % 3 else "Smith", f"F{rnd.randrange(300)}", f"C{rnd.randrange(40)}") for i in range(64_000)]
    df = spark.createDataFrame(data, "id int, lastName string, firstName string, city string")
    laid = write_for_lookup(df, str(tmp_path / "l"), ["lastName", "firstName", "city", "id"], 64,
                            bloom=["lastName", "firstName", "city"])
    files = laid.select(F.input_file_name()).distinct().count()
    assert files >= 60
    for name, first, city in (data[1][1:], data[3][1:], ("Smith", "F7", "C9"), ("Nobody", "F1", "C1")):
        who = {"lastName": name, "firstName": first, "city": city}
        found = P.find_profile(laid, who, limit=1000)
        assert rows(found) == rows(P.find_profile(df, who, limit=1000))
        assert _rows_read(found) <= 64_000 * 5 / 64                 # five files of 64 at most
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "EqualTo(lastName," in plan
    # A name inside every file's range, which dictionaries and Bloom filters rule out.
    assert _rows_read(P.find_profile(laid, {"firstName": "F150x"})) == 0
