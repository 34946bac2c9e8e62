"""P15 in the readers: rows + rejects = records."""

import pytest
from pyspark.sql import functions as F

from ballotlake.sources.rejects import count_records, parse_records, read_records, rejects_of, rows_of
from tests.conftest import write


def split(parsed, text="value"):
    return ([tuple(r) for r in rows_of(parsed).collect()], sorted((tuple(r) for r in rejects_of(parsed, text).collect()), key=repr))


@pytest.mark.parametrize("fmt,good,bad", [
    ("csv", ["1,a", '2,"b, c"', "3,"], ["x,a", "1", "1,a,b", ""]),
    ("json", ['{"n":1,"s":"a"}', '{"n":2}', "{}"], ['{"n":"x"}', '{"n":1', "nothing"]),
    ("xml", ["<r><n>1</n><s>a</s></r>", "<r><n>2</n></r>"], ["<r><n>1</n>", "<r><n>x</n></r>"])])
def test_formats(spark, fmt, good, bad):
    df = spark.createDataFrame([(t,) for t in [*good, *bad, None]], "value string")
    parsed = parse_records(df, "value", "n int, s string", fmt)
    rows, rejects = split(parsed)
    assert len(rows) == len(good) and len(rejects) == len(bad) + 1
    assert {r for _, r in rejects} == {f"malformed {fmt}", "no text"}
    assert {t for t, _ in rejects} == {*bad, None}


def test_checks_in_order(spark):
    df = spark.createDataFrame([(t,) for t in ("1,a", "-1,", ",a", "5,")], "value string")
    parsed = parse_records(df, "value", "n int, s string", "csv", checks=[
        ("no number", F.col("r.n").isNull()), ("negative", F.col("r.n") < 0), ("no text field", F.col("r.s").isNull())])
    rows, rejects = split(parsed)
    assert rows == [(1, "a")] and rejects == [(",a", "no number"), ("-1,", "negative"), ("5,", "no text field")]
    counts = {r.reason: r.records for r in count_records(parsed).collect()}
    assert counts == {"accepted": 1, "no number": 1, "negative": 1, "no text field": 1}


def test_files_with_headers(spark, tmp_path):
    write(str(tmp_path / "d/a.csv"), 'n,s\n1,a\nx,b\n')
    write(str(tmp_path / "d/b.csv"), '"n","s"\n2,c\n')
    parsed = read_records(spark, str(tmp_path / "d"), "n int, s string", "csv", header=True)
    rows, rejects = split(parsed)
    assert sorted(rows) == [(1, "a"), (2, "c")] and rejects == [("x,b", "malformed csv")]


def test_registered_queries_count_every_record(spark):
    from ballotlake.plans.catalog import QUERIES
    d = "/root/testdata/sf0.001"
    n = spark.read.parquet(d + "/orders.parquet").count()
    assert QUERIES["history_rows_and_rejects"](spark, d).count() == n
    assert QUERIES["history_record_counts"](spark, d).agg(F.sum("records")).first()[0] == n
