"""Lookup checks (B11) and left enrichment with an unmatched report."""

import pytest

from ballotlake.operators.enrich import assert_unique, duplicate_keys, first_per_key, left_enrich_with_report


def test_duplicate_map_keys(spark):
    m = spark.createDataFrame([("FULTON", "a", "1"), ("FULTON", "a", "2"), ("COBB", "b", "3")],
                              "county string, name string, precinct string")
    d = duplicate_keys(m, ["county", "name"]).collect()
    assert [(r.county, r.name, r.copies) for r in d] == [("FULTON", "a", 2)]
    with pytest.raises(ValueError):
        assert_unique(m, ["county", "name"])
    assert_unique(m, ["precinct"])
    one = {(r.county, r.name): r.precinct for r in first_per_key(m, ["county", "name"], "precinct").collect()}
    assert one == {("FULTON", "a"): "1", ("COBB", "b"): "3"}


def test_left_enrich_report(spark):
    df = spark.createDataFrame([("FULTON", "a", 5), ("COBB", "z", 7), (None, "a", 1)],
                               "county string, name string, votes int")
    m = spark.createDataFrame([("FULTON", "a", "P1")], "county string, name string, precinct string")
    out, miss = left_enrich_with_report(df, m, ["county", "name"])
    assert out.count() == 3
    assert sorted((r.county or "", r.votes) for r in miss.collect()) == [("", 1), ("COBB", 7)]
