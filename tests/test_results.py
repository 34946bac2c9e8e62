"""Results pivot and nesting (fixture T2; traps B2, B3, B4)."""

from pyspark.sql import functions as F

from ballotlake.plans.results import (candidate_totals, cleanse_results, county_totals, results_by_mode,
                                      summarize_results)
from ballotlake.sources import read_results
from tests.conftest import write

T2 = """race,county,precinct,candidate,party,mode,votes
Senate,Fulton,Alpha,Ann,democratic,Election Day Votes,10
Senate,Fulton,Alpha,Bob,republican,Election Day Votes,7
Senate,Fulton,Alpha,Cy,other,Election Day Votes,1
Senate,Fulton,Alpha,Lib,LIB,Election Day Votes,2
Senate,fulton,Alpha,Unk,unknown,Absentee by Mail Votes,3
Senate,Fulton,Alpha,Under/Over Votes,other,Absentee by Mail Votes,50
Senate,Fulton,Alpha,,democratic,Absentee by Mail Votes,4
Senate,Fulton,Beta,Ann,democratic,Election Day Votes,5
Governor,Cobb,Gamma,Gil,republican,Election Day Votes,9
"""
MAP = [("FULTON", "Alpha", "A-1"), ("COBB", "Gamma", "G-1")]


def _base(spark, tmp_path, **kw):
    p = write(str(tmp_path / "r.csv"), T2)
    m = spark.createDataFrame(MAP, "county string, electionResultsPrecinctName string, precinct string")
    return read_results(spark, p), cleanse_results(read_results(spark, p), m, **kw)


def test_pivot_fold_and_filters(spark, tmp_path):
    _, base = _base(spark, tmp_path)
    rows = {(r.race, r.county, r.precinct, r.mode): (r.democratic, r.republican, r.other) for r in base.collect()}
    # LIB folded into other; unknown (absentee) into other; Under/Over gone; null candidate kept
    assert rows[("Senate", "FULTON", "A-1", "Election Day Votes")] == (10, 7, 3)
    assert rows[("Senate", "FULTON", "A-1", "Absentee by Mail Votes")] == (4, None, 3)
    assert rows[("Senate", "FULTON", None, "Election Day Votes")] == (5, None, None)   # B4 unmatched


def test_reference_parity_flags(spark, tmp_path):
    _, base = _base(spark, tmp_path, fold_into=None, drop_null_candidates=True)
    r = base.filter((F.col("precinct") == "A-1") & (F.col("mode") == "Absentee by Mail Votes")).collect()
    assert r[0].democratic is None and r[0].other is None


def test_levels_agree_and_null_group_survives(spark, tmp_path):
    _, base = _base(spark, tmp_path)
    tot = lambda df: df.agg(*[F.sum(c).alias(c) for c in ("democratic", "republican", "other")]).first()  # noqa
    a = tot(results_by_mode(base, ["county", "precinct"]))
    b = tot(results_by_mode(base, ["county"]))
    c = tot(results_by_mode(base, []))
    assert a == b == c
    out = summarize_results(read_results(spark, str(tmp_path / "r.csv")),
                            spark.createDataFrame(MAP, "county string, electionResultsPrecinctName string, "
                                                  "precinct string"))
    pre = out["county_precinct"]
    assert pre.filter(F.col("precinct").isNull()).count() == 1
    st = out["statewide"].collect()[0].races
    assert [r.race for r in st] == ["Governor", "Senate"]
    assert st[1].democratic == 19 and [m.mode for m in st[1].resultsByMode] == \
        ["Absentee by Mail Votes", "Election Day Votes"]


def test_totals(spark, tmp_path):
    raw, _ = _base(spark, tmp_path)
    ct = {(r.race, r.candidate): r.votes for r in candidate_totals(raw).collect()}
    assert ct[("Senate", "Ann")] == 15
    cty = {r.county: r.votes for r in county_totals(raw, "Senate").collect()}
    assert cty == {"Fulton": 79, "fulton": 3}


def test_unmatched_report(spark, tmp_path):
    from ballotlake.plans.results import unmatched_precincts
    _, base = _base(spark, tmp_path)
    rows = [(r.county, r.electionResultsPrecinctName, r.democratic) for r in unmatched_precincts(base).collect()]
    assert rows == [("FULTON", "Beta", 5)]
