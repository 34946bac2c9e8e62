"""Accepted ballots by day (fixture T1; traps B9, B10, B26)."""

import datetime as dt

from pyspark.sql import functions as F

from ballotlake.plans.ballots import cleanse_ballots, nested_by_day, rejected_dates, summarize_ballots, \
    ballots_all_levels, ballots_by_day
from ballotlake.sources import read_ballots
from tests.conftest import write

HEADER = "County,Voter Registration #,Last Name,Ballot Status,Ballot Return Date,County Precinct\n"
ROWS = [
    "benhill,1,Smith,A,10/01/2024,p1",
    "Ben Hill,2,SMITH,A,10/01/2024,P1",
    "BEN HILL,3,smith,A,10/02/2024,p1",
    "Ben Hill,4,Doe,R,10/02/2024,p1",       # not accepted
    "Fulton,5,Roe,A,,F1",                   # blank date
    "Fulton,6,Roe,A,13/45/2024,F1",         # bad date (B9)
    "Fulton,,Roe,A,10/03/2024,F1",          # null registration: not counted
    "Fulton,8,Roe,A,10/03/2024,F1",
    "jeffdavis,9,Poe,A,10/03/2024,J1",
]
DATE = "2024-11-05"


def _ballots(spark, tmp_path):
    d = tmp_path / "absentee"
    write(str(d / "a.csv"), HEADER + "\n".join(ROWS[:5]) + "\n")
    write(str(d / "b.csv"), HEADER + "\n".join(ROWS[5:]) + "\n")
    write(str(d / "STATEWIDE.csv"), HEADER + "\n".join(ROWS) + "\n")
    return read_ballots(spark, str(d / "*.csv"))


def test_statewide_file_skipped(spark, tmp_path):
    assert _ballots(spark, tmp_path).count() == len(ROWS)


def test_cleanse_counts_and_dates(spark, tmp_path):
    base = cleanse_ballots(_ballots(spark, tmp_path))
    got = {(r.county, r.precinct, r.DateDT): r.votesOnDate
           for r in base.groupBy("county", "precinct", "DateDT").agg(F.sum("votesOnDate").alias("votesOnDate"))
           .collect()}
    assert got[("BEN HILL", "P1", dt.date(2024, 10, 1))] == 2
    assert got[("BEN HILL", "P1", dt.date(2024, 10, 2))] == 1
    assert got[("JEFF DAVIS", "J1", dt.date(2024, 10, 3))] == 1
    assert got[("FULTON", "F1", dt.date(2024, 10, 3))] == 1      # null id not counted
    assert got[("FULTON", "F1", None)] == 2                       # blank + unparsable
    assert rejected_dates(base).count() == 1


def test_running_totals_nulls_first(spark, tmp_path):
    base = cleanse_ballots(_ballots(spark, tmp_path)).drop("_returned")
    state = ballots_by_day(base, DATE, {"statewide": ()})["statewide"].orderBy(F.col("DaysFromElection").asc_nulls_first())
    rows = state.collect()
    # the state window runs in one partition: its input is one row per day
    assert len(rows) == len({r.DateDT for r in rows})
    assert rows[0].DateDT is None and rows[0].votesToDate == 2   # undated ballots first (B10)
    assert [r.votesToDate for r in rows] == [2, 4, 5, 7]
    assert rows[-1].votesToDate == sum(r.votesOnDate for r in rows)
    assert rows[1].DaysFromElection == (dt.date(2024, 10, 1) - dt.date(2024, 11, 5)).days


def test_levels_agree_and_nested(spark, tmp_path):
    out = summarize_ballots(_ballots(spark, tmp_path), DATE)
    assert set(out) == {"county_precinct", "county", "statewide"}
    state = out["statewide"].collect()
    assert len(state) == 1
    days = state[0].votesByDay
    assert [d.DaysFromElection for d in days][0] is None          # sorted, nulls first
    county = out["county"].collect()
    total = sum(d.votesOnDate for r in county for d in r.votesByDay)
    assert total == sum(d.votesOnDate for d in days) == 7
    assert out["county_precinct"].schema["votesByDay"].dataType.elementType.fieldNames() == \
        ["DaysFromElection", "DateDT", "votesToDate", "votesOnDate"]


def test_grouping_sets_match_per_level(spark, tmp_path):
    base = cleanse_ballots(_ballots(spark, tmp_path)).drop("_returned")
    flat = ballots_all_levels(base, DATE)
    per = ballots_by_day(base, DATE)
    for name, df in per.items():
        a = sorted(map(tuple, flat.filter(F.col("level") == name).select("DateDT", "votesOnDate", "votesToDate")
                   .collect()), key=repr)
        b = sorted(map(tuple, df.select("DateDT", "votesOnDate", "votesToDate").collect()), key=repr)
        assert a == b, name


def test_id_map_left_join_keeps_unmatched(spark, tmp_path):
    m = spark.createDataFrame([("BEN HILL", "p1", "BH-01", 99.0)],
                              "county string, absenteePrecinct string, precinct string, score double")
    base = cleanse_ballots(_ballots(spark, tmp_path), id_map=m).drop("_returned")
    pre = {r.precinct for r in base.filter(F.col("county") == "BEN HILL").collect()}
    assert pre == {"BH-01", None}            # 'P1' (upper) spelling had no map row
    nested = nested_by_day(ballots_by_day(base, DATE, {"county_precinct": ("county", "precinct")})["county_precinct"],
                           ["county", "precinct"])
    assert nested.filter(F.col("precinct").isNull()).count() >= 1


def test_undated_report(spark, tmp_path):
    from ballotlake.plans.ballots import undated_ballots
    base = cleanse_ballots(_ballots(spark, tmp_path))
    assert {(r.county, r.undatedBallots) for r in undated_ballots(base).collect()} == {("FULTON", 2)}
