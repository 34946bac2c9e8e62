"""Profiles and history (fixtures T6, T7a, T7b, T8; traps B6, B7, B8, B19)."""

import datetime as dt

from pyspark.sql import functions as F

from ballotlake.plans import people as P
from ballotlake.sources import read_history_new, read_history_old, read_profile_sources
from tests.conftest import write

# Header deliberately differs from the schema (County vs CountyName); an extra
# trailing column; a non-numeric id. All people are invented.
HDR = "County,Voter Registration #,Last Name,First Name,Middle Name,Suffix,Street #,Street Name,Apt/Unit,City,State,Zip Code,Extra\n"


def _profiles(spark, tmp_path):
    write(str(tmp_path / "2020/data/a.csv"), HDR +
          "FULTON,1,OLDNAME,ANN,,,1,MAIN ST,,ATLANTA,GA,30301,x\n"
          "COBB,2,DOE,JOHN,Q,,5,ELM ST,,MARIETTA,GA,30060,x\n")
    write(str(tmp_path / "2022/data/a.csv"), HDR +
          "FULTON,1,MC DONALD-SMITH,ANN,,,1,MAIN ST,,ATLANTA,GA,30301,x\n"
          "FULTON,abc,NOID,NOBODY,,,9,OAK ST,,ATLANTA,GA,30301,x\n")
    write(str(tmp_path / "2024/data/a.csv"), HDR +
          "DEKALB,1,NEWNAME,ANN,,,7,PINE ST,,DECATUR,GA,30030,x\n"
          "COBB,3,TIE,TOM,,,2,ELM ST,,MARIETTA,GA,30060,x\n"
          "COBB,3,TIE,THOMAS,,,2,ELM ST,,MARIETTA,GA,30060,x\n")
    srcs = [(str(tmp_path / y / "data"), float(y)) for y in ("2020", "2022", "2024")]
    return read_profile_sources(spark, srcs)


def test_positional_read_and_tags(spark, tmp_path):
    df = _profiles(spark, tmp_path)
    assert "Extra" not in df.columns and "CountyName" in df.columns
    rows = df.collect()
    assert len(rows) == 7
    assert {r.absenteeDataYear for r in rows} == {2020.0, 2022.0, 2024.0}
    assert sum(r["Voter Registration #"] is None for r in rows) == 1


def test_latest_profiles_ties_and_title_case(spark, tmp_path):
    latest = P.latest_profiles(_profiles(spark, tmp_path))
    by_id = {}
    for r in latest.collect():
        by_id.setdefault(r.id, []).append(r)
    assert None not in by_id                                   # null id dropped
    assert [r.lastName for r in by_id[1]] == ["Newname"] and by_id[1][0].countyCurrent == "Dekalb"
    assert sorted(r.firstName for r in by_id[3]) == ["Thomas", "Tom"]   # tie kept (B7)
    one = P.latest_profiles(_profiles(spark, tmp_path), one_per_id=True, tiebreak=["firstName"])
    assert one.filter(F.col("id") == 3).count() == 1
    assert spark.createDataFrame([("MC DONALD-SMITH",)], "s string").select(F.initcap("s")).first()[0] == \
        "Mc Donald-smith"


def _history(spark, tmp_path):
    old = write(str(tmp_path / "h/old.csv"),
                "County Number,Registration Number,Election Date,Election Type,Party,Absentee,Provisional,Supplemental\n"
                "60,1,20201103,1,D,Y,N,\n"
                "60,1,20220524,2,NP,N,,N\n"
                "33,2,20201103,1,R,,Y,Y\n")
    new = write(str(tmp_path / "h/new.csv"),
                "County Name,Voter Registration Number,Election Date,Election Type,Party,Ballot Style,Absentee,Provisional,Supplemental\n"
                "FULTON,1,05/21/2024,PRIMARY,NON-PARTISAN,S1,Y,Y,N\n"
                "COBB,2,05/21/2024,PRIMARY,REPUBLICAN,S2,N,N,N\n"
                "COBB,2,11/05/2024,GENERAL,,S2,N,N,N\n")
    return P.normalise_history(read_history_old(spark, old), read_history_new(spark, new))


def test_history_normalised(spark, tmp_path):
    h = _history(spark, tmp_path)
    assert tuple(h.columns) == P.HISTORY_COLUMNS
    rows = {(r.id, r.election): r for r in h.collect()}
    assert rows[(1, dt.date(2020, 11, 3))].absentee is True
    assert rows[(1, dt.date(2022, 5, 24))].provisional is False          # blank flag -> false
    assert rows[(1, dt.date(2024, 5, 21))].party == "NP"                 # B19
    assert rows[(2, dt.date(2024, 11, 5))].party == ""


def test_participation(spark, tmp_path):
    prof = P.latest_profiles(_profiles(spark, tmp_path))
    s = {r.id: r for r in P.participation_summary(prof, _history(spark, tmp_path)).collect()}
    assert s[1].totalElections == 3 and s[1].primaryElectionsNP == 2 and s[1].primaryElectionsD == 1
    assert s[1].inPerson == 3 - 2 - 1 - 0                                  # B8: overlapping flags
    assert s[3].totalElections == 0 and s[3].inPerson == 0                 # B6: no history -> zeros
    assert s[2].lastElection == dt.date(2024, 11, 5)
    assert P.recent_voters(P.participation_summary(prof, _history(spark, tmp_path)), "2024-06-01") \
        .select("id").collect()[0].id == 2
    mean = P.mean_participation(P.participation_summary(prof, _history(spark, tmp_path))).first()[0]
    assert abs(mean - 6 / 3) < 1e-12


def test_nested_history_and_directory(spark, tmp_path):
    prof = P.latest_profiles(_profiles(spark, tmp_path))
    h = _history(spark, tmp_path)
    nh = P.nested_history(prof.filter(F.col("id") != 3), h).collect()
    for r in nh:
        days = [x.election for x in r.voterHistory or []]
        assert days == sorted(days) and {x.year for x in days} <= {r.part}
    assert sum(len(r.voterHistory) for r in nh if r.id == 2) == 3
    d = P.street_directory(prof, h)
    rows = d.collect()
    # every voter appears exactly once although groups were split into parts
    ids = sorted(v.id for r in rows for v in r.voters)
    assert ids == sorted(r.id for r in prof.collect())


def test_catalogue_and_search(spark, tmp_path):
    h = _history(spark, tmp_path)
    codes = spark.createDataFrame([(1, "General"), (7, "Unused")], "electionType int, electionTypeName string")
    cat = {r.election: r for r in P.election_catalogue(h, codes).collect()}
    assert cat[dt.date(2020, 11, 3)].voters == 2 and cat[dt.date(2020, 11, 3)].electionTypeName == "General"
    assert cat[dt.date(2022, 5, 24)].electionTypeName is None
    prof = P.latest_profiles(_profiles(spark, tmp_path))
    hit = P.find_profile(prof, {"lastName": "Tie", "city": "Marietta"}).collect()
    assert [r.firstName for r in hit] in (["Tom", "Thomas"], ["Thomas", "Tom"])


def test_profile_source_tags_with_globs(spark, tmp_path):
    write(str(tmp_path / "absentee/2022/data/a.csv"), HDR + "FULTON,1,A,B,,,1,X,,Y,GA,1,x\n")
    write(str(tmp_path / "absentee/2022_runoff/data/a.csv"), HDR + "FULTON,2,A,B,,,1,X,,Y,GA,1,x\n")
    srcs = [(str(tmp_path / "absentee/2022/data/*.csv"), 2022.0),
            (str(tmp_path / "absentee/2022_runoff/data/*.csv"), 2022.1)]
    got = {r["Voter Registration #"]: r.absenteeDataYear for r in read_profile_sources(spark, srcs).collect()}
    assert got == {1: 2022.0, 2: 2022.1}


def test_profile_source_tags_in_odd_folders(spark, tmp_path):
    row = HDR + "FULTON,{},A,B,,,1,X,,Y,GA,1,x\n"
    write(str(tmp_path / "y 2024+a/a.csv"), row.format(1))
    write(str(tmp_path / "y 2022/a.csv"), row.format(2))
    srcs = [(str(tmp_path / "y 2022"), 2022.0), (str(tmp_path / "y 2024+a/*.csv"), 2024.0)]
    got = {r["Voter Registration #"]: r.absenteeDataYear for r in read_profile_sources(spark, srcs).collect()}
    assert got == {1: 2024.0, 2: 2022.0}


def test_union_tagged_drift(spark):
    a = spark.createDataFrame([(1, "x", 2.5)], "id int, city string, price double")
    b = spark.createDataFrame([(2, "y")], "id int, city string")
    u = P.union_tagged([(a, 2022.0), (b, 2024.1)], "absenteeDataYear")
    got = sorted(map(tuple, u.select("id", "city", "price", "absenteeDataYear").collect()))
    assert got == [(1, "x", 2.5, 2022.0), (2, "y", None, 2024.1)]
    plan = u._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan                     # a union of scans, no shuffle
