"""XML / JSON feeds and fixed width (fixtures T12-T15; P15, A18, B17)."""

import json

from pyspark.sql import functions as F

from ballotlake.plans.feeds import results_from_feed_a, results_from_feed_b, results_from_xml
from ballotlake.plans.people import normalise_history_old
from ballotlake.sources.fixed_width import read_fixed_width, type_history_old
from tests.conftest import write

XML = """<?xml version="1.0"?>
<ElectionResult>
  <Region>Fulton</Region>
  <Contest text="US Senate Special Election/Loeffler">
    <Choice text="Kelly Loeffler (Rep)">
      <VoteType name="Election Day Votes">
        <Precinct name="P1" votes="10"/>
        <Precinct name="P2" votes="0"/>
      </VoteType>
    </Choice>
    <Choice text="Raphael Warnock (Dem)">
      <VoteType name="Election Day Votes"><Precinct name="P1" votes="12"/></VoteType>
      <VoteType name="Absentee by Mail Votes"><Precinct name="P1" votes="3"/></VoteType>
    </Choice>
    <Choice text="Write-in"></Choice>
    <VoteType name="Undervotes"><Precinct name="P1" votes="2"/></VoteType>
  </Contest>
  <Contest text="Governor">
    <VoteType name="Undervotes"><Precinct name="P1" votes="1"/></VoteType>
  </Contest>
  <Contest text="County Sheriff">
    <Choice text="Someone"><VoteType name="Election Day Votes"><Precinct name="P1" votes="5"/></VoteType></Choice>
    <VoteType name="Undervotes"><Precinct name="P1" votes="1"/></VoteType>
  </Contest>
</ElectionResult>
"""


def test_xml_feed(spark, tmp_path):
    p = write(str(tmp_path / "x/fulton.xml"), XML)
    rows, rejects = results_from_xml(spark, p)
    got = sorted((r.race, r.county, r.precinct, r.candidate, r.party, r.mode, r.votes) for r in rows.collect())
    assert got == sorted([
        ("US Senate Special", "Fulton", "P1", "Kelly Loeffler (Rep)", "republican", "Election Day Votes", 10),
        ("US Senate Special", "Fulton", "P1", "Raphael Warnock (Dem)", "democratic", "Election Day Votes", 12),
        ("US Senate Special", "Fulton", "P1", "Raphael Warnock (Dem)", "democratic", "Absentee by Mail Votes", 3),
        ("US Senate Special", "Fulton", "P1", "Under/Over Votes", "other", "Absentee by Mail Votes", 2),
    ])
    rj = sorted((r.race, r.candidate, r.reason) for r in rejects.collect())
    assert rj == [("Governor", None, "no choices"), ("US Senate Special", "Write-in", "no vote types")]


def test_feed_a(spark, tmp_path):
    summary = [{"K": "11", "C": "President of the United States/x", "CH": ["Joe Biden", "Donald Trump"]},
               {"K": "12", "C": "County Clerk", "CH": ["A"]}]
    root, manifest = str(tmp_path / "a"), _manifest(spark, ("Cobb", "7", "1"))
    write(f"{root}/Cobb/7/1/json/en/summary.json", json.dumps(summary))
    ed = {"Contests": [{"A": "-1", "C": ["11"], "V": [[100, 90]]},
                       {"A": "P1", "C": ["11", "12", "99"], "V": [[5, 0], [7], [1]]}]}
    write(f"{root}/Cobb/7/1/json/Election_Day_Votes.json", json.dumps(ed))
    out, report = results_from_feed_a(spark, root, manifest)
    got = [(r.race, r.county, r.precinct, r.candidate, r.party, r.mode, r.votes) for r in out.collect()]
    assert got == [("President of the United States", "Cobb", "P1", "Joe Biden", "democratic",
                    "Election Day Votes", 5)]
    assert report.count() == 0


def _manifest(spark, *rows):
    return spark.createDataFrame(list(rows), "county string, countyElectionId string, version string")


def test_feed_a_of_many_counties(spark, tmp_path):
    """Contest ids mean another contest, and candidate lists another order, in
    each county; old versions and counties outside the manifest don't count."""
    root = str(tmp_path / "a")

    def land(folder, text, choices, votes, mode="Election_Day_Votes"):
        write(f"{root}/{folder}/json/en/summary.json", json.dumps([{"K": "1", "C": text, "CH": choices}]))
        write(f"{root}/{folder}/json/{mode}.json", json.dumps({"Contests": [{"A": "P1", "C": ["1"], "V": [votes]}]}))

    land("Cobb/7/2", "Governor", ["Kemp", "Abrams"], [5, 6])
    land("Cobb/7/1", "Governor", ["Kemp", "Abrams"], [50, 60])
    land("Jeff Davis/8/4", "US Senate", ["Warnock", "Walker"], [7, 8], "Provisional_Votes")
    land("Ware/9/1", "County Clerk", ["Kemp", "B"], [1, 2])
    land("Left/3/1", "Governor", ["Kemp"], [9])
    write(f"{root}/Half/5/1/json/en/summary.json", "[]")
    manifest = _manifest(spark, ("Cobb", "7", "2"), ("Cobb", "7", "2"), ("Jeff Davis", "8", "4"), ("Ware", "9", "1"),
                         ("Half", "5", "1"), ("Gone", "6", "1"))
    out, report = results_from_feed_a(spark, root, manifest)
    assert sorted((r.race, r.county, r.candidate, r.party, r.mode, r.votes) for r in out.collect()) == [
        ("Governor", "Cobb", "Abrams", "democratic", "Election Day Votes", 6),
        ("Governor", "Cobb", "Kemp", "republican", "Election Day Votes", 5),
        ("US Senate", "Jeff Davis", "Walker", "republican", "Provisional Votes", 8),
        ("US Senate", "Jeff Davis", "Warnock", "democratic", "Provisional Votes", 7)]
    assert sorted((r.county, r.version, r.problem) for r in report.collect()) == [
        ("Cobb", "1", "modes not in manifest"), ("Cobb", "1", "summary not in manifest"), ("Gone", "1", "no modes"),
        ("Gone", "1", "no summary"), ("Half", "1", "no modes"), ("Half", "1", "no summary"),
        ("Left", "1", "modes not in manifest"), ("Left", "1", "summary not in manifest")]


def test_path_of_another_form_fails_by_name(spark):
    import pytest
    from ballotlake.sources.feeds import path_columns
    df = spark.createDataFrame([("file:/x/a+b/c%20d/e.json",)], "path string")
    assert path_columns(df, "{one}/{two}/{three}.json", "path").first()[1:] == ("a+b", "c d", "e")
    with pytest.raises(Exception, match="not a q/{two}.json file: file:/x/a"):
        path_columns(df, "q/{two}.json", "path").collect()


LOCALITIES = "locality string, county string"


def _opt(name, party, total, groups):
    return {"name": [{"text": name}], "party": {"name": [{"text": party}]}, "voteCount": total,
            "groupResults": [{"groupName": [{"text": g}], "voteCount": v} for g, v in groups]}


def test_feed_b(spark, tmp_path):
    doc = {"breakdownResults": [{"precinct": {"name": [{"text": "P1"}]}, "ballotOptions": [
        _opt("Ann (Dem)", "", 9, [("Election Day", 0), ("Absentee by Mail", 0)]),
        _opt("Bob", "REPUBLICAN", 7, [("Election Day", 4), ("Advanced Voting", 3), ("Provisional", 0)]),
        _opt("Cy", "LIB", 0, [("Election Day", 0)]),
    ]}]}
    root = str(tmp_path / "b")
    write(f"{root}/fulton/E1/ballot-items.json", json.dumps({"data": [{"id": 4, "name": [{"text": "US Senate"}]}]}))
    write(f"{root}/fulton/E1/ballot-items/4.json", json.dumps(doc))
    out, report = results_from_feed_b(spark, root, spark.createDataFrame([("fulton", "Fulton")], LOCALITIES), ["US Senate"])
    assert report.count() == 0
    got = sorted((r.county, r.candidate, r.party, r.mode, r.votes) for r in out.collect())
    assert got == [("Fulton", "Ann (Dem)", "democratic", "Unknown", 9),
                   ("Fulton", "Bob", "republican", "Advance Voting Votes", 3),
                   ("Fulton", "Bob", "republican", "Election Day Votes", 4)]


def test_feed_b_of_many_localities(spark, tmp_path):
    """Contest id 4 is another contest in each locality; the contest of a
    phrase is the first of the locality's own list."""
    from ballotlake.plans.feeds import locality_records
    from ballotlake.sources.feeds import LOCALITIES_SCHEMA
    root = str(tmp_path / "b")

    def land(slug, items, **docs):
        write(f"{root}/{slug}/E1/ballot-items.json", json.dumps(
            {"data": [{"id": i, "name": [{"text": t}]} for i, t in items]}))
        for i, votes in docs.items():
            write(f"{root}/{slug}/E1/ballot-items/{i[1:]}.json", json.dumps({"breakdownResults": [{
                "precinct": {"name": [{"text": "P1"}]}, "ballotOptions": [_opt("Ann", "DEM", votes, [])]}]}))

    land("cobb", [(4, "US Senate"), (5, "Governor"), (6, "US Senate Special")], c4=11, c5=12, c6=13)
    land("ware", [(4, "Governor"), (5, "US Senate runoff")], c4=21)
    land("left", [(4, "Governor")], c4=31)
    p = write(str(tmp_path / "m.json"), json.dumps({"childLocalities": [
        {"shortName": s, "name": [{"text": n}]} for s, n in (("cobb", "Cobb County"), ("ware", "Ware County"), ("gone", "Gone"))]}))
    local = locality_records(spark.read.schema(LOCALITIES_SCHEMA).json(p))
    out, report = results_from_feed_b(spark, root, local, ["US Senate", "Governor"])
    assert sorted((r.race, r.county, r.votes) for r in out.collect()) == [
        ("Governor", "Cobb", 12), ("Governor", "Ware", 21), ("US Senate", "Cobb", 11)]
    assert sorted(tuple(r) for r in report.collect()) == [
        ("gone", "Governor", "no contest"), ("gone", "US Senate", "no contest"), ("ware", "US Senate", "no document")]


def test_fixed_width(spark, tmp_path):
    # widths 3 8 8 3 2 1 1 1
    lines = ["060" "00001234" "20201103" "001" "D " "Y" "N" "Y",
             "060" "00001234" "20220524" "002" "  " "N" "N" "N",
             "001" "00000099" "20220524" "000" "NP" "Y" " " " "]
    p = write(str(tmp_path / "fw/h.txt"), "\n".join(lines) + "\n")
    h = normalise_history_old(type_history_old(read_fixed_width(spark, p)))
    rows = sorted(map(tuple, h.select("id", "county", "election", "electionTypeCode", "party", "absentee",
                                      "provisional").collect()), key=lambda r: (r[0], r[2]))
    assert [r[0] for r in rows] == [99, 1234, 1234]
    assert {r[4] for r in rows} == {"D", "", "NP"}
    assert [r for r in rows if r[0] == 99][0][1] == "1"             # leading zeros dropped by the int


def test_relevant_contests(spark, tmp_path):
    from ballotlake.plans.feeds import ballot_items, relevant_contests
    docs = [{"locality": "fulton", "data": [{"id": 5, "name": [{"text": "Governor"}]},
                                          {"id": 9, "name": [{"text": "US Senate"}]},
                                          {"id": 3, "name": [{"text": "US Senate Special"}]}]},
            {"locality": "cobb", "data": [{"id": 1, "name": [{"text": "Mayor"}]}]}]
    p = write(str(tmp_path / "items.json"), "\n".join(json.dumps(d) for d in docs) + "\n")
    items = ballot_items(spark.read.schema("locality string, data array<struct<id:long, name:array<struct<text:string>>>>")
                         .json(p))
    got = [(r.locality, r.contestId, r.name) for r in relevant_contests(items, ["US Senate"]).collect()]
    assert got == [("fulton", "9", "US Senate")]


def test_feed_a_mode_labels(spark, tmp_path):
    root, manifest = str(tmp_path / "a"), _manifest(spark, ("Cobb", "7", "1"))
    write(f"{root}/Cobb/7/1/json/en/summary.json", json.dumps([{"K": "1", "C": "Governor", "CH": ["Kemp"]}]))
    write(f"{root}/Cobb/7/1/json/Advanced_Voting_Votes.json", json.dumps({"Contests": [{"A": "P", "C": ["1"], "V": [[4]]}]}))
    out, _ = results_from_feed_a(spark, root, manifest)
    assert [r.mode for r in out.collect()] == ["Advanced Voting Votes"]
    out2, _ = results_from_feed_a(spark, root, manifest, mode_labels=[("Advanced Voting Votes", "Advance Voting Votes")])
    assert [(r.mode, r.party) for r in out2.collect()] == [("Advance Voting Votes", "republican")]


def test_county_manifests(spark, tmp_path):
    from ballotlake.plans.feeds import manifest_parallel, manifest_records
    a = spark.createDataFrame([(["Appling|105369|270957|x", "Ben Hill|105370|270958"],)],
                              "participatingcounties array<string>")
    assert [tuple(r) for r in manifest_records(a).collect()] == [("Appling", "105369", "270957"),
                                                                 ("Ben Hill", "105370", "270958")]
    b = spark.createDataFrame([([11, 12], ["Jeff Davis County", "Cobb"])], "Eid array<long>, P array<string>")
    assert [(r.pos, r.county, r.countyElectionId) for r in manifest_parallel(b).collect()] == \
        [(0, "Jeff_Davis County", "11"), (1, "Cobb", "12")]
