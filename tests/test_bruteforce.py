"""C1 and C2 against plain-Python brute force on random inputs."""

import collections
import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ballotlake.plans.ballots import BallotColumns, ballots_by_day, cleanse_ballots
from ballotlake.plans.results import cleanse_results, results_by_mode

COLS = BallotColumns(county="c", precinct="p", status="s", returned="d", voter_id="v", accepted="A",
                     date_format="MM/dd/yyyy")
ANCHOR = dt.date(2024, 11, 5)

ballot = st.tuples(st.sampled_from(["fulton", "Fulton", "COBB", "benhill co"]),
                   st.sampled_from(["p1", "P2"]), st.sampled_from(["A", "R"]),
                   st.one_of(st.none(), st.dates(dt.date(2024, 10, 1), dt.date(2024, 10, 6))),
                   st.one_of(st.none(), st.integers(1, 9)))


def _expected(rows, level):
    per = collections.Counter()
    for c, p, s, d, v in rows:
        if s != "A" or v is None:
            continue
        cu = c.upper()
        cu = "BEN HILL" if cu.startswith("BENHILL") else cu
        key = {"county": cu, "precinct": p.upper()}
        per[(tuple(key[k] for k in level), d)] += 1
    out = {}
    groups = collections.defaultdict(list)
    for (k, d), n in per.items():
        groups[k].append((d, n))
    for k, items in groups.items():
        items.sort(key=lambda t: (t[0] is not None, t[0] or dt.date.min))
        run = 0
        for d, n in items:
            run += n
            out[(k, d)] = (n, run, None if d is None else (d - ANCHOR).days)
    return out


@settings(max_examples=8, deadline=None)
@given(rows=st.lists(ballot, max_size=40))
def test_running_totals_bruteforce(spark, rows):
    data = [(c, p, s, d.strftime("%m/%d/%Y") if d else None, v) for c, p, s, d, v in rows]
    df = spark.createDataFrame(data, "c string, p string, s string, d string, v int")
    base = cleanse_ballots(df, COLS).drop("_returned")
    for level in (["county", "precinct"], ["county"], []):
        got = {}
        name = "_".join(level) or "statewide"
        for r in ballots_by_day(base, ANCHOR.isoformat(), {name: level})[name].collect():
            got[(tuple(r[k] for k in level), r.DateDT)] = (r.votesOnDate, r.votesToDate, r.DaysFromElection)
        exp = _expected(rows, level)
        # a group with zero accepted ballots on a date never appears (counts only accepted, non-null ids)
        assert {k: v for k, v in got.items() if v[0] > 0} == exp


result = st.tuples(st.sampled_from(["R1", "R2"]), st.sampled_from(["a", "A", "b"]), st.sampled_from(["x", "y"]),
                   st.sampled_from(["c1", "Under/Over Votes", None]),
                   st.sampled_from(["democratic", "republican", "other", "LIB", None]),
                   st.sampled_from(["m1", "m2"]), st.integers(0, 50))


@settings(max_examples=8, deadline=None)
@given(rows=st.lists(result, min_size=1, max_size=40))
def test_results_bruteforce(spark, rows):
    df = spark.createDataFrame(rows, "race string, county string, precinct string, candidate string, "
                                     "party string, mode string, votes long")
    base = cleanse_results(df, None)
    got = {(r.race, r.county, r.mode): (r.democratic, r.republican, r.other)
           for r in results_by_mode(base, ["county"]).collect()}
    exp = collections.defaultdict(lambda: [None, None, None])
    for race, county, _, cand, party, mode, votes in rows:
        if cand == "Under/Over Votes":
            continue
        i = {"democratic": 0, "republican": 1}.get(party, 2)
        cell = exp[(race, county.upper(), mode)]
        cell[i] = (cell[i] or 0) + votes
    assert got == {k: tuple(v) for k, v in exp.items()}


def test_running_total_by_range(spark):
    """Two passes equal the one-window total, whatever the range width; peers,
    nulls and negative order values included."""
    import random
    from ballotlake.operators.levels import running_total, running_total_by_range
    rnd = random.Random(6)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, *range(-40, 40)]), rnd.choice([None, 1, 2, 5])) for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, o int, v int")
    for keys in (["k"], []):
        want = sorted(map(tuple, running_total(df, keys, "o", "v", "t").collect()), key=repr)
        for width in (1, 7, 64, 1000):
            got = running_total_by_range(df, keys, "o", "v", "t", width)
            assert sorted(map(tuple, got.select("k", "o", "v", "t").collect()), key=repr) == want


def test_state_total_moves_no_day_rows_to_one_task(spark):
    """The only single-partition exchange is over the sums per range."""
    from ballotlake.plans.catalog import QUERIES
    plan = QUERIES["running_state"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    at = [i for i, x in enumerate(lines) if "SinglePartition" in x]
    assert len(at) == 1
    below = next(x for x in lines[at[0] + 1:] if "HashAggregate" in x or "Scan" in x)
    assert "HashAggregate" in below and "__range" in below
