"""Oracle SQL (DuckDB dialect) for the ballot and results stand-ins."""

ELECTION_DATE = "1998-11-03"

BALLOT_BASE = """
SELECT upper(o_orderpriority) AS county, upper(CAST(o_custkey AS VARCHAR)) AS precinct,
       CAST(o_orderdate AS DATE) AS "DateDT", count(o_custkey) AS "votesOnDate"
FROM orders WHERE o_orderstatus = 'F'
GROUP BY upper(o_orderpriority), CAST(o_custkey AS VARCHAR), o_orderdate
"""


def by_day(level: list[str]) -> str:
    keys = ", ".join(level)
    sel = (keys + ", ") if level else ""
    part = f"PARTITION BY {keys}" if level else ""
    return f"""
WITH base AS ({BALLOT_BASE}),
lv AS (SELECT {sel}"DateDT", CAST(sum("votesOnDate") AS BIGINT) AS "votesOnDate"
       FROM base GROUP BY {sel}"DateDT"),
d AS (SELECT *, CAST(date_diff('day', DATE '{ELECTION_DATE}', "DateDT") AS INTEGER) AS "DaysFromElection" FROM lv)
SELECT *, CAST(sum("votesOnDate") OVER ({part} ORDER BY "DaysFromElection" NULLS FIRST
       RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS "votesToDate"
FROM d"""


def nested_by_day(level: list[str]) -> str:
    keys = ", ".join(level)
    sel = (keys + ", ") if level else ""
    grp = f"GROUP BY {keys}" if level else ""
    return f"""
WITH f AS ({by_day(level)})
SELECT {sel}CAST(to_json(list({{'DaysFromElection': "DaysFromElection", 'DateDT': "DateDT",
        'votesToDate': "votesToDate", 'votesOnDate': "votesOnDate"}}
        ORDER BY "DaysFromElection" NULLS FIRST, "DateDT" NULLS FIRST)) AS VARCHAR) AS "votesByDay"
FROM f {grp}"""


LEVELS_GROUPING_SETS = f"""
WITH base AS ({BALLOT_BASE}),
g AS (SELECT county, precinct, "DateDT", CAST(sum("votesOnDate") AS BIGINT) AS "votesOnDate",
             GROUPING(county, precinct, "DateDT") AS gid
      FROM base GROUP BY GROUPING SETS ((county, precinct, "DateDT"), (county, "DateDT"), ("DateDT"))),
d AS (SELECT *, CASE gid WHEN 0 THEN 'county_precinct' WHEN 2 THEN 'county' WHEN 6 THEN 'statewide' END AS level,
             CAST(date_diff('day', DATE '{ELECTION_DATE}', "DateDT") AS INTEGER) AS "DaysFromElection" FROM g)
SELECT county, precinct, "DateDT", "votesOnDate", level, "DaysFromElection",
       CAST(sum("votesOnDate") OVER (PARTITION BY gid, county, precinct ORDER BY "DaysFromElection" NULLS FIRST
            RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS "votesToDate"
FROM d"""

RESULTS = """
SELECT 'race ' || CAST(CAST(floor(CAST(json_extract_string(e.props, '$.k') AS INTEGER) / 25) AS BIGINT) AS VARCHAR) AS race,
       c.c_mktsegment AS county, c.c_name AS precinct,
       CASE WHEN CAST(json_extract_string(e.props, '$.k') AS INTEGER) >= 95 THEN 'Under/Over Votes'
            ELSE 'cand ' || json_extract_string(e.props, '$.k') END AS candidate,
       CASE WHEN e.event_type = 'click' THEN 'democratic' WHEN e.event_type = 'view' THEN 'republican'
            ELSE e.event_type END AS party,
       CASE WHEN e.value < 50 THEN 'Election Day Votes' WHEN e.value < 150 THEN 'Absentee by Mail Votes'
            ELSE 'Advance Voting Votes' END AS mode,
       CAST(floor(e.value) AS BIGINT) AS votes
FROM events e JOIN customer c ON e.user_id = c.c_custkey
"""

NAME_MAP = """
SELECT upper(c_mktsegment) AS county, 'p' || CAST(c_custkey AS VARCHAR) AS precinct,
       c_name AS "mapPrecinctName", c_name AS "electionResultsPrecinctName", 100.0 AS score
FROM customer WHERE c_acctbal >= 0
"""

RESULTS_BASE = f"""
WITH r AS ({RESULTS}),
f AS (SELECT * FROM r WHERE candidate IS DISTINCT FROM 'Under/Over Votes'),
p AS (SELECT race, upper(county) AS county, precinct AS "electionResultsPrecinctName", mode,
             CAST(sum(votes) FILTER (WHERE party = 'democratic') AS BIGINT) AS democratic,
             CAST(sum(votes) FILTER (WHERE party = 'republican') AS BIGINT) AS republican,
             CAST(sum(votes) FILTER (WHERE party IS NULL OR party NOT IN ('democratic', 'republican')) AS BIGINT) AS other
      FROM f GROUP BY race, upper(county), precinct, mode),
m AS ({NAME_MAP})
SELECT p.race, p.county, p."electionResultsPrecinctName", p.mode, p.democratic, p.republican, p.other,
       upper(m.precinct) AS precinct
FROM p LEFT JOIN m ON p.county = m.county AND p."electionResultsPrecinctName" = m."electionResultsPrecinctName"
"""


def results_by_mode(level: list[str]) -> str:
    sel = "".join(k + ", " for k in level)
    return f"""
WITH b AS ({RESULTS_BASE})
SELECT race, {sel}mode, CAST(sum(democratic) AS BIGINT) AS democratic,
       CAST(sum(republican) AS BIGINT) AS republican, CAST(sum(other) AS BIGINT) AS other
FROM b GROUP BY race, {sel}mode"""


def results_nested(level: list[str]) -> str:
    sel = "".join(k + ", " for k in level)
    keys = ", ".join(level)
    grp = f"GROUP BY {keys}" if level else ""
    return f"""
WITH bm AS ({results_by_mode(level)}),
pr AS (SELECT race, {sel}CAST(sum(democratic) AS BIGINT) AS democratic, CAST(sum(republican) AS BIGINT) AS republican,
              CAST(sum(other) AS BIGINT) AS other,
              list({{'mode': mode, 'democratic': democratic, 'republican': republican, 'other': other}}
                   ORDER BY mode NULLS FIRST, democratic NULLS FIRST, republican NULLS FIRST, other NULLS FIRST) AS "resultsByMode"
       FROM bm GROUP BY race, {sel[:-2] if level else 'race'})
SELECT {sel}CAST(to_json(list({{'race': race, 'democratic': democratic, 'republican': republican, 'other': other,
                          'resultsByMode': "resultsByMode"}} ORDER BY race NULLS FIRST)) AS VARCHAR) AS races
FROM pr {grp}"""


LINE_RESULTS = """
SELECT p.p_type AS race, l.l_returnflag AS county, p.p_name AS candidate, CAST(l.l_quantity AS BIGINT) AS votes
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
"""

CANDIDATE_TOTALS = f"""
WITH r AS ({LINE_RESULTS}) SELECT race, candidate, CAST(sum(votes) AS BIGINT) AS votes FROM r GROUP BY race, candidate"""

COUNTY_TOTALS = f"""
WITH r AS ({LINE_RESULTS}) SELECT county, CAST(sum(votes) AS BIGINT) AS votes FROM r WHERE race = 'SMALL' GROUP BY county"""

ENRICH_LEFT = """
SELECT s.s_suppkey, s.s_name, s.s_nationkey, n.n_name
FROM supplier s LEFT JOIN (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 4) n
  ON s.s_nationkey = n.n_nationkey
"""

ENRICH_UNMATCHED = """
SELECT s.s_suppkey, s.s_name, s.s_nationkey
FROM supplier s LEFT JOIN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 4) n
  ON s.s_nationkey = n.n_nationkey WHERE n.n_nationkey IS NULL
"""

TEXT_BALLOT_BASE = """
SELECT upper(o_orderpriority) AS county, upper(CAST(o_custkey AS VARCHAR)) AS precinct,
       CASE WHEN o_totalprice > 400000 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS "DateDT",
       count(o_custkey) AS "votesOnDate"
FROM orders WHERE o_orderstatus = 'F'
GROUP BY upper(o_orderpriority), CAST(o_custkey AS VARCHAR),
         CASE WHEN o_totalprice > 400000 THEN 'bad ' || CAST(year(o_orderdate) AS VARCHAR)
              ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END,
         CASE WHEN o_totalprice > 400000 THEN NULL ELSE CAST(o_orderdate AS DATE) END
"""

CSV_BALLOTS_COUNTY = by_day(["county"]).replace(BALLOT_BASE, TEXT_BALLOT_BASE)

BALLOTS_ID_MAP = f"""
SELECT county, CASE WHEN CAST(precinct AS BIGINT) % 3 <> 0 THEN 'M' || precinct END AS precinct, "DateDT", "votesOnDate"
FROM ({BALLOT_BASE}) b
"""
