"""Oracle SQL (DuckDB dialect) for the people stand-ins."""


def initcap(x: str) -> str:
    """Spark's initcap spelled out: lower everything, upper the first
    character of every blank-separated word."""
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


UNION_TAGGED = """
SELECT o_custkey AS id, o_orderpriority AS "City",
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS totalprice,
       CASE o_orderstatus WHEN 'F' THEN 2022.0 WHEN 'O' THEN 2023.0 WHEN 'P' THEN 2024.1 END::DOUBLE AS "absenteeDataYear"
FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')
"""

LATEST_PROFILES = f"""
WITH u AS ({UNION_TAGGED}),
t AS (SELECT id, {initcap('"City"')} AS city, totalprice, "absenteeDataYear" FROM u WHERE id IS NOT NULL),
r AS (SELECT *, rank() OVER (PARTITION BY id ORDER BY "absenteeDataYear" DESC) AS rk FROM t)
SELECT DISTINCT id, city, totalprice, "absenteeDataYear" FROM r WHERE rk = 1
"""

LATEST_WITH_TIES = """
WITH t AS (SELECT l_suppkey AS id, CAST(l_shipdate AS DATE) AS shipped, l_returnflag, l_linestatus
           FROM lineitem WHERE l_suppkey IS NOT NULL),
r AS (SELECT *, rank() OVER (PARTITION BY id ORDER BY shipped DESC) AS rk FROM t)
SELECT DISTINCT id, shipped, l_returnflag, l_linestatus FROM r WHERE rk = 1
"""

NORMALISE_FLAGS = """
SELECT CAST(l_orderkey AS INTEGER) AS id, CAST(l_linenumber AS VARCHAR) AS county,
       CAST(l_shipdate AS DATE) AS election, l_linenumber AS "electionTypeCode",
       CAST(NULL AS VARCHAR) AS "electionTypeName",
       CASE l_returnflag WHEN 'N' THEN 'D' WHEN 'R' THEN 'R' WHEN 'A' THEN 'NP' END AS party,
       CAST(NULL AS VARCHAR) AS "ballotStyle",
       coalesce(l_returnflag = 'R', false) AS absentee,
       coalesce(l_linestatus = 'O', false) AS provisional,
       coalesce(l_discount > 0.08, false) AS supplemental
FROM lineitem
"""

CANONICAL_NAMES = f"""
SELECT n_nationkey,
       CASE WHEN starts_with(upper(n_name), 'NATION_1') THEN 'NATION ONE' ELSE upper(n_name) END AS county,
       {initcap('n_name')} AS title
FROM nation
"""

PROFILES = """
SELECT c.c_custkey AS id, split_part(c.c_name, '#', 1) AS "firstName",
       reverse(split_part(reverse(c.c_name), '#', 1)) AS "lastName",
       n.n_name AS "countyCurrent", c.c_mktsegment AS city
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

HISTORY = """
SELECT o_orderkey AS "rowId", o_custkey AS id, o_orderpriority AS county, CAST(o_orderdate AS DATE) AS election,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS "electionTypeCode",
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'D' WHEN '2' THEN 'R' WHEN '3' THEN 'NP' ELSE '' END AS party,
       o_totalprice < 100000 AS absentee, o_totalprice > 400000 AS provisional,
       o_orderpriority = '5-LOW' AS supplemental
FROM orders
"""


def nested_history(history: str = HISTORY, part: str = "CAST(year(election) AS INTEGER)") -> str:
    return f"""
WITH h AS ({history}),
g AS (SELECT id, {part} AS part,
             CAST(to_json(list({{'election': election, 'county': county, 'party': party, 'absentee': absentee,
                           'provisional': provisional, 'supplemental': supplemental}}
                          ORDER BY election, county, party, absentee, provisional, supplemental)) AS VARCHAR) AS "voterHistory"
      FROM h WHERE id IS NOT NULL GROUP BY ALL)
SELECT p.*, g.part, g."voterHistory" FROM ({PROFILES}) p LEFT JOIN g ON p.id = g.id
"""


HOT_HISTORY = f"""
SELECT "rowId", CASE WHEN "rowId" % 3 = 0 THEN 1 ELSE id END AS id, county,
       CASE WHEN "rowId" % 3 = 0 THEN DATE '1998-11-03' ELSE election END AS election, party, absentee, provisional, supplemental
FROM ({HISTORY}) x
"""


LAST_SEEN = f"""
WITH h AS ({HISTORY}), l AS (SELECT id, max(election) AS "electionLastVoted" FROM h GROUP BY id)
SELECT p.*, l."electionLastVoted" FROM ({PROFILES}) p LEFT JOIN l ON p.id = l.id
"""


STREET_DIRECTORY = f"""
SELECT "countyCurrent", city, CAST(floor(id / 1000) AS BIGINT) AS part,
       CAST(to_json(list({{'id': id, 'firstName': "firstName", 'lastName': "lastName",
                     'electionLastVoted': "electionLastVoted"}}
                    ORDER BY id, "firstName", "lastName", "electionLastVoted")) AS VARCHAR) AS voters
FROM ({LAST_SEEN}) s GROUP BY ALL
"""


PARTICIPATION = f"""
WITH h AS ({HISTORY}),
a AS (SELECT id, count(id) AS "totalElections",
             count(*) FILTER (WHERE party = 'D') AS "primaryElectionsD",
             count(*) FILTER (WHERE party = 'R') AS "primaryElectionsR",
             count(*) FILTER (WHERE party = 'NP') AS "primaryElectionsNP",
             CAST(sum(CAST(absentee AS BIGINT)) AS BIGINT) AS absentee,
             CAST(sum(CAST(provisional AS BIGINT)) AS BIGINT) AS provisional,
             CAST(sum(CAST(supplemental AS BIGINT)) AS BIGINT) AS supplemental,
             max(election) AS "lastElection"
      FROM h GROUP BY id),
ids AS (SELECT DISTINCT id FROM ({PROFILES}) p),
j AS (SELECT ids.id, coalesce(a."totalElections", 0) AS "totalElections",
             coalesce(a."primaryElectionsD", 0) AS "primaryElectionsD",
             coalesce(a."primaryElectionsR", 0) AS "primaryElectionsR",
             coalesce(a."primaryElectionsNP", 0) AS "primaryElectionsNP",
             coalesce(a.absentee, 0) AS absentee, coalesce(a.provisional, 0) AS provisional,
             coalesce(a.supplemental, 0) AS supplemental, a."lastElection"
      FROM ids LEFT JOIN a ON ids.id = a.id)
SELECT *, "totalElections" - absentee - provisional - supplemental AS "inPerson" FROM j
"""

MEAN_PARTICIPATION = f"""
SELECT avg("totalElections") AS "totalElections" FROM ({PARTICIPATION}) s
"""

RECENT_VOTERS = f"""
SELECT * FROM ({PARTICIPATION}) s WHERE "lastElection" > DATE '2000-01-01'
"""

ELECTION_CATALOGUE = f"""
WITH h AS ({HISTORY}),
e AS (SELECT election, count(id) AS voters, CAST(min("electionTypeCode") AS INTEGER) AS "electionType" FROM h GROUP BY election)
SELECT e."electionType", e.election, e.voters, e.election AS id, e.election AS name, r.r_name AS "electionTypeName"
FROM e LEFT JOIN region r ON e."electionType" = r.r_regionkey
"""

PROFILE_SEARCH = f"""
SELECT * FROM ({PROFILES}) p
WHERE "firstName" = 'Customer' AND city = 'BUILDING' AND "countyCurrent" = 'NATION_3'
ORDER BY id LIMIT 10
"""


def _ic(x: str) -> str:
    return initcap(x)


CSV_PROFILES = f"""
WITH src AS (
  SELECT c.c_custkey, c.c_acctbal, n.n_name, c.c_mktsegment, c.c_name, c.c_nationkey, upper(c.c_mktsegment) AS city,
         2022.0::DOUBLE AS y
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  UNION ALL
  SELECT c.c_custkey, c.c_acctbal, n.n_name, c.c_mktsegment, c.c_name, c.c_nationkey, 'NEW TOWN' AS city,
         2024.1::DOUBLE AS y
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE c.c_acctbal > 5000),
p AS (
  SELECT CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_custkey AS INTEGER) END AS id,
         {_ic("upper(c_name)")} AS "firstName", CAST(NULL AS VARCHAR) AS "middleName",
         {_ic("'MC ' || upper(c_mktsegment)")} AS "lastName", CAST(NULL AS VARCHAR) AS "Suffix",
         CAST(c_custkey AS VARCHAR) AS "streetNumber", {_ic("'MAIN ST'")} AS "streetName",
         CAST(NULL AS VARCHAR) AS "Apt/Unit", {_ic("city")} AS city, 'ZZ' AS state,
         {_ic("lpad(CAST(c_nationkey AS VARCHAR), 5, '0')")} AS zip, {_ic("n_name")} AS "countyCurrent",
         y AS "absenteeDataYear"
  FROM src),
r AS (SELECT *, rank() OVER (PARTITION BY id ORDER BY "absenteeDataYear" DESC) AS rk FROM p WHERE id IS NOT NULL)
SELECT DISTINCT id, "firstName", "middleName", "lastName", "Suffix", "streetNumber", "streetName", "Apt/Unit", city,
       state, zip, "countyCurrent", "absenteeDataYear"
FROM r WHERE rk = 1
"""

CSV_HISTORY_NEW = """
SELECT CAST(o_custkey AS INTEGER) AS id, 'COUNTY ' || substr(o_orderpriority, 1, 1) AS county,
       CAST(o_orderdate AS DATE) AS election, CAST(NULL AS INTEGER) AS "electionTypeCode",
       CASE WHEN substr(o_orderpriority, 1, 1) = '1' THEN 'PRIMARY' ELSE 'GENERAL' END AS "electionTypeName",
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'D' WHEN '2' THEN 'R' WHEN '3' THEN 'NP' ELSE '' END AS party,
       'S' || substr(o_orderpriority, 1, 1) AS "ballotStyle",
       o_totalprice < 100000 AS absentee, o_totalprice > 400000 AS provisional,
       substr(o_orderpriority, 1, 1) = '5' AS supplemental
FROM orders
"""

DAMAGED = """
SELECT o_custkey, o_orderpriority, o_orderdate, CASE WHEN o_orderkey % 19 = 0 THEN '' ELSE value END AS value,
       CASE WHEN o_orderkey % 19 = 0 THEN 'no text'
            WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 THEN 'malformed csv'
            WHEN o_orderkey % 17 = 0 THEN 'no voter id' END AS reason
FROM (SELECT *, 'COUNTY ' || substr(o_orderpriority, 1, 1) || ',' ||
             CASE WHEN o_orderkey % 11 = 0 THEN 'R' || o_custkey WHEN o_orderkey % 17 = 0 THEN ''
                  ELSE CAST(o_custkey AS VARCHAR) END || ',' ||
             CASE WHEN o_orderkey % 13 = 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y.%m.%d')
                  ELSE strftime(CAST(o_orderdate AS DATE), '%m/%d/%Y') END || ',' ||
             CASE WHEN o_orderkey % 7 = 0 THEN 'GENERAL' ELSE 'GENERAL,,S1,Y,N,N' END AS value FROM orders) o
"""

HISTORY_ROWS_AND_REJECTS = f"""
SELECT 'row' AS kind, CAST(o_custkey AS INTEGER) AS id, 'COUNTY ' || substr(o_orderpriority, 1, 1) AS county,
       CAST(o_orderdate AS DATE) AS election, true AS absentee, CAST(NULL AS VARCHAR) AS record, CAST(NULL AS VARCHAR) AS reason
FROM ({DAMAGED}) d WHERE reason IS NULL
UNION ALL
SELECT 'reject', NULL, NULL, NULL, NULL, value, reason FROM ({DAMAGED}) d WHERE reason IS NOT NULL
"""

HISTORY_RECORD_COUNTS = f"""
SELECT coalesce(reason, 'accepted') AS reason, count(*) AS records FROM ({DAMAGED}) d GROUP BY 1
"""
