"""Oracle SQL (DuckDB dialect) for the feed / text-function stand-ins."""

FIXED_WIDTH = """
SELECT CAST(o_custkey AS INTEGER) AS id, CAST(CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS VARCHAR) AS county,
       CAST(o_orderdate AS DATE) AS election, CAST(year(o_orderdate) - 1990 AS INTEGER) AS "electionTypeCode",
       CAST(NULL AS VARCHAR) AS "electionTypeName",
       CASE o_orderstatus WHEN 'F' THEN 'D' WHEN 'O' THEN 'NP' ELSE '' END AS party,
       CAST(NULL AS VARCHAR) AS "ballotStyle",
       o_totalprice < 100000 AS absentee, o_orderpriority = '1-URGENT' AS provisional, false AS supplemental
FROM orders
"""

SPLIT_KEYS = """
SELECT r.r_name AS locality,
       CAST(row_number() OVER (PARTITION BY r.r_name ORDER BY n.n_nationkey) - 1 AS INTEGER) AS pos,
       n.n_name AS names, CAST(n.n_nationkey AS VARCHAR) AS keys
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
"""

KEYWORD_CLASS = """
SELECT p_partkey,
       CASE WHEN contains(upper(p_name), 'RED') OR contains(upper(p_name), 'HOT') THEN 'republican'
            WHEN contains(upper(p_name), 'BLUE') OR contains(upper(p_name), 'COLD') THEN 'democratic'
            ELSE 'other' END AS party
FROM part
"""

FIRST_PER_GROUP = """
SELECT p_type, p_partkey, p_name FROM (
  SELECT p_type, p_partkey, p_name, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS rn
  FROM part WHERE contains(p_name, 'ring')) t WHERE rn = 1
"""

DETAIL_OR_TOTAL = """
WITH m AS (SELECT l_orderkey,
                  CASE l_returnflag WHEN 'A' THEN 'Absentee by Mail Votes' WHEN 'N' THEN 'Election Day Votes'
                       WHEN 'R' THEN 'Provisional Votes' END AS mode,
                  sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS votes
           FROM lineitem GROUP BY ALL),
t AS (SELECT l_orderkey, sum(CAST(l_quantity AS BIGINT)) AS total FROM lineitem GROUP BY l_orderkey),
s AS (SELECT l_orderkey, sum(votes) AS s FROM m GROUP BY l_orderkey)
SELECT m.l_orderkey, m.mode, CAST(m.votes AS BIGINT) AS votes FROM m JOIN s ON m.l_orderkey = s.l_orderkey
WHERE s.s <> 0 AND m.votes > 0
UNION ALL
SELECT t.l_orderkey, 'Unknown' AS mode, CAST(t.total AS BIGINT) AS votes FROM t JOIN s ON t.l_orderkey = s.l_orderkey
WHERE s.s = 0 AND t.total > 0
"""

JSON_FLATTEN = """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
"""

LABEL_CLEANUP = """
WITH p AS (SELECT *,
             CASE WHEN p_size <= 10 THEN '' WHEN p_size <= 20 THEN 'REPUBLICAN' WHEN p_size <= 30 THEN 'dem'
                  WHEN p_size <= 40 THEN 'LIB' ELSE NULL END AS code,
             p_name || CASE WHEN p_retailprice > 1500 THEN ' (Dem)' ELSE '' END AS cand
           FROM part)
SELECT p_partkey,
       regexp_replace(split_part(p_name || ' Special Election Special Election/' || p_brand, '/', 1),
                      'Special Election', 'Special') AS contest,
       regexp_replace(p_name, '\\s', '_', 'g') AS slug,
       split_part(upper(p_name), ' ', 1) || 'C' AS token,
       regexp_replace(p_type || ' County', ' County', '') AS county,
       CASE WHEN code IS NULL OR trim(code) = '' THEN
                 CASE WHEN contains(cand, 'Dem') THEN 'democratic' WHEN contains(cand, 'Rep') THEN 'republican'
                      ELSE 'unknown' END
            WHEN starts_with(upper(trim(code)), 'REP') THEN 'republican'
            WHEN starts_with(upper(trim(code)), 'DEM') THEN 'democratic'
            ELSE upper(trim(code)) END AS party
FROM p
"""

COUNTY = "(['Cobb', 'Fulton', 'Ben_Hill', 'Jeff Davis'])[o_custkey % 4 + 1]"

FEED_B = f"""
SELECT 'US Senate' AS race, {COUNTY} AS county, CAST(o_custkey AS VARCHAR) AS precinct,
       'opt ' || o_orderstatus AS candidate,
       CASE o_orderstatus WHEN 'F' THEN 'republican' WHEN 'O' THEN 'democratic' ELSE 'unknown' END AS party,
       CASE WHEN o_orderpriority = '1-URGENT' AND CAST(floor(o_totalprice / 1000) AS BIGINT) <> 0
            THEN 'Election Day Votes' ELSE 'Unknown' END AS mode,
       CAST(floor(o_totalprice / 1000) AS BIGINT) AS votes
FROM orders WHERE CAST(floor(o_totalprice / 1000) AS BIGINT) > 0 AND o_orderkey % 3 = (o_custkey % 4 + 1) % 3
"""

FEED_B_REPORT = f"SELECT DISTINCT lower({COUNTY}) AS locality, 'Governor' AS race, 'no contest' AS problem FROM orders"

FEED_A = f"""
SELECT o_orderpriority AS race, {COUNTY} AS county, CAST(o_custkey AS VARCHAR) AS precinct, o_orderstatus AS candidate,
       CASE WHEN contains(upper(o_orderstatus), 'F') THEN 'republican'
            WHEN contains(upper(o_orderstatus), 'O') THEN 'democratic' ELSE 'other' END AS party,
       CASE WHEN o_totalprice < 200000 THEN 'Election Day Votes' ELSE 'Absentee by Mail Votes' END AS mode,
       CAST(floor(o_totalprice / 1000) AS BIGINT) AS votes
FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND CAST(floor(o_totalprice / 1000) AS BIGINT) > 0
"""

FEED_A_REPORT = f"""
SELECT DISTINCT {COUNTY} AS county, CAST(o_custkey % 4 + 100 AS VARCHAR) AS "countyElectionId", '1' AS version,
       'modes not in manifest' AS problem FROM orders WHERE o_custkey % 5 = 0
"""

XML_FEED = """
SELECT 'US Senate Special' AS race, c_mktsegment AS county, CAST(c_custkey AS VARCHAR) AS precinct,
       CASE WHEN c_acctbal >= 5000 THEN 'Kemp' ELSE 'Ossoff' END AS candidate,
       CASE WHEN c_acctbal >= 5000 THEN 'republican' ELSE 'democratic' END AS party,
       'Election Day Votes' AS mode, CAST(floor(c_acctbal / 100) AS BIGINT) AS votes
FROM customer WHERE CAST(floor(c_acctbal / 100) AS BIGINT) > 0
UNION ALL
SELECT 'US Senate Special' AS race, c_mktsegment AS county, CAST(c_custkey AS VARCHAR) AS precinct,
       'Under/Over Votes' AS candidate, 'other' AS party, 'Absentee by Mail Votes' AS mode, CAST(1 AS BIGINT) AS votes
FROM customer
UNION ALL
SELECT 'Governor' AS race, c_mktsegment AS county, CAST(c_custkey AS VARCHAR) AS precinct,
       'Under/Over Votes' AS candidate, 'other' AS party, 'Absentee by Mail Votes' AS mode, CAST(1 AS BIGINT) AS votes
FROM customer WHERE c_custkey % 10 = 2
"""

XML_REJECTS = """
SELECT c_mktsegment AS county, 'Governor' AS race,
       CASE WHEN c_custkey % 10 = 2 THEN CASE WHEN c_acctbal >= 5000 THEN 'Kemp' ELSE 'Ossoff' END END AS candidate,
       CASE c_custkey % 10 WHEN 0 THEN 'no choices' WHEN 1 THEN 'no under/over votes' ELSE 'no vote types' END AS reason
FROM customer WHERE c_custkey % 10 < 3
"""
