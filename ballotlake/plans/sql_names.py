"""Oracle SQL (DuckDB dialect) for the name-resolution stand-ins."""


def squeeze(x: str) -> str:
    return f"trim(regexp_replace(upper({x}), '\\s+', ' ', 'g'))"


def tsort(x: str) -> str:
    return f"array_to_string(list_sort(string_split({x}, ' ')), ' ')"


def sim(a: str, b: str) -> str:
    n = f"greatest(length({a}), length({b}))"
    d = f"levenshtein({a}, {b})"
    return f"(CASE WHEN {n} = 0 THEN 100 ELSE CAST((200 * ({n} - {d}) + {n}) // (2 * {n}) AS INTEGER) END)"


def score(q: str, l: str) -> str:
    return f"greatest({sim(q, l)}, {sim(tsort(q), tsort(l))})"


NAMES = "SELECT DISTINCT upper(p_type) AS county, concat_ws(' ', p_name, p_brand) AS name FROM part"
LABELS = ("SELECT DISTINCT upper(p_type) AS county, upper(split_part(p_name, ' ', 1)) AS precinct, "
          "p_name AS \"precinctName\" FROM part")
OVERRIDES = ("SELECT upper(p_type) AS county, 'OVR' || CAST(p_partkey AS VARCHAR) AS precinct, "
             "p_name AS \"mapPrecinctName\", concat_ws(' ', p_name, p_brand) AS name FROM part WHERE p_size = 50")


def fuzzy(names_sql: str, labels_sql: str) -> str:
    return f"""
SELECT county, name, label, id, score FROM (
  SELECT n.county, n.name, l."precinctName" AS label, l.precinct AS id,
         CASE WHEN l."precinctName" IS NULL THEN 0 ELSE {score('n.q', 'l.lq')} END AS score,
         row_number() OVER (PARTITION BY n.county, n.name ORDER BY
             CASE WHEN l."precinctName" IS NULL THEN 0 ELSE {score('n.q', 'l.lq')} END DESC,
             l."precinctName" NULLS FIRST, l.precinct NULLS FIRST) AS rn
  FROM (SELECT *, {squeeze('name')} AS q FROM ({names_sql}) x WHERE name IS NOT NULL) n
  LEFT JOIN (SELECT *, {squeeze('"precinctName"')} AS lq FROM ({labels_sql}) y WHERE "precinctName" IS NOT NULL) l
    ON n.county = l.county) t WHERE rn = 1"""


BEST_MATCH = f"""
SELECT county, name, label, id, score FROM ({fuzzy(NAMES, LABELS)}) f
"""

MATCH_RULES = f"""
WITH n AS ({NAMES}),
ov AS (SELECT county, name, precinct, "mapPrecinctName" FROM (
         SELECT *, row_number() OVER (PARTITION BY county, name ORDER BY precinct) AS rn FROM ({OVERRIDES}) o) x
       WHERE rn = 1),
rules AS (SELECT * FROM (VALUES ('SMALL', 'first_token', ''), ('MEDIUM', 'first_token', 'C')) t(county, rule, suffix)),
p1 AS (SELECT n.county, ov.precinct, ov."mapPrecinctName", n.name AS "electionResultsPrecinctName",
              100 AS score, 'override' AS rule
       FROM n JOIN ov ON n.county = ov.county AND n.name = ov.name),
rest1 AS (SELECT n.* FROM n LEFT JOIN ov ON n.county = ov.county AND n.name = ov.name WHERE ov.name IS NULL),
byid AS (SELECT county, precinct, min("precinctName") AS "mapPrecinctName" FROM ({LABELS}) l GROUP BY county, precinct),
ruled AS (SELECT r1.county, r1.name,
                 CASE WHEN rules.rule = 'first_token' THEN split_part(r1.name, ' ', 1) || rules.suffix ELSE r1.name END AS precinct
          FROM rest1 r1 JOIN rules ON r1.county = rules.county),
p2 AS (SELECT ruled.county, ruled.precinct, coalesce(byid."mapPrecinctName", '??') AS "mapPrecinctName",
              ruled.name AS "electionResultsPrecinctName",
              CASE WHEN byid."mapPrecinctName" IS NULL THEN 0 ELSE 100 END AS score, 'rule' AS rule
       FROM ruled LEFT JOIN byid ON ruled.county = byid.county AND ruled.precinct = byid.precinct),
rest2 AS (SELECT r1.* FROM rest1 r1 LEFT JOIN rules ON r1.county = rules.county WHERE rules.rule IS NULL),
p3 AS (SELECT county, id AS precinct, label AS "mapPrecinctName", name AS "electionResultsPrecinctName",
              score, 'fuzzy' AS rule FROM ({fuzzy('SELECT * FROM rest2', LABELS)}) f)
SELECT * FROM p1 UNION ALL SELECT * FROM p2 UNION ALL SELECT * FROM p3
"""

MATCH_REVIEW = f"SELECT * FROM ({MATCH_RULES}) m WHERE score < 95"

ID_NAMES = "SELECT DISTINCT upper(p_type) AS county, upper(p_brand) AS name FROM part"
ID_LABELS = ("SELECT DISTINCT upper(p_type) AS county, 'BRAND#' || CAST(p_size AS VARCHAR) AS precinct, "
             "'BRAND#' || CAST(p_size AS VARCHAR) AS \"precinctName\" FROM part")

MATCH_IDS = f"""
SELECT county, id AS precinct, name AS "absenteePrecinct", score
FROM ({fuzzy(ID_NAMES, ID_LABELS)}) f WHERE score > 80
"""

_COUNTY_NAMES = "SELECT county, CASE WHEN name LIKE 'blue%' THEN NULL ELSE name END AS name FROM (" + NAMES + ") n0 WHERE county = 'PROMO'"
COUNTY_NAME_MAP = f"""
SELECT county, id AS precinct, label AS "mapPrecinctName", name AS "electionResultsPrecinctName",
       printf('%.2f', CAST(score AS DOUBLE)) AS score, 'fuzzy' AS rule
FROM ({fuzzy(f"SELECT DISTINCT * FROM ({_COUNTY_NAMES}) n1", LABELS)}) f
"""
