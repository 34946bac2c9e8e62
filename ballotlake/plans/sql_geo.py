"""Oracle SQL (DuckDB dialect) for the geometry stand-ins. Sums are folded
left to right over the ring, the same order as the Spark expressions."""

from .geography import REGISTRATION_COUNTS

RINGS = """
SELECT vec_id, label,
       list_transform(range(0, CAST(floor(len(embedding) / 2) AS BIGINT)),
                      lambda i: {'x': CAST(embedding[2 * i + 1] AS DOUBLE), 'y': CAST(embedding[2 * i + 2] AS DOUBLE)}) AS pts
FROM embeddings
"""


def _fold(expr: str) -> str:
    return (f"list_reduce(list_transform(range(1, len(pts) + 1), lambda i: {expr}), "
            f"lambda a, b: a + b, 0.0)")


# Vertices as seen from the ring's first vertex.
PX, PY = (f"(pts[i].{c} - pts[1].{c})" for c in "xy")
QX, QY = (f"(pts[(i % len(pts)) + 1].{c} - pts[1].{c})" for c in "xy")
CROSS = f"({PX} * {QY} - {QX} * {PY})"

def _ring_stats(pts_sql: str) -> str:
    """a2, mx, my of a ring given as a DuckDB list of {x, y} named ``pts``."""
    return f"""SELECT vec_id, label, pts[1].x AS ox, pts[1].y AS oy, {_fold(CROSS)} AS a2, {_fold(f'({PX} + {QX}) * {CROSS}')} AS mx,
                  {_fold(f'({PY} + {QY}) * {CROSS}')} AS my
           FROM ({pts_sql}) r"""


def ring_centroid(rings: str = RINGS) -> str:
    return f"""
WITH m AS ({_ring_stats(rings)})
SELECT vec_id, label, mx / (3.0 * a2) + ox AS cx, my / (3.0 * a2) + oy AS cy, abs(a2 / 2) AS area
FROM m
"""


SMALL_RINGS = f"""
SELECT vec_id, label, list_transform(pts, lambda p: {{'x': p.x * 1e-4 + CAST(-84.39 AS DOUBLE),
                                                     'y': p.y * 1e-4 + CAST(33.75 AS DOUBLE)}}) AS pts
FROM ({RINGS}) r0
"""


BBOX = f"""
WITH b AS (SELECT label, list_min(list_transform(pts, lambda p: p.x)) AS mnx, list_min(list_transform(pts, lambda p: p.y)) AS mny,
                  list_max(list_transform(pts, lambda p: p.x)) AS mxx, list_max(list_transform(pts, lambda p: p.y)) AS mxy
           FROM ({RINGS}) r)
SELECT CASE WHEN GROUPING(label) = 1 THEN 'STATE' ELSE CAST(label AS VARCHAR) END AS label,
       min(mnx) AS "minX", min(mny) AS "minY", max(mxx) AS "maxX", max(mxy) AS "maxY"
FROM b GROUP BY GROUPING SETS ((label), ())
"""


def _thinned(tol: float) -> str:
    """Kept vertices (vec_id, ord, x, y); rings here are open."""
    return f"""
SELECT vec_id, ord, x, y FROM (
  WITH v AS (SELECT vec_id, len(pts) AS n, pts, unnest(range(0, len(pts))) AS i FROM ({RINGS}) r),
  c AS (SELECT vec_id, n, i, pts[i + 1].x AS x, pts[i + 1].y AS y,
               CASE WHEN floor(pts[i + 1].x / {tol}) <> floor(pts[(i + n - 1) % n + 1].x / {tol})
                      OR floor(pts[i + 1].y / {tol}) <> floor(pts[(i + n - 1) % n + 1].y / {tol}) THEN 1 ELSE 0 END AS ch
        FROM v),
  s AS (SELECT *, sum(ch) OVER (PARTITION BY vec_id ORDER BY i) AS run, sum(ch) OVER (PARTITION BY vec_id) AS runs FROM c),
  k AS (SELECT vec_id, CASE WHEN run = 0 THEN runs ELSE run END AS ord, min({{'x': x, 'y': y}}) AS p
        FROM s WHERE runs >= least(n, 4) GROUP BY ALL)
  SELECT vec_id, ord, p.x AS x, p.y AS y FROM k
  UNION ALL SELECT vec_id, i AS ord, x, y FROM s WHERE runs < least(n, 4)) t"""


def thin(tol: float) -> str:
    return f"""
SELECT vec_id, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY ord) - 1 AS INTEGER) AS pos, x, y
FROM ({_thinned(tol)}) z
"""


MEASURE_ROLLUP = """
SELECT c_mktsegment AS county, CAST(sum(CAST(coalesce(c_acctbal, 0) AS DECIMAL(28,6))) AS DECIMAL(20,2)) AS c_acctbal,
       CAST(sum(coalesce(c_nationkey, 0)) AS BIGINT) AS c_nationkey
FROM customer GROUP BY c_mktsegment
"""

COMPOSITE_ID = """
SELECT p_partkey,
       CASE WHEN p_size <= 5 THEN upper(p_type) ELSE upper(p_type) || '##' || upper(p_brand) END AS id
FROM part
"""


def _half(lo: str) -> str:
    return f"""SELECT vec_id, label,
       list_transform(range(0, CAST(floor(len(embedding) / 4) AS BIGINT)),
                      lambda i: {{'x': CAST(embedding[{lo} + 2 * i + 1] AS DOUBLE),
                                  'y': CAST(embedding[{lo} + 2 * i + 2] AS DOUBLE)}}) AS pts
FROM embeddings"""


FEATURE_CENTROID = f"""
WITH a AS ({_ring_stats(_half('0'))}),
b AS ({_ring_stats(_half('CAST(len(embedding) / 2 AS BIGINT)'))}),
c AS (SELECT a.vec_id, a.label,
             a.mx / (3.0 * a.a2) + a.ox AS xa, a.my / (3.0 * a.a2) + a.oy AS ya, abs(a.a2 / 2) AS wa,
             b.mx / (3.0 * b.a2) + b.ox AS xb, b.my / (3.0 * b.a2) + b.oy AS yb, abs(b.a2 / 2) AS wb
      FROM a JOIN b ON a.vec_id = b.vec_id)
SELECT vec_id, label,
       ((1.0 * wa * xa) + (-1.0 * wb * xb)) / ((1.0 * wa) + (-1.0 * wb)) AS cx,
       ((1.0 * wa * ya) + (-1.0 * wb * yb)) / ((1.0 * wa) + (-1.0 * wb)) AS cy
FROM c
"""


_FEATURE_IDS = """
SELECT vec_id,
       CASE WHEN label <> 0 THEN upper('county' || CAST(label AS VARCHAR)) || '##' || upper('p' || CAST(vec_id AS VARCHAR))
            ELSE upper('county' || CAST(label AS VARCHAR)) END AS id,
       upper('county' || CAST(label AS VARCHAR)) AS "CTYNAME",
       CASE WHEN label <> 0 THEN 'p' || CAST(vec_id AS VARCHAR) END AS "PRECINCT_I"
FROM embeddings
"""


def county_collections(tol: float) -> str:
    return f"""
WITH v AS (SELECT vec_id, count(*) AS vertices FROM ({_thinned(tol)}) z GROUP BY vec_id),
f AS (SELECT f.vec_id, f.id, f."CTYNAME", f."PRECINCT_I", CAST(v.vertices AS INTEGER) AS vertices
      FROM ({_FEATURE_IDS}) f JOIN v ON f.vec_id = v.vec_id)
SELECT "CTYNAME", CAST(ascii(substr(md5(id), 1, 1)) AS INTEGER) AS part,
       CAST(to_json(list({{'id': id, 'PRECINCT_I': "PRECINCT_I", 'vertices': vertices}}
                         ORDER BY id, CAST(vec_id AS VARCHAR))) AS VARCHAR) AS features
FROM f GROUP BY ALL
"""


GEOJSON_FEATURES = f"""
WITH m AS ({_ring_stats(RINGS)})
SELECT CASE WHEN label <> 0 THEN upper('county' || CAST(label AS VARCHAR)) || '##' || upper('p' || CAST(vec_id AS VARCHAR))
            ELSE upper('county' || CAST(label AS VARCHAR)) END AS id,
       upper('county' || CAST(label AS VARCHAR)) AS "CTYNAME",
       CASE WHEN label <> 0 THEN 'p' || CAST(vec_id AS VARCHAR) END AS "PRECINCT_I",
       (1.0 * abs(a2 / 2) * (mx / (3.0 * a2) + ox)) / (1.0 * abs(a2 / 2)) AS cx,
       (1.0 * abs(a2 / 2) * (my / (3.0 * a2) + oy)) / (1.0 * abs(a2 / 2)) AS cy
FROM m
"""

_COUNTS = [(c, f"CASE WHEN label <> {i % 10} OR {i} = 0 THEN vec_id * {i + 1} END") for i, c in enumerate(REGISTRATION_COUNTS)]
_COUNTY = "upper('county' || CAST(label AS VARCHAR))"
_PRECINCT = "CASE WHEN label <> 0 THEN 'p' || CAST(vec_id AS VARCHAR) END"

COUNTY_DEMOGRAPHICS = f"""
SELECT {_COUNTY} AS "CTYNAME",
       {", ".join(f'CAST(coalesce(sum({e}), 0) AS BIGINT) AS "{c}"' for c, e in _COUNTS)},
       {_COUNTY} AS id
FROM embeddings GROUP BY 1
"""

PRECINCT_DEMOGRAPHICS = f"""
SELECT {_COUNTY} || coalesce('##' || upper({_PRECINCT}), '') AS id,
       {", ".join(f'CAST({e} AS BIGINT) AS "{c}"' for c, e in _COUNTS)}
FROM embeddings
"""

ID_TO_NAME = f"""
SELECT {_COUNTY} AS county, {_PRECINCT} AS precinct, 'precinct ' || CAST(vec_id AS VARCHAR) AS "precinctName"
FROM embeddings
"""


#: Strips between the border lines of neighbouring vectors, cut at vertices whose edges differ between rings. ``arcs``
#: has one row per arc and ring; ``arc`` runs in the smaller direction.
_BORDER_ARCS = """
line AS (
  SELECT vec_id, list_transform(range(0, len(embedding)), lambda j:
           {'x': vec_id * 4000.0::DOUBLE + floor(CAST(embedding[j + 1] AS DOUBLE) * 1000),
            'y': CAST(j * 1000 AS DOUBLE)}) AS pts
  FROM embeddings WHERE len(embedding) >= 2),
strip AS (
  SELECT a.vec_id, list_concat(a.pts, list_reverse(b.pts)) AS ring
  FROM line a JOIN line b ON b.vec_id = a.vec_id + 1),
place AS (SELECT vec_id, ring, len(ring) AS n, unnest(range(1, len(ring) + 1)) AS pos FROM strip),
edge AS (
  SELECT vec_id, pos, ring[pos] AS p, ring[CASE WHEN pos = 1 THEN n ELSE pos - 1 END] AS a, ring[pos % n + 1] AS b
  FROM place),
ends AS (
  SELECT p FROM (SELECT p, CASE WHEN a < b THEN a ELSE b END AS lo, CASE WHEN a < b THEN b ELSE a END AS hi FROM edge) e
  GROUP BY p HAVING count(DISTINCT lo) > 1 OR count(DISTINCT hi) > 1),
cut AS (SELECT vec_id, list(pos ORDER BY pos) AS cuts FROM edge JOIN ends USING (p) GROUP BY vec_id),
walk AS (
  SELECT vec_id, ring, coalesce(cuts, [list_position(ring, list_min(ring))]) AS cuts FROM strip LEFT JOIN cut USING (vec_id)),
piece AS (
  SELECT vec_id, k, list_concat(ring, ring, ring[1:1])[cuts[k]:(CASE WHEN k = len(cuts) THEN cuts[1] + len(ring)
                                                                  ELSE cuts[k + 1] END)] AS arc
  FROM (SELECT *, unnest(range(1, len(cuts) + 1)) AS k FROM walk) w),
arcs AS (
  SELECT vec_id, k, list_reverse(arc) < arc AS flipped,
         CASE WHEN list_reverse(arc) < arc THEN list_reverse(arc) ELSE arc END AS arc
  FROM piece)"""

_POINTS = ("array_to_string(list_transform({}, lambda p: CAST(CAST(p.x AS BIGINT) AS VARCHAR) || ' ' || "
           "CAST(CAST(p.y AS BIGINT) AS VARCHAR)), ',')")

ARC_TABLE = f"""
WITH {_BORDER_ARCS}
SELECT {_POINTS.format('arc')} AS arc, count(*) AS n_rings FROM arcs GROUP BY arcs.arc
"""


def simplify_shared(area: float) -> str:
    return f"""
WITH RECURSIVE {_BORDER_ARCS},
thin AS (
  SELECT DISTINCT arc, arc AS a, 0 AS step FROM arcs
  UNION ALL
  SELECT arc, kept, step + 1 FROM (
    SELECT arc, a, step, list_filter(a, lambda p, i: NOT coalesce(
             m[i].area < {area} AND coalesce(m[i] < m[i - 1], true) AND coalesce(m[i] < m[i + 1], true), false)) AS kept
    FROM (SELECT arc, a, step, list_transform(a, lambda p, i: CASE WHEN i > 1 AND i < len(a) THEN
            {{'area': abs((a[i].x - a[i - 1].x) * (a[i + 1].y - a[i - 1].y)
                          - (a[i + 1].x - a[i - 1].x) * (a[i].y - a[i - 1].y)) / 2, 'x': p.x, 'y': p.y}} END) AS m
          FROM thin) t) r
  WHERE len(kept) < len(a) AND len(kept) >= CASE WHEN a[1] = a[len(a)] THEN 4 ELSE 3 END),
last AS (SELECT arc, arg_max(a, step) AS a FROM thin GROUP BY arc),
back AS (
  SELECT vec_id, k, CASE WHEN flipped THEN list_reverse(a) ELSE a END AS a FROM arcs JOIN last USING (arc)),
whole AS (SELECT vec_id, flatten(list(a[1:len(a) - 1] ORDER BY k)) AS pts FROM back GROUP BY vec_id),
closed AS (SELECT vec_id, list_concat(pts, pts[1:1]) AS pts FROM whole)
SELECT vec_id, CAST(len(pts) AS INTEGER) AS vertices, {_POINTS.format('pts')} AS ring FROM closed
"""
