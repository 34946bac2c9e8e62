"""Precinct features -> ids, centroids, boxes, thinned shapes and
demographic rollups (G1-G8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import composite_id
from ..operators import geometry as G
from ..operators.nest import nest_parts, row_bucket

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's for identical results.
# Registration counts carried per precinct and rolled up per county.
REGISTRATION_COUNTS: tuple[str, ...] = (
    "REG20", "WMREG20", "WFMREG20", "WUKNREG20", "BLMREG20", "BLFREG20", "BLUKNREG20", "ASIANMREG2",
    "ASIANFMREG", "ASIANUKNRE", "HISPMREG20", "HISPFMREG2", "HSPUKNREG2", "OTHERMREG2", "OTHERFMREG",
    "OTHERUKNRE", "UKNMALEREG", "UKNFMREG20", "UKNOWNREG2",
)
KEPT_PROPERTIES: tuple[str, ...] = ("ID", "CNTY", "CTYNAME", "PRECINCT_I", "PRECINCT_N")
COUNTY_TOLERANCE = 0.00005
STATE_TOLERANCE = 0.001
# ---------------------------------------------------------------------------


def precinct_features(features: DataFrame, county: str = "CTYNAME", precinct: str = "PRECINCT_I",
                      kept: Sequence[str] = KEPT_PROPERTIES) -> DataFrame:
    """One row per feature with the upper-cased county, the composite
    id (``COUNTY##PRECINCT`` or the county), the kept properties, the
    centre of mass and the geometry."""
    p = F.col("properties")
    cty = F.upper(p[county])
    cols = [composite_id(cty, p[precinct]).alias("id")]
    # Spark resolves names case-insensitively, so the source ``ID`` property
    # is exposed as ``sourceID`` next to the composite ``id``.
    cols += [(cty if k == county else p[k]).alias("sourceID" if k.lower() == "id" else k) for k in kept]
    cent = G.feature_centroid("geometry")
    cols += [F.array(cent.x, cent.y).alias("centroid"), F.col("geometry")]
    return features.select(*cols)


def id_to_name(features: DataFrame, county: str = "CTYNAME", precinct: str = "PRECINCT_I",
               name: str = "PRECINCT_N") -> DataFrame:
    """County, precinct, precinctName (the label table T3)."""
    p = F.col("properties")
    return features.select(F.upper(p[county]).alias("county"), p[precinct].alias("precinct"),
                           p[name].alias("precinctName"))


def precinct_demographics(features: DataFrame, counts: Sequence[str] = REGISTRATION_COUNTS,
                          county: str = "CTYNAME", precinct: str = "PRECINCT_I") -> DataFrame:
    """Id + the registration counts as given (missing stay null)."""
    p = F.col("properties")
    return features.select(composite_id(F.upper(p[county]), p[precinct]).alias("id"),
                           *[p[c].alias(c) for c in counts])


def county_demographics(features: DataFrame, counts: Sequence[str] = REGISTRATION_COUNTS,
                        county: str = "CTYNAME") -> DataFrame:
    """Per county sums, a missing count adds 0 for every feature."""
    p = F.col("properties")
    flat = features.select(F.upper(p[county]).alias("CTYNAME"), *[p[c].alias(c) for c in counts])
    return G.measure_rollup(flat, "CTYNAME", counts).withColumn("id", F.col("CTYNAME"))


def county_boxes(features: DataFrame, county: str = "CTYNAME", total_key: str = "STATE") -> DataFrame:
    """``[minX, minY, maxX, maxY]`` per county plus the state."""
    b = features.select(F.upper(F.col("properties")[county]).alias("county"),
                        G.feature_bbox("geometry").alias("bbox"))
    out = G.boxes(b, "county", total_key=total_key)
    return out.select("county", F.array("minX", "minY", "maxX", "maxY").alias("bbox"))


def county_collections(precincts: DataFrame, tolerance: float = COUNTY_TOLERANCE,
                       part: Column | None = None) -> DataFrame:
    """The features of each county (thinned at the county tolerance),
    one row per ``part`` (default: one of 64 hash buckets of the id)."""
    t = precincts.withColumn("geometry", G.thin_feature("geometry", tolerance))
    feat = ["id", "CNTY", "PRECINCT_I", "PRECINCT_N", "centroid", "geometry"]
    return nest_parts(t, ["CTYNAME"], feat, "features", row_bucket(["id"]) if part is None else part)


def geojson_lines(features: DataFrame, geometry: str = "geometry") -> DataFrame:
    """One GeoJSON Feature text (``value``) per row, all other
    columns as its properties; write with ``df.write.text`` or, per county,
    next to ``CTYNAME`` with ``write_split_by``."""
    props = F.to_json(F.struct(*[c for c in features.columns if c != geometry]), {"ignoreNullFields": "false"})
    text = F.concat(F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'),
                    G.geojson_geometry(geometry), F.lit("}"))
    return features.select(*[c for c in ("CTYNAME",) if c in features.columns], text.alias("value"))
