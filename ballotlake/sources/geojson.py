"""GeoJSON features -> rows.

``read_features`` reads FeatureCollection files, each parsed by one task
(fine for per-state files of tens of MB); ``read_large_features`` reads the
same files of any size in many tasks each; ``read_feature_lines`` reads newline-delimited features (GeoJSON text
sequences), which split across tasks for large inputs. Both return one row
per feature: ``properties`` struct + ``geometry`` as a multi-polygon
array (``geometry.MULTI``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.geometry import multipolygon_from_coords
from .records import json_records


def _geometry(df: DataFrame) -> DataFrame:
    return df.select("properties", multipolygon_from_coords(F.col("geometry.coordinates"),
                                                            F.col("geometry.type")).alias("geometry"))


def read_features(spark: SparkSession, paths, properties: StructType | str | None = None) -> DataFrame:
    """FeatureCollection documents. ``properties``: declared property types
    (e.g. ``"CTYNAME string, PRECINCT_I string, REG20 long"``); the
    coordinates are kept as JSON text by the reader and parsed per
    geometry type."""
    schema = (f"features array<struct<properties:struct<{_props_fields(properties)}>, "
              f"geometry:struct<type:string, coordinates:string>>>")
    df = spark.read.option("multiLine", True).schema(schema).json(paths)
    return _geometry(df.select(F.explode("features").alias("f")).select("f.*"))


def parse_features(df: DataFrame, text_col: str, properties: StructType | str | None = None) -> DataFrame:
    """Features held as GeoJSON text in a column (one feature per row) ->
    the same rows as the readers return."""
    schema = (f"properties struct<{_props_fields(properties)}>, "
              f"geometry struct<type:string, coordinates:string>")
    from ..operators.nest import compute_once
    return _geometry(compute_once(df.select(text_col), F.from_json(F.col(text_col), schema), "f").select("f.*"))


def read_large_features(spark: SparkSession, paths, properties: StructType | str | None = None) -> DataFrame:
    """FeatureCollection documents, each cut into features by many tasks. Other
    objects of the collection (``crs``) are told apart by their ``type``. A
    feature that the file's end cuts off fails the job, as a broken document does."""
    r = json_records(spark, paths, depth=1)
    whole = F.when(F.col("complete"), F.col("record")).otherwise(F.raise_error(F.concat(
        F.lit("feature cut off by the end of "), "file")))
    r = r.select(whole.alias("record")).filter(F.get_json_object("record", "$.type") == "Feature")
    return parse_features(r, "record", properties)


def read_feature_lines(spark: SparkSession, paths, properties: StructType | str | None = None) -> DataFrame:
    schema = (f"properties struct<{_props_fields(properties)}>, "
              f"geometry struct<type:string, coordinates:string>")
    return _geometry(spark.read.schema(schema).json(paths))


def _props_fields(properties) -> str:
    if properties is None:
        raise ValueError("declare the feature properties to read")
    if isinstance(properties, StructType):
        return ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in properties.fields)
    return ",".join(f"`{p.strip().split()[0]}`:{' '.join(p.strip().split()[1:])}" for p in properties.split(","))
