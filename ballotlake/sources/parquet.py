"""Parquet (S5) and JSON-array (S6) readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .records import json_records


def read_parquet(spark: SparkSession, paths, merge_schema: bool = True) -> DataFrame:
    """Partitioned Parquet with partition discovery; ``mergeSchema``
    exposes the union of layouts written over time (history files gained
    columns), otherwise Spark shows only one file's columns."""
    return spark.read.option("mergeSchema", merge_schema).parquet(paths)


def read_json_array(spark: SparkSession, paths, schema=None) -> DataFrame:
    """A file holding one JSON array of objects (the single-document
    summary sink) -> one row per object."""
    r = spark.read.option("multiLine", True)
    if schema is not None:
        r = r.schema(schema)
    return r.json(paths)


def read_large_json_array(spark: SparkSession, paths, schema) -> DataFrame:
    """S6 for files of any size: the objects of each array are cut by many
    tasks. An object that the file's end cuts off fails the job."""
    r = json_records(spark, paths, depth=0)
    whole = F.when(F.col("complete"), F.col("record")).otherwise(F.raise_error(F.concat(
        F.lit("object cut off by the end of "), "file")))
    return r.select(F.from_json(whole, schema).alias("r")).select("r.*")
