"""Readers for landed result feeds."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

PRECINCT = "array<struct<_name:string,_votes:long>>"
XML_SCHEMA = (
    "Region string, Contest array<struct<_text:string, "
    f"Choice:array<struct<_text:string, VoteType:array<struct<_name:string, Precinct:{PRECINCT}>>>>, "
    f"VoteType:array<struct<_name:string, Precinct:{PRECINCT}>>>>"
)
SUMMARY_SCHEMA = "K string, C string, CH array<string>"
MODES_SCHEMA = "Contests array<struct<A:string, C:array<string>, V:array<array<long>>>>"
_NAME = "array<struct<text:string>>"
ITEMS_SCHEMA = f"data array<struct<id:string, name:{_NAME}>>"
LOCALITIES_SCHEMA = f"childLocalities array<struct<shortName:string, name:{_NAME}>>"
FEED_B_SCHEMA = (
    f"breakdownResults array<struct<precinct:struct<name:{_NAME}>, ballotOptions:array<struct<"
    f"name:{_NAME}, party:struct<name:{_NAME}>, voteCount:long, "
    f"groupResults:array<struct<groupName:{_NAME}, voteCount:long>>>>>>"
)


def read_xml_feed(spark: SparkSession, paths, row_tag: str = "ElectionResult") -> DataFrame:
    """One row per county document with Spark's built-in XML source and
    a declared schema (attributes as ``_name``; single children still
    arrive as one-element arrays)."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(XML_SCHEMA).load(paths)


#: Landed files keep the layout of the sites they come from.
FEED_A_FOLDERS = "{county}/{countyElectionId}/{version}/json"
FEED_B_FOLDERS = "{locality}/{electionId}/ballot-items"


def path_columns(df: DataFrame, layout: str, path: str | Column = "_metadata.file_path") -> DataFrame:
    """Columns named by ``layout`` from each row's file path: ``{name}`` stands
    for one folder or file name (percent escapes decoded), the rest is literal;
    the layout is the path's end. A path of another form fails by name."""
    p = F.col(path) if isinstance(path, str) else path
    # A plus sign is no blank in a path.
    p = F.url_decode(F.regexp_replace(p, r"\+", "%2B"))
    names = re.findall(r"{(\w+)}", layout)
    pattern = "/" + re.sub(r"\\{\w+\\}", "([^/]+)", re.escape(layout)) + "$"
    found = F.when(p.rlike(pattern), p).otherwise(F.raise_error(F.concat(F.lit(f"not a {layout} file: "), p)))
    return df.withColumns({n: F.regexp_extract(found, pattern, i) for i, n in enumerate(names, 1)})


def read_feed_a_summary(spark: SparkSession, root: str) -> DataFrame:
    """The summaries of all counties below ``root``; each is a JSON array
    of contests. Whose it is (county, county election id, version) comes from
    its path."""
    df = spark.read.option("multiLine", True).schema(SUMMARY_SCHEMA).json(f"{root}/*/*/*/json/en/summary.json")
    return path_columns(df, FEED_A_FOLDERS + "/en/summary.json")


def feed_a_mode(df: DataFrame, path: str | Column = "_metadata.file_path") -> DataFrame:
    """Whose document and which vote mode it is, from the path: the mode is the
    file name with ``_`` for blanks."""
    df = path_columns(df, FEED_A_FOLDERS + "/{file}.json", path)
    return df.withColumn("mode", F.replace("file", F.lit("_"), F.lit(" "))).drop("file")


def read_feed_a_modes(spark: SparkSession, root: str) -> DataFrame:
    """The documents of all counties and vote modes below ``root``, one
    per mode (``Election_Day_Votes.json`` -> ``Election Day Votes``)."""
    return feed_a_mode(spark.read.option("multiLine", True).schema(MODES_SCHEMA).json(f"{root}/*/*/*/json/*.json"))


def read_feed_b(spark: SparkSession, root: str) -> DataFrame:
    """The result documents of all localities and contests below
    ``root``, one per (locality, contest)."""
    df = spark.read.option("multiLine", True).schema(FEED_B_SCHEMA).json(f"{root}/*/*/ballot-items/*.json")
    return path_columns(df, FEED_B_FOLDERS + "/{contestId}.json")


def read_ballot_items(spark: SparkSession, root: str) -> DataFrame:
    """The lists of contests of all localities below ``root``."""
    df = spark.read.option("multiLine", True).schema(ITEMS_SCHEMA).json(f"{root}/*/*/ballot-items.json")
    return path_columns(df, FEED_B_FOLDERS + ".json")
