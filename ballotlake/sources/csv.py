"""CSV readers: header + all strings (S1), declared types (S2), positional
schema with date pattern and trailing-blank trim (S3), several tagged
sources in one read (S4), small lookups with forced string ids (S8)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's for identical results.
# A statewide file repeats the county files and must not be read with them.
STATEWIDE_FILE = "STATEWIDE.csv"
BALLOT_COLUMNS_USED = ("County", "County Precinct", "Ballot Status", "Ballot Return Date",
                       "Voter Registration #")
RESULTS_SCHEMA = StructType([StructField(n, t) for n, t in (
    ("race", StringType()), ("county", StringType()), ("precinct", StringType()),
    ("candidate", StringType()), ("party", StringType()), ("mode", StringType()), ("votes", LongType()))])
PROFILE_SCHEMA = StructType([StructField(n, t) for n, t in (
    ("CountyName", StringType()), ("Voter Registration #", IntegerType()), ("Last Name", StringType()),
    ("First Name", StringType()), ("Middle Name", StringType()), ("Suffix", StringType()),
    ("Street #", StringType()), ("Street Name", StringType()), ("Apt/Unit", StringType()),
    ("City", StringType()), ("State", StringType()), ("Zip Code", StringType()))])
HISTORY_OLD_SCHEMA = StructType([StructField(n, t) for n, t in (
    ("County Number", IntegerType()), ("Registration Number", IntegerType()), ("Election Date", DateType()),
    ("Election Type", IntegerType()), ("Party", StringType()), ("Absentee", StringType()),
    ("Provisional", StringType()), ("Supplemental", StringType()))])
HISTORY_NEW_SCHEMA = StructType([StructField(n, t) for n, t in (
    ("County Name", StringType()), ("Voter Registration Number", IntegerType()), ("Election Date", DateType()),
    ("Election Type", StringType()), ("Party", StringType()), ("Ballot Style", StringType()),
    ("Absentee", StringType()), ("Provisional", StringType()), ("Supplemental", StringType()))])
# ---------------------------------------------------------------------------


def read_ballots(spark: SparkSession, paths: str | Sequence[str], skip_statewide: bool = True) -> DataFrame:
    """Header names, every column a string. The statewide file, when
    it was landed next to the county files, is excluded by name (it would
    count every ballot twice)."""
    r = spark.read.option("header", True).option("inferSchema", False)
    df = r.csv(list(paths) if not isinstance(paths, str) else paths)
    if skip_statewide:
        df = df.filter(F.col("_metadata.file_name") != F.lit(STATEWIDE_FILE))
    return df


def read_results(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The flat results table with a declared schema (no inference pass)."""
    return spark.read.option("header", True).schema(RESULTS_SCHEMA).csv(
        list(paths) if not isinstance(paths, str) else paths)


def _positional(spark: SparkSession, schema: StructType, date_format: str) -> "DataFrameReader":  # noqa: F821
    return (spark.read.schema(schema)
            .options(delimiter=",", header=True, dateFormat=date_format, ignoreTrailingWhiteSpace=True,
                     mode="PERMISSIVE"))


def read_profile_sources(spark: SparkSession, sources: Sequence[tuple[str, float]],
                         tag_col: str = "absenteeDataYear", date_format: str = "yyyyMMdd") -> DataFrame:
    """S3 + S4: every profile file set read with one positional schema in a
    single scan; each row tagged with its source's priority, looked up from
    the file path (``_metadata.file_path``) instead of one read per source.

    ``sources``: (path prefix or directory, priority). Header names are
    ignored (the schema is positional), extra trailing columns are dropped
    and a non-numeric id becomes null.
    """
    paths = [p for p, _ in sources]
    df = _positional(spark, PROFILE_SCHEMA, date_format).csv(paths)
    # File paths come URL-encoded and with a scheme; "+" is not a blank in a path.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    path = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    tag = F.raise_error(F.concat(F.lit("no profile source for "), path)).cast("double")
    # Longest first, so the more exact of two sources claims a file.
    for source, prio in sorted(sources, key=lambda t: len(t[0])):
        tag = F.when(path.rlike(_source_pattern(source)), F.lit(float(prio))).otherwise(tag)
    return df.withColumn(tag_col, tag)


def _source_pattern(source: str) -> str:
    """Regular expression of the file paths that a path, folder or glob
    reads. Relative sources are matched from a folder boundary on."""
    bare = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", source).rstrip("/")
    glob = {"*": "[^/]*", "?": "[^/]", "{": "(", "}": ")", ",": "|", "[": "[", "]": "]"}
    rx = "".join(glob.get(c) or re.escape(c) for c in bare)
    return ("^" if bare.startswith("/") else "(^|/)") + rx + "(/.*)?$"


def read_history_old(spark: SparkSession, paths, date_format: str = "yyyyMMdd") -> DataFrame:
    return _positional(spark, HISTORY_OLD_SCHEMA, date_format).csv(paths)


def read_history_new(spark: SparkSession, paths, date_format: str = "MM/dd/yyyy") -> DataFrame:
    return _positional(spark, HISTORY_NEW_SCHEMA, date_format).csv(paths)


def read_lookup(spark: SparkSession, path, schema: StructType | str) -> DataFrame:
    """Small CSV lookup (labels, overrides, codes) with declared types,
    so ids such as ``01A`` keep their leading zeros."""
    return spark.read.option("header", True).schema(schema).csv(path)
