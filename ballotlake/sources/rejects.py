"""Rejects of text records (P15 with S3, S9-S11): every record read is either
a row or a reject with its text and the first reason that holds, so rows +
rejects = records. Rows and rejects are filters of one parsed frame; persist
it where both are written, or the text is read for each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from ..operators.nest import compute_once

_PARSERS = {"csv": F.from_csv, "json": F.from_json, "xml": F.from_xml}
_CORRUPT = "__corrupt"


def _ddl(schema: StructType | str) -> str:
    if isinstance(schema, StructType):
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return schema


def parse_records(lines: DataFrame, text_col: str, schema: StructType | str, fmt: str,
                  options: Mapping[str, str] | None = None,
                  checks: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """``lines`` with the parsed record ``r`` and ``reason`` (null: a row).

    A record that the parser can't read whole (a field of another type, too
    few or too many fields, broken nesting) has the reason ``malformed <fmt>``;
    ``checks`` are further reasons with conditions over ``r``, tested in order. A
    null text is ``no text``.
    """
    options = {**(options or {}), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = compute_once(lines, _PARSERS[fmt](F.col(text_col), f"{_ddl(schema)}, {_CORRUPT} string", options), "r")
    reason = F.when(F.coalesce(F.trim(text_col), F.lit("")) == "", "no text").when(F.col(f"r.{_CORRUPT}").isNotNull(), f"malformed {fmt}")
    for name, cond in checks:
        reason = reason.when(cond, name)
    return parsed.withColumn("reason", reason)


def rows_of(parsed: DataFrame) -> DataFrame:
    """The columns of the records without a reason."""
    return parsed.filter(F.col("reason").isNull()).select("r.*").drop(_CORRUPT)


def rejects_of(parsed: DataFrame, text_col: str) -> DataFrame:
    """``record, reason`` of the others."""
    return parsed.filter(F.col("reason").isNotNull()).select(F.col(text_col).alias("record"), "reason")


def count_records(parsed: DataFrame) -> DataFrame:
    """``reason, records``: how many records became rows (``accepted``) and how
    many were rejected for each reason; the counts add up to the records read."""
    return (parsed.groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("records")))


def read_records(spark, paths, schema: StructType | str, fmt: str, options: Mapping[str, str] | None = None,
                 checks: Sequence[tuple[str, Column]] = (), header: bool = False) -> DataFrame:
    """Files with a record a line -> :func:`parse_records` of their lines (column
    ``value``) with ``file``. With ``header``, the first line of each file is no
    record: it is the one whose fields are the schema's names."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"))
    if header:
        names = schema.fieldNames() if isinstance(schema, StructType) else spark.createDataFrame([], schema).columns
        bare = F.regexp_replace("value", r'["\r]', "")
        lines = lines.filter(~F.coalesce(F.trim(bare).startswith(",".join(names)), F.lit(False)))
    return parse_records(lines, "value", schema, fmt, options, checks)
