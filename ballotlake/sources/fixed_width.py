"""Fixed-width text -> columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's for identical results.
HISTORY_WIDTHS: tuple[int, ...] = (3, 8, 8, 3, 2, 1, 1, 1)
HISTORY_FIELDS: tuple[str, ...] = ("County Number", "Registration Number", "Election Date", "Election Type",
                                   "Party", "Absentee", "Provisional", "Supplemental")
# ---------------------------------------------------------------------------


def parse_fixed_width(lines: DataFrame, widths: Sequence[int] = HISTORY_WIDTHS,
                      names: Sequence[str] = HISTORY_FIELDS, value_col: str = "value",
                      strip_blanks: Sequence[str] = ("Party",)) -> DataFrame:
    """Slice each line by ``widths`` into string columns (1-based
    ``substring``); blanks are removed from the ``strip_blanks`` fields."""
    cols, start = [], 1
    for w, n in zip(widths, names):
        c = F.substring(F.col(value_col), start, w)
        if n in strip_blanks:
            c = F.regexp_replace(c, " ", "")
        cols.append(c.alias(n))
        start += w
    return lines.select(*cols)


def read_fixed_width(spark: SparkSession, paths, **kw) -> DataFrame:
    """``spark.read.text`` (splittable, one line per row) + slicing."""
    return parse_fixed_width(spark.read.text(paths), **kw)


def type_history_old(raw: DataFrame, date_format: str = "yyyyMMdd") -> DataFrame:
    """The sliced strings typed like the T7a CSV (ints, date)."""
    return raw.select(
        F.col("County Number").try_cast("int").alias("County Number"),
        F.col("Registration Number").try_cast("int").alias("Registration Number"),
        F.try_to_date(F.col("Election Date"), date_format).alias("Election Date"),
        F.col("Election Type").try_cast("int").alias("Election Type"),
        "Party", "Absentee", "Provisional", "Supplemental")
