"""Free-text precinct names -> map ids (results and absentee variants)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.matching import SALT_BUCKETS, resolve_ids, resolve_names, review_queue


# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's for identical results.
# Counties whose result names start with the precinct id.
FIRST_TOKEN_COUNTIES: tuple[str, ...] = ("CHATHAM", "WARE", "FORSYTH")
# Races in which those ids carry the suffix "C".
SUFFIX_C_RACES: tuple[str, ...] = ("2018", "2016")
# (county, race) pairs whose result name is the precinct id itself.
NAME_IS_ID: tuple[tuple[str, str], ...] = (("RICHMOND", "2022"),)
# ---------------------------------------------------------------------------


def default_rules(spark: SparkSession, race: str) -> DataFrame:
    """The rule table (county, rule, suffix) for one race, from the fixed
    county lists above. ``race`` is the race/election name the rules are
    keyed by (an explicit argument, not parsed from a file name)."""
    suffix = "C" if race in SUFFIX_C_RACES else ""
    rows = [(c, "first_token", suffix) for c in FIRST_TOKEN_COUNTIES]
    rows += [(c, "name_is_id", "") for c, r in NAME_IS_ID if r == race]
    return spark.createDataFrame(rows, "county string, rule string, suffix string")


def results_name_map(results: DataFrame, labels: DataFrame, overrides: DataFrame | None = None,
                     rules: DataFrame | None = None, county: str | None = None,
                     salt_buckets: int = SALT_BUCKETS) -> tuple[DataFrame, DataFrame]:
    """Distinct (county, precinct) of the results, upper-cased county first
    (then distinct, so case variants collapse), optional county filter,
    then the cascade. Returns (map T4, review queue score < 95)."""
    names = results.select(F.upper("county").alias("county"), F.col("precinct").alias("name")).distinct()
    if county:
        names = names.filter(F.col("county") == F.lit(county.upper()))
    m = resolve_names(names, labels, overrides, rules, salt_buckets=salt_buckets)
    return m, review_queue(m, 95)


def absentee_id_map(summary: DataFrame, labels: DataFrame, county: str | None = None,
                    min_score: int = 80) -> tuple[DataFrame, DataFrame]:
    """Absentee precinct names matched against map ids; keeps score >
    ``min_score``; review queue = score < 100. Null names are skipped."""
    names = (summary.select(F.upper("county").alias("county"), F.col("precinct"))
             .filter(F.col("precinct").isNotNull()).distinct())
    if county:
        names = names.filter(F.col("county") == F.lit(county.upper()))
    m = resolve_ids(names, labels, min_score=min_score)
    return m, review_queue(m, 100)
