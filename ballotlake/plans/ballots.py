"""Accepted ballots per day and to date, at several levels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import parse_date
from ..functions.text import COUNTY_PREFIXES, canonical_prefix
from ..operators.enrich import first_per_key, left_enrich
from ..operators.levels import by_day_at_level, by_day_grouping_sets
from ..operators.nest import nest

#: Name -> keys.
DEFAULT_LEVELS: dict[str, tuple[str, ...]] = {"county_precinct": ("county", "precinct"), "county": ("county",),
                                              "statewide": ()}


@dataclass(frozen=True)
class BallotColumns:
    """Where the ballot file keeps each field (header names of T1)."""
    county: str = "County"
    precinct: str = "County Precinct"
    status: str = "Ballot Status"
    returned: str = "Ballot Return Date"
    voter_id: str = "Voter Registration #"
    accepted: str = "A"
    date_format: str | None = "MM/dd/yyyy"


def cleanse_ballots(ballots: DataFrame, cols: BallotColumns = BallotColumns(),
                    id_map: DataFrame | None = None,
                    prefixes: Sequence[tuple[str, str]] = COUNTY_PREFIXES) -> DataFrame:
    """Accepted ballots -> ``county, precinct, DateDT, votesOnDate``.

    Filter first (pushed into the scan), canonicalise the county, then
    reduce ballots to one row per (county, precinct, return date) with a
    non-null count of registrations; only then parse the date and join the
    optional precinct-id map (``county, absenteePrecinct -> precinct``), so
    the join sees precinct-days, not ballots. Unparsable dates become null
    (see ``rejected_dates``) and, ordered first, count in every running total.
    """
    county = canonical_prefix(F.upper(F.col(cols.county)), prefixes)
    dtype = ballots.schema[cols.returned].dataType
    base = (ballots.filter(F.col(cols.status) == F.lit(cols.accepted))
            .groupBy(county.alias("county"), F.col(cols.precinct).alias("precinct"),
                     F.col(cols.returned).alias("_returned"))
            .agg(F.count(F.col(cols.voter_id)).alias("votesOnDate"))
            .withColumn("DateDT", parse_date("_returned", cols.date_format, dtype)))
    if id_map is not None:
        base = base.withColumnRenamed("precinct", "absenteePrecinct")
        # A repeated map key would multiply ballots: the smallest id wins.
        one = first_per_key(id_map.select("county", "absenteePrecinct", "precinct"),
                            ["county", "absenteePrecinct"], "precinct")
        base = left_enrich(base, one, ["county", "absenteePrecinct"])
    return (base.withColumn("precinct", F.upper(F.col("precinct")))
            .select("county", "precinct", "_returned", "DateDT", "votesOnDate"))


def rejected_dates(base: DataFrame) -> DataFrame:
    """Rows of the cleansed base whose return date text did not parse."""
    return base.filter(F.col("_returned").isNotNull() & F.col("DateDT").isNull())


def ballots_by_day(base: DataFrame, election_date: str,
                   levels: Mapping[str, Sequence[str]] = DEFAULT_LEVELS) -> dict[str, DataFrame]:
    """Flat per-level frames: level keys, DateDT, DaysFromElection,
    votesOnDate, votesToDate. Persist ``base`` around the call when several
    levels are computed (each level re-reads it)."""
    return {name: by_day_at_level(base, list(lv), election_date) for name, lv in levels.items()}


def nested_by_day(by_day: DataFrame, level: Sequence[str]) -> DataFrame:
    """O1: level keys + ``votesByDay array<struct<DaysFromElection, DateDT,
    votesToDate, votesOnDate>>`` sorted by day (nulls first). The array
    length is bounded by the number of distinct days."""
    return nest(by_day, list(level), ["DaysFromElection", "DateDT", "votesToDate", "votesOnDate"],
                "votesByDay")


def summarize_ballots(ballots: DataFrame, election_date: str, cols: BallotColumns = BallotColumns(),
                      id_map: DataFrame | None = None,
                      levels: Mapping[str, Sequence[str]] = DEFAULT_LEVELS) -> dict[str, DataFrame]:
    """Whole C1: nested summaries per level, keyed by level name."""
    base = cleanse_ballots(ballots, cols, id_map).drop("_returned")
    flat = ballots_by_day(base, election_date, levels)
    return {name: nested_by_day(df, levels[name]) for name, df in flat.items()}


def ballots_all_levels(base: DataFrame, election_date: str,
                       levels: Mapping[str, Sequence[str]] = DEFAULT_LEVELS) -> DataFrame:
    """All levels as one flat frame from one GROUPING SETS aggregate."""
    return by_day_grouping_sets(base, levels, election_date)


def undated_ballots(base: DataFrame) -> DataFrame:
    """B10 report: accepted ballots without a usable return date per county
    (they count in every running total, ordered first)."""
    return (base.filter(F.col("DateDT").isNull()).groupBy("county")
            .agg(F.sum("votesOnDate").cast("long").alias("undatedBallots")))
