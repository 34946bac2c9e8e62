"""Votes by race x party x mode at several levels, nested; C8 totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators.enrich import first_per_key, left_enrich
from ..operators.nest import nest
from ..operators.pivot import pivot_sum

PARTIES: tuple[str, ...] = ("democratic", "republican", "other")
UNDER_OVER = "Under/Over Votes"
#: Name -> keys.
DEFAULT_LEVELS: dict[str, tuple[str, ...]] = {"county_precinct": ("county", "precinct"), "county": ("county",),
                                              "statewide": ()}


def cleanse_results(results: DataFrame, name_map: DataFrame | None = None,
                    parties: Sequence[str] = PARTIES, fold_into: str | None = "other",
                    exclude_candidate: str | None = UNDER_OVER,
                    drop_null_candidates: bool = False) -> DataFrame:
    """T2 rows -> ``race, county, electionResultsPrecinctName, precinct,
    mode`` + one summed column per party.

    Under/over votes are excluded with a null-safe test, so a null candidate
    is kept (``drop_null_candidates=True`` restores the reference's loss of
    them). Parties outside ``parties`` are folded into ``fold_into``.
    Rows are pivoted (reduced) before the name-map join, so the join sees
    one row per (race, county, precinct, mode).
    """
    df = results
    if exclude_candidate is not None:
        keep = ~F.col("candidate").eqNullSafe(F.lit(exclude_candidate))
        if drop_null_candidates:
            keep = keep & F.col("candidate").isNotNull()
        df = df.filter(keep)
    df = df.withColumn("county", F.upper(F.col("county")))
    piv = pivot_sum(df, ["race", "county", "precinct", "mode"], "party", "votes", parties, fold_into)
    piv = piv.withColumnRenamed("precinct", "electionResultsPrecinctName")
    if name_map is not None:
        # A repeated map key would multiply votes: the smallest id wins
        # (``enrich.duplicate_keys`` lists such keys).
        m = first_per_key(name_map.select("county", "electionResultsPrecinctName", "precinct"),
                          ["county", "electionResultsPrecinctName"], "precinct")
        piv = left_enrich(piv, m, ["county", "electionResultsPrecinctName"])
    else:
        piv = piv.withColumn("precinct", F.col("electionResultsPrecinctName"))
    return piv.withColumn("precinct", F.upper(F.col("precinct")))


def results_by_mode(base: DataFrame, level: Sequence[str], parties: Sequence[str] = PARTIES) -> DataFrame:
    """Flat sums per (race, level keys, mode), summed map-side first."""
    return base.groupBy("race", *level, "mode").agg(*[F.sum(p).alias(p) for p in parties])


def results_nested(by_mode: DataFrame, level: Sequence[str], parties: Sequence[str] = PARTIES) -> DataFrame:
    """O2: level keys + ``races array<struct<race, parties..., resultsByMode
    array<struct<mode, parties...>>>>``.

    Totals and the per-mode array come from one aggregate over the per-mode
    rows (no self-join), so null level keys (unmatched precincts) survive at
    every level. Arrays are bounded by races x modes.
    """
    per_race = nest(by_mode, ["race", *level], ["mode", *parties], "resultsByMode",
                    extra_aggs=[F.sum(p).alias(p) for p in parties])
    return nest(per_race, list(level), ["race", *parties, "resultsByMode"], "races")


def summarize_results(results: DataFrame, name_map: DataFrame | None = None,
                      levels: Mapping[str, Sequence[str]] = DEFAULT_LEVELS,
                      parties: Sequence[str] = PARTIES) -> dict[str, DataFrame]:
    base = cleanse_results(results, name_map, parties)
    return {name: results_nested(results_by_mode(base, lv, parties), lv, parties)
            for name, lv in levels.items()}


def candidate_totals(results: DataFrame) -> DataFrame:
    """Votes per (race, candidate)."""
    return results.groupBy("race", "candidate").agg(F.sum("votes").alias("votes"))


def county_totals(results: DataFrame, race: str) -> DataFrame:
    """Votes per county for one race (filter pushed to the scan)."""
    return (results.filter(F.col("race") == F.lit(race))
            .groupBy("county").agg(F.sum("votes").alias("votes")))


def unmatched_precincts(base: DataFrame) -> DataFrame:
    """B4 report: result precinct names the name map did not resolve, with
    the votes they carry (they stay in every level as a null precinct)."""
    return (base.filter(F.col("precinct").isNull())
            .groupBy("county", "electionResultsPrecinctName")
            .agg(*[F.sum(p).alias(p) for p in PARTIES]))


results_summary = summarize_results
