"""Config-driven batch job (entry 1 of the source system): for every
configured election, summarise ballots and/or results at every level and
write them. The config is a small JSON list read on the driver (T11)."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.enrich import duplicate_keys
from ..sinks.writers import write_csv, write_json_lines
from ..sources.csv import read_ballots, read_lookup, read_results
from .ballots import DEFAULT_LEVELS, BallotColumns, ballots_by_day, cleanse_ballots, nested_by_day, rejected_dates, undated_ballots
from .results import cleanse_results, results_by_mode, results_nested, unmatched_precincts

ID_MAP_SCHEMA = "county string, precinct string, absenteePrecinct string, score double"
NAME_MAP_SCHEMA = ("county string, precinct string, mapPrecinctName string, electionResultsPrecinctName string, "
                   "score double")


def load_config(path: str) -> list[dict]:
    with open(path) as f:
        return json.load(f)


def ballot_summaries(spark: SparkSession, election: Mapping, levels: Mapping[str, Sequence[str]] = DEFAULT_LEVELS,
                     cols: BallotColumns = BallotColumns()) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(persisted base, nested summary per level and reports) for one election."""
    id_map = None
    if election.get("absenteeFilesIDMap"):
        id_map = read_lookup(spark, election["absenteeFilesIDMap"], ID_MAP_SCHEMA)
    base = cleanse_ballots(read_ballots(spark, election["absenteeFiles"]), cols, id_map)
    base = base.persist(StorageLevel.MEMORY_AND_DISK)
    flat = ballots_by_day(base, election["date"], levels)
    out = {name: nested_by_day(df, levels[name]) for name, df in flat.items()}
    out |= {"report_rejected_dates": rejected_dates(base), "report_undated": undated_ballots(base)}
    if id_map is not None:
        out["report_duplicate_map_keys"] = duplicate_keys(id_map, ["county", "absenteePrecinct"])
    return base, out


def result_summaries(spark: SparkSession, election: Mapping, levels: Mapping[str, Sequence[str]] = DEFAULT_LEVELS
                     ) -> tuple[DataFrame, dict[str, DataFrame]]:
    name_map = None
    if election.get("resultsPrecinctNameToMapFile"):
        name_map = read_lookup(spark, election["resultsPrecinctNameToMapFile"], NAME_MAP_SCHEMA)
    base = cleanse_results(read_results(spark, election["resultsDownloadFile"]), name_map)
    base = base.persist(StorageLevel.MEMORY_AND_DISK)
    out = {name: results_nested(results_by_mode(base, lv), lv) for name, lv in levels.items()}
    out["report_unmatched"] = unmatched_precincts(base)
    if name_map is not None:
        out["report_duplicate_map_keys"] = duplicate_keys(name_map, ["county", "electionResultsPrecinctName"])
    return base, out


def run_elections(spark: SparkSession, config: Sequence[Mapping] | str, out_dir: str,
                  levels: Mapping[str, Sequence[str]] = DEFAULT_LEVELS,
                  ballots_dir: str = "ballots_by_day", results_dir: str = "results") -> list[str]:
    """Run every enabled summary of every configured election; returns the
    written paths. Each election's cleansed base is persisted while its
    levels and review reports (rejected and missing dates, unmatched
    precincts, repeated map keys) are written as JSON lines, and released
    afterwards."""
    elections = load_config(config) if isinstance(config, str) else list(config)
    written = []
    for e in elections:
        for flag, build, sub in (("absenteeSummarize", ballot_summaries, ballots_dir),
                                 ("resultsSummarize", result_summaries, results_dir)):
            if not e.get(flag):
                continue
            base, summaries = build(spark, e, levels)
            try:
                for name, df in summaries.items():
                    path = os.path.join(out_dir, sub, e["name"], f"{name}.json")
                    write_json_lines(df, path)
                    written.append(path)
            finally:
                base.unpersist()
    return written


def printed_scores(df: DataFrame) -> DataFrame:
    """scores as text with two decimals."""
    return df.withColumn("score", F.format_string("%.2f", F.col("score").cast("double")))


def write_name_map(df: DataFrame, path: str) -> None:
    """K5 for the name map: scores printed with two decimals."""
    write_csv(printed_scores(df), path)
