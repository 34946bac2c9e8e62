"""Plan guards: properties of every registered query's physical plan that
matter at scale (reviewed in docs/PLANS.md), checked on sf0.001."""

import pytest

import __spark_entry__ as E
from ballotlake.plans.catalog import QUERIES
from tools.plan_report import summarise

SF = "/root/testdata/sf0.001"
# Queries whose single-partition exchange follows a reduction to one row per
# day / race / partial aggregate.
SINGLE_PARTITION_OK = {"running_state", "nested_by_day_state", "results_nested_state", "mean_participation",
                       # the stand-in manifest is one document with an entry per county
                       "feed_a_flatten", "feed_a_report", "feed_b_flatten", "feed_b_report"}
# Reviewed shuffle budget per query (initial plan at this size).
EXCHANGE_BUDGET = {
    "ballots_by_day": 1,
    "running_precinct": 3,
    "running_county": 3,
    "running_state": 7,
    "levels_grouping_sets": 3,
    "nested_by_day": 3,
    "nested_by_day_state": 8,
    "pivot_parties": 2,
    "results_levels": 3,
    "results_nested": 4,
    "results_nested_state": 4,
    "candidate_totals": 1,
    "county_totals": 1,
    "union_tagged_sources": 0,
    "latest_profiles": 2,
    "latest_with_ties": 2,
    "normalise_flags": 0,
    "canonical_names": 0,
    "nested_history": 1,
    "nested_history_hot": 1,
    "last_seen": 1,
    "street_directory": 2,
    "participation_summary": 2,
    "mean_participation": 3,
    "recent_voters": 2,
    "election_catalogue": 1,
    "profile_search": 0,
    "best_match": 13,
    "match_rules": 16,
    "match_review": 16,
    "match_ids": 13,
    "ring_centroid": 0,
    "ring_centroid_small": 0,
    "bbox": 1,
    "thin_ring": 0,
    "measure_rollup": 1,
    "composite_id": 0,
    "fixed_width": 0,
    "split_keys": 1,
    "keyword_class": 0,
    "first_per_group": 1,
    "detail_or_total": 1,
    "json_flatten": 0,
    "label_cleanup": 0,
    "enrich_left_unmatched": 0,
    "enrich_unmatched_report": 0,
    "feature_centroid": 0,
    "county_collections": 1,
    "feed_b_flatten": 4,
    "feed_a_flatten": 13,
    "xml_flatten": 0,
    "geojson_features": 0,
    "county_demographics": 1,
    "csv_ballots": 3,
    "csv_profiles": 2,
    "csv_history_new": 0,
    "precinct_demographics": 0,
    "id_to_name": 0,
    "xml_rejects": 0,
    "ballots_id_map": 4,
    "county_name_map": 13,
    "feed_a_report": 27,
    "feed_b_report": 8,
    "history_rows_and_rejects": 0,
    "history_record_counts": 1,
    "arc_table": 6,
    "simplify_shared": 5,
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_properties(spark, name):
    s = summarise(E.queries()[name](spark, SF))
    assert not {"BroadcastNestedLoopJoin", "CartesianProduct"} & set(s["joins"])
    assert not s["python"]
    assert s["exchanges"] <= EXCHANGE_BUDGET[name]
    if name not in SINGLE_PARTITION_OK:
        assert s["single"] == 0
    assert s["scans"], "every registered query reads the driver tables"
    for table, cols, _ in s["scans"]:
        assert len(cols) <= 6, (table, cols)          # projections reach the scan


def test_filters_reach_the_scan(spark):
    s = summarise(E.queries()["ballots_by_day"](spark, SF))
    (table, cols, pushed), = s["scans"]
    assert table == "orders" and "EqualTo(o_orderstatus,F)" in pushed
    assert sorted(cols) == ["o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_parses_once(spark, name):
    import re
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    count = lambda f: len(re.findall(r"\b" + f + r"\(", plan))
    # Distinct profiles feed both sides of the latest join; AQE reuses that exchange.
    assert count("from_csv") <= (2 if name == "csv_profiles" else 1) and count("from_xml") <= 1 and count("get_json_object") <= 1
    # one parse of the feature text plus one per geometry-type branch of a CASE
    assert count("from_json") <= 3
