"""Registry of runnable queries over the driver tables and their DuckDB
oracle SQL. ``__spark_entry__`` re-exports these two dictionaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import feeds as FP
from . import people as P
from . import sql_ballots as SB
from . import sql_feeds as SF
from . import sql_geo as SG
from . import sql_names as SN
from . import sql_people as SP
from . import standins as S
from ..functions import text as T
from ..functions.flags import code_map, yes_flag
from ..functions.text import canonical_prefix, composite_id
from ..operators import feeds as FD
from ..operators import geometry as G
from ..operators import matching as M
from ..operators.enrich import left_enrich_with_report
from ..operators.latest import latest_per_key
from ..operators.levels import by_day_at_level
from ..operators.nest import compute_once, json_text
from ..sources.feeds import FEED_A_FOLDERS, FEED_B_FOLDERS, feed_a_mode, path_columns
from ..sources.fixed_width import parse_fixed_width, type_history_old
from ..sources.rejects import count_records
from .ballots import ballots_all_levels, cleanse_ballots, nested_by_day
from .results import (candidate_totals, cleanse_results, county_totals, results_by_mode,
                      results_nested)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# -- C1: ballots by day ----------------------------------------------------

def _ballot_base(spark, d):
    return cleanse_ballots(S.ballots(spark, d), S.BALLOT_COLS).drop("_returned")


@register("ballots_by_day", SB.BALLOT_BASE)
def q_ballots_by_day(spark, d):
    return _ballot_base(spark, d)


@register("running_precinct", SB.by_day(["county", "precinct"]))
def q_running_precinct(spark, d):
    return by_day_at_level(_ballot_base(spark, d), ["county", "precinct"], S.ELECTION_DATE)


@register("running_county", SB.by_day(["county"]))
def q_running_county(spark, d):
    return by_day_at_level(_ballot_base(spark, d), ["county"], S.ELECTION_DATE)


@register("running_state", SB.by_day([]))
def q_running_state(spark, d):
    return by_day_at_level(_ballot_base(spark, d), [], S.ELECTION_DATE)


@register("levels_grouping_sets", SB.LEVELS_GROUPING_SETS)
def q_levels_grouping_sets(spark, d):
    return ballots_all_levels(_ballot_base(spark, d), S.ELECTION_DATE)


@register("nested_by_day", SB.nested_by_day(["county"]))
def q_nested_by_day(spark, d):
    n = nested_by_day(q_running_county(spark, d), ["county"])
    return n.select("county", json_text("votesByDay").alias("votesByDay"))


@register("nested_by_day_state", SB.nested_by_day([]))
def q_nested_by_day_state(spark, d):
    n = nested_by_day(q_running_state(spark, d), [])
    return n.select(json_text("votesByDay").alias("votesByDay"))


# -- C2: results -----------------------------------------------------------

def _results_base(spark, d):
    return cleanse_results(S.results(spark, d), S.results_name_map(spark, d))


@register("pivot_parties", SB.RESULTS_BASE)
def q_pivot_parties(spark, d):
    return _results_base(spark, d)


@register("results_levels", SB.results_by_mode(["county", "precinct"]))
def q_results_levels(spark, d):
    return results_by_mode(_results_base(spark, d), ["county", "precinct"])


@register("results_nested", SB.results_nested(["county"]))
def q_results_nested(spark, d):
    n = results_nested(results_by_mode(_results_base(spark, d), ["county"]), ["county"])
    return n.select("county", json_text("races").alias("races"))


@register("results_nested_state", SB.results_nested([]))
def q_results_nested_state(spark, d):
    n = results_nested(results_by_mode(_results_base(spark, d), []), [])
    return n.select(json_text("races").alias("races"))


@register("candidate_totals", SB.CANDIDATE_TOTALS)
def q_candidate_totals(spark, d):
    return candidate_totals(S.line_results(spark, d))


@register("county_totals", SB.COUNTY_TOTALS)
def q_county_totals(spark, d):
    return county_totals(S.line_results(spark, d), "SMALL")


# -- C3/C4: people ---------------------------------------------------------


@register("union_tagged_sources", SP.UNION_TAGGED)
def q_union_tagged_sources(spark, d):
    return P.union_tagged(S.profile_sources(spark, d), "absenteeDataYear")


@register("latest_profiles", SP.LATEST_PROFILES)
def q_latest_profiles(spark, d):
    return P.latest_profiles(q_union_tagged_sources(spark, d))


@register("latest_with_ties", SP.LATEST_WITH_TIES)
def q_latest_with_ties(spark, d):
    li = S.table(spark, d, "lineitem")
    t = li.select(F.col("l_suppkey").alias("id"), F.to_date("l_shipdate").alias("shipped"),
                  "l_returnflag", "l_linestatus")
    return latest_per_key(t, "id", "shipped")


@register("normalise_flags", SP.NORMALISE_FLAGS)
def q_normalise_flags(spark, d):
    return P.normalise_history_old(S.history_old_layout(spark, d))


@register("canonical_names", SP.CANONICAL_NAMES)
def q_canonical_names(spark, d):
    n = S.table(spark, d, "nation")
    return n.select("n_nationkey",
                    canonical_prefix(F.upper("n_name"), [("NATION_1", "NATION ONE")]).alias("county"),
                    F.initcap("n_name").alias("title"))


@register("nested_history", SP.nested_history())
def q_nested_history(spark, d):
    out = P.nested_history(S.profiles(spark, d), S.history(spark, d))
    return out.withColumn("voterHistory", json_text("voterHistory"))


@register("nested_history_hot", SP.nested_history(SP.HOT_HISTORY, 'CAST(floor("rowId" / 1000) AS BIGINT)'))
def q_nested_history_hot(spark, d):
    """A third of all history belongs to one voter, all on one date."""
    hot = F.col("rowId") % 3 == 0
    h = S.history(spark, d).withColumns({"id": F.when(hot, F.lit(1)).otherwise(F.col("id")),
                                         "election": F.when(hot, F.to_date(F.lit("1998-11-03")))
                                         .otherwise(F.col("election"))})
    out = P.nested_history(S.profiles(spark, d), h, part=F.floor(F.col("rowId") / 1000))
    return out.withColumn("voterHistory", json_text("voterHistory"))


@register("last_seen", SP.LAST_SEEN)
def q_last_seen(spark, d):
    return P.with_last_voted(S.profiles(spark, d), S.history(spark, d))


@register("street_directory", SP.STREET_DIRECTORY)
def q_street_directory(spark, d):
    out = P.street_directory(S.profiles(spark, d), S.history(spark, d), keys=("countyCurrent", "city"),
                             part=F.floor(F.col("id") / 1000))
    return out.withColumn("voters", json_text("voters"))


@register("participation_summary", SP.PARTICIPATION)
def q_participation_summary(spark, d):
    return P.participation_summary(S.profiles(spark, d), S.history(spark, d))


@register("mean_participation", SP.MEAN_PARTICIPATION)
def q_mean_participation(spark, d):
    return P.mean_participation(q_participation_summary(spark, d))


@register("recent_voters", SP.RECENT_VOTERS)
def q_recent_voters(spark, d):
    return P.recent_voters(q_participation_summary(spark, d), "2000-01-01")


@register("election_catalogue", SP.ELECTION_CATALOGUE)
def q_election_catalogue(spark, d):
    return P.election_catalogue(S.history(spark, d), S.election_codes(spark, d))


@register("profile_search", SP.PROFILE_SEARCH)
def q_profile_search(spark, d):
    return P.find_profile(S.profiles(spark, d),
                          {"firstName": "Customer", "city": "BUILDING", "countyCurrent": "NATION_3"})


# -- C5: name resolution ---------------------------------------------------


@register("best_match", SN.BEST_MATCH)
def q_best_match(spark, d):
    n = S.match_names(spark, d).withColumn("county", F.upper("county"))
    return M.best_match(n, S.match_labels(spark, d), ["county"], "name", "precinctName", "precinct")


def _resolved(spark, d):
    return M.resolve_names(S.match_names(spark, d), S.match_labels(spark, d),
                           S.match_overrides(spark, d), S.match_rules(spark))


@register("match_rules", SN.MATCH_RULES)
def q_match_rules(spark, d):
    return _resolved(spark, d)


@register("match_review", SN.MATCH_REVIEW)
def q_match_review(spark, d):
    return M.review_queue(_resolved(spark, d), 95)


@register("match_ids", SN.MATCH_IDS)
def q_match_ids(spark, d):
    return M.resolve_ids(S.id_names(spark, d), S.id_labels(spark, d))


# -- C6: geography ---------------------------------------------------------


@register("ring_centroid", SG.ring_centroid())
def q_ring_centroid(spark, d):
    return _centres(S.rings(spark, d))


@register("ring_centroid_small", SG.ring_centroid(SG.SMALL_RINGS))
def q_ring_centroid_small(spark, d):
    """Rings of about 1e-4 degrees at real coordinates."""
    moved = F.transform("ring", lambda p: F.struct((p.x * F.lit(1e-4) + F.lit(-84.39)).alias("x"),
                                                   (p.y * F.lit(1e-4) + F.lit(33.75)).alias("y")))
    return _centres(S.rings(spark, d).withColumn("ring", moved))


def _centres(rings):
    c = rings.select("vec_id", "label", G.ring_centroid("ring").alias("c"))
    return c.select("vec_id", "label", F.col("c.x").alias("cx"), F.col("c.y").alias("cy"),
                    F.col("c.area").alias("area"))


@register("bbox", SG.BBOX)
def q_bbox(spark, d):
    r = S.rings(spark, d).select("label", G.feature_bbox(F.array(F.array("ring"))).alias("bbox"))
    return G.boxes(r, "label")


@register("thin_ring", SG.thin(0.05))
def q_thin_ring(spark, d):
    r = S.rings(spark, d).select("vec_id", G.thin_ring("ring", S.THIN_TOLERANCE).alias("thin"))
    # posexplode_outer + a null filter: no inferred size(thin) > 0 filter
    # that would thin every ring a second time.
    return (r.select("vec_id", F.posexplode_outer("thin").alias("pos", "p")).filter(F.col("pos").isNotNull())
            .select("vec_id", "pos", "p.x", "p.y"))


@register("simplify_shared", SG.simplify_shared(S.BORDER_AREA))
def q_simplify_shared(spark, d):
    from ..operators.arcs import simplify_shared
    thin = simplify_shared(S.border_strips(spark, d), S.BORDER_AREA)
    point = F.transform(F.col("geometry")[0][0], lambda p: F.concat_ws(" ", p.x.cast("long"), p.y.cast("long")))
    return thin.select("vec_id", F.size(point).alias("vertices"), F.array_join(point, ",").alias("ring"))


@register("arc_table", SG.ARC_TABLE)
def q_arc_table(spark, d):
    from ..operators.arcs import arc_table
    point = F.transform("arc", lambda p: F.concat_ws(" ", p.x.cast("long"), p.y.cast("long")))
    return arc_table(S.border_strips(spark, d)).select(F.array_join(point, ",").alias("arc"), "n_rings")


@register("measure_rollup", SG.MEASURE_ROLLUP)
def q_measure_rollup(spark, d):
    c = S.table(spark, d, "customer").withColumnRenamed("c_mktsegment", "county")
    out = G.measure_rollup(c, "county", ["c_acctbal", "c_nationkey"])
    return out.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(20,2)"))


@register("composite_id", SG.COMPOSITE_ID)
def q_composite_id(spark, d):
    p = S.table(spark, d, "part")
    pre = F.when(F.col("p_size") <= 5, F.lit(None)).otherwise(F.col("p_brand"))
    return p.select("p_partkey", composite_id("p_type", pre).alias("id"))


# -- C7: feeds and text functions ----------------------------------------


@register("fixed_width", SF.FIXED_WIDTH)
def q_fixed_width(spark, d):
    return P.normalise_history_old(type_history_old(parse_fixed_width(S.fixed_width_lines(spark, d))))


@register("split_keys", SF.SPLIT_KEYS)
def q_split_keys(spark, d):
    m = S.region_manifest(spark, d).withColumn("locality", T.strip_first("locality", " County"))
    return FD.explode_parallel(m, ["names", "keys"], "|", keep=["locality"])


@register("keyword_class", SF.KEYWORD_CLASS)
def q_keyword_class(spark, d):
    p = S.table(spark, d, "part")
    return p.select("p_partkey", T.keyword_class("p_name", S.KEYWORDS).alias("party"))


@register("first_per_group", SF.FIRST_PER_GROUP)
def q_first_per_group(spark, d):
    p = S.table(spark, d, "part").select("p_type", "p_partkey", "p_name")
    return FD.first_per_group(p, ["p_type"], "p_partkey", F.col("p_name").contains("ring"))


@register("detail_or_total", SF.DETAIL_OR_TOTAL)
def q_detail_or_total(spark, d):
    li = S.table(spark, d, "lineitem")
    qty = F.col("l_quantity").cast("long")
    label = T.normalise_label(code_map("l_returnflag", S.FLAG_MODES, None))
    # (order, mode) groups are nearly as many as lines, so a map-side partial
    # aggregate would not shrink the data: partition the lines by order once
    # and let both aggregates below reuse that partitioning.
    per_mode = li.repartition("l_orderkey").groupBy("l_orderkey", label.alias("mode")).agg(
        F.sum(F.when(F.col("l_linestatus") == "O", qty).otherwise(F.lit(0).cast("long"))).alias("votes"),
        F.sum(qty).alias("total"))
    opt = per_mode.groupBy("l_orderkey").agg(F.collect_list(F.struct("mode", "votes")).alias("modes"),
                                             F.sum("total").alias("total"))
    out = opt.select("l_orderkey", F.inline(FD.detail_or_total(F.col("modes"), F.col("total"))))
    return out.filter(F.col("votes") > 0)


@register("json_flatten", SF.JSON_FLATTEN)
def q_json_flatten(spark, d):
    e = S.table(spark, d, "events")
    return e.select("event_id", "event_type", F.from_json("props", "k int")["k"].alias("k"))


@register("label_cleanup", SF.LABEL_CLEANUP)
def q_label_cleanup(spark, d):
    p = S.table(spark, d, "part")
    code = (F.when(F.col("p_size") <= 10, "").when(F.col("p_size") <= 20, "REPUBLICAN")
            .when(F.col("p_size") <= 30, "dem").when(F.col("p_size") <= 40, "LIB"))
    cand = F.concat(F.col("p_name"), F.when(F.col("p_retailprice") > 1500, " (Dem)").otherwise(""))
    return p.select(
        "p_partkey",
        T.contest_name(F.concat(F.col("p_name"), F.lit(" Special Election Special Election/"), F.col("p_brand")))
        .alias("contest"),
        T.underscore_spaces("p_name").alias("slug"),
        T.first_token(F.upper("p_name"), "C").alias("token"),
        T.strip_first(F.concat(F.col("p_type"), F.lit(" County")), " County").alias("county"),
        T.party_from_code(code, cand).alias("party"))


# -- enrichment with an unmatched report (J1/J2/J9) ------------------------


def _enriched(spark, d):
    s = S.table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = (S.table(spark, d, "nation").filter(F.col("n_regionkey") != 4)
         .select(F.col("n_nationkey").alias("s_nationkey"), "n_name"))
    return left_enrich_with_report(s, n, ["s_nationkey"])


@register("enrich_left_unmatched", SB.ENRICH_LEFT)
def q_enrich_left_unmatched(spark, d):
    return _enriched(spark, d)[0].select("s_suppkey", "s_name", "s_nationkey", "n_name")


@register("enrich_unmatched_report", SB.ENRICH_UNMATCHED)
def q_enrich_unmatched_report(spark, d):
    return _enriched(spark, d)[1]


@register("feature_centroid", SG.FEATURE_CENTROID)
def q_feature_centroid(spark, d):
    f = S.two_ring_features(spark, d).select("vec_id", "label", G.feature_centroid("geometry").alias("c"))
    return f.select("vec_id", "label", F.col("c.x").alias("cx"), F.col("c.y").alias("cy"))


@register("county_collections", SG.county_collections(S.THIN_TOLERANCE))
def q_county_collections(spark, d):
    from .geography import county_collections, precinct_features
    out = county_collections(precinct_features(_features(spark, d)), S.THIN_TOLERANCE,
                             part=F.ascii(F.substring(F.md5("id"), 1, 1)))
    short = F.transform("features", lambda f: F.struct(f["id"].alias("id"), f["PRECINCT_I"].alias("PRECINCT_I"),
                                                       F.size(G.vertices(f["geometry"])).alias("vertices")))
    return out.withColumn("features", json_text(short))


def _feed_b(spark, d):
    docs = path_columns(S.feed_b_documents(spark, d), FEED_B_FOLDERS + "/{contestId}.json", "path")
    return FP.feed_b_results(docs, FP.ballot_items(S.feed_b_items(spark, d)),
                             FP.locality_records(S.feed_b_localities(spark, d)), S.FEED_B_RACES)


@register("feed_b_flatten", SF.FEED_B)
def q_feed_b_flatten(spark, d):
    return _feed_b(spark, d)[0]


@register("feed_b_report", SF.FEED_B_REPORT)
def q_feed_b_report(spark, d):
    return _feed_b(spark, d)[1]


def _feed_a(spark, d):
    summary = path_columns(S.feed_a_summary(spark, d), FEED_A_FOLDERS + "/en/summary.json", "path")
    return FP.feed_a_results(summary, feed_a_mode(S.feed_a_modes(spark, d), "path"),
                             FP.manifest_records(S.feed_a_manifest(spark, d)),
                             phrases=S.FEED_A_PHRASES, keywords=S.STATUS_KEYWORDS)


@register("feed_a_flatten", SF.FEED_A)
def q_feed_a_flatten(spark, d):
    return _feed_a(spark, d)[0]


@register("feed_a_report", SF.FEED_A_REPORT)
def q_feed_a_report(spark, d):
    return _feed_a(spark, d)[1]


@register("xml_flatten", SF.XML_FEED)
def q_xml_flatten(spark, d):
    from ..sources.feeds import XML_SCHEMA
    doc = S.xml_documents(spark, d).select(F.from_xml("xml", XML_SCHEMA).alias("d")).select("d.*")
    return FD.flatten_xml_feed(doc)[0]


@register("history_rows_and_rejects", SP.HISTORY_ROWS_AND_REJECTS)
def q_history_rows_and_rejects(spark, d):
    """Both outputs in one pass over the lines: ``rows_of`` and ``rejects_of``
    side by side, told apart by ``kind``."""
    parsed = P.history_new_records(S.history_new_damaged(spark, d))
    row = F.col("reason").isNull()
    return parsed.select(
        F.when(row, "row").otherwise("reject").alias("kind"), F.when(row, F.col("r.Voter Registration Number")).alias("id"),
        F.when(row, F.col("r.County Name")).alias("county"), F.when(row, F.col("r.Election Date")).alias("election"),
        F.when(row, yes_flag("r.Absentee")).alias("absentee"), F.when(~row, F.col("value")).alias("record"), "reason")


@register("history_record_counts", SP.HISTORY_RECORD_COUNTS)
def q_history_record_counts(spark, d):
    return count_records(P.history_new_records(S.history_new_damaged(spark, d)))


def _features(spark, d):
    from ..sources.geojson import parse_features
    return parse_features(S.geojson_text(spark, d), "feature", S.FEATURE_PROPERTIES)


@register("geojson_features", SG.GEOJSON_FEATURES)
def q_geojson_features(spark, d):
    from .geography import precinct_features
    f = precinct_features(_features(spark, d))
    return f.select("id", "CTYNAME", "PRECINCT_I", F.col("centroid")[0].alias("cx"), F.col("centroid")[1].alias("cy"))


@register("county_demographics", SG.COUNTY_DEMOGRAPHICS)
def q_county_demographics(spark, d):
    from .geography import county_demographics
    return county_demographics(_features(spark, d))


@register("precinct_demographics", SG.PRECINCT_DEMOGRAPHICS)
def q_precinct_demographics(spark, d):
    from .geography import precinct_demographics
    return precinct_demographics(_features(spark, d))


@register("id_to_name", SG.ID_TO_NAME)
def q_id_to_name(spark, d):
    from .geography import id_to_name
    return id_to_name(_features(spark, d))


@register("xml_rejects", SF.XML_REJECTS)
def q_xml_rejects(spark, d):
    from ..sources.feeds import XML_SCHEMA
    doc = S.xml_documents(spark, d).select(F.from_xml("xml", XML_SCHEMA).alias("d")).select("d.*")
    return FD.flatten_xml_feed(doc)[1]


@register("ballots_id_map", SB.BALLOTS_ID_MAP)
def q_ballots_id_map(spark, d):
    """C1's base with the optional id map (J1): unmapped precincts are null."""
    return cleanse_ballots(S.ballots(spark, d), S.BALLOT_COLS, S.ballot_id_map(spark, d)).drop("_returned")


@register("county_name_map", SN.COUNTY_NAME_MAP)
def q_county_name_map(spark, d):
    """The names of one county (P12), null names skipped (P11), scores printed."""
    from .jobs import printed_scores
    from .names import results_name_map
    names = S.match_names(spark, d).select("county", F.when(~F.col("name").startswith("blue"), F.col("name")).alias("precinct"))
    return printed_scores(results_name_map(names, S.match_labels(spark, d), county="promo")[0])


@register("csv_ballots", SB.CSV_BALLOTS_COUNTY)
def q_csv_ballots(spark, d):
    lines = S.ballot_csv_lines(spark, d)
    raw = compute_once(lines, F.from_csv("value", S.BALLOT_TEXT_SCHEMA), "r").select("r.*")
    base = cleanse_ballots(raw, S.BALLOT_TEXT_COLS).drop("_returned")
    return by_day_at_level(base, ["county"], S.ELECTION_DATE)


@register("csv_profiles", SP.CSV_PROFILES)
def q_csv_profiles(spark, d):
    from ..sources.csv import PROFILE_SCHEMA
    lines = S.profile_csv_sources(spark, d)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in PROFILE_SCHEMA.fields)
    parsed = compute_once(lines, F.from_csv("value", ddl), "r")
    profiles = parsed.select("r.*", F.col("year").alias("absenteeDataYear"))
    out = P.latest_profiles(profiles)
    return out.select("id", "firstName", "middleName", "lastName", "Suffix", "streetNumber", "streetName",
                      "Apt/Unit", "city", "state", "zip", "countyCurrent", "absenteeDataYear")


@register("csv_history_new", SP.CSV_HISTORY_NEW)
def q_csv_history_new(spark, d):
    from ..sources.csv import HISTORY_NEW_SCHEMA
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in HISTORY_NEW_SCHEMA.fields)
    raw = compute_once(S.history_new_csv(spark, d), F.from_csv("value", ddl, {"dateFormat": "MM/dd/yyyy"}),
                       "r").select("r.*")
    return P.normalise_history_new(raw)
