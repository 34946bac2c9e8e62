"""Domain views over the driver's benchmark tables.

The election tables are not shipped, so each pipeline is exercised on a
stand-in derived by Spark from the given tables (whole tables, no
sampling). The mapping is fixed here once and mirrored by the oracle SQL:

* ballots (T1)   <- orders: priority = county, customer = precinct,
                    status 'F' = accepted, order date = return date
* results (T2)   <- events joined to customer: segment = county, customer
                    name = precinct, event type = party (click/view =
                    democratic/republican, rest folded into other)
* name map (T4)  <- customer with a non-negative balance (others unmatched)
* profiles (T6') <- customer joined to nation
* history (T7)   <- orders
* names/labels   <- distinct part names blocked by part type
* polygons (T9)  <- each embedding = one ring of 32 (x, y) vertices
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .ballots import BallotColumns
from .geography import REGISTRATION_COUNTS

ELECTION_DATE = "1998-11-03"
BALLOT_COLS = BallotColumns(county="County", precinct="County Precinct", status="Ballot Status",
                            returned="Ballot Return Date", voter_id="Voter Registration #",
                            accepted="F", date_format=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table as it is now."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ballots(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderpriority").alias("County"),
                    F.col("o_custkey").cast("string").alias("County Precinct"),
                    F.col("o_orderstatus").alias("Ballot Status"),
                    F.col("o_orderdate").alias("Ballot Return Date"),
                    F.col("o_custkey").alias("Voter Registration #"))


def _k(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast("int")


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "value", "props")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    # k is parsed once in its own projection; Catalyst keeps that projection
    # rather than inline the JSON parse into the three uses below.
    from ..operators.nest import compute_once
    e = compute_once(e.select("user_id", "event_type", "value", "props"), _k(), "k").drop("props")
    k = F.col("k")
    j = e.join(c, e.user_id == c.c_custkey, "inner")
    return j.select(
        F.concat(F.lit("race "), F.floor(k / 25).cast("string")).alias("race"),
        F.col("c_mktsegment").alias("county"),
        F.col("c_name").alias("precinct"),
        F.when(k >= 95, F.lit("Under/Over Votes")).otherwise(F.concat(F.lit("cand "), k.cast("string")))
        .alias("candidate"),
        F.when(F.col("event_type") == "click", "democratic").when(F.col("event_type") == "view", "republican")
        .otherwise(F.col("event_type")).alias("party"),
        F.when(F.col("value") < 50, "Election Day Votes").when(F.col("value") < 150, "Absentee by Mail Votes")
        .otherwise("Advance Voting Votes").alias("mode"),
        F.floor(F.col("value")).cast("long").alias("votes"),
    )


def ballot_id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absentee precinct -> map id, for customers whose number 3 doesn't divide;
    where 5 does, there are two entries (the smaller id counts)."""
    o = table(spark, sf_dir, "orders").select(F.upper("o_orderpriority").alias("county"), F.col("o_custkey").alias("c")).distinct()
    ids = F.when(F.pmod("c", F.lit(5)) == 0, F.array(F.lit("z"), F.lit("m"))).otherwise(F.array(F.lit("m")))
    return (o.filter(F.pmod("c", F.lit(3)) != 0).withColumn("k", F.explode(ids))
            .select("county", F.col("c").cast("string").alias("absenteePrecinct"),
                    F.concat("k", F.col("c").cast("string")).alias("precinct")))


def results_name_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return (c.filter(F.col("c_acctbal") >= 0)
            .select(F.upper(F.col("c_mktsegment")).alias("county"),
                    F.concat(F.lit("p"), F.col("c_custkey").cast("string")).alias("precinct"),
                    F.col("c_name").alias("mapPrecinctName"),
                    F.col("c_name").alias("electionResultsPrecinctName"),
                    F.lit(100.0).alias("score")))


def line_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2-shaped rows from lineitem x part for the C8 totals."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_quantity")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name")
    j = li.join(p, li.l_partkey == p.p_partkey, "inner")
    return j.select(F.col("p_type").alias("race"), F.col("l_returnflag").alias("county"),
                    F.col("p_name").alias("candidate"), F.col("l_quantity").cast("long").alias("votes"))


# -- people ----------------------------------------------------------------

PRIORITY_BY_STATUS = (("F", 2022.0), ("O", 2023.0), ("P", 2024.1))


def profile_sources(spark: SparkSession, sf_dir: str) -> list[tuple[DataFrame, float]]:
    """Orders split by status into three yearly 'profile files'; the newest
    lacks the price column (schema drift between years)."""
    o = table(spark, sf_dir, "orders")
    out = []
    for status, prio in PRIORITY_BY_STATUS:
        cols = [F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("City")]
        if status != "P":
            cols.append(F.col("o_totalprice").alias("totalprice"))
        out.append((o.filter(F.col("o_orderstatus") == status).select(*cols), prio))
    return out


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    return j.select(F.col("c_custkey").alias("id"),
                    F.substring_index("c_name", "#", 1).alias("firstName"),
                    F.substring_index("c_name", "#", -1).alias("lastName"),
                    F.col("n_name").alias("countyCurrent"),
                    F.col("c_mktsegment").alias("city"))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    code = F.substring("o_orderpriority", 1, 1)
    return o.select(
        F.col("o_orderkey").alias("rowId"),
        F.col("o_custkey").alias("id"),
        F.col("o_orderpriority").alias("county"),
        F.to_date("o_orderdate").alias("election"),
        code.cast("int").alias("electionTypeCode"),
        F.when(code == "1", "D").when(code == "2", "R").when(code == "3", "NP").otherwise("").alias("party"),
        (F.col("o_totalprice") < 100000).alias("absentee"),
        (F.col("o_totalprice") > 400000).alias("provisional"),
        (F.col("o_orderpriority") == "5-LOW").alias("supplemental"),
    )


def history_old_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7a-shaped rows (text flags Y/N/blank) from lineitem."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_linenumber").alias("County Number"),
        F.col("l_orderkey").cast("int").alias("Registration Number"),
        F.to_date("l_shipdate").alias("Election Date"),
        F.col("l_linenumber").alias("Election Type"),
        F.when(F.col("l_returnflag") == "N", "D").when(F.col("l_returnflag") == "R", "R")
        .when(F.col("l_returnflag") == "A", "NP").alias("Party"),
        F.when(F.col("l_returnflag") == "R", "Y").when(F.col("l_returnflag") == "A", "N").alias("Absentee"),
        F.when(F.col("l_linestatus") == "O", "Y").otherwise("N").alias("Provisional"),
        F.when(F.col("l_discount") > 0.08, "Y").when(F.col("l_discount") < 0.02, " ").otherwise("N")
        .alias("Supplemental"),
    )


def election_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    return r.select(F.col("r_regionkey").alias("electionType"), F.col("r_name").alias("electionTypeName"))


# -- names -----------------------------------------------------------------

MATCH_RULES = (("SMALL", "first_token", ""), ("MEDIUM", "first_token", "C"))


def match_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free-text names: part name + brand, blocked by part type."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_type").alias("county"),
                    F.concat_ws(" ", "p_name", "p_brand").alias("name"))


def match_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map labels: distinct part names; id = upper first word."""
    p = table(spark, sf_dir, "part")
    return p.select(F.upper("p_type").alias("county"),
                    F.upper(F.substring_index("p_name", " ", 1)).alias("precinct"),
                    F.col("p_name").alias("precinctName")).distinct()


def match_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").filter(F.col("p_size") == 50)
    return p.select(F.upper("p_type").alias("county"),
                    F.concat(F.lit("OVR"), F.col("p_partkey").cast("string")).alias("precinct"),
                    F.col("p_name").alias("mapPrecinctName"),
                    F.concat_ws(" ", "p_name", "p_brand").alias("electionResultsPrecinctName"))


def match_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(MATCH_RULES), "county string, rule string, suffix string")


def id_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_type").alias("county"), F.upper("p_brand").alias("precinct")).distinct()


def id_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_type").alias("county"),
                    F.concat(F.lit("BRAND#"), F.col("p_size").cast("string")).alias("precinct")).distinct()


# -- geography -------------------------------------------------------------

THIN_TOLERANCE = 0.05


def rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ring per embedding: consecutive value pairs are (x, y)."""
    from ..operators.geometry import points_from_flat
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", points_from_flat("embedding").alias("ring"))


# -- feeds and text functions ---------------------------------------------

KEYWORDS = (("republican", ("RED", "HOT")), ("democratic", ("BLUE", "COLD")))
FLAG_MODES = {"A": "Absentee by Mail", "N": "Election Day", "R": "Provisional"}


def fixed_width_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History lines in the 3/8/8/3/2/1/1/1 layout, written from orders."""
    o = table(spark, sf_dir, "orders")
    party = (F.when(F.col("o_orderstatus") == "F", "D ").when(F.col("o_orderstatus") == "O", "NP")
             .otherwise("  "))
    line = F.concat(
        F.lpad(F.substring("o_orderpriority", 1, 1), 3, "0"),
        F.lpad(F.col("o_custkey").cast("string"), 8, "0"),
        F.date_format("o_orderdate", "yyyyMMdd"),
        F.lpad((F.year("o_orderdate") - 1990).cast("string"), 3, "0"),
        party,
        F.when(F.col("o_totalprice") < 100000, "Y").otherwise("N"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Y").otherwise(" "),
        F.lit("N"))
    return o.select(line.alias("value"))


def region_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per region: locality name plus parallel pipe-delimited lists
    of its nations' names and keys (bounded by the nation dimension)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey, "inner")
    g = j.groupBy("r_name").agg(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("ns"))
    return g.select(F.concat(F.col("r_name"), F.lit(" County")).alias("locality"),
                    F.concat_ws("|", F.transform("ns", lambda x: x["n_name"])).alias("names"),
                    F.concat_ws("|", F.transform("ns", lambda x: x["n_nationkey"].cast("string"))).alias("keys"))


def two_ring_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One polygon per embedding: values 0-31 are the outer ring, values
    32-63 a hole (16 vertices each)."""
    from ..operators.geometry import points_from_flat
    e = table(spark, sf_dir, "embeddings")
    n = F.size("embedding")
    outer = points_from_flat(F.slice("embedding", 1, n / 2))
    hole = points_from_flat(F.slice("embedding", n / 2 + 1, n / 2))
    return e.select("vec_id", "label", F.array(F.array(outer, hole)).alias("geometry"))


#: Effective area below which a vertex of a border goes (units of ``border_strips``).
BORDER_AREA = 100000.0


def border_strips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One strip per embedding that has a successor by vec_id, between the
    border lines of both: value j of embedding i is the vertex
    (4000 i + floor(1000 value), 1000 j). Neighbouring strips share a line."""
    e = table(spark, sf_dir, "embeddings").where(F.size("embedding") >= 2)
    line = F.transform("embedding", lambda v, j: F.struct(
        (F.col("vec_id") * 4000.0 + F.floor(v.cast("double") * 1000)).cast("double").alias("x"),
        (j * 1000.0).cast("double").alias("y")))
    left = e.select("vec_id", line.alias("_left"))
    right = left.select((F.col("vec_id") - 1).alias("vec_id"), F.col("_left").alias("_right"))
    ring = F.concat("_left", F.reverse("_right"), F.slice("_left", 1, 1))
    return left.join(right, "vec_id").select("vec_id", F.array(F.array(ring)).alias("geometry"))


#: Counties of the feed documents; an order belongs to that of its customer's number.
FEED_COUNTIES = ("Cobb", "Fulton", "Ben_Hill", "Jeff Davis")


def _feed_county(number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in FEED_COUNTIES]), (F.pmod(number, F.lit(len(FEED_COUNTIES))) + 1).cast("int"))


def _in_path(name: Column) -> Column:
    """As it stands in a file path."""
    return F.replace(name, F.lit(" "), F.lit("%20"))


def feed_counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counties that have orders: their number and name."""
    n = F.pmod("o_custkey", F.lit(len(FEED_COUNTIES)))
    return table(spark, sf_dir, "orders").select(n.alias("number")).distinct().withColumn("county", _feed_county(F.col("number")))


FEED_B_RACES = ("US Senate", "Governor")


def feed_b_localities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of feed B: one document that lists all localities."""
    one = F.struct(F.lower("county").alias("shortName"),
                   F.array(F.struct(F.concat("county", F.lit(" County")).alias("text"))).alias("name"))
    return feed_counties(spark, sf_dir).agg(F.collect_list(one).alias("childLocalities"))


def feed_b_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ballot items of each locality. The ids 0 to 2 mean another contest in
    each: county number + 1 is the first Senate contest, + 2 the second."""
    def item(i, name):
        return F.struct(F.pmod(F.col("number") + i, F.lit(3)).cast("string").alias("id"),
                        F.array(F.struct(F.lit(name).alias("text"))).alias("name"))

    return feed_counties(spark, sf_dir).select(F.lower("county").alias("locality"), F.array(
        item(0, "County Sheriff"), item(1, "US Senate (Rep)"), item(2, "US Senate Special")).alias("data"))


def feed_b_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed-B shaped documents derived from orders, one per order, with the
    path that they would land under (its folder tells the locality, its name
    the contest: the order key modulo 3): the
    customer is the precinct, the order one ballot option named after its
    status (party code F -> REP, O -> DEM, P -> empty) with votes =
    thousands of its price; per-mode results count them on election day
    for urgent orders and report zeros otherwise (then only the total is
    usable). Map-only: no grouping is needed to form the documents."""
    o = table(spark, sf_dir, "orders")
    votes = F.floor(F.col("o_totalprice") / 1000).cast("long")
    urgent = F.col("o_orderpriority") == "1-URGENT"

    def name(c):
        return F.array(F.struct(c.alias("text")))

    option = F.struct(
        name(F.concat(F.lit("opt "), F.col("o_orderstatus"))).alias("name"),
        F.struct(name(F.when(F.col("o_orderstatus") == "F", "REP").when(F.col("o_orderstatus") == "O", "DEM")
                      .otherwise("")).alias("name")).alias("party"),
        votes.alias("voteCount"),
        F.array(F.struct(name(F.lit("Election Day")).alias("groupName"),
                         F.when(urgent, votes).otherwise(F.lit(0).cast("long")).alias("voteCount")),
                F.struct(name(F.lit("Absentee by Mail")).alias("groupName"),
                         F.lit(0).cast("long").alias("voteCount"))).alias("groupResults"))
    path = F.concat(F.lit("file:/landed/b/"), _in_path(F.lower(_feed_county(F.col("o_custkey")))), F.lit("/E1/ballot-items/"),
                    F.pmod("o_orderkey", F.lit(3)).cast("string"), F.lit(".json"))
    return o.select(path.alias("path"), F.array(F.struct(
        F.struct(name(F.col("o_custkey").cast("string")).alias("name")).alias("precinct"),
        F.array(option).alias("ballotOptions"))).alias("breakdownResults"))


FEED_A_PHRASES = ("1-URGENT", "2-HIGH", "3-MEDIUM")
STATUS_KEYWORDS = (("republican", ("F",)), ("democratic", ("O",)))


def _order_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.when(F.col("o_totalprice") < 200000, "Election Day Votes").otherwise("Absentee by Mail Votes")
                    .alias("mode"), F.col("o_custkey").cast("string").alias("precinct"),
                    _feed_county(F.col("o_custkey")).alias("county"),
                    F.col("o_orderpriority").alias("contest"), F.col("o_orderstatus").alias("candidate"),
                    F.floor(F.col("o_totalprice") / 1000).cast("long").alias("q"))


def feed_a_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of feed A: one document with a string per county; version 2 is
    the current one everywhere."""
    return feed_counties(spark, sf_dir).agg(F.collect_list(F.concat(
        F.col("county"), F.lit("|"), F.col("number") + 100, F.lit("|2|x"))).alias("participatingcounties"))


def _feed_a_path(county: Column, version: Column, file: Column) -> Column:
    eid = (F.array_position(F.array(*[F.lit(c) for c in FEED_COUNTIES]), county) + 99).cast("string")
    return F.concat(F.lit("file:/landed/a/"), _in_path(county), F.lit("/"), eid, F.lit("/"), version, F.lit("/json/"), file)


def feed_a_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed-A contest summaries with their paths: one row per county and order
    priority (contest id K = its first digit, text C with a '/' suffix,
    candidate list CH = its order statuses, in falling order in the counties
    whose name has a blank or underscore, so that a lookup in another county's
    list would go wrong)."""
    v = _order_votes(spark, sf_dir)
    g = v.groupBy("county", "contest").agg(F.array_sort(F.collect_set("candidate")).alias("CH"))
    ch = F.when(F.col("county").rlike("[ _]"), F.reverse("CH")).otherwise(F.col("CH"))
    return g.select(_feed_a_path(F.col("county"), F.lit("2"), F.lit("en/summary.json")).alias("path"),
                    F.substring("contest", 1, 1).alias("K"), F.concat(F.col("contest"), F.lit("/stand-in")).alias("C"),
                    ch.alias("CH"))


def feed_a_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed-A mode documents with their paths: one per order (its customer is
    the precinct) with the parallel arrays C = [contest id] and V = [votes per
    candidate in the county's summary order: the order's votes at its status,
    zeros elsewhere], plus one '-1' total line per county and mode (the only
    aggregate, over county x mode x contest x status). Customers whose number
    5 divides also have documents of an older version, which don't count."""
    v = _order_votes(spark, sf_dir)
    s = feed_a_summary(spark, sf_dir)
    county = F.replace(F.split_part("path", F.lit("/"), F.lit(4)), F.lit("%20"), F.lit(" "))
    ch = s.select(county.alias("county"), F.substring_index("C", "/", 1).alias("contest"), "K", "CH")

    def doc(df: DataFrame, precinct: Column, version: str = "2") -> DataFrame:
        aligned = F.transform("CH", lambda c: F.when(c == F.col("candidate"), F.col("q"))
                              .otherwise(F.lit(0).cast("long")))
        file = F.concat(F.replace("mode", F.lit(" "), F.lit("_")), F.lit(".json"))
        return (df.join(ch, ["county", "contest"], "inner")
                .select(_feed_a_path(F.col("county"), F.lit(version), file).alias("path"),
                        F.array(F.struct(precinct.alias("A"), F.array("K").alias("C"),
                                         F.array(aligned).alias("V"))).alias("Contests")))

    totals = v.groupBy("county", "mode", "contest", "candidate").agg(F.sum("q").alias("q"))
    old = v.where(F.pmod(F.col("precinct").cast("long"), F.lit(5)) == 0)
    return (doc(v, F.col("precinct")).unionByName(doc(totals, F.lit("-1")))
            .unionByName(doc(old, F.col("precinct"), "1")))


def xml_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result-feed XML text derived from customer, one document per
    customer: the market segment is the county, the customer a precinct;
    a "US Senate Special Election/..." contest with one candidate (Kemp
    for balances of 5,000 and more, Ossoff otherwise) whose election-day
    votes are hundreds of the balance (negative -> dropped) and one
    under/over vote. Customers 0 modulo 10 also have a contest without
    choices, those 1 modulo 10 one without under/over votes, those 2 modulo 10
    one whose choice has no vote types (all rejects). Serialised
    with ``to_xml`` (attributes from the ``_``-prefixed fields), so reading
    it back is a real XML parse."""
    c = table(spark, sf_dir, "customer")
    pre = F.col("c_custkey").cast("string")
    votes = F.floor(F.col("c_acctbal") / 100).cast("long")
    cand = F.when(F.col("c_acctbal") >= 5000, "Kemp").otherwise("Ossoff")

    def precinct(v):
        return F.array(F.struct(pre.alias("_name"), v.alias("_votes")))

    def vote_type(name, v):
        return F.array(F.struct(F.lit(name).alias("_name"), precinct(v).alias("Precinct")))

    def contest(text, candidate, choices=F.lit(True), modes=F.lit(True), under=F.lit(True)):
        return F.struct(
            text.alias("_text"),
            F.when(choices, F.array(F.struct(candidate.alias("_text"), F.when(modes, vote_type("Election Day Votes", votes))
                                             .alias("VoteType")))).alias("Choice"),
            F.when(under, vote_type("Undervotes", F.lit(1).cast("long"))).alias("VoteType"))

    senate = contest(F.concat(F.lit("US Senate Special Election/"), F.col("c_nationkey").cast("string")), cand)
    kind = F.pmod("c_custkey", F.lit(10))
    broken = contest(F.lit("Governor"), cand, kind != 0, kind != 2, kind != 1)
    contests = F.when(kind < 3, F.array(senate, broken)).otherwise(F.array(senate))
    doc = F.struct(F.col("c_mktsegment").alias("Region"), contests.alias("Contest"))
    return c.select(F.to_xml(doc, {"rowTag": "ElectionResult"}).alias("xml"))


FEATURE_PROPERTIES = ("ID string, CNTY string, CTYNAME string, PRECINCT_I string, PRECINCT_N string, "
                      + ", ".join(f"{c} long" for c in REGISTRATION_COUNTS))


def geojson_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GeoJSON feature text written with ``to_json`` from embeddings: one
    polygon feature per vector (its 32 (x, y) pairs as the ring), county
    ``county<label>`` in lower case, no precinct id for label 0, and all
    registration counts: the i-th is i + 1 times the vector's number, missing
    where the label is i modulo 10 (but the first, which is never missing)."""
    from ..operators.geometry import points_from_flat
    e = table(spark, sf_dir, "embeddings")
    ring = F.transform(points_from_flat("embedding"), lambda p: F.array(p.x, p.y))
    props = F.struct(
        F.col("vec_id").cast("string").alias("ID"), F.col("label").cast("string").alias("CNTY"),
        F.concat(F.lit("county"), F.col("label").cast("string")).alias("CTYNAME"),
        F.when(F.col("label") != 0, F.concat(F.lit("p"), F.col("vec_id").cast("string"))).alias("PRECINCT_I"),
        F.concat(F.lit("precinct "), F.col("vec_id").cast("string")).alias("PRECINCT_N"),
        *[F.when((F.col("label") != i % 10) | F.lit(i == 0), F.col("vec_id") * (i + 1)).alias(c)
          for i, c in enumerate(REGISTRATION_COUNTS)])
    feature = F.struct(F.lit("Feature").alias("type"), props.alias("properties"),
                       F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    return e.select(F.to_json(feature).alias("feature"))


BALLOT_TEXT_COLS = BallotColumns(accepted="F")       # header names, text dates MM/dd/yyyy
BALLOT_TEXT_SCHEMA = ("`County` string, `Voter Registration #` string, `Ballot Status` string, "
                      "`Ballot Return Date` string, `County Precinct` string")


def ballot_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ballot-file CSV lines written with ``to_csv`` from orders: return
    dates as MM/dd/yyyy text, except orders above 400,000 whose date text
    is not a date (13/45/<year>), as in damaged files."""
    o = table(spark, sf_dir, "orders")
    date_text = F.when(F.col("o_totalprice") > 400000,
                       F.concat(F.lit("13/45/"), F.year("o_orderdate").cast("string"))
                       ).otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
    rec = F.struct(F.col("o_orderpriority").alias("County"),
                   F.col("o_custkey").cast("string").alias("Voter Registration #"),
                   F.col("o_orderstatus").alias("Ballot Status"), date_text.alias("Ballot Return Date"),
                   F.col("o_custkey").cast("string").alias("County Precinct"))
    return o.select(F.to_csv(rec).alias("value"))


def _profile_line(c: DataFrame, city: Column) -> DataFrame:
    """One profile-file CSV line per customer, 12 fields in the file's order
    plus an extra trailing field; the id is not numeric for negative
    balances (it must become null and drop out)."""
    rid = F.when(F.col("c_acctbal") < 0, F.concat(F.lit("x"), F.col("c_custkey").cast("string"))) \
        .otherwise(F.col("c_custkey").cast("string"))
    rec = F.struct(F.col("n_name").alias("a"), rid.alias("b"),
                   F.concat(F.lit("MC "), F.upper("c_mktsegment")).alias("c"), F.upper("c_name").alias("d"),
                   F.lit(None).cast("string").alias("e"), F.lit(None).cast("string").alias("f"),
                   F.col("c_custkey").cast("string").alias("g"), F.lit("MAIN ST").alias("h"),
                   F.lit(None).cast("string").alias("i"), city.alias("j"), F.lit("ZZ").alias("k"),
                   F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("l"), F.lit("extra").alias("m"))
    return c.select(F.to_csv(rec).alias("value"))


def profile_csv_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two yearly profile files as CSV text: every customer in the older
    one (city = segment), customers with a balance over 5,000 again in the
    newer one with another city; a ``year`` column tags the file."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"),
                                             "inner")
    old = _profile_line(c, F.upper("c_mktsegment")).withColumn("year", F.lit(2022.0))
    new = _profile_line(c.filter(F.col("c_acctbal") > 5000), F.lit("NEW TOWN")).withColumn("year", F.lit(2024.1))
    return old.unionByName(new)


def history_new_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newer-layout history CSV lines from orders: county name,
    id, MM/dd/yyyy date, election type text, party word (DEMOCRAT /
    REPUBLICAN / NON-PARTISAN / blank by priority), ballot style, Y/N flags."""
    o = table(spark, sf_dir, "orders")
    code = F.substring("o_orderpriority", 1, 1)
    party = (F.when(code == "1", "DEMOCRAT").when(code == "2", "REPUBLICAN").when(code == "3", "NON-PARTISAN")
             .otherwise(F.lit(None).cast("string")))
    yn = lambda cond: F.when(cond, "Y").otherwise("N")
    rec = F.struct(F.concat(F.lit("COUNTY "), code).alias("a"), F.col("o_custkey").cast("string").alias("b"),
                   F.date_format("o_orderdate", "MM/dd/yyyy").alias("c"),
                   F.when(code == "1", "PRIMARY").otherwise("GENERAL").alias("d"), party.alias("e"),
                   F.concat(F.lit("S"), code).alias("f"), yn(F.col("o_totalprice") < 100000).alias("g"),
                   yn(F.col("o_totalprice") > 400000).alias("h"), yn(code == "5").alias("i"))
    return o.select(F.to_csv(rec).alias("value"))


def history_new_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``history_new_csv`` as it may arrive, damaged by order key: every 7th
    line lacks its last fields, every 11th has letters in the id, every 13th
    a date of another form, every 17th no id, every 19th is empty."""
    o = table(spark, sf_dir, "orders")
    code = F.substring("o_orderpriority", 1, 1)
    bad = lambda n: F.pmod("o_orderkey", F.lit(n)) == 0
    ident = F.when(bad(11), F.concat(F.lit("R"), F.col("o_custkey"))).when(bad(17), "").otherwise(F.col("o_custkey").cast("string"))
    date = F.when(bad(13), F.date_format("o_orderdate", "yyyy.MM.dd")).otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
    line = F.concat_ws(",", F.concat(F.lit("COUNTY "), code), ident, date,
                       F.when(bad(7), "GENERAL").otherwise("GENERAL,,S1,Y,N,N"))
    return o.select(F.when(bad(19), "").otherwise(line).alias("value"))
