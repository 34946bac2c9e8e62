"""Name resolution (C5): blocked best match (M1/M3), rule cascade (M2),
review queue (M4).

The best label is found without scoring all pairs of a block, and exactly.
Names and labels are reduced to distinct values and cut into bigrams of the
blank-padded text. Words in another order have the same bigrams, so one index
serves the plain and the token-sorted score. An edit destroys two bigrams at
most, hence a label that scores at least s against a name of m characters
shares T = m + 1 - 2 m (201 - 2 s) / 200 of its m + 1 bigrams, and at least
one of the m + 2 - T that are rarest among the block's labels. So

1. every name learns how many labels of its block hold each of its bigrams;
2. the likeliest label under its rarest bigrams is scored: that is s;
3. the name looks up its m + 2 - T rarest bigrams; a name that shares too
   few for that (T < 1), or whose lists are longer than the block, looks at
   the whole block instead;
4. pairs whose signatures rule out s are dropped, the others are scored.

The best label per name is ``min(struct(-score, label, id))``: an aggregate
with map-side partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.similarity import similarity, token_sort
from ..functions.text import first_token, squeeze_upper
from ..operators.enrich import first_per_key
from ..operators.nest import compute_once

UNKNOWN_LABEL = "??"

#: Parts into which the names of a block that look at the whole block are
#: dealt; the block's labels are copied to each.
SALT_BUCKETS = 16
#: The first label is sought under the rarest bigrams, as long as they hold
#: this many labels together (at least under the rarest). More make the
#: bound better and the search for it longer; the result is the same.
SEED_LABELS = 1024
#: The list of all labels of a block, looked up like a bigram.
WHOLE = ""


def _numbered(pieces: Column) -> Column:
    """A bag as a set: each piece with the number of its occurrence."""
    # Bound once: the lambda would sort the array anew for every element.
    return F.flatten(F.transform(F.array(F.array_sort(pieces)), lambda p: F.transform(
        p, lambda x, i: F.concat(x, (i - F.array_position(p, x) + 1).cast("string")))))


def bigrams(text: Column) -> Column:
    """The numbered bigrams of the text with a blank before and after."""
    return _numbered(F.transform(F.sequence(F.lit(1), F.length(text) + 1),
                                 lambda i: F.substring(F.concat(F.lit(" "), text, F.lit(" ")), i, F.lit(2))))


def _signature(column: str) -> Column:
    """64 bits, one set per element; what is in one set of bits but not in
    another is in one array but not in the other."""
    return F.expr(f"aggregate({column}, 0L, (a, x) -> a | shiftleft(1L, cast(pmod(xxhash64(x), 64) as int)))")


def _described(df: DataFrame, text: Column, prefix: str, token_sorted: bool) -> DataFrame:
    """Columns of the squeezed text: itself, token-sorted, length, bigrams,
    signatures of characters and of bigrams."""
    c = {k: f"__{prefix}{k}" for k in ("t", "s", "m", "g", "cs", "gs")}
    df = compute_once(df, squeeze_upper(text), c["t"])
    df = compute_once(df, F.struct(bigrams(F.col(c["t"])).alias("g"), _numbered(F.split(c["t"], "")).alias("c")), "__bags")
    df = df.withColumns({c["s"]: token_sort(c["t"]) if token_sorted else F.col(c["t"]), c["m"]: F.length(c["t"]),
                         c["g"]: F.col("__bags.g")})
    return compute_once(df, F.struct(_signature("__bags.c").alias(c["cs"]), _signature("__bags.g").alias(c["gs"])),
                        "__signs").select("*", "__signs.*").drop("__bags", "__signs")


def _least_distance() -> Column:
    """No more than the edit distance of name (n) and label (l), in either
    order of the words.

    An edit script of i insertions, d deletions and s substitutions from
    label to name has i - d = name's length - label's length. A label's
    character that the name lacks is deleted or substituted, so i + d + s is
    at least the surplus length plus the number of those; likewise the other
    way round. Bigrams that are lacking bound it by half, as an insertion
    destroys one bigram of the label and every other edit two.
    """
    longer, shorter = F.expr("greatest(__nm - __lm, 0)"), F.expr("greatest(__lm - __nm, 0)")
    only = lambda a, b, s: F.expr(f"bit_count(__{a}{s} & ~__{b}{s})")
    half = lambda surplus, lack: F.floor((surplus + lack + 1) / 2).cast("int")
    return F.greatest(longer + only("l", "n", "cs"), shorter + only("n", "l", "cs"),
                      half(longer, only("l", "n", "gs")), half(shorter, only("n", "l", "gs")))


def _score_at(distance: Column) -> Column:
    n = F.greatest(F.col("__nm"), F.col("__lm"))
    return F.when(n == 0, 100).otherwise(F.floor((200 * (n - distance) + n) / (2 * n))).cast("int")


def _pair_score(token_sorted: bool) -> Column:
    plain = similarity("__nt", "__lt")
    return F.greatest(plain, similarity("__ns", "__ls")) if token_sorted else plain


def candidate_pairs(names: DataFrame, labels: DataFrame, block: Sequence[str], name_col: str, label_col: str, id_col: str,
                    token_sorted: bool = True, salt_buckets: int = SALT_BUCKETS) -> DataFrame:
    """The pairs that may be a name's best one: all columns of ``names`` (distinct
    rows), the columns of both texts (``__n*``, ``__l*``), ``__label``, ``__id`` and
    the seed's ``__seed`` score. Each pair comes once; each name's best pair is among
    them; a name whose block has no label comes once, with nulls."""
    block = list(block)
    own = names.columns
    # Few rows make many: their shuffles keep all partitions, as AQE can't foresee the growth.
    parts = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = _described(names.repartition(parts, *block, name_col), F.col(name_col), "n", token_sorted)
    lab = _described(labels.select(*block, F.col(label_col).alias("__label"), F.col(id_col).alias("__id"))
                     .filter(F.col("__label").isNotNull()), F.col("__label"), "l", token_sorted)
    # A label's number is its place in the seeds' choice; any label of a place will do there.
    lab = lab.withColumn("__no", F.pmod(F.xxhash64("__label", "__id"), F.lit(1 << 40)))
    index = lab.withColumn("__gram", F.explode(F.concat(F.array(F.lit(WHOLE)), "__lg")))
    lists = index.groupBy(*block, "__gram").agg(F.count(F.lit(1)).alias("__size"))

    # 1. The name's bigrams by the number of labels that hold them, the rarest first.
    text = [c for c in n.columns if c not in own]
    keys = [*own, *[c for c in text if c != "__ng"]]
    known = (n.withColumn("__gram", F.explode(F.concat(F.array(F.lit(WHOLE)), "__ng"))).drop("__ng")
             .join(lists, [*block, "__gram"], "left")
             .groupBy(*keys).agg(F.array_sort(F.collect_list(F.when(F.col("__gram") != WHOLE, F.struct(
                 F.coalesce("__size", F.lit(0)).alias("size"), F.col("__gram").alias("gram"))))).alias("__lists"),
                 F.max(F.when(F.col("__gram") == WHOLE, F.col("__size"))).alias("__labels")))

    # 2. The likeliest label under the rarest bigrams that any label holds.
    shared = known.withColumn("__held", F.filter("__lists", lambda g: g["size"] > 0))
    some = F.expr(f"aggregate(__held, struct(0 as n, 0L as labels), (a, g) -> struct("
                  f"a.n + if(a.labels + g.size <= {SEED_LABELS}, 1, 0) as n, a.labels + g.size as labels), a -> a.n)")
    seeds = F.transform(F.slice("__held", F.lit(1), F.greatest(some, F.lit(1))), lambda g: g["gram"])
    unlike = F.expr("bit_count(__lgs & ~__ngs) + bit_count(__ngs & ~__lgs)").cast("long")
    choice = (shared.withColumn("__gram", F.explode_outer(seeds)).drop("__held").repartition(parts, *block, "__gram")
              .join(index.select(*block, "__gram", "__no", "__lgs"), [*block, "__gram"], "left")
              .groupBy(*keys, "__lists", "__labels")
              .agg(F.min(unlike * (1 << 40) + F.col("__no")).alias("__no"))
              .withColumn("__no", F.pmod("__no", F.lit(1 << 40))))
    numbered = lab.groupBy(*block, "__no").agg(F.min(F.struct("__lt", "__ls")).alias("__first")).select(
        *block, "__no", "__first.*")
    seeded = (choice.join(numbered, [*block, "__no"], "left")
              .withColumn("__seed", F.coalesce(_pair_score(token_sorted), F.lit(0))).drop("__no", "__lt", "__ls"))

    # 3. What to look up: the bigrams of which one must be shared, or the block.
    need = F.expr("ceil((100 * (__nm + 1) - __nm * (201 - 2 * __seed)) / 100)").cast("int")
    seeded = seeded.withColumn("__prefix", F.when((F.col("__seed") > 50) & (need >= 1),
                                                  F.slice("__lists", F.lit(1), F.greatest(F.size("__lists") - need + 1, F.lit(0)))))
    cost = F.aggregate("__prefix", F.lit(0).cast("long"), lambda a, g: a + g["size"])
    held = F.transform(F.filter("__prefix", lambda g: g["size"] > 0), lambda g: g["gram"])
    probes = seeded.withColumn("__held", F.when(cost < F.col("__labels"), held).otherwise(F.array(F.lit(WHOLE))))
    probes = (probes.withColumn("__gram", F.explode("__held")).drop("__lists", "__prefix", "__labels")
              .withColumn("__salt", F.when(F.col("__gram") == WHOLE, F.pmod(F.xxhash64(name_col), F.lit(salt_buckets)))
                          .otherwise(0).cast("int")))
    probes = probes.repartition(parts, *block, "__gram", "__salt")
    dealt = index.withColumn("__salt", F.explode(F.when(
        F.col("__gram") == WHOLE, F.sequence(F.lit(0), F.lit(salt_buckets - 1))).otherwise(F.array(F.lit(0)))))

    # 4. Pairs that can reach the seed's score, each under the first bigram that they share.
    pairs = probes.join(dealt, [*block, "__gram", "__salt"], "left")
    first_shared = (F.col("__gram") == WHOLE) | (F.col("__gram") == F.get(F.array_intersect("__held", "__lg"), F.lit(0)))
    return (pairs.filter(F.col("__lt").isNull() | ((_score_at(_least_distance()) >= F.col("__seed")) & first_shared))
            .drop("__lg", "__no", "__gram", "__salt", "__held"))


def best_match(names: DataFrame, labels: DataFrame, block: Sequence[str], name_col: str,
               label_col: str, id_col: str, token_sorted: bool = True,
               salt_buckets: int = SALT_BUCKETS, names_distinct: bool = False,
               settled: Column | None = None) -> DataFrame:
    """For each distinct (block, name): the best-scoring label of the same
    block, its id and the integer score 0..100 (ties: lower label, then id).
    A name whose block has no label gets a null label and score 0. A null
    block matches nothing.

    Only the pairs of :func:`candidate_pairs` are scored. Names that look at
    their whole block are dealt over ``salt_buckets`` parts, so a block with most
    of the names is many tasks. With ``names_distinct`` further columns of
    ``names`` are kept; rows where ``settled`` holds are passed through without
    being scored.
    """
    block = list(block)
    n = names.filter(F.col(name_col).isNotNull())
    if not names_distinct:
        n = n.select(*block, name_col).distinct()
    carried = [c for c in n.columns if c not in (*block, name_col)]
    done = F.lit(False) if settled is None else F.coalesce(settled, F.lit(False))
    # A settled name looks for labels in no block.
    n = n.withColumn("__open", ~done)
    lab = labels.withColumn("__open", F.lit(True))
    pairs = candidate_pairs(n, lab, [*block, "__open"], name_col, label_col, id_col, token_sorted, salt_buckets)
    score = F.when(F.col("__lt").isNull(), F.lit(0)).otherwise(_pair_score(token_sorted))
    # The score is computed in a projection (whole-stage code generation,
    # common subexpressions shared) before the struct-min aggregate, whose
    # sort-based implementation would otherwise evaluate it row by row.
    keys = [*block, name_col, *carried]
    scored = pairs.select(*keys, F.struct((-score).alias("neg"), F.col("__label").alias("label"),
                                          F.col("__id").alias("id")).alias("__c"))
    best = scored.groupBy(*keys).agg(F.min("__c").alias("__b"))
    return best.select(*block, name_col, *carried, F.col("__b.label").alias("label"), F.col("__b.id").alias("id"),
                       (-F.col("__b.neg")).cast("int").alias("score"))


def resolve_names(names: DataFrame, labels: DataFrame, overrides: DataFrame | None = None,
                  rules: DataFrame | None = None, county_col: str = "county", name_col: str = "name",
                  label_id_col: str = "precinct", label_name_col: str = "precinctName",
                  token_sorted: bool = True, salt_buckets: int = SALT_BUCKETS) -> DataFrame:
    """M2 cascade, first hit wins:

    1. override row for (county, name) -> its id and label, score 100
       (duplicated override keys: the smallest id wins);
    2. a rule for the county (table ``county, rule, suffix``; rule
       ``first_token`` = first blank-separated token + suffix, ``name_is_id``
       = the name itself) -> label of that id (the smallest label when the
       id repeats), score 100; no such id -> label ``??``, score 0;
    3. fuzzy ``best_match`` against the county's labels.

    One pass over the names: each table joins from the left, only names that
    neither an override nor a rule settled are scored, and the columns are
    coalesced in this order.
    Output: county, precinct, mapPrecinctName, electionResultsPrecinctName,
    score (int), rule. Every distinct input name appears exactly once.
    """
    none = F.lit(None).cast("string")
    n = names.select(F.upper(F.col(county_col)).alias("county"), F.col(name_col).alias("name")) \
        .filter(F.col("name").isNotNull()).distinct()
    lab = labels.select(F.upper(F.col(county_col)).alias("county"), F.col(label_id_col).alias("precinct"),
                        F.col(label_name_col).alias("precinctName"))
    if overrides is None:
        n = n.withColumns({"__oid": none, "__olabel": none, "__over": F.lit(False)})
    else:
        ov = overrides.select(F.upper(F.col("county")).alias("county"),
                              F.col("electionResultsPrecinctName").alias("name"),
                              F.col("precinct").alias("__oid"), F.col("mapPrecinctName").alias("__olabel"))
        ov = first_per_key(ov, ["county", "name"], "__oid").withColumn("__over", F.lit(True))
        n = n.join(ov, ["county", "name"], "left").fillna(False, ["__over"])
    if rules is None:
        n = n.withColumns({"__rid": none, "__rlabel": none})
    else:
        r = rules.select(F.upper(F.col("county")).alias("county"), "rule",
                         F.coalesce(F.col("suffix"), F.lit("")).alias("suffix"))
        n = n.join(r, "county", "left").withColumn("__rid", F.when(
            F.col("rule").isNotNull() & ~F.col("__over"),
            F.when(F.col("rule") == "first_token", first_token("name", F.col("suffix"))).otherwise(F.col("name"))))
        by_id = lab.groupBy("county", F.col("precinct").alias("__rid")).agg(F.min("precinctName").alias("__rlabel"))
        n = n.drop("rule", "suffix").join(by_id, ["county", "__rid"], "left")
    over, ruled = F.col("__over"), F.col("__rid").isNotNull()
    m = best_match(n, lab, ["county"], "name", "precinctName", "precinct", token_sorted, salt_buckets,
                   names_distinct=True, settled=over | ruled)
    return m.select(
        "county", F.when(over, F.col("__oid")).when(ruled, F.col("__rid")).otherwise(F.col("id")).alias("precinct"),
        F.when(over, F.col("__olabel")).when(ruled, F.coalesce("__rlabel", F.lit(UNKNOWN_LABEL)))
        .otherwise(F.col("label")).alias("mapPrecinctName"),
        F.col("name").alias("electionResultsPrecinctName"),
        F.when(over, 100).when(ruled, F.when(F.col("__rlabel").isNull(), 0).otherwise(100))
        .otherwise(F.col("score")).alias("score"),
        F.when(over, "override").when(ruled, "rule").otherwise("fuzzy").alias("rule"))


def resolve_ids(names: DataFrame, labels: DataFrame, county_col: str = "county", name_col: str = "precinct",
                id_col: str = "precinct", min_score: int = 80, token_sorted: bool = True,
                salt_buckets: int = SALT_BUCKETS) -> DataFrame:
    """M3: match names directly against map ids; keep score > ``min_score``.
    Output: county, precinct (map id), absenteePrecinct (input), score."""
    n = names.select(F.upper(F.col(county_col)).alias("county"), F.col(name_col).alias("absenteePrecinct"))
    lab = labels.select(F.upper(F.col(county_col)).alias("county"), F.col(id_col).alias("__mid"))
    m = best_match(n, lab, ["county"], "absenteePrecinct", "__mid", "__mid", token_sorted, salt_buckets)
    return (m.filter(F.col("score") > min_score)
            .select("county", F.col("id").alias("precinct"), "absenteePrecinct", "score"))


def review_queue(matches: DataFrame, below: int = 95) -> DataFrame:
    """M4: matches scoring under ``below`` (95 for results, 100 for ids)."""
    return matches.filter(F.col("score") < below)
