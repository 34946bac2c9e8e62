"""Operator 9: benchmark decontamination with Spark expressions only.

A document is contaminated by a benchmark item when some window of the
document, as long in words as the item, has a weighted k-word shingle
similarity of 0.8 or more with it (Jaccard with multiplicities as weights).

1. Anchors. An item of W shingles shares at least ceil(0.8 W) of them with
   a similar window, so any W - ceil(0.8 W) + 1 of them include a shared
   one. Those with the longest first word are looked up at every position
   of every document; only windows around a hit can be similar, and all of
   those are formed. Nothing similar is lost.
2. SimHash. Window and item get 64-bit fingerprints of their weighted
   shingles. They are cut into ``radius + 1`` blocks; two fingerprints
   within the radius agree in at least one block, and only windows that do,
   and that are within the radius, go on.
3. The exact weighted similarity decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import row_key, written

SPACE = r"[\x20\x09-\x0D]+"
#: Anchors are broadcast up to this many bytes of their rows; beyond it the
#: lookup is a shuffled join on shingle hashes.
MAX_BROADCAST = 32 << 20
#: Shingles that fit the 16-bit lanes of a fingerprint.
MOST_SHINGLES = 65_535
#: With similarity s >= 0.8 about 64 * acos(s') / pi = 9.6 of 64 bits differ
#: (s' = 8/9 the cosine), standard deviation 2.9: 24 is five of them away.
RADIUS = 24


def split_words(text: Column) -> Column:
    """Lower-cased words; an empty text has one empty word."""
    return F.split(F.btrim(F.lower(text), F.lit(" \t\n\x0b\f\r")), SPACE)


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once (a one-element array
    binds it; Catalyst would copy a plain expression to each use)."""
    return F.element_at(F.transform(F.array(value), use), 1)


def shingles(words: Column, k: Column) -> Column:
    """Hashes of the k-word shingles of an array of at least k words."""
    return bound(words, lambda ws: F.transform(F.sequence(F.lit(1), F.size(ws) - k + 1),
                                               lambda i: F.xxhash64(F.array_join(F.slice(ws, i, k), " "))))


def simhash(hashes: Column) -> Column:
    """64-bit SimHash of an array of up to 65,535 hashes, multiplicity as
    weight. Bits are counted four at a time in 16-bit lanes."""
    lane = 0x0001000100010001
    n = F.size(hashes)

    def lanes(b: int) -> Column:
        return F.aggregate(hashes, F.lit(0).cast("long"),
                           lambda acc, h: acc + F.shiftrightunsigned(h, b).bitwiseAND(F.lit(lane)))

    def bits(b: int):
        def pick(v: Column) -> Column:
            of = F.lit(0).cast("long")
            for j in range(4):
                value = 1 << (16 * j + b)
                of = of.bitwiseOR(F.when(F.shiftrightunsigned(v, 16 * j).bitwiseAND(F.lit(65535)) * 2 > n,
                                         F.lit(value - (1 << 64) if value >> 63 else value)).otherwise(F.lit(0))
                                  .cast("long"))
            return of
        return pick

    out = F.lit(0).cast("long")
    for b in range(16):
        out = out.bitwiseOR(bound(lanes(b), bits(b)))
    return out


def near(a: Column, b: Column, radius: int) -> Column:
    """Multi-index test: some of ``radius + 1`` blocks agree, and at most
    ``radius`` bits differ."""
    cut = [64 * i // (radius + 1) for i in range(radius + 2)]

    def test(x: Column) -> Column:
        agree = F.lit(False)
        for i, j in zip(cut, cut[1:]):
            agree = agree | (F.shiftrightunsigned(x, i).bitwiseAND(F.lit((1 << (j - i)) - 1)) == 0)
        return agree & (F.bit_count(x) <= radius)

    return bound(a.bitwiseXOR(b), test)


def weighted_jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays as multisets."""
    plain = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    times = lambda arr, x: F.size(F.filter(arr, lambda y: y == x))
    # If one side has no repeats, each common value counts once.
    both = F.when(plain, F.size(F.array_intersect(a, b))).otherwise(
        F.aggregate(F.array_distinct(a), F.lit(0), lambda acc, x: acc + F.least(times(a, x), times(b, x))))
    return bound(both, lambda m: m / (F.size(a) + F.size(b) - m))


def _items(benchmark: DataFrame, threshold: float) -> DataFrame:
    """One row per distinct item: ``item`` (hash of id and words), item_id,
    words_n, k, hashes, fp, ``grams`` (the words of its anchors by rank) and
    ``anchors`` (their hashes)."""
    w = (benchmark.select("item_id", split_words(F.col("text")).alias("words")).where(F.array_join("words", "") != "")
         .withColumn("item", F.xxhash64(F.col("item_id").isNull(), "item_id", "words")).dropDuplicates(["item"]))
    w = w.withColumn("k", F.least(F.lit(5), F.size("words")))
    w = w.select("item", "item_id", "k", F.size("words").alias("words_n"), "words",
                 shingles(F.col("words"), F.col("k")).alias("hashes"))
    w = w.withColumn("fp", F.when(F.size("hashes") <= MOST_SHINGLES, simhash(F.col("hashes"))))
    need = F.size("hashes") - F.ceil(F.size("hashes") * threshold).cast("int") + 1
    by_length = F.transform(F.sequence(F.lit(1), F.size("hashes")), lambda i: F.struct(
        (-F.char_length(F.element_at("words", i))).alias("l"), i.alias("j")))
    picked = F.slice(F.sort_array(by_length), 1, need)
    grams = F.array_distinct(F.transform(picked, lambda s: F.slice("words", s["j"], F.col("k"))))
    w = w.withColumn("grams", grams).drop("words")
    return w.withColumn("anchors", F.transform("grams", lambda g: F.xxhash64(F.array_join(g, " "))))


def _anchors(items: DataFrame) -> DataFrame:
    """One row per anchor, as long as its words: item, words_n, k, ``rank``,
    ``gram`` (its words) and ``first`` (its first word)."""
    return (items.select("item", "k", "words_n", F.posexplode_outer("grams").alias("rank", "gram"))
            .withColumn("first", F.element_at("gram", 1)))


def _bytes(anchors: DataFrame) -> int:
    """Size of all anchors as rows: words twice at most, 24 bytes for each
    word and 96 for the rest of a row."""
    size = 2 * F.octet_length(F.array_join("gram", " ")) + 24 * F.size("gram") + 96
    return anchors.agg(F.sum(size.cast("long"))).first()[0] or 0


def _hits_by_word(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """doc_id, words, position and anchor of every hit (anchors broadcast)."""
    at = docs.select("doc_id", "words", F.posexplode_outer("words").alias("p", "w"))
    return (at.join(F.broadcast(anchors), F.col("w") == F.col("first"))
            .where(F.slice("words", F.col("p") + 1, F.col("k")) == F.col("gram")))


def _hits_by_hash(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """The same by a shuffled join of shingle hashes, then of ids."""
    sizes = [r["k"] for r in anchors.select("k").distinct().collect()]  # 1 to 5

    def of_size(k: int) -> Column:
        none = F.array().cast("array<struct<k:int,p:int,h:bigint>>")
        return F.when(F.size("words") >= k, F.transform(
            shingles(F.col("words"), F.lit(k)),
            lambda h, i: F.struct(F.lit(k).alias("k"), i.alias("p"), h.alias("h")))).otherwise(none)

    grams = F.flatten(F.array(*[of_size(k) for k in sizes]))
    at = docs.select("doc_id", F.explode_outer(grams).alias("g")).select("doc_id", "g.*").withColumnRenamed("k", "k_doc")
    keyed = anchors.withColumn("h", F.xxhash64(F.array_join("gram", " ")))
    hits = written(at.join(keyed, "h").where("k = k_doc").drop("h", "k_doc"), "hash-hits")
    ids = docs.select(F.col("doc_id").alias("_id"), "words")
    return (hits.join(ids, F.col("doc_id").eqNullSafe(F.col("_id"))).drop("_id")
            .where(F.slice("words", F.col("p") + 1, F.col("k")) == F.col("gram")))


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text", threshold: float = 0.8, radius: int = RADIUS,
                 max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``doc_id, item_id, similarity, start`` of every contaminated pair:
    the best window of the document and its first word (from 0).

    Words are runs without white space, lower-cased. Items with fewer than
    five words have one shingle, the whole item. A window at the end of a
    document, or in one shorter than the item, may be shorter.

    Null, empty or wordless texts and items: no pair. Repeated rows or ids:
    one pair per distinct (doc_id, item_id), null ids included. Ties: the
    first window. No rows on either side: no pair. Extra columns are ignored
    and may have any name. Whole texts. Anchors (words only) are broadcast if
    their rows have at most ``max_broadcast`` bytes, which is measured;
    otherwise a join on shingle hashes finds the hits. Items join the hits
    afterwards. Items of more than 65,535 shingles have no fingerprint: all
    their windows around hits are verified exactly.
    """
    benchmark = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    items = written(_items(benchmark, threshold), "items")
    anchors = written(_anchors(items), "anchors")
    d = docs.select(F.col(doc_id).alias("doc_id"), split_words(F.col(text)).alias("words"))
    hits = (_hits_by_word if _bytes(anchors) <= max_broadcast else _hits_by_hash)(d, anchors)
    # All windows that contain the hit start at p - (L - k) .. p; their words are written, so that
    # Catalyst cannot move the costly tests below the lookup.
    lo = F.greatest(F.lit(0), F.col("p") - (F.col("words_n") - F.col("k")))
    hits = written(hits.withColumn("lo", lo).select(
        "doc_id", "item", "rank", "lo", (F.col("p") - F.col("lo")).alias("last"),
        F.slice("words", F.col("lo") + 1, F.col("p") - F.col("lo") + F.col("words_n")).alias("around")), "hits")
    hits = (hits.join(items.select("item", "item_id", "k", "hashes", "fp", "anchors"), "item")
            .withColumn("before", F.slice("anchors", F.lit(1), F.col("rank"))))

    def tested(grams: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col("last")), lambda s: bound(
            F.slice(grams, s + 1, F.size("hashes")), lambda w: F.struct(
                # A window that holds an anchor of smaller rank is tested at that one.
                F.when(F.arrays_overlap("before", w), F.lit(0.0))
                .when(F.col("fp").isNull() | near(simhash(w), F.col("fp"), radius), weighted_jaccard(w, F.col("hashes")))
                .otherwise(F.lit(0.0)).alias("similarity"), (-(F.col("lo") + s)).alias("at"))))

    best = bound(shingles(F.col("around"), F.col("k")), lambda g: F.array_max(tested(g)))
    return (hits.groupBy("doc_id", "item_id").agg(F.max(best).alias("best"))
            .where(F.col("best.similarity") >= threshold)
            .select("doc_id", "item_id", F.col("best.similarity").alias("similarity"),
                    (-F.col("best.at")).cast("long").alias("start")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` (all columns) without contaminated documents. Rows are told
    apart by id and text, null ids included."""
    keyed = docs.withColumn("__k", row_key())
    bad = written(contaminated(keyed.select("__k", "text"), benchmark, doc_id="__k").select(F.col("doc_id").alias("__k"))
                  .distinct(), "contaminated")
    return keyed.join(bad, "__k", "left_anti").select(*docs.columns)
