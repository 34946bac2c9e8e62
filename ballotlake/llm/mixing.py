"""Operator 10: mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

#: Words: maximal runs without x20 and x09-x0D.
WORD = r"[^\x20\x09-\x0D]+"
#: Ranks are cut into this many bins per level; three levels leave about a
#: 2 ** 36th of a source's documents to rank one by one.
BINS = 4096


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """``(source, source_size)`` -> the same with ``target``.

    Sources in code-point order, null last, take ``weights`` in turn and
    divide ``share`` of all sizes by weight; a target stops at ``most``
    times its source's size and the excess goes to the others by weight
    until none is above. That is a water level: with sources ordered by
    cap / weight, those before the level are capped and the rest share what
    is left. One row per source, so the two windows without a key sort the
    list of sources, not documents.
    """
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    cyc = F.array(*[F.lit(float(w)) for w in weights])
    s = (sizes.withColumn("_w", F.element_at(cyc, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1)
                                             .cast("int")))
         .withColumn("_cap", F.col("source_size") * F.lit(most)))
    by_cap = Window.orderBy((F.col("_cap") / F.col("_w")), F.col("source").isNull(), F.encode("source", "UTF-8"))
    every = Window.partitionBy()
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("_left", F.sum("source_size").over(every) * F.lit(share)
                      - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
         .withColumn("_wleft", F.sum("_w").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing))))
    # The first source (by cap / weight) whose share of what is left fits under its cap sets the level.
    s = s.withColumn("_level", F.min(F.when(F.col("_left") <= F.col("_cap") / F.col("_w") * F.col("_wleft"),
                                            F.struct((F.col("_cap") / F.col("_w")).alias("k"),
                                                     (F.col("_left") / F.col("_wleft")).alias("level")))).over(every))
    target = F.when(F.col("_level").isNull(), F.col("_cap")).otherwise(
        F.least(F.col("_cap"), F.col("_level.level") * F.col("_w")))
    return s.select("source", "source_size", target.alias("target"))


def _threshold(rows: DataFrame, seen: DataFrame, bins: str) -> DataFrame:
    """The bin of each source in which its remaining words run out.

    ``rows``: source, size and ``bins``; ``seen``: source, ``left`` (words
    still to take). Sums per (source, bin) are formed before the shuffle and
    the running sum sees at most BINS rows a source."""
    w = Window.partitionBy("source").orderBy(bins).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("source", bins).agg(F.sum("size").alias("_s"))
    run = (sums.withColumn("_before", F.coalesce(F.sum("_s").over(w), F.lit(0)))
           .join(seen.withColumnRenamed("source", "_src"), F.col("source").eqNullSafe(F.col("_src"))).drop("_src"))
    inside = run.where((F.col("_before") <= F.col("left")) & (F.col("_before") + F.col("_s") > F.col("left")))
    return (inside.groupBy("source").agg(F.min(F.struct(bins, "_before", "left")).alias("_t"))
            .select("source", F.col(f"_t.{bins}").alias("cut"),
                    (F.col("_t.left") - F.col("_t._before")).alias("left")))


def text_hash(text: Column) -> Column:
    """64-bit hash of a text, null and empty told apart."""
    return F.xxhash64(text.isNull(), text)


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (``doc_id, source, size``, the text's hash ``_h`` and any
    others) with ``_k``, a hash of the row, and ``_i``, a running number
    from 1 among rows of equal id, source and text. Rows without words are
    never drawn and all have number 1.

    Equal rows are interchangeable, so the set of numbers is the same however
    the rows are split. Only rows that repeat are shuffled: numbered inside
    groups of at most 65,536 neighbouring rows, then moved on by the counts
    of the groups before, so no task holds all copies of a row.
    """
    k = F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("source").isNull(), "source", "size", "_h")
    rows = rows.withColumn("_k", k)
    same = written(rows.where("size > 0").groupBy("_k", "_h").count().where("count > 1")
                   .select("_k", "_h", F.lit(True).alias("_same")), "mix-same")
    marked = (rows.withColumn("_b", F.shiftright(F.monotonically_increasing_id(), 16))
              .join(same, ["_k", "_h"], "left"))
    many = written(marked.where("_same").drop("_same"), "mix-copies")
    before = Window.partitionBy("_k", "_h").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    start = (many.groupBy("_k", "_h", "_b").count()
             .select("_k", "_h", "_b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start")))
    inside = Window.partitionBy("_k", "_h", "_b").orderBy("_b")
    counted = (many.withColumn("_i", F.row_number().over(inside)).join(start, ["_k", "_h", "_b"])
               .withColumn("_i", F.col("_i") + F.col("_start")).drop("_start", "_b"))
    once = marked.where("_same is null").drop("_same", "_b").withColumn("_i", F.lit(1).cast("long"))
    return once.unionByName(counted)


def _ranks(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """``rows`` with the plan of their source, the Pareto rank ``_v`` and its
    grid cell ``_g`` (null where no fraction is to be drawn)."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "_k", "_h", "_i"), 11).cast("double") + 0.5) / float(1 << 53)
    # Pareto rank q = odds(u) / odds(p); q / (1 + q) lies in (0, 1) and keeps the order.
    odds = (F.col("_u") / (1 - F.col("_u"))) / (F.col("p") / (1 - F.col("p")))
    return (rows.withColumn("_u", u)
            .join(plan.withColumnRenamed("source", "_src"), F.col("source").eqNullSafe(F.col("_src")), "left")
            .drop("_src").withColumn("_v", F.when((F.col("p") > 0) & (F.col("size") > 0), odds / (1 + odds)))
            .withColumn("_g", F.floor(F.col("_v") * float(BINS) ** 3).cast("long")))


def mix_plan(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
             seed: int = 17) -> DataFrame:
    """The decisions for ``sizes`` (``source, size`` of rows that ``numbered``
    has told apart), one row per source: ``source, source_size, target, whole, p, cut, last``.

    Every document is taken ``whole`` times, and once more if its rank lies
    in a grid cell before ``cut``, or in that cell and not after ``last``;
    without ``cut`` every document with a rank is.

    The cut is found without sorting a source in one task: ranks are binned
    on a fixed grid, words are summed per (source, bin) before the shuffle,
    the bin that holds the cut is binned again twice, and only the
    documents of the last bin are ranked one by one.
    """
    goal = source_targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    ratio = F.col("target") / F.col("source_size")
    some = F.col("source_size") > 0
    goal = written(goal.withColumn("whole", F.when(some, F.floor(ratio)).otherwise(0).cast("long"))
                   .withColumn("p", F.when(some, ratio - F.col("whole")).otherwise(F.lit(0.0))), "mix-goal")
    live = (_ranks(sizes, goal.select("source", "p"), seed).where("_v is not null")
            .select("source", "size", "_v", "_k", "_h", "_i", F.shiftright("_g", 24).alias("b1"),
                    F.shiftright("_g", 12).alias("b2"), F.col("_g").alias("g")))
    left = goal.select("source", (F.col("target") - F.col("whole") * F.col("source_size")).alias("left"))
    cut = None
    for bins in ("b1", "b2", "g"):
        cut = written(_threshold(live, left, bins), "mix-cut")
        left = cut.select("source", "left")
        inside = cut.select(F.col("source").alias("_src"), F.col("cut").alias("_cut"))
        live = (live.join(inside, F.col("source").eqNullSafe(F.col("_src")) & (F.col(bins) == F.col("_cut")))
                .drop("_src", "_cut"))
    w = Window.partitionBy("source").orderBy("_v", "_k", "_h", "_i")
    last = (live.withColumn("_before", F.coalesce(F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                                  F.lit(0)))
            .join(left.withColumnRenamed("source", "_src"), F.col("source").eqNullSafe(F.col("_src"))).drop("_src")
            .where(F.col("_before") + F.col("size") / 2 <= F.col("left"))
            .groupBy("source").agg(F.max(F.struct("_v", "_k", "_h", "_i")).alias("last")))
    c = cut.select(F.col("source").alias("_c"), "cut")
    e = last.select(F.col("source").alias("_e"), "last")
    return written(goal.join(c, F.col("source").eqNullSafe(F.col("_c")), "left")
                   .join(e, F.col("source").eqNullSafe(F.col("_e")), "left").drop("_c", "_e"), "mix-plan")


def apply_plan(rows: DataFrame, plan: DataFrame, seed: int = 17) -> DataFrame:
    """``numbered`` rows (``source, size`` and any others) with
    ``source_size, target, copies``. The plan has one row per source, so the
    join moves no rows as long as the plan is small."""
    me = F.struct("_v", "_k", "_h", "_i")
    extra = (F.when(F.col("_v").isNull(), 0).when(F.col("cut").isNull() | (F.col("_g") < F.col("cut")), 1)
             .when((F.col("_g") == F.col("cut")) & (me <= F.col("last")), 1).otherwise(0))
    copies = F.when(F.col("size") > 0, F.coalesce(F.col("whole"), F.lit(0)) + extra).otherwise(F.lit(0))
    return (_ranks(rows, plan, seed).withColumn("copies", copies.cast("long"))
            .drop("_u", "_v", "_g", "_k", "_h", "_i", "whole", "p", "cut", "last"))


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
                seed: int = 17) -> DataFrame:
    """Documents with the number of copies the mix takes of each.

    Returns ``doc_id, source, size, source_size, target, copies, taken``,
    one row per input row. With ratio r = target / source_size, every
    document of the source is taken ``floor(r)`` whole times; the fraction
    p = r - floor(r) is an inclusion probability, and one more copy goes to
    the documents of smallest Pareto rank ``(u / (1 - u)) / (p / (1 - p))``
    until the source's remaining words are used (fixed size in words), the
    last one taken if at least half of it fits. ``u`` is a hash of seed, id,
    source, text and, among rows equal in these, a running number, so reruns
    agree and equal rows are drawn one by one.

    Null or wordless text: size 0, taken 0. Null source: a source of its
    own, last in order. Null ids and repeated rows: ordinary rows, each with
    a rank of its own. No rows: none. Extra columns are ignored and may have
    any name.
    """
    t = F.col(text)
    sizes = written(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                                word_count(t).alias("size"), text_hash(t).alias("_h")), "mix-sizes")
    base = written(numbered(sizes), "mix-rows")
    return (apply_plan(base, mix_plan(base, weights, share, most, seed), seed)
            .select("doc_id", "source", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id, text, source`` and any others) that the mix takes,
    each once, with ``copies``, how many times it is taken. A column of that
    name is replaced; other columns may have any name. Of rows equal in id,
    source and text it doesn't matter which is taken; only such rows are
    moved whole."""
    keep = [c for c in docs.columns if c != "copies"]
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), text_hash(F.col("text")).alias("_h"),
                       F.struct(*keep).alias("row"))
    sizes = written(rows.drop("row"), "mix-sizes")
    plan = mix_plan(written(numbered(sizes), "mix-rows"))
    return apply_plan(numbered(rows), plan).where("copies > 0").select("row.*", "copies")
