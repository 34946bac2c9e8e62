"""Operator 1: n-gram Jaccard join by T-occurrence search (DivideSkip).

A document is the set of its distinct k-word shingles. Two documents of
sizes a and b link when their sets share T(a, b) = ceil(t (a + b) / (1 + t))
shingles or more. DivideSkip divides a set's inverted lists into the L
longest and the others: whoever shares T shingles occurs on at least T - L
of the short lists. With L = T - 1, one occurrence on a short list makes a
candidate. So, with shingles in one global order from rare to frequent,

* the lists of a set's rarest shingles (its prefix) are the short ones.
  They are merged by a sort-merge join of postings on the shingle, spread
  over the cluster; size and position bounds drop pairs that can no longer
  reach T;
* all other lists are long and never merged: a candidate's remaining
  shingles are probed by binary search in the other set's sorted array, and
  the candidate is retained when the required overlap is reached.

Links inside a group of many alike documents are not expanded. Equal sets
collapse into one node first. Then every node meets one partner from its
lists (a star), the links found are joined into components, and lists whose
members all lie in one component are dropped: what is missing there cannot
change a component. On the other lists every pair of different components
that passes the bounds is verified, so components are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import prefilter, row_key, written
from .textgrams import mix, shingle_sets, text_slices

#: Shingles are counted in 2 ** SKETCH_BITS cells (by hash) to order them by
#: frequency; the cells are exact sums over all documents and their number
#: does not grow.
SKETCH_BITS = 16
#: A set's parity map has 64 bits a word, at least MAP_WORDS words and
#: about two bits a shingle (a power of two); each shingle flips one bit.
#: Two maps differ in at most as many bits as the sets differ in shingles.
MAP_WORDS = 16
SETS = "cell boolean, id long, n long, s1 long, s2 long"


def _sets(k: int):
    """Per document its set size and a 128-bit signature of the set; per
    task the cell counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << SKETCH_BITS, np.int64)
        for b in batches:
            for at, end, data, off in text_slices(b, "text"):
                n, s1, s2 = (np.zeros(end - at, np.uint64) for _ in range(3))
                some = []
                for i, s in enumerate(shingle_sets(data, off, k)):
                    n[i] = len(s)
                    if len(s):
                        some.append(s)
                        s1[i] = s.sum(dtype=np.uint64)
                        s2[i] = mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
                if some:
                    cells += np.bincount((np.concatenate(some) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64),
                                         minlength=len(cells))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(end - at, bool)), b.column("id").slice(at, end - at),
                     *(pa.array(x.view(np.int64)) for x in (n, s1, s2))], ["cell", "id", "n", "s1", "s2"])
        hit = np.flatnonzero(cells)
        zero = pa.array(np.zeros(len(hit), np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(hit), bool)), pa.array(hit), pa.array(cells[hit]), zero,
                                          zero], ["cell", "id", "n", "s1", "s2"])

    return run


def _levels(cells: DataFrame) -> np.ndarray:
    """Frequency level 0..255 of each cell, rare first."""
    count = np.zeros(1 << SKETCH_BITS)
    for r in cells.collect():  # at most 2 ** SKETCH_BITS rows
        count[r["id"]] = r["n"]
    return np.minimum(np.round(np.log2(count + 1) * 6), 255).astype(np.uint8)


def _prefixes(k: int, num: int, den: int, level: np.ndarray):
    """The rarest n - ceil(t n) + 1 shingles of each set, in global order,
    and its parity map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, end, data, off in text_slices(b, "text"):
                n, flat, size, maps = [], [], [], []
                for s in shingle_sets(data, off, k):
                    m = len(s)
                    p = m - (num * m + den - 1) // den + 1 if m else 0
                    if p:
                        lv = level[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
                        # s is sorted, so equal keys stay in hash order
                        key = (lv << np.uint64(56)) | (s >> np.uint64(8))
                        few = np.sort(np.argpartition(key, p - 1)[:p]) if p < m else np.arange(m)
                        few = few[np.argsort(key[few], kind="stable")]
                        flat.append(s[few])
                    n.append(m)
                    size.append(p)
                    bits = 64 * max(MAP_WORDS, 1 << max(0, (m - 1) // 32).bit_length())
                    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
                    maps.append(np.packbits(odd.astype(bool)).view(np.int64))
                flat = np.concatenate(flat) if flat else np.zeros(0, np.uint64)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)].astype(np.int32)),
                                                 pa.array(flat.view(np.int64)))
                maps = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(x) for x in maps])].astype(np.int32)),
                                                pa.array(np.concatenate(maps)))
                yield pa.RecordBatch.from_arrays([b.column("id").slice(at, end - at), pa.array(n, pa.int64()), lists,
                                                  maps], ["id", "n", "tokens", "map"])

    return run


def _whole(k: int):
    """The whole set of each document as sorted little-endian bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, end, data, off in text_slices(b, "text"):
                sets = pa.array([s.tobytes() for s in shingle_sets(data, off, k)], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column("id").slice(at, end - at), sets], ["id", "s"])

    return run


def _probe(num: int, den: int):
    """Pairs with both sets -> pairs that link (binary probes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("sa"), batch.column("sb"))):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                ok[i] = both * den >= num * (len(x) + len(y) - both)
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("u", "v")], ["u", "v"])

    return run


def _possible(num: int, den: int, n1: Column, p1: Column, n2: Column, p2: Column) -> Column:
    """Size and position bounds: can sets of sizes n1 and n2 that first meet
    at positions p1 and p2 (from 0) still share enough?"""
    most = F.least(n1 - p1, n2 - p2)
    return ((F.least(n1, n2) * den >= F.greatest(n1, n2) * num) & (most * (num + den) >= (n1 + n2) * num))


def _differ(m1: Column, m2: Column) -> Column:
    """Number of bits in which two parity maps differ; the longer one is
    folded to the length of the other."""

    def fold(m: Column, words: Column) -> Column:
        # Sizes of sets that may link differ by less than 2, so lengths by a factor of 2 at most.
        return F.when(F.size(m) <= words, m).otherwise(F.zip_with(
            F.slice(m, F.lit(1), words), F.slice(m, words + 1, words), lambda x, y: x.bitwiseXOR(y)))

    words = F.least(F.size(m1), F.size(m2))
    return F.aggregate(F.zip_with(fold(m1, words), fold(m2, words), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                       F.lit(0), lambda acc, x: acc + x)


def _pruned(maps: DataFrame, pairs: DataFrame, num: int, den: int) -> DataFrame:
    """``pairs`` (u, v and any others) without those whose sizes or parity
    maps show that they do not link, with ``d``, the bits that differ."""
    a = maps.select(F.col("id").alias("u"), F.col("n").alias("n1"), F.col("map").alias("m1"))
    b = maps.select(F.col("id").alias("v"), F.col("n").alias("n2"), F.col("map").alias("m2"))
    sized = pairs.join(a, "u").join(b, "v").where(F.least("n1", "n2") * den >= F.greatest("n1", "n2") * num)
    # |A xor B| = |A| + |B| - 2 |A and B|, and |A and B| >= t (|A| + |B|) / (1 + t)
    return (sized.withColumn("d", _differ(F.col("m1"), F.col("m2")))
            .where(F.col("d") * (num + den) <= (F.col("n1") + F.col("n2")) * (den - num)).drop("n1", "n2", "m1", "m2"))


def _once(rows: DataFrame, again: DataFrame) -> DataFrame:
    """``rows`` with equal rows of the ids in ``again`` (distinct, the ids that
    occur more than once) taken once. Other rows are not shuffled for it;
    equal rows meet after a map-side distinct."""
    return rows.join(again, "id", "left_anti").unionByName(rows.join(again, "id", "left_semi").distinct())


def _verified(docs: DataFrame, pairs: DataFrame, k: int, num: int, den: int, again: DataFrame) -> DataFrame:
    """The distinct pairs (u, v) that link. Only the sets of these documents
    are formed and moved; repeated rows (ids ``again``) have one set."""
    ids = pairs.select(F.col("u").alias("id")).unionByName(pairs.select(F.col("v").alias("id"))).distinct()
    sets = written(prefilter(docs, "id", ids).select("id", "text").mapInArrow(_whole(k), "id long, s binary"), "whole")
    sets = _once(sets, again)
    a = sets.select(F.col("id").alias("u"), F.col("s").alias("sa"))
    b = sets.select(F.col("id").alias("v"), F.col("s").alias("sb"))
    return written(pairs.select("u", "v").join(a, "u").join(b, "v").select("u", "v", "sa", "sb")
                   .mapInArrow(_probe(num, den), "u long, v long"), "links")


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5,
                       threshold: tuple[int, int] = (4, 5)) -> DataFrame:
    """Components of the graph of documents whose k-word shingle sets have a
    Jaccard similarity of ``threshold`` (numerator, denominator) or more.

    Words are maximal runs without white space (x20, x09-x0D), A-Z
    lower-cased. Returns one row per input row: ``doc_id, n_shingles,
    component_id, set_id`` with the smallest id reachable by links, itself
    included; ``set_id`` is the smallest id of an equal set.

    Null, empty or wordless text: an empty set, linked with nothing (its
    component is its own id). Fewer words than k: the whole sequence as one
    shingle. Repeated rows and ties: equal sets, one component. A row
    without id: linked with nothing, component null. No rows: none. Extra
    columns are ignored and may have any name. Ids are integers. Sets are
    compared by 64-bit shingle hashes and equal sets by 128-bit signatures.
    """
    num, den = threshold
    docs = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    facts = written(docs.mapInArrow(_sets(k), SETS), "sets")
    level = _levels(facts.where("cell").groupBy("id").agg(F.sum("n").alias("n")))
    facts = facts.where("not cell").drop("cell")
    # Equal sets: one node each, named after its smallest id.
    node = written(facts.where("n > 0 and id is not null").groupBy("s1", "s2", "n").agg(F.min("id").alias("node")),
                   "nodes")
    ids = node.select(F.col("node").alias("id"))
    rare = (docs.where("id is not null and text is not null")
            .mapInArrow(_prefixes(k, num, den, level), "id long, n long, tokens array<bigint>, map array<bigint>"))
    again = written(facts.where("id is not null").groupBy("id").count().where("count > 1").select("id"), "repeated-ids")
    # Of repeated rows one is in the lists; more would meet each other and all others in each list.
    rare = _once(written(rare.join(ids, "id", "left_semi"), "prefixes"), again)
    maps = rare.select("id", "n", "map")
    post = rare.select("id", F.col("n").cast("int").alias("n"), F.posexplode("tokens").alias("p", "token"))
    # The short lists with more than one member.
    lists = post.groupBy("token").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first <> last")
    live = written(post.join(lists, "token").drop("last"), "lists")
    star = live.where(F.col("id") != F.col("first")).groupBy(F.col("id").alias("u")).agg(F.min("first").alias("v"))
    links = _verified(docs, written(_pruned(maps, star, num, den), "star-pairs"), k, num, den, again)
    comp = written(components(links), "star-components")
    named = live.join(comp.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    mixed = named.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    rest = written(named.join(mixed.select("token"), "token", "left_semi").drop("first"), "mixed-lists")
    a = rest.select("token", F.col("id").alias("u"), F.col("n").alias("n1"), F.col("p").alias("p1"),
                    F.col("component").alias("c1"))
    b = rest.select("token", F.col("id").alias("v"), F.col("n").alias("n2"), F.col("p").alias("p2"),
                    F.col("component").alias("c2"))
    found = (a.join(b, "token").where((F.col("u") < F.col("v")) & (F.col("c1") != F.col("c2")) & _possible(
        num, den, F.col("n1"), F.col("p1"), F.col("n2"), F.col("p2"))).select("u", "v", "c1", "c2").distinct())
    found = written(_pruned(maps, found, num, den), "open-pairs")
    # The likeliest pair of each two components first: a link settles all others of the two.
    best = found.groupBy(F.least("c1", "c2").alias("a"), F.greatest("c1", "c2").alias("b")).agg(
        F.min(F.struct("d", "u", "v")).alias("x")).select("x.u", "x.v")
    links = links.unionByName(_verified(docs, written(best, "best-pairs"), k, num, den, again))
    comp = written(components(links), "joined-components")
    side = lambda c: comp.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
    left = (found.join(side("u"), "u", "left").join(side("v"), "v", "left")
            .where(F.coalesce("cu", "u") != F.coalesce("cv", "v")).select("u", "v").join(best, ["u", "v"], "left_anti"))
    links = links.unionByName(_verified(docs, written(left, "last-pairs"), k, num, den, again))
    comp = components(links)
    named = (node.join(comp.withColumnRenamed("component", "c"), "node", "left")
             .select("s1", "s2", "n", "node", F.coalesce("c", "node").alias("component")))
    return (facts.join(named, ["s1", "s2", "n"], "left")
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
                    F.when(F.col("id").isNotNull(), F.coalesce("node", "id")).alias("set_id")))


def keep_one(docs: DataFrame, k: int = 5, threshold: tuple[int, int] = (4, 5)) -> DataFrame:
    """One document of each component of ``docs``, the one with the smallest
    id (ties: by a key of id and text); all columns are kept.

    Rows are told apart by id and text, null ids included: a row without id
    is compared like all others and goes when its component has one with an
    id. Of repeated rows (same id, same text) one stays, also without words.
    """
    keyed = docs.withColumn("__k", row_key())
    comp = jaccard_components(keyed.select("__k", "text"), "__k", k=k, threshold=threshold)
    # A key is one id and one text.
    ids = keyed.groupBy("__k").agg(F.first("doc_id").alias("id"), F.count(F.lit(1)).alias("rows"))
    ids = written(ids.join(comp.select(F.col("doc_id").alias("__k"), "component_id").distinct(), "__k"), "keys")
    best = ids.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "__k")).alias("best"))
    best = best.select(F.col("best.__k").alias("__k"))
    drop = written(ids.join(best, "__k", "left_anti").select("__k"), "duplicates")
    again = written(ids.where("rows > 1").join(best, "__k", "left_semi").select("__k"), "repeated-rows")
    single = keyed.join(drop.unionByName(again), "__k", "left_anti")
    one = prefilter(keyed, "__k", again).join(again, "__k").dropDuplicates(["__k"])
    return single.select(*docs.columns).unionByName(one.select(*docs.columns))
