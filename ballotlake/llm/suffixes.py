"""Operator 5: removal of long repeated byte strings with suffix arrays.

Every byte that lies in an ``n``-byte string (400) which also starts
anywhere else is removed. Building suffix arrays over all text would sort
mostly text that occurs once, so the arrays are built over the parts that
can repeat:

1. Anchors. In every n-byte window the k-byte gram of smallest hash is an
   anchor (winnowing). Equal windows choose the same gram, so a repeated
   string shares an anchor, and with it the *context*: all n-byte windows
   around the anchor, at most 2n - k bytes. Anchors that occur once end
   here.
2. Equal contexts are counted by (anchor, context) hash: a context that
   occurs twice is repeated as a whole.
3. The different contexts of an anchor go to one shard. The array of its
   suffixes of at least n bytes is built by prefix tripling in numpy (a
   suffix shorter than the prefix sorted so far leaves the sort), up to
   n bytes: neighbours that are still tied then share n bytes.
4. An anchor with more contexts than a shard may hold is dealt over several.
   Two shards can only share a string as far as its text around the anchor
   recurs: each shard first reports the anchor grown to the left or right by
   1, 2, 4, ... bytes (two short ladders a context). Where ladders of
   different shards agree, the shard reports the classes of its array that lie
   inside (a 128-bit key for n equal bytes, and where they are); keys that
   shards report from different places are joined, and each shard finds them
   in its classes by binary search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import prefilter, written
from .textgrams import gram_hashes, mix, prefix_hashes, span_hashes, text_slices

GRAM = 256
#: A text is looked at in blocks of at most this many bytes (overlapping by
#: n - 1), a shard holds about this many bytes of contexts.
BLOCK = 1 << 20
SHARD_BYTES = 1 << 20
#: Windows are looked at so many at a time, to stay in the CPU's cache.
STEP = 1 << 16
#: An anchor is dealt over several shards beyond this many times the size.
DEAL = 1
CONTEXT = "fp long, ctx long, key long, start long, len int"
SPAN = "key long, a long, b long"


def _window_argmin(h: np.ndarray, w: int) -> np.ndarray:
    """Leftmost position of the minimum of each window of w values."""
    x = (h & ~np.uint64((1 << 24) - 1)) | np.arange(len(h), dtype=np.uint64)
    have = 1
    while have * 2 <= w:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    if have < w:
        x = np.minimum(x[:len(x) - (w - have)], x[w - have:])
    return (x & np.uint64((1 << 24) - 1)).astype(np.int64)


def _contexts(n: int, k: int):
    """Anchors and contexts of every text, as hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            for at, end, data, off in text_slices(batch, "text", BLOCK):
                if len(data) < n:
                    continue
                pre = prefix_hashes(data)
                out = []
                ends = np.repeat(off[1:], np.diff(off))
                for lo in range(0, len(data) - n + 1, STEP):
                    hi = min(len(data), lo + STEP + n - 1)
                    arg = _window_argmin(gram_hashes(pre, lo, hi - k + 1, k), n - k + 1) + lo
                    arg = arg[np.arange(lo + n, hi + 1) <= ends[lo:hi - n + 1]]
                    out.append(arg[_heads(arg)])  # the leftmost smallest gram never moves back
                p = np.concatenate(out)
                p = p[_heads(p)]
                if not len(p):
                    continue
                doc = np.searchsorted(off, p, "right") - 1
                a = np.maximum(off[doc], p + k - n)
                b = np.minimum(off[doc + 1], p + n)
                fp, ctx = span_hashes(pre, p, p + k), span_hashes(pre, a, b)
                # One row per anchor and context of a text, also where contexts coincide: where they are the whole text.
                one = np.ones(len(p), bool)
                short = np.flatnonzero((a == off[doc]) & (b == off[doc + 1]))
                short = short[np.lexsort((fp[short], doc[short]))]
                one[short[1:]] = (doc[short[1:]] != doc[short[:-1]]) | (fp[short[1:]] != fp[short[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp[one].view(np.int64)), pa.array(ctx[one].view(np.int64)),
                     pa.array(keys[at + doc[one]]), pa.array(a[one] - off[doc[one]]),
                     pa.array((b - a)[one].astype(np.int32))], ["fp", "ctx", "key", "start", "len"])

    return run


def _heads(*sorted_keys: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before."""
    new = np.ones(len(sorted_keys[0]), bool)
    new[1:] = np.any([x[1:] != x[:-1] for x in sorted_keys], axis=0)
    return new


def window_array(parts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The suffixes of at least ``n`` bytes of all parts, sorted by their
    first ``n`` bytes: (array, class of each, bytes, part starts). Suffixes of
    one class share these bytes; classes rise with them.

    The order by d bytes gives that by up to 3 d: a suffix is ranked by the
    ranks of its d bytes at three places. Only suffixes that have all these
    bytes are ranked; no shorter one is ever asked for.
    """
    size = np.array([len(p) for p in parts])
    start = np.r_[0, np.cumsum(size)]
    t = np.frombuffer(b"".join(parts) + bytes(8), np.uint8)
    left = np.repeat(start[1:], size) - np.arange(start[-1])
    depth = min(8, n)
    s = np.flatnonzero(left >= depth)
    key = np.ndarray(len(left), ">u8", t, strides=(1,)).astype(np.uint64)[s] >> np.uint64(64 - 8 * depth)
    rank = np.zeros(len(left), np.uint32)
    while True:
        o = np.argsort(key)
        cls = np.cumsum(_heads(key[o])) - 1
        s = s[o]
        if depth == n or not len(s):
            return s, cls, t, start
        rank[s] = cls
        bits = max(1, int(cls[-1]).bit_length())
        times = 3 if 3 * bits <= 64 else 2
        then = min(times * depth, n)
        s = np.flatnonzero(left >= then)
        key = np.zeros(len(s), np.uint64)
        for i in [0, depth, then - depth] if then > 2 * depth else [0, then - depth]:
            key = (key << np.uint64(bits)) | rank[s + i]
        depth = then


def suffix_array(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array of all parts, shorter suffixes and all bytes included
    (Larsson-Sadakane: prefix doubling that re-sorts only groups still tied).
    ``window_array`` is the part of it that the operator needs.

    Returns (array, bytes padded with 8 zeros, part starts, end of each
    position's part). A suffix ends with its part; an ended suffix precedes
    its extensions, and ended suffixes of equal text are told apart by
    position (as if each part ended in a mark of its own).
    """
    size = np.array([len(p) for p in parts])
    start = np.r_[0, np.cumsum(size)]
    n = int(start[-1])
    t = np.frombuffer(b"".join(parts) + bytes(8), np.uint8)
    end = np.repeat(start[1:], size)
    left = end - np.arange(n)
    # Seven bytes and how many of them there are; ended suffixes of equal text stay in order.
    key = np.zeros(n, np.uint64)
    for i in range(7):
        key = (key << np.uint64(8)) | np.where(left > i, t[i:n + i], 0).astype(np.uint64)
    key = (key << np.uint64(8)) | np.minimum(left, 7).astype(np.uint64)
    sa = np.argsort(key)
    ended = np.flatnonzero(left[sa] < 7)
    sa[ended] = sa[ended][np.lexsort((sa[ended], key[sa[ended]]))]
    # rank[i]: first place of i's group in the array; suffixes that ended are alone.
    new = np.ones(n, bool)
    new[1:] = key[sa[1:]] != key[sa[:-1]]
    new[ended] = True
    rank = np.zeros(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    h = 7
    while h < size.max():
        # Only groups still tied are sorted again.
        todo = np.flatnonzero(~(new & np.r_[new[1:], True]))
        if not len(todo):
            break
        s = sa[todo]
        # What follows h bytes later; an ended suffix comes first, by its place in the text.
        after = np.where(left[s] > h, rank[np.minimum(s + h, n - 1)] + n + 1, s)
        both = rank[s] * (2 * n + 2) + after
        o = np.argsort(both)
        s, both = s[o], both[o]
        sa[todo] = s
        fresh = np.ones(len(todo), bool)
        fresh[1:] = both[1:] != both[:-1]
        new[todo] = fresh
        rank[s] = todo[np.maximum.accumulate(np.where(fresh, np.arange(len(todo)), 0))]
        h *= 2
    return sa, t, start, end


def kasai(sa: np.ndarray, t: np.ndarray, start: np.ndarray, end: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix (up to ``cap``) of each suffix with its predecessor in
    the array, by place. Kasai's carry (a suffix one byte later shares at
    least one byte less) runs through all parts in step, as far as suffixes have
    ``cap`` bytes; other places get 0."""
    n = len(sa)
    before = np.full(n, -1)
    before[sa[1:]] = sa[:-1]
    word = np.zeros(n + 8, np.uint64)
    for i in range(8):
        word[:n] = (word[:n] << np.uint64(8)) | t[i:n + i].astype(np.uint64)
    lcp = np.zeros(n, np.int64)
    size = np.diff(start) - cap + 1  # suffixes of cap bytes
    part = np.argsort(-size, kind="stable")
    size = size[part]
    carry = np.zeros(len(part), np.int64)
    for o in range(max(0, int(size[0]))):
        live = int(np.searchsorted(-size, -o, "left"))  # parts longer than o
        pos = start[part[:live]] + o
        prev = before[pos]
        h = np.where(prev >= 0, np.maximum(carry[:live] - 1, 0), 0)
        most = np.minimum(np.minimum(end[pos] - pos, end[np.maximum(prev, 0)] - prev), cap)
        act = np.flatnonzero((prev >= 0) & (h < most))
        while len(act):
            x = word[pos[act] + h[act]] ^ word[prev[act] + h[act]]
            same = np.where(x == 0, 8, 0)
            d = np.flatnonzero(x)
            if len(d):
                same[d] = _leading_bytes(x[d])
            h[act] += same
            act = act[(same == 8) & (h[act] < most[act])]
        h = np.minimum(h, np.where(prev >= 0, most, 0))
        carry[:live] = h
        lcp[pos] = h
    return lcp[sa]


def _leading_bytes(x: np.ndarray) -> np.ndarray:
    """Number of zero bytes at the high end of non-zero words."""
    out = np.zeros(len(x), np.int64)
    for shift in range(56, 0, -8):
        out += (x >> np.uint64(shift)) == 0
    return out


def _classes(rows: dict, n: int) -> tuple:
    """Class of each suffix that has n bytes; see ``_search``."""
    pos, cls, t, start = window_array(rows["body"], n)
    return pos, cls, np.repeat(np.arange(len(start) - 1), np.diff(start))[pos], t, start


def _spans(rows: dict, pos: np.ndarray, start: np.ndarray, n: int) -> pd.DataFrame:
    """Unions of the windows at ``pos``, by context."""
    pos = np.sort(pos)
    part = np.searchsorted(start, pos, "right") - 1
    once = np.array(rows["n"], np.int64)[part] == 1  # contexts that occur twice are removed as a whole anyway
    pos, part = pos[once], part[once]
    new = np.ones(len(pos), bool)
    new[1:] = (part[1:] != part[:-1]) | (pos[1:] - pos[:-1] > n)
    a, b = np.flatnonzero(new), np.flatnonzero(np.r_[new[1:], True][:len(new)])
    at = np.array(rows["start"], np.int64)[part[a]] - start[part[a]]
    return pd.DataFrame({"key": np.array(rows["key"], np.int64)[part[a]], "a": at + pos[a], "b": at + pos[b] + n})


def _recurs(rows: dict, pos, cls, part, start) -> np.ndarray:
    """Per suffix: is its n-byte string at two places? Overlapping contexts
    of one text may hold the same place twice; a context that occurs twice
    is at two places by itself."""
    keys = np.array(rows["key"], np.int64)[part]
    place = np.array(rows["start"], np.int64)[part] + pos - start[part]
    many = np.array(rows["n"], np.int64)[part] > 1
    head = np.flatnonzero(_heads(cls))[cls]
    two = (keys != keys[head]) | (place != place[head]) | many
    return (np.bincount(cls, weights=two) > 0)[cls]


def _shards(batches: Iterator[pd.DataFrame], most: int) -> Iterator[tuple[bool, dict]]:
    """Rows sorted by (part, fp, ctx) in shards: each (part, fp) of an anchor
    that is dealt over several parts, and runs of other anchors of about
    ``most`` bytes; (dealt, rows)."""
    cols = ("parts", "part", "fp", "ctx", "key", "start", "n", "body")
    now, size, group, last = {c: [] for c in cols}, 0, None, None
    for pdf in batches:
        for row in zip(*(pdf[c] for c in cols)):
            parts, part, fp, ctx = row[:4]
            if (fp, ctx) == last:
                continue  # the same context, from a repeated row
            mine = (part, fp) if parts > 1 else None
            if now["fp"] and (mine != group or mine is None and size > most and fp != now["fp"][-1]):
                yield group is not None, now
                now, size = {c: [] for c in cols}, 0
            last, group = (fp, ctx), mine
            for c, v in zip(cols, row):
                now[c].append(v)
            size += len(row[-1])
    if now["fp"]:
        yield group is not None, now


def _class_keys(pos, cls, t, n: int) -> tuple[np.ndarray, list[bytes]]:
    """The place of each class in the array and its 128-bit key."""
    first = np.flatnonzero(np.r_[True, cls[1:] != cls[:-1]])
    raw = t.tobytes()
    return first, [hashlib.blake2b(raw[p:p + n], digest_size=16).digest() for p in pos[first]]


def _search(n: int, k: int, most: int):
    """Spans of single contexts whose n-byte strings recur in their shard,
    and the ladders of dealt anchors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for dealt, rows in _shards(batches, most):
            pos, cls, part, t, start = _classes(rows, n)
            if not len(pos):
                continue
            twice = _recurs(rows, pos, cls, part, start)
            yield _frame(_spans(rows, pos[twice], start, n))
            if dealt:
                q, i, rungs = _ladders(rows, t, start, n, k)
                hit, key = (np.concatenate(v) for v in zip(*((r[2], r[3]) for r in rungs)))
                if len(hit):
                    o = np.argsort(key, kind="stable")
                    hit, key = hit[o], key[o]
                    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
                    lo, hi = _places(rows, q[hit], i[hit], start, first)
                    yield _report(rows, [int(x).to_bytes(8, "big") for x in key[first]], lo, hi)

    return run


def _ladders(rows: dict, t, start, n: int, k: int) -> tuple[np.ndarray, np.ndarray, list]:
    """Places of a shard's anchor gram in its contexts, the contexts, and per
    rung (side, bytes, which places, keys): the key of the gram grown by so
    many bytes to that side, where the context has them. A gram that stands
    at several places of a context has ladders at each: equal strings hold
    it at the same offset, whichever of them chose it."""
    pre = prefix_hashes(t[:int(start[-1])])
    s = np.arange(max(0, int(start[-1]) - k + 1))
    i = np.searchsorted(start, s, "right") - 1
    q = s[(s + k <= start[i + 1]) & (span_hashes(pre, s, s + k).view(np.int64) == rows["fp"][0])]
    i = np.searchsorted(start, q, "right") - 1
    rungs = []
    for v in _steps(n, k):
        left = np.flatnonzero(q - v >= start[i])
        rungs.append((0, v, left, mix(span_hashes(pre, q[left] - v, q[left] + k) + np.uint64(2 * v))))
        right = np.flatnonzero(q + k + v <= start[i + 1])
        rungs.append((1, v, right, mix(span_hashes(pre, q[right], q[right] + k + v) + np.uint64(2 * v + 1))))
    return q, i, rungs


def _steps(n: int, k: int) -> list[int]:
    """1, 2, 4, ... and n - k, the most bytes beside the gram in a window."""
    return [1 << j for j in range((n - k).bit_length()) if 1 << j < n - k] + [n - k]


def _may_recur(rows: dict, t, start, known: np.ndarray, n: int, k: int) -> np.ndarray:
    """Per byte: can the n-byte string from here stand in another shard?
    ``known``: sorted ladder keys of other shards."""
    q, _, rungs = _ladders(rows, t, start, n, k)
    steps = np.array([*_steps(n, k), n - k + 1])
    reach = np.zeros((2, len(q)), np.int64)  # below the first rung that no other shard has
    for side, v, place, key in rungs:
        if len(place):
            at = np.minimum(np.searchsorted(known, key), len(known) - 1)
            place = place[known[at] == key]
            reach[side, place] = steps[np.searchsorted(steps, v) + 1] - 1
    least = n - k - reach[1]  # bytes left of the gram
    ok = least <= reach[0]
    edge = np.zeros(len(t) + 1, np.int64)
    np.add.at(edge, np.maximum(q - reach[0], 0)[ok], 1)
    np.add.at(edge, np.maximum(q - least + 1, 0)[ok], -1)
    return np.cumsum(edge) > 0


def _report(rows: dict, keys: list[bytes], lo: np.ndarray, hi: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"key": 0, "a": lo, "b": hi, "fp": rows["fp"][0], "part": rows["part"][0], "cls": keys})


def _places(rows: dict, pos, part, start, first) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest hash of the places (text, offset) of each class;
    a context that occurs twice has two places."""
    keys = np.array(rows["key"], np.int64)[part].view(np.uint64)
    place = mix(keys + mix((np.array(rows["start"], np.int64)[part] + pos - start[part]).astype(np.uint64)))
    other = np.where(np.array(rows["n"], np.int64)[part] > 1, ~place, place)
    lo = np.minimum.reduceat(np.minimum(place, other), first)
    hi = np.maximum.reduceat(np.maximum(place, other), first)
    return lo.view(np.int64), hi.view(np.int64)


def _frame(spans: pd.DataFrame) -> pd.DataFrame:
    df = spans.astype("Int64")
    return df.assign(fp=pd.Series(pd.NA, df.index, "Int64"), part=pd.Series(pd.NA, df.index, "Int32"), cls=None)


def _asked(batches: Iterator[pd.DataFrame], most: int) -> Iterator[tuple[dict, np.ndarray]]:
    """The rows of each dealt shard with the sorted keys (their first 64
    bits) that another shard reports too; the keys come before the rows."""
    keys: dict[tuple[int, int], list[bytes]] = {}

    def bodies():
        for pdf in batches:
            asked = pdf["body"].isna()
            if asked.any():
                fresh = pdf[asked]
                group = list(zip(fresh["part"], fresh["fp"]))
                for g, x in zip(group, fresh["cls"]):
                    keys.setdefault(g, []).append(x[:8])
            if not asked.all():
                yield pdf[~asked]

    for _, rows in _shards(bodies(), most):
        known = keys.pop((rows["part"][0], rows["fp"][0]), [])
        if known:
            yield rows, np.sort(np.frombuffer(b"".join(known), ">u8").astype(np.uint64))


def _inside(n: int, k: int, most: int):
    """Class keys of the dealt shards, as far as other shards' ladders reach."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, known in _asked(batches, most):
            pos, cls, part, t, start = _classes(rows, n)
            if not len(pos):
                continue
            may = _may_recur(rows, t, start, known, n, k)[pos]
            live = np.zeros(int(cls[-1]) + 1, bool)
            live[cls[may]] = True
            o = np.flatnonzero(live[cls])
            if len(o):
                first, keys = _class_keys(pos[o], cls[o], t, n)
                yield _report(rows, keys, *_places(rows, pos[o], part[o], start, first))

    return run


def _probe(n: int, most: int):
    """Cross-shard merge: the rows of a dealt shard, preceded by the class
    keys that another shard reports too, to spans."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, known in _asked(batches, most):
            pos, cls, part, t, start = _classes(rows, n)
            if not len(pos):
                continue
            first, keys = _class_keys(pos, cls, t, n)
            mine = np.frombuffer(b"".join(x[:8] for x in keys), ">u8").astype(np.uint64)
            at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
            hit = np.repeat(known[at] == mine, np.diff(np.r_[first, len(cls)]))
            yield _spans(rows, pos[hit], start, n)

    return run


def _with_asked(body: DataFrame, keys: DataFrame) -> DataFrame:
    """Dealt rows by shard, each shard after its keys that another shard
    reports from another place."""
    shared = (keys.groupBy("fp", "cls").agg(F.count_distinct("part").alias("c"), F.min(F.least("lo", "hi")).alias("lo"),
                                            F.max(F.greatest("lo", "hi")).alias("hi"))
              .where("c > 1 and lo <> hi").select("fp", "cls"))
    zero = F.lit(0).cast("long")
    asked = keys.join(shared, ["fp", "cls"], "left_semi").select(
        "fp", zero.alias("ctx"), zero.alias("n"), F.lit(2).alias("parts"), zero.alias("key"), zero.alias("start"),
        F.lit(None).cast("binary").alias("body"), "part", "cls")
    both = body.where("parts > 1").withColumn("cls", F.lit(None).cast("binary")).unionByName(asked)
    return both.repartition("fp", "part").sortWithinPartitions("part", "fp", F.col("body").isNotNull(), "ctx")


def repeated_spans(docs: DataFrame, n: int = 400, k: int = GRAM, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``(key, a, b)``: byte spans of the text with ``key`` that are covered
    by repeated n-byte strings; spans may overlap. ``docs``: ``key, text``."""
    found = written(docs.mapInArrow(_contexts(n, k), CONTEXT), "contexts")
    twice = found.groupBy("fp").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("fp")
    live = written(found.join(twice, "fp", "left_semi"), "anchors")
    ctx = written(live.groupBy("fp", "ctx").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "start", "len"))
                                                .alias("at")), "distinct-contexts")
    whole = (live.join(ctx.where("n > 1").select("fp", "ctx"), ["fp", "ctx"], "left_semi")
             .select("key", F.col("start").alias("a"), (F.col("start") + F.col("len")).alias("b")))
    fps = (ctx.groupBy("fp").agg(F.count(F.lit(1)).alias("d"), F.min("n").alias("least"))
           .where("d > 1 and least = 1")
           .select("fp", F.ceil(F.col("d") * F.lit(float(2 * n - k) / (DEAL * shard_bytes))).cast("int").alias("parts")))
    need = written(ctx.join(fps, "fp").select("fp", "ctx", "n", "parts", "at.*"), "needed-contexts")
    keys = need.select("key").distinct()
    text = prefilter(docs, "key", keys).withColumn("bytes", F.col("text").cast("binary")).select("key", "bytes")
    body = (text.join(need, "key")
            .select("fp", "ctx", "n", "parts", "key", "start", F.substring(F.col("bytes"), F.col("start").cast("int") + 1,
                                                                           F.col("len")).alias("body"))
            .withColumn("part", F.when(F.col("parts") > 1, F.pmod("ctx", F.col("parts"))).otherwise(0).cast("int")))
    body = written(body, "context-bytes")
    report = "key long, a long, b long, fp long, part int, cls binary"
    one = written(body.repartition("fp", "part").sortWithinPartitions("part", "fp", "ctx").mapInPandas(
        _search(n, k, shard_bytes), report), "spans")
    spans = whole.unionByName(one.where("cls is null").select("key", "a", "b"))
    # Anchors dealt over several shards: ladders, then classes that two shards report, go back to those shards.
    found_keys = [F.col("fp"), F.col("part"), F.col("cls"), F.col("a").alias("lo"), F.col("b").alias("hi")]
    ladders = one.where("cls is not null").select(*found_keys)
    keys = written(_with_asked(body, ladders).mapInPandas(_inside(n, k, shard_bytes), report).select(*found_keys),
                   "class-keys")
    more = _with_asked(body, keys).mapInPandas(_probe(n, shard_bytes), SPAN)
    return spans.unionByName(more)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their spans -> what is removed and what is left."""
    for batch in batches:
        out = []
        for text, a, b in zip(batch.column("text"), batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            raw = text.as_buffer().to_pybytes()
            kept, removed, at, runs = [], 0, 0, 0
            end = -1
            for x, y in sorted(zip(a, b)):
                if x > end:
                    kept.append(raw[at:x])
                    runs += 1
                    at = x
                if y > end:
                    removed += y - max(x, at)
                    at = end = y
            kept.append(raw[at:])
            left = b"".join(kept)
            out.append((len(raw) - len(left), runs, left))
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
             pa.array([r[2] for r in out], pa.binary())], ["key", "n_removed", "n_spans", "kept"])


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn("__sx_key", F.xxhash64(F.col(doc_id), t)).withColumn("__sx_text", t)


def cut_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 400,
              shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``key, n_removed, n_spans, kept`` (bytes) of the texts that lose
    something; ``key`` is xxhash64(id, text or "")."""
    keyed = _keyed(docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_t")), "_id", "_t").select(
        F.col("__sx_key").alias("key"), F.col("__sx_text").alias("text"))
    spans = written(repeated_spans(keyed, n, shard_bytes=shard_bytes), "repeats")
    # Spans of one text: at most one per anchor in it.
    per = spans.groupBy("key").agg(F.collect_list("a").alias("a"), F.collect_list("b").alias("b"))
    some = prefilter(keyed, "key", spans.select("key").distinct())
    cut = some.join(per, "key").mapInArrow(_cut, "key long, n_removed long, n_spans long, kept binary")
    return written(cut, "cut").dropDuplicates(["key"])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 400,
                   shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans,
    kept_sha256`` after removing every byte covered by an n-byte string that
    also starts anywhere else (same text included), as judged on the input.

    Null text: no bytes. Texts under n bytes: unchanged. Repeated rows are
    separate documents and repeat each other. Ids need not be unique or
    non-null: rows are told apart by id and text. No rows: none. Extra
    columns are ignored and may have any name.
    """
    cut = cut_texts(docs, doc_id, text, n, shard_bytes).select(
        F.col("key").alias("__sx_key"), "n_removed", "n_spans", F.sha2("kept", 256).alias("_sha"))
    rows = _keyed(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_t")), "doc_id", "_t").select(
        "doc_id", "__sx_key", F.octet_length("__sx_text").cast("long").alias("n_bytes"),
        F.sha2(F.col("__sx_text"), 256).alias("_whole"))
    return rows.join(cut, "__sx_key", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("_sha", "_whole").alias("kept_sha256"))


def without_repeats(docs: DataFrame, n: int = 400) -> DataFrame:
    """``docs`` (``doc_id, text`` and any others) with the repeated bytes cut
    from ``text``; a character cut in part goes whole. All columns are kept,
    ``n_chars`` is renewed where there is one. Documents left without text stay,
    with empty text; null texts stay null."""
    cut = cut_texts(docs, n=n).select(F.col("key").alias("__sx_key"), F.col("kept").alias("__sx_kept"))
    whole = _keyed(docs, "doc_id", "text").drop("__sx_text").join(cut, "__sx_key", "left")
    # Invalid sequences at the cuts decode to U+FFFD; texts rarely hold that character themselves.
    text = F.when(F.col("__sx_kept").isNull(), F.col("text")).otherwise(
        F.replace(F.make_valid_utf8(F.col("__sx_kept").cast("string")), F.lit("\ufffd"), F.lit("")))
    out = whole.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
