"""Operator 8: quality by perplexity under interpolated modified
Kneser-Ney models trained on trusted text.

Two models are nested. The word model has order 3; its n-grams of all
trusted text are counted into tables that grow with the corpus and stay
sharded by n-gram. Its unknown words are spelled by the second model, of
byte classes: the ``CLASSES - 2`` most frequent bytes of the trusted text
have one class each, the others share one, and one marks the start of a
word. That one has at most CLASSES ** 3 entries (8 MB) and goes to every
task.

A text's negative log likelihood is a sum over its n-grams: the spelling of
all words, and for every n-gram that the trusted text holds a correction
that the tables give. Trigrams of trusted and scored texts meet in the bucket
of their middle word, some buckets at a time, and are summed per document.

Trusted texts are halved by a hash, each half has a word model, and every
text, trusted or not, has the worse of its two scores: the one of a model
that doesn't hold the text itself or a near copy. Otherwise limits set by
trusted texts, which would know their own n-grams, would condemn all others.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import prefilter, remove, written, written_once
from .textgrams import mix, prefix_hashes, span_hashes, text_slices, words

CLASSES = 128
START, OTHER = 0, 1
#: Bytes are shifted by one in raw trigram codes, 0 being the start mark.
RAW = 257
#: Hashes of the marks before and after a text in the word model.
BEGIN, END = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9E6C63D0876A9A47)
#: Documents' n-grams are gathered over blocks of about this many bytes.
BLOCK_BYTES = 8 << 20
#: n-grams are moved in up to ROUNDS parts, of at least this many bytes of
#: trusted text each; a bucket has about this many.
ROUNDS, ROUND_BYTES, BUCKET_BYTES = 8, 2 << 20, 2 << 20
#: Bytes of a word's hash that trigrams carry for the first and last word
#: (the middle word has all 8).
A_BYTES, C_BYTES = 6, 7
A_MASK, C_MASK = np.uint64((1 << 48) - 1), np.uint64((1 << 56) - 1)


def _trigrams(data: np.ndarray, off: np.ndarray, symbol: np.ndarray, base: int) -> np.ndarray:
    """The code of (two symbols before, symbol) of every byte, text by text."""
    n = len(data)
    s = symbol.astype(np.int32)[data]  # codes are under RAW ** 3
    one, two = np.zeros(n, np.int32), np.zeros(n, np.int32)
    one[1:], two[2:] = s[:-1], s[:-2]
    first = off[:-1][np.diff(off) > 0]
    one[first], two[first] = START, START
    second = first + 1
    two[second[second < n]] = START
    # A one-byte text: the byte after it starts the next text and is already right.
    return (two * base + one) * base + s


def _spelled(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words [start, end) with one blank after each: (bytes, offsets)."""
    off = np.r_[0, np.cumsum(end - start + 1)]
    kind = np.int32 if off[-1] + len(data) < 1 << 31 else np.int64
    at = np.repeat((start - off[:-1]).astype(kind), end - start + 1)
    at += np.arange(off[-1], dtype=kind)
    out = data[np.minimum(at, len(data) - 1, out=at)] if len(data) else data
    out[off[1:] - 1] = 0x20
    return out, off


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(RAW ** 3, np.int32)
    held = 0

    def rows():
        code = np.flatnonzero(total)
        for i in range(0, len(code), 1 << 16):
            part = code[i:i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part].astype(np.int64))], ["code", "n"])

    shift = np.arange(1, 257)
    for b in batches:
        for _, _, data, off in text_slices(b, "text"):
            data, off = _spelled(data, *words(data, off)[:2])
            if held + len(data) >= 1 << 31:
                yield from rows()
                total[:] = 0
                held = 0
            held += len(data)
            code, n = np.unique(_trigrams(data, off, shift, RAW), return_counts=True)
            total[code] += n.astype(np.int32)
    yield from rows()


def _shared(spark: SparkSession, model: dict) -> Broadcast:
    """The model's classes and table, broadcast once for all jobs."""
    if "shared" not in model:
        model["shared"] = spark.sparkContext.broadcast({k: model[k] for k in ("classes", "nll")})
    return model["shared"]


def _spelling(model: dict, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """nll of each spelled word."""
    nll = np.zeros(len(data) + 1)
    np.cumsum(model["nll"][_trigrams(data, off, model["classes"], CLASSES)], out=nll[1:])
    return nll[off[1:]] - nll[off[:-1]]


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans, eight bytes at a time."""
    eight = np.ndarray(len(data) + 1, "<u8", np.r_[data, np.zeros(8, np.uint8)], strides=(1,))
    size = end - start
    h = mix(size.astype(np.uint64) + END)
    some, at, left = slice(None), start, size
    while len(at):
        few = np.minimum(left, 8)
        x = eight[at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> ((8 - few) * 8).astype(np.uint64))
        h[some] = mix((h[some] ^ x) * np.uint64(0x9E3779B97F4A7C15))
        more = np.flatnonzero(left > 8)
        some = more if isinstance(some, slice) else some[more]
        at, left = at[more] + 8, left[more] - 8
    return h


def _sequences(data: np.ndarray, off: np.ndarray, ids: bool = True) -> tuple[np.ndarray, ...]:
    """All texts with a word as one sequence of word hashes, two marks
    before and one after each text: (hashes, text of each, position in the
    text, start and end of the words, each text's hash if ``ids``)."""
    start, end, first = words(data, off)
    whole = span_hashes(prefix_hashes(data), off[:-1], off[1:]) if ids else None
    n = np.diff(first)
    size = np.where(n > 0, n + 3, 0)
    to = np.r_[0, np.cumsum(size)]
    text = np.repeat(np.arange(len(n)), size)
    pos = np.arange(to[-1]) - to[text]
    x = np.full(to[-1], BEGIN, np.uint64)
    last = pos == size[text] - 1
    x[last] = END
    x[(pos >= 2) & ~last] = _word_hashes(data, start, end)
    return x, text, pos, start, end, whole


def _key(order: int, *gram: np.ndarray) -> np.ndarray:
    """64-bit key of the n-gram."""
    k = np.full(len(gram[0]), order, np.uint64)
    for w in gram:
        k = mix(k ^ w) * np.uint64(0x9E3779B97F4A7C15)
    return mix(k)


def _fold(whole: np.ndarray) -> np.ndarray:
    return (whole >> np.uint64(17)) & np.uint64(1)


def _discount(n: dict) -> tuple[float, float, float]:
    """D1, D2, D3+ from the numbers of n-grams seen 1 to 4 times."""
    n1, n2, n3, n4 = (n.get(i, 0) for i in (1, 2, 3, 4))
    if not (n1 and n2 and n3):
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    return tuple(min(max(d, 0.05), i) for i, d in enumerate((1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2,
                                                            3 - 4 * y * n4 / n3), 1))


def _discounts(counts: DataFrame, c: str) -> tuple[float, float, float]:
    return _discount(dict(counts.where(F.col(c) <= 4).groupBy(c).count().collect()))


def _discounted(c: Column, d: tuple[float, float, float]) -> Column:
    return F.when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])


def _order(counts: DataFrame, context: list[str], c: str) -> DataFrame:
    """n-gram counts -> ``alpha`` (discounted relative count) of each n-gram
    and ``gamma`` (the mass its context leaves to lower orders)."""
    d = _discounts(counts, c)
    cut = _discounted(F.col(c), d)
    rows = counts.withColumn("_cut", F.least(cut, F.col(c).cast("double")))
    if not context:
        t, m = rows.agg(F.sum(c), F.sum("_cut")).first()
        out = rows.withColumns({"_t": F.lit(t), "_m": F.lit(m)})
    else:
        whole = rows.groupBy(*context).agg(F.sum(c).alias("_t"), F.sum("_cut").alias("_m"))
        out = rows.join(whole, context)
    return (out.withColumn("alpha", (F.col(c) - F.col("_cut")) / F.col("_t"))
            .withColumn("gamma", F.col("_m") / F.col("_t")))


def train(trusted: DataFrame, text: str = "text") -> dict:
    """The model of all ``trusted`` texts: the class of each byte and the
    dense table of negative log probabilities (CLASSES ** 3, float32).

    Trigram counts are formed per task and summed by key; continuation
    counts, totals and discounts are aggregations and joins of count tables
    sharded by n-gram. No trusted text: a uniform model.
    """
    raw = written(trusted.where(F.col(text).isNotNull()).select(F.col(text).alias("text"))
                  .mapInArrow(_count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")), "lm-raw")
    last = raw.groupBy(F.pmod("code", F.lit(RAW)).alias("b")).agg(F.sum("n").alias("n"))
    top = [r["b"] - 1 for r in last.orderBy(F.desc("n"), "b").limit(CLASSES - 2).collect()]
    cls = np.full(256, OTHER)
    cls[top] = np.arange(2, 2 + len(top))
    of = F.array(F.lit(START), *[F.lit(int(k)) for k in cls])
    at = lambda e: F.element_at(of, (F.pmod(e, F.lit(RAW)) + 1).cast("int"))
    tri = written(raw.select(at(F.floor(F.col("code") / (RAW * RAW))).alias("a"), at(F.floor(F.col("code") / RAW)).alias("b"),
                             at(F.col("code")).alias("c"), "n").groupBy("a", "b", "c").agg(F.sum("n").alias("n")),
                  "lm-trigrams")
    bi = tri.groupBy("b", "c").agg(F.count(F.lit(1)).alias("n"))  # continuation counts
    uni = bi.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    p = np.full(CLASSES, 1.0 / CLASSES)
    # Each collected table has at most CLASSES ** order rows.
    t1 = _order(uni, [], "n").select("c", "alpha", "gamma").toPandas()
    if len(t1):
        p1 = t1["gamma"].iloc[0] * p
        p1[t1["c"]] += t1["alpha"]
        t2 = _order(bi, ["b"], "n").select("b", "c", "alpha", "gamma").toPandas()
        left = np.ones(CLASSES)
        left[t2["b"]] = t2["gamma"]
        p2 = left[:, None] * p1[None, :]
        p2[t2["b"], t2["c"]] += t2["alpha"]
        t3 = _order(tri, ["a", "b"], "n").select("a", "b", "c", "alpha", "gamma").toPandas()
        left = np.ones((CLASSES, CLASSES))
        left[t3["a"], t3["b"]] = t3["gamma"]
        p3 = left[:, :, None] * p2[None, :, :]
        p3[t3["a"], t3["b"], t3["c"]] += t3["alpha"]
    else:
        p3 = np.broadcast_to(p, (CLASSES, CLASSES, CLASSES))
    return {"classes": cls, "nll": (-np.log(p3)).astype(np.float32).reshape(-1)}


def _planes(x: np.ndarray, n: int) -> bytes:
    """The lowest ``n`` bytes of unsigned integers, all first bytes first."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1)[:, :n].T).tobytes()


def _packed(b: np.ndarray, a: np.ndarray, c: np.ndarray, *more: np.ndarray) -> bytes:
    """Distinct trigrams, sorted by (b, a, c), with further 4-byte columns."""
    hb = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
    ha = np.flatnonzero(np.r_[True, (b[1:] != b[:-1]) | (a[1:] != a[:-1])])
    size = lambda head: np.diff(np.r_[head, len(b)]).astype(np.uint32)
    parts = [np.array([len(hb), len(ha), len(b), *map(len, more)], np.int64).tobytes(), b[hb].tobytes(), _planes(size(hb), 4),
             _planes(a[ha], A_BYTES), _planes(size(ha), 4), _planes(c, C_BYTES), *(_planes(m, 4) for m in more)]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpacked(data: bytes, types: list) -> list[np.ndarray]:
    """[b, a, c, further columns] of ``_packed``."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    n = raw[:8 * (3 + len(types))].view(np.int64)
    at = 8 * len(n)

    def take(count: int, width: int, kind) -> np.ndarray:
        nonlocal at
        out = np.zeros((count, np.dtype(kind).itemsize), np.uint8)
        out[:, :width] = raw[at:at + count * width].reshape(width, count).T
        at += count * width
        return out.reshape(-1).view(kind)

    b = raw[at:at + 8 * n[0]].copy().view(np.uint64)
    at += 8 * int(n[0])
    b = np.repeat(b, take(int(n[0]), 4, np.uint32))
    a = take(int(n[1]), A_BYTES, np.uint64)
    a = np.repeat(a, take(int(n[1]), 4, np.uint32))
    return [b, a, take(int(n[2]), C_BYTES, np.uint64), *(take(int(m), 4, t) for m, t in zip(n[3:], types))]


def _bucket(b: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets rise with the hash of the middle word."""
    return ((b >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)


def _runs_of(x: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, start, end) of the runs of equal values."""
    head = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, int)
    for i, j in zip(head, np.r_[head[1:], len(x)]):
        yield int(x[i]), int(i), int(j)


def _picked(data: np.ndarray, off: np.ndarray, buckets: int, rounds: int, now: int, ids: bool = True):
    """The trigrams (a, b, c) of texts whose middle word is in a bucket of
    this round: (a, b, c, text, index of c, sequences)."""
    seq = _sequences(data, off, ids)
    x, text, pos = seq[:3]
    at = np.flatnonzero(pos >= 2)
    at = at[_bucket(x[at - 1], buckets) % np.uint64(rounds) == now]
    return x[at - 2] & A_MASK, x[at - 1], x[at] & C_MASK, text[at], at, seq


BLOBS = "bucket int, kind int, block long, data binary, whole array<bigint>"


def _blobs(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64())))],
        ["bucket", "kind", "block", "data", "whole"])


def _trusted_grams(buckets: int, rounds: int, now: int, shared: Broadcast | None = None):
    """Trusted texts -> per slice, half and bucket the trigrams with their
    counts (kind 1 and 2 for the halves), with a ``shared`` model also the
    spelling nll of the last word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value if shared else None
        for batch in batches:
            for _, _, data, off in text_slices(batch, "text"):
                a, b, c, text, at, (x, _, pos, start, end, whole) = _picked(data, off, buckets, rounds, now)
                if not len(b):
                    continue
                spell = np.zeros(len(x), np.float32)
                if model:
                    spell[x == END] = _spelling(model, np.array([0x20], np.uint8), np.array([0, 1]))[0]
                    spell[(pos >= 2) & (x != END)] = _spelling(model, *_spelled(data, start, end))
                f = _fold(whole)[text]
                o = np.lexsort((c, a, b, f))
                a, b, c, f, at = a[o], b[o], c[o], f[o], at[o]
                new = np.r_[True, (f[1:] != f[:-1]) | (b[1:] != b[:-1]) | (a[1:] != a[:-1]) | (c[1:] != c[:-1])]
                head = np.flatnonzero(new)
                n = np.diff(np.r_[head, len(b)]).astype(np.uint32)
                a, b, c, f, s = a[head], b[head], c[head], f[head], spell[at[head]]
                rows = []
                for g, i, j in _runs_of(f * np.uint64(buckets) + _bucket(b, buckets)):
                    more = [n[i:j], s[i:j]] if model else [n[i:j]]
                    rows.append((g % buckets, 1 + g // buckets, 0, _packed(b[i:j], a[i:j], c[i:j], *more), None))
                yield _blobs(rows)

    return run


def _text_grams(buckets: int, rounds: int, now: int):
    """Texts -> per block of texts and bucket the distinct trigrams with the
    texts they occur in (kind 3); copies of a text in a block count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen, wholes, parts = 0, set(), [], []

        def rows():
            nonlocal held
            block = uuid.uuid4().int >> 65
            a, b, c, place = (np.concatenate(p) for p in zip(*parts))
            whole = np.array(wholes, np.int64)
            o = np.lexsort((place, c, a, b))
            a, b, c, place = a[o], b[o], c[o], place[o]
            out = []
            for g, i, j in _runs_of(_bucket(b, buckets)):
                x, y, z, p = a[i:j], b[i:j], c[i:j], place[i:j]
                new = np.r_[True, (y[1:] != y[:-1]) | (x[1:] != x[:-1]) | (z[1:] != z[:-1])]
                post = np.flatnonzero(new | np.r_[True, p[1:] != p[:-1]])
                own, at = np.unique(p[post], return_inverse=True)
                head = np.flatnonzero(new)
                texts = np.diff(np.searchsorted(post, np.r_[head, len(p)])).astype(np.uint32)
                out.append((g, 3, block, _packed(y[head], x[head], z[head], texts, at.astype(np.uint32),
                                                 np.diff(np.r_[post, len(p)]).astype(np.uint32)), whole[own]))
            held = 0
            for keep in (seen, wholes, parts):
                keep.clear()
            for i in range(0, len(out), 16):
                yield _blobs(out[i:i + 16])

        for batch in batches:
            for first, end, data, off in text_slices(batch, "text"):
                a, b, c, text, _, _ = _picked(data, off, buckets, rounds, now, ids=False)
                ids = np.full(len(off) - 1, -1)
                for i, w in enumerate(batch.column("whole").slice(first, end - first).to_pylist()):
                    if w not in seen:
                        seen.add(w)
                        ids[i] = len(wholes)
                        wholes.append(w)
                ok = ids[text] >= 0
                parts.append((a[ok], b[ok], c[ok], ids[text][ok]))
                held += len(data)
                if held >= BLOCK_BYTES:
                    yield from rows()
        if parts:
            yield from rows()

    return run


def _sum_by(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """(distinct keys, index of one row each, row's key, sums of the values)."""
    own, first, at = np.unique(key, return_index=True, return_inverse=True)
    return own, first, at, *(np.bincount(at, weights=v, minlength=len(own)) for v in values)


def _grams_of(blobs: list[bytes], types: list) -> list[np.ndarray]:
    """All trigrams of the blobs, added up: [b, a, c, count, further columns]."""
    cols = [np.concatenate(x) for x in zip(*(_unpacked(d, types) for d in blobs))]
    _, first, _, n = _sum_by(_key(3, *(cols[i] for i in (1, 0, 2))), cols[3])
    return [*(x[first] for x in cols[:3]), n, *(x[first] for x in cols[4:])]


def _seen(n: np.ndarray) -> np.ndarray:
    """How many are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(n, 5).astype(np.int64), minlength=6)[1:5]


WORDS = "shard int, bucket int, data binary, stat array<bigint>"


def _word_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64())))],
        ["shard", "bucket", "data", "stat"])


def _vocabulary(w: np.ndarray, n: list[np.ndarray], s: np.ndarray) -> bytes:
    """Words sorted by hash with a count in each half and the spelling nll."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(
        [np.array([len(w)], np.int64).tobytes(), _planes(w, C_BYTES), *(_planes(x.astype(np.uint64), 6) for x in n),
         s.astype(np.float32).tobytes()]))


def _vocabulary_of(data: bytes) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    n = int(raw[:8].view(np.int64)[0])
    at, out = 8, []
    for width in (C_BYTES, 6, 6):
        x = np.zeros((n, 8), np.uint8)
        x[:, :width] = raw[at:at + n * width].reshape(width, n).T
        out.append(x.reshape(-1).view(np.uint64))
        at += n * width
    return [*out, raw[at:].copy().view(np.float32)]


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list]]]:
    """(bucket, blobs by kind) of sorted rows."""
    now, held = None, {}
    for batch in batches:
        for bucket, kind, data in zip(*(batch.column(c).to_pylist() for c in ("bucket", "kind", "data"))):
            if bucket != now and held:
                yield now, held
                held = {}
            now = bucket
            held.setdefault(kind, []).append(data)
    if held:
        yield now, held


def _continuations(buckets: int):
    """A bucket's trusted trigrams -> how many trigrams and continuation
    counts are 1 to 4, and per shard of words: how many of the bucket's words
    each follows, also (count 0) the bucket's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, blobs in _by_bucket(batches):
            seen3, seen2, words, counts, spells = np.zeros(4, int), np.zeros(4, int), [], [], []
            for f in (0, 1):
                if f + 1 not in blobs:
                    continue
                b, _, c, n, s = _grams_of(blobs[f + 1], [np.uint32, np.float32])
                _, first, _, n2 = _sum_by(_key(2, b, c), np.ones(len(b)))
                seen3, seen2 = seen3 + _seen(n), seen2 + _seen(n2)
                w = np.unique(b) & C_MASK
                words += [c[first], w]
                counts += [np.full((len(first), 2), [1 - f, f]), np.zeros((len(w), 2), int)]
                spells += [s[first], np.full(len(w), np.inf, np.float32)]
            w, n, s = map(np.concatenate, (words, counts, spells))
            own, _, at, n0, n1 = _sum_by(w, n[:, 0], n[:, 1])
            least = np.full(len(own), np.inf, np.float32)
            np.minimum.at(least, at, s)
            shard = (own % np.uint64(buckets)).astype(np.int64)
            o = np.argsort(shard, kind="stable")
            rows = [(-1, bucket, None, [*seen3.tolist(), *seen2.tolist()])]
            rows += [(g, bucket, _vocabulary(own[o[i:j]], [n0[o[i:j]], n1[o[i:j]]], least[o[i:j]]), None)
                     for g, i, j in _runs_of(shard[o])]
            yield _word_rows(rows)

    return run


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's words from all buckets -> each bucket's words with the sums
    of all buckets; and, bucket -1, the sums that the discounts need."""

    def rows(held: list[tuple]):
        parts = [_vocabulary_of(d) for _, d in held]
        w, n0, n1, s = (np.concatenate(x) for x in zip(*parts))
        own, _, at, n0, n1 = _sum_by(w, n0, n1)
        least = np.full(len(own), np.inf, np.float32)
        np.minimum.at(least, at, s)
        stat = []
        for n in (n0, n1):
            end = n[own == END & C_MASK].sum()
            stat += [n.sum(), (n == 1).sum(), (n == 2).sum(), (n > 2).sum(), (n == 3).sum(), (n == 4).sum(), end]
        out = [(0, -1, None, [int(x) for x in stat])]
        for (bucket, _), p in zip(held, parts):
            i = np.searchsorted(own, p[0])
            out.append((0, bucket, _vocabulary(p[0], [n0[i], n1[i]], least[i]), None))
        yield _word_rows(out)

    now, held = None, []
    for batch in batches:
        for shard, bucket, data in zip(*(batch.column(c).to_pylist() for c in ("shard", "bucket", "data"))):
            if shard != now and held:
                yield from rows(held)
                held = []
            now = shard
            held.append((bucket, data))
    if held:
        yield from rows(held)


def _summed(stats: DataFrame, size: int) -> list[int]:
    rows = stats.where("stat is not null").select(F.posexplode("stat").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x"))
    got = {r["i"]: r["x"] for r in rows.collect()}
    return [got.get(i, 0) for i in range(size)]


def train_words(trusted: DataFrame, model: dict, text: str = "text") -> tuple[dict, list[float]]:
    """The word models of both halves of ``trusted``, and per half the nll of
    taking an unknown word.

    A model is what its tables need that no bucket of middle words has by
    itself: the discounts of the three orders, and for each bucket its words
    with their continuation counts (a table). The tables of a bucket are
    built from ``trusted`` when texts are scored, some buckets at a time, so
    they are never on disk as a whole; see ``word_scores``.
    """
    trusted = trusted.where(F.col(text).isNotNull()).select(F.col(text).alias("text"))
    size = trusted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = max(1, min(ROUNDS, -(-size // ROUND_BYTES)))
    buckets = max(8 * rounds, size // BUCKET_BYTES)
    passes = -(-rounds // 4)
    shared = _shared(trusted.sparkSession, model)
    parts = []
    for i in range(passes):
        grams = trusted.mapInArrow(_trusted_grams(buckets, passes, i, shared), BLOBS)
        parts.append(written_once(grams.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
            _continuations(buckets), WORDS), "lm-follow"))
    follow = parts[0]
    for p in parts[1:]:
        follow = follow.unionByName(p)
    stat = _summed(follow, 8)
    d3, d2 = (_discount(dict(enumerate(x, 1))) for x in (stat[:4], stat[4:]))
    words = written_once(follow.where("shard >= 0").repartition("shard").sortWithinPartitions("shard").mapInArrow(
        _totals, WORDS), "lm-words")
    for p in parts:
        remove(p)
    stat = _summed(words, 14)
    d1 = _discount({1: stat[1] + stat[8], 2: stat[2] + stat[9], 3: stat[4] + stat[11], 4: stat[5] + stat[12]})
    half, unknown = [], []
    spell = float(np.float32(_spelling(model, np.array([0x20], np.uint8), np.array([0, 1]))[0]))
    for f in (0, 1):
        total, one, two, more, _, _, end = stat[7 * f:7 * f + 7]
        gamma = (one * d1[0] + two * d1[1] + more * d1[2]) / total if total else 1.0
        half.append({"total": total, "gamma": gamma})
        unknown.append(-float(np.log(gamma)))
        half[f]["end"] = float(np.log(gamma) - spell - np.log(_first(np.array([end]), spell, d1, half[f])[0])) if end else 0.0
    return {"trusted": trusted, "rounds": rounds, "buckets": buckets, "d": (d1, d2, d3), "half": half,
            "words": words.where("bucket >= 0").select("bucket", "data")}, unknown


def _cut_of(n: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.minimum(np.array(d)[np.clip(n, 1, 3).astype(np.int64) - 1], n)


def _first(n: np.ndarray, spell, d: tuple[float, float, float], half: dict) -> np.ndarray:
    """Unigram probabilities of words with these continuation counts."""
    return (n - _cut_of(n, d)) / max(half["total"], 1) + half["gamma"] * np.exp(-np.asarray(spell, float))


def _tables(blobs: dict[int, list], words: dict) -> list[tuple[np.ndarray, np.ndarray]]:
    """The corrections that a bucket's trigrams, their first two words, their
    last two and their middle word add to a text's nll: (sorted keys, values
    in both halves) each.

    In the sum over a text's n-grams each one has two parts, as the words
    predicted (-log p less what the shorter n-gram gives) and as the context
    of the next word (-log of the mass left to shorter n-grams).
    """
    d1, d2, d3 = words["d"]
    vocab = [np.concatenate(x) for x in zip(*map(_vocabulary_of, blobs.get(0, [])))]
    if vocab:
        o = np.argsort(vocab[0])
        vocab = [x[o] for x in vocab]
    found: list[list] = [[], [], [], []]
    for f, half in enumerate(words["half"]):
        if f + 1 not in blobs:
            continue
        b, a, c, n = _grams_of(blobs[f + 1], [np.uint32])
        ab, _, at_ab, t3, m3 = _sum_by(_key(2, a, b), n, _cut_of(n, d3))
        bc, first, at_bc, n2 = _sum_by(_key(4, b, c), np.ones(len(b)))
        cut2 = _cut_of(n2, d2)
        own, _, at_b, t2, m2 = _sum_by(b[first], n2, cut2)
        at = np.searchsorted(vocab[0], c[first])
        p1 = _first(vocab[1 + f][at].astype(float), vocab[3][at], d1, half)
        g2, g3 = m2 / t2, m3 / t3
        p2 = (n2 - cut2) / t2[at_b] + g2[at_b] * p1
        p3 = (n - _cut_of(n, d3)) / t3[at_ab] + g3[at_ab] * p2[at_bc]
        v1 = -np.log(g2)
        at = np.minimum(np.searchsorted(vocab[0], own & C_MASK), len(vocab[0]) - 1)
        nf = np.where(vocab[0][at] == own & C_MASK, vocab[1 + f][at].astype(float), 0.0)
        known = (nf > 0) & (own != BEGIN)
        s = vocab[3][at][known].astype(float)
        v1[known] += np.log(half["gamma"]) - s - np.log(_first(nf[known], s, d1, half))
        for t, (key, v) in enumerate([(_key(3, a, b, c), np.log(g3[at_ab] * p2[at_bc] / p3)), (ab, -np.log(g3)),
                                      (bc, np.log(g2[at_b] * p1 / p2)), (own, v1)]):
            found[t].append((f, key, v))
    out = []
    for t in found:
        keys = np.unique(np.concatenate([k for _, k, _ in t])) if t else np.zeros(0, np.uint64)
        values = np.zeros((len(keys), 2))
        for f, k, v in t:
            values[np.searchsorted(keys, k), f] = v
        out.append((keys, values))
    return out


def _at(table: tuple[np.ndarray, np.ndarray], key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, which are known) of the keys."""
    keys, values = table
    if not len(keys):
        return np.zeros((len(key), 2)), np.zeros(len(key), bool)
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    hit = keys[at] == key
    return np.where(hit[:, None], values[at], 0.0), hit


def _corrections(tables: list, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Both halves' sums of the corrections of each trigram, sorted by (b, a,
    c). A trigram is known only where all of its parts are."""
    new_b = np.r_[True, b[1:] != b[:-1]]
    new_a = new_b | np.r_[True, a[1:] != a[:-1]]
    hb, ha = np.flatnonzero(new_b), np.flatnonzero(new_a)
    of_b, of_a = np.cumsum(new_b) - 1, np.cumsum(new_a) - 1
    v_b, known_b = _at(tables[3], b[hb])
    v_a, known_a = np.zeros((len(ha), 2)), np.zeros(len(ha), bool)
    i = np.flatnonzero(known_b[of_b[ha]])
    v_a[i], known_a[i] = _at(tables[1], _key(2, a[ha[i]], b[ha[i]]))
    v = v_b[of_b] + v_a[of_a]
    i = np.flatnonzero(known_b[of_b])
    more, known = _at(tables[2], _key(4, b[i], c[i]))
    v[i] += more
    i = i[known & known_a[of_a[i]]]
    v[i] += _at(tables[0], _key(3, a[i], b[i], c[i]))[0]
    return v


def _scores(words: dict):
    """A bucket's words, trusted trigrams and texts' trigrams, in this order
    -> (block, whole, v0, v1), the corrections of the bucket per text."""
    fixed = {k: words[k] for k in ("d", "half")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blobs, tables = None, {}, None
        for batch in batches:
            for i, (bucket, kind, block, data) in enumerate(zip(*(batch.column(c).to_pylist() for c in
                                                                  ("bucket", "kind", "block", "data")))):
                if bucket != now:
                    now, blobs, tables = bucket, {}, None
                if kind < 3:
                    blobs.setdefault(kind, []).append(data)
                    continue
                if tables is None:
                    tables, blobs = _tables(blobs, fixed), {}
                b, a, c, texts, place, n = _unpacked(data, [np.uint32] * 3)
                v = _corrections(tables, a, b, c)
                whole = batch.column("whole")[i].values
                gram = np.repeat(np.arange(len(b)), texts)
                total = [np.bincount(place, weights=v[gram, f] * n, minlength=len(whole)) for f in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(whole), block)), whole, *map(pa.array, total)],
                                                 ["block", "whole", "v0", "v1"])

    return run


def word_scores(docs: DataFrame, words: dict, text: str = "text") -> DataFrame:
    """``whole, v0, v1``: the corrections of all n-grams of each distinct text
    (by its hash).

    All that a trigram needs is known where its middle word is: the counts
    of the trigram, of its first two words and of its last two. Trusted and
    scored texts send each trigram once to the bucket of that word. This is
    done in rounds of buckets, each with a part of all n-grams; only
    sums per text outlast a round. Whole texts are read in every round.
    """
    docs = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("text"), F.xxhash64(text).alias("whole"))
    rounds, buckets = words["rounds"], words["buckets"]
    empty = F.lit(None).cast("array<bigint>").alias("whole")
    sums = []
    for i in range(rounds):
        rows = (words["words"].where(F.col("bucket") % rounds == i)
                .select("bucket", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("block"), "data", empty)
                .unionByName(words["trusted"].mapInArrow(_trusted_grams(buckets, rounds, i), BLOBS))
                .unionByName(docs.mapInArrow(_text_grams(buckets, rounds, i), BLOBS)))
        part = rows.repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(
            _scores(words), "block long, whole long, v0 double, v1 double")
        # Copies of a text have the same sum.
        sums.append(written_once(part.groupBy("block", "whole").agg(F.sum("v0").alias("v0"), F.sum("v1").alias("v1"))
                                 .groupBy("whole").agg(F.max("v0").alias("v0"), F.max("v1").alias("v1")), "lm-part"))
    total = sums[0]
    for p in sums[1:]:
        total = total.unionByName(p)
    end = [h["end"] for h in words["half"]]
    out = written_once(total.groupBy("whole").agg(*[(F.sum(f"v{f}") + end[f]).alias(f"v{f}") for f in (0, 1)]), "lm-scores")
    for p in sums:
        remove(p)
    return out


def score(docs: DataFrame, model: dict, table: dict, unknown: list[float], text: str = "text",
          known: DataFrame | None = None) -> DataFrame:
    """All columns of ``docs`` with ``__lm_nll`` (negative log likelihood of
    the whole text) and ``__lm_bytes`` (of its words, with a blank each).
    Null text: 0 and 0. ``known``: ``word_scores`` of these texts, if they
    are there already."""
    shared = _shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        end_nll = _spelling(m, np.array([0x20], np.uint8), np.array([0, 1]))[0]
        for b in batches:
            for at, end, data, off in text_slices(b, text):
                start, stop, first = words(data, off)
                n = np.diff(first)
                nll = np.r_[0, np.cumsum(_spelling(m, *_spelled(data, start, stop)))]
                size = np.r_[0, np.cumsum(stop - start + 1)]
                base = np.where(n > 0, nll[first[1:]] - nll[first[:-1]] + end_nll, 0.0)
                base = [base + np.where(n > 0, u * (n + 1), 0.0) for u in unknown]
                yield pa.RecordBatch.from_arrays(
                    [b.column(i).slice(at, end - at) for i in range(b.num_columns)]
                    + [*map(pa.array, base), pa.array(size[first[1:]] - size[first[:-1]])],
                    [*b.schema.names, "__lm_b0", "__lm_b1", "__lm_bytes"])

    rows = docs.withColumn("__lm_whole", F.xxhash64(text))
    rows = rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("__lm_b0", T.DoubleType()),
                                              T.StructField("__lm_b1", T.DoubleType()),
                                              T.StructField("__lm_bytes", T.LongType())]))
    known = (word_scores(docs, table, text) if known is None else known).select(F.col("whole").alias("__lm_whole"), F.col("v0").alias("__lm_v0"),
                                                 F.col("v1").alias("__lm_v1"))
    return (rows.join(known, "__lm_whole", "left")
            .select(*docs.columns, F.greatest(*[F.col(f"__lm_b{f}") + F.coalesce(f"__lm_v{f}", F.lit(0.0)) for f in (0, 1)])
                    .alias("__lm_nll"), "__lm_bytes"))


def thresholds(scored: DataFrame, lang: str = "lang", low: float = 0.001, high: float = 0.999,
               slack: float = 0.5, prior_bytes: int = 200) -> DataFrame:
    """Per language (null: a language of its own; and one row with ``every``
    true for all together): ``mean`` nll per byte and the limits ``lo`` and
    ``hi`` of the smoothed nll per byte of trusted documents.

    ``lo`` and ``hi`` are the ``low`` and ``high`` quantiles. Fewer than
    1 / ``low`` documents cannot show them; the extremes seen are then moved
    outwards by up to ``slack`` times their distance from the median, less
    the more documents there are.
    """
    rows = scored.where("__lm_bytes > 0")
    both = (rows.select(F.col(lang).alias("lang"), F.lit(False).alias("every"), "__lm_nll", "__lm_bytes")
            .unionByName(rows.select(F.lit(None).cast("string").alias("lang"), F.lit(True).alias("every"), "__lm_nll",
                                     "__lm_bytes")))
    mean = both.groupBy("lang", "every").agg((F.sum("__lm_nll") / F.sum("__lm_bytes")).alias("mean"))
    mean = written(mean, "lm-means")
    m = mean.select(F.col("lang").alias("__lm_l"), F.col("every").alias("_e"), "mean")
    smooth = both.join(m, F.col("lang").eqNullSafe(F.col("__lm_l")) & (F.col("every") == F.col("_e")))
    q = smooth.groupBy("lang", "every", "mean").agg(F.percentile_approx(
        _smoothed(F.col("__lm_nll"), F.col("__lm_bytes"), F.col("mean"), prior_bytes), [low, 0.5, high], 10000).alias("q"),
        F.greatest(F.lit(0.0), 1 - F.count(F.lit(1)) * low).alias("_few"))
    slack = F.col("_few") * slack
    return written(q.select("lang", "every", "mean",
                            (F.col("q")[0] - slack * (F.col("q")[1] - F.col("q")[0])).alias("lo"),
                            (F.col("q")[2] + slack * (F.col("q")[2] - F.col("q")[1])).alias("hi")), "lm-limits")


def _smoothed(nll: Column, n: Column, mean: Column, prior: int) -> Column:
    """nll per byte with ``prior`` bytes of the language's mean added, so
    that a few unusual words don't condemn a short text."""
    return (nll + mean * prior) / (n + prior)


def trusted_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents labelled good and not toxic. Only texts that may match
    (fixed-size filter) are shuffled to the exact join; ids in ``good`` are
    distinct. (Catalyst would move a left-semi join below the filter.)"""
    good = labels.where("quality = 1 and coalesce(toxic, 0) <> 1 and doc_id is not null").select("doc_id").distinct()
    return prefilter(docs.select("doc_id", "text", "lang"), "doc_id", good).join(good, "doc_id")


def classify(docs: DataFrame, trusted: DataFrame, prior_bytes: int = 200, **quantiles) -> DataFrame:
    """All columns of ``docs`` plus ``perplexity`` (per byte, smoothed) and
    ``keep``.

    ``trusted`` (``text, lang``) trains the model and sets the limits of
    each language; a document is kept inside its language's limits. A
    language without trusted text uses the limits of all languages together;
    without any trusted text everything is kept. Null or empty text:
    perplexity of the language's mean, kept (nothing speaks against it).
    Repeated rows are scored alike. A column of ``docs`` named like one of
    the results is replaced.
    """
    trusted = written_once(trusted.select("text", "lang"), "lm-trusted")
    model = train(trusted)
    table, unknown = train_words(trusted, model)
    # Each text is scored once: the documents, and trusted texts that are not among them.
    same = F.xxhash64("text").alias("_h")
    others = written_once(trusted.select("text", same).join(docs.where("text is not null").select(same).distinct(), "_h",
                                                            "left_anti").select("text"), "lm-others")
    known = word_scores(docs.select("text").unionByName(others), table)
    remove(others)
    limits = thresholds(written(score(trusted, model, table, unknown, known=known).drop("text"), "lm-held-out"),
                        prior_bytes=prior_bytes, **quantiles)
    own = limits.where("not every").select(F.col("lang").alias("__lm_l"), F.struct("mean", "lo", "hi").alias("__lm_own"))
    e = limits.where("every").first()  # one row
    every = F.struct(*[F.lit(e[c] if e else None).cast("double").alias(c) for c in ("mean", "lo", "hi")])
    keep = [c for c in docs.columns if c not in ("perplexity", "keep") and not c.startswith("__lm_")]
    s = score(docs.select(*keep), model, table, unknown, known=known)
    remove(trusted)
    s = (s.join(own, s["lang"].eqNullSafe(F.col("__lm_l")), "left")
         .withColumn("__lm_lim", F.coalesce(F.col("__lm_own"), every)))
    value = _smoothed(F.col("__lm_nll"), F.col("__lm_bytes"), F.coalesce(F.col("__lm_lim.mean"), F.lit(0.0)), prior_bytes)
    return (s.withColumn("__lm_v", value)
            .select(*keep, F.exp("__lm_v").alias("perplexity"),
                    F.coalesce((F.col("__lm_bytes") == 0) | F.col("__lm_v").between(F.col("__lm_lim.lo"), F.col("__lm_lim.hi")),
                               F.lit(True)).alias("keep")))
