"""Operator 13: log probability of texts by prediction by partial matching.

A text is scored as its token sequence: A-Z lower-cased, every word followed
by one blank, one end byte at last. The model is a trie of byte contexts of
up to ORDER bytes. A context and the byte that follows it are one integer,
the context's last byte first, so the sorted distinct integers are the trie:
the contexts of every length are ranges of it, and a prefix of the integer is
the shorter context.

Probabilities: at a context of total T with q distinct next bytes, a byte of
count c has (2c - 1) / 2T and the escape to the next shorter context has
q / 2T; bytes seen at the longer context are excluded there (their counts
leave T, their number leaves q). Shorter contexts count a byte once for each
longer context it followed. Below the empty context all bytes that were never
seen are equally likely. The probabilities of all token sequences add up to 1.

Work is dealt in two directions. Blocks of texts report their distinct
keys (contexts with next byte, and words), dealt over buckets by a hash of
the key, so that no bucket is hot however frequent a key is; a bucket adds up
its keys over all blocks. The trie is then dealt by the last three context
bytes: such a part is bounded by the alphabet, not by the corpus. Each key's
cost goes back to the buckets, from there to the blocks that asked, and the
blocks add up the costs along their texts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written
from .textgrams import _LOWER, mix, text_slices, words

#: Context bytes; a context and its next byte fit in 64 bits up to 7.
ORDER = 5
BLANK, END = 0x20, 0x0A
#: Bytes that a token sequence can hold: those of UTF-8 less A-Z and white space, and the two above.
SYMBOLS = 256 - 13 - 26 - 6 + 2
#: Texts of a block are about this many bytes at most, of a bucket on the average.
BLOCK_BYTES, BUCKET_BYTES, SLICE = 16 << 20, 16 << 20, 1 << 19
#: The lower orders (contexts of up to 2 bytes with the next byte) are a table of at most 2 ** 24 rows.
LOW = 2

GRAM, WORD, TEXT = 0, 1, 2
_UNITS = ("kind int, block long, bucket long, keys binary, counts binary, ids array<bigint>, held array<boolean>, "
          "ends array<bigint>, data binary")
_SCHEMA = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("bucket", pa.int64()), ("keys", pa.binary()),
                     ("counts", pa.binary()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
                     ("ends", pa.list_(pa.int64())), ("data", pa.binary())])


def _zip(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unzip(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _pack(x: np.ndarray) -> bytes:
    """Sorted integers as compressed differences."""
    return _zip(np.diff(x, prepend=np.zeros(1, x.dtype)).tobytes())


def _unpack(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(_unzip(data), np.uint64), dtype=np.uint64)


def _counts(data: bytes) -> np.ndarray:
    return np.frombuffer(_unzip(data), np.int64)


def _floats(data: bytes) -> np.ndarray:
    return np.frombuffer(_unzip(data), np.float64)


def _sequence(data: np.ndarray, off: np.ndarray, order: int) -> tuple[np.ndarray, ...]:
    """Token sequences of texts (lower-cased bytes): (the key of every byte
    of the sequences, their offsets, start, end and first of the words in
    ``data``). Each sequence starts after ``order`` end bytes."""
    start, end, first = words(data, off)
    n = len(off) - 1
    size = end - start + 1
    place = np.r_[0, np.cumsum(size)]
    to = place[first] + np.arange(n + 1)  # every text has one end byte more
    padded = np.full(to[-1] + n * order, END, np.uint8)
    text = np.repeat(np.arange(n), np.diff(first))
    if len(start):
        lead = order * (text + 1) + text
        src = np.repeat(start - place[:-1], size)
        src += np.arange(place[-1])
        byte = data[np.minimum(src, len(data) - 1, out=src)]
        byte[place[1:] - 1] = BLANK
        at = np.repeat(lead, size)
        at += np.arange(place[-1])
        padded[at] = byte
    row = np.zeros((len(padded), 8), np.uint8)  # big-endian: the last context byte first, the next byte last
    row[:, 7] = padded
    for j in range(1, order + 1):
        row[j:, 6 - order + j] = padded[:-j]
    key = row.view(">u8").reshape(-1).astype(np.uint64)
    own = np.ones(len(padded), bool)
    own.reshape(-1)[(to[:-1] + order * np.arange(n))[:, None] + np.arange(order)] = False
    return key[own], to, start, end, first


def _distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and how often each occurs."""
    key = np.sort(key)
    at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[at], np.diff(np.r_[at, len(key)])


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of sorted lists, sorted, with their counts added up."""
    key, n = np.concatenate(keys), np.concatenate(counts)
    if not len(key):
        return key, n
    by = np.argsort(key, kind="stable")  # merges sorted runs
    key = key[by]
    at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[at], np.add.reduceat(n[by], at)


def _word_array(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The words [start, end) of ``data`` as an Arrow array."""
    size = end - start
    off = np.r_[0, np.cumsum(size)]
    src = np.repeat(start - off[:-1], size) + np.arange(off[-1])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [
        None, pa.py_buffer(off.astype(np.int64).tobytes()), pa.py_buffer(data[src].tobytes())])


def _word_buckets(w: pa.Array, buckets: int, step: int = 1 << 15) -> np.ndarray:
    """The bucket of each word, by a hash of its bytes."""
    out = np.zeros(len(w), np.int64)
    for lo in range(0, len(w), step):
        part = w.slice(lo, step)
        off = np.frombuffer(part.buffers()[1], np.int64)[part.offset:part.offset + len(part) + 1]
        data = np.frombuffer(part.buffers()[2], np.uint8)[off[0]:off[-1]]
        off = off - off[0]
        at = np.arange(len(data)) - np.repeat(off[:-1], np.diff(off))
        h = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(mix((at.astype(np.uint64) << np.uint64(8)) | data), out=h[1:])
        out[lo:lo + step] = mix(h[off[1:]] - h[off[:-1]]) % np.uint64(buckets)
    return out


def _joined(w: pa.Array) -> pa.Buffer:
    """The words, a line each."""
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array([0, len(w)], pa.int64()), w), pa.scalar(b"\n", w.type))[0].as_buffer()


def _one(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks)


class _Block:
    """The distinct keys of the texts seen so far, with their counts in
    training texts."""

    def __init__(self, order: int):
        self.order = order
        self.id = uuid.uuid4().int >> 65
        self.bytes = 0
        self.keys, self.n, self.waiting = [], [], 0
        self.words: list[pa.Table] = []

    def add(self, data: np.ndarray, off: np.ndarray, held: np.ndarray) -> None:
        self.bytes += len(data)
        key, to, start, end, first = _sequence(data, off, self.order)
        train = ~held
        learn = np.repeat(train, np.diff(to))
        for k, times in ((key[learn], 1), (key[~learn], 0)):
            k, n = _distinct(k)
            self.keys.append(k)
            self.n.append(n * times)
            self.waiting += len(k)
        if self.waiting > 1 << 20:
            k, n = _merge(self.keys, self.n)
            self.keys, self.n, self.waiting = [k], [n], 0
        if len(start):
            w = _word_array(data, start, end).dictionary_encode()
            learn = np.repeat(train, np.diff(first))
            n = np.bincount(w.indices.to_numpy()[learn], minlength=len(w.dictionary))
            self.words.append(pa.table({"w": w.dictionary, "n": pa.array(n)}))
            if len(self.words) > 16:
                self.words = [self._words()]

    def _words(self) -> pa.Table:
        t = pa.concat_tables(self.words).group_by("w", use_threads=False).aggregate([("n", "sum")])
        return pa.table({"w": t["w"], "n": t["n_sum"]})

    def units(self, buckets: int) -> Iterator[dict]:
        """A row per kind and bucket that the block has keys of."""
        if not self.keys:
            return
        key, n = _merge(self.keys, self.n)
        self.keys, self.n = [], []
        for b, (k, c) in _dealt((mix(key) % np.uint64(buckets)).astype(np.int64), key, n):
            yield {"kind": GRAM, "block": self.id, "bucket": b, "keys": _pack(k), "counts": _zip(c.tobytes())}
        if self.words:
            t = self._words()
            w, n = _one(t["w"]), t["n"].to_numpy()
            for b, (i, c) in _dealt(_word_buckets(w, buckets), np.arange(len(w)), n):
                yield {"kind": WORD, "block": self.id, "bucket": b, "keys": _zip(_joined(w.take(pa.array(i)))),
                       "counts": _zip(c.tobytes())}


def _dealt(part: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(part, the entries of each array that belong to it, in their order)."""
    by = np.argsort(part.astype(np.uint16) if part.max(initial=0) < 1 << 16 else part, kind="stable")
    part = part[by]
    at = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else []
    for lo, hi in zip(at, [*at[1:], len(part)]):
        yield int(part[lo]), [a[by[lo:hi]] for a in arrays]


def _rows(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += sum(len(v) for v in r.values() if isinstance(v, bytes)) + 100
        if size > 2 << 20:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _read(buckets: int, order: int):
    """(doc_id, held, text) -> the rows of _UNITS: the texts, lower-cased and
    compressed, and the keys of their block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            block = _Block(order)
            for b in batches:
                ids, held = b.column("doc_id").to_pylist(), b.column("held").to_numpy(zero_copy_only=False)
                for lo, hi, data, off in text_slices(b, "text", SLICE):
                    data = _LOWER[data]
                    block.add(data, off, held[lo:hi])
                    yield {"kind": TEXT, "block": block.id, "ids": ids[lo:hi], "held": held[lo:hi].tolist(),
                           "ends": off[1:].tolist(), "data": _zip(data.tobytes())}
                    if block.bytes >= BLOCK_BYTES:
                        yield from block.units(buckets)
                        block = _Block(order)
            yield from block.units(buckets)

        yield from _rows(rows(), _SCHEMA)

    return run


# --- the trie ---------------------------------------------------------------

_PARTS = "part long, bucket long, keys binary, counts binary"


def _add_up(parts: int, order: int):
    """All units of a bucket -> its distinct grams, dealt by the last three
    context bytes."""

    def run(t: pa.Table) -> pa.Table:
        key, n = _merge([_unpack(k) for k in t["keys"].to_pylist()], [_counts(c) for c in t["counts"].to_pylist()])
        rows = [{"part": p, "bucket": t["bucket"][0].as_py(), "keys": _pack(k), "counts": _zip(c.tobytes())}
                for p, (k, c) in _dealt(_part(key, parts, order), key, n)]
        return pa.Table.from_pylist(rows, pa.schema([("part", pa.int64()), ("bucket", pa.int64()), ("keys", pa.binary()),
                                                     ("counts", pa.binary())]))

    return run


def _part(key: np.ndarray, parts: int, order: int) -> np.ndarray:
    return (mix(key >> np.uint64(8 * (order - LOW))) % np.uint64(parts)).astype(np.int64)


class Trie:
    """Levels of contexts: for each length k the rows (context, next byte)
    with counts, and per context total, number of next bytes, and both as
    seen one level down (what is excluded there)."""

    def __init__(self, key: np.ndarray, count: np.ndarray, top: int, bottom: int = 0):
        """``key`` sorted, of contexts of ``top`` bytes; levels ``top`` to
        ``bottom`` are derived."""
        self.levels: dict[int, dict] = {}
        for k in range(top, bottom - 1, -1):
            self.put(k, key, count)
            if k > bottom:
                key, count = self.shorter(k)
                self.below(k, count)

    def put(self, k: int, key: np.ndarray, count: np.ndarray) -> None:
        context = key >> np.uint64(8)
        start = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(key) else np.zeros(0, np.int64)
        self.levels[k] = {"key": key, "count": count, "context": context[start], "start": start,
                          "total": np.add.reduceat(count, start) if len(key) else np.zeros(0, np.int64),
                          "distinct": np.diff(np.r_[start, len(key)])}

    def shorter(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of level k - 1: each byte counts once per longer context."""
        level = self.levels[k]
        key = level["key"]
        parent = ((key >> np.uint64(16)) << np.uint64(8)) | (key & np.uint64(255))
        up, at, n = np.unique(parent, return_inverse=True, return_counts=True)
        level["parent"] = at
        return up, n

    def below(self, k: int, count: np.ndarray) -> None:
        """What the contexts of level k exclude one level down, where the
        rows have ``count``."""
        level = self.levels[k]
        level["excluded"] = np.add.reduceat(count[level["parent"]], level["start"]) if len(level["key"]) else np.zeros(0)

    @staticmethod
    def _find(sorted_: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(sorted_):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(sorted_, wanted), len(sorted_) - 1)
        return at, sorted_[at] == wanted

    def costs(self, key: np.ndarray, order: int) -> np.ndarray:
        """-log10 of the probability of each key's last byte in its context."""
        cost = np.zeros(len(key))
        alive = np.ones(len(key), bool)
        gone, number = np.zeros(len(key)), np.zeros(len(key))  # excluded counts and bytes
        byte, context = key & np.uint64(255), key >> np.uint64(8)
        for k in range(order, -1, -1):
            level = self.levels[k]
            here = context >> np.uint64(8 * (order - k))
            at, known = self._find(level["context"], here)
            known &= alive
            total, distinct = np.zeros(len(key)), np.zeros(len(key))
            total[known] = level["total"][at[known]] - gone[known]
            distinct[known] = level["distinct"][at[known]] - number[known]
            row, hit = self._find(level["key"], (here << np.uint64(8)) | byte)
            hit &= known
            cost[hit] -= np.log10((2 * level["count"][row[hit]] - 1) / (2 * total[hit]))
            alive &= ~hit
            escape = known & ~hit & (total > 0)
            cost[escape] -= np.log10(distinct[escape] / (2 * total[escape]))
            if k:
                gone[:], number[:] = 0, 0
                gone[known] = level["excluded"][at[known]]
                number[known] = level["distinct"][at[known]]
        seen = int(self.levels[0]["distinct"].sum())
        cost[alive] += np.log10(max(SYMBOLS - seen, 1))
        return cost


def _low_counts(order: int):
    """A part of the trie -> how often each byte follows each context of
    LOW bytes, counted once per longer context."""

    def run(t: pa.Table) -> pa.Table:
        key, _ = _trained(t)
        up = np.unique(_cut(key, order, LOW + 1))
        parent, n = np.unique(((up >> np.uint64(16)) << np.uint64(8)) | (up & np.uint64(255)), return_counts=True)
        return pa.table({"gram": pa.array(parent.astype(np.int64)), "n": pa.array(n.astype(np.int64))})

    return run


def _cut(key: np.ndarray, order: int, k: int) -> np.ndarray:
    """The keys with contexts cut to the last ``k`` bytes."""
    return ((key >> np.uint64(8 * (order - k + 1))) << np.uint64(8)) | (key & np.uint64(255))


def _trained(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = [_unpack(k) for k in t["keys"].to_pylist()], [_counts(c) for c in t["counts"].to_pylist()]
    key, n = np.concatenate(keys), np.concatenate(counts)
    by = np.argsort(key[n > 0])
    return key[n > 0][by], n[n > 0][by]


def _price(low: dict[str, np.ndarray], order: int):
    """A part of the trie -> the cost of each of its keys, back by bucket."""

    def run(t: pa.Table) -> pa.Table:
        key, n = _trained(t)
        trie = Trie(key, n, order, LOW + 1)
        small = Trie(low["gram"], low["n"], LOW)
        trie.levels.update(small.levels)
        up, _ = trie.shorter(LOW + 1)
        at, _ = Trie._find(low["gram"], up)
        trie.below(LOW + 1, low["n"][at] if len(up) else np.zeros(0, np.int64))
        rows = [{"bucket": b, "keys": k, "costs": _zip(trie.costs(_unpack(k), order).tobytes())}
                for b, k in zip(t["bucket"].to_pylist(), t["keys"].to_pylist())]
        return pa.Table.from_pylist(rows, pa.schema([("bucket", pa.int64()), ("keys", pa.binary()), ("costs", pa.binary())]))

    return run


_ANSWERS = "kind int, block long, keys binary, found binary"
_ANSWER_SCHEMA = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("found", pa.binary())])


def _answer_grams(units: pa.Table, prices: pa.Table) -> pa.Table:
    """A bucket's units and prices -> the costs of each block's keys."""
    if not len(units):
        return _ANSWER_SCHEMA.empty_table()
    key = np.concatenate([_unpack(k) for k in prices["keys"].to_pylist()])
    cost = np.concatenate([_floats(c) for c in prices["costs"].to_pylist()])
    by = np.argsort(key)
    key, cost = key[by], cost[by]
    return pa.Table.from_pylist([{"kind": GRAM, "block": b, "keys": k,
                                  "found": _zip(cost[np.searchsorted(key, _unpack(k))].tobytes())}
                                 for b, k in zip(units["block"].to_pylist(), units["keys"].to_pylist())], _ANSWER_SCHEMA)


def _split(data: bytes) -> pa.Array:
    return pa.array(_unzip(data).split(b"\n"), pa.large_binary())


def _answer_words(t: pa.Table) -> pa.Table:
    """A bucket of word units -> the counts of each block's words over all
    training texts; the row without a block has the bucket's sum of counts
    and number of training words."""
    lists = [_split(k) for k in t["keys"].to_pylist()]
    all_ = pa.table({"w": pa.concat_arrays(lists), "n": pa.array(np.concatenate([_counts(c) for c in t["counts"].to_pylist()]))})
    whole = all_.group_by("w", use_threads=False).aggregate([("n", "sum")])
    names, n = _one(whole["w"]), whole["n_sum"].to_numpy()
    rows = [{"kind": WORD, "block": b, "keys": k, "found": _zip(n[pc.index_in(w, value_set=names).to_numpy()].tobytes())}
            for b, k, w in zip(t["block"].to_pylist(), t["keys"].to_pylist(), lists)]
    rows.append({"n": int(n.sum()), "v": int(np.count_nonzero(n))})
    return pa.Table.from_pylist(rows, _ANSWER_SCHEMA.append(pa.field("n", pa.int64())).append(pa.field("v", pa.int64())))


def _look_up(key: np.ndarray, cost: np.ndarray, wanted: np.ndarray, order: int) -> np.ndarray:
    """The cost of each wanted key; all are among the sorted ``key``. Up to
    order 5 the key leaves 16 bits for a place, and sorted keys are sought,
    which is several times faster than keys in text order."""
    out = np.empty(len(wanted))
    step = 1 << 16
    for i in range(0, len(wanted), step):
        part = wanted[i:i + step]
        if order <= 5:
            part = np.sort((part << np.uint64(16)) | np.arange(len(part), dtype=np.uint64))
            out[i + (part & np.uint64(step - 1)).astype(np.int64)] = cost[np.searchsorted(key, part >> np.uint64(16))]
        else:
            out[i:i + step] = cost[np.searchsorted(key, part)]
    return out


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
_SCORE_SCHEMA = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                           ("base_score", pa.float64()), ("score", pa.float64())])


def _score(total: int, distinct: int, ends: int, order: int):
    """A block's texts and answers -> its scores."""

    def base(c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        key, cost, names, n = [], [], [], []
        for kind, k, f in zip(answers["kind"].to_pylist(), answers["keys"].to_pylist(), answers["found"].to_pylist()):
            if kind == GRAM:
                key.append(_unpack(k))
                cost.append(_floats(f))
            else:
                names.append(_split(k))
                n.append(_counts(f))
        key, cost = np.concatenate(key or [np.zeros(0, np.uint64)]), np.concatenate(cost or [np.zeros(0)])
        by = np.argsort(key)
        key, cost = key[by], cost[by]
        words_ = []  # per slice: distinct words, the number of each word among them, the text of each word
        out = []
        for ids, held, stop, data in zip(*(texts[c].to_pylist() for c in ("ids", "held", "ends", "data"))):
            data, off = np.frombuffer(_unzip(data), np.uint8), np.r_[0, np.array(stop, np.int64)]
            grams, to, start, end, first = _sequence(data, off, order)
            price = -_look_up(key, cost, grams, order)
            size = np.diff(first)
            w = _word_array(data, start, end).dictionary_encode()
            words_.append((w.dictionary, w.indices.to_numpy(), np.repeat(np.arange(len(size)), size)))
            out.append((ids, held, size, np.add.reduceat(price, to[:-1])))
        if not out:
            return _SCORE_SCHEMA.empty_table()
        asked = pa.concat_arrays([w[0] for w in words_])
        count = np.zeros(0, np.int64)
        if len(asked):
            count = np.concatenate(n)[pc.index_in(asked, value_set=pa.concat_arrays(names)).to_numpy()]
        at, tables = 0, []
        for (ids, held, size, score), (distinct_, which, text) in zip(out, words_):
            c = count[at:at + len(distinct_)][which]
            at += len(distinct_)
            known = np.bincount(text, c > 0, len(size)).astype(np.int64) + (ends > 0)
            part = np.bincount(text, base(c), len(size)) + float(base(np.array(ends)))
            tables.append(pa.table([pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(size + 1), pa.array(known),
                                    pa.array(part), pa.array(score)], schema=_SCORE_SCHEMA))
        return pa.concat_tables(tables)

    return run


def score_texts(docs: DataFrame, held_out, order: int = ORDER, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score``.

    ``held_out`` is a boolean column expression of ``docs``; the other rows
    train the word counts and the trie (``order`` context bytes, at least 3
    and at most 7). ``score`` is the trie's log10 probability of the token
    sequence, ``base_score`` that of the smoothed word counts.

    Null or empty text: the end token alone. A null ``held_out`` counts as
    false. Rows with null or repeated ids are rows of their own; repeated
    texts count as often as they occur. Very long texts are blocks of their
    own. Empty table: no rows; no training text: all bytes are equally
    likely. Columns of other names are not read.
    """
    if not LOW < order <= 7:
        raise ValueError("order must be 3 to 7")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held"),
                       F.col(text).alias("text"))
    sums = rows.agg(F.sum(F.octet_length("text")).alias("b"), F.count_if(~F.col("held")).alias("ends")).first()
    buckets, ends = max(1, -(-(sums["b"] or 0) // BUCKET_BYTES)), sums["ends"]
    all_ = written(rows.mapInArrow(_read(buckets, order), _UNITS), "ppm-units")
    grams = all_.where(F.col("kind") == GRAM).select("block", "bucket", "keys", "counts")
    terms = all_.where(F.col("kind") == WORD).select("block", "bucket", "keys", "counts")

    parts = written(grams.groupBy("bucket").applyInArrow(_add_up(buckets, order), _PARTS), "ppm-trie")
    low = (parts.groupBy("part").applyInArrow(_low_counts(order), "gram long, n long")
           .groupBy("gram").agg(F.sum("n").alias("n")).toPandas().sort_values("gram"))  # at most 2 ** 24 rows
    low = {"gram": low["gram"].to_numpy().astype(np.uint64), "n": low["n"].to_numpy().astype(np.int64)}
    prices = parts.groupBy("part").applyInArrow(_price(low, order), "bucket long, keys binary, costs binary")
    gram_answers = grams.groupBy("bucket").cogroup(prices.groupBy("bucket")).applyInArrow(_answer_grams, _ANSWERS)

    word_answers = written(terms.groupBy("bucket").applyInArrow(_answer_words, _ANSWERS + ", n long, v long"), "ppm-words")
    own = word_answers.where("block is null").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    total, distinct = (own["n"] or 0) + ends, (own["v"] or 0) + (ends > 0)
    answers = gram_answers.unionByName(word_answers.where("block is not null").drop("n", "v"))
    texts = all_.where(F.col("kind") == TEXT).select("block", "ids", "held", "ends", "data")
    return (texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score(total, distinct, ends, order), _SCORES)
            .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
                    "base_score", "score"))
