"""Operator 11: fill-in-middle over texts kept as seekable zstandard frames.

A text is stored as an ordered list of independent zstandard frames, each
with the running totals of units and of code points up to its end. A unit is
a word with the white space before it, or the white space at the end of the
text. A position in units is found by its frame's totals and by reading that
one frame; the frames that are not cut move to the output as they are. Texts
of any length are written, cut, digested and rebuilt one frame at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written
from .textgrams import text_slices, words

#: Raw bytes of a frame; a frame may end inside a unit, never inside a code point.
FRAME_BYTES = 64 << 10
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Output batches are closed beyond this many compressed bytes.
BATCH_BYTES = 4 << 20

FRAMES = "array<struct<units:bigint,chars:bigint,data:binary>>"
_FRAMES = pa.list_(pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("data", pa.binary())]))


def _chars(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def _cuts(data: np.ndarray) -> list[int]:
    """Ends of the frames of one text."""
    ends, at = [], 0
    while len(data) - at > FRAME_BYTES:
        at += FRAME_BYTES
        while data[at] & 0xC0 == 0x80:
            at -= 1
        ends.append(at)
    return [*ends, len(data)] if len(data) else []


def _unit_ends(data: np.ndarray, whole: bool) -> np.ndarray:
    """Ends of the units that end inside ``data``; ``whole`` if a unit also
    ends with its last byte."""
    _, end, _ = words(data, np.array([0, len(data)]))
    if len(end) and end[-1] == len(data):
        end = end[:-1]
    return np.append(end, len(data)) if whole else end


def _store(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows (values in the order of ``schema``, frames last) as batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(f["data"]) for f in row[-1]) + 200
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def store(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The seekable store: a row ``doc_id, n, marked, frames`` per row of
    ``docs``. ``n`` is the number of units, ``marked`` tells whether the text
    holds a mark of the output format.

    Null and empty texts have no frames and no units; repeated rows stay; a
    very long text has more frames, none of them larger. Other columns are
    not read, whatever their names.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("marked", pa.bool_()), ("frames", _FRAMES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress

        def rows():
            for b in batches:
                ids = b.column("doc_id").to_pylist()
                for first, _, data, off in text_slices(b, "text"):
                    _, ends, to = words(data, off)
                    for i in range(len(off) - 1):
                        one, end = data[off[i]:off[i + 1]], ends[to[i]:to[i + 1]] - off[i]
                        if len(one) and (not len(end) or end[-1] < len(one)):
                            end = np.append(end, len(one))
                        raw, at, frames, chars = one.tobytes(), 0, [], 0
                        for cut in _cuts(one):
                            chars += _chars(one[at:cut])
                            frames.append({"units": int(np.searchsorted(end, cut, "right")), "chars": chars,
                                           "data": pack(raw[at:cut])})
                            at = cut
                        yield ids[first + i], len(end), any(m in raw for m in (PREFIX, SUFFIX, MIDDLE)), frames

        yield from _store(rows(), schema)

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(run, f"doc_id long, n long, marked boolean, frames {FRAMES}"))


def plan_cuts(stored: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """``stored`` with ``form`` (plain, psm or spm) and the cuts ``first`` and
    ``second`` in units, all from one hash of seed and id. A null id hashes
    like an empty one. Texts that hold a mark stay plain."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)

    def part(i: int) -> Column:
        return F.conv(F.substring("_h", 8 * i + 1, 8), 16, 10).cast("long")

    cut = [F.pmod(part(i), F.col("n") + 1) for i in (0, 1)]
    plain = (F.col("n") == 0) | F.col("marked") | (F.pmod(part(2), F.lit(100)) >= rate)
    return (stored.withColumn("_h", h)
            .withColumns({"form": F.when(plain, "plain").when(F.pmod(part(3), F.lit(100)) < spm, "spm").otherwise("psm"),
                          "first": F.least(*cut), "second": F.greatest(*cut)}).drop("_h"))


class _Cutter:
    """Splits a text's frames after a number of units; only the frame that
    holds the cut is decompressed, and its halves are new frames."""

    def __init__(self):
        self.read = zstandard.ZstdDecompressor().decompress
        self.pack = zstandard.ZstdCompressor(level=3).compress

    def split(self, frames: list[dict], units: int) -> tuple[list[dict], list[dict], int]:
        """(frames before, frames after, code points before); totals in the
        returned frames are still those of the whole text."""
        if units <= 0:
            return [], frames, 0
        i = next(j for j, f in enumerate(frames) if f["units"] >= units)
        f = frames[i]
        before = frames[i - 1]["units"] if i else 0
        base = frames[i - 1]["chars"] if i else 0
        raw = self.read(f["data"])
        data = np.frombuffer(raw, np.uint8)
        ends = _unit_ends(data, False)
        # A unit also ends with the frame if the frame counts one more than can be seen inside.
        ends = _unit_ends(data, True) if len(ends) < f["units"] - before else ends
        at = int(ends[units - before - 1])
        chars = base + _chars(data[:at])
        if at == len(raw):
            return frames[:i + 1], frames[i + 1:], chars
        head = {"units": units, "chars": chars, "data": self.pack(raw[:at])}
        tail = {"units": f["units"], "chars": f["chars"], "data": self.pack(raw[at:])}
        return [*frames[:i], head], [tail, *frames[i + 1:]], chars


def transform(planned: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``; ``output`` is
    the transformed text, again as frames (with the totals of their place in
    the input; marks are frames of their own). Decompressing the frames one
    after the other gives the output text. ``prefix_chars`` and
    ``middle_chars`` are null for plain rows."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                        ("middle_chars", pa.int64()), ("output", _FRAMES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _Cutter()
        mark = {m: {"units": None, "chars": None, "data": cutter.pack(m)} for m in (PREFIX, SUFFIX, MIDDLE)}

        def rows():
            for b in batches:
                for i in range(b.num_rows):
                    doc, n, form, first, second, frames = (b.column(c)[i].as_py() for c in (
                        "doc_id", "n", "form", "first", "second", "frames"))
                    if form == "plain":
                        yield doc, n, form, None, None, frames
                        continue
                    # The later cut first: the earlier one may fall into the frame that it leaves behind.
                    rest, suffix, until = cutter.split(frames, second)
                    prefix, middle, chars = cutter.split(rest, first)
                    prefix, suffix = [mark[PREFIX], *prefix], [mark[SUFFIX], *suffix]
                    out = [*suffix, *prefix] if form == "spm" else [*prefix, *suffix]
                    yield doc, n, form, chars, until - chars, [*out, mark[MIDDLE], *middle]

        yield from _store(rows(), schema)

    return (planned.select("doc_id", "n", "form", "first", "second", "frames")
            .mapInArrow(run, f"doc_id long, n long, form string, prefix_chars long, middle_chars long, output {FRAMES}"))


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80, doc_id: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """Fill-in-middle forms of all texts, see :func:`transform`.

    The store is written to the shared folder first. Null or empty text:
    plain, no frames. Null id: as an empty id. Repeated rows: each its own
    row, all alike. Empty table: no rows.
    """
    return transform(plan_cuts(written(store(docs, doc_id, text), "fim-store"), seed, rate, spm))


def _find_marks(parts: Iterator[bytes], marks: list[bytes]) -> list[int]:
    """Byte offsets of the marks, each sought after the one before, in a
    text that arrives in parts; a mark may lie across parts."""
    found, tail, at = [], b"", 0
    for part in parts:
        window, base, start = tail + part, at - len(tail), 0
        while len(found) < len(marks):
            i = window.find(marks[len(found)], start)
            if i < 0:
                break
            found.append(base + i)
            start = i + 3
        at += len(part)
        # Two bytes may begin a mark, but not bytes of a mark already found.
        tail = window[max(start, len(window) - 2):]
    return found


def _ranges(parts: Iterator[bytes], start: int, end: int) -> Iterator[bytes]:
    """The bytes [start, end) of a text that arrives in parts."""
    at = 0
    for part in parts:
        if at < end and at + len(part) > start:
            yield part[max(start - at, 0):end - at]
        at += len(part)


def read_text(frames: list[dict]) -> Iterator[bytes]:
    """The text of frames, one frame after the other."""
    read = zstandard.ZstdDecompressor().decompress
    return (read(f["data"]) for f in frames)


def restored(frames: list[dict], form: str) -> Iterator[bytes]:
    """The original text in parts, rebuilt from the output text and its form
    only: the marks are found in the text, not taken from the frames."""
    if form == "plain":
        yield from read_text(frames)
        return
    order = [SUFFIX, PREFIX, MIDDLE] if form == "spm" else [PREFIX, SUFFIX, MIDDLE]
    at = _find_marks(read_text(frames), order)
    piece = dict(zip(order, zip([a + 3 for a in at], [*at[1:], 1 << 62])))
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from _ranges(read_text(frames), *piece[mark])


def digests(transformed: DataFrame) -> DataFrame:
    """The columns of ``transformed`` but ``output``, with the SHA-256 (lower-case
    hex) of the output text and of the text restored from it."""
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]

    def sha(parts: Iterator[bytes]) -> str:
        h = hashlib.sha256()
        for p in parts:
            h.update(p)
        return h.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, back = [], []
            for i in range(b.num_rows):
                frames, form = b.column("output")[i].as_py(), b.column("form")[i].as_py()
                out.append(sha(read_text(frames)))
                back.append(sha(restored(frames, form)))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(out, pa.string()),
                                              pa.array(back, pa.string())], [*names, "output_sha256", "restored_sha256"])

    return transformed.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
                                       "output_sha256 string, restored_sha256 string")
