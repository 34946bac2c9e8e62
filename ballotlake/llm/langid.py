"""Operator 6: language identification with a blended-spectrum string kernel.

A text is the set of its byte n-grams, n = 1..4 (presence, not counts), the
blended spectrum, hashed to ``DIM`` features. The kernel of two texts is the
cosine of their presence vectors. Nyström landmarks turn it into a finite
feature map, one-versus-rest kernel ridge regression is solved on the
training sample, and whole texts are scored by batched matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .textgrams import mix, text_slices

DIM = 1 << 12
ORDERS = (1, 2, 3, 4)
UNKNOWN = "und"


def presence(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Presence vectors (texts x DIM, uint8) of all texts of a slice.

    A-Z is lower-cased and digits, ASCII punctuation and white space count
    as one blank, so markup and shouting weigh little."""
    out = np.zeros((len(off) - 1, DIM), np.uint8)
    table = np.arange(256, dtype=np.uint64)
    table[:128] = 32
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    x = table[data]
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    flat = out.reshape(-1)
    code = np.zeros(len(x), np.uint64)
    for n in ORDERS:
        m = len(x) - n + 1
        if m <= 0:
            break
        code = (code[:m] << np.uint64(8)) | x[n - 1:]
        ok = doc[:m] == doc[n - 1:]
        slot = (mix(code + np.uint64(n << 40)) % np.uint64(DIM)).astype(np.int64)
        flat[doc[:m][ok] * DIM + slot[ok]] = 1
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float32)
    return x / np.maximum(np.sqrt(x.sum(1, keepdims=True)), 1)


def fit(features: np.ndarray, langs: list[str], landmarks: int = 256, ridge: float = 1e-2
        ) -> tuple[list[str], np.ndarray]:
    """(languages, DIM x languages matrix) of one-versus-rest kernel ridge
    regression on Nyström features of the presence kernel.

    With landmark vectors L (rows of the sample, spread over it) the feature
    map is K(x, L) K(L, L)^(-1/2). The kernel is linear in the unit presence
    vector, so map and regression weights fold into one matrix.
    """
    x = _unit(features).astype(np.float64)
    names = sorted(set(langs))
    y = np.array([[1.0 if g == k else -1.0 for k in names] for g in langs])
    pick = np.unique(np.linspace(0, len(x) - 1, min(landmarks, len(x))).astype(int))
    land = x[pick]
    w, v = np.linalg.eigh(land @ land.T)
    keep = w > 1e-8 * max(w.max(), 1e-12)
    root = v[:, keep] / np.sqrt(w[keep])
    phi = (x @ land.T) @ root
    weight = np.array([1.0 / langs.count(g) for g in langs])
    weight = weight / weight.mean()
    gram = phi.T @ (phi * weight[:, None]) + ridge * len(x) / max(1, phi.shape[1]) * np.eye(phi.shape[1])
    beta = np.linalg.solve(gram, phi.T @ (y * weight[:, None]))
    return names, (land.T @ root @ beta).astype(np.float32)


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lang = b.column("lang")
        for at, end, data, off in text_slices(b, "text", 1 << 20):
            for i in range(0, end - at, 64):
                j = min(i + 64, end - at)
                p = np.packbits(presence(data[off[i]:off[j]], off[i:j + 1] - off[i]), axis=1)
                yield pa.RecordBatch.from_arrays([lang.slice(at + i, j - i), pa.array([r.tobytes() for r in p],
                                                                                     pa.binary())], ["lang", "bits"])


def train(docs: DataFrame, per_language: int = 250, languages: int = 400, landmarks: int = 256,
          seed: int = 5) -> tuple[list[str], np.ndarray]:
    """Fit on ``(doc_id, text, lang)``; rows without lang or text are not used.

    The fit uses a bounded sample: the ``per_language`` documents of each of
    at most ``languages`` languages (the most frequent) with the smallest
    hash of their id. Whole texts are read; what reaches the driver is DIM
    bits a document.
    """
    rows = docs.where("lang is not null and text is not null")
    known = (rows.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "lang")
             .limit(languages).select("lang"))
    w = Window.partitionBy("lang").orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id")
    chosen = (rows.select("doc_id", "lang").withColumn("_r", F.row_number().over(w))
              .where(F.col("_r") <= per_language).join(known, "lang", "left_semi").select("doc_id").distinct())
    ids = [r[0] for r in chosen.collect()]  # at most per_language * languages
    if not ids:
        return [], np.zeros((DIM, 0), np.float32)
    sample = rows.where(F.col("doc_id").isin(ids)) if len(ids) <= 5000 else rows.join(F.broadcast(chosen), "doc_id")
    got = sample.select("text", "lang").mapInArrow(_bits, "lang string, bits binary").toArrow().sort_by(
        [("lang", "ascending"), ("bits", "ascending")]).to_pydict()
    x = np.unpackbits(np.array([np.frombuffer(b, np.uint8) for b in got["bits"]]), axis=1)
    order = np.random.default_rng(seed).permutation(len(x))
    return fit(x[order], [got["lang"][i] for i in order], landmarks)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns, ``lang_pred`` and ``score`` (0 to 1) of every row.

    ``lang_pred`` is the class of the largest regression value, ties to the
    first name; ``score`` maps that value from [-1, 1] to [0, 1]. Null
    text, text without a letter, or a model without classes: ``und`` with
    score 0. Whole texts, one pass, no shuffle; the model is DIM x languages
    numbers. Extra columns are ignored.
    """
    names, matrix = model

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array([*names, UNKNOWN], dtype=object)
        for b in batches:
            letter = np.asarray(b.column("_letter").to_pylist(), bool)
            for at, end, data, off in text_slices(b, "text", 1 << 20):
                best = np.full(end - at, len(names))
                value = np.zeros(end - at)
                for i in range(0, end - at if names else 0, 64):
                    j = min(i + 64, end - at)
                    s = _unit(presence(data[off[i]:off[j]], off[i:j + 1] - off[i])) @ matrix
                    best[i:j], value[i:j] = s.argmax(1), np.clip((1 + s.max(1)) / 2, 0, 1)
                no = ~letter[at:end]
                best[no], value[no] = len(names), 0
                yield pa.RecordBatch.from_arrays(
                    [b.column(c).slice(at, end - at) for c in carry]
                    + [pa.array(table[best].tolist(), pa.string()), pa.array(value, pa.float64())],
                    [*carry, "lang_pred", "score"])

    rows = docs.select(*carry, F.col("text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letter"))
    types = dict(rows.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in carry) + ", lang_pred string, score double"
    return rows.mapInArrow(score, schema)
