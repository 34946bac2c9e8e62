"""Operator 13 against a dictionary version."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ballotlake.llm import ppm

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, held boolean, score double, kind int, block long"


def sequence(text):
    w = WORD.findall((text or "").encode().translate(bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))))
    return w, b"".join(x + b" " for x in w) + b"\n"


class Plain:
    """Counts in dictionaries, one context after the other."""

    def __init__(self, texts, order):
        self.order = order
        self.level = [collections.defaultdict(collections.Counter) for _ in range(order + 1)]
        for t in texts:
            s = b"\n" * order + sequence(t)[1]
            for i in range(order, len(s)):
                self.level[order][s[i - order:i]][s[i]] += 1
        for k in range(order, 0, -1):
            for c, nxt in self.level[k].items():
                for b in nxt:
                    self.level[k - 1][c[1:]][b] += 1

    def log10(self, context, byte):
        p, gone = 0.0, set()
        for k in range(self.order, -1, -1):
            nxt = self.level[k].get(context[len(context) - k:])
            if nxt is None:
                continue
            left = {b: n for b, n in nxt.items() if b not in gone}
            total = sum(left.values())
            if byte in left:
                return p + math.log10((2 * left[byte] - 1) / (2 * total))
            if total:
                p += math.log10(len(left) / (2 * total))
            gone = set(nxt)
        return p - math.log10(ppm.SYMBOLS - len(gone))

    def text(self, t):
        s = b"\n" * self.order + sequence(t)[1]
        return sum(self.log10(s[i - self.order:i], s[i]) for i in range(self.order, len(s)))


def texts():
    rnd = random.Random(13)
    vocab = ["".join(rnd.choices("abcdeé漢", k=rnd.randint(1, 7))) for _ in range(80)]
    out = [" ".join(rnd.choices(vocab, k=rnd.randint(1, 40))) for _ in range(60)]
    return out + out[:5] + [None, "", " \n\t", "One TWO one", "neverseen", "x" * 3000, "q  q\nq"]


@pytest.mark.parametrize("order,block,bucket", [(5, None, None), (3, 300, 200), (7, 1, 5000)])
def test_like_dictionaries(spark, monkeypatch, order, block, bucket):
    if block:
        monkeypatch.setattr(ppm, "BUCKET_BYTES", bucket)
        monkeypatch.setattr(ppm, "BLOCK_BYTES", block)
        monkeypatch.setattr(ppm, "SLICE", block)
    rows = [(i, t, i % 5 == 1, 0.0, 1, 2) for i, t in enumerate(texts())] + [(None, "id is null", None, 0.0, 1, 2)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r["doc_id"]: r for r in ppm.score_texts(df, F.col("held"), order=order).collect()}
    assert len(got) == len(rows)
    train = [t for _, t, h, *_ in rows if not h]
    model = Plain(train, order)
    count = collections.Counter(w for t in train for w in sequence(t)[0])
    count["end"] = len(train)
    n, v = sum(count.values()), len(count)
    for i, t, h, *_ in rows:
        r, tokens = got[i], [*sequence(t)[0], "end"]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            bool(h), len(tokens), sum(count[w] > 0 for w in tokens), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens))
        assert r["score"] == pytest.approx(model.text(t), rel=1e-9)


def test_probabilities_add_up():
    """After any context, known or not, the bytes' probabilities add up to 1."""
    train = [t for t in texts() if t]
    data = [t.lower().encode() for t in train]
    raw, off = np.frombuffer(b"".join(data), np.uint8), np.r_[0, np.cumsum([len(d) for d in data])]
    key, n = ppm._distinct(ppm._sequence(raw, off, 5)[0])
    trie = ppm.Trie(key, n, 5)
    legal = [b for b in range(256) if b in (0x20, 0x0A) or not (b in range(9, 14) or 65 <= b <= 90 or b in (0xC0, 0xC1) or b > 0xF4)]
    assert len(legal) == ppm.SYMBOLS
    contexts = [int(k) >> 8 for k in key[::37]] + [0x61FFFFFFFF, 0xFEFEFEFEFE, 0x0A0A0A0A0A]
    for c in contexts:
        keys = np.array([(c << 8) | b for b in legal], np.uint64)
        assert (10 ** -trie.costs(keys, 5)).sum() == pytest.approx(1, abs=1e-9)


def test_hot_repeats(spark):
    """A third of the rows are one text: one key each in a bucket, whatever their number."""
    rows = [(i, "the same text again" if i % 3 == 0 else f"text number {i}", False, 0.0, 1, 2) for i in range(900)]
    out = ppm.score_texts(spark.createDataFrame(rows, SCHEMA).repartition(4), F.col("held"))
    assert out.count() == 900 and out.where("n_known <> n_tokens").count() == 0
    assert out.where("doc_id % 3 = 0").select("score").distinct().count() == 1


def test_empty_and_untrained(spark):
    assert ppm.score_texts(spark.createDataFrame([], SCHEMA), F.col("held")).count() == 0
    r = ppm.score_texts(spark.createDataFrame([(1, "ab", True, 0.0, 1, 2)], SCHEMA), F.col("held")).first()
    assert r["train_tokens"] == 0 and r["n_known"] == 0
    assert r["score"] == pytest.approx(-4 * math.log10(ppm.SYMBOLS))


def test_better_than_word_counts(spark):
    """Held-out texts of the test tables cost fewer bits than under word counts."""
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    r = ppm.score_texts(docs, held).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]
