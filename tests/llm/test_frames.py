"""Operator 11 against a plain version on whole strings."""

import hashlib
import random
import re

import pytest
import zstandard
from pyspark.sql import functions as F

from ballotlake.llm import frames

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_version(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(units), "plain", None, None, text
    if h4 % 100 < 80:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def texts():
    rnd = random.Random(4)
    chars = "ab é漢𝄞 \t\n\x0b\xa0 <P"
    out = ["".join(rnd.choices(chars, k=rnd.randint(0, 300))) for _ in range(150)]
    return out + [None, "", " ", "\n\n", "x", " x ", "a <P> b", "<S><M>", "a<", "<P", "漢" * 90_000,
                  " ".join("w%d" % i for i in range(40_000)) + "  ", "y" * 200_000 + " z", " " * 70_000 + "end"]


@pytest.fixture(scope="module", params=[frames.FRAME_BYTES, 7])
def result(request, spark):
    """Whole results; once with frames so short that every cut meets them."""
    rows = list(enumerate(texts()))
    if request.param == 7:
        rows = [r for r in rows if len(r[1] or "") < 1000]
    rows += [(None, "id is null here"), (3, texts()[3]), (3, texts()[3])]
    df = spark.createDataFrame([(i, t, "x", 5, True) for i, t in rows],
                               "doc_id long, text string, form string, n long, frames boolean")
    old, frames.FRAME_BYTES = frames.FRAME_BYTES, request.param
    try:
        out = frames.fill_in_middle(df).cache()
        kept = [r.asDict(recursive=True) for r in out.collect()]
        hashes = [r.asDict() for r in frames.digests(out).collect()]
    finally:
        frames.FRAME_BYTES = old
    return rows, kept, hashes


def test_same_as_on_strings(result):
    rows, kept, hashes = result
    expected = sorted((str(i), *plain_version(i, t)) for i, t in rows)
    got = sorted((str(r["doc_id"]), r["n"], r["form"], r["prefix_chars"], r["middle_chars"],
                  b"".join(frames.read_text(r["output"])).decode()) for r in kept)
    assert got == expected
    assert {r["form"] for r in kept} == {"plain", "spm", "psm"}
    assert sorted((str(i), sha(plain_version(i, t)[-1]), sha(t or "")) for i, t in rows) == \
        sorted((str(r["doc_id"]), r["output_sha256"], r["restored_sha256"]) for r in hashes)


def test_frames_are_independent(result):
    """Every frame can be read alone, and they stay small however long the text."""
    for r in result[1]:
        for f in r["output"]:
            assert len(zstandard.ZstdDecompressor().decompress(f["data"])) <= frames.FRAME_BYTES


def test_uncut_frames_are_moved_as_they_are(spark):
    df = spark.createDataFrame([(i, " ".join(f"{i}w{j}" for j in range(60_000))) for i in range(12)],
                               "doc_id long, text string")
    stored = {r["doc_id"]: {bytes(f["data"]) for f in r["frames"]} for r in frames.store(df).collect()}
    for r in frames.fill_in_middle(df, rate=100).collect():
        new = [f for f in r["output"] if bytes(f["data"]) not in stored[r["doc_id"]]]
        assert len(new) <= 3 + 4  # the marks and the halves of two cut frames


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert frames.digests(frames.fill_in_middle(df)).count() == 0


def test_marks_across_parts():
    assert frames._find_marks(iter([b"a<", b"S", b">b<P", b">", b"<M>c"]), [b"<S>", b"<P>", b"<M>"]) == [1, 5, 8]


def test_totals_of_the_store(spark):
    text = "one two\tthree \n" * 30_000
    row = frames.store(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["n"] == 90_001
    assert row["frames"][-1]["units"] == 90_001 and row["frames"][-1]["chars"] == len(text)
    assert [f["units"] for f in row["frames"]] == sorted(f["units"] for f in row["frames"])


def test_registered_query_restores_every_text(spark):
    from ballotlake.llm.queries import QUERIES
    out = QUERIES["op11_fill_in_middle"](spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bad = out.join(docs, "doc_id").where(F.col("restored_sha256") != F.sha2(F.coalesce("text", F.lit("")), 256))
    assert bad.count() == 0 and out.count() == docs.count()
