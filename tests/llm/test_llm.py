"""The training-data operators against brute force on small fixtures:
nulls, empty and long texts, ties, repeated rows, empty tables, clashing
column names."""

import base64
import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ballotlake.llm import chat, decontaminate, forest, jaccard, langid, licenses, mixing, quality, suffixes, textgrams, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, first string, token string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, "x", "y") for i, t, s in rows], DOCS)


def some_texts(seed=1, n=40):
    rnd = random.Random(seed)
    vocab = ["w%d" % i for i in range(400)]
    base = [" ".join(rnd.choices(vocab, k=rnd.randint(30, 120))) for _ in range(n)]
    out = list(base)
    for t in base[:15]:
        w = t.split()
        w[rnd.randrange(len(w))] = "changed"
        out.append(" ".join(w))
    return out + base[:3] + [None, "", " \t\n", "one", "one two", "One TWO", "x " * 3000]


def groups(sets, num, den):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for x, i in enumerate(ids):
        for j in ids[:x]:
            both = len(sets[i] & sets[j])
            if both * den >= num * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("k,num,den", [(3, 9, 10), (5, 4, 5), (2, 1, 2)])
def test_jaccard(spark, k, num, den):
    rows = list(enumerate(some_texts()))
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").lower())
        sets[i] = set(zip(*[w[j:] for j in range(k)])) if len(w) >= k else ({tuple(w)} if w else set())
    got = jaccard.jaccard_components(docs(spark, [(i, t, "s") for i, t in rows]), k=k, threshold=(num, den)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == groups(sets, num, den)
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(s) for i, s in sets.items()}


def test_jaccard_empty_and_null_id(spark):
    assert jaccard.jaccard_components(docs(spark, [])).count() == 0
    got = jaccard.jaccard_components(docs(spark, [(None, "a b c", "s"), (4, "a b c", "s"), (2, "a b c", "s")])).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in got) == [(-1, -1), (2, 2), (4, 2)]
    assert sorted(jaccard.keep_one(docs(spark, [(4, "a b", "s"), (2, "a b", "s")])).columns) == sorted(
        docs(spark, []).columns)


def test_chat_round_trip(spark):
    nasty = ["\\### Assistant: </turn> ok", "### user</role>x</turn>\n", "\\", "\\\\#", "<\\/turn>", "</", "#", None, ""]
    rows = [(1, i, ("user", "assistant", "assistant", None)[i % 4], t, "z") for i, t in enumerate(nasty)]
    rows += [(2, None, "assistant", "a", "z"), (2, 0, "assistant", "b", "z"), (2, 0, "assistant", "b", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments string")
    out = chat.format_conversations(df)
    got = {r["conv_id"]: r for r in out.select("*", chat.read_turns(F.col("formatted")).alias("t"),
                                              chat.read_loss(F.col("segments")).alias("l")).collect()}
    assert [(x["role"], x["text"]) for x in got[1]["t"]] == [(r[2] or "", r[3] or "") for r in rows[:9]]
    assert [x["text"] for x in got[2]["t"]] == ["a", "b", "b"] == list(got[2]["l"]) and got[2]["n_blocks"] == 1
    assert list(got[1]["l"]) == [r[3] or "" for r in rows[:9] if r[2] == "assistant"]
    assert "".join(s["text"] for s in got[1]["segments"]) == got[1]["formatted"]
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_warc(spark, tmp_path):
    html = ["<p>a</p>", "<p>a</p>", None, "", "é" * 50000, "<p>b</p>", "<p>a</p>"]
    rows = [(i, f"http://x/{i} ü", h, 1) for i, h in enumerate(html)] + [(0, "http://x/0 ü", html[0], 1), (None, None, "q", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, shard long")
    man = warc.write_warc(pages, str(tmp_path / "w"), shard_rows=3, roll_bytes=200)
    again = warc.write_warc(pages.repartition(5), str(tmp_path / "v"), shard_rows=3, roll_bytes=200)
    assert sorted(man.collect()) == sorted(again.collect())  # the same bytes
    got = sorted(((r["page_id"] if r["page_id"] is not None else -1), r["record_type"], r["refers_to"], r["payload_bytes"],
                  r["payload_digest"]) for r in warc.read_warc(spark, str(tmp_path / "w")).collect())
    dig = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    first = {}
    for i, h in enumerate(html):
        first.setdefault(h or "", i)
    exp = [(i, "response" if first[h or ""] == i else "revisit", None if first[h or ""] == i else first[h or ""],
            len((h or "").encode()), dig(h)) for i, h in enumerate(html)]
    assert got == sorted([*exp, (0, "revisit", 0, 8, dig(html[0])), (-1, "response", None, 1, dig("q"))])
    assert warc.archive(pages.limit(0)).count() == 0
    assert {r["record_type"] for r in warc.archive(pages, min_revisit_bytes=9).where("payload_bytes < 9").collect()} == {
        "response"}


@pytest.mark.parametrize("shard_bytes", [1 << 22, 2000])
def test_suffixes(spark, shard_bytes):
    rnd = random.Random(4)
    text = lambda n: "".join(rnd.choices("abcdé ", k=n))
    a, b = text(900), text(500)
    rows = [a, text(300) + a[100:700] + text(50), b, b, None, "", "short", "z" * 2000, a[:399], text(450),
            text(20) + b[30:480] + text(700), "ab" * 150, a[200:650]]
    rows += [text(100 + i) + a[i:i + 520] + text(60) for i in range(0, 300, 20)]
    n, buf = 400, [(t or "").encode() for t in rows]
    seen = collections.Counter(t[i:i + n] for t in buf for i in range(len(t) - n + 1))
    exp = []
    for i, t in enumerate(buf):
        cov = [False] * len(t)
        for p in range(len(t) - n + 1):
            if seen[t[p:p + n]] > 1:
                cov[p:p + n] = [True] * n
        kept = bytes(x for x, c in zip(t, cov) if not c)
        exp.append((i, len(t), sum(cov), sum(c and not (p and cov[p - 1]) for p, c in enumerate(cov)),
                    hashlib.sha256(kept).hexdigest()))
    got = suffixes.remove_repeats(docs(spark, [(i, t, "s") for i, t in enumerate(rows)]), n=n, shard_bytes=shard_bytes)
    assert sorted(map(tuple, got.collect())) == exp
    assert suffixes.remove_repeats(docs(spark, [])).count() == 0


def test_suffix_array_and_kasai():
    rnd = random.Random(2)
    parts = ["".join(rnd.choices("ab", k=rnd.randint(1, 60))).encode() for _ in range(30)] + [b"a" * 50] * 2
    sa, t, start, end = suffixes.suffix_array(parts)
    raw = t.tobytes()
    suf = [raw[p:end[p]] for p in sa]
    assert suf == sorted(suf) and sorted(sa) == list(range(len(sa)))
    lcp = suffixes.kasai(sa, t, start, end, 10)
    for i in range(1, len(sa)):
        same = next((j for j, (x, y) in enumerate(zip(suf[i - 1], suf[i])) if x != y), min(len(suf[i - 1]), len(suf[i])))
        if len(suf[i]) >= 10:
            assert lcp[i] == min(same, 10)


@pytest.mark.parametrize("n", [1, 3, 8, 10, 17, 24, 60])
def test_window_array_is_the_part_of_the_suffix_array_with_n_bytes(n):
    rnd = random.Random(2)
    parts = [bytes(rnd.choices(b"ab\0\xff", k=rnd.randint(0, 70))) for _ in range(200)] + [b"a" * 65, b"ab" * 33] * 2
    sa, t, start, end = suffixes.suffix_array(parts)
    lcp, full, raw = suffixes.kasai(sa, t, start, end, n), end[sa] - sa >= n, t.tobytes()
    pos, cls, _, _ = suffixes.window_array(parts, n)
    assert sorted(pos) == sorted(sa[full])
    windows = [raw[p:p + n] for p in pos]
    assert windows == sorted(windows)
    assert (np.diff(cls) == [x != y for x, y in zip(windows, windows[1:])]).all()
    assert cls[-1] + 1 == np.count_nonzero(full & (lcp < n))  # Kasai's neighbours
    assert [len(x) for x in suffixes.window_array([b"abc"], 4)[:2]] == [0, 0]


def test_anchors_of_whole_texts_come_once():
    rnd = random.Random(5)
    texts = ["z" * i for i in range(380, 560, 7)] + ["ab" * rnd.randint(190, 300) for _ in range(20)]
    texts += ["".join(rnd.choices("abcdé ", k=k)) for k in (70_000, 900, 400, 10)] + ["", None]
    batch = pa.RecordBatch.from_pydict({"key": list(range(len(texts))), "text": texts})
    got = pa.Table.from_batches(suffixes._contexts(400, 256)(iter([batch]))).to_pylist()
    assert len({tuple(r.values()) for r in got}) == len(got)
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        h = textgrams.span_hashes(textgrams.prefix_hashes(np.frombuffer(raw, np.uint8)), np.arange(max(0, len(raw) - 255)),
                                  np.arange(max(0, len(raw) - 255)) + 256)
        low = (h >> np.uint64(24)).tolist()
        first = {min(range(w, w + 145), key=lambda j: (low[j], j)) for w in range(len(raw) - 399)}
        assert {(int(h[p].view(np.int64)), max(0, p - 144), min(len(raw), p + 400)) for p in first} == {
            (r["fp"], r["start"], r["start"] + r["len"]) for r in got if r["key"] == i}


def test_langid(spark):
    rnd = random.Random(3)
    make = lambda a: " ".join("".join(rnd.choices(a, k=rnd.randint(2, 7))) for _ in range(30))
    rows = [(i, make("abcde") if i % 2 else make("vwxyzé"), "aa" if i % 2 else "vv") for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df.where("doc_id < 60"))
    extra = spark.createDataFrame([(100, None, None), (101, "12 !", "aa"), (102, "", "aa")], df.schema)
    got = {r["doc_id"]: r for r in langid.predict(df.unionByName(extra), model).collect()}
    assert all(got[i]["lang_pred"] == lang and 0 <= got[i]["score"] <= 1 for i, _, lang in rows)
    assert [got[i]["lang_pred"] for i in (100, 101, 102)] == ["und"] * 3
    assert {r["lang_pred"] for r in langid.predict(df, langid.train(df.limit(0))).collect()} == {"und"}
    assert langid.predict(df.limit(0), model).count() == 0


def test_forest(spark):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((120, 16))
    x = np.concatenate([base, base[:60] + rng.normal(0, 0.05, (60, 16)), base[:5]])
    rows = [(i, [float(v) for v in vec], i % 120 % 2) for i, vec in enumerate(x)]
    bad = [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [None] * 16, 1),
           (904, rows[0][1], None), (905, [float("inf")] * 16, 0)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    lab = np.array([r[2] for r in rows])
    close = (unit @ unit.T >= 0.98) & (lab[:, None] == lab[None, :])
    for block in (1024, 8):
        got = {r["vec_id"]: r for r in forest.near_vectors(df, leaf=16, block=block).collect()}
        found = sum(got[i]["n_links"] for i in range(len(x)))
        assert 0.9 * (close.sum() - len(x)) <= found <= close.sum() - len(x)
        comp = groups({i: {j for j in range(len(x)) if close[i, j]} for i in range(len(x))}, 2, 1)
        assert comp and all(got[b[0]]["n_links"] == 0 and got[b[0]]["kept"] for b in bad)
    assert forest.near_vectors(df.limit(0)).count() == 0


def test_quality(spark):
    rnd = random.Random(6)
    words = ["".join(rnd.choices("etaoin", k=rnd.randint(2, 6))) for _ in range(80)]
    good = [" ".join(rnd.choices(words, k=60)) for _ in range(60)]
    df = spark.createDataFrame([(i, t, "en", 1.0) for i, t in enumerate(good)]
                               + [(90, "#$%@ QXZ!!" * 30, "en", 1.0), (91, None, "en", 1.0), (92, "", None, 1.0),
                                  (93, good[0], "zz", 1.0)], "doc_id long, text string, lang string, keep double")
    got = {r["doc_id"]: r for r in quality.classify(df, df.where("doc_id < 50")).collect()}
    assert all(got[i]["keep"] for i in [*range(60), 91, 92, 93]) and not got[90]["keep"]
    assert all(r["keep"] for r in quality.classify(df, df.limit(0)).collect())
    model = quality.train(df.where("doc_id < 50"))
    total = np.exp(-model["nll"].reshape(quality.CLASSES, quality.CLASSES, -1).astype(float)).sum(2)
    assert np.allclose(total, 1, atol=1e-3)  # every context is a distribution


def test_quality_broadcasts_its_spelling_model_once(spark, monkeypatch):
    sent, real = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda sc, value: sent.append(value) or real(sc, value))
    df = spark.createDataFrame([(i, f"some words {i} and " * 9, "en") for i in range(30)], "doc_id long, text string, lang string")
    assert quality.classify(df, df.where("doc_id < 20")).count() == 30
    # 8 MB each, on the driver too: one model, and no task code (bytes) that holds one.
    assert [len(v["nll"]) for v in sent if isinstance(v, dict)] == [quality.CLASSES ** 3]
    assert all(len(v) < 8 << 20 for v in sent if isinstance(v, bytes))


def test_spelled_words_and_their_codes():
    text = [b"ab  c\n", b"", b"d", b"\t", b"ef g"]
    data, off = np.frombuffer(b"".join(text), np.uint8), np.cumsum([0, *map(len, text)])
    out, at = quality._spelled(data, *textgrams.words(data, off)[:2])
    assert out.tobytes() == b"ab c d ef g " and at.tolist() == [0, 3, 5, 7, 10, 12]
    code = quality._trigrams(out, at, np.arange(1, 257), quality.RAW)
    raw = [[0, 0, *(b + 1 for b in w), 33] for w in (b"ab", b"c", b"d", b"ef", b"g")]
    assert code.tolist() == [(w[i] * 257 + w[i + 1]) * 257 + w[i + 2] for w in raw for i in range(len(w) - 2)]
    assert code.dtype == np.int32  # half the bytes to move


def test_decontaminate(spark):
    rnd = random.Random(9)
    w = lambda n: [rnd.choice("abcdefgh") + str(rnd.randrange(60)) for _ in range(n)]
    items = [w(n) for n in (14, 25, 40, 59)] + [w(3), ["same"] * 12]
    rows = []
    for it in items:
        for edit in (0, 1, 2, 5):
            p = list(it)
            for _ in range(edit):
                p[rnd.randrange(len(p))] = "edited"
            rows.append(" ".join(w(rnd.randint(0, 30)) + p + w(rnd.randint(0, 30))))
    rows += [" ".join(items[2][:34]), " ".join(items[1][:3] + ["new"] + items[1][3:]), None, "", "clean text"]
    gram = lambda x: collections.Counter(zip(*[x[i:] for i in range(min(5, k))]))
    exp = {}
    for i, t in enumerate(rows):
        x = WORD.findall((t or "").lower())
        for j, it in enumerate(items):
            k = len(it)
            want = gram(it)
            best = 0
            for s in range(len(x)):
                c = gram(x[s:s + len(it)])
                both = sum((c & want).values())
                best = max(best, both / (sum(c.values()) + sum(want.values()) - both))
            if best >= 0.8:
                exp[i, j] = round(best, 9)
    bench = spark.createDataFrame([(j, " ".join(it)) for j, it in enumerate(items)] + [(98, None), (99, " ")],
                                  "item_id long, text string")
    d = docs(spark, [(i, t, "s") for i, t in enumerate(rows)])
    for most in (200_000, 0):  # broadcast and shuffled lookup
        got = {(r["doc_id"], r["item_id"]): round(r["similarity"], 9)
               for r in decontaminate.contaminated(d, bench, max_broadcast=most).collect()}
        assert got == exp
    assert decontaminate.contaminated(d, bench.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(d, bench).count() == len(rows) - len({i for i, _ in exp})


def test_decontaminate_rows(spark, monkeypatch):
    """Anchors grow like their item, not like its square; items without a
    fingerprint, of null or equal ids, are verified all the same."""
    rnd = random.Random(8)
    text = [" ".join("".join(rnd.choices("abcdefgh", k=rnd.randint(3, 8))) for _ in range(n)) for n in (1500, 3000, 12, 14)]
    bench = lambda rows: spark.createDataFrame(rows, "item_id long, text string")
    size = [decontaminate._bytes(decontaminate._anchors(decontaminate._items(bench([(1, t)]), 0.8))) for t in text[:2]]
    assert size[0] < size[1] < 2.2 * size[0]
    items = bench([(None, text[2]), (4, text[2]), (4, text[3]), (4, text[3])])
    d = docs(spark, [(1, f"so {text[2]} it", "s"), (None, text[3] + " x", "s"), (3, "nothing here", "s"), (1, f"so {text[2]} it", "s")])
    found = lambda: sorted(map(str, decontaminate.contaminated(d, items).collect()))
    first = found()
    assert len(first) == 3
    monkeypatch.setattr(decontaminate, "MOST_SHINGLES", 3)
    assert found() == first


def test_mixing(spark):
    rnd = random.Random(5)
    rows = [(i, " ".join("w" * rnd.randint(1, 3) for _ in range(rnd.randint(1, 30))), rnd.choice(["b", "a", "é", None]))
            for i in range(600)] + [(700, None, "a"), (701, "", "b"), (702, None, "void")]
    got = mixing.mix_sources(docs(spark, rows)).collect()
    again = mixing.mix_sources(docs(spark, rows).repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
    size = collections.Counter()
    for _, t, s in rows:
        size[s] += len(WORD.findall(t or ""))
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    capped, total = set(), 1.5 * sum(size.values())
    while True:
        left = total - sum(2 * size[s] for s in capped)
        free = [s for s in order if s not in capped]
        over = {s for s in free if left * weight[s] / sum(weight[f] for f in free) > 2 * size[s]}
        if not over:
            break
        capped |= over
    goal = {s: 2 * size[s] if s in capped else left * weight[s] / sum(weight[f] for f in free) for s in order}
    taken = collections.Counter()
    for r in got:
        assert abs(r["target"] - goal[r["source"]]) < 1e-6 and r["source_size"] == size[r["source"]]
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - goal[s]) <= 30 for s in order)
    assert mixing.mix_sources(docs(spark, [])).count() == 0
    mixed = mixing.mixed_documents(docs(spark, rows).withColumn("size", F.lit("mine")))
    assert {r["doc_id"]: r["copies"] for r in mixed.collect()} == {r["doc_id"]: r["copies"] for r in got if r["copies"]}


def test_mixing_equal_rows(spark):
    """Rows without id and repeated rows are drawn one by one: a source's
    taken words stay within one document of its target."""
    words = " ".join(["w"] * 10)
    for rows in ([(None, words, "a")] * 2000, [(None, f"{words[2:]} {i}", "a") for i in range(2000)],
                 [(7, words, "a")] * 1000 + [(i, words, "a") for i in range(8, 1008)],
                 [(None, words, None)] * 900 + [(None, None, "b")] * 300 + [(5, words, "b")] * 800):
        once = docs(spark, rows)
        got = mixing.mix_sources(once).collect()
        assert len(got) == len(rows) and all(r["taken"] <= 2 * r["size"] for r in got)
        taken = collections.Counter()
        for r in got:
            taken[r["source"]] += r["taken"]
        assert all(abs(taken[r["source"]] - r["target"]) <= 10 for r in got)
        key = lambda d: sorted(map(str, d))
        assert key(mixing.mix_sources(once.repartition(5)).collect()) == key(got)
        mixed = mixing.mixed_documents(once).collect()
        assert sum(r["copies"] for r in mixed) == sum(r["copies"] for r in got)
        assert collections.Counter((r["doc_id"], r["source"], r["copies"]) for r in mixed) == collections.Counter(
            (r["doc_id"], r["source"], r["copies"]) for r in got if r["copies"])


def test_licenses(spark):
    rows = [(1, "Some text. Licensed under the Apache License, Version 2.0. More text here.", "s"),
            (2, "a\nReleased under the MIT license\nAll Rights Reserved.", "s"),
            (3, "We gave license to write. Copyright is a long story about many other things.", "s"),
            (4, None, "s"), (5, "", "s"), (6, "x " * 5000 + "Licensed under CC BY-NC 4.0.", "s"),
            (7, "Licensed under the Apache License, Version 2.0.", "s"),
            (7, "Licensed under the Apache License, Version 2.0.", "s"),
            (8, "This work is now licensed under the GNU General Public License version 3.", "s")]
    got = sorted((r["doc_id"], r["license"], r["n_diff"]) for r in licenses.license_blocks(docs(spark, rows)).collect())
    assert got == [(1, "Apache-2.0", 0), (2, "MIT", 0), (2, "proprietary", 0), (7, "Apache-2.0", 0), (7, "Apache-2.0", 0),
                   (8, "GPL-3.0", 1)]
    assert licenses.license_blocks(docs(spark, [])).count() == 0
    assert licenses.wording("a b c d", "a x c d e") == (2, 5)


def test_quality_words(spark):
    """Scores are those of a direct computation; order and repetition count."""
    import math

    rnd = random.Random(11)
    vocab = ["".join(rnd.choices("etaoinshr", k=rnd.randint(2, 7))) for _ in range(300)]
    after = {w: rnd.choices(vocab, k=4) for w in vocab}

    def chain(n):
        out = [rnd.choice(vocab)]
        while len(out) < n:
            out.append(rnd.choice(after[out[-1]]))
        return out

    good = [chain(100) for _ in range(400)]
    mixed = [rnd.sample(t, len(t)) for t in good[300:340]]
    once = [[rnd.choice(vocab)] * 100 for _ in range(20)]
    texts = [" ".join(t) for t in [*good, *mixed, *once]] + ["a", "zz  q\n", "", None, " ".join(good[0])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'en' lang")
    trusted = df.where("doc_id < 300")
    got = {r["doc_id"]: r["keep"] for r in quality.classify(df, trusted).collect()}
    assert sum(not got[i] for i in range(400, 440)) >= 38 and sum(not got[i] for i in range(440, 460)) >= 18
    assert sum(got[i] for i in range(400)) >= 396

    model = quality.train(trusted)
    table, unknown = quality.train_words(trusted, model)
    scored = {r["doc_id"]: r for r in quality.score(df, model, table, unknown).collect()}
    raw = lambda t: (np.frombuffer((t or "").encode(), np.uint8), np.array([0, len((t or "").encode())]))
    half = {t: int(quality._fold(quality._sequences(*raw(t))[5])[0]) for t in texts}
    spell = lambda w: float(quality._spelling(model, *(lambda d: (d, np.array([0, len(d)])))(
        np.frombuffer((w + " ").encode(), np.uint8)))[0])
    S, E = "<", ""  # marks; the end is spelled as a blank
    all3 = [collections.Counter(), collections.Counter()]
    for t in texts[:300]:
        x = [S, S, *t.split(), E]
        all3[half[t]].update(zip(x, x[1:], x[2:]))
    counts = [[collections.Counter(), collections.Counter(), c] for c in all3]
    for c in counts:
        c[1].update(g[1:] for g in c[2])
        c[0].update(g[1:] for g in c[1])
    cuts = []
    for o in range(3):
        n = collections.Counter(v for c in counts for v in c[o].values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] and n[3] else None
        cuts.append((0.5, 0.75, 0.9) if y is None else tuple(
            min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.05), i) for i in (1, 2, 3)))

    sums = [[collections.defaultdict(lambda: [0, 0.0]) for _ in range(3)] for _ in range(2)]
    for f in range(2):
        for o in range(3):
            for g, v in counts[f][o].items():
                sums[f][o][g[:-1]][0] += v
                sums[f][o][g[:-1]][1] += min(cuts[o][min(v, 3) - 1], v)

    def p(f, g):
        low = p(f, g[1:]) if len(g) > 1 else math.exp(-spell(g[0]))
        o = len(g) - 1
        if g[:-1] not in sums[f][o]:
            return low
        total, left = sums[f][o][g[:-1]]
        v = counts[f][o].get(g, 0)
        return ((v - min(cuts[o][min(v, 3) - 1], v)) / total if v else 0) + left / total * low

    for i in [0, 5, 301, 405, 445, 460, 461, 462, 463, 464]:
        w = (texts[i] or "").split()
        x = [S, S, *w, E] if w else []
        exp = max(-sum(math.log(p(f, g)) for g in zip(x, x[1:], x[2:])) for f in (0, 1))
        assert scored[i]["__lm_nll"] == pytest.approx(exp, rel=1e-4)


def test_quality_rounds(spark, tmp_path, monkeypatch):
    """n-grams in rounds give the scores of one round, and neither n-grams
    nor trusted texts stay on disk."""
    rnd = random.Random(12)
    vocab = ["".join(rnd.choices("abcdé", k=rnd.randint(1, 20))) for _ in range(60)]
    texts = [" ".join(rnd.choices(vocab, k=rnd.randint(1, 40))) for _ in range(60)]
    df = spark.createDataFrame([*enumerate(texts + texts[:5] + ["", None])], "doc_id long, text string").selectExpr("*", "'en' lang")
    trusted = df.where("doc_id < 30").unionByName(spark.sql("SELECT -1L doc_id, 'abc only trusted' text, 'en' lang"))
    monkeypatch.setattr("ballotlake.llm.shared.shared_dir", lambda _: f"file://{tmp_path}")
    one = {(r["doc_id"], r["keep"]): r["perplexity"] for r in quality.classify(df, trusted).collect()}
    monkeypatch.setattr(quality, "ROUNDS", 3)
    monkeypatch.setattr(quality, "ROUND_BYTES", 1)
    many = {(r["doc_id"], r["keep"]): r["perplexity"] for r in quality.classify(df, trusted).collect()}
    assert many == pytest.approx(one) and len(many) == 67
    names = {p.name.split("-")[2] for p in tmp_path.iterdir()}
    assert not names & {"trusted", "others", "part", "follow", "grams", "words3", "p3", "table"}


def test_license_texts(spark):
    """Real headers: wrapped, in comments, going on after the template."""
    import textwrap

    texts = {n: " ".join(t.split()) for n, t in licenses.TEMPLATES if len(t) > 180}
    rows, exp = [], set()
    for i, (name, t) in enumerate(sorted(texts.items())):
        for j, mark in enumerate(["", " * ", "# ", "// "]):
            lines = "".join(mark + x + "\n" for x in textwrap.wrap(t, (72, 60, 50, 40)[j]))
            rows.append((10 * i + j, "import os\n" + lines + "\ndef main(): pass\n" * 5, "s"))
            exp.add((10 * i + j, name))
        rows.append((10 * i + 5, f"Notes on the program. {t} And a last word about other things that follow here.", "s"))
        exp.add((10 * i + 5, name))
    rows += [(900, "MIT License\n\nCopyright (c) 2020 Someone\n", "s"), (901, "x\n\tMIT License", "s"), (None, "MIT License", "s"),
             (902, "All about the license of a driver, and how people get permission to redistribute old maps of towns.", "s")]
    got = licenses.license_blocks(docs(spark, rows)).collect()
    assert exp <= {(r["doc_id"], r["license"]) for r in got}
    assert {(r["doc_id"], r["license"]) for r in got} - exp == {(900, "MIT"), (901, "MIT"), (None, "MIT")}
    assert len({(r["doc_id"], r["block_no"]) for r in got}) == len(got)


def test_license_ranking(monkeypatch):
    """Every template's reduction is known before a wording is compared, and
    wordings are confirmed by falling reduction; the choice is that of a
    search through all templates."""
    rnd = random.Random(3)
    scan = licenses._Scan(licenses.TEMPLATES, 0.25)
    blocks = []
    for _, t in licenses.TEMPLATES:
        w = t.split()
        for edits in (0, 1, 3, len(w) // 4 + 1):
            x = list(w)
            for _ in range(edits):
                x[rnd.randrange(len(x))] = rnd.choice(["license", "or", "copyright", *w])
            blocks += [" ".join(x), " ".join([*x, "and", "so", "on"])]
    blocks += ["copyright is a word", "license", "", "licensed " * 3000]
    number = {t: i for i, (_, t) in enumerate(licenses.TEMPLATES)}
    wording, compared = licenses.wording, []
    monkeypatch.setattr(licenses, "wording", lambda t, b: (compared.append(number[t]), wording(t, b))[1])
    hits = confirmed = 0
    for block in blocks:
        order = [i for gain, i in scan.ranked(block, range(len(number))) if gain > 0]
        gains = dict((i, gain) for gain, i in scan.ranked(block, range(len(number))))
        compared.clear()
        got = scan.block(block)
        assert [i for i in order if i in compared] == compared
        confirmed += len(compared)
        found = [(d / n, -gains[i], i, d, n) for i in order for d, n in [wording(licenses.TEMPLATES[i][1], block)]
                 if d <= 0.25 * n]
        assert got == (min(found) if found else None)
        hits += got is not None
    assert hits > len(number) and confirmed >= hits
    # A passage's templates are aligned by falling reduction, too.
    tried = []
    aligned = licenses.aligned
    monkeypatch.setattr(licenses, "aligned", lambda t, p: (tried.append(scan.words.index(t)), aligned(t, p))[1])
    words = "x y z this program is free software ; you can".split() + scan.words[scan.long[-1]] + ["the", "end"]
    cue = words.index("license") if "license" in words else 12
    first = [i for _, i in scan.ranked(" ".join(words), scan.long)]
    assert list(scan.passages(words, [cue])) and tried
    assert [i for i in first if i in tried][0] == tried[0]


def test_repeated_rows_are_linear(spark, monkeypatch):
    """2,000 copies of a row and a near copy of it: as many links and rows in
    the lists as for one copy."""
    base = some_texts(seed=21, n=6)[:6]
    near = base[0].split()
    near[3] = "changed"
    seen = {}

    def watch(df, name):
        out = jaccard_written(df, name)
        seen.setdefault(name, []).append(out.count())
        return out

    jaccard_written = jaccard.written
    monkeypatch.setattr(jaccard, "written", watch)
    counts = []
    for copies in (1, 2000):
        seen.clear()
        rows = [(0, base[0])] * copies + [(1, " ".join(near))] + list(enumerate(base[1:], 2))
        out = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), k=2, threshold=(1, 2))
        assert out.count() == len(rows) and out.where("doc_id < 2 and component_id <> 0").count() == 0
        counts.append((sum(seen["links"]), sum(seen["lists"]), sum(seen["star-pairs"]), sum(seen["mixed-lists"])))
    assert counts[0] == counts[1] and counts[0][0] >= 1
