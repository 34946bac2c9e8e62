"""The pipeline's stages, one after the other, and the registered queries."""

import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_registered():
    assert [f"op{n}_" for n in range(1, 11)] == [next(q for q in entry.queries() if q.startswith(f"op{n}_"))[:len(f"op{n}_")]
                                                for n in range(1, 11)]
    assert "pipeline" in entry.queries() and len(corpus_pipeline.STAGES) == 5


def test_stages_take_effect(spark, tmp_path):
    rnd = random.Random(1)
    words = ["".join(rnd.choices("etaoin", k=rnd.randint(2, 6))) for _ in range(3000)]
    clean = [" ".join(rnd.choices(words, k=120)) for _ in range(200)]
    passage = " ".join(rnd.choices(words, k=150))
    item = " ".join(rnd.choices(words, k=30))
    rows = list(enumerate(clean))
    rows += [(250, clean[0]), (251, clean[1] + " tail"), (252, clean[2][:200] + " " + passage),
             (253, clean[3][:200] + "x " + passage), (254, rnd.choice(words) + " " + item + " " + " ".join(words[:40])),
             (255, "@@@### QQQ!!! " * 40), (256, ""), (257, None)]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now, left = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = spark.createDataFrame(stage(spark, now, str(tmp_path)).collect(), docs.schema)
        left.append({r["doc_id"]: r for r in now.collect()})
    assert set(left[0]) == {i for i, _ in rows} - {255}
    assert set(left[1]) == set(left[0]) - {250, 251}
    assert passage[:200] not in (left[2][252]["text"] + left[2][253]["text"]) and left[2][5]["text"] == clean[5]
    assert left[2][252]["n_chars"] == len(left[2][252]["text"])
    assert set(left[3]) == set(left[1]) - {254}
    mixed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in mixed} <= set(left[3]) and all(r["copies"] in (1, 2) for r in mixed)


def test_repeated_rows_and_null_ids(spark):
    rnd = random.Random(2)
    words = ["".join(rnd.choices("etaoin", k=rnd.randint(3, 8))) for _ in range(3000)]
    text = [" ".join(rnd.choices(words, k=120)) for _ in range(7)]
    item = " ".join(rnd.choices(words, k=30))
    rows = [(1, text[0]), (1, text[0]), (2, text[1]), (None, text[1]), (None, text[2]), (None, text[2]), (3, text[3]),
            (3, text[4]), (4, text[5]), (5, text[5] + " tail"), (None, text[6][:200] + " " + item), (6, None), (6, None), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    stages = dict(corpus_pipeline.STAGES)
    one = stages["near_duplicates"](spark, df, "")
    order = lambda rows: sorted(rows, key=repr)
    exp = order([(1, text[0]), (2, text[1]), (None, text[2]), (3, text[3]), (3, text[4]), (4, text[5]), rows[10], (6, None),
                 (7, "")])
    assert order(map(tuple, one.collect())) == exp
    left = stages["repeated_passages"](spark, one, "")
    assert order(map(tuple, left.collect())) == exp
    clean = corpus_pipeline.decontaminate.drop_contaminated(left, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert order(map(tuple, clean.collect())) == [r for r in exp if r != rows[10]]


@pytest.mark.parametrize("name", [q for q in entry.queries() if q.startswith("op")])
def test_query_runs(spark, name):
    df = entry.queries()[name](spark, SF)
    rows = df.collect()
    assert rows or name == "op9_decontaminate"
