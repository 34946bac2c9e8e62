"""Blocked best match, cascade, id matching (fixtures T3, T4, T5; B11, B15)."""

from pyspark.sql import functions as F

from ballotlake.functions.similarity import similarity
from ballotlake.operators.matching import best_match, resolve_ids, resolve_names, review_queue

LABELS = [("FULTON", "01A", "ALPHA PARK"), ("FULTON", "02B", "BETA HILLS"), ("FULTON", "03C", "GAMMA RIDGE"),
          ("CHATHAM", "7-07", "SEVEN OAKS"), ("CHATHAM", "8-08", "EIGHT MILE")]
LSCHEMA = "county string, precinct string, precinctName string"


def test_similarity_scores(spark):
    df = spark.createDataFrame([("KITTEN", "SITTING"), ("ABC", "ABC"), ("", "")], "a string, b string")
    got = [r[0] for r in df.select(similarity("a", "b")).collect()]
    assert got == [57, 100, 100]       # 100*(1-3/7)=57.14


def test_best_match_blocked(spark):
    labels = spark.createDataFrame(LABELS, LSCHEMA)
    names = spark.createDataFrame([("FULTON", "Alpha  Park"), ("FULTON", "HILLS BETA"), ("FULTON", None),
                                   ("COBB", "Anything")], "county string, name string")
    got = {r.name: r for r in best_match(names, labels, ["county"], "name", "precinctName", "precinct").collect()}
    assert got["Alpha  Park"].id == "01A" and got["Alpha  Park"].score == 100
    assert got["HILLS BETA"].id == "02B" and got["HILLS BETA"].score == 100     # token-sorted
    assert got["Anything"].label is None and got["Anything"].score == 0         # B15: no labels in block
    assert None not in got
    salted = best_match(names, labels, ["county"], "name", "precinctName", "precinct", salt_buckets=4)
    assert sorted(map(tuple, salted.collect()), key=repr) == sorted(
        map(tuple, best_match(names, labels, ["county"], "name", "precinctName", "precinct").collect()), key=repr)


def test_cascade(spark):
    labels = spark.createDataFrame(LABELS, LSCHEMA)
    names = spark.createDataFrame([("fulton", "ALPHA PK"), ("fulton", "Gamma"), ("Chatham", "7-07 Seven"),
                                   ("Chatham", "9-09 Nine"), ("fulton", "ALPHA PK")], "county string, name string")
    ov = spark.createDataFrame([("FULTON", "Gamma", "03C", "GAMMA RIDGE"), ("FULTON", "Gamma", "09Z", "DUP")],
                               "county string, electionResultsPrecinctName string, precinct string, mapPrecinctName string")
    rules = spark.createDataFrame([("CHATHAM", "first_token", "")], "county string, rule string, suffix string")
    out = resolve_names(names, labels, ov, rules)
    got = {r.electionResultsPrecinctName: r for r in out.collect()}
    assert out.count() == 4                                           # each distinct name once
    assert (got["Gamma"].precinct, got["Gamma"].score, got["Gamma"].rule) == ("03C", 100, "override")  # B11
    assert (got["7-07 Seven"].mapPrecinctName, got["7-07 Seven"].score) == ("SEVEN OAKS", 100)
    assert (got["9-09 Nine"].mapPrecinctName, got["9-09 Nine"].score) == ("??", 0)
    assert got["ALPHA PK"].rule == "fuzzy" and got["ALPHA PK"].precinct == "01A"
    assert {r.electionResultsPrecinctName for r in review_queue(out, 95).collect()} == {"ALPHA PK", "9-09 Nine"}


def test_resolve_ids_threshold(spark):
    labels = spark.createDataFrame([("FULTON", "SS01", "x"), ("FULTON", "SS02", "y")], LSCHEMA)
    names = spark.createDataFrame([("Fulton", "SS01"), ("Fulton", "SS0"), ("Fulton", "QQQQ")],
                                  "county string, precinct string")
    got = {r.absenteePrecinct: r.score for r in resolve_ids(names, labels).collect()}
    assert got == {"SS01": 100}          # SS0 scores 75 (<= 80), QQQQ 0


def test_lookup_keeps_leading_zeros(spark, tmp_path):
    from ballotlake.sources import read_lookup
    from tests.conftest import write
    p = write(str(tmp_path / "labels.csv"), "county,precinct,precinctName\nfulton,01A,ALPHA PARK\ncobb,007,X\n")
    lab = read_lookup(spark, p, "county string, precinct string, precinctName string")
    assert sorted(r.precinct for r in lab.collect()) == ["007", "01A"]


def test_default_rules(spark):
    from ballotlake.plans.names import default_rules, results_name_map
    r16 = {(r.county, r.rule, r.suffix) for r in default_rules(spark, "2016").collect()}
    assert ("CHATHAM", "first_token", "C") in r16 and len(r16) == 3
    r22 = {(r.county, r.rule) for r in default_rules(spark, "2022").collect()}
    assert ("RICHMOND", "name_is_id") in r22 and len(r22) == 4
    labels = spark.createDataFrame([("CHATHAM", "1-01C", "ONE"), ("RICHMOND", "R7", "SEVEN")], LSCHEMA)
    res = spark.createDataFrame([("Chatham", "1-01 Somewhere"), ("Richmond", "R7")], "county string, precinct string")
    m, review = results_name_map(res, labels, rules=default_rules(spark, "2018"))
    got = {r.electionResultsPrecinctName: (r.precinct, r.mapPrecinctName, r.score) for r in m.collect()}
    assert got["1-01 Somewhere"] == ("1-01C", "ONE", 100)
    assert got["R7"][0] == "R7" and got["R7"][2] < 95              # 2018: no rule, fuzzy on names


def test_id_score_thresholds(spark):
    from ballotlake.plans.names import absentee_id_map
    label = "A" * 100
    labels = spark.createDataFrame([("FULTON", label, "x")], LSCHEMA)
    # distance d to a 100-character label gives score 100 - d
    names = {100 - d: "A" * (100 - d) + "B" * d for d in (0, 1, 19, 20, 21)}
    summary = spark.createDataFrame([("fulton", n) for n in names.values()] + [("fulton", None)],
                                    "county string, precinct string")
    kept, review = absentee_id_map(summary, labels)
    got = {r.absenteePrecinct: r.score for r in kept.collect()}
    assert sorted(got.values()) == [81, 99, 100]                  # 79 and 80 are not > 80; null skipped
    assert sorted(r.score for r in review.collect()) == [81, 99]   # review: < 100


def _all_pairs(names, labels):
    """Every name against every label of its block, in plain Python."""
    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            prev, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
        return row[-1]

    def score(a, b):
        n = max(len(a), len(b))
        return 100 if n == 0 else (200 * (n - lev(a, b)) + n) // (2 * n)

    def text(t):
        return " ".join(t.upper().split())

    out = {}
    for block, name in set(names):
        best = (0, None, None)
        for lb, label, i in labels:
            if lb == block and label is not None:
                q, w = text(name), text(label)
                s = max(score(q, w), score(" ".join(sorted(q.split(" "))), " ".join(sorted(w.split(" ")))))
                best = min(best if best[1] is not None else (1, None, None), (-s, label, i))
        out[block, name] = (best[1], best[2], -min(best[0], 0))
    return out


def _random_names(seed, n_labels, n_names, noise):
    import random
    rnd = random.Random(seed)
    words = ["".join(rnd.choices("ABCDEFGHILMNOPRSTU", k=rnd.randint(2, 9))) for _ in range(60)] + ["1", "02", "3A"]
    labels = [(rnd.choice("XYZ"), " ".join(rnd.choices(words, k=rnd.randint(1, 4))), f"{i:03}") for i in range(n_labels)]
    labels += [("X", "", "blank"), ("X", None, "none"), labels[0][:2] + ("zzz",)]
    names = []
    for _ in range(n_names):
        b, t, _ = rnd.choice(labels[:n_labels])
        w = t.split()
        rnd.shuffle(w)
        t = list(" ".join(w))
        for _ in range(rnd.randint(0, noise)):
            i = rnd.randrange(len(t) + 1)
            t[i:i + rnd.randint(0, 1)] = rnd.choice(["", "q", "E", " ", "TT"])
        names.append((b, "".join(t)))
    return names + [("X", ""), ("X", "  "), ("Y", "00000"), ("W", "no labels here")], labels


def test_best_match_equals_all_pairs(spark):
    for seed, noise in ((1, 2), (2, 6), (3, 14)):
        names, labels = _random_names(seed, 250, 300, noise)
        got = best_match(spark.createDataFrame(names, "county string, name string"),
                         spark.createDataFrame(labels, "county string, label string, id string"),
                         ["county"], "name", "label", "id")
        rows = {(r.county, r.name): (r.label, r.id, r.score) for r in got.collect()}
        assert rows == _all_pairs(names, labels)


def test_few_pairs_are_scored(spark):
    """Near copies in one large block."""
    from ballotlake.operators.matching import candidate_pairs
    names, labels = _random_names(5, 3000, 2000, 2)
    names = [("X", t) for _, t in set(names) if len(t) > 8]
    labels = [("X", t, i) for _, t, i in labels]
    n = spark.createDataFrame(names, "county string, name string").distinct()
    pairs = candidate_pairs(n, spark.createDataFrame(labels, "county string, label string, id string"),
                            ["county"], "name", "label", "id")
    assert pairs.count() < n.count() * len(labels) / 20


def test_few_pairs_are_scored_on_the_stand_in(spark):
    from ballotlake.operators.matching import candidate_pairs
    from ballotlake.plans import standins as S
    d = "/root/testdata/sf0.1"
    n = S.match_names(spark, d).withColumn("county", F.upper("county")).distinct()
    lab = S.match_labels(spark, d)
    formed = n.join(lab, "county").count()
    assert candidate_pairs(n, lab, ["county"], "name", "precinctName", "precinct").count() <= formed / 10


def test_lookup_is_no_cross_join(spark):
    names = spark.createDataFrame([("FULTON", "ALPHA PARK")], "county string, name string")
    plan = best_match(names, spark.createDataFrame(LABELS, LSCHEMA), ["county"], "name", "precinctName", "precinct"
                      )._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan
