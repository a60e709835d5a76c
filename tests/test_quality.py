import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.operators import analytics, anomalies, quality


def feature_rows(spark, rows):
    return spark.createDataFrame(rows, "id long, content string, n_entities int, n_tokens int, polarity double")


def test_validation_order_and_boundaries(spark):
    ok = "x" * 10
    df = feature_rows(spark, [
        (1, "x" * 9, 5, 9, 0.5), (2, ok, 1, 5, 0.05), (3, ok, 1, 5, 0.0499), (4, ok, 0, 9, 0.5), (5, ok, 1, 4, -0.5),
        (6, "y" * 20, 1, 5, 0.5), (7, "x" * 30, 1, 5, 0.5), (8, "", 1, 5, 0.5), (9, ok, 2, 10, -0.6)])
    got = {r["id"]: (r["message"], r["validated"], r["quality_score"]) for r in
           quality.validate(df, rules=[("x", "must start with x"), ("x{0,29}$", "too many")], max_chars=30).collect()}
    assert got[1] == ("too_short", False, 0.0) and got[8] == ("too_short", False, 0.0)
    assert got[2] == ("valid", True, round((1 + 1 + 0.05) / 3, 6))
    assert got[3][0] == "neutral" and got[3][2] > 0
    assert got[4][0] == got[5][0] == "no_entities_or_keywords" and got[4][2] > 0
    assert got[6] == ("rule:must start with x", False, 0.0) and got[7] == ("rule:too many", False, 0.0)
    assert got[9] == ("valid", True, round((2 + 2 + 0.6) / 3, 6))
    long = quality.validate(feature_rows(spark, [(1, "x" * 31, 1, 5, 0.5)]), max_chars=30).first()
    assert long["message"] == "too_long"
    calm = quality.validate(feature_rows(spark, [(1, ok, 1, 5, 0.0)]), use_sentiment=False).first()
    assert calm["message"] == "valid"


def test_features_see_the_whole_text(spark):
    text = "we saw Big Ben and paris and the eiffel tower. " + "pad " * 300 + "paris"
    df = spark.createDataFrame([(1, text)], "id long, content string")
    r = quality.text_features(df, ["paris", "eiffel tower"], ["and", "the"], {"saw": 0.5, "ben": -1.0}).first()
    assert r["n_entities"] == 4 and r["polarity"] is not None and r["polarity"] == pytest.approx(-0.25)


def test_too_many_rules_are_refused(spark):
    df = spark.createDataFrame([(i, "a", "e") for i in range(3)], "ord int, regex string, error string")
    with pytest.raises(ValueError):
        quality.rule_table(df, limit=2)
    assert quality.rule_table(df.orderBy(F.desc("ord")), limit=3) == [("a", "e")] * 3


def test_kb_update_last_document_wins(spark):
    kb = spark.createDataFrame([("paris", "GPE", "old"), ("rome", "GPE", "kept")], "text_lc string, type string, description string")
    mentions = spark.createDataFrame(
        [(1, 0, "Paris", "paris", "PERSON"), (2, 0, "Paris", "paris", "ORG"), (3, 0, "x", "x", "MISC")],
        "id long, pos int, text string, text_lc string, label string")
    got = {r["text_lc"]: (r["type"], r["description"]) for r in quality.kb_update(kb, mentions).collect()}
    assert got == {"paris": ("ORG", "ORG sisällöstä"), "rome": ("GPE", "kept")}


def test_tag_threshold_is_strict(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a a")], "id long, content string")
    words = spark.createDataFrame([("t", "a", 3.0)], "tag string, token string, weight double")
    assert [r["id"] for r in quality.tag_documents(df, words).collect()] == [2]


def test_language(spark):
    train = spark.createDataFrame([(1, "en", "the house and the garden"), (2, "de", "das haus und der garten")], "id long, lang string, t string")
    profiles = quality.language_profiles(train, "lang", "id", "t")
    probe = spark.createDataFrame([(1, "the tree and"), (2, "der baum und"), (3, "x")], "id long, t string")
    got = {r["id"]: r["detected"] for r in quality.detect_language(probe, profiles, content="t").collect()}
    assert got == {1: "en", 2: "de"}


def scores(spark, n=1000):
    x = np.random.default_rng(0).normal(5, 1, n)
    x[:10] = [30, -20, 28, 31, -25, 40, 29, 27, 33, -30]
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "id long, quality_score double")


def test_forest_share_extremes_and_stability(spark):
    df = scores(spark)
    a = {r["id"]: r["is_anomaly"] for r in anomalies.anomaly_iforest(df).collect()}
    b = {r["id"]: r["is_anomaly"] for r in anomalies.anomaly_iforest(df.repartition(9)).collect()}
    assert a == b
    assert 0.05 <= sum(a.values()) / len(a) <= 0.1
    assert all(a[i] for i in range(10))


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_tail_equals_numpy(spark, n):
    df = scores(spark, max(n, 10)).filter(F.col("id") < n)
    rows = df.collect()
    x = np.array([r["quality_score"] for r in rows])
    d = np.round(np.abs(x - np.median(x)), 9)
    want = sorted(range(n), key=lambda i: (-d[i], rows[i]["id"]))[: int(np.ceil(0.1 * n))]
    assert {r["id"] for r in anomalies.anomaly_tail(df).collect()} == {rows[i]["id"] for i in want}


def test_histogram(spark):
    df = spark.createDataFrame([(float(i),) for i in range(21)], "quality_score double")
    got = analytics.quality_histogram(df).orderBy("bin").collect()
    assert [r["entries"] for r in got] == [1] * 19 + [2]
    same = spark.createDataFrame([(2.0,), (2.0,)], "quality_score double")
    assert [r["entries"] for r in analytics.quality_histogram(same).orderBy("bin").collect()] == [2] + [0] * 19


def test_log_lines(spark):
    lines = [("2024-01-01 10:00:00,000 - INFO - Kysymys: why, Intentio: a, b, Intentio: list, Viive: 1.50s, Vastauksia: 3",),
             ("2024-01-01 10:00:00,000 - ERROR - something",),
             ("2024-01-01 10:00:00,000 - INFO - Kysymys: x, Intentio: factoid, Viive: 0.50s, Vastauksia: 1",)]
    log = analytics.question_log(spark.createDataFrame(lines, "value string"))
    assert sorted(r["intent"] for r in log.collect()) == ["factoid", "list"]
    counts = {r["intent"]: r["questions"] for r in analytics.intent_stats(log).collect()}
    assert counts == {"list": 1, "definition": 0, "explanation": 0, "comparison": 0, "factoid": 1}
    s = analytics.latency_stats(log).first()
    assert (s["questions"], s["avg_latency"], s["max_latency"], s["avg_answers"]) == (2, 1.0, 1.5, 2.0)


def test_decision_and_decay_tables(spark):
    # The action table and the evidence table of the described calculations.
    actions = spark.createDataFrame(
        [("Full isolation", 95.0, 340000.0, 20.0), ("Database isolation", 70.0, 170000.0, 60.0), ("C2 blocking only", 30.0, 0.0, 90.0),
         ("Deception mode", 60.0, 50000.0, 40.0), ("Partial services", 80.0, 200000.0, 50.0)], "action string, gain double, cost double, risk double")
    best = analytics.best_decision(analytics.decision_score(actions), "action").first()
    assert best["action"] == "Full isolation" and best["score"] == pytest.approx(156.6)
    evidence = spark.createDataFrame(
        [("Memory forensics", 100, 10), ("Network connections", 100, 30), ("Running processes", 100, 5), ("Disk artifacts", 100, 90), ("Log entries", 100, 100)],
        "kind string, now int, later int")
    got = [r["kind"] for r in analytics.evidence_decay(evidence, "kind", "now", "later").collect()]
    assert got == ["Running processes", "Memory forensics", "Network connections"]


def test_tracks_and_levels(spark):
    df = spark.createDataFrame([(80.0, 2), (79.9, 1), (50.0, 0), (49.9, 5)], "c double, s int")
    got = [tuple(r) for r in df.select(analytics.confidence_track(F.col("c")), analytics.evidence_confidence(F.col("s"))).collect()]
    assert got == [("high", "HIGH"), ("medium", "MEDIUM"), ("medium", "LOW"), ("low", "HIGH")]


def test_running_best_is_strict(spark):
    rows = [("r", i, v) for i, v in enumerate([3.0, 3.0, 2.0, 2.5, 1.0])] + [("s", 0, 9.0)]
    log = spark.createDataFrame(rows, "run string, step int, loss double")
    got = {(r["run"], r["step"]) for r in analytics.running_best(log, "run", "step", "loss").collect()}
    assert got == {("r", 0), ("r", 2), ("r", 4), ("s", 0)}


def test_iforest_trees_draw_from_all_rows(spark):

    ids = sorted(range(30_000), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    rare = set(ids[8192::1000])  # none among the 8,192 rows with the smallest hash
    df = spark.createDataFrame([(i, 1000.0 if i in rare else i % 100 / 100) for i in range(30_000)], "id bigint, quality_score double")
    got = {r["id"]: r["score"] for r in anomalies.anomaly_iforest(df).collect()}
    assert max(got[i] for i in rare) < min(s for i, s in got.items() if i not in rare)
    small = df.select("id", F.col("id").cast("double").alias("value")).limit(3000)
    values = np.array([r["value"] for r in small.collect()])
    base = np.array([r[0] for r in small.select(F.xxhash64(F.concat_ws(":", F.lit("1"), F.col("id").cast("string")))).collect()])
    for parts in (1, 7):
        drawn = anomalies.tree_samples(small.repartition(parts), 3, 50, 1)
        for tree, sample in enumerate(drawn):
            assert sample.tolist() == values[np.argsort(anomalies.tree_keys(base, tree))[:50]].tolist()


def test_language_reads_its_counts_once_and_sums_languages_in_one_row(spark, monkeypatch):
    rows = [(1, "en", "the cat and the dog"), (2, "fi", "kissa ja koira"), (3, None, "xyz"), (4, "sv", "en katt och en hund")]
    train = spark.createDataFrame(rows, "id long, lang string, t string")
    profiles = quality.language_profiles(train, "lang", "id", "t")
    assert len(profiles.inputFiles()) > 0  # written, so that a small one is broadcast by its size
    probe = spark.createDataFrame([(1, "the dog"), (2, "koira ja kissa"), (3, "qqqq"), (4, None), (5, "katt")], "id long, t string")

    def found():
        return sorted((r["id"], r["detected"], round(r["score"], 6)) for r in quality.detect_language(probe, profiles, content="t").collect())

    narrow = found()
    assert [x[:2] for x in narrow] == [(1, "en"), (2, "fi"), (5, "sv")]
    monkeypatch.setattr(quality, "LANGUAGES", 2)  # more languages than columns: the same result
    assert found() == narrow
