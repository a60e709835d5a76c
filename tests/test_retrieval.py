import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corvane.functions import text as T
from corvane.operators import retrieval as R

DOCS = ["the cat sat", "the dog sat on the mat", "the the bird", "a fish", "the cat and the dog"]


def okapi(query, docs, k1=1.5, b=0.75, eps=0.25):
    toks = [d.split() for d in docs]
    n, avg = len(toks), sum(map(len, toks)) / len(toks)
    df = Counter(t for d in toks for t in set(d))
    idf = {t: math.log(n - f + 0.5) - math.log(f + 0.5) for t, f in df.items()}
    mean = sum(idf.values()) / len(idf)
    idf = {t: eps * mean if v < 0 else v for t, v in idf.items()}
    out = []
    for d in toks:
        tf = Counter(d)
        out.append(sum(idf.get(t, 0) * tf[t] * (k1 + 1) / (tf[t] + k1 * (1 - b + b * len(d) / avg)) for t in query.split()))
    return out


def frames(spark, query):
    q = spark.createDataFrame([(1, query)], "query_id long, q string").select("query_id", F.split("q", " ").alias("q_tokens"))
    d = spark.createDataFrame(list(enumerate(DOCS)), "doc_id long, d string").select("doc_id", F.split("d", " ").alias("tokens"))
    return q, d


@pytest.mark.parametrize("query", ["the cat", "the the cat unknown", "dog mat"])
def test_bm25_with_negative_idf(spark, query):
    q, d = frames(spark, query)
    got = {r["doc_id"]: r["score"] for r in R.bm25_scores(q, d, "query_id", "doc_id").collect()}
    for i, want in enumerate(okapi(query, DOCS)):
        assert got.get(i, 0.0) == pytest.approx(want)


def test_bm25_of_given_pairs(spark):
    q, d = frames(spark, "the cat")
    pairs = spark.createDataFrame([(1, 1), (1, 3)], "query_id long, doc_id long")
    got = R.bm25_scores(q, d, "query_id", "doc_id", pairs=pairs).collect()
    assert [r["doc_id"] for r in got] == [1]
    assert got[0]["score"] == pytest.approx(okapi("the cat", DOCS)[1])


def test_page_rank_equals_the_pairwise_form(spark):
    texts = ["red green blue", "green blue yellow", "red red pink", "grey", "blue pink yellow green", "red green blue"]
    df = spark.createDataFrame([(1, i, s) for i, s in enumerate(texts)], "entry_id long, pos int, sentence string")
    got = {r["pos"]: r["score"] for r in R.rank_sentences(df, [], iterations=20).collect()}
    sets = [set(t.split()) for t in texts]
    n = len(sets)
    w = [[len(a & b) if i != j else 0 for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    score = [1 / n] * n
    for _ in range(20):
        score = [0.15 / n + 0.85 * sum(score[j] * w[j][i] / sum(w[j]) for j in range(n) if sum(w[j])) for i in range(n)]
    for i in range(n):
        assert got[i] == pytest.approx(score[i])
    short = R.summarize_extractive(df, [], iterations=20).first()
    best = sorted(sorted(range(n), key=lambda i: (-round(score[i], 9), i))[:3])
    assert short["summary"] == " ".join(texts[i] for i in best)


def test_dedup_sentences_keeps_first_spelling(spark):
    df = spark.createDataFrame([(1, "One here.  one HERE. Two! One here. Three"), (2, "")], "id long, content string")
    got = {r["id"]: r["text"] for r in R.dedup_sentences(df).collect()}
    assert got == {1: "One here. Two! Three", 2: ""}


def test_gate_is_strict(spark):
    entries = spark.createDataFrame([(1, True, 0.7), (2, True, 0.71), (3, False, 0.9)], "id long, validated boolean, quality_score double")
    sents = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "entry_id long, sentence string")
    assert [r["entry_id"] for r in R.semi_validated(sents, entries).collect()] == [2]


def test_answer_limit_by_intent(spark):
    rows = [(q, i, q * 10 + k, intent, n, 1.0 - k / 10, 1.0 - k / 10 + (0.5 if k == 2 else 0))
            for q, intent, n in [(1, "list", 0), (2, "factoid", 1), (3, "factoid", 0), (4, "definition", 0)]
            for k, i in enumerate(["a", "b", "c"])]
    df = spark.createDataFrame(rows, "query_id long, doc_id string, entry_id long, intent string, n_entities int, base_score double, boosted_score double")
    count = {r["query_id"]: r["count"] for r in R.answer_limit(df).groupBy("query_id").count().collect()}
    assert count == {1: 3, 2: 1, 4: 1}
    first = R.answer_limit(df, rerank=True).filter("query_id = 4").first()
    assert first["doc_id"] == "c"


def test_boost_counts_mentions(spark):
    mentions = spark.createDataFrame([(1, "paris"), (1, "paris"), (1, "rome"), (2, "oslo")], "id long, text_lc string")
    kb = spark.createDataFrame([("paris",)], "text_lc string")
    got = {r["id"]: (r["n_entities"], round(r["kb_boost"], 6)) for r in R.kb_boost(mentions, kb).collect()}
    assert got == {1: (3, 0.2), 2: (1, 0.0)}


def test_expand_synonyms(spark):
    q = spark.createDataFrame([(1, "Big car in town")], "qid long, question string")
    syn = spark.createDataFrame([("car", "motor_car"), ("big", "large")], "word string, synonym string")
    assert R.expand_synonyms(q, syn, ["in"]).first()["words"] == ["big", "car", "large", "motor car", "town"]


def test_sentence_rows(spark):
    df = spark.createDataFrame([(5, "First one here. Second one.")], "id long, content string")
    got = R.sentences_of(df).withColumn("sid", R.sentence_id()).orderBy("pos").collect()
    assert [(r["sid"], r["sentence"]) for r in got] == [("5-000000", "First one here."), ("5-000001", "Second one.")]
    assert T.MARK not in got[0]["sentence"]


def test_no_row_per_pair_is_shuffled(spark):
    queries = spark.createDataFrame([(1, ["a", "b"]), (2, ["b"])], "q long, q_tokens array<string>")
    corpus = spark.createDataFrame([(i, ["a", "b", "c"][: i % 3 + 1]) for i in range(9)], "d long, tokens array<string>")
    scores = R.bm25_scores(queries, corpus, "q", "d")
    assert "hashpartitioning(query_id" not in scores._jdf.queryExecution().executedPlan().toString()
    assert {(r.query_id, r.doc_id) for r in scores.collect()} == {(1, i) for i in range(9)} | {(2, i) for i in range(9) if i % 3}
