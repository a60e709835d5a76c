"""Listed names in token arrays, against plain Python."""

from pyspark.sql import functions as F

from corvane.functions import text as T
from corvane.operators import quality

NAMES = ["a", "a a", "a b a", "b a", "de la", "a.b", "(", "la", "x  y", "b a b a"]


def plain(tokens):
    if tokens is None:
        return None
    return sum(" ".join(tokens[i:i + len(n.split(" "))]) == n for n in set(NAMES) for i in range(len(tokens) - len(n.split(" ")) + 1))


def test_overlapping_names_all_count_and_no_gram_is_built(spark):
    rows = [["a", "a", "a", "b", "a", "b", "a"], ["de", "la", "la"], ["b", "a"], ["dea", "b", "ab"], [], None, ["a"], ["x", "y"]]
    df = spark.createDataFrame(list(enumerate(rows)), "id int, t array<string>")
    found = df.select("id", quality.gazetteer_hits(F.col("t"), NAMES).alias("n"))
    assert {r.id: r.n for r in found.collect()} == {i: plain(t) for i, t in enumerate(rows)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "slice" not in plan and "sequence" not in plan


def test_polarity_looks_up_listed_tokens_only(spark):
    df = spark.createDataFrame([(["good", "x", "bad", "good"],), ([],), (["x"],), (None,)], "t array<string>")
    got = [r[0] for r in df.select(T.polarity(F.col("t"), {"good": 0.5, "bad": -0.2})).collect()]
    assert got[0] == (0.5 - 0.2 + 0.5) / 3 and got[1:] == [0.0, 0.0, 0.0]


def test_ngrams_are_not_shuffled_to_meet_a_small_kb(spark):
    kb = spark.createDataFrame([("red fox", "ORG"), ("a b c d", "WORK")], "text_lc string, type string")
    df = spark.createDataFrame([(1, "the red fox sat"), (2, "a b c d e")], "id long, content string")
    found = quality.entity_mentions(df, kb)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert {(r["id"], r["pos"], r["text"]) for r in found.collect()} == {(1, 1, "red fox"), (2, 0, "a b c d")}
