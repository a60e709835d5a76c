import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corvane.functions import text as T
from corvane.operators import decoding, ngrams, tokens
from corvane.session import saved

SENTENCES = [
    "Seven grey herons wait beside the old mill.", "Rain fell on the mill, and the herons left.",
    "Who counts boats when the river is dry?", "Clocks in this valley run slow; nobody minds.",
]


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string")


def test_vocab_ties_follow_first_occurrence(spark):
    df = docs(spark, ["b a b", "c a d <PAD>"]).repartition(3)
    got = [(r["token"], r["id"]) for r in tokens.vocab_topn(df, 8).orderBy("id").collect()]
    assert got == [("<PAD>", 0), ("<UNK>", 1), ("<BOS>", 2), ("<EOS>", 3), ("b", 4), ("a", 5), ("c", 6), ("d", 7)]


def test_encode_and_decode(spark):
    df = docs(spark, SENTENCES + ["", SENTENCES[0]]).withColumn("id", F.col("id") % 5)  # id 0 twice
    vocab = tokens.vocab_topn(df.filter("id < 3"), 1000)
    encoded = tokens.encode(df.select("id", T.word_tokens("text").alias("tokens")), vocab)
    rows = sorted((r["id"], r["ids"]) for r in encoded.collect())
    table = {r["token"]: r["id"] for r in vocab.collect()}
    want = [[2, *[table.get(w, 1) for w in re.findall(r"\b\w+\b|[^\w\s]", t.lower())], 3] for t in SENTENCES]
    assert rows == sorted([*enumerate(want), (4, [2, 3]), (0, want[0])])
    text = sorted((r["id"], r["text"]) for r in tokens.decode(encoded, vocab).collect())
    assert text[:2] == [(0, "seven grey herons wait beside the old mill.")] * 2 and text[-1] == (4, "")
    shown = tokens.decode(encoded.filter("id = 4"), vocab, skip_special=False).first()["text"]
    assert shown == "<BOS> <EOS>"
    again = tokens.encode(tokens.decode(encoded.filter("id < 3"), vocab).select("id", T.word_tokens("text").alias("tokens")), vocab)
    assert sorted((r["id"], r["ids"]) for r in again.collect()) == sorted([*enumerate(want[:3]), (0, want[0])])
    plain = tokens.encode(spark.createDataFrame([(1, None), (2, ["zzz"])], "id long, tokens array<string>"), vocab, add_special=False)
    assert {r["id"]: r["ids"] for r in plain.collect()} == {1: [], 2: [1]}


def test_decode_puts_no_space_before_marks(spark):
    df = spark.createDataFrame([([5, 4, 6, 99, 0],)], "ids array<int>")
    words = ["<PAD>", "<UNK>", "<BOS>", "<EOS>", ",", "a", "b"]
    vocab = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "token string, id int")
    assert tokens.decode(df, vocab).first()["text"] == "a, b"


def test_batch_pad(spark):
    df = spark.createDataFrame([(i, list(range(i + 1))) for i in range(5)], "id long, ids array<int>")
    got = {r["id"]: (r["batch"], len(r["padded"])) for r in tokens.batch_pad(df, 2).collect()}
    assert got == {0: (0, 2), 1: (0, 2), 2: (1, 4), 3: (1, 4), 4: (2, 5)}


@pytest.mark.parametrize("n, want", [(1, 1), (2, 1), (10, 9), (105, 94)])
def test_split_size_and_independence_of_partitions(spark, n, want):
    df = spark.range(n)
    a = {r["id"]: r["split"] for r in tokens.train_val_split(df).collect()}
    b = {r["id"]: r["split"] for r in tokens.train_val_split(df.repartition(5)).collect()}
    assert a == b and Counter(a.values())["train"] == want


def test_markov_counts_equal_plain_python(spark):
    texts = SENTENCES + ["abc", "naïve 😀😀😀😀 ça"]
    want = Counter((t[i:i + 3], t[i + 3]) for t in texts for i in range(len(t) - 3))
    table = ngrams.markov_train(docs(spark, texts), 3)
    assert {(r["ctx"], r["nxt"]): r["n"] for r in table.collect()} == dict(want)
    s = ngrams.markov_stats(table).first()
    assert s["contexts"] == len({c for c, _ in want}) and s["total_transitions"] == sum(want.values())


def test_markov_errors(spark):
    with pytest.raises(ValueError):
        ngrams.markov_train(docs(spark, ["abc"]), 0)
    with pytest.raises(ValueError):
        ngrams.require_transitions(ngrams.markov_train(docs(spark, ["abc"]), 3))


def test_markov_score_of_seen_and_unseen_grams(spark):
    import math
    table = ngrams.markov_train(docs(spark, ["abab"]), 1)  # a->b 2, b->a 1
    got = {r["id"]: r["log_likelihood"] for r in ngrams.markov_score(docs(spark, ["ab", "aa", "zz", "q"]), table, 1).collect()}
    assert got == pytest.approx({0: math.log(3 / 4), 1: math.log(1 / 4), 2: math.log(1 / 2)})


def logits(spark, rows):
    return spark.createDataFrame(rows, "seq_id long, token_id int, logit double")


def test_softmax_sums_to_one(spark):
    df = logits(spark, [(s, t, float(t * s)) for s in (1, 2) for t in range(5)] + [(3, 0, 1000.0), (3, 1, -1000.0)])
    for r in decoding.softmax_temperature(df, 0.7).groupBy("seq_id").agg(F.sum("prob").alias("p")).collect():
        assert r["p"] == pytest.approx(1.0)


def test_topk_keeps_ties(spark):
    df = logits(spark, [(1, 0, 3.0), (1, 1, 2.0), (1, 2, 2.0), (1, 3, 1.0)])
    assert {r["token_id"] for r in decoding.topk_filter(df, 2).collect()} == {0, 1, 2}


def test_nucleus_modes(spark):
    df = logits(spark, [(1, 0, 5.0), (1, 1, 0.0), (1, 2, 0.0), (2, 0, 0.0), (2, 1, 0.0), (2, 2, 0.0), (2, 3, 0.0)])
    kept = {(r["seq_id"], r["token_id"]) for r in decoding.nucleus_filter(df, 0.5).collect()}
    # the first token survives although it alone exceeds p; at cum == p one more is kept
    assert kept == {(1, 0), (2, 0), (2, 1), (2, 2)}
    strict = {(r["seq_id"], r["token_id"]) for r in decoding.nucleus_filter(df, 0.5, "strict").collect()}
    assert strict == {(2, 0), (2, 1)}
    with pytest.raises(ValueError):
        decoding.nucleus_filter(df, 0.5, "other")


def test_penalty_mask_and_greedy(spark):
    df = logits(spark, [(1, 0, 2.0), (1, 1, -2.0), (1, 2, 2.0)])
    seen = spark.createDataFrame([(1, 1), (1, 1), (1, 0)], "seq_id long, token_id int")
    got = {r["token_id"]: r["logit"] for r in decoding.repetition_penalty(df, seen, 2.0).collect()}
    assert got == {0: 1.0, 1: -1.0, 2: 2.0}
    length = spark.createDataFrame([(1, 3)], "seq_id long, generated int")
    assert decoding.min_length_mask(df, length, 2, 4).count() == 2
    assert decoding.min_length_mask(df, length, 2, 3).count() == 3
    assert decoding.greedy_next(df).first()["token_id"] == 0


@pytest.mark.parametrize("batch", [None, 1, 8])
@pytest.mark.parametrize("sizes", [[], [3], [0, 2, 9, 0, 1, 40, 5], [1] * 30])
def test_corpus_windows_cross_sequences_and_chunks(spark, sizes, batch):
    rows = [(i, [100 * i + k for k in range(n)]) for i, n in enumerate(sizes)] + [(99, None)]
    df = spark.createDataFrame(rows, "id long, ids array<int>").repartition(3)
    flat = [x for _, r in rows for x in r or []]
    count = max(len(flat) - 4, 0)
    count = count if batch is None else count // batch * batch
    got = sorted(map(tuple, tokens.corpus_windows(df, 4, batch, chunk=7).collect()))
    assert got == [(i, flat[i:i + 4], flat[i + 1:i + 5]) for i in range(count)]


def test_items_meet_again_without_another_shuffle(spark):
    """Arrays are dealt out once, before their items become rows; wide columns go with one item only."""
    vocab = saved(spark.createDataFrame([("a", 4), ("b", 5)], "token string, id int"), "vocab")
    df = spark.createDataFrame([(1, ["a", None, "c"], "x"), (1, ["a", None, "c"], "x"), (None, [], None), (2, None, "z")],
                               "id long, tokens array<string>, more string")
    found = tokens.encode(df, vocab, add_special=False)
    plan = found._jdf.queryExecution().executedPlan().toString()
    got = sorted(((r.id, r.tokens, r.more, r.ids) for r in found.collect()), key=str)
    assert got == sorted([(1, ["a", None, "c"], "x", [4, 1, 1])] * 2 + [(None, [], None, []), (2, None, "z", [])], key=str)
    assert plan.count("REPARTITION_BY_COL") >= 1 and "hashpartitioning(_row" in plan
    assert not [line for line in plan.splitlines() if "hashpartitioning" in line and "ENSURE_REQUIREMENTS" in line]


def test_windows_make_their_sequences_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("array<int>")
    def ids(i):
        made.add(1)
        return list(range(i))

    df = spark.range(40).repartition(3).select("id", ids("id").alias("ids"))
    assert tokens.corpus_windows(df, 4, chunk=16).count() == sum(range(40)) - 4
    assert made.value < 2 * 40  # a filter may ask once more for a row that it keeps, the sort and the total not at all
