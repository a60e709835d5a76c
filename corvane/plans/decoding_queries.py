"""Registered queries: next-token distribution filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.operators import decoding, ngrams
from corvane.plans import fixtures as fx
from corvane.plans.registry import query

SOFTMAX = """p AS (SELECT seq_id, token_id, logit, exp(logit / 0.8::DOUBLE - max(logit / 0.8::DOUBLE) OVER w) AS e FROM logits
  WINDOW w AS (PARTITION BY seq_id)), s AS (SELECT seq_id, token_id, e / sum(e) OVER (PARTITION BY seq_id) AS prob FROM p)"""


@query("g12_softmax_temperature", f"WITH {SOFTMAX} SELECT seq_id, token_id, round(prob, 6) AS prob FROM s", "logits")
def softmax_temperature(spark, sf):
    return decoding.softmax_temperature(fx.logits(spark, sf), 0.8).select(
        "seq_id", "token_id", F.round("prob", 6).alias("prob")
    )


@query("g13_topk_filter", """
SELECT seq_id, token_id, round(logit, 6) AS logit FROM (SELECT *, rank() OVER (PARTITION BY seq_id ORDER BY logit DESC) AS r
  FROM logits) WHERE r <= 10""", "logits")
def topk_filter(spark, sf):
    return decoding.topk_filter(fx.logits(spark, sf), 10).select(
        "seq_id", "token_id", F.round("logit", 6).alias("logit")
    )


CUMULATIVE = """p AS (SELECT seq_id, token_id, exp(logit - max(logit) OVER (PARTITION BY seq_id)) AS e FROM logits),
s AS (SELECT seq_id, token_id, e / sum(e) OVER (PARTITION BY seq_id) AS prob FROM p),
c AS (SELECT *, round(sum(prob) OVER (PARTITION BY seq_id ORDER BY prob DESC, token_id ROWS UNBOUNDED PRECEDING), 12) AS cum FROM s)"""


@query("g14_nucleus_filter", f"""
WITH {CUMULATIVE}, b AS (SELECT *, coalesce(lag(cum) OVER (PARTITION BY seq_id ORDER BY prob DESC, token_id), 0) AS before FROM c)
SELECT seq_id, token_id, round(prob, 6) AS prob, round(cum, 6) AS cum FROM b WHERE before <= 0.9""", "logits")
def nucleus_filter(spark, sf):
    return decoding.nucleus_filter(fx.logits(spark, sf), 0.9).select(
        "seq_id", "token_id", F.round("prob", 6).alias("prob"), F.round("cum", 6).alias("cum")
    )


@query("g14_nucleus_filter_strict", f"""
WITH {CUMULATIVE} SELECT seq_id, token_id, round(cum, 6) AS cum FROM c WHERE cum <= 0.9""", "logits")
def nucleus_filter_strict(spark, sf):
    return decoding.nucleus_filter(fx.logits(spark, sf), 0.9, "strict").select(
        "seq_id", "token_id", F.round("cum", 6).alias("cum")
    )


@query("g15_repetition_penalty", """
SELECT l.seq_id, l.token_id, round(CASE WHEN v.vec_id IS NULL THEN logit ELSE logit / 1.2::DOUBLE END, 6) AS logit
FROM logits l LEFT JOIN embeddings v ON v.vec_id = l.seq_id AND v.label = l.token_id""", "logits")
def repetition_penalty(spark, sf):
    seen = fx.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("seq_id"), F.col("label").alias("token_id")
    )
    return decoding.repetition_penalty(fx.logits(spark, sf), seen, 1.2).withColumn(
        "logit", F.round("logit", 6)
    )


@query("g16_min_length_mask", """
SELECT l.seq_id, l.token_id, round(logit, 6) AS logit FROM logits l JOIN embeddings v ON v.vec_id = l.seq_id
WHERE NOT (token_id = 2 AND label < 4)""", "logits")
def min_length_mask(spark, sf):
    generated = fx.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("seq_id"), F.col("label").alias("generated")
    )
    return decoding.min_length_mask(fx.logits(spark, sf), generated, 2, 4).withColumn(
        "logit", F.round("logit", 6)
    )


@query("g17_greedy_next", """
SELECT seq_id, arg_max(token_id, (logit, -token_id))::BIGINT AS token_id, round(max(logit), 6) AS logit FROM logits GROUP BY seq_id""", "logits")
def greedy_next(spark, sf):
    return decoding.greedy_next(fx.logits(spark, sf)).select(
        "seq_id", F.col("token_id").cast("bigint").alias("token_id"), F.round("logit", 6).alias("logit")
    )


@query("g17_greedy_next_char", """
SELECT ctx, nxt, n FROM (SELECT *, row_number() OVER (PARTITION BY ctx ORDER BY n DESC, nxt) AS r FROM transitions)
WHERE r = 1""", "transitions")
def greedy_next_char(spark, sf):
    return ngrams.greedy_next_char(ngrams.markov_train(fx.table(spark, sf, "documents"), 3))
