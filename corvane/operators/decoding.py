"""Next-token distribution filters on a table (seq_id, token_id, logit).

Windows are per sequence; a sequence has one row per vocabulary entry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

def _seq():
    return Window.partitionBy("seq_id")


def softmax(logit: Column | str = "logit", temperature: float = 1.0) -> Column:
    """Probability within the sequence, shifted by the maximum before exponentiation."""
    scaled = (F.col(logit) if isinstance(logit, str) else logit) / F.lit(float(temperature))
    top = F.max(scaled).over(_seq())
    weight = F.exp(scaled - top)
    return weight / F.sum(weight).over(_seq())


def softmax_temperature(logits: DataFrame, temperature: float = 1.0) -> DataFrame:
    scaled = logits.withColumn("_x", F.col("logit") / F.lit(float(temperature)))
    shifted = scaled.withColumn("_w", F.exp(F.col("_x") - F.max("_x").over(_seq())))
    return shifted.withColumn("prob", F.col("_w") / F.sum("_w").over(_seq())).drop("_x", "_w")


def topk_filter(logits: DataFrame, k: int) -> DataFrame:
    """Tokens whose logit is at least the k-th largest; ties are kept."""
    order = _seq().orderBy(F.col("logit").desc())
    return logits.withColumn("_r", F.rank().over(order)).filter(F.col("_r") <= k).drop("_r")


def nucleus_filter(logits: DataFrame, p: float, mode: str = "crossing") -> DataFrame:
    """Smallest head of the distribution with mass p: adds ``prob`` and ``cum``.

    ``crossing`` keeps the token that crosses p (and always the first one); ``strict``
    keeps only tokens with cumulative probability <= p, possibly none.
    """
    if mode not in ("crossing", "strict"):
        raise ValueError(f"unknown mode {mode!r}")
    order = _seq().orderBy(F.col("prob").desc(), F.col("token_id"))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scored = softmax_temperature(logits).withColumn("cum", F.round(F.sum("prob").over(upto), 12))
    if mode == "strict":
        return scored.filter(F.col("cum") <= p)
    previous = F.lag("cum", 1, 0.0).over(order)
    return scored.withColumn("_before", previous).filter(F.col("_before") <= p).drop("_before")


def repetition_penalty(logits: DataFrame, seen: DataFrame, penalty: float) -> DataFrame:
    """Divide the logit of every token already in the sequence.

    Negative logits are divided too, which raises them; that is the rule as given.
    """
    marks = seen.select("seq_id", "token_id", F.lit(True).alias("_seen")).distinct()
    return logits.join(marks, ["seq_id", "token_id"], "left").select(
        "seq_id", "token_id",
        F.when(F.col("_seen"), F.col("logit") / penalty).otherwise(F.col("logit")).alias("logit"),
    )


def min_length_mask(
    logits: DataFrame, generated: DataFrame, eos_id: int, min_length: int
) -> DataFrame:
    """Drop the end token of sequences shorter than ``min_length`` (probability zero)."""
    short = generated.filter(F.col("generated") < min_length).select(
        "seq_id", F.lit(eos_id).alias("token_id")
    )
    return logits.join(short, ["seq_id", "token_id"], "left_anti")


def greedy_next(logits: DataFrame) -> DataFrame:
    """(seq_id, token_id, logit): the largest logit, ties by token id."""
    best = F.max(F.struct("logit", (-F.col("token_id")).alias("_neg")))
    return logits.groupBy("seq_id").agg(best.alias("b")).select(
        "seq_id", (-F.col("b._neg")).alias("token_id"), F.col("b.logit").alias("logit")
    )
