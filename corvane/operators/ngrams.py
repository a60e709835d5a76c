"""Character n-gram (Markov) model as a table of transitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def char_grams(
    df: DataFrame, order: int, text: str = "text", id_col: str | None = None
) -> DataFrame:
    """One row per (context + next character), as UTF-32 bytes in ``gram``.

    With four bytes per character a slice is a constant-time byte range; ``substr`` on
    UTF-8 would scan the text for each position. Texts of at most ``order`` characters
    give nothing.
    """
    keep = [F.col(id_col)] if id_col else []
    wide = df.filter(F.length(text) > order).select(
        *keep, F.encode(text, "UTF-32").alias("_w")
    )
    count = F.expr(f"int(octet_length(_w) / 4) - {order}")
    at = wide.select(*keep, "_w", F.explode(F.sequence(F.lit(0), count - 1)).alias("_i"))
    return at.select(
        *keep, F.substring("_w", F.col("_i") * 4 + 1, F.lit(4 * (order + 1))).alias("gram")
    )


def _split_gram(counts: DataFrame, order: int) -> DataFrame:
    whole = F.decode("gram", "UTF-32")
    return counts.select(
        F.substring(whole, 1, order).alias("ctx"),
        F.substring(whole, order + 1, 1).alias("nxt"),
        "n",
    )


def markov_train(df: DataFrame, order: int = 3, text: str = "text") -> DataFrame:
    """(ctx, nxt, n): how often a character follows a context of ``order`` characters."""
    if order < 1:
        raise ValueError("order must be at least 1")
    counts = char_grams(df, order, text).groupBy("gram").agg(F.count("*").alias("n"))
    return _split_gram(counts, order)


def require_transitions(transitions: DataFrame) -> DataFrame:
    """The same frame; an empty table is an error (texts too short)."""
    if transitions.limit(1).count() == 0:
        raise ValueError("no transitions learned, texts may be too short")
    return transitions


def markov_stats(transitions: DataFrame) -> DataFrame:
    """One row: contexts, total transitions and their average per context."""
    per_context = transitions.groupBy("ctx").agg(F.sum("n").alias("n"))
    return per_context.agg(
        F.count("*").alias("contexts"), F.sum("n").alias("total_transitions")
    ).select(
        "contexts",
        F.coalesce("total_transitions", F.lit(0)).alias("total_transitions"),
        F.try_divide(F.col("total_transitions"), F.col("contexts")).alias(
            "avg_transitions_per_context"
        ),
    )


def markov_score(
    df: DataFrame, transitions: DataFrame, order: int = 3, alpha: float = 1.0,
    id_col: str = "id", text: str = "text",
) -> DataFrame:
    """(id, n_chars, log_likelihood, perplexity) with additive smoothing.

    Grams are counted per text on the map side first, then meet the transition table in
    an equi-join; a frequent gram is one row per text and its side can be split by
    adaptive execution.
    """
    letters = transitions.agg(F.countDistinct("nxt").alias("v")).select("v").scalar()
    totals = transitions.groupBy("ctx").agg(F.sum("n").alias("ctx_n"))
    logs = (
        transitions.join(totals, "ctx")
        .select(
            F.encode(F.concat("ctx", "nxt"), "UTF-32").alias("gram"),
            F.log((F.col("n") + alpha) / (F.col("ctx_n") + F.lit(alpha) * letters)).alias("logp"),
        )
    )
    # a gram whose context exists but was never followed by this character
    context_logs = totals.select(
        F.encode("ctx", "UTF-32").alias("cgram"),
        F.log(F.lit(alpha) / (F.col("ctx_n") + F.lit(alpha) * letters)).alias("logc"),
    )
    unseen = F.log(F.lit(1.0) / letters)
    grams = (
        char_grams(df, order, text, id_col)
        .groupBy(F.col(id_col).alias("id"), "gram")
        .agg(F.count("*").alias("c"))
    )
    known = grams.join(logs, "gram", "left")
    missing = known.filter(F.col("logp").isNull()).select(
        "id", "c", F.substring("gram", 1, 4 * order).alias("cgram")
    )
    late = missing.join(context_logs, "cgram", "left").select(
        "id", "c", F.coalesce("logc", unseen).alias("logp")
    )
    scored = known.filter(F.col("logp").isNotNull()).select("id", "c", "logp").unionByName(late)
    return (
        scored.groupBy("id")
        .agg(F.sum("c").alias("n_chars"), F.sum(F.col("c") * F.col("logp")).alias("log_likelihood"))
        .withColumn("perplexity", F.exp(-F.col("log_likelihood") / F.col("n_chars")))
    )


def greedy_next_char(transitions: DataFrame) -> DataFrame:
    """(ctx, nxt, n): the most frequent next character, ties by character."""
    best = F.min(F.struct((-F.col("n")).alias("_neg"), F.col("nxt")))
    return transitions.groupBy("ctx").agg(best.alias("b")).select(
        "ctx", F.col("b.nxt").alias("nxt"), (-F.col("b._neg")).alias("n")
    )
