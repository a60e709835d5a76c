"""Store statistics, log statistics, training history and small decision tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corvane.functions.lexicons import INTENTS
from corvane.functions.ordering import with_group_carry, with_running_total


def count_by_type(entries: DataFrame) -> DataFrame:
    return entries.groupBy("data_type").agg(F.count("*").alias("entries"))


def quality_histogram(entries: DataFrame, bins: int = 20, value: str = "quality_score") -> DataFrame:
    """(bin, low, high, entries): equal-width bins, the last closed, empty bins included."""
    scores = entries.select(F.col(value).alias("x"))
    low = scores.agg(F.min("x").alias("v")).select("v").scalar()
    high = scores.agg(F.max("x").alias("v")).select("v").scalar()
    width = (high - low) / F.lit(bins)
    at = F.when(width > 0, F.floor((F.col("x") - low) / width)).otherwise(0)
    counted = (
        scores.select(F.least(at, F.lit(bins - 1)).cast("bigint").alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("entries"))
    )
    frame = entries.sparkSession.range(bins).select(F.col("id").alias("bin"))
    return frame.join(counted, "bin", "left").select(
        "bin",
        F.round(low + F.col("bin") * width, 6).alias("low"),
        F.round(low + (F.col("bin") + 1) * width, 6).alias("high"),
        F.coalesce("entries", F.lit(0)).alias("entries"),
    )


def store_summary(
    entries: DataFrame, sentences: DataFrame, flagged: DataFrame, questions: DataFrame
) -> DataFrame:
    """One row of totals; ``questions`` has one row per question with its ``intent``."""
    by_intent = [
        F.count_if(F.col("intent") == name).alias(f"n_{name}") for name in INTENTS
    ]
    asked = questions.agg(F.count("*").alias("questions"), *by_intent)
    totals = entries.agg(
        F.count_if("validated").alias("validated_entries"),
        F.coalesce(F.avg("quality_score"), F.lit(0.0)).alias("avg_quality"),
    )
    return totals.select(
        sentences.agg(F.count("*").alias("c")).select("c").scalar().alias("sentences"),
        "validated_entries", F.round("avg_quality", 6).alias("avg_quality"),
        flagged.agg(F.count("*").alias("c")).select("c").scalar().alias("anomalies"),
        *[
            asked.select(c).scalar().alias(c)
            for c in ["questions", *(f"n_{name}" for name in INTENTS)]
        ],
    )


# Fields of a question's log line.
LOG_QUESTION = r"Kysymys: (.*), Intentio: ([a-z]+), Viive: ([0-9.]+)s, Vastauksia: ([0-9]+)"


def question_log(lines: DataFrame, line: str = "value") -> DataFrame:
    """Question lines of a log as (question, intent, latency, answers)."""
    found = lines.filter(F.col(line).rlike(LOG_QUESTION))
    return found.select(
        F.regexp_extract(line, LOG_QUESTION, 1).alias("question"),
        F.regexp_extract(line, LOG_QUESTION, 2).alias("intent"),
        F.regexp_extract(line, LOG_QUESTION, 3).cast("double").alias("latency"),
        F.regexp_extract(line, LOG_QUESTION, 4).cast("bigint").alias("answers"),
    )


def intent_stats(questions: DataFrame) -> DataFrame:
    """(intent, questions) for all five intents, absent ones with 0."""
    spark = questions.sparkSession
    every = spark.createDataFrame([(i,) for i in INTENTS], "intent string")
    counted = questions.groupBy("intent").agg(F.count("*").alias("questions"))
    return every.join(counted, "intent", "left").select(
        "intent", F.coalesce("questions", F.lit(0)).alias("questions")
    )


def latency_stats(questions: DataFrame) -> DataFrame:
    """One row: average, median (the lower of two middle values) and maximum latency, average answers.

    The median is exact: questions are counted per latency first, and a running total over the
    sorted distinct latencies finds the middle. Null latencies are left out of it.
    """
    counts = questions.filter(F.col("latency").isNotNull()).groupBy("latency").agg(F.count("*").alias("_n"))
    placed = with_running_total(counts, "_n", F.col("latency"), name="_before")
    total = placed.agg(F.sum("_n").alias("n")).select("n").scalar()
    middle = placed.filter((F.col("_before") + F.col("_n")) * 2 >= total).agg(F.min("latency").alias("m"))
    return questions.agg(
        F.count("*").alias("questions"),
        F.round(F.avg("latency"), 6).alias("avg_latency"),
        F.max("latency").alias("max_latency"),
        F.round(F.avg("answers"), 6).alias("avg_answers"),
    ).select(
        "questions", "avg_latency", middle.select("m").scalar().alias("median_latency"), "max_latency", "avg_answers")


def corpus_stats(df: DataFrame, suffix: str, length: str, min_chars: int) -> DataFrame:
    """Per suffix: files, texts that are long enough, texts filtered out."""
    enough = F.col(length) >= min_chars
    return df.groupBy(suffix).agg(
        F.count("*").alias("files"), F.count_if(enough).alias("valid"),
        F.count_if(~enough).alias("filtered"),
    )


def loss_by_epoch(log: DataFrame, run: str, step: str, loss: str, steps_per_epoch: int) -> DataFrame:
    """Average and summed loss per run and epoch."""
    epoch = F.floor(F.col(step) / steps_per_epoch)
    return log.groupBy(F.col(run).alias("run"), epoch.alias("epoch")).agg(
        F.count("*").alias("steps"), F.avg(loss).alias("avg_loss"), F.sum(loss).alias("sum_loss")
    )


def audit_counts(audit: DataFrame, ts: str = "ts") -> DataFrame:
    return audit.groupBy("user_id", "action", F.to_date(ts).alias("day")).agg(
        F.count("*").alias("actions")
    )


def running_best(log: DataFrame, run: str, step: str, loss: str) -> DataFrame:
    """Rows whose loss is strictly below every earlier loss of the run."""
    return with_group_carry(log, run, step, step, loss, "min", "best_before").filter(
        F.col("best_before").isNull() | (F.col(loss) < F.col("best_before"))
    )


# --- small decision tables -------------------------------------------------------------


def decision_score(
    actions: DataFrame, gain: str = "gain", cost: str = "cost", risk: str = "risk"
) -> DataFrame:
    """Score gain*2 - cost/100000 - risk*1.5 for every action."""
    score = F.col(gain) * 2 - F.col(cost) / 100000 - F.col(risk) * 1.5
    return actions.withColumn("score", score)


def best_decision(scored: DataFrame, key: str, *groups: str) -> DataFrame:
    """The action with the largest score (per group), ties by key."""
    top = F.max_by(F.struct(key, "score"), F.struct("score", key)).alias("b")
    picked = scored.groupBy(*groups).agg(top) if groups else scored.agg(top)
    return picked.select(*groups, F.col(f"b.{key}").alias(key), F.col("b.score").alias("score"))


def confidence_track(confidence: Column) -> Column:
    return (
        F.when(confidence >= 80, "high").when(confidence >= 50, "medium").otherwise("low")
    )


def evidence_confidence(sources: Column, inferred: Column | None = None) -> Column:
    level = F.when(sources >= 2, "HIGH").when(sources == 1, "MEDIUM").otherwise("LOW")
    return level if inferred is None else F.when(inferred, "LOW").otherwise(level)


def beacon_detection(
    events: DataFrame, source: str, ts: str, tie: str, period: float = 3600.0,
    tolerance: float = 0.1,
) -> DataFrame:
    """Per source: gaps between events and how many lie within period +- tolerance."""
    seconds = events.select(
        F.col(source).alias("source"), F.col(tie).alias("tie"),
        (F.unix_micros(F.col(ts).cast("timestamp")) / 1e6).alias("at"),
    )
    gaps = with_group_carry(seconds, "source", "at", "tie", "at", "last", "previous")
    gap = F.col("at") - F.col("previous")
    near = F.abs(gap - period) <= period * tolerance
    return (
        gaps.groupBy("source")
        .agg(F.count("previous").alias("gaps"), F.count_if(near).alias("near_period"))
        .withColumn("share", F.round(F.try_divide(F.col("near_period"), F.col("gaps")), 6))
    )


def evidence_decay(values: DataFrame, key: str, now: str, later: str, top: int = 3) -> DataFrame:
    """The kinds that lose most value, largest loss first."""
    return (
        values.withColumn("loss", F.col(now) - F.col(later))
        .orderBy(F.col("loss").desc(), F.col(key))
        .limit(top)
    )


def risk_matrix(risks: DataFrame, likelihood: str = "likelihood", impact: str = "impact") -> DataFrame:
    """Score = likelihood * impact, and the dense rank of the score.

    Scores take at most 25 values, so ranks come from the distinct scores.
    """
    from pyspark.sql import Window

    scored = risks.withColumn("score", F.col(likelihood) * F.col(impact))
    levels = scored.select("score").distinct()
    ranks = levels.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("score").desc()))
    )
    return scored.join(ranks, "score")


def mean_time(
    events: DataFrame, key: str, start: Column, end: Column, target_seconds: float
) -> DataFrame:
    """Mean seconds from the first start to the first later end per key, against a target."""
    begun = events.groupBy(key).agg(F.min(start).alias("begin"))
    ended = (
        events.join(begun, key)
        .filter(end > F.col("begin"))
        .groupBy(key)
        .agg(F.min(end).alias("finish"), F.first("begin").alias("begin"))
    )
    return ended.agg(
        F.count("*").alias("cases"), F.avg(F.col("finish") - F.col("begin")).alias("mean_seconds")
    ).withColumn("on_target", F.col("mean_seconds") < target_seconds)


def sum_check(shares: DataFrame, key: str, share: str, total: float = 100.0, tol: float = 1e-6) -> DataFrame:
    """Sum of shares per group and whether it reaches the expected total."""
    return shares.groupBy(key).agg(F.sum(share).alias("total")).withColumn(
        "ok", F.abs(F.col("total") - total) <= tol
    )
