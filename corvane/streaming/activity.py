"""Event streams: activity counts, limits, sessions, progress and duplicate removal.

Every transformation works on a batch and on a stream. Streams need ``ts`` as a timestamp
and a watermark; rows later than the watermark are dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from corvane.functions.lexicons import DEFAULT_LIMITS, RATE_LIMITS
from corvane.functions.ordering import with_group_carry, with_running_total
from corvane.session import scratch_path


def read_stream(
    spark: SparkSession, folder: str, pattern: str, files_per_trigger: int | None = None
) -> DataFrame:
    """A Parquet folder as a stream; the schema is read from the present files."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def with_event_time(events: DataFrame, ts: str = "ts", delay: str | None = None) -> DataFrame:
    """``ts`` as a timestamp (UTC session), with a watermark when ``delay`` is given."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp"))
    return timed.withWatermark(ts, delay) if delay else timed


def activity(events: DataFrame, width: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Events per entry, action and window."""
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    return events.groupBy(window.alias("w"), "entry_id", "action").agg(
        F.count("*").alias("events")
    ).select(F.col("w.start").alias("window_start"), "entry_id", "action", "events")


def rate_limit_breaches(
    events: DataFrame, limits: Sequence[tuple[str, int, int]] = tuple(RATE_LIMITS),
    default_limits: Sequence[tuple[int, int]] = tuple(DEFAULT_LIMITS),
    sliding: bool = False,
) -> DataFrame:
    """Windows in which a user exceeds a ceiling: (user_id, action, seconds, start, n).

    Ceilings of an action count that action; the default ceilings count everything and
    report the action ``*``. ``sliding`` moves each window by a tenth of its width.
    """
    found: DataFrame | None = None
    by_width: dict[int, list[tuple[str, int]]] = {}
    for action, seconds, limit in limits:
        by_width.setdefault(seconds, []).append((action, limit))

    def window(seconds: int):
        width = f"{seconds} seconds"
        return F.window("ts", width, f"{max(1, seconds // 10)} seconds") if sliding else F.window("ts", width)

    for seconds, rules in sorted(by_width.items()):
        ceiling = F.coalesce(*[F.when(F.col("action") == a, F.lit(n)) for a, n in rules])
        part = (
            events.filter(F.col("action").isin([a for a, _ in rules]))
            .groupBy(window(seconds).alias("w"), "user_id", "action")
            .agg(F.count("*").alias("n"))
            .filter(F.col("n") > ceiling)
            .select("user_id", "action", F.lit(seconds).alias("seconds"),
                    F.col("w.start").alias("window_start"), "n")
        )
        found = part if found is None else found.unionByName(part)
    for seconds, limit in default_limits:
        part = (
            events.groupBy(window(seconds).alias("w"), "user_id")
            .agg(F.count("*").alias("n"))
            .filter(F.col("n") > limit)
            .select("user_id", F.lit("*").alias("action"), F.lit(seconds).alias("seconds"),
                    F.col("w.start").alias("window_start"), "n")
        )
        found = part if found is None else found.unionByName(part)
    return found


def collab_sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Sessions per entry and user: (entry_id, user_id, start, end, events).

    A stream uses session windows. A batch finds session starts in chunks of the sorted
    events and numbers them by a running total, so one busy room is not one task.
    """
    if not events.isStreaming:
        return _batch_sessions(events, gap)
    return events.groupBy(
        F.session_window("ts", gap).alias("w"), "entry_id", "user_id"
    ).agg(F.count("*").alias("events")).select(
        "entry_id", "user_id", F.col("w.start").alias("session_start"),
        F.col("w.end").alias("session_end"), "events",
    )


def _batch_sessions(events: DataFrame, gap: str) -> DataFrame:
    width = F.expr(f"INTERVAL {gap}")
    rows = events.select(
        F.struct("entry_id", "user_id").alias("room"), "ts", F.xxhash64(*events.columns).alias("tie")
    )
    seen = with_group_carry(rows, "room", "ts", "tie", "ts", "last", "previous")
    new = F.col("previous").isNull() | (F.col("ts") >= F.col("previous") + width)
    starts = seen.withColumn("new", new.cast("bigint"))
    numbered = with_running_total(
        starts, "new", F.col("room"), F.col("ts"), F.col("tie"), name="before"
    )
    return (
        numbered.groupBy("room", (F.col("before") + F.col("new")).alias("session"))
        .agg(F.min("ts").alias("session_start"), F.max("ts").alias("last"), F.count("*").alias("events"))
        .select(
            "room.entry_id", "room.user_id", "session_start",
            (F.col("last") + width).alias("session_end"), "events",
        )
    )


def latest_progress(events: DataFrame, key: str, *message: str, tie: str = "event_id") -> DataFrame:
    """The last message per key, by time and then by ``tie``."""
    last = F.max_by(F.struct("ts", *message), F.struct("ts", tie)).alias("m")
    return events.groupBy(key).agg(last).select(
        key, F.col("m.ts").alias("ts"), *[F.col(f"m.{c}").alias(c) for c in message]
    )


def drop_duplicates(events: DataFrame, content: str) -> DataFrame:
    """Rows whose content hash was not seen before (within the watermark on a stream)."""
    hashed = events.withColumn("content_md5", F.md5(content))
    if events.isStreaming:
        return hashed.dropDuplicatesWithinWatermark(["content_md5"])
    return hashed.dropDuplicates(["content_md5"])


def run_available(
    stream: DataFrame, path: str, mode: str = "append",
    each: Callable[[DataFrame, int], None] | None = None, partitions: int | None = None,
) -> None:
    """Process what is available and stop; batches land in ``path`` by batch number.

    A batch folder is overwritten on a retry, so a repeated batch leaves one copy.
    """

    def land(batch: DataFrame, number: int) -> None:
        if each is not None:
            each(batch, number)
        else:
            batch.write.mode("overwrite").parquet(f"{path}/data/batch={number}")

    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{path}/checkpoint")
        .foreachBatch(land)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def updated_result(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """Final rows of an update-mode run: the newest batch wins per key."""
    rows = spark.read.parquet(f"{path}/data")
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    last = F.max_by(F.struct(*values), "batch").alias("v")
    return rows.groupBy(*keys).agg(last).select(*keys, *[F.col(f"v.{c}").alias(c) for c in values])


def appended_result(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/data").drop("batch")


def run_path(spark: SparkSession, label: str) -> str:
    return scratch_path(spark, label)


