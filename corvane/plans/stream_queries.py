"""Registered queries: streams over the given tables, run until nothing is left."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.plans import fixtures as fx, oracle as O
from corvane.plans.registry import query
from corvane.plans.store_queries import _text_folder
from corvane.session import scratch_path
from corvane.streaming import activity as S, ingest, keyed

DELAY = "60 days"  # longer than the data, so that no row counts as late


def _event_stream(spark, sf, delay=DELAY):
    stream = S.read_stream(spark, sf, "events.parquet")
    return S.with_event_time(fx.as_activity(stream), delay=delay)


def _minute(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


@query("i1_stream_ingest", f"""
SELECT source, sum(length({O.norm('text')}) + 1)::BIGINT AS chars, 'txt' AS data_type FROM documents GROUP BY source""")
def stream_ingest(spark, sf):
    base = scratch_path(spark, "ingest")
    ingest.stream_ingest(spark, _text_folder(spark, sf), base, fx.validator())
    entries = spark.read.parquet(f"{base}/entries")
    return entries.groupBy(F.regexp_extract("source", "source=([^/]+)/", 1).alias("source"), "data_type").agg(
        F.sum(F.length("content") + 1).alias("chars")
    )


@query("i2_stream_activity", """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS entry_id, event_type AS action, count(*) AS events
FROM events GROUP BY ALL""")
def stream_activity(spark, sf):
    path = scratch_path(spark, "activity")
    S.run_available(S.activity(_event_stream(spark, sf)), path, "update")
    final = S.updated_result(spark, path, "window_start", "entry_id", "action")
    return final.withColumn("window_start", _minute("window_start"))


LIMITS = [("click", 3600, 1), ("view", 86400, 2)]
DEFAULTS = [(86400, 4)]


@query("i3_rate_limit_breaches", """
SELECT user_id, 'click' AS action, 3600 AS seconds, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n
FROM events WHERE event_type = 'click' GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT user_id, 'view', 86400, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S'), count(*)
FROM events WHERE event_type = 'view' GROUP BY ALL HAVING count(*) > 2
UNION ALL SELECT user_id, '*', 86400, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S'), count(*)
FROM events GROUP BY ALL HAVING count(*) > 4""")
def rate_limit_breaches(spark, sf):
    events = S.with_event_time(fx.activity_events(spark, sf))
    found = S.rate_limit_breaches(events, LIMITS, DEFAULTS)
    return found.withColumn("window_start", _minute("window_start"))


@query("i3_rate_limit_breaches_sliding", """
WITH s AS (SELECT user_id, ts, unnest(range(0, 10)) AS k FROM events WHERE event_type = 'click'),
w AS (SELECT user_id, to_timestamp(floor(epoch(ts) / 360) * 360 - k * 360) AS st FROM s)
SELECT user_id, 'click' AS action, 3600 AS seconds, strftime(st AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n
FROM w GROUP BY user_id, st HAVING count(*) > 1""")
def rate_limit_breaches_sliding(spark, sf):
    events = S.with_event_time(fx.activity_events(spark, sf))
    found = S.rate_limit_breaches(events, [("click", 3600, 1)], [], sliding=True)
    return found.withColumn("window_start", _minute("window_start"))


@query("i4_collab_sessions", """
WITH e AS (SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS entry_id, user_id, ts FROM events),
g AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w < 86400000000 THEN 0 ELSE 1 END AS new FROM e
  WINDOW w AS (PARTITION BY entry_id, user_id ORDER BY ts)),
s AS (SELECT *, sum(new) OVER (PARTITION BY entry_id, user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT entry_id, user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start,
  strftime(max(ts) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS session_end, count(*) AS events
FROM s GROUP BY entry_id, user_id, k""")
def collab_sessions(spark, sf):
    events = S.with_event_time(fx.activity_events(spark, sf))
    return S.collab_sessions(events, "24 hours").select(
        "entry_id", "user_id", _minute("session_start").alias("session_start"),
        _minute("session_end").alias("session_end"), "events",
    )


@query("i5_latest_progress", """
SELECT user_id, action, value FROM (SELECT user_id, event_type AS action, value,
  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def latest_progress(spark, sf):
    path = scratch_path(spark, "progress")
    stream = S.latest_progress(_event_stream(spark, sf), "user_id", "action", "value")
    S.run_available(stream, path, "update")
    return S.updated_result(spark, path, "user_id").select("user_id", "action", "value")


@query("i6_stream_dedup", """
SELECT DISTINCT md5(user_id || ' ' || event_type || ' ' || floor(value)::BIGINT) AS content_md5 FROM events""")
def stream_dedup(spark, sf):
    path = scratch_path(spark, "dedup")
    stream = _event_stream(spark, sf).withColumn(
        "content", F.concat_ws(" ", "user_id", "action", F.floor("value").cast("string"))
    )
    S.run_available(S.drop_duplicates(stream, "content").select("content_md5"), path)
    return S.appended_result(spark, path)


SHORT = "6 hours"
SLICES = 4


FILE_ROWS = 10_000  # at least, in a file of a slice of several files


def _timed_stream(spark, sf):
    """The events as files in the order of time, with a short watermark.

    A slice of time is a batch: all slices have the same number of files and a batch takes that many. Were
    the files of a slice several batches, rows would come behind the watermark and be lost, and the
    number of batches would grow with the table.
    """
    folder = scratch_path(spark, "events")
    events = fx.table(spark, sf, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts = events.select(at.alias("us")).approxQuantile("us", [i / SLICES for i in range(1, SLICES)], 0.01)
    slices = []
    for low, high in zip([None, *cuts], [*cuts, None]):
        kept = F.lit(True) if low is None else at > int(low)
        slices.append(kept if high is None else kept & (at <= int(high)))
    fewest = min(events.agg(*[F.count_if(kept) for kept in slices]).first())
    files = max(1, min(spark.sparkContext.defaultParallelism, fewest // FILE_ROWS))
    for kept in slices:
        events.filter(kept).repartition(files).write.mode("append").parquet(folder)
    stream = S.read_stream(spark, folder, "*.parquet", files_per_trigger=files)
    return S.with_event_time(fx.as_activity(stream), delay=SHORT)


CEILINGS = {"click": (86400, 2), "view": (43200, 1), "*": (86400, 5)}


def _moving(action: str, seconds: int, most: int) -> str:
    kept = "TRUE" if action == "*" else f"event_type = '{action}'"
    return f"""SELECT user_id, '{action}' AS action, event_id, ts, n FROM (
SELECT *, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL {seconds * 1_000_000 - 1} MICROSECONDS PRECEDING
  AND CURRENT ROW) AS n FROM events WHERE {kept}) WHERE n > {most}"""


PASSED = "epoch_ms({0}) < (SELECT epoch_ms(max(ts)) FROM events) - 21600000"


@query("i3_rate_limit_moving", f"""
SELECT user_id, action, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, n
FROM ({' UNION ALL '.join(_moving(a, *r) for a, r in CEILINGS.items())}) WHERE {PASSED.format('ts')}""")
def rate_limit_moving(spark, sf):
    path = scratch_path(spark, "limits")
    S.run_available(keyed.moving_breaches(_timed_stream(spark, sf), CEILINGS), path)
    return S.appended_result(spark, path).withColumn("ts", _minute("ts"))


@query("i4_collab_rooms", f"""
WITH e AS (SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS entry_id, user_id, event_id, ts, event_type AS action FROM events),
g AS (SELECT *, CASE WHEN lag(action) OVER w = 'error' OR epoch_us(ts) - lag(epoch_us(ts)) OVER w >= 28800000000 THEN 1 ELSE 0 END AS new
  FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
c AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM g),
z AS (SELECT user_id, k, max(ts) AS last, bool_or(action = 'error') AS gone FROM c GROUP BY user_id, k),
r AS (SELECT entry_id, user_id, k, min(ts) AS start, count(*) AS joins FROM c WHERE action = 'signup' GROUP BY ALL),
s AS (SELECT entry_id, user_id, start, CASE WHEN gone THEN last ELSE last + INTERVAL 8 HOURS END AS stop, joins,
  CASE WHEN gone THEN 'leave' ELSE 'timeout' END AS ended_by FROM r JOIN z USING (user_id, k))
SELECT entry_id, user_id, strftime(start, '%Y-%m-%d %H:%M:%S') AS session_start,
  strftime(stop, '%Y-%m-%d %H:%M:%S') AS session_end, joins, ended_by FROM s WHERE {PASSED.format('stop')}""")
def collab_rooms(spark, sf):
    """A sign-up stands for joining an entry's room, an error for the end of the connection."""
    path = scratch_path(spark, "rooms")
    S.run_available(keyed.room_sessions(_timed_stream(spark, sf), "signup", "error", 8 * 3600), path)
    return S.appended_result(spark, path).withColumn("session_start", _minute("session_start")).withColumn(
        "session_end", _minute("session_end"))
