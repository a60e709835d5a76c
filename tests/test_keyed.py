"""Keyed streams against plain Python, over files whose rows are out of order and tie."""

import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corvane.plans import stream_queries
from corvane.streaming import activity as S, keyed

BASE = pd.Timestamp("2024-01-01")
DELAY = 600  # seconds


@pytest.fixture()
def stream(spark, tmp_path):
    draw = random.Random(5)
    rows = [(i, i * 20 + draw.randrange(0, 500), draw.randrange(4), draw.choice(["join", "leave", "edit", "view", "view"]),
             draw.choice([None, 1, 2, 3])) for i in range(600)]
    rows += [(1000 + i, rows[i][1], *rows[i][2:]) for i in range(0, 600, 9)]  # equal times
    rows.sort(key=lambda r: r[1] // 500)
    folder = tmp_path / "in"
    folder.mkdir()
    frame = pd.DataFrame(rows, columns=["event_id", "s", "user_id", "action", "entry_id"]).astype({"entry_id": "Int64"})
    frame["ts"] = BASE + pd.to_timedelta(frame["s"], unit="s")
    for part in range(4):
        at = len(frame) // 4
        chunk = frame[part * at:(part + 1) * at if part < 3 else None]
        chunk.drop(columns="s").to_parquet(folder / f"part{part}.parquet", coerce_timestamps="us")
    events = S.with_event_time(S.read_stream(spark, str(folder), "*.parquet", files_per_trigger=1), delay=f"{DELAY} seconds")
    return rows, events, str(tmp_path / "out")


def seconds(value):
    return int((pd.Timestamp(value) - BASE).total_seconds())


def test_moving_limits_hold_at_every_event(spark, stream):
    rows, events, out = stream
    limits = {"view": (300, 2), "*": (120, 3)}
    S.run_available(keyed.moving_breaches(events, limits), out)
    passed = max(r[1] for r in rows) - DELAY
    want = []
    for action, (width, most) in limits.items():
        kept = [r for r in rows if action in (r[3], "*")]
        for i, s, user, *_ in kept:
            n = sum(r[2] == user and s - width < r[1] <= s for r in kept)
            if n > most and s < passed:
                want.append((user, action, i, s, n))
    got = [(r.user_id, r.action, r.event_id, seconds(r.ts), r.n) for r in S.appended_result(spark, out).collect()]
    assert want and sorted(got) == sorted(want)


def test_rooms_are_left_by_event_or_time(spark, stream):
    rows, events, out = stream
    wait = 400
    S.run_available(keyed.room_sessions(events, "join", "leave", wait), out)
    passed = max(r[1] for r in rows) - DELAY
    want = []
    for user in range(4):
        rooms, last = {}, None
        mine = sorted((s, i, action, entry) for i, s, u, action, entry in rows if u == user and (entry is not None or action != "join"))
        for s, _, action, entry in [*mine, (10**9, 0, "end", None)]:
            if last is not None and s >= last + wait:
                want += [(r, user, a, last + wait, n, "timeout") for r, (a, n) in rooms.items()]
                rooms = {}
            last = s
            if action == "leave":
                want += [(r, user, a, s, n, "leave") for r, (a, n) in rooms.items()]
                rooms = {}
            elif action == "join":
                first, n = rooms.get(entry, (s, 0))
                rooms[entry] = (first, n + 1)
    want = [w for w in want if w[3] < passed]
    got = [(r.entry_id, r.user_id, seconds(r.session_start), seconds(r.session_end), r.joins, r.ended_by)
           for r in S.appended_result(spark, out).collect()]
    assert {w[5] for w in want} == {"leave", "timeout"} and sorted(got) == sorted(want)


def test_users_share_calls(spark, tmp_path):
    """Many users of one event each: a call per bucket, whatever the number of users; null users and ids stay."""
    folder = tmp_path / "in"
    folder.mkdir()
    users = 20000
    frame = pd.DataFrame({
        "event_id": pd.array([None, *range(1, 2 * users + 4)], "Int64"),
        "user_id": pd.array([None] * 4 + list(range(users)) * 2, "Int64"), "action": "view", "entry_id": pd.array([1] * (2 * users + 4), "Int64"),
        "ts": BASE + pd.to_timedelta([1] * 4 + [10] * users + [20] * users, unit="s")})
    frame.loc[len(frame)] = [10**6, 0, "view", 1, BASE + pd.to_timedelta(10**6, unit="s")]
    frame.to_parquet(folder / "part.parquet", coerce_timestamps="us")
    events = S.with_event_time(S.read_stream(spark, str(folder), "*.parquet"), delay=f"{DELAY} seconds")
    began = time.monotonic()
    S.run_available(keyed.moving_breaches(events, {"view": (60, 1)}), str(tmp_path / "out"))
    took = time.monotonic() - began
    got = S.appended_result(spark, str(tmp_path / "out"))
    assert got.filter("user_id is null").count() == 4 and got.filter("event_id is null").count() == 1
    assert got.count() == users + 4 and got.filter("user_id is not null and n <> 2").count() == 0
    assert took < 60


def test_a_slice_of_time_is_one_batch(spark, tmp_path, monkeypatch):
    """Events in files that all span the whole time: none is late, and the batches do not grow with the files."""
    monkeypatch.setattr(stream_queries, "FILE_ROWS", 50)
    spark.range(4000).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 1000 * 600).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).alias("user_id"), F.lit("click").alias("event_type"), F.lit(1.0).alias("value"), F.lit('{"k": 1}').alias("props"),
    ).repartition(6, "user_id").write.parquet(str(tmp_path / "events.parquet"))
    got = stream_queries.rate_limit_moving(spark, str(tmp_path))
    rows = [(i, i % 7, i % 1000 * 600) for i in range(4000)]
    want = {(i, n) for i, user, at in rows if at < 999 * 600 - 6 * 3600
            for n in [sum(u == user and at - 86400 < t <= at for _, u, t in rows)] if n > 2}
    assert {(r.event_id, r.n) for r in got.filter("action = 'click'").collect()} == want
