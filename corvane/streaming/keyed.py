"""Streams with keyed state and timers: limits over a window that moves, rooms joined and left.

Rows wait in the state until the watermark has passed them, and are then taken in the
order of time and id. So results do not depend on how rows fall into batches, and the state holds what
is younger than the watermark plus what the rule itself looks back on. Users share the state of a
bucket: a batch costs one call per bucket, not one per user.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

MICROS = 1000  # of a millisecond, the unit of watermarks and timers
BUCKETS = 512


def _keyed(events: DataFrame, *more: Column) -> DataFrame:
    """The events by bucket of users, with nulls of the ids in columns of their own; rows without time never pass."""
    return events.filter(F.col("ts").isNotNull()).select(
        F.pmod(F.xxhash64("user_id"), F.lit(BUCKETS)).cast("int").alias("bucket"), "ts", F.unix_micros("ts").alias("us"),
        F.coalesce("user_id", F.lit(0)).cast("bigint").alias("user"), F.col("user_id").isNull().alias("no_user"),
        F.coalesce("event_id", F.lit(0)).cast("bigint").alias("event"), F.col("event_id").isNull().alias("no_event"), *more)


def _held(state: GroupState, frames: Iterator[pd.DataFrame], types: Mapping[str, str]) -> dict[str, np.ndarray]:
    """The columns of the rows in the state and of the new ones; the state begins with these columns."""
    old = list(state.get)[:len(types)] if state.exists else [[] for _ in types]
    new = list(frames)
    return {
        name: np.concatenate([np.asarray(list(had), kind), *(f[name].to_numpy(kind) for f in new)])
        for (name, kind), had in zip(types.items(), old)}


def _passed(us: np.ndarray, state: GroupState) -> np.ndarray:
    return us // MICROS < state.getCurrentWatermarkMs()


def _keep(state: GroupState, kept: tuple[list, ...], micros: int | None) -> None:
    """The state and a timer for ``micros``, or no state if that is None."""
    if micros is not None:
        state.update(kept)
        state.setTimeoutTimestamp(max(micros // MICROS, state.getCurrentWatermarkMs(), 1))
    elif state.exists:
        state.remove()


def _up_to(who: np.ndarray, us: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """For each row how many rows of smaller users, or of its user and not later than its ``limit``, there are."""
    n = len(us)
    asks = np.repeat([False, True], n)
    order = np.lexsort((asks, np.concatenate([us, limit]), np.concatenate([who, who])))
    counts = np.empty(2 * n, np.int64)
    counts[order] = np.cumsum(~asks[order])
    return counts[n:]


def moving_breaches(events: DataFrame, limits: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Events with which a user exceeds a ceiling: (user_id, action, event_id, ts, n).

    ``limits`` maps an action to (seconds, most events); ``*`` counts all actions. ``n`` events of
    the user lie in the ``seconds`` up to and with the event. The stream ``events(user_id,
    action, event_id, ts)`` needs a watermark on ts; rows behind it are lost, rows younger than it wait.
    The state is the rows within the widest window.
    """
    names = list(limits)
    widest = max(seconds for seconds, _ in limits.values()) * 1_000_000
    code = F.lit(-1)
    for i, name in enumerate(names):
        code = F.when(F.col("action") == name, i).otherwise(code)
    types = {"us": "int64", "user": "int64", "no_user": "bool", "event": "int64", "no_event": "bool", "code": "int64", "taken": "bool"}

    def check(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = _held(state, frames, types)
        us, passed = rows["us"], _passed(rows["us"], state)
        who = np.unique(rows["user"], return_inverse=True)[1] * 2 + rows["no_user"]
        for i, name in enumerate(names):
            seconds, most = limits[name]
            at = np.flatnonzero(passed if name == "*" else passed & (rows["code"] == i))
            # equal times count each other
            n = _up_to(who[at], us[at], us[at]) - _up_to(who[at], us[at], us[at] - seconds * 1_000_000)
            over = (n > most) & ~rows["taken"][at]
            out = {c: rows[c][at[over]] for c in ("user", "no_user", "event", "no_event", "us")}
            yield pd.DataFrame({**out, "action": name, "n": n[over]})
        kept = ~passed | (us > state.getCurrentWatermarkMs() * MICROS - widest)
        rows["taken"] = passed
        least = None
        if kept.any():
            least = int(us[kept].max()) + widest if passed[kept].all() else int(us[~passed].min())
        _keep(state, tuple(v[kept].tolist() for v in rows.values()), least)

    counted = events if "*" in limits else events.filter(F.col("action").isin(names))
    found = _keyed(counted, code.alias("code"), F.lit(False).alias("taken")).groupBy("bucket").applyInPandasWithState(
        check, "user bigint, no_user boolean, event bigint, no_event boolean, us bigint, action string, n bigint",
        "us array<bigint>, user array<bigint>, no_user array<boolean>, event array<bigint>, no_event array<boolean>, "
        "code array<bigint>, taken array<boolean>", "append", GroupStateTimeout.EventTimeTimeout)
    return found.select(
        F.when(~F.col("no_user"), F.col("user")).alias("user_id"), "action", F.when(~F.col("no_event"), F.col("event")).alias("event_id"),
        F.timestamp_micros("us").alias("ts"), "n")


def room_sessions(events: DataFrame, join: str, leave: str, timeout_seconds: int) -> DataFrame:
    """Stays in rooms: (entry_id, user_id, session_start, session_end, joins, ended_by).

    An event ``join`` brings the user into the room of its entry, an event ``leave`` takes the
    user out of all rooms, and so does ``timeout_seconds`` without any event of the user, at the
    end of that time. A stay is returned when it ends. ``events(entry_id, user_id, event_id,
    action, ts)`` needs a watermark on ts. The state is the waiting rows and the open rooms.
    """
    wait = timeout_seconds * 1_000_000
    types = {"us": "int64", "user": "int64", "no_user": "bool", "event": "int64", "code": "int64", "entry": "int64"}

    def follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        open_rooms: dict[tuple, dict[int, list[int]]] = defaultdict(dict)
        last: dict[tuple, int] = {}
        if state.exists:
            for user, none, room, start, joins, at in zip(*list(state.get)[len(types):]):
                open_rooms[user, none][room] = [start, joins]
                last[user, none] = at
        rows = _held(state, frames, types)
        passed = _passed(rows["us"], state)
        order = np.lexsort((rows["event"], rows["us"]))
        out: list[tuple] = []

        def close(user: tuple, end: int, reason: str) -> None:
            out.extend((room, *user, start, end, n, reason) for room, (start, n) in open_rooms.pop(user, {}).items())

        for now, *who, _, code, entry in zip(*(v[order][passed[order]].tolist() for v in rows.values())):
            user = tuple(who)
            if user in last and now >= last[user] + wait:
                close(user, last[user] + wait, "timeout")
            last[user] = now
            if code == 2:
                close(user, now, "leave")
            elif code == 1:
                open_rooms[user].setdefault(entry, [now, 0])[1] += 1
        for user in list(open_rooms):
            if (last[user] + wait) // MICROS < state.getCurrentWatermarkMs():
                close(user, last[user] + wait, "timeout")
        rooms = [(*user, room, start, n, last[user]) for user, inside in open_rooms.items() for room, (start, n) in inside.items()]
        waiting = [v[~passed].tolist() for v in rows.values()]
        ends = [at + wait for *_, at in rooms] + waiting[0]
        _keep(state, (*waiting, *([r[i] for r in rooms] for i in range(6))), min(ends, default=None))
        yield pd.DataFrame(out, columns=["entry_id", "user", "no_user", "start", "end", "joins", "ended_by"])

    code = F.when(F.col("action") == leave, 2).when(F.col("action") == join, 1).otherwise(0)
    found = _keyed(
        events.filter(F.col("entry_id").isNotNull() | (F.col("action") != join)),
        code.alias("code"), F.coalesce("entry_id", F.lit(-1)).alias("entry"),
    ).groupBy("bucket").applyInPandasWithState(
        follow, "entry_id bigint, user bigint, no_user boolean, start bigint, end bigint, joins bigint, ended_by string",
        "us array<bigint>, user array<bigint>, no_user array<boolean>, event array<bigint>, code array<bigint>, entry array<bigint>, "
        "room_users array<bigint>, room_no_users array<boolean>, rooms array<bigint>, starts array<bigint>, joins array<bigint>, "
        "lasts array<bigint>", "append", GroupStateTimeout.EventTimeTimeout)
    return found.select(
        "entry_id", F.when(~F.col("no_user"), F.col("user")).alias("user_id"), F.timestamp_micros("start").alias("session_start"),
        F.timestamp_micros("end").alias("session_end"), "joins", "ended_by")
