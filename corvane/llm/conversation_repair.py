"""Conversations brought into the order system, then user and assistant in turn, at least cost."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from corvane.llm.common import SPACE, parts, written
from corvane.session import scratch_path

#: Letters of the edits in ASCII order; a letter's digit is its place, and 0 pads the end.
LETTERS = "DIKR"
DIGITS = str.maketrans({letter: str(i + 1) for i, letter in enumerate(LETTERS)})
BITS = 3
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States: nothing yet, after the system row, after a user, after an assistant.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NAMES = {2: "user", 3: "assistant"}
INSERTED = {0: 2, 1: 2, 2: 3, 3: 2}  # the only row that may be inserted in a state
FINAL = (0, 3)
STATES = range(4)
NONE = -1
PIECE_BITS = 12  # rows of a piece: 4,096
BLOCK = 64
FAN_IN = 16
MEMO = 100_000
HEAD = 32
MOST = (1 << 63) - 1


class Weights:
    """Integers whose high digits are a cost and whose ``width`` low digits are audit letters."""

    def __init__(self, width: int):
        self.low = BITS * width
        self.mask = (1 << self.low) - 1
        self.steps = {
            letter: (i + 1) << max(0, self.low - BITS) for i, letter in enumerate(LETTERS)}
        self.unreachable = 1 << (self.low + 70)

    def before(self, letter: str, cost: int, weight: int) -> int:
        """The weight of an edit followed by the edits of ``weight``."""
        if weight >= self.unreachable:
            return self.unreachable
        low = weight & self.mask
        return weight - low + (cost << self.low) + self.steps[letter] + (low >> BITS)

    def with_inserts(self, after: list[int]) -> list[int]:
        """The least weights if up to two rows may be inserted first; a third repeats a state."""
        out = []
        for state in STATES:
            best, letters, at = after[state], 0, state
            for _ in range(2):
                at, letters = INSERTED[at], letters + 1
                weight = after[at]
                for _ in range(letters):
                    weight = self.before("I", INSERT, weight)
                best = min(best, weight)
            out.append(best)
        return out

    def over_row(self, initial: str, fault: str, after: list[int]) -> list[int]:
        """Weights before a row, from those behind it; ``fault`` is x (must go), t or empty."""
        added = TRUNCATED if fault == "t" else 0
        out = []
        for state in STATES:
            best = self.before("D", DELETE, after[state])
            if fault != "x":
                if (state, initial) in STEP:
                    best = min(best, self.before("K", KEEP + added, after[STEP[state, initial]]))
                best = min(best, self.before("R", REROLE + added, after[INSERTED[state]]))
            out.append(best)
        return self.with_inserts(out)

    def read(self, weight: int) -> tuple[int, str]:
        """Cost and letters."""
        if weight >= self.unreachable:
            return NONE, ""
        digits = f"{weight & self.mask:0{self.low // BITS}o}".rstrip("0") if self.low else ""
        return weight >> self.low, "".join(LETTERS[int(d) - 1] for d in digits)

    def write(self, cost: int, letters: str) -> int:
        if cost == NONE:
            return self.unreachable
        digits = int(letters.translate(DIGITS), 8) if letters else 0
        return (cost << self.low) + (digits << (self.low - BITS * len(letters)))


def cheapest(rows: list[tuple[str, str]]) -> tuple[int, str]:
    """Cost and audit of a whole conversation of (initial, fault)."""
    weights = Weights(3 * len(rows) + 2)
    after = weights.with_inserts([0 if q in FINAL else weights.unreachable for q in STATES])
    for initial, fault in reversed(rows):
        after = weights.over_row(initial, fault, after)
    return weights.read(after[0])


Map = list[tuple[int, str]]  # cost and letters from state i // 4 to state i % 4


def block_map(rows: list[tuple[str, str]]) -> Map:
    """The least edits of some rows between every two states; rows may be inserted before each."""
    weights = Weights(3 * len(rows))
    out: Map = [(NONE, "")] * 16
    for end in STATES:
        after = [0 if q == end else weights.unreachable for q in STATES]
        for initial, fault in reversed(rows):
            after = weights.over_row(initial, fault, after)
        for start in STATES:
            out[4 * start + end] = weights.read(after[start])
    return out


def joined(a: Map, b: Map) -> Map:
    """The map of ``a``'s rows followed by ``b``'s.

    Cheapest edits of equal cost are never a prefix of each other, as a further letter costs
    at least an insertion; so the least weight stays the least whatever follows it.
    """
    out: Map = []
    for start in STATES:
        for end in STATES:
            found = [
                (a[4 * start + mid][0] + b[4 * mid + end][0], a[4 * start + mid][1] + b[4 * mid + end][1])
                for mid in STATES if a[4 * start + mid][0] != NONE and b[4 * mid + end][0] != NONE]
            if len(found) > 1:
                weights = Weights(max(len(letters) for _, letters in found))
                found = [min(found, key=lambda f: weights.write(*f))]
            out.append(found[0] if found else (NONE, ""))
    return out


def joined_all(maps: list[Map]) -> Map:
    """Neighbours joined pairwise until one map is left."""
    while len(maps) > 1:
        maps = [joined(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
    return maps[0]


def rows_map(rows: list[tuple[str, str]]) -> Map:
    return joined_all([block_map(rows[at:at + BLOCK]) for at in range(0, len(rows), BLOCK)])


def ended(whole: Map) -> tuple[int, str]:
    """Cost and audit of a conversation from the map of all its rows."""
    end: Map = [(NONE, "")] * 16
    weights = Weights(2)
    last = weights.with_inserts([0 if q in FINAL else weights.unreachable for q in STATES])
    for state in STATES:
        end[4 * state] = weights.read(last[state])
    return joined(whole, end)[0]


SUMS = ("rows", "blank", "duplicate", "truncated", "illegal")
SUMMARY = (", ".join(f"{s} bigint" for s in SUMS) + ", first string, last string, low bigint, high bigint, turns bigint, "
           "costs array<bigint>, audits array<string>")


def _summary(rows: list[dict], whole: bool, memo: dict) -> dict:
    """Counts and edits of neighbouring rows of one conversation; ``whole``: it has no others."""
    classes, counts = [], dict.fromkeys(SUMS, 0)
    turns: set[int] = set()
    for row in rows:
        fault = "x" if row["blank"] or not row["is_first"] else "t" if row["truncated"] else ""
        if fault:
            counts["blank" if row["blank"] else "duplicate" if fault == "x" else "truncated"] += 1
        classes.append((row["role"][:1], fault))
        if row["turn"] is not None:
            turns.add(row["turn"])
    counts["rows"] = len(rows)
    counts["illegal"] = sum(_illegal(a, b) for (a, _), (b, _) in zip(classes, classes[1:]))
    if whole:
        key = tuple(classes)
        if key not in memo:
            if len(memo) >= MEMO:
                memo.clear()
            memo[key] = cheapest(classes) if len(rows) <= BLOCK else ended(rows_map(classes))
        edits = [memo[key]]
    else:
        edits = rows_map(classes)
    return counts | {
        "first": classes[0][0], "last": classes[-1][0], "low": min(turns, default=None),
        "high": max(turns, default=None), "turns": len(turns),
        "costs": [c for c, _ in edits], "audits": [a for _, a in edits]}


def _illegal(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


def _together(found: list[dict]) -> dict:
    """The summary of neighbouring parts of a conversation, given in order."""
    out = {s: sum(int(f[s]) for f in found) for s in SUMS}
    out["illegal"] += sum(_illegal(a["last"], b["first"]) for a, b in zip(found, found[1:]))
    out |= {"first": found[0]["first"], "last": found[-1]["last"], "low": None, "high": None, "turns": 0}
    for f in found:
        if not pd.isna(f["low"]):
            out["turns"] += int(f["turns"]) - (out["high"] == int(f["low"]))
            out["low"] = int(f["low"]) if out["low"] is None else out["low"]
            out["high"] = int(f["high"])
    edits = joined_all([list(zip(map(int, f["costs"]), f["audits"])) for f in found])
    return out | {"costs": [c for c, _ in edits], "audits": [a for _, a in edits]}


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("head"), F.col("digest")]


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) after the faults that crc32 of ``conv_id:turn`` deals out."""
    def said(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    text = F.when(fault == 1, F.lit("")).when(
        fault == 2, F.translate(said("text"), ".!?", "")).otherwise(said("text"))
    return conversations.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"),
        F.when(fault == 4, F.lit("user")).otherwise(said("role")).alias("role"), text.alias("text"), fault.alias("fault"),
    ).filter("fault <> 0").withColumn(
        "copy", F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
    ).drop("fault", "copy")


def summaries(rows: DataFrame, piece_bits: int = PIECE_BITS, fan_in: int = FAN_IN) -> DataFrame:
    """Per conversation of ``rows(conv_id, turn, role, text)`` its counts, cost and audit.

    What is sorted is a digest and the first 32 characters of each text, by range, so a long
    conversation lies in many pieces of 4,096 rows. A piece gives one summary per conversation:
    counts and, where the conversation may go on elsewhere, the cheapest edits between every two
    states. These maps are joined in a tree of 16 at a time.
    """
    spark = rows.sparkSession
    meaning = F.rtrim("text", F.lit(SPACE))
    keys = rows.select(
        "conv_id", "turn", "role", F.left("text", F.lit(HEAD)).alias("head"), F.unhex(F.sha2("text", 256)).alias("digest"),
        (meaning == "").alias("blank"), (~F.right(meaning, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
        F.monotonically_increasing_id().alias("tie"))
    path = scratch_path(spark, "turns")
    keys.orderBy("conv_id", *_order(), "tie").select(
        F.monotonically_increasing_id().alias("slot"), "conv_id", "turn", "role", "digest", "blank", "truncated",
    ).write.parquet(path)
    placed = spark.read.parquet(path)
    firsts = placed.groupBy("conv_id", "role", "digest").agg(F.min("slot").alias("slot")).select(
        "slot", F.lit(True).alias("is_first"))
    marked = placed.drop("digest").unionByName(firsts, allowMissingColumns=True).withColumn(
        "piece", F.shiftright("slot", piece_bits)).repartition("piece").sortWithinPartitions(
        "slot", F.col("is_first").desc_nulls_last())
    of = T.StructType([rows.schema["conv_id"], T.StructField("piece", T.LongType())])
    schema = T.StructType([*of.fields, *T.StructType.fromDDL(SUMMARY).fields])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        held: list[dict] = []
        for run in _runs(batches, "piece"):
            segments = list(_segments(run))
            for i, segment in enumerate(segments):
                inside = 0 < i < len(segments) - 1
                held.append({"conv_id": segment[0]["conv_id"], "piece": segment[0]["piece"]}
                            | _summary(segment, inside, memo))
            if len(held) >= 1024:
                yield _arrow(held, schema)
                held = []
        if held:
            yield _arrow(held, schema)

    found = written(marked.mapInArrow(pieces, schema), "pieces")
    apart = found.filter("size(costs) = 16")
    numbered = apart.select(
        F.col("conv_id").alias("of"), "piece",
        (F.row_number().over(Window.partitionBy("conv_id").orderBy("piece")) - 1).alias("part"))
    parted = written(apart.withColumnRenamed("piece", "in_piece").join(
        numbered, (F.col("in_piece") == F.col("piece")) & F.col("conv_id").eqNullSafe(F.col("of"))).drop("of", "piece"), "parts")
    most = parted.agg(F.max("part")).first()[0] or 0
    columns = [*schema.names[:1], "part", *schema.names[2:]]
    out_schema = T.StructType([schema["conv_id"], T.StructField("part", T.LongType()), *schema.fields[2:]])

    def tree(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values("part")
        of = {"conv_id": ordered["conv_id"].iloc[0], "part": int(ordered["part"].iloc[0]) // fan_in}
        whole = _together(ordered.to_dict("records"))
        return pd.DataFrame([of | whole], columns=columns).astype({"low": "Int64", "high": "Int64"})

    level = parted.select(*[F.col(c).cast("bigint") if c == "part" else F.col(c) for c in columns])
    while most:
        level = level.groupBy("conv_id", F.floor(F.col("part") / fan_in).alias("group")).applyInPandas(tree, out_schema)
        most //= fan_in
    return found.filter("size(costs) = 1").drop("piece").unionByName(level.drop("part"))


def _runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[list[dict]]:
    """Rows with equal ``column``, in order; a row of ``is_first`` alone marks the one behind it."""
    held: list[dict] = []
    mark = None
    for batch in parts(batches):
        for row in batch.to_pylist():
            if row["is_first"]:
                mark = row["slot"]
                continue
            row["is_first"] = mark == row["slot"]
            if held and held[-1][column] != row[column]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _segments(rows: list[dict]) -> Iterator[list[dict]]:
    start = 0
    for at in range(1, len(rows) + 1):
        if at == len(rows) or rows[at]["conv_id"] != rows[start]["conv_id"]:
            yield rows[start:at]
            start = at


def _arrow(rows: list[dict], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    return pa.RecordBatch.from_pylist(rows, schema=to_arrow_schema(schema))


REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def repaired(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Repaired conversations of ``rows(conv_id, turn, role, text)``, row by row.

    Returns (conv_id, position, edit, role, text, gaps, blank, duplicate, truncated, illegal,
    cost, audit), a conversation's rows together and in order: position 0 is its report,
    the repaired rows follow with the edit K, R or I that made them. ``ids(conv_id)`` names
    conversations that must have a report although no row is left of them.

    Weights are integers: the cost in the high digits, the letters of the edits as fixed-width
    low digits from the left, zeros behind the last; the integer minimum settles cost and ties.

    Order is turn (null first), role, the first 32 characters of the text, then its SHA-256;
    rows equal in all are interchangeable. An empty role, or one that starts otherwise than
    with s, u or a, can be changed or deleted but not kept. A null id is a conversation of its own.
    ``rows`` must have no null role or text. Other columns are ignored. An empty table gives none.
    """
    reports = summaries(rows)
    wanted = rows.select("conv_id") if ids is None else ids.select("conv_id")
    wanted = wanted.distinct().withColumnRenamed("conv_id", "of")
    heads = wanted.join(reports, F.col("of").eqNullSafe(F.col("conv_id")), "left").drop("conv_id").withColumnRenamed(
        "of", "conv_id").withColumn("kind", F.lit(0))
    body = rows.select(
        "conv_id", "turn", "role", F.left("text", F.lit(HEAD)).alias("head"), F.unhex(F.sha2("text", 256)).alias("digest"),
        "text", F.lit(1).alias("kind"))
    lined = heads.drop("rows", "first", "last").unionByName(body, allowMissingColumns=True).repartition(
        "conv_id").sortWithinPartitions("conv_id", "kind", *_order()).drop("turn", "head", "digest")
    schema = T.StructType([
        rows.schema["conv_id"], *T.StructType.fromDDL("position bigint, edit string, role string, text string").fields,
        *T.StructType.fromDDL(REPORT).fields])

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conversation = None
        for batch in parts(batches):
            out: list[dict] = []
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    if conversation is not None:
                        out.extend(conversation.rest())
                    conversation = _Conversation(row)
                    out.append(conversation.report)
                else:
                    out.extend(conversation.over(row["role"], row["text"]))
            yield _arrow(out, schema)
        if conversation is not None:
            yield _arrow(list(conversation.rest()), schema)

    return lined.mapInArrow(repair, schema)


class _Conversation:
    """The rows that a conversation's audit makes of its rows, one by one."""

    def __init__(self, head: dict):
        self.id, self.at, self.state, self.position = head["conv_id"], 0, 0, 0
        cost, self.audit = 0, ""
        if head["costs"] is not None:
            edits = list(zip(head["costs"], head["audits"]))
            cost, self.audit = edits[0] if len(edits) == 1 else ended(edits)
        gaps = 0 if head["low"] is None else min(MOST, head["high"] - head["low"] + 1 - head["turns"])
        self.report = {"conv_id": self.id, "position": 0, "gaps": gaps, "cost": cost, "audit": self.audit} | {
            name: head[name] or 0 for name in ("blank", "duplicate", "truncated", "illegal")}

    def _row(self, edit: str, role: str, text: str) -> dict:
        self.position += 1
        return {"conv_id": self.id, "position": self.position, "edit": edit, "role": role, "text": text}

    def _inserts(self) -> Iterator[dict]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at, self.state = self.at + 1, INSERTED[self.state]
            yield self._row("I", NAMES[self.state], "")

    def over(self, role: str, text: str) -> Iterator[dict]:
        yield from self._inserts()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self.state = STEP[self.state, role[:1]]
            yield self._row(edit, role, text)
        elif edit == "R":
            self.state = INSERTED[self.state]
            yield self._row(edit, NAMES[self.state], text)

    def rest(self) -> Iterable[dict]:
        yield from self._inserts()


def with_digests(repairs: DataFrame) -> DataFrame:
    """The reports of :func:`repaired` with ``repaired_sha256`` of ``role:text`` lines.

    Rows are read as they lie, one after the other, so no conversation is held; a digest is
    sequential by nature, so one conversation's rows pass through one task.
    """
    report = T.StructType([repairs.schema["conv_id"], *T.StructType.fromDDL(REPORT).fields])
    schema = T.StructType([*report.fields, T.StructField("repaired_sha256", T.StringType())])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, digest = None, None
        for batch in parts(batches):
            out = []
            for row in batch.to_pylist():
                if row["position"] == 0:
                    if head is not None:
                        out.append(head | {"repaired_sha256": digest.hexdigest()})
                    head, digest = {name: row[name] for name in report.names}, hashlib.sha256()
                else:
                    line = f"{row['role']}:{row['text']}"
                    digest.update((line if row["position"] == 1 else "\n" + line).encode())
            yield _arrow(out, schema)
        if head is not None:
            yield _arrow([head | {"repaired_sha256": digest.hexdigest()}], schema)

    return repairs.mapInArrow(digests, schema)


def repair_report(conversations: DataFrame) -> DataFrame:
    """Conversations damaged by rule, repaired, one report each; see :func:`repaired`.

    Null roles and texts are one space, null turns come first. Every conv_id of the table has
    a row; one whose rows were all dropped has zeros, an empty audit and the empty digest.
    """
    return with_digests(repaired(damaged(conversations), conversations))
