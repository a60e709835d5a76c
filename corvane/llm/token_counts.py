"""Token counts of whole texts by a compiled finite-state byte-pair tokenizer."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

from corvane.llm.common import whole
from corvane.llm.merges import Transducer, Merger

CHUNK = 1 << 15
SLAB = 1 << 20
LIMIT = 512
#: The pre-tokenizer pattern of this vocabulary, a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Before these characters a token ends whatever the machine's state was: white space behind
#: something else, and a mark behind a letter or digit ('|' and '>' occur inside the special token).
SYNC = regex.compile(r"(?<=\S)\s|(?<=[\p{L}\p{N}])[^\s\p{L}\p{N}|>]")

MIXED = regex.compile(r"\s ").search


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Counter(dict):
    """Counts per pre-token, filled by the transducer when a pre-token is new."""

    LIMIT = 200_000

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        letters = byte_letters()
        raw = {c: bytes([b]) for c, b in letters.items()}
        to_bytes = lambda s: b"".join(map(raw.__getitem__, s))
        ranks = {tuple(map(to_bytes, pair)): i for i, pair in enumerate(model["model"]["merges"])}
        vocab = {to_bytes(token): i for token, i in model["model"]["vocab"].items()}
        self.machine = Transducer(Merger(vocab, lambda a, b: ranks.get((a, b))))
        special = [regex.escape(t["content"]) for t in model["added_tokens"]]
        self.special = regex.compile("|".join(special)) if special else None
        self.pieces = regex.compile(PATTERN).findall
        self.spaced = Spaced(self)

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        count = self.machine.count(piece.encode("utf-8", "surrogatepass"))
        if len(piece) < 64:
            self[piece] = count
        return count

    def parts(self, text: str) -> int:
        parts = self.special.split(text) if self.special else [text]
        total = len(parts) - 1
        for part in parts:
            total += sum(map(self.__getitem__, self.pieces(part)))
        return total

    def count(self, text: str) -> int:
        """A space behind something that isn't white space always starts a pre-token."""
        if MIXED(text):
            return self.parts(text)
        first, *others = text.split(" ")
        return (self.parts(first) if first else 0) + sum(map(self.spaced.__getitem__, others))


class Spaced(dict):
    """Counts of a space and the text up to the next one."""

    LIMIT = 500_000

    def __init__(self, owner: Counter):
        self.owner = owner

    def __missing__(self, rest: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        if rest.isalpha():
            count = self.owner.machine.count(b" " + rest.encode())
        elif rest[:-1].isalpha() and rest[-1] in ",.":
            count = self[rest[:-1]] + 1
        else:
            count = self.owner.parts(" " + rest)
        if len(rest) < 64:
            self[rest] = count
        return count


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """Compiled once per Python worker."""
    return Counter(path)


def chunk_map(count: Counter, text: str) -> tuple[bool, str, int, str]:
    """The chunk as a function of the state it is entered with: (open, head, count, tail).

    Between its first and last synchronising character the count is the same for every state.
    Head and tail wait for the neighbours; a chunk without such a character is all head (open).
    """
    first = SYNC.search(text)
    if first is None:
        return True, text, 0, ""
    last = first.start()
    for found in SYNC.finditer(text, max(last, len(text) - 256)):
        last = found.start()
    if last == first.start() and len(text) - last > 256:
        for found in SYNC.finditer(text, last):
            last = found.start()
    return False, text[:first.start()], count.count(text[first.start():last]), text[last:]


def slices(text: Column, size: int) -> Column:
    last = F.greatest(F.lit(0), F.floor((F.length(text) - 1) / size)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(text, i * size + 1, F.lit(size)))


def count_tokens(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
    limit: int = LIMIT,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row, as the vocabulary's library counts.

    ``vocabulary`` is the path of a byte-level BPE file (JSON) that all executors can read. Texts
    are cut into chunks of 2^15 characters that any task may process; each becomes a map from
    entry state to count and exit state (``chunk_map``), and a scan in chunk order composes the
    maps of a row. Rows of the scan are a few hundred bytes; texts are never shuffled.

    Null and empty texts have 0 bytes and 0 tokens. Strings of special tokens inside a text
    count as one token, the library's default. Rows that repeat an id are separate rows. An
    unbroken run of letters is carried whole through the scan.
    """
    id_type = docs.schema[id_col].dataType
    text = whole(text_col)
    chunks = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
        F.octet_length(text).cast("bigint").alias("n_bytes"), text.alias("text"),
    ).select(
        "row", "doc_id", "n_bytes",
        F.posexplode(
            F.when(F.length("text") <= CHUNK, F.array("text")).otherwise(
                F.flatten(F.transform(slices(F.col("text"), SLAB), lambda t: slices(t, CHUNK))))
        ).alias("chunk", "text"),
    )

    def to_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary)
        for batch in batches:
            maps = [chunk_map(count, t) for t in batch.column("text").to_pylist()]
            opened, head, inner, tail = zip(*maps) if maps else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("row", "doc_id", "n_bytes", "chunk")],
                 pa.array(opened, pa.bool_()), pa.array(head, pa.string()),
                 pa.array(inner, pa.int64()), pa.array(tail, pa.string())],
                names=["row", "doc_id", "n_bytes", "chunk", "open", "head", "inner", "tail"])

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary)
        now, total, carry = None, 0, []
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in
                       ("row", "doc_id", "n_bytes", "open", "head", "inner", "tail")]
            for row, doc, size, opened, head, inner, tail in zip(*columns):
                if now is None or now[0] != row:
                    if now is not None:
                        out.append((now[1], now[2], total + count.count("".join(carry))))
                    now, total, carry = (row, doc, size), 0, []
                carry.append(head)
                if not opened:
                    total += count.count("".join(carry)) + inner
                    carry = [tail]
            yield result(out)
        if now is not None:
            yield result([(now[1], now[2], total + count.count("".join(carry)))])

    def result(rows: list[tuple]) -> pa.RecordBatch:
        doc, size, tokens = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(doc, arrow_id), pa.array(size, pa.int64()), pa.array(tokens, pa.int64())],
            names=["doc_id", "n_bytes", "n_tokens"])

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_id = to_arrow_type(id_type)
    head = [T.StructField("doc_id", id_type), T.StructField("n_bytes", T.LongType())]
    maps = chunks.mapInArrow(to_maps, T.StructType([
        T.StructField("row", T.LongType()), *head, T.StructField("chunk", T.IntegerType()),
        T.StructField("open", T.BooleanType()), T.StructField("head", T.StringType()),
        T.StructField("inner", T.LongType()), T.StructField("tail", T.StringType())]))
    counts = maps.repartition("row").sortWithinPartitions("row", "chunk").mapInArrow(
        compose, T.StructType([*head, T.StructField("n_tokens", T.LongType())]))
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
