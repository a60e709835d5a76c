"""Token ids in files: ranked by frequency, byte-aligned, with control bytes apart."""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from corvane.llm.common import whole, written
from corvane.llm.token_counts import byte_letters
from corvane.llm.warc import _open, _uri
from corvane.session import scratch_path

MAGIC = b"IDS1"
#: Block head: documents, ids, bytes of data, 1 if the last document goes on in the next block.
HEAD = struct.Struct("<IIIB")
BLOCK = 1 << 16  # ids of a block
SLICE = 1 << 18  # characters of a text that are split at a time
JOINED = 512
MEMO = 400_000
LONGEST = 64
RANKS = "ranks.u32"
END = 0

MIXED = re.compile(r"\s[ \n]").search
SEGMENTS = re.compile(r"(?<=\S)(?=[ \n])").split
CUT = re.compile(r"(?<=\S)[ \n]").search
MARKS = ".,;:!?"


class Encoder:
    """Ids of whole texts by the library, which sees every different segment once.

    A segment starts at a space or line feed behind something that is no white space; there a token of
    this vocabulary always ends, so segments are encoded apart. Marks behind an ASCII letter or digit
    are a segment of their own for the same reason. Unknown segments go to the library many at a
    time, joined as they stand; token lengths in bytes tell them apart again.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        letters = set(byte_letters())
        self.lengths = np.zeros(self.size, np.int64)
        for token, i in self.library.get_vocab(with_added_tokens=True).items():
            self.lengths[i] = len(token) if letters.issuperset(token) else len(token.encode())
        for i, token in self.library.get_added_tokens_decoder().items():
            self.lengths[i] = len(token.content.encode())
        #: Ids of a segment; a key that does not start with a line feed stands behind a space.
        self.known: dict[str, bytes] = {}

    def ids(self, text: str) -> np.ndarray:
        return self.all_ids([text])[0]

    def all_ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; long texts are worked on slice by slice."""
        out: list[list[bytes]] = [[] for _ in texts]
        for slices in zip_longest(*map(_slices, texts)):
            held = [(at, *_words(part, at_start)) for at, (part, at_start) in enumerate(s or ("", True) for s in slices)]
            if len(self.known) > MEMO:
                self.known = {}
            new = set().union(*(words for _, _, words, _ in held)).difference(self.known)
            self._learn(new)
            for at, first, words, apart in held:
                if first:
                    out[at].append(self._packed(self.library.encode(first, add_special_tokens=False).ids))
                found = list(map(self.known.__getitem__, words))
                for place, segment in apart.items():
                    found[place] = self._packed(self.library.encode(segment, add_special_tokens=False).ids)
                out[at] += found
            for word in new:
                if len(word) > LONGEST:
                    del self.known[word]
        return [np.frombuffer(b"".join(o), self.dtype) for o in out]

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _learn(self, words: set[str]) -> None:
        """Fill ``known`` for new keys."""
        plain: dict[str, set[str]] = {" ": set(), "\n": set()}
        tails: list[tuple[str, str, str]] = []
        other = []
        for word in words:
            core = word.rstrip(MARKS)
            if core != word and core[-1:].isalnum() and core.isascii():
                tails.append((word, core, word[len(core):]))
                if core in self.known:
                    continue
                word = core
            lead, bare = ("\n", word[1:]) if word[:1] == "\n" else (" ", word)
            if bare.split(None, 1) == [bare]:
                plain[lead].add(bare)
            elif word not in self.known:
                other.append(word)
        for lead, bare in plain.items():
            self._learn_joined(lead, list(bare))
        full = [w if w[:1] == "\n" else " " + w for w in other]
        for word, found in zip(other, self.library.encode_batch_fast(full, add_special_tokens=False)):
            self.known[word] = self._packed(found.ids)
        marks: dict[str, bytes] = {}
        for word, core, tail in tails:
            if tail not in marks:
                marks[tail] = self._packed(self.library.encode(tail, add_special_tokens=False).ids)
            self.known[word] = self.known[core] + marks[tail]

    def _learn_joined(self, lead: str, words: list[str]) -> None:
        key = lead.strip(" ")
        for at in range(0, len(words), JOINED):
            some = words[at:at + JOINED]
            ids = np.array(self.library.encode_batch_fast([lead + lead.join(some)], add_special_tokens=False)[0].ids, self.dtype)
            ends = np.cumsum(self.lengths[ids])
            wanted = np.cumsum([len(w) if w.isascii() else len(w.encode("utf-8", "surrogatepass")) for w in some]) + np.arange(1, len(some) + 1)
            cuts = np.searchsorted(ends, wanted) + 1
            if not np.array_equal(ends[cuts - 1], wanted):
                raise ValueError("a token crosses a segment's border")
            data, width = ids.tobytes(), self.dtype.itemsize
            stops = (cuts * width).tolist()
            for word, start, stop in zip(some, [0, *stops], stops):
                self.known[key + word] = data[start:stop]


def _slices(text: str) -> Iterator[tuple[str, bool]]:
    """Parts of at most about SLICE characters, cut where a segment starts; whether a part is the first."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > SLICE and (cut := CUT(text, at + SLICE)):
            end = cut.start()
        yield text[at:end], at == 0
        at = end


def _words(part: str, at_start: bool) -> tuple[str, list[str], dict[int, str]]:
    """First segment of a text, keys of the others, and segments that no key stands for, by place."""
    apart = {}
    if MIXED(part):
        words = SEGMENTS(part)
        first = words.pop(0) if at_start else ""
        for place, word in enumerate(words):
            if word[:1] == " ":
                words[place] = word[1:]
                if word[:2] == " \n":
                    apart[place], words[place] = word, "."
    else:
        words = part.replace("\n", " \n").split(" ")
        first = words.pop(0)
    return first, words, apart


def packed(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes (four two-bit lengths each) and the ranks' bytes without leading zeros."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    more = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    four = np.zeros((len(ranks) + 3) // 4 * 4, np.uint8)
    four[:len(ranks)] = more
    four = four.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) <= more[:, None]]
    return control.tobytes(), data.tobytes()


#: The four lengths that a control byte stands for.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def unpacked(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The ranks that :func:`packed` got."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    starts = np.cumsum(lengths) - lengths
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = raw[starts].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(lengths > k)
        out[longer] |= raw[starts[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


class _Writer:
    """One file of blocks; a block holds whole documents, or one piece of a long one."""

    def __init__(self, out, ranks: np.ndarray):
        self.out, self.ranks, self.docs, self.ids, self.count = out, ranks, 0, 0, 0
        self.held: list[tuple[int | None, np.ndarray]] = []
        out.write(MAGIC)

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.docs, self.ids = self.docs + 1, self.ids + len(ids)
        if self.held and self.count + len(ids) > BLOCK:
            self.flush()
        while len(ids) > BLOCK:
            self.held, ids = [(doc, ids[:BLOCK])], ids[BLOCK:]
            self.flush(1)
        self.held.append((doc, ids))
        self.count += len(ids)

    def flush(self, goes_on: int = 0) -> None:
        if not self.held:
            return
        ranks = self.ranks[np.concatenate([i for _, i in self.held])]
        control, data = packed(ranks)
        docs = [d for d, _ in self.held]
        self.out.write(HEAD.pack(len(docs), len(ranks), len(data), goes_on))
        self.out.write(np.array([d is None for d in docs], np.uint8).tobytes())
        self.out.write(np.array([d or 0 for d in docs], "<i8").tobytes())
        self.out.write(np.array([len(i) for _, i in self.held], "<u4").tobytes())
        self.out.write(control)
        self.out.write(data)
        self.held, self.count = [], 0


def _blocks(stream, by_rank: np.ndarray) -> Iterator[tuple[int | None, np.ndarray, bool]]:
    """(doc_id, ids, whether the document ends here) from one file, block by block."""
    if stream.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a file of token ids")

    def take(n: int) -> bytes:
        data = stream.read(n)
        while len(data) < n:
            more = stream.read(n - len(data))
            if not more:
                raise ValueError("the file ends within a block")
            data += more
        return data

    while head := stream.read(1):
        docs, count, size, goes_on = HEAD.unpack(head + take(HEAD.size - 1))
        nulls = np.frombuffer(take(docs), np.uint8)
        names = np.frombuffer(take(8 * docs), "<i8")
        lengths = np.frombuffer(take(4 * docs), "<u4")
        control = take((count + 3) // 4)
        ids = by_rank[unpacked(control, take(size), count)]
        at = 0
        for null, name, length in zip(nulls, names.tolist(), lengths.tolist()):
            yield (None if null else name), ids[at:at + length], not goes_on
            at += length


def encoded(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every whole text with the end id, as a table (part, at, doc_id, ids) in ascending order of the id.

    Rows with equal ids follow the SHA-256 of their text; a null id comes first.
    """
    text = whole(text_col)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text")).orderBy(
        F.col("doc_id").asc_nulls_first(), F.unhex(F.sha2("text", 256)), F.monotonically_increasing_id())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, at = Encoder(vocabulary), 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                some = batch.slice(low, 64)
                end = np.array([END], encoder.dtype).tobytes()
                ids = [found.tobytes() + end for found in encoder.all_ids(some["text"].to_pylist())]
                n = some.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part)), pa.array(np.arange(at, at + n)), some["doc_id"],
                     pa.array(ids, pa.binary())], ["part", "at", "doc_id", "ids"])
                at += n

    return written(rows.mapInArrow(encode, "part bigint, at bigint, doc_id bigint, ids binary"), "ids", compression="zstd")


def ranked(ids: DataFrame, size: int, dtype: np.dtype) -> np.ndarray:
    """All ids of a vocabulary by falling frequency in ``ids``, then by id; unused ones last.

    Tasks count into one array each; what reaches the driver is a row per used id.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for value in batch["ids"]:
                counts += np.bincount(np.frombuffer(value.as_buffer(), dtype), minlength=size)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["id", "times"])

    rows = ids.select("ids").mapInArrow(count, "id bigint, times bigint").groupBy("id").agg(F.sum("times").alias("times"))
    totals = np.zeros(size, np.int64)
    for row in rows.toLocalIterator():
        totals[row["id"]] = row["times"]
    return np.argsort(-totals, kind="stable").astype("<u4")


def write_ids(docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the token ids of every whole text, with an end id, below ``path``.

    Returns (file, part, at, docs, ids, bytes, start): files in the order of part and at hold
    the documents by ascending id, and ``start`` is the number of ids in earlier files. Names sort alike.

    An id is stored as its frequency rank in one to four bytes; two bits in a block's control
    bytes tell how many. The order of ranks is the file ``ranks.u32``: as many numbers as the
    vocabulary has ids, never more. Nothing else passes the driver. A file has a name of its own per
    attempt, and only the files of successful attempts are in the returned table.

    Null texts are empty and have the end id alone; rows with equal or null ids are written each, null
    first. Other columns are ignored. An empty table writes no file but the ranks.
    """
    spark = docs.sparkSession
    encoder = Encoder(vocabulary)
    size, dtype = encoder.size, encoder.dtype
    ids = encoded(docs, vocabulary, id_col, text_col)
    order = ranked(ids, size, dtype)
    system, folder = _open(path)
    system.create_dir(folder, recursive=True)
    with system.open_output_stream(f"{folder}/{RANKS}") as out:
        out.write(order.tobytes())
    ranks = np.empty(size, "<u4")
    ranks[order] = np.arange(size, dtype="<u4")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _open(path)
        writer = name = start = None
        follows = (-1, -1)

        def done() -> pa.RecordBatch:
            writer.flush()
            size = writer.out.tell()
            writer.out.close()
            row = {"file": name, "part": start[0], "at": start[1], "docs": writer.docs, "ids": writer.ids, "bytes": size}
            return pa.RecordBatch.from_pylist([row])

        for batch in batches:
            for part, at, doc, value in zip(*(batch[c] for c in ("part", "at", "doc_id", "ids"))):
                place = (part.as_py(), at.as_py())
                if place != follows:
                    if writer:
                        yield done()
                    start = place
                    name = f"{folder}/{place[0]:08d}-{place[1]:012d}-{uuid.uuid4().hex}.ids"
                    writer = _Writer(system.open_output_stream(name), ranks)
                writer.add(doc.as_py(), np.frombuffer(value.as_buffer(), dtype))
                follows = (place[0], place[1] + 1)
        if writer:
            yield done()

    files = written(ids.mapInArrow(write, "file string, part bigint, at bigint, docs bigint, ids bigint, bytes bigint"), "files")
    # one row per file, so this window is small
    before = F.coalesce(F.expr("sum(ids) over (order by part, at rows between unbounded preceding and 1 preceding)"), F.lit(0))
    return files.withColumn("start", before)


def _read(files: DataFrame, path: str, schema: str, rows) -> DataFrame:
    """``rows(start, blocks)`` of every file, several files at a time in different tasks."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _open(path)
        by_rank = None
        for batch in batches:
            for row in batch.to_pylist():
                if by_rank is None:
                    with system.open_input_stream(f"{folder}/{RANKS}") as stream:
                        by_rank = np.frombuffer(stream.read(), "<u4")
                with system.open_input_stream(row["file"]) as stream:
                    yield from rows(row["start"], _blocks(stream, by_rank))

    return files.select("file", "start").repartition(max(1, files.count()), "file").mapInArrow(read, schema)


def read_ids(files: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, last, ids) per document, or per piece of a long one: ``start`` counts the ids before it."""
    def rows(start: int, blocks: Iterable) -> Iterator[pa.RecordBatch]:
        for doc, ids, last in blocks:
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc], pa.int64()), pa.array([start], pa.int64()), pa.array([last]),
                 pa.array([ids.astype(np.int64)], pa.list_(pa.int64()))], ["doc_id", "start", "last", "ids"])
            start += len(ids)

    return _read(files, path, "doc_id bigint, start bigint, last boolean, ids array<bigint>", rows)


def read_digests(files: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from the files."""
    def rows(start: int, blocks: Iterable) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        crc = count = 0
        for doc, ids, last in blocks:
            crc, count = zlib.crc32(ids.astype("<u4").tobytes(), crc), count + len(ids)
            if last:
                held.append({"doc_id": doc, "start": start, "n_tokens": count, "ids_crc32": crc})
                start, crc, count = start + count, 0, 0
            if len(held) >= 1024:
                yield pa.RecordBatch.from_pylist(held, schema=schema)
                held = []
        yield pa.RecordBatch.from_pylist(held, schema=schema)

    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")])
    return _read(files, path, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint", rows)


def stored_ids(spark: SparkSession, docs: DataFrame, vocabulary: str) -> DataFrame:
    """The documents' ids written and read back; see :func:`write_ids`."""
    path = _uri(scratch_path(spark, "token-files"))
    return read_digests(write_ids(docs, path, vocabulary), path)
