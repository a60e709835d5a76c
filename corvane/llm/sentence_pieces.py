"""SentencePiece encoding and decoding (merge models with byte fallback) as a streaming search."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corvane.llm.common import parts, whole, with_whole
from corvane.llm.merges import START, Merger

MARK = "▁"  # stands for a space inside pieces
SEGMENT = re.compile(r" *[^ ]+| +")
CHECK_EVERY = 32
MARKS = frozenset(".,;:!?")


class Pieces(dict):
    """A model's pieces; as a dict, packed ids of the segments met before (bounded).

    A full dict becomes ``older``, from which segments that are met again come back, so common ones stay.
    """

    LIMIT = 1 << 18  # of each of the two

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.vocab_size())
        bytes_at = {i for i in ids if model.is_byte(i)}
        plain = [i for i in ids if not (
            i in bytes_at or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        names = {model.id_to_piece(i).replace(MARK, " "): i for i in plain}
        ranks = {name: -model.get_score(i) for name, i in names.items()}
        self.byte_id = {int(model.id_to_piece(i)[3:5], 16): i for i in bytes_at}
        self.unknown = model.unk_id()
        self.merger = Merger(names, lambda a, b: ranks.get(a + b))
        #: The pieces character by character: each leads to (id of the piece that ends here, what may follow).
        self.root: dict[str, tuple] = {}
        for name in sorted(names):  # a beginning comes before what it begins
            node = self.root
            for char in name[:-1]:
                node = node.setdefault(char, (None, {}))[1]
            node[name[-1]] = (names[name], {})
        self.sizes = {i: len(name) for name, i in names.items()}
        # a piece never holds a space behind another character, so segments don't interact
        self.split = not any(" " in name.lstrip(" ") for name in names)
        self.inside = {name[i:i + 2] for name in names for i in range(len(name) - 1)}
        self.raw = [b""] * len(ids)
        for name, i in names.items():
            self.raw[i] = name.encode()
        for byte, i in self.byte_id.items():
            self.raw[i] = bytes([byte])
        self.raw[self.unknown] = " ⁇ ".encode()
        self.older: dict[str, bytes] = {}

    def spell(self, char: str) -> list[int]:
        """Ids of a character that no piece holds."""
        data = char.encode("utf-8", "surrogatepass")
        return [self.byte_id[b] for b in data] if self.byte_id else [self.unknown]

    def stream(self, units: Iterable[str]) -> Iterator[int]:
        """Ids of a text read character by character, released as early as they are certain.

        Kept are the last token of the best path to each position (its backpointer) since the
        released boundary. Paths can only go on from the last window of the longest piece's
        length; whenever the paths of all its positions run through one boundary, everything
        before that is released. Scores only order merges in these models, so the best path to
        a position is the one whose last token may follow the one before it; it is unique.
        """
        sizes, longest = self.sizes, self.merger.longest
        last: list[int | str | None] = [START]
        text, at = "", 0
        units = iter(units)
        while more := "".join(islice(units, CHECK_EVERY)):
            text += more
            last += [None] * len(more)
            end = len(text) - longest  # no token that starts before it needs a later character
            if end < max(CHECK_EVERY, 2 * longest):
                continue
            self._search(text, last, at, end + 1)
            at = end + 1
            meet = {*range(end - longest, end + 1)}
            while len(meet) > 1:  # the newest of the boundaries steps back
                newest = max(meet)
                meet.discard(newest)
                token = last[newest]
                meet.add(newest - 1 if isinstance(token, str) else newest - sizes[token])
            boundary = meet.pop()
            if boundary > 0:
                yield from self._path(last, boundary)
                last, text, at = last[boundary:], text[boundary:], at - boundary
        self._search(text, last, at, len(text) + 1)
        yield from self._path(last, len(text))

    def _path(self, last: list[int | str | None], until: int) -> list[int]:
        """Ids of the best path to a position."""
        path = []
        while until > 0:
            token = last[until]
            if isinstance(token, str):
                path += reversed(self.spell(token))
                until -= 1
            else:
                path.append(token)
                until -= self.sizes[token]
        return path[::-1]

    def _search(self, text: str, last: list[int | str | None], first: int, stop: int) -> None:
        """Fill ``last`` up to ``stop``, and behind it with what the tokens that start before ``stop`` give.

        Earlier starts come first, so a position gets the longest token that may end there.
        """
        root, known, follows, longest = self.root, self.merger.known, self.merger.follows, self.merger.longest
        for at in range(first, stop):
            before = last[at]
            if before is None:  # no token ends here
                before = last[at] = text[at - 1]
            if before.__class__ is str:
                before = START
            behind = known[before].get
            end, node = at, root
            for char in text[at:at + longest]:
                found = node.get(char)
                if found is None:
                    break
                end += 1
                token, node = found
                if token is not None and last[end] is None:
                    may = behind(token)
                    if may or (may is None and follows(before, token)):
                        last[end] = token

    def __missing__(self, segment: str) -> bytes:
        if (known := self.older.get(segment)) is not None:
            return self._keep(segment, known)
        if segment.startswith("  "):  # runs of spaces tie in score: merge them literally
            found: list[int] = []
            for part in self.merger.merge(list(segment)):
                token = self.merger.ids.get(part)
                found += self.spell(part) if token is None else [token]
            ids = found
        elif 2 < len(segment) <= CHECK_EVERY and segment[-1] in MARKS and segment[-2:] not in self.inside:
            return self[segment[:-1]] + self[segment[-1]]  # no piece crosses this border
        elif len(segment) <= CHECK_EVERY:  # nothing could be released earlier
            last = [START, *[None] * len(segment)]
            self._search(segment, last, 0, len(segment) + 1)
            ids = self._path(last, len(segment))
        else:
            ids = self.stream(segment)
        result = array("i", ids).tobytes()
        return self._keep(segment, result) if len(segment) < 64 else result

    def _keep(self, segment: str, result: bytes) -> bytes:
        if len(self) >= self.LIMIT:
            self.older = dict(self)
            self.clear()
        self[segment] = result
        return result

    def packed(self, text: str) -> bytes:
        """Ids of a text, four bytes each."""
        if not text:
            return b""
        text = " " + text.replace(MARK, " ")
        return b"".join(map(self.__getitem__, SEGMENT.findall(text) if self.split else [text]))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """Loaded once per Python worker."""
    return Pieces(path)


def _mapped(docs: DataFrame, model: str, text_col: str, name: str, back: str | None) -> DataFrame:
    """``docs`` with the ids of the whole texts and, for ``back``, the text of these ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_pieces = pieces(model)
        for batch in parts(batches):
            lists = [model_pieces.packed(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            offsets = np.cumsum([0, *(len(x) // 4 for x in lists)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(offsets, np.frombuffer(b"".join(lists), np.int32))
            texts = [pa.array([model_pieces.decode(np.frombuffer(x, np.int32).tolist()) for x in lists],
                              pa.string())] if back else []
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids, *texts], schema=target)

    kept = docs.drop(name, *([back] if back else []))
    more = [(name, pa.list_(pa.int32())), *([(back, pa.string())] if back else [])]
    target = pa.schema([*[(f.name, to_arrow_type(f.dataType)) for f in kept.schema], *more])
    result = kept.withColumn(name, F.array().cast("array<int>"))
    return with_whole(kept, text_col).mapInArrow(
        run, (result.withColumn(back, F.lit("")) if back else result).schema)


def encode(docs: DataFrame, model: str, text_col: str = "text", name: str = "ids") -> DataFrame:
    """``docs`` with ``name``: the piece ids of the whole text, without begin or end marks.

    Null and empty texts give an empty list. Other columns are passed on; one called ``name``
    is replaced. Memory beyond the text itself is a window of the longest piece.
    """
    return _mapped(docs, model, text_col, name, None)


def encode_and_decode(
    docs: DataFrame, model: str, text_col: str = "text", name: str = "ids", back: str = "decoded",
) -> DataFrame:
    """``encode`` and, in the same pass over the texts, ``back``: the text of the ids."""
    return _mapped(docs, model, text_col, name, back)


def decode(encoded: DataFrame, model: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """``encoded`` with ``name``: the text of the ids. Null counts as no ids, an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_pieces = pieces(model)
        for batch in parts(batches):
            lists = batch.column(batch.schema.get_field_index(ids_col))
            texts = [model_pieces.decode(x.values.to_numpy(zero_copy_only=False).tolist()) if x.is_valid else ""
                     for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, name])

    kept = encoded.drop(name)
    return kept.mapInArrow(run, kept.withColumn(name, F.lit("")).schema)


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_ids, ids, same): ids of every row, and whether decoding gives the text back.

    The models write spaces as U+2581, so such a character comes back as a space.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text"))
    return encode_and_decode(rows, model).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_ids"), "ids",
        (F.col("decoded") == F.replace("text", F.lit(MARK), F.lit(" "))).alias("same"))
