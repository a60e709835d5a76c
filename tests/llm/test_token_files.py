"""Token id files against the library, with an independent reader of the format."""

import random
import struct
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from corvane.llm import token_files as files
from corvane.llm.queries import QUERIES, TOKENIZER, vocabulary

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, ids string, part int, at string, _whole int, start string"
LIBRARY = Tokenizer.from_file(vocabulary(TOKENIZER))
EDGE = [(9, None), (2, ""), (3, " \t\n"), (4, "one"), (5, " a  b \n c "), (6, "w " * 200_000), (7, "x1, y. z!? it's 'll "),
        (7, "x1, y. z!? it's 'll "), (7, "other"), (8, "é中🙂 ﬁ  ́a"), (11, "a" * 50_000), (None, "stray"),
        (10, "x<|endoftext|>y <|endoftext|> z.<|endoftext|>"), (None, None), (-3, "A.\nB.\r\nC\x0cD  ,. ,")]


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [0]


def test_encoder_equals_library():
    draw = random.Random(1)
    encoder = files.Encoder(vocabulary(TOKENIZER))
    parts = ["word", "Word", "don't", " ", "  ", "\n", "\t ", ".", "...", "12", "é", "中", "<|endoftext|>", "<|", "a.b", "!?,", " ", " ", "_", "x" * 70]
    for _ in range(1500):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 25)))
        assert encoder.ids(text).tolist() == ids(text)[:-1], repr(text)


def test_slices_do_not_change_ids(monkeypatch):
    monkeypatch.setattr(files, "SLICE", 7)
    encoder = files.Encoder(vocabulary(TOKENIZER))
    for _, text in EDGE:
        text = (text or "")[:3000]
        assert encoder.ids(text).tolist() == ids(text)[:-1], repr(text[:50])


@pytest.mark.parametrize("high", [1, 255, 256, 65_535, 65_536, 1 << 24, (1 << 32) - 1])
def test_packing_round_trip(high):
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = np.random.default_rng(n).integers(0, high, n, dtype=np.uint32, endpoint=True)
        control, data = files.packed(ranks)
        assert len(control) == (n + 3) // 4
        assert files.unpacked(control, data, n).tolist() == ranks.tolist()


def plain_reader(path, order):
    """Documents of one file, one id at a time."""
    data = open(path, "rb").read()
    assert data[:4] == b"IDS1"
    at, out, going = 4, [], None
    while at < len(data):
        docs, count, size, goes_on = struct.unpack_from("<IIIB", data, at)
        at += 13
        nulls = data[at:at + docs]
        names = struct.unpack_from(f"<{docs}q", data, at + docs)
        lengths = struct.unpack_from(f"<{docs}I", data, at + 9 * docs)
        control = data[at + 13 * docs:at + 13 * docs + (count + 3) // 4]
        at += 13 * docs + len(control)
        found = []
        for i in range(count):
            n = (control[i // 4] >> 2 * (i % 4) & 3) + 1
            found.append(int(order[int.from_bytes(data[at:at + n], "little")]))
            at += n
        for null, name, length in zip(nulls, names, lengths):
            going = (going or []) + found[:length]
            del found[:length]
            if not goes_on:
                out.append((None if null else name, going))
                going = None
    return out


def test_files_hold_the_documents_in_order(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(i, t, "x", 1, "y", 2, "z") for i, t in EDGE], DOCS).repartition(5)
    path = f"file://{tmp_path}/ids"
    written = files.write_ids(df, path, vocabulary(TOKENIZER))
    rows = sorted(written.collect(), key=lambda r: (r.part, r["at"]))
    order = np.fromfile(f"{tmp_path}/ids/ranks.u32", "<u4")
    assert sorted(order.tolist()) == list(range(LIBRARY.get_vocab_size()))
    stored = [d for r in rows for d in plain_reader(r.file, order)]
    assert sorted((str(i), v) for i, v in stored) == sorted((str(i), ids(t)) for i, t in EDGE)
    assert [i for i, _ in stored] == sorted((i for i, _ in EDGE), key=lambda i: (i is not None, i))
    assert [r.file for r in rows] == sorted(r.file for r in rows)
    times = np.bincount([i for _, v in stored for i in v], minlength=len(order))[order]
    assert (np.diff(times) <= 0).all()
    digests = sorted(files.read_digests(written, path).collect(), key=lambda r: r.start)
    start = 0
    for r, (i, v) in zip(digests, stored, strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(v), zlib.crc32(np.array(v, "<u4").tobytes()))
        start += len(v)
    whole = {}
    for r in sorted(files.read_ids(written, path).collect(), key=lambda r: r.start):
        whole.setdefault(r.doc_id, []).extend(r.ids)
    assert whole[6] == ids("w " * 200_000)


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], DOCS)
    path = f"file://{tmp_path}/none"
    assert files.read_digests(files.write_ids(df, path, vocabulary(TOKENIZER)), path).count() == 0


def test_query_equals_library(spark):
    from corvane.llm.common import table

    rows = sorted(((r.doc_id, r.text) for r in table(spark, SF, "documents").collect()))
    want, start = [], 0
    for i, text in rows:
        v = ids(text)
        want.append((i, start, len(v), zlib.crc32(np.array(v, "<u4").tobytes())))
        start += len(v)
    got = QUERIES["op12_token_files"](spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want
