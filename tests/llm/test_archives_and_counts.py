"""Archive headers read by a plain parser, and word counts of repeated rows."""

import glob
import hashlib

from corvane.llm import warc
from corvane.llm.word_model import surprises, train_words


def plain_records(path):
    """(headers, block) of every record, by the line rules of the format only."""
    data, out = open(path, "rb").read(), []
    while data:
        head, data = data.split(b"\r\n\r\n", 1)
        version, *lines = head.decode().split("\r\n")
        assert version == "WARC/1.1"
        headers = dict(line.split(": ", 1) for line in lines)
        size = int(headers["Content-Length"])
        out.append((headers, data[:size]))
        assert data[size:size + 4] == b"\r\n\r\n"
        data = data[size + 4:]
    return out


def test_headers_are_complete_and_references_resolve(spark, tmp_path):
    long = "x" * 150_000
    rows = [(1, "http://a/ b", "same " * 40), (2, "u", "same " * 40), (3, "u", "short"), (4, "u", "short"), (5, None, None),
            (6, "u", long), (7, "u", long), (None, "u", "same " * 40), (1, "u", "same " * 40), (8, "u", "\r\n\r\nWARC/1.0\r\n")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, row int").repartition(4)
    path = f"file://{tmp_path}/warc"
    files = warc.write_archives(df, path, date="2024-05-06T07:08:09Z")
    records = [r for f in glob.glob(f"{tmp_path}/warc/*.warc") for r in plain_records(f)]
    assert len(records) == len(rows) == files.agg({"records": "sum"}).first()[0]
    by_id = {h["WARC-Record-ID"]: (h, b) for h, b in records}
    assert len(by_id) == len(records)
    for headers, block in records:
        assert headers["WARC-Date"] == "2024-05-06T07:08:09Z" and headers["Content-Type"].startswith("text/html")
        assert headers["WARC-Target-URI"] is not None
        if headers["WARC-Type"] == "revisit":
            first, payload = by_id[headers["WARC-Refers-To"]]
            assert block == b"" and headers["WARC-Profile"] == warc.PROFILE
            assert first["WARC-Type"] == "response" and first["WARC-Page-ID"] == headers["WARC-Refers-To-Page"]
            assert "sha256:" + hashlib.sha256(payload).hexdigest() == headers["WARC-Payload-Digest"]
        else:
            assert "sha256:" + hashlib.sha256(block).hexdigest() == headers["WARC-Payload-Digest"]
    kinds = sorted((h["WARC-Page-ID"], h["WARC-Type"]) for h, _ in records)
    assert [k for k in kinds if k[1] == "revisit"] == [("2", "revisit"), ("7", "revisit")]
    assert warc.read_archives(files, path).rdd.getNumPartitions() >= 1


def test_words_are_counted_per_row(spark):
    trusted = spark.createDataFrame([("a b c d e f",), ("a b c",)], "text string")
    docs = spark.createDataFrame([("a b c d e f",)] * 3 + [("z",), ("",), (None,)], "text string")
    got = {r.symbols: r.surprise for r in surprises(docs, train_words(trusted)).collect()}
    once = {r.symbols: r.surprise for r in surprises(docs.distinct(), train_words(trusted)).collect()}
    assert set(got) == {6, 1} and got.keys() == once.keys()
    assert all(abs(got[k] - once[k]) < 1e-9 for k in got)
    none = train_words(trusted.limit(0))
    assert {r.symbols for r in surprises(docs, none).collect()} == {6, 1}
