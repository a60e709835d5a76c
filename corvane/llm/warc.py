"""WARC archives written from and read back as chunk rows, with digests carried along."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from corvane.llm.common import whole, written
from corvane.session import scratch_path

CHUNK = 1 << 16
LEAST_REVISIT = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIELDS = {"WARC-Page-ID": "page_id", "WARC-Type": "record_type", "WARC-Refers-To-Page": "refers_to",
          "WARC-Payload-Digest": "declared", "WARC-Payload-Length": "payload_bytes", "WARC-Target-URI": "url"}
CHUNK_SCHEMA = ("page_id bigint, record_type string, refers_to bigint, declared string, payload_bytes bigint, "
                "chunk_no bigint, n_bytes bigint, digest_so_far string, last boolean, bytes binary")


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _uri(path: str) -> str:
    return path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path


def records(pages: DataFrame, id_col: str, payload_col: str, url_col: str | None) -> DataFrame:
    """One row per record with length and digest of the full payload, type and reference."""
    payload = whole(payload_col).cast("binary")
    base = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("page_id"),
        (F.col(url_col) if url_col else F.lit("")).alias("url"), payload.alias("payload"),
        F.length(payload).cast("bigint").alias("payload_bytes"), F.sha2(payload, 256).alias("digest"))
    # digests of one record only need no row here; the payload itself is joined once
    first = base.filter((F.col("payload_bytes") >= LEAST_REVISIT) & F.col("page_id").isNotNull()).groupBy("digest").agg(
        F.min(F.struct("page_id", "row")).alias("first"), F.count("*").alias("records")).filter("records > 1").select(
        F.col("digest").alias("of"), "first")
    later = F.coalesce(F.col("first.page_id") < F.col("page_id"), F.lit(False))
    return base.join(first, F.when(F.col("payload_bytes") >= LEAST_REVISIT, F.col("digest")) == F.col("of"), "left").select(
        "row", "page_id", "url", "payload_bytes", "digest", F.when(later, F.col("first.page_id")).alias("refers_to"),
        F.when(later, F.col("first.row")).alias("refers_to_row"),
        F.when(later, F.lit(b"")).otherwise(F.col("payload")).alias("payload"))


def _record_id(page_id: int | None, row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, str((page_id, row)))}>"


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", payload_col: str = "html", url_col: str | None = "url",
    date: str | None = None, content_type: str = "text/html; charset=utf-8",
) -> DataFrame:
    """Write a WARC record per row below ``path``; returns the written files (file, records, bytes).

    ``date`` (now, if not given) and ``content_type`` go into every record; a revisit names its
    profile and the record it refers to.

    Payloads are cut into rows (record, chunk number, bytes) of at most 64 KiB where the records
    lie, before Python gets them. Rows of a record stay together and in order, so a task streams them into its
    archive, updating the digest chunk by chunk and checking it against the declared one. Of
    records with equal payloads of at least 100 bytes the smallest page_id is the response, the
    others are revisits without payload. A file has a name of its own per attempt, and only the
    files of successful attempts are in the returned table, so lost tasks leave nothing visible.

    Null payloads are empty; rows that repeat an id and payload are responses alike; null ids are
    responses with an empty id; names with line breaks in the address are cut to one line.
    """
    rows = records(pages, id_col, payload_col, url_col)
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    last = F.greatest(F.lit(0), F.floor((F.length("payload") - 1) / CHUNK)).cast("int")
    chunks = (
        rows.withColumn("last", last).withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.col("last"))))
        .select("row", "page_id", "url", "payload_bytes", "digest", "refers_to", "refers_to_row", "chunk_no", "last",
                F.length("payload").alias("stored"),
                F.expr(f"substring(payload, chunk_no * {CHUNK} + 1, {CHUNK})").alias("bytes"))
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _open(path)
        out, name, count, digest = None, f"{folder}/{uuid.uuid4().hex}.warc", 0, None
        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    system.create_dir(folder, recursive=True)
                    out = system.open_output_stream(name)
                if r["chunk_no"] == 0:
                    count, digest = count + 1, hashlib.sha256()
                    revisit = r["refers_to"] is not None
                    lines = [
                        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
                        f"WARC-Record-ID: {_record_id(r['page_id'], r['row'])}", f"WARC-Date: {date}",
                        f"WARC-Target-URI: {' '.join((r['url'] or '').split())}",
                        f"WARC-Page-ID: {'' if r['page_id'] is None else r['page_id']}",
                        f"WARC-Payload-Digest: sha256:{r['digest']}", f"WARC-Payload-Length: {r['payload_bytes']}",
                        *([f"WARC-Refers-To-Page: {r['refers_to']}",
                           f"WARC-Refers-To: {_record_id(r['refers_to'], r['refers_to_row'])}",
                           f"WARC-Profile: {PROFILE}"] if revisit else []),
                        f"Content-Type: {content_type}",
                        f"Content-Length: {r['stored']}", "", ""]
                    out.write("\r\n".join(lines).encode())
                out.write(r["bytes"])
                digest.update(r["bytes"])
                if r["chunk_no"] == r["last"]:
                    if not revisit and digest.hexdigest() != r["digest"]:
                        raise ValueError(f"page {r['page_id']}: the chunks do not give the payload")
                    out.write(b"\r\n\r\n")
        if out is not None:
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [count], "bytes": [size]})

    return written(chunks.mapInArrow(write, "file string, records bigint, bytes bigint"), "archives")


def read_archives(files: DataFrame, path: str, with_bytes: bool = True) -> DataFrame:
    """Chunk rows of the archives in ``files(file)``, read as streams of at most 64 KiB.

    Each row has the SHA-256 of its record up to and including the chunk; ``last`` marks the row
    whose digest covers the whole stored payload. No record is held in memory.
    """
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, _ = _open(path)
        for batch in batches:
            for name in batch["file"]:
                with system.open_input_stream(name) as stream:
                    yield from _table(_chunks(stream, with_bytes))

    return files.select("file").repartition(max(1, files.count()), "file").mapInPandas(read, CHUNK_SCHEMA)


class _Lines:
    """Lines and counted bytes of a stream, through one bounded buffer."""

    def __init__(self, stream):
        self.stream, self.held = stream, b""

    def take(self, n: int) -> bytes:
        while len(self.held) < n and (more := self.stream.read(CHUNK)):
            self.held += more
        out, self.held = self.held[:n], self.held[n:]
        return out

    def line(self) -> bytes:
        while b"\r\n" not in self.held and (more := self.stream.read(CHUNK)):
            self.held += more
        out, _, self.held = self.held.partition(b"\r\n")
        return out


def _chunks(stream, with_bytes: bool) -> Iterator[dict]:
    source = _Lines(stream)
    while version := source.line():
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a record: {version[:40]!r}")
        head: dict = dict.fromkeys(FIELDS.values())
        length = 0
        while line := source.line():
            name, _, value = line.decode().partition(": ")
            if name in FIELDS:
                head[FIELDS[name]] = value
            elif name == "Content-Length":
                length = int(value)
        for number in ("page_id", "refers_to", "payload_bytes"):
            head[number] = int(head[number]) if head[number] else None
        head["declared"] = head["declared"].removeprefix("sha256:")
        del head["url"]
        digest, left, at = hashlib.sha256(), length, 0
        while at == 0 or left:
            data = source.take(min(left, CHUNK))
            if len(data) < min(left, CHUNK):
                raise ValueError("the archive ends within a record")
            digest.update(data)
            left -= len(data)
            yield head | {"chunk_no": at, "n_bytes": len(data), "digest_so_far": digest.hexdigest(),
                          "last": left == 0, "bytes": data if with_bytes else None}
            at += 1
        source.take(4)


def _table(rows: Iterator[dict]) -> Iterator[pd.DataFrame]:
    columns = [c.strip().split()[0] for c in CHUNK_SCHEMA.split(",")]
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= 256:
            yield _frame(held, columns)
            held = []
    if held:
        yield _frame(held, columns)


def _frame(rows: list[dict], columns: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=columns)
    return frame.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"})


def archived_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) as read from the archives.

    A response's length and digest are those of the bytes read; a revisit has no bytes, its
    header names them.
    """
    path = _uri(scratch_path(spark, "warc"))
    rows = read_archives(write_archives(pages, path), path, with_bytes=False).filter("last")
    revisit = F.col("record_type") == "revisit"
    return rows.select(
        "page_id",
        F.when(revisit, F.col("payload_bytes")).otherwise(F.col("chunk_no") * CHUNK + F.col("n_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("declared")).otherwise(F.col("digest_so_far")).alias("payload_digest"),
        "record_type", "refers_to")


SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT html, min(page_id) AS first FROM p WHERE strlen(html) >= 100 GROUP BY html)
SELECT p.page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes, sha256(p.html) AS payload_digest,
       CASE WHEN f.first < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first < p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.html = f.html
"""
