import io
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corvane.streaming import activity as S, ingest


@pytest.fixture()
def events(spark, tmp_path):
    base = pd.Timestamp("2024-01-01")
    rows = [(i, base + pd.Timedelta(minutes=7 * i), i % 4, "view" if i % 3 else "edit", i % 5) for i in range(400)]
    frame = pd.DataFrame(rows, columns=["event_id", "ts", "user_id", "action", "entry_id"])
    folder = tmp_path / "in"
    folder.mkdir()
    for part in range(4):  # time-ordered files, so that no row is late
        frame[part * 100:(part + 1) * 100].to_parquet(folder / f"part{part}.parquet", coerce_timestamps="us")
    batch = S.with_event_time(spark.createDataFrame(frame).withColumn("ts", F.col("ts").cast("timestamp_ntz")))
    stream = S.with_event_time(S.read_stream(spark, str(folder), "*.parquet", files_per_trigger=1), delay="1 day")
    return batch, stream, str(tmp_path / "out")


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def test_activity_stream_equals_batch(spark, events):
    batch, stream, out = events
    S.run_available(S.activity(stream), out, "update")
    assert rows(S.updated_result(spark, out, "window_start", "entry_id", "action")) == rows(S.activity(batch))


def test_progress_stream_equals_batch(spark, events):
    batch, stream, out = events
    S.run_available(S.latest_progress(stream, "user_id", "action"), out, "update")
    assert rows(S.updated_result(spark, out, "user_id")) == rows(S.latest_progress(batch, "user_id", "action"))


def test_closed_sessions_of_the_stream_are_batch_sessions(spark, events):
    batch, stream, out = events
    S.run_available(S.collab_sessions(stream, "30 minutes"), out)
    done = rows(S.appended_result(spark, out))
    want = rows(S.collab_sessions(batch, "30 minutes"))
    assert done and set(done) <= set(want)


def test_stream_dedup(spark, events):
    batch, stream, out = events
    content = F.concat_ws("-", "user_id", "action")
    S.run_available(S.drop_duplicates(stream.withColumn("c", content), "c"), out)
    got = [r["c"] for r in S.appended_result(spark, out).collect()]
    assert len(got) == len(set(got)) == batch.select(content).distinct().count()


def test_limits(spark):
    base = pd.Timestamp("2024-01-01")
    data = [(1, "login", base + pd.Timedelta(seconds=5 * i)) for i in range(11)]
    data += [(2, "login", base + pd.Timedelta(seconds=5 * i)) for i in range(10)]
    data += [(3, "other", base + pd.Timedelta(seconds=60 * i)) for i in range(51)]
    # eleven logins around a minute border: no tumbling window sees them, a sliding one does
    data += [(4, "login", base + pd.Timedelta(seconds=33 + 5 * i)) for i in range(11)]
    df = spark.createDataFrame(pd.DataFrame(data, columns=["user_id", "action", "ts"]))
    hit = {(r["user_id"], r["action"], r["seconds"]) for r in S.rate_limit_breaches(df).collect()}
    assert hit == {(1, "login", 60), (3, "*", 3600)}
    slid = {r["user_id"] for r in S.rate_limit_breaches(df, sliding=True).filter("action = 'login'").collect()}
    assert slid == {1, 4}


def test_file_stream(spark, tmp_path):
    folder, base = tmp_path / "files", str(tmp_path / "store")
    folder.mkdir()
    (folder / "a.txt").write_text("hello world text")
    (folder / "b.bin").write_bytes(b"x")
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("in/c.md", "from the archive")
        z.writestr("in/d.txt", b"\xff\xff")
    (folder / "z.zip").write_bytes(buffer.getvalue())

    def validate(df):
        return df.withColumn("validated", F.lit(True)).withColumn("quality_score", F.lit(1.0))

    ingest.stream_ingest(spark, str(folder), base, validate)
    got = sorted(r["content"] for r in spark.read.parquet(f"{base}/entries").collect())
    assert got == ["from the archive", "hello world text"]
    bad = {r["path"].rsplit("/", 1)[1]: r["status"] for r in spark.read.parquet(f"{base}/quarantine").collect()}
    assert bad == {"b.bin": "unsupported", "d.txt": "error"}
    (folder / "e.md").write_text("a later file")
    ingest.stream_ingest(spark, str(folder), base, validate)
    assert spark.read.parquet(f"{base}/entries").count() == 3
    assert spark.read.parquet(f"{base}/history").count() == 3


def test_checkpoint_folder_is_kept(spark):
    from corvane.session import checkpoint_root, scratch_path

    root = checkpoint_root(spark)
    assert checkpoint_root(spark) == root
    assert scratch_path(spark, "x").startswith(root)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
