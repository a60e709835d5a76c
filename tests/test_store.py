import pytest
from pyspark.sql import functions as F

from corvane.operators import listing, quality, store
from corvane.sources import exports


def stamp(text):
    return F.lit(text).cast("timestamp_ntz")


def validate(df):
    features = quality.text_features(df, ["paris"], ["the"], {"good": 0.5})
    return quality.validate(features)


GOOD = "Paris is a good town with many old streets"


@pytest.fixture()
def base(spark):
    rows = [(1, "txt", GOOD + ". Second sentence here.", "a", "{}"), (2, "md", "too bad", "b", '{"tags":1}'),
            (3, "txt", "plain words without any known name at all", "c", "{}")]
    batch = spark.createDataFrame(rows, "id long, data_type string, content string, source string, metadata string")
    return store.store_entries(batch, validate, stamp("2024-01-01 00:00:00"))


def ids(df, col="id"):
    return sorted(r[col] for r in df.select(col).collect())


def test_store(base):
    got = {r["id"]: r["validated"] for r in base.entries.collect()}
    assert got == {1: True, 2: False, 3: False}
    assert base.history.count() == 3 and base.audit.count() == 3
    assert ids(base.sentences, "entry_id") == [1, 1, 2, 3]


def test_update_keeps_type_and_ignores_unknown_ids(spark, base):
    changes = spark.createDataFrame([(2, GOOD), (99, GOOD)], "id long, content string")
    new = store.update_entries(base, changes, validate, stamp("2024-02-01 00:00:00"))
    row = new.entries.filter("id = 2").first()
    assert (row["data_type"], row["metadata"], row["validated"]) == ("md", '{"tags":1}', True)
    assert ids(new.history, "entry_id") == [1, 2, 2, 3] and new.entries.count() == 3
    assert new.sentences.filter("entry_id = 2").first()["sentence"] == GOOD
    assert new.audit.filter("action = 'update'").count() == 1


def test_several_changes_of_one_entry(spark, base):
    rows = [(2, GOOD, 1), (2, "second version", 2), (2, "second version", 2), (3, "only one", 1)]
    changes = spark.createDataFrame(rows, "id long, content string, seq int")
    new = store.update_entries(base, changes, validate, stamp("2024-02-01 00:00:00"))
    assert ids(new.entries) == [1, 2, 3] and ids(new.history, "entry_id") == [1, 2, 2, 2, 3, 3]
    assert new.entries.filter("id = 2").first()["content"] == "second version"
    assert new.history.select("id").distinct().count() == 6 and ids(new.sentences, "entry_id") == [1, 1, 2, 3]
    assert new.audit.filter("action = 'update'").count() == 3
    wanted = new.history.filter("entry_id = 2").select("entry_id", F.col("id").alias("history_id"))
    back = store.restore_entries(new, wanted, validate, stamp("2024-03-01 00:00:00"))
    assert ids(back.entries) == [1, 2, 3] and back.audit.filter("action = 'restore'").count() == 3
    steps = [(2, "delete", None, 2), (2, "update", GOOD, 1), (2, "update", "too late", 3)]
    actions = spark.createDataFrame(steps, "id long, action string, content string, seq int")
    done = store.review_apply(base, actions, validate, stamp("2024-02-01 00:00:00"))
    assert ids(done.entries) == [1, 3] and done.history.filter("content = 'too late'").count() == 0


def test_delete_then_restore_brings_the_old_content_back(spark, base):
    changes = spark.createDataFrame([(1, "short")], "id long, content string")
    updated = store.update_entries(base, changes, validate, stamp("2024-02-01 00:00:00"))
    gone = store.delete_entries(updated, spark.createDataFrame([(1,), (50,)], "id long"), stamp("2024-02-02 00:00:00"))
    assert ids(gone.entries) == [2, 3] and ids(gone.history, "entry_id") == [1, 1, 2, 3]
    first = gone.history.filter("entry_id = 1").orderBy("ts").first()
    wanted = spark.createDataFrame([(1, first["id"]), (2, "no such version"), (77, "x")], "entry_id long, history_id string")
    back = store.restore_entries(gone, wanted, validate, stamp("2024-03-01 00:00:00"))
    row = back.entries.filter("id = 1").first()
    assert row["content"].startswith(GOOD) and row["data_type"] == "restored"
    assert (row["source"], row["metadata"], row["validated"]) == ("history", "{}", True)
    assert back.history.count() == gone.history.count()
    status = {r["entry_id"]: r["status"] for r in store.restore_status(wanted, gone.history).collect()}
    assert status == {1: "restored", 2: "unknown_version", 77: "no_history"}


def test_review(spark, base):
    actions = spark.createDataFrame([(1, "skip", "x"), (2, "update", GOOD), (3, "delete", None)], "id long, action string, content string")
    new = store.review_apply(base, actions, validate, stamp("2024-02-01 00:00:00"))
    assert {r["id"]: r["validated"] for r in new.entries.collect()} == {1: True, 2: True}


def test_update_warning_skips_the_own_old_version(spark, base):
    changes = spark.createDataFrame([(1, GOOD), (2, GOOD + ". Second sentence here.")], "id long, content string")
    from corvane.functions import text as T
    got = store.update_warnings(base, changes, T.letter_tokens, 0.9)
    assert ids(got) == [2]


def test_latest_version_as_of(base, spark):
    changes = spark.createDataFrame([(1, "new text")], "id long, content string")
    new = store.update_entries(base, changes, validate, stamp("2024-02-01 00:00:00"))
    now = store.latest_version(new.history).filter("entry_id = 1").first()["content"]
    then = store.latest_version(new.history, stamp("2024-01-15 00:00:00")).filter("entry_id = 1").first()["content"]
    assert now == "new text" and then.startswith(GOOD)
    shown = [r["preview"] for r in store.history_list(new.history).filter("entry_id = 1").collect()]
    assert shown == ["new text", (GOOD + ". Second sentence here.")[:50]]


def test_versions_and_snapshot(spark, base, tmp_path):
    root = str(tmp_path / "store")
    store.write_version(base, root, 1)
    fewer = store.delete_entries(base, spark.createDataFrame([(1,)], "id long"), stamp("2024-02-01 00:00:00"))
    store.write_version(fewer, root, 2)
    (tmp_path / "store" / "version=000003" / "entries").mkdir(parents=True)  # no marker: not complete
    assert store.versions(spark, root) == [1, 2]
    assert ids(store.read_version(spark, root).entries) == [2, 3]
    assert ids(store.read_version(spark, root, 1).entries) == [1, 2, 3]
    with pytest.raises(ValueError):
        store.write_version(base, root, 2)
    with pytest.raises(FileNotFoundError):
        store.read_version(spark, root, 3)
    folder = store.snapshot(spark, root, str(tmp_path / "copies"), "20240101_000000")
    assert ids(spark.read.parquet(f"{folder}/entries")) == [2, 3]


def test_fingerprint_is_free_of_order_and_sees_changes(spark):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(100)], "id long, content string")
    a = store.dataset_fingerprint(df).first()
    assert a == store.dataset_fingerprint(df.repartition(7).orderBy(F.rand(1))).first()
    changed = df.withColumn("content", F.when(F.col("id") == 5, "other").otherwise(F.col("content")))
    assert a["fingerprint"] != store.dataset_fingerprint(changed).first()["fingerprint"]
    assert store.dataset_fingerprint(df.filter("id < 0")).first()["rows"] == 0


def test_token_samples_are_written_once(spark, tmp_path):
    df = spark.range(5)
    _, fresh = store.write_tokens(df, str(tmp_path), "f1")
    kept, again = store.write_tokens(df, str(tmp_path), "f1")
    _, other = store.write_tokens(df, str(tmp_path), "f2")
    assert (fresh, again, other) == (True, False, True) and kept.count() == 5


def test_list_filters(spark):
    rows = [(1, "txt", "Red apple", "s1", True, '{"a":"X_1"}', 0.9), (2, "md", "green", "apple", False, "{}", 0.5),
            (3, "md", "APPLE pie", "s3", True, "{}", 0.9)]
    df = spark.createDataFrame(rows, "id long, data_type string, content string, source string, validated boolean, metadata string, quality_score double")
    assert ids(listing.list_entries(df, "apple")) == [1, 2, 3]
    assert ids(listing.list_entries(df, "apple", validated=True)) == [1, 3]
    assert ids(listing.list_entries(df, "apple", "md", False)) == [2]
    assert ids(listing.list_entries(df, metadata_query="x_1")) == [1]
    assert ids(listing.fulltext_match(df, "pie GREEN")) == [2, 3]
    assert [r["id"] for r in listing.page_by_quality(df, 1, 2).collect()] == [1, 3]
    assert [r["id"] for r in listing.page_by_quality(df, 2, 2).collect()] == [2]
    assert tuple(listing.paged_total(df, 2).first()) == (3, 2)
    assert ids(listing.quality_gate(df, 0.9)) == []


def test_export_format(spark, tmp_path):
    with pytest.raises(ValueError):
        exports.export(spark.range(1), str(tmp_path / "x"), "xml")
