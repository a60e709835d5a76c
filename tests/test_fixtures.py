"""How the given tables are read."""

from corvane.plans import fixtures as fx


def test_shares_of_a_table_do_not_grow_with_it(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fx, "PART_BYTES", 1 << 14, raising=False)
    rows = spark.range(20000).selectExpr("id AS doc_id", "md5(cast(id AS string)) AS text")
    rows.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    read = fx.table(spark, str(tmp_path), "documents")
    assert read.rdd.getNumPartitions() > 2 * spark.sparkContext.defaultParallelism
    assert read.count() == 20000 and read.distinct().count() == 20000
