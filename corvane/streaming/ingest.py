"""Continuous file ingest: extract, validate, store; failures go to quarantine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from corvane.operators.store import Store, store_entries
from corvane.sources.extractors import Registry, error_route, expand_zip, extract


def read_file_stream(spark: SparkSession, folder: str) -> DataFrame:
    """New files below ``folder`` as (path, content)."""
    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "content")
    )


def ingest_batch(
    files: DataFrame, validate: Callable[[DataFrame], DataFrame],
    registry: Registry | None = None,
) -> tuple[Store, DataFrame]:
    """(store rows, quarantined rows) of a batch of files; zip files are expanded."""
    is_zip = F.lower("path").endswith(".zip")
    found = expand_zip(files.filter(is_zip)).withColumn("path", F.concat_ws("!", "archive", "path"))
    members = found.filter("error is null").select("path", "content")
    unread = found.filter("error is not null").select(
        "path", F.coalesce(F.ltrim("ext", F.lit(".")), F.lit("zip")).alias("ext"),
        F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("metadata"),
        F.lit("error").alias("status"), "error",
    )
    plain = files.filter(~is_zip).select("path", "content")
    good, bad = error_route(extract(plain.unionByName(members), registry))
    bad = bad.unionByName(unread)
    batch = good.select(
        F.md5("path").alias("id"), F.col("ext").alias("data_type"),
        F.col("text").alias("content"), F.col("path").alias("source"), "metadata",
    )
    return store_entries(batch, validate, F.current_timestamp()), bad


def stream_ingest(
    spark: SparkSession, folder: str, base: str, validate: Callable[[DataFrame], DataFrame],
    registry: Registry | None = None,
) -> None:
    """Process all new files and stop. Tables and quarantine land below ``base``.

    Each micro-batch writes its own folders and overwrites them when it is repeated.
    """

    def land(batch: DataFrame, number: int) -> None:
        store, bad = ingest_batch(batch, validate, registry)
        for table in ("entries", "history", "sentences", "audit"):
            getattr(store, table).write.mode("overwrite").parquet(f"{base}/{table}/batch={number}")
        bad.write.mode("overwrite").parquet(f"{base}/quarantine/batch={number}")

    query = (
        read_file_stream(spark, folder)
        .writeStream.option("checkpointLocation", f"{base}/checkpoint")
        .foreachBatch(land)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
