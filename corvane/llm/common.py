"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from corvane.functions.ordering import place_in_order
from corvane.session import cut, scratch_path

SPACE = "\x20\t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
HOLD_OUT = 5
ROWS = 512  # texts that a task works on at a time


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(column: str) -> Column:
    """A text column in which null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ROWS rows, so what is derived from texts stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` is called so in any case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def with_whole(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` with the whole text, null as empty, as a further last column."""
    return df.withColumn(fresh(df, "_whole"), whole(text_col))


#: Spark's own setting: a query's shuffle files go when it ends, not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, safe from lost executors.

    The table replaces the shuffle files behind it, so these are removed with the write.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def held_out(id_col: str) -> Column:
    """True for the rows that no model may learn from: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % HOLD_OUT == 0


def prefix_sums(df: DataFrame, keys: list[str], values: list[str], *order: Column) -> DataFrame:
    """Add ``<value>_before`` per value: its sum over the earlier rows of the same key.

    Rows are range-sorted by key and order, so a key with most rows is spread over many tasks;
    what crosses a task border is one row per key and sort chunk. Keys must not be null.
    """
    placed = place_in_order(df, *[F.col(k) for k in keys], *order)
    local = Window.partitionBy(*keys, "_chunk").orderBy("_at")
    chunks = Window.partitionBy(*keys) if keys else Window
    sums = placed.groupBy(*keys, "_chunk").agg(*[F.sum(v).alias(v) for v in values])
    offsets = sums.select(
        *keys, "_chunk",
        *[(F.sum(v).over(chunks.orderBy("_chunk")) - F.col(v)).alias(f"{v}_offset") for v in values],
    )
    return placed.join(offsets, [*keys, "_chunk"]).select(
        *df.columns,
        *[
            (F.col(f"{v}_offset") + F.sum(v).over(local) - F.col(v)).alias(f"{v}_before")
            for v in values
        ],
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component): smallest reachable node, for the nodes of ``links(a, b)``.

    Hub-and-spoke rounds: every node points to its smallest neighbour's label, then labels
    are followed one step, until nothing changes. Each round ends in a reliable checkpoint.
    A hub's rows are first combined per task; the joins are plain ones that may be split.
    """
    both = cut(
        links.filter("a <> b")
        .select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        .select("e.*").distinct()
    )
    labels = cut(both.groupBy("a").agg(F.min("b").alias("near")).select(
        F.col("a").alias("node"), F.least("a", "near").alias("component"), F.lit(True).alias("moved")))
    while labels.filter("moved").limit(1).count():
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(
            F.min("component").alias("near"))
        lower = labels.drop("moved").join(near, F.col("node") == F.col("a")).select(
            "node", F.col("component").alias("was"), F.least("component", "near").alias("mid"))
        step = labels.select(F.col("node").alias("mid"), F.col("component").alias("next"))
        labels = cut(lower.join(step, "mid").select(
            "node", F.least("mid", "next").alias("component"),
            (F.least("mid", "next") < F.col("was")).alias("moved")))
    return labels.select("node", "component")
