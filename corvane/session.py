"""Session defaults and the places where a job may write intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "corvane", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC time and Arrow transfer switched on.

    Cluster sizing (executors, memory, shuffle partitions) stays with the submitter;
    pass overrides as keyword arguments with dots written as double underscores.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    It is read from ``spark.checkpoint.dir``. Only a local session without that
    setting gets a temporary folder; on a cluster a missing setting is an error,
    because a folder on one machine would be lost together with its executor.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="corvane-")
    context.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Reliable eager checkpoint: ends the lineage and fixes row placement."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path for an intermediate table below the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


#: Spark's own setting: the shuffle files of a query go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back.

    It ends the lineage like :func:`cut`, in columns that can be pruned and compressed, and the
    shuffle files behind it go with the write.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Remove written tables from the shared folder, once all that was made of them is written too."""
    for df in tables:
        context = df.sparkSession.sparkContext
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
