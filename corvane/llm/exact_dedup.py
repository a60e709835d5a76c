"""Exact duplicates by most-significant-byte-first radix partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corvane.llm.common import SPACE, written, whole

FIRST_DIGIT = 16
SECOND_DIGIT = 4096
GROWTH = 16


def normalised(text: Column) -> Column:
    """The text without any of the six ASCII white-space characters."""
    for char in SPACE:
        text = F.replace(text, F.lit(char), F.lit(""))
    return text


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, row), one row per input row.

    A document is read as its length followed by its bytes. Level by level rows are grouped
    by the bytes read so far; groups of one row are finished, and so are groups whose texts
    have ended: their rows are equal byte by byte, no digest decides. Digits grow with the
    depth (16 bytes, 4 KiB, then 16 times more), so the number of levels is logarithmic in
    the longest text, and from the second level on only rows with a partner take part.
    Group counts are combined per task before they are shuffled and joined back by plain
    joins that adaptive execution may split, so one huge group of copies is no single task.

    Null text counts as empty; all empty texts are one group. The row with the most code
    points in its original text stays, then the smallest doc_id (null last); of rows that
    repeat both id and text one stays, the one with the smallest ``row``: a number of the row,
    ``row_col`` if that names a unique bigint column. No rows in, no rows out. Other columns
    are ignored.
    """
    text = whole(text_col)
    base = docs.select(
        F.col(id_col).alias("doc_id"), (F.col(row_col) if row_col else F.lit(0)).alias("given"), F.length(text).alias("n_cp"),
        normalised(text).cast("binary").alias("body"),
    ).withColumn("n", F.length("body")).withColumn("digit", F.substring("body", 1, FIRST_DIGIT))
    shared = base.groupBy("n", "digit").agg(F.count("*").alias("rows")).filter("rows > 1")
    level = written(
        base.join(shared, ["n", "digit"], "left").select(
            (F.col("given") if row_col else F.monotonically_increasing_id()).alias("row"),
            "doc_id", "n_cp", "n",
            F.sha2("body", 256).alias("text_sha256"),
            F.when(F.col("rows") > 1, F.col("body")).alias("body"),
        ), "radix",
    )
    alone = [F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
             F.lit(True).alias("kept"), "text_sha256", "row"]
    done = level.filter("body is null").select("doc_id", *alone)
    going = ["row", "doc_id", "n_cp", "n", "text_sha256", "body"]
    rest, width = level.filter("body is not null").select(*going), SECOND_DIGIT
    while rest.limit(1).count():
        rest = rest.withColumn("digit", F.expr(f"substring(body, 1, {width})"))
        groups = rest.groupBy("n", "digit").agg(
            F.count("*").alias("group_size"),
            F.max(F.struct("n_cp", F.expr("~doc_id").alias("doc"), F.expr("~row").alias("row"))).alias("best"),
        )
        ended = F.col("n") <= width
        level = written(
            rest.join(groups, ["n", "digit"]).select(
                "row", "doc_id", "n_cp", "n", "text_sha256", "group_size",
                F.expr("~best.doc").alias("keep_id"), (F.expr("~best.row") == F.col("row")).alias("kept"),
                F.when(~ended & (F.col("group_size") > 1), F.col("body")).alias("body"),
            ), "radix",
        )
        done = done.union(level.filter("body is null").select(
            "doc_id", "keep_id", "group_size", "kept", "text_sha256", "row"))
        rest, width = level.filter("body is not null").select(*going), width * GROWTH
    return done


SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_cp,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body FROM documents),
r AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size
  FROM t WINDOW w AS (PARTITION BY body ORDER BY n_cp DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM r
"""
