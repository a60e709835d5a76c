"""Mixing sources to target weights, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corvane.llm.common import WORD, prefix_sums
from corvane.session import cut

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix"


def mix_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """(no_source, source, source_size, target) from ``sizes(no_source, source, source_size)``.

    Sources in order take the weights in turn and share ``share`` of all sizes. A target
    stops at ``max_epochs`` times its source's size and the excess is shared again by weight:
    the result is least(cap, weight * level) with one level for all, found by prefix sums
    over the sources in order of cap / weight.
    """
    ranked = prefix_sums(sizes.withColumn("one", F.lit(1)), [], ["one"], F.col("no_source"), F.col("source"))
    turn = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("one_before") % len(weights) + 1).cast("int"))
    capped = cut(
        ranked.select("no_source", "source", "source_size", turn.cast("bigint").alias("weight"))
        .withColumn("cap", F.col("source_size") * max_epochs)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    totals = capped.agg(
        (F.sum("source_size") * F.lit(share)).alias("goal"), F.sum("weight").alias("weights"))
    level = (
        prefix_sums(capped, [], ["cap", "weight"], F.col("ratio"), F.col("no_source"), F.col("source"))
        .withColumn("level", (totals.select("goal").scalar() - F.col("cap_before"))
                    / (totals.select("weights").scalar() - F.col("weight_before")))
        .filter("level <= ratio")
        .agg(F.min(F.struct("ratio", "no_source", "source", "level")).alias("first"))
        .select(F.coalesce("first.level", F.lit(0.0)))
    )
    return capped.select(
        "no_source", "source", "source_size",
        F.least(F.col("cap").cast("double"), F.col("weight") * level.scalar()).alias("target"),
    )


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
    max_epochs: int = MAX_EPOCHS, seed: str = SEED, id_col: str = "doc_id",
    source_col: str = "source", text_col: str = "text", row_col: str | None = None,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source): words that the mix takes of each row.

    ``row_col`` names a column that is passed on as ``row``.

    Rows get a hash-random key (MD5 of seed and id) and are range-sorted by source and key;
    distributed prefix sums of the word counts place each row on its source's line. Whole
    passes over the source come first, the rest of the budget is cut at the exact word, so a
    source gives floor(target) words and the row at the cut gives a part of itself.

    Null or empty text has size 0 and gives nothing. A null source is a source of its own,
    last in order. Rows that repeat an id are separate rows. No words at all: all targets 0.
    The order is fixed by key, id and size, so reruns agree.
    """
    sized = cut(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).isNull().alias("no_source"),
        F.coalesce(F.col(source_col), F.lit("")).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        *([F.col(row_col).alias("row")] if row_col else []),
    ))
    by_source = sized.groupBy("no_source", "source").agg(F.sum("size").alias("source_size"))
    targets = mix_targets(by_source, weights, share, max_epochs)
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    lined = prefix_sums(sized, ["no_source", "source"], ["size"], key, F.col("doc_id"), F.col("size"))
    total, budget = F.col("source_size"), F.floor("target")
    passes = F.coalesce(F.expr("try_divide(floor(target), source_size)").cast("bigint"), F.lit(0))
    rest = budget - passes * total
    return lined.join(targets, ["no_source", "source"]).select(
        "doc_id", "size", "source_size", "target",
        (passes * F.col("size") + F.greatest(
            F.lit(0), F.least(F.col("size"), rest - F.col("size_before")))).cast("bigint").alias("taken"),
        F.when(~F.col("no_source"), F.col("source")).alias("source"), *(["row"] if row_col else []),
    )


SQL = r"""
WITH t AS (
  SELECT doc_id, source IS NULL AS no_source, coalesce(source, '') AS source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT no_source, source, CAST(sum(size) AS BIGINT) AS source_size FROM t GROUP BY ALL),
w AS (
  SELECT *, CAST([3, 1, 2][(row_number() OVER (ORDER BY no_source, source) - 1) % 3 + 1] AS BIGINT) AS weight,
         source_size * 2 AS cap FROM s),
c AS (SELECT *, cap / weight AS ratio FROM w),
p AS (
  SELECT *, CAST(sum(cap) OVER o - cap AS BIGINT) AS cap_before, CAST(sum(weight) OVER o - weight AS BIGINT) AS weight_before
  FROM c WINDOW o AS (ORDER BY ratio, no_source, source)),
l AS (
  SELECT *, ((SELECT CAST(sum(source_size) AS DOUBLE) * 1.5::DOUBLE FROM s) - cap_before)
            / ((SELECT CAST(sum(weight) AS BIGINT) FROM w) - weight_before) AS level FROM p),
b AS (SELECT coalesce(arg_min(level, (ratio, no_source, source)), 0.0) AS level FROM l WHERE level <= ratio),
g AS (SELECT c.*, least(CAST(cap AS DOUBLE), weight * b.level) AS target FROM c, b),
d AS (
  SELECT *, CAST(sum(size) OVER (PARTITION BY no_source, source
           ORDER BY md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id NULLS FIRST, size
           ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS size_before FROM t),
j AS (
  SELECT d.*, g.source_size, g.target, CAST(floor(g.target) AS BIGINT) AS budget,
         CASE WHEN g.source_size = 0 THEN 0 ELSE CAST(floor(g.target) AS BIGINT) // g.source_size END AS passes
  FROM d JOIN g USING (no_source, source))
SELECT doc_id, size, source_size, target,
       CAST(passes * size + greatest(0, least(size, budget - passes * source_size - size_before)) AS BIGINT) AS taken,
       CASE WHEN NOT no_source THEN source END AS source
FROM j
"""
