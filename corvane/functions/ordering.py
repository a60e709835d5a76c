"""Global order without a single-task window.

A window with no (or a skewed) partition key sorts all rows in one task. These helpers
sort once by range, fix the placement with a checkpoint, and combine per-chunk results
with one small row per chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corvane.session import cut

_SLOT_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def place_in_order(df: DataFrame, *order: Column) -> DataFrame:
    """Range-sort ``df`` and add ``_chunk`` and ``_at`` (position inside the chunk).

    The checkpoint matters: chunk numbers are read more than once, and a recomputed sort
    may choose other range bounds.
    """
    placed = cut(df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()))
    return placed.select(
        *df.columns,
        F.shiftright("_slot", _SLOT_BITS).alias("_chunk"),
        F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1)).alias("_at"),
    )


def with_global_rank(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """Add the 1-based position of each row in the given total order."""
    placed = place_in_order(df, *order)
    sizes = placed.groupBy("_chunk").agg(F.count("*").alias("_rows"))
    # one row per sort chunk, so this window and the broadcast are small
    before = sizes.select(
        "_chunk",
        (F.sum("_rows").over(Window.orderBy("_chunk")) - F.col("_rows")).alias("_before"),
    )
    return placed.join(F.broadcast(before), "_chunk").select(
        *df.columns, (F.col("_before") + F.col("_at") + 1).alias(name)
    )


def with_running_total(
    df: DataFrame, value: str, *order: Column, name: str = "total_before"
) -> DataFrame:
    """Add the sum of ``value`` over all rows that come earlier in the order."""
    placed = place_in_order(df, *order)
    sums = placed.groupBy("_chunk").agg(F.sum(value).alias("_sum"))
    before = sums.select(
        "_chunk",
        (F.sum("_sum").over(Window.orderBy("_chunk")) - F.col("_sum")).alias("_before"),
    )
    local = Window.partitionBy("_chunk").orderBy("_at")
    return placed.join(F.broadcast(before), "_chunk").select(
        *df.columns,
        (F.col("_before") + F.sum(value).over(local) - F.col(value)).alias(name),
    )


def with_group_carry(
    df: DataFrame, key: str, order: str, tie: str, value: str, kind: str, name: str
) -> DataFrame:
    """Add, per key, the running minimum before a row or the previous value.

    ``kind`` is ``"min"``, ``"last"`` or ``"count"`` (rows before this one). A key that holds most rows is spread over
    many chunks; what crosses a chunk border is one row per (key, chunk).
    """
    placed = place_in_order(df, F.col(key), F.col(order), F.col(tie))
    local = Window.partitionBy(key, "_chunk").orderBy("_at")
    earlier = local.rowsBetween(Window.unboundedPreceding, -1)
    chunks = Window.partitionBy(key).orderBy("_chunk")
    if kind == "min":
        inside = F.min(value).over(earlier)
        ends = placed.groupBy(key, "_chunk").agg(F.min(value).alias("_end"))
        carried = F.min("_end").over(chunks.rowsBetween(Window.unboundedPreceding, -1))
    elif kind == "last":
        inside = F.lag(value).over(local)
        ends = placed.groupBy(key, "_chunk").agg(F.max_by(value, "_at").alias("_end"))
        carried = F.lag("_end").over(chunks)
    elif kind == "count":
        inside = F.row_number().over(local) - 1
        ends = placed.groupBy(key, "_chunk").agg(F.count("*").alias("_end"))
        carried = F.coalesce(
            F.sum("_end").over(chunks.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )
    else:
        raise ValueError(f"unknown kind {kind!r}")
    edges = ends.select(key, "_chunk", carried.alias("_carried"))
    # least() skips nulls; for "last" the carried value only serves a chunk's first row
    inner, outer = F.col("_inside"), F.col("_carried")
    combined = {
        "min": F.least(inner, outer), "last": F.coalesce(inner, outer), "count": inner + outer,
    }[kind]
    return (
        placed.withColumn("_inside", inside)
        .join(edges, [key, "_chunk"], "left")
        .select(*df.columns, combined.alias(name))
    )
