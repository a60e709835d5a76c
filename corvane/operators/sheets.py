"""Header detection in ragged sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corvane.functions.ordering import with_group_carry

MAX_HEADER = 25


def filled_cells(cells: Column | str) -> Column:
    column = F.col(cells) if isinstance(cells, str) else cells
    return F.size(F.filter(column, lambda c: c.isNotNull() & (c != "")))


def sheet_header(
    df: DataFrame, sheet: str = "sheet", row_idx: str = "row_idx", cells: str = "cells"
) -> DataFrame:
    """Rows from the detected header on, with ``row_no`` and ``is_header``.

    Blank rows go first. The header is the first row with at least as many filled cells
    as the next row; the last row has no next row and never qualifies. Without a header,
    or with one beyond index 25, row 0 is taken. Only rows 0 to 26 can decide, so the
    search reads a bounded head of each sheet.
    """
    filled = df.withColumn("_filled", filled_cells(cells)).filter(F.col("_filled") > 0)
    order = Window.partitionBy(sheet).orderBy(row_idx)
    numbered = with_group_carry(filled, sheet, row_idx, row_idx, row_idx, "count", "row_no")
    head = (
        filled.select(sheet, row_idx, "_filled")
        .withColumn("_no", F.row_number().over(order))
        .filter(F.col("_no") <= MAX_HEADER + 2)
        .withColumn("_next", F.lead("_filled").over(order))
    )
    start = head.groupBy(sheet).agg(
        F.coalesce(
            F.min(
                F.when(
                    (F.col("_filled") >= F.col("_next")) & (F.col("_no") <= MAX_HEADER + 1),
                    F.col("_no") - 1,
                )
            ),
            F.lit(0),
        ).alias("_start")
    )
    return (
        numbered.join(start, sheet)
        .filter(F.col("row_no") >= F.col("_start"))
        .select(
            sheet, row_idx, (F.col("row_no") - F.col("_start")).alias("row_no"),
            (F.col("row_no") == F.col("_start")).alias("is_header"), cells,
        )
    )
