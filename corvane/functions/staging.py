"""Evaluate derived columns once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def stage(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters and lambdas reuse as values.

    The optimizer replaces a plain alias by its expression wherever a filter is pushed
    below it, so a costly column (a token array, say) would be evaluated again for every
    mention, even per element inside a lambda. A one-row generator stops that; it is a
    narrow operator and filters on the other columns still reach the scan.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(row)))
