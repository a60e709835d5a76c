"""Sinks for the export projection."""

from __future__ import annotations

from pyspark.sql import DataFrame


def export(rows: DataFrame, path: str, fmt: str = "json") -> str:
    """Write an export as a folder of JSON-lines or CSV files."""
    writer = rows.write.mode("errorifexists")
    if fmt == "json":
        writer.json(path)
    elif fmt == "csv":
        writer.option("header", "true").option("escape", '"').csv(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return path
