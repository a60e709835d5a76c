"""Filtered, ordered and paged views of the entry table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corvane.functions import text as T


def list_entries(
    entries: DataFrame, search: str | None = None, data_type: str | None = None,
    validated: bool | None = None, metadata_query: str | None = None,
) -> DataFrame:
    """Entries that satisfy every given filter (substring match, case-insensitive)."""
    found = entries
    if search:
        found = found.filter(T.contains_ci("content", search) | T.contains_ci("source", search))
    if data_type:
        found = found.filter(F.col("data_type") == data_type)
    if validated is not None:
        found = found.filter(F.col("validated") == F.lit(validated))
    if metadata_query:
        found = metadata_filter(found, metadata_query)
    return found


def metadata_filter(entries: DataFrame, text: str) -> DataFrame:
    """Entries whose metadata JSON contains the text."""
    return entries.filter(T.contains_ci("metadata", text))


def tag_filter(entries: DataFrame, tag: str, tags: str = "tags") -> DataFrame:
    """Typed form of the metadata filter, on an array column."""
    return entries.filter(F.array_contains(tags, tag))


def fulltext_match(entries: DataFrame, query: str) -> DataFrame:
    """Entries with any query token in content or source."""
    wanted = T.letter_tokens(F.lit(query))
    return entries.filter(
        F.arrays_overlap(T.letter_tokens("content"), wanted)
        | F.arrays_overlap(T.letter_tokens("source"), wanted)
    )


def unvalidated(entries: DataFrame, search: str | None = None) -> DataFrame:
    return list_entries(entries, search=search, validated=False)


def quality_gate(entries: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Validated entries with a score strictly above the threshold."""
    return entries.filter(F.col("validated") & (F.col("quality_score") > threshold))


def min_length(df: DataFrame, text: str, chars: int) -> DataFrame:
    return df.filter(F.length(text) >= chars)


def page_by_quality(entries: DataFrame, page: int = 1, per_page: int = 20) -> DataFrame:
    """One page, best quality first, ties by id."""
    ordered = entries.orderBy(F.col("quality_score").desc(), F.col("id"))
    if page > 1:
        ordered = ordered.offset((page - 1) * per_page)
    return ordered.limit(per_page)


def paged_total(found: DataFrame, per_page: int = 20) -> DataFrame:
    """(total, pages) of the same filtered frame."""
    return found.agg(F.count("*").alias("total")).select(
        "total", F.ceil(F.col("total") / F.lit(per_page)).alias("pages")
    )


def list_row(entries: DataFrame) -> DataFrame:
    """The columns of the list view; ``is_anomaly`` must be present."""
    return entries.select(
        "id", F.col("data_type").alias("type"), "source",
        T.status_label("validated").alias("status"), F.col("quality_score").alias("quality"),
        "metadata", T.preview("content").alias("content_preview"), "is_anomaly",
    )


def export_row(entries: DataFrame) -> DataFrame:
    """The columns of an export; content is a 100-character preview plus dots."""
    return entries.select(
        "id", "data_type", F.concat(T.preview("content"), F.lit("...")).alias("content"),
        "source", "validated", "metadata", "quality_score", "is_anomaly",
    )


def mark_anomalies(entries: DataFrame, flagged: DataFrame) -> DataFrame:
    """Add ``is_anomaly`` from a frame of flagged ids."""
    marks = flagged.select("id", F.lit(True).alias("_flag"))
    return entries.join(marks, "id", "left").select(
        *entries.columns, F.coalesce("_flag", F.lit(False)).alias("is_anomaly")
    )


def export_preview(exported: DataFrame, rows: int = 5) -> DataFrame:
    return exported.orderBy(F.col("quality_score").desc(), F.col("id")).limit(rows)
