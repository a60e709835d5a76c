"""Corpus files: text, JSON, JSON lines and CSV."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corvane.functions import text as T

PATTERNS = {"txt": "*.txt", "md": "*.md", "json": "*.json", "jsonl": "*.jsonl"}


def read_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, size, content bytes) of the matching files below ``path``.

    A file becomes one row, as its text becomes one document; use the line-based Spark
    readers for single files beyond the 2 GB row limit.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", F.col("length").alias("size"), "content")
    )


def decode_text(content: Column | str, fallback: bool = True) -> Column:
    """UTF-8 text; with ``fallback`` invalid bytes are read as Latin-1, else null."""
    raw = F.col(content) if isinstance(content, str) else content
    as_text = raw.cast("string")
    other = F.decode(raw, "ISO-8859-1") if fallback else F.lit(None).cast("string")
    return F.when(F.is_valid_utf8(as_text), as_text).otherwise(other)


def ingest_text(spark: SparkSession, path: str, pattern: str = "*.{txt,md}") -> DataFrame:
    """One row per text file: (path, text, metadata, status, error)."""
    files = read_files(spark, path, pattern)
    text = decode_text("content", fallback=False)
    return files.select(
        "path", text.alias("text"),
        F.to_json(F.struct(F.col("size").alias("file_size"))).alias("metadata"),
        F.when(text.isNull(), "error").otherwise("ok").alias("status"),
        F.when(text.isNull(), "invalid utf-8").alias("error"),
    )


def json_docs(df: DataFrame, mode: str = "v1", value: str = "value") -> DataFrame:
    """Documents in JSON texts (column ``value``): adds ``text``.

    ``v1``: a list gives one document per non-empty item, an object its ``text`` (or the
    whole object; a ``text`` that is null gives nothing), a scalar itself. ``v2``: a list is
    one document. Empty items are null, false, zero and empty texts, lists and objects.
    Invalid JSON gives no row.
    """
    keep = [c for c in df.columns if c != value]
    parsed = df.withColumn("_v", F.try_parse_json(value)).filter(F.col("_v").isNotNull())
    kind = F.schema_of_variant("_v")
    is_list = kind.startswith("ARRAY")
    is_object = kind.startswith("OBJECT")
    whole = F.when(kind == "STRING", F.try_variant_get("_v", "$", "string")).otherwise(
        F.to_json("_v")
    )
    field = F.try_variant_get("_v", "$.text", "string")
    no_text = F.coalesce(F.is_variant_null(F.try_variant_get("_v", "$.text", "variant")), F.lit(False))
    single = F.when(is_object & no_text, F.lit(None).cast("string")).when(
        is_object, F.coalesce(field, whole)
    ).otherwise(whole)
    if mode == "v2":
        return parsed.select(*keep, single.alias("text")).filter(F.length("text") > 0)
    if mode != "v1":
        raise ValueError(f"unknown mode {mode!r}")
    items = F.try_variant_get("_v", "$", "array<variant>")
    spread = parsed.select(
        *keep, F.when(is_list, items).otherwise(F.array("_v")).alias("_items"),
        is_list.alias("_list"), single.alias("_single"),
    ).select(*keep, "_list", "_single", F.explode("_items").alias("_item"))
    item_kind = F.schema_of_variant("_item")
    item = F.when(
        item_kind == "STRING", F.try_variant_get("_item", "$", "string")
    ).otherwise(F.to_json("_item"))
    filled = (
        F.when(item_kind == "VOID", False)
        .when(item_kind == "STRING", item != "")
        .when(item_kind == "BOOLEAN", item == "true")
        .when(item_kind.startswith("ARRAY"), item != "[]")
        .when(item_kind.startswith("OBJECT"), item != "{}")
        .otherwise(F.try_variant_get("_item", "$", "double") != 0)
    )
    return (
        spread.filter(~F.col("_list") | filled)
        .select(*keep, F.when(F.col("_list"), item).otherwise(F.col("_single")).alias("text"))
        .filter(F.length("text") > 0)
    )


def jsonl_text(lines: Column) -> Column:
    """Text of a JSON-lines file: the ``text`` values of its object lines, in order."""
    parsed = F.transform(lines, lambda l: F.try_parse_json(l))
    objects = F.filter(
        parsed, lambda v: v.isNotNull() & F.schema_of_variant(v).startswith("OBJECT")
    )
    texts = F.transform(
        objects,
        lambda v: F.coalesce(F.try_variant_get(v, "$.text", "string"), F.to_json(v)),
    )
    return F.array_join(texts, " ")


def corpus_load(
    spark: SparkSession, directory: str | None = None, texts: DataFrame | None = None,
    min_len: int | None = None, mode: str = "v1",
    patterns: Mapping[str, str] = PATTERNS, text_col: str = "text",
) -> DataFrame:
    """(suffix, origin, text) of a corpus folder and raw texts, cleaned and filtered.

    ``v1`` reads txt and json, drops undecodable characters, strips, and keeps 50
    characters or more. ``v2`` adds md and jsonl, falls back to Latin-1, collapses white
    space and keeps 32 or more.
    """
    if mode not in ("v1", "v2"):
        raise ValueError(f"unknown mode {mode!r}")
    parts: list[DataFrame] = []
    if directory is not None:
        for suffix in ("txt", "json") if mode == "v1" else ("txt", "md", "json", "jsonl"):
            if suffix not in patterns:
                continue
            files = read_files(spark, directory, patterns[suffix])
            if mode == "v1":
                # bytes that are not UTF-8 become U+FFFD and are dropped
                body = F.replace(
                    F.make_valid_utf8(F.col("content").cast("string")), F.lit("�"), F.lit("")
                )
            else:
                body = decode_text("content")
            named = files.select(F.col("path").alias("origin"), body.alias("value"))
            if suffix == "json":
                rows = json_docs(named, mode)
            elif suffix == "jsonl":
                rows = named.select("origin", jsonl_text(F.split("value", "\r?\n")).alias("text"))
            else:
                rows = named.select("origin", F.col("value").alias("text"))
            parts.append(rows.select(F.lit(suffix).alias("suffix"), "origin", "text"))
    if texts is not None:
        parts.append(
            texts.select(
                F.lit("raw").alias("suffix"), F.lit(None).cast("string").alias("origin"),
                F.col(text_col).cast("string").alias("text"),
            )
        )
    if not parts:
        raise ValueError("nothing to load")
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    ends = T.WHITESPACE
    clean = (
        F.regexp_replace(F.regexp_replace("text", "^" + ends, ""), ends + "$", "")
        if mode == "v1"
        else T.normalize_ws("text")
    )
    least = min_len if min_len is not None else (50 if mode == "v1" else 32)
    return rows.withColumn("text", clean).filter(F.length("text") >= least)


def ingest_csv(
    spark: SparkSession, path: str, with_text: bool = True, multi_line: bool = True
) -> DataFrame:
    """One row per ``*.csv`` file: (path, rows, columns[, text]).

    Records are counted by the CSV reader, columns in each file's own first line. Line breaks
    inside quotes need ``multi_line``, which reads a file in one task; without such cells pass
    False and large files are split. The text is the file as it is.
    """
    def below(reader):
        return reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")

    table = below(spark.read.option("header", "true")).option("multiLine", str(multi_line).lower()).csv(path)
    records = table.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("rows"))
    # a file's first split holds its first line
    lines = below(spark.read).text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), "value",
    ).filter("start = 0")
    bare = F.regexp_replace("value", '"[^"]*"', "")
    heads = lines.groupBy("path").agg(F.min_by(F.size(F.split(bare, ",")), "at").alias("columns"))
    counts = heads.join(records, "path", "left").select(
        "path", F.coalesce("rows", F.lit(0)).alias("rows"), "columns"
    )
    if not with_text:
        return counts
    files = read_files(spark, path, "*.csv").select("path", decode_text("content").alias("text"))
    # the two readers write "file:" paths with a different number of slashes
    plain = F.regexp_replace("path", "^([a-z0-9]+):/+", "$1:/")
    return counts.withColumn("_p", plain).join(
        files.select(plain.alias("_p"), "text"), "_p", "left"
    ).drop("_p")


def concat_corpus(df: DataFrame, id_col: str = "id", text: str = "text") -> DataFrame:
    """Place of every text in the corpus formed by text + newline in id order.

    (id, start, n_chars). The corpus is addressed, not built: one string of all texts
    would have to pass through a single task.
    """
    from corvane.functions.ordering import with_running_total

    sized = df.select(F.col(id_col).alias("id"), (F.length(text) + 1).cast("bigint").alias("n_chars"))
    return with_running_total(sized, "n_chars", F.col("id"), name="start").select(
        "id", "start", "n_chars"
    )


def ext_filter(df: DataFrame, path: str, extensions: list[str]) -> DataFrame:
    """Rows whose file name has one of the extensions (with or without the dot)."""
    wanted = [e.lower().lstrip(".") for e in extensions]
    return df.filter(T.file_extension(path).isin(wanted))
