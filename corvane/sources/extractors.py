"""Archive members and text extraction by file extension."""

from __future__ import annotations

import importlib
import importlib.metadata
import io
import json
import posixpath
import sys
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from corvane.functions import text as T
from corvane.functions.lexicons import SUPPORTED_EXTENSIONS

# An extractor maps (path, bytes) to (text, metadata); an exception marks the row as failed.
Extractor = Callable[[str, bytes], tuple[str, dict]]
PLUGIN_GROUP = "data_processing.plugins"  # fixed value: the entry points' group


class Registry:
    """Extractors by extension (with the dot, lower case)."""

    def __init__(self) -> None:
        self.by_ext: dict[str, Extractor] = {}

    def register(self, *extensions: str) -> Callable[[Extractor], Extractor]:
        """Decorator that registers a function for the given extensions."""

        def keep(function: Extractor) -> Extractor:
            for ext in extensions:
                self.by_ext[ext.lower()] = function
            return function

        return keep

    def load_plugins(self, group: str = PLUGIN_GROUP) -> list[str]:
        """Add extractors of installed packages; a plugin returns {extension: function}.

        Plugin code must be importable on the executors (for instance ``addPyFile``).
        Returns the names of plugins that could not be loaded.
        """
        failed = []
        for point in importlib.metadata.entry_points(group=group):
            try:
                for ext, function in point.load()().items():
                    self.by_ext[ext.lower()] = function
            except Exception:
                failed.append(point.name)
        return failed


def ship_package(spark: SparkSession, archive: str) -> None:
    """Make a package archive (a zip with its ``dist-info``) importable here and on the executors.

    Spark sends the archive to every executor, and its entry points are found by ``load_plugins``.
    A function of the package is pickled by name, so tasks import it from the shipped archive.
    """
    spark.sparkContext.addPyFile(archive)
    if archive not in sys.path:
        sys.path.insert(0, archive)
    importlib.invalidate_caches()
    importlib.metadata.MetadataPathFinder.invalidate_caches()


def text_file(path: str, content: bytes) -> tuple[str, dict]:
    return content.decode("utf-8"), {"file_size": len(content)}


def csv_file(path: str, content: bytes) -> tuple[str, dict]:
    table = pd.read_csv(io.BytesIO(content))
    return table.to_string(), {"rows": len(table), "columns": len(table.columns)}


def default_registry() -> Registry:
    registry = Registry()
    registry.register(".txt", ".md")(text_file)
    registry.register(".csv")(csv_file)
    return registry


def expand_zip(
    archives: DataFrame, extensions: list[str] | None = None
) -> DataFrame:
    """Members of zip files (path, content): (archive, path, ext, content, error).

    Only members with a supported extension are kept. A broken archive gives one row without
    path and content, an unreadable member one without content; ``error`` says why.
    """
    wanted = {e.lower() for e in (extensions or SUPPORTED_EXTENSIONS)}

    def row(archive: str, path: str | None, content: bytes | None, error: Exception | None) -> pd.DataFrame:
        ext = None if path is None else posixpath.splitext(path)[1].lower()
        return pd.DataFrame({
            "archive": [archive], "path": [path], "ext": [ext], "content": [content],
            "error": [None if error is None else str(error) or type(error).__name__]})

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, content in zip(batch["path"], batch["content"]):
                try:
                    opened = zipfile.ZipFile(io.BytesIO(content))
                except Exception as problem:
                    yield row(archive, None, None, problem)
                    continue
                # one member at a time keeps only that member in memory
                for info in opened.infolist():
                    if info.is_dir() or posixpath.splitext(info.filename)[1].lower() not in wanted:
                        continue
                    try:
                        yield row(archive, info.filename, opened.read(info), None)
                    except Exception as problem:
                        yield row(archive, info.filename, None, problem)

    return archives.select("path", "content").mapInPandas(
        members, "archive string, path string, ext string, content binary, error string"
    )


def extract(files: DataFrame, registry: Registry | None = None) -> DataFrame:
    """Text of files (path, content): (path, ext, text, metadata, status, error).

    ``status`` is ``ok``, ``unsupported`` or ``error``; a failed file is a row with a
    message, never a text that happens to contain one.
    """
    table = dict((registry or default_registry()).by_ext)
    known = [ext.lstrip(".") for ext in table]
    typed = files.select("path", T.file_extension("path").alias("ext"), "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, ext, content in zip(batch["path"], batch["ext"], batch["content"]):
                try:
                    text, metadata = table["." + ext](path, bytes(content))
                    rows.append((path, ext, text, json.dumps(metadata), "ok", None))
                except Exception as problem:
                    rows.append((path, ext, None, None, "error", str(problem)))
            yield pd.DataFrame(
                rows, columns=["path", "ext", "text", "metadata", "status", "error"]
            )

    schema = "path string, ext string, text string, metadata string, status string, error string"
    done = typed.filter(F.col("ext").isin(known)).mapInPandas(run, schema)
    other = typed.filter(~F.col("ext").isin(known)).select(
        "path", "ext", F.lit(None).cast("string").alias("text"),
        F.lit(None).cast("string").alias("metadata"), F.lit("unsupported").alias("status"),
        F.concat(F.lit("unsupported type: "), "ext").alias("error"),
    )
    return done.unionByName(other)


def error_route(extracted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable rows, quarantined rows)."""
    good = F.col("status") == "ok"
    return extracted.filter(good), extracted.filter(~good)
