"""Plugins of a shipped package archive."""

import subprocess
import sys

from corvane.plans.store_queries import plugin_archive
from corvane.sources import extractors


def test_plugins_run_from_a_shipped_archive(spark, tmp_path):
    extractors.ship_package(spark, plugin_archive(str(tmp_path)))
    registry = extractors.Registry()
    assert registry.load_plugins() == [] and set(registry.by_ext) == {".page", ".broken"}
    files = spark.createDataFrame([("a.page", b"<p><b>"), ("b.broken", b""), ("c.other", b"")], "path string, content binary").repartition(3)
    got = {r.path: (r.text, r.status, r.error) for r in extractors.extract(files, registry).collect()}
    assert got == {"a.page": ("2", "ok", None), "b.broken": (None, "error", "cannot read b.broken"),
                   "c.other": (None, "unsupported", "unsupported type: other")}


def test_functions_come_from_the_archive(tmp_path):
    """Without Spark and without this package: the archive alone makes the entry point loadable."""
    path = plugin_archive(str(tmp_path))
    code = ("import importlib.metadata as m; p, = m.entry_points(group='data_processing.plugins'); "
            "print(p.load()()['.page']('x', b'<<')[0])")
    out = subprocess.run([sys.executable, "-c", code], env={"PYTHONPATH": path}, cwd=tmp_path, capture_output=True, text=True)
    assert out.stdout.strip() == "2", out.stderr
