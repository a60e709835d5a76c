import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from corvane.operators import sheets
from corvane.sources import extractors, files
from corvane.streaming import ingest

LONG = "This sentence is long enough to be kept by both loaders."


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text(f"  {LONG}\n", encoding="utf-8")
    (tmp_path / "sub" / "latin.txt").write_bytes(("é" * 60).encode("latin-1"))
    (tmp_path / "sub" / "b.md").write_text("# Title\n\n" + LONG, encoding="utf-8")
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "list.json").write_text(json.dumps([LONG, "", None, {"k": LONG}, 0, False]))
    (tmp_path / "obj.json").write_text(json.dumps({"text": LONG + " object", "n": 1}))
    (tmp_path / "whole.json").write_text(json.dumps({"other": LONG}))
    (tmp_path / "broken.json").write_text("{nope")
    (tmp_path / "lines.jsonl").write_text("\n".join([
        json.dumps({"text": "first line of the file here"}), "not json", "[1, 2]", json.dumps({"text": "second line"})]))
    return str(tmp_path)


def test_load_v1(spark, folder):
    got = files.corpus_load(spark, folder, mode="v1")
    rows = sorted((r["suffix"], r["text"]) for r in got.collect())
    # undecodable bytes are dropped, which leaves nothing of the Latin-1 file
    assert rows == sorted([("txt", LONG), ("json", LONG), ("json", json.dumps({"k": LONG}, separators=(",", ":"))),
                           ("json", LONG + " object"), ("json", json.dumps({"other": LONG}, separators=(",", ":")))])


def test_load_v2(spark, folder):
    texts = spark.createDataFrame([("x" * 32,), ("x" * 31,), (None,)], "text string")
    got = files.corpus_load(spark, folder, texts, mode="v2")
    rows = {}
    for r in got.collect():
        rows.setdefault(r["suffix"], []).append(r["text"])
    assert sorted(rows["txt"]) == sorted([LONG, "é" * 60])
    assert rows["md"] == ["# Title " + LONG]
    assert rows["jsonl"] == ["first line of the file here second line"]
    assert rows["raw"] == ["x" * 32] and len(rows["json"]) == 3
    with pytest.raises(ValueError):
        files.corpus_load(spark)


def test_ingest_text_marks_bad_bytes(spark, folder):
    got = {r["path"].rsplit("/", 1)[1]: r for r in files.ingest_text(spark, folder).collect()}
    assert got["latin.txt"]["status"] == "error" and got["latin.txt"]["text"] is None
    assert json.loads(got["a.txt"]["metadata"]) == {"file_size": len(LONG) + 3}


def test_ingest_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,"two\nlines"\n3,4\n')
    (tmp_path / "y.csv").write_text("a,b\n5,6\n")
    (tmp_path / "z.csv").write_text('a,"b, c",d,e\n1,2,3,4\n')
    (tmp_path / "head.csv").write_text("a\n")
    (tmp_path / "note.txt").write_text("no table\n")
    got = {r["path"].rsplit("/", 1)[1]: r for r in files.ingest_csv(spark, str(tmp_path)).collect()}
    assert got["y.csv"]["rows"] == 1 and got["y.csv"]["columns"] == 2
    assert got["y.csv"]["text"] == "a,b\n5,6\n" and got["x.csv"]["rows"] == 2
    assert got["z.csv"]["columns"] == 4 and got["x.csv"]["columns"] == 2
    assert (got["head.csv"]["rows"], got["head.csv"]["columns"]) == (0, 1) and len(got) == 4


def archive(members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, content in members.items():
            z.writestr(name, content)
    return buffer.getvalue()


def test_zip_members(spark):
    good = archive({"a.txt": "x", "deep/er/b.MD": "y", "c.exe": "z", "dir/": ""})
    df = spark.createDataFrame([("one.zip", bytearray(good)), ("bad.zip", bytearray(b"no zip"))], "path string, content binary")
    got = sorted((r["archive"], r["path"], r["ext"]) for r in extractors.expand_zip(df).collect())
    assert got == [("bad.zip", None, None), ("one.zip", "a.txt", ".txt"), ("one.zip", "deep/er/b.MD", ".md")]
    broken = bytearray(good.replace(b"x", b"q", 1))  # the member's checksum no longer fits
    df = spark.createDataFrame([("two.zip", broken)], "path string, content binary")
    errors = {r["path"]: r["error"] for r in extractors.expand_zip(df).collect()}
    assert errors["a.txt"] and errors["deep/er/b.MD"] is None


def test_broken_archives_reach_quarantine(spark):
    from tests.test_store import validate
    df = spark.createDataFrame([("in/bad.zip", bytearray(b"no zip")), ("in/a.txt", bytearray(b"text"))], "path string, content binary")
    kept, bad = ingest.ingest_batch(df, validate)
    assert [(r["path"], r["status"]) for r in bad.collect()] == [("in/bad.zip", "error")] and kept.entries.count() == 1


def test_json_items_and_null_text(spark):
    made = [json.dumps(["0", "false", "null", "[]", "", 0, 0.0, -0.0, False, None, [], {}, True, 7]),
            '{"text": null, "n": 1}', '{"text": "x"}', '{"n": 1}']
    df = spark.createDataFrame(list(enumerate(made)), "id int, value string")
    got = {}
    for r in files.json_docs(df, "v1").collect():
        got.setdefault(r["id"], []).append(r["text"])
    assert got == {0: ["0", "false", "null", "[]", "true", "7"], 2: ["x"], 3: ['{"n":1}']}


def test_extract_routes_failures(spark):
    rows = [("a.txt", bytearray(b"Virhe is only a word")), ("b.TXT", bytearray(b"\xff\xfe")), ("c.pdf", bytearray(b"x")),
            ("d.csv", bytearray(b"a,b\n1,2\n")), ("noext", bytearray(b"x"))]
    df = spark.createDataFrame(rows, "path string, content binary")
    good, bad = extractors.error_route(extractors.extract(df))
    assert sorted(r["path"] for r in good.collect()) == ["a.txt", "d.csv"]
    assert {r["path"]: r["status"] for r in bad.collect()} == {"b.TXT": "error", "c.pdf": "unsupported", "noext": "unsupported"}
    registry = extractors.default_registry()

    @registry.register(".pdf", ".DOCX")
    def fake(path, content):
        return "text of " + path, {"page_count": 1}

    row = extractors.extract(df, registry).filter("path = 'c.pdf'").first()
    assert (row["status"], row["text"], json.loads(row["metadata"])) == ("ok", "text of c.pdf", {"page_count": 1})
    assert ".docx" in registry.by_ext and registry.load_plugins("no.such.group") == []


def test_ext_filter(spark):
    df = spark.createDataFrame([("a.TXT",), ("b.md",), ("txt",), ("c.txt.exe",)], "path string")
    assert [r["path"] for r in files.ext_filter(df, "path", [".txt"]).collect()] == ["a.TXT"]


def test_concat_corpus(spark):
    df = spark.createDataFrame([(2, "bb"), (1, "a"), (3, "")], "id long, text string")
    got = [tuple(r) for r in files.concat_corpus(df).orderBy("id").collect()]
    assert got == [(1, 0, 2), (2, 2, 3), (3, 5, 1)]


def sheet(spark, name, widths):
    rows = [(name, i, ["x"] * w + ["", None]) for i, w in enumerate(widths)]
    return spark.createDataFrame(rows, "sheet string, row_idx int, cells array<string>")


@pytest.mark.parametrize("widths, header", [
    ([1, 2, 0, 3, 3, 2], 3),                      # blank row dropped, header is the first row as full as the next
    ([1, 2, 3], 0),                               # no row qualifies, the last one has no next row
    ([2, 2], 0),
    ([4], 0),
    (list(range(1, 27)) + [26, 1], 25),           # index 25 still counts
    (list(range(1, 28)) + [27, 1], 0),            # index 26 does not
])
def test_sheet_header(spark, widths, header):
    got = sheets.sheet_header(sheet(spark, "s", widths)).collect()
    first = [r for r in got if r["is_header"]]
    assert len(first) == 1 and first[0]["row_idx"] == header
    assert sorted(r["row_no"] for r in got) == list(range(len(got)))
    assert len(got) == sum(1 for i, w in enumerate(widths) if w and i >= header)
