"""Registered queries: store changes, versions, file sources and sinks."""

from __future__ import annotations

import inspect
import io
import tempfile
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from corvane.functions import arrays as A, text as T
from corvane.operators import listing, sheets, store, tokens
from corvane.plans import demo_pages, entry_queries, fixtures as fx, oracle as O
from corvane.plans.registry import query
from corvane.session import saved, scratch_path
from corvane.sources import exports, extractors, files


def _stamp(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _store(spark, sf) -> store.Store:
    """The store after loading all documents, materialised once."""
    made = store.store_entries(fx.raw_entries(spark, sf), fx.validator(), _stamp(fx.STAMP))
    base = scratch_path(spark, "store")
    store.write_version(made, base, 1)
    return store.read_version(spark, base)


def _view(s: store.Store):
    """One row per id ever stored: current state, versions, sentences and last action."""
    versions = s.history.groupBy(F.col("entry_id").alias("id")).agg(F.count("*").alias("versions"))
    parts = s.sentences.groupBy(F.col("entry_id").alias("id")).agg(F.count("*").alias("sentences"))
    actions = s.audit.groupBy(F.col("entry_id").alias("id")).agg(
        F.max_by("action", F.struct("ts", "action")).alias("last_action")
    )
    return (
        versions.join(s.entries, "id", "left").join(parts, "id", "left").join(actions, "id", "left")
        .select(
            "id", "data_type", "source", "validated", "quality_score", F.md5("content").alias("content_md5"),
            "versions", F.coalesce("sentences", F.lit(0)).alias("sentences"), "last_action",
        )
    )


def _view_sql(final: str, versions: str, action: str) -> str:
    return f"""
SELECT d.id, f.data_type, f.source, f.validated, f.quality_score, md5(f.content) AS content_md5,
  ({versions})::BIGINT AS versions, coalesce(len({O.sentence_list('f.content')}), 0)::BIGINT AS sentences,
  {action} AS last_action
FROM raw_entries d LEFT JOIN {final} f USING (id) LEFT JOIN labels l ON l.doc_id = d.id"""


@query("a11_store_entries", _view_sql("entries", "1", "'create'"), "entries")
def store_entries(spark, sf):
    return _view(_store(spark, sf))


def _updates(spark, sf):
    """New content for the documents labelled as poor, and for one unknown id each."""
    low = fx.table(spark, sf, "labels").filter(F.col("quality") == 0).select("doc_id")
    docs = fx.table(spark, sf, "documents").join(low, "doc_id")
    known = docs.select(
        F.col("doc_id").alias("id"), F.concat(F.lit("Updated  text than thing. "), "text").alias("content")
    )
    return known.unionByName(known.select((-1 - F.col("id")).alias("id"), "content"))


KIND = O.KIND + " AS data_type"
UPDATED = f"""fresh AS (SELECT doc_id AS id, {KIND}, {O.norm("'Updated  text than thing. ' || text")} AS content, source,
  NULL AS metadata FROM documents JOIN labels USING (doc_id) WHERE quality = 0),
{O.validated('changed', 'fresh')},
updated AS (SELECT id, data_type, source, content, validated, quality_score FROM changed
  UNION ALL SELECT id, data_type, source, content, validated, quality_score FROM entries
  WHERE id NOT IN (SELECT id FROM changed))"""
O.define("updated", UPDATED, "entries")


@query("h1_update_entries", _view_sql("updated", "CASE WHEN l.quality = 0 THEN 2 ELSE 1 END",
                                      "CASE WHEN l.quality = 0 THEN 'update' ELSE 'create' END"), "updated")
def update_entries(spark, sf):
    return _view(store.update_entries(_store(spark, sf), _updates(spark, sf), fx.validator(), _stamp(fx.LATER)))


O.define(
    "fresh_vec",
    "fresh_tok AS (SELECT id, " + O.content_tokens("content") + " AS tokens FROM fresh),"
    + O.embed("fresh_vec", "fresh_tok", "id", "tokens", 1 << 20),
    "updated",
)
O.define("old_vec", "old_tok AS (SELECT id, " + O.content_tokens("content") + " AS tokens FROM raw_entries),"
         + O.embed("old_vec", "old_tok", "id", "tokens", 1 << 20), "raw_entries")


@query("h1_update_warnings", """
WITH s AS (SELECT a.id, round(sum(a.w * b.w), 9) AS sim FROM fresh_vec a JOIN old_vec b USING (bucket)
  WHERE a.id <> b.id AND b.id IN (SELECT id FROM entries WHERE validated) GROUP BY a.id, b.id)
SELECT id, round(max(sim), 6) AS max_sim FROM s GROUP BY id HAVING max(sim) > 0.9""", "fresh_vec", "old_vec", "entries")
def update_warnings(spark, sf):
    found = store.update_warnings(_store(spark, sf), _updates(spark, sf), fx.tokens_of)
    return found.select("id", F.round("max_sim", 6).alias("max_sim"))


def _toxic(spark, sf):
    toxic = fx.table(spark, sf, "labels").filter(F.col("toxic") == 1)
    known = toxic.select(F.col("doc_id").alias("id"))
    return known.unionByName(known.select((-1 - F.col("id")).alias("id")))


O.define(
    "remaining",
    "remaining AS (SELECT * FROM entries WHERE id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1))", "entries",
)


@query("h2_delete_entries", _view_sql("remaining", "1", "CASE WHEN l.toxic = 1 THEN 'delete' ELSE 'create' END"), "remaining")
def delete_entries(spark, sf):
    return _view(store.delete_entries(_store(spark, sf), _toxic(spark, sf), _stamp(fx.LATER)))


O.define(
    "restored",
    """restored AS (SELECT id, 'restored' AS data_type, 'history' AS source, content, validated, quality_score FROM entries
  WHERE id IN (SELECT doc_id FROM labels WHERE toxic = 1)
  UNION ALL SELECT id, data_type, source, content, validated, quality_score FROM remaining)""", "remaining",
)


@query("h3_restore_entries", _view_sql("restored", "1", "CASE WHEN l.toxic = 1 THEN 'restore' ELSE 'create' END"), "restored")
def restore_entries(spark, sf):
    whole = _store(spark, sf)
    fewer = store.delete_entries(whole, _toxic(spark, sf), _stamp(fx.LATER))
    wanted = whole.history.join(
        _toxic(spark, sf).select(F.col("id").alias("entry_id")), "entry_id", "left_semi"
    ).select("entry_id", F.col("id").alias("history_id"))
    return _view(
        store.restore_entries(fewer, wanted, fx.validator(), _stamp("2024-03-01 00:00:00"))
    )


@query("h4_audit_append", """
SELECT 'system' AS user_id, a AS action, count(*) AS n FROM (SELECT 'create' AS a FROM documents
  UNION ALL SELECT 'update' FROM labels WHERE quality = 0) GROUP BY ALL""")
def audit_append(spark, sf):
    changed = store.update_entries(_store(spark, sf), _updates(spark, sf), fx.validator(), _stamp(fx.LATER))
    return changed.audit.groupBy("user_id", "action").agg(F.count("*").alias("n"))


O.define(
    "reviewed",
    "reviewed AS (SELECT * FROM updated WHERE id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1))", "updated",
)


@query("h5_review_apply", _view_sql(
    "reviewed", "CASE WHEN l.quality = 0 AND l.toxic = 0 THEN 2 ELSE 1 END",
    "CASE WHEN l.toxic = 1 THEN 'delete' WHEN l.quality = 0 THEN 'update' ELSE 'create' END"), "reviewed")
def review_apply(spark, sf):
    labels = fx.table(spark, sf, "labels").withColumnRenamed("doc_id", "id")
    action = F.when(F.col("toxic") == 1, "delete").when(F.col("quality") == 0, "update").otherwise("skip")
    docs = fx.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    actions = labels.join(docs, "id").select(
        "id", action.alias("action"), F.concat(F.lit("Updated  text than thing. "), "text").alias("content")
    )
    return _view(store.review_apply(_store(spark, sf), actions, fx.validator(), _stamp(fx.LATER)))


def _versions(spark, sf):
    """Events as history: each event is a version of the entry named in its props."""
    return fx.activity_events(spark, sf).select(
        F.col("event_id").cast("string").alias("id"), "entry_id",
        F.concat_ws(" ", F.lit("version by user"), "user_id", "action").alias("content"), "ts",
    )


O.define("versions", """versions AS (SELECT event_id::VARCHAR AS id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS entry_id,
  'version by user ' || user_id || ' ' || event_type AS content, ts FROM events)""")


@query("g10_history_list", """
SELECT entry_id, id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, substr(content, 1, 50) AS preview FROM versions""", "versions")
def history_list(spark, sf):
    return store.history_list(_versions(spark, sf)).select(
        "entry_id", "id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "preview"
    )


@query("g11_latest_version", """
SELECT entry_id, id, content FROM (SELECT *, row_number() OVER (PARTITION BY entry_id ORDER BY ts DESC, id DESC) AS r
  FROM versions WHERE ts <= TIMESTAMP '2024-01-15 00:00:00') WHERE r = 1""", "versions")
def latest_version(spark, sf):
    return store.latest_version(_versions(spark, sf), _stamp("2024-01-15 00:00:00")).select(
        "entry_id", "id", "content"
    )


@query("e8_history_join", """
SELECT v.entry_id, v.id, v.content FROM versions v JOIN events e ON v.id = e.event_id::VARCHAR WHERE e.event_type = 'purchase'""", "versions")
def history_join(spark, sf):
    wanted = fx.activity_events(spark, sf).filter(F.col("action") == "purchase").select(
        "entry_id", F.col("event_id").cast("string").alias("history_id")
    )
    return store.history_join(_versions(spark, sf), wanted).select("entry_id", "id", "content")


@query("a14_snapshot", """
SELECT 'entries' AS name, count(*) AS n FROM raw_entries UNION ALL SELECT 'history', count(*) FROM raw_entries
UNION ALL SELECT 'sentences', count(*) FROM sentences UNION ALL SELECT 'audit', count(*) FROM raw_entries""", "sentences")
def snapshot(spark, sf):
    made = store.store_entries(fx.raw_entries(spark, sf), fx.validator(), _stamp(fx.STAMP))
    base = scratch_path(spark, "store")
    store.write_version(made, base, 1)
    folder = store.snapshot(spark, base, scratch_path(spark, "copies"), "20240101_000000")
    counts = [
        spark.read.parquet(f"{folder}/{name}").agg(F.lit(name).alias("name"), F.count("*").alias("n"))
        for name in store.TABLES
    ]
    out = counts[0]
    for part in counts[1:]:
        out = out.unionByName(part)
    return out


@query("a15_vocab_save_load", "SELECT token, id, freq::BIGINT AS freq FROM vocab", "vocab")
def vocab_save_load(spark, sf):
    docs = fx.table(spark, sf, "documents").withColumnRenamed("doc_id", "id")
    path = scratch_path(spark, "vocab")
    store.save_vocab(tokens.vocab_topn(docs, 5000), path)
    return store.load_vocab(spark, path)


@query("a16_token_dataset_write", """
SELECT id, array_to_string(ids, ',') AS ids, 'second' AS read_from FROM encoded""", "encoded")
def token_dataset_write(spark, sf):
    docs = fx.table(spark, sf, "documents").withColumnRenamed("doc_id", "id")
    vocab = saved(tokens.vocab_topn(docs, 5000), "vocab")
    encoded = tokens.encode(docs.select("id", T.word_tokens("text").alias("tokens")), vocab)
    samples = encoded.select("id", A.joined(F.col("ids")).alias("ids"))
    content = store.dataset_fingerprint(docs, "id", "text").first()["fingerprint"]
    words = store.dataset_fingerprint(vocab, "id", "token").first()["fingerprint"]
    mark = f"{content}-{words}"
    path = scratch_path(spark, "tokens")
    store.write_tokens(samples, path, mark)
    kept, fresh = store.write_tokens(samples, path, mark)
    return kept.withColumn("read_from", F.lit("first" if fresh else "second"))


@query("a17_sheet_header", r"""
WITH l AS (SELECT doc_id AS sheet, string_split(text, chr(10)) AS l FROM documents),
r AS (SELECT sheet, unnest(range(len(l))) AS row_idx, string_split(unnest(l), ' ') AS cells FROM l),
f AS (SELECT *, len(list_filter(cells, lambda c: c <> '')) AS k FROM r),
n AS (SELECT *, row_number() OVER (PARTITION BY sheet ORDER BY row_idx) - 1 AS no FROM f WHERE k > 0),
x AS (SELECT *, lead(k) OVER (PARTITION BY sheet ORDER BY row_idx) AS nk FROM n),
h AS (SELECT sheet, min(no) FILTER (k >= nk) AS h FROM x GROUP BY sheet),
s AS (SELECT sheet, CASE WHEN h IS NULL OR h > 25 THEN 0 ELSE h END AS h FROM h)
SELECT sheet, row_idx, no - h AS row_no, no = h AS is_header FROM n JOIN s USING (sheet) WHERE no >= h""")
def sheet_header(spark, sf):
    rows = fx.table(spark, sf, "documents").select(
        F.col("doc_id").alias("sheet"), F.posexplode(F.split("text", "\n")).alias("row_idx", "line")
    ).select("sheet", "row_idx", F.split("line", " ").alias("cells"))
    return sheets.sheet_header(rows).select(
        "sheet", F.col("row_idx").cast("bigint").alias("row_idx"),
        F.col("row_no").cast("bigint").alias("row_no"), "is_header",
    )


@query("a12_export_json", entry_queries.EXPORT, "listed")
def export_json(spark, sf):
    rows = listing.export_row(entry_queries._listed(spark, sf))
    path = exports.export(rows, scratch_path(spark, "export"), "json")
    return spark.read.schema(rows.schema).json(path)


@query("a12_export_csv", entry_queries.EXPORT, "listed")
def export_csv(spark, sf):
    rows = listing.export_row(entry_queries._listed(spark, sf))
    path = exports.export(rows, scratch_path(spark, "export"), "csv")
    reader = spark.read.schema(rows.schema).option("header", "true").option("escape", '"')
    return reader.csv(path)


def _text_folder(spark, sf) -> str:
    """All documents as text files, one folder per source."""
    path = scratch_path(spark, "files")
    fx.table(spark, sf, "documents").select("source", "text").write.partitionBy("source").text(path)
    return path


def _source(path: str):
    return F.regexp_extract(path, "source=([^/]+)/", 1)


@query("a1_ingest_text", """
SELECT source, sum(strlen(text) + 1)::BIGINT AS bytes, sum(length(text) + 1)::BIGINT AS chars, 'ok' AS status
FROM documents GROUP BY source""")
def ingest_text(spark, sf):
    read = files.ingest_text(spark, _text_folder(spark, sf))
    return read.groupBy(_source("path").alias("source"), "status").agg(
        F.sum(F.get_json_object("metadata", "$.file_size").cast("bigint")).alias("bytes"),
        F.sum(F.length("text")).alias("chars"),
    )


@query("a2_corpus_load_v1", f"""
SELECT length(t)::BIGINT AS n_chars, count(*) AS texts FROM (SELECT regexp_replace(regexp_replace(text, '^{T.WHITESPACE}', ''), '{T.WHITESPACE}$', '') AS t FROM conversations)
WHERE length(t) >= 50 GROUP BY 1""")
def corpus_load_v1(spark, sf):
    turns = fx.table(spark, sf, "conversations").select("text")
    loaded = files.corpus_load(spark, texts=turns, mode="v1")
    return loaded.groupBy(F.length("text").cast("bigint").alias("n_chars")).agg(F.count("*").alias("texts"))


@query("a3_corpus_load_v2", f"""
WITH t AS (SELECT {O.norm('text')} AS t FROM conversations WHERE trim(text) <> ''),
d AS (SELECT {O.norm('text')} AS t FROM documents)
SELECT 'jsonl' AS suffix, sum(length(t) + 1)::BIGINT AS chars FROM t
UNION ALL SELECT 'txt', sum(length(t) + 1)::BIGINT FROM d
UNION ALL SELECT 'raw', sum(length(t) + 1)::BIGINT FROM t WHERE length(t) >= 32""")
def corpus_load_v2(spark, sf):
    turns = fx.table(spark, sf, "conversations").filter(F.trim("text") != "")
    folder = _text_folder(spark, sf)
    turns.select("role", "text").write.mode("append").partitionBy("role").json(folder)
    # how Spark splits the texts into files is not fixed, so short files are kept here
    from_files = files.corpus_load(
        spark, folder, mode="v2", min_len=1,
        patterns={"txt": "*.txt", "md": "*.md", "jsonl": "*.json"},
    )
    loaded = from_files.unionByName(files.corpus_load(spark, texts=turns, mode="v2"))
    return loaded.groupBy("suffix").agg(F.sum(F.length("text") + 1).cast("bigint").alias("chars"))


@query("a4_json_to_text", """
WITH e AS (SELECT event_id, event_type, user_id, props FROM events)
SELECT event_id, text FROM (
  SELECT event_id, CASE event_type WHEN 'view' THEN event_type WHEN 'click' THEN props
    WHEN 'error' THEN user_id::VARCHAR WHEN 'purchase' THEN 'bought' END AS text FROM e WHERE event_type <> 'signup'
  UNION ALL SELECT event_id, 'a' FROM e WHERE event_type = 'signup'
  UNION ALL SELECT event_id, user_id::VARCHAR FROM e WHERE event_type = 'signup' AND user_id <> 0)""")
def json_to_text(spark, sf):
    events = fx.table(spark, sf, "events")
    user = F.col("user_id").cast("string")
    made = (
        F.when(F.col("event_type") == "view", F.to_json(F.struct(F.col("event_type").alias("text"), "user_id")))
        .when(F.col("event_type") == "click", F.regexp_replace("props", " ", ""))
        .when(F.col("event_type") == "error", user)
        .when(F.col("event_type") == "purchase", F.lit('"bought"'))
        .otherwise(F.concat(F.lit('["a", "", null, '), user, F.lit(", {}]")))
    )
    docs = files.json_docs(events.select("event_id", made.alias("value")), "v1")
    # objects are rendered compactly; the given props have a space after the colon
    return docs.select(
        "event_id",
        F.when(F.col("text").startswith('{"k":'), F.replace("text", F.lit(":"), F.lit(": ")))
        .otherwise(F.col("text")).alias("text"),
    )


@query("a5_ingest_csv", """
SELECT c_mktsegment AS segment, count(*) AS rows, 4 AS columns,
  sum(length(c_name))::BIGINT > 0 AS has_text FROM customer GROUP BY 1""")
def ingest_csv(spark, sf):
    path = scratch_path(spark, "csv")
    fx.table(spark, sf, "customer").write.partitionBy("c_mktsegment").option("header", "true").csv(path)
    read = files.ingest_csv(spark, path)
    return read.groupBy(F.regexp_extract("path", "c_mktsegment=([^/]+)/", 1).alias("segment")).agg(
        F.sum("rows").alias("rows"), F.max("columns").alias("columns"),
        F.min(F.col("text").startswith("c_custkey,c_name")).alias("has_text"),
    )


def _zip_pages(batches):
    for batch in batches:
        made = []
        for page, url, html in zip(batch["page_id"], batch["url"], batch["html"]):
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("page.md", html)
                archive.writestr("nested/deep/URL.TXT", url)
                archive.writestr("nested/skip.exe", "x")
            made.append((f"{page}.zip", buffer.getvalue()))
        yield pd.DataFrame(made, columns=["path", "content"])


@query("a6_expand_zip", """
SELECT page_id || '.zip' AS archive, 'page.md' AS path, '.md' AS ext, strlen(html)::BIGINT AS n_bytes FROM pages
UNION ALL SELECT page_id || '.zip', 'nested/deep/URL.TXT', '.txt', strlen(url)::BIGINT FROM pages""")
def expand_zip(spark, sf):
    archives = fx.table(spark, sf, "pages").mapInPandas(_zip_pages, "path string, content binary")
    return extractors.expand_zip(archives).select(
        "archive", "path", "ext", F.octet_length("content").cast("bigint").alias("n_bytes")
    )


def _files(spark, sf):
    """Documents as files; csv documents are small tables, toxic ones end in a bad byte."""
    docs = fx.raw_entries(spark, sf).join(
        fx.table(spark, sf, "labels").select(F.col("doc_id").alias("id"), "toxic"), "id", "left"
    )
    body = F.when(
        F.col("data_type") == "csv", F.concat(F.lit("chars,source\n"), F.length("content").cast("string"), F.lit(","), "source")
    ).otherwise(F.col("content"))
    raw = F.encode(body, "UTF-8")
    return docs.select(
        F.concat(F.lit("in/doc_"), F.col("id").cast("string"), F.lit("."), F.upper("data_type")).alias("path"),
        F.when(F.col("toxic") == 1, F.concat(raw, F.unhex(F.lit("FF")))).otherwise(raw).alias("content"),
    )


FILES = f"""files AS (SELECT doc_id AS id, {O.KIND} AS ext, text, coalesce(toxic, 0) AS toxic FROM documents LEFT JOIN labels USING (doc_id)),
extracted AS (SELECT 'in/doc_' || id || '.' || upper(ext) AS path, ext,
  CASE WHEN ext IN ('pdf', 'docx') THEN 'unsupported' WHEN toxic = 1 THEN 'error' ELSE 'ok' END AS status,
  CASE WHEN ext = 'csv' THEN '{{"rows": 1, "columns": 2}}' ELSE '{{"file_size": ' || strlen(text) || '}}' END AS metadata FROM files)"""
O.define("extracted", FILES)


@query("a7_extract_dispatch", """
SELECT path, ext, status, CASE WHEN status = 'ok' THEN metadata END AS metadata FROM extracted""", "extracted")
def extract_dispatch(spark, sf):
    return extractors.extract(_files(spark, sf)).select("path", "ext", "status", "metadata")


@query("a8_error_route", "SELECT path, status FROM extracted WHERE status <> 'ok'", "extracted")
def error_route(spark, sf):
    return extractors.error_route(extractors.extract(_files(spark, sf)))[1].select("path", "status")


@query("j1_register_extractor", """
SELECT path, 'ok' AS status, '{"pages": 1}' AS metadata FROM extracted WHERE ext = 'pdf'""", "extracted")
def register_extractor(spark, sf):
    registry = extractors.Registry()

    @registry.register(".pdf")
    def latin(path, content):
        return content.decode("latin-1"), {"pages": 1}

    found = extractors.extract(_files(spark, sf), registry)
    return found.filter(F.col("ext") == "pdf").select("path", "status", "metadata")


def plugin_archive(folder: str) -> str:
    """A plugin package as a zip below ``folder`` of the driver; Spark ships it from there."""
    path = f"{folder}/demo_pages-1.0.zip"
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("demo_pages.py", inspect.getsource(demo_pages))
        archive.writestr("demo_pages-1.0.dist-info/METADATA", "Metadata-Version: 2.1\nName: demo-pages\nVersion: 1.0\n")
        archive.writestr("demo_pages-1.0.dist-info/entry_points.txt", f"[{extractors.PLUGIN_GROUP}]\npages = demo_pages:processors\n")
    return path


@query("j2_load_plugins", """
SELECT page_id, CASE WHEN page_id % 10 <> 0 THEN (length(html) - length(replace(html, '<', '')))::VARCHAR END AS text,
  CASE WHEN page_id % 10 <> 0 THEN 'ok' ELSE 'error' END AS status FROM pages""")
def load_plugins(spark, sf):
    """Every tenth page has an extension whose plugin fails."""
    registry = extractors.Registry()
    extractors.ship_package(spark, plugin_archive(tempfile.mkdtemp(prefix="corvane-plugin-")))
    registry.load_plugins()
    ext = F.when(F.col("page_id") % 10 != 0, ".page").otherwise(".broken")
    pages = fx.table(spark, sf, "pages").select(
        F.concat(F.col("page_id").cast("string"), ext).alias("path"), F.col("html").cast("binary").alias("content"))
    return extractors.extract(pages, registry).select(
        F.regexp_extract("path", "^([0-9]+)", 1).cast("bigint").alias("page_id"), "text", "status")
