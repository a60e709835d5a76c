"""Registered queries: text functions, token functions and file-name filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import arrays as A, text as T
from corvane.functions.lexicons import EXPLAIN_WORDS, STOP_WORDS
from corvane.operators import bpe, ngrams, quality, retrieval, store, tokens
from corvane.plans import fixtures as fx, oracle as O
from corvane.plans.registry import query
from corvane.session import cut, saved
from corvane.sources import files


@query("b1_normalize_ws", f"SELECT doc_id, {O.norm('text')} AS text FROM documents")
def normalize_ws(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", T.normalize_ws("text").alias("text"))


@query("b2_detect_language", f"""
WITH c AS (SELECT doc_id, lang, string_split({O.norm('text')}, '') AS c FROM documents),
g AS (SELECT doc_id, lang, unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])) AS gram
  FROM c WHERE len(c) >= 3),
n AS (SELECT lang, gram, count(*) AS n FROM g GROUP BY ALL),
v AS (SELECT count(DISTINCT gram) AS v FROM n),
t AS (SELECT lang, sum(n) AS total FROM n GROUP BY lang),
p AS (SELECT lang, gram, ln((n + 1) / (total + v)::DOUBLE) AS logp, ln(1 / (total + v)::DOUBLE) AS miss
  FROM n JOIN t USING (lang), v),
m AS (SELECT lang, max(miss) AS miss FROM p GROUP BY lang),
z AS (SELECT doc_id, count(*) AS k FROM g GROUP BY doc_id),
s AS (SELECT g.doc_id, p.lang, sum(logp - miss) AS gain FROM g JOIN p ON g.gram = p.gram GROUP BY ALL),
r AS (SELECT doc_id, lang, gain + k * miss AS score FROM s JOIN z USING (doc_id) JOIN m USING (lang))
SELECT doc_id, arg_max(lang, (round(score, 6), lang)) AS detected, round(max(score), 2) AS score FROM r GROUP BY doc_id""")
def detect_language(spark, sf):
    docs = saved(fx.table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), "lang", T.normalize_ws("text").alias("content")
    ), "texts")
    profiles = quality.language_profiles(docs, "lang", "id", "content")
    return quality.detect_language(docs, profiles).select(
        F.col("id").alias("doc_id"), "detected", F.round("score", 2).alias("score")
    )


@query("b3_split_sentences", "SELECT entry_id, pos, sentence FROM sentences", "sentences")
def split_sentences(spark, sf):
    return fx.sentences(spark, sf).select("entry_id", F.col("pos").cast("bigint").alias("pos"), "sentence")


@query("b4_dedup_sentences", rf"""
WITH s AS (SELECT id, string_split(regexp_replace(content, '([.!?])[ ]+', '\1' || chr(1), 'g'), chr(1)) AS s FROM raw_entries),
u AS (SELECT id, unnest(range(len(s))) AS pos, unnest(s) AS sentence FROM s),
f AS (SELECT id, lower(sentence) AS low, min(pos) AS pos, arg_min(sentence, pos) AS sentence FROM u GROUP BY ALL)
SELECT id, string_agg(sentence, ' ' ORDER BY pos) AS text FROM f GROUP BY id""", "raw_entries")
def dedup_sentences(spark, sf):
    return retrieval.dedup_sentences(fx.raw_entries(spark, sf))


@query("b5_content_tokens", f"""
SELECT doc_id, len(t)::BIGINT AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5
FROM (SELECT doc_id, {O.content_tokens('text')} AS t FROM documents)""")
def content_tokens(spark, sf):
    t = T.content_tokens("text", STOP_WORDS)
    return fx.table(spark, sf, "documents").select("doc_id", t.alias("t")).select(
        "doc_id", F.size("t").cast("bigint").alias("n_tokens"),
        F.md5(F.array_join("t", " ")).alias("tokens_md5"),
    )


@query("b6_word_tokens", f"""
SELECT doc_id, len(t)::BIGINT AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5
FROM (SELECT doc_id, {O.words('text')} AS t FROM documents)""")
def word_tokens(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", T.word_tokens("text").alias("t")).select(
        "doc_id", F.size("t").cast("bigint").alias("n_tokens"),
        F.md5(F.array_join("t", " ")).alias("tokens_md5"),
    )


def _vocab(spark, sf):
    docs = fx.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    return docs, saved(tokens.vocab_topn(docs, 5000), "vocab")


def _encoded(spark, sf, **options):
    return _encode(*_vocab(spark, sf), **options)


def _encode(docs, vocab, **options):
    return tokens.encode(
        docs.select("id", T.word_tokens("text").alias("tokens")), vocab, **options
    ).select("id", "ids")


@query("b7_encode", "SELECT id, array_to_string(ids, ',') AS ids FROM encoded", "encoded")
def encode(spark, sf):
    return _encoded(spark, sf).select("id", A.joined(F.col("ids")).alias("ids"))


@query("b8_decode", """
WITH u AS (SELECT id, unnest(range(len(ids))) AS p, unnest(ids) AS tid FROM encoded),
w AS (SELECT u.id, p, token FROM u JOIN vocab v ON v.id = u.tid WHERE tid > 3),
f AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY p) AS r FROM w)
SELECT e.id, coalesce(string_agg(CASE WHEN r = 1 OR token IN ('.', ',', '!', '?', ';', ':') THEN token
  ELSE ' ' || token END, '' ORDER BY p), '') AS text
FROM encoded e LEFT JOIN f USING (id) GROUP BY e.id""", "encoded")
def decode(spark, sf):
    docs, vocab = _vocab(spark, sf)
    return tokens.decode(_encode(docs, vocab), vocab).select("id", "text")


@query("b9_pad_truncate", """
WITH p AS (SELECT id, ids[1:64] AS k FROM encoded)
SELECT id, array_to_string(list_concat(k, list_transform(range(64 - len(k)), lambda i: 0)), ',') AS input_ids,
  array_to_string(list_concat(list_transform(k, lambda x: 1), list_transform(range(64 - len(k)), lambda i: 0)), ',')
  AS attention_mask, len(k)::BIGINT AS real_tokens FROM p""", "encoded")
def pad_truncate(spark, sf):
    padded = A.pad_truncate(F.col("ids"), 64)
    return _encoded(spark, sf).select(
        "id", A.joined(padded["input_ids"]).alias("input_ids"),
        A.joined(padded["attention_mask"]).alias("attention_mask"),
        F.aggregate(padded["loss_mask"], F.lit(0), lambda a, x: a + x).cast("bigint").alias("real_tokens"),
    )


@query("b10_batch_pad", """
WITH r AS (SELECT id, ids, floor((row_number() OVER (ORDER BY id) - 1) / 32)::BIGINT AS batch FROM encoded),
m AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch) AS longest FROM r)
SELECT id, batch, longest::BIGINT AS longest,
  md5(array_to_string(list_concat(ids, list_transform(range(longest - len(ids)), lambda i: 0)), ',')) AS padded_md5
FROM m""", "encoded")
def batch_pad(spark, sf):
    return tokens.batch_pad(_encoded(spark, sf), 32).select(
        "id", "batch", F.col("longest").cast("bigint").alias("longest"),
        F.md5(A.joined(F.col("padded"))).alias("padded_md5"),
    )


@query("b11_shift_targets", """
SELECT id, md5(array_to_string(ids[1:len(ids) - 1], ',')) AS inputs_md5,
  md5(array_to_string(ids[2:], ',')) AS targets_md5 FROM encoded""", "encoded")
def shift_targets(spark, sf):
    inputs, targets = A.shift_targets(F.col("ids"))
    return _encoded(spark, sf).select(
        "id", F.md5(A.joined(inputs)).alias("inputs_md5"), F.md5(A.joined(targets)).alias("targets_md5")
    )


@query("b12_sliding_windows", """
WITH u AS (SELECT id, unnest(range(len(ids))) AS p, unnest(ids) AS t FROM encoded),
o AS (SELECT row_number() OVER (ORDER BY id, p) - 1 AS pos, t FROM u),
w AS (SELECT pos, list(t) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW AND 16 FOLLOWING) AS w FROM o),
c AS (SELECT greatest(count(*) - 16, 0) // 8 * 8 AS n FROM o)
SELECT pos, array_to_string(w[1:16], ',') AS inputs, array_to_string(w[2:17], ',') AS targets
FROM w, c WHERE pos < n""", "encoded")
def sliding_windows(spark, sf):
    return tokens.corpus_windows(_encoded(spark, sf), 16, batch=8).select(
        "pos", A.joined(F.col("inputs")).alias("inputs"), A.joined(F.col("targets")).alias("targets"),
    )


@query("b13_preview_status", """
SELECT id, substr(content, 1, 100) AS content_preview,
  CASE WHEN validated THEN 'validated' ELSE 'needs_validation' END AS status FROM entries""", "entries")
def preview_status(spark, sf):
    return fx.entries(spark, sf).select(
        "id", T.preview("content").alias("content_preview"), T.status_label("validated").alias("status")
    )


@query("b14_content_md5", "SELECT doc_id, md5(text) AS content_md5 FROM documents")
def content_md5(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", F.md5("text").alias("content_md5"))


@query("b15_dataset_fingerprint", r"""
WITH h AS (SELECT md5(doc_id || chr(1) || text) AS d FROM documents),
s AS (SELECT CAST('0x' || substr(d, 1, 8) AS BIGINT) AS h, CAST('0x' || substr(d, 9, 8) AS BIGINT) AS l FROM h)
SELECT count(*) AS rows, md5(count(*) || ':' || sum(h) || ':' || bit_xor(l)) AS fingerprint FROM s""")
def dataset_fingerprint(spark, sf):
    return store.dataset_fingerprint(fx.table(spark, sf, "documents"), "doc_id", "text")


@query("b16_metadata_json", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  '{"event_type":"' || event_type || '","k":' || json_extract_string(props, '$.k') || '}' AS metadata FROM events""")
def metadata_json(spark, sf):
    parsed = F.from_json("props", "k bigint")
    return fx.table(spark, sf, "events").select("event_id", parsed["k"].alias("k"), "event_type").select(
        "event_id", "k", F.to_json(F.struct("event_type", "k")).alias("metadata")
    )


@query("b17_detect_intent", f"SELECT conv_id, turn, {O.intent('text')} AS intent FROM conversations WHERE role = 'user'")
def detect_intent(spark, sf):
    return fx.user_turns(spark, sf).select(
        "conv_id", "turn", T.detect_intent("text", EXPLAIN_WORDS).alias("intent")
    )


@query("b18_rewrite_question", f"SELECT conv_id, turn, {O.rewrite('text')} AS rewritten FROM conversations WHERE role = 'user'")
def rewrite_question(spark, sf):
    return fx.user_turns(spark, sf).select("conv_id", "turn", T.rewrite_question("text").alias("rewritten"))


@query("b19_expand_synonyms", "SELECT qid, array_to_string(words, ' ') AS expanded FROM expanded", "expanded")
def expand_synonyms(spark, sf):
    rewritten = fx.questions(spark, sf).select("qid", T.rewrite_question("question").alias("question"))
    return retrieval.expand_synonyms(rewritten, fx.synonyms(spark), STOP_WORDS).select(
        "qid", F.array_join("words", " ").alias("expanded")
    )


@query("b20_format_entry", """
SELECT id, 'id: ' || id || ', type: ' || data_type || ', source: ' || source || ', status: ' ||
  CASE WHEN validated THEN 'validated' ELSE 'needs_validation' END || ', quality: ' ||
  printf('%.2f', quality_score) || ', metadata: ' || metadata AS line FROM entries""", "entries")
def format_entry(spark, sf):
    return fx.entries(spark, sf).withColumn("status", T.status_label("validated")).select(
        "id", T.format_entry().alias("line")
    )


@query("a9_ext_filter", r"""
SELECT page_id, url FROM pages
WHERE lower(regexp_extract(regexp_extract(url, '([^/\\]*)$', 1), '\.([^.]+)$', 1)) IN ('html', 'htm')""")
def ext_filter(spark, sf):
    return files.ext_filter(fx.table(spark, sf, "pages"), "url", [".html", "htm"]).select("page_id", "url")


@query("a10_concat_corpus", """
SELECT doc_id AS id, (sum(length(text) + 1) OVER (ORDER BY doc_id) - length(text) - 1)::BIGINT AS start,
  (length(text) + 1)::BIGINT AS n_chars FROM documents""")
def concat_corpus(spark, sf):
    return files.concat_corpus(fx.table(spark, sf, "documents"), "doc_id", "text")


@query("f7_vocab_count", f"""
SELECT token, count(*) AS freq FROM (SELECT unnest({O.words('text')}) AS token FROM documents) GROUP BY token""")
def vocab_count(spark, sf):
    return tokens.vocab_count(fx.table(spark, sf, "documents"))


@query("g9_vocab_topn", "SELECT token, id, freq::BIGINT AS freq FROM vocab", "vocab")
def vocab_topn(spark, sf):
    return _vocab(spark, sf)[1]


@query("f8_markov_train", "SELECT ctx, nxt, n FROM transitions", "transitions")
def markov_train(spark, sf):
    return ngrams.require_transitions(ngrams.markov_train(fx.table(spark, sf, "documents"), 3))


@query("f9_markov_stats", """
SELECT count(DISTINCT ctx) AS contexts, sum(n)::BIGINT AS total_transitions,
  round(sum(n) / count(DISTINCT ctx)::DOUBLE, 6) AS avg_transitions_per_context FROM transitions""", "transitions")
def markov_stats(spark, sf):
    return ngrams.markov_stats(ngrams.markov_train(fx.table(spark, sf, "documents"), 3)).select(
        "contexts", "total_transitions",
        F.round("avg_transitions_per_context", 6).alias("avg_transitions_per_context"),
    )


@query("f10_markov_score", """
WITH v AS (SELECT count(DISTINCT nxt) AS v FROM transitions),
t AS (SELECT ctx, sum(n) AS cn FROM transitions GROUP BY ctx),
q AS (SELECT conv_id * 1000 + turn AS id, string_split(text, '') AS c FROM conversations),
g AS (SELECT id, unnest(list_transform(range(1, len(c) - 2), lambda i: c[i] || c[i + 1] || c[i + 2])) AS ctx,
  unnest(list_transform(range(1, len(c) - 2), lambda i: c[i + 3])) AS nxt FROM q),
s AS (SELECT id, ln((coalesce(n, 0) + 1) / (coalesce(cn, 0) + v)::DOUBLE) AS lp
  FROM g LEFT JOIN transitions USING (ctx, nxt) LEFT JOIN t USING (ctx), v)
SELECT id, count(*) AS n_chars, round(sum(lp), 4) AS log_likelihood, round(exp(-avg(lp)), 4) AS perplexity
FROM s GROUP BY id""", "transitions")
def markov_score(spark, sf):
    table = cut(ngrams.markov_train(fx.table(spark, sf, "documents"), 3))
    turns = fx.table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text"
    )
    return ngrams.markov_score(turns, table, 3).select(
        "id", "n_chars", F.round("log_likelihood", 4).alias("log_likelihood"),
        F.round("perplexity", 4).alias("perplexity"),
    )


def _bpe_sql(rounds: int) -> str:
    parts = [r"""w AS (SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text,
  '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+')) AS word FROM documents) GROUP BY word),
s0 AS (SELECT regexp_replace(word, '(.)', ' \1 ', 'g') AS sym, n FROM w)"""]
    for i in range(rounds):
        parts.append(f"""l{i} AS (SELECT string_split(substr(sym, 2, length(sym) - 2), '  ') AS p, n FROM s{i}),
p{i} AS (SELECT unnest(p[:len(p) - 1]) AS a, unnest(p[2:]) AS b, n FROM l{i} WHERE len(p) > 1),
b{i} AS (SELECT a, b, sum(n)::BIGINT AS freq FROM p{i} GROUP BY a, b ORDER BY freq DESC, a, b LIMIT 1),
s{i + 1} AS MATERIALIZED (SELECT replace(sym, ' ' || a || '  ' || b || ' ', ' ' || a || b || ' ') AS sym, n FROM s{i}, b{i})""")
    union = " UNION ALL ".join(
        f"SELECT {i + 1}::BIGINT AS rank, a AS left_part, b AS right_part, freq FROM b{i}"
        for i in range(rounds)
    )
    return "WITH " + ",\n".join(parts) + "\n" + union


BPE_VOCABULARY = 20_000
MERGES = "rank bigint, left_part string, right_part string, freq bigint"


@query("f11_bpe_train")
def bpe_train(spark, sf):
    merges = bpe.bpe_train(fx.table(spark, sf, "documents"), vocab_size=BPE_VOCABULARY)
    return spark.createDataFrame(merges, MERGES)


@query("f11_bpe_first_merges", _bpe_sql(6))
def bpe_first_merges(spark, sf):
    """A report of the six best merges."""
    return spark.createDataFrame(bpe.bpe_train(fx.table(spark, sf, "documents"), 6), MERGES)


@query("g19_train_val_split", "SELECT id, split FROM split", "split")
def train_val_split(spark, sf):
    return tokens.train_val_split(fx.table(spark, sf, "documents"), id_col="doc_id")


@query("f13_batch_counts", """
WITH c AS (SELECT count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'val') AS n_val FROM split),
b AS (SELECT *, ceil(n_train / 8.0::DOUBLE)::BIGINT AS train_batches, ceil(n_val / 8.0::DOUBLE)::BIGINT AS val_batches FROM c),
t AS (SELECT *, (train_batches * 3 // 4)::BIGINT AS total_steps FROM b)
SELECT *, floor(total_steps * 0.1::DOUBLE)::BIGINT AS warmup_steps FROM t""", "split")
def batch_counts(spark, sf):
    return tokens.batch_counts(
        tokens.train_val_split(fx.table(spark, sf, "documents"), id_col="doc_id")
    )


@query("c5_min_length_filter", f"""
SELECT doc_id, length(text)::BIGINT AS n_chars FROM documents
WHERE length(text) >= 50 AND len({O.words('text')}) > 2 AND length(text) > 3""")
def min_length_filter(spark, sf):
    docs = fx.table(spark, sf, "documents").filter(
        (F.length("text") >= 50) & (F.size(T.word_tokens("text")) > 2) & (F.length("text") > 3)
    )
    return docs.select("doc_id", F.length("text").cast("bigint").alias("n_chars"))
