"""Registered queries: vectors, neighbours, clusters, ranking and answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import text as T
from corvane.functions.lexicons import STOP_WORDS
from corvane.operators import clusters, quality, retrieval
from corvane.operators.similarity import (
    dense_vector, embed_text, near_duplicates, review_suggestions, top_matches,
)
from corvane.plans import answer, fixtures as fx, oracle as O
from corvane.plans.registry import query
from corvane.session import cut, saved

WIDTH = 64  # of the given vectors


def _vectors(spark, sf):
    return fx.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").alias("entry_id"), dense_vector("embedding").alias("vec")
    )


O.define(
    "doc_vec",
    "doc_tok AS (SELECT id, " + O.content_tokens("content") + " AS tokens FROM raw_entries),"
    + O.embed("doc_vec", "doc_tok", "id", "tokens"),
    "raw_entries",
)


O.define("wide_vec", O.embed("wide_vec", "doc_tok", "id", "tokens", 1 << 20), "doc_vec")


@query("d10_embed_text", """
SELECT id, bucket, round(w, 6) AS weight FROM doc_vec""", "doc_vec")
def embed(spark, sf):
    docs = fx.normal_entries(spark, sf).select("id", "content")
    vectors = embed_text(docs, fx.tokens_of(F.col("content"))).select(
        "id", F.arrays_zip(F.col("vec.indices").alias("b"), F.col("vec.values").alias("w")).alias("z")
    )
    return vectors.select("id", F.explode("z").alias("z")).select(
        "id", F.col("z.b").cast("bigint").alias("bucket"), F.round("z.w", 6).alias("weight")
    )


@query("e1_semi_validated", """
SELECT sentence_id, entry_id FROM sentences
WHERE entry_id IN (SELECT id FROM entries WHERE validated AND quality_score > 0.7)""", "sentences", "entries")
def semi_validated(spark, sf):
    return retrieval.semi_validated(fx.sentences(spark, sf), fx.entries(spark, sf)).select(
        "sentence_id", "entry_id"
    )


@query("e2_kb_join", """
SELECT m.id, count(*) AS n_entities, round(count(kb.text_lc) * 0.1::DOUBLE, 6) AS kb_boost
FROM mentions m LEFT JOIN kb USING (text_lc) GROUP BY m.id""", "mentions", "kb")
def kb_join(spark, sf):
    mentions = quality.entity_mentions(fx.normal_entries(spark, sf), fx.kb(spark))
    return retrieval.kb_boost(mentions, fx.kb(spark)).select(
        "id", "n_entities", F.round("kb_boost", 6).alias("kb_boost")
    )


@query("e3_near_duplicates", """
WITH s AS (SELECT a.id, round(sum(a.w * b.w), 9) AS sim FROM wide_vec a JOIN wide_vec b USING (bucket)
  WHERE a.id <> b.id AND b.id IN (SELECT id FROM entries WHERE validated) GROUP BY a.id, b.id)
SELECT id, round(max(sim), 6) AS max_sim FROM s GROUP BY id HAVING max(sim) > 0.9""", "wide_vec", "entries")
def find_near_duplicates(spark, sf):
    entries = cut(fx.entries(spark, sf).select("id", "content", "validated"))
    found = near_duplicates(entries, entries.filter("validated"), fx.tokens_of)
    return found.select("id", F.round("max_sim", 6).alias("max_sim"))


@query("e4_review_suggestion", """
WITH p AS (SELECT a.id, b.id AS other, round(sum(a.w * b.w), 9) AS sim FROM doc_vec a JOIN doc_vec b USING (bucket)
  WHERE a.id IN (SELECT id FROM entries WHERE NOT validated) AND b.id IN (SELECT id FROM entries WHERE validated)
  GROUP BY a.id, b.id),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY sim DESC, other) AS r FROM p WHERE sim > 0.5),
b AS (SELECT r.id, other, sim, substr(content, 1, 100) || '...' AS suggestion FROM r JOIN entries e ON e.id = r.other WHERE r = 1)
SELECT e.id, b.other AS suggestion_id, round(sim, 6) AS sim, coalesce(suggestion, 'none') AS suggestion
FROM entries e LEFT JOIN b USING (id) WHERE NOT validated""", "doc_vec", "entries")
def review_suggestion(spark, sf):
    entries = cut(fx.entries(spark, sf).select("id", "content", "validated"))
    found = review_suggestions(
        entries.filter(~F.col("validated")), entries.filter("validated"), fx.tokens_of
    )
    return found.withColumn("sim", F.round("sim", 6))


VECTORS = """unit AS (SELECT vec_id AS id, label AS entry_id, embedding::DOUBLE[] AS v FROM embeddings),
pairs AS (SELECT a.id, b.id AS other, a.entry_id, b.entry_id AS other_entry,
  round(list_cosine_similarity(a.v, b.v), 9) AS sim FROM unit a, unit b WHERE a.id <> b.id)"""
O.define("pairs", VECTORS)
LABELS = """edges AS (SELECT id AS a, other AS b FROM pairs WHERE sim >= 0.3),
reach(id, seen) AS (SELECT id, id FROM unit UNION SELECT e.b, r.seen FROM reach r JOIN edges e ON e.a = r.id),
parts AS (SELECT id, min(seen) AS component FROM reach GROUP BY id),
clusters AS (SELECT id, CASE WHEN count(*) OVER (PARTITION BY component) >= 2 THEN component ELSE -1 END AS cluster FROM parts)"""
O.define("clusters", LABELS, "pairs")


@query("e6_cluster_vectors", "SELECT id, cluster FROM clusters", "clusters", recursive=True)
def cluster_vectors(spark, sf):
    return clusters.cluster_vectors(_vectors(spark, sf), 0.3, WIDTH)


@query("e5_related_entries", """
WITH n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY sim DESC, other) AS rank FROM pairs WHERE entry_id <> other_entry),
t AS (SELECT n.id, rank, other_entry, cluster FROM n JOIN clusters c ON c.id = n.other WHERE rank <= 3),
f AS (SELECT id, cluster AS best FROM t WHERE rank = 1)
SELECT t.id AS vec_id, rank, other_entry AS related FROM t JOIN f USING (id) WHERE cluster = best""",
       "clusters", recursive=True)
def related_entries(spark, sf):
    vectors = cut(_vectors(spark, sf))
    labels = clusters.cluster_vectors(vectors, 0.3, WIDTH)
    documents = vectors.select(F.col("id").alias("doc_id"), F.col("entry_id").alias("owner"), "vec")
    sentences = vectors.select(F.col("id").alias("sentence_id"), "entry_id", "vec")
    found = clusters.related_entries(documents, sentences, labels, WIDTH, doc_id="doc_id")
    return found.select(F.col("entry_id").alias("vec_id"), F.col("rank").cast("bigint").alias("rank"), "related")


@query("e7_entry_lookup", """
SELECT sentence_id, validated, metadata, quality_score FROM sentences JOIN entries ON id = entry_id""", "sentences", "entries")
def entry_lookup(spark, sf):
    looked_up = fx.entries(spark, sf).select(
        F.col("id").alias("entry_id"), "validated", "metadata", "quality_score"
    )
    return fx.sentences(spark, sf).join(looked_up, "entry_id").select(
        "sentence_id", "validated", "metadata", "quality_score"
    )


@query("d11_enrich_metadata", f"""
WITH k AS (SELECT * FROM {O.values(fx.TAG_KEYWORDS)} k(tag, token, weight)),
t AS (SELECT id, unnest({O.letters('content')}) AS token FROM raw_entries),
g AS (SELECT id, tag, sum(weight) - 3 AS total FROM t JOIN k USING (token) GROUP BY ALL),
tags AS (SELECT id, string_agg(tag, ',' ORDER BY tag) AS tags FROM g WHERE total > 0 GROUP BY id),
s AS (SELECT a.id, b.id AS other, round(sum(a.w * b.w), 9) AS sim FROM doc_vec a JOIN doc_vec b USING (bucket)
  WHERE a.id <> b.id GROUP BY a.id, b.id),
n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY sim DESC, other) AS r FROM s WHERE sim > 0.5),
rel AS (SELECT id, string_agg(other::VARCHAR, ',' ORDER BY r) AS related FROM n WHERE r <= 3 GROUP BY id)
SELECT e.id, coalesce(tags, '') AS tags, coalesce(related, '') AS related_entries FROM raw_entries e
LEFT JOIN tags USING (id) LEFT JOIN rel USING (id)""", "doc_vec")
def enrich_metadata(spark, sf):
    docs = fx.normal_entries(spark, sf).select("id", "content")
    tags = quality.tag_documents(docs, fx.tag_keywords(spark)).groupBy("id").agg(
        F.array_sort(F.collect_set("tag")).alias("tags")
    )
    vectors = saved(embed_text(docs, fx.tokens_of(F.col("content"))).select("id", "vec"), "vectors")
    near = top_matches(vectors, vectors, 3, "id", "id", 256, floor=0.5, other_group=True)
    # three rows per entry at most
    related = near.groupBy(F.col("left_id").alias("id")).agg(
        F.array_sort(F.collect_list(F.struct("rank", "right_id"))).alias("r")
    )
    return docs.select("id").join(tags, "id", "left").join(related, "id", "left").select(
        "id", F.coalesce(F.array_join("tags", ","), F.lit("")).alias("tags"),
        F.coalesce(
            F.array_join(F.transform("r", lambda x: x["right_id"].cast("string")), ","), F.lit("")
        ).alias("related_entries"),
    )


def _queries_and_corpus(spark, sf):
    queries = answer.prepare_questions(fx.questions(spark, sf), fx.synonyms(spark), STOP_WORDS)
    corpus = answer.candidate_sentences(fx.sentences(spark, sf), fx.entries(spark, sf), STOP_WORDS)
    return queries, corpus


@query("g2_bm25", """
SELECT query_id, doc_id, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER
  (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM lexical) WHERE rank <= 5""", "lexical")
def bm25(spark, sf):
    queries, corpus = _queries_and_corpus(spark, sf)
    scores = retrieval.bm25_scores(queries, corpus, "query_id", "doc_id")
    return retrieval.top_per_query(scores, 5).select(
        "query_id", "doc_id", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank")
    )


@query("g2_bm25_documents", "WITH q AS (SELECT item_id AS query_id, " + O.letters("text") + """ AS tokens FROM benchmark),
d AS (SELECT doc_id, """ + O.letters("text") + " AS tokens FROM documents)," + O.bm25("b", "q", "d") + """
SELECT query_id, doc_id, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER
  (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM b) WHERE rank <= 5""")
def bm25_documents(spark, sf):
    queries = fx.questions(spark, sf).select(
        F.col("qid").alias("query_id"), T.letter_tokens("question").alias("q_tokens")
    )
    corpus = fx.table(spark, sf, "documents").select("doc_id", T.letter_tokens("text").alias("tokens"))
    scores = retrieval.bm25_scores(queries, corpus, "query_id", "doc_id")
    return retrieval.top_per_query(scores, 5).select(
        "query_id", "doc_id", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank")
    )


@query("g3_knn_topk", """
SELECT query_id, doc_id, round(sim, 6) AS sim, rank FROM semantic""", "semantic")
def knn_topk(spark, sf):
    queries, corpus = _queries_and_corpus(spark, sf)
    return answer.vector_hits(queries, corpus, 5).select(
        "query_id", "doc_id", F.round("sim", 6).alias("sim"), F.col("rank").cast("bigint").alias("rank")
    )


@query("g3_knn_vectors", """
SELECT id, other, round(sim, 6) AS sim, rank FROM (SELECT *, row_number() OVER
  (PARTITION BY id ORDER BY sim DESC, other) AS rank FROM pairs) WHERE rank <= 5""", "pairs")
def knn_vectors(spark, sf):
    vectors = _vectors(spark, sf)
    near = top_matches(vectors, vectors, 5, "id", "id", WIDTH, other_group=True)
    return near.select(
        F.col("left_id").alias("id"), F.col("right_id").alias("other"),
        F.round("sim", 6).alias("sim"), F.col("rank").cast("bigint").alias("rank"),
    )


HYBRID = """hybrid AS (SELECT query_id, s.doc_id, 0.6::DOUBLE * sim + 0.4::DOUBLE * coalesce(score, 0) AS base_score
  FROM semantic s LEFT JOIN lexical l USING (query_id, doc_id))"""
O.define("hybrid", HYBRID, "semantic", "lexical")
BEST = """best AS (SELECT * FROM (SELECT query_id, doc_id, entry_id, sentence, base_score, row_number() OVER
  (PARTITION BY query_id, entry_id ORDER BY round(base_score, 9) DESC, doc_id) AS r
  FROM hybrid JOIN candidates USING (doc_id)) WHERE r = 1)"""
O.define("best", BEST, "hybrid", "candidates")


def _hybrid(spark, sf):
    queries, corpus = _queries_and_corpus(spark, sf)
    near = cut(answer.vector_hits(queries, corpus, 5))
    lexical = retrieval.bm25_scores(queries, corpus, "query_id", "doc_id", pairs=near)
    return retrieval.hybrid_score(near, lexical), corpus


@query("g4_hybrid_score", "SELECT query_id, doc_id, round(base_score, 6) AS base_score FROM hybrid", "hybrid")
def hybrid_score(spark, sf):
    return _hybrid(spark, sf)[0].withColumn("base_score", F.round("base_score", 6))


@query("g5_best_per_entry", """
SELECT query_id, entry_id, doc_id, round(base_score, 6) AS base_score FROM best""", "best")
def best_per_entry(spark, sf):
    scored, corpus = _hybrid(spark, sf)
    hits = corpus.join(scored, "doc_id").select("query_id", "entry_id", "doc_id", "base_score")
    return retrieval.best_per_entry(hits).withColumn("base_score", F.round("base_score", 6))


ANSWERS = f"""hit_t AS (SELECT DISTINCT doc_id, sentence, {O.letters('sentence')} AS t FROM hybrid JOIN candidates USING (doc_id)),
hit_m AS (SELECT doc_id, text_lc FROM ({" UNION ALL ".join(f"SELECT doc_id, unnest({O.grams('t', n)}) AS text_lc FROM hit_t" for n in (1, 2, 3))}) JOIN kb USING (text_lc)
  UNION ALL SELECT doc_id, lower(unnest(regexp_extract_all(sentence, '{T.CAPITAL_RUN}', 1))) FROM hit_t),
boost AS (SELECT doc_id, count(*) AS n_entities, count(kb.text_lc) * 0.1::DOUBLE AS kb_boost
  FROM hit_m LEFT JOIN kb USING (text_lc) GROUP BY doc_id),
usable AS (SELECT * FROM (SELECT h.query_id, h.doc_id, c.entry_id, c.sentence, base_score, intent,
    coalesce(n_entities, 0) AS n_entities, base_score + coalesce(kb_boost, 0) AS boosted_score,
    row_number() OVER (PARTITION BY h.query_id, c.entry_id ORDER BY round(base_score, 9) DESC, h.doc_id) AS r
  FROM hybrid h JOIN candidates c ON c.doc_id = h.doc_id JOIN questions q ON q.qid = h.query_id
  LEFT JOIN boost ON boost.doc_id = h.doc_id
  WHERE intent NOT IN ('factoid', 'comparison') OR coalesce(n_entities, 0) > 0) WHERE r = 1),
answers AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(base_score, 9) DESC, doc_id) AS answer_rank
  FROM usable WHERE intent NOT IN ('factoid', 'comparison') OR n_entities > 0)
  WHERE answer_rank <= CASE WHEN intent IN ('list', 'explanation') THEN 5 ELSE 1 END)"""
O.define("answers", ANSWERS, "hybrid", "candidates", "questions", "kb")


def _answers(spark, sf):
    return answer.answer_questions(
        fx.questions(spark, sf), fx.sentences(spark, sf), fx.entries(spark, sf), fx.kb(spark),
        fx.synonyms(spark), STOP_WORDS,
    )


@query("g6_answer_limit", "SELECT query_id, max(answer_rank) AS answers FROM answers GROUP BY query_id", "answers")
def answer_limit(spark, sf):
    return _answers(spark, sf).groupBy("query_id").agg(F.max("answer_rank").cast("bigint").alias("answers"))


@query("g8_answer_question", """
SELECT query_id, intent, answer_rank, entry_id, doc_id, sentence, round(base_score, 6) AS base_score,
  round(boosted_score, 6) AS boosted_score FROM answers""", "answers")
def answer_question(spark, sf):
    return _answers(spark, sf).select(
        "query_id", "intent", F.col("answer_rank").cast("bigint").alias("answer_rank"), "entry_id",
        "doc_id", "sentence", F.round("base_score", 6).alias("base_score"),
        F.round("boosted_score", 6).alias("boosted_score"),
    )


@query("g8_answer_text")
def answer_text(spark, sf):
    return answer.answer_text(fx.questions(spark, sf), cut(_answers(spark, sf)), STOP_WORDS)


def _rank_sql(rounds: int) -> str:
    parts = [f"""b AS (SELECT entry_id, pos, sentence, list_distinct({O.content_tokens('sentence')}) AS t,
  count(*) OVER (PARTITION BY entry_id) AS n FROM sentences),
k AS (SELECT entry_id, pos, unnest(t) AS token FROM b),
f AS (SELECT entry_id, token, count(*) AS f FROM k GROUP BY ALL),
w AS (SELECT entry_id, pos, sum(f - 1)::BIGINT AS w, count(*) AS t FROM k JOIN f USING (entry_id, token) GROUP BY ALL),
s0 AS (SELECT entry_id, pos, n, coalesce(w.w, 0) AS w, coalesce(w.t, 0) AS t, 1.0::DOUBLE / n AS score
  FROM b LEFT JOIN w USING (entry_id, pos))"""]
    for i in range(rounds):
        parts.append(f"""o{i} AS (SELECT *, CASE WHEN w > 0 THEN score / w ELSE 0 END AS share FROM s{i}),
a{i} AS (SELECT entry_id, token, sum(share) AS total FROM k JOIN o{i} USING (entry_id, pos) GROUP BY ALL),
r{i} AS (SELECT entry_id, pos, sum(total) AS all_in FROM k JOIN a{i} USING (entry_id, token) GROUP BY ALL),
s{i + 1} AS MATERIALIZED (SELECT entry_id, pos, n, w, t, 0.15::DOUBLE / n + 0.85::DOUBLE * (coalesce(all_in, 0) - t * share) AS score
  FROM o{i} LEFT JOIN r{i} USING (entry_id, pos))""")
    parts.append(f"""z AS (SELECT *, row_number() OVER (PARTITION BY entry_id ORDER BY round(score, 9) DESC, pos) AS r FROM s{rounds})
SELECT entry_id, count(*) AS kept, string_agg(sentence, ' ' ORDER BY pos) AS summary
FROM z JOIN b USING (entry_id, pos) WHERE r <= ceil(z.n * 0.5::DOUBLE) GROUP BY entry_id""")
    return "WITH " + ",\n".join(parts)


@query("g7_summarize_extractive", _rank_sql(20), "sentences")
def summarize_extractive(spark, sf):
    sentences = fx.sentences(spark, sf).select("entry_id", "pos", "sentence")
    return retrieval.summarize_extractive(sentences, STOP_WORDS)
