"""Registered queries: validation, listing, entities, tags, anomalies, statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import text as T
from corvane.functions.lexicons import EXPLAIN_WORDS, INTENTS, STOP_WORDS
from corvane.operators import analytics, anomalies, listing, quality
from corvane.plans import fixtures as fx, oracle as O
from corvane.plans.registry import query
from corvane.session import saved

LISTED = """id, data_type AS type, source,
  CASE WHEN validated THEN 'validated' ELSE 'needs_validation' END AS status,
  quality_score AS quality, metadata, substr(content, 1, 100) AS content_preview, is_anomaly"""


@query("d1_custom_rules", rf"""
SELECT id, CASE {" ".join(f"WHEN NOT regexp_matches(content, '{chr(92)}A(?:{r})') THEN '{e}'" for r, e in fx.RULES)} END AS error
FROM raw_entries""", "raw_entries")
def custom_rules(spark, sf):
    rules = quality.rule_table(
        spark.createDataFrame(
            [(i, r, e) for i, (r, e) in enumerate(fx.RULES)], "ord int, regex string, error string"
        )
    )
    raw = fx.normal_entries(spark, sf)
    return raw.select("id", quality.custom_rules("content", rules).alias("error"))


@query("d2_validate", "SELECT id, validated, message, quality_score FROM entries", "entries")
def validate(spark, sf):
    return fx.entries(spark, sf).select("id", "validated", "message", "quality_score")


@query("d3_quality_score", """
SELECT id, n_entities::BIGINT AS n_entities, n_tokens::BIGINT AS n_tokens,
  round((n_entities + n_tokens / 5.0::DOUBLE + abs(polarity)) / 3.0::DOUBLE, 6) AS score FROM entries""", "entries")
def quality_score(spark, sf):
    score = quality.quality_score(F.col("n_entities"), F.col("n_tokens"), F.col("polarity"))
    return fx.entries(spark, sf).select(
        "id", F.col("n_entities").cast("bigint").alias("n_entities"),
        F.col("n_tokens").cast("bigint").alias("n_tokens"), F.round(score, 6).alias("score"),
    )


@query("d4_sentiment_polarity", "SELECT id, round(polarity, 6) + 0.0::DOUBLE AS polarity FROM entries", "entries")
def sentiment_polarity(spark, sf):
    return fx.entries(spark, sf).select("id", (F.round("polarity", 6) + 0.0).alias("polarity"))


MENTIONS = f"""mentions_t AS (SELECT id, {O.letters('content')} AS t, content AS head FROM raw_entries),
mentions_g AS ({" UNION ALL ".join(f"SELECT id, unnest(range(len({O.grams('t', n)}))) AS pos, unnest({O.grams('t', n)}) AS text_lc FROM mentions_t" for n in (1, 2, 3))}),
mentions_c AS (SELECT id, regexp_extract_all(head, '{T.CAPITAL_RUN}', 1) AS r FROM mentions_t),
mentions AS (SELECT id, pos, text_lc AS text, text_lc, type AS label FROM mentions_g JOIN kb USING (text_lc)
  UNION ALL SELECT id, pos, text, lower(text), 'MISC' FROM
  (SELECT id, unnest(range(len(r))) AS pos, unnest(r) AS text FROM mentions_c))"""
O.define("mentions", MENTIONS, "raw_entries", "kb")


def _mentions(spark, sf):
    raw = fx.normal_entries(spark, sf)
    return quality.entity_mentions(raw, fx.kb(spark))


@query("d5_entity_mentions", "SELECT id, pos, text, label FROM mentions", "mentions")
def entity_mentions(spark, sf):
    return _mentions(spark, sf).select("id", F.col("pos").cast("bigint").alias("pos"), "text", "label")


LONG = (4, 5, 7, 12)


@query("d5_long_names", f"""
WITH b AS (SELECT {O.letters('text')} AS t FROM benchmark),
k AS ({" UNION ".join(f"SELECT array_to_string(t[1:{n}], ' ') AS text FROM b WHERE len(t) >= {n}" for n in LONG)}),
e AS MATERIALIZED (SELECT id, {O.letters('content')} AS t FROM raw_entries),
g AS ({" UNION ALL ".join(f"SELECT id, unnest(range(len({O.grams('t', n)}))) AS pos, unnest({O.grams('t', n)}) AS text FROM e" for n in LONG)})
SELECT id, pos, text FROM g JOIN k USING (text)""", "raw_entries")
def long_names(spark, sf):
    """The first 4, 5, 7 and 12 words of the benchmark's items, as names."""
    words = T.letter_tokens("text")
    names = fx.table(spark, sf, "benchmark").select(words.alias("w")).select(
        "w", F.explode(F.array(*map(F.lit, LONG))).alias("n")).filter(F.size("w") >= F.col("n")).select(
        F.array_join(F.slice("w", F.lit(1), F.col("n")), " ").alias("text_lc"), F.lit("WORK").alias("type")).distinct()
    found = quality.entity_mentions(fx.normal_entries(spark, sf), names).filter("label = 'WORK'")
    return found.select("id", F.col("pos").cast("bigint").alias("pos"), "text")


@query("c7_type_in_list", """
SELECT id, text, label FROM mentions WHERE label IN ('GPE', 'PERSON', 'ORG', 'FAC')""", "mentions")
def type_in_list(spark, sf):
    return quality.type_in_list(_mentions(spark, sf)).select("id", "text", "label")


@query("d6_tag_documents", f"""
WITH k AS (SELECT * FROM {O.values(fx.TAG_KEYWORDS)} k(tag, token, weight)),
t AS (SELECT id, unnest({O.letters('content')}) AS token FROM raw_entries),
s AS (SELECT id, tag, sum(weight) - 3 AS total FROM t JOIN k USING (token) GROUP BY ALL)
SELECT id, tag, round(1 / (1 + exp(-total)), 6) AS score FROM s WHERE 1 / (1 + exp(-total)) > 0.5""", "raw_entries")
def tag_documents(spark, sf):
    raw = fx.normal_entries(spark, sf)
    return quality.tag_documents(raw, fx.tag_keywords(spark)).select(
        "id", "tag", F.round("score", 6).alias("score")
    )


@query("d6_tag_documents_trained")
def tag_documents_trained(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", "text")
    labelled = docs.join(fx.table(spark, sf, "labels"), "doc_id").select(
        F.col("toxic").cast("double").alias("toxic"), F.col("text").alias("content")
    )
    model = quality.train_tagger(labelled, "toxic")
    scored = quality.apply_tagger(model, docs.withColumnRenamed("text", "content"))
    return scored.select("doc_id", F.round("score", 4).alias("score"))


@query("d7_anomaly_iforest")
def anomaly_iforest(spark, sf):
    return anomalies.anomaly_iforest(fx.entries(spark, sf))


def _validated_once(spark, sf):
    """Validated entries without their content, written, for queries that read them more than once."""
    return saved(fx.entries(spark, sf).drop("content"), "entries")


@query("d8_anomaly_tail", "SELECT id, distance FROM flagged", "flagged")
def anomaly_tail(spark, sf):
    return anomalies.anomaly_tail(_validated_once(spark, sf))


@query("d9_kb_update", """
WITH m AS (SELECT text_lc, arg_max(label, (id, pos, label)) AS type FROM mentions
  WHERE id IN (SELECT id FROM entries WHERE validated) AND label IN ('GPE', 'PERSON', 'ORG', 'FAC') GROUP BY text_lc)
SELECT text_lc, type, type || ' sisällöstä' AS description FROM m
UNION ALL SELECT * FROM kb WHERE text_lc NOT IN (SELECT text_lc FROM m)""", "mentions", "entries")
def kb_update(spark, sf):
    # mentions read them once per length of name, so they are validated once and written
    valid = saved(fx.entries(spark, sf).filter("validated").select("id", "content"), "valid")
    kb = fx.kb(spark)
    return quality.kb_update(kb, quality.entity_mentions(valid, kb))


def _listed(spark, sf):
    entries = saved(fx.entries(spark, sf), "entries")
    return listing.mark_anomalies(entries, anomalies.anomaly_tail(entries))


SEARCH = "(lower(content) LIKE '%tion%' OR lower(source) LIKE '%tion%')"


@query("c1_list_entries", f"""
SELECT {LISTED} FROM listed WHERE {SEARCH} AND data_type = 'md' AND validated
  AND lower(metadata) LIKE '%"lang":"en"%' ORDER BY quality_score DESC, id LIMIT 20""", "listed")
def list_entries(spark, sf):
    found = listing.list_entries(_listed(spark, sf), "TION", "md", True, '"LANG":"en"')
    return listing.list_row(listing.page_by_quality(found))


@query("c2_metadata_filter", """
SELECT id, metadata FROM entries WHERE lower(metadata) LIKE '%"lang":"fr"%'""", "entries")
def metadata_filter(spark, sf):
    return listing.metadata_filter(fx.entries(spark, sf), '"lang":"FR"').select("id", "metadata")


@query("c3_fulltext_match", f"""
SELECT id, quality_score FROM entries WHERE list_has_any({O.letters('content')}, ['attion', 'lich', 'src'])
  OR list_has_any({O.letters('source')}, ['attion', 'lich', 'src'])""", "entries")
def fulltext_match(spark, sf):
    return listing.fulltext_match(fx.entries(spark, sf), "Attion lich, src").select("id", "quality_score")


@query("c4_quality_gate", "SELECT id, quality_score FROM entries WHERE validated AND quality_score > 0.7", "entries")
def quality_gate(spark, sf):
    return listing.quality_gate(fx.entries(spark, sf)).select("id", "quality_score")


@query("c6_unvalidated", f"""
SELECT id, source, quality_score, substr(content, 1, 100) AS content_preview FROM entries
WHERE NOT validated AND {SEARCH} ORDER BY quality_score DESC, id LIMIT 20""", "entries")
def unvalidated(spark, sf):
    found = listing.unvalidated(fx.entries(spark, sf), "tion")
    return listing.page_by_quality(found).select(
        "id", "source", "quality_score", T.preview("content").alias("content_preview")
    )


@query("g1_page_by_quality", """
SELECT id, quality_score FROM entries ORDER BY quality_score DESC, id LIMIT 20 OFFSET 40""", "entries")
def page_by_quality(spark, sf):
    return listing.page_by_quality(fx.entries(spark, sf), page=3).select("id", "quality_score")


@query("f4_paged_total", f"""
SELECT count(*) AS total, ceil(count(*) / 20.0::DOUBLE)::BIGINT AS pages FROM entries
WHERE validated AND {SEARCH}""", "entries")
def paged_total(spark, sf):
    return listing.paged_total(listing.list_entries(fx.entries(spark, sf), "tion", validated=True))


EXPORT = """SELECT id, data_type, substr(content, 1, 100) || '...' AS content, source, validated, metadata,
  quality_score, is_anomaly FROM listed"""


@query("a13_export_preview", EXPORT + " ORDER BY quality_score DESC, id LIMIT 5", "listed")
def export_preview(spark, sf):
    return listing.export_preview(listing.export_row(_listed(spark, sf)))


@query("f1_count_by_type", "SELECT data_type, count(*) AS entries FROM raw_entries GROUP BY data_type", "raw_entries")
def count_by_type(spark, sf):
    return analytics.count_by_type(fx.raw_entries(spark, sf))


@query("f2_quality_histogram", """
WITH m AS (SELECT min(quality_score) AS lo, (max(quality_score) - min(quality_score)) / 20 AS w FROM entries),
b AS (SELECT least(floor((quality_score - lo) / w), 19)::BIGINT AS bin, count(*) AS c FROM entries, m GROUP BY 1)
SELECT r.range AS bin, round(lo + r.range * w, 6) AS low, round(lo + (r.range + 1) * w, 6) AS high,
  coalesce(c, 0) AS entries FROM range(20) r CROSS JOIN m LEFT JOIN b ON b.bin = r.range""", "entries")
def quality_histogram(spark, sf):
    return analytics.quality_histogram(saved(fx.entries(spark, sf).select("quality_score"), "scores"))


TURNS = f"""turns AS (SELECT *, {O.intent('text')} AS intent FROM conversations WHERE role = 'user')"""
O.define("turns", TURNS)


@query("f3_store_summary", f"""
SELECT (SELECT count(*) FROM sentences) AS sentences, count(*) FILTER (validated) AS validated_entries,
  round(coalesce(avg(quality_score), 0), 6) AS avg_quality, (SELECT count(*) FROM flagged) AS anomalies,
  (SELECT count(*) FROM turns) AS questions,
  {", ".join(f"(SELECT count(*) FROM turns WHERE intent = '{i}') AS n_{i}" for i in INTENTS)}
FROM entries""", "entries", "sentences", "flagged", "turns")
def store_summary(spark, sf):
    entries = _validated_once(spark, sf)
    asked = fx.user_turns(spark, sf).select(T.detect_intent("text", EXPLAIN_WORDS).alias("intent"))
    return analytics.store_summary(
        entries, fx.sentences(spark, sf), anomalies.anomaly_tail(entries), asked
    )


def _log_lines(spark, sf):
    """Log lines in the logged format, one per user turn."""
    return fx.user_turns(spark, sf).select(
        F.concat(
            F.lit("2024-01-01 00:00:00,000 - INFO - Kysymys: "), T.normalize_ws("text"),
            F.lit(", Intentio: "), T.detect_intent("text", EXPLAIN_WORDS), F.lit(", Viive: "),
            ((F.length("text") % 400) / 100).cast("decimal(10,2)").cast("string"),
            F.lit("s, Vastauksia: "), (F.col("turn") % 6).cast("string"),
        ).alias("value")
    )


@query("f5_intent_stats", f"""
SELECT i.intent, count(t.intent) AS questions FROM (SELECT unnest({list(INTENTS)}) AS intent) i
LEFT JOIN turns t USING (intent) GROUP BY i.intent""", "turns")
def intent_stats(spark, sf):
    return analytics.intent_stats(analytics.question_log(_log_lines(spark, sf)))


@query("f6_latency_stats", """
WITH t AS (SELECT (length(text) % 400) / 100.0::DOUBLE AS latency, turn % 6 AS answers FROM turns)
SELECT count(*) AS questions, round(avg(latency), 6) AS avg_latency, quantile_disc(latency, 0.5) AS median_latency,
  max(latency) AS max_latency, round(avg(answers), 6) AS avg_answers FROM t""", "turns")
def latency_stats(spark, sf):
    return analytics.latency_stats(analytics.question_log(_log_lines(spark, sf)))


@query("f12_corpus_stats", f"""
SELECT data_type AS suffix, count(*) AS files, count(*) FILTER (length(content) >= 32) AS valid,
  count(*) FILTER (length(content) < 32) AS filtered FROM raw_entries GROUP BY data_type""", "raw_entries")
def corpus_stats(spark, sf):
    sized = fx.raw_entries(spark, sf).select(
        F.col("data_type").alias("suffix"), F.length(T.normalize_ws("content")).alias("n_chars")
    )
    return analytics.corpus_stats(sized, "suffix", "n_chars", 32)


@query("f14_loss_by_epoch", """
SELECT user_id AS run, floor(event_id / 1000)::BIGINT AS epoch, count(*) AS steps, round(avg(value), 6) AS avg_loss,
  round(sum(value), 4) AS sum_loss FROM events GROUP BY 1, 2""")
def loss_by_epoch(spark, sf):
    events = fx.table(spark, sf, "events")
    return analytics.loss_by_epoch(events, "user_id", "event_id", "value", 1000).select(
        "run", "epoch", "steps", F.round("avg_loss", 6).alias("avg_loss"),
        F.round("sum_loss", 4).alias("sum_loss"),
    )


@query("f15_audit_counts", """
SELECT user_id, event_type AS action, strftime(ts, '%Y-%m-%d') AS day, count(*) AS actions FROM events GROUP BY ALL""")
def audit_counts(spark, sf):
    counts = analytics.audit_counts(fx.activity_events(spark, sf))
    return counts.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("g18_running_best", """
SELECT user_id, event_id, value FROM (SELECT *, min(value) OVER (PARTITION BY user_id ORDER BY event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM events) WHERE best IS NULL OR value < best""")
def running_best(spark, sf):
    log = fx.table(spark, sf, "events").select("user_id", "event_id", "value")
    return analytics.running_best(log, "user_id", "event_id", "value").select("user_id", "event_id", "value")


@query("l1_decision_score", """
WITH s AS (SELECT o_orderpriority, o_orderkey, o_totalprice / 10000 * 2 - o_totalprice * 3 / 100000
  - length(o_orderstatus || o_orderpriority) * 1.5::DOUBLE AS score FROM orders)
SELECT o_orderpriority, arg_max(o_orderkey, (score, o_orderkey)) AS o_orderkey, round(max(score), 6) AS score
FROM s GROUP BY 1""")
def decision_score(spark, sf):
    actions = fx.table(spark, sf, "orders").select(
        "o_orderpriority", "o_orderkey", (F.col("o_totalprice") / 10000).alias("gain"),
        (F.col("o_totalprice") * 3).alias("cost"),
        F.length(F.concat("o_orderstatus", "o_orderpriority")).alias("risk"),
    )
    best = analytics.best_decision(analytics.decision_score(actions), "o_orderkey", "o_orderpriority")
    return best.withColumn("score", F.round("score", 6))


@query("l2_confidence_track", """
SELECT CASE WHEN c_acctbal / 100 >= 80 THEN 'high' WHEN c_acctbal / 100 >= 50 THEN 'medium' ELSE 'low' END AS track,
  count(*) AS customers FROM customer GROUP BY 1""")
def confidence_track(spark, sf):
    track = analytics.confidence_track(F.col("c_acctbal") / 100)
    return fx.table(spark, sf, "customer").groupBy(track.alias("track")).agg(F.count("*").alias("customers"))


@query("l3_evidence_confidence", """
WITH e AS (SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS entry_id, floor(value)::BIGINT AS kind,
  count(DISTINCT user_id) AS sources FROM events GROUP BY ALL)
SELECT entry_id, kind, sources, CASE WHEN kind = 0 THEN 'LOW' WHEN sources >= 2 THEN 'HIGH' ELSE 'MEDIUM' END AS confidence FROM e""")
def evidence_confidence(spark, sf):
    found = fx.activity_events(spark, sf).groupBy("entry_id", F.floor("value").alias("kind")).agg(
        F.countDistinct("user_id").alias("sources")
    )
    return found.select(
        "*", analytics.evidence_confidence(F.col("sources"), F.col("kind") == 0).alias("confidence")
    )


@query("l4_beacon_detection", """
WITH g AS (SELECT user_id, epoch_us(ts) / 1e6 - lag(epoch_us(ts) / 1e6) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events)
SELECT user_id AS source, count(gap) AS gaps, count(*) FILTER (abs(gap - 3600) <= 360) AS near_period,
  round(count(*) FILTER (abs(gap - 3600) <= 360) / nullif(count(gap), 0)::DOUBLE, 6) AS share FROM g GROUP BY user_id""")
def beacon_detection(spark, sf):
    return analytics.beacon_detection(fx.table(spark, sf, "events"), "user_id", "ts", "event_id")


@query("l5_evidence_decay", """
SELECT kind, round(now, 2) AS now, round(later, 2) AS later, round(now - later, 2) AS loss FROM
  (SELECT l_returnflag || l_linestatus AS kind, sum(l_extendedprice) AS now,
   sum(l_extendedprice * (1 - l_discount)) AS later FROM lineitem GROUP BY 1) ORDER BY now - later DESC, kind LIMIT 3""")
def evidence_decay(spark, sf):
    kinds = fx.table(spark, sf, "lineitem").groupBy(F.concat("l_returnflag", "l_linestatus").alias("kind")).agg(
        F.sum("l_extendedprice").alias("now"),
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("later"),
    )
    return analytics.evidence_decay(kinds, "kind", "now", "later").select(
        "kind", *[F.round(c, 2).alias(c) for c in ("now", "later", "loss")]
    )


@query("l6_risk_matrix", """
WITH r AS (SELECT p_partkey, (p_size % 5 + 1)::INT AS likelihood, (length(p_type) % 5 + 1)::INT AS impact FROM part)
SELECT *, (likelihood * impact)::INT AS score, dense_rank() OVER (ORDER BY likelihood * impact DESC)::INT AS rank FROM r""")
def risk_matrix(spark, sf):
    risks = fx.table(spark, sf, "part").select(
        "p_partkey", (F.col("p_size") % 5 + 1).alias("likelihood"),
        (F.length("p_type") % 5 + 1).alias("impact"),
    )
    return analytics.risk_matrix(risks)


@query("l7_mean_time_kpis", """
WITH b AS (SELECT user_id, min(epoch_us(ts)) AS s FROM events WHERE event_type = 'error' GROUP BY user_id),
e AS (SELECT user_id, min(epoch_us(ts)) AS f, any_value(s) AS s FROM events JOIN b USING (user_id)
  WHERE event_type = 'click' AND epoch_us(ts) > s GROUP BY user_id)
SELECT count(*) AS cases, round(avg(f - s) / 1e6, 3) AS mean_seconds, avg(f - s) / 1e6 < 14400 AS on_target FROM e""")
def mean_time_kpis(spark, sf):
    at = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    events = fx.table(spark, sf, "events").select("user_id", "event_type", at.alias("at"))
    start = F.when(F.col("event_type") == "error", F.col("at"))
    end = F.when(F.col("event_type") == "click", F.col("at"))
    return analytics.mean_time(events, "user_id", start, end, 4 * 3600).withColumn(
        "mean_seconds", F.round("mean_seconds", 3)
    )


@query("l8_sum_check", """
WITH t AS (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1),
s AS (SELECT l_orderkey, round(100 * l_quantity / q, 1) AS share FROM lineitem JOIN t USING (l_orderkey))
SELECT l_orderkey, round(sum(share), 1) AS total, abs(sum(share) - 100) <= 1e-6 AS ok FROM s GROUP BY 1""")
def sum_check(spark, sf):
    lines = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_quantity")
    totals = lines.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q"))
    shares = lines.join(totals, "l_orderkey").select(
        "l_orderkey", F.round(100 * F.col("l_quantity") / F.col("q"), 1).alias("share")
    )
    return analytics.sum_check(shares, "l_orderkey", "share").withColumn("total", F.round("total", 1))
