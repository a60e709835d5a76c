"""Question preparation, BM25, hybrid ranking and extractive summaries."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as ST
from pyspark.sql.pandas.types import to_arrow_type

from corvane.functions import text as T
from corvane.session import saved


def sentences_of(
    entries: DataFrame, id_col: str = "id", content: str = "content", *keep: str
) -> DataFrame:
    """One row per sentence: (entry_id, pos, sentence)."""
    return entries.select(
        F.col(id_col).alias("entry_id"), *keep,
        F.posexplode(T.sentence_array(content)).alias("pos", "sentence"),
    )


def sentence_id() -> Column:
    return F.format_string("%s-%06d", F.col("entry_id").cast("string"), F.col("pos"))


def semi_validated(sentences: DataFrame, entries: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Sentences of validated entries with quality strictly above the threshold."""
    good = entries.filter(F.col("validated") & (F.col("quality_score") > threshold))
    return sentences.join(
        good.select(F.col("id").alias("entry_id")), "entry_id", "left_semi"
    )


def expand_synonyms(
    questions: DataFrame, synonyms: DataFrame, stop_words: Sequence[str],
    id_col: str = "qid", question: str = "question",
) -> DataFrame:
    """(qid, words): distinct content words and their synonyms, sorted."""
    words = questions.select(
        F.col(id_col), F.explode(T.content_tokens(question, stop_words)).alias("word")
    ).distinct()
    added = words.join(synonyms, "word").select(
        id_col, F.regexp_replace(F.lower("synonym"), "_", " ").alias("word")
    )
    return (
        words.unionByName(added)
        .groupBy(id_col)
        .agg(F.array_sort(F.collect_set("word")).alias("words"))
    )


def bm25_scores(
    queries: DataFrame, corpus: DataFrame, query_id: str, doc_id: str,
    query_tokens: str = "q_tokens", doc_tokens: str = "tokens",
    k1: float = 1.5, b: float = 0.75, epsilon: float = 0.25, pairs: DataFrame | None = None,
) -> DataFrame:
    """Okapi scores of every (query, text) pair that shares a token.

    With ``pairs(query_id, doc_id)`` only those pairs are scored: statistics still span
    the whole corpus, but no other text gives postings.

    Texts are dealt out by id once, and as long as the weights of the query tokens are small enough to
    be broadcast (they are written, so their size is known), frequencies and scores are summed
    where a text lies: no row per pair is shuffled. A token of negative idf gets ``epsilon`` times
    the mean idf of the whole vocabulary.
    """
    terms = (
        queries.select(F.col(query_id).alias("query_id"), F.explode(query_tokens).alias("token"))
        .groupBy("query_id", "token")
        .agg(F.count("*").alias("qtf"))
    )
    sized = corpus.select(
        F.col(doc_id).alias("doc_id"), F.col(doc_tokens).alias("_t"),
        F.size(doc_tokens).alias("len"),
    )
    n = sized.agg(F.count("*").alias("n")).select("n").scalar()
    avg_len = sized.agg(F.avg("len").alias("a")).select("a").scalar()
    document_freq = (
        sized.select(F.explode(F.array_distinct("_t")).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("df"))
    )
    raw = document_freq.withColumn(
        "raw", F.log((n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    )
    mean_idf = raw.agg(F.avg("raw").alias("m")).select("m").scalar()
    idf = raw.select(
        "token",
        F.when(F.col("raw") < 0, F.lit(epsilon) * mean_idf).otherwise(F.col("raw")).alias("idf"),
    )
    weighted = saved(terms.join(idf, "token"), "weights")
    wanted = weighted.select("token").distinct()
    if pairs is not None:
        pairs = pairs.select("query_id", "doc_id")
        scored = sized.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi")
    else:
        scored = sized.repartition("doc_id")
    freq = (
        scored.select("doc_id", "len", F.explode("_t").alias("token"))
        .join(wanted, "token", "left_semi")
        .groupBy("doc_id", "len", "token")
        .agg(F.count("*").alias("tf"))
    )
    gain = (
        F.col("qtf") * F.col("idf") * F.col("tf") * F.lit(k1 + 1)
        / (F.col("tf") + F.lit(k1) * (F.lit(1 - b) + F.lit(b) * F.col("len") / avg_len))
    )
    postings = freq.join(weighted, "token")
    if pairs is not None:
        postings = postings.join(pairs, ["query_id", "doc_id"], "left_semi")
    return postings.groupBy("query_id", "doc_id").agg(F.sum(gain).alias("score"))


def top_per_query(scores: DataFrame, k: int, digits: int = 9) -> DataFrame:
    """The k best rows per query; ties by doc_id. Applied per map task before the shuffle."""
    order = Window.partitionBy("query_id").orderBy(
        F.round("score", digits).desc(), F.col("doc_id")
    )
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hybrid_score(
    semantic: DataFrame, lexical: DataFrame, semantic_weight: float = 0.6,
    bm25_weight: float = 0.4,
) -> DataFrame:
    """Weighted score of the vector hits: (query_id, doc_id, base_score)."""
    return semantic.join(lexical, ["query_id", "doc_id"], "left").select(
        "query_id", "doc_id",
        (
            F.lit(semantic_weight) * F.col("sim")
            + F.lit(bm25_weight) * F.coalesce("score", F.lit(0.0))
        ).alias("base_score"),
    )


def best_per_entry(scored: DataFrame, score: str = "base_score") -> DataFrame:
    """The best sentence of each entry per query."""
    order = Window.partitionBy("query_id", "entry_id").orderBy(
        F.round(score, 9).desc(), F.col("doc_id")
    )
    return scored.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")


def kb_boost(mentions: DataFrame, kb: DataFrame, step: float = 0.1) -> DataFrame:
    """(id, n_entities, kb_boost): the boost adds ``step`` per mention found in the kb."""
    known = kb.select("text_lc", F.lit(True).alias("_known")).distinct()
    return (
        mentions.join(known, "text_lc", "left")
        .groupBy("id")
        .agg(
            F.count("*").alias("n_entities"),
            (F.count("_known") * F.lit(step)).alias("kb_boost"),
        )
    )


def answer_limit(answers: DataFrame, max_answers: int = 5, rerank: bool = False) -> DataFrame:
    """Entity requirement and per-intent limit: needs intent, n_entities and scores.

    Order is by ``base_score``; ``rerank=True`` orders by ``boosted_score``.
    """
    usable = answers.filter(
        ~F.col("intent").isin("factoid", "comparison") | (F.col("n_entities") > 0)
    )
    score = "boosted_score" if rerank else "base_score"
    order = Window.partitionBy("query_id").orderBy(F.round(score, 9).desc(), F.col("doc_id"))
    allowed = F.when(F.col("intent").isin("list", "explanation"), max_answers).otherwise(1)
    return (
        usable.withColumn("answer_rank", F.row_number().over(order))
        .filter(F.col("answer_rank") <= max_answers)  # constant bound, pruned before the shuffle
        .filter(F.col("answer_rank") <= allowed)
    )


def rank_sentences(
    sentences: DataFrame, stop_words: Sequence[str], key: str = "entry_id",
    iterations: int = 20, damping: float = 0.85,
) -> DataFrame:
    """Weighted PageRank of a text's sentences: (key, pos, n, score).

    Two sentences are linked by the number of distinct content tokens they share. The
    sums run over the text's (sentence, token) pairs (token totals, then sentence totals), which
    equals summing over all sentence pairs without forming them. A text's sentences are brought
    together once, and all rounds run on its numbers; texts are read from the sorted
    partition one after the other, so a task holds one text at a time.
    """
    words = F.array_distinct(T.content_tokens("sentence", stop_words))
    base = sentences.select(
        F.col(key).alias("key"), F.col("pos").cast("bigint").alias("pos"), F.transform(words, lambda t: F.xxhash64(t)).alias("tokens"),
    ).repartition("key").sortWithinPartitions("key", "pos")
    schema = ST.StructType([
        base.schema["key"], *ST.StructType.fromDDL("pos bigint, n bigint, score double").fields])

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, pos, tokens in _texts(batches):
            size = np.array([len(t) for t in tokens])
            rows = np.repeat(np.arange(len(pos)), size)
            _, column = np.unique(np.concatenate(tokens), return_inverse=True)
            score = _page_rank(rows, column, len(pos), iterations, damping)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(pos), key_type), pa.array(pos, pa.int64()), pa.array([len(pos)] * len(pos), pa.int64()),
                 pa.array(score)], schema.names)

    key_type = to_arrow_type(base.schema["key"].dataType)
    return base.mapInArrow(rank, schema).withColumnRenamed("key", key)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[int], list[np.ndarray]]]:
    """Key, positions and token lists of one text after the other; equal keys lie together."""
    name, pos, tokens = None, [], []
    for batch in batches:
        keys, places, lists = (batch[c] for c in ("key", "pos", "tokens"))
        for at, key in enumerate(keys.to_pylist()):
            if pos and key != name:
                yield name, pos, tokens
                pos, tokens = [], []
            name = key
            pos.append(places[at].as_py())
            words = lists[at].values
            tokens.append(np.zeros(0, np.int64) if words is None else words.to_numpy(zero_copy_only=False))
    if pos:
        yield name, pos, tokens


def _page_rank(rows: np.ndarray, column: np.ndarray, n: int, iterations: int, damping: float) -> np.ndarray:
    """Scores from the pairs (sentence, token); a sentence is not linked to itself."""
    kinds = int(column.max()) + 1 if len(column) else 0
    shared = np.bincount(column, minlength=kinds) - 1
    weight = np.bincount(rows, shared[column], minlength=n)
    own = np.bincount(rows, minlength=n)
    score = np.full(n, 1.0 / n)
    for _ in range(iterations):
        share = np.divide(score, weight, out=np.zeros(n), where=weight > 0)
        token = np.bincount(column, share[rows], minlength=kinds)
        received = np.bincount(rows, token[column], minlength=n)
        score = (1 - damping) / n + damping * (received - own * share)
    return score


def summarize_extractive(
    sentences: DataFrame, stop_words: Sequence[str], key: str = "entry_id",
    ratio: float = 0.5, iterations: int = 20,
) -> DataFrame:
    """The best ceil(ratio * n) sentences of each text in their original order."""
    ranked = rank_sentences(sentences, stop_words, key, iterations)
    order = Window.partitionBy(key).orderBy(F.round("score", 9).desc(), F.col("pos"))
    kept = (
        ranked.withColumn("_r", F.row_number().over(order))
        .filter(F.col("_r") <= F.ceil(F.col("n") * F.lit(ratio)))
        .select(key, "pos")
    )
    return (
        sentences.join(kept, [key, "pos"])
        .groupBy(key)
        .agg(
            F.count("*").alias("kept"),
            F.expr("listagg(sentence, ' ') within group (order by pos)").alias("summary"),
        )
    )


def dedup_sentences(df: DataFrame, id_col: str = "id", content: str = "content") -> DataFrame:
    """Text with repeated sentences (ignoring case) removed, first occurrence kept.

    Rows are placed by id once; both aggregations then run without another shuffle.
    """
    marked = F.regexp_replace(T.normalize_ws(content), T.SENTENCE_END, "$1" + T.MARK)
    rows = df.select(F.col(id_col).alias("id"), marked.alias("_m")).repartition("id")
    first = (
        rows.select("id", F.posexplode(F.split("_m", T.MARK)).alias("pos", "sentence"))
        .groupBy("id", F.lower("sentence").alias("_low"))
        .agg(F.min(F.struct("pos", "sentence")).alias("_first"))
    )
    ordered = F.array_sort(F.collect_list("_first"))
    return first.groupBy("id").agg(
        F.array_join(F.transform(ordered, lambda s: s["sentence"]), " ").alias("text")
    )
