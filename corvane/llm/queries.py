"""Registered queries of this package and their comparison SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corvane.llm import exact_dedup, mixing, vector_dedup, warc
from corvane.llm.common import table
from corvane.llm.conversation_repair import repair_report
from corvane.llm.jaccard_join import near_duplicate_groups
from corvane.llm.quality_model import judge_quality
from corvane.llm.sentence_pieces import round_trip
from corvane.llm.token_counts import count_tokens
from corvane.llm.token_files import stored_ids
from corvane.llm.toxicity import score_toxicity, train_toxicity
from corvane.llm.url_filter import judge_urls
from corvane.llm.whitening import whitened_rows

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary(TOKENIZER))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, train_toxicity(docs, table(spark, sf_dir, "labels")))


def op4_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(spark, table(spark, sf_dir, "pages"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).drop("row")


def op7_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), vocabulary(PIECES))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(table(spark, sf_dir, "conversations"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_ids(spark, table(spark, sf_dir, "documents"), vocabulary(TOKENIZER))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_rows(spark, table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f for f in (
        op1_token_counts, op2_quality_classifier, op3_toxicity, op4_vector_dedup, op5_warc_chunks, op6_exact_dedup,
        op7_sentence_pieces, op8_mix_sources, op9_url_filter, op10_ngram_jaccard_join,
        op11_conversation_repair, op12_token_files, op13_embedding_whitening)
}
ORACLES = {
    "op4_vector_dedup": vector_dedup.SQL, "op5_warc_chunks": warc.SQL, "op6_exact_dedup": exact_dedup.SQL,
    "op8_mix_sources": mixing.SQL,
}
