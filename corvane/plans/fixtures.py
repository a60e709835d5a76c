"""How the given tables stand in for the store's tables.

The texts are invented prose, so the dictionaries below name tokens that occur in them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corvane.functions import text as T
from corvane.functions.lexicons import KNOWLEDGE_BASE, STOP_WORDS
from corvane.functions.staging import stage
from corvane.operators import quality, retrieval

NAMES = KNOWLEDGE_BASE + [
    ("ther", "GPE", "place"), ("than", "PERSON", "person"), ("thon", "PERSON", "person"),
    ("thre", "ORG", "group"), ("erth", "FAC", "building"), ("elle", "PERSON", "person"),
    ("eau", "GPE", "place"), ("ment", "ORG", "group"), ("auf", "LANDMARK", "sight"),
    ("ung", "ORG", "group"), ("keit", "PERSON", "person"), ("para", "GPE", "place"),
    ("ción", "ORG", "group"), ("ado", "PERSON", "person"), ("de la", "FAC", "building"),
    ("that the", "GPE", "place"), ("in the", "LANDMARK", "sight"),
    ("and attion to", "ORG", "group"),
]

SENTIMENT = {
    "ing": 0.4, "tion": 0.3, "ble": 0.6, "ly": 0.2, "thed": -0.5, "thes": -0.3,
    "thin": -0.7, "ha": 0.5, "nd": -0.2, "ai": 0.4, "é": -0.6, "eux": 0.7, "ou": -0.1,
    "er": 0.3, "sch": -0.6, "ch": 0.2, "lich": 0.8, "con": 0.4, "os": -0.5, "su": 0.6,
    "al": -0.3,
}

SYNONYMS = [
    ("ther", "thon"), ("ther", "th_or"), ("than", "erth"), ("elle", "eau_x"),
    ("er", "ver"), ("para", "por_que"), ("ing", "ble"), ("ea", "anea"),
    ("tion", "attion"), ("nd", "hand"),
]

TAG_KEYWORDS = [
    ("positive", "ble", 1.5), ("positive", "ing", 1.25), ("negative", "thed", 2.0),
    ("negative", "é", 1.0), ("technical", "tion", 1.25), ("technical", "thon", 1.75),
    ("informal", "ha", 1.0), ("formal", "lich", 2.0), ("formal", "ment", 1.25),
    ("question", "wh", 1.75), ("question", "qui", 2.25), ("instruction", "er", 0.75),
    ("instruction", "para", 2.0),
]

RULES = [(r"[^|]*$", "table_mark"), (r"[^{}]*$", "braces")]
TYPES = ["txt", "md", "pdf", "csv", "docx"]
STAMP = "2024-01-01 00:00:00"
LATER = "2024-02-01 00:00:00"


TEXT_KEYS = {"documents": "doc_id", "conversations": "conv_id", "pages": "page_id"}
SPREAD_BYTES = 1 << 30
PART_BYTES = 8 << 20  # of such a table, so that a task's share does not grow with it


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table. A small text table that sits in one row group would be read and
    processed by one task, so its rows are dealt out; large tables stay as scanned."""
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    if name not in TEXT_KEYS:
        return df
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    parts = max(spark.sparkContext.defaultParallelism, -(-size // PART_BYTES))
    return df.repartition(parts, TEXT_KEYS[name]) if size <= SPREAD_BYTES else df


def kb(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NAMES, "text_lc string, type string, description string")


def synonyms(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SYNONYMS, "word string, synonym string")


def tag_keywords(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TAG_KEYWORDS, "tag string, token string, weight double")


def tokens_of(text: Column) -> Column:
    return T.content_tokens(text, STOP_WORDS)


def validator(rules=tuple(RULES)):
    """Features and validation with the dictionaries of this module."""

    def run(df: DataFrame) -> DataFrame:
        features = quality.text_features(df, [n for n, _, _ in NAMES], STOP_WORDS, SENTIMENT)
        return quality.validate(features, rules)

    return run


def raw_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as entries before validation, content as loaded."""
    kind = F.element_at(F.lit(TYPES), (F.pmod("doc_id", F.lit(5)) + 1).cast("int"))
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), kind.alias("data_type"), F.col("text").alias("content"),
        "source",
        F.to_json(
            F.struct(F.octet_length("text").cast("bigint").alias("file_size"), "lang")
        ).alias("metadata"),
    )


def normal_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Entries with normalised content."""
    raw = raw_entries(spark, sf)
    kept = [c for c in raw.columns if c != "content"]
    named = raw.select(*kept, F.col("content").alias("_raw"))
    return stage(named, content=T.normalize_ws("_raw")).select(*raw.columns)


def entries(spark: SparkSession, sf: str) -> DataFrame:
    """Validated entries: id, data_type, content, source, metadata, features, verdict."""
    return validator()(normal_entries(spark, sf))


def sentences(spark: SparkSession, sf: str) -> DataFrame:
    """All sentences: entry_id, pos, sentence, sentence_id."""
    return retrieval.sentences_of(normal_entries(spark, sf)).withColumn("sentence_id", retrieval.sentence_id())


def questions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select(
        F.col("item_id").alias("qid"), F.col("text").alias("question")
    )


def user_turns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").filter(F.col("role") == "user")


def activity_events(spark: SparkSession, sf: str) -> DataFrame:
    return as_activity(table(spark, sf, "events"))


def as_activity(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", "ts", "user_id", F.col("event_type").alias("action"),
        F.get_json_object("props", "$.k").cast("bigint").alias("entry_id"), "value",
    )


def logits(spark: SparkSession, sf: str) -> DataFrame:
    """Vector components times ten as next-token logits."""
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("seq_id"), F.posexplode("embedding").alias("token_id", "x")
    ).select("seq_id", "token_id", (F.col("x").cast("double") * 10).alias("logit"))
