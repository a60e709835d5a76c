"""Validation, quality score, entities, tags and language."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from corvane.functions import text as T
from corvane.functions.lexicons import KB_TYPES
from corvane.functions.staging import stage
from corvane.operators.ngrams import char_grams
from corvane.session import saved

LANGUAGES = 64  # up to so many, each has a sum of its own in the row of a text

def gazetteer_hits(tokens: Column, names: Sequence[str]) -> Column:
    """How many 1-3-grams of the token array are listed names.

    Names are looked for in the joined tokens, once per length, so no n-gram is built. A name's words
    stand in a lookahead: names that overlap all count.
    """
    by_size: dict[int, list[str]] = {}
    for name in names:
        by_size.setdefault(len(name.split(" ")), []).append(name)
    text = F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" "))
    total = F.lit(0)
    for n, listed in sorted(by_size.items()):
        if n == 1:
            total = total + F.size(F.filter(tokens, lambda t: t.isin(listed)))
        else:
            anyone = "|".join(map(re.escape, listed))
            total = total + F.coalesce(F.regexp_count(text, F.lit(f" (?=(?:{anyone}) )")), F.lit(0))
    return total


def text_features(
    df: DataFrame,
    names: Sequence[str],
    stop_words: Sequence[str],
    sentiment: Mapping[str, float],
    content: str = "content",
) -> DataFrame:
    """Add ``n_entities``, ``n_tokens`` and ``polarity`` of the head of the text.

    An entity is a listed name or a capitalised run inside a sentence. A model's counts
    can replace these three columns; ``validate`` only reads them.
    """
    head = F.col(content)
    stops = list(stop_words)
    tokens = F.col("_tokens")
    read = stage(stage(df, _head=head), _tokens=T.letter_tokens("_head"))
    counted = stage(
        read,
        n_entities=gazetteer_hits(tokens, names)
        + F.regexp_count(F.col("_head"), F.lit(T.CAPITAL_RUN)),
        n_tokens=F.size(F.filter(tokens, lambda t: ~t.isin(stops))),
        polarity=T.polarity(tokens, sentiment),
    )
    return counted.drop("_head", "_tokens")


def custom_rules(content: Column | str, rules: Sequence[tuple[str, str]]) -> Column:
    """Message of the first rule whose pattern does not match at the start, else null."""
    failed = [
        F.when(~T.starts_with_match(content, regex), F.lit(error)) for regex, error in rules
    ]
    return F.coalesce(*failed, F.lit(None).cast("string"))


def rule_table(rules: DataFrame, limit: int = 1000) -> list[tuple[str, str]]:
    """Rules of a user table (ord, regex, error) in order.

    Rules are configuration; a table larger than ``limit`` is refused, not truncated.
    """
    rows = rules.orderBy("ord").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} validation rules")
    return [(r["regex"], r["error"]) for r in rows]


def quality_score(
    entities: Column, tokens: Column, polarity: Column,
    entity_threshold: int = 1, token_threshold: int = 5,
) -> Column:
    """Mean of the two ratios and the absolute polarity; may exceed 1."""
    return (
        entities / F.lit(max(1, entity_threshold))
        + tokens / F.lit(max(1, token_threshold))
        + F.abs(polarity)
    ) / F.lit(3.0)


def validate(
    df: DataFrame,
    rules: Sequence[tuple[str, str]] = (),
    min_chars: int = 10,
    max_chars: int = 1_000_000,
    entity_threshold: int = 1,
    token_threshold: int = 5,
    use_sentiment: bool = True,
    sentiment_threshold: float = 0.05,
    content: str = "content",
) -> DataFrame:
    """Add ``validated``, ``message`` and ``quality_score`` to a frame with features."""
    length = F.length(content)
    score = quality_score(
        F.col("n_entities"), F.col("n_tokens"), F.col("polarity"),
        entity_threshold, token_threshold,
    )
    broken = custom_rules(content, rules)
    poor = (F.col("n_entities") < entity_threshold) | (F.col("n_tokens") < token_threshold)
    message = (
        F.when(length < min_chars, "too_short")
        .when(length > max_chars, "too_long")
        .when(broken.isNotNull(), F.concat(F.lit("rule:"), broken))
        .when(poor, "no_entities_or_keywords")
    )
    if use_sentiment:
        message = message.when(F.abs("polarity") < sentiment_threshold, "neutral")
    message = message.otherwise("valid")
    rejected = (
        F.col("message").isin("too_short", "too_long") | F.col("message").startswith("rule:")
    )
    return (
        stage(df, message=message)
        .withColumn("validated", F.col("message") == "valid")
        .withColumn("quality_score", F.when(rejected, 0.0).otherwise(F.round(score, 6)))
    )


def entity_mentions(
    df: DataFrame, kb: DataFrame, id_col: str = "id", content: str = "content",
    head_chars: int | None = None,
) -> DataFrame:
    """One row per mention: (id, pos, text, text_lc, label).

    Names of any number of words come from ``kb(text_lc, type)``; capitalised runs get the label
    ``MISC``. Every place where a name stands is a mention, also inside a longer name. The kb joins
    are plain equi-joins, so adaptive execution broadcasts a small kb by its measured size and
    splits skewed names of a large one. A name of more than three words is looked up by its
    runs of three words (:func:`_long_names`).
    """
    body = F.col(content)
    if head_chars is not None:
        body = F.substring(body, 1, head_chars)
    base = df.select(F.col(id_col).alias("id"), body.alias("_body"))
    tokens = stage(base, _t=T.letter_tokens("_body"))
    grams = reduce(
        DataFrame.unionByName,
        [
            tokens.select("id", F.posexplode(T.ngrams(F.col("_t"), n)).alias("pos", "text_lc"))
            for n in (1, 2, 3)
        ],
    )
    # written, so that its size is known before the n-grams of the texts would be shuffled
    listed = saved(kb.select("text_lc", F.col("type").alias("label")).distinct(), "names")
    places = grams.join(listed.select("text_lc").distinct(), "text_lc", "left_semi").unionByName(
        _long_names(tokens, listed.select("text_lc").distinct()))
    named = places.join(listed, "text_lc").select("id", "pos", F.col("text_lc").alias("text"), "text_lc", "label")
    runs = base.select(
        "id",
        F.posexplode(
            F.regexp_extract_all(F.col("_body"), F.lit(T.CAPITAL_RUN), F.lit(1))
        ).alias("pos", "text"),
    ).select("id", "pos", "text", F.lower("text").alias("text_lc"), F.lit("MISC").alias("label"))
    return named.unionByName(runs)


def _long_names(tokens: DataFrame, names: DataFrame) -> DataFrame:
    """(id, pos, text_lc): where names of more than three words stand in ``tokens(id, _t)``.

    A name is covered by its runs of three words at every third place and at its end. A
    run found at a place votes for the name's start; a start with all votes is a mention. A text's
    run of three words is a row only where some name has it, and no row holds a text.
    """
    words = F.split("text_lc", " ")
    last = F.size(words) - 3
    offsets = F.array_distinct(F.concat(F.sequence(F.lit(0), last, F.lit(3)), F.array(last)))
    parts = names.filter(F.size(words) > 3).select(
        "text_lc", F.size(offsets).alias("votes"), F.explode(offsets).alias("offset")
    ).withColumn("run", F.array_join(F.slice(words, F.col("offset") + 1, F.lit(3)), " "))
    runs = tokens.select("id", F.posexplode(T.ngrams(F.col("_t"), 3)).alias("at", "run"))
    found = runs.join(parts, "run").groupBy("id", (F.col("at") - F.col("offset")).alias("pos"), "text_lc").agg(
        F.count("*").alias("found"), F.max("votes").alias("votes"))
    return found.filter(F.col("found") == F.col("votes")).select("id", "pos", "text_lc")


def type_in_list(mentions: DataFrame, types: Sequence[str] = tuple(KB_TYPES)) -> DataFrame:
    return mentions.filter(F.col("label").isin(list(types)))


def kb_update(kb: DataFrame, mentions: DataFrame) -> DataFrame:
    """Upsert mentions into the knowledge base, the last document winning.

    ``max_by`` combines on the map side, so a name found in most documents still
    reaches its reducer as one row per task. The names found are read twice, so they are written once.
    """
    found = saved(
        type_in_list(mentions)
        .groupBy("text_lc")
        .agg(F.max_by("label", F.struct("id", "pos", "label")).alias("type"))
        .select(
            "text_lc", "type",
            F.concat(F.col("type"), F.lit(" sisällöstä")).alias("description"),
        ), "found"
    )
    kept = kb.select("text_lc", "type", "description").join(found, "text_lc", "left_anti")
    return kept.unionByName(found)


def tag_documents(
    df: DataFrame, keywords: DataFrame, bias: float = -3.0, threshold: float = 0.5,
    id_col: str = "id", content: str = "content",
) -> DataFrame:
    """Tags with logistic score above ``threshold``: (id, tag, score).

    ``keywords(tag, token, weight)`` stands in for a zero-shot classifier.
    """
    head = F.col(content)
    hits = (
        df.select(F.col(id_col).alias("id"), F.explode(T.letter_tokens(head)).alias("token"))
        .join(keywords, "token")
        .groupBy("id", "tag")
        .agg(F.sum("weight").alias("total"))
    )
    score = 1.0 / (1.0 + F.exp(-(F.col("total") + F.lit(bias))))
    return hits.select("id", "tag", score.alias("score")).filter(F.col("score") > threshold)


def train_tagger(labelled: DataFrame, label: str, content: str = "content"):
    """A trained tagger for one label: hashed term counts and logistic regression."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF

    prepared = labelled.withColumn("_terms", T.letter_tokens(content))
    stages = [
        HashingTF(inputCol="_terms", outputCol="_counts", numFeatures=1 << 14),
        LogisticRegression(
            featuresCol="_counts", labelCol=label, maxIter=10, regParam=0.01,
            probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="predicted",
        ),
    ]
    return Pipeline(stages=stages).fit(prepared)


def apply_tagger(model, df: DataFrame, content: str = "content") -> DataFrame:
    """Add ``score`` (probability of the label) with a model of ``train_tagger``."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(df.withColumn("_terms", T.letter_tokens(content)))
    return scored.select(*df.columns, vector_to_array("_probability")[1].alias("score"))


def _head_grams(df: DataFrame, id_col: str, content: str) -> DataFrame:
    """(id, gram): character trigrams of the head of the text."""
    heads = df.select(
        F.col(id_col).alias("id"), F.col(content).alias("_head")
    )
    return char_grams(heads, 2, "_head", "id")


def language_profiles(df: DataFrame, lang: str, id_col: str, content: str) -> DataFrame:
    """(gram, gains): add-one smoothed trigram models, one row per trigram.

    ``gains`` holds (lang, gain, missing) per language, where ``gain`` is what the trigram
    adds to the log probability compared with an unseen one. The counts are read three times and the
    profiles are joined with every trigram of a text, so both are written; profiles that are small by the size of
    their file are broadcast, and the texts' trigrams are not shuffled.
    """
    heads = df.select(
        F.col(lang).alias("lang"), F.col(content).alias("_head")
    )
    counts = saved(char_grams(heads, 2, "_head", "lang").groupBy("lang", "gram").agg(
        F.count("*").alias("n")
    ), "grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    vocab = counts.agg(F.countDistinct("gram").alias("v")).select("v").scalar()
    missing = F.log(1 / (F.col("total") + vocab))
    gain = F.log((F.col("n") + 1) / (F.col("total") + vocab)) - missing
    entry = F.struct("lang", gain.alias("gain"), missing.alias("missing"))
    return saved(counts.join(totals, "lang").groupBy("gram").agg(F.collect_list(entry).alias("gains")), "profiles")


def detect_language(
    df: DataFrame, profiles: DataFrame, id_col: str = "id", content: str = "content"
) -> DataFrame:
    """Most likely language per text: (id, detected, score).

    Log probability = gains of the known trigrams plus the number of trigrams times the
    value of an unseen one. A text meets each of its trigrams once in the join and is
    summed per language on the map side.
    """
    found = profiles.select(F.inline("gains")).groupBy("lang").agg(F.max("missing").alias("missing"))
    languages = found.orderBy("lang").limit(LANGUAGES + 1).collect()
    grams = _head_grams(df, id_col, content)
    if 0 < len(languages) <= LANGUAGES:  # one row per trigram with a sum per language, not one row per language
        def gain(lang: str) -> Column:
            return F.get(F.filter("gains", lambda g: g["lang"] == lang), 0)["gain"]

        gains = [gain(r["lang"]).alias(f"_g{i}") for i, r in enumerate(languages)]
        sums = grams.join(profiles.select("gram", *gains), "gram").groupBy("id").agg(
            *[F.sum(f"_g{i}").alias(f"_g{i}") for i in range(len(languages))])
        matched = sums.select("id", F.inline(F.array(*[
            F.struct(F.lit(r["lang"]).alias("lang"), F.col(f"_g{i}").alias("gain"), F.lit(r["missing"]).alias("missing"))
            for i, r in enumerate(languages)]))).filter("gain IS NOT NULL")
    else:
        matched = grams.join(profiles, "gram").select("id", F.inline("gains")).groupBy("id", "lang").agg(
            F.sum("gain").alias("gain"), F.max("missing").alias("missing"))
    head = F.length(content)
    sizes = df.select(F.col(id_col).alias("id"), F.greatest(head - 2, F.lit(0)).alias("n_grams"))
    scored = matched.join(sizes, "id").select(
        "id", "lang", (F.col("gain") + F.col("n_grams") * F.col("missing")).alias("score")
    )
    return scored.groupBy("id").agg(
        F.max_by("lang", F.struct(F.round("score", 6), "lang")).alias("detected"),
        F.max("score").alias("score"),
    )
