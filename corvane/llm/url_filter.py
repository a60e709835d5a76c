"""URL verdicts: rules first, then naive Bayes over segmented host names and path tokens."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corvane.llm.common import whole
from corvane.session import cut

#: (host, path start, verdict); fixed values.
RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]
LONGEST = 24


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: behind the first '://' up to '/', '?', '#'; path: then up to '?', '#'."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    return lower_ascii(host), F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits; null without one."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def word_counts(texts: DataFrame, text_col: str) -> DataFrame:
    """(word, n) of all words of all texts, counted per task first."""
    word = re.compile(rb"[a-z]{2,24}").findall

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array([w.decode() for w in total], pa.string()), pa.array(list(total.values()), pa.int64())],
                names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for text in batch.column("text").to_pylist():
                total.update(word(text.encode("utf-8", "surrogatepass").lower()))
            if len(total) > 300_000:
                yield flush()
        yield flush()

    rows = texts.select(whole(text_col).alias("text")).mapInArrow(count, "word string, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def segment(name: str, words: dict[str, float], least: float | None = None) -> list[str]:
    """The most probable split of a concatenated name (unigram Viterbi).

    ``words`` needs those that occur in the name; ``least`` is then the lowest log probability of all.
    A stretch that no word explains costs ten words' worth per character and stays together.
    """
    if not words:
        return [name] if name else []
    unknown = (min(words.values()) if least is None else least) - 2.0
    best, back = [0.0], [0]
    for end in range(1, len(name) + 1):
        options = [(best[start] + words[name[start:end]], start)
                   for start in range(max(0, end - LONGEST), end) if name[start:end] in words]
        options.append((best[end - 1] + unknown * 1.5, end - 1))
        score, start = max(options)
        best.append(score)
        back.append(start)
    parts, end = [], len(name)
    while end:
        parts.append(name[back[end]:end])
        end = back[end]
    out: list[str] = []
    for part in reversed(parts):
        if out and part not in words and len(part) == 1 and out[-1] not in words:
            out[-1] += part
        else:
            out.append(part)
    return out


def segmented(names: DataFrame, words: DataFrame) -> DataFrame:
    """(name, parts): the split of every distinct name, by the counts of all words.

    A name's substrings are joined to the word table, so a task holds the words of one name.
    """
    total, least = words.agg(F.sum("n"), F.min("n")).first()
    log_total = math.log(total) if total else 0.0
    lowest = math.log(least) - log_total if total else 0.0
    starts = F.sequence(F.lit(1), F.length("name") - 1)
    pieces = F.flatten(F.transform(starts, lambda at: F.transform(
        F.sequence(F.lit(2), F.least(F.lit(LONGEST), F.length("name") - at + 1)), lambda size: F.substring("name", at, size))))
    found = (
        names.filter(F.length("name") > 1).select("name", F.explode(F.array_distinct(pieces)).alias("word"))
        .join(words, "word").groupBy("name").agg(F.collect_list(F.struct("word", "n")).alias("words"))
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [
                segment(name, {w["word"]: math.log(w["n"]) - log_total for w in hits or ()}, lowest)
                for name, hits in zip(batch.column("name").to_pylist(), batch.column("words").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("name"), pa.array(parts, pa.list_(pa.string()))], names=["name", "parts"])

    return names.join(found, "name", "left").select("name", "words").mapInArrow(split, "name string, parts array<string>")


def host_tokens(hosts: DataFrame, words: DataFrame) -> DataFrame:
    """(host, host_tokens) of the hosts with letters or digits: 'h:' tokens, labels split at digits and into words."""
    runs = hosts.select("host", F.explode(F.regexp_extract_all("host", F.lit("([a-z]+|[0-9]+)"), F.lit(1))).alias("name"))
    parts = segmented(runs.filter("name >= 'a'").select("name").distinct(), words)
    return (
        runs.join(parts, "name", "left")
        .select("host", F.explode(F.coalesce("parts", F.array("name"))).alias("part"))
        .groupBy("host").agg(F.collect_list(F.concat(F.lit("h:"), F.col("part"))).alias("host_tokens"))
    )


def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, id_col: str = "page_id",
    url_col: str = "url", text_col: str = "html",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row.

    The longest rule that fits decides. Other addresses are judged by multinomial naive Bayes
    with add-one smoothing over the tokens of segmented host and path; its classes are learned
    from all addresses that rules decide, its word list from all words of the pages' texts. Tokens are
    counted per distinct host and path, then per class, and the counts are joined to the
    undecided addresses' tokens. score is the log odds of block; ties and addresses without
    tokens follow the class sizes, and without any decided address everything is allowed.

    Null addresses and those without '://' have an empty host and path and no rule.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    distinct = cut(rows.groupBy("host", "path").agg(F.count("*").alias("n")))
    by_host = host_tokens(distinct.select("host").distinct(), cut(word_counts(pages, text_col)))
    in_path = F.transform(
        F.filter(F.split(F.lower("path"), "[^a-z]+"), lambda t: t != ""), lambda t: F.concat(F.lit("p:"), t))
    ruled = matching_rule(F.col("host"), F.col("path"), rules)

    tokens = cut(distinct.join(by_host, "host", "left").select(
        "host", "path", "n", ruled["verdict"].alias("verdict"),
        F.concat(F.coalesce("host_tokens", F.array().cast("array<string>")), in_path).alias("tokens")))
    known = tokens.filter("verdict is not null")
    block = F.when(F.col("verdict") == "block", F.col("n")).otherwise(0)
    model = known.select("n", "verdict", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.sum(block).alias("b"), F.sum(F.col("n")).alias("all"))
    size = known.select("verdict", "n", F.size("tokens").alias("k")).agg(
        F.sum(block).alias("b"), F.sum("n").alias("n"),
        F.sum(block * F.col("k")).alias("bt"), F.sum(F.col("n") * F.col("k")).alias("t")).first()
    kinds = model.count()
    b, n, bt, t = (size[c] or 0 for c in ("b", "n", "bt", "t"))
    prior = math.log((b + 1) / (n - b + 1)) if n else -1.0
    odds = F.log((F.coalesce("b", F.lit(0)) + 1) / (bt + kinds + 1)) - F.log(
        (F.coalesce(F.col("all") - F.col("b"), F.lit(0)) + 1) / (t - bt + kinds + 1))
    scored = (
        tokens.filter("verdict is null").select("host", "path", F.posexplode("tokens").alias("at", "token"))
        .join(model, "token", "left")
        .groupBy("host", "path").agg(F.round(F.sum(odds), 9).alias("odds"))
    )
    facts = tokens.select("host", "path", "verdict").join(scored, ["host", "path"], "left")
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    return rows.join(facts, ["host", "path"]).select(
        "page_id", "host", "path", rule["rule"].alias("rule"),
        F.coalesce(F.col("verdict"), F.when(F.coalesce("odds", F.lit(0.0)) + prior > 0, "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("verdict").isNull(), F.coalesce("odds", F.lit(0.0)) + prior).alias("score"))
