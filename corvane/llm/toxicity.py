"""Toxic documents by a subsequence string-kernel support vector machine."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from corvane.llm.common import held_out, parts, whole, with_whole
from corvane.session import cut

SAMPLE = 8_000
LANDMARKS = 384
CLEAN_WORDS = 4_000
HARD_ROUNDS = 2
RIDGE = 0.01
ORDER, SPAN, DECAY = 3, 5, 0.6
LETTERS = 32  # a to z and six classes of all other letters
WINDOW = 24
PART, WORDS_KEPT = 256, 200_000
NOT_LETTER = re.compile(r"[\W\d_]+")
#: Positions, from a first letter, of the other two letters of a subsequence within SPAN.
GAPS = [(a, b) for a in range(1, SPAN - 1) for b in range(a + 1, SPAN)]


def tokens(text: str) -> list[str]:
    """Lower-case words, and each run of three or more single characters joined to one word."""
    words = text.lower().split()
    if sum(1 for w in words if len(w) == 1) >= 3:
        runs, run = [], []
        for word in [*words, ""]:
            if len(word) == 1:
                run.append(word)
                continue
            if len(run) >= 3:
                runs.append("".join(run))
            run = []
        words += runs
    return words


def windows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(letters, owner): the words' letters as codes, -1 beyond the end.

    Other characters are dropped; a word of more than WINDOW letters gives overlapping windows.
    """
    codes, owner = [], []
    for at, word in enumerate(words):
        word = NOT_LETTER.sub("", word)
        for start in range(0, max(1, len(word) - SPAN + 1), WINDOW - SPAN + 1):
            codes.append(word[start:start + WINDOW])
            owner.append(at)
    width = max(map(len, codes), default=0)
    text = "".join(c.ljust(width) for c in codes)
    raw = np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(len(codes), width).astype(np.int32)
    letters = np.where((raw >= 97) & (raw <= 122), raw - 97, 26 + raw % 6)
    return np.where(raw == 32, -1, letters), np.array(owner)


def subsequences(letters: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """Codes (-1: none) and weight of every gapped letter triple, by gap pattern."""
    padded = np.pad(letters, ((0, 0), (0, SPAN)), constant_values=-1)
    width = letters.shape[1]
    for a, b in GAPS:
        x, y, z = padded[:, :width], padded[:, a:a + width], padded[:, b:b + width]
        yield np.where(z >= 0, (x * LETTERS + y) * LETTERS + z, -1), DECAY ** (b + 1)


def features(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse unit vectors (row, code, value) in the kernel's space of letter triples.

    The normalised subsequence kernel of two words is the product of their vectors.
    """
    rows, codes, weights = [], [], []
    for code, weight in subsequences(letters):
        row, at = np.nonzero(code >= 0)
        rows.append(row)
        codes.append(code[row, at])
        weights.append(np.full(len(row), weight))
    size = LETTERS ** ORDER
    keys = np.concatenate(rows) * size + np.concatenate(codes) if rows else np.array([], np.int64)
    keys, place = np.unique(keys, return_inverse=True)
    values = np.bincount(place, np.concatenate(weights) if rows else [], len(keys))
    row, code = keys // size, keys % size
    norm = np.sqrt(np.bincount(row, values ** 2, len(letters)))
    return row, code, values / norm[row]


@dataclass
class ToxicityModel:
    """Weights of the letter triples: the machine's weights pulled back through its landmarks."""

    triples: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def margins(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        letters, owner = windows(words)
        row, code, value = features(letters)
        margin = np.bincount(row, value * self.triples[code], len(letters)) + self.bias
        best = np.full(len(words), -np.inf)
        np.maximum.at(best, owner, margin)
        return best

    def document_margins(self, texts: Iterator[str], memo: dict[str, float]) -> list[float]:
        """The highest margin of any word; the bias alone if there is no word.

        Words of PART texts are held at a time.
        """
        out: list[float] = []
        texts = list(texts)
        for first in range(0, len(texts), PART):
            words = [tokens(t) for t in texts[first:first + PART]]
            met = set().union(*words)
            new = [w for w in met if w not in memo]
            if len(memo) + len(new) > WORDS_KEPT:
                memo.clear()
                new = list(met)
            for at in range(0, len(new), 20_000):
                part = new[at:at + 20_000]
                memo.update(zip(part, self.margins(part).tolist()))
            out += [max(map(memo.__getitem__, w), default=self.bias) for w in words]
        return out

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def _dense(words: list[str]) -> np.ndarray:
    """One vector per word: of the window with the most letters' weight, which is its first."""
    letters, owner = windows(words)
    first = np.unique(owner, return_index=True)[1]
    row, code, value = features(letters[first])
    out = np.zeros((len(words), LETTERS ** ORDER), np.float32)
    out[row, code] = value
    return out


def _kernel(words: list[str], marks: np.ndarray) -> np.ndarray:
    """Normalised kernel of every word with every landmark, from the words' sparse vectors."""
    letters, owner = windows(words)
    first = np.unique(owner, return_index=True)[1]
    row, code, value = features(letters[first])
    out = np.zeros((len(words), len(marks)))
    for at in range(0, len(row), 100_000):
        part = slice(at, at + 100_000)
        starts = np.unique(row[part], return_index=True)
        out[starts[0]] += np.add.reduceat(marks.T[code[part]] * value[part, None], starts[1], axis=0)
    return out


def padded(word: str) -> list[str]:
    """The word with one letter more: each inner letter doubled, or a rare letter before it."""
    return [word[:i] + extra + word[i:] for i in range(1, len(word)) for extra in (word[i], "q")]


def fit_machine(toxic: list[str], clean: list[str], landmarks: int = LANDMARKS) -> ToxicityModel:
    """Linear SVM (squared hinge, Newton steps) on Nyström features of labelled words.

    Toxic words are also shown with an inserted letter.
    """
    half = landmarks // 2
    marks = _dense(toxic[:half] + clean[:landmarks - min(half, len(toxic))])
    toxic = toxic + [w for word in toxic for w in padded(word) if len(w) <= WINDOW]
    inner = marks @ marks.T
    values, vectors = np.linalg.eigh(inner.astype(np.float64))
    keep = values > 1e-6 * max(values.max(), 1e-12)
    pull = (vectors[:, keep] / np.sqrt(values[keep])) @ vectors[:, keep].T
    blocks = [_kernel(part, marks) for at in range(0, len(toxic) + len(clean), 500)
              if (part := (toxic + clean)[at:at + 500])]
    x = np.hstack([np.vstack(blocks) @ pull, np.ones((len(toxic) + len(clean), 1))])
    y = np.r_[np.ones(len(toxic)), -np.ones(len(clean))]
    cost = np.where(y > 0, len(clean) / max(len(toxic), 1), 1.0)
    w, ridge = np.zeros(x.shape[1]), RIDGE * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        active = y * (x @ w) < 1
        a = x[active] * cost[active, None]
        new = np.linalg.solve(a.T @ x[active] + ridge, a.T @ y[active])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return ToxicityModel((marks.T @ (pull @ w[:-1])).astype(np.float64), float(w[-1]))


def train_toxicity(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id",
    text_col: str = "text", label_col: str = "toxic",
) -> ToxicityModel:
    """Fit on at most ``sample`` labelled rows outside the held-out fifth, chosen by id hash.

    Word statistics are gathered by Spark: in how many toxic and clean sampled documents a word
    occurs (documents that share the four long words lowest by hash count once, so copies rarely vote
    twice). Words whose toxicity is significant against the number of words tried are the toxic
    examples; words of clean documents, drawn by hash, the others. Examples from both sides are
    the Nyström landmarks. A logistic curve turns the highest margin of a document into a score.
    """
    chosen = (
        labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label_col).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    # at most ``sample`` rows of two numbers
    texts = docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text")).join(
        F.broadcast(chosen), "doc_id")

    def words_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, toxic in zip(batch["text"], batch["toxic"]):
                found = {NOT_LETTER.sub("", w) for w in tokens(text)}
                found = {w for w in found if 3 <= len(w) <= WINDOW}
                long = sorted(hash_word(w) for w in found if len(w) >= 7)[:4]
                out.append((hash_word(repr(long) if len(long) == 4 else text), int(toxic), list(found)))
            yield pd.DataFrame(out, columns=["kin", "toxic", "words"])

    seen = (
        texts.mapInPandas(words_of, "kin long, toxic int, words array<string>")
        .groupBy("kin", "toxic").agg(F.max_by("words", F.size("words")).alias("words"))
    )
    counts = seen.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("toxic").alias("bad"), F.count("*").alias("n"))
    totals = seen.agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
    counts, totals = cut(counts), totals.first()
    rate = min(max((totals["bad"] or 0) / max(totals["n"], 1), 1e-3), 0.999)
    tried = max(counts.filter("n >= 3").count(), 2)
    share = F.col("bad") / F.col("n")
    evidence = F.col("bad") * F.log(F.greatest(share, F.lit(1e-9)) / rate) + (
        F.col("n") - F.col("bad")) * F.log(F.greatest(1 - share, F.lit(1e-9)) / (1 - rate))
    toxic = [r["word"] for r in counts.filter((share > 0.5) & (share > rate))
             .withColumn("evidence", evidence).filter(F.col("evidence") > math.log(tried) + 1)
             .orderBy(F.desc("evidence"), "word").limit(LANDMARKS).collect()]
    others = counts.filter(share <= rate)
    clean = {r["word"] for order in (F.desc("n"), F.xxhash64("word"))
             for r in others.orderBy(order, "word").limit(CLEAN_WORDS // 2).collect()}
    if not toxic or not clean:  # nothing to learn from: every document gets the base rate
        return ToxicityModel(np.zeros(LETTERS ** ORDER), -1.0, 1.0, 1.0 + math.log(rate / (1 - rate)))
    by_hash = lambda words: sorted(words, key=hash_word)
    model = fit_machine(toxic, by_hash(clean))
    for _ in range(HARD_ROUNDS):  # the clean words nearest to the toxic side join the examples
        machine = model

        def rate_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                words = batch["word"].tolist()
                yield pd.DataFrame({"word": words, "margin": machine.margins(words)})

        hard = others.select("word").mapInPandas(rate_words, "word string, margin double")
        clean |= {r["word"] for r in hard.filter("margin > -0.8").orderBy(F.desc("margin"), "word")
                  .limit(CLEAN_WORDS // 4).collect()}
        model = fit_machine(toxic, by_hash(clean))

    def margins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[str, float] = {}
        for batch in batches:
            yield pd.DataFrame({"margin": model.document_margins(batch["text"], memo),
                                "toxic": batch["toxic"]})

    got = texts.mapInPandas(margins, "margin double, toxic int").toPandas()  # ``sample`` rows
    model.slope, model.offset = fit_curve(got["margin"].to_numpy(), got["toxic"].to_numpy())
    return model


def hash_word(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) >> 1


def fit_curve(margin: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one feature by Newton steps with a small ridge."""
    x = np.c_[margin, np.ones(len(margin))]
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2),
                               x.T @ (p - toxic) + 0.1 * (w - [1.0, 0.0]))
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 1e-3), float(w[1])


def with_score(
    docs: DataFrame, model: ToxicityModel, text_col: str = "text", name: str = "score",
) -> DataFrame:
    """``docs`` with ``name``: the score of the whole text. A column of that name is replaced.

    A document's score is that of its most toxic word. Characters that aren't letters are
    dropped from a word, single characters in a row are joined, and the kernel allows gaps, so
    spelled-out, interrupted and padded insults keep most of their subsequences. Null and empty
    texts get the score of no word. The model is a table of 32^3 numbers.
    """
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, float] = {}
        for batch in parts(batches):
            margin = np.array(model.document_margins(batch.column(batch.num_columns - 1).to_pylist(), memo))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(model.probability(margin), pa.float64())],
                names=[*batch.schema.names[:-1], name])

    kept = docs.drop(name)
    return with_whole(kept, text_col).mapInArrow(
        score, kept.withColumn(name, F.lit(0.0)).schema)


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; see ``with_score``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                       F.col(text_col).alias("text"))
    return with_score(rows, model).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
