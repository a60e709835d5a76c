"""Column expressions on text. Everything here stays inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Unicode white space, written so that Java and RE2 read it alike.
WHITESPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]+"
SENTENCE_END = r"([.!?])[ ]+"
LETTERS = r"\p{L}+"
WORD_OR_MARK = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"
CAPITAL_RUN = r"[^.!?] (\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*)"
MARK = "\u0001"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def normalize_ws(text: Column | str) -> Column:
    """Strip and collapse every run of white space to one space."""
    return F.trim(F.regexp_replace(_col(text), WHITESPACE, " "))


def sentence_array(text: Column | str, min_chars: int = 5) -> Column:
    """Sentences of normalised text that are longer than ``min_chars``.

    A rule (end mark followed by space) stands in for a trained splitter;
    abbreviations are not special.
    """
    marked = F.regexp_replace(_col(text), SENTENCE_END, "$1" + MARK)
    parts = F.split(marked, MARK)
    return F.filter(parts, lambda s: (F.trim(s) != "") & (F.length(s) > min_chars))


def letter_tokens(text: Column | str) -> Column:
    """Lower-case alphabetic tokens, stop words included."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(LETTERS), F.lit(0))


def content_tokens(text: Column | str, stop_words: Sequence[str]) -> Column:
    """Lower-case alphabetic tokens without stop words."""
    words = list(stop_words)
    return F.filter(letter_tokens(text), lambda t: ~t.isin(words))


def word_tokens(text: Column | str) -> Column:
    """Lower-case words and single punctuation marks."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(WORD_OR_MARK), F.lit(0))


def ngrams(tokens: Column, n: int) -> Column:
    """Space-joined n-grams of a token array; empty when there are too few tokens."""
    if n == 1:
        return tokens
    last = F.size(tokens) - n + 1
    grams = F.transform(
        F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
        lambda i: F.array_join(F.slice(tokens, i, n), " "),
    )
    return F.when(last >= 1, grams).otherwise(F.array().cast("array<string>"))


def preview(text: Column | str, chars: int = 100) -> Column:
    return F.substring(_col(text), 1, chars)


def status_label(validated: Column | str) -> Column:
    return F.when(_col(validated), F.lit("validated")).otherwise(F.lit("needs_validation"))


def file_extension(path: Column | str) -> Column:
    """Lower-case extension without the dot; empty when the name has none."""
    name = F.regexp_extract(_col(path), r"([^/\\]*)$", 1)
    return F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1))


def contains_ci(text: Column | str, needle: str) -> Column:
    """Case-insensitive containment of a literal (wildcards are taken literally)."""
    quoted = needle.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return _col(text).ilike(f"%{quoted}%")


def starts_with_match(text: Column | str, regex: str) -> Column:
    """True when the pattern matches at the start of the text."""
    return _col(text).rlike(r"\A(?:" + regex + ")")


def polarity(tokens: Column, lexicon: Mapping[str, float]) -> Column:
    """Mean lexicon weight of the tokens found in the lexicon, 0 without a hit."""
    pairs = [F.lit(x) for item in sorted(lexicon.items()) for x in item]
    table = F.create_map(*pairs)
    # the hashed test spares most tokens the walk through the map
    listed = F.filter(tokens, lambda t: t.isin(sorted(lexicon)))
    hits = F.filter(
        F.transform(listed, lambda t: F.try_element_at(table, t)), lambda w: w.isNotNull()
    )
    total = F.aggregate(hits, F.lit(0.0), lambda acc, w: acc + w)
    return F.when(F.size(hits) > 0, total / F.size(hits)).otherwise(F.lit(0.0))


def detect_intent(question: Column | str, explain_words: Sequence[str]) -> Column:
    """Question intent; the first rule that applies wins.

    A closed list of prepositions and adverbs replaces a dependency parse.
    """
    low = F.lower(_col(question))
    has_explain = F.exists(letter_tokens(question), lambda t: t.isin(list(explain_words)))

    def starts(*heads: str) -> Column:
        test = low.startswith(heads[0])
        for head in heads[1:]:
            test = test | low.startswith(head)
        return test

    return (
        F.when(starts("list", "what are", "name"), "list")
        .when(starts("define"), "definition")
        .when(has_explain | starts("why", "how"), "explanation")
        .when(starts("compare", "difference"), "comparison")
        .otherwise("factoid")
    )


WH_LEAD = r"^(what|where|who|when)( (is|are|was|were|do|does|did))?( |$)"


def rewrite_question(question: Column | str) -> Column:
    """Lower, strip, and drop a leading wh-word with its auxiliary."""
    low = F.trim(F.lower(_col(question)))
    return F.trim(F.regexp_replace(low, WH_LEAD, ""))


def two_decimals(x: Column) -> Column:
    """A non-negative number with two decimals, correctly rounded, ties to even.

    ``format_string`` rounds the shortest decimal form half up, which differs for values
    such as 8.125. Here x * 100 is kept exactly as a product and its error term.
    """
    scaled = x * 134217729.0
    high = scaled - (scaled - x)
    product = x * 100.0
    error = (high * 100.0 - product) + (x - high) * 100.0
    whole = F.floor(product)
    over = product - whole - 0.5
    tie_up = (over == 0) & ((error > 0) | ((error == 0) & (whole % 2 == 1)))
    cents = whole + F.when((over > 0) | tie_up, 1).otherwise(0)
    return F.format_string("%d.%02d", F.floor(cents / 100), cents % 100)


def format_entry(
    id_: str = "id", type_: str = "data_type", source: str = "source",
    status: str = "status", quality: str = "quality_score", metadata: str = "metadata",
) -> Column:
    """One text line per entry, quality with two decimals."""
    return F.concat(
        F.lit("id: "), F.col(id_).cast("string"),
        F.lit(", type: "), F.col(type_),
        F.lit(", source: "), F.col(source),
        F.lit(", status: "), F.col(status),
        F.lit(", quality: "), two_decimals(F.col(quality)),
        F.lit(", metadata: "), F.col(metadata),
    )
