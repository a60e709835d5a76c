"""Building blocks of the comparison SQL (DuckDB dialect)."""

from __future__ import annotations

from corvane.functions import text as T
from corvane.functions.lexicons import EXPLAIN_WORDS, STOP_WORDS
from corvane.plans import fixtures as fx


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(quoted(v) for v in values) + ")"


def values(rows) -> str:
    def one(x):
        return quoted(x) if isinstance(x, str) else f"{x!r}::DOUBLE" if isinstance(x, float) else repr(x)

    return "(VALUES " + ", ".join("(" + ", ".join(one(x) for x in r) + ")" for r in rows) + ")"


def norm(col: str) -> str:
    return f"trim(regexp_replace({col}, '{T.WHITESPACE}', ' ', 'g'))"


def letters(col: str) -> str:
    return rf"regexp_extract_all(lower({col}), '\p{{L}}+')"


def content_tokens(col: str) -> str:
    return f"list_filter({letters(col)}, lambda t: t NOT IN {in_list(STOP_WORDS)})"


def words(col: str) -> str:
    return f"regexp_extract_all(lower({col}), '{T.WORD_OR_MARK}')"


def sentence_list(col: str) -> str:
    return (
        rf"list_filter(string_split(regexp_replace({col}, '([.!?])[ ]+', '\1' || chr(1), 'g'), chr(1)), "
        "lambda s: trim(s) <> '' AND length(s) > 5)"
    )


def grams(col: str, n: int) -> str:
    if n == 1:
        return col
    glue = " || ' ' || ".join(f"{col}[i + {k}]" for k in range(n))
    return f"list_transform(range(1, len({col}) - {n - 2}), lambda i: {glue})"


def intent(col: str) -> str:
    low = f"lower({col})"
    explain = f"len(list_filter({letters(col)}, lambda t: t IN {in_list(EXPLAIN_WORDS)})) > 0"

    def starts(*heads):
        return "(" + " OR ".join(f"starts_with({low}, '{h}')" for h in heads) + ")"

    return (
        f"CASE WHEN {starts('list', 'what are', 'name')} THEN 'list' "
        f"WHEN {starts('define')} THEN 'definition' "
        f"WHEN {explain} OR {starts('why', 'how')} THEN 'explanation' "
        f"WHEN {starts('compare', 'difference')} THEN 'comparison' ELSE 'factoid' END"
    )


def rewrite(col: str) -> str:
    return f"trim(regexp_replace(trim(lower({col})), '{T.WH_LEAD}', ''))"


def validated(name: str, source: str) -> str:
    """CTEs that end in ``name``: ``source`` (id, content, ...) with features and verdict."""
    by_size: dict[int, list[str]] = {}
    for text, _, _ in fx.NAMES:
        by_size.setdefault(len(text.split(" ")), []).append(text)
    hits = " + ".join(
        f"len(list_filter({grams('toks', n)}, lambda g: g IN {in_list(listed)}))"
        for n, listed in sorted(by_size.items())
    )
    weight = " ".join(f"WHEN {quoted(k)} THEN {v}::DOUBLE" for k, v in fx.SENTIMENT.items())
    rules = " ".join(
        rf"WHEN NOT regexp_matches(content, '\A(?:{regex})') THEN 'rule:{error}'"
        for regex, error in fx.RULES
    )
    return rf"""
{name}_a AS (SELECT *, content AS head FROM {source}),
{name}_b AS (SELECT *, {letters('head')} AS toks FROM {name}_a),
{name}_c AS (SELECT *,
  {hits} + len(regexp_extract_all(head, '{T.CAPITAL_RUN}')) AS n_entities,
  len(list_filter(toks, lambda t: t NOT IN {in_list(STOP_WORDS)})) AS n_tokens,
  coalesce(list_avg(list_filter(list_transform(toks, lambda t: CASE t {weight} END),
    lambda w: w IS NOT NULL)), 0.0) AS polarity FROM {name}_b),
{name}_d AS (SELECT *, CASE WHEN length(content) < 10 THEN 'too_short'
  WHEN length(content) > 1000000 THEN 'too_long' {rules}
  WHEN n_entities < 1 OR n_tokens < 5 THEN 'no_entities_or_keywords'
  WHEN abs(polarity) < 0.05 THEN 'neutral' ELSE 'valid' END AS message FROM {name}_c),
{name} AS (SELECT * EXCLUDE (head, toks), message = 'valid' AS validated,
  CASE WHEN message IN ('too_short', 'too_long') OR message LIKE 'rule:%' THEN 0.0
  ELSE round((n_entities / 1.0::DOUBLE + n_tokens / 5.0::DOUBLE + abs(polarity)) / 3.0::DOUBLE, 6) END
  AS quality_score FROM {name}_d)"""


def bm25(name: str, queries: str, docs: str) -> str:
    """CTEs ending in ``name`` (query_id, doc_id, score); inputs have a ``tokens`` list."""
    return f"""
{name}_t AS (SELECT query_id, token, count(*) AS qtf
  FROM (SELECT query_id, unnest(tokens) AS token FROM {queries}) GROUP BY ALL),
{name}_s AS (SELECT count(*) AS n, avg(len(tokens)) AS avg_len FROM {docs}),
{name}_f AS (SELECT token, count(*) AS df
  FROM (SELECT unnest(list_distinct(tokens)) AS token FROM {docs}) GROUP BY token),
{name}_r AS (SELECT token, ln((n - df + 0.5) / (df + 0.5)::DOUBLE) AS raw FROM {name}_f, {name}_s),
{name}_m AS (SELECT avg(raw) AS mean FROM {name}_r),
{name}_i AS (SELECT token, CASE WHEN raw < 0 THEN 0.25 * mean ELSE raw END AS idf
  FROM {name}_r, {name}_m),
{name}_p AS (SELECT doc_id, len, token, count(*) AS tf
  FROM (SELECT doc_id, len(tokens) AS len, unnest(tokens) AS token FROM {docs})
  WHERE token IN (SELECT token FROM {name}_t) GROUP BY ALL),
{name} AS (SELECT query_id, doc_id,
  sum(qtf * idf * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len / avg_len))) AS score
  FROM {name}_p JOIN {name}_t USING (token) JOIN {name}_i USING (token), {name}_s GROUP BY ALL)"""


def embed(name: str, source: str, key: str, tokens: str, dim: int = 256) -> str:
    """CTEs ending in ``name`` (key, bucket, w): hashed unit vectors."""
    return f"""
{name}_n AS (SELECT {key}, bucket, count(*)::DOUBLE AS c FROM (SELECT {key},
  CAST(('0x' || substr(md5(token), 1, 8)) AS BIGINT) % {dim} AS bucket
  FROM (SELECT {key}, unnest({tokens}) AS token FROM {source})) GROUP BY ALL),
{name} AS (SELECT {key}, bucket, c / sqrt(sum(c * c) OVER (PARTITION BY {key})) AS w FROM {name}_n)"""


CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def define(name: str, sql: str, *needs: str) -> None:
    CTES[name] = (needs, sql)


def with_ctes(body: str, *needs: str, recursive: bool = False) -> str:
    """``body`` behind the named CTEs and everything they need, each once."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for other in CTES[name][0]:
            visit(other)
        order.append(name)

    for name in needs:
        visit(name)
    parts = [CTES[name][1].strip() for name in order]
    rest = body.strip()
    if rest.lower().startswith("with "):
        rest = rest[5:]
        parts.append("")
        head = ",\n".join(parts[:-1]) + ",\n" if len(parts) > 1 else ""
        return f"WITH {'RECURSIVE ' if recursive else ''}{head}{rest}"
    if not parts:
        return rest
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" + rest


KIND = "CASE doc_id % 5 " + " ".join(
    f"WHEN {i} THEN '{t}'" for i, t in enumerate(fx.TYPES)
) + " END"
define(
    "raw_entries",
    f"""raw_entries AS (SELECT doc_id AS id, {KIND} AS data_type, {norm('text')} AS content, source,
  '{{"file_size":' || strlen(text) || ',"lang":"' || lang || '"}}' AS metadata FROM documents)""",
)
define("entries", validated("entries", "raw_entries"), "raw_entries")
define(
    "sentences",
    f"""sentences_l AS (SELECT id AS entry_id, {sentence_list('content')} AS s FROM raw_entries),
sentences AS (SELECT *, entry_id || '-' || lpad(pos::VARCHAR, 6, '0') AS sentence_id FROM
  (SELECT entry_id, unnest(range(len(s))) AS pos, unnest(s) AS sentence FROM sentences_l))""",
    "raw_entries",
)
define(
    "candidates",
    f"""candidates AS (SELECT entry_id, pos, sentence, sentence_id, sentence_id AS doc_id,
  {content_tokens('sentence')} AS tokens FROM sentences
  WHERE entry_id IN (SELECT id FROM entries WHERE validated AND quality_score > 0.7))""",
    "entries", "sentences",
)
define(
    "flagged",
    """flagged_m AS (SELECT median(quality_score) AS med, count(*) AS n FROM entries),
flagged_d AS (SELECT id, round(abs(quality_score - med), 9) AS distance, n FROM entries, flagged_m),
flagged AS (SELECT id, distance FROM
  (SELECT *, row_number() OVER (ORDER BY distance DESC, id) AS r FROM flagged_d)
  WHERE r <= ceil(n * 0.1::DOUBLE))""",
    "entries",
)
define("kb", f"kb AS (SELECT * FROM {values(fx.NAMES)} t(text_lc, type, description))")
define(
    "listed",
    """listed AS (SELECT e.*, f.id IS NOT NULL AS is_anomaly FROM entries e LEFT JOIN flagged f USING (id))""",
    "flagged",
)
define(
    "questions",
    f"""questions AS (SELECT item_id AS qid, text AS question, {intent('text')} AS intent,
  {rewrite('text')} AS rewritten FROM benchmark)""",
)
define("synonyms", f"synonyms AS (SELECT * FROM {values(fx.SYNONYMS)} t(word, synonym))")
define(
    "expanded",
    f"""expanded_w AS (SELECT DISTINCT qid, unnest({content_tokens('rewritten')}) AS word FROM questions),
expanded AS (SELECT qid, list_sort(list(DISTINCT word)) AS words FROM
  (SELECT qid, word FROM expanded_w UNION ALL
   SELECT qid, replace(lower(synonym), '_', ' ') FROM expanded_w JOIN synonyms USING (word)) GROUP BY qid),
asked AS (SELECT qid AS query_id, {content_tokens("array_to_string(words, ' ')")} AS tokens FROM expanded)""",
    "questions", "synonyms",
)
define("lexical", bm25("lexical", "asked", "candidates"), "expanded", "candidates")
define("question_vec", embed("question_vec", "asked", "query_id", "tokens"), "expanded")
define("sentence_vec", embed("sentence_vec", "candidates", "doc_id", "tokens"), "candidates")
define(
    "semantic",
    """semantic_s AS (SELECT query_id, b.doc_id, round(sum(a.w * b.w), 9) AS sim
  FROM question_vec a JOIN sentence_vec b USING (bucket) GROUP BY ALL),
semantic AS (SELECT * FROM (SELECT *, row_number() OVER
  (PARTITION BY query_id ORDER BY sim DESC, doc_id) AS rank FROM semantic_s) WHERE rank <= 5)""",
    "question_vec", "sentence_vec",
)
define("logits", """logits AS (SELECT vec_id AS seq_id, unnest(range(len(embedding)))::INT AS token_id,
  unnest(embedding)::DOUBLE * 10 AS logit FROM embeddings)""")
define(
    "vocab",
    f"""vocab_t AS (SELECT doc_id, unnest(range(len(w))) AS p, unnest(w) AS token
  FROM (SELECT doc_id, {words('text')} AS w FROM documents)),
vocab_c AS (SELECT token, count(*) AS freq, min(lpad(doc_id::VARCHAR, 12, '0') || lpad(p::VARCHAR, 9, '0')) AS f
  FROM vocab_t WHERE token NOT IN ('<PAD>', '<UNK>', '<BOS>', '<EOS>') GROUP BY token),
vocab AS (SELECT * FROM (VALUES ('<PAD>', 0, 0), ('<UNK>', 1, 0), ('<BOS>', 2, 0), ('<EOS>', 3, 0)) t(token, id, freq)
  UNION ALL SELECT token, (row_number() OVER (ORDER BY freq DESC, f) + 3)::INT, freq
  FROM (SELECT * FROM vocab_c ORDER BY freq DESC, f LIMIT 4996))""",
)
define(
    "encoded",
    """encoded AS (SELECT d.doc_id AS id, list_concat([2], coalesce(i.ids, []::INT[]), [3]) AS ids
  FROM documents d LEFT JOIN (SELECT doc_id, list(coalesce(v.id, 1)::INT ORDER BY p) AS ids
  FROM vocab_t LEFT JOIN vocab v USING (token) GROUP BY doc_id) i USING (doc_id))""",
    "vocab",
)
define(
    "transitions",
    """transitions_c AS (SELECT doc_id, string_split(text, '') AS c FROM documents),
transitions_g AS (SELECT unnest(list_transform(range(1, len(c) - 2),
  lambda i: c[i] || c[i + 1] || c[i + 2] || c[i + 3])) AS gram FROM transitions_c),
transitions AS (SELECT substr(gram, 1, 3) AS ctx, substr(gram, 4, 1) AS nxt, count(*) AS n
  FROM transitions_g GROUP BY ALL)""",
)
define(
    "split",
    """split_k AS (SELECT doc_id AS id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS r,
  count(*) OVER () AS n FROM documents),
split AS (SELECT id, CASE WHEN r <= greatest(1, floor(n * 0.9::DOUBLE)) THEN 'train' ELSE 'val' END AS split
  FROM split_k)""",
)
