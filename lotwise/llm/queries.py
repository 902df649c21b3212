"""One registered query per operator, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import (
    bpe,
    embedding_dedup,
    lexical,
    line_dedup,
    mixing,
    phrases,
    pii,
    quality,
    simhash,
    substring_dedup,
    token_counts,
    toxicity,
    warc,
)
from lotwise.llm.common import application_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return register


def _quality_sql() -> str:
    """The base and the shipped thresholds over DuckDB lists."""
    stop = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)
    edge = quality.EDGE.replace("'", "''")
    plain = "translate(trim(x, '{}'), '{}', '{}')".format(edge, *quality.CAPITALS)
    ratio = {
        "mean_word_chars": "word_chars / nullif(n_words, 0)",
        "symbols_per_word": "n_symbols / nullif(n_words, 0)",
        "stop_word_share": "n_stop / nullif(n_words, 0)",
        "duplicate_line_share": "n_dup_lines / nullif(n_lines, 0)",
        "ellipsis_line_share": "n_ellipsis / nullif(n_lines, 0)",
        "bullet_line_share": "n_bullet / nullif(n_lines, 0)",
    }
    bounds = [f"{ratio[r.metric]} >= {r.low}" for r in quality.RULES if r.low is not None]
    bounds += [f"{ratio[r.metric]} <= {r.high}" for r in quality.RULES if r.high is not None]
    within = " AND ".join(f"coalesce({b}, true)" for b in bounds)
    return rf"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), places AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM split WHERE len(w) >= 8
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS win FROM places
), twice AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, sum(least(8, coalesce(lead_i - i, 8)))::BIGINT AS n_repeat_words
  FROM (SELECT *, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS lead_i FROM twice) GROUP BY doc_id
), stats AS (
  SELECT s.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(list_filter(w, lambda x: {plain} IN ({stop})))::BIGINT AS n_stop, len(l)::BIGINT AS n_lines,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$')))::BIGINT AS n_ellipsis,
    len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•·]')))::BIGINT AS n_bullet,
    coalesce(c.n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM split s LEFT JOIN covered c ON s.doc_id = c.doc_id
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM stats
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {within} AS kept
FROM judged"""


@query("op1_quality_rules", _quality_sql())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


@query("op6_mix_sources")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query(
    "op7_warc",
    """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, strlen(h) AS n, sha1(h) AS digest, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id < top THEN top END AS refers_to
FROM q""",
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = application_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), archive)
    return warc.read_pages(spark, archive)


@query("op2_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op9_simhash")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    bits = F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint")
    return found.select("doc_id", bits, "component_id")


@query(
    "op10_line_dedup",
    rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, coalesce('s' || source, 'none') AS site FROM documents),
lines AS (
  SELECT r, doc_id, site, unnest(string_split(text, chr(10))) AS raw,
    generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM d WHERE text IS NOT NULL
), cleaned AS (
  SELECT *, regexp_replace(raw, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line FROM lines
), spread AS (
  SELECT line, min(doc_id) AS home FROM cleaned WHERE line <> '' GROUP BY line
  HAVING count(DISTINCT site) >= {line_dedup.MIN_SITES}
), kept AS (
  SELECT c.r, c.i, c.raw, c.line, s.line IS NOT NULL AND s.home IS DISTINCT FROM c.doc_id AS gone
  FROM cleaned c LEFT JOIN spread s ON c.line = s.line
), texts AS (
  SELECT r, count(*) FILTER (line <> '') AS n_lines, count(*) FILTER (gone) AS n_removed,
    string_agg(raw, chr(10) ORDER BY i) FILTER (NOT gone) AS t
  FROM kept GROUP BY r
)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN texts ON d.r = texts.r""",
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    n = lambda text: F.size(
        F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    ).cast("long")
    counted = docs.select("doc_id", "text", "source", n(F.col("text")).alias("n_lines"))
    return line_dedup.line_dedup(counted).select(
        "doc_id",
        "n_lines",
        (F.col("n_lines") - n(F.col("text"))).alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


@query("op8_pii")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digests(table(spark, sf_dir, "documents"))


@query("op3_embedding_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query(
    "op5_substring_dedup",
    r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), lists AS (
  SELECT doc_id, list_transform(range(1, len(ws) - 18), lambda i: array_to_string(ws[i:i + 19], ' ')) AS wins
  FROM w WHERE len(ws) >= 20
), windows AS (
  SELECT doc_id, unnest(wins) AS win, generate_subscripts(wins, 1) AS i FROM lists
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS n FROM windows)
  WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, i + d AS place FROM later, range(20) AS t(d)
), words AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS place FROM w
), kept AS (
  SELECT words.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY words.place) AS t
  FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.place = words.place
  WHERE gone.place IS NULL GROUP BY words.doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id""",
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeat_digests(table(spark, sf_dir, "documents"))


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


@query(
    "op11_lexical_search",
    f"""
WITH d AS (
  SELECT r, doc_id, ts, len(ts)::BIGINT AS n
  FROM (SELECT row_number() OVER () AS r, doc_id,
          regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '{_TERM}') AS ts FROM documents)
  WHERE len(ts) > 0
), counts AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM d),
tf AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY r, term),
w AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, counts GROUP BY term, n_docs
), items AS (
  SELECT row_number() OVER () AS k, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)
), q AS (
  SELECT DISTINCT k, item_id, term
  FROM (SELECT k, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '{_TERM}')) AS term FROM items)
), scored AS (
  SELECT k, q.item_id, d.r, d.doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN tf ON q.term = tf.term JOIN w ON q.term = w.term JOIN d ON tf.r = d.r, counts
  GROUP BY k, q.item_id, d.r, d.doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
) WHERE rank <= {lexical.TOP}""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op13_collocations",
    rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), {_LOWER}), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), texts AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces
), totals AS (
  SELECT lang, sum(len(ws))::BIGINT AS n FROM texts GROUP BY lang
), places AS (
  SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM texts
), found AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*)::BIGINT AS f
  FROM places, range(1, {phrases.LONGEST + 1}) AS t(k) WHERE i + k - 1 <= len(ws)
  GROUP BY lang, k, phrase HAVING count(*) >= {phrases.MIN_COUNT}
), cand AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM found WHERE k > 1
), cuts AS (
  SELECT c.lang, c.phrase, c.a, j, l.f AS l, r.f AS r, n, ((1000::HUGEINT * c.a * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM cand) c JOIN totals t ON c.lang = t.lang
  JOIN found l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:j], ' ')
  JOIN found r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[j + 1:], ' ')
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), inside AS (
  SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k + 1)) AS i FROM cand), range(2, {phrases.LONGEST}) AS t(m)
  WHERE m < k AND i + m - 1 <= k GROUP BY ALL
), ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN inside s ON b.lang = s.lang AND b.phrase = s.phrase
  WHERE s.phrase IS NULL OR 100 * longer < {phrases.SHARE} * a
)
SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {phrases.TOP}""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query("op12_toxicity")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    at = F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return found.select("doc_id", "held_out", "score", "predicted", F.array_join(at, ",").alias("spans"))
