"""The registered queries of this package and their SQL counterparts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import (
    alignment,
    bpe,
    language_id,
    lattice_lm,
    line_quality,
    mixing,
    ngram_join,
    phrases,
    pivot_topk,
    secret_scan,
    sharding,
    url_filter,
    warc,
)
from fleetlens.llm.common import id_remainder, table, tuned

BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

BPE_MODEL = public_tokenizers.path("byte_bpe_50k.json")

PIECES = public_tokenizers.path("piece_bpe_32k.model")

URL_POLICY = url_filter.Policy(
    rules=(
        url_filter.Rule("allow", "com"),
        url_filter.Rule("block", "example.com", "/en/"),
        url_filter.Rule("allow", "www.example.com", "/en/"),
        url_filter.Rule("block", "net", "/es/"),
        url_filter.Rule("block", "net", "/fr/"),
    )
)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tuned(spark), sf_dir, "documents")
    held_out = id_remainder(F.col("doc_id"), 4) == 2
    model = language_id.fit(docs.where(~held_out).select("text", "lang"), PIECES)
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    return language_id.predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(tuned(spark), sf_dir, "pages").select("page_id", "url", "html")
    return warc.report(warc.read(spark, warc.write(pages), payloads=False))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    settings = secret_scan.Settings()
    ratios = secret_scan.train(secret_scan.labelled_samples(docs, settings), settings)
    return secret_scan.digests(secret_scan.scan(docs, ratios, settings))


def op4_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tuned(spark), sf_dir, "documents").select("doc_id", "text")
    held_out = id_remainder(F.col("doc_id"), 7) == 2
    model = lattice_lm.fit(docs.where(~held_out), PIECES)
    return lattice_lm.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(tuned(spark), sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_POLICY).select("page_id", "host", "path", "rule", "verdict")


def op6_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(tuned(spark), sf_dir, "embeddings").select("vec_id", "embedding")
    return pivot_topk.top_k(vectors, lambda vec_id: vec_id % 50 == 0)


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tuned(spark), sf_dir, "documents").select("doc_id", "text")
    return ngram_join.join(docs).select("doc_id", "n_shingles", "component_id")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tuned(spark), sf_dir, "documents").select("doc_id", "text")
    pattern = public_tokenizers.PATTERN
    return bpe.digests(bpe.decode(bpe.encode(docs, BPE_RANKS, pattern), BPE_RANKS, pattern))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op10_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_quality.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tuned(spark), sf_dir, "documents").select("doc_id", "text")
    return alignment.align(docs, BPE_MODEL, PIECES)


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(tuned(spark), sf_dir, "documents").select("text", "lang"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.report(table(spark, sf_dir, "documents"))


def _terms(terms: tuple[str, ...]) -> list[str]:
    return [f"CAST(regexp_matches(low, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') AS INTEGER)" for t in terms]


OP5_SQL = f"""
WITH parts AS (
  SELECT page_id,
    coalesce(lower(url), '') AS low,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), cut AS (
  SELECT page_id, low, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM parts
), ruled AS (
  SELECT *, CASE
      WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/')
        THEN 'www.example.com/en/'
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/')
        THEN 'example.com/en/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
      WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
    END AS rule
  FROM cut
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN {" + ".join(_terms(url_filter.STRICT_TERMS))} >= 1 THEN 'block'
    WHEN {" + ".join(_terms(url_filter.SOFT_TERMS))} >= {URL_POLICY.soft_limit} THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""

OP10_SQL = r"""
WITH base AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS body, coalesce('+' || source, '-') AS host
  FROM documents
), cut AS (
  SELECT *,
    list_filter(string_split_regex(body, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM base
), spots AS (
  SELECT row_id, unnest(range(len(words) - 2)) AS spot, words FROM cut WHERE len(words) > 2
), windows AS (
  SELECT row_id, spot, words[spot + 1] || ' ' || words[spot + 2] || ' ' || words[spot + 3] AS shown FROM spots
), twice AS (
  SELECT row_id, spot FROM windows
  QUALIFY count(*) OVER (PARTITION BY row_id, shown) > 1
), repeated AS (
  SELECT row_id, count(DISTINCT place) AS n
  FROM (SELECT row_id, unnest([spot, spot + 1, spot + 2]) AS place FROM twice) GROUP BY row_id
), line_rows AS (
  SELECT DISTINCT host, md5(body) AS key,
    trim(lower(regexp_replace(regexp_replace(unnest(lines), '[\x20\x09\x0B-\x0D]+', ' ', 'g'), '[0-9]', '0', 'g')))
      AS line
  FROM cut
), hosts AS (
  SELECT host, count(DISTINCT key) AS all_docs FROM line_rows GROUP BY host
), frequent AS (
  SELECT host, line FROM line_rows JOIN hosts USING (host) GROUP BY host, line, all_docs
  HAVING count(*) >= 10 AND count(*) > all_docs * 0.02
), sized AS (
  SELECT l.host, l.key, length(l.line) - length(replace(l.line, ' ', '')) + 1 AS n, f.line IS NOT NULL AS gone
  FROM line_rows l LEFT JOIN frequent f ON l.host = f.host AND l.line = f.line
), depleted AS (
  SELECT host, key FROM sized GROUP BY host, key
  HAVING bool_or(gone) AND 100.0 * sum(CASE WHEN gone THEN 0 ELSE n END) / sum(n) < 30
), counted AS (
  SELECT doc_id, host, md5(body) AS key, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(body, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM cut LEFT JOIN repeated USING (row_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND d.key IS NULL AS kept
FROM counted c LEFT JOIN depleted d ON c.host = d.host AND c.key = d.key
"""

OP2_SQL = """
WITH sized AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), grouped AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id
  FROM sized
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id IS DISTINCT FROM page_id AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END
    AS record_type,
  CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
FROM grouped
"""

OP6_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score
FROM scored QUALIFY rank <= 5
"""

OP12_SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), cut AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM docs
), grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))) AS phrase
  FROM cut, range(1, 6) AS sizes(k)
), counted AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE k = 1 GROUP BY lang
), often AS (
  SELECT * FROM counted WHERE f >= 100
), cuts AS (
  SELECT lang, phrase, k AS size, f, unnest(range(1, k)) AS spot, string_split(phrase, ' ') AS w FROM often WHERE k > 1
), parts AS (
  SELECT lang, phrase, size, f, spot, array_to_string(w[:spot], ' ') AS head, array_to_string(w[spot + 1:], ' ') AS rest FROM cuts
), scored AS (
  SELECT p.lang, p.phrase, p.size, p.f AS a, h.f AS l, r.f AS r, n, spot,
    CAST((1000::HUGEINT * p.f * n) // (h.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM parts p JOIN totals t ON p.lang = t.lang
  JOIN often h ON p.lang = h.lang AND p.head = h.phrase JOIN often r ON p.lang = r.lang AND p.rest = r.phrase
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, spot) = 1
), whole AS (
  SELECT * FROM lowest c WHERE NOT EXISTS (
    SELECT 1 FROM lowest x WHERE x.lang = c.lang AND x.size > c.size AND 100 * x.a >= 100 * c.a
      AND contains(' ' || x.phrase || ' ', ' ' || c.phrase || ' '))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM whole QUALIFY rank <= 2000
"""

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_warc": op2_warc,
    "op3_secret_scan": op3_secret_scan,
    "op4_lattice_lm": op4_lattice_lm,
    "op5_url_filter": op5_url_filter,
    "op6_pivot_topk": op6_pivot_topk,
    "op7_ngram_join": op7_ngram_join,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_source_mix": op9_source_mix,
    "op10_line_quality": op10_line_quality,
    "op11_alignment": op11_alignment,
    "op12_phrases": op12_phrases,
    "op13_sharding": op13_sharding,
}

ORACLES = {
    "op2_warc": OP2_SQL,
    "op6_pivot_topk": OP6_SQL,
    "op5_url_filter": OP5_SQL,
    "op10_line_quality": OP10_SQL,
    "op12_phrases": OP12_SQL,
}
