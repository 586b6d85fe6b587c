"""One query per operator over its whole table, with production parameters, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tagloom.llm import (
    bpe, fillmiddle, hardnegatives, hilbert, linededup, mixing, neargraph, quality, simhash, tokenrecords, toxicity, urls,
    warc,
)
from tagloom.llm.shared import Scratch, read_table

VOCABULARY = "word_bpe_49k.json"
RECORD_VOCABULARY, END_ID = "byte_bpe_50k.json", 2
URL_RULES = (
    urls.UrlRule("net/", "block"),
    urls.UrlRule("example.net/en/", "allow"),
    urls.UrlRule("example.com/de/", "block"),
    urls.UrlRule("org/fr/", "allow"),
)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = (read_table(spark, sf_dir, name) for name in ("pages", "labels"))
    return urls.judge_urls(pages, labels, URL_RULES).drop("lower")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hilbert.shards(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    path = f"{scratch.root}/archives"
    warc.write_archives(read_table(spark, sf_dir, "pages"), path, scratch=scratch)
    return warc.read_archives(spark, path, scratch, strict=True).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs, measures=quality.MEASURES).drop("text")


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neargraph.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token shares of the mix: nine tenths good, the rest toxic and junk, within the tokens there are."""
    docs, labels = (read_table(spark, sf_dir, name) for name in ("documents", "labels"))
    weights = {"good": 0.9, "junk": 0.04, "toxic": 0.06}
    found = mixing.mix(docs, labels, weights, keep=["doc_id", "source"])
    posteriors = [F.col(f"_p{k}").alias(f"p_{name}") for k, name in enumerate(mixing.DOMAINS)]
    return found.select(
        "doc_id", "source", F.col("_tokens").alias("n_tokens"), *posteriors,
        F.col("_rate").alias("rate"), F.col("_copies").alias("copies"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, name) for name in ("documents", "labels"))
    found = toxicity.score(docs, toxicity.fit(docs, labels), threshold=0.3)
    return found.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted",
        F.size("sentences").alias("n_offending"), F.get("sentences", F.lit(0)).alias("worst"),
    )


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    return bpe.encode(read_table(spark, sf_dir, "documents"), path, decoded=True).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs, min_docs=10, keep_first=False))
    text, keep = F.col("text"), F.col("_keep")
    return found.select(
        "doc_id",
        F.size(linededup.lines(text)).cast("bigint").alias("n_lines"),
        linededup.dropped_lines(text, keep).alias("n_dropped"),
        F.sha2(F.coalesce(linededup.kept_text(text, keep), F.lit("")), 256).alias("kept_sha256"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.expr("vec_id % 7 = 0"), F.expr("(label + 1) % 10")).otherwise(F.col("label"))
    vectors = read_table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hardnegatives.hard_negatives(vectors, F.expr("vec_id % 50 = 0"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = fillmiddle.fill_in_middle(docs).withColumn("again", fillmiddle.restored(F.col("output"), F.col("form")))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("again", 256).alias("restored_sha256"),
    )


def op13_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    path = f"{scratch.root}/records"
    vocabulary = public_tokenizers.path(RECORD_VOCABULARY)
    tokenrecords.write_records(read_table(spark, sf_dir, "documents"), path, vocabulary, END_ID, scratch=scratch)
    found = tokenrecords.read_records(tokenrecords.read_index(spark, path), path, packed=True)
    return found.select(
        "doc_id", "start", F.expr("octet_length(ids) div 4").cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    dealt = (
        op1_url_filter, op2_simhash, op3_sharding, op4_warc, op5_quality,
        op6_embedding_dedup, op7_mixing, op8_toxicity, op9_bpe, op10_line_dedup, op11_hard_negatives,
        op12_fill_in_middle, op13_token_records,
    )
    return {f.__name__: f for f in dealt}


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = r"regexp_extract_all(text, '[^ \t\n\x0B\f\r]+')"

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_URL = "regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)'"


def _strength_sql(level: str) -> str:
    """Prior strength of a level with n, k and the parent's rate m."""
    return f"""(SELECT CASE WHEN coalesce(d, 0) = 0 OR q <= c THEN 1000.0
        ELSE least(1000.0, greatest(2.0, d / (q - c) - 1)) END
        FROM (SELECT sum(n * (k / n - m) * (k / n - m) / (m * (1 - m))) AS q, count(*) AS c, sum(n - 1) AS d
              FROM {level} WHERE n > 0))"""


OP1_SQL = rf"""
WITH parsed AS (
    SELECT page_id, translate({_URL}, 1), {_LOWER}) AS host, {_URL}, 2) AS path FROM pages
), outcome AS (
    SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels
    WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id
), counted AS (
    SELECT host, rtrim(regexp_extract(host, '{urls.NAME}', 1), '.') AS name,
           CAST(count(bad) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS k
    FROM parsed LEFT JOIN outcome ON page_id = doc_id GROUP BY host
), suffixed AS (
    SELECT *, regexp_matches(name, '{urls.ADDRESS}') AS address,
           CASE WHEN address THEN '' ELSE regexp_extract(name, '(?:^|\.)({urls.SUFFIXES}|[^.]*)\z', 1) END AS suffix FROM counted
), hosts AS (
    SELECT host, n, k, suffix, CASE WHEN address OR length(name) <= length(suffix) + 1 THEN name
        ELSE string_split(left(name, length(name) - length(suffix) - 1), '.')[-1] || '.' || suffix END AS domain FROM suffixed
), by_suffix AS (
    SELECT suffix, sum(n) AS n, sum(k) AS k, (SELECT (sum(k) + 0.1) / (sum(n) + 1) FROM hosts) AS m
    FROM hosts GROUP BY suffix
), suffixes AS (
    SELECT suffix, (k + s * m) / (n + s) AS m FROM by_suffix, (SELECT {_strength_sql("by_suffix")} AS s)
), by_domain AS (
    SELECT h.domain, sum(h.n) AS n, sum(h.k) AS k, any_value(s.m) AS m
    FROM hosts h JOIN suffixes s USING (suffix) GROUP BY h.domain, h.suffix
), domains AS (
    SELECT domain, (k + s * m) / (n + s) AS m FROM by_domain, (SELECT {_strength_sql("by_domain")} AS s)
), by_host AS (
    SELECT host, n, k, m FROM hosts JOIN domains USING (domain)
), posterior AS (
    SELECT host, k + s * m AS a, n - k + s * (1 - m) AS b FROM by_host, (SELECT {_strength_sql("by_host")} AS s)
), judged AS (
    SELECT host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS lower FROM posterior
), ruled AS (
    SELECT *, CASE
        WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM parsed
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow' WHEN lower > 0.3 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled JOIN judged USING (host)"""

OP5_SQL = rf"""
WITH base AS (
    SELECT doc_id, coalesce(text, '') AS text FROM documents
), split AS (
    SELECT doc_id, text, {_WORDS} AS words, string_split(text, chr(10)) AS all_lines,
           row_number() OVER () AS r FROM base
), windows AS (
    SELECT r, i, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] AS w
    FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM split)
), repeated AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1
), covered AS (
    SELECT r, count(DISTINCT i + k) AS n_repeat_words
    FROM repeated, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r
), with_word AS (
    SELECT r, list_filter(all_lines, lambda x: trim(x, {_BLANKS}) <> '') AS with_word FROM split
), measured AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
           CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(with_word) - len(list_distinct(with_word)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, len(all_lines) AS n_lines
    FROM split JOIN with_word USING (r) LEFT JOIN covered USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 4 * n_symbols > n_words
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM measured"""

OP10_SQL = f"""
WITH split AS (
    SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
    SELECT r, doc_id, i, ls[i] AS line,
           translate(trim(ls[i], {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM (SELECT r, doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM split)
), common AS (
    SELECT k FROM lines WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(c.k) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE c.k IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN common c ON lines.k = c.k GROUP BY r, doc_id"""


#: Base 32 of the digest, digit by digit: five bits from the hexadecimal digits that hold them.
OP4_SQL = """
WITH digits AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), digested AS (
    SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
           array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
               (((instr('0123456789abcdef', substr(h, 1 + CAST(i * 5 // 4 AS INTEGER), 1)) - 1) * 16
                 + greatest(0, instr('0123456789abcdef', substr(h, 2 + CAST(i * 5 // 4 AS INTEGER), 1)) - 1))
                // CAST(pow(2, 3 - (i * 5) % 4) AS INTEGER)) % 32 AS INTEGER), 1)), '') AS payload_digest
    FROM digits
), led AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS leader FROM digested
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = leader THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> leader THEN leader END AS refers_to
FROM led"""


OP11_SQL = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v, row_number() OVER () AS r
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.r AS anchor, a.vec_id AS anchor_id, b.vec_id, b.r, a.label = b.label AS same,
           CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM rows a JOIN rows b ON a.r <> b.r WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor, anchor_id, r AS positive, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, r) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, positive ORDER BY score DESC, vec_id, r) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON p.anchor = s.anchor
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""

OP12_SQL = r"""
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
           regexp_extract_all(coalesce(text, ''), '[ \t\n\x0B\f\r]*[^ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+') AS u FROM documents
), drawn AS (
    SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS c2,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
                WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM units
), cut AS (
    SELECT *, array_to_string(u[1:least(c1, c2)], '') AS p, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
           array_to_string(u[greatest(c1, c2) + 1:], '') AS s FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM cut"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filter": OP1_SQL, "op4_warc": OP4_SQL, "op5_quality": OP5_SQL, "op10_line_dedup": OP10_SQL,
        "op11_hard_negatives": OP11_SQL, "op12_fill_in_middle": OP12_SQL,
    }
