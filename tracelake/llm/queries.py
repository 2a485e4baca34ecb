"""Registered queries of the text operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.llm import (
    content_sort,
    conversations,
    fill_middle,
    golay,
    html_text,
    languages,
    licenses,
    mixing,
    packing,
    passages,
    quality,
    tiling,
    token_counts,
)
from tracelake.llm.common import id_remainder, table
from tracelake.llm.conversation_sql import REPAIR_SQL


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = (id_remainder("doc_id", 5) == 0).alias("held_out")
    return languages.identify(docs).select(
        "doc_id", held_out, "lang_pred", "score", "rejected"
    )


def op7_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.equal_texts(table(spark, sf_dir, "documents"))


def op9_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = golay.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", golay.hex_fingerprint().alias("fingerprint"), "component_id")


def op1_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return tiling.contaminations(docs, benchmark)


def op4_whole_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op10_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        "base_labels", "labels", "score",
    )


def op2_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", "n_chars"
    )


def op3_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    scored = quality.score_documents(docs, quality.fit(docs, labels))
    return scored.select(
        "doc_id",
        (id_remainder("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op5_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op11_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op12_swar_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    formed = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return formed.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(fill_middle.restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


def op13_suffix_dawg(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.audits_with_digests(rows).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


LLM_QUERIES = {
    "op5_compact_windows": op5_compact_windows,
    "op3_boosted_quality": op3_boosted_quality,
    "op2_line_blocks": op2_line_blocks,
    "op1_poisson_mix": op1_poisson_mix,
    "op6_string_tiling": op6_string_tiling,
    "op7_content_sort": op7_content_sort,
    "op8_language_id": op8_language_id,
    "op9_golay_simhash": op9_golay_simhash,
    "op4_whole_tokens": op4_whole_tokens,
    "op10_license_rules": op10_license_rules,
    "op11_retrieval_packing": op11_retrieval_packing,
    "op12_swar_fim": op12_swar_fim,
    "op13_suffix_dawg": op13_suffix_dawg,
}

LLM_ORACLE = {
    "op1_poisson_mix": """
        WITH docs AS (
            SELECT *, coalesce('s' || source, '') AS mix_key,
                coalesce(CAST(doc_id AS VARCHAR), '') AS mix_id
            FROM documents
        ), sizes AS (
            SELECT mix_key, CAST(sum(length(coalesce(text, '')) + 1) AS DOUBLE) AS size
            FROM docs GROUP BY mix_key
        ), totals AS (
            SELECT sum(sqrt(size)) AS all_weight, sum(size) AS all_size FROM sizes
        ), rates AS (
            SELECT mix_key, sqrt(size) / all_weight * all_size / size AS rate
            FROM sizes, totals
        ), means AS (
            SELECT mix_key, rate / greatest(1, ceil(rate / 32)) AS mean,
                CAST(greatest(1, ceil(rate / 32)) AS INTEGER) AS draws
            FROM rates
        ), terms AS (
            SELECT mix_key, CAST(n AS DOUBLE) AS n,
                exp(n * ln(mean) - mean - lgamma(n + 1)) AS p
            FROM means, range(0, 200) AS r(n)
        ), cdf AS (
            SELECT mix_key, sum(p) OVER (PARTITION BY mix_key ORDER BY n) AS c
            FROM terms
        ), fractions AS (
            SELECT mix_key, mix_id,
                CAST('0x' || substr(md5('mix:' || mix_id || ':' || draw), 1, 13) AS BIGINT)
                    / CAST(4503599627370496 AS DOUBLE) AS u
            FROM docs JOIN means USING (mix_key), range(1, 1000000) AS d(draw)
            WHERE draw <= draws
        ), counts AS (
            SELECT mix_id, count(c) AS n
            FROM fractions f JOIN cdf k ON f.mix_key = k.mix_key AND k.c <= f.u
            GROUP BY mix_id
        )
        SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, CAST(copy AS INTEGER) AS copy,
            md5('mix:order:' || mix_id || ':' || copy) AS shuffle_key
        FROM docs d JOIN counts USING (mix_id), LATERAL unnest(range(1, n + 1)) AS r(copy)
    """,
    "op7_content_sort": r"""
        WITH texts AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
            FROM documents
        ), ranked AS (
            SELECT *, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
                count(*) OVER (PARTITION BY norm) AS group_size,
                row_number() OVER (PARTITION BY norm ORDER BY doc_id) AS place
            FROM texts
        )
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256
        FROM ranked
    """,
    "op12_swar_fim": r"""
        WITH cut AS (
            SELECT doc_id, coalesce(text, '') AS t,
                regexp_extract_all(coalesce(text, ''),
                    '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
                sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex
            FROM documents
        ), hashed AS (
            SELECT *, len(u) AS n,
                CAST('0x' || substr(hex, 1, 8) AS BIGINT) AS h1,
                CAST('0x' || substr(hex, 9, 8) AS BIGINT) AS h2,
                CAST('0x' || substr(hex, 17, 8) AS BIGINT) AS h3,
                CAST('0x' || substr(hex, 25, 8) AS BIGINT) AS h4
            FROM cut
        ), placed AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                    OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
            FROM hashed
        ), parts AS (
            SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS p,
                array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s
            FROM placed
        )
        SELECT doc_id, CAST(n AS BIGINT) AS n, form,
            CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
            sha256(t) AS restored_sha256
        FROM parts
    """,
    "op13_suffix_dawg": REPAIR_SQL,
}
