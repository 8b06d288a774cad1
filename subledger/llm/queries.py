"""Each operator over its whole table, with production parameters, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm import (
    alignment, jaccard_join, language_id, mixing, nearest, packing, pii, quality_rules, ranked_search, token_counts, toxicity,
    url_filters, warc,
)
from subledger.llm.common import held_out

TOKENIZER = "word_bpe_49k.json"
ALIGNED = "byte_bpe_50k.json", "piece_bpe_32k.model"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_filters.filter_urls(table(spark, folder, "pages"), [*url_filters.RULES, *url_filters.KINDS])


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs.filter(~held_out(F.col("doc_id"))), table(spark, folder, "labels"))
    return toxicity.score(docs, model).withColumn("held_out", held_out(F.col("doc_id")))


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality(table(spark, folder, "documents"))


def op4_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.join(table(spark, folder, "documents"))


def op5_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    codes = nearest.index(table(spark, folder, "embeddings"))
    return nearest.search(codes, F.col("key") % 20 == 0)


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    """Pieces and their places, with a digest for the ids."""
    return packing.pack(packing.cut(docs, public_tokenizers.path(TOKENIZER), ids=False))


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language_id.train(docs.filter(~held_out(F.col("doc_id"))))
    return language_id.predict(docs, model).withColumn("held_out", held_out(F.col("doc_id")))


def op9_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = warc.write(table(spark, folder, "pages"))
    return warc.read(archive).drop("payload", "warc")


def op11_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(table(spark, folder, "documents"))


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(table(spark, folder, "documents"), *map(public_tokenizers.path, ALIGNED))


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.rank(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filters, op2_toxicity, op3_quality_rules, op4_ngram_jaccard_join, op5_nearest_neighbours, op6_token_counts,
        op7_best_fit_packing, op8_language_id, op9_source_mixing, op10_warc, op11_pii,
        op12_token_alignment, op13_ranked_search,
    )
}

_BASE32_GROUPS = " || ".join(
    f"to_base(('0x' || substr(sha1(payload), {5 * at + 1}, 5))::BIGINT, 32, 4)" for at in range(8)
)

ORACLE_SQL: dict[str, str] = {
    "op1_url_filters": r"""
        WITH parts AS (
            SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
            FROM pages
        ), judged AS (
            SELECT page_id, host, path, CASE
                WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
                WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
                WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
                WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
            FROM parts
        )
        SELECT page_id, host, path, rule, CASE
            WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN '.' || host LIKE '%.spam-%' OR '.' || host LIKE '%.casino-%' OR '.' || host LIKE '%.poker-%'
                OR host LIKE '%-pills.%' THEN 'block'
            ELSE 'allow' END AS verdict
        FROM judged
    """,
    "op10_warc": f"""
        WITH rows AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), ranked AS (
            SELECT page_id, payload, row_number() OVER (PARTITION BY payload ORDER BY page_id DESC NULLS LAST) AS rank,
                first_value(page_id) OVER (PARTITION BY payload ORDER BY page_id DESC NULLS LAST) AS top
            FROM rows
        )
        SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes,
            translate({_BASE32_GROUPS}, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
            CASE WHEN rank = 1 THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN rank > 1 THEN top END AS refers_to
        FROM ranked
    """,
    "op13_ranked_search": r"""
        WITH texts AS (
            SELECT doc_id, row_number() OVER () AS row, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents
        ), found AS (
            SELECT doc_id, row, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM texts
        ), lengths AS (
            SELECT doc_id, row, len(terms) AS n FROM found WHERE len(terms) > 0
        ), totals AS (
            SELECT count(*) AS n_all, sum(n)::BIGINT AS l_all FROM lengths
        ), counts AS (
            SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM found) GROUP BY row, term
        ), asked AS (
            SELECT item_id, term, count(*) AS q FROM (
                SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
            ) GROUP BY item_id, term
        ), weights AS (
            SELECT term, floor(1000 * ln((2 * max(n_all) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM counts, totals WHERE term IN (SELECT term FROM asked) GROUP BY term
        ), scores AS (
            SELECT item_id, doc_id, row,
                sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_all) // l_all))))::BIGINT AS score
            FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (row), totals
            GROUP BY item_id, doc_id, row
        ), ranked AS (
            SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
            FROM scores WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
    """,
}
