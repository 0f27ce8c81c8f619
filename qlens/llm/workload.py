"""The registered query of each corpus operator, over its whole table, and its DuckDB SQL where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from qlens.llm import (
    decontaminate,
    hard_negatives,
    html_text,
    language,
    licenses,
    mixing,
    packing,
    quality,
    sharding,
    simhash,
    token_counts,
    whitening,
    winnowing,
)
from qlens.llm.common import small_batches
from qlens.storage import checkpoint_dir, join_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    """Registers a query under its function's name."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op2_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_quality_classifier(spark, sf_dir):
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op5_html_extraction(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op6_benchmark_decontamination(spark, sf_dir):
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_language_id(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op8_sharding(spark, sf_dir):
    return sharding.assignments(table(spark, sf_dir, "documents"))


@query
def op9_document_fingerprints(spark, sf_dir):
    return winnowing.compare_with_next(table(spark, sf_dir, "documents"))


@query
def op10_token_counts(spark, sf_dir):
    """Starts from an empty cache of its own, so that it counts all contents whatever ran before."""
    cache = join_path(checkpoint_dir(spark), f"token-counts-{uuid.uuid4().hex}")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), cache)


@query
def op11_hard_negatives(spark, sf_dir):
    return hard_negatives.mine_embeddings(table(spark, sf_dir, "embeddings"))


@query
def op12_entropy_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op13_embedding_whitening(spark, sf_dir):
    return whitening.whiten_embeddings(table(spark, sf_dir, "embeddings"))


def words_of(texts: dict[str, str]) -> str:
    """License templates as DuckDB rows: template number, label, list of words."""
    rows = (f"({n}, '{label}', string_split('{words}', ' '))" for n, (words, label) in enumerate(texts.items()))
    return ", ".join(rows)


# Without an entry: 1 to 3, 5 to 7, 9, 10, 12 and 13 need a tokenizer, a trained model, XXH64, a flow, rolling hashes,
# Newton's method or eigenvectors.
ORACLE = {
    "op4_license_scan": f"""
        WITH texts AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'),
                                              '{licenses.WORD}') AS w FROM documents),
        phrases(template, label, p) AS (VALUES {words_of(licenses.PHRASES)}),
        notices(template, label, p) AS (VALUES {words_of(licenses.NOTICES)}),
        places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM texts),
        base AS (
            SELECT doc_id, label, i - 1 AS start FROM places, phrases WHERE w[i] = p[1] AND w[i : i + len(p) - 1] = p),
        grams AS (
            SELECT template, label, len(p) - {licenses.NOTICE_GRAM - 1} AS n, i - 1 AS spot, p[i : i + {licenses.NOTICE_GRAM - 1}] AS gram
            FROM (SELECT *, unnest(range(1, len(p) - {licenses.NOTICE_GRAM - 2})) AS i FROM notices)),
        hits AS (
            SELECT doc_id, template, label, n, spot, i - 1 AS pos, i - 1 - spot AS diagonal
            FROM places JOIN grams ON gram = w[i : i + {licenses.NOTICE_GRAM - 1}]),
        steps AS (
            SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS gap FROM hits),
        bands AS (
            SELECT *, count(*) FILTER (gap IS NULL OR gap > {licenses.SHIFT}) OVER (
                PARTITION BY doc_id, template ORDER BY diagonal) AS band FROM steps),
        spans AS (
            SELECT doc_id, any_value(label) AS label, count(DISTINCT spot) / any_value(n) AS score
            FROM bands GROUP BY doc_id, template, band
            HAVING count(DISTINCT spot) / any_value(n) >= {licenses.SHARE}
               AND max(pos) + {licenses.NOTICE_GRAM} - min(pos) <= {licenses.STRETCH} * (any_value(n) + {licenses.NOTICE_GRAM - 1})),
        found AS (
            SELECT doc_id, label, start, 1.0 :: DOUBLE AS score FROM base UNION ALL SELECT doc_id, label, NULL, score FROM spans),
        sums AS (
            SELECT doc_id, count(start) AS n_base, min(start) AS first_word, max(start) AS last_word,
                   string_agg(DISTINCT label, ',' ORDER BY label) FILTER (start IS NOT NULL) AS base_labels,
                   string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
            FROM found GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
               coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
        FROM texts LEFT JOIN sums USING (doc_id)
    """,
    "op11_hard_negatives": f"""
        WITH vectors AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda c: floor(256 * c :: DOUBLE)) AS x
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        scored AS (
            SELECT DISTINCT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same, list_dot_product(a.x, c.x) :: BIGINT AS score
            FROM vectors a JOIN vectors c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
        positives AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {hard_negatives.POSITIVES})
        SELECT anchor_id, positive_id,
               row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) :: INT AS rank,
               id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND {hard_negatives.LOW} * positive_score <= 100 * score AND 100 * score <= {hard_negatives.HIGH} * positive_score
        QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= {hard_negatives.NEGATIVES}
    """,
    "op8_sharding": f"""
        WITH owners AS (
            SELECT unnest(string_split('{",".join(map(str, sharding.lookup_table()))}', ',')) :: INT AS owner,
                   unnest(range({sharding.SLOTS})) AS slot)
        SELECT doc_id, owners.slot :: INT AS slot, 'shard-' || lpad(owner :: VARCHAR, 3, '0') AS shard
        FROM documents JOIN owners
          ON owners.slot = ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)) :: BIGINT % {sharding.SLOTS}
    """,
}
