"""One query per operator over its whole table with production parameters, and its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlake.llm import (
    bpe,
    decontaminate,
    html_tree,
    jaccard_join,
    merkle,
    mixing,
    permutation_index,
    quality_classifier,
    quality_rules,
    sharding,
    token_codes,
    toxicity,
    vector_codes,
)
from reviewlake.llm.texts import WORD

SHARDS = 24
TARGET_ENTROPY, MAX_EPOCHS = 0.95, 4.0


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file; every executor has it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(_table(spark, sf_dir, "documents"), percent=85, n=4)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), TARGET_ENTROPY, MAX_EPOCHS)
    return mixed.select(
        "doc_id", "source", "mix_tokens", F.round("mix_weight", 9).alias("mix_weight"), "mix_epoch", "mix_block", "mix_place"
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(_table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_codes.encode_documents(_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op6_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digest_documents(
        _table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), SHARDS)


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_tree.extract_pages(_table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest_manifest(_table(spark, sf_dir, "documents"))


def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join, op2_mix_sources, op3_quality_rules, op4_quality_classifier, op5_token_codes,
        op6_byte_level_bpe, op7_sharding, op8_html_extraction, op9_toxicity, op10_permutation_index,
        op11_merkle_manifest, op12_benchmark_decontamination, op13_vector_codes,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Shingle sets by SQL, all links by a join on shingles, components by recursion.
_JACCARD = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i+3], ' ') for i in range(1, len(w) - 2)]) END AS shingles
  FROM w
), e AS MATERIALIZED (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, least_id) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT l.b, r.least_id FROM reach r JOIN both_ways l ON l.a = r.node WHERE r.least_id < l.b
)
SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles, r.component_id, coalesce(c.n, 0)::BIGINT AS n_links
FROM s JOIN (SELECT node, min(least_id) AS component_id FROM reach GROUP BY node) r ON r.node = s.doc_id
LEFT JOIN (SELECT a, count(*) AS n FROM both_ways GROUP BY a) c ON c.a = s.doc_id
"""


def _hash48(*parts: str) -> str:
    joined = " || '/' || ".join(f"({p})::VARCHAR" for p in parts)
    return f"('0x' || substr(md5({joined}), 1, 12))::BIGINT"


#: The same bisection as a recursive query, the same hashes, the same budget.
_MIX = f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS tokens,
    {_hash48("'block0'", "coalesce(doc_id::VARCHAR, 'null')")} % {mixing.BLOCKS} AS block
  FROM documents
), totals AS (SELECT source, sum(tokens)::BIGINT AS t FROM rows GROUP BY source HAVING sum(tokens) > 0),
all_of AS (SELECT list(t::DOUBLE) AS ts, sum(t)::DOUBLE AS total, max(t)::DOUBLE AS most, min(t)::DOUBLE AS least_t, count(*) AS n FROM totals),
start AS (
  SELECT -list_sum(list_transform(ts, lambda x: x / total * ln(x / total))) >= {TARGET_ENTROPY} * ln(n) OR n < 2 AS stays FROM all_of
), halving(step, low, high) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT step + 1, CASE WHEN up THEN low ELSE m END, CASE WHEN up THEN m ELSE high END FROM (
    SELECT step, low, high, m, pow(most / least_t, 1 - m) <= {MAX_EPOCHS}
      AND ln(list_sum(p)) - list_sum(list_transform(p, lambda x: x * ln(x))) / list_sum(p) < {TARGET_ENTROPY} * ln(n) AS up
    FROM (SELECT *, (low + high) / 2 AS m, list_transform(ts, lambda x: pow(x / total, (low + high) / 2)) AS p FROM halving, all_of)
    WHERE step < {mixing.HALVINGS})
), exponent AS (SELECT CASE WHEN (SELECT stays FROM start) THEN 1.0 ELSE high END AS e FROM halving WHERE step = {mixing.HALVINGS}),
powers AS (SELECT source, t, pow(t / total, e) AS p, round(pow(most / t, 1 - e), 9) AS epochs FROM totals, all_of, exponent),
plan AS (SELECT source, t, p / sum(p) OVER () AS weight, epochs, floor(epochs)::BIGINT AS whole,
  floor((epochs - floor(epochs)) * t + 0.5) AS rest FROM powers),
blocks AS (SELECT source, block, sum(tokens) AS tokens FROM rows GROUP BY source, block),
placed AS (
  SELECT b.*, p.whole, p.rest, {_hash48("'order0'", "coalesce(b.source, 'null')", "p.whole", "b.block")} AS place
  FROM blocks b JOIN plan p ON b.source IS NOT DISTINCT FROM p.source
), running AS (
  SELECT *, sum(tokens) OVER (PARTITION BY source ORDER BY place, block ROWS UNBOUNDED PRECEDING) AS upto FROM placed
), last AS (
  SELECT source, max(place) AS place FROM running WHERE 2 * upto - tokens <= 2 * rest AND rest > 0 GROUP BY source
), copies AS (
  SELECT r.*, p.weight, coalesce(p.whole, 1) + CASE WHEN
    {_hash48("'order0'", "coalesce(r.source, 'null')", "p.whole", "r.block")} <= l.place THEN 1 ELSE 0 END AS n
  FROM rows r LEFT JOIN plan p ON r.source IS NOT DISTINCT FROM p.source LEFT JOIN last l ON r.source IS NOT DISTINCT FROM l.source
), repeated AS (SELECT *, unnest(range(0, n::BIGINT)) AS epoch FROM copies)
SELECT doc_id, source, tokens AS mix_tokens, round(weight, 9) AS mix_weight, epoch AS mix_epoch, block::INTEGER AS mix_block,
  {_hash48("'order0'", "coalesce(source, 'null')", "epoch", "block")} AS mix_place
FROM repeated
"""

ORACLES = {
    "op1_ngram_jaccard_join": _JACCARD,
    "op2_mix_sources": _MIX,
    "op3_quality_rules": quality_rules.SQL,
    "op11_merkle_manifest": merkle.SQL,
    "op12_benchmark_decontamination": decontaminate.SQL,
    "op13_vector_codes": vector_codes.SQL,
}
