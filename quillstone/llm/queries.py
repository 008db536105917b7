"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillstone.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_histogram_sort_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillstone.llm.sharding import shard_documents

    return shard_documents(spark, table(spark, sf_dir, "documents"))


def op2_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillstone.llm import weak_quality

    return weak_quality.classify(spark, table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op3_content_addressed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillstone.llm import token_store

    path = token_store.write_store(spark, table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return token_store.read_digests(spark, path)


def op4_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillstone.llm import secrets

    return secrets.digests(spark, table(spark, sf_dir, "documents"))


def op5_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillstone.llm.sketch import fingerprints

    return fingerprints(spark, table(spark, sf_dir, "documents"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillstone.llm import apportion

    return apportion.mix(spark, apportion.sized(table(spark, sf_dir, "documents"))).select("doc_id", "size", "source_size", "target", "taken")


def op7_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillstone.llm import quotes

    return quotes.link(table(spark, sf_dir, "conversations"))


def op8_prefix_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillstone.llm import jaccard

    return jaccard.join(spark, table(spark, sf_dir, "documents"))


def op9_itq_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillstone.llm.itq import near_duplicates

    return near_duplicates(spark, table(spark, sf_dir, "embeddings"))


def op10_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillstone.llm import pieces

    return pieces.encoded(spark, table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), pieces.DIGESTS)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_histogram_sort_shards, op2_weak_label_quality, op3_content_addressed_ids, op4_markov_secrets, op5_scaled_sketch, op6_source_mix, op7_quotation_links, op8_prefix_jaccard, op9_itq_near_duplicates, op10_piece_round_trip)}


#: What op8 and op9 return, by all pairs.
PREFIX_JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS id, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.id)
SELECT s.doc_id, len(s.s) AS n_shingles, (SELECT min(c) FROM reach r WHERE r.id = s.doc_id) AS component_id FROM s
"""
ITQ = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS id, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.id),
least AS (SELECT id, min(c) AS c FROM reach GROUP BY id)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, least.c AS component_id, e.vec_id = least.c AS kept FROM embeddings e JOIN least ON least.id = e.vec_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op8_prefix_jaccard": PREFIX_JACCARD, "op9_itq_near_duplicates": ITQ}
