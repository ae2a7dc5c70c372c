"""The registered queries of the operators, one each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.registry import Registry
from millrace.llm import (
    attribution,
    bpe,
    conversation_trie,
    language_id,
    mpeg,
    packing,
    quality,
    secret_scan,
    simhash,
    spelling,
    token_files,
    toxicity,
    vector_topk,
)
from millrace.session import load_table, scratch_path

registry = Registry()


@registry.add("op1_token_files")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(load_table(spark, folder, "documents"), path)
    return token_files.token_checksums(token_files.read_token_files(spark, path))


@registry.add("op2_vector_topk", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank" FROM scored)
SELECT query_id, "rank", vec_id, score FROM ranked WHERE "rank" <= 10""")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return vector_topk.top_products(load_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@registry.add("op3_secret_scan")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan_documents(load_table(spark, folder, "documents"))


@registry.add("op4_toxicity")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(load_table(spark, folder, "documents"), load_table(spark, folder, "labels"))


@registry.add("op5_quality")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(load_table(spark, folder, "documents"), load_table(spark, folder, "labels"))


@registry.add("op6_section_tokens")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return attribution.section_tokens(load_table(spark, folder, "documents"))


@registry.add("op7_audio_columns")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return mpeg.audio_columns(load_table(spark, folder, "documents"))


@registry.add("op8_simhash_near_duplicates")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(load_table(spark, folder, "documents"))


@registry.add("op9_packing")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(load_table(spark, folder, "documents"))


@registry.add("op10_bpe_codec")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.codec_digests(load_table(spark, folder, "documents"))


@registry.add("op11_language_id")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.languages(load_table(spark, folder, "documents"))


# CRC-32 bit by bit: 3988292384 is its reflected polynomial.
_TRIE_SQL = r"""
WITH t AS (SELECT conv_id, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(x ORDER BY i) AS l, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END)), CAST(4294967295 AS BIGINT)) % 4 AS h
  FROM t GROUP BY conv_id),
rebuilt AS (SELECT o.conv_id, list_concat(coalesce(d.l[1:o.h], []), o.l[o.h + 1:]) AS l
  FROM own o LEFT JOIN own d ON d.conv_id = o.conv_id - o.conv_id % 20),
starts AS (SELECT conv_id, l, unnest(range(0, len(l) + 1)) AS d FROM rebuilt),
nodes AS (SELECT l[1:d] AS prefix, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CASE WHEN len(l) = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM starts GROUP BY 1, 2),
children AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
own_values AS (SELECT n.*, coalesce(c.n, 0) AS n_children,
    CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(n.prefix[depth].text, '[^\x20\x09-\x0D]+')) END AS gain
  FROM nodes n LEFT JOIN children c ON c.prefix = n.prefix),
above AS (SELECT *, unnest(range(0, depth + 1)) AS d FROM own_values),
subtrees AS (SELECT prefix[1:d] AS prefix, sum(gain) AS saved, count(*) FILTER (n_children = 0) AS leaves FROM above GROUP BY 1)
SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, s.leaves AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, o.ends_sha256
FROM own_values o JOIN subtrees s ON s.prefix = o.prefix LEFT JOIN nodes p ON p.depth = o.depth - 1 AND p.prefix = o.prefix[1:o.depth - 1]"""


@registry.add("op12_conversation_trie", _TRIE_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.conversation_trie(load_table(spark, folder, "conversations"))


@registry.add("op13_spelling_variants")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(load_table(spark, folder, "documents"))
