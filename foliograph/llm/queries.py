"""Queries of the training-data operators, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.llm import bpe, chat, decontam, hnsw, licenses, simhash, substring, suffix, tokencount, toxicity
from foliograph.llm.common import table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digest(rows.unionByName(extra))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digest(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), texts=False)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_chat_format, op2_decontamination, op3_simhash_dedup, op4_suffix_dedup, op5_token_counts, op6_toxicity, op7_nearest_neighbours, op8_license_scan, op9_bpe, op10_substring_dedup]
    return {f.__name__: f for f in found}


#: Words of a lower-cased text, A-Z only.
_WORDS = r"regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
coded AS (
  SELECT *, length(role) + length(text) + 14
    + length(regexp_replace(role || text, '[^\\<#:]', '', 'g')) AS cells,
    CASE WHEN role = 'assistant' THEN text ELSE '' END AS mine FROM said WHERE conv_id IS NOT NULL)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(length(mine))::BIGINT AS loss_chars,
  sha256(string_agg(mine, '' ORDER BY turn, role, text)) AS loss_sha256,
  sum(cells)::BIGINT AS formatted_chars
FROM coded GROUP BY conv_id
"""

OP2_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(t="coalesce(text, '')")} AS w FROM documents),
b AS (SELECT DISTINCT item_id::VARCHAR AS item_id, {_WORDS.format(t="coalesce(text, '')")} AS w FROM benchmark WHERE item_id IS NOT NULL),
p AS (SELECT DISTINCT item_id, array_to_string(list_slice(w, i + 1, i + 8), ' ') AS phrase, least(len(w), 8) AS n
      FROM b, unnest(range(0, greatest(len(w) - 7, 1))) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM p),
hits AS (SELECT d.doc_id, i, p.n, p.item_id
         FROM d, sizes, unnest(range(0, greatest(len(w) - sizes.n + 1, 0))) AS t(i), p
         WHERE p.n = sizes.n AND p.phrase = array_to_string(list_slice(w, i + 1, i + sizes.n), ' ')),
cover AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM hits, unnest(range(i, i + n)) AS u(k) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP10_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
v AS (SELECT doc_id, i, sha256(array_to_string(list_slice(w, i + 1, i + 50), ' ')) AS h
      FROM d, unnest(range(0, greatest(len(w) - 49, 0))) AS t(i)),
f AS (SELECT h, min(doc_id) AS first FROM v GROUP BY h),
r AS (SELECT DISTINCT doc_id, k FROM v JOIN f USING (h), unnest(range(i, i + 50)) AS u(k) WHERE first < doc_id),
g AS (SELECT doc_id, list(k) AS gone FROM r GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE
    list_transform(list_filter(list_zip(w, range(0, len(w))), lambda x: NOT list_contains(gone, x[2])), lambda x: x[1]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_format": OP1_SQL, "op2_decontamination": OP2_SQL, "op10_substring_dedup": OP10_SQL}
