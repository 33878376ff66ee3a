"""The operators' queries over the whole tables, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import bpe, chat, langid, licenses, mixing, pii, simhash, tiff, topk, unigram
from lectern.llm.common import read


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.sample(read(spark, sf_dir, "documents"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = "SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    return chat.digest(chat.format_chats(rows.unionByName(spark.sql(planted))))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(read(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(read(spark, sf_dir, "documents"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read(spark, sf_dir, "embeddings"))


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiff.text_media(read(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.token_counts(read(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_chat": op2_chat,
    "op3_simhash": op3_simhash,
    "op4_language": op4_language,
    "op5_licenses": op5_licenses,
    "op6_pii": op6_pii,
    "op7_topk": op7_topk,
    "op8_media": op8_media,
    "op9_bpe": op9_bpe,
    "op10_token_counts": op10_token_counts,
}

SQL: dict[str, str] = {
    "op2_chat": r"""
        WITH source AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), turns AS (
            SELECT *,
                CASE role WHEN 'user' THEN 'INST' WHEN 'system' THEN 'SYS' WHEN 'assistant' THEN 'ANS'
                     ELSE 'ROLE:' || hex(role) END AS tag,
                CASE WHEN contains(text, '\') OR regexp_matches(text, '[<\[]/?(s>|INST|SYS|ANS|ROLE)')
                     THEN regexp_replace(replace(text, '\', '\\'), '([<\[])(/?(?:s>|INST|SYS|ANS|ROLE))', '\1\\\2', 'g')
                     ELSE text END AS body
            FROM source
        )
        SELECT conv_id,
            count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
            sum(14 + 2 * length(tag) + length(body))::BIGINT AS formatted_chars,
            true AS intact
        FROM turns GROUP BY conv_id
    """,
    "op7_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, rank::INTEGER AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
        WHERE rank <= 5
    """,
}
