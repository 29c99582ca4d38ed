"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm import alignment, chat, decontaminate, divergence, linededup, packing, quality, setjoin, simhash, sql, tokens, urls, vectorcodes, warc
from quillmill.llm.common import shared_dir, staged, table


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score_quality(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = tokens.tabled(table(spark, sf_dir, "documents").select("doc_id", "text"), _vocabulary("word_bpe_49k.json"))
    return tokens.answers(staged(tables.drop("text"), "tokens")).select("doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "score")


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return chat.format_and_read(turns.unionByName(extra))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "archive")
    pages = table(spark, sf_dir, "pages")
    warc.write_archive(pages, path)
    kind = pages.schema["page_id"].dataType.simpleString()
    read = warc.parsed(warc.reconstructed(spark, path))
    return read.select(F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.joined_sets(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.compress(table(spark, sf_dir, "embeddings"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"), _vocabulary("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_token_counts": op2_token_counts,
    "op3_decontamination": op3_decontamination,
    "op4_url_filter": op4_url_filter,
    "op5_chat": op5_chat,
    "op6_line_dedup": op6_line_dedup,
    "op7_simhash": op7_simhash,
    "op8_packing": op8_packing,
    "op9_warc": op9_warc,
    "op10_quality_rules": op10_quality_rules,
    "op11_set_join": op11_set_join,
    "op12_vector_codes": op12_vector_codes,
    "op13_alignment": op13_alignment,
}

#: The others hold a fitted model, a tokenizer or a hash that SQL lacks; brute force tests them.
ORACLE_SQL: dict[str, str] = {"op5_chat": sql.OP5_CHAT, "op9_warc": sql.OP9_WARC, "op10_quality_rules": sql.OP10_RULES, "op12_vector_codes": sql.OP12_VECTORS}
