"""The registered queries of this subpackage and the SQL some of them are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.llm import oracles, pii, url_filter
from shelfwatch.llm.common import table
from shelfwatch.llm.decontaminate import decontaminate
from shelfwatch.llm.exact_dedup import exact_dedup
from shelfwatch.llm.fill_in_middle import fill_in_middle, restored
from shelfwatch.llm.language_id import identify
from shelfwatch.llm.line_spread import drop_spread_lines
from shelfwatch.llm.mixing import systematic_mix, word_count
from shelfwatch.llm.near_join import near_join
from shelfwatch.llm.repeats import remove_repeats
from shelfwatch.llm.token_alignment import align_tokens
from shelfwatch.llm.token_counts import TOKEN_LIMIT, count_tokens
from shelfwatch.llm.tool_calls import link_tool_calls, messages_from_turns

Query = Callable[[SparkSession, str], DataFrame]


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    model = url_filter.train(url_filter.labelled_urls(spark))
    return url_filter.judge(table(spark, folder, "pages"), model)


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(pii.find_personal_data(table(spark, folder, "documents")))


def op4_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    return link_tool_calls(messages_from_turns(table(spark, folder, "conversations")))


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return identify(table(spark, folder, "documents"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Per document its class (smallest id of its group), its copies' smallest id and its number of links."""
    found = near_join(table(spark, folder, "documents"))
    groups = found.groupBy("group_no").agg(F.min("doc_id").alias("class_id"))
    copies = found.groupBy("class_no").agg(F.min("doc_id").alias("copy_id"))
    return found.join(groups, "group_no").join(copies, "class_no").select(
        "doc_id", "class_id", "copy_id", "n_links", "group_size"
    )


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = drop_spread_lines(table(spark, folder, "documents"))
    return cleaned.select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    mixed = systematic_mix(docs, size=F.col("size"))
    return mixed.select(
        "doc_id", "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        (F.col("_copies") * F.col("size")).alias("taken"),
    )


def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = count_tokens(table(spark, folder, "documents"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op12_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    aligned = align_tokens(table(spark, folder, "documents"))
    return aligned.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = fill_in_middle(table(spark, folder, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"),
    )


def queries() -> dict[str, Query]:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_suffix_dedup": op2_suffix_dedup,
        "op3_pii": op3_pii,
        "op4_tool_calls": op4_tool_calls,
        "op5_language_id": op5_language_id,
        "op6_decontamination": op6_decontamination,
        "op7_exact_dedup": op7_exact_dedup,
        "op8_ngram_join": op8_ngram_join,
        "op9_line_dedup": op9_line_dedup,
        "op10_mixing": op10_mixing,
        "op11_token_counts": op11_token_counts,
        "op12_tokenizer_alignment": op12_tokenizer_alignment,
        "op13_fill_in_middle": op13_fill_in_middle,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_decontamination": oracles.DECONTAMINATION,
        "op7_exact_dedup": oracles.EXACT_DEDUP,
        "op9_line_dedup": oracles.LINE_DEDUP,
        "op10_mixing": oracles.MIXING,
        "op13_fill_in_middle": oracles.FILL_IN_MIDDLE,
    }
