"""The operators on their whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchantlake.llm import oracle
from merchantlake.llm.common import table
from merchantlake.llm.conversation_repair import repaired
from merchantlake.llm.decontaminate import contaminated
from merchantlake.llm.hard_negatives import hard_negatives
from merchantlake.llm.language_mix import languages
from merchantlake.llm.quality_ordinal import quality_grades
from merchantlake.llm.quality_rules import quality_rules
from merchantlake.llm.simhash_trie import simhash_components
from merchantlake.llm.source_mix import mix_sources
from merchantlake.llm.substring_dedup import substring_dedup
from merchantlake.llm.suffix_dedup import suffix_dedup
from merchantlake.llm.token_scan import token_counts
from merchantlake.llm.toxicity_nb import toxicity
from merchantlake.llm.warc_index import archived_pages


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents")).drop("kept_text")


def op2_quality_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings: 0 for bad text, 1 for good but toxic text, 2 for good text that is not toxic."""
    labels = table(spark, sf_dir, "labels")
    ratings = labels.select("doc_id", (F.col("quality") * (2 - F.col("toxic"))).cast("int").alias("rating"))
    return quality_grades(table(spark, sf_dir, "documents"), ratings, "rating")


def op3_language_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents")).drop("mixture")


def op4_token_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"), carry=False)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op7_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents"))
    return judged.select(
        F.col("document.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept",
    )


def op10_toxicity_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row has the next label; every hundredth is an anchor."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=label)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup(table(spark, sf_dir, "documents"))
    return cut.select("document.doc_id", "n_words", "n_removed", "kept_sha256")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_quality_ordinal": op2_quality_ordinal,
    "op3_language_mix": op3_language_mix,
    "op4_token_scan": op4_token_scan,
    "op5_source_mix": op5_source_mix,
    "op6_simhash_trie": op6_simhash_trie,
    "op7_warc_index": op7_warc_index,
    "op8_decontaminate": op8_decontaminate,
    "op9_quality_rules": op9_quality_rules,
    "op10_toxicity_nb": op10_toxicity_nb,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_conversation_repair": op13_conversation_repair,
}
ORACLE = {
    "op5_source_mix": oracle.SOURCE_MIX,
    "op7_warc_index": oracle.ARCHIVED_PAGES,
    "op9_quality_rules": oracle.QUALITY_RULES,
    "op11_hard_negatives": oracle.HARD_NEGATIVES,
    "op12_substring_dedup": oracle.SUBSTRING_DEDUP,
    "op13_conversation_repair": oracle.CONVERSATION_REPAIR,
}
