"""A corpus from raw documents to a mix, in stages that are each written and read again.

Every stage works on all rows it is given and takes nulls in any column, texts of any length, repeated rows and empty tables;
what each makes of them is said below. Columns that a stage does not need are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchantlake.llm.common import store, table
from merchantlake.llm.decontaminate import contaminated
from merchantlake.llm.quality_rules import quality_rules
from merchantlake.llm.simhash_trie import simhash_duplicates_removed
from merchantlake.llm.source_mix import mix_sources
from merchantlake.llm.suffix_dedup import suffix_dedup


def by_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules. Null and empty texts have too few words and go; rows are judged one by one."""
    return quality_rules(docs).where("kept").select("document.*")


def by_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group whose SimHash fingerprints the trie links: three words, three bits.

    Of rows equal in id and text one stays. A null id names a group only when it has no other. Texts without words are one group.
    """
    return simhash_duplicates_removed(docs)


def by_suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that also stand earlier in the corpus. A null text stays null."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    cut = suffix_dedup(docs.withColumn("without_text", F.col("text").isNull()), others=(*others, "without_text"))
    text = F.when(~F.col("without_text"), F.col("kept_text")).alias("text")
    length = F.char_length("text").cast("bigint").alias("n_chars")
    return cut.select("doc_id", text, *others).select("*", length).select(*docs.columns)


def by_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark. Null and empty texts hold none; repeated rows are judged alike."""
    judged = contaminated(docs, table(spark, sf_dir, "benchmark"), carry=True)
    return judged.where("not contaminated").select("document.*")


def by_source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes, with ``taken``: the words it takes of each, repeats counted.

    A null source is a source of its own, the last. Rows equal in id and text are taken together. Texts without words are not taken.
    """
    return mix_sources(docs).where(F.col("taken") > 0).select("document.*", "size", "source_size", "target", "taken")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", by_quality_rules),
    ("simhash_near_dedup", by_near_duplicates),
    ("suffix_dedup", by_suffix_dedup),
    ("decontamination", by_decontamination),
    ("source_mix", by_source_mix),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
