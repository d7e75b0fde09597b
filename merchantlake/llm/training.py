"""Bounded training samples of labelled documents."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchantlake.llm.common import held_out, store


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(label, text) of at most ``per_class`` rows of each value of ``label``, chosen by the checksum of their ids.

    ``docs`` has doc_id and text, ``labels`` doc_id and the label. Held-out ids, null ids and null labels are never taken.
    Only ids are ranked; of each label, no task sends on more than the limit. Rows that repeat an id count once.
    """
    known = labels.select("doc_id", F.col(label).alias("label")).where(~held_out(F.col("doc_id")) & F.col("label").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    place = Window.partitionBy("label").orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id")
    chosen = known.withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= per_class).drop("_place")
    chosen = store(chosen, "sample-ids")
    # At most per_class ids for each class; of rows that repeat an id, the smallest text stays.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("text").alias("text")).select("label", "text")


def fitted(features: DataFrame, fit, schema: str) -> pd.DataFrame:
    """Run ``fit`` on a bounded sample as one task; the model is a few rows."""
    return features.groupBy(F.lit(0).alias("_all")).applyInPandas(fit, schema).toPandas()
