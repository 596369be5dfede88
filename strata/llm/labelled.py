"""The bounded sample of labelled documents that classifiers learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import held_out

#: Labelled rows that a classifier learns from, at most.
TRAIN_ROWS = 16_000


def training_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, label) of at most ``rows`` labelled ids that are not held out,
    those with the smallest id hash. Rows without id or label teach nothing;
    an id with several labels counts with the largest, and one with several
    texts with the text of the smallest hash, so there is one row per id."""
    known = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    chosen = F.broadcast(known.orderBy(F.xxhash64("id"), "id").limit(rows))  # at most ``rows`` narrow rows
    found = docs.select(F.col("doc_id").alias("id"), F.col("text")).join(chosen, "id")
    one = found.groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return one.select("text", "label")
