"""Bounded labelled samples for fitting models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from landfall.session import settle

#: Most labelled rows that a model is fitted on; a broadcast of their ids stays below 1 MB.
SAMPLE_ROWS = 16_000


def fold(doc_id: Column | str) -> Column:
    """0 to 3 from the CRC of the id as text; fold 2 is held out of all learning."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % 4


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str,
                    rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, text, label 0/1, fold) of at most `rows` labelled documents, stored.

    The rows are those with the smallest hash of their id, never of fold 2. Null ids or
    labels are left out; an id with several labels has the largest. Of documents that share
    an id one counts, that with the smallest hash of its text, so the bound is one of rows.
    """
    picked = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .where(fold("doc_id") != 2)
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        .withColumn("fold", fold("doc_id"))
    )
    # At most `rows` ids, by the limit just above.
    few = F.broadcast(settle(picked, "labelled"))
    found = docs.select("doc_id", "text").join(few, "doc_id").groupBy("doc_id").agg(F.min(
        F.struct(F.xxhash64("text").alias("mark"), "text", "label", "fold")).alias("row"))
    return settle(found.select("doc_id", "row.text", "row.label", "row.fold").coalesce(64),
                  "sample")
