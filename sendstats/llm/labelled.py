"""Which documents may teach a classifier, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``folds``; NULL ids are in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(0)).cast("int")


def teaching_sample(labels: DataFrame, label: str, folds: int, held_out: int, most: int) -> DataFrame:
    """(doc_id, y) of at most ``most`` labelled documents outside the held-out fold.

    They are the first in the order of a hash of their ids, so that the sample is the same
    in every run. Contradicting labels of one document count as the larger.
    """
    usable = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != held_out))
    one = usable.groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("y"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
