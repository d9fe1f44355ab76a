"""Boilerplate lines: lines that many sites have in common.

Each line is hashed, and the sites that have it are counted by HyperLogLog sketches,
which Spark merges by aggregation. Lines whose estimate is near the threshold get an
exact count. A line on enough sites is removed everywhere but in the document with the
smallest id, so that no text is lost altogether.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sendstats.llm.common import materialize

MIN_SITES = 8
# Registers of a sketch, as a power of two; its relative error is 1.04 / 2 ** (LOG_K / 2).
LOG_K = 10
# Estimates within so many standard errors of the threshold are counted exactly.
ERRORS = 4
# Two hashes make equal keys of different lines unlikely at any size.
KEY = ["_k1", "_k2"]
BLANK = " \t\n\x0b\x0c\r"


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANK))


def _keys(line: Column) -> tuple[Column, Column]:
    return F.xxhash64(line).alias("_k1"), F.hash(line).alias("_k2")


def line_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, source, line key) of every line with a word; a line repeated in its text counts once."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    each = docs.select("doc_id", "source", F.explode(F.array_distinct(F.transform(lines, _trimmed))).alias("line"))
    return each.where(F.col("line") != "").select("doc_id", "source", *_keys(F.col("line")))


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Keys of the lines on ``min_sites`` sites or more, with the id of the document that keeps them."""
    rows = line_rows(docs)
    sketched = rows.groupBy(*KEY).agg(
        F.hll_sketch_agg("source", LOG_K).alias("_sites"), F.min("doc_id").alias("_keeper")
    )
    margin = ERRORS * 1.04 / 2 ** (LOG_K / 2)
    # NULL sources are a site of their own, which the sketch does not count.
    estimate = F.hll_sketch_estimate("_sites") + 1
    spread = materialize(
        sketched.select(*KEY, "_keeper", estimate.alias("_most")).where(F.col("_most") >= min_sites * (1 - margin)), "spread"
    )
    sure = F.col("_most") - 1 > min_sites * (1 + margin)
    unsure = spread.where(~sure)
    # Few lines are near the threshold; all their rows are read again, one per site.
    exact = rows.join(unsure.select(*KEY), KEY, "left_semi").select(*KEY, "source").distinct().groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("_count")
    ).where(F.col("_count") >= min_sites)
    counted = unsure.join(exact, KEY, "left_semi")
    return materialize(spread.where(sure).unionByName(counted).select(*KEY, "_keeper"), "boilerplate")


def line_dedup(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` (doc_id, text, source and any other columns) without cross-site lines.

    Lines are compared without the white space around them; lines without a word are no
    lines and stay as they are. Adds ``_lines`` and ``_removed``, the lines with a word of
    the text and those of them removed. NULL texts stay NULL, texts may become empty, and
    no row is dropped. Rows with equal ids are treated as one document; a NULL id keeps a line
    only where no other document has it. An empty table gives no rows.
    """
    common = boilerplate(docs, min_sites)
    hit = line_rows(docs).join(common, KEY).where(~F.col("doc_id").eqNullSafe(F.col("_keeper")))
    # A document's row holds as many keys as it has common lines.
    marks = hit.groupBy("doc_id").agg(F.collect_set(F.struct(*KEY)).alias("_bad")).withColumnRenamed("doc_id", "_id")
    joined = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id").join(
        marks, F.col("doc_id").eqNullSafe(F.col("_id")), "left"
    ).select("_row", "_bad", F.split("_row.text", "\n").alias("_split"))
    key_of = lambda x: F.struct(*_keys(_trimmed(x)))
    bad = lambda x: F.array_contains(F.col("_bad"), key_of(x)) & (_trimmed(x) != "")
    left = joined.withColumn("_left", F.when(F.col("_bad").isNull(), F.col("_split")).otherwise(F.filter("_split", lambda x: ~bad(x))))
    text = F.when(F.col("_bad").isNull(), F.col("_row.text")).otherwise(F.array_join("_left", "\n"))
    n_lines = F.coalesce(F.size(F.filter("_split", lambda x: _trimmed(x) != "")), F.lit(0))
    removed = F.when(F.col("_bad").isNull(), 0).otherwise(F.size("_split") - F.size("_left"))
    return left.select(
        *[text.alias(c) if c == "text" else F.col(f"_row.{c}").alias(c) for c in docs.columns],
        n_lines.cast("long").alias("_lines"), F.coalesce(removed, F.lit(0)).cast("long").alias("_removed"),
    )


def cleaned(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``line_dedup`` with the columns of ``docs``; ``n_chars``, if there, counts the new text."""
    out = line_dedup(docs, min_sites).drop("_lines", "_removed")
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", length)
    return out.select(*docs.columns)
