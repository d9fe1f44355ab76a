"""A corpus pipeline: rules, line dedup, near-duplicates, decontamination, mixing.

Each stage takes what the one before it has kept and returns the columns of documents;
the last one adds the training position of each row.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from sendstats.llm.common import discard, materialize, recorded, ship  # noqa: E402
from sendstats.llm.decontaminate import without_leaks  # noqa: E402
from sendstats.llm.line_dedup import cleaned  # noqa: E402
from sendstats.llm.mixing import training_order  # noqa: E402
from sendstats.llm.near_dedup import deduplicated  # noqa: E402
from sendstats.llm.quality_rules import passing  # noqa: E402


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; so do NULL and empty texts."""
    return passing(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cross-site lines go, everywhere but in one document each; repeated rows stay apart."""
    return cleaned(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, that of the smallest id; rows without id come last."""
    return deduplicated(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, each row by its own text; NULL items hold for none."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document, in training order; NULL sources are a source."""
    return training_order(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# By application and folder: the place of the stage that ran last, and the tables it wrote.
_left: dict[tuple[str, str], tuple[int, list[str]]] = {}


def _clearing(place: int, stage: Stage) -> Stage:
    """The stage, which first deletes what the stage before it wrote for itself.

    That is read no more once its result is written; if ``docs`` still reads it, it stays.
    """

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        key = (spark.sparkContext.applicationId, sf_dir)
        before, tables = _left.pop(key, (None, []))
        if before == place - 1:
            discard(spark, tables, docs)
        with recorded() as tables:
            out = stage(spark, docs, sf_dir)
        _left[key] = (place, tables)
        return out

    return run_stage


STAGES = [
    (name, _clearing(place, stage))
    for place, (name, stage) in enumerate([
        ("quality_rules", quality_stage),
        ("line_dedup", line_stage),
        ("near_duplicates", near_duplicate_stage),
        ("decontamination", decontamination_stage),
        ("source_mixing", mixing_stage),
    ])
]

# Connected components of near-duplicates are beyond SQL that would end in useful time.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written as Parquet and read again.

    Once a stage is written, the result of the one before its predecessor is deleted.
    NULL, empty and repeated texts are each stage's own matter, see there; an empty table gives no rows.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    written: list[list[str]] = []
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            with recorded() as tables:
                docs = materialize(docs, f"stage-{name}")
            written.append(tables)
            if len(written) > 2:
                discard(spark, written.pop(0), docs)
    return docs
