"""Quality scores by histogram gradient-boosted trees over document statistics.

The statistics are Spark expressions over the whole text. The trees are fitted by this
module on a bounded sample of labelled documents (their numbers only, never their
text, come to the driver) and walked by numpy inside the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sendstats.llm.boosting import Trees, fit
from sendstats.llm.common import materialize, once, words_of
from sendstats.llm.labelled import fold, teaching_sample

FOLDS, HELD_OUT = 5, 0
# Labelled documents that the trees are fitted on, at most.
MAX_SAMPLE = 20_000
PREDICT_AT = 0.3

FEATURES = (
    "words", "word_length", "symbols", "marks", "capitals", "digits", "stops",
    "distinct", "lines", "dup_lines", "changes", "longest",
)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the features of each row; all zero for NULL and empty texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = once(docs.select("doc_id", "text", text.alias("_text")), "_words", words_of(F.col("text")))
    base = base.withColumns({
        "_lines": F.split("_text", "\n"), "_n": F.size("_words").cast("double"),
        "_chars": F.char_length("_text").cast("double"),
    })

    def per(count: Column, of: str) -> Column:
        return F.when(F.col(of) > 0, count / F.col(of)).otherwise(0.0)

    count = lambda pattern: F.regexp_count("_text", F.lit(pattern))
    # Words unlike the one before them: few in texts that repeat single words.
    changes = F.expr("size(filter(_words, (w, i) -> i = 0 OR _words[i - 1] <> w))")
    values = {
        "words": F.log1p("_n"),
        "word_length": per(F.char_length(F.array_join("_words", "")), "_n"),
        "symbols": per(count("[#*$%&|<>@{}\\[\\]\\\\^_~=+]"), "_n"),
        "marks": per(count("[!?]"), "_n"),
        "capitals": per(count("\\p{Lu}"), "_chars"),
        "digits": per(count("[0-9]"), "_chars"),
        "stops": per(count("[.,;:]"), "_n"),
        "distinct": per(F.size(F.array_distinct("_words")), "_n"),
        "lines": per(F.size("_lines"), "_n"),
        "dup_lines": F.lit(1.0) - F.size(F.array_distinct("_lines")) / F.size("_lines"),
        "changes": per(changes, "_n"),
        "longest": F.log1p(F.array_max(F.transform("_lines", lambda x: F.octet_length(x)))),
    }
    return base.select("doc_id", *[values[f].cast("double").alias(f) for f in FEATURES])


def train(features: DataFrame, labels: DataFrame) -> Trees:
    """Trees for ``labels.quality``, from at most ``MAX_SAMPLE`` documents outside the held-out fold."""
    sample = teaching_sample(labels, "quality", FOLDS, HELD_OUT, MAX_SAMPLE)
    # Repeated rows of a document are one example.
    rows = features.join(sample, "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "y", *FEATURES).toPandas()
    rows = rows.sort_values("doc_id")
    return fit(rows[list(FEATURES)].to_numpy(dtype=np.float64), rows["y"].to_numpy(dtype=np.float64))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text).

    ``score`` is the probability of quality 1. NULL and empty texts are scored like any
    other, repeated rows stay apart, an empty table gives no rows. Without usable labels all
    scores are 0.5. Other columns are not carried.
    """
    measured = materialize(statistics(docs.select("doc_id", "text")), "statistics")
    model = train(measured, labels.select("doc_id", "quality"))

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = frame[["doc_id"]].copy()
            out["score"] = model.score(frame[list(FEATURES)].to_numpy(dtype=np.float64))
            yield out

    kind = docs.schema["doc_id"].dataType.simpleString()
    # Ids stay outside: pandas would turn a column with NULLs into floats.
    keyed = measured.withColumn("doc_id", F.col("doc_id").cast("string"))
    scored = keyed.mapInPandas(score, "doc_id string, score double")
    return scored.select(
        F.col("doc_id").cast(kind).alias("doc_id"),
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score", (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"),
    )
