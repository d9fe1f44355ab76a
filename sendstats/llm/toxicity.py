"""Toxicity by compression distance.

Two zstandard dictionaries are trained, on ordinary text and on what sets toxic text
apart. Windows of a text are compressed with ordinary text as the dictionary, once
after more ordinary text and once after the toxic dictionary; a window that gets shorter
by the latter has wording of toxic text. The savings of all windows of a document are
calibrated to a probability on labelled documents that the dictionaries have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sendstats.llm.boosting import fit
from sendstats.llm.common import materialize, words_of
from sendstats.llm.labelled import fold, teaching_sample

FOLDS, HELD_OUT = 3, 1
# Labelled documents that teach, at most: one half the dictionaries, one the calibration.
MAX_SAMPLE = 20_000
# Windows of each class that a dictionary is trained on, at most.
MAX_WINDOWS = 30_000
PREDICT_AT = 0.7

WINDOW = 12  # words
ORDINARY_BYTES, TOXIC_BYTES = 16_384, 2_048
SEGMENT = 16  # bytes of the pieces that a dictionary is made of
# A word is typical of toxic text if its windows' classes are so unlikely by chance
# (log likelihood ratio), and so many such words are used at most.
MIN_RATIO, MAX_WORDS = 12.0, 500
STATS = ("largest", "total", "mean", "excess", "high")
# Fixed value: the three repeat offsets that end the tables of a zstandard dictionary.
TABLES_END = bytes([1, 0, 0, 0, 4, 0, 0, 0, 8, 0, 0, 0])


@dataclass(frozen=True)
class Distance:
    """Two dictionaries, the same but for the toxic piece, and what they save."""

    ordinary: bytes
    filler: bytes
    toxic: bytes

    def __getstate__(self):
        # Compressors are made anew where the dictionaries arrive.
        return {"ordinary": self.ordinary, "filler": self.filler, "toxic": self.toxic}

    @cached_property
    def compressors(self) -> list[zstandard.ZstdCompressor]:
        params = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_LAZY, min_match=5, window_log=17, hash_log=15, chain_log=15, search_log=4,
            write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        )
        return [
            zstandard.ZstdCompressor(
                dict_data=zstandard.ZstdCompressionDict(first + self.ordinary, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                compression_params=params,
            ) for first in (self.filler, self.toxic)
        ]

    def stats(self, text: str | None) -> tuple[float, ...]:
        """Largest, summed and mean saving of a window, and the sum and share of those over a byte."""
        plain, toxic = self.compressors
        words = (text or "").lower().split()
        saved = []
        for i in range(0, len(words), WINDOW):
            window = (" " + " ".join(words[i : i + WINDOW]) + " ").encode(errors="replace")
            saved.append(len(plain.compress(window)) - len(toxic.compress(window)))
        if not saved:
            return (0.0,) * len(STATS)
        s = np.array(saved, dtype=np.float64)
        return s.max(), s.sum(), s.mean(), np.maximum(s - 1, 0).sum(), (s > 2).mean()


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """The content of a dictionary trained on ``samples``; too few are taken as they are."""
    try:
        return zstandard.train_dictionary(size, samples, k=SEGMENT, d=6, level=3).as_bytes().split(TABLES_END, 1)[-1]
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _windows(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(y, window) of the sample's documents; windows that several share count once."""
    words = docs.join(sample, "doc_id").select("y", words_of(F.lower("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.size("w") - 1, F.lit(WINDOW))
    each = words.select("y", F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, WINDOW))).alias("window"))
    return each.distinct()


def typical_words(windows: DataFrame) -> list[str]:
    """The words that tell toxic windows from ordinary ones most surely."""
    totals = windows.agg(F.count_if(F.col("y") == 1).alias("toxic"), F.count(F.lit(1)).alias("n")).first()
    if not totals["toxic"] or totals["toxic"] == totals["n"]:
        return []
    share = totals["toxic"] / totals["n"]
    counted = windows.select("y", F.explode(F.array_distinct("window")).alias("word")).groupBy("word").agg(
        F.count_if(F.col("y") == 1).alias("t"), F.count_if(F.col("y") == 0).alias("o")
    )
    p = F.col("t") / (F.col("t") + F.col("o"))
    ratio = F.col("t") * F.ln(p / share) + F.when(F.col("o") > 0, F.col("o") * F.ln((1 - p) / (1 - share))).otherwise(0.0)
    sure = counted.where((F.col("t") > 0) & (p > share)).withColumn("ratio", ratio).where(F.col("ratio") > MIN_RATIO)
    return [r["word"] for r in sure.orderBy(F.desc("ratio"), "word").limit(MAX_WORDS).collect()]


def train(docs: DataFrame, sample: DataFrame) -> Distance | None:
    """Dictionaries from the documents of ``sample`` (doc_id, y); None if a class is missing."""
    windows = materialize(_windows(docs, sample), "windows")
    typical = set(typical_words(windows))
    some = lambda y: [
        r["window"] for r in windows.where(F.col("y") == y).orderBy(F.xxhash64("window"), "window").limit(MAX_WINDOWS).collect()
    ]
    toxic, ordinary = some(1), some(0)
    if not typical or not ordinary:
        return None
    known = [w for w in ([x for x in window if x in typical] for window in toxic) if w]
    plain = [(" " + " ".join(w)).encode() for w in ordinary]
    own = _dictionary([(" " + " ".join(w) + " ").encode() for w in known], TOXIC_BYTES)
    # As much ordinary text stands in place of the toxic piece, so that distances are the same.
    filler = _dictionary(plain[::-1][:5_000], TOXIC_BYTES)[-len(own):].rjust(len(own))
    return Distance(_dictionary(plain, ORDINARY_BYTES), filler, own)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text).

    ``score`` is the probability of toxic 1. NULL and empty texts save nothing and are scored
    as such. Repeated rows stay apart, an empty table gives no rows, and without labels of both
    classes all scores are the same. Other columns are not carried.
    """
    labels = labels.select("doc_id", "toxic")
    sample = materialize(teaching_sample(labels, "toxic", FOLDS, HELD_OUT, MAX_SAMPLE), "sample")
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))
    docs = docs.select("doc_id", "text")
    distance = train(docs, sample.where(half == 0))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            stats = [distance.stats(t) if distance else (0.0,) * len(STATS) for t in frame["text"]]
            out = pd.DataFrame(stats, columns=list(STATS))
            out.insert(0, "doc_id", frame["doc_id"].to_numpy())
            yield out

    # Ids travel as text: pandas would turn a column with NULLs into floats.
    keyed = docs.withColumn("doc_id", F.col("doc_id").cast("string"))
    shape = "doc_id string, " + ", ".join(f"{s} double" for s in STATS)
    measured = materialize(keyed.mapInPandas(measure, shape), "savings")
    other = sample.where(half == 1).withColumn("doc_id", F.col("doc_id").cast("string"))
    rows = measured.join(other, "doc_id").dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id")
    model = fit(rows[list(STATS)].to_numpy(dtype=np.float64), rows["y"].to_numpy(dtype=np.float64), n_trees=40, depth=3)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = frame[["doc_id"]].copy()
            out["score"] = model.score(frame[list(STATS)].to_numpy(dtype=np.float64))
            yield out

    scored = measured.mapInPandas(score, "doc_id string, score double")
    return scored.select(
        F.col("doc_id").cast(kind).alias("doc_id"),
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score", (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"),
    )
