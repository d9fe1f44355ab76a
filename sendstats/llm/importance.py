"""Importance resampling towards a target text collection.

Words, pairs and triples of words are hashed to buckets and counted in the documents and in
the target texts. The gain of a bucket is the logarithm of how much more often the target has
it; a document weighs the sum of the gains over its features, looked up in one array. With
Gumbel noise added to the weights, the highest scores are a sample without replacement.

Scores are written once. The cutoff is found by bisection on the score, then on doc_id among
ties: each step is a job that counts the rows below some probes exactly, so that rows are never
sorted to find it. Only the drawn rows are then partitioned by ranges and ranked.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from itertools import chain, islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sendstats.llm.common import materialize

BUCKETS = 10_000
PERCENT = 5
MIN_WORDS = 20
SEED = "42:"
# Thresholds that one counting job tries: four halvings at once.
PROBES = 15
# In UTF-8: digits, a to z, and all bytes of characters beyond ASCII. Lower-casing bytes changes A-Z only.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
# Bytes whose words are hashed together: bounds the memory that a very long text takes.
CHUNK = 1 << 20
FEATURES = 3
LAST_ID = (1 << 63) - 1


def hashed_features(text: bytes, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the runs of one to three words that end in them), some words at a time."""
    text, at, before = text.lower(), 0, []
    while at < len(text):
        gap = GAP.search(text, min(at + CHUNK, len(text)))
        end = gap.start() if gap else len(text)
        some = WORD.findall(text, at, end)
        at = max(end, at + 1)
        words, n = before + some, len(before)
        spaced = [b" " + w for w in words[1:]]
        one = list(map(crc32, words))
        two = list(map(crc32, spaced, one))
        three = map(crc32, spaced[1:], two)
        # Runs that end within the words before were counted with them.
        runs = chain(one[n:], two[max(n - 1, 0):], islice(three, max(n - 2, 0), None))
        yield len(some), np.fromiter(runs, dtype=np.int64) % buckets
        before = words[1 - FEATURES:]


def _counting(buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                for _, found in hashed_features(text or b"", buckets):
                    counts += np.bincount(found, minlength=buckets)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["bucket", "n"])

    return run


def feature_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows by bucket; each task sends one number for each bucket."""
    parts = texts.select("text").mapInArrow(_counting(buckets), "bucket bigint, n bigint")
    out = np.zeros(buckets)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """By bucket, a thousand times the logarithm of the smoothed ratio of its shares, rounded down."""
    k = float(len(source))
    s, t = float(source.sum()), float(target.sum())
    ratio = ((target + 1.0) * (s + k)) / ((source + 1.0) * (t + k))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], dtype=np.int64)


def _weighing(gain: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, features, weights = (np.zeros(n, dtype=np.int64) for _ in range(3))
            for i, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                for count, found in hashed_features(text or b"", len(gain)):
                    words[i] += count
                    features[i] += len(found)
                    weights[i] += gain[found].sum()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words), pa.array(features), pa.array(weights)],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return run


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """A Gumbel variate in thousandths, rounded down, from the hash of the id; a missing id counts as empty."""
    name = F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def scored(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, seed: str = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, _row) of every row of ``docs``, written once."""
    gain = gains(feature_counts(docs, buckets), feature_counts(target, buckets))
    kind = docs.schema["doc_id"].dataType.simpleString()
    weighed = docs.select("doc_id", "text").mapInArrow(
        _weighing(gain), f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint"
    )
    score = F.col("weight") + noise(F.col("doc_id"), seed)
    return materialize(weighed.withColumn("score", score).withColumn("_row", F.monotonically_increasing_id()), "scored")


def _order() -> list[Column]:
    """The order in which rows are drawn, as ascending numbers; rows without id come last among ties."""
    return [-F.col("score"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)), F.col("_row")]


def bisected(rows: DataFrame, value: Column, wanted: int) -> tuple[int, int, int]:
    """(cut, below, at): the smallest value that at least ``wanted`` >= 1 rows don't pass, how many rows are below and at it."""
    ends = rows.agg(F.min(value).alias("low"), F.max(value).alias("high")).first()
    low, high = ends.low, ends.high
    while low < high:
        probes = sorted({low + (high - low) * i // (PROBES + 1) for i in range(1, PROBES + 1)})
        # Each probe with the values next to it, so that the search goes on between values that there are.
        counts = [F.count_if(value <= p) for p in probes]
        under = [F.max(F.when(value <= p, value)) for p in probes]
        over = [F.min(F.when(value > p, value)) for p in probes]
        found = tuple(rows.agg(*[c.alias(f"x{i}") for i, c in enumerate(counts + under + over)]).first())
        n = len(probes)
        enough = next((i for i in range(n) if found[i] >= wanted), n)
        high = found[n + enough] if enough < n else high
        low = found[2 * n + enough - 1] if enough else low
    found = rows.agg(F.count_if(value < low).alias("below"), F.count_if(value == low).alias("at")).first()
    return low, found.below, found.at


def cutoff(rows: DataFrame, wanted: int) -> Column:
    """Whether a row is among the first ``wanted`` ones in the order of drawing."""
    if wanted <= 0:
        return F.lit(False)
    inside, ties = F.lit(False), F.lit(True)
    for value in _order():
        cut, below, at = bisected(rows.where(ties), value, wanted)
        inside = inside | (ties & (value < cut))
        ties = ties & (value == cut)
        wanted -= below
        if at == wanted:
            break
    return inside | ties


def ranked(drawn: DataFrame) -> DataFrame:
    """Add ``rank`` to the drawn rows: their place in their range, after all ranges before it."""
    keys = [f"_k{i}" for i in range(3)]
    ordered = drawn.withColumns(dict(zip(keys, _order())))
    ranges = materialize(ordered.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "drawn")
    # One row for each partition.
    sizes = ranges.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*keys))
    placed = ranges.withColumn("_place", place).join(sizes.select("_part", before.alias("_before")), "_part")
    return placed.withColumn("rank", F.col("_before") + F.col("_place")).drop("_part", "_place", "_before", *keys)


def importance_sample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
    buckets: int = BUCKETS, seed: str = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``; ``rank`` is NULL for rows that aren't drawn.

    ``docs``: doc_id (whole numbers), text; ``target``: text. Of the documents with at least
    ``min_words`` words, ``percent`` percent are drawn, those of the highest score, ties by the
    smaller id. NULL and empty texts have no features and weight 0, and are never drawn. A row
    without id is hashed as if its id were empty and comes last among ties. Repeated rows count
    each; of equal ones just as many are drawn as are due. Very long texts are hashed piece by
    piece. An empty table gives no rows. Other columns are not carried.
    """
    rows = scored(docs.select("doc_id", "text"), target, buckets, seed)
    able = F.col("n_words") >= min_words
    wanted = percent * rows.where(able).count() // 100
    chosen = able & cutoff(rows.where(able), wanted)
    columns = ["doc_id", "n_features", "weight", "score"]
    rest = rows.where(~chosen).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    return ranked(rows.where(chosen)).select(*columns, F.col("rank").cast("bigint")).unionByName(rest)
