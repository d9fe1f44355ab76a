"""A filter on ids that are too many to be broadcast themselves.

The ids are hashed to the bits of a map, built by a distributed aggregation. The map is
broadcast, at most ``MAX_BUCKETS`` rows of 4 KB whatever the number of ids, and probed before
the first shuffle. Rows that pass by chance go with an exact join later: none is lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bits of one map row, as the built-in aggregate makes them.
BITS = 32_768
# 16 MB, 134 million bits.
MAX_BUCKETS = 4_096
# Bits per id, as long as the map may grow: one foreign row in 16 passes.
BITS_PER_ID = 16


def with_bit(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Add the map row (``_bucket``) and the place in it (``_bit``) of each row's keys."""
    place = F.pmod(F.xxhash64(*keys), F.lit(buckets * BITS))
    return df.withColumn("_bucket", F.floor(place / BITS)).withColumn("_bit", F.pmod(place, F.lit(BITS)))


def bitmaps(ids: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """(_bucket, _map): a bit for each of the ids."""
    placed = with_bit(ids.select(*keys), keys, buckets)
    return placed.groupBy("_bucket").agg(F.bitmap_construct_agg(F.col("_bit")).alias("_map"))


def probed(df: DataFrame, ids: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``df`` whose keys are among ``ids``, and few others; no shuffle of ``df``."""
    buckets = min(MAX_BUCKETS, max(1, -(-ids.count() * BITS_PER_ID // BITS)))
    # Broadcast: at most MAX_BUCKETS rows of 4 KB.
    met = with_bit(df, keys, buckets).join(F.broadcast(bitmaps(ids, keys, buckets)), "_bucket")
    byte = F.conv(F.hex(F.expr("substring(_map, CAST(_bit div 8 AS int) + 1, 1)")), 16, 10).cast("int")
    is_set = byte.bitwiseAND(F.expr("shiftleft(1, CAST(_bit % 8 AS int))")) != 0
    return met.where(is_set).drop("_bucket", "_bit", "_map")
