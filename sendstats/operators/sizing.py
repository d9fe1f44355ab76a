"""Broadcasts behind a check of the size, and what is done beyond it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of two or three 8-byte numbers: this many stay near 100 MB when hashed.
MAX_BROADCAST_ROWS = 1_000_000
# Parts that the rows of one key are dealt to in a shuffle join.
SALTS = 32
# Rows of one key beyond which it is dealt to parts, where keys are counted first.
HOT_ROWS = 100_000


def few_rows(df: DataFrame) -> bool:
    """Whether ``df`` has few enough rows to be broadcast.

    It is counted, no further than the limit, as a size estimate sees neither what an explode adds nor what
    a join drops. Meant for narrow id lists out of dimension snapshots, which
    are tiny next to the sessions they are joined to.
    """
    return df.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS


def join_few(big: DataFrame, small: DataFrame, on: Sequence[str], how: str, count_keys: bool = False) -> DataFrame:
    """Inner, left or left-semi join of sessions, as they are scanned, with an id list.

    A list that turns out long is joined by a shuffle. There one key may hold a
    large part of all sessions, so its rows are dealt in turn to ``SALTS`` parts,
    each of which meets its own copy of the list. The turn is the row's place in
    its file split, the same again when a lost task is repeated, and splits up
    identical rows too.

    That shuffles the list ``SALTS`` times. With ``count_keys`` the rows of each key are
    counted in a pass of its own, and only a key with more than ``HOT_ROWS`` is dealt.
    """
    if few_rows(small):
        return big.join(F.broadcast(small), on, how)
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    big = big.withColumn("_salt", turn)
    last = F.lit(SALTS - 1)
    if count_keys:
        # Each stands for many rows, so there are few of them.
        counts = big.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > HOT_ROWS)
        hot = F.broadcast(counts.select(*[F.col(c).alias(f"_hot_{c}") for c in on], F.lit(True).alias("_hot")))
        # NULL keys match nothing, but a left join keeps their rows.
        same = [F.col(c).eqNullSafe(F.col(f"_hot_{c}")) for c in on]
        big, small = (df.join(hot, same, "left").drop(*[f"_hot_{c}" for c in on]) for df in (big, small))
        big = big.withColumn("_salt", F.when(F.col("_hot"), F.col("_salt")).otherwise(0)).drop("_hot")
        last = F.when(F.col("_hot"), last).otherwise(0)
    copies = F.explode(F.sequence(F.lit(0), last))
    salted = big.join(small.withColumn("_salt", copies).drop("_hot"), [*on, "_salt"], how)
    return salted.drop("_salt")
