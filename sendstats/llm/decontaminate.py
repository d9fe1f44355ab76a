"""Benchmark items that occur in documents, found by SimHash over windows.

Windows have the length of an item: of the shortest one, so that each longer item
holds several. Items are fingerprinted at every offset and documents at a stride
chosen such that any passage with a similarity of ``MIN_SIMILARITY`` leaves one
window whole. Fingerprints are compared by multi-index Hamming search: they are cut
to ``RADIUS + 1`` blocks, and two within the radius agree in one block at least, so
joining on blocks finds all of them. Each candidate is then verified exactly: the
item against the stretch of the document that the two windows align it with.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sendstats.llm.common import SHINGLE, once, shingle_hashes, tagged, words_of

MIN_SIMILARITY = 0.8
RADIUS = 3
BLOCKS = RADIUS + 1
BLOCK_BITS = 64 // BLOCKS
# Item windows in one broadcast: some 100 bytes each for its blocks, so 100 MB. A
# larger benchmark is searched in so many slices, each a pass over the documents.
MAX_BROADCAST_WINDOWS = 1_000_000


def window_shape(shortest: int) -> tuple[int, int]:
    """Window length and stride, in words, for items of ``shortest`` words and more.

    An item of n shingles and a stretch of its length with a similarity of 0.8 have
    n * 1.6 / 1.8 shingles in common. A change inside costs five of them and needs an
    item of 49 words; so a run of ``intact`` words at least is the same in both, and
    a run of window + stride - 1 words holds a whole window wherever it starts.
    """
    shingles = shortest - SHINGLE + 1
    common = math.ceil(shingles * 2 * MIN_SIMILARITY / (1 + MIN_SIMILARITY) - 1e-9)
    intact = common + SHINGLE - 1
    # With a change inside, half of an item of 49 words is left whole.
    intact = min(intact, 24)
    length = max(SHINGLE, math.ceil(intact * 2 / 3))
    return length, max(1, intact - length + 1)


def simhash(shingles: str, count: int) -> str:
    """SQL for the SimHash of ``shingles``, an array of ``count`` hashes: each bit by majority.

    A shingle that occurs twice weighs two. The 64 counters are held as bit planes, so
    that one hash is added to all of them by a few whole-number operations.
    """
    planes = count.bit_length()
    carry, added = "x", []
    for p in range(planes):
        added.append(f"a.p{p} ^ ({carry}) AS p{p}")
        carry = f"{carry} & a.p{p}"
    zero = ", ".join(f"0L AS p{p}" for p in range(planes))
    # Bits whose count is above half: compare the planes with count div 2, high plane first.
    above, equal = "0L", "-1L"
    for p in reversed(range(planes)):
        if (count // 2) >> p & 1:
            equal = f"{equal} & a.p{p}"
        else:
            above = f"{above} | ({equal} & a.p{p})"
            equal = f"{equal} & ~a.p{p}"
    return f"aggregate({shingles}, struct({zero}), (a, x) -> struct({', '.join(added)}), a -> {above})"


def blocks_of(fingerprint: str) -> Column:
    """The block values of a fingerprint, each with its place, as one number."""
    mask = (1 << BLOCK_BITS) - 1
    parts = [
        f"CAST(shiftrightunsigned({fingerprint}, {b * BLOCK_BITS}) & {mask} AS int) + {b << BLOCK_BITS}"
        for b in range(BLOCKS)
    ]
    return F.explode(F.expr(f"array({', '.join(parts)})"))


def _shingled(table: DataFrame, key: str) -> DataFrame:
    words = once(table, "_words", words_of(F.lower("text"))).where(F.size("_words") >= SHINGLE)
    return once(words, "h", shingle_hashes("_words")).select(key, "h")


def similarity(item: str, stretch: str) -> str:
    """SQL for the weighted Jaccard similarity of two shingle arrays; weights are counts."""
    both = (
        f"aggregate(array_distinct({item}), 0, (a, x) -> a + least("
        f"size(filter({item}, y -> y = x)), size(filter({stretch}, y -> y = x))))"
    )
    return f"{both} / (size({item}) + size({stretch}) - {both})"


def _search(docs: DataFrame, items: DataFrame, length: int, stride: int) -> DataFrame:
    count = length - SHINGLE + 1
    offsets = items.select(
        "item_id", F.expr(f"explode(transform(sequence(0, size(h) - {count}), o -> struct(o, "
                          f"{simhash(f'slice(h, o + 1, {count})', count)} AS f)))").alias("w"),
    ).select("item_id", F.col("w.o").alias("_offset"), F.col("w.f").alias("_item_fp"))
    index = offsets.withColumn("_block", blocks_of("_item_fp"))
    # The last window ends with the text; a shorter text is one window.
    starts = f"array_distinct(concat(sequence(0, greatest(size(h) - {count}, 0), {stride}), array(greatest(size(h) - {count}, 0))))"
    windows = docs.select("doc_id", "h", F.expr(
        f"explode(transform({starts}, s -> struct(s, {simhash(f'slice(h, s + 1, {count})', count)} AS f)))"
    ).alias("w")).select("doc_id", "h", F.col("w.s").alias("_start"), F.col("w.f").alias("_fp"))
    near = F.expr(f"bit_count(_fp ^ _item_fp) <= {RADIUS}")
    # Broadcast: at most MAX_BROADCAST_WINDOWS item windows, see leaks().
    found = windows.withColumn("_block", blocks_of("_fp")).join(F.broadcast(index), "_block").where(near)
    aligned = found.join(F.broadcast(items.withColumnRenamed("h", "_item")), "item_id")
    first = F.greatest(F.col("_start") - F.col("_offset"), F.lit(0))
    end = F.col("_start") - F.col("_offset") + F.size("_item")
    stretched = once(aligned.withColumn("start_word", first), "_stretch", F.slice("h", first + 1, end - first))
    return stretched.select("doc_id", "item_id", "start_word", F.expr(similarity("_item", "_stretch")).alias("similarity"))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pairs (doc_id, item_id) of a document of ``docs`` and a benchmark item that it holds.

    Text is compared in lower case by five-word shingles, weighted by their counts:
    the best stretch of the item's length has a similarity of 0.8 at least, and starts
    at ``start_word``. Items and documents under five words, empty and NULL ones
    included, have no shingle and no pair; an empty table on either side gives no rows.
    Rows with equal ids, NULL ones as well, count as one document or item.
    """
    items = _shingled(benchmark.select("item_id", "text"), "item_id")
    shape = items.agg(
        F.min(F.size("h")).alias("least"), F.sum(F.size("h")).alias("windows")
    ).first()
    shortest = SHINGLE if shape["least"] is None else shape["least"] + SHINGLE - 1
    length, stride = window_shape(shortest)
    slices = max(1, math.ceil((shape["windows"] or 0) / MAX_BROADCAST_WINDOWS))
    shingled = _shingled(docs.select("doc_id", "text"), "doc_id")
    found = None
    for part in range(slices):
        some = items if slices == 1 else items.where(F.pmod(F.xxhash64("item_id"), F.lit(slices)) == part)
        here = _search(shingled, some, length, stride)
        found = here if found is None else found.unionAll(here)
    best = F.max(F.struct("similarity", (-F.col("start_word")).alias("s")))
    return found.where(F.col("similarity") >= MIN_SIMILARITY).groupBy("doc_id", "item_id").agg(best.alias("b")).select(
        "doc_id", "item_id", F.round("b.similarity", 9).alias("similarity"), (-F.col("b.s")).cast("long").alias("start_word")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns.

    Each row goes by its own text: rows without id, or with the same id as a leak, stay.
    """
    rows = tagged(docs)
    bad = leaks(rows.select(F.col("_id").alias("doc_id"), F.col("_row.text").alias("text")), benchmark)
    return rows.join(bad.select(F.col("doc_id").alias("_id")), "_id", "left_anti").select("_row.*")
