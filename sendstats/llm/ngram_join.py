"""Similarity join of shingle sets by rare-first prefix filtering.

Sets of n shingles with a Jaccard similarity of 0.9 have 0.9 n shingles in common at least. So
with the shingles of all sets in one order, rare ones first, the first n/10 + 1 of each set,
its prefix, hold a common one.

1. Texts with the same set make one class, whatever its size.
2. A class with more than n/10 shingles that no other class has links with nothing: its whole
   prefix is its own. A quarter of all shingles, by hash, is enough to tell that of most
   classes, so that only the rest, the open classes, have all their shingles counted.
3. Prefixes are joined on their shingles. A pair must pass a length filter, and a positional
   and suffix filter in one: what both sets still have after the common shingle, counted by
   eight ranges of hashes, bounds what they can have in common.
   A pair that passes must also have parity sketches that allow a link: of two sets, the bits in
   which these differ are at most as many as the shingles that one set has and the other lacks.
4. Passing pairs are verified once each, by the exact sets. Members of a group with a shingle in
   common are first compared with one of them, its centre, and linked classes are joined;
   then with more and more centres, in rounds, until every pair that is still in different
   components is verified. Pairs within a component change nothing, so that of a group of many
   near copies only some links for each are found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sendstats.llm.common import materialize, once, words_of
from sendstats.llm.components import apart, component_labels, linked_in_groups, merged
from sendstats.llm.near_dedup import PARITY, parities
from sendstats.llm.probminhash import fingerprints, shingles, weighted
from sendstats.operators.sizing import few_rows

SHINGLE = 3
# Links: PERCENT * union <= 100 * intersection. Prefixes of n // 10 + 1 shingles go with 90.
PERCENT = 90
# One in so many shingles, by hash, is counted over all classes.
SAMPLE = 4
# Ranges of hashes whose shingles are counted for the suffix filter.
PARTS = 8
# Words that are worked on together: bounds the memory of a task.
CHUNK = 400_000
# Sets with a prefix shingle in common that are compared in one task.
BLOCK = 1_000
CLASS = ["f1", "f2"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SUFFIX = [f"c{i}" for i in range(PARTS)]


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with hashes that find a row again: of its id and, twice, of its text."""
    return docs.select(
        "doc_id", "text", F.xxhash64("doc_id").alias("who"), F.xxhash64("text").alias("t1"), F.hash("text").alias("t2")
    )


def _word_hashes(rows: DataFrame, *carried: str) -> DataFrame:
    """The columns ``carried`` and ``h``, the hashes of the words of ``text`` with A-Z in lower case."""
    words = once(rows, "_words", words_of(F.translate(F.col("text"), UPPER, LOWER)))
    return words.select(*carried, F.transform("_words", lambda w: F.xxhash64(w)).alias("h"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(rows, number of rows, sets, elements) for pieces of about ``CHUNK`` words; the last column has the word hashes."""
    for batch in batches:
        lists = batch.column(batch.num_columns - 1)
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(ends):
            begun = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, begun + CHUNK, side="right")))
            lengths = np.diff(np.concatenate(([begun], ends[at:upto])))
            part = lists.slice(at, upto - at).flatten().to_numpy()
            sets, elements, _ = weighted(*shingles(part, lengths, SHINGLE))
            yield batch.slice(at, upto - at), upto - at, sets, elements
            at = upto


def _lists(n: int, sets: np.ndarray, values: np.ndarray) -> pa.Array:
    """The values of each set as a list; ``sets`` is in order."""
    offsets = np.concatenate(([0], np.cumsum(np.bincount(sets, minlength=n)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, n, sets, elements in _pieces(batches):
        marks = fingerprints(n, sets, elements, np.ones(len(sets))).view(np.int64)
        few = elements % np.uint64(SAMPLE) == 0
        yield pa.RecordBatch.from_arrays(
            [*rows.columns[:-1], pa.array(np.bincount(sets, minlength=n)), pa.array(marks[:, 0]), pa.array(marks[:, 1]),
             _lists(n, sets[few], elements[few])],
            names=[*rows.schema.names[:-1], "n", *CLASS, "sample"],
        )


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, n, sets, elements in _pieces(batches):
        words = parities(n, sets, elements).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(np.bincount(sets, minlength=n)), _lists(n, sets, elements),
             *[pa.array(np.ascontiguousarray(w)) for w in words.T]],
            names=["node", "n", "s", *PARITY],
        )


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (e, node, n, rest, c0...) for the shingles of each prefix that other sets have too.

    Columns in: node, n, shared (df, e). ``rest`` counts the shared shingles from this one on,
    and c0 and so on those after it by the range of their hashes.
    """
    for batch in batches:
        nodes, sizes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        flat = batch.column(2).flatten()
        df, e = (flat.field(i).to_numpy() for i in range(2))
        ends = np.cumsum(pc.list_value_length(batch.column(2)).to_numpy().astype(np.int64))
        out: list[list] = [[] for _ in range(4)]
        after = []
        for i, (node, n) in enumerate(zip(nodes, sizes)):
            own = slice(ends[i - 1] if i else 0, ends[i])
            mine = e[own][np.lexsort((e[own], df[own]))]
            # Those that only this set has come first.
            upto = int(n // 10 + 1 - (n - len(mine)))
            if upto <= 0:
                continue
            part = (mine.view(np.uint64) >> np.uint64(61)).astype(np.int64)
            left = np.bincount(part, minlength=PARTS) - np.cumsum(np.eye(PARTS, dtype=np.int64)[part[:upto]], axis=0)
            k = len(left)
            for column, values in zip(out, (mine[:k], np.full(k, node), np.full(k, n), len(mine) - np.arange(k))):
                column.append(values)
            after.append(left)
        if after:
            counts = np.concatenate(after).astype(np.int32)
            columns = [np.concatenate(c) for c in out] + [counts[:, p] for p in range(PARTS)]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=["e", "node", "n", "rest", *SUFFIX])


def _signed(docs: DataFrame) -> DataFrame:
    """Of every row: how to find it, the size and the class of its set, and the sampled shingles."""
    hashed = _word_hashes(_keyed(docs), "doc_id", "who", "t1", "t2")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return hashed.mapInArrow(_sign, f"doc_id {kind}, who bigint, t1 bigint, t2 int, n bigint, f1 bigint, f2 bigint, sample array<bigint>")


def _open(classes: DataFrame, signed: DataFrame) -> DataFrame:
    """The classes that may have a partner: few enough of their sampled shingles are their own."""
    each = signed.where("n > 0").select("f1", F.explode("sample").alias("e"))
    alone = each.groupBy("e").agg(F.min("f1").alias("f1"), F.max("f1").alias("_other")).where("f1 = _other")
    counts = alone.groupBy("f1").agg(F.count(F.lit(1)).alias("alone"))
    return classes.join(counts, "f1", "left").where("n > 0 AND coalesce(alone, 0) <= n div 10")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, n, s, p0...) of the classes ``wanted``, from the text of one row each."""
    key = ["who", "t1", "t2"]
    ids = wanted.select(*key, "node")
    # Four numbers a class: a list of checked length is broadcast, a longer one joined by a shuffle of the texts.
    found = _keyed(docs).join(F.broadcast(ids) if few_rows(ids) else ids, key).groupBy(*key).agg(F.first("node").alias("node"), F.first("text").alias("text"))
    kinds = ", ".join(f"{c} bigint" for c in PARITY)
    return _word_hashes(found, "node").mapInArrow(_whole, f"node bigint, n bigint, s array<bigint>, {kinds}")


def _prefix_rows(sets: DataFrame) -> DataFrame:
    each = sets.select("node", "n", F.explode("s").alias("e"))
    shared = each.groupBy("e").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    listed = each.join(shared, "e").groupBy("node", "n").agg(F.collect_list(F.struct("df", "e")).alias("shared"))
    kinds = ", ".join(f"{c} int" for c in SUFFIX)
    rows = listed.select("node", "n", "shared").mapInArrow(_prefixes, f"e bigint, node bigint, n bigint, rest bigint, {kinds}")
    return materialize(rows, "prefixes")


def _can_link(x: Callable[[str], Column], y: Callable[[str], Column]) -> Column:
    """Length, positional and suffix filters of two prefix rows with the same shingle.

    A link needs an intersection of 9/19 of both sizes together.
    """
    long, short = F.greatest(x("n"), y("n")), F.least(x("n"), y("n"))
    left = sum((F.least(x(c), y(c)) for c in SUFFIX), F.lit(1))
    need = PERCENT * (x("n") + y("n"))
    per = 100 + PERCENT
    return (100 * short >= PERCENT * long) & (per * F.least(x("rest"), y("rest")) >= need) & (per * left >= need)


def _may_link(x: Callable[[str], Column], y: Callable[[str], Column]) -> Column:
    """Sets that link differ in a nineteenth of both sizes at most."""
    differ = sum((F.bit_count(x(c).bitwiseXOR(y(c))) for c in PARITY), F.lit(0))
    return (100 + PERCENT) * differ <= (100 - PERCENT) * (x("n") + y("n"))


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))


def _to_centres(first: DataFrame) -> DataFrame:
    """(a, b, n): pairs of a set and the centre of a group that it is in, and how often they meet so."""
    fields = ["node", "n", "rest", *SUFFIX]
    centre = F.min(F.struct(F.xxhash64("node", "e").alias("h"), *fields))
    groups = first.groupBy("e").agg(centre.alias("c"), F.count(F.lit(1)).alias("k")).where("k > 1")
    groups = groups.select("e", F.col("c.node").alias("other"), *[F.col(f"c.{f}").alias(f"o_{f}") for f in fields[1:]])
    near = first.join(groups, "e").where((F.col("node") != F.col("other")) & _can_link(F.col, lambda c: F.col(f"o_{c}")))
    return materialize(_pairs(near).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")), "pairs")


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("s").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("s").alias("sb"))
    both = once(pairs.join(left, "a").join(right, "b"), "common", F.size(F.array_intersect("sa", "sb")))
    return both.where(f"100 * common >= {PERCENT} * (na + nb - common)").select("a", "b")


def joined_classes(sets: DataFrame) -> DataFrame:
    """(node, label) of the sets (node, n, s, p0...) that are linked with any: the smallest node of the component."""
    first = _prefix_rows(sets)
    pairs = _to_centres(first)
    # Of each set, the centre it meets most often is compared before all others.
    best = pairs.groupBy("b").agg(F.max(F.struct("n", "a")).alias("m")).select(F.col("m.a").alias("a"), "b")
    links = materialize(_links(best, sets), "links")
    labels = component_labels(links)
    more = materialize(apart(pairs.select("a", "b").join(best, ["a", "b"], "left_anti"), labels), "pairs")
    labels = merged(labels, _links(more, sets))
    may_link = lambda x, y: _can_link(x.get, y.get) & _may_link(x.get, y.get)
    verified = lambda found: _links(found, sets)
    return linked_in_groups(first, "e", sets.select("node", *PARITY), labels, best.unionByName(more), may_link, verified, BLOCK)


def ngram_join(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text).

    Documents link when 100 times the common shingles of three words (A-Z in lower case) are
    at least 90 times all shingles of both; ``component_id`` is the smallest id that a document
    is linked with, through others as well. A text of one or two words has one shingle, all its
    words. NULL texts and texts without words have no shingle, link with nothing and keep their
    own id. Rows without id count by their text and never give the component its id; one that is
    linked with no id at all has NULL. Repeated rows each have a result, an empty table gives
    none. Very long texts are worked on one at a time. Other columns are not carried.
    """
    docs = docs.select("doc_id", "text")
    signed = materialize(_signed(docs), "signed")
    one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "who", "t1", "t2")).alias("one")
    classes = signed.groupBy(*CLASS).agg(one, F.first("n").alias("n"))
    classes = classes.select(*CLASS, "n", F.col("one.doc_id").alias("low"), "one.who", "one.t1", "one.t2")
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    wanted = materialize(_open(classes, signed), "open")
    sets = materialize(_sets(docs, wanted), "sets")
    labels = joined_classes(sets)
    linked = labels.join(classes.select("node", *CLASS, "low"), "node")
    lows = linked.groupBy("label").agg(F.min("low").alias("component"))
    named = linked.join(lows, "label").select(*CLASS, "component")
    of_class = classes.select(*CLASS, "low").join(named, CLASS, "left").select(*CLASS, F.coalesce("component", "low").alias("component_id"))
    # A class of very many copies is a hot key here, with one row on the other side.
    out = signed.select("doc_id", F.col("n").alias("n_shingles"), *CLASS).join(of_class, CLASS)
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
