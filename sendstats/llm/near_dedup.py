"""Near-duplicate documents by ProbMinHash, banding and exact verification.

1. Texts with the same set of shingles make one class, whatever its size.
2. A class is signed by ProbMinHash, in which a shingle weighs 1 to 1.5 by its length, the
   same in all documents. Links are defined on the plain sets; for sets at 0.8 the probability
   Jaccard of these weights is 0.727 at least, so that such a pair shares one of the bands
   below with a probability of 0.995, and 0.9999 if the weights are even.
3. Signatures are cut to bands; classes that share a band, with sizes in the proportion of
   0.8 at least, are candidates. Each is compared with its group's centre first, with the one
   it shares most bands with before all others, and linked classes are joined.
4. Then every pair of candidates that are still in different components is verified, once.
   Pairs within a component change nothing, so that groups of many near copies are not
   compared pair by pair. A group of many classes is dealt to blocks, and a pair comes out
   of one only if its parity sketches allow it: of two sets, the bits in which these differ are
   at most as many as the elements that one set has and the other lacks. This loses no link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sendstats.llm.common import SHINGLE, materialize, once, words_of
from sendstats.llm.components import apart, component_labels, labelled, stars
from sendstats.llm.probminhash import GOLDEN, bands, fingerprints, mixed, shingles, signatures, weighted
from sendstats.operators.sizing import few_rows

PERCENT = 80
BANDS, ROWS = 24, 5
# The lowest bits of a word's hash and of a shingle hold the characters, up to this number.
LENGTH = 63
# Words that are worked on together: bounds the memory of a task.
CHUNK = 400_000
# Classes with a band in common that are compared in one task.
BLOCK = 1_000
# The parity sketch of a set has 64 bits in each of these: bit i tells whether an odd number of its elements fall to it.
PARITY = [f"p{i}" for i in range(16)]
CLASS = ["_f1", "_f2"]
# Finds a row again: hashes of its id and, twice, of its text.
ROW = ["_who", "_t1", "_t2"]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"_who": F.xxhash64("doc_id"), "_t1": F.xxhash64("text"), "_t2": F.hash("text")})


def _hashed(rows: DataFrame, *carried: str) -> DataFrame:
    words = once(rows, "_words", words_of(F.col("text")))
    h = F.expr(f"transform(_words, w -> (xxhash64(w) & {-LENGTH - 1}L) | least(length(w), {LENGTH}))")
    return words.select(*carried, h.alias("h"))


def _sized(words: np.ndarray, lengths: np.ndarray, sets: np.ndarray, elements: np.ndarray) -> np.ndarray:
    """The shingles ``elements`` with the characters of their words in the lowest bits."""
    counts = np.bincount(sets, minlength=len(lengths))
    ends = np.cumsum(lengths)
    starts = np.arange(len(sets)) + np.repeat(ends - lengths - (np.cumsum(counts) - counts), counts)
    upto = np.concatenate(([0], np.cumsum(words & LENGTH)))
    chars = upto[np.minimum(starts + SHINGLE, ends[sets])] - upto[starts]
    return (elements & ~np.uint64(LENGTH)) | np.minimum(chars, LENGTH).astype(np.uint64)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(rows, number of rows, sets, distinct shingles) for pieces of about ``CHUNK`` words; the last column has the word hashes."""
    for batch in batches:
        lists = batch.column(batch.num_columns - 1)
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(ends):
            begun = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, begun + CHUNK, side="right")))
            lengths = np.diff(np.concatenate(([begun], ends[at:upto])))
            words = lists.slice(at, upto - at).flatten().to_numpy()
            sets, elements = shingles(words, lengths, SHINGLE)
            sets, elements, _ = weighted(sets, _sized(words, lengths, sets, elements))
            yield batch.slice(at, upto - at), upto - at, sets, elements
            at = upto


def _lists(counts: np.ndarray, values: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, n, sets, elements in _pieces(batches):
        counts = np.bincount(sets, minlength=n)
        weights = 1.0 + (elements & np.uint64(LENGTH)).astype(np.float64) / (2 * LENGTH)
        marks = fingerprints(n, sets, elements, weights).view(np.int64)
        signed = bands(signatures(n, sets, elements, weights, BANDS * ROWS), ROWS)[:, :BANDS]
        # Texts without words have no band; they all make one class.
        some = counts > 0
        yield pa.RecordBatch.from_arrays(
            [*rows.columns[:-1], pa.array(counts), pa.array(marks[:, 0]), pa.array(marks[:, 1]),
             _lists(np.where(some, BANDS, 0), np.ascontiguousarray(signed[some]).reshape(-1))],
            names=[*rows.schema.names[:-1], "n", *CLASS, "bands"],
        )


def parities(n_sets: int, sets: np.ndarray, elements: np.ndarray) -> np.ndarray:
    """One row per set of ``len(PARITY)`` words, the parity sketch of its distinct elements."""
    bit = mixed(elements.astype(np.uint64) + GOLDEN)
    out = np.zeros((n_sets, len(PARITY)), dtype=np.uint64)
    word = (bit >> np.uint64(6)) % np.uint64(len(PARITY))
    np.bitwise_xor.at(out, (sets, word.astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
    return out


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, n, sets, elements in _pieces(batches):
        counts = np.bincount(sets, minlength=n)
        words = parities(n, sets, elements).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(counts), _lists(counts, elements), *[pa.array(np.ascontiguousarray(w)) for w in words.T]],
            names=["node", "n", "s", *PARITY],
        )


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, n, s, p0...) of the classes ``wanted``, from the text of one row each."""
    ids = wanted.select(*ROW, "node")
    # Four numbers a class: a list of checked length is broadcast, a longer one joined by a shuffle of the texts.
    found = _keyed(docs).join(F.broadcast(ids) if few_rows(ids) else ids, ROW)
    found = found.groupBy(*ROW).agg(F.first("node").alias("node"), F.first("text").alias("text"))
    kinds = ", ".join(f"{c} bigint" for c in PARITY)
    return _hashed(found, "node").mapInArrow(_whole, f"node bigint, n bigint, s array<bigint>, {kinds}")


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose shingle sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("s").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("s").alias("sb"))
    both = once(pairs.join(left, "a").join(right, "b"), "common", F.size(F.array_intersect("sa", "sb")))
    return both.where(f"100 * common >= {PERCENT} * (na + nb - common)").select("a", "b")


def _near(n, m):
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def _may_link(x, y):
    """Sets at 0.8 differ in a ninth of both sizes at most."""
    differ = sum((F.bit_count(x[c].bitwiseXOR(y[c])) for c in PARITY), F.lit(0))
    return (100 + PERCENT) * differ <= (100 - PERCENT) * (x["n"] + y["n"])


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))


def _to_centres(members: DataFrame) -> DataFrame:
    """(a, b, n): pairs of a class and a centre of a group that it is in, and the bands they share so.

    Each group's centre is another member, so that a class in many groups meets many.
    """
    centre = F.min(F.struct(F.xxhash64("node", "key").alias("h"), "node", "n")).alias("c")
    groups = members.groupBy("key").agg(centre).select("key", F.col("c.node").alias("other"), F.col("c.n").alias("m"))
    near = members.join(groups, "key").where((F.col("node") != F.col("other")) & _near(F.col("n"), F.col("m")))
    return materialize(_pairs(near).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")), "pairs")


def _across(members: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """All candidates of different labels that may link; each pair of blocks of a large group has a key of its own."""
    rows = labelled(members, labels, "node", "label")
    groups = rows.groupBy("key").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).alias("k"), F.min("label").alias("x"), F.max("label").alias("y")
    ).where("x <> y").select("key", "k")
    rows = materialize(rows.join(groups, "key").join(sets.select("node", *PARITY), "node"), "split")
    dealt = rows.withColumn("mine", F.pmod(F.xxhash64("node"), "k"))
    every = F.explode(F.expr("sequence(0L, k - 1)"))
    fields = ["node", "label", "n", *PARITY]
    left = dealt.select("key", F.col("mine").alias("i"), every.alias("j"), *fields).alias("l")
    right = dealt.select("key", every.alias("i"), F.col("mine").alias("j"), *fields).alias("r")
    x, y = ({c: F.col(f"{side}.{c}") for c in fields} for side in "lr")
    near = (x["label"] < y["label"]) & _near(x["n"], y["n"]) & _may_link(x, y)
    on = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("key", "i", "j")]
    both = left.join(right, on[0] & on[1] & on[2] & near).select(x["node"], y["node"].alias("other"))
    return _pairs(both).distinct()


def _joined(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, label) of the classes that are linked with any."""
    pairs = _to_centres(members)
    best = pairs.groupBy("b").agg(F.max(F.struct("n", "a")).alias("m")).select(F.col("m.a").alias("a"), "b")
    labels = component_labels(materialize(_links(best, sets), "links"))
    more = materialize(apart(pairs.select("a", "b").join(best, ["a", "b"], "left_anti"), labels), "pairs")
    labels = component_labels(stars(labels).unionByName(_links(more, sets)))
    rest = _across(members, labels, sets).join(best.unionByName(more), ["a", "b"], "left_anti")
    return component_labels(stars(labels).unionByName(_links(rest, sets)))


def _classified(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` with their class by equal sets, and of each class its id and the row that stays of it."""
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = materialize(
        _hashed(_keyed(docs), "doc_id", *ROW).mapInArrow(
            _sign, f"doc_id {kind}, _who bigint, _t1 bigint, _t2 int, n bigint, _f1 bigint, _f2 bigint, bands array<bigint>"
        ), "signed",
    )
    # Rows without id come last.
    one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *ROW)).alias("one")
    classes = signed.groupBy(*CLASS).agg(one, F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    keyed = classes.select("node", "n", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("key")
    members = materialize(keyed.join(shared, "key", "left_semi"), "members")
    wanted = classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "one.*")
    sets = materialize(_sets(docs, wanted), "sets")
    at = labelled(classes.select(*CLASS, "node", "one"), _joined(members, sets), "node", "label")
    at = materialize(at, "labelled")
    labels = at.groupBy("label").agg(F.min("one").alias("one"), F.min("_f1").alias("hash"))
    labels = labels.withColumn("low", F.col("one.doc_id").cast("bigint"))
    # Ids that are the smallest of several classes.
    twice = labels.where("low IS NOT NULL").groupBy("low").agg(F.min("hash").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    class_id = F.when(F.col("low").isNull() | (F.col("hash") > F.col("first")), F.col("hash")).otherwise(F.col("low"))
    ids = labels.join(twice, "low", "left").select("label", class_id.alias("class_id"), *[F.col(f"one.{c}").alias(f"{c}_kept") for c in ROW])
    return signed, at.select(*CLASS, "label").join(ids, "label").drop("label")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id) of every row of ``docs`` (doc_id whole numbers, text).

    Documents are linked when at least 0.8 of their five-word shingles are the same
    (Jaccard similarity of the sets); the class is all that is linked, through others as
    well, and ``class_id`` its smallest id. Texts under five words have one shingle, all
    their words. NULL and empty texts are alike and make one class. Every row counts by its
    own text, also rows without id or with an id that others have. A class without any id
    has a hash as its ``class_id``, and so has one whose smallest id another class has too;
    of those, one keeps the id. Very long texts are signed one at a time, repeated rows each have
    a result, an empty table gives none, and other columns are not carried.
    """
    signed, classes = _classified(docs)
    # A class of very many copies is a hot key here, with one row on the other side.
    return signed.select("doc_id", *CLASS).join(classes.select(*CLASS, "class_id"), CLASS).select("doc_id", "class_id")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of each class of ``near_duplicates``, that of its smallest id, with the columns of ``docs``.

    NULL texts, texts without words, rows without id and repeated ids count as they do there; of
    rows with the same id and text one stays. An empty table gives no rows.
    """
    signed, classes = _classified(docs)
    kept = classes.select(*[F.col(f"{c}_kept").alias(c) for c in ROW]).distinct()
    counts = signed.groupBy(*ROW).agg(F.count(F.lit(1)).alias("_copies"))
    marks = counts.join(kept.withColumn("_stays", F.lit(True)), ROW, "left").where("_copies > 1 OR _stays IS NULL")
    marks = materialize(marks.select(*ROW, F.coalesce("_stays", F.lit(False)).alias("_stays")), "dropped")
    # Rows apart from those listed stay: a list of checked length is broadcast.
    few = F.broadcast if few_rows(marks) else lambda df: df
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text")
    rows = _keyed(rows).select("_row", *ROW)
    single = rows.join(few(marks), ROW, "left_anti").select("_row.*")
    again = marks.where("_stays")
    if again.isEmpty():
        return single
    repeated = rows.join(few(again), ROW, "left_semi").groupBy(*ROW).agg(F.first("_row").alias("_row"))
    return single.unionByName(repeated.select("_row.*"))
