"""Mixing sources to target weights along a training curriculum.

Each source has a weight schedule over training time 0 to 1. Its integral, scaled to
the source's target, is the source's cumulative demand for words; inverting it at the
place of a document in its source gives the document's training position. Rows sorted
by position over all sources are the training order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sendstats.llm.common import materialize, once, words_of

MAX_REPEATS = 3
# Sources in order of their names weigh these, over and over.
WEIGHTS = (1, 2, 3)
# Share of its mean weight that a source of each kind has at the start and at the end
# of the training: weights change linearly between them.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
# Documents of a source that are summed up in one task.
CHUNK = 20_000


def targets(sizes: DataFrame) -> DataFrame:
    """The words each source shall give: shares by weight, none above three times its size.

    ``sizes``: source, size, one row per source; only these few rows are ordered as a
    whole. Capped sources are those whose size is small for their weight. With the
    sources in that order, a source is capped if the level that is left for it and all
    later ones would pass its cap.
    """
    cap = (MAX_REPEATS * F.col("source_size")).alias("cap")
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weigh = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.pmod(number, F.lit(len(WEIGHTS))) + 1).cast("int"))
    listed = sizes.select("source", "source_size", cap, F.pmod(number, F.lit(len(WEIGHTS))).alias("kind"), weigh.alias("weight"))
    by_room = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    before, after = by_room.rowsBetween(Window.unboundedPreceding, -1), by_room.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = listed.withColumns({
        "left": F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "weights": F.sum("weight").over(after),
    })
    full = F.col("cap") / F.col("weight") <= F.col("left") / F.col("weights")
    marked = level.withColumn("full", full)
    # The first source that isn't full sets the level of all that are not.
    share = lambda c: F.first(F.when(~F.col("full"), F.col(c)), ignorenulls=True)
    shared = marked.withColumns({
        "left": share("left").over(by_room.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        "weights": share("weights").over(by_room.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    })
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("left") * F.col("weight") / F.col("weights"))
    return shared.select("source", "source_size", "kind", target.alias("target"))


def position(demand: Column, start: Column, end: Column) -> Column:
    """When a source has met the share ``demand`` of its target.

    Its weight runs from ``start`` to ``end`` (mean 1), so that the demand at t is
    start * t + (end - start) * t * t / 2; this is solved for t. NULL for a NULL demand.
    """
    t = 2 * demand / (start + F.sqrt(start * start + 2 * (end - start) * demand))
    return F.when(t < 1.0, t).when(t >= 1.0, 1.0)


def sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("size", F.size(words_of(F.col("text"))).cast("long"))


def mix(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """What the mix takes of every row of ``docs`` (doc_id, source, size and ``key``, see ``sized``).

    Documents of a source come in the order of a hash of their ids. The source is read
    from the start, again and again, until its target is met; the last document is cut
    there. ``taken`` counts the words, ``first_position`` is where the first of them
    stand in the training, NULL for rows of which nothing is taken. Rows with equal ids
    and sizes can stand for each other. Empty rows take nothing; an empty table gives no
    rows. Other columns are not carried.

    Sums run within chunks of a source, as one source may have a large part of all rows.
    """
    order = F.md5(F.col("doc_id").cast("string")).alias("_order")
    own = docs.select(*dict.fromkeys([key, "doc_id"]), "source", "size", order)
    counts = own.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_n"))
    plan = targets(counts.select("source", "source_size")).join(
        counts.select(F.col("source").alias("_s"), "_n"), F.col("source").eqNullSafe(F.col("_s"))
    ).drop("_s")
    plan = materialize(plan.withColumn("_chunks", F.ceil(F.col("_n") / CHUNK)), "sources")
    # The first 28 bits of the order give the chunk, so that chunks follow each other in it.
    place = F.conv(F.substring("_order", 1, 7), 16, 10).cast("long")
    same = own["source"].eqNullSafe(F.col("_source"))
    dealt = own.join(plan.withColumnRenamed("source", "_source"), same).drop("_source").withColumn(
        "_chunk", F.coalesce((place * F.col("_chunks")) / F.lit(1 << 28), F.lit(0)).cast("long")
    )
    sums = dealt.groupBy("source", "_chunk").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("source").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("source").alias("_source"), F.col("_chunk").alias("_c"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"),
    )
    within = Window.partitionBy("source", "_chunk").orderBy("_order", key, "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("_within", F.coalesce(F.sum("size").over(within), F.lit(0)))
    on = placed["source"].eqNullSafe(offsets["_source"]) & (placed["_chunk"] == offsets["_c"])
    placed = placed.join(offsets, on).withColumn("_before", F.col("_offset") + F.col("_within"))
    rest = F.expr("if(source_size > 0, floor(target) % source_size, 0)")
    rounds = F.expr("if(source_size > 0, floor(target) div source_size, 0)")
    part = F.greatest(F.least(rest - F.col("_before"), F.col("size")), F.lit(0))
    taken = (rounds * F.col("size") + part).cast("long")
    start = F.element_at(F.array(*[F.lit(s) for s, _ in SCHEDULES]), (F.col("kind") + 1).cast("int"))
    end = F.element_at(F.array(*[F.lit(e) for _, e in SCHEDULES]), (F.col("kind") + 1).cast("int"))
    out = placed.withColumns({"taken": taken, "_start": start, "_end": end})
    met = F.when(F.col("taken") > 0, F.col("_before") / F.col("target"))
    return out.select(
        key, "size", "source_size", "target", "taken",
        position(met, F.col("_start"), F.col("_end")).alias("first_position"),
        "source", "_before", "_start", "_end",
    )


def passes(mixed: DataFrame) -> DataFrame:
    """One row per pass over a document: ``words`` taken of it and its training ``position``."""
    each = mixed.where("taken > 0").withColumn(
        "_pass", F.explode(F.expr("sequence(0L, (taken - 1) div size)"))
    )
    met = (F.col("_pass") * F.col("source_size") + F.col("_before")) / F.col("target")
    return each.withColumns({
        "position": position(met, F.col("_start"), F.col("_end")),
        "words": F.least(F.col("size"), F.col("taken") - F.col("_pass") * F.col("size")),
    })


def mixed_documents(docs: DataFrame) -> DataFrame:
    """What the mix takes of every document, in the order of the training; see ``mix``."""
    # Counted once; the counts are read for the sources and for the documents.
    counted = materialize(sized(docs.select("doc_id", "source", "text")).drop("text"), "sized")
    return mix(counted).orderBy("first_position", "doc_id")


def training_order(docs: DataFrame) -> DataFrame:
    """The mixed documents as rows sorted by training position, texts cut where only a part is taken.

    Columns as in ``docs``, then ``position``; ``n_chars`` of a cut text counts what is left.
    A document that is taken more than once has a row for each pass, one of which nothing is
    taken, as with NULL and empty texts, has none. An empty table gives no rows. The sort is by ranges, over all partitions.
    """
    columns = docs.columns
    tagged = materialize(sized(docs.select(F.struct(*columns).alias("_row"), "doc_id", "source", "text")).drop("text").withColumn(
        "_id", F.monotonically_increasing_id()), "sized")
    taken = passes(mix(tagged, "_id")).select("_id", "words", "position")
    joined = tagged.join(taken, "_id")
    # Of a cut text the first words stay, with the white space before each of them. Its pieces are
    # made once a row, and not at all for whole texts.
    is_cut = F.col("words") < F.col("size")
    text = F.when(is_cut, F.col("_row.text"))
    joined = once(joined, "_gaps", F.when(is_cut, F.split(text, "[^ \\t-\\r]+")))
    joined = once(joined, "_some", F.when(is_cut, words_of(text)))
    first = lambda pieces: F.slice(pieces, F.lit(1), F.col("words").cast("int"))
    cut = F.array_join(F.zip_with(first("_gaps"), first("_some"), lambda gap, word: F.concat(gap, word)), "")
    changed = {"text": cut, "n_chars": F.length(cut)}
    fields = []
    for field in docs.schema:
        value = F.col(f"_row.{field.name}")
        if field.name in changed:
            value = F.when(is_cut, changed[field.name].cast(field.dataType)).otherwise(value)
        fields.append(value.alias(field.name))
    return joined.select(*fields, "position").orderBy("position", "doc_id")
