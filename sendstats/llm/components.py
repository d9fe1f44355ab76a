"""Connected components of a table of links, and of sets that are compared within groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sendstats.llm.common import materialize

# Centres of a group in the first round, and how many times as many there are after each next one.
GROWTH = 16


def component_labels(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b): the smallest node it is linked with, through others as well.

    Large and small stars in turn: each node hands its smallest neighbour to its larger
    neighbours, then to all that are left. A component shrinks to a star around its smallest
    node in a few rounds, whatever its shape; it ends when all are such stars. Minima are
    aggregated before they are shuffled, so that a centre with very many links is no hot spot
    there; the joins that follow have one row of the other side for such a key.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = materialize(edges, "edges")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        others = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(others.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return materialize(stars.unionByName(stars.select(F.col("label").alias("node"), "label").distinct()), "labels")


def _are_stars(edges: DataFrame) -> bool:
    """Whether each ``u`` has one ``v`` only, which is no ``u`` itself."""
    ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("v").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    counts = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counts.where("up > 1 OR up > 0 AND down > 0").isEmpty()


def labelled(df: DataFrame, labels: DataFrame, node: str, name: str) -> DataFrame:
    """Add the label of a node; one without links is its own."""
    own = labels.select(F.col("node").alias(node), F.col("label").alias(name))
    return df.join(own, node, "left").withColumn(name, F.coalesce(name, node))


def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) of different components."""
    both = labelled(labelled(pairs, labels, "a", "la"), labels, "b", "lb")
    return both.where("la <> lb").select(*pairs.columns)


def stars(labels: DataFrame) -> DataFrame:
    """Links (a, b) that hold the components together: as many as nodes, less one each."""
    return labels.where("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after more links (a, b).

    Links of the same two components are one, so that the work grows with the components and
    not with the links.
    """
    names = labelled(labelled(links, labels, "a", "la"), labels, "b", "lb").where("la <> lb")
    more = component_labels(names.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct())
    every = labels.unionByName(more.select("node", F.col("node").alias("label"))).distinct()
    into = more.select(F.col("node").alias("label"), F.col("label").alias("_into"))
    joined = every.join(into, "label", "left").select("node", F.coalesce("_into", "label").alias("label"))
    return materialize(joined, "labels")


def _still_apart(rows: DataFrame, key: str, labels: DataFrame, begun: int, upto: int) -> DataFrame:
    """The rows from rank ``begun`` on of groups with several labels, with what ``_to_new_centres`` needs."""
    rows = labelled(rows.where(F.col("rank") >= begun), labels, "node", "label")
    new = F.count_if(F.col("rank") < upto)
    counts = rows.groupBy(key, "label").agg(F.count(F.lit(1)).alias("size"), new.alias("new"))
    groups = counts.groupBy(key).agg(
        F.max(F.struct("size", "label")).alias("most"), F.sum("size").alias("size"), F.sum("new").alias("new")
    ).where("size > most.size")
    groups = groups.select(key, F.col("most.label").alias("major"), "size", "new")
    return rows.join(groups, key).withColumn("major", F.col("label") == F.col("major"))


def _to_new_centres(rows: DataFrame, key: str, fields: list[str], upto: int, may_link: Callable[[dict, dict], Column], block: int) -> DataFrame:
    """(a, b): sets of different labels that may link, one of them a centre, a row of a rank below ``upto``.

    One of two different labels is not the group's most frequent one, so that rows of that one
    meet no centre of it. Members and centres of a large group are dealt to blocks, and each
    pair of blocks to a key of its own.
    """
    rows = rows.where("new > 0").withColumns({"_m": F.ceil(F.col("size") / block), "_c": F.ceil(F.col("new") / block)})
    rows = rows.withColumns({"_i": F.pmod(F.xxhash64("node"), "_m"), "_j": F.pmod(F.xxhash64("node"), "_c")})
    kept = ["node", "label", "rank", *fields]
    every = {c: F.explode(F.expr(f"sequence(0L, _{c} - 1)")) for c in "mc"}
    left = rows.select(key, F.col("major").alias("side"), F.col("_i").alias("i"), every["c"].alias("j"), *kept).alias("l")
    sides = F.explode(F.expr("IF(major, array(false), array(false, true))"))
    right = rows.where(F.col("rank") < upto).select(key, sides.alias("side"), "_m", F.col("_j").alias("j"), *kept)
    right = right.select(key, "side", every["m"].alias("i"), "j", *kept).alias("r")
    x, y = ({c: F.col(f"{side}.{c}") for c in kept} for side in "lr")
    # Of two centres each would meet the other.
    near = (x["label"] != y["label"]) & ((x["rank"] >= upto) | (x["label"] < y["label"])) & may_link(x, y)
    for c in (key, "side", "i", "j"):
        near &= F.col(f"l.{c}") == F.col(f"r.{c}")
    joined = left.join(right, near)
    return joined.select(F.least(x["node"], y["node"]).alias("a"), F.greatest(x["node"], y["node"]).alias("b")).distinct()


def linked_in_groups(
    members: DataFrame, key: str, sketches: DataFrame, labels: DataFrame, seen: DataFrame,
    may_link: Callable[[dict, dict], Column], links: Callable[[DataFrame], DataFrame], block: int,
) -> DataFrame:
    """``labels`` after the links of all sets with a group in common.

    ``members`` (key, node) tells the groups. ``may_link`` rules pairs out by its other columns and
    those of ``sketches`` (node), ``links`` verifies pairs (a, b), and ``seen`` has those that are done. Some rows of a group, its centres, are compared with all rows
    of other labels; linked components become one, and the next round takes ``GROWTH`` times as
    many centres, until every row of a group that still has several labels was one. So no pair
    of different components is left out. Sets with many links to others meet a centre early, when
    there are few, and sets with few links meet few: the links that a round finds grow with the
    rows of a group and not with their square, as all links of it would.
    """
    sizes = members.groupBy(key).agg(F.count(F.lit(1)).alias("_k")).where("_k > 1")
    rows = members.join(sizes, key).withColumn("rank", F.pmod(F.xxhash64(key, "node"), "_k")).drop("_k")
    known = members.columns
    fields = [c for c in [*known, *sketches.columns] if c not in (key, "node")]
    begun, upto = 0, GROWTH
    while True:
        rows = _still_apart(rows.select("rank", *known), key, labels, begun, upto)
        if not begun:
            rows, known = rows.join(sketches, "node"), [key, "node", *fields]
        rows = materialize(rows, "split")
        if rows.isEmpty():
            return labels
        pairs = _to_new_centres(rows, key, fields, upto, may_link, block)
        pairs = materialize(pairs.join(seen, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            labels, seen = merged(labels, links(pairs)), seen.unionByName(pairs)
        if rows.where(F.col("rank") >= upto).isEmpty():
            return labels
        begun, upto = upto, upto * GROWTH
