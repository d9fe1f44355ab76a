"""The n-gram join, importance resampling and centroid clustering: planted and odd cases beside their SQL."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sendstats.llm import components, importance, ngram_join as nj
from sendstats.llm.centroids import Bisectors, centroid_clusters
from sendstats.llm.components import component_labels, linked_in_groups
from sendstats.llm.importance import hashed_features, importance_sample
from sendstats.llm.ngram_join import ngram_join

DOCS = "doc_id bigint, text string"


def words(n, start=0):
    return " ".join(f"w{start + i}" for i in range(n))


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()


def expected_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 90 * len(a | b):
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for i in range(len(rows)):
        ids[root(i)].append(rows[i][0])
    low = {r: min((x for x in v if x is not None), default=None) for r, v in ids.items()}
    return sorted(((d, len(sets[i]), low[root(i)]) for i, (d, _) in enumerate(rows)), key=str)


def found_components(spark, rows):
    found = ngram_join(spark.createDataFrame(rows, DOCS))
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_join_against_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for k in range(40):
        base = [f"x{rng.randrange(60)}" for _ in range(rng.randrange(3, 120))]
        for _ in range(6):
            text = list(base)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(len(text))] = f"y{rng.randrange(300)}"
            rows.append((len(rows), " ".join(text[rng.randrange(2):])))
    assert found_components(spark, rows) == expected_components(rows)


@pytest.mark.parametrize("changed", [0, 1, 2])
def test_join_at_the_threshold(spark, changed):
    # 100 shingles, the last ones changed: 95 of 105 are common (0.905), then 94 of 106 (0.887).
    base = words(102)
    other = " ".join(base.split()[: 97 - changed] + [f"z{i}" for i in range(5 + changed)])
    rows = [(7, base), (3, other), (5, words(50, 500))]
    found = found_components(spark, rows)
    assert found == expected_components(rows)
    assert {d: c for d, _, c in found}[7] == (3 if changed == 0 else 7)


def test_join_of_many_near_copies(spark, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK", 7)
    base = words(400).split()
    rows = [(1000 - i, " ".join(base[: 4 * i] + [f"own{i}"] + base[4 * i + 1 :])) for i in range(90)]
    # Texts with most shingles in common, none of them near enough to another.
    rows += [(2000 + i, words(60, 9000) + " " + words(8, 20_000 + 100 * i)) for i in range(60)]
    rows += [(5000 + i, words(400).upper()) for i in range(30)]
    found = found_components(spark, rows)
    assert found == expected_components(rows)
    assert len({c for _, _, c in found}) == 61


def test_sketches_allow_every_link_and_few_other_pairs(spark):
    # Sets of 100 numbers each, of which the second one has d others: up to 5 they link.
    changed = list(range(0, 40))
    sets = [set(range(100))] + [set(range(d, 100)) | set(range(1000 * d, 1001 * d)) for d in changed]
    flat = [sorted(x) for x in sets]
    ids = np.repeat(np.arange(len(flat)), [len(x) for x in flat])
    marks = nj.parities(len(flat), ids, np.array(sum(flat, []), dtype=np.uint64)).view(np.int64)
    rows = [(i, len(flat[i]), *map(int, marks[i])) for i in range(len(flat))]
    df = spark.createDataFrame(rows, "i int, n bigint, " + ", ".join(f"{c} bigint" for c in nj.PARITY))
    x, y = df.where("i = 0").alias("x"), df.where("i > 0").alias("y")
    kept = x.join(y, nj._may_link(lambda c: F.col(f"x.{c}"), lambda c: F.col(f"y.{c}"))).select("y.i").collect()
    found, linked = {r.i for r in kept}, {i for i in range(1, 41) if 100 * len(sets[0] & sets[i]) >= 90 * len(sets[0] | sets[i])}
    assert linked <= found and len(found - linked) < 5


def test_join_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One\tTwo"), (8, "one two three"), (None, "one"),
            (None, "alone without id"), (None, "alone without id"), (9, words(30_000)), (9, words(30_000)), (9, words(20)), (10, words(30_000) + " x"), (11, "K a b"), (12, "k a b")]
    found = found_components(spark, rows)
    assert found == expected_components(rows)
    assert [c for d, n, c in found if d in (1, 2, 3)] == [1, 2, 3]
    empty = spark.createDataFrame([], DOCS)
    assert ngram_join(empty).count() == 0
    wide = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in ("node", "n", "s", "e", "h", "label", "a", "b", "f1", "who", "low", "k")})
    assert sorted((tuple(r) for r in ngram_join(wide).collect()), key=str) == found


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(0, 200)]
    star = [(1000, 1000 + i) for i in range(1, 300)] + [(1000, 1000)]
    found = component_labels(spark.createDataFrame(path + star + path[:5], "a bigint, b bigint"))
    labels = {r.node: r.label for r in found.collect()}
    assert labels == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}}
    assert component_labels(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("block", [7, 1000])
def test_links_of_a_large_group_grow_with_its_rows(spark, monkeypatch, block):
    # Of 400 sets all even ones link, and each odd one up to 380 with some even ones: 21,800 links.
    linked = lambda x, y: (x % 2 + y % 2 == 0) or (x % 2 + y % 2 == 1 and max(x % 2 * x, y % 2 * y) < 380 and (x + y) % 40 in (1, 3))
    every = {(x, y) for x in range(400) for y in range(x + 1, 400) if linked(x, y)}
    assert len(every) > 20_000
    table = spark.createDataFrame(sorted(every), "a bigint, b bigint").cache()
    found, merged = [], []

    def links(pairs):
        some = pairs.join(table, ["a", "b"], "left_semi")
        found.extend(tuple(p) for p in pairs.collect())
        return some

    def counted(edges):
        merged.append(edges.count())
        return component_labels(edges)

    monkeypatch.setattr(components, "component_labels", counted)
    members = spark.createDataFrame([(g, i) for g in (1, 2) for i in range(400 if g == 1 else 3)], "g bigint, node bigint")
    sketches = spark.createDataFrame([(i, i < 380 or i % 2 == 0) for i in range(400)], "node bigint, any boolean")
    none = spark.createDataFrame([], "node bigint, label bigint")
    seen = spark.createDataFrame([], "a bigint, b bigint")
    even = lambda c: c["node"] % 2 == 0
    may_link = lambda x, y: x["any"] & y["any"] & ((even(x) & even(y)) | (even(x) != even(y)) & ((x["node"] + y["node"]) % 40).isin(1, 3))
    labels = linked_in_groups(members, "g", sketches, none, seen, may_link, links, block)
    assert {r.node: r.label for r in labels.collect()} == {i: 0 for i in range(400) if i < 380 or i % 2 == 0}
    assert len(found) == len(set(found)) and len(found) < 6_000
    assert sum(merged) < 6_000


def plain_features(text, buckets=10_000):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]
    return len(w), Counter(zlib.crc32(r.encode()) % buckets for r in runs)


@pytest.mark.parametrize("chunk", [1, 2, 3, 5, 1000])
def test_features_in_pieces(monkeypatch, chunk):
    monkeypatch.setattr(importance, "CHUNK", chunk)
    for text in ("", "One", "a b", "A-b, c_d ÉK 12 İx " * 5, "x " * 17):
        pieces = list(hashed_features(text.encode(), 10_000))
        whole = plain_features(text)
        assert (sum(n for n, _ in pieces), Counter(int(b) for _, p in pieces for b in p)) == whole


def test_sample_with_ties_and_odd_rows(spark):
    long = words(30)
    rows = [(i, words(25, i)) for i in range(60)] + [(500, long)] * 40 + [(None, long)] * 20 + [(600, None), (601, ""), (602, words(19)), (603, words(20_000))]
    docs = spark.createDataFrame(rows, DOCS)
    target = spark.createDataFrame([(1, long)] * 300 + [(2, None)], "item_id bigint, text string")
    found = importance_sample(docs, target, percent=30).collect()
    assert len(found) == len(rows)
    drawn = sorted((r for r in found if r["rank"] is not None), key=lambda r: r["rank"])
    able = sum(plain_features(t)[0] >= 20 for _, t in rows)
    assert [r["rank"] for r in drawn] == list(range(1, 30 * able // 100 + 1))
    key = lambda r: (-r.score, r.doc_id is None, r.doc_id or 0)
    assert [key(r) for r in drawn] == sorted(key(r) for r in drawn)
    counts = {d: sum(plain_features(t)[1].values()) for d, t in rows}
    assert all(r.n_features == counts[r.doc_id] for r in found)
    left = [key(r) for r in found if r["rank"] is None and r.n_features >= 57]
    assert key(drawn[-1]) <= min(left)
    # The tied rows are cut in their middle.
    assert 0 < sum(r.doc_id == 500 for r in drawn) + sum(r.doc_id is None for r in drawn) < 60
    again = importance_sample(docs.repartition(7), target, percent=30).where("rank IS NOT NULL").collect()
    assert sorted((r["rank"], r.doc_id or -1) for r in again) == sorted((r["rank"], r.doc_id or -1) for r in drawn)


def test_sample_of_few_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, words(25)), (2, words(3))], DOCS).withColumns({c: F.lit("x") for c in ("score", "weight", "_row", "n", "rank", "bucket", "_part")})
    target = spark.createDataFrame([], "item_id bigint, text string")
    found = importance_sample(docs, target)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert [r["rank"] for r in found.collect()] == [None, None]
    assert [r["rank"] for r in importance_sample(docs, target, percent=100).orderBy("doc_id").collect()] == [1, None]
    assert importance_sample(docs.limit(0), target).count() == 0


def test_tournament_finds_the_nearest():
    rng = np.random.default_rng(2)
    x = rng.integers(-3, 4, (4000, 4))
    c = rng.integers(-3, 4, (9, 4))
    c[5] = c[2]
    far = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    assert (Bisectors(c).winners(x) == far.argmin(axis=1)).all()


def test_clusters_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0, 2.0]), (4, [1.0, nan, 0.0]), (5, [inf, 0.0, 0.0]), (6, [None, 0.0, 0.0]), (7, [1e30, -1e30, 0.0]),
            (8, [0.5, 0.25, -0.0001]), (8, [0.5, 0.25, -0.0001]), (None, [0.5, 0.25, 3.0]), (9, [0.1, 0.1, 0.1])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumns({c: F.lit("x") for c in ("v", "h", "cluster", "distance", "n", "total")})
    found = centroid_clusters(frame, components=3, clusters=2, rounds=3).collect()
    assert sorted((r.vec_id or 0) for r in found) == [0, 7, 8, 8, 9]
    assert {r.inertia for r in found} == {sum(r.distance for r in found)}
    few = centroid_clusters(frame.where("vec_id = 8"), components=3).collect()
    assert [(r.vec_id, r.cluster, r.distance, r.inertia) for r in few] == [(8, 0, 0, 0)] * 2
    assert centroid_clusters(frame.limit(0), components=3).count() == 0


def test_cut_texts_keep_their_white_space_and_are_counted(spark):
    from sendstats.llm.mixing import training_order

    rows = [(i, f"  {words(9, 10 * i)}\n\n{words(8)} \t end", f"s{i % 3}", 999) for i in range(40)] + [(99, None, "s1", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars bigint")
    texts = {r[0]: r[1] for r in rows}
    out = training_order(docs).collect()
    cut = [r for r in out if r.text != texts[r.doc_id]]
    assert cut and all(texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text) and not r.text[-1].isspace() for r in cut)
    assert all(r.n_chars == 999 for r in out if r.text == texts[r.doc_id])
