from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sendstats.functions.events import EMAIL_COUNTERS
from sendstats.operators import counts, sizing
from sendstats.operators.dims import (
    ids_from_literals,
    latest,
    newest_definition,
    senders,
    subject_lines,
    variant_messages,
    variant_subjects,
)
from sendstats.operators.nesting import (
    email_position,
    explode_events,
    explode_variants,
    message_events,
    with_email,
    with_variants,
)
from sendstats.plans import subject
from sendstats.plans.domain import with_all_rows

STATES = "states array<struct<events: array<struct<name: string, time: double>>>>"
VARS = "vars array<struct<name: string, value: struct<text: string>>>"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_a_null_state_loses_only_itself(spark):
    data = [
        (1, [([("a", 1.0)],), (None,), ([("b", 2.0), ("c", 3.0)],), None]),
        (2, None),
        (3, []),
        (4, [([],)]),
    ]
    df = spark.createDataFrame(data, f"id int, {STATES}")
    assert rows(explode_events(df)) == [(1, "a", 1.0), (1, "b", 2.0), (1, "c", 3.0)]


def test_variants(spark):
    schema = "id int, experiments array<struct<variant: bigint>>"
    data = [(1, [(5,), (5,), (6,)]), (2, []), (3, None), (4, [(None,)])]
    df = spark.createDataFrame(data, schema)
    assert rows(explode_variants(df)) == [(1, 5), (1, 5), (1, 6), (2, None), (3, None), (4, None)]
    # Every row once without a variant; a repeated variant counts twice.
    assert rows(with_variants(df)) == [
        (1, 5), (1, 5), (1, 6), (1, None), (2, None), (3, None), (4, None),
    ]


def test_email_position(spark):
    schema = "app_id bigint, email_user_attribute string, attribute_columns array<string>"
    apps = [
        (1, "email", ["a", "email"]),
        (2, None, ["email"]),
        (3, "gone", ["email"]),
        (4, "email", None),
        (5, "email", ["a", "b", "c", "email"]),
    ]
    positions = email_position(spark.createDataFrame(apps, schema))
    sessions = spark.createDataFrame(
        [(app, ["X@QQ.com", "U@Gmail.com"]) for app in range(1, 7)] + [(1, None)],
        "app_id bigint, attrs array<string>",
    )
    assert rows(with_email(sessions, positions)) == [
        (1, "u@gmail.com", "gmail.com"),
        (1, None, "Other"),
        (2, None, "Other"),
        (3, None, "Other"),
        (4, None, "Other"),
        (5, None, "Other"),
    ]


def test_latest_and_newest_definition(spark):
    schema = (
        "message_id bigint, app_id bigint, name string, action_type string, delivery_type int, "
        "last_change_time timestamp, dt date"
    )
    data = spark.sql(f"""
      SELECT * FROM VALUES
        (1L, 1L, 'old', '__Email', 0, TIMESTAMP'2024-01-01 10:00:00', DATE'2024-01-01'),
        (1L, 1L, 'new', '__Email', 1, TIMESTAMP'2024-01-02 10:00:00', DATE'2024-01-02'),
        (2L, 1L, 'tie a', '__Email', 2, TIMESTAMP'2024-01-01 10:00:00', DATE'2024-01-01'),
        (2L, 1L, 'tie b', '__Email', 2, TIMESTAMP'2024-01-01 10:00:00', DATE'2024-01-03'),
        (3L, 1L, 'changed first', '__Email', 9, TIMESTAMP'2024-01-09 10:00:00', DATE'2024-01-01'),
        (3L, 1L, 'changed last', '__In App', NULL, TIMESTAMP'2024-01-05 10:00:00', DATE'2024-01-02')
      AS t({", ".join(c.split()[0] for c in schema.split(", "))})""")
    assert rows(newest_definition(data)) == [
        (1, "new", "Future"), (2, "tie b", "Manual"), (3, "changed first", "Unknown"),
    ]
    # Live is what the newest snapshot holds; the others were deleted.
    assert rows(latest(data, ["message_id"]).select("message_id", "name", "action_type")) == [
        (2, "tie b", "__Email"),
    ]


def test_experiment_look_ups(spark):
    import datetime as dt

    first, second = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    m = 4500000000000001

    def var(name, text):
        return (name, (text,))

    data = [
        (10, m, first, [var("Subject", "a"), var("Sender email", "x@a"), var(f"__message__{m}", ""),
                        var(f"__message__{m}.Subject", "A1")]),
        (10, m, second, [var("Subject", "b"), var("Subject", "c"), var("Sender email", "y@a"),
                         var(f"__message__{m}.Subject", "A2"), var("__message__12", ""),
                         var(f"__message__x{m}", "")]),
        (11, m, second, [var("Sender email", "z@a"), var("my subject", "d"), var(f"__message__{m}x", "")]),
        (12, m, second, None),
    ]
    df = spark.createDataFrame(data, f"variant_id bigint, message_id bigint, dt date, {VARS}")
    assert rows(subject_lines(df)) == [(m, "a"), (m, "b"), (m, "c")]
    assert rows(senders(df)) == [(m, "z@a")]
    assert rows(variant_messages(df)) == [(10, m)]
    assert rows(variant_subjects(df)) == [(10, m, "A2")]


def test_ids_from_literals(spark):
    assert rows(ids_from_literals(spark, [3, 1, 3])) == [(1,), (3,), (3,)]
    assert rows(ids_from_literals(spark, [])) == []


def random_events(seed, n=3000):
    """A third of all events is one message of one user, copies included."""
    rng = random.Random(seed)
    labels = ["Sent", "Delivered", "Open", "Click", "Bounce", "Other thing"]
    hot = (1, 100, 7, "hot@gmail.com")
    out = []
    for i in range(n):
        app, message, user, email = hot if i % 3 == 0 else (
            rng.randrange(3), rng.randrange(95, 105), rng.randrange(20),
            rng.choice([None, "a@gmail.com", "b@x.y", ""]),
        )
        out.append((app, message, user, email, rng.choice(labels), rng.randrange(4)))
    return out


SCHEMA = "app_id bigint, message_id bigint, user_id bigint, email string, label string, day int"


@pytest.mark.parametrize("few", [True, False])
def test_counters_match_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 10**6 if few else -1)
    data = random_events(1)
    df = spark.createDataFrame(data, SCHEMA)
    wanted = {(1, 100), (0, 96), (2, 104)}
    ids = spark.createDataFrame(sorted(wanted), "app_id bigint, message_id bigint")
    keys = ["app_id", "message_id"]
    found = counts.counters_of_messages(df, ids, keys, EMAIL_COUNTERS, ["user_id", "email", "day"])

    own = [r for r in data if (r[0], r[1]) in wanted]
    totals = Counter((r[0], r[1], r[4]) for r in own)
    unique = Counter((app, message, label) for app, message, _, _, label, _ in set(own))
    want = sorted(
        (
            app, message,
            *[totals[app, message, label] for label in EMAIL_COUNTERS],
            unique[app, message, "Open"], unique[app, message, "Click"],
        )
        for app, message in {(r[0], r[1]) for r in own}
    )
    assert sorted(tuple(r) for r in found.collect()) == want


@pytest.mark.parametrize("few", [True, False])
def test_variant_counters_match_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 10**6 if few else -1)
    rng = random.Random(2)
    data = [
        (*event, [(v,) for v in rng.choices([1, 2, 3, None], k=rng.randrange(4))])
        for event in random_events(3)
    ]
    df = spark.createDataFrame(data, SCHEMA + ", experiments array<struct<variant: bigint>>")
    ids = spark.createDataFrame([(1, 100), (0, 96)], "app_id bigint, message_id bigint")
    pairs = {(1, 100), (2, 100), (3, 97)}
    variants = spark.createDataFrame(sorted(pairs), "variant_id bigint, message_id bigint")
    found = subject.variant_counters(df.drop("email"), ids, variants)

    spread = []
    for app, message, user, _, label, day, taken in data:
        if (app, message) in {(1, 100), (0, 96)}:
            spread.append((app, message, None, user, label, day))
            for v, in taken:
                if v is not None and (v, message) in pairs:
                    spread.append((app, message, v, user, label, day))
    totals = Counter((*r[:3], r[4]) for r in spread)
    unique = Counter((*r[:3], r[4]) for r in set(spread))
    want = [
        (*key, *[totals[(*key, label)] for label in EMAIL_COUNTERS],
         unique[(*key, "Open")], unique[(*key, "Click")])
        for key in {r[:3] for r in spread}
    ]
    assert rows(found) == sorted(want, key=str)


@pytest.mark.parametrize("how, count", [("left_semi", 200), ("inner", 200), ("left", 1000)])
def test_join_few_gives_the_same_rows_either_way(spark, monkeypatch, how, count):
    # Ten identical rows each: copies are dealt to different parts, none is lost.
    big = spark.range(1000).select((F.col("id") % 10).alias("k"), F.floor(F.col("id") / 100).alias("v"))
    small = spark.createDataFrame([(1, "a"), (3, "b")], "k bigint, w string")
    few = rows(sizing.join_few(big, small, ["k"], how))
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 1)
    many = sizing.join_few(big, small, ["k"], how)
    assert rows(many) == few and len(few) == count


@pytest.mark.parametrize("how", ["left_semi", "inner", "left"])
def test_only_hot_keys_of_a_long_list_are_copied(spark, monkeypatch, how):
    # Key 1 and NULL are hot; keys 3 and 5 have one row each, key 7 none.
    big = spark.range(1002).selectExpr("CASE WHEN id = 3 OR id = 5 THEN id WHEN id % 2 = 0 THEN 1L END AS k", "id % 4 AS v")
    small = spark.createDataFrame([(1, "a"), (3, "b"), (3, "c"), (7, "d"), (None, "e")], "k bigint, w string")
    few = rows(sizing.join_few(big, small, ["k"], how))
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 1)
    monkeypatch.setattr(sizing, "HOT_ROWS", 100)
    assert rows(sizing.join_few(big, small, ["k"], how, count_keys=True)) == few and len(few) > 500


def test_all_rows(spark):
    names = ["Sent", "Delivered", "Open", "Unique_Open", "Unique_Click", "Bounce", "Dropped", "Unsubscribe", "Spam"]
    schema = "app_id bigint, message_id bigint, Domain string, " + ", ".join(f"{n} bigint" for n in names)
    data = [
        (1, 1, "gmail.com", 5, 4, 3, 2, 1, 0, 0, 0, 1),
        (1, 1, "Other", 1, 0, 0, 0, 0, 1, 0, 0, 0),
        (1, 2, "Other", 2, 0, 0, 0, 0, 2, 0, 0, 0),
        (1, 3, "Other", 1, 1, 0, 0, 0, 0, 0, 0, 0),
    ]
    found = with_all_rows(spark.createDataFrame(data, schema))
    every = rows(found.select("app_id", "message_id", "Domain", *names))
    # Message 2 had nothing delivered; message 3, the last one, has its row too.
    assert every == sorted(data + [
        (1, 1, "All", 6, 4, 3, 2, 1, 1, 0, 0, 1),
        (1, 3, "All", 1, 1, 0, 0, 0, 0, 0, 0, 0),
    ], key=str)


def test_message_events_without_time(spark):
    df = spark.createDataFrame([(1, [([(".m4500000000000001", None)],)])], f"app_id bigint, {STATES}")
    narrow = df.select("app_id", F.expr("transform(states, s -> struct(transform(s.events, e -> struct(e.name)) AS events))").alias("states"))
    assert message_events(narrow).columns == ["app_id", "message_id", "label"]
    assert rows(message_events(narrow)) == [(1, 4500000000000001, "Sent")]
