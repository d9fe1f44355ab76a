"""The stored day counters against one pass over all sessions."""

from __future__ import annotations

import datetime as dt

import pytest

import scenario as s
from sendstats.operators import sizing
from sendstats.plans.daystate import refresh, state_path, stored_domain_report
from sendstats.plans.domain import domain_report
from sendstats.plans.inputs import read_inputs
from sendstats.sources.committed import delete, visible
from sendstats.sources.schemas import SESSIONS, SNAPSHOTS

DAY2, LAST = dt.date(2024, 3, 2), s.DAY2


@pytest.fixture
def world(spark, tmp_path):
    root = s.write(spark, str(tmp_path / "world"))
    add(spark, root, DAY2, [
        # After midnight of the first day: one open that the third day has too, one that no day has, and one twice.
        session(1, s.at(LAST, 60), "one@gmail.com"), session(7, s.at(LAST, 60), "g@qq.com"), session(7, s.at(LAST, 61), "g@qq.com"),
        session(8, s.at(s.DAY1, 60), None), session(9, s.at(DAY2, 60), "h@qq.com"), session(2, s.at(s.AFTER, 60), "x@qq.com"),
    ])
    return root


def session(user, time, email, app=1):
    return (user, app, [([s.event(s.MAIL, "Open", time), s.event(s.MAIL, "", time)],)], ["x", email], [], DAY2)


def add(spark, root, day, rows):
    kept = [(*r[:-1], day) for r in rows]
    spark.createDataFrame(kept, SESSIONS["all"]).write.mode("append").partitionBy("dt").parquet(f"{root}/sessions")


def both(spark, root, **scope):
    inputs = read_inputs(spark, root, "domain")
    stored = stored_domain_report(spark, root, inputs, s.START, s.END, **scope)
    plain = domain_report(inputs, s.START, s.END, **scope)
    key = lambda r: str(tuple(r))
    return sorted(stored.collect(), key=key), sorted(plain.collect(), key=key), stored


def built(spark, root):
    return refresh(spark, root, read_inputs(spark, root, "domain"), s.START, s.END)


def test_equal_with_none_some_and_all_days_stored(spark, world):
    left, right, stored = both(spark, world)
    assert left == right and left
    refresh(spark, world, read_inputs(spark, world, "domain"), s.DAY1, s.DAY1)
    left, right, stored = both(spark, world)
    assert left == right and scans(stored) == 1
    assert built(spark, world) == [DAY2, LAST] and built(spark, world) == []
    left, right, stored = both(spark, world)
    assert left == right and scans(stored) == 0
    assert max(r.Unique_Open for r in left) > 3
    for scope in ({"app_id": 1}, {"company_id": 50}, {"app_id": 2}):
        left, right, _ = both(spark, world, **scope)
        assert left == right and left


def scans(df) -> int:
    return int(any("/sessions/" in file for file in df.inputFiles()))


def test_a_changed_day_is_replaced_alone(spark, world):
    built(spark, world)
    before = visible(spark, state_path(world))
    add(spark, world, LAST, [session(7, s.at(LAST, 60), "g@qq.com"), session(10, s.at(LAST, 60), "new@qq.com")])
    assert built(spark, world) == [LAST]
    after = visible(spark, state_path(world))
    assert [d for d in after if after[d] != before[d]] == [LAST]
    left, right, stored = both(spark, world)
    assert left == right and scans(stored) == 0


def test_a_moved_email_attribute_builds_the_days_of_its_app(spark, world):
    built(spark, world)
    row = ((1,), (50,), "Shop live", "new@shop.example", "first", ["first", "mail"], None, dt.date(2024, 3, 10))
    other = ((2,), (51,), "Games", "d2@games.example", "mail", ["first", "mail"], None, dt.date(2024, 3, 10))
    spark.createDataFrame([row, other], SNAPSHOTS["App"]).write.mode("append").partitionBy("dt").parquet(f"{world}/App")
    assert built(spark, world) == [s.DAY1, DAY2, LAST]
    left, right, _ = both(spark, world)
    assert left == right


def test_long_lists_are_joined_by_a_shuffle(spark, world, monkeypatch):
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", -1)
    built(spark, world)
    left, right, _ = both(spark, world)
    assert left == right


def test_a_day_that_is_gone(spark, world):
    built(spark, world)
    delete(spark, f"{world}/sessions/dt={DAY2}")
    assert built(spark, world) == [] and DAY2 not in visible(spark, state_path(world))
    left, right, _ = both(spark, world)
    assert left == right
