"""What the physical plans look like over stored tables."""

from __future__ import annotations

import re

import pytest

import scenario as s
from sendstats.operators import sizing
from sendstats.operators.counts import collapsed
from sendstats.operators.nesting import with_variant_set
from sendstats.plans.domain import domain_report
from sendstats.plans.inputs import read_inputs
from sendstats.plans.push import push_report
from sendstats.plans.subject import ab_report, subject_report, variant_counters

REPORTS = {"domain": domain_report, "subject": subject_report, "ab": ab_report, "push": push_report}
EVENT = {
    "push": "states:array<struct<events:array<struct<name:string>>>>",
    "subject": "states:array<struct<events:array<struct<name:string,time:double>>>>",
}


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    return s.write(spark, str(tmp_path_factory.mktemp("world")))


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def session_scans(plan: str) -> list[str]:
    return [line for line in plan.splitlines() if "FileScan" in line and "/sessions]" in line]


@pytest.fixture
def wide(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    spark.conf.set("spark.sql.debug.maxToStringFields", "200")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    spark.conf.unset("spark.sql.debug.maxToStringFields")


@pytest.mark.parametrize("name", REPORTS)
def test_one_narrow_pruned_scan_of_the_sessions(spark, root, wide, name):
    plan = executed(REPORTS[name](read_inputs(spark, root, name), s.START, s.END))
    scans = session_scans(plan)
    assert len(scans) == 1
    partitions = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", scans[0]).group(1)
    assert "dt" in partitions and ">=" in partitions and "<=" in partitions
    read = re.search(r"ReadSchema: struct<(.*)", scans[0]).group(1)
    assert EVENT.get(name, EVENT["subject"]) in read
    assert ("attrs" in read) == (name == "domain")
    assert ("experiments" in read) == (name == "ab")
    assert ("user_id" in read) == (name != "push")


@pytest.mark.parametrize("name", REPORTS)
def test_no_python_no_cross_join_no_nested_loop(spark, root, name):
    plan = executed(REPORTS[name](read_inputs(spark, root, name), s.START, s.END))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas", "CollectLimit"):
        assert operator not in plan


def test_an_app_filter_reaches_the_scan(spark, root, wide):
    plan = executed(push_report(read_inputs(spark, root, "push"), s.START, s.END, app_id=1))
    assert "EqualTo(app_id,1)" in session_scans(plan)[0]


def test_ids_filter_the_events_before_the_first_shuffle(spark, root):
    plan = executed(subject_report(read_inputs(spark, root, "subject"), s.START, s.END))
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "/sessions]" in line)
    above = lines[:scan]
    last_semi = max(i for i, line in enumerate(above) if "BroadcastHashJoin" in line and "LeftSemi" in line)
    last_shuffle = max(i for i, line in enumerate(above) if "Exchange hashpartitioning" in line)
    assert last_shuffle < last_semi


def test_newest_rows_are_limited_before_their_shuffle(spark, root):
    plan = executed(domain_report(read_inputs(spark, root, "domain"), s.START, s.END))
    windows = sum("Window [row_number()" in line for line in plan.splitlines())
    limits = sum("WindowGroupLimit" in line and "Partial" in line for line in plan.splitlines())
    assert limits == windows > 0


def test_long_app_lists_are_joined_salted(spark, root, monkeypatch):
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", -1)
    plan = executed(domain_report(read_inputs(spark, root, "domain"), s.START, s.END))
    assert "monotonically_increasing_id" in plan
    assert len(session_scans(plan)) == 1


def test_variants_are_spread_after_the_first_shuffle(spark, root):
    plan = executed(ab_report(read_inputs(spark, root, "ab"), s.START, s.END))
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "/sessions]" in line)
    shuffles = [i for i, line in enumerate(lines[:scan]) if "Exchange hashpartitioning" in line]
    spread = [i for i, line in enumerate(lines[:scan]) if "Generate explode(concat(" in line]
    assert spread and max(spread) < max(shuffles)


def test_shuffled_events_do_not_grow_with_variants(spark):
    """Sets of one and of six variants: as many groups reach the first shuffle."""
    ids = spark.createDataFrame([(1, 5)], "app_id bigint, message_id bigint")
    pairs = spark.createDataFrame([(v, 5) for v in range(6)], "variant_id bigint, message_id bigint")
    for n in (1, 6):
        events = spark.range(1000).selectExpr(
            "1L AS app_id", "5L AS message_id", "if(id % 2 = 0, 'Open', 'Sent') AS label", "id % 10 AS user_id", "DATE'2024-01-01' AS day",
            f"transform(sequence(0, {n - 1}), v -> named_struct('variant', CAST(v AS BIGINT))) AS experiments",
        )
        sets = collapsed(with_variant_set(events), ["app_id", "message_id", "variants"], ["user_id", "day"])
        assert sets.count() == 6
        found = {r.variant_id: r for r in variant_counters(events, ids, pairs).collect()}
        assert set(found) == {None, *range(n)} and {r.Unique_Open for r in found.values()} == {5} and {r.Open for r in found.values()} == {500}
