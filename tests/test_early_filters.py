"""What is dropped before the first shuffle, skipped in files, or counted on the way."""

from __future__ import annotations

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import scenario as s
from sendstats.functions.events import EMAIL_COUNTERS
from sendstats.operators import counts, idfilter, sizing
from sendstats.operators.idfilter import probed
from sendstats.plans.domain import domain_report
from sendstats.plans.inputs import read_inputs
from sendstats.plans.push import push_report
from sendstats.plans.runner import run_report
from sendstats.plans.subject import subject_report
from sendstats.sources.layout import write_sessions
from sendstats.sources.scans import read_sessions

PAIR = ["app_id", "message_id"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def nodes(plan):
    """All nodes of a physical plan that has run, within adaptive stages as well."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from nodes(plan.executedPlan())
        return
    if kind.endswith("QueryStageExec"):
        yield from nodes(plan.plan())
        return
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


def metric(df, kind, name):
    """The metric ``name`` of each node of a kind, after ``df`` was collected."""
    found = [n for n in nodes(df._jdf.queryExecution().executedPlan()) if n.getClass().getSimpleName() == kind]
    return [n.metrics().apply(name).value() for n in found if n.metrics().contains(name)]


@pytest.mark.parametrize("buckets", [4_096, 1])
def test_a_bitmap_keeps_all_own_rows(spark, monkeypatch, buckets):
    monkeypatch.setattr(idfilter, "MAX_BUCKETS", buckets)
    ids = spark.range(0, 60_000, 3).select((F.col("id") % 7).alias("app_id"), F.col("id").alias("message_id"))
    all_rows = spark.range(60_000).select((F.col("id") % 7).alias("app_id"), F.col("id").alias("message_id"), F.lit("x").alias("text"))
    left = probed(all_rows, ids, PAIR)
    assert left.columns == all_rows.columns
    own = all_rows.where("message_id % 3 = 0")
    assert own.exceptAll(left).count() == 0
    foreign = left.where("message_id % 3 <> 0").count()
    # With 16 bits an id few foreign rows pass, with one and a half more.
    assert foreign < 40_000 / 10 if buckets > 1 else foreign < 40_000 / 2 + 1_000
    odd = spark.createDataFrame([(None, 3), (1, None), (None, None)], "app_id bigint, message_id bigint")
    assert probed(odd, ids, PAIR).join(ids, PAIR, "left_semi").count() == 0
    assert probed(all_rows, ids.limit(0), PAIR).count() == 0


def test_foreign_events_stay_out_of_the_first_shuffle(spark, monkeypatch):
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", -1)
    events = spark.range(100_000).select(
        F.lit(1).cast("bigint").alias("app_id"), F.col("id").alias("message_id"), F.lit("Sent").alias("label")
    )
    ids = events.where("message_id % 50 = 0").select(*PAIR)
    found = counts.counters_of_messages(events, ids, PAIR, EMAIL_COUNTERS)
    assert len(found.collect()) == 2_000
    written = metric(found, "ShuffleExchangeExec", "shuffleRecordsWritten")
    # The ids themselves, and the own events with a few others, twice.
    assert written and max(written) < 12_000


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clustered"))
    # App 0 has half of all sessions.
    made = spark.range(0, 40_000, 1, 8).selectExpr(
        "id * 7919 % 40000 AS user_id", "IF(id % 2 = 0, 0L, id % 40) AS app_id",
        "array(struct(array(struct(concat('.m45000000', lpad(id, 8, '0')) AS name, CAST(id AS double) AS time)) AS events)) AS states",
        "array('x', 'y') AS attrs", "array(struct(CAST(NULL AS bigint) AS variant)) AS experiments", "DATE '2024-03-01' + CAST(id % 2 AS int) AS dt",
    )
    write_sessions(made, path, files_per_day=4, row_group_bytes=1 << 16)
    return made, path


def test_clustered_sessions_skip_row_groups(spark, clustered):
    made, path = clustered
    assert rows(read_sessions(spark, path).groupBy("dt", "app_id").count()) == rows(made.groupBy("dt", "app_id").count())
    one = read_sessions(spark, path).where("app_id = 21").select("user_id")
    assert len(one.collect()) == 1_000
    assert 1_000 <= metric(one, "FileSourceScanExec", "numOutputRows")[0] < 10_000
    # The large app is spread over files by its users.
    files = read_sessions(spark, path).where("app_id = 0").groupBy(F.input_file_name()).count().collect()
    assert len(files) > 1 and max(r["count"] for r in files) < 15_000


def test_clustered_days_are_replaced_alone(spark, clustered, tmp_path):
    made, path = clustered[0].where("user_id < 500"), str(tmp_path / "sessions")
    write_sessions(made, path)
    write_sessions(made.where("dt = DATE '2024-03-02' AND user_id < 100"), path)
    left = read_sessions(spark, path).groupBy("dt").count()
    assert rows(left) == rows(made.where("dt = DATE '2024-03-01' OR user_id < 100").groupBy("dt").count())
    write_sessions(made.limit(0), str(tmp_path / "none"))


def causes_of(found, first, last):
    """The counts by cause, from the scenario's own rows."""
    names = [e for r in found if first <= r[5] <= last for state in r[2] for e in (state[0] or [])]
    out = {"events": len(names), "nameless": 0, "foreign": 0, "bad_ids": 0, "unknown_labels": 0}
    for name, _ in names:
        known = {"", *EMAIL_COUNTERS, "Held Back"}
        if not name.startswith(".m"):
            out["foreign"] += 1
        elif not name[2:18].isdigit():
            out["bad_ids"] += 1
        elif name[19:] not in known:
            out["unknown_labels"] += 1
    return {**out, "counted": out["events"] - sum(list(out.values())[1:])}


@pytest.mark.parametrize("report", [domain_report, subject_report, push_report])
def test_causes_are_counted_in_the_pass_of_the_report(spark, tmp_path, report):
    root = s.write(spark, str(tmp_path))
    extra = [s.session(1, 1, s.DAY1, [(".m4500000000000001 Forwarded", 1.0), (None, 1.0), (".mshort", 2.0), (".m4500000000000001 Open", 1e19)])]
    spark.createDataFrame(extra, s.SESSIONS["all"]).write.mode("append").partitionBy("dt").parquet(f"{root}/sessions")
    kind = {domain_report: "domain", subject_report: "subject", push_report: "push"}[report]
    plain_inputs, inputs = read_inputs(spark, root, kind), read_inputs(spark, root, kind)
    inputs.watch = Observation("events")
    found = report(inputs, s.START, s.END)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len([x for x in plan.splitlines() if "FileScan" in x and "states#" in x]) == 1
    assert rows(found) == rows(report(plain_inputs, s.START, s.END))
    got, expected = dict(inputs.watch.get), causes_of(s.sessions(), s.DAY1, s.DAY2)
    for cause, more in {"events": 4, "nameless": 1, "bad_ids": 1, "unknown_labels": 1, "counted": 1}.items():
        expected[cause] += more
    assert got.pop("bad_times", 1) == 1 and got == expected
    assert got["events"] == sum(n for cause, n in got.items() if cause != "events")


def test_the_runner_passes_the_watch_on(spark, tmp_path):
    root, watch = s.write(spark, str(tmp_path / "in")), Observation()
    run_report(spark, root, "all", s.START, s.END, "p", str(tmp_path / "out"), as_of="20240310", watch=watch)
    assert watch.get["events"] == causes_of(s.sessions(), s.DAY1, s.DAY2)["events"]
