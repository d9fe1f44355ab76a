"""Reports on a local disk are written and read by the tasks, in the same form as by Spark."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import scenario as s
from sendstats.sources import localfiles, sink

WINDOW = (s.START, s.END)
COLUMNS = (
    "App string, app_id bigint, message_id bigint, MessageName string, StartDate string, Sent bigint, Open bigint, "
    "Open_PCT double, Held_Back bigint, Bounce bigint, Bounce_PCT double, MessageLink string"
)
ODD = ["a,b", 'say "x"', "", None, " edge ", "two\nlines", "cr\rhere", "back\\slash", '\\"', "#1", "Zoë ☃ 😀", "\x7f", "tab\t", "'"]


def odd_rows(spark):
    """Odd texts, and apps with odd, equal and missing names."""
    names = ["Shop: 1/2", "a=b%c", "Zoë ☃", None, "", "plain", "plain", "[x]^{y}?*#'\"\\", "\x01\x7f", "%41"]
    rows = [
        (name, app, i, text, text, i, None, 0.5, 0, 0, 0.0, "x")
        for app, name in enumerate(names) for i, text in enumerate(ODD)
    ]
    return spark.createDataFrame(rows, COLUMNS).repartition(5)


def by_spark(monkeypatch):
    monkeypatch.setattr(sink, "local_path", lambda spark, path: None)


def files(path):
    """The bytes of each folder, in order of the parts."""
    found = {}
    for file in sorted(path.glob("app_id=*/report=*/*.csv")):
        found.setdefault(str(file.parent.relative_to(path)), []).append(file.read_bytes())
    return found


def rows(df):
    return sorted(map(str, df.collect()))


def test_hadoop_starts_no_process_for_a_folder(spark, tmp_path):
    """The sums that Hadoop writes beside each file would cost a process like the file and its folders."""
    sink.write_report(odd_rows(spark), "push", *WINDOW, str(tmp_path))
    assert len(files(tmp_path)) == 10
    assert not list(tmp_path.glob("app_id=*/report=*/.*"))
    assert (tmp_path / "_SUCCESS").exists() and not list(tmp_path.glob("_files*"))


@pytest.mark.parametrize("batch", [3, 10_000])
def test_files_and_rows_are_those_of_spark(spark, tmp_path, monkeypatch, batch):
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own, plain = tmp_path / "own", tmp_path / "spark"
    monkeypatch.setattr("sendstats.sources.localfiles.BATCH_LINES", batch)
    spark.conf.set(conf, batch)
    try:
        sink.write_report(odd_rows(spark), "push", *WINDOW, str(own))
        read = {at: sink.read_report(spark, str(at), "push") for at in (own,)}
        mine = rows(read[own])
        with monkeypatch.context() as patch:
            by_spark(patch)
            sink.write_report(odd_rows(spark), "push", *WINDOW, str(plain))
            theirs = [sink.read_report(spark, str(at), "push") for at in (plain, own)]
            assert [rows(df) for df in theirs] == [mine, mine]
            assert theirs[0].dtypes == read[own].dtypes
        assert rows(sink.read_report(spark, str(plain), "push")) == mine
    finally:
        spark.conf.unset(conf)
    assert files(own) == files(plain)


def test_a_folder_in_several_tasks(spark, tmp_path):
    """A rerun replaces the folder once, not with each task's part."""
    report = odd_rows(spark).where("app_id = 0").crossJoin(spark.range(300).toDF("n")).withColumn("message_id", F.col("n") * 100 + F.col("message_id")).drop("n")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for _ in range(2):
            sink.write_report(report, "push", *WINDOW, str(tmp_path))
            (parts,) = files(tmp_path).values()
            assert len(parts) > 1 and sum(part.count(b",x\n") for part in parts) == 300 * len(ODD)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_failed_write_leaves_the_files_as_they_were(spark, tmp_path):
    lines = spark.range(40).select((F.col("id") % 4).alias("app_id"), F.lit("r").alias("report"), F.col("id").cast("string").alias("line"))
    ordered = lines.repartition(4, "app_id").sortWithinPartitions("app_id")
    sink.write_lines(ordered, str(tmp_path), "overwrite", "h")
    before = files(tmp_path)
    bad = ordered.withColumn("line", F.when(F.col("line") == "39", F.raise_error(F.lit("broken"))).otherwise("new"))
    with pytest.raises(Exception, match="broken"):
        sink.write_lines(bad, str(tmp_path), "overwrite", "h")
    assert files(tmp_path) == before and not list(tmp_path.glob("_files*"))
    # What a crash has left is not read.
    (tmp_path / "_files-x" / "0" / "app_id=9" / "report=r").mkdir(parents=True)
    (tmp_path / "_files-x" / "0" / "app_id=9" / "report=r" / "part-0.csv").write_text("h\n1\n")
    read = sink.read_lines(spark, str(tmp_path), "app_id bigint, report string")
    assert read.count() == 40 and {r.app_id for r in read.collect()} == {0, 1, 2, 3}


def test_the_files_of_one_folder_are_read_by_several_tasks(spark, tmp_path):
    folder = tmp_path / "app_id=1" / "report=r"
    folder.mkdir(parents=True)
    for part in range(80):
        (folder / f"part-{part}.csv").write_text("h\n" + "x\n" * 10)
    read = sink.read_lines(spark, str(tmp_path), "app_id bigint, report string")
    tasks = read.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in tasks) == 800 and max(r["count"] for r in tasks) < 400


def test_of_two_attempts_of_a_task_one_counts(spark, tmp_path):
    staged = tmp_path / "_files-x"
    (staged / "task-00000" / "app_id=0" / "report=r").mkdir(parents=True)
    (staged / "task-00000" / "app_id=0" / "report=r" / "part-00000-x.csv").write_text("h\nfirst\n")
    lines = spark.range(1).selectExpr("id AS app_id", "'r' AS report", "'again' AS line").coalesce(1)
    task = localfiles._writer(str(staged), "x", ["app_id", "report"], "h", "")
    assert lines.mapInArrow(task, "files bigint").collect() == [(1,)]
    assert [p.read_text() for p in staged.glob("**/*.csv")] == ["h\nfirst\n"]


def test_workers_need_not_have_the_package(tmp_path):
    """Another session, from another folder and without PYTHONPATH."""
    code = f"""
import sys; sys.path[:0] = [{os.getcwd()!r}, {os.path.dirname(__file__)!r}]
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
import test_localfiles as t
t.sink.write_report(t.odd_rows(spark).where("app_id < 3"), "push", *t.WINDOW, {str(tmp_path / "out")!r})
print("rows", t.sink.read_report(spark, {str(tmp_path / "out")!r}, "push").count())
spark.stop()
"""
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET", "SPARK_CONF_DIR")}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    # A line end in two columns of a row makes three lines of it.
    assert f"rows {3 * (len(ODD) + 4)}" in done.stdout, done.stderr[-2000:]
