from __future__ import annotations

import csv
import datetime as dt
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import scenario as s
from sendstats.plans.runner import run_report
from sendstats.sources import ingest
from sendstats.sources.committed import Day, commit, stage, visible
from sendstats.sources.ingest import find_snapshot, ingest_snapshots, load_snapshots, remove_snapshots, snapshot_pattern
from sendstats.sources.scans import app_asof, read_snapshots, scan_sessions, scan_snapshots
from sendstats.sources.schemas import SNAPSHOTS
from sendstats.sources.sink import HEADERS, read_report, write_report
from verification import fixtures as fx


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    return s.write(spark, str(tmp_path_factory.mktemp("world")))


def lines(out: Path) -> dict[str, list[list[str]]]:
    """Rows per report folder, each starting with its header."""
    found = {}
    for file in sorted(out.glob("app_id=*/report=*/*.csv")):
        with file.open(newline="") as handle:
            found.setdefault(file.parent.name, []).extend(csv.reader(handle))
    return found


def test_scans_take_both_end_days_and_tolerate_missing_ones(spark, root):
    def days(start, end):
        return {str(r.dt) for r in scan_sessions(spark, f"{root}/sessions", start, end).select("dt").collect()}

    assert days("20240301", "20240303") == {"2024-03-01", "2024-03-03"}
    assert days("20240302", "20240308") == {"2024-03-03"}
    assert days("2024-03-04", dt.date(2024, 3, 8)) == set()
    study = scan_snapshots(spark, f"{root}/Study", "Study", s.START, s.END)
    # The eleven of the window's two days, and the message that is deleted later.
    assert study.where("name = 'Hello live'").count() == 0 and study.count() == 12
    assert [str(r.dt) for r in study.where(study.message_id == s.DELETED).select("dt").collect()] == ["2024-03-01"]
    assert {r.name for r in app_asof(spark, f"{root}/App", s.END).collect()} == {"Shop/EU", "Games"}


def test_naming_rules():
    assert snapshot_pattern("Study", dt.date(2018, 4, 26)) == ("backup_20180426", ".study.")
    assert snapshot_pattern("Study", dt.date(2018, 4, 27)) == ("20180427", "_study.")


def test_ingest(spark, tmp_path):
    src, dst = str(tmp_path / "in"), str(tmp_path / "out")
    schema = type(SNAPSHOTS["App"])([f for f in SNAPSHOTS["App"] if f.name != "dt"])

    def put(folder, file, name):
        row = ((1,), (50,), name, "d@x", "mail", ["mail"], None)
        spark.createDataFrame([row], schema).write.parquet(f"{src}/{folder}/{file}")

    put("backup_201804261200_x", "export.App.info", "old rule")
    put("20180427215301", "kind_app.metadata", "new rule")
    put("20180428000000", "kind.app.metadata", "old name, new day")
    put("20180429000000", "a_app.metadata", "twice")
    put("20180429120000", "b_App.metadata", "twice")
    put("20180430000000", "kind_appdata.metadata", "another model")
    window = ("20180425", "20180430")

    assert find_snapshot(spark, src, "App", dt.date(2018, 4, 29)) is None
    loaded = ingest_snapshots(spark, src, dst, *window)
    days = [dt.date(2018, 4, 26), dt.date(2018, 4, 27)]
    assert loaded == {"Study": [], "Experiment": [], "App": days}
    found = read_snapshots(spark, f"{dst}/App", "App").select("dt", "name").collect()
    assert sorted(tuple(r) for r in found) == list(zip(days, ["old rule", "new rule"]))

    # A loaded day is not loaded again; a new one is added.
    put("20180428000000", "kind_app.metadata", "third")
    assert ingest_snapshots(spark, src, dst, *window)["App"] == [dt.date(2018, 4, 28)]
    assert read_snapshots(spark, f"{dst}/App", "App").count() == 3

    remove_snapshots(spark, dst, "20180427", "20180428")
    assert [str(r.dt) for r in read_snapshots(spark, f"{dst}/App", "App").collect()] == ["2018-04-26"]


def test_domain_csv(spark, root, tmp_path):
    out = tmp_path / "reports"
    run_report(spark, root, "__A1", s.START, s.END, "d", str(out), as_of="20240310")
    files = lines(out)
    assert list(files) == ["report=EmailData_Shop live_20240301_20240303_domain"]
    header, *rows = next(iter(files.values()))
    assert tuple(header) == HEADERS["domain"]
    # By message, its All row last; quotes and commas survive; one space for no link.
    assert [r[2] for r in rows] == ["Other", "gmail.com", "All", "Other", "All", "qq.com"]
    name = 'Hello, "again" (me@here@new.example)'
    assert rows[2] == [
        name, "new.example", "All", "2024-03-01", "2", "1", "50.0%", "4", "400.%", "3", "300.%",
        "1", "100.%", "1", "50.0%", "0", "0", "0", "0.0%", "Triggered Server", "News", " ",
    ]


def test_push_and_subject_csv_by_company(spark, root, tmp_path):
    for kind in ("p", "s0", "s1"):
        run_report(spark, root, "50", s.START, s.END, kind, str(tmp_path / kind), as_of="20240310")
    push = lines(tmp_path / "p")
    assert push == {
        "report=PushData_Shop-EU_20240301_20240303": [
            list(HEADERS["push"]),
            ["ping 2", "2024-03-01", "3", "1", "33.3%", "1", "1", "33.3%",
             f"https://dashboard.example.com/dashboard?appId=1#/1/messaging/{s.PUSH}"],
        ]
    }
    subject = lines(tmp_path / "s0")["report=EmailData_Shop-EU_20240301_20240303_subject"]
    assert tuple(subject[0]) == HEADERS["subject"]
    assert [r[0] for r in subject[1:]] == ["Hi", "Hi 2", "B", "L", "U"]
    variants = lines(tmp_path / "s1")["report=EmailData_Shop-EU_20240301_20240303_subject"]
    assert [r[0] for r in variants[1:]] == ["Arm A --Variant 71", "Hi 2 --Variant 72", "B", "L", "U"]


def test_an_app_without_rows_writes_nothing(spark, root, tmp_path):
    run_report(spark, root, "51", s.START, s.END, "p", str(tmp_path / "p"), as_of="20240310")
    assert lines(tmp_path / "p") == {}


def test_runner_refuses_old_windows_and_unknown_reports(spark, root, tmp_path):
    with pytest.raises(ValueError):
        run_report(spark, root, "50", s.START, s.END, "p", str(tmp_path / "a"), as_of="20240601")
    with pytest.raises(KeyError):
        run_report(spark, root, "50", s.START, s.END, "x", str(tmp_path / "a"), as_of="20240310")


def test_reports_share_a_folder_and_a_rerun_replaces_its_own(spark, root, tmp_path):
    out = tmp_path / "reports"
    for kind in ("p", "s0", "d", "d"):
        run_report(spark, root, "50", s.START, s.END, kind, str(out), as_of="20240310")
    alone = tmp_path / "alone"
    run_report(spark, root, "50", s.START, s.END, "d", str(alone), as_of="20240310")
    found, one = lines(out), lines(alone)
    assert len(found) == 3 and one.items() <= found.items()


def test_a_report_on_all_apps(spark, root, tmp_path):
    for who in ("all", "50"):
        run_report(spark, root, who, s.START, s.END, "p", str(tmp_path / who), as_of="20240310")
    assert lines(tmp_path / "50").items() <= lines(tmp_path / "all").items()


def test_a_company_report_needs_the_apps_of_its_last_day(spark, root, tmp_path):
    with pytest.raises(ValueError, match="no App snapshot"):
        run_report(spark, root, "50", "20240301", "20240304", "p", str(tmp_path / "p"), as_of="20240310")


def test_snapshots_lie_at_any_depth_and_fail_alone(spark, tmp_path):
    src, dst = tmp_path / "in", str(tmp_path / "out")
    schema = type(SNAPSHOTS["App"])([f for f in SNAPSHOTS["App"] if f.name != "dt"])
    row = ((1,), (50,), "deep", "d@x", "mail", ["mail"], None)
    spark.createDataFrame([row], schema).write.parquet(f"{src}/20180427000000/space/kinds/all_app.metadata")
    spark.createDataFrame([row], schema).write.parquet(f"{src}/20180427000000/output/all_app.metadata")
    (src / "20180428000000").mkdir()
    (src / "20180428000000" / "all_app.metadata").write_text("no parquet")
    with pytest.warns(UserWarning, match="App of 2018-04-28"):
        loaded = ingest_snapshots(spark, str(src), dst, "20180427", "20180428", ["App"])
    assert loaded == {"App": [dt.date(2018, 4, 27)]}
    assert [r.name for r in read_snapshots(spark, f"{dst}/App", "App").collect()] == ["deep"]


def app_files(spark, src, days, name="loaded"):
    schema = type(SNAPSHOTS["App"])([f for f in SNAPSHOTS["App"] if f.name != "dt"])
    row = ((1,), (50,), name, "d@x", "mail", ["mail"], None)
    for day in days:
        spark.createDataFrame([row], schema).write.parquet(f"{src}/{day}000000/all_app.metadata")


def stored(spark, dst):
    return sorted((str(r.dt), r.name) for r in read_snapshots(spark, f"{dst}/App", "App").select("dt", "name").collect())


def test_a_load_that_breaks_shows_none_of_its_days(spark, tmp_path, monkeypatch):
    src, dst = str(tmp_path / "in"), str(tmp_path / "out")
    app_files(spark, src, ["20240501", "20240502", "20240503"])
    ingest_snapshots(spark, src, dst, "20240501", "20240501", ["App"])
    before = stored(spark, dst)

    def broken(*args, **kwargs):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        # All files are written, and the load ends before its marker.
        patch.setattr(ingest, "commit", broken)
        with pytest.raises(KeyboardInterrupt):
            ingest_snapshots(spark, src, dst, "20240501", "20240503", ["App"])
    assert stored(spark, dst) == before == [("2024-05-01", "loaded")]
    assert len(ingest_snapshots(spark, src, dst, "20240501", "20240503", ["App"])["App"]) == 2
    assert len(stored(spark, dst)) == 3


def test_of_two_loads_of_a_day_one_counts(spark, tmp_path):
    path = str(tmp_path / "out" / "App")
    day, other = dt.date(2024, 5, 1), dt.date(2024, 5, 2)
    def rows(name, *days):
        return spark.createDataFrame([((1,), (50,), name, "d@x", "mail", ["mail"], None, d) for d in days], SNAPSHOTS["App"])

    first, second = stage(rows("a", day), path, [day]), stage(rows("b", day, other), path, [day, other])
    assert commit(spark, path, second, replace=False) == [day, other]
    assert commit(spark, path, first, replace=False) == []
    assert stored(spark, str(tmp_path / "out")) == [("2024-05-01", "b"), ("2024-05-02", "b")]
    # Replacing and dropping touch one day only; a marker that was cut off counts for nothing.
    assert commit(spark, path, first, replace=True) == [day]
    assert commit(spark, path, {other: None}, replace=True) == [other]
    Path(path, "_commits", "000000000099.json").write_text('{"2024-05-09": {"fol')
    assert stored(spark, str(tmp_path / "out")) == [("2024-05-01", "a")]
    assert commit(spark, path, {other: Day(None, "empty")}, replace=False) == [other]
    assert visible(spark, path)[other] == Day(None, "empty") and len(stored(spark, str(tmp_path / "out"))) == 1


def test_days_stored_without_markers_stay(spark, tmp_path):
    src, dst = str(tmp_path / "in"), str(tmp_path / "out")
    row = ((1,), (50,), "plain", "d@x", "mail", ["mail"], None, dt.date(2024, 5, 1))
    spark.createDataFrame([row], SNAPSHOTS["App"]).write.partitionBy("dt").parquet(f"{dst}/App")
    assert stored(spark, dst) == [("2024-05-01", "plain")]
    app_files(spark, src, ["20240501", "20240502"])
    (tmp_path / "in" / "20240503000000").mkdir()
    (tmp_path / "in" / "20240503000000" / "all_app.metadata").write_text("no parquet")
    load = load_snapshots(spark, src, dst, "20240501", "20240503", ["App"])
    assert load.loaded == {"App": [dt.date(2024, 5, 2)]} and list(load.failed["App"]) == [dt.date(2024, 5, 3)]
    assert stored(spark, dst) == [("2024-05-01", "plain"), ("2024-05-02", "loaded")]


def push_rows(spark, app, n, name="Shop"):
    columns = "App string, app_id bigint, message_id bigint, MessageName string, StartDate string, Sent bigint, Open bigint, Open_PCT double, Held_Back bigint, Bounce bigint, Bounce_PCT double, MessageLink string"
    rows = [(name, app, i, f"m{i:06}", None, 1, 1, 0.5, 0, 0, 0.0, "x") for i in range(n)]
    return spark.createDataFrame(rows, columns).repartition(5)


def test_parts_of_a_large_app_are_in_order(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_report(push_rows(spark, 1, 4000).unionByName(push_rows(spark, 2, 3)), "push", s.START, s.END, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted(tmp_path.glob("app_id=1/report=*/*.csv"))
    names = [row[0] for part in parts for row in list(csv.reader(part.open(newline="")))[1:]]
    assert len(parts) > 1 and names == [f"m{i:06}" for i in range(4000)]


def test_a_rerun_removes_what_it_has_no_rows_for(spark, tmp_path):
    def files():
        return {(p.parent.parent.name, p.parent.name) for p in tmp_path.glob("app_id=*/report=*/*.csv")}

    def write(report, covered=None, window=(s.START, s.END)):
        ids = None if covered is None else spark.createDataFrame([(c,) for c in covered], "app_id bigint")
        write_report(report, "push", *window, str(tmp_path), ids)

    one, two, three = (push_rows(spark, app, 3, f"Shop: {app}") for app in (1, 2, 3))
    name = "report=PushData_Shop%3A {}_20240301_20240303"
    folder = lambda app: (f"app_id={app}", name.format(app))
    write(one.unionByName(two).unionByName(three))
    write(two, window=("20240301", "20240302"))
    other = ("app_id=2", "report=PushData_Shop%3A 2_20240301_20240302")
    assert files() == {folder(1), folder(2), folder(3), other}
    # The messages of app 2 are gone; app 3 is none of this run's apps.
    write(one, covered=[1, 2])
    assert files() == {folder(1), folder(3), other}
    # An app's new name replaces the old one, and no rows at all leave no file.
    write(push_rows(spark, 1, 3, "New"), covered=[1])
    assert files() == {("app_id=1", "report=PushData_New_20240301_20240303"), folder(3), other}
    write(one.limit(0))
    assert files() == {other}
    assert not list(tmp_path.glob("_rows*")) and len(list(tmp_path.glob("_manifest/*/*"))) == 2


def test_only_a_report_that_is_there_is_overwritten(spark, tmp_path, monkeypatch):
    modes = []
    writer = type(spark.range(1).write)
    plain = writer.mode
    monkeypatch.setattr(writer, "mode", lambda self, mode: (modes.extend([mode] if mode else []), plain(self, mode))[1])

    def write(report, window=(s.START, s.END)):
        modes.clear()
        write_report(report, "push", *window, str(tmp_path))
        read = read_report(spark, str(tmp_path), "push").groupBy("app_id").count().orderBy("app_id").collect()
        # The manifest is written before and, if folders were removed, after the files.
        return modes[1], [tuple(r) for r in read]

    one, two = push_rows(spark, 1, 3), push_rows(spark, 2, 4)
    assert write(one.unionByName(two)) == ("append", [(1, 3), (2, 4)])
    assert write(one.unionByName(two)) == ("overwrite", [(1, 3), (2, 4)])
    assert write(two, ("20240301", "20240302")) == ("append", [(1, 3), (2, 8)])
    # Files that no manifest lists are replaced, too.
    shutil.rmtree(tmp_path / "_manifest")
    assert write(one) == ("overwrite", [(1, 3), (2, 8)])
    assert write(one.limit(0)) == ("overwrite", [(2, 8)])


@pytest.mark.parametrize("name", ["raw_study", "raw_experiment", "raw_app"])
def test_a_task_stores_the_snapshots_of_few_rows(spark, tmp_path, monkeypatch, name):
    # One file of 400 parts or apps with up to four snapshots each, dealt to tasks of some 40.
    monkeypatch.setattr(fx, "TASK_ROWS", 40)
    ids = spark.range(400).selectExpr(
        "id AS p_partkey", "'x' AS p_name", "CAST(id % 50 AS int) AS p_size", "id AS s_suppkey", "'s#1' AS s_name", "CAST(id % 25 AS int) AS s_nationkey"
    ).coalesce(1)
    for table in ("part", "supplier"):
        ids.write.parquet(f"{tmp_path}/{table}.parquet")
    plain, dealt = (getattr(fx, name)(spark, str(tmp_path), dealt=d) for d in (False, True))
    assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
    largest = max(r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect())
    assert largest < plain.count() / 4
