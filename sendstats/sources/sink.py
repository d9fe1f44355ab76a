"""Writing reports as CSV, one folder per app."""

from __future__ import annotations

import uuid
from itertools import islice
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sendstats.functions.rates import percent_text
from sendstats.sources.committed import delete, file_system
from sendstats.sources.localfiles import local_path, read_lines, write_lines
from sendstats.sources.scans import as_day

# File name parts and CSV header per report.
NAMES = {
    "domain": ("EmailData", "_domain"),
    "subject": ("EmailData", "_subject"),
    "push": ("PushData", ""),
}
HEADERS = {
    "domain": (
        "MessageName", "SenderDomain", "Domain", "StartDate", "Sent",
        "Delivered", "Delivered_PCT", "Open", "Open_PCT",
        "Unique_Open", "Unique_Open_PCT", "Unique_Click", "Unique_Click_PCT",
        "Bounce", "Bounce_PCT", "Dropped", "Unsubscribe", "Spam", "Spam_PCT",
        "Type", "Category", "MessageLink",
    ),
    "subject": (
        "Subject", "StartDate", "Sent", "Delivered", "Delivered_PCT",
        "Open", "Open_PCT", "Unique_Open", "Unique_Open_PCT",
        "Unique_Click", "Unique_Click_PCT", "Bounce", "Bounce_PCT",
        "Dropped", "Unsubscribe", "Spam", "Spam_PCT", "Category", "MessageLink",
    ),
    "push": (
        "MessageName", "StartDate", "Sent", "Open", "Open_PCT", "Held Back",
        "Bounce", "Bounce_PCT", "MessageLink",
    ),
}
# Columns whose CSV heading is not their name.
RENAMED = {"Held_Back": "Held Back"}
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

# Folders that are removed at the same time, and those that are held at once.
REMOVERS, REMOVED_AT_ONCE = 8, 10_000


def csv_view(report: DataFrame, kind: str, start, end) -> DataFrame:
    """The report as it is written: percentages as text, the headings of the
    file, and the two folder columns ``app_id`` and ``report``."""
    head, tail = NAMES[kind]
    window = f"{as_day(start):%Y%m%d}_{as_day(end):%Y%m%d}"
    name = F.concat(F.lit(f"{head}_"), F.col("App"), F.lit(f"_{window}{tail}"))
    source = {new: old for old, new in RENAMED.items()}
    shown = []
    for column in HEADERS[kind]:
        value = F.col(source.get(column, column))
        shown.append((percent_text(value) if column.endswith("_PCT") else value).alias(column))
    return report.select("message_id", "app_id", name.alias("report"), *shown)


def write_report(
    report: DataFrame, kind: str, start, end, path: str, covered: DataFrame | None = None
) -> None:
    """Write ``<path>/app_id=.../report=.../*.csv``, in order of messages.

    Rows are partitioned by ranges of app and order, so that an app too large for one task
    has several parts, whose names put them in order. Other reports in the same folder stay.

    A manifest below ``<path>/_manifest`` lists the folders of each kind of report and window.
    A rerun replaces its own files, and removes what the manifest lists of the apps in
    ``covered`` (app_id; all apps without it) and the rerun has no rows for: an app without
    rows, or one that has another name by now. Folders are listed before they are written
    and until they are removed, so that a rerun after a failure finds them. The first report of
    a window has nothing to replace and is appended: its commit moves each app's folder once.
    """
    spark = report.sparkSession
    view = csv_view(report, kind, start, end)
    # The rows are few next to what they are counted from: written once, read for listing and files.
    staged = f"{path}/_rows-{uuid.uuid4().hex}"
    view.write.parquet(staged)
    rows = spark.read.schema(view.schema).parquet(staged)
    folder = ["app_id", "report"]
    order = ["message_id"]
    if "Domain" in view.columns:
        order += [F.col("Domain") == "All", "Domain"]
    elif "Subject" in view.columns:
        order += ["Subject"]
    manifest = Manifest(spark, path, kind, start, end)
    first = not manifest.versions() and not _written(spark, path, kind, start, end)
    listed = rows.select(*folder).distinct()
    manifest.write(manifest.read().unionByName(listed).distinct())
    ranged = rows.repartitionByRange(*folder, *order).sortWithinPartitions(*folder, *order)
    _write_files(ranged.drop("message_id"), folder, path, "append" if first else "overwrite")
    if not first:
        known = manifest.read()
        mine = known if covered is None else known.join(covered.select("app_id").distinct(), "app_id", "left_semi")
        gone = mine.join(listed, folder, "left_anti").select(*folder)
        if _remove(spark, path, gone):
            manifest.write(known.join(gone, folder, "left_anti"))
    delete(spark, staged)


def _write_files(rows: DataFrame, folder: list[str], path: str, mode: str) -> None:
    """Write the CSV files of ``rows``, which are in order of their ``folder`` columns."""
    local = local_path(rows.sparkSession, path)
    if local is None:
        writer = rows.write.mode(mode).option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*folder).options(**CSV_OPTIONS).csv(path)
        return
    columns = [c for c in rows.columns if c not in folder]
    line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in columns]), CSV_OPTIONS)
    # The headings need no quotes.
    write_lines(rows.select(*folder, line.alias("line")), local, mode, ",".join(columns))


def _written(spark: SparkSession, path: str, kind: str, start, end) -> bool:
    """Whether there is any folder named as those of the report, listed or not."""
    head, tail = NAMES[kind]
    named = f"{head}_*_{as_day(start):%Y%m%d}_{as_day(end):%Y%m%d}{tail}"
    mine = f"{path}/app_id=*/report={{{named},__HIVE_DEFAULT_PARTITION__}}"
    return bool(file_system(spark, path).globStatus(spark._jvm.org.apache.hadoop.fs.Path(mine)))


def _remove(spark: SparkSession, path: str, folders: DataFrame) -> int:
    """Remove the ``folders`` (app_id, report) as they come in, some at a time; how many there were."""
    # Looked up once: to find a class by its name takes longer than to remove a folder.
    fs, at, escape = file_system(spark, path), spark._jvm.org.apache.hadoop.fs.Path, _escape(spark)

    def drop(row) -> None:
        fs.delete(at(f"{path}/app_id={row.app_id}/report={escape(row.report)}"), True)

    count, rows = 0, folders.toLocalIterator()
    with ThreadPool(REMOVERS) as pool:
        while batch := list(islice(rows, REMOVED_AT_ONCE)):
            pool.map(drop, batch)
            count += len(batch)
    return count


def read_report(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The written reports of one kind, as text. The columns are given: else Spark lists all files again for the header of one."""
    schema, folders = ", ".join(f"`{c}` string" for c in HEADERS[kind]), "app_id bigint, report string"
    local = local_path(spark, path)
    if local is None:
        return spark.read.schema(f"{schema}, {folders}").options(**CSV_OPTIONS).csv(path)
    lines = read_lines(spark, local, folders)
    return lines.select(F.from_csv("line", schema, CSV_OPTIONS).alias("row"), "app_id", "report").select("row.*", "app_id", "report")


def _escape(spark: SparkSession):
    """The function that gives a partition value as it stands in a folder's name."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName


class Manifest:
    """The folders (app_id, report) of one kind of report and window, in numbered versions of which the last counts."""

    SCHEMA = "app_id bigint, report string"

    def __init__(self, spark: SparkSession, path: str, kind: str, start, end):
        self.spark = spark
        self.path = f"{path}/_manifest/{kind}_{as_day(start):%Y%m%d}_{as_day(end):%Y%m%d}"

    def versions(self) -> list[int]:
        """Those that were written to their end."""
        fs, path = file_system(self.spark, self.path), self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted(int(e.getPath().getParent().getName()) for e in fs.globStatus(path(f"{self.path}/*/_SUCCESS")) or [])

    def read(self) -> DataFrame:
        there = self.versions()
        if not there:
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(f"{self.path}/{there[-1]}")

    def write(self, rows: DataFrame) -> None:
        there = self.versions()
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{there[-1] + 1 if there else 1}")
        for old in there:
            delete(self.spark, f"{self.path}/{old}")
