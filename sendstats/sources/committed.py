"""Day-partitioned tables whose days become visible by one marker.

Layout: ``<path>/load=<id>/dt=<day>/*.parquet`` and ``<path>/_commits/<number>.json``. A load
first writes all its days; the marker file that lists them then makes them visible, all at
once. Of a day that is listed several times the last marker counts, so that a day can be
replaced or dropped alone. Marker files are created under the next free number, which only
one of two writers gets; the other one looks again at what there is by then.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LOG = "_commits"


@dataclass(frozen=True)
class Day:
    """Where a visible day lies (None: no row), and what its writer noted."""

    folder: str | None
    note: str | None = None


def file_system(spark: SparkSession, path: str):
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf)


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(spark._jvm.org.apache.hadoop.fs.Path(path))


def delete(spark: SparkSession, path: str) -> None:
    file_system(spark, path).delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)


def is_committed(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/{LOG}")


def _markers(spark: SparkSession, path: str) -> list[tuple[int, dict]]:
    """The markers in order. One that was cut off while it was written lists nothing."""
    if not is_committed(spark, path):
        return []
    found = []
    files = spark.read.text(f"{path}/{LOG}", wholetext=True).select("value", F.col("_metadata.file_name").alias("name"))
    for row in files.collect():
        try:
            entries = json.loads(row.value)
        except ValueError:
            entries = {}
        found.append((int(row.name.removesuffix(".json")), entries))
    return sorted(found, key=lambda marker: marker[0])


def visible(spark: SparkSession, path: str) -> dict[dt.date, Day]:
    """The days that can be read."""
    days: dict[dt.date, Day] = {}
    for _, entries in _markers(spark, path):
        for text, entry in entries.items():
            day = dt.date.fromisoformat(text)
            if entry is None:
                days.pop(day, None)
            else:
                days[day] = Day(entry["folder"], entry["note"])
    return days


def stage(df: DataFrame, path: str, days: Iterable[dt.date], notes: dict[dt.date, str] | None = None) -> dict[dt.date, Day]:
    """Write the rows of ``df`` by their day ``dt``; nothing is visible yet."""
    spark, name = df.sparkSession, f"load={uuid.uuid4().hex}"
    df.write.partitionBy("dt").parquet(f"{path}/{name}")
    staged = {}
    for day in days:
        folder = f"{name}/dt={day}"
        staged[day] = Day(folder if exists(spark, f"{path}/{folder}") else None, (notes or {}).get(day))
    return staged


def commit(spark: SparkSession, path: str, days: dict[dt.date, Day | None], replace: bool) -> list[dt.date]:
    """Make staged days visible by one marker, or drop those that are None; the days this took effect for.

    Without ``replace``, a day that is visible by then stays as it is.
    """
    number = max([n for n, _ in _markers(spark, path)], default=0) + 1
    while True:
        there = visible(spark, path)
        mine = {day: entry for day, entry in days.items() if replace or day not in there}
        if not mine:
            return []
        entries = {str(day): entry and {"folder": entry.folder, "note": entry.note} for day, entry in mine.items()}
        if _create(spark, f"{path}/{LOG}/{number:012d}.json", json.dumps(entries)):
            return sorted(mine)
        number += 1


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file that must not be there yet."""
    fs, target = file_system(spark, path), spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        out = fs.create(target, False)
    except Py4JJavaError as failure:
        if fs.exists(target):
            return False
        raise failure
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_committed(spark: SparkSession, path: str, schema: StructType, days: Iterable[dt.date] | None = None) -> DataFrame:
    """The rows of the visible days, or of those among ``days``."""
    there = visible(spark, path)
    wanted = there if days is None else [day for day in days if day in there]
    folders = [there[day].folder for day in wanted if there[day].folder]
    # Days that were stored before the table had markers lie one level higher.
    parts = [[f"{path}/{f}" for f in folders if f.startswith("load=") == loaded] for loaded in (True, False)]
    found = [
        spark.read.schema(schema).option("basePath", path).parquet(*part).select(*schema.fieldNames()) for part in parts if part
    ]
    if not found:
        return spark.createDataFrame([], schema)
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])
