"""Helpers shared by the text operators."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sendstats.sources.committed import delete

SPACE = "[ \\t-\\r]+"  # U+0020 and U+0009 to U+000D
SHINGLE = 5


_shipped: set[str] = set()
_recording: list[list[str]] = []


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Not needed where it is installed on all machines or named in PYTHONPATH.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="llm-package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share.

    It is ``spark.checkpoint.dir``; only a local session without one (tests)
    gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root}/llm-{name}-{uuid.uuid4().hex}"
    for tables in _recording:
        tables.append(path)
    return path


@contextmanager
def recorded() -> Iterator[list[str]]:
    """Lists the tables that are written while it is open, for ``discard``."""
    tables: list[str] = []
    _recording.append(tables)
    try:
        yield tables
    finally:
        _recording[:] = [t for t in _recording if t is not tables]


def discard(spark: SparkSession, tables: list[str], reader: DataFrame | None = None) -> None:
    """Delete tables that nothing reads any more; none of them if ``reader`` does."""
    if reader is not None:
        names = {path.rsplit("/", 1)[1] for path in tables}
        if any(names & set(file.split("/")) for file in reader.inputFiles()):
            return
    for path in tables:
        delete(spark, path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: cuts the lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tagged(docs: DataFrame) -> DataFrame:
    """(_row, _id) of every row of ``docs``: all its columns, and a number of its own that stays."""
    return materialize(docs.select(F.struct(*docs.columns).alias("_row")).withColumn("_id", F.monotonically_increasing_id()), "rows")


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column in such a way that it is worked out once per row.

    The optimizer may put a plain column's expression into each filter and lambda that uses
    it, where it is worked out again and again; it leaves generated columns alone.
    """
    return df.withColumn(name, F.explode_outer(F.array(value)))


def words_of(text: Column) -> Column:
    """The runs of characters other than white space; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def shingle_hashes(words: str, size: int = SHINGLE) -> Column:
    """64-bit hashes of all runs of ``size`` words of the array column ``words``, in order.

    Texts with fewer words have one shingle, of all their words; without words there is none.
    """
    gram = ", ".join(f"{words}[i + {k}]" for k in range(size))
    return F.expr(
        f"CASE WHEN size({words}) = 0 THEN CAST(array() AS array<bigint>) "
        f"WHEN size({words}) < {size} THEN array(xxhash64({words})) "
        f"ELSE transform(sequence(0, size({words}) - {size}), i -> xxhash64({gram})) END"
    )


def only(docs: DataFrame, *names: str) -> DataFrame:
    """The columns an operator reads, as any others may clash with those it adds."""
    return docs.select(*[F.col(n) for n in names])
