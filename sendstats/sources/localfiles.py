"""Text files in partition folders on a disk that all machines see as a local one.

Without its native library Hadoop sets the mode of every new folder and file on such a disk by a process
of its own, four for a folder with one file. Here the tasks write files by themselves, in folders and with names
as of Spark's writer. A task writes to a folder of its own below ``<path>/_files-...`` and renames it when it is
done; what is there by the end of the job is moved, so that nothing is visible before and a repeated task adds nothing.
Spark's reader takes longer to list and set up many small files than to read them: tasks get lists of them here.
"""

from __future__ import annotations

import os
import re
import shutil
import sys
import uuid
from collections.abc import Callable, Iterator
from itertools import groupby, islice

from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructType

# Nothing of this package is imported here: workers get this module with the job, and need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
# Top folders to a task that reads, and lines that are handed on at once.
TASK_FOLDERS, BATCH_LINES = 500, 10_000
# What Java trims off.
BLANK = "".join(map(chr, range(33)))


def local_path(spark: SparkSession, path: str) -> str | None:
    """Where ``path`` lies, if that is on a local disk."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.makeQualified(at).toUri().getPath() if fs.getScheme() == "file" else None


def write_lines(lines: DataFrame, path: str, mode: str, header: str) -> None:
    """Write ``lines``, of which the last column is a line of text and the others make the folders.

    Each task starts a new file with the ``header`` where the folder changes, so rows of a folder have to
    follow each other. With the mode ``overwrite`` the files of each folder that gets rows are replaced, as by
    Spark's dynamic overwriting of partitions; with ``append`` they stay. ``path`` is that of ``local_path``.
    """
    names = lines.sparkSession._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    escaped = "".join(c for c in map(chr, range(128)) if names.needsEscaping(c))
    *folders, _ = lines.columns
    job = uuid.uuid4().hex
    staged = f"{path}/_files-{job}"
    os.makedirs(staged)
    try:
        # The tasks write; what they tell goes nowhere.
        done = lines.mapInArrow(_writer(staged, job, folders, header, escaped), "files bigint")
        done.write.format("noop").mode(mode).save()
        tasks = [f"{staged}/{name}" for name in os.listdir(staged) if name.startswith("task-")]
        if mode == "overwrite":
            for task in tasks:
                for folder in _folders(task, "", len(folders)):
                    if os.path.isdir(f"{path}{folder}"):
                        shutil.rmtree(f"{path}{folder}")
        for task in tasks:
            _move(task, path)
    finally:
        shutil.rmtree(staged, ignore_errors=True)
    open(f"{path}/_SUCCESS", "w").close()


def read_lines(spark: SparkSession, path: str, folders: str) -> DataFrame:
    """The lines of all files as ``line``, without headers and blank ones, and the ``folders``, columns of text or bigint.

    The names of the top folders are listed here, and what they hold by tasks.
    """
    schema = StructType.fromDDL(f"{folders}, line string")
    columns = schema.fieldNames()[:-1]
    with os.scandir(path) as entries:
        tops = [(entry.name,) for entry in entries if entry.name.startswith(f"{columns[0]}=")]
    listed = spark.createDataFrame(tops, "file string", verifySchema=False).mapInArrow(_lister(path, columns), "file string")
    # The files of one folder may be many: they are dealt one by one.
    tasks = max(spark.sparkContext.defaultParallelism, -(-len(tops) // TASK_FOLDERS))
    return listed.repartition(tasks).mapInArrow(_reader(path, schema, BATCH_LINES), schema)


def _writer(staged: str, job: str, folders: list[str], header: str, escaped: str) -> Callable:
    def named(values: tuple) -> str:
        def text(value) -> str:
            # Spark takes an empty text for none, too.
            if value is None or value == "":
                return NULL_FOLDER
            return "".join(f"%{ord(c):02X}" if c in escaped else c for c in str(value))

        return "/".join(f"{name}={text(value)}" for name, value in zip(folders, values))

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        task = TaskContext.get()
        root = f"{staged}/attempt-{task.taskAttemptId()}"
        # Fails if the job is over.
        os.mkdir(root)
        name, now, out, files = f"part-{task.partitionId():05d}-{job}.csv", None, None, 0
        try:
            for batch in batches:
                for values, rows in groupby(zip(*(c.to_pylist() for c in batch.columns)), key=lambda row: row[:-1]):
                    if out is None or values != now:
                        if out is not None:
                            out.close()
                        folder, now = f"{root}/{named(values)}", values
                        os.makedirs(folder, exist_ok=True)
                        # A folder that comes again is gone on with.
                        out = open(f"{folder}/{name}", "a", encoding="utf-8", newline="")
                        if not out.tell():
                            out.write(header + "\n")
                            files += 1
                    out.writelines(row[-1] + "\n" for row in rows)
        finally:
            if out is not None:
                out.close()
        finished = f"{staged}/task-{task.partitionId():05d}"
        try:
            os.rename(root, finished)
        except OSError:
            if not os.path.isdir(finished):
                raise
            # Another attempt was first; it has the same rows.
            shutil.rmtree(root)
        yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], ["files"])

    return write


def _lister(path: str, columns: list[str]) -> Callable:
    def below(folder: str, levels: list[str]) -> Iterator[str]:
        for name in os.listdir(f"{path}/{folder}"):
            if name.startswith(("_", ".")):
                continue
            if not levels:
                yield f"{folder}/{name}"
            elif name.startswith(f"{levels[0]}="):
                yield from below(f"{folder}/{name}", levels[1:])

    def found(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            files = [file for top in batch.column(0).to_pylist() for file in below(top, columns[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(files, pa.string())], ["file"])

    return found


def _reader(path: str, schema: StructType, at_once: int) -> Callable:
    kinds = [field.dataType for field in schema.fields[:-1]]

    def value(name: str, kind):
        if name == NULL_FOLDER:
            return None
        text = re.sub("%([0-9A-Fa-f]{2})", lambda code: chr(int(code[1], 16)), name)
        return int(text) if kind == LongType() else text

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        types = [pa.int64() if kind == LongType() else pa.string() for kind in kinds] + [pa.string()]
        columns: list[list] = [[] for _ in types]

        def batch():
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], schema.fieldNames())
            for column in columns:
                column.clear()
            return made

        for given in batches:
            for file in given.column(0).to_pylist():
                values = [value(name.partition("=")[2], kind) for name, kind in zip(file.split("/"), kinds)]
                # Lines end as those of Spark's reader, which takes broken characters, too.
                with open(f"{path}/{file}", encoding="utf-8", errors="replace") as text:
                    lines = (line.rstrip("\n") for line in text if line.strip(BLANK))
                    next(lines, None)
                    while some := list(islice(lines, at_once)):
                        for column, same in zip(columns, values):
                            column.extend([same] * len(some))
                        columns[-1].extend(some)
                        if len(columns[-1]) >= at_once:
                            yield batch()
        if columns[-1]:
            yield batch()

    return rows


def _folders(root: str, below: str, depth: int) -> Iterator[str]:
    """The folders ``depth`` levels below ``root``, from there on."""
    if not depth:
        yield below
        return
    for name in os.listdir(f"{root}{below}"):
        yield from _folders(root, f"{below}/{name}", depth - 1)


def _move(source: str, target: str) -> None:
    """Move what is in ``source`` to ``target``: a folder as a whole, where there is none of its name with anything in it."""
    for name in os.listdir(source):
        there = f"{target}/{name}"
        try:
            os.rename(f"{source}/{name}", there)
        except OSError:
            if not os.path.isdir(there):
                raise
            _move(f"{source}/{name}", there)
