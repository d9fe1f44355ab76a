"""The stored layout of sessions: clustered, so that reports on one app skip most row groups."""

from __future__ import annotations

from pyspark.sql import DataFrame

CLUSTER = ("app_id", "user_id")


def write_sessions(sessions: DataFrame, path: str, files_per_day: int = 8, row_group_bytes: int = 32 << 20) -> None:
    """Write sessions partitioned by ``dt``, each day in ranges of app and user.

    Ranges are cut from a sample of the rows, so that an app with a large part of a day is
    spread by its users over several files, and small apps share one. Within a file rows are
    in order of app, so that the least and greatest ``app_id`` of most row groups rule them out
    for a report on one app. Days that are written again are replaced, others stay.
    """
    days = sessions.select("dt").distinct().count()
    ranged = sessions.repartitionByRange(max(1, days * files_per_day), "dt", *CLUSTER)
    ordered = ranged.sortWithinPartitions("dt", *CLUSTER)
    (
        ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("parquet.block.size", str(row_group_bytes)).partitionBy("dt").parquet(path)
    )
