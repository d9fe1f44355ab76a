"""Compare every query with its oracle: ``python tests/check_oracles.py <sf_dir> [query ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from verification.oracles import oracles  # noqa: E402
from verification.queries import queries  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def ordered(columns, rows) -> tuple[list[str], list[tuple]]:
    """Columns by name and rows in a total order, NULLs included."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(shaped, key=lambda r: [(v is None, str(v)) for v in r])


def spark_result(df) -> tuple[list[str], list[tuple]]:
    return ordered(df.columns, [tuple(row) for row in df.collect()])


def duck_result(con, sql: str) -> tuple[list[str], list[tuple]]:
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    return ordered(columns, found.fetchall())


def difference(left, right) -> str | None:
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows != {len(right[1])}"
    for a, b in zip(left[1], right[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b}"
    return None


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(sf_dir), oracles(), 0
    assert set(sql) == set(queries())
    for name, build in queries().items():
        if names and name not in names:
            continue
        began = time.time()
        found = spark_result(build(spark, sf_dir))
        took = time.time() - began
        diff = difference(found, duck_result(con, sql[name]))
        bad += diff is not None
        print(f"{'ok ' if diff is None else 'BAD'} {name} rows={len(found[1])} {took:.2f}s {diff or ''}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
