"""Run registered queries in Spark and their SQL in DuckDB, and compare the results as multisets."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS FROM '{os.path.join(folder, table)}.parquet'")
    return con


def _value(value):
    return value.normalize() + 0 if isinstance(value, Decimal) else value


def rows_of(names: list[str], rows) -> Counter:
    """Rows with columns in name order. Values compare exactly, also doubles."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def compare(spark_frame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences in words; none when both sides agree."""
    relation = con.sql(sql)
    names, wanted_names = spark_frame.columns, relation.columns
    if sorted(names) != sorted(wanted_names):
        return [f"columns {sorted(names)} != {sorted(wanted_names)}"]
    got, wanted = rows_of(names, spark_frame.collect()), rows_of(wanted_names, relation.fetchall())
    if got == wanted:
        return []
    extra, missing = got - wanted, wanted - got
    return [
        f"{got.total()} rows, expected {wanted.total()}; {extra.total()} extra, "
        f"{missing.total()} missing; e.g. {next(iter(extra), None)} for {next(iter(missing), None)}"
    ]


def main() -> int:
    import __spark_entry__ as entry
    from shopmarts.session import local_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    spark, con, failed = local_session(8), duck(folder), 0
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            frame = query(spark, folder)
            problems = compare(frame, con, sqls[name]) if name in sqls else ["no oracle"]
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s", *problems[:1], flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
