"""Compare registered queries with their SQL on the same Parquet tables.

Run as a script: ``python -m tests.oracle [folder] [query ...]``.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

REPORT = "{:<34} {:>8} rows {:>7.2f} s  {}"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value) if value is not None else None


def sorted_rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=lambda r: tuple((v is None, v or "") for v in r))


def arrow_types(table) -> dict[str, str]:
    return {field.name: str(field.type).replace("large_", "") for field in table.schema}


def difference(spark_frame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs in names, types or rows; None when all agree."""
    ours = spark_frame.toArrow()
    theirs = connection.sql(sql).to_arrow_table()
    if arrow_types(ours) != arrow_types(theirs):
        mine, other = arrow_types(ours), arrow_types(theirs)
        keys = sorted({*mine, *other})
        return "types: " + ", ".join(f"{k}: {mine.get(k)} / {other.get(k)}" for k in keys if mine.get(k) != other.get(k))
    a = sorted_rows(ours.column_names, list(zip(*(c.to_pylist() for c in ours.columns))))
    b = sorted_rows(theirs.column_names, list(zip(*(c.to_pylist() for c in theirs.columns))))
    if len(a) != len(b):
        return f"rows: {len(a)} / {len(b)}; only ours {[x for x in a if x not in set(b)][:2]} only theirs {[x for x in b if x not in set(a)][:2]}"
    for x, y in zip(a, b):
        if x != y:
            return f"values: {x} / {y}"
    return None


def main(argv: list[str]) -> int:
    from siltwork import build_session
    from siltwork.queries import ORACLES, QUERIES

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session("oracle", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = 0
    for name in names:
        begin = time.time()
        try:
            frame = QUERIES[name](spark, folder)
            if name in ORACLES:
                verdict = difference(frame, connection, ORACLES[name])
                count = len(connection.execute(ORACLES[name]).fetchall())
            else:
                count, verdict = frame.count(), None
        except Exception as error:  # noqa: BLE001
            verdict, count = f"error: {str(error)[:1500]}", -1
        failed += verdict is not None
        kind = "ok" if name in ORACLES else "ok (rows only)"
        print(REPORT.format(name, count, time.time() - begin, verdict or kind), flush=True)
    print(f"{len(names)} queries, {failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
