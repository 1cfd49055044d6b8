"""Run registered queries against their SQL: python tools/compare.py <sf_dir> [name part ...]"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, bool):
        return str(value)
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, query, sql: str | None) -> str | None:
    """None when equal, else what differs."""
    frame = query(spark, sf_dir)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if len(set(frame.columns)) != len(frame.columns):
        return "duplicate column names"
    if sql is None:
        return None if got else "no rows"
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = rows_of(columns, cursor.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    if not got:
        return "no rows"
    if got == want:
        return type_difference(frame, cursor.description)
    only_got = [r for r in got if r not in set(want)][:2]
    only_want = [r for r in want if r not in set(got)][:2]
    return f"rows {len(got)} vs {len(want)}; spark only {only_got}; sql only {only_want}"[:900]


# Spark and DuckDB names of the types results may have.
SAME_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP",
    "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT",
}


def type_difference(frame, description) -> str | None:
    theirs = {d[0]: str(d[1]) for d in description}
    wrong = []
    for field in frame.schema.fields:
        kind = field.dataType.simpleString()
        expected = SAME_TYPES.get(kind, kind.upper())
        if theirs[field.name].replace(" ", "") != expected.replace(" ", ""):
            wrong.append(f"{field.name}: {kind} / {theirs[field.name]}")
    return f"types differ: {wrong}" if wrong else None


def main() -> None:
    from millrace.catalog import ORACLES, QUERIES
    from millrace.session import build_session

    sf_dir, parts = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, query in QUERIES.items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, query, ORACLES.get(name))
        except Exception as error:  # the report goes on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        mark = "ok " if problem is None else "BAD"
        print(f"{mark} {name} {time.time() - start:.2f}s{'' if name in ORACLES else ' (no SQL)'} {problem or ''}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
