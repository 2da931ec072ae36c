"""Run registered queries against their SQL twins in DuckDB.

    python tools/compare.py [--dir /root/testdata/sf0.01] [name ...]

Prints one line per query; exits with 1 if any differs or fails.
"""

from __future__ import annotations

import argparse
import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from tallywood import build_session  # noqa: E402
from tallywood.queries import ORACLES, QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

KINDS = {"int": "integer", "string": "varchar"}


def kind(name: str) -> str:
    name = name.lower()
    return KINDS.get(name, name)


def normal(value):
    if isinstance(value, float):
        return repr(0.0 if value == 0 else value)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(normal(v) for v in value) + "]"
    return repr(value)


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, connection, name: str, folder: str) -> tuple[str, str]:
    frame = QUERIES[name](spark, folder)
    rows = [tuple(r) for r in frame.collect()]
    if name not in ORACLES:
        return ("rows" if rows else "EMPTY"), f"{len(rows)} rows"
    result = connection.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return "COLUMNS", f"{frame.columns} against {columns}"
    note = ""
    for field, dtype in frame.dtypes:
        if kind(dtype) != kind(kinds[field]):
            note += f" {field}:{dtype}/{kinds[field]}"
    mine, theirs = canonical(rows, frame.columns), canonical(expected, columns)
    if mine != theirs:
        extra = [r for r in mine if r not in set(theirs)][:2]
        missing = [r for r in theirs if r not in set(mine)][:2]
        shown = f"{len(rows)} against {len(expected)} rows; only here {extra}; only there {missing}"
        return "DIFFERS", shown[:900]
    return ("TYPES" if note else "same"), f"{len(rows)} rows{note}"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--dir", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8",
        spark__driver__memory="16g", spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{args.dir}/{table}.parquet'"
        )
    bad = 0
    for name in args.names or QUERIES:
        started = time.time()
        try:
            verdict, detail = compare(spark, connection, name, args.dir)
        except Exception as failure:  # report and go on with the next query
            verdict, detail = "FAILED", str(failure)[:600]
            if args.names:
                traceback.print_exc()
        bad += verdict not in ("same", "rows")
        print(f"{verdict:8} {time.time() - started:6.2f}s {name}: {detail}", flush=True)
    print(f"{bad} bad of {len(args.names or QUERIES)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
