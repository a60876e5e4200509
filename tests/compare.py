"""Compare registered queries with their SQL twins in DuckDB.

Run as a script: ``python tests/compare.py [sf] [name part ...]``.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (0, "") if math.isnan(value) else (1, f"{value:.9e}")
    return (1, str(value))


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_key(r[i]) for i in order) for r in rows)


def differences(spark_df, relation) -> str | None:
    """None when equal, else a short description of the first difference."""
    left = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    right = canonical(relation.columns, relation.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} / {len(right[1])}"
    bad = [(a, b) for a, b in zip(left[1], right[1], strict=True) if a != b]
    if bad:
        a, b = bad[0]
        cells = [(n, x[1], y[1]) for n, x, y in zip(left[0], a, b, strict=True) if x != y]
        return f"{len(bad)} of {len(left[1])} rows differ, e.g. {cells}"
    return None


KINDS = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def type_differences(spark_df, relation) -> list[str]:
    theirs = dict(zip(relation.columns, map(str, relation.types), strict=True))
    return [
        f"{n}: {t} / {theirs.get(n)}" for n, t in spark_df.dtypes if n in theirs and KINDS.get(t, t) != theirs[n]
    ]


def main() -> None:
    import __spark_entry__ as entry_module
    from patronlens.session import local_session

    folder = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.001'}"
    parts = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    twins = entry_module.oracle_sql()
    for name, query in entry_module.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        started = time.time()
        try:
            df = query(spark, folder)
            if name in twins:
                relation = db.sql(twins[name])
                types = type_differences(df, relation)
                result = differences(df, relation) or "ok"
                result += f" TYPES {types}" if types else ""
            else:
                result = f"no SQL twin, {len(df.collect())} rows"
        except Exception as error:  # noqa: BLE001
            result = "ERROR " + str(error).replace("\n", " ")[:600]
        print(f"{name:32s} {time.time() - started:6.1f}s {result}", flush=True)


if __name__ == "__main__":
    main()
