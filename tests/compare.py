"""Run registered queries next to their SQL in DuckDB and compare the rows.

    python tests/compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value: object) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "<null>"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when names, column kinds and rows agree, else what differs."""
    result = con.sql(sql)
    columns = sorted(df.columns)
    if columns != sorted(result.columns):
        return f"columns {columns} vs {sorted(result.columns)}"
    kinds = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    theirs = dict(zip(result.columns, map(str, result.types), strict=True))
    odd = {name: (kind, theirs[name]) for name, kind in df.dtypes if kinds.get(kind) != theirs[name]}
    if odd:
        return f"types {odd}"
    ours = sorted([tuple(_cell(row[c]) for c in columns) for row in df.collect()])
    order = [result.columns.index(c) for c in columns]
    expected = sorted([tuple(_cell(row[i]) for i in order) for row in result.fetchall()])
    if ours == expected:
        return None
    only = [row for row in ours if row not in set(expected)][:2]
    other = [row for row in expected if row not in set(ours)][:2]
    return f"{len(ours)} vs {len(expected)} rows; {columns}; ours {str(only)[:1500]}; sql {str(other)[:1500]}"


def main() -> None:
    import __spark_entry__ as registry
    from notevalue.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    settings = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"}
    spark = build_session(master="local[8]", **settings)
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    queries, oracles = registry.queries(), registry.oracle_sql()
    failed = []
    for name in names or queries:
        started = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                problem = differences(df, con, oracles[name])
                rows = ""
            else:
                rows = f"{len(df.collect())} rows, no SQL"
                problem = None
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:300]} ... {str(error)[-900:]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:32} {time.time() - started:6.2f}s {problem or rows}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main()
