"""Runs registered queries next to their SQL twins and compares every value."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(row):
    return tuple((v is None, "" if v is None else (f"{v:.4f}" if isinstance(v, float) else str(v))) for v in row)


def difference(df, con, sql: str) -> str | None:
    """None when both results are equal, else the first difference found."""
    columns = sorted(df.columns)
    ours = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    at = [names.index(c) for c in columns]
    theirs = [tuple(r[i] for i in at) for r in result.fetchall()]
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    for a, b in zip(sorted(ours, key=_key), sorted(theirs, key=_key)):
        for c, x, y in zip(columns, a, b):
            if type(x) is not type(y):
                return f"{c}: types {type(x)} {type(y)} in {a} / {b}"
            if x != y and not (isinstance(x, float) and math.isnan(x) and math.isnan(y)):
                return f"{c}: {x!r} != {y!r} in {a} / {b}"
    return None


def main(names: list[str], sf_dir: str) -> int:
    from __spark_entry__ import oracle_sql, queries
    from verisift.session import build_session

    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    twins, failed = oracle_sql(), 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        begin = time.time()
        try:
            df = run(spark, sf_dir)
            found = difference(df, con, twins[name]) if name in twins else f"ROWS {df.count()}"
        except Exception as error:  # noqa: BLE001
            causes = [line[:300] for line in str(error).splitlines() if "Caused by" in line]
            found = f"ERROR {type(error).__name__} {str(error)[:300]} {causes}"
        failed += found is not None and not found.startswith("ROWS")
        print(f"{name:28s} {time.time() - begin:6.2f}s {found or 'ok'}", flush=True)
    print("unused twins:", sorted(set(twins) - set(queries())), "failed:", failed)
    return failed


if __name__ == "__main__":
    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    sys.exit(bool(main(sys.argv[1:], folder)))
