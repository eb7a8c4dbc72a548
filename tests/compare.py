"""Compare registered queries with their SQL on the same Parquet tables."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    return value


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark, con, run, sql: str, sf_dir: str) -> list[str]:
    """What differs between the query and its SQL; empty when they agree."""
    df = run(spark, sf_dir)
    got = df.collect()
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    want = result.fetchall()
    if sorted(df.columns) != sorted(columns):
        return [f"columns {sorted(df.columns)} against {sorted(columns)}"]
    found = []
    a, b = _rows(df.columns, got), _rows(columns, want)
    if a != b:
        found.append(f"{len(got)} rows against {len(want)}; only here {list((a - b).items())[:3]}; only there {list((b - a).items())[:3]}")
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for name, kind in df.dtypes:
        if kinds.get(kind) and kinds[kind] != types[name]:
            found.append(f"type of {name}: {kind} against {types[name]}")
    return found


def main(sf_dir: str, only: list[str]) -> None:
    import __spark_entry__ as entry
    from plumbline.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle = entry.oracle_sql()
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in oracle:
                found = differences(spark, con, run, oracle[name], sf_dir)
                state = "ok" if not found else "DIFF " + " | ".join(found)
            else:
                state = f"rows {run(spark, sf_dir).count()}"
        except Exception as error:  # noqa: BLE001
            state = f"FAIL {type(error).__name__} {str(error)[:700]}"
        print(f"{name:32s} {time.time() - start:6.1f}s {state[:1500]}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
