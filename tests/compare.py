"""Run registered queries against DuckDB over the same parquet files.

``python tests/compare.py [name ...]`` prints one line per query at ``$COMPARE_SF_DIR``
(default sf0.01).
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, Decimal):
        return repr(float(value))
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value if value is None else str(value)


def family(dtype: str) -> str:
    return {
        "bigint": "int64", "int": "int32", "integer": "int32", "double": "float64",
        "string": "text", "varchar": "text", "boolean": "bool", "date": "date",
        "timestamp_ntz": "timestamp", "timestamp": "timestamp",
    }.get(dtype.lower(), dtype.lower())


def compare(spark, con, query, sf_dir: str) -> str:
    """Empty text when rows, names and types agree, else what differs."""
    rows = query.build(spark, sf_dir)
    columns = sorted(rows.columns)
    ours = Counter(tuple(plain(row[c]) for c in columns) for row in rows.collect())
    if query.sql is None:
        return "" if ours else "no rows"
    cursor = con.execute(query.sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    types = dict(rows.dtypes)
    for described in cursor.description:
        if family(types[described[0]]) != family(str(described[1])):
            return f"type of {described[0]}: {types[described[0]]} != {described[1]}"
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(plain(row[i]) for i in order) for row in cursor.fetchall())
    if ours != theirs:
        extra, missing = ours - theirs, theirs - ours
        return (f"{sum(ours.values())} rows != {sum(theirs.values())}; {columns}\n"
                f"  only ours: {list(extra)[:2]}\n  only sql:  {list(missing)[:2]}")
    return ""


def main(names: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from medallion.catalog import all_queries
    from medallion.session import build_session

    sf_dir = os.environ.get("COMPARE_SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        master="local[8]", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                              "spark.sql.shuffle.partitions": "8",
                              "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name, query in all_queries().items():
        if names and name not in names and not any(name.startswith(n[:-1]) for n in names
                                                   if n.endswith("*")):
            continue
        started = time.time()
        try:
            verdict = compare(spark, con, query, sf_dir)
        except Exception as error:
            verdict = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(verdict)
        print(f"{'FAIL' if verdict else 'ok':4} {time.time() - started:6.2f}s {name} {verdict}",
              flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 1))
