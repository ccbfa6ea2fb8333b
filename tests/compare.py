"""Run queries on Spark and their SQL on DuckDB, and compare the rows."""

from __future__ import annotations

import math
import os
import re
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return float(f"{value:.9g}") if abs(value) > 1e9 else value + 0.0
    return value


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(spark_df, con, sql: str) -> list[str]:
    names, mine = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    wanted_names, wanted = rows_of([d[0] for d in result.description], result.fetchall())
    problems = []
    if names != wanted_names:
        problems.append(f"columns {names} != {wanted_names}")
    if len(mine) != len(wanted):
        problems.append(f"{len(mine)} rows, wanted {len(wanted)}")
    bad = [(a, b) for a, b in zip(mine, wanted) if a != b]
    if bad:
        problems.append(f"{len(bad)} rows differ, first {bad[0]}")
    kinds = [(a, b) for a, b in zip(mine, wanted) if [type(x) for x in a] != [type(x) for x in b]]
    if kinds:
        problems.append(f"types differ, first {kinds[0]}")
    return problems


def plan(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def plan_problems(df) -> list[str]:
    """Cross joins, and windows that gather the whole input."""
    text = plan(df)
    found = [name for name in ("CartesianProduct", "BroadcastNestedLoopJoin") if name in text]
    if re.search(r"windowspecdefinition\((?:[^(),]* (?:ASC|DESC)|specifiedwindowframe)", text):
        found.append("window without a partition")
    return found


def main(names: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from tablewright.plans.catalog import ORACLES, QUERIES
    from tablewright.session import build_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        "compare", f"local[{os.cpu_count()}]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf)
            if name in ORACLES:
                problems = plan_problems(df) + differences(df, con, ORACLES[name])
                note = "same"
            else:
                problems, note = plan_problems(df), f"{df.count()} rows, no SQL"
        except Exception as error:  # report every query
            problems, note = [f"{type(error).__name__}: {str(error)[:1500]}"], ""
        failed += bool(problems)
        print(f"{name:24s} {time.time() - start:6.1f}s  {'; '.join(problems) or note}", flush=True)
    print(f"{failed} failed")
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
