"""Run registered queries and compare them with their SQL in DuckDB: ``python -m tests.compare [sf] [name | @module ...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def local_session():
    from pyspark.sql import SparkSession

    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("feedweir")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    """A value in a form both engines share."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return float(f"{value:.9g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (dt.date, dt.timedelta)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in sorted(value.items()))
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def difference(df, con, sql: str) -> str | None:
    """What differs between a DataFrame and the SQL's result; None when nothing does."""
    got_rows = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    want_rows = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    got, want = rows_of(df.columns, got_rows), rows_of(names, want_rows)
    if got == want:
        return None
    extra, lost = sorted(set(got) - set(want), key=repr), sorted(set(want) - set(got), key=repr)
    return f"{len(got)} rows against {len(want)}; only here {extra[:2]}; only in SQL {lost[:2]}"


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from feedweir.plans.registry import all_queries

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    wanted = sys.argv[2:]
    spark, con = local_session(), oracle(f"/root/testdata/sf{sf}")
    bad = 0
    for name, q in all_queries().items():
        if wanted and not any(w in name or w == "@" + q.module for w in wanted):
            continue
        begin = time.time()
        try:
            df = q.plan(spark, f"/root/testdata/sf{sf}")
            if q.sql is None:
                problem, note = None, f"rows only: {df.count()}"
            else:
                problem, note = difference(df, con, q.sql), f"rows {con.execute(f'SELECT count(*) FROM ({q.sql})').fetchone()[0]}"
        except Exception as error:  # noqa: BLE001
            problem, note = f"{type(error).__name__}: {str(error)[:600]}", ""
        bad += problem is not None
        print(f"{'BAD ' if problem else 'ok  '} {name} {time.time() - begin:.1f}s {note} {problem or ''}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
