"""Run queries and their SQL twins side by side and compare the rows."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float) or type(v).__name__ == "Decimal":
        return round(float(v), 6) + 0.0
    return v


def bag(names, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, sql: str, con) -> str | None:
    """None when equal, else what differs."""
    left_names, left = bag(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    right_names, right = bag([d[0] for d in cur.description], cur.fetchall())
    if left_names != right_names:
        return f"columns {left_names} != {right_names}"
    if left == right:
        return None
    only_l, only_r = left - right, right - left
    return (f"{sum(left.values())} vs {sum(right.values())} rows; only ours {list(only_l.items())[:3]}; "
            f"only SQL {list(only_r.items())[:3]}")


def session(cores: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("rankforge")
        .config("spark.sql.shuffle.partitions", str(cores)).config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from rankforge.plans.oracle import oracles
    from rankforge.plans.queries import registry

    sf_dir = f"/root/testdata/{sys.argv[1]}"
    spark, con, sqls = session(), duck(sf_dir), oracles()
    for name in sys.argv[2:] or registry():
        t0 = time.time()
        try:
            df = registry()[name](spark, sf_dir)
            if name not in sqls:
                print(f"{name:28s} rows only: {df.count()}", flush=True)
                continue
            problem = compare(df, sqls[name], con)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:400]}"
        print(f"{name:28s} {time.time() - t0:6.2f}s {'ok' if problem is None else 'DIFF ' + problem}", flush=True)
    print("without SQL:", sorted(set(registry()) - set(sqls)), "unused SQL:", sorted(set(sqls) - set(registry())))
