"""Runs queries beside their SQL: python tests/oracle.py [--sf DIR] [NAME...]; prints what differs."""

import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def connect(sf_dir):
    c = duckdb.connect()
    c.sql("set timezone='UTC'")
    for p in sorted(Path(sf_dir).glob("*.parquet")):
        c.sql(f"create view {p.stem} as select * from '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return c


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(str(r[i]) for i in order) for r in rows)


def compare(spark, name, query, sql, sf_dir, con=None):
    """(rows of Spark, rows of SQL, only in Spark, only in SQL)"""
    df = query(spark, sf_dir)
    got = plain([tuple(r) for r in df.collect()], df.columns)
    con = con or connect(sf_dir)
    rel = con.sql(sql)
    assert sorted(rel.columns) == sorted(df.columns), (name, rel.columns, df.columns)
    want = plain(rel.fetchall(), rel.columns)
    return sum(got.values()), sum(want.values()), got - want, want - got


def main(args):
    sf = args.pop(args.index("--sf") + 1) if "--sf" in args else "/root/testdata/sf0.01"
    args = [a for a in args if a != "--sf"]
    os.environ["TZ"] = "UTC"
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf), e.oracle_sql(), 0
    for name, q in e.queries().items():
        if args and name not in args:
            continue
        t = time.time()
        try:
            if name in sqls:
                a, b, x, y = compare(spark, name, q, sqls[name], sf, con)
                same = not x and not y
                print(f"{'ok ' if same else 'BAD'} {name} {a} {b} {time.time() - t:.1f}s", *([list(x.items())[:3], list(y.items())[:3]] if not same else []), flush=True)
                bad += not same
            else:
                print(f"    {name} {len(q(spark, sf).collect())} rows, no SQL, {time.time() - t:.1f}s", flush=True)
        except Exception as err:  # noqa: BLE001
            bad += 1
            print("BAD", name, type(err).__name__, str(err)[:1500], flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
