"""Run registered queries beside their SQL and compare rows: python tests/compare.py <folder> [name ...]"""

import datetime
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "labels"]


def connect(folder):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def rows_of(columns, records):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in at]
    rows = sorted((tuple(_value(r[i]) for i in at) for r in records), key=repr)
    return names, rows


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cursor = con.execute(sql)
    return rows_of([d[0] for d in cursor.description], cursor.fetchall())


def sql_types(con, sql):
    return {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}


def main(folder, names):
    import __spark_entry__ as entry
    from freshet.session import build_session

    spark = build_session(master="local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sqls = connect(folder), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        started = time.time()
        try:
            df = queries[name](spark, folder)
            got = spark_rows(df)
            took = time.time() - started
            if name not in sqls:
                print(f"{name:28s} rows only {len(got[1])} {took:.1f}s", flush=True)
                continue
            started = time.time()
            want = sql_rows(con, sqls[name])
            same = got == want
            types = {f.name: f.dataType.simpleString() for f in df.schema}
            print(f"{name:28s} {'ok' if same else 'DIFFERENT'} {len(got[1])} {len(want[1])} {took:.1f}s {time.time() - started:.1f}s", flush=True)
            loose = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
            theirs = sql_types(con, sqls[name])
            off = {c: (t, theirs.get(c)) for c, t in types.items() if loose.get(t, theirs.get(c)) != theirs.get(c)}
            if off:
                print("   types:", off, flush=True)
            if not same:
                bad += 1
                print("   columns", got[0], want[0])
                a, b = set(map(repr, got[1])), set(map(repr, want[1]))
                print("   only spark:", [r[:300] for r in sorted(a - b)[:3]], "\n   only sql:  ", [r[:300] for r in sorted(b - a)[:3]], flush=True)
        except Exception as error:
            bad += 1
            print(f"{name:28s} FAILED {type(error).__name__}: {str(error)[:700]}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
