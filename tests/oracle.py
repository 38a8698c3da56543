"""Runs a named query in Spark and its SQL in DuckDB on the same files, and compares the rows.

``python tests/oracle.py [folder] [name ...]`` prints one line per query.
"""

import datetime
import decimal
import glob
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _plain(value):
    if value is None or value != value:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return int(value) if value.is_integer() else value
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=repr)


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def differences(spark_df, con, sql):
    """None when equal, else a short description."""
    got_cols, got = _rows(spark_df.columns, [tuple(x) for x in spark_df.collect()])
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    want_cols, want = _rows(names, result.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        g, w = bad[0]
        cells = [(c, a, b) for c, a, b in zip(got_cols, g, w) if a != b]
        return f"{len(bad)} of {len(got)} rows differ, first: {cells[:4]}"
    return None


def main():
    from conftest import make_session
    import __spark_entry__ as entry
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = make_session()
    con = connect(folder)
    sqls = entry.oracle_sql()
    failed = 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            problem = differences(df, con, sqls[name]) if name in sqls else f"no SQL, {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = "ERROR " + str(error).split("JVM stacktrace")[0][:700]
            if os.environ.get("TRACE"):
                traceback.print_exc()
        failed += bool(problem) and not str(problem).startswith("no SQL")
        print(f"{'ok  ' if not problem else '----'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failed", failed)


if __name__ == "__main__":
    main()
