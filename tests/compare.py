"""Run registered queries and their SQL side by side: python tests/compare.py SF_DIR [name ...]."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain_rows = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(plain_rows, key=repr), [columns[i] for i in order]


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, fn, sql, folder):
    """None if both give the same columns, types and rows, else a text on the first difference."""
    df = fn(spark, folder)
    got, got_cols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    types = {d[0]: str(d[1]).upper() for d in relation.description}
    want, want_cols = rows_of(names, relation.fetchall())
    if got_cols != want_cols:
        return f"columns {sorted(set(got_cols) ^ set(want_cols))}"
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if KINDS.get(kind) != types[f.name]:
            return f"type of {f.name}: {kind} / {types[f.name]}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"first difference {[(c, x, y) for c, x, y in zip(got_cols, a, b) if x != y][:4]}"
    return None


def connect(folder):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def main(folder, names):
    from __spark_entry__ import oracle_sql, queries
    from lakeweir import build_session

    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(folder), oracle_sql(), 0
    for name, fn in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, fn, sqls[name], folder)
            else:
                problem = None if fn(spark, folder).count() > 0 else "no rows"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        kind = "" if name in sqls else " (rows only)"
        print(f"{'FAIL' if problem else 'ok  '} {name}{kind} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
