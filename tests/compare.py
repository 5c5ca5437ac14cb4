"""Compare registered queries with their SQL in DuckDB: ``python tests/compare.py [sf] [name ...]``."""

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def oracle(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(rows):
    return sorted(rows, key=repr)


def difference(spark, con, sf_dir, name, queries, sql):
    """None if both sides agree, else a short text."""
    df = queries[name](spark, sf_dir)
    cols = sorted(df.columns)
    mine = df.select(*cols).toPandas()
    res = con.execute(sql[name])
    theirs_cols = [d[0] for d in res.description]
    if sorted(theirs_cols) != cols:
        return f"columns {cols} != {sorted(theirs_cols)}"
    order = [theirs_cols.index(c) for c in cols]
    theirs = normal([tuple(clean(r[i]) for i in order) for r in res.fetchall()])
    kinds = {d[0]: str(d[1]) for d in res.description}
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    same = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
        "timestamp_ntz": "TIMESTAMP", "date": "DATE",
    }
    odd = {c: (types[c], kinds[c]) for c in cols if same.get(types[c]) != kinds[c]}
    if odd:
        return f"types {odd}"
    rows = normal([tuple(clean(x) for x in r) for r in mine.itertuples(index=False, name=None)])
    if len(rows) != len(theirs):
        return f"{len(rows)} rows != {len(theirs)}"
    for a, b in zip(rows, theirs):
        if a != b:
            return f"{cols}\n  spark  {a}\n  duckdb {b}"
    return None


def clean(x):
    import pandas as pd

    if x is None or x is pd.NaT or (isinstance(x, float) and x != x):
        return None
    if isinstance(x, pd.Timestamp):
        return x.to_pydatetime()
    if hasattr(x, "item"):
        x = x.item()
    if isinstance(x, float) and x.is_integer():
        return int(x)
    return x


if __name__ == "__main__":
    import __spark_entry__ as entry
    from proofmark.session import session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    sf_dir = f"/root/testdata/{sf}"
    spark = session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in sql:
                text = difference(spark, con, sf_dir, name, queries, sql)
            else:
                text = None if queries[name](spark, sf_dir).count() >= 0 else "no rows"
        except Exception as e:  # report and go on
            text = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += text is not None
        rows = "" if name in sql else " (rows only)"
        print(f"{'ok ' if text is None else 'BAD'} {name}{rows} {time.time() - start:.1f}s {text or ''}", flush=True)
    print("bad:", bad)
    spark.stop()
