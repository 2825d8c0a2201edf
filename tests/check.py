"""Compare queries with their SQL: ``python tests/check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return f"{v:.9g}"
        return repr(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name, query, sql):
    """None when equal, else a description of the first difference."""
    df = query(spark, folder)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    want = normal(cur.fetchall(), columns)
    if got == want:
        return None
    extra = sorted(set(got) - set(want))[:3]
    missing = sorted(set(want) - set(got))[:3]
    return f"{len(got)} rows, want {len(want)}; only spark {extra}; only sql {missing}"


def main() -> int:
    import __spark_entry__ as entry
    from tideline.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="check-")})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    sqls = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, folder, name, query, sqls[name])
            else:
                problem = None if query(spark, folder).count() else "no rows"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
