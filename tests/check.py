"""Compare registered queries with their SQL twins; usage: check.py SF_DIR [name ...]."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

from bazaarline.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql):
    """Empty text if both sides agree, else what differs."""
    mine = [tuple(r) for r in spark_df.collect()]
    print(f"    spark done at {time.time() % 1000:.1f}", end="", flush=True)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    print(f" sql done at {time.time() % 1000:.1f}")
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    a, b = rows_of(spark_df.columns, mine), rows_of(names, theirs)
    if a == b:
        return ""
    only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    return f"rows {len(a)} against {len(b)}; only here {len(only_a)} {only_a[:2]}; only there {len(only_b)} {only_b[:2]}"


def main(sf_dir: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries

    spark = local_session()
    con, sqls, runs, bad = connect(sf_dir), oracle_sql(), queries(), 0
    print("no query for", sorted(set(sqls) - set(runs)), "no sql for", sorted(set(runs) - set(sqls)))
    for name in names or list(runs):
        start = time.time()
        print(f"    start {start % 1000:.1f}", end="")
        try:
            df = runs[name](spark, sf_dir)
            if name in sqls:
                con_start = time.time()
                problem = compare(df, con, sqls[name])
            else:
                problem = "" if df.collect() else "no rows"
        except Exception:
            problem = traceback.format_exc(limit=2)[-1500:]
        bad += bool(problem)
        print(f"{'BAD' if problem else 'ok '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(bad, "bad")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
