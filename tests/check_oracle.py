"""Run queries and their SQL twins on one scale and compare all values.

    python tests/check_oracle.py [folder] [query ...]
"""

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def value(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, bool):
        return x
    if isinstance(x, (int, float)) or type(x).__name__ == "Decimal":
        return float(x)
    return str(x)


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


def compare(spark_df, con, sql):
    """None when equal, else a description of the first difference."""
    names, mine = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    other_names, theirs = canonical([d[0] for d in cur.description], cur.fetchall())
    if names != other_names:
        return f"columns {names} / {other_names}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{str(a)[:300]} / {str(b)[:300]}"
    if not mine:
        return "no rows"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from deskflow.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    picked = sys.argv[2:]
    spark, con = local_session(8), connect(folder)
    oracle, bad = oracle_sql(), 0
    for name, q in queries().items():
        if picked and name not in picked:
            continue
        start = time.time()
        try:
            df = q(spark, folder)
            found = compare(df, con, oracle[name]) if name in oracle else f"rows only: {len(df.collect())}"
        except Exception as e:
            found = f"ERROR {type(e).__name__} {str(e)[:600]}"
        ok = found is None or found.startswith("rows only")
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {time.time() - start:6.1f}s {name} {found or ''}", flush=True)
    print("bad:", bad)
