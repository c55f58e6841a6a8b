"""Compare registered queries with their oracle text: python tools/check.py [sf] [name ...]."""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from freshet.catalog import load_all  # noqa: E402
from freshet.catalog.fixtures import TABLES  # noqa: E402
from freshet.catalog.registry import ENTRIES, oracle, run  # noqa: E402
from freshet.session import build_session  # noqa: E402


def canon(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in rows)


def main():
    args = sys.argv[1:]
    sf = "0.01"
    if args and args[0].replace(".", "").isdigit():
        sf = args.pop(0)
    load_all()
    names = [n for n in ENTRIES if not args or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in args)]
    if args and args[0].startswith("@"):
        names = [n for n in ENTRIES if any(ENTRIES[n].build.__module__.endswith("." + a[1:]) for a in args)]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("local[8]")
    spark.sparkContext.setLogLevel("OFF")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    bad = []
    for n in names:
        t0 = time.time()
        try:
            df = run(n, spark, sf_dir)
            got = [tuple(r) for r in df.collect()]
            t1 = time.time()
            sql = oracle(n)
            if sql is None:
                print(f"rows  {n}: {len(got)} rows {t1 - t0:.1f}s", flush=True)
                continue
            cur = con.execute(sql)
            cols = [c[0] for c in cur.description]
            want = cur.fetchall()
            t2 = time.time()
            if sorted(cols) != sorted(df.columns):
                raise AssertionError(f"columns {sorted(df.columns)} vs {sorted(cols)}")
            a, b = rows_of(df.columns, got), rows_of(cols, want)
            if a != b:
                sa, sb = set(a), set(b)
                raise AssertionError(
                    f"{len(a)} vs {len(b)} rows; cols {sorted(cols)}; only spark {sorted(sa - sb)[:3]}; only oracle {sorted(sb - sa)[:3]}"
                )
            nulls = {c: sum(1 for r in got if r[i] is None) for i, c in enumerate(df.columns)}
            allnull = [c for c, k in nulls.items() if got and k == len(got)]
            print(f"ok    {n}: {len(got)} rows {t1 - t0:.1f}s (oracle {t2 - t1:.1f}s)" + (f" ALL NULL {allnull}" if allnull else "") + (" EMPTY" if not got else ""), flush=True)
        except Exception as err:  # noqa: BLE001
            bad.append(n)
            print(f"FAIL  {n}: {type(err).__name__} {str(err)[:900]}", flush=True)
    print(f"{len(names) - len(bad)}/{len(names)} fine; failing: {bad}")


main()
