"""Compare every query with its SQL twin: python tools_check.py [sf_dir] [name ...]"""
import glob, os, sys, time, math, datetime
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import duckdb
from revlake.plans import catalog
from revlake.session import local_session


def norm(v):
    if isinstance(v, bool) or v is None: return str(v)
    if isinstance(v, float): return repr(round(v, 6))
    if isinstance(v, datetime.datetime): return v.isoformat()
    return str(v)


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    only = sys.argv[2:]
    catalog.load_all()
    con = duckdb.connect()
    for f in glob.glob(folder + "/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    spark = local_session(int(os.environ.get("N", "8")))
    bad = 0
    for name, fn in catalog.QUERIES.items():
        if only and not any(name == o or (o.endswith('*') and name.startswith(o[:-1])) for o in only): continue
        t0 = time.time()
        try:
            df = fn(spark, folder); rows = [tuple(r) for r in df.collect()]
        except Exception as e:
            bad += 1; print("SPARK-ERR", name, str(e)[:700].replace("\n", " ")); continue
        dt = time.time() - t0
        if name not in catalog.ORACLES:
            print(f"rows-only {name} n={len(rows)} {dt:.2f}s"); continue
        try:
            cur = con.execute(catalog.ORACLES[name]); cols = [d[0] for d in cur.description]; types=[str(d[1]) for d in cur.description]; orows = cur.fetchall()
        except Exception as e:
            bad += 1; print("DUCK-ERR", name, str(e)[:700]); continue
        if sorted(cols) != sorted(df.columns):
            bad += 1; print("COLS", name, df.columns, cols); continue
        ix = [df.columns.index(c) for c in sorted(df.columns)]; oix = [cols.index(c) for c in sorted(cols)]
        A = sorted(tuple(norm(r[i]) for i in ix) for r in rows); B = sorted(tuple(norm(r[i]) for i in oix) for r in orows)
        tm = {"STRING": "VARCHAR"}
        ty = [(c, df.schema[c].dataType.simpleString().upper(), types[cols.index(c)]) for c in df.columns]
        ty = [(c, a, b) for c, a, b in ty if {"STRING": "VARCHAR", "INT": "INTEGER"}.get(a, a) != b]
        if A == B: print(f"ok {name} n={len(A)} {dt:.2f}s", ("TYPES " + str(ty)) if ty else "", "" if len(A) else "EMPTY")
        else:
            bad += 1
            sa, sb = set(A), set(B)
            d1 = sorted(sa - sb)[:2]; d2 = sorted(sb - sa)[:2]
            print(f"DIFF {name} spark={len(A)} duck={len(B)} only_spark={len(sa-sb)} only_duck={len(sb-sa)}\n   S {str(d1)[:500]}\n   D {str(d2)[:500]}")
    print("bad", bad)


main()
