"""Compares registered queries with their SQL: ``python tests/check.py [folder] [name ...]``."""

import pathlib
import sys
import time

sys.path[:0] = [str(pathlib.Path(__file__).resolve().parents[1]), str(pathlib.Path(__file__).resolve().parent)]

import oracle

import __spark_entry__ as entry
from marquee.session import local_session

if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    queries, sqls = entry.queries(), entry.oracle_sql()
    wanted = [q for q in queries if not sys.argv[2:] or any(q.startswith(w) for w in sys.argv[2:])]
    con = oracle.connect(folder)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in sqls:
                problem = oracle.compare(df, con, sqls[name])
                note = "ok" if problem is None else "DIFF " + problem[:600]
            else:
                rows = df.collect()
                note, problem = f"rows-only {len(rows)} {df.columns}", None
        except Exception as e:
            problem = note = f"ERROR {type(e).__name__}: {str(e)[:700]}"
        bad += problem is not None
        print(f"{time.time() - start:6.2f}s {name}: {note}", flush=True)
    print("problems:", bad, "of", len(wanted))
