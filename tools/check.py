"""Compare queries with DuckDB: python tools/check.py [folder] [name ...]."""

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from oracle import compare, duck  # noqa: E402

from mergewell.session import local_session  # noqa: E402
from mergewell.queries import all_oracles, all_queries  # noqa: E402

folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(all_queries())
spark, connection, bad = local_session(), duck(folder), 0
for name in names:
    start = time.time()
    try:
        df = all_queries()[name](spark, folder)
        sql = all_oracles().get(name)
        note = compare(df, connection, sql) if sql else f"rows only: {df.count()}"
    except Exception as error:
        note = f"{type(error).__name__}: {str(error)[:1500]}"
    ok = not note or note.startswith("rows only")
    bad += not ok
    print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.2f}s {note}", flush=True)
print("bad:", bad)
