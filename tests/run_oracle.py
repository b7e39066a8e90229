"""Run every registered query against its DuckDB oracle: python tests/run_oracle.py [sf_dir] [names...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from oracle import compare, duck  # noqa: E402
from pagesift.session import local_session  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
only = set(sys.argv[2:])
spark = local_session()
con = duck(sf_dir)
qs, os_ = entry.queries(), entry.oracle_sql()
bad = 0
for name, fn in qs.items():
    if only and name not in only:
        continue
    t = time.time()
    df = fn(spark, sf_dir)
    if name not in os_:
        n = df.count()
        print(f"{name:24s} rows={n:7d} (rows-only) {time.time()-t:.1f}s")
        continue
    try:
        n, problems = compare(df, con, os_[name])
    except Exception as e:  # noqa: BLE001
        n, problems = -1, [f"ERROR {type(e).__name__}: {str(e)[:400]}"]
    bad += bool(problems)
    print(f"{name:24s} rows={n:7d} {'OK' if not problems else 'FAIL ' + '; '.join(problems)} {time.time()-t:.1f}s")
print(f"{len(qs)} queries, {bad} failing")
spark.stop()
