"""Run registered queries against their SQL: check_queries.py [sf] [name part ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as registered  # noqa: E402
from compare import connect, differences  # noqa: E402
from patloom.session import local_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
parts = sys.argv[2:]
spark = local_session("8", "8g", **{"spark.sql.warehouse.dir": "/tmp/patloom-warehouse"})
sf_dir = f"/root/testdata/sf{sf}"
connection = connect(sf_dir)
queries, sqls = registered.queries(), registered.oracle_sql()
bad = 0
for name, run in queries.items():
    if parts and not any(part in name for part in parts):
        continue
    start = time.time()
    try:
        found = differences(run(spark, sf_dir), connection, sqls[name])
    except Exception as problem:
        found = [str(problem)[:1500]]
    bad += bool(found)
    print(f"{'BAD' if found else 'ok '} {name} {time.time() - start:.1f}s", *found, sep="  ", flush=True)
print(bad, "bad")
