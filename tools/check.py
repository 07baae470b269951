"""Compare queries with their SQL: python tools/check.py [folder] [name ...]."""

import sys
import time

sys.path[:0] = [".", "tests"]
from compare import connect, difference  # noqa: E402

from tidemark.catalog import ORACLES, QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(QUERIES)
spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
spark.sparkContext.setLogLevel("ERROR")
con, bad = connect(folder), 0
for name in names:
    start = time.time()
    try:
        df = QUERIES[name](spark, folder)
        problem = difference(df, con, ORACLES[name]) if name in ORACLES else f"(no SQL, {df.count()} rows)"
    except Exception as error:  # report and go on
        problem = f"{type(error).__name__}: {str(error)[:700]}"
    bad += problem is not None
    print(f"{name:45s} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
print(f"{len(names)} queries, {bad} not equal")
