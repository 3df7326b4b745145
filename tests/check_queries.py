"""Run queries against their SQL from the command line: check_queries.py [sf folder] [name ...]"""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

import oracle  # noqa: E402

import __spark_entry__ as contract  # noqa: E402
from listingflow.session import get_spark  # noqa: E402

folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
wanted = sys.argv[2:]
spark = get_spark("check", "local[8]", **{
    "spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    "spark.sql.session.timeZone": "UTC", "spark.log.level": "ERROR"})
con = oracle.connect(folder)
sqls = contract.oracle_sql()
bad = 0
for name, run in contract.queries().items():
    if wanted and not any(name.startswith(w) for w in wanted):
        continue
    start = time.time()
    try:
        problems = oracle.compare(spark, con, folder, name, run, sqls[name])
    except Exception as err:  # report and go on
        problems = [f"{type(err).__name__}: {str(err)[:900]}"]
    bad += bool(problems)
    print(f"{'BAD ' if problems else 'ok  '} {name} {time.time() - start:.1f}s", flush=True)
    for p in problems:
        print("     ", p, flush=True)
print("bad:", bad)
