"""Command line: compare registered queries with their SQL.

``check_queries.py [scale or folder] [names...]``; CHECK_ZONE sets the session's zone and
CHECK_HOT_ROWS the size from which a key is salted.
"""

import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry_point
import compare
from lamina.operators import skew
from lamina.session import build_session


def main(argv: list[str]) -> int:
    sf = argv[0] if argv else "0.01"
    sf_dir = sf if sf.startswith("/") else f"/root/testdata/sf{sf}"
    skew.HOT_ROWS = int(os.environ.get("CHECK_HOT_ROWS", skew.HOT_ROWS))
    spark = build_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", os.environ.get("CHECK_ZONE", "UTC"))
    con = compare.connect(sf_dir)
    queries, oracles = entry_point.queries(), entry_point.oracle_sql()
    bad = 0
    for name in argv[1:] or queries:
        started = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                problems = compare.differences(df, con, oracles[name])
            else:
                count = df.count()
                problems = [] if count else ["no rows"]
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        took = time.time() - started
        print(f"{'FAIL' if problems else 'ok  '} {name} {took:.1f}s", flush=True)
        for p in problems:
            print("     ", str(p)[:900], flush=True)
        bad += bool(problems)
    print(f"{bad} of {len(argv[1:] or queries)} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
