"""Run selected queries against their SQL twins: python -m tests.check [name...]"""

from __future__ import annotations

import os
import sys
import time

from concordat import bindings
from concordat.session import build_session
from tests.oracle import compare, connect


def main() -> int:
    folder = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, twins = bindings.load()
    only = sys.argv[1:]
    bad = 0
    for name, fn in queries.items():
        if only and not any(name == o or (o.endswith("*") and name.startswith(o[:-1])) for o in only):
            continue
        t = time.time()
        try:
            df = fn(spark, folder)
            if name in twins:
                n, issues = compare(df, con, twins[name])
            else:
                n, issues = df.count(), []
        except Exception as e:  # report and go on
            n, issues = -1, [f"{type(e).__name__}: {str(e)[:1500]}"]
        bad += bool(issues)
        print(f"{'FAIL' if issues else 'ok  '} {name} rows={n} {time.time() - t:.2f}s {'' if name in twins else '(no twin)'}", flush=True)
        for i in issues:
            print("     ", i[:2500])
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
