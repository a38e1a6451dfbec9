"""Run registered queries against their SQL: python -m tests.check [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
import traceback

import __spark_entry__ as contract
from orrery.session import local_session
from tests.compare import connect, oracle_rows, spark_rows


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(contract.queries())
    spark = local_session(app="check")
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    failed = 0
    for name in names:
        started = time.time()
        try:
            got = spark_rows(contract.queries()[name](spark, sf_dir))
            took = time.time() - started
            sql = contract.oracle_sql().get(name)
            want = oracle_rows(db, sql) if sql else got
            state = "ok" if got == want else "DIFFERS"
            if got != want:
                print(got[0], want[0], len(got[1]), len(want[1]))
                pairs = [(a, b) for a, b in zip(got[1], want[1]) if a != b][:3]
                print(*pairs, sep="\n")
        except Exception:
            traceback.print_exc(limit=-4)
            state, took, got = "ERROR", time.time() - started, ([], [])
        failed += state != "ok"
        print(f"{state:8} {name:28} rows={len(got[1]):7} {took:6.2f}s", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
