"""Run registered queries against their oracles: python tests/check_oracles.py [keys...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_compare import compare, rows_of_spark  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from corpuslens.session import get_session  # noqa: E402


def main(argv):
    sf_dir = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = get_session("local[8]")
    qs, os_ = E.queries(), E.oracle_sql()
    keys = argv or sorted(qs)
    bad = 0
    for k in keys:
        t0 = time.time()
        try:
            if k in os_:
                probs = compare(spark, qs[k], os_[k], sf_dir)
            else:
                cols, rows = rows_of_spark(qs[k](spark, sf_dir))
                probs = [] if cols else ["no columns"]
                k = k + " (rows-only: %d)" % len(rows)
        except Exception as e:  # report and continue
            probs = [f"error: {type(e).__name__}: {str(e)[:600]}"]
        dt = time.time() - t0
        bad += bool(probs)
        print(f"{'OK  ' if not probs else 'FAIL'} {k} {dt:.1f}s {'; '.join(probs)[:1500]}", flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
