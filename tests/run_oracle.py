"""Run every query with an oracle at a scale factor and print the outcome.

    python tests/run_oracle.py /root/testdata/sf0.01 [name ...]
"""

import sys
import time

from oracle import ROOT, compare  # noqa: F401

import __spark_entry__ as E
from txnscore.session import get_spark


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_spark("local[8]", shuffle_partitions=8)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        t0 = time.time()
        if name not in sqls:
            n = qs[name](spark, sf_dir).count()
            print(f"ROWS  {name:22s} {n:8d} rows {time.time()-t0:6.1f}s", flush=True)
            continue
        try:
            ok, n, detail = compare(spark, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # report and go on
            ok, n, detail = False, -1, f"{type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'}  {name:22s} {n:8d} rows {time.time()-t0:6.1f}s {detail}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
