"""Compare every query with its oracle SQL: python tests/run_oracle.py [sf_dir] [keys...]"""

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import compare, duck  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as E  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or sorted(E.queries())
    scratch = tempfile.mkdtemp(prefix="veritab-oracle-")
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.checkpoint.dir", os.path.join(scratch, "ckpt"))
             .config("spark.local.dir", os.path.join(scratch, "local"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    sqls = E.oracle_sql()
    bad = 0
    for k in keys:
        t = time.time()
        if k not in sqls:
            n = E.queries()[k](spark, sf_dir).count()
            print(f"{k:28s} rows-only {n} rows ({time.time()-t:.1f}s)")
            continue
        try:
            problems, ns, nd = compare(spark, con, E.queries()[k], sqls[k], sf_dir)
        except Exception as exc:  # noqa: BLE001
            problems, ns, nd = [f"error: {str(exc)[:400]}"], -1, -1
        bad += bool(problems)
        status = "OK " if not problems else "BAD"
        print(f"{k:28s} {status} spark={ns} oracle={nd} ({time.time()-t:.1f}s) {'; '.join(problems)}")
    spark.stop()
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
