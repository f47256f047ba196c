"""Write every registered query's formatted physical plan to a folder:

    python tests/show_plans.py /root/testdata/sf0.1 /tmp/plans-XXXX

Queries that write files or run a stream while being built (csv_round_trip,
report_status, dq_stream) are skipped.
"""

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as E  # noqa: E402

SKIP = {"csv_round_trip", "report_status", "dq_stream"}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="plans-")
    os.makedirs(out, exist_ok=True)
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    for name, fn in E.queries().items():
        if name in SKIP:
            continue
        plan = fn(spark, sf_dir)._jdf.queryExecution().explainString(mode)
        with open(os.path.join(out, f"{name}.txt"), "w") as f:
            f.write(plan)
    print(out)
    spark.stop()


if __name__ == "__main__":
    main()
