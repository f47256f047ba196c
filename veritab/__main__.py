"""Command line: quality suite, then every report.

    spark-submit -m veritab calls.csv details.csv sales.csv out/ [--halt-all]
        [--halt row_count,address_format] [--stage | --no-stage] [--single-file]

Exit code 0 when every halting check passed and every report was written,
1 otherwise (a halting check failure is a failure, not a clean exit).
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from veritab.operators.quality import CHECK_NAMES
from veritab.plans.job import load_inputs, run_job
from veritab.sources.files import configure
from veritab.sources.schemas import EMPLOYEE_CALLS, EMPLOYEE_DETAILS, SALES_DETAILS


def parse(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="veritab", description=__doc__.splitlines()[0])
    p.add_argument("calls", help="calls table (CSV or Parquet)")
    p.add_argument("details", help="details table (CSV or Parquet)")
    p.add_argument("sales", help="sales table (CSV or Parquet)")
    p.add_argument("output_dir")
    p.add_argument("--halt-all", action="store_true", help="stop on any failed check")
    p.add_argument("--halt", default="",
                   help=f"comma-separated checks to stop on ({', '.join(CHECK_NAMES)})")
    stage = p.add_mutually_exclusive_group()
    stage.add_argument("--stage", dest="stage", action="store_true", default=None,
                       help="copy the inputs to Parquet under spark.checkpoint.dir first "
                            "(default when any input is CSV)")
    stage.add_argument("--no-stage", dest="stage", action="store_false",
                       help="read the inputs directly in every pass")
    p.add_argument("--single-file", action="store_true", help="one CSV part per summary report (row-level reports stay parallel)")
    p.add_argument("--run-id", help="take up an unfinished run of this id: only what it did not finish is written")
    return p.parse_args(argv)


def should_stage(args: argparse.Namespace) -> bool:
    """CSV is parsed again by the suite and by each of the six reports (and has
    no columnar pruning), so CSV inputs are staged as Parquet unless told not to."""
    if args.stage is not None:
        return args.stage
    return any(p.lower().endswith(".csv") for p in (args.calls, args.details, args.sales))


def halt_set(args: argparse.Namespace) -> set[str]:
    halt = set(CHECK_NAMES) if args.halt_all else set()
    return halt | {c.strip() for c in args.halt.split(",") if c.strip()}


def main(argv=None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    args = parse(argv)
    spark = configure(SparkSession.builder.appName("veritab").getOrCreate())
    tables = load_inputs(spark, {EMPLOYEE_CALLS: args.calls, EMPLOYEE_DETAILS: args.details,
                                 SALES_DETAILS: args.sales})
    try:
        result = run_job(spark, tables, args.output_dir, halt_set(args),
                         stage=should_stage(args), single_file=args.single_file, run_id=args.run_id)
    except RuntimeError as exc:
        logging.getLogger("veritab").error("stopped: %s", exc)
        return 1
    return 0 if result.ok else 1


if __name__ == "__main__":
    sys.exit(main())
