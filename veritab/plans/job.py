"""The whole job: quality suite, halt gate, then every report."""

from __future__ import annotations

import logging
import os
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from veritab.plans.quality import run_quality, standard_suite
from veritab.plans.reports import ReportStatus, run_reports
from veritab.sources.files import MALFORMED, materialize_at, read_table, remove_dir, shared_dir
from veritab.sources.schemas import EMPLOYEE_CALLS, EMPLOYEE_DETAILS, SALES_DETAILS, SPECS

log = logging.getLogger(__name__)


@dataclass
class JobResult:
    quality: list
    reports: list[ReportStatus]

    @property
    def ok(self) -> bool:
        return all(s.status == "SUCCESS" for s in self.reports)


def load_inputs(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Read each logical table (CSV or Parquet) with its fixed schema; a CSV table also
    lists its cells and records that could not be read, for the suite to count, and its files
    may have their columns in different orders."""
    return {name: read_table(spark, path, SPECS[name].schema, malformed=True, mixed_headers=True)
            for name, path in paths.items()}


def stage_inputs(spark: SparkSession, tables: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Write each input once as Parquet under ``folder`` (on the shared file system) and
    read it back: the suite and the six reports then scan only the columns
    they use instead of re-parsing CSV (or re-running derived joins) seven
    times, and the lineage is cut at a durable copy that survives lost
    executors. The copies are written concurrently; the caller removes them."""
    with ThreadPoolExecutor(max_workers=max(1, len(tables)),
                            thread_name_prefix="stage") as pool:
        futures = {name: pool.submit(materialize_at, df, os.path.join(folder, name))
                   for name, df in tables.items()}
        return {name: f.result() for name, f in futures.items()}


def run_job(spark: SparkSession, tables: dict[str, DataFrame], out_dir: str,
            halt_on: Iterable[str] = (), expected_rows: dict | None = None,
            stage: bool = False, single_file: bool = False, run_id: str | None = None) -> JobResult:
    """Quality suite (raises if a halting check fails, before any report is
    written), then all registered reports with per-report failure isolation.
    Staged copies of the inputs are removed when the job ends, however it ends. A job with
    the ``run_id`` of an earlier one writes only the reports that one did not finish."""
    if not stage:
        return _run(tables, out_dir, halt_on, expected_rows, single_file, run_id)
    folder = shared_dir(spark, "inputs")
    try:
        return _run(stage_inputs(spark, tables, folder), out_dir, halt_on, expected_rows, single_file, run_id)
    finally:
        remove_dir(spark, folder)


def _run(tables, out_dir, halt_on, expected_rows, single_file, run_id) -> JobResult:
    quality = run_quality(tables, halt_on, standard_suite(expected_rows))
    clean = {name: df.drop(MALFORMED) for name, df in tables.items()}
    statuses = run_reports(clean[EMPLOYEE_CALLS], clean[EMPLOYEE_DETAILS],
                           clean[SALES_DETAILS], out_dir, single_file=single_file, run_id=run_id, share=True)
    for s in statuses:
        if s.error:
            log.error(s.error)
    return JobResult(quality, statuses)
