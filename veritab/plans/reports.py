"""The six reports, their registry and the runner that writes them.

Every report takes the three logical tables ``(calls, details, sales)`` and
returns a lazy DataFrame; columns are resolved by name after each join, so a
column may sit in either input of a join. With ``display=True`` (the default,
as in the written reports) numbers become formatted text in a final
projection; ``display=False`` keeps them numeric.

The two sales reports aggregate the line-level table to one row per
(caller, key) before joining it: the join then moves aggregated rows, and a
caller with a third of all sales arrives at the join as a handful of rows.
"""

from __future__ import annotations

import inspect
import logging
import os
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritab.functions import count_text, money_text, percent_text, ratio
from veritab.operators.aggregate import ratio_breakdown, summed_top_k
from veritab.operators.split import split_pattern
from veritab.operators.topn import top_k_per_group, top_n
from veritab.sources.files import make_dir, materialize_at, path_exists, remove_dir, shared_dir, write_csv

log = logging.getLogger(__name__)

Report = Callable[[DataFrame, DataFrame, DataFrame], DataFrame]
REPORTS: dict[str, Report] = {}


def report(folder: str) -> Callable[[Report], Report]:
    """Register a report under its output folder; registration order is run order.
    A folder that is taken is a ``ValueError``: one report would replace the other's output."""
    def register(fn: Report) -> Report:
        if folder in REPORTS:
            raise ValueError(f"a report for folder {folder!r} is registered already")
        REPORTS[folder] = fn
        return fn
    return register


# The default parameters of the six written reports.
IT_AREA = "IT"
MARKETING_AREA = "Marketing"
TOP_N = 100
RATE_THRESHOLD = 0.75
TOP_K = 3
PRODUCT_COUNTRY = "Netherlands"

# Reports whose rows grow with the inputs; the others return a top-k or one row a group.
ROW_LEVEL = {"marketing_address_info"}


def join_people(calls: DataFrame, details: DataFrame, people: DataFrame | None = None) -> DataFrame:
    """Calls and details by id; ``people`` is that join made before, if a run shares it."""
    return calls.join(details, on="id", how="inner") if people is None else people


@report("it_data")
def top_sales(calls: DataFrame, details: DataFrame, sales: DataFrame | None = None,
              area: str = IT_AREA, n: int = TOP_N, people: DataFrame | None = None) -> DataFrame:
    """The ``n`` people of ``area`` with the highest sales (null counts as 0.0;
    ties broken by id)."""
    joined = join_people(calls, details, people).filter(F.col("area") == area)
    return top_n(joined, "sales_amount", n, fill=0.0, tie_breakers=["id"])


@report("marketing_address_info")
def address_info(calls: DataFrame, details: DataFrame, sales: DataFrame | None = None,
                 area: str = MARKETING_AREA, people: DataFrame | None = None) -> DataFrame:
    """name, address without its postcode, and the postcode, for ``area``."""
    joined = join_people(calls, details, people).filter(F.col("area") == area)
    return split_pattern(joined, "address", "zip_code").select("name", "address", "zip_code")


@report("department_breakdown")
def department_breakdown(calls: DataFrame, details: DataFrame, sales: DataFrame | None = None,
                         display: bool = True, people: DataFrame | None = None) -> DataFrame:
    """Per area: total sales, and successful / made calls in percent."""
    b = ratio_breakdown(join_people(calls, details, people), ["area"], "sales_amount",
                        "calls_successful", "calls_made")
    if not display:
        return b.select("area", "total_sales", "success_rate")
    return b.select("area", money_text("total_sales").alias("total_sales_amount"),
                    percent_text("success_rate").alias("success_rate_pct"))


@report("top_3")
def top_performers(calls: DataFrame, details: DataFrame, sales: DataFrame | None = None,
                   threshold: float = RATE_THRESHOLD, k: int = TOP_K,
                   display: bool = True, people: DataFrame | None = None) -> DataFrame:
    """Per area, the top ``k`` by sales then success rate among people whose
    success rate is strictly above ``threshold`` (ties share a rank)."""
    joined = (join_people(calls, details, people)
              .withColumn("success_rate", ratio("calls_successful", "calls_made"))
              .filter(F.col("success_rate") > threshold))
    ranked = top_k_per_group(joined, ["area"],
                             [F.col("sales_amount").desc(), F.col("success_rate").desc()], k)
    if not display:
        return ranked.select("area", "name", "sales_amount", "success_rate", "rank")
    return ranked.select(
        "area", "name", money_text("sales_amount").alias("sales_amount"),
        percent_text(F.col("success_rate") * 100).alias("success_rate_pct"), "rank")


@report("top_3_most_sold_per_department_netherlands")
def top_products(calls: DataFrame, details: DataFrame | None, sales: DataFrame,
                 country: str = PRODUCT_COUNTRY, k: int = TOP_K,
                 display: bool = True) -> DataFrame:
    """Per area of the caller, the ``k`` products with the largest quantity sold
    in ``country``."""
    per_caller = (sales.filter(F.col("country") == country)
                  .groupBy("caller_id", "product_sold")
                  .agg(F.sum("quantity").alias("_qty")))
    people = calls.select("id", "area")
    joined = people.join(per_caller, people["id"] == per_caller["caller_id"], "inner")
    ranked = summed_top_k(joined, ["area"], ["product_sold"], "_qty", k,
                          total_col="total_quantity")
    if not display:
        return ranked.select("area", "product_sold", "total_quantity", "rank")
    return ranked.select("area", "product_sold",
                         count_text("total_quantity").alias("total_quantity"), "rank")


@report("best_salesperson")
def best_salesperson(calls: DataFrame | None, details: DataFrame, sales: DataFrame,
                     k: int = 1, display: bool = True) -> DataFrame:
    """Per country, the person (by id, so namesakes stay apart) with the largest
    quantity sold, then the larger sales amount; full ties all win."""
    per_caller = (sales.groupBy("caller_id", "country")
                  .agg(F.sum("quantity").alias("_qty")))
    people = details.select("id", "name", "sales_amount")
    joined = people.join(per_caller, people["id"] == per_caller["caller_id"], "inner")
    # Re-group on the report's own key: identical to summing the raw lines even
    # when an id occurs twice in details. The join output is already
    # partitioned by id, so this adds no shuffle.
    totals = (joined.groupBy(people["id"], "country", "name", "sales_amount")
              .agg(F.sum("_qty").alias("total_quantity")))
    ranked = top_k_per_group(totals, ["country"],
                             [F.col("total_quantity").desc(), F.col("sales_amount").desc()], k)
    if not display:
        return ranked.select("id", "name", "country", "total_quantity", "sales_amount", "rank")
    return ranked.select("name", "country",
                         count_text("total_quantity").alias("total_quantity"),
                         money_text("sales_amount").alias("sales_amount"))


SUMMARIES = set(REPORTS) - ROW_LEVEL


# ------------------------------------------------------------------- runner

SUCCESS, FAILED = "SUCCESS", "FAILED"
STATUS_SCHEMA = T.StructType([T.StructField("report", T.StringType()),
                              T.StructField("status", T.StringType()),
                              T.StructField("error", T.StringType())])


@dataclass(frozen=True)
class ReportStatus:
    """``resumed``: written by an earlier run of the same ``run_id`` and left as it is."""

    report: str
    status: str
    error: str | None = None
    resumed: bool = False


class Manifest:
    """Which reports of a run are finished: a folder ``_finished/<report>/<run id>`` beside the
    reports, made after a report is committed and removed before it is written again. A
    report whose own commit mark is missing is not finished, whatever the manifest says."""

    def __init__(self, spark: SparkSession, out_dir: str, run_id: str):
        self.spark, self.out_dir, self.name = spark, out_dir, quote(run_id, safe="")

    def _mark(self, folder: str) -> str:
        return os.path.join(self.out_dir, "_finished", folder)

    def finished(self, folder: str) -> bool:
        return (path_exists(self.spark, os.path.join(self._mark(folder), self.name))
                and path_exists(self.spark, os.path.join(self.out_dir, folder, "_SUCCESS")))

    def begin(self, folder: str) -> None:
        remove_dir(self.spark, self._mark(folder))

    def end(self, folder: str) -> None:
        make_dir(self.spark, os.path.join(self._mark(folder), self.name))


def _run_one(folder: str, fn: Report, tables: tuple, out_dir: str, write, manifest: Manifest | None) -> ReportStatus:
    try:
        if manifest is not None:
            if manifest.finished(folder):
                log.info("%s was written before", folder)
                return ReportStatus(folder, SUCCESS, resumed=True)
            manifest.begin(folder)
        write(fn(*tables), os.path.join(out_dir, folder))
        if manifest is not None:
            manifest.end(folder)
        log.info("%s written", folder)
        return ReportStatus(folder, SUCCESS)
    except Exception as exc:  # noqa: BLE001 - isolate one report's failure
        log.error("%s failed: %s", folder, exc)
        return ReportStatus(folder, FAILED, f"{folder}: {exc}")


def takes_people(fn: Report) -> bool:
    """True for a report that can read the shared join of calls and details."""
    try:
        return "people" in inspect.signature(fn).parameters
    except ValueError:   # a builtin that does not tell
        return False


def run_reports(calls: DataFrame, details: DataFrame, sales: DataFrame, out_dir: str,
                reports: dict[str, Report] | None = None, single_file: bool = False,
                writer: Callable[..., None] | None = None,
                parallelism: int = 3, run_id: str | None = None, share: bool = False) -> list[ReportStatus]:
    """Build and write every report to ``out_dir/<folder>``.

    A report that fails (at analysis or while writing) is recorded as FAILED
    with ``"<folder>: <error>"`` and the others still run. Up to
    ``parallelism`` reports are submitted at once from driver threads, so the
    narrow tail stages of one report (final aggregate, top-k merge, commit)
    overlap with the wide stages of another. Each write is an ordinary Spark
    job with the standard output committer: a lost executor's tasks are
    retried and a half-written folder is never committed. Statuses come back
    in registration order. ``single_file`` writes each summary report as one part;
    row-level reports (``ROW_LEVEL``) and unknown ones are written in parallel all the
    same, since one task would have to hold as many rows as the inputs have.

    With ``run_id`` a run can be taken up again: reports that a run of that id has finished in
    ``out_dir`` are left alone (``resumed``), the others are written. The id stands for the inputs
    and parameters; give another one when they change. ``share`` joins calls and details once,
    into a table in the shared folder that is removed at the end, for all reports that have a
    ``people`` parameter - if more than one of them is to be written.
    """
    def write_one(df: DataFrame, path: str) -> None:
        name = os.path.basename(path)
        write_csv(df, path, single_file=single_file and name in SUMMARIES)

    write = writer or write_one
    todo = dict(reports if reports is not None else REPORTS)
    tables = (calls, details, sales)
    manifest = Manifest(calls.sparkSession, out_dir, run_id) if run_id is not None else None
    sharing = [f for f, fn in todo.items() if share and takes_people(fn)
               and not (manifest is not None and manifest.finished(f))]
    folder = shared_dir(calls.sparkSession, "people") if len(sharing) > 1 else None
    if folder is not None:
        people = materialize_at(join_people(calls, details), folder)
        todo |= {f: partial(todo[f], people=people) for f in sharing}
    try:
        if parallelism <= 1 or len(todo) <= 1:
            return [_run_one(f, fn, tables, out_dir, write, manifest) for f, fn in todo.items()]
        with ThreadPoolExecutor(max_workers=parallelism, thread_name_prefix="report") as pool:
            futures = [pool.submit(_run_one, f, fn, tables, out_dir, write, manifest) for f, fn in todo.items()]
            return [f.result() for f in futures]
    finally:
        if folder is not None:
            remove_dir(calls.sparkSession, folder)


def status_frame(spark: SparkSession, statuses: list[ReportStatus]) -> DataFrame:
    """The statuses as a DataFrame (one row per report)."""
    return spark.createDataFrame([(s.report, s.status, s.error) for s in statuses],
                                 STATUS_SCHEMA)
