"""

``entry(spark)`` runs the flagship query (the whole quality suite) on sf0.001.
``queries()`` holds one callable per implemented operator; each reads the
TPC-H-like test tables of ``sf_dir`` whole, derives the three logical tables
from them (``veritab.sources.adapters``) and runs the operator.
``oracle_sql()`` gives the same computation as DuckDB SQL over the same parquet
views; the adapter views are repeated there as CTEs.
"""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# the package sits next to this file; make it importable however the file is loaded
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from veritab.functions import money_text  # noqa: E402
from veritab.operators import quality as q  # noqa: E402
from veritab.operators.quality import orphan_keys, violations  # noqa: E402
from veritab.plans import reports as R  # noqa: E402
from veritab.plans.quality import standard_suite  # noqa: E402
from veritab.sources.adapters import (  # noqa: E402
    TPCH_SCHEMAS,
    employee_calls,
    employee_details,
    load_tpch,
    sales_details,
)
from veritab.sources.files import (  # noqa: E402
    MALFORMED,
    RECORD,
    read_csv,
    remove_dir,
    shared_dir,
    write_csv,
)
from veritab.sources.schemas import (  # noqa: E402
    DETAILS_SCHEMA,
    EMPLOYEE_CALLS,
    EMPLOYEE_DETAILS,
    SALES_DETAILS,
    SALES_SCHEMA,
)
from veritab.streaming import totals, watch  # noqa: E402



def _present(*modules: str) -> bool:
    try:
        return all(importlib.util.find_spec(m) is not None for m in modules)
    except ImportError:   # not even the folder a module should be in
        return False


# the corpus operators and their pipeline are optional; if they are there they must import
if _present("corpus_pipeline", "veritab.llm.queries"):
    import corpus_pipeline  # noqa: E402
    from veritab.llm import queries as corpus  # noqa: E402

    CORPUS = corpus.QUERIES | {"pipeline": corpus_pipeline.run}
    CORPUS_SQL = corpus.ORACLE_SQL
else:
    CORPUS, CORPUS_SQL = {}, {}

# Report parameters that select real groups in the test data
# (segments and nation names stand in for departments and countries).
TOP_AREA = "MACHINERY"
SPLIT_AREA = "BUILDING"
COUNTRY = "NATION_3"

DEFAULT_SF = "/root/testdata/sf0.001"


# --------------------------------------------------------------------- loading

class _Views(dict):
    """The three logical tables of ``sf_dir``, each built on first use."""

    def __init__(self, spark, sf_dir, sales_columns=None):
        super().__init__()
        self._t = load_tpch(spark, sf_dir)
        self._sales_columns = sales_columns

    def __missing__(self, name):
        build = {EMPLOYEE_CALLS: lambda: employee_calls(self._t),
                 EMPLOYEE_DETAILS: lambda: employee_details(self._t),
                 SALES_DETAILS: lambda: sales_details(self._t, self._sales_columns)}
        if name not in build:
            raise KeyError(name)
        self[name] = df = build[name]()
        return df

    def __contains__(self, name):
        return name in (EMPLOYEE_CALLS, EMPLOYEE_DETAILS, SALES_DETAILS)


def _tables(spark: SparkSession, sf_dir: str, sales_columns: list[str] | None = None):
    return _Views(spark, sf_dir, sales_columns)


def _cd(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return t[EMPLOYEE_CALLS], t[EMPLOYEE_DETAILS]


def _with_sales(spark, sf_dir, first: str, sales_columns=None):
    t = _tables(spark, sf_dir, sales_columns)
    return t[first], t[SALES_DETAILS]


# --------------------------------------------------------------------- reports

def q_top_n_by_sales(spark, sf_dir):
    c, d = _cd(spark, sf_dir)
    return R.top_sales(c, d, None, area=TOP_AREA, n=100)


def q_address_split(spark, sf_dir):
    c, d = _cd(spark, sf_dir)
    return R.address_info(c, d, None, area=SPLIT_AREA)


def q_area_breakdown(spark, sf_dir):
    c, d = _cd(spark, sf_dir)
    # rounded to compare: the total's last digits depend on the order of addition in SQL
    return (R.department_breakdown(c, d, None, display=False)
            .withColumn("total_sales", F.round("total_sales", 4)))


def q_area_breakdown_formatted(spark, sf_dir):
    c, d = _cd(spark, sf_dir)
    return R.department_breakdown(c, d, None)


def q_area_breakdown_thirds(spark, sf_dir):
    """Totals of amounts with more than two decimals."""
    c, d = _cd(spark, sf_dir)
    return R.department_breakdown(c, d.withColumn("sales_amount", F.col("sales_amount") / 3), None)


def q_top3_performers(spark, sf_dir):
    c, d = _cd(spark, sf_dir)
    return R.top_performers(c, d, None)


def q_top3_performers_numeric(spark, sf_dir):
    c, d = _cd(spark, sf_dir)
    return R.top_performers(c, d, None, display=False)


_R5_COLS = ["caller_id", "country", "product_sold", "quantity"]
_R6_COLS = ["caller_id", "country", "quantity"]


def q_top3_products(spark, sf_dir):
    c, s = _with_sales(spark, sf_dir, EMPLOYEE_CALLS, _R5_COLS)
    return R.top_products(c, None, s, country=COUNTRY)


def q_top3_products_numeric(spark, sf_dir):
    c, s = _with_sales(spark, sf_dir, EMPLOYEE_CALLS, _R5_COLS)
    return R.top_products(c, None, s, country=COUNTRY, display=False)


def q_best_per_country(spark, sf_dir):
    d, s = _with_sales(spark, sf_dir, EMPLOYEE_DETAILS, _R6_COLS)
    return R.best_salesperson(None, d, s)


def q_best_per_country_numeric(spark, sf_dir):
    d, s = _with_sales(spark, sf_dir, EMPLOYEE_DETAILS, _R6_COLS)
    return R.best_salesperson(None, d, s, display=False)


def q_sales_formatted(spark, sf_dir):
    d = _tables(spark, sf_dir)[EMPLOYEE_DETAILS]
    return (d.filter(F.col("sales_amount").isNotNull())
            .select("id", money_text("sales_amount").alias("sales_display")))


# ---------------------------------------------------------------- data quality

_DQ_SALES_COLS = ["id", "caller_id", "age", "quantity"]


def q_dq_report(spark, sf_dir):
    """The whole suite: every table is read once, and nothing is written."""
    return q.evaluate(_tables(spark, sf_dir, _DQ_SALES_COLS), standard_suite())


def q_dq_halt(spark, sf_dir):
    """Which failed checks would stop a run under a given halt list."""
    t = _tables(spark, sf_dir)
    checks = [c for c in standard_suite() if c.dataset != SALES_DETAILS] + q.rule(
        EMPLOYEE_CALLS, "zero_calls", F.col("calls_made") == 0, ["calls_made"], "calls_made")
    return q.halting(q.evaluate(t, checks), ["address_format", " zero_calls", "col_unique", ""])


def q_dq_basic_sales(spark, sf_dir):
    checks = [c for c in standard_suite() if c.dataset == SALES_DETAILS and c.kind != "referential"]
    return q.evaluate(_tables(spark, sf_dir, _DQ_SALES_COLS), checks)


def q_dq_non_negative(spark, sf_dir):
    return q.evaluate(_tables(spark, sf_dir),
                      q.non_negative(EMPLOYEE_DETAILS, ["sales_amount"]))


def q_dq_calls(spark, sf_dir):
    checks = q.calls_successful_le_made(EMPLOYEE_CALLS) + q.rule(
        EMPLOYEE_CALLS, "zero_calls", F.col("calls_made") == 0, ["calls_made"], "calls_made")
    return q.evaluate(_tables(spark, sf_dir), checks)


def q_dq_address(spark, sf_dir):
    return q.evaluate(_tables(spark, sf_dir), q.pattern(EMPLOYEE_DETAILS, "address"))


def q_dq_orphans(spark, sf_dir):
    t = _tables(spark, sf_dir, ["caller_id"])
    o = orphan_keys(t[SALES_DETAILS], ["caller_id"], t[EMPLOYEE_CALLS], ["id"])
    return o.agg(F.count(F.lit(1)).alias("orphan_keys"),
                 F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("orphan_rows"))


def q_dq_row_count(spark, sf_dir):
    return q.evaluate(_tables(spark, sf_dir, _DQ_SALES_COLS),
                      [c for c in standard_suite() if c.kind == "row_count"])


def q_dq_non_null(spark, sf_dir):
    checks = (q.non_null(EMPLOYEE_CALLS, ["id", "area"])
              + q.non_null(EMPLOYEE_DETAILS, ["id", "address", "sales_amount"])
              + q.non_null(SALES_DETAILS, ["id", "caller_id"]))
    return q.evaluate(_tables(spark, sf_dir, _DQ_SALES_COLS), checks)


def q_dq_unique(spark, sf_dir):
    # two columns on details: the second gets an aggregate of its own
    checks = (q.unique(EMPLOYEE_CALLS, ["id"]) + q.unique(EMPLOYEE_DETAILS, ["id", "name"])
              + q.unique(SALES_DETAILS, ["id"]))
    return q.evaluate(_tables(spark, sf_dir, _DQ_SALES_COLS), checks)


def q_dq_referential(spark, sf_dir):
    return q.evaluate(_tables(spark, sf_dir, ["caller_id"]),
                      q.referential(SALES_DETAILS, ["caller_id"], EMPLOYEE_CALLS, ["id"]))


def q_dq_null_rows(spark, sf_dir):
    return _rows(spark, sf_dir, q.non_null(EMPLOYEE_DETAILS, ["address"])[0])


def q_dq_unique_columns(spark, sf_dir):
    """Four columns of the sales view, each on its own, beside the view's other checks."""
    return q.evaluate(_tables(spark, sf_dir, ["id", "caller_id", "age", "quantity"]),
                      q.unique(SALES_DETAILS, ["id", "caller_id", "age", "quantity"])
                      + q.non_negative(SALES_DETAILS, ["caller_id"])
                      + q.referential(SALES_DETAILS, ["caller_id"], EMPLOYEE_DETAILS, ["id"]))


def q_dq_violation_vectors(spark, sf_dir):
    """Every offending row of calls and details with all it breaks and the values that do."""
    t = _tables(spark, sf_dir)
    checks = {
        EMPLOYEE_CALLS: q.calls_successful_le_made(EMPLOYEE_CALLS) + q.rule(
            EMPLOYEE_CALLS, "few_successes", F.col("calls_successful") * 2 < F.col("calls_made"),
            ["calls_successful", "calls_made"]) + q.rule(
            EMPLOYEE_CALLS, "zero_calls", F.col("calls_made") == 0, ["calls_made"], "calls_made"),
        EMPLOYEE_DETAILS: q.non_null(EMPLOYEE_DETAILS, ["address", "sales_amount"])
        + q.non_negative(EMPLOYEE_DETAILS, ["sales_amount"]) + q.pattern(EMPLOYEE_DETAILS, "address")}
    parts = [q.violation_vectors(t, own).select(
        F.lit(name).alias("dataset"), "id", F.size("failed").cast("bigint").alias("n_failed"),
        F.array_join(F.transform("failed", lambda f: F.concat(
            f["check_name"], F.lit(":"), F.array_join(F.map_values(f["raw"]), "/", "?"))), "; ").alias("failed"))
        for name, own in checks.items()]
    return parts[0].unionByName(parts[1])


def q_dq_stream(spark, sf_dir):
    """The customer table as a file stream; details derived per micro-batch by a
    stream-static join with nation; row-level checks run on every batch and
    are summed over batches."""
    customers = (spark.readStream.schema(TPCH_SCHEMAS["customer"])
                 .parquet(os.path.join(sf_dir, "customer.parque[t]")))  # a glob: a file, too, is found by its folder
    details = employee_details({"customer": customers, "nation": load_tpch(spark, sf_dir)["nation"]})
    checks = (q.non_null(EMPLOYEE_DETAILS, ["id"])
              + q.non_negative(EMPLOYEE_DETAILS, ["sales_amount"])
              + q.pattern(EMPLOYEE_DETAILS, "address"))
    results = shared_dir(spark, "stream-results")
    run = watch(details, EMPLOYEE_DETAILS, checks, results, trigger={"availableNow": True})
    run.awaitTermination()
    if run.exception() is not None:
        raise RuntimeError(str(run.exception()))
    return totals(spark, results).drop("batches")


def _rows(spark, sf_dir, check, sales_columns=None):
    return violations(_tables(spark, sf_dir, sales_columns), check)


def q_dq_duplicate_rows(spark, sf_dir):
    """The repeated lines are found on lineitem and orders alone; the dimensions are
    joined to what is left."""
    t = load_tpch(spark, sf_dir)
    chk = q.unique(SALES_DETAILS, ["id"])[0]
    ids = sales_details(t, ["id"])
    return sales_details(t, keep=lambda rows: violations({SALES_DETAILS: rows}, chk, keys=ids))


def q_dq_orphan_rows(spark, sf_dir):
    t = load_tpch(spark, sf_dir)
    chk = q.referential(SALES_DETAILS, ["caller_id"], EMPLOYEE_CALLS, ["id"])[0]
    known = t["customer"].select(F.col("c_custkey").alias("id"))   # the calls view's ids
    return sales_details(t, keep=lambda rows: violations(
        {SALES_DETAILS: rows, EMPLOYEE_CALLS: known}, chk))


def q_dq_negative_rows(spark, sf_dir):
    return _rows(spark, sf_dir, q.non_negative(EMPLOYEE_DETAILS, ["sales_amount"])[0])


def q_dq_address_rows(spark, sf_dir):
    return _rows(spark, sf_dir, q.pattern(EMPLOYEE_DETAILS, "address")[0])


# ------------------------------------------------------------- sources, runner

# What is put around addresses (by id modulo 9) that a careless CSV loses or splits.
_HARD = ["  {}  ", "\t{}", '"{}" said', "{},", "line\nbreak {}", "{}\r\n", "back\\slash {}\\", "\\n {}"]


def q_csv_round_trip(spark, sf_dir):
    """Details whose addresses hold blanks at both ends, quotes, separators, line breaks and
    backslashes, or are empty or null: written as CSV and read back."""
    d = _tables(spark, sf_dir)[EMPLOYEE_DETAILS]
    hard = F.lit("")
    for k, text in enumerate(_HARD):
        before, after = text.split("{}")
        hard = F.when(F.col("id") % 9 == k, F.concat(F.lit(before), F.coalesce("address", F.lit(" ")), F.lit(after))
                      ).otherwise(hard)
    d = d.withColumn("address", F.when(F.col("id") % 10 != 0, hard))
    path = shared_dir(spark, "csv-round-trip")
    write_csv(d, path)
    return read_csv(spark, path, DETAILS_SCHEMA, lossless=True)


def q_csv_mixed_headers(spark, sf_dir):
    """Details written in files of three column orders, one with a column more, and read as one table."""
    d = _tables(spark, sf_dir)[EMPLOYEE_DETAILS]
    path = shared_dir(spark, "csv-mixed")
    orders = [d.columns, ["sales_amount", "name", "id", "address"], ["address", "more", "id", "sales_amount", "name"]]
    for k, columns in enumerate(orders):
        write_csv(d.where(F.col("id") % 3 == k).withColumn("more", F.lit("x")).select(columns),
                  os.path.join(path, f"order-{k}"))
    return read_csv(spark, os.path.join(path, "*"), DETAILS_SCHEMA, lossless=True, mixed_headers=True)


def q_csv_records(spark, sf_dir):
    """Order lines as records of which some are short, long, or have a quote left open: what is
    listed for each line number, with its rows and the characters of the records."""
    line = F.col("l_linenumber")
    cells = [F.col("l_orderkey").cast("string"), line.cast("string"), F.col("l_quantity").cast("int").cast("string")]
    record = (F.when(line == 2, F.concat_ws(",", *cells[:2]))
              .when(line == 3, F.concat_ws(",", *cells, F.lit("more")))
              .when(line == 4, F.concat_ws(",", *cells[:2], F.concat(F.lit('"'), cells[2])))
              .when(line == 5, F.concat_ws(",", *cells[:2], F.lit("many")))
              .when(line == 6, F.concat_ws(",", *cells[:2], F.concat(F.lit('"'), cells[2], F.lit('"'))))
              .otherwise(F.concat_ws(",", *cells)))
    path = shared_dir(spark, "csv-records")
    lines = load_tpch(spark, sf_dir)["lineitem"].select(record.alias("id,age,quantity"))
    lines.write.options(header=True, sep="\2", quote="\3").csv(path)   # as they are
    schema = T.StructType([f for f in SALES_SCHEMA if f.name in ("id", "age", "quantity")])
    rows = read_csv(spark, path, schema, malformed=True, records=True)
    return (rows.groupBy("age", F.array_join(MALFORMED, ",").alias("listed"))
            .agg(F.count("*").alias("n_rows"), F.count("quantity").alias("n_quantity"),
                 F.coalesce(F.sum(F.length(RECORD)), F.lit(0)).cast("bigint").alias("record_chars")))


def q_csv_malformed(spark, sf_dir):
    """Order lines written as CSV with broken cells - no number, a fraction, a whole
    number written as ``3.0`` - and the columns in another order, read back and checked."""
    line = F.col("l_linenumber")
    quantity = F.col("l_quantity").cast("int").cast("string")
    lines = load_tpch(spark, sf_dir)["lineitem"].select(
        F.when(line == 7, "n/a").when(line == 6, "2.5")
        .when(line == 3, F.concat(quantity, F.lit(".0"))).otherwise(quantity).alias("quantity"),
        F.col("l_orderkey").alias("caller_id"), (F.col("l_orderkey") * 10 + line).alias("id"))
    path = shared_dir(spark, "csv-malformed")
    write_csv(lines, path)
    schema = T.StructType([f for f in SALES_SCHEMA if f.name in lines.columns])
    table = {SALES_DETAILS: read_csv(spark, path, schema, malformed=True)}
    return q.evaluate(table, q.readable(SALES_DETAILS) + q.non_null(SALES_DETAILS, ["quantity", "id"])
                      + q.rule(SALES_DETAILS, "large", F.col("quantity") > 25, ["quantity"], "quantity"))


BROKEN = "broken_report"


def _bound_reports(t):
    """Every registered report with the parameters that select real groups here."""
    bound = {"it_data": {"area": TOP_AREA}, "marketing_address_info": {"area": SPLIT_AREA},
             "top_3_most_sold_per_department_netherlands": {"country": COUNTRY}}
    lines = {"top_3_most_sold_per_department_netherlands": sales_details(t, _R5_COLS),
             "best_salesperson": sales_details(t, _R6_COLS)}

    def bind(folder, fn):
        if R.takes_people(fn):
            return lambda calls, details, _, people=None: fn(calls, details, None, people=people,
                                                             **bound.get(folder, {}))
        return lambda calls, details, _: fn(calls, details, lines.get(folder), **bound.get(folder, {}))

    return {folder: bind(folder, fn) for folder, fn in R.REPORTS.items()}


def _written_rows(spark, out, report):
    return spark.read.option("header", True).csv(os.path.join(out, report)).count()


def q_report_status(spark, sf_dir):
    """Every registered report and one that fails, through the runner: status, rows read
    back from what was written, and whether the error names the report."""
    t = load_tpch(spark, sf_dir)
    runs = {BROKEN: lambda calls, details, _: calls.select("no_such_column")} | _bound_reports(t)
    out = shared_dir(spark, "reports")
    try:
        rows = [(s.report, s.status, _written_rows(spark, out, s.report) if s.status == R.SUCCESS else None,
                 s.error is not None and s.report in s.error)
                for s in R.run_reports(employee_calls(t), employee_details(t), None, out, runs)]
    finally:
        remove_dir(spark, out)
    return spark.createDataFrame(rows, "report string, status string, n_rows bigint, "
                                       "error_names_report boolean")


KILLED = "department_breakdown"


def q_report_resume(spark, sf_dir):
    """A run in which one report dies while it writes, and the same run taken up again: both
    statuses, what the second run left as it was, and the rows that are there at last. Calls and
    details are joined once in each."""
    t = load_tpch(spark, sf_dir)
    runs = _bound_reports(t)
    killed = runs | {KILLED: lambda calls, details, _, people=None: runs[KILLED](
        calls, details, _, people=people).withColumn("died", F.raise_error(F.lit("killed")).cast("string"))}
    out = shared_dir(spark, "reports")
    calls, details = employee_calls(t), employee_details(t)
    try:
        first, second = ({s.report: s for s in R.run_reports(calls, details, None, out, r, run_id="q1", share=True)}
                         for r in (killed, runs))
        rows = [(name, first[name].status, s.status, s.resumed, _written_rows(spark, out, name))
                for name, s in second.items()]
    finally:
        remove_dir(spark, out)
    return spark.createDataFrame(rows, "report string, first_status string, status string, resumed boolean, "
                                       "n_rows bigint")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "top_n_by_sales": q_top_n_by_sales,
    "address_split": q_address_split,
    "area_breakdown": q_area_breakdown,
    "area_breakdown_thirds": q_area_breakdown_thirds,
    "area_breakdown_formatted": q_area_breakdown_formatted,
    "top3_performers": q_top3_performers,
    "top3_performers_numeric": q_top3_performers_numeric,
    "top3_products": q_top3_products,
    "top3_products_numeric": q_top3_products_numeric,
    "best_per_country": q_best_per_country,
    "best_per_country_numeric": q_best_per_country_numeric,
    "sales_formatted": q_sales_formatted,
    "dq_report": q_dq_report,
    "dq_halt": q_dq_halt,
    "dq_basic_sales": q_dq_basic_sales,
    "dq_non_negative": q_dq_non_negative,
    "dq_calls": q_dq_calls,
    "dq_address": q_dq_address,
    "dq_orphans": q_dq_orphans,
    "dq_duplicate_rows": q_dq_duplicate_rows,
    "dq_orphan_rows": q_dq_orphan_rows,
    "dq_negative_rows": q_dq_negative_rows,
    "dq_address_rows": q_dq_address_rows,
    "dq_row_count": q_dq_row_count,
    "dq_non_null": q_dq_non_null,
    "dq_unique": q_dq_unique,
    "dq_referential": q_dq_referential,
    "dq_null_rows": q_dq_null_rows,
    "dq_unique_columns": q_dq_unique_columns,
    "dq_violation_vectors": q_dq_violation_vectors,
    "dq_stream": q_dq_stream,
    "csv_malformed": q_csv_malformed,
    "csv_round_trip": q_csv_round_trip,
    "csv_mixed_headers": q_csv_mixed_headers,
    "csv_records": q_csv_records,
    "report_status": q_report_status,
    "report_resume": q_report_resume,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the whole quality suite over the three derived tables."""
    return q_dq_report(spark, DEFAULT_SF)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | CORPUS


# ================================================================== oracle SQL

_VIEWS = r"""
WITH employee_calls AS (
  SELECT c.c_custkey AS id, c.c_mktsegment AS area,
         CAST(coalesce(u.calls_made, 0) AS BIGINT) AS calls_made,
         CAST(coalesce(u.calls_successful, 0) AS BIGINT) AS calls_successful
  FROM customer c
  LEFT JOIN (SELECT o_custkey, count(*) AS calls_made,
                    count(*) FILTER (WHERE o_orderstatus <> 'P') AS calls_successful
             FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey) u
    ON c.c_custkey = u.o_custkey
),
employee_details AS (
  SELECT c.c_custkey AS id, c.c_name AS name,
         CASE c.c_custkey % 5
           WHEN 0 THEN 'Main Street, ' || CAST(c.c_custkey AS VARCHAR) || ', ' || c.z
           WHEN 1 THEN c.z || ', ' || n.n_name
           WHEN 2 THEN 'Lindehof 5, ' || c.z || ', ' || n.n_name
           WHEN 3 THEN 'Main Street 10'
         END AS address,
         CASE WHEN c.c_custkey % 50 = 0 THEN NULL ELSE c.c_acctbal END AS sales_amount
  FROM (SELECT *, CAST(1000 + c_custkey % 9000 AS VARCHAR) || ' ' || substr(c_mktsegment, 1, 2) AS z
        FROM customer) c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
sales_details AS (
  SELECT CAST(l.l_orderkey * 10 + l.l_linenumber AS BIGINT) AS id,
         CASE WHEN o.o_orderkey % 1000 = 0 THEN -1 - o.o_custkey ELSE o.o_custkey END AS caller_id,
         s.s_name AS company, cu.c_name AS recipient,
         CAST(18 + o.o_custkey % 60 AS INTEGER) AS age,
         n.n_name AS country, p.p_name AS product_sold,
         CAST(l.l_quantity AS BIGINT) AS quantity
  FROM lineitem l
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN customer cu ON o.o_custkey = cu.c_custkey
),
calls_details AS (
  SELECT c.id, c.area, c.calls_made, c.calls_successful, d.name, d.address, d.sales_amount
  FROM employee_calls c JOIN employee_details d ON c.id = d.id
)
"""


def _j2(expr: str) -> str:
    """Java ``%.2f`` rounding in DuckDB: HALF_UP on the shortest decimal form."""
    return f"round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), 2)"


def _money(expr: str) -> str:
    return f"format('{{:,.2f}}', {_j2(expr)})"


def _pct(expr: str) -> str:
    return f"format('{{:.2f}} %', {_j2(expr)})"


def _count(expr: str) -> str:
    return f"format('{{:,d}}', CAST(({expr}) AS BIGINT))"


def _result(dataset, check, column, total, viol, source, where="") -> str:
    col = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return (f"SELECT '{dataset}' AS dataset, '{check}' AS check_name, {col} AS column_name, "
            f"CAST({total} AS BIGINT) AS total, CAST({viol} AS BIGINT) AS violations, "
            f"CAST({viol} AS BIGINT) = 0 AS passed FROM {source} {where}")


def _cnt(pred: str) -> str:
    return f"count(*) FILTER (WHERE {pred})"


def _uniq(col: str) -> str:
    return (f"count(*) - (count(DISTINCT {col}) + "
            f"coalesce(max(CASE WHEN {col} IS NULL THEN 1 ELSE 0 END), 0))")


# Fixed values, written out here so that the expected results do not follow the library's.
_ZIP_RE = r"\d{4} [A-Z]{2}"
_ADDRESS_RE = r"^[A-Za-z0-9-\s]+, \d+, \d{4} [A-Z]{2}$"
_EDGE_RE = r"^,\s*|,\s*$"


def _basic(dataset: str, view: str, expected: int, non_negative: list[str]) -> list[str]:
    parts = [
        _result(dataset, "row_count", None, "count(*)", f"abs(count(*) - {expected})", view),
        _result(dataset, "col_unique", "id", "count(*)", _uniq("id"), view),
        _result(dataset, "col_non_null", "id", "count(*)", _cnt("id IS NULL"), view),
    ]
    parts += [_result(dataset, "col_non_negative", c, "count(*)", _cnt(f"{c} < 0"), view)
              for c in non_negative]
    return parts


_CALLS_RULE = _result("Employee_calls", "calls_successful_gt_made", "calls_successful",
                      "count(*)", _cnt("calls_successful > calls_made"), "employee_calls")
_ADDRESS = _result("Employee_details", "address_format", "address", "count(*)",
                   _cnt(f"address IS NULL OR NOT regexp_matches(address, '{_ADDRESS_RE}')"),
                   "employee_details")
_REFERENTIAL = _result(
    "Sales_details", "referential_integrity", "caller_id", "count(*)",
    "count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM employee_calls c "
    "WHERE c.id IS NOT DISTINCT FROM k.caller_id))",
    "(SELECT DISTINCT caller_id FROM sales_details) k")

_SALES_BASIC = _basic("Sales_details", "sales_details", 10000, ["quantity", "age"])


def _check(dataset, view, check, column, viol):
    return _result(dataset, check, column, "count(*)", viol, view)


def _non_null(dataset, view, column):
    return _check(dataset, view, "col_non_null", column, _cnt(f"{column} IS NULL"))


def _unique(dataset, view, column):
    return _check(dataset, view, "col_unique", column, _uniq(column))


def _row_count(dataset, view, expected):
    return _result(dataset, "row_count", None, "count(*)", f"abs(count(*) - {expected})", view)
_DQ_REPORT = (_basic("Employee_calls", "employee_calls", 1000,
                     ["calls_made", "calls_successful"])
              + _basic("Employee_details", "employee_details", 1000, ["sales_amount"])
              + _SALES_BASIC + [_CALLS_RULE, _ADDRESS, _REFERENTIAL])

def _breakdown(amount: str) -> str:
    return f"""
SELECT area, {_money('total_sales')} AS total_sales_amount,
       {_pct('success_rate')} AS success_rate_pct
FROM (SELECT area, fsum({amount}) AS total_sales,
             CAST(sum(calls_successful) AS DOUBLE)
               / nullif(CAST(sum(calls_made) AS DOUBLE), 0) * 100 AS success_rate
      FROM calls_details GROUP BY area) b"""


def _written(report: str, key: str) -> str:
    return (f"SELECT '{report}' AS report, 'SUCCESS' AS status, count(*) AS n_rows, "
            f"false AS error_names_report FROM ({_ORACLE_BODIES[key]}) q")


_ORACLE_BODIES = {
    "top_n_by_sales": f"""
SELECT id, area, calls_made, calls_successful, name, address,
       coalesce(sales_amount, 0.0) AS sales_amount
FROM calls_details WHERE area = '{TOP_AREA}'
ORDER BY coalesce(sales_amount, 0.0) DESC, id ASC LIMIT 100""",
    "address_split": rf"""
SELECT name,
       trim(regexp_replace(regexp_replace(address, '{_ZIP_RE},?\s*', '', 'g'),
                           '{_EDGE_RE}', '', 'g')) AS address,
       regexp_extract(address, '({_ZIP_RE})', 1) AS zip_code
FROM calls_details WHERE area = '{SPLIT_AREA}'""",
    "area_breakdown": """
SELECT area, round(fsum(sales_amount), 4) AS total_sales,
       CAST(sum(calls_successful) AS DOUBLE) / nullif(CAST(sum(calls_made) AS DOUBLE), 0) * 100
         AS success_rate
FROM calls_details GROUP BY area""",
    "area_breakdown_formatted": _breakdown("sales_amount"),
    "area_breakdown_thirds": _breakdown("sales_amount / 3"),
    "top3_performers": f"""
SELECT area, name, {_money('sales_amount')} AS sales_amount,
       {_pct('success_rate * 100')} AS success_rate_pct, rank
FROM (SELECT area, name, sales_amount, success_rate,
             CAST(rank() OVER (PARTITION BY area ORDER BY sales_amount DESC NULLS LAST,
                                                       success_rate DESC NULLS LAST) AS INTEGER) AS rank
      FROM (SELECT *, calls_successful / nullif(calls_made, 0) AS success_rate
            FROM calls_details) r
      WHERE success_rate > 0.75) t
WHERE rank <= 3""",
    "top3_performers_numeric": """
SELECT area, name, sales_amount, success_rate, rank
FROM (SELECT area, name, sales_amount, success_rate,
             CAST(rank() OVER (PARTITION BY area ORDER BY sales_amount DESC NULLS LAST,
                                                       success_rate DESC NULLS LAST) AS INTEGER) AS rank
      FROM (SELECT *, calls_successful / nullif(calls_made, 0) AS success_rate
            FROM calls_details) r
      WHERE success_rate > 0.75) t
WHERE rank <= 3""",
    "top3_products": f"""
SELECT area, product_sold, {_count('total_quantity')} AS total_quantity, rank
FROM (SELECT c.area, s.product_sold, sum(s.quantity) AS total_quantity,
             CAST(rank() OVER (PARTITION BY c.area ORDER BY sum(s.quantity) DESC NULLS LAST)
                  AS INTEGER) AS rank
      FROM employee_calls c JOIN sales_details s ON c.id = s.caller_id
      WHERE s.country = '{COUNTRY}'
      GROUP BY c.area, s.product_sold) t
WHERE rank <= 3""",
    "top3_products_numeric": f"""
SELECT area, product_sold, CAST(total_quantity AS BIGINT) AS total_quantity, rank
FROM (SELECT c.area, s.product_sold, sum(s.quantity) AS total_quantity,
             CAST(rank() OVER (PARTITION BY c.area ORDER BY sum(s.quantity) DESC NULLS LAST)
                  AS INTEGER) AS rank
      FROM employee_calls c JOIN sales_details s ON c.id = s.caller_id
      WHERE s.country = '{COUNTRY}'
      GROUP BY c.area, s.product_sold) t
WHERE rank <= 3""",
    "best_per_country": f"""
SELECT name, country, {_count('total_quantity')} AS total_quantity,
       {_money('sales_amount')} AS sales_amount
FROM (SELECT d.id, s.country, d.name, d.sales_amount, sum(s.quantity) AS total_quantity,
             rank() OVER (PARTITION BY s.country ORDER BY sum(s.quantity) DESC NULLS LAST,
                                                        d.sales_amount DESC NULLS LAST) AS rnk
      FROM employee_details d JOIN sales_details s ON d.id = s.caller_id
      GROUP BY d.id, s.country, d.name, d.sales_amount) t
WHERE rnk = 1""",
    "best_per_country_numeric": """
SELECT id, name, country, CAST(total_quantity AS BIGINT) AS total_quantity, sales_amount,
       CAST(rnk AS INTEGER) AS rank
FROM (SELECT d.id, s.country, d.name, d.sales_amount, sum(s.quantity) AS total_quantity,
             rank() OVER (PARTITION BY s.country ORDER BY sum(s.quantity) DESC NULLS LAST,
                                                        d.sales_amount DESC NULLS LAST) AS rnk
      FROM employee_details d JOIN sales_details s ON d.id = s.caller_id
      GROUP BY d.id, s.country, d.name, d.sales_amount) t
WHERE rnk = 1""",
    "sales_formatted": f"""
SELECT id, {_money('sales_amount')} AS sales_display
FROM employee_details WHERE sales_amount IS NOT NULL""",
    "dq_report": "\nUNION ALL\n".join(_DQ_REPORT),
    "dq_basic_sales": "\nUNION ALL\n".join(_SALES_BASIC),
    "dq_non_negative": _result("Employee_details", "col_non_negative", "sales_amount",
                               "count(*)", _cnt("sales_amount < 0"), "employee_details"),
    "dq_calls": _CALLS_RULE + "\nUNION ALL\n" + _result(
        "Employee_calls", "zero_calls", "calls_made", "count(*)", _cnt("calls_made = 0"),
        "employee_calls"),
    "dq_address": _ADDRESS,
    "dq_orphans": """
SELECT count(*) AS orphan_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS orphan_rows
FROM (SELECT caller_id, count(*) AS n FROM sales_details GROUP BY caller_id) k
WHERE NOT EXISTS (SELECT 1 FROM employee_calls c WHERE c.id IS NOT DISTINCT FROM k.caller_id)""",
    "dq_duplicate_rows": """
SELECT s.* FROM sales_details s
WHERE EXISTS (SELECT 1 FROM (SELECT id FROM sales_details GROUP BY id HAVING count(*) > 1) d
              WHERE d.id IS NOT DISTINCT FROM s.id)""",
    "dq_orphan_rows": """
SELECT s.* FROM sales_details s
WHERE NOT EXISTS (SELECT 1 FROM employee_calls c WHERE c.id IS NOT DISTINCT FROM s.caller_id)""",
    "dq_negative_rows": "SELECT * FROM employee_details WHERE sales_amount < 0",
    "dq_address_rows": f"""
SELECT * FROM employee_details
WHERE address IS NULL OR NOT regexp_matches(address, '{_ADDRESS_RE}')""",
    "dq_row_count": "\nUNION ALL\n".join([
        _row_count("Employee_calls", "employee_calls", 1000),
        _row_count("Employee_details", "employee_details", 1000),
        _row_count("Sales_details", "sales_details", 10000)]),
    "dq_non_null": "\nUNION ALL\n".join([
        _non_null("Employee_calls", "employee_calls", "id"),
        _non_null("Employee_calls", "employee_calls", "area"),
        _non_null("Employee_details", "employee_details", "id"),
        _non_null("Employee_details", "employee_details", "address"),
        _non_null("Employee_details", "employee_details", "sales_amount"),
        _non_null("Sales_details", "sales_details", "id"),
        _non_null("Sales_details", "sales_details", "caller_id")]),
    "dq_unique": "\nUNION ALL\n".join([
        _unique("Employee_calls", "employee_calls", "id"),
        _unique("Employee_details", "employee_details", "id"),
        _unique("Employee_details", "employee_details", "name"),
        _unique("Sales_details", "sales_details", "id")]),
    "dq_referential": _REFERENTIAL,
    "dq_null_rows": "SELECT * FROM employee_details WHERE address IS NULL",
    "dq_unique_columns": "\nUNION ALL\n".join([
        *[_unique("Sales_details", "sales_details", c) for c in ("id", "caller_id", "age", "quantity")],
        _check("Sales_details", "sales_details", "col_non_negative", "caller_id", _cnt("caller_id < 0")),
        _REFERENTIAL]),
    "dq_violation_vectors": f"""
SELECT dataset, id, CAST(len(f) AS BIGINT) AS n_failed, array_to_string(f, '; ') AS failed
FROM (SELECT 'Employee_calls' AS dataset, id, list_filter([
        CASE WHEN calls_successful > calls_made
             THEN 'calls_successful_gt_made:' || calls_successful || '/' || calls_made END,
        CASE WHEN calls_successful * 2 < calls_made THEN 'few_successes:' || calls_successful || '/' || calls_made END,
        CASE WHEN calls_made = 0 THEN 'zero_calls:' || calls_made END], lambda x: x IS NOT NULL) AS f
      FROM employee_calls
      UNION ALL
      SELECT 'Employee_details', id, list_filter([
        CASE WHEN address IS NULL THEN 'col_non_null:?' END,
        CASE WHEN sales_amount IS NULL THEN 'col_non_null:?' END,
        CASE WHEN sales_amount < 0 THEN 'col_non_negative:' || sales_amount END,
        CASE WHEN address IS NULL OR NOT regexp_matches(address, '{_ADDRESS_RE}')
             THEN 'address_format:' || coalesce(address, '?') END], lambda x: x IS NOT NULL)
      FROM employee_details) v
WHERE len(f) > 0""",
    "dq_stream": "\nUNION ALL\n".join([
        _non_null("Employee_details", "employee_details", "id"),
        _check("Employee_details", "employee_details", "col_non_negative", "sales_amount",
               _cnt("sales_amount < 0")),
        _ADDRESS]),
    "csv_round_trip": r"""
SELECT id, name,
       CASE WHEN id % 10 = 0 THEN NULL ELSE
         CASE id % 9 WHEN 0 THEN '  ' || a || '  ' WHEN 1 THEN chr(9) || a WHEN 2 THEN '"' || a || '" said'
                     WHEN 3 THEN a || ',' WHEN 4 THEN 'line' || chr(10) || 'break ' || a
                     WHEN 5 THEN a || chr(13) || chr(10) WHEN 6 THEN 'back\slash ' || a || '\'
                     WHEN 7 THEN '\n ' || a ELSE '' END END AS address, sales_amount
FROM (SELECT *, coalesce(address, ' ') AS a FROM employee_details) d""",
    "csv_mixed_headers": "SELECT * FROM employee_details",
    "csv_records": """
SELECT CAST(l_linenumber AS INTEGER) AS age,
       CASE WHEN l_linenumber IN (2, 3, 4) THEN '(width)' WHEN l_linenumber = 5 THEN 'quantity' ELSE '' END AS listed,
       count(*) AS n_rows, count(*) FILTER (WHERE l_linenumber NOT IN (2, 5)) AS n_quantity,
       CAST(sum(CASE WHEN l_linenumber IN (2, 3, 4, 5) THEN
              len(CAST(l_orderkey AS VARCHAR)) + 1 + len(CAST(l_linenumber AS VARCHAR))
              + CASE l_linenumber WHEN 2 THEN 0 WHEN 5 THEN 5
                  ELSE 1 + len(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR))
                       + CASE l_linenumber WHEN 3 THEN 5 ELSE 1 END END
            ELSE 0 END) AS BIGINT) AS record_chars
FROM lineitem GROUP BY l_linenumber""",
    "dq_halt": "SELECT *, NOT passed AND check_name IN ('address_format', 'zero_calls', 'col_unique') "
               "AS halts FROM (" + "\nUNION ALL\n".join(
                   _basic("Employee_calls", "employee_calls", 1000, ["calls_made", "calls_successful"])
                   + _basic("Employee_details", "employee_details", 1000, ["sales_amount"])
                   + [_CALLS_RULE, _ADDRESS, _result("Employee_calls", "zero_calls", "calls_made",
                                                     "count(*)", _cnt("calls_made = 0"),
                                                     "employee_calls")]) + ") r",
    "csv_malformed": "\nUNION ALL\n".join([
        _check("Sales_details", "lineitem", "csv_malformed", None, _cnt("l_linenumber IN (6, 7)")),
        _check("Sales_details", "lineitem", "col_non_null", "quantity", _cnt("l_linenumber IN (6, 7)")),
        _check("Sales_details", "lineitem", "col_non_null", "id", _cnt("false")),
        _check("Sales_details", "lineitem", "large", "quantity",
               _cnt("l_linenumber NOT IN (6, 7) AND l_quantity > 25"))]),
}
_REPORT_KEYS = {"it_data": "top_n_by_sales", "marketing_address_info": "address_split",
                "department_breakdown": "area_breakdown_formatted", "top_3": "top3_performers",
                "top_3_most_sold_per_department_netherlands": "top3_products", "best_salesperson": "best_per_country"}
_ORACLE_BODIES["report_status"] = "\nUNION ALL\n".join([
    f"SELECT '{BROKEN}' AS report, 'FAILED' AS status, CAST(NULL AS BIGINT) AS n_rows, "
    "true AS error_names_report", *[_written(report, key) for report, key in _REPORT_KEYS.items()]])
_ORACLE_BODIES["report_resume"] = "\nUNION ALL\n".join(
    f"SELECT '{report}' AS report, '{'FAILED' if report == KILLED else 'SUCCESS'}' AS first_status, "
    f"'SUCCESS' AS status, {str(report != KILLED).lower()} AS resumed, count(*) AS n_rows "
    f"FROM ({_ORACLE_BODIES[key]}) q" for report, key in _REPORT_KEYS.items())


def oracle_sql() -> dict[str, str]:
    return ({k: _VIEWS + v for k, v in _ORACLE_BODIES.items()}
            | CORPUS_SQL)


if __name__ == "__main__":  # manual smoke run
    spark = SparkSession.builder.master("local[*]").config("spark.ui.enabled", "false") \
        .getOrCreate()
    entry(spark).show(truncate=False)
    print(os.linesep.join(sorted(queries())))
