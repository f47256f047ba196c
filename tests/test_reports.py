"""The six reports on small invented tables, their registry and the runner."""

import os

import pytest
from pyspark.sql import functions as F

from veritab.plans import reports as R

STAFF = "id long, name string, area string, calls_made long, calls_successful long"
PAY = "id long, address string, sales_amount double"
LINES = "caller_id long, country string, product_sold string, quantity long"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def staff(spark, *rows):
    """(id, name, area[, made, successful])"""
    return spark.createDataFrame([(*r, *(10, 9)[len(r) - 3:]) if len(r) < 5 else r for r in rows], STAFF)


def pay(spark, *rows):
    """(id, amount[, address])"""
    return spark.createDataFrame([(r[0], r[2] if len(r) > 2 else None, r[1]) for r in rows], PAY)


def lines(spark, *rows):
    return spark.createDataFrame(list(rows), LINES)


# ------------------------------------------------------------------ R1 top-N

def test_top_sales_orders_one_area_with_nulls_as_zero(spark):
    people = staff(spark, (11, "Ilse", "Depot"), (12, "Tomas", "Depot"), (13, "Wen", "Depot"),
                   (14, "Uma", "Office"), (15, "Pavel", "Depot"))
    amounts = pay(spark, (11, 72.5), (12, None), (13, -4.0), (14, 9000.0), (16, 1.0))
    out = R.top_sales(people, amounts, None, area="Depot")
    assert [(r["name"], r["sales_amount"]) for r in out.collect()] == [
        ("Ilse", 72.5), ("Tomas", 0.0), ("Wen", -4.0)]   # Pavel has no amount row
    assert out.columns == ["id", "name", "area", "calls_made", "calls_successful", "address",
                           "sales_amount"]
    assert "TakeOrderedAndProject" in _plan(out)
    assert R.top_sales(people, amounts, None).count() == 0   # nobody in the default area


def test_top_sales_cut_breaks_ties_by_id(spark):
    people = staff(spark, *[(i, f"worker {i}", "Depot") for i in (8, 3, 5, 6)])
    amounts = pay(spark, (8, 2.0), (3, 7.0), (5, 2.0), (6, 2.0))
    got = R.top_sales(people, amounts, None, area="Depot", n=3).collect()
    assert [r["id"] for r in got] == [3, 5, 6]


# --------------------------------------------------------------- R2 split

@pytest.mark.parametrize("address, rest, code", [
    ("Kade 3-b, Veenwijk, 7001 QX", "Kade 3-b, Veenwijk", "7001 QX"),      # at the end
    ("9330 LK, Hoogland", "Hoogland", "9330 LK"),                         # at the beginning
    ("Molenpad 88, 6125 RT, Zuidbroek", "Molenpad 88, Zuidbroek", "6125 RT"),   # between
    ("3301 AA, Kade, 4402 BB", "Kade", "3301 AA"),                       # twice: first one told
    ("987654 PQRS", "98RS", "7654 PQ"),                                  # inside longer runs
    ("Molenpad 88", "Molenpad 88", ""),
    ("", "", ""),
    (None, None, None),
])
def test_address_info_splits_the_code_off(spark, address, rest, code):
    out = R.address_info(staff(spark, (1, "Uma", "Press"), (2, "Wen", "Depot")),
                         pay(spark, (1, 0.0, address), (2, 0.0, "5000 ZZ")), None, area="Press")
    assert out.columns == ["name", "address", "zip_code"]
    assert [tuple(r) for r in out.collect()] == [("Uma", rest, code)]


# ----------------------------------------------------------- R3 breakdown

def _breakdown(spark, rows, **kwargs):
    """rows of (area, amount, made, successful)"""
    people = staff(spark, *[(i, "n", a, m, s) for i, (a, _, m, s) in enumerate(rows)])
    out = R.department_breakdown(people, pay(spark, *[(i, x) for i, (_, x, _, _) in enumerate(rows)]),
                                 None, **kwargs)
    return {r["area"]: tuple(r)[1:] for r in out.collect()}


def test_breakdown_totals_and_ratio_of_sums(spark):
    got = _breakdown(spark, [("Depot", 1200.25, 1, 1), ("Depot", 34.5, 7, 1), ("Press", 3.0, 3, 2),
                             (None, 8.0, 2, 1)])
    assert got == {"Depot": ("1,234.75", "25.00 %"),   # 2 of 8, not the mean of 1 and 1/7
                   "Press": ("3.00", "66.67 %"), None: ("8.00", "50.00 %")}


def test_breakdown_without_calls_or_amounts_is_null(spark):
    rows = [("Depot", None, 0, 0)]
    assert _breakdown(spark, rows) == {"Depot": (None, None)}
    assert _breakdown(spark, rows, display=False) == {"Depot": (None, None)}


@pytest.mark.parametrize("amounts, shown", [
    ([0.004] * 1000, "4.00"),                 # parts of a cent are not rounded away
    ([5.0, float("nan")], "NaN"),             # nor is a row left out
    ([2e16, 1.0], "20,000,000,000,000,000.00"),
    ([1e30, 1.0], "1,000,000,000,000,000,000,000,000,000,000.00"),   # beyond the decimal
    ([6e19, 6e19], "120,000,000,000,000,000,000.00"),                # its total is
    ([float("inf"), 1.0], "Infinity"),
    ([1 / 3] * 3, "1.00"),
])
def test_breakdown_keeps_every_amount(spark, amounts, shown):
    got = _breakdown(spark, [("Depot", x, 1, 1) for x in amounts])
    assert got["Depot"][0] == shown


# ------------------------------------------------------- R4 top performers

def test_performers_need_more_than_the_threshold(spark):
    people = staff(spark, (1, "at it", "Depot", 8, 6), (2, "above", "Depot", 8, 7),
                   (3, "no calls", "Depot", 0, 0), (4, "unknown", "Depot", None, 3))
    out = R.top_performers(people, pay(spark, *[(i, 50.0) for i in range(1, 5)]), None)
    assert [(r["name"], r["success_rate_pct"], r["rank"]) for r in out.collect()] == [
        ("above", "87.50 %", 1)]


def test_performers_rank_by_amount_then_rate(spark):
    people = staff(spark, (1, "Ilse", "Depot", 10, 8), (2, "Tomas", "Depot", 10, 9), (3, "Wen", "Depot", 10, 10),
                   (4, "Uma", "Depot", 10, 9), (5, "Pavel", "Press", 10, 9), (6, "Rafa", "Depot", 10, 9))
    out = R.top_performers(people, pay(spark, (1, 410.0), (2, 410.0), (3, 63.0), (4, 410.0), (5, None), (6, 700.0)),
                           None)
    got = sorted((r["area"], r["rank"], r["name"], r["sales_amount"]) for r in out.collect()
                 if r["sales_amount"] is not None)
    assert got == [("Depot", 1, "Rafa", "700.00"), ("Depot", 2, "Tomas", "410.00"), ("Depot", 2, "Uma", "410.00")]
    assert [r["name"] for r in out.where("sales_amount IS NULL").collect()] == ["Pavel"]
    assert "WindowGroupLimit" in _plan(out)


def test_performers_ranks_skip_after_a_tie(spark):
    people = staff(spark, *[(i, chr(96 + i), "Depot") for i in range(1, 7)])
    amounts = pay(spark, (1, 31.0), (2, 31.0), (3, 30.5), (4, 30.5), (5, 30.5), (6, None))
    out = R.top_performers(people, amounts, None, display=False)
    assert sorted((r["rank"], r["name"]) for r in out.collect()) == [
        (1, "a"), (1, "b"), (3, "c"), (3, "d"), (3, "e")]


# ---------------------------------------------------------- R5 top products

def test_products_of_one_country_summed_over_callers(spark):
    people = staff(spark, (1, "Ilse", "Depot"), (2, "Tomas", "Depot"), (3, "Wen", "Press"))
    sold = lines(spark, (1, "Chile", "lamp", 900), (2, "Chile", "lamp", 850), (1, "Chile", "rope", 4),
                 (3, "Chile", "rope", 2), (1, "Peru", "tent", 5000), (9, "Chile", "lamp", 7),
                 (2, "Chile", "hook", None))
    out = R.top_products(people, None, sold, country="Chile")
    assert sorted(tuple(r) for r in out.where("total_quantity IS NOT NULL").collect()) == [
        ("Depot", "lamp", "1,750", 1), ("Depot", "rope", "4", 2), ("Press", "rope", "2", 1)]
    assert [tuple(r) for r in out.where("total_quantity IS NULL").collect()] == [("Depot", "hook", None, 3)]
    assert R.top_products(people, None, sold).count() == 0   # nothing from the default country


def test_products_keep_ties_and_drop_the_rest(spark):
    sold = lines(spark, *[(1, "Chile", p, n) for p, n in
                          [("axe", 12), ("bow", 12), ("cup", 11), ("dye", 11), ("elk", 1)]])
    out = R.top_products(staff(spark, (1, "Ilse", "Depot")), None, sold, country="Chile")
    assert sorted((r["rank"], r["product_sold"]) for r in out.collect()) == [
        (1, "axe"), (1, "bow"), (3, "cup"), (3, "dye")]


# ------------------------------------------------------- R6 best salesperson

def _best(spark, people, sold, **kwargs):
    details = spark.createDataFrame(people, "id long, name string, sales_amount double")
    return R.best_salesperson(None, details, lines(spark, *[(i, c, "x", n) for i, c, n in sold]), **kwargs)


def test_best_per_country(spark):
    out = _best(spark, [(1, "Ilse", 20.0), (2, "Tomas", 1310.5), (3, "Wen", 5.0)],
                [(1, "Chile", 700), (1, "Chile", 800), (2, "Chile", 1100), (2, "Peru", 3), (3, "Peru", 2)])
    assert out.columns == ["name", "country", "total_quantity", "sales_amount"]
    assert sorted(tuple(r) for r in out.collect()) == [
        ("Ilse", "Chile", "1,500", "20.00"), ("Tomas", "Peru", "3", "1,310.50")]


def test_best_keeps_namesakes_apart(spark):
    out = _best(spark, [(4, "Wen", 2.0), (5, "Wen", 2.5)], [(4, "Peru", 60), (5, "Peru", 50), (5, "Peru", 9)])
    assert [(r["total_quantity"], r["sales_amount"]) for r in out.collect()] == [("60", "2.00")]


def test_best_tie_goes_to_the_larger_amount_then_to_all(spark):
    sold = [(1, "Peru", 40), (2, "Peru", 40), (3, "Peru", 40), (4, "Peru", 39)]
    people = [(1, "Ilse", 6.0), (2, "Tomas", 8.0), (3, "Wen", 8.0), (4, "Uma", 99.0)]
    assert sorted(r["name"] for r in _best(spark, people, sold).collect()) == ["Tomas", "Wen"]


def test_best_repeated_person_counts_lines_as_a_line_join_would(spark):
    out = _best(spark, [(1, "Ilse", 6.0), (1, "Ilse", 6.0), (2, "Tomas", 6.0)],
                [(1, "Peru", 21), (2, "Peru", 41)], display=False)
    assert [(r["name"], r["total_quantity"]) for r in out.collect()] == [("Ilse", 42)]


# -------------------------------------------------------- registry, runner

FOLDERS = ["it_data", "marketing_address_info", "department_breakdown", "top_3",
           "top_3_most_sold_per_department_netherlands", "best_salesperson"]


def test_registry_order_and_folders():
    assert list(R.REPORTS)[:6] == FOLDERS
    assert R.SUMMARIES == set(FOLDERS) - {"marketing_address_info"}


def test_register_returns_the_function_and_refuses_a_taken_folder():
    try:
        fn = R.report("extra_folder")(len)
        assert fn is len and R.REPORTS["extra_folder"] is len
        with pytest.raises(ValueError, match="extra_folder"):
            R.report("extra_folder")(max)
    finally:
        R.REPORTS.pop("extra_folder")


def test_runner_goes_on_after_a_failure(spark, out_dir):
    df = staff(spark, (1, "Ilse", "Depot"))

    def late(a, b, c):   # fails in a task, not in analysis
        return a.select(F.raise_error(F.lit("no luck")).cast("string").alias("x"))

    runs = {"first": lambda a, b, c: a.select("missing"), "second": late, "third": lambda a, b, c: a}
    done = R.run_reports(df, df, df, out_dir, runs)
    assert [(s.report, s.status) for s in done] == [("first", "FAILED"), ("second", "FAILED"),
                                                    ("third", "SUCCESS")]
    assert done[0].error.startswith("first: ") and "no luck" in done[1].error and done[2].error is None
    assert spark.read.option("header", True).csv(f"{out_dir}/third").count() == 1
    assert R.status_frame(spark, done).where("status = 'FAILED'").count() == 2


def test_single_file_is_for_summaries_only(spark, out_dir):
    df = spark.range(20).repartition(4)
    runs = {"best_salesperson": lambda a, b, c: a, "marketing_address_info": lambda a, b, c: a}
    R.run_reports(df, df, df, out_dir, runs, single_file=True)
    parts = {f: len([p for p in os.listdir(f"{out_dir}/{f}") if p.startswith("part-")]) for f in runs}
    assert parts == {"best_salesperson": 1, "marketing_address_info": 4}


# ------------------------------------------------------------ resume, shared join

def _mtimes(folder):
    return {f: os.stat(os.path.join(folder, f)).st_mtime_ns for f in os.listdir(folder)}


def test_a_run_is_taken_up_where_it_stopped(spark, out_dir):
    df = spark.range(3).selectExpr("id", "'x' AS area")
    good = {f"r{k}": lambda c, d, s, k=k: c.where(f"id < {k}") for k in (1, 2, 3)}
    dead = good | {"r2": lambda c, d, s: c.selectExpr("raise_error('gone') AS x")}
    first = R.run_reports(df, df, df, out_dir, dead, run_id="2024/1 %")
    assert [(s.status, s.resumed) for s in first] == [("SUCCESS", False), ("FAILED", False), ("SUCCESS", False)]
    before = _mtimes(os.path.join(out_dir, "r1"))
    second = R.run_reports(df, df, df, out_dir, good, run_id="2024/1 %")
    assert [(s.status, s.resumed) for s in second] == [("SUCCESS", True), ("SUCCESS", False), ("SUCCESS", True)]
    assert _mtimes(os.path.join(out_dir, "r1")) == before
    assert spark.read.option("header", True).csv(os.path.join(out_dir, "r2")).count() == 2
    # another run writes everything, and the first one's marks are gone with what they stood for
    assert not any(s.resumed for s in R.run_reports(df, df, df, out_dir, good, run_id="2024/2"))
    assert not any(s.resumed for s in R.run_reports(df, df, df, out_dir, good, run_id="2024/1 %"))


def test_a_report_without_its_commit_mark_is_written_again(spark, out_dir):
    df = spark.range(3)
    runs = {"r": lambda c, d, s: c}
    R.run_reports(df, df, df, out_dir, runs, run_id="a")
    os.rename(os.path.join(out_dir, "r", "_SUCCESS"), os.path.join(out_dir, "r", "_old"))
    assert [s.resumed for s in R.run_reports(df, df, df, out_dir, runs, run_id="a")] == [False]


def test_calls_and_details_are_joined_once_for_four_reports(spark, out_dir):
    rows = [(k, "IT" if k % 2 else "Marketing", 4, 4, f"n{k}", f"Kade, {k}, 7001 QX", float(k)) for k in range(20)]
    df = spark.createDataFrame(rows, "id long, area string, calls_made long, calls_successful long, name string, "
                                     "address string, sales_amount double")
    df.write.parquet(os.path.join(out_dir, "in"))
    df = spark.read.parquet(os.path.join(out_dir, "in"))
    calls, details = df.select("id", "area", "calls_made", "calls_successful"), df.select("id", "name", "address", "sales_amount")
    sharing = [f for f, fn in R.REPORTS.items() if R.takes_people(fn)]
    assert len(sharing) == 4
    reports = {f: R.REPORTS[f] for f in sharing}
    got = {}
    for share in (False, True):
        plans = {}

        def write(out, path):
            plans[os.path.basename(path)] = out._jdf.queryExecution().optimizedPlan().toString()
            got[share, os.path.basename(path)] = sorted(map(str, out.collect()))

        shared = spark.conf.get("spark.checkpoint.dir")
        before = set(os.listdir(shared)) if os.path.exists(shared) else set()
        R.run_reports(calls, details, None, out_dir, reports, writer=write, share=share)
        assert sum(plan.count("Join Inner") for plan in plans.values()) == (0 if share else 4)
        assert set(os.listdir(shared)) == before if os.path.exists(shared) else True   # the join's table is gone
    assert all(got[True, f] == got[False, f] != [] for f in sharing)
