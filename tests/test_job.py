"""The whole job on CSV inputs derived from the test tables."""

import os

import pytest

from veritab.__main__ import halt_set, parse
from veritab.plans.job import load_inputs, run_job
from veritab.sources.adapters import employee_calls, employee_details, load_tpch, sales_details
from veritab.sources.files import write_csv
from veritab.sources.schemas import EMPLOYEE_CALLS, EMPLOYEE_DETAILS, SALES_DETAILS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def csv_inputs(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("inputs")
    t = load_tpch(spark, SF)
    paths = {}
    for name, df in {EMPLOYEE_CALLS: employee_calls(t), EMPLOYEE_DETAILS: employee_details(t),
                     SALES_DETAILS: sales_details(t)}.items():
        paths[name] = str(base / f"{name}.csv")
        write_csv(df, paths[name])
    return paths


def test_job_writes_all_reports(spark, csv_inputs, tmp_path):
    tables = load_inputs(spark, csv_inputs)
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared)) if os.path.exists(shared) else set()
    result = run_job(spark, tables, str(tmp_path), stage=True)
    assert result.ok
    assert set(os.listdir(shared)) - before == set()   # the staged copies are gone
    assert [s.report for s in result.reports][:6] == [
        "it_data", "marketing_address_info", "department_breakdown", "top_3",
        "top_3_most_sold_per_department_netherlands", "best_salesperson"]
    assert len(result.quality) == 20   # the suite, and that each CSV table could be read
    for s in result.reports:
        assert os.path.exists(os.path.join(str(tmp_path), s.report, "_SUCCESS"))
    # segments stand in for departments, so the default areas select nothing
    breakdown = spark.read.option("header", True).csv(f"{tmp_path}/department_breakdown")
    assert breakdown.count() == 5


def test_job_halts_before_reports(spark, csv_inputs, tmp_path):
    tables = load_inputs(spark, csv_inputs)
    with pytest.raises(RuntimeError, match="address_format"):
        run_job(spark, tables, str(tmp_path), halt_on={"address_format", "row_count"})
    assert os.listdir(str(tmp_path)) == []


def test_cli_halt_set():
    args = parse(["a", "b", "c", "out", "--halt", " row_count, ,address_format"])
    assert halt_set(args) == {"row_count", "address_format"}
    assert len(halt_set(parse(["a", "b", "c", "out", "--halt-all"]))) == 8


def test_cli_main_exit_codes(spark, csv_inputs, tmp_path):
    from veritab.__main__ import main
    args = [csv_inputs[EMPLOYEE_CALLS], csv_inputs[EMPLOYEE_DETAILS], csv_inputs[SALES_DETAILS]]
    assert main(args + [str(tmp_path / "warn")]) == 0
    assert os.path.exists(str(tmp_path / "warn" / "best_salesperson" / "_SUCCESS"))
    assert main(args + [str(tmp_path / "halt"), "--halt", "address_format"]) == 1
    assert not os.path.exists(str(tmp_path / "halt"))
    # the session's SQL settings were applied
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_cli_stages_csv_by_default():
    from veritab.__main__ import should_stage
    assert should_stage(parse(["a.csv", "b.csv", "c.csv", "out"]))
    assert not should_stage(parse(["a.csv", "b.csv", "c.csv", "out", "--no-stage"]))
    assert not should_stage(parse(["a", "b", "c", "out"]))
    assert should_stage(parse(["a", "b", "c", "out", "--stage"]))
