"""Data-quality checks: what passes and fails, their edges, and the one-pass evaluation."""

import pytest
from pyspark.sql import functions as F

from veritab.operators import quality as q
from veritab.plans import quality as dq
from veritab.plans.quality import standard_suite


def _ints(spark, values, name="id"):
    return spark.createDataFrame([(v,) for v in values], f"{name} long")


# ---------------------------------------------------------------- row count

@pytest.mark.parametrize("n, expected, ok", [(3, 3, True), (0, 0, True), (2, 5, False),
                                             (0, 3, False)])
def test_row_count(spark, n, expected, ok):
    assert dq.check_row_count(_ints(spark, range(n)), expected, "T") is ok


def test_row_count_halts(spark):
    with pytest.raises(RuntimeError, match="T"):
        dq.check_row_count(_ints(spark, [1]), 2, "T", halt_on_failure=True)
    assert dq.check_row_count(_ints(spark, [1]), 2, "T", halt_on_failure=None) is False


# ------------------------------------------------------------------ non-null

def _people(spark, rows):
    return spark.createDataFrame(rows, "name string, email string")


def test_non_null(spark):
    df = _people(spark, [("a", "x"), ("b", "y")])
    assert dq.check_col_non_null(df, "P", ["name", "email"])
    assert dq.check_col_non_null(df, "P", [])


def test_non_null_names_only_failing_column(spark):
    df = _people(spark, [("a", None)])
    assert dq.check_col_non_null(df, "P", ["name", "email"]) is False
    with pytest.raises(RuntimeError) as err:
        dq.check_col_non_null(df, "P", ["name", "email"], halt_on_failure=True)
    assert "P.email" in str(err.value) and "P.name" not in str(err.value)


def test_non_null_unknown_column(spark):
    with pytest.raises(ValueError, match="nope"):
        dq.check_col_non_null(_people(spark, [("a", "b")]), "P", ["nope"])


# -------------------------------------------------------------------- unique

def test_unique(spark):
    assert dq.check_col_unique(_ints(spark, [1, 2, 3]), "T", ["id"])
    assert dq.check_col_unique(_ints(spark, [1, 1]), "T", [])
    assert dq.check_col_unique(_ints(spark, []), "T", ["id"])
    assert dq.check_col_unique(_ints(spark, [1, 1]), "T", ["id"]) is False


def test_unique_null_is_one_value(spark):
    assert dq.check_col_unique(_ints(spark, [1, None]), "T", ["id"])
    assert dq.check_col_unique(_ints(spark, [1, None, None]), "T", ["id"]) is False


def test_unique_each_column_alone_and_named(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a")], "id long, code string")
    with pytest.raises(RuntimeError) as err:
        dq.check_col_unique(df, "T", ["id", "code"], halt_on_failure=True)
    assert "T.code" in str(err.value) and "T.id" not in str(err.value)


# -------------------------------------------------------------- non-negative

def test_non_negative(spark):
    df = spark.createDataFrame([(1, 0), (5, None)], "qty long, price long")
    assert dq.check_col_non_negative(df, "T", ["qty", "price"])
    assert dq.check_col_non_negative(df, "T", [])
    bad = spark.createDataFrame([(1, -1)], "qty long, price long")
    assert dq.check_col_non_negative(bad, "T", ["qty", "price"]) is False
    with pytest.raises(RuntimeError, match="price"):
        dq.check_col_non_negative(bad, "T", ["qty", "price"], halt_on_failure=True)


# --------------------------------------------------------------- referential

def test_referential(spark):
    parent = _ints(spark, [1, 2])
    ok = _ints(spark, [1, 2, 2], "caller_id")
    assert dq.check_referential_integrity(parent, ["id"], ok, ["caller_id"], "S")
    assert dq.check_referential_integrity(parent, ["id"], _ints(spark, [], "caller_id"),
                                          ["caller_id"], "S")
    for child in ([1, 99], [99, 100]):
        assert dq.check_referential_integrity(
            parent, ["id"], _ints(spark, child, "caller_id"), ["caller_id"], "S") is False


def test_referential_counts_distinct_orphans_and_null_safety(spark):
    tables = {"P": _ints(spark, [1, 2]), "C": _ints(spark, [1, 7, 7, 8, None], "caller_id")}
    chk = q.referential("C", ["caller_id"], "P", ["id"])
    row = q.evaluate(tables, chk).collect()[0]
    assert (row["total"], row["violations"]) == (4, 3)  # keys 1,7,8,null; orphans 7,8,null
    assert q.violations(tables, chk[0]).count() == 4    # rows 7,7,8,null
    tables["P"] = _ints(spark, [1, 2, None])
    assert q.evaluate(tables, chk).collect()[0]["violations"] == 2


def test_referential_argument_errors(spark):
    parent, child = _ints(spark, [1]), _ints(spark, [1], "caller_id")
    with pytest.raises(ValueError, match="parent"):
        dq.check_referential_integrity(parent, ["nope"], child, ["caller_id"], "S")
    with pytest.raises(ValueError, match="child"):
        dq.check_referential_integrity(parent, ["id"], child, ["nope"], "S")
    with pytest.raises(ValueError, match="same length"):
        dq.check_referential_integrity(parent, ["id", "id"], child, ["caller_id"], "S")


def test_referential_halts(spark):
    with pytest.raises(RuntimeError, match="S"):
        dq.check_referential_integrity(_ints(spark, [1]), ["id"], _ints(spark, [5], "caller_id"),
                                       ["caller_id"], "S", halt_on_failure=True)


# ------------------------------------------------------ successful <= made

def _calls(spark, rows):
    return spark.createDataFrame(rows, "calls_successful long, calls_made long")


def test_calls_rule(spark):
    fine = _calls(spark, [(0, 0), (0, 41), (3, 4), (12, 12), (None, 2), (2, None)])
    assert dq.check_calls_successful_gt_made(fine, "C")
    assert dq.check_calls_successful_gt_made(_calls(spark, []), "C")
    off = _calls(spark, [(12, 12), (13, 12), (1, 0)])
    assert dq.check_calls_successful_gt_made(off, "C") is False
    with pytest.raises(RuntimeError, match="2 of 3 rows"):
        dq.check_calls_successful_gt_made(off, "C", halt_on_failure=True)
    with pytest.raises(ValueError):
        dq.check_calls_successful_gt_made(spark.range(1), "C")


# ------------------------------------------------------------------ address

# one address for each thing the pattern says
VALID = ["Kade, 3, 7001 QX", "Noord-Zuid Pad 9, 250, 9330 LK", "5e Dwarsweg, 0, 0000 AA",
         "-, 1, 1000 AA", "A\tB, 1, 1000 AA"]
INVALID = [None, "", "Kade, 3", "Kade 3, 7001 QX",        # a part is missing
           "Kade, 3b, 7001 QX", "Kade, , 7001 QX",        # the number is not just digits
           "Kade, 3, 700 QX", "Kade, 3, 70011 QX",        # four digits
           "Kade, 3, 7001QX", "Kade, 3, 7001 Qx", "Kade, 3, 7001 Q", "Kade, 3, 7001 QXY",
           "Kade,3, 7001 QX", "Kade, 3, 7001 QX.",        # blanks and the end
           "Straße, 3, 7001 QX", "St. Jan, 3, 7001 QX", ", 3, 7001 QX"]


def _addr(spark, values):
    return spark.createDataFrame([(v,) for v in values], "address string")


@pytest.mark.parametrize("value", VALID)
def test_address_valid(spark, value):
    assert dq.check_address_format(_addr(spark, [value]), "D")


@pytest.mark.parametrize("value", INVALID)
def test_address_invalid(spark, value):
    assert dq.check_address_format(_addr(spark, [value]), "D") is False


def test_address_empty_table_and_missing_column(spark):
    assert dq.check_address_format(_addr(spark, []), "D")
    with pytest.raises(ValueError):
        dq.check_address_format(spark.range(1), "D")


# ------------------------------------------------------ suite, gate, rows

@pytest.fixture
def tables(spark, tmp_path):
    calls = spark.createDataFrame([(1, "IT", 4, 3), (2, "HR", 0, 0), (3, "IT", 2, 5)],
                                  "id long, area string, calls_made long, calls_successful long")
    details = spark.createDataFrame(
        [(1, "A", "Kade, 3, 7001 QX", 10.0), (2, "B", "bad", -1.0),
         (2, "C", None, None)], "id long, name string, address string, sales_amount double")
    sales = spark.createDataFrame(
        [(1, 1, "x", "y", 30, "NL", "W", 3), (2, 9, "x", "y", -1, "NL", "W", 1),
         (2, None, "x", "y", 20, "NL", "W", -4)],
        "id long, caller_id long, company string, recipient string, age int, country string, "
        "product_sold string, quantity long")
    out = {}
    for name, df in {"Employee_calls": calls, "Employee_details": details,
                     "Sales_details": sales}.items():
        path = str(tmp_path / name)
        df.write.parquet(path)
        out[name] = spark.read.parquet(path)
    return out


def test_suite_results(tables):
    rows = q.evaluate(tables, standard_suite({"Employee_calls": 3, "Employee_details": 1000,
                                               "Sales_details": None})).collect()
    got = {(r["dataset"], r["check_name"], r["column_name"]): (r["total"], r["violations"])
           for r in rows}
    assert got[("Employee_calls", "row_count", None)] == (3, 0)
    assert got[("Employee_details", "row_count", None)] == (3, 997)
    assert ("Sales_details", "row_count", None) not in got
    assert got[("Employee_details", "col_unique", "id")] == (3, 1)
    assert got[("Sales_details", "col_non_negative", "age")] == (3, 1)
    assert got[("Sales_details", "col_non_negative", "quantity")] == (3, 1)
    assert got[("Employee_calls", "calls_successful_gt_made", "calls_successful")] == (3, 1)
    assert got[("Employee_details", "address_format", "address")] == (3, 2)
    assert got[("Sales_details", "referential_integrity", "caller_id")] == (3, 2)
    assert len(rows) == 16


def test_suite_scans_each_table_once(tables):
    res = q.evaluate(tables, standard_suite())
    plan = res._jdf.queryExecution().executedPlan().toString()
    # calls: shared aggregate + referential parent; details: 1; sales: aggregate + keyed
    # child keys (the two keyed branches share one exchange)
    scans = plan.count("Scan parquet")
    assert scans <= 6, plan


def test_gate(tables):
    res = q.evaluate(tables, standard_suite())
    assert any(not r["passed"] for r in q.gate(res, []))
    with pytest.raises(RuntimeError) as err:
        q.gate(res, ["address_format", "referential_integrity", "unknown_name"])
    assert "address_format" in str(err.value) and "referential_integrity" in str(err.value)
    assert "col_unique" not in str(err.value)
    with pytest.raises(RuntimeError):
        q.gate(res, ["all"])
    assert q.gate(res.where("passed"), ["all"])


def test_halting_marks_the_failed_checks_of_the_list(tables):
    res = q.evaluate(tables, standard_suite())
    marked = q.halting(res, [" address_format ", "", "row_count"]).collect()
    assert {r["check_name"] for r in marked if r["halts"]} == {"address_format", "row_count"}
    assert all(not r["passed"] for r in marked if r["halts"])
    assert q.halting(res, []).where("halts").count() == 0
    assert q.halting(res, ["all"]).where("halts").count() == res.where("NOT passed").count()


def test_gate_knows_the_names_in_the_results(tables, caplog):
    own = q.rule("Employee_calls", "no_calls", F.col("calls_made") == 0, ["calls_made"])
    with pytest.raises(RuntimeError, match="no_calls"):
        q.gate(q.evaluate(tables, own), ["no_calls", "nonsense"])
    assert "nonsense" in caplog.text
    assert "halt list: nonsense" in caplog.text   # and not the custom check


def test_one_check_says_expected_and_actual(spark):
    with pytest.raises(RuntimeError, match="holds 1 rows, not 2"):
        dq.check_row_count(_ints(spark, [1]), 2, "T", halt_on_failure=True)


def test_duplicate_rows_by_their_keys_alone(tables):
    df = tables["Employee_details"]
    chk = q.unique("Employee_details", ["id"])[0]
    got = q.violations(tables, chk, keys=df.select("id"))
    assert sorted(r["name"] for r in got.collect()) == ["B", "C"]


def test_violation_rows(tables):
    dup = q.violations(tables, q.unique("Employee_details", ["id"])[0])
    assert sorted(r["name"] for r in dup.collect()) == ["B", "C"]
    neg = q.violations(tables, q.non_negative("Employee_details", ["sales_amount"])[0])
    assert [r["name"] for r in neg.collect()] == ["B"]
    bad = q.violations(tables, q.calls_successful_le_made("Employee_calls")[0])
    assert [r["id"] for r in bad.collect()] == [3]
    orphans = q.violations(tables, q.referential("Sales_details", ["caller_id"],
                                                 "Employee_calls", ["id"])[0])
    assert sorted((r["caller_id"] is None, r["caller_id"]) for r in orphans.collect()) == [
        (False, 9), (True, None)]
    addr = q.violations(tables, q.pattern("Employee_details")[0])
    assert addr.count() == 2
    custom = q.rule("Employee_calls", "zero", F.col("calls_made") == 0, ["calls_made"])
    assert q.violations(tables, custom[0]).count() == 1


def test_missing_column_fails_before_any_job(tables):
    with pytest.raises(ValueError):
        q.evaluate(tables, q.non_null("Employee_calls", ["nope"]))
    with pytest.raises(ValueError):
        q.evaluate(tables, q.non_null("Nope", ["id"]))


def test_address_trailing_newline_follows_java_dollar(spark):
    # Java's `$` also matches before a final line terminator, so this passes,
    # exactly as the same rlike check always has
    assert dq.check_address_format(_addr(spark, ["Kade, 3, 7001 QX\n"]), "D")
    assert dq.check_address_format(_addr(spark, ["Kade, 3, 7001 QX\n\n"]), "D") is False


def test_names_with_quotes_survive_the_unpivot(spark):
    name = "O'Brien \\ sales"
    res = q.evaluate({name: _ints(spark, [1, None])}, q.non_null(name, ["id"])).collect()
    assert [(r["dataset"], r["column_name"], r["violations"]) for r in res] == [(name, "id", 1)]


def test_referential_generic_path_for_other_key_types(spark):
    import datetime as dt
    d = [dt.date(2020, 1, i) for i in range(1, 4)]
    tables = {"P": spark.createDataFrame([(d[0],), (d[1],)], "k date"),
              "C": spark.createDataFrame([(d[0],), (d[2],), (d[2],), (None,)], "k date")}
    row = q.evaluate(tables, q.referential("C", ["k"], "P", ["k"])).collect()[0]
    assert (row["total"], row["violations"]) == (3, 2)
    orphans = q.orphan_keys(tables["C"], ["k"], tables["P"], ["k"]).collect()
    assert sorted((r["k"] is None, r["_rows"]) for r in orphans) == [(False, 2), (True, 1)]


def test_referential_shuffles_each_side_once(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = {"P": _ints(spark, range(50)), "C": _ints(spark, [1, 2, 99, None] * 5, "caller_id")}
        res = q.evaluate(tables, q.referential("C", ["caller_id"], "P", ["id"]))
        plan = res._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2, plan
        row = res.collect()[0]
        assert (row["total"], row["violations"]) == (4, 2)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# ------------------------------------------------- several keys in one aggregate

def _mixed(spark):
    rows = [(1, "a", 1.0, 5), (1, "b", -0.0, 5), (2, "b", 0.0, None), (None, None, float("nan"), 7),
            (None, "a b", float("nan"), 9), (3, "", None, 9), (0, "c", 1.5, -1)]
    return spark.createDataFrame(rows, "id long, code string, score double, caller_id int")


def _beyond_distinct(df, column):
    return df.count() - df.select(column).distinct().count()


def test_keys_counted_together_agree_with_distinct(spark):
    df, parent = _mixed(spark), spark.createDataFrame([(5,), (9,), (9,), (None,)], "id long")
    tables = {"T": df, "P": parent}
    checks = (q.row_count("T", 6) + q.unique("T", ["id", "code", "score", "caller_id"])
              + q.non_null("T", ["id"]) + q.non_negative("T", ["score", "caller_id"])
              + q.referential("T", ["caller_id"], "P", ["id"]))
    got = {(r["check_name"], r["column_name"]): (r["total"], r["violations"], r["passed"])
           for r in q.evaluate(tables, checks).collect()}
    for c in ("id", "code", "score", "caller_id"):
        n = _beyond_distinct(df, c)
        assert got["col_unique", c] == (7, n, n == 0)
    assert got["row_count", None] == (7, 1, False)
    assert got["col_non_null", "id"] == (7, 2, False)
    assert got["col_non_negative", "score"] == (7, 0, True)
    assert got["col_non_negative", "caller_id"] == (7, 1, False)
    assert got["referential_integrity", "caller_id"] == (5, 2, False)   # 5, null, 7, 9, -1; 7 and -1 unknown


def test_keys_counted_together_of_an_empty_table(spark):
    df = _mixed(spark).limit(0)
    checks = (q.row_count("T", 0) + q.unique("T", ["id", "code"]) + q.non_null("T", ["id"])
              + q.referential("T", ["caller_id"], "P", ["id"]))
    rows = q.evaluate({"T": df, "P": _ints(spark, [1])}, checks).collect()
    assert [(r["total"], r["violations"], r["passed"]) for r in rows] == [(0, 0, True)] * 5


def test_composite_and_unlike_keys(spark):
    child = spark.createDataFrame([(1, None, "x"), (None, 1, "x"), (1, 1, "y"), (1, 1, "y")], "a int, b int, c string")
    parent = spark.createDataFrame([(1, None, "1", 1.0), (1, 1, "y", 7.5)], "a int, b int, c string, d double")
    tables = {"C": child, "P": parent}
    checks = (q.unique("C", ["a"]) + q.referential("C", ["a", "b"], "P", ["a", "b"])
              + q.referential("C", ["c"], "P", ["c"]) + q.referential("C", ["a"], "P", ["d"]))
    got = {r["column_name"]: (r["total"], r["violations"]) for r in q.evaluate(tables, checks).collect()
           if r["check_name"] == "referential_integrity"}
    # the last check's keys are of two types: joined as Spark compares them
    assert got == {"a,b": (3, 1), "c": (2, 1), "a": (2, 1)}


def test_a_value_that_fills_a_third_of_the_rows(spark):
    df = spark.range(30_000).selectExpr("id % 3 * id AS id", "CAST(id % 3 * id AS STRING) AS code",
                                        "CAST(id % 3 AS INT) AS caller_id")
    checks = q.unique("T", ["id", "code"]) + q.referential("T", ["caller_id"], "P", ["id"])
    rows = q.evaluate({"T": df, "P": _ints(spark, [0, 1])}, checks).collect()
    assert [(r["total"], r["violations"]) for r in rows] == [
        (30_000, _beyond_distinct(df, "id")), (30_000, _beyond_distinct(df, "code")), (3, 1)]


# ------------------------------------------------------------ violation vectors

def test_violation_vectors(tables):
    checks = (q.non_null("Employee_details", ["address", "sales_amount"])
              + q.non_negative("Employee_details", ["sales_amount"]) + q.pattern("Employee_details"))
    got = {r["name"]: [(f["check_name"], f["column_name"], f["raw"]) for f in r["failed"]]
           for r in q.violation_vectors(tables, checks).collect()}
    assert got == {
        "B": [("col_non_negative", "sales_amount", {"sales_amount": "-1.0"}), ("address_format", "address", {"address": "bad"})],
        "C": [("col_non_null", "address", {"address": None}), ("col_non_null", "sales_amount", {"sales_amount": None}),
              ("address_format", "address", {"address": None})]}
    rule = q.calls_successful_le_made("Employee_calls")
    row, = q.violation_vectors(tables, rule).collect()
    assert row["failed"][0]["raw"] == {"calls_successful": "5", "calls_made": "2"}


def test_violation_vectors_agree_with_the_counts(tables):
    checks = (q.non_null("Employee_details", ["name", "address"])
              + q.non_negative("Employee_details", ["sales_amount"]) + q.pattern("Employee_details"))
    counted = {(r["check_name"], r["column_name"]): r["violations"] for r in q.evaluate(tables, checks).collect()}
    listed = dict.fromkeys(counted, 0)
    for r in q.violation_vectors(tables, checks).collect():
        for f in r["failed"]:
            listed[f["check_name"], f["column_name"]] += 1
    assert listed == counted


def test_violation_vectors_are_for_row_level_checks_of_one_dataset(tables):
    with pytest.raises(ValueError, match="col_unique"):
        q.violation_vectors(tables, q.unique("Employee_details", ["id"]))
    with pytest.raises(ValueError, match="several"):
        q.violation_vectors(tables, q.non_null("Employee_details", ["id"]) + q.non_null("Employee_calls", ["id"]))
