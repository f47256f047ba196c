"""Readers, writers, shared folders and the adapter views."""

import os

import pytest
from pyspark.sql import types as T

from veritab.operators import quality as q
from veritab.plans.quality import run_quality
from veritab.sources import adapters as A
from veritab.sources.files import (
    first_lines,
    materialize_at,
    read_csv,
    read_table,
    remove_dir,
    shared_dir,
    write_csv,
)
from veritab.sources.schemas import CALLS_SCHEMA, DETAILS_SCHEMA

SF = "/root/testdata/sf0.001"


HARD = [None, "", " lead", "tail ", " ", "1,500.00", 'say "so"', '"', '" ', "a\\", "x,\\", '\\"', "\\N", "null", "#",
        "new\nline", "\r\n", "\\n", "\\\\n", "\u0000", "a\u0000b", "\u0001", "\\1\u0001", "\u2028", "é", "\t", ",,", "''"]


@pytest.mark.parametrize("columns", [1, 2])
@pytest.mark.parametrize("how", [{}, {"malformed": True}, {"mixed_headers": True}])
def test_csv_round_trip_loses_nothing(spark, out_dir, columns, how):
    schema = T.StructType([T.StructField(f"text {k}", T.StringType()) for k in range(columns)])
    rows = [(v,) * columns for v in HARD] * 2
    if columns == 2:
        rows += [(None, "x"), ("x", None), ("", None), (" ", "")]
    path = os.path.join(out_dir, "a b%20c")
    write_csv(spark.createDataFrame(rows, schema).repartition(3), path)
    got = [tuple(r)[:columns] for r in read_csv(spark, path, schema, lossless=True, **how).collect()]
    assert sorted(got, key=str) == sorted(rows, key=str)


def test_csv_writes_one_line_a_record(spark, out_dir):
    rows = [(k, "a\nb\r\nc") for k in range(20)]
    write_csv(spark.createDataFrame(rows, "id long, text string"), os.path.join(out_dir, "t"), single_file=True)
    part, = [f for f in os.listdir(os.path.join(out_dir, "t")) if f.startswith("part-")]
    with open(os.path.join(out_dir, "t", part), newline="") as f:
        assert len(f.read().split("\n")) == 22   # the header, and what follows the last break


def test_csv_plain_reading_of_what_is_written(spark, out_dir):
    rows = [(1, "1,500.00"), (2, ""), (3, None), (4, "  padded  ")]
    path = os.path.join(out_dir, "t")
    write_csv(spark.createDataFrame(rows, "id long, text string"), path)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])
    got = {r["id"]: r["text"] for r in read_csv(spark, path, schema).collect()}
    assert got == {1: "1,500.00", 2: None, 3: None, 4: "  padded  "}   # '' is null to other readers


def test_explicit_schema_keeps_money_double(spark, out_dir):
    path = os.path.join(out_dir, "d.csv")
    with open(path, "w") as f:
        f.write("id,name,address,sales_amount\r\n1,Ann,x,1500\r\n")
    df = read_table(spark, path, DETAILS_SCHEMA)
    assert dict(df.dtypes)["sales_amount"] == "double"
    inferred = read_csv(spark, path, infer=True)
    assert dict(inferred.dtypes)["sales_amount"] == "int"


def test_single_file_write(spark, out_dir):
    path = os.path.join(out_dir, "one")
    write_csv(spark.range(100).repartition(5), path, single_file=True)
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 1


def test_shared_dir_under_checkpoint_dir(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a.startswith(base) and a != b


def test_adapter_shapes(spark):
    t = A.load_tpch(spark, SF)
    calls, details = A.employee_calls(t), A.employee_details(t)
    assert calls.columns == ["id", "area", "calls_made", "calls_successful"]
    assert details.columns == ["id", "name", "address", "sales_amount"]
    n_customers = t["customer"].count()
    assert calls.count() == n_customers == details.count()
    sales = A.sales_details(t)
    assert sales.columns == ["id", "caller_id", "company", "recipient", "age", "country",
                             "product_sold", "quantity"]
    assert sales.count() == t["lineitem"].count()


def test_sales_column_pruning_keeps_rows(spark):
    t = A.load_tpch(spark, SF)
    cols = ["id", "caller_id", "country", "quantity"]
    full = A.sales_details(t).select(*cols)
    pruned = A.sales_details(t, cols)
    assert sorted(full.collect()) == sorted(pruned.collect())
    plan = pruned._jdf.queryExecution().optimizedPlan().toString()
    assert "p_partkey" not in plan and "c_custkey" not in plan


def _csv(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(folder, f"{name}.csv"), "w") as f:
            f.write(text)
    return folder


def test_csv_columns_matched_by_name(spark, out_dir):
    path = _csv(os.path.join(out_dir, "reordered"), a="sales_amount,address,id,name,extra\n"
                "12.5,\"Kade, 3, 7001 QX\",7,Uma,x\n,,8,Wen,y\n")
    rows = {r["id"]: r for r in read_csv(spark, path, DETAILS_SCHEMA).collect()}
    assert tuple(rows[7]) == (7, "Uma", "Kade, 3, 7001 QX", 12.5)
    assert tuple(rows[8]) == (8, "Wen", None, None)
    missing = _csv(os.path.join(out_dir, "missing"), a="id,name\n1,Uma\n")
    with pytest.raises(ValueError, match="address"):
        read_csv(spark, missing, DETAILS_SCHEMA)


CALLS_HEAD = "id,area,calls_made,calls_successful\n"


def test_csv_file_with_columns_in_another_order_fails_loudly(spark, out_dir):
    path = _csv(out_dir, a=CALLS_HEAD + "1,Depot,9,4\n",
                b="id,area,calls_successful,calls_made\n2,Depot,4,9\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, path, CALLS_SCHEMA).collect()
    with pytest.raises(Exception, match="(?i)header"):   # also if only these columns are read
        read_csv(spark, path, CALLS_SCHEMA).select("calls_made").collect()
    good = _csv(os.path.join(out_dir, "good"), a=CALLS_HEAD + "1,Depot,9,4\n", b=CALLS_HEAD + "2,Depot,8,3\n")
    assert sorted(tuple(r) for r in read_csv(spark, good, CALLS_SCHEMA).collect()) == [
        (1, "Depot", 9, 4), (2, "Depot", 8, 3)]


def test_csv_integers_written_as_decimals_and_cells_that_are_none(spark, out_dir):
    path = _csv(out_dir, a=CALLS_HEAD + "1,Depot,3.0,2\n2,Depot,abc,1\n3,Press,2.5,-4.00\n4,,,\n"
                                        "5,Press,99999999999999999999,1e2\n")
    df = read_csv(spark, path, CALLS_SCHEMA, malformed=True)
    assert df.dtypes[2:] == [("calls_made", "bigint"), ("calls_successful", "bigint"),
                             ("_malformed", "array<string>")]
    got = {r["id"]: (r["calls_made"], r["calls_successful"], r["_malformed"]) for r in df.collect()}
    assert got == {1: (3, 2, []), 2: (None, 1, ["calls_made"]), 3: (None, -4, ["calls_made"]),
                   4: (None, None, []), 5: (None, 100, ["calls_made"])}
    assert "_malformed" not in read_csv(spark, path, CALLS_SCHEMA).columns


THREE = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.LongType()),
                      T.StructField("name", T.StringType())])


def test_csv_records_of_the_wrong_width(spark, out_dir):
    path = _csv(out_dir, x="id,a,name\n1,2,x\n2,3\n3,4,x,extra\n\n4,5,\"open\n5,\"6,y\n6,7,\"a, b\"\n7,8,six\" pipe\n"
                           "8,,\n9,3.00000000001,z\n10,9,\n11\n12,1,x,\n")
    df = read_csv(spark, path, THREE, malformed=True, records=True)
    got = {r["id"]: (r["a"], r["name"], r["_malformed"], r["_record"]) for r in df.collect()}
    assert got == {
        1: (2, "x", [], None), 2: (3, None, ["(width)"], "2,3"), 3: (4, "x", ["(width)"], "3,4,x,extra"),
        4: (5, "open", ["(width)"], '4,5,"open'), 5: (None, None, ["(width)", "a"], '5,"6,y'),
        6: (7, "a, b", [], None), 7: (8, 'six" pipe', [], None), 8: (None, None, [], None),
        9: (None, "z", ["a"], "9,3.00000000001,z"), 10: (9, None, [], None),
        11: (None, None, ["(width)"], "11"), 12: (1, "x", ["(width)"], "12,1,x,")}
    rows = {r["check_name"]: r for r in q.evaluate({"T": df}, q.readable("T") + q.row_count("T", 12)).collect()}
    assert (rows["csv_malformed"]["total"], rows["csv_malformed"]["violations"]) == (12, 7)


def test_csv_whole_numbers_keep_every_digit(spark, out_dir):
    cells = {"3.00000000001": None, "3.": 3, "3.000000000000000000000000": 3, " 7.0 ": 7, "1e2": 100, "12e-1": None,
             "10e-1": 1, "1.5e1": 15, "-0.0": 0, "9223372036854775807.0": 9223372036854775807, "9e99": None, "+5": 5,
             "1.0000000000000000000001": None, "0x1": None, "1e": None}
    path = _csv(out_dir, x="id,a,name\n" + "".join(f"{k},{c},n\n" for k, c in enumerate(cells)))
    got = {r["id"]: r["a"] for r in read_csv(spark, path, THREE).collect()}
    assert got == dict(enumerate(cells.values()))


def test_csv_files_of_different_headers_are_read_by_name(spark, out_dir):
    path = _csv(out_dir, a="id,a,name\n1,10,x\n", b="name,id,a\ny,2,20\n", c="\ufeffid,more,\"name\",a\r\n3,m,\"z, z\",30\r\n",
                d="id,a,name\n4,40,w\n", empty="")
    want = [(1, 10, "x"), (2, 20, "y"), (3, 30, "z, z"), (4, 40, "w")]
    for malformed in (False, True):
        df = read_csv(spark, path, THREE, mixed_headers=True, malformed=malformed)
        assert sorted(tuple(r)[:3] for r in df.collect()) == want
    with pytest.raises(ValueError, match="different headers"):
        read_csv(spark, path, THREE, malformed=True)
    _csv(out_dir, e="id,name\n5,v\n")
    with pytest.raises(ValueError, match="no column a"):
        read_csv(spark, path, THREE, mixed_headers=True)


def test_csv_of_files_without_a_line(spark, out_dir):
    path = _csv(out_dir, a="", b="\n\n")
    df = read_csv(spark, path, THREE, malformed=True)
    assert df.columns == ["id", "a", "name", "_malformed"] and df.count() == 0


def test_first_lines_reads_no_more_than_the_start(spark, out_dir):
    path = _csv(out_dir, a="h,i\n" + "1,2\n" * 500_000, b="i,h\n3,4\n")
    lines = first_lines(spark, path)
    assert [(os.path.basename(f), line) for f, line in lines] == [("a.csv", "h,i"), ("b.csv", "i,h")]
    assert spark.conf.get("spark.sql.files.openCostInBytes") != str(2 ** 50)


def test_csv_plain_scan_stays_pruned(spark, out_dir):
    path = _csv(out_dir, a="id,a,name\n1,10,x\n")
    plan = read_csv(spark, path, THREE, mixed_headers=True).select("a")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:string>" in plan


def test_unreadable_cells_fail_the_suite(spark, out_dir):
    path = _csv(out_dir, a=CALLS_HEAD + "1,Depot,3.0,2\n2,Depot,abc,1\n")
    tables = {"Employee_calls": read_csv(spark, path, CALLS_SCHEMA, malformed=True)}
    checks = q.non_negative("Employee_calls", ["calls_made"])
    rows = {r["check_name"]: r for r in run_quality(tables, checks=checks)}
    assert rows["col_non_negative"]["passed"] and not rows["csv_malformed"]["passed"]
    assert (rows["csv_malformed"]["total"], rows["csv_malformed"]["violations"]) == (2, 1)
    with pytest.raises(RuntimeError, match="csv_malformed"):
        run_quality(tables, ["csv_malformed"], checks)


def test_remove_dir(spark, out_dir):
    path = os.path.join(out_dir, "gone")
    materialize_at(spark.range(3), path)
    remove_dir(spark, path)
    assert not os.path.exists(path)


def test_configure_applies_settings_and_overrides(spark):
    from veritab.sources.files import SESSION_SETTINGS, configure
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        configure(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB"})
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "256MB"
        for key in set(SESSION_SETTINGS) - {"spark.sql.adaptive.advisoryPartitionSizeInBytes"}:
            assert spark.conf.get(key) == SESSION_SETTINGS[key]
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
