"""The three logical tables, derived from the TPC-H-like test tables.

The reports and checks are written against three call-centre tables
(calls, details, sales). The test data is a TPC-H star schema, so each logical
table is a view over it:

* calls   - one row per customer: segment as area, urgent orders as calls
            made, those not pending as successful (0 when none).
* details - customer + nation: name, a synthetic address in several layouts,
            account balance as sales amount (null for every 50th customer).
* sales   - one row per order line: caller = the ordering customer (negated
            for every 1000th order, so some callers have no calls row), the
            supplier's nation as country, the part name as product.

Dimension lookups in ``sales_details`` are left joins on unique keys, so they
never add or drop order lines; that lets the view build only the joins whose
columns the caller asks for - Catalyst prunes unused columns but keeps an
unused join, and at scale every join of the line-level table is a shuffle.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritab.sources.schemas import (
    EMPLOYEE_CALLS,
    EMPLOYEE_DETAILS,
    SALES_DETAILS,
    SALES_SCHEMA,
)

TPCH_TABLES = ("customer", "orders", "lineitem", "part", "supplier", "nation")

# Fixed values of the adapter definition.
URGENT_PRIORITY = "1-URGENT"
PENDING_STATUS = "P"
NULL_SALES_EVERY = 50
ORPHAN_ORDER_EVERY = 1000


# Column types of the TPC-H-like input tables. Declaring them
# skips footer reads for schema inference at read time.
_L, _I, _D, _S, _TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), \
    T.TimestampType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in cols])


TPCH_SCHEMAS = {
    "customer": _schema(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I),
                        ("c_acctbal", _D), ("c_mktsegment", _S)),
    "orders": _schema(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S),
                      ("o_totalprice", _D), ("o_orderdate", _TS), ("o_orderpriority", _S)),
    "lineitem": _schema(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L),
                        ("l_linenumber", _I), ("l_quantity", _D), ("l_extendedprice", _D),
                        ("l_discount", _D), ("l_tax", _D), ("l_returnflag", _S),
                        ("l_linestatus", _S), ("l_shipdate", _TS)),
    "part": _schema(("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S),
                    ("p_size", _I), ("p_retailprice", _D)),
    "supplier": _schema(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I),
                        ("s_acctbal", _D)),
    "nation": _schema(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
}


class TpchTables(Mapping):
    """The input tables of one folder, each read (lazily, with its declared
    schema) the first time a view asks for it."""

    def __init__(self, spark: SparkSession, sf_dir: str, names=TPCH_TABLES):
        self._spark, self._dir, self._names = spark, sf_dir, tuple(names)
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._frames:
            reader = self._spark.read
            if name in TPCH_SCHEMAS:
                reader = reader.schema(TPCH_SCHEMAS[name])
            self._frames[name] = reader.parquet(os.path.join(self._dir, f"{name}.parquet"))
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def load_tpch(spark: SparkSession, sf_dir: str, names=TPCH_TABLES) -> TpchTables:
    return TpchTables(spark, sf_dir, names)


def employee_calls(t: Mapping[str, DataFrame]) -> DataFrame:
    """id, area, calls_made, calls_successful - one row per customer."""
    urgent = (
        t["orders"]
        .filter(F.col("o_orderpriority") == URGENT_PRIORITY)
        .groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).alias("calls_made"),
            F.count_if(F.col("o_orderstatus") != PENDING_STATUS).alias("calls_successful"),
        )
    )
    c = t["customer"]
    return c.join(urgent, c["c_custkey"] == urgent["o_custkey"], "left").select(
        c["c_custkey"].alias("id"),
        c["c_mktsegment"].alias("area"),
        F.coalesce(urgent["calls_made"], F.lit(0)).cast("bigint").alias("calls_made"),
        F.coalesce(urgent["calls_successful"], F.lit(0)).cast("bigint").alias("calls_successful"),
    )


def _zip(custkey: Column, segment: Column) -> Column:
    return F.concat((F.lit(1000) + custkey % 9000).cast("string"), F.lit(" "),
                    F.substring(segment, 1, 2))


def employee_details(t: Mapping[str, DataFrame]) -> DataFrame:
    """id, name, address, sales_amount - one row per customer with a nation."""
    c, n = t["customer"], t["nation"]
    key = c["c_custkey"]
    z = _zip(key, c["c_mktsegment"])
    layout = key % 5
    address = (
        F.when(layout == 0, F.concat(F.lit("Main Street, "), key.cast("string"), F.lit(", "), z))
        .when(layout == 1, F.concat(z, F.lit(", "), n["n_name"]))
        .when(layout == 2, F.concat(F.lit("Lindehof 5, "), z, F.lit(", "), n["n_name"]))
        .when(layout == 3, F.lit("Main Street 10"))
    )
    return c.join(n, c["c_nationkey"] == n["n_nationkey"], "inner").select(
        key.alias("id"),
        c["c_name"].alias("name"),
        address.alias("address"),
        F.when(key % NULL_SALES_EVERY == 0, F.lit(None).cast("double"))
        .otherwise(c["c_acctbal"]).alias("sales_amount"),
    )


def sales_details(t: Mapping[str, DataFrame], columns: list[str] | None = None,
                  keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """id, caller_id, company, recipient, age, country, product_sold, quantity.

    ``columns`` restricts the output and skips dimension joins nobody reads. ``keep``
    thins the order lines (with their id, caller_id, age and quantity) before any
    dimension is joined to them; it must return them with all their columns.
    """
    wanted = [f.name for f in SALES_SCHEMA.fields] if columns is None else list(columns)
    unknown = set(wanted) - {f.name for f in SALES_SCHEMA.fields}
    if unknown:
        raise ValueError(f"unknown sales column(s): {sorted(unknown)}")

    li = t["lineitem"]
    o = t["orders"]
    if keep is not None:
        li = keep(_with_keys(li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")))
    # Supplier, then nation, first: a country filter then turns both lookups
    # into inner joins against filtered sides and thins the line table before
    # the order join shuffles it. Each lookup joins a base table directly, so
    # the planner sizes it from that table's own statistics (a join of two
    # dimensions would be estimated as the product of their sizes).
    # (TPC-H column names are unique across tables, so no projection is needed
    # before a join; Catalyst prunes each scan to the columns used)
    if {"company", "country"} & set(wanted):
        s = t["supplier"]
        li = li.join(s, li["l_suppkey"] == s["s_suppkey"], "left")
    if "country" in wanted:
        n = t["nation"]
        li = li.join(n, li["s_nationkey"] == n["n_nationkey"], "left")
    rows = li if keep is not None else _with_keys(
        li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner"))
    if "product_sold" in wanted:
        p = t["part"]
        rows = rows.join(p, rows["l_partkey"] == p["p_partkey"], "left")
    if "recipient" in wanted:
        c = t["customer"]
        rows = rows.join(c, rows["o_custkey"] == c["c_custkey"], "left")

    names = {"company": "s_name", "recipient": "c_name", "country": "n_name",
             "product_sold": "p_name"}
    return rows.select([F.col(names.get(c, c)).alias(c) for c in wanted])


def _with_keys(rows: DataFrame) -> DataFrame:
    """Order lines joined to their orders, with the columns that need no dimension."""
    cust = F.col("o_custkey")
    return rows.withColumns({
        "id": (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint"),
        "caller_id": F.when(F.col("o_orderkey") % ORPHAN_ORDER_EVERY == 0, F.lit(-1) - cust)
        .otherwise(cust),
        "age": (F.lit(18) + cust % 60).cast("int"),
        "quantity": F.col("l_quantity").cast("bigint"),
    })


def adapter_tables(spark: SparkSession, sf_dir: str,
                   sales_columns: list[str] | None = None) -> dict[str, DataFrame]:
    """The three logical tables over ``sf_dir``, keyed by their logical names."""
    t = load_tpch(spark, sf_dir)
    return {
        EMPLOYEE_CALLS: employee_calls(t),
        EMPLOYEE_DETAILS: employee_details(t),
        SALES_DETAILS: sales_details(t, sales_columns),
    }
