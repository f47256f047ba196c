"""Declarative data-quality checks, evaluated in as few passes as possible.

A check is a spec (``Check``). ``evaluate`` turns a list of them into one
DataFrame with a row per (check, column)::

    dataset, check_name, column_name, total, violations, passed

* every table-local check of a dataset (row count, non-null, non-negative,
  row rules, text patterns, and one uniqueness column) shares ONE aggregate,
  i.e. one scan of that table;
* a dataset with several keys to count (uniqueness columns, referential checks) has all its
  checks in one aggregate over ``(slot, key)``: a row gives one entry for each of its keys and
  one for each rule it breaks, parents' keys join them as entries that count nothing. Tasks
  add entries up before the one shuffle, whose rows do not widen with the columns;
* a referential check by itself is one null-safe left join of the child's aggregated
  keys with the parent's distinct keys.

All of them are unioned, so the whole suite runs as a single Spark action. The
offending rows themselves come from ``violations``; ``gate`` decides whether a
failure stops the run.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.functions.text import ADDRESS_PATTERN, not_matching
from veritab.sources.files import MALFORMED
from veritab.sources.schemas import require_columns

log = logging.getLogger(__name__)

# The names of the seven checks (the switches of the halt policy).
ROW_COUNT = "row_count"
COL_UNIQUE = "col_unique"
COL_NON_NULL = "col_non_null"
COL_NON_NEGATIVE = "col_non_negative"
REFERENTIAL_INTEGRITY = "referential_integrity"
CALLS_SUCCESSFUL_GT_MADE = "calls_successful_gt_made"
ADDRESS_FORMAT = "address_format"
# and of the check this library adds for CSV inputs
CSV_MALFORMED = "csv_malformed"
CHECK_NAMES = (ROW_COUNT, COL_UNIQUE, COL_NON_NULL, COL_NON_NEGATIVE,
               REFERENTIAL_INTEGRITY, CALLS_SUCCESSFUL_GT_MADE, ADDRESS_FORMAT, CSV_MALFORMED)

RESULT_COLUMNS = ["dataset", "check_name", "column_name", "total", "violations", "passed"]


@dataclass(frozen=True, eq=False)
class Check:
    """One check on one dataset (and at most one column).

    kind: ``row_count`` | ``non_null`` | ``unique`` | ``non_negative`` |
    ``rule`` (``violation`` is a boolean Column, true on a bad row) |
    ``pattern`` (``column`` must be non-null and match ``pattern``) |
    ``referential`` (``keys`` of ``dataset`` must exist as ``parent_keys``
    of ``parent``; null-safe, matched by position).
    """

    name: str
    kind: str
    dataset: str
    column: str | None = None
    expected: int | None = None
    violation: Column | None = None
    needs: tuple[str, ...] = field(default_factory=tuple)
    pattern: str | None = None
    keys: tuple[str, ...] = field(default_factory=tuple)
    parent: str | None = None
    parent_keys: tuple[str, ...] = field(default_factory=tuple)


# ---------------------------------------------------------------- constructors

def row_count(dataset: str, expected: int) -> list[Check]:
    return [Check(ROW_COUNT, "row_count", dataset, expected=expected)]


def non_null(dataset: str, columns: Sequence[str]) -> list[Check]:
    return [Check(COL_NON_NULL, "non_null", dataset, c) for c in columns]


def unique(dataset: str, columns: Sequence[str]) -> list[Check]:
    """Each column on its own (not a composite key); null counts as one value."""
    return [Check(COL_UNIQUE, "unique", dataset, c) for c in columns]


def non_negative(dataset: str, columns: Sequence[str]) -> list[Check]:
    """Zero and null pass."""
    return [Check(COL_NON_NEGATIVE, "non_negative", dataset, c) for c in columns]


def rule(dataset: str, name: str, violation: Column, needs: Sequence[str],
         column: str | None = None) -> list[Check]:
    """A row rule: ``violation`` is true on an offending row (null = passes)."""
    return [Check(name, "rule", dataset, column, violation=violation, needs=tuple(needs))]


def calls_successful_le_made(dataset: str) -> list[Check]:
    bad = F.col("calls_successful") > F.col("calls_made")
    return rule(dataset, CALLS_SUCCESSFUL_GT_MADE, bad, ("calls_successful", "calls_made"),
                "calls_successful")


def pattern(dataset: str, column: str = "address", regex: str = ADDRESS_PATTERN,
            name: str = ADDRESS_FORMAT) -> list[Check]:
    """Null and non-matching values are violations."""
    return [Check(name, "pattern", dataset, column, pattern=regex)]


def readable(dataset: str) -> list[Check]:
    """Rows of a CSV table with a cell that is no value of its column's type (the reader's
    ``malformed`` column names them)."""
    return rule(dataset, CSV_MALFORMED, F.size(MALFORMED) > 0, (MALFORMED,))


def referential(dataset: str, keys: Sequence[str], parent: str, parent_keys: Sequence[str],
                name: str = REFERENTIAL_INTEGRITY) -> list[Check]:
    if len(keys) != len(parent_keys):
        raise ValueError("child and parent key lists must have the same length")
    return [Check(name, "referential", dataset, ",".join(keys), keys=tuple(keys),
                  parent=parent, parent_keys=tuple(parent_keys))]


# ------------------------------------------------------------------ evaluation

def _needed_columns(chk: Check) -> list[str]:
    if chk.kind == "rule":
        return list(chk.needs)
    if chk.kind == "referential":
        return list(chk.keys)
    return [chk.column] if chk.column else []


def validate(tables: dict[str, DataFrame], checks: Iterable[Check]) -> None:
    """Raise ``ValueError`` for a missing table or column - before any job runs."""
    for chk in checks:
        if chk.dataset not in tables:
            raise ValueError(f"unknown dataset {chk.dataset!r}")
        require_columns(tables[chk.dataset], _needed_columns(chk),
                        "child_table" if chk.kind == "referential" else "DataFrame")
        if chk.kind == "referential":
            if chk.parent not in tables:
                raise ValueError(f"unknown dataset {chk.parent!r}")
            require_columns(tables[chk.parent], chk.parent_keys, "parent_table")


def _distinct_with_null(c: Column) -> Column:
    """Distinct values of ``c`` counting null as one value, like ``distinct()``."""
    return F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))


ROW_LEVEL = {"non_null", "non_negative", "rule", "pattern"}   # kinds that see one row at a time


def _violation(chk: Check) -> Column:
    """True on a row that breaks a row-level check (null: it does not)."""
    c = F.col(chk.column) if chk.column else None
    if chk.kind == "non_null":
        return c.isNull()
    if chk.kind == "non_negative":
        return c < 0
    if chk.kind == "rule":
        return chk.violation
    if chk.kind == "pattern":
        return not_matching(c, chk.pattern)
    raise ValueError(chk.kind)


def _violation_count(chk: Check) -> Column:
    return F.count_if(_violation(chk))


def _sql_str(value) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _result_rows(agg: DataFrame, rows: list[tuple[Check, str, str]]) -> DataFrame:
    """Unpivot the one-row aggregate into one row per check (no shuffle).

    ``rows`` holds (check, total, violations) as SQL over the aggregate's
    columns; the whole unpivot is one expression (one call into the JVM).
    """
    structs = ", ".join(
        f"named_struct('dataset', {_sql_str(chk.dataset)}, "
        f"'check_name', {_sql_str(chk.name)}, 'column_name', {_sql_str(chk.column)}, "
        f"'total', CAST({total} AS BIGINT), 'violations', CAST({viol} AS BIGINT), "
        f"'passed', ({viol}) = 0)"
        for chk, total, viol in rows)
    return agg.select(F.expr(f"inline(array({structs}))"))


def _table_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """The table-local checks and at most one uniqueness column in one aggregate."""
    aggs: list[Column] = [F.count(F.lit(1)).alias("_total")]
    rows = []
    for i, chk in enumerate(checks):
        if chk.kind == "row_count":
            rows.append((chk, "_total", f"abs(_total - {int(chk.expected)})"))
            continue
        name = f"_v{i}"
        if chk.kind == "unique":
            aggs.append(_distinct_with_null(F.col(chk.column)).alias(name))
            rows.append((chk, "_total", f"_total - {name}"))
        else:
            aggs.append(_violation_count(chk).alias(name))
            rows.append((chk, "_total", name))
    return _result_rows(df.agg(*aggs), rows)


_INTEGRAL = {"byte", "short", "integer", "long"}


def _key(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """A key as two bigints. One integer column is its own value, so equal pairs are equal keys;
    of any other key they are 128 bits of a hash. Null is a value of its own."""
    if len(columns) == 1 and df.schema[columns[0]].dataType.typeName() in _INTEGRAL:
        value = F.col(columns[0]).cast("bigint")
        return [F.coalesce(value, F.lit(0).cast("bigint")), F.when(value.isNull(), 1).otherwise(0).cast("bigint")]
    parts = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(*parts), F.xxhash64(F.lit(1), *reversed(parts))]


def _countable(tables: dict[str, DataFrame], chk: Check) -> bool:
    """True if child and parent keys of a referential check are alike as ``_key`` has them."""
    if chk.kind != "referential":
        return True
    kinds = [[t.schema[k].dataType for k in keys] for t, keys in (
        (tables[chk.dataset], chk.keys), (tables[chk.parent], chk.parent_keys))]
    whole = all(len(k) == 1 and k[0].typeName() in _INTEGRAL for k in kinds)
    return whole or kinds[0] == kinds[1]


def _counted_checks(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """All checks of one dataset, which has keys to count, from one aggregate over ``(slot, key)``."""
    df = tables[checks[0].dataset]
    zero = [F.lit(0).cast("bigint")] * 2

    def entry(slot: int, key: list[Column]) -> Column:
        return F.struct(F.lit(slot).alias("slot"), key[0].alias("k1"), key[1].alias("k2"))

    keys, broken, parents = [], [], []
    for slot, chk in enumerate(checks):
        if chk.kind == "unique":
            keys.append(entry(slot, _key(df, [chk.column])))
        elif chk.kind == "referential":
            keys.append(entry(slot, _key(df, chk.keys)))
            parent = tables[chk.parent]
            parents.append(parent.select(F.lit(slot).alias("slot"), *[
                k.alias(n) for k, n in zip(_key(parent, chk.parent_keys), ("k1", "k2"))]))
        elif chk.kind != "row_count":
            broken.append((_violation(chk), entry(slot, zero)))
    entries = F.array(*keys)
    if broken:   # few rows break a rule: the others' arrays are not put together
        none = F.slice(entries, 1, 0)
        some = F.concat(entries, *[F.when(bad, F.array(e)).otherwise(none) for bad, e in broken])
        entries = F.when(reduce(lambda a, b: a | b, [F.coalesce(bad, F.lit(False)) for bad, _ in broken]),
                         some).otherwise(entries)
    counted = df.select(F.explode(entries).alias("e")).select("e.*", F.lit(1).alias("n"), F.lit(0).alias("p"))
    for parent in parents:
        counted = counted.unionByName(parent.withColumns({"n": F.lit(0), "p": F.lit(1)}))
    groups = counted.groupBy("slot", "k1", "k2").agg(F.sum("n").alias("n"), F.max("p").alias("p"))

    total = next(slot for slot, chk in enumerate(checks) if chk.kind in ("unique", "referential"))
    here = lambda slot: F.col("slot") == slot
    rows_of = lambda slot: F.coalesce(F.sum(F.when(here(slot), F.col("n"))), F.lit(0))
    aggs, rows = [rows_of(total).alias("_total")], []
    for slot, chk in enumerate(checks):
        if chk.kind == "row_count":
            rows.append((chk, "_total", f"abs(_total - {int(chk.expected)})"))
        elif chk.kind == "unique":
            aggs.append(F.count_if(here(slot)).alias(f"_d{slot}"))
            rows.append((chk, "_total", f"_total - _d{slot}"))
        elif chk.kind == "referential":
            child = here(slot) & (F.col("n") > 0)
            aggs += [F.count_if(child).alias(f"_d{slot}"),
                     F.count_if(child & (F.col("p") == 0)).alias(f"_v{slot}")]
            rows.append((chk, f"_d{slot}", f"_v{slot}"))
        else:
            aggs.append(rows_of(slot).alias(f"_v{slot}"))
            rows.append((chk, "_total", f"_v{slot}"))
    return _result_rows(groups.agg(*aggs), rows)


def _null_safe_on(left: DataFrame, lkeys: Sequence[str], right: DataFrame,
                  rkeys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b,
                  [left[lk].eqNullSafe(right[rk]) for lk, rk in zip(lkeys, rkeys)])


# Placeholder a null key is coalesced to; ``isnull`` travels next to it, so the
# pair (coalesce(k, placeholder), isnull(k)) is equal exactly when the keys are
# null-safe equal. Types without an entry use ``<=>`` directly.
_PLACEHOLDERS = {"byte": 0, "short": 0, "integer": 0, "long": 0, "float": 0.0, "double": 0.0,
                 "decimal": 0, "string": "", "boolean": False}


def _null_safe_pairs(df: DataFrame, keys: Sequence[str]) -> list[tuple[Column, Column]] | None:
    pairs = []
    for k in keys:
        kind = df.schema[k].dataType.typeName()
        if kind not in _PLACEHOLDERS:
            return None
        pairs.append((F.coalesce(F.col(k), F.lit(_PLACEHOLDERS[kind])), F.col(k).isNull()))
    return pairs


def _same_types(a: DataFrame, akeys: Sequence[str], b: DataFrame, bkeys: Sequence[str]) -> bool:
    return all(a.schema[x].dataType == b.schema[y].dataType for x, y in zip(akeys, bkeys))


def child_key_counts(child: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct child keys with their row counts. Partial aggregation collapses
    a hot key inside each map task, so no task sees a key's rows whole."""
    return child.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))


def matched_keys(child: DataFrame, keys: Sequence[str], parent: DataFrame,
                 parent_keys: Sequence[str]) -> DataFrame:
    """Every distinct child key with ``_rows`` (its row count) and ``_orphan``
    (true when no parent has that key; null-safe, by position).

    Aggregate first, then join: a left join of the aggregated child keys with
    the distinct parent keys. (Written as an anti-join, Catalyst would push
    the join below the aggregate and shuffle every raw child row.) Both sides
    are grouped on the null-safe key pairs themselves, so the join reuses the
    aggregates' partitioning instead of shuffling them a second time (safe
    here: both sides hold one row per key, so neither side can be skewed).
    """
    joined, restored = _keyed_join(child, keys, parent, parent_keys)
    return joined.select(*restored, "_rows", F.col("_hit").isNull().alias("_orphan"))


def _keyed_join(child, keys, parent, parent_keys) -> tuple[DataFrame, list[Column]]:
    """The left join behind ``matched_keys`` and the columns restoring the keys."""
    cp = _null_safe_pairs(child, keys)
    pp = _null_safe_pairs(parent, parent_keys)
    if cp is None or pp is None or not _same_types(child, keys, parent, parent_keys):
        return _keyed_join_generic(child, keys, parent, parent_keys)
    keyed = child.groupBy(*[c for i, (k, z) in enumerate(cp)
                            for c in (k.alias(f"_k{i}"), z.alias(f"_z{i}"))]) \
        .agg(F.count(F.lit(1)).alias("_rows"))
    pk = parent.groupBy(*[c for i, (k, z) in enumerate(pp)
                          for c in (k.alias(f"_pk{i}"), z.alias(f"_pz{i}"))]) \
        .agg(F.max(F.lit(True)).alias("_hit"))
    on = reduce(lambda a, b: a & b,
                [(keyed[f"_k{i}"] == pk[f"_pk{i}"]) & (keyed[f"_z{i}"] == pk[f"_pz{i}"])
                 for i in range(len(keys))])
    restored = [F.when(keyed[f"_z{i}"], F.lit(None)).otherwise(keyed[f"_k{i}"])
                .cast(child.schema[k].dataType).alias(k) for i, k in enumerate(keys)]
    return keyed.join(pk, on, "left"), restored


def _keyed_join_generic(child, keys, parent, parent_keys) -> tuple[DataFrame, list[Column]]:
    pk = parent.groupBy(*[parent[p].alias(f"_p{i}") for i, p in enumerate(parent_keys)]) \
        .agg(F.max(F.lit(True)).alias("_hit"))
    keyed = child_key_counts(child, keys)
    on = _null_safe_on(keyed, keys, pk, [f"_p{i}" for i in range(len(parent_keys))])
    return keyed.join(pk, on, "left"), [keyed[k] for k in keys]


def orphan_keys(child: DataFrame, keys: Sequence[str], parent: DataFrame,
                parent_keys: Sequence[str]) -> DataFrame:
    """Distinct child keys (with ``_rows``) that have no parent: the
    ``EXCEPT DISTINCT`` of the keys, null-safe."""
    m = matched_keys(child, keys, parent, parent_keys)
    return m.filter(F.col("_orphan")).drop("_orphan")


def _referential(tables: dict[str, DataFrame], chk: Check) -> DataFrame:
    joined, _ = _keyed_join(tables[chk.dataset], chk.keys, tables[chk.parent], chk.parent_keys)
    agg = joined.agg(F.count(F.lit(1)).alias("_keys"),
                     F.count_if(F.col("_hit").isNull()).alias("_orphans"))
    return _result_rows(agg, [(chk, "_keys", "_orphans")])


def evaluate(tables: dict[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """All ``checks`` as one lazy DataFrame of results (one action when collected).

    ``total``/``violations`` per kind: rows / offending rows; for ``unique``
    rows / rows beyond the distinct values; for ``row_count`` rows / absolute
    difference to ``expected``; for ``referential`` distinct child keys /
    distinct orphan keys.
    """
    checks = list(checks)
    validate(tables, checks)
    parts: list[DataFrame] = []
    by_dataset: dict[str, list[Check]] = {}
    for chk in checks:
        by_dataset.setdefault(chk.dataset, []).append(chk)
    for dataset, group in by_dataset.items():
        apart = [c for c in group if not _countable(tables, c)]
        together = [c for c in group if c not in apart]
        if sum(c.kind in ("unique", "referential") for c in together) < 2:
            apart += [c for c in together if c.kind == "referential"]
            together = [c for c in together if c.kind != "referential"]
            parts += [_table_checks(tables[dataset], together)] if together else []
        else:
            parts.append(_counted_checks(tables, together))
        parts += [_referential(tables, c) for c in apart]
    if not parts:
        raise ValueError("no checks given")
    # every part comes from ``_result_rows``: same columns in the same order
    return reduce(DataFrame.union, parts)


# ----------------------------------------------------------- offending rows

def violations(tables: dict[str, DataFrame], chk: Check, keys: DataFrame | None = None) -> DataFrame:
    """The rows of ``chk.dataset`` that break ``chk`` (all of them, distributed).

    ``unique``: every row whose value repeats (a group-by count, then a
    null-safe semi-join back; AQE splits a hot key on the big side). The values are
    counted over ``keys`` if given: the same rows with nothing but the column, for a table
    that is a view whose other columns cost joins.
    ``referential``: every child row without a parent (null-safe anti-join).
    """
    validate(tables, [chk])
    df = tables[chk.dataset]
    if chk.kind == "row_count":
        return df.limit(0)
    if chk.kind == "unique":
        # The duplicated values are shuffled once more for the join on purpose:
        # with both join inputs fresh from a shuffle, AQE can split a hot
        # value's partition on the raw side (it cannot when one side is an
        # aggregate that reuses its own partitioning).
        dup = ((df if keys is None else keys).groupBy(chk.column).agg(F.count(F.lit(1)).alias("_n"))
               .filter(F.col("_n") > 1).select(F.col(chk.column).alias("_dup")))
        return df.join(dup, df[chk.column].eqNullSafe(dup["_dup"]), "left_semi")
    if chk.kind == "referential":
        parent = tables[chk.parent]
        pk = parent.select([parent[p].alias(f"_p{i}") for i, p in enumerate(chk.parent_keys)])
        return df.join(pk, _null_safe_on(df, chk.keys, pk, pk.columns), "left_anti")
    return df.filter(_violation(chk))


def violation_vectors(tables: dict[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """Every row of one dataset that breaks any of these row-level ``checks``, with ``failed``: an
    array of ``(check_name, column_name, raw)`` in the order of the checks, ``raw`` mapping the columns
    a check looks at to their values as text (null stays null).

    One scan whatever the number of checks; rows are told by the checks' predicates
    alone, the arrays are made for offending rows only."""
    checks = list(checks)
    validate(tables, checks)
    wrong = sorted({c.name for c in checks if c.kind not in ROW_LEVEL})
    if wrong or len({c.dataset for c in checks}) != 1:
        raise ValueError(f"not row-level checks of one dataset: {', '.join(wrong) or 'several datasets'}")
    df = tables[checks[0].dataset]

    def failure(chk: Check) -> Column:
        raw = [x for c in dict.fromkeys(_needed_columns(chk)) for x in (F.lit(c), F.col(c).cast("string"))]
        return F.when(_violation(chk), F.struct(
            F.lit(chk.name).alias("check_name"), F.lit(chk.column).cast("string").alias("column_name"),
            F.create_map(*raw).alias("raw")))

    bad = reduce(lambda a, b: a | b, [F.coalesce(_violation(c), F.lit(False)) for c in checks])
    return df.where(bad).withColumn("failed", F.array_compact(F.array(*[failure(c) for c in checks])))


# ------------------------------------------------------------------------ gate

def halt_names(halt_on: Iterable[str]) -> set[str]:
    return {h.strip() for h in halt_on if h and h.strip()}


def halting(results: DataFrame, halt_on: Iterable[str] = ()) -> DataFrame:
    """The results with ``halts``: true for a failed check that stops a run under this
    halt list (``"all"`` names every check)."""
    halt = halt_names(halt_on)
    named = F.lit(True) if "all" in halt else F.col("check_name").isin(sorted(halt))
    return results.withColumn("halts", ~F.col("passed") & named)


def gate(results: DataFrame, halt_on: Iterable[str] = ()) -> list:
    """Log every failed check; raise one ``RuntimeError`` naming every failure
    whose check name is in ``halt_on`` (``"all"`` halts on any).

    Collects the result table only: one row per check, never data rows.
    """
    rows = halting(results, halt_on).collect()
    unknown = halt_names(halt_on) - set(CHECK_NAMES) - {"all"} - {r["check_name"] for r in rows}
    if unknown:
        log.warning("unknown check name(s) in halt list: %s", ", ".join(sorted(unknown)))
    failed = [r for r in rows if not r["passed"]]
    def where(r) -> str:
        return r["dataset"] + (f".{r['column_name']}" if r["column_name"] else "")

    for r in failed:
        log.warning("%s failed on %s: %d violation(s) of %d", r["check_name"], where(r),
                    r["violations"], r["total"])
    stop = [r for r in failed if r["halts"]]
    if stop:
        detail = "; ".join(f"{r['check_name']} on {where(r)}" for r in stop)
        raise RuntimeError(f"Data quality check(s) failed: {detail}")
    return rows
