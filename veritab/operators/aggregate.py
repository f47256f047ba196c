"""Grouped totals: ratio of sums, and summed top-k per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.functions.numeric import BIN, IS_FINITE, IS_PLAIN, LIMBS, SCALED, limbs, limbs_total
from veritab.operators.topn import top_k_per_group


def ratio_breakdown(df: DataFrame, by: Sequence[str], amount: str, numerator: str,
                    denominator: str, total_col: str = "total_sales",
                    rate_col: str = "success_rate", scale: float = 100) -> DataFrame:
    """Per group: total of ``amount`` and ``sum(numerator) / sum(denominator) * scale`` - a ratio of
    sums, not a mean of ratios.

    Totals do not depend on the order of the rows. Amounts that wide decimals hold as they are
    (all but those of 1e19 and more or with digits beyond the eighteenth place) are added as
    such. A group with any other amount gets the double nearest to the sum of its doubles: the
    first aggregate keeps whole-number sums a (group, bin of exponents), few rows a group, which
    the second puts together. A NaN or infinity makes the total what adding it makes it.

    A zero or null denominator gives a null rate. Partial aggregation runs map-side, so the
    shuffles carry a few rows per group per task.
    """
    keys = [f"`{c}`" for c in by]
    carried = [*keys, "_num", "_den", "_x"]
    binned = (df.selectExpr(*keys, f"CAST(`{amount}` AS DOUBLE) AS _x", f"`{numerator}` AS _num", f"`{denominator}` AS _den")
              .selectExpr(*carried, f"{IS_PLAIN.format(x='_x')} AS _plain", f"{IS_FINITE.format(x='_x')} AS _finite",
                          f"if({IS_FINITE.format(x='_x')}, {BIN.format(x='_x')}, 0) AS _bin")
              .selectExpr(*carried, "_plain", "_finite", "_bin", f"if(_finite, {SCALED.format(x='_x', bin='_bin')}, NULL) AS _y"))
    here = binned.groupBy(*by, "_bin").agg(*map(F.expr, [
        "sum(_num) AS _num", "sum(_den) AS _den", "count(_x) AS _n", "count_if(_plain) AS _plains",
        "try_sum(if(_plain, try_cast(_x AS DECIMAL(38, 18)), NULL)) AS _exact",
        "sum(if(_finite, NULL, _x)) AS _odd", *[f"sum({s}) AS _s{k}" for k, s in enumerate(limbs("_y"))]]))
    entry = ", ".join(f"named_struct('i', _bin - {k}, 's', coalesce(_s{k}, 0L))" for k in range(LIMBS))
    merged = here.groupBy(*by).agg(*map(F.expr, [
        "sum(_num) AS _num", "sum(_den) AS _den", "sum(_n) AS _n", "sum(_odd) AS _odd",
        "if(sum(_n) = sum(_plains), try_sum(_exact), NULL) AS _exact",
        f"flatten(collect_list(array({entry}))) AS _limbs"]))
    # the limbs of groups that have a total already are not put together
    needed = merged.selectExpr(*keys, "_num", "_den", "_n", "_odd", "_exact",
                               "if(_n = 0 OR _odd IS NOT NULL OR _exact IS NOT NULL, NULL, _limbs) AS _limbs")
    total = "if(_n = 0, NULL, coalesce(_odd, CAST(_exact AS DOUBLE), _total))"
    return limbs_total(needed, "_limbs", "_total").selectExpr(
        *keys, f"{total} AS `{total_col}`", f"try_divide(_num, _den) * {float(scale)!r}D AS `{rate_col}`")


def summed_top_k(df: DataFrame, group: Sequence[str], item: Sequence[str], value: str, k: int,
                 total_col: str = "total", extra_order: Sequence[Column] = (),
                 rank_col: str = "rank") -> DataFrame:
    """Sum ``value`` per (group, item), then keep the top ``k`` items of each
    group by that sum (descending, ties kept)."""
    totals = df.groupBy(*group, *item).agg(F.sum(value).alias(total_col))
    order = [F.col(total_col).desc(), *extra_order]
    return top_k_per_group(totals, group, order, k, rank_col)
