"""Numeric column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Wide enough that a double's shortest decimal form is kept as it is.
EXACT = T.DecimalType(38, 18)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num, den) -> Column:
    """``num / den`` as double; null (not an error) when ``den`` is 0 or null."""
    return F.try_divide(_col(num), _col(den))


def money_sum(c) -> Column:
    """The sum of amounts as a double, nothing rounded before the end.

    Amounts are added as wide decimals, so the result does not depend on the order rows
    arrive in. A group that holds a NaN, an infinity or an amount beyond the decimal's range
    (or whose total is) is summed as doubles instead: no row is left out or fails the sum.
    ``operators.aggregate.ratio_breakdown`` sums such groups exactly.
    """
    value = _col(c).cast("double")
    exact = value.try_cast(EXACT)
    whole = F.when(F.count(value) == F.count(exact), F.try_sum(exact).cast("double"))
    return F.coalesce(whole, F.sum(value))


# Exact sums of doubles: a double is cut into whole multiples of powers of 2^LIMB. Its bin tells
# the first of them, so amounts of like size share a bin, whose limbs are sums of longs.
LIMB = 20      # bits of a limb: 2^42 amounts of a bin add up within 64 bits
LIMBS = 4      # a double's 53 bits, wherever they begin in the first limb, end in the fourth


# As SQL text, of a double column: one expression each, where built call by call they would
# take longer to put together than most totals take to run.
#
# true for an amount that a wide decimal holds as it is (17 digits end in time from 0.01 up)
IS_PLAIN = ("CASE WHEN {x} = 0 OR abs({x}) >= 0.01D AND abs({x}) < 1e19D THEN true "
            "WHEN abs({x}) < 0.01D THEN CAST(try_cast({x} AS DECIMAL(38, 18)) AS DOUBLE) = {x} ELSE false END")
IS_FINITE = "coalesce(abs({x}) < DOUBLE('Infinity'), false)"   # NaN is above it
# the bin of a finite double (0 for 0): about its exponent over LIMB
BIN = f"CASE WHEN abs({{x}}) > 0 THEN CAST(floor(log2(abs({{x}})) / {LIMB}) AS INT) ELSE 0 END"
# a finite double as multiple of 2^(LIMB * bin): exact, as scaling by powers of two is (in two
# steps, as one could leave the doubles' range)
SCALED = f"{{x}} * pow(2D, -{LIMB // 2} * {{bin}}) * pow(2D, -{LIMB // 2} * {{bin}})"


def limbs(y: str) -> list[str]:
    """A scaled double as ``sum(limb[k] / 2^(LIMB * k))``: whole numbers of its sign."""
    return [f"CAST({y} AS BIGINT)" if k == 0 else f"CAST({y} * {2 ** (LIMB * k)}D % {2 ** LIMB}D AS BIGINT)"
            for k in range(LIMBS)]


def limbs_total(df: DataFrame, entries: str, total: str) -> DataFrame:
    """``df`` with ``total``: the double nearest to the sum of ``s * 2^(LIMB * i)`` over the array
    ``entries`` of ``(i, s)``.

    Carries go up from the lowest limb, which leaves digits and one signed number above them.
    From there down the leading 80 bits are put together, and a last bit that says whether
    anything follows; they round as the sum does."""
    up = f"""aggregate(sequence(_lo, array_max(transform({entries}, e -> e.i))),
        named_struct('carry', 0L, 'digits', CAST(array() AS ARRAY<BIGINT>)),
        (state, i) -> aggregate({entries}, state.carry, (a, e) -> a + if(e.i = i, e.s, 0L),
            here -> named_struct('carry', shiftright(here, {LIMB}),
                                 'digits', concat(array(here & {2 ** LIMB - 1}L), state.digits))))"""
    lead = f"""aggregate(_up.digits,
        named_struct('lead', CAST(_up.carry AS DECIMAL(38, 0)), 'left', 0, 'more', 0),
        (state, d) -> if(abs(state.lead) < {2 ** 80},
            named_struct('lead', CAST(state.lead * {2 ** LIMB} + d AS DECIMAL(38, 0)), 'left', 0, 'more', 0),
            named_struct('lead', state.lead, 'left', state.left + 1, 'more', if(d = 0, state.more, 1))))"""
    rounded = f"""CAST(CAST(_top.lead * 2 + _top.more AS DECIMAL(38, 0)) AS DOUBLE)
        * pow(2D, floor(({LIMB} * (_lo + _top.left) - 1) / 2))
        * pow(2D, {LIMB} * (_lo + _top.left) - 1 - floor(({LIMB} * (_lo + _top.left) - 1) / 2))"""
    kept = [f"`{c}`" for c in df.columns]
    return (df.selectExpr(*kept, f"array_min(transform({entries}, e -> e.i)) AS _lo")
            .selectExpr(*kept, "_lo", f"{up} AS _up").selectExpr(*kept, "_lo", f"{lead} AS _top")
            .selectExpr(*kept, f"{rounded} AS `{total}`"))
