"""Numeric functions: tolerant parsing, guarded ratios and order-independent sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A bare cast would also accept Java suffixes ("1d") and hexadecimal floats.
NUMBER_TEXT = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf(inity)?)\s*$"

DIGIT_BITS = 24
UNITS = tuple(range(-72, 25, DIGIT_BITS))  # powers of two that one unit of each digit of a stable sum stands for
LARGEST_BITS = 56


def parse_number(value: Column, dtype: T.DataType | None = None) -> Column:
    """Number as DOUBLE; text that is no number, NaN and NULL become 0."""
    if dtype is None or isinstance(dtype, T.StringType):
        number = F.when(value.rlike(NUMBER_TEXT), F.trim(value).try_cast("double"))
    else:
        number = value.try_cast("double")
    return F.coalesce(F.nanvl(number, F.lit(0.0)), F.lit(0.0))


def finite_or_null(value: Column) -> Column:
    """NaN and the infinities become NULL."""
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as DOUBLE, NULL where the denominator is 0 or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def _digit_sums(name: str) -> str:
    """SQL of the sums of a column's signed digits of ``DIGIT_BITS`` bits, least first; NULL digits count as 0.

    The digits of a double add up to it but for bits under the last unit: ``rint`` of a double scaled by a power of two
    is exact, and so is the difference of two neighbours.
    """
    whole = [f"rint({name} * {2.0**-unit!r}D)" for unit in UNITS]
    digits = [f"{w} - {above} * {2.0**DIGIT_BITS!r}D" for w, above in zip(whole, whole[1:], strict=False)] + [whole[-1]]
    inside = f"abs({name}) < {2.0**LARGEST_BITS!r}D"
    return f"array({', '.join(f'coalesce(sum(CASE WHEN {inside} THEN CAST({d} AS BIGINT) END), 0L)' for d in digits)})"


def _carried(digits: str) -> str:
    """SQL of the digits after carrying: the rest above the last one, and the sum of the others as a double, least first."""
    start = f"named_struct('carry', 0L, 'total', 0.0D, 'unit', {2.0 ** UNITS[0]!r}D)"
    full = "(d + t.carry)"
    step = (f"named_struct('carry', shiftright({full}, {DIGIT_BITS}), "
            f"'total', t.total + ({full} & {(1 << DIGIT_BITS) - 1}L) * t.unit, 'unit', t.unit * {2.0**DIGIT_BITS!r}D)")
    return f"aggregate({digits}, {start}, (t, d) -> {step})"


def stable_sum(column: str) -> Column:
    """Sum of a DOUBLE column that does not depend on row or task order, to 15 significant digits.

    Every value is split into digits of 24 bits, from 2**-72 up, and each digit is summed as a long: the sums are exact,
    whatever the order, and stay in generated code on primitives, unlike DECIMAL. A group may have some 5e11 rows; more
    end with an error of the long sum, never with a wrong figure. The digits are put together after carrying, so equal
    sums give equal doubles. These keep 15 decimal digits, as many as any double holds, which takes away the binary noise
    of decimal amounts. Values from 2**56 (7.2e16) up and infinities are added as doubles. NaN and NULL are skipped; the
    sum of no value is 0.

    It is one SQL text, not a tree of columns: a wide KPI block is then built in milliseconds.
    """
    name = f"`{column}`"
    # A negative sum is put together from its opposite: a complement would lose the low digits.
    sign = f"named_struct('s', s, 'sign', IF({_carried('s')}.carry < 0, -1L, 1L))"
    done = f"named_struct('sign', x.sign, 'sum', {_carried('transform(x.s, d -> d * x.sign)')})"
    top = f"y.sign * (y.sum.total + y.sum.carry * {2.0 ** (UNITS[-1] + DIGIT_BITS)!r}D)"
    exact = f"transform(transform(transform(array({_digit_sums(name)}), s -> {sign}), x -> {done}), y -> {top})[0]"
    beyond = f"coalesce(sum(CASE WHEN abs({name}) >= {2.0**LARGEST_BITS!r}D AND NOT isnan({name}) THEN {name} END), 0.0D)"
    return F.expr(f"CAST(format_string('%.14e', {exact} + {beyond}) AS DOUBLE)")
