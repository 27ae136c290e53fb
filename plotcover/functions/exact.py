"""Sums of doubles that are exact whatever the order of the rows.

Each double is split into signed digits of 24 bits at fixed places; the digits
of each place are summed as longs (room for 2^40 rows), so a partial sum is the
same in any task and any join strategy.  Once, at the end, the digits are put
together and rounded to the nearest double (ties to even), as adding the real
values and rounding once would.

Values of magnitude 2^95 and above (no cover, distance or product is) are added
as doubles beside it, so are infinities; bits below 2^-144 are rounded off each
value.  The splitting is plain arithmetic inside code generation; only the last
step, one row a group, uses higher-order functions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGIT_BITS = 24
DIGITS = 10
LOWEST = -144                                          # place of the last digit's last bit
LIMIT = 2.0 ** (LOWEST + DIGIT_BITS * DIGITS - 1)      # magnitudes below it are split


def _double(x: float) -> str:
    return f"{x!r}D"


def _digit(value: str, k: int) -> str:
    """Digit k of a double, from the last one up."""
    def whole(place: int) -> str:
        return f"rint({value} * {_double(2.0 ** -place)})"

    place = LOWEST + DIGIT_BITS * k
    above = f" - {_double(2.0 ** DIGIT_BITS)} * {whole(place + DIGIT_BITS)}" if k + 1 < DIGITS else ""
    return f"cast({whole(place)}{above} as bigint)"


def _rounded(digits: str) -> str:
    """The double nearest to the number whose digits, all from 0 to 2^24 - 1
    and the last one first, are in the array ``digits``: its four top digits
    as two whole numbers, the lower one made odd if anything is below them, so
    that adding the two rounds once and rightly."""
    base = 1 << DIGIT_BITS
    top = f"({DIGITS + 2} - cast(array_position(transform(reverse({digits}), x -> x <> 0), true) as int))"
    padded = f"concat(array(0L, 0L, 0L), {digits})"
    return (
        f"element_at(transform(array(named_struct('top', {top}, 'd', {padded})), r -> if(r.top > {DIGITS + 1}, 0D, "
        f"(cast(r.d[r.top + 3] * {base}L + r.d[r.top + 2] as double) * {_double(2.0 ** (2 * DIGIT_BITS))}"
        f" + cast((r.d[r.top + 1] * {base}L + r.d[r.top])"
        f" | if(exists(slice(r.d, 1, r.top), x -> x <> 0), 1L, 0L) as double))"
        f" * power(2D, {DIGIT_BITS} * (r.top - 3) + {LOWEST}))), 1)")


def _total(sums: list[str]) -> str:
    """The double nearest to the sum of the digit sums at their places."""
    digits = f"array({', '.join(sums)}, 0L, 0L)"
    carry = f"shiftright(x + a, {DIGIT_BITS})"
    negative = f"aggregate({digits}, 0L, (a, x) -> {carry}) < 0"
    spread = (f"aggregate(transform({digits}, x -> s * x), named_struct('c', 0L, 'd', cast(array() as array<bigint>)), "
              f"(a, x) -> named_struct('c', shiftright(x + a.c, {DIGIT_BITS}), "
              f"'d', concat(a.d, array((x + a.c) & {(1 << DIGIT_BITS) - 1}L))), a -> s * {_rounded('a.d')})")
    return f"element_at(transform(array(if({negative}, -1L, 1L)), s -> {spread}), 1)"


def exact_sum(column: str) -> Column:
    """Aggregate sum of a double column: 0.0 when every value is missing (N4);
    missing (not NaN) when infinities of both signs meet."""
    name = "`" + column.replace("`", "``") + "`"
    inside = f"if(abs({name}) < {_double(LIMIT)}, {name}, 0D)"
    sums = [f"coalesce(sum({_digit(inside, k)}), 0L)" for k in range(DIGITS)]
    beyond = f"coalesce(sum(if(abs({name}) >= {_double(LIMIT)}, {name}, null)), 0D)"
    return F.nanvl(F.expr(f"{_total(sums)} + {beyond}"), F.lit(None).cast("double"))
