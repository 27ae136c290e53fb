"""Column expressions for cover arithmetic.

Every function returns a native ``Column`` so the work stays inside
whole-stage codegen; none of them is a Python UDF.  Missing is always NULL,
never NaN (the coercion maps NaN to NULL).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotcover.schema import (
    COMMUNITY_LABELS,
    OVERALL_LABEL,
    SIDES,
    STRATA,
    STRATUM_LABELS,
    cover_col,
)

# Text the coercion accepts as a number: optional sign, digits with an
# optional point (or a point and digits), optional exponent; or an infinity
# word.  Anything else (empty, '1,000', '5%', '0x1A', '1.5d', 'nan', a number
# too large for a double) becomes NULL.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INFINITY_PATTERN = r"(?i)^[+-]?inf(inity)?$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# Building a Column costs one call into the JVM per function used, and the
# same few expressions are built for every report.  Expressions over named
# columns are kept per live JVM (a Column is an unresolved expression, safe to
# reuse in any plan of that JVM).
_memo: dict[tuple, Column] = {}


def _memoised(key: tuple, build) -> Column:
    gateway = SparkContext._gateway
    full = (id(gateway),) + key
    if full not in _memo:
        _memo[full] = build()
    return _memo[full]


def to_number(col: Column | str, source_type: T.DataType | None = None) -> Column:
    """Coerce a value to a double the way a forgiving numeric parser does
    (op E3): surrounding whitespace is ignored, bad text and NaN become NULL."""
    if isinstance(col, str):
        numeric = isinstance(source_type, T.NumericType)
        return _memoised(("to_number", col, numeric), lambda: _to_number(F.col(col), source_type))
    return _to_number(col, source_type)


def _to_number(c: Column, source_type: T.DataType | None) -> Column:
    if source_type is not None and isinstance(source_type, T.NumericType):
        value = c.cast("double")
        return no_nan(value)
    text = F.regexp_replace(c.cast("string"), r"^\s+|\s+$", "")
    value = text.try_cast("double")
    finite = F.abs(value) != F.lit(float("inf"))
    return (
        F.when(text.rlike(NUMBER_PATTERN) & finite, value)
        .when(text.rlike(INFINITY_PATTERN), value)
    )


def row_sum(*cols: Column | str) -> Column:
    """Row-wise total, terms added in the order given, that skips missing
    terms; all missing gives 0.0 (N1), infinities of both signs NULL."""
    terms = [F.coalesce(_c(c), F.lit(0.0)) for c in cols]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return no_nan(total)


def cells_sum(names: Sequence[str]) -> Column:
    """``row_sum`` over any number of named columns: a fold over an array of
    them, so the plan does not get deeper with their number."""
    cells = ", ".join("`" + n.replace("`", "``") + "`" for n in names)
    return no_nan(F.expr(f"aggregate(array({cells}), 0D, (held, c) -> held + coalesce(c, 0D))")
                  if names else F.lit(0.0))


def equals_exactly(col: Column | str, value: float) -> Column:
    """Exact float equality that reads missing as False."""
    return F.coalesce(_c(col) == F.lit(float(value)), F.lit(False))


def side_stratum_cover(side: str, vegetation_type: Column) -> Column:
    """The relative cover of the layer a vegetation row names, on one side.

    The layer label picks the column; the label ``Overall`` picks the side's
    overall cover (D6); any other label, or none, gives NULL.
    """
    picked = None
    for stratum in STRATA:
        cond = vegetation_type == F.lit(STRATUM_LABELS[stratum])
        col = F.col(cover_col(side, stratum))
        picked = F.when(cond, col) if picked is None else picked.when(cond, col)
    return picked.when(
        vegetation_type == F.lit(OVERALL_LABEL), F.col(cover_col(side, "overall"))
    )


def absolute_cover(
    community: Column | str = "communitytype",
    vegetation: Column | str = "vegetationtype",
    percent: Column | str = "percentcover",
) -> Column:
    """Absolute cover of one species row (op E2):
    overall x (layer / 100) x (percent / 100) on the row's side; a side or
    layer that is not one of the known labels gives NULL."""
    if all(isinstance(c, str) for c in (community, vegetation, percent)):
        return _memoised(("absolute_cover", community, vegetation, percent),
                         lambda: _absolute_cover(F.col(community), F.col(vegetation), F.col(percent)))
    return _absolute_cover(_c(community), _c(vegetation), _c(percent))


def _absolute_cover(community: Column, vegetation: Column, percent: Column) -> Column:
    result = None
    for side in SIDES:
        overall = F.col(cover_col(side, "overall"))
        specific = side_stratum_cover(side, vegetation)
        value = overall * (specific / F.lit(100.0)) * (percent / F.lit(100.0))
        cond = community == F.lit(COMMUNITY_LABELS[side])
        result = F.when(cond, value) if result is None else result.when(cond, value)
    return no_nan(result)


def no_nan(value: Column) -> Column:
    """Missing is NULL, never NaN (an infinity times 0 gives one)."""
    return F.when(~F.isnan(value), value)


def stratum_absolute_cover(side: str, stratum: str) -> Column:
    """overall x (layer / 100) for one side and layer (op E4); NULL if
    either is NULL."""
    overall = F.col(cover_col(side, "overall"))
    return no_nan(overall * (F.col(cover_col(side, stratum)) / F.lit(100.0)))
