"""
(ops A3, A4, A6, O5, O6).

The long form — one row per (keys, pivot value) that occurs — is the
canonical, scalable result: one aggregation with map-side combine, so a hot
key is pre-aggregated in every task before the shuffle.  The wide form pivots
the already aggregated long form (one more small aggregate) in the same lazy
plan.  Its columns are an input: the caller supplies the pivot values (from
the locations or species dimension), however many there are, and a value
outside them fails the job rather than vanish.

Sums of doubles are exact and rounded once (``functions.exact``), so they depend
neither on the order of rows nor on a join strategy.

Rules: a row with a missing key or pivot value is left out (N3); a sum over
only missing values is 0.0 (N4); a count over only missing values is 0 (N5);
a combination that never occurs is NULL in the wide form, never 0.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotcover.functions.cover import cells_sum, equals_exactly, no_nan
from plotcover.functions.exact import exact_sum
from plotcover.functions.text import site_point, site_segment


def _aggregate(agg: str, value: str) -> Column:
    if agg == "sum":
        return exact_sum(value)
    if agg == "count":
        return F.count(value)
    raise ValueError(f"unsupported pivot aggregate {agg!r}")


def drop_missing_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rule N3: rows with a NULL in any grouping key are left out."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df if cond is None else df.where(cond)


def long_pivot(df: DataFrame, keys: Sequence[str], column: str, value: str,
               agg: str = "sum", out: str | None = None,
               nullable_keys: Sequence[str] = ()) -> DataFrame:
    """One row per occurring (keys, column) with the aggregate of ``value``.
    ``nullable_keys`` are keys already resolved by the caller (F10) and kept
    even when NULL."""
    out = out or f"{agg}_{value}"
    group = list(keys) + [column]
    required = [k for k in group if k not in nullable_keys]
    return drop_missing_keys(df, required).groupBy(*group).agg(_aggregate(agg, value).alias(out))


def site_order(values: Sequence[str]) -> list[str]:
    """Site codes by segment then point number (O6), other names after them
    in text order."""
    def key(v):
        m = re.match(r"^\s*([0-9]+)[_-]([0-9]+)\s*$", str(v))
        return (0, int(m.group(1)), int(m.group(2)), str(v)) if m else (1, 0, 0, str(v))
    return sorted(values, key=key)


def wide_pivot(long_df: DataFrame, keys: Sequence[str], column: str, measure: str,
               values: Sequence, order: str = "text",
               row_total: str | None = None, total_flag: str | None = None,
               total_target: float = 100.0) -> DataFrame:
    """Pivot an aggregated long form to one column per value in ``values``,
    in text order (O5) or site order (O6).

    ``row_total`` adds the row sum over the pivot cells in column order,
    skipping NULL cells (N1); ``total_flag`` adds whether that total equals
    ``total_target`` exactly (A5, D7).  Rows are sorted by the keys (O5).
    A value outside ``values`` fails the job: the wide schema would lose it."""
    names = site_order(values) if order == "site" else sorted(values)
    known = F.col(column).isin(list(names)) if names else F.lit(False)
    checked = F.when(known, F.col(column)).otherwise(F.raise_error(
        F.concat(F.lit(f"{column} outside the wide table's columns: "), F.col(column).cast("string"))))
    wide = (long_df.withColumn(column, checked.cast(long_df.schema[column].dataType))
            .groupBy(*keys).pivot(column, list(names)).agg(F.first(measure)))
    if row_total:
        wide = wide.withColumn(row_total, cells_sum(names))
        if total_flag:
            wide = wide.withColumn(total_flag, equals_exactly(row_total, total_target))
    return wide.orderBy(*keys)


def wide_cells(wide: DataFrame, keys: Sequence[str], names: Sequence[str], column: str,
               measure: str) -> DataFrame:
    """The cells of a wide table as rows, empty ones too: its keys, each cell's
    place among the table's value columns (O5, O6), its column and its value."""
    ordered = [c for c in wide.columns if c in set(names)]
    cells = F.array(*[F.struct(F.lit(c).alias(column), F.col("`" + c.replace("`", "``") + "`").alias(measure))
                      for c in ordered])
    rows = wide.select(*keys, F.posexplode(cells).alias("at", "cell"))
    return rows.select(*keys, (F.col("at") + 1).alias("column_position"), "cell.*")


def pandas_pivot(df: DataFrame, keys: Sequence[str], column: str, value: str,
                 values: Sequence, agg: str = "sum", order: str = "text",
                 extra_keys: Sequence[str] = ()) -> DataFrame:
    """Wide pivot of raw rows in one call: long aggregate, then pivot.
    ``extra_keys`` (event group, date...) lead the row keys (A7, D4)."""
    all_keys = list(extra_keys) + list(keys)
    measure = f"{agg}_{value}"
    return wide_pivot(long_pivot(df, all_keys, column, value, agg, out=measure),
                      all_keys, column, measure, values, order)


def _ordered_cells(long_df: DataFrame, keys: Sequence[str], column: str, measure: str,
                   out: str) -> DataFrame:
    """One row per keys: the cells (column, measure) of an aggregated long form
    in the order of ``column``, and ``out``, their total added in that order,
    as the wide form adds its columns.  What is gathered per key is one number
    per occurring value of the column."""
    cells = F.array_sort(F.collect_list(F.struct(F.col(column).alias("at"), F.col(measure).alias("cell"))))
    total = F.aggregate("cells", F.lit(0.0), lambda held, c: held + F.coalesce(c["cell"], F.lit(0.0)))
    return long_df.groupBy(*keys).agg(cells.alias("cells")).select(*keys, "cells", no_nan(total).alias(out))


def ordered_total(long_df: DataFrame, keys: Sequence[str], column: str, measure: str,
                  out: str) -> DataFrame:
    """One row per keys with the total of its cells, added in column order."""
    return _ordered_cells(long_df, keys, column, measure, out).drop("cells")


def with_ordered_total(long_df: DataFrame, keys: Sequence[str], column: str, measure: str,
                       out: str) -> DataFrame:
    """The long form with ``ordered_total`` on each of its rows: one aggregate
    gives both, the cells are listed again after it."""
    rows = _ordered_cells(long_df, keys, column, measure, out)
    return rows.select(*keys, F.inline("cells"), out).select(
        *keys, F.col("at").alias(column), F.col("cell").alias(measure), out)


def site_order_key(col: str = "location_name") -> list[Column]:
    """Sort expressions for site codes in site order."""
    return [site_segment(col).asc_nulls_last(), site_point(col).asc_nulls_last(), F.col(col)]
