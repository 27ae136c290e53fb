"""Proven row bounds for broadcast joins, from file footers.

A table is broadcast to every task only after its size is proven; a planner
estimate (a compressed file size) says little about the rows in memory.  The
proof reads the row counts in the footers of the Parquet files behind a plan,
on the driver, without a Spark job: the rows of a plan of scans, filters,
projections, aggregates and joins are at most the product of its tables' rows
(a semi-join's those of its left side).
A table of many files or bytes is taken as large without opening any; so is a
plan that is not read from Parquet (an optimisation lost at most: AQE still
broadcasts from measured shuffle sizes, and no result depends on the strategy).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest table broadcast to every task: at about 250 bytes a row (a marker
# with its visit), 100,000 rows are some 25 MB in each executor.
BROADCAST_MAX_ROWS = 100_000
# A table beyond either is large: its footers are not read.
FOOTER_MAX_FILES = 200
FOOTER_MAX_BYTES = 64 * 1024 * 1024

_footers: dict[tuple[int, tuple[str, ...]], int] = {}

# Operators that make no more rows than they read, besides joins.
NARROWING = {"Project", "Filter", "SubqueryAlias", "Aggregate", "Sort", "Distinct", "Deduplicate", "ResolvedHint",
             "UnresolvedHint", "GlobalLimit", "LocalLimit", "Window", "Repartition", "RepartitionByExpression", "View"}


def forget_bounds() -> None:
    """Drop every kept row count: the files behind a table may have changed."""
    _footers.clear()


def footer_rows(jvm, conf, paths: tuple[str, ...]) -> int:
    """Rows of Parquet files, from their footers, kept per list of files."""
    key = (id(jvm), paths)
    if key not in _footers:
        rows = 0
        for path in paths:
            file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
                jvm.org.apache.hadoop.fs.Path(path), conf)
            reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
            try:
                rows += reader.getRecordCount()
            finally:
                reader.close()
        _footers[key] = rows
    return _footers[key]


def _leaf_rows(leaf, jvm, conf) -> int | None:
    if leaf.nodeName() != "LogicalRelation":
        known = leaf.maxRows()
        return int(known.get()) if known.isDefined() else None
    relation = leaf.relation()
    if relation.getClass().getSimpleName() != "HadoopFsRelation" or relation.fileFormat().toString() != "Parquet":
        return None
    location = relation.location()
    if location.sizeInBytes() > FOOTER_MAX_BYTES:
        return None
    paths = tuple(location.inputFiles())
    return footer_rows(jvm, conf, paths) if len(paths) <= FOOTER_MAX_FILES else None


def _plan_rows(plan, jvm, conf) -> int | None:
    children = plan.children()
    if not children.size():
        return _leaf_rows(plan, jvm, conf)
    name = plan.nodeName()
    if name == "Join":
        kind = plan.joinType().sql()
        sides = 1 if kind in ("LEFT SEMI", "LEFT ANTI") else 2
        if kind in ("FULL OUTER", "RIGHT OUTER"):
            return None
        bound = 1
        for i in range(sides):
            rows = _plan_rows(children.apply(i), jvm, conf)
            if rows is None:
                return None
            bound *= max(1, rows)
        return bound
    return _plan_rows(children.apply(0), jvm, conf) if name in NARROWING else None


def row_bound(df: DataFrame) -> int | None:
    """At most how many rows ``df`` has, None if that is not known without
    running it."""
    sc = df.sparkSession.sparkContext
    return _plan_rows(df._jdf.queryExecution().analyzed(), sc._jvm, sc._jsc.hadoopConfiguration())


def is_bounded(df: DataFrame, max_rows: int | None = None) -> bool:
    """Whether ``df`` is proven to have at most ``max_rows`` rows (default
    ``BROADCAST_MAX_ROWS``, read when called)."""
    bound = row_bound(df)
    return bound is not None and bound <= (BROADCAST_MAX_ROWS if max_rows is None else max_rows)


def broadcast_if_bounded(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Broadcast hint on ``df`` if it is proven to have at most ``max_rows``
    rows; any other table is left to the planner.  It decides only the join
    strategy; no total depends on it (``functions.exact``)."""
    return F.broadcast(df) if is_bounded(df, max_rows) else df
