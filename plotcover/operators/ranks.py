"""Row order as data (ops O1-O5): each row with its place in a sorted table.

A global window would put every row in one task.  Here rows are range-
partitioned and sorted, numbered within their partition and written; the rows
of each partition are counted from the written table, and the counts before a
partition are added.  The counts are one row a partition, so small by
construction.  The order must be total (end in a unique key): equal rows of one
order may lie on either side of each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotcover.sources.sinks import materialize

WITHIN_BITS = 33       # of a row's number, below its partition's (Spark's row ids)


def with_position(df: DataFrame, order: Sequence[Column | str], out: str = "position",
                  folder: str | None = None) -> DataFrame:
    """``df`` with ``out``, 1 for its first row in ``order``.  The sorted rows
    are written to the checkpoint folder first (under ``folder``, from
    ``sinks.scratch_folder``, if the caller removes them)."""
    numbered = (df.repartitionByRange(*order).sortWithinPartitions(*order)
                .withColumn("_row", F.monotonically_increasing_id()))
    written = materialize(numbered, "positions", folder)
    part = F.shiftright("_row", WITHIN_BITS).alias("_part")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = written.groupBy(part).agg(F.count(F.lit(1)).alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0).cast("long")).alias("_start"))
    within = F.col("_row").bitwiseAND(F.lit((1 << WITHIN_BITS) - 1).cast("long"))
    return (written.withColumn("_part", part).join(F.broadcast(starts), "_part")
            .withColumn(out, F.col("_start") + within + 1).drop("_part", "_row", "_start"))
