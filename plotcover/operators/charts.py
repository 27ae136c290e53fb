"""Chart data for the SOP8-3 figure (ops C1, F5, F7, F9).

The figure itself (stacked bars per region, Marsh side above, Mangrove side
below) is drawing, not data work; what it plots is built here as a long
series table a report tool can draw from directly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plotcover.schema import COMMUNITY_LABELS, STRATA, STRATUM_LABELS, abs_cover_col, cover_col

# Panel order: Marsh side on top, Mangrove side below; bar segments in
# legend order Tree, Shrub, Herb.
SIDE_ORDER = ("marsh", "mangrove")

# The regions the Protocol and Pilot figures draw, in page
# order (the Merged figure draws the regions found in the data instead).
FIXED_REGIONS = ("Turner River", "Shark Slough", "Taylor Slough")


def region_list(stratum_rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """the regions in the order a table sorted by location name meets
    them, i.e. by each region's first location name; ``keys`` (the event
    group) give one list per key."""
    # The minimum of a string has no fixed-width buffer, so Spark would sort
    # every row to aggregate it.  Instead: distinct (region, location) pairs
    # by hash aggregation, combined map-side, then the first location of each
    # region by a window over those few pairs.
    pairs = stratum_rows.select(*keys, "region", "location_name").distinct()
    first = Window.partitionBy(*keys, "region").orderBy(F.col("location_name").asc_nulls_last())
    firsts = (pairs.withColumn("_rank", F.row_number().over(first))
              .where(F.col("_rank") == 1)
              .select(*keys, "region", F.col("location_name").alias("first_location_name")))
    # one row per region (and key): the window only ever sees that many rows
    order = Window.partitionBy(*keys).orderBy(F.col("first_location_name").asc_nulls_last(),
                                              F.col("region").asc_nulls_last())
    return firsts.withColumn("region_order", F.row_number().over(order))


def fixed_region_list(stratum_rows: DataFrame,
                      regions: Sequence[str] = FIXED_REGIONS) -> DataFrame:
    """F9 for Protocol and Pilot: the given regions in the given order, each
    with its first location name in the data (NULL for a region without
    rows, whose page is empty)."""
    fixed = stratum_rows.sparkSession.createDataFrame(
        [(r, i) for i, r in enumerate(regions, start=1)], "region string, region_order int")
    firsts = region_list(stratum_rows.where(F.col("region").isin(list(regions)))).select(
        "region", "first_location_name")
    return F.broadcast(fixed).join(firsts, "region", "left").select(
        "region", "first_location_name", "region_order")


def chart_series(stratum_rows: DataFrame, region: str | None = None) -> DataFrame:
    """One row per bar segment — (region, side, location, visit, layer)
    with its absolute cover; the side's overall cover rides along but is not
    a segment of the stack (D8).  ``region`` keeps one region (F5).  Layer
    names are the plain labels 'Tree', 'Shrub', 'Herb' (F7)."""
    df = stratum_rows if region is None else stratum_rows.where(F.col("region") == F.lit(region))
    parts = []
    for side_rank, side in enumerate(SIDE_ORDER, start=1):
        for stratum_rank, stratum in enumerate(STRATA, start=1):
            parts.append(F.struct(
                F.lit(COMMUNITY_LABELS[side]).alias("side"),
                F.lit(side_rank).alias("side_order"),
                F.lit(STRATUM_LABELS[stratum]).alias("stratum"),
                F.lit(stratum_rank).alias("stratum_order"),
                F.col(cover_col(side, "overall")).alias("overall_cover"),
                F.col(abs_cover_col(side, stratum)).alias("abs_cover"),
            ))
    ids = [c for c in ("event_group_id", "region", "location_name", "start_date", "point_id")
           if c in df.columns]
    return df.select(*ids, F.inline(F.array(*parts)))
