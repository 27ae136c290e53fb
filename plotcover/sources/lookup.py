"""The static site -> region lookup of the Pilot generation (ops S3, T2).

Fixed values: 56 sites, four points to a segment, numbered in order; the
first 20 sites are Turner River, the next 16 Shark Slough, the last 20 Taylor
Slough.  Codes are written '01-01' (two-digit segment, dash, two-digit point).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotcover.functions.text import format_site_code

SITE_REGIONS = [("Turner River", 20), ("Shark Slough", 16), ("Taylor Slough", 20)]
POINTS_PER_SEGMENT = 4


def site_region_lookup(spark: SparkSession) -> DataFrame:
    """DataFrame (region, location_name), one row per site; built from a
    range, so it is 56 rows on any cluster and safe to broadcast."""
    total = sum(n for _, n in SITE_REGIONS)
    i = F.col("id")
    region = None
    upper = 0
    for name, count in SITE_REGIONS:
        upper += count
        cond = i < F.lit(upper)
        region = F.when(cond, F.lit(name)) if region is None else region.when(cond, F.lit(name))
    segment = (F.floor(i / POINTS_PER_SEGMENT) + 1).cast("int")
    point = (i % POINTS_PER_SEGMENT + 1).cast("int")
    return spark.range(total).select(
        region.alias("region"),
        format_site_code(segment, point, separator="-", point_width=2)
        .alias("location_name"),
    )
