"""Boundary-distance summary (SOP8-1; ops J5, O4, A1, A2, T1, O3, F8).

Per (event group, region, segment): mean, standard error, count, minimum and
maximum of the measured distance, and Student-t confidence limits.  Every
statistic is algebraic, so Spark combines it map-side and the shuffle carries
one partial row per group per task, however large a group is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotcover.functions.cover import no_nan
from plotcover.functions.student_t import with_t_critical
from plotcover.functions.text import segment_number
from plotcover.operators.frames import marker_frame
from plotcover.operators.pivots import drop_missing_keys
from plotcover.schema import MARKER_VISIT
from plotcover.sources.tables import SurveyTables

DISTANCE_COLUMNS = ["event_group_id", "event_group_name", "group_start_date", "group_end_date",
                    "assessment", "event_type",
                    "location_id", "region", "segment", "location_name", "point_id",
                    "distance", "method"]
SUMMARY_KEYS = ["event_group_id", "region", "segment"]


def distance_rows(t: SurveyTables, event_type: str | None = MARKER_VISIT,
                  ordered: bool = False) -> DataFrame:
    """Marker distances of marker visits with their location and event
    group.  ``ordered`` sorts by segment, location name and visit type (O4),
    then point id so the order is total."""
    df = marker_frame(t, event_type=event_type, with_group=True).select(*DISTANCE_COLUMNS)
    if ordered:
        df = df.orderBy("segment", "location_name", "event_type", "point_id")
    return df


def limit_names(confidence: float) -> tuple[str, str]:
    """Names of the confidence limits: ``lower_ci_95`` at 0.95."""
    percent = f"{100 * confidence:.6g}".replace(".", "_")
    return f"lower_ci_{percent}", f"upper_ci_{percent}"


def distance_summary(rows: DataFrame, keys: Sequence[str] = SUMMARY_KEYS,
                     confidence: float | None = 0.95, ordered: bool = True) -> DataFrame:
    """A1 (+ A2 when ``confidence`` is given).

    A row with a missing key is left out (N3).  The standard error is the
    sample standard deviation over the square root of the count of present
    distances; with one distance or none it is NULL, and so are the limits
    (N6), as with an infinite distance (missing is never NaN).  Limits are mean -/+ t x standard error with t the two-sided
    critical value at dof = count - 1.  Rows are sorted by the segment's
    number, missing last (T1, O3); the sort key and the working columns are
    not kept (F8)."""
    d = F.col("distance")
    summary = drop_missing_keys(rows, keys).groupBy(*keys).agg(
        no_nan(F.avg(d)).alias("average_dist_m"),
        no_nan(F.stddev_samp(d) / F.sqrt(F.count(d))).alias("standard_error"),
        F.count(d).alias("rec_count"),
        F.min(d).alias("min_difference"),
        F.max(d).alias("max_difference"),
    )
    if confidence is not None:
        summary = with_t_critical(summary.withColumn("dof", F.col("rec_count") - 1),
                                  "dof", "t_crit", confidence)
        margin = F.col("t_crit") * F.col("standard_error")
        lower, upper = limit_names(confidence)
        summary = summary.withColumns({lower: no_nan(F.col("average_dist_m") - margin),
                                       upper: no_nan(F.col("average_dist_m") + margin)}).drop("dof", "t_crit")
    if ordered:
        summary = summary.orderBy(segment_number("segment").asc_nulls_last(), *keys)
    return summary


def segment_sort_keys(rows: DataFrame) -> DataFrame:
    """T1 over the segments that occur: each label with its number."""
    return rows.select("segment").distinct().withColumn("segment_number",
                                                        segment_number("segment"))
