"""Event groups: the campaign list (S2, T4) and every per-group report
computed for all groups in one plan (A7, F10, T3).

The reference's loop runs each report once per event group; here the group
id is one more grouping key, so each table is read once and all groups share
one shuffle.  A group holding most of the rows is no hot spot: aggregation is
combined map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotcover.functions.text import contains_word, year_of
from plotcover.operators.checks import (POINT_KEYS, point_count_long, point_rows, point_sum_long,
                                        relcover_check, strata_check)
from plotcover.operators.frames import marker_frame
from plotcover.operators.cover import abs_cover_long, point_cover_rows
from plotcover.schema import SEGMENT_GROUP_WORD
from plotcover.sources.tables import SurveyTables

GROUP_POINT_KEYS = ["event_group_id"] + POINT_KEYS


def event_group_list(t: SurveyTables) -> DataFrame:
    """Id, name and start year of every event group."""
    if t.event_groups is None:
        raise ValueError("the event_groups table is needed")
    return t.event_groups.select(
        "event_group_id", "event_group_name",
        year_of("start_date").alias("event_group_year"))


def conditional_segment(rows: DataFrame, name_col: str = "event_group_name") -> DataFrame:
    """Segment is a report key only for groups whose name contains
    'Segment' (case-sensitive, T3).  In those groups a row without a segment
    leaves the report (N3); in the others the segment is set to NULL and
    every row stays."""
    by_segment = contains_word(name_col, SEGMENT_GROUP_WORD)
    return (rows.where(~by_segment | F.col("segment").isNotNull())
            .withColumn("segment", F.when(by_segment, F.col("segment"))))


def group_point_rows(t: SurveyTables) -> DataFrame:
    return conditional_segment(point_rows(t, with_group=True))


def point_sum_by_group(t: SurveyTables) -> DataFrame:
    """A4 for every group at once, Segment a key only where F10 says so."""
    return point_sum_long(group_point_rows(t), GROUP_POINT_KEYS, nullable_keys=("segment",))


def point_count_by_group(t: SurveyTables) -> DataFrame:
    """A3 for every group at once."""
    return point_count_long(group_point_rows(t), GROUP_POINT_KEYS, nullable_keys=("segment",))


def relcover_by_group(t: SurveyTables) -> DataFrame:
    """A5 for every group at once."""
    return relcover_check(group_point_rows(t), GROUP_POINT_KEYS, nullable_keys=("segment",))


def strata_check_by_group(t: SurveyTables) -> DataFrame:
    """E1 for every group at once; visits without a group leave."""
    frame = marker_frame(t, event_type=None, with_group=True)
    return strata_check(None, frame=frame, extra_cols=["event_group_id", "point_id"])


def abs_cover_by_group(t: SurveyTables) -> DataFrame:
    """SOP8-2 long form for every group at once (A6 + A7)."""
    return abs_cover_long(point_cover_rows(t), extra_keys=["event_group_id"])
