"""Table schemas and column names of the survey data model.

Five tables: locations, event groups, events (visits), markers (one row per
point per visit: covers and boundary distance) and vegetation (one row per
species per stratum per side per point).  All names are lower case; readers
normalise source names to these (``sources.tables``).
"""

from __future__ import annotations

from pyspark.sql import types as T

SIDES = ("mangrove", "marsh")          # community sides of the boundary
STRATA = ("tree", "shrub", "herb")     # vegetation layers within a side

# Fixed values of the source data model: the community and layer labels the
# vegetation rows carry, the visit type of a marker visit, and the word an
# event-group name contains when its reports are kept per segment.
COMMUNITY_LABELS = {"mangrove": "Mangrove", "marsh": "Marsh"}
STRATUM_LABELS = {"tree": "Tree", "shrub": "Shrub", "herb": "Herb"}
OVERALL_LABEL = "Overall"
MARKER_VISIT = "Marker Visit"
SEGMENT_GROUP_WORD = "Segment"


def cover_col(side: str, stratum: str) -> str:
    """Name of a relative-cover column of the marker table."""
    return f"{side}side_cover_{stratum}"


def abs_cover_col(side: str, stratum: str) -> str:
    """Name of an absolute-cover-by-stratum column (SOP8-3)."""
    return f"abscover_{side}_{stratum}"


OVERALL_COLS = [cover_col(s, "overall") for s in SIDES]
STRATUM_COLS = [cover_col(s, st) for s in SIDES for st in STRATA]
# The eight cover columns; with the percent cover they are the nine that are
# coerced to numbers before absolute cover is computed.
COVER_COLS = [
    cover_col(s, st) for s in SIDES for st in ("overall",) + STRATA
]

LOCATIONS = T.StructType([
    T.StructField("location_id", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("location_name", T.StringType()),
])

EVENT_GROUPS = T.StructType([
    T.StructField("event_group_id", T.StringType()),
    T.StructField("event_group_name", T.StringType()),
    T.StructField("start_date", T.DateType()),
    T.StructField("end_date", T.DateType()),
    T.StructField("assessment", T.StringType()),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_group_id", T.StringType()),
    T.StructField("location_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("start_date", T.DateType()),
])

MARKERS = T.StructType(
    [
        T.StructField("point_id", T.StringType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("distance", T.DoubleType()),
        T.StructField("method", T.StringType()),
    ]
    + [T.StructField(c, T.DoubleType()) for c in COVER_COLS]
)

VEGETATION = T.StructType([
    T.StructField("point_id", T.StringType()),
    T.StructField("communitytype", T.StringType()),
    T.StructField("vegetationtype", T.StringType()),
    T.StructField("speciescode", T.StringType()),
    T.StructField("percentcover_raw", T.StringType()),
])

SCHEMAS = {
    "locations": LOCATIONS,
    "event_groups": EVENT_GROUPS,
    "events": EVENTS,
    "markers": MARKERS,
    "vegetation": VEGETATION,
}
