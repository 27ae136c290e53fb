"""Joined frames the reports start from (ops J1-J6) and their filters
(F2-F4, F6).

Join order is written for scale: the dimension-sized tables (locations, event
groups) join the visit table first, visits join markers on ``event_id``, and
only then does the largest table (vegetation) join on ``point_id``.  That is
one shuffle of vegetation, whatever the number of reports built on top.

A dimension table is broadcast only after its files' row counts prove it small
(``bounds``; no job runs while a query is built); otherwise Spark plans a shuffle join, AQE can still
switch it to a broadcast at run time from measured sizes, and AQE's skew-join
split handles a key that holds a large share of the rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotcover.bounds import is_bounded
from plotcover.functions.text import site_point, site_segment
from plotcover.schema import MARKER_VISIT
from plotcover.sources.tables import SurveyTables

VISIT_COLUMNS = ["event_id", "event_group_id", "location_id", "event_type",
                 "start_date", "region", "segment", "location_name"]


def normalised_literal(value: str) -> str:
    """The literal side of op F6: braces dropped, upper case, the same rule
    ``functions.text.normalise_id`` applies to the stored ids."""
    return re.sub(r"[{}]", "", str(value)).upper()


def filter_event_group(df: DataFrame, event_group: str | None,
                       col: str = "event_group_id") -> DataFrame:
    """Rows of one event group (op F6).  The stored ids are normalised when
    read, so the literal is normalised here and the predicate stays a plain
    equality that reaches the Parquet scan and partition pruning."""
    if event_group is None:
        return df
    return df.where(F.col(col) == F.lit(normalised_literal(event_group)))


def filter_event_type(df: DataFrame, event_type: str | None = MARKER_VISIT) -> DataFrame:
    """Visits of one type (op F2), exact text comparison."""
    if event_type is None:
        return df
    return df.where(F.col("event_type") == F.lit(event_type))


# The Pilot site list is segments 01 to 14 with points 1 to 4,
# written '01_1' ... '14_4'.
PILOT_SEGMENTS = range(1, 15)
PILOT_POINTS = range(1, 5)


def pilot_site_codes() -> list[str]:
    return [f"{s:02d}_{p}" for s in PILOT_SEGMENTS for p in PILOT_POINTS]


def filter_site_codes(df: DataFrame, codes: list[str] | None = None,
                      col: str = "location_name") -> DataFrame:
    """Rows whose location name is one of the site codes (op F4); an ``IN``
    list the Parquet scan can use."""
    return df.where(F.col(col).isin(codes if codes is not None else pilot_site_codes()))


def join_stored(table: DataFrame, frame: DataFrame, key: str, by_group: bool) -> DataFrame:
    """A stored table (markers, species rows) joined on ``key`` with a frame
    built on visits, which always carries ``event_group_id``.  In the group
    layout (``sources.tables.write_tables``) the table carries the group too,
    as its partition column.  A report by group then joins on it as well and
    reads only that group's folders; any other report leaves it out, so rows
    of visits without a group stay.  Only schemas are read here."""
    if "event_group_id" not in table.columns:
        return table.join(frame, key)
    if by_group:
        return table.join(frame, [key, "event_group_id"])
    return table.drop("event_group_id").join(frame, key)


def _dimensions(t: SurveyTables, event_group: str | None, with_group: bool
                ) -> list[tuple[DataFrame, str, bool]]:
    """The tables joined to visits: each with its key and whether it is proven
    small, and then hinted."""
    found = [(t.locations.select("location_id", "region", "segment", "location_name"), "location_id")]
    if with_group:
        if t.event_groups is None:
            raise ValueError("this report needs the event_groups table")
        found.append((filter_event_group(t.event_groups, event_group).select(
            "event_group_id", "event_group_name",
            F.col("start_date").alias("group_start_date"),
            F.col("end_date").alias("group_end_date"), "assessment"), "event_group_id"))
    return [(F.broadcast(df) if small else df, key, small)
            for df, key in found for small in [is_bounded(df)]]


def _events(t: SurveyTables, event_type: str | None, event_group: str | None) -> DataFrame:
    return filter_event_group(filter_event_type(t.events, event_type), event_group).select(
        "event_id", "event_group_id", "location_id", "event_type", "start_date")


def visits(t: SurveyTables, event_type: str | None = None,
           event_group: str | None = None, with_group: bool = False) -> DataFrame:
    """Visits with their location (and, if asked, their event group's name
    and start date): events x locations [x event_groups]."""
    out = _events(t, event_type, event_group)
    for table, key, _ in _dimensions(t, event_group, with_group):
        out = out.join(table, key)
    return out


def marker_frame_with_bound(t: SurveyTables, event_type: str | None = None,
                            event_group: str | None = None,
                            with_group: bool = False) -> tuple[DataFrame, bool]:
    """The marker frame, and whether its plan is map-only (every table joined
    to the markers is broadcast, each proven small by itself)."""
    by_group = with_group or event_group is not None
    events, dimensions = _events(t, event_type, event_group), _dimensions(t, event_group, with_group)
    if all(small for _, _, small in dimensions) and is_bounded(t.events):
        out = join_stored(t.markers, F.broadcast(events), "event_id", by_group)
        for table, key, _ in dimensions:
            out = out.join(table, key)
        return out, True
    return join_stored(t.markers, visits(t, event_type, event_group, with_group), "event_id", by_group), False


def marker_frame(t: SurveyTables, event_type: str | None = None,
                 event_group: str | None = None, with_group: bool = False) -> DataFrame:
    """Markers with their visit and location (ops J1, J3, J5).

    Visits are far fewer than points; when they and their dimensions are proven
    small, each is broadcast and markers are shuffled once only (for the
    species join on ``point_id``), not first on ``event_id`` as well."""
    return marker_frame_with_bound(t, event_type, event_group, with_group)[0]


def vegetation_frame(t: SurveyTables, event_type: str | None = None,
                     event_group: str | None = None, with_group: bool = False,
                     require_percent: bool = False) -> DataFrame:
    """Species rows with their marker, visit and location (op J2).
    ``require_percent`` drops rows whose raw percent cover is missing
    (op F3), before any coercion.

    Vegetation, the largest table, meets the markers on ``point_id``.  The
    marker frame is never read to prove its size while the query is built: a
    small one (one campaign, a small survey) is broadcast by Spark itself, from
    its measured shuffle output."""
    veg = t.vegetation
    if require_percent:
        veg = veg.where(F.col("percentcover_raw").isNotNull())
    return species_join(veg, marker_frame(t, event_type, event_group, with_group),
                        by_group=with_group or event_group is not None)


def species_join(vegetation: DataFrame, markers: DataFrame, by_group: bool) -> DataFrame:
    """Species rows with their marker (ops J2, J4)."""
    return join_stored(vegetation, markers, "point_id", by_group)


def locations_from_pilot(geo_locations: DataFrame) -> DataFrame:
    """Pilot-generation location table (``globalid``, ``loc_name_short``) in
    the common schema (op S4): id and name renamed, region and segment absent
    and so typed NULL."""
    cols = {c.lower(): c for c in geo_locations.columns}
    return geo_locations.select(
        F.col(cols["globalid"]).alias("location_id"),
        F.lit(None).cast("string").alias("region"),
        F.lit(None).cast("string").alias("segment"),
        F.col(cols["loc_name_short"]).alias("location_name"),
    )


def stratum_fanout_frame(t: SurveyTables, event_type: str | None = MARKER_VISIT) -> DataFrame:
    """Pilot's stratum frame (op J4): markers joined to vegetation as well,
    so each marker row repeats once per species row of its point, and the
    sites limited to the Pilot list (op F4)."""
    markers = filter_site_codes(marker_frame(t, event_type))
    return species_join(t.vegetation.select("point_id"), markers, by_group=False)


def with_lookup_region(rows: DataFrame, lookup: DataFrame, col: str = "location_name",
                       out_col: str = "region") -> DataFrame:
    """Region from a site lookup (op J6), matched on the site code's numbers
    so '01_1' meets '01-01' (D2).  The lookup is a fixed 56-row table,
    broadcast by construction; rows whose code is not in it drop out, as in
    an inner merge."""
    keyed = rows.withColumn("_seg", site_segment(col)).withColumn("_pt", site_point(col))
    lk = lookup.select(F.col("region").alias(out_col),
                       site_segment("location_name").alias("_seg"),
                       site_point("location_name").alias("_pt"))
    return F.broadcast(lk).join(keyed, ["_seg", "_pt"]).drop("_seg", "_pt")
