"""Absolute cover: per species row and per location (SOP8-2, ops E2, E3,
A6, A7) and per stratum (SOP8-3, ops J3, E4, O2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotcover.functions.cover import absolute_cover, stratum_absolute_cover, to_number
from plotcover.operators.frames import marker_frame, vegetation_frame
from plotcover.operators.pivots import long_pivot, wide_pivot
from plotcover.schema import COVER_COLS, MARKER_VISIT, SIDES, STRATA, abs_cover_col, cover_col
from plotcover.sources.tables import SurveyTables

SPECIES_KEYS = ["communitytype", "vegetationtype", "speciescode"]

POINT_COVER_COLUMNS = (
    ["event_group_id", "start_date", "region", "location_name", "event_type",
     "communitytype", "vegetationtype", "speciescode", "percentcover_raw"]
    + COVER_COLS
)


def point_cover_rows(t: SurveyTables, event_group: str | None = None,
                     event_type: str | None = MARKER_VISIT) -> DataFrame:
    """The SOP8-2 input (ops J2, F2, F3): species rows of marker visits whose
    raw percent cover is present, with the point's covers and location."""
    return vegetation_frame(t, event_type=event_type, event_group=event_group,
                            require_percent=True).select(*POINT_COVER_COLUMNS)


def coerce_covers(rows: DataFrame) -> DataFrame:
    """Op E3 on the nine cover columns and the percent cover: each becomes a
    double, unreadable text NULL.  ``percentcover`` is the coerced value,
    ``percentcover_raw`` stays as read."""
    types = {f.name: f.dataType for f in rows.schema.fields}
    coerced = {c: to_number(c, types[c]) for c in COVER_COLS}
    coerced["percentcover"] = to_number("percentcover_raw", types["percentcover_raw"])
    return rows.withColumns(coerced)


def abs_cover_rows(rows: DataFrame) -> DataFrame:
    """Coerce (E3), then the absolute cover of each species row (E2), in the
    order the report applies them (D11)."""
    return coerce_covers(rows).withColumn("abs_cover", absolute_cover())


def abs_cover_long(rows: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """SOP8-2 in long form (A6): the sum of absolute cover per species row
    keys and location; a combination whose covers are all missing is 0.0.
    ``extra_keys`` (e.g. ``event_group_id``) make it one table per group (A7)."""
    keys = list(extra_keys) + SPECIES_KEYS
    return long_pivot(abs_cover_rows(rows), keys, "location_name", "abs_cover",
                      "sum", out="abs_cover")


def abs_cover_wide(rows: DataFrame, locations: Sequence[str], extra_keys: Sequence[str] = (),
                   order: str = "text") -> DataFrame:
    """SOP8-2 as the report shows it: species rows by location columns (the
    names in ``locations``), in text order (O5) or site order (O6)."""
    keys = list(extra_keys) + SPECIES_KEYS
    return wide_pivot(abs_cover_long(rows, extra_keys), keys, "location_name", "abs_cover",
                      locations, order)


STRATUM_COLUMNS = (
    ["event_group_id", "point_id", "location_id", "region", "location_name", "start_date"]
)


def abs_cover_by_stratum(t: SurveyTables | None, event_group: str | None = None,
                         event_type: str | None = MARKER_VISIT,
                         frame: DataFrame | None = None,
                         id_columns: Sequence[str] = STRATUM_COLUMNS) -> DataFrame:
    """SOP8-3 rows (J3, E4): per marker visit, each side's covers and the
    absolute cover of each layer, overall x layer / 100.  ``frame`` replaces
    the default marker frame (Pilot's fan-out, J4)."""
    frame = frame if frame is not None else marker_frame(t, event_type, event_group)
    cols = [F.col(c) for c in id_columns]
    for side in SIDES:
        cols += [F.col(cover_col(side, s)) for s in ("overall",) + STRATA]
        cols += [stratum_absolute_cover(side, s).alias(abs_cover_col(side, s)) for s in STRATA]
    return frame.select(*cols)


def order_stratum_rows(df: DataFrame) -> DataFrame:
    """O2: by location name then visit date; the point id breaks ties so the
    order is total and a location holding many rows can still be split over
    several range partitions."""
    return df.orderBy("location_name", "start_date", "point_id")
