"""Quality checks on relative cover (ops J1, E1, O1, A3, A4, A5).

* Across strata: per marker visit, Tree + Shrub + Herb on each side should
  be 100 (E1).  A map-only job after the joins.
* Within a stratum: per location, side, layer and visit type, the species
  covers should add up to 100 (A5), with the count and sum pivots by species
  behind it (A3, A4).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotcover.functions.cover import equals_exactly, row_sum, to_number
from plotcover.operators.frames import marker_frame, vegetation_frame
from plotcover.operators.pivots import long_pivot, ordered_total, wide_pivot
from plotcover.schema import SIDES, STRATA, STRATUM_COLS, cover_col
from plotcover.sources.tables import SurveyTables

STRATA_CHECK_COLUMNS = ["region", "segment", "location_name", "event_type"] + STRATUM_COLS

# Row keys of the within-stratum check (Protocol and segment groups).
POINT_KEYS = ["region", "segment", "location_name", "communitytype", "vegetationtype",
              "event_type"]
# Pilot tables carry no region or segment.
PILOT_POINT_KEYS = ["location_name", "communitytype", "vegetationtype", "event_type"]


def strata_check(t: SurveyTables | None, event_group: str | None = None,
                 extra_cols: Sequence[str] = (), ordered: bool = False,
                 frame: DataFrame | None = None,
                 columns: Sequence[str] = STRATA_CHECK_COLUMNS) -> DataFrame:
    """Across-strata check (E1): every marker row of every visit type, the
    three layer covers summed per side with missing read as 0, and whether
    each sum is exactly 100.
    ``ordered`` sorts by location name (O1), with the point id as tie-breaker
    so a busy location spreads over several range partitions."""
    frame = frame if frame is not None else marker_frame(t, event_type=None, event_group=event_group)
    df = frame.select(*extra_cols, *columns)
    sums = {f"sum_{side}": row_sum(*[cover_col(side, s) for s in STRATA]) for side in SIDES}
    df = df.withColumns(sums).withColumns(
        {f"{side}_is_100": equals_exactly(f"sum_{side}", 100.0) for side in SIDES})
    if ordered:
        df = df.orderBy("location_name", *[c for c in ("point_id",) if c in df.columns])
    return df


def point_rows(t: SurveyTables, event_group: str | None = None,
               with_group: bool = False) -> DataFrame:
    """Within-stratum check input (J2): every species row of every visit,
    no visit-type or missing-cover filter; ``percentcover`` is the raw value
    read as a number (E3), ``percentcover_raw`` the value as recorded."""
    frame = vegetation_frame(t, event_type=None, event_group=event_group, with_group=with_group)
    types = {f.name: f.dataType for f in frame.schema.fields}
    return frame.withColumn("percentcover", to_number("percentcover_raw", types["percentcover_raw"]))


def point_count_long(rows: DataFrame, keys: Sequence[str] = POINT_KEYS,
                     nullable_keys: Sequence[str] = ()) -> DataFrame:
    """A3 long: number of species rows with a recorded cover, readable as a
    number or not, per keys and species."""
    return long_pivot(rows, keys, "speciescode", "percentcover_raw", "count", out="n_percentcover",
                      nullable_keys=nullable_keys)


def point_sum_long(rows: DataFrame, keys: Sequence[str] = POINT_KEYS,
                   nullable_keys: Sequence[str] = ()) -> DataFrame:
    """A4 long: sum of species covers per keys and species (0.0 when all
    missing)."""
    return long_pivot(rows, keys, "speciescode", "percentcover", "sum", out="sum_percentcover",
                      nullable_keys=nullable_keys)


def point_count_wide(rows: DataFrame, species: Sequence[str],
                     keys: Sequence[str] = POINT_KEYS) -> DataFrame:
    """A3 as the report shows it: keys by species columns, counts."""
    return wide_pivot(point_count_long(rows, keys), keys, "speciescode", "n_percentcover", species)


def point_sum_wide(rows: DataFrame, species: Sequence[str],
                   keys: Sequence[str] = POINT_KEYS) -> DataFrame:
    """A4 + A5 as the report shows them: species sums, their row total
    ``sum_relcover`` and the flag ``relcover_is_100``."""
    return wide_pivot(point_sum_long(rows, keys), keys, "speciescode", "sum_percentcover", species,
                      row_total="sum_relcover", total_flag="relcover_is_100")


def relcover_check(rows: DataFrame, keys: Sequence[str] = POINT_KEYS,
                   nullable_keys: Sequence[str] = ()) -> DataFrame:
    """A5 without the wide table: an exact total per species, whatever the
    order of the rows, then the species totals added in species order, as the
    wide form adds its columns.  So both forms and any join strategy agree."""
    sums = point_sum_long(rows, keys, nullable_keys)
    return ordered_total(sums, keys, "speciescode", "sum_percentcover", "sum_relcover").withColumn(
        "relcover_is_100", equals_exactly("sum_relcover", 100.0))
