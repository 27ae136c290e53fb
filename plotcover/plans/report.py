"""The whole report in one Spark application: for every event group at once
(Merged generation), or once over a whole source without groups (Protocol,
Pilot).

The reference runs four reports once per event group, each re-reading and
re-joining the database.  This plan joins once:

1. the species frame (vegetation x markers x visits x groups, op J2) is
   written to the shared checkpoint folder; every species report reads it;
2. the marker frame (markers x visits x groups, ops J1/J3/J5) is written
   too when its join shuffles; with broadcast visits it is map-only;
3. each report adds ``event_group_id`` to its keys (A7) and is written as its
   own dataset, partitioned by group (S5, S6).

Shuffles: one join shuffle of vegetation and markers, then one small shuffle
per aggregate report, each combined map-side first.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotcover.functions.cover import equals_exactly, to_number
from plotcover.bounds import broadcast_if_bounded
from plotcover.operators import charts
from plotcover.operators.checks import (PILOT_POINT_KEYS, POINT_KEYS, STRATA_CHECK_COLUMNS,
                                        point_count_long, point_sum_long, strata_check)
from plotcover.operators.cover import (POINT_COVER_COLUMNS, STRATUM_COLUMNS, abs_cover_by_stratum,
                                       abs_cover_long)
from plotcover.operators.distance import DISTANCE_COLUMNS, distance_rows, distance_summary
from plotcover.operators.frames import (filter_site_codes, marker_frame_with_bound, species_join,
                                       with_lookup_region)
from plotcover.operators.pivots import with_ordered_total
from plotcover.operators.groups import GROUP_POINT_KEYS, conditional_segment, event_group_list
from plotcover.schema import MARKER_VISIT, STRATUM_COLS
from plotcover.sources import sinks
from plotcover.sources.lookup import site_region_lookup
from plotcover.sources.tables import SurveyTables


# The three generations of the survey database and their reports: Merged
# has event groups and reports per group; Protocol and Pilot have no group
# table and report once over the whole source.  Pilot locations carry no
# region or segment: its checks are keyed by location only, its covers keep
# the Pilot site list (F4) and its stratum rows take region from the site
# lookup (S3, J6).
GENERATIONS = ("merged", "protocol", "pilot")

# Columns of the species frame the species reports read (the SOP8-2 input,
# the check keys and the group name for the conditional Segment key).
SPECIES_FRAME_COLUMNS = POINT_COVER_COLUMNS + ["segment", "event_group_name"]


def shared_frames(t: SurveyTables, materialize: bool = True, folder: str | None = None,
                  with_group: bool = True) -> tuple[DataFrame, DataFrame]:
    """The species frame and the marker frame every report reads, for all
    groups and visit types.

    When ``materialize``, the species frame (a shuffle join of the largest
    table) is written once under ``folder``.  The marker frame is written
    first only when its own join shuffles (visits too many to broadcast), and
    the species frame is then built on the written copy; with broadcast
    visits it is a map-only plan, as cheap to recompute as to re-read."""
    markers, small_visits = marker_frame_with_bound(t, None, None, with_group)
    if materialize and not small_visits:
        markers = sinks.materialize(markers, "marker_frame", folder)
    species = species_join(t.vegetation, markers, by_group=with_group)
    if materialize:
        # only the columns the species reports read: the largest write of
        # the run, and every report re-reads it
        keep = [c for c in SPECIES_FRAME_COLUMNS if c in species.columns]
        species = sinks.materialize(species.select(*keep), "species_frame", folder)
    return species, markers


def build_report(t: SurveyTables, confidence: float = 0.95,
                 materialize: bool = True, folder: str | None = None,
                 generation: str = "merged") -> dict[str, DataFrame]:
    """Every result of the report, keyed by the name of the sheet it
    replaces: for all event groups at once (``merged``), or once over the
    whole source (``protocol``, ``pilot``)."""
    if generation not in GENERATIONS:
        raise ValueError(f"generation must be one of {GENERATIONS}")
    by_group = generation == "merged"
    species, markers = shared_frames(t, materialize, folder, with_group=by_group)
    types = {f.name: f.dataType for f in species.schema.fields}
    species = species.withColumn(
        "percentcover", to_number("percentcover_raw", types["percentcover_raw"]))
    sop82_rows = species.where(
        (F.col("event_type") == F.lit(MARKER_VISIT)) & F.col("percentcover_raw").isNotNull()
    ).select(*POINT_COVER_COLUMNS)
    visits = markers.where(F.col("event_type") == F.lit(MARKER_VISIT))
    if by_group:
        results = _group_report(species, markers, sop82_rows, visits, confidence)
        groups = event_group_list(t)
        named = {name: label_groups(df, groups) for name, df in results.items()}
        return {sinks.SHEET_EVENT_GROUPS: groups} | named
    results = _source_report(species, markers, sop82_rows, visits, generation == "pilot")
    if generation == "protocol" and t.event_groups is not None:
        results[sinks.SHEET_DISTANCE] = distance_summary(distance_rows(t), confidence=confidence,
                                                         ordered=False)
    return results


def label_groups(df: DataFrame, groups: DataFrame) -> DataFrame:
    """Each row with its group's name and year, as the report of a group is
    headed."""
    names = [c for c in groups.columns if c != "event_group_id" and c not in df.columns]
    return df.join(broadcast_if_bounded(groups.select("event_group_id", *names)), "event_group_id", "left")


def with_total(rows: DataFrame, keys: list[str], nullable_keys: tuple[str, ...] = ()) -> DataFrame:
    """The species sums with the row total and flag of the sheet they stand
    in: ``sum_relcover`` and ``relcover_is_100`` repeat on each row of a key."""
    sums = point_sum_long(rows, keys, nullable_keys)
    total = with_ordered_total(sums, keys, "speciescode", "sum_percentcover", "sum_relcover")
    return total.withColumn("relcover_is_100", equals_exactly("sum_relcover", 100.0))


def _group_report(species, markers, sop82_rows, visits, confidence) -> dict[str, DataFrame]:
    checks = conditional_segment(species)
    count = point_count_long(checks, GROUP_POINT_KEYS, nullable_keys=("segment",))
    total = with_total(checks, GROUP_POINT_KEYS, nullable_keys=("segment",))
    abs_cover = abs_cover_long(sop82_rows, extra_keys=["event_group_id"])
    stratum = abs_cover_by_stratum(None, frame=visits)
    distance = distance_summary(visits.select(*DISTANCE_COLUMNS), confidence=confidence,
                                ordered=False)
    return {
        sinks.SHEET_STRATA_CHECK: strata_check(
            None, frame=markers, extra_cols=["event_group_id", "point_id"]),
        sinks.SHEET_POINT_COUNT: count,
        sinks.SHEET_POINT_SUM: total,
        sinks.SHEET_ABS_COVER: abs_cover,
        sinks.SHEET_STRATUM: stratum,
        "SOP8-3-ChartSeries": charts.chart_series(stratum),
        "SOP8-3-Regions": charts.region_list(stratum, keys=["event_group_id"]),
        sinks.SHEET_DISTANCE: distance,
    }


def _source_report(species, markers, sop82_rows, visits, pilot: bool) -> dict[str, DataFrame]:
    """Protocol and Pilot: the reports once over the whole source.  The
    distance summary joins the groups (J5), so it is added for a source that
    has them."""
    keys = PILOT_POINT_KEYS if pilot else POINT_KEYS
    stratum_ids = [c for c in STRATUM_COLUMNS if c != "event_group_id"]
    if pilot:
        sop82_rows = filter_site_codes(sop82_rows)
        visits = filter_site_codes(visits)
        stratum_ids = [c for c in stratum_ids if c != "region"]
    stratum = abs_cover_by_stratum(None, frame=visits, id_columns=stratum_ids)
    if pilot:
        stratum = with_lookup_region(stratum, site_region_lookup(species.sparkSession))
    check_cols = (["start_date", "location_name", "event_type"] + STRATUM_COLS if pilot
                  else STRATA_CHECK_COLUMNS)
    return {
        sinks.SHEET_STRATA_CHECK: strata_check(None, frame=markers, extra_cols=["point_id"],
                                               columns=check_cols),
        sinks.SHEET_POINT_COUNT: point_count_long(species, keys),
        sinks.SHEET_POINT_SUM: with_total(species, keys),
        sinks.SHEET_ABS_COVER: abs_cover_long(sop82_rows),
        sinks.SHEET_STRATUM: stratum,
        # the figure draws the fixed regions only
        "SOP8-3-ChartSeries": charts.chart_series(stratum).where(
            F.col("region").isin(list(charts.FIXED_REGIONS))),
        "SOP8-3-Regions": charts.fixed_region_list(stratum),
    }


# Order of rows inside each written file, as the sheets were sorted
# (O1, O2, O5).
SORT_WITHIN = {
    sinks.SHEET_STRATA_CHECK: ("location_name", "point_id"),
    sinks.SHEET_STRATUM: ("location_name", "start_date", "point_id"),
    "SOP8-3-ChartSeries": ("region", "side_order", "location_name", "start_date",
                           "point_id", "stratum_order"),
}


# Result writes that run at the same time.  Each result is its own Spark
# job; many of their stages have fewer tasks than the cluster has cores (a
# small aggregate, a final coalesced write), so a few jobs side by side keep
# the cores busy.  Spark schedules their tasks; this only submits them.
PARALLEL_WRITES = 4


def write_report(t: SurveyTables, out_dir: str, confidence: float = 0.95,
                 materialize: bool = True, generation: str = "merged",
                 parallel_writes: int = PARALLEL_WRITES,
                 touched: Sequence[str] | None = None) -> dict[str, str]:
    """Build and write every result, then commit them together; returns name
    -> folder of this run.  ``touched`` names the groups ``t`` was restricted
    to (a refresh): they are replaced in every result, also where no row of
    them is left.  The shared frames are written to a scratch folder under the
    checkpoint folder and removed once every result is written (or the job
    fails): they are as large as the species table and no result reads them
    afterwards.  A run that fails removes its own results."""
    spark = t.vegetation.sparkSession
    folder, run = sinks.scratch_folder(spark), sinks.new_run()
    names: list[str] = []
    try:
        results = build_report(t, confidence, materialize, folder, generation)
        names = list(results)

        def write(name: str) -> sinks.Written:
            df = results[name]
            sort_keys = SORT_WITHIN.get(name, ())
            if not sort_keys:
                sort_keys = tuple(c for c in df.columns if c != "event_group_id")[:3]
            return sinks.stage_result(df, out_dir, name, run, sort_within=sort_keys)

        with ThreadPoolExecutor(max_workers=max(1, parallel_writes)) as pool:
            futures = [pool.submit(write, name) for name in names]
        written = [f.result() for f in futures]
        sinks.commit(spark, out_dir, written, touched)
    except BaseException:
        for name in names:
            sinks.remove_folder(spark, f"{out_dir.rstrip('/')}/{name}/{run}")
        raise
    finally:
        if materialize:
            sinks.remove_folder(spark, folder)
    return {w.name: f"{out_dir.rstrip('/')}/{w.folder}" for w in written}
