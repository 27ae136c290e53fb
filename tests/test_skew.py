"""Hot keys: one point holds a third of all species rows, one visit a third
of all points, one event group most visits.  AQE's skew thresholds are
lowered so the skewed join partitions really are split at this size; the
results must still equal a brute-force computation of the same reports
(DuckDB, pandas), and the executed plan must show the split."""

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plotcover.operators import groups
from plotcover.schema import COVER_COLS, SCHEMAS
from plotcover.sources.tables import SurveyTables

N_VEG = 60_000
N_POINTS = 2_000
N_EVENTS = 150
N_LOCATIONS = 10

SKEW_CONF = {
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
}


def _pick(labels, idx):
    """Element ``idx`` of a fixed list of labels, as a Column."""
    expr = F.lit(None).cast("string")
    for i, label in enumerate(labels):
        expr = F.when(idx == i, F.lit(label)).otherwise(expr)
    return expr


def _skewed_tables(spark):
    v = F.col("id")
    vegetation = spark.range(N_VEG).select(
        # every third species row belongs to point P0000
        F.when(v % 3 == 0, F.lit("P0000"))
         .otherwise(F.format_string("P%04d", (v % (N_POINTS - 1) + 1).cast("int")))
         .alias("point_id"),
        _pick(["Mangrove", "Marsh", "Upland"], (v / 3).cast("long") % 3).alias("communitytype"),
        _pick(["Tree", "Shrub", "Herb", "Vine"], (v / 7).cast("long") % 4).alias("vegetationtype"),
        F.when(v % 53 == 0, F.lit(None))
         .otherwise(F.format_string("S%02d", (v % 11).cast("int"))).alias("speciescode"),
        F.when(v % 43 == 0, F.lit(None)).when(v % 41 == 0, F.lit("trace"))
         .otherwise((v % 101).cast("string")).alias("percentcover_raw"),
    )
    m = F.col("id")
    covers = {
        "mangroveside_cover_overall": (m * 7 % 21 * 5).cast("double"),
        "mangroveside_cover_tree": F.when(m % 13 != 0, (m % 5 * 10).cast("double")),
        "mangroveside_cover_shrub": F.when(m % 13 != 0, (m % 4 * 15).cast("double")),
        "mangroveside_cover_herb": F.when(m % 13 != 0, (100 - m % 5 * 10 - m % 4 * 15).cast("double")),
        "marshside_cover_overall": (m * 11 % 21 * 5).cast("double"),
        "marshside_cover_tree": (m % 3 * 20).cast("double"),
        "marshside_cover_shrub": F.when(m % 7 != 0, (m % 6 * 5).cast("double")),
        "marshside_cover_herb": (100 - m % 3 * 20 - m % 6 * 5).cast("double"),
    }
    markers = spark.range(N_POINTS).select(
        F.format_string("P%04d", m.cast("int")).alias("point_id"),
        # every third point is a point of visit E000
        F.when(m % 3 == 0, F.lit("E000"))
         .otherwise(F.format_string("E%03d", (m % N_EVENTS).cast("int"))).alias("event_id"),
        F.when(m % 11 != 0, (m % 37 * 1.5)).alias("distance"),
        F.lit("GPS").alias("method"),
        *[covers[c].alias(c) for c in COVER_COLS],
    )
    e = F.col("id")
    events = spark.range(N_EVENTS).select(
        F.format_string("E%03d", e.cast("int")).alias("event_id"),
        F.when(e % 5 == 4, F.format_string("G%d", (e % 2 + 1).cast("int")))
         .otherwise(F.lit("G0")).alias("event_group_id"),
        F.format_string("L%d", (e % N_LOCATIONS).cast("int")).alias("location_id"),
        F.when(e % 10 == 7, F.lit("Segment Visit")).otherwise(F.lit("Marker Visit"))
         .alias("event_type"),
        F.make_date(F.lit(2020), (e % 12 + 1).cast("int"), F.lit(1)).alias("start_date"),
    )
    k = F.col("id")
    locations = spark.range(N_LOCATIONS).select(
        F.format_string("L%d", k.cast("int")).alias("location_id"),
        F.format_string("R%d", (k % 3).cast("int")).alias("region"),
        F.when(k != 9, F.format_string("Segment %d", (k % 4 + 1).cast("int"))).alias("segment"),
        F.format_string("%02d_%d", (k / 4 + 1).cast("int"), (k % 4 + 1).cast("int"))
         .alias("location_name"),
    )
    import datetime as dt
    event_groups = spark.createDataFrame(
        [("G0", "Segment 2020", dt.date(2020, 1, 1), None, None),
         ("G1", "Index 2021", dt.date(2021, 1, 1), None, None),
         ("G2", "Index 2022", dt.date(2022, 1, 1), None, None)], SCHEMAS["event_groups"])

    def typed(df, name):
        return df.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMAS[name].fields])

    return SurveyTables(
        locations=typed(locations, "locations"), events=typed(events, "events"),
        markers=typed(markers, "markers"), vegetation=typed(vegetation, "vegetation"),
        event_groups=event_groups)


@pytest.fixture(scope="module")
def skewed(spark):
    # At this size points and visits would be broadcast (no shuffle, so no
    # skew to split); a lower bound sends them down the shuffle-join path a
    # large survey takes.
    from plotcover import bounds
    saved = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    saved_bound = bounds.BROADCAST_MAX_ROWS
    bounds.BROADCAST_MAX_ROWS = 100
    yield _skewed_tables(spark)
    bounds.BROADCAST_MAX_ROWS = saved_bound
    for k, v in saved.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _pandas_frame(t):
    """The species frame, brute force in pandas: every join written out."""
    veg = t.vegetation.toPandas()
    mk = t.markers.toPandas()
    ev = t.events.toPandas()
    loc = t.locations.toPandas()
    eg = t.event_groups.toPandas()
    out = (veg.merge(mk, on="point_id").merge(ev, on="event_id")
           .merge(loc, on="location_id").merge(eg.drop(columns="start_date"), on="event_group_id"))
    out["percentcover"] = pd.to_numeric(out["percentcover_raw"], errors="coerce")
    return out


def _executed_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_inputs_are_skewed(skewed):
    n_hot = skewed.vegetation.where(F.col("point_id") == "P0000").count()
    assert n_hot == N_VEG // 3
    assert skewed.markers.where(F.col("event_id") == "E000").count() == N_POINTS // 3 + 1


def test_abs_cover_by_group_under_skew_split(skewed):
    df = groups.abs_cover_by_group(skewed)
    got = df.toPandas()
    assert "skew=true" in _executed_plan(df)

    keys = ["event_group_id", "communitytype", "vegetationtype", "speciescode", "location_name"]
    con = duckdb.connect()
    for name in ("vegetation", "markers", "events", "locations"):
        con.register(name, getattr(skewed, name).toArrow())
    want = con.execute(f"""
with cells as (
  select v.*, e.event_group_id, l.location_name, try_cast(v.percentcover_raw as double) as percent,
    (case communitytype when 'Mangrove' then mangroveside_cover_overall
                        when 'Marsh' then marshside_cover_overall end) as overall,
    (case communitytype || vegetationtype
       when 'MangroveTree' then mangroveside_cover_tree when 'MarshTree' then marshside_cover_tree
       when 'MangroveShrub' then mangroveside_cover_shrub when 'MarshShrub' then marshside_cover_shrub
       when 'MangroveHerb' then mangroveside_cover_herb when 'MarshHerb' then marshside_cover_herb end) as layer
  from vegetation v join markers using (point_id) join events e using (event_id)
    join locations l using (location_id)
  where event_type = 'Marker Visit' and percentcover_raw is not null)
select {', '.join(keys)}, coalesce(sum(overall * layer * percent), 0) / 10000 as abs_cover
from cells where speciescode is not null group by all""").df()

    got = got.sort_values(keys).reset_index(drop=True)
    want = want.sort_values(keys).reset_index(drop=True)
    assert len(got) == len(want)
    assert got[keys].equals(want[keys])
    np.testing.assert_allclose(got["abs_cover"].to_numpy(float), want["abs_cover"].to_numpy(float),
                               rtol=1e-12, atol=1e-9)


def test_point_sum_by_group_under_skew_split(skewed):
    df = groups.point_sum_by_group(skewed)
    got = df.toPandas()
    assert "skew=true" in _executed_plan(df)

    frame = _pandas_frame(skewed)
    by_segment = frame.event_group_name.str.contains("Segment")
    frame = frame[~by_segment | frame.segment.notna()].copy()
    frame.loc[~by_segment, "segment"] = "<none>"
    keys = ["event_group_id", "region", "segment", "location_name", "communitytype",
            "vegetationtype", "event_type", "speciescode"]
    want = frame.groupby(keys, dropna=True)["percentcover"].sum(min_count=0).reset_index()
    want["segment"] = want["segment"].replace("<none>", None)

    got = got.rename(columns={"sum_percentcover": "percentcover"})
    got["segment"] = got["segment"].astype(object)
    order = [k for k in keys]
    got = got.sort_values(order, na_position="first").reset_index(drop=True)
    want = want.sort_values(order, na_position="first").reset_index(drop=True)
    assert len(got) == len(want)
    for k in keys:
        assert got[k].where(got[k].notna(), None).tolist() == \
            want[k].where(want[k].notna(), None).tolist(), k
    np.testing.assert_allclose(got["percentcover"].to_numpy(float),
                               want["percentcover"].to_numpy(float), rtol=1e-12)
