"""The refresh stream re-runs the report for the groups of new visits only."""

import pytest
from pyspark.sql import functions as F

from plotcover.sources import sinks
from plotcover.sources.fixtures import fixture_tables
from plotcover.sources.tables import read_parquet_tables, write_tables
from plotcover.streaming.refresh import start_refresh_stream


@pytest.mark.parametrize("group_layout", [False, True])
def test_refresh_stream_rewrites_touched_groups(spark, sf_dir, tmp_path, group_layout):
    t = fixture_tables(spark, sf_dir)
    paths = write_tables(t, str(tmp_path / "tables"), group_layout=group_layout)
    landing = str(tmp_path / "landing")
    out = str(tmp_path / "reports")
    # a first campaign's visits land: only its group is reported
    t.events.where(F.col("event_group_id") == "BUILDING").write.mode("append").parquet(landing)
    q = start_refresh_stream(spark, landing, lambda: read_parquet_tables(spark, paths), out,
                             str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(300)
    got = sinks.read_result(spark, out, sinks.SHEET_ABS_COVER)
    assert {r[0] for r in got.select("event_group_id").distinct().collect()} == {"BUILDING"}
    # the batch's ids are normalised as the stored ones are
    assert {r[0] for r in got.select("event_group_id").distinct().collect()} == {"BUILDING"}
    # a second batch with another group adds that group and leaves the first alone
    late = t.events.where(F.col("event_group_id") == "MACHINERY")
    late.withColumn("event_group_id", F.lit("{machinery}")).write.mode("append").parquet(landing)
    q = start_refresh_stream(spark, landing, lambda: read_parquet_tables(spark, paths), out,
                             str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(300)
    got = sinks.read_result(spark, out, sinks.SHEET_ABS_COVER)
    assert {r[0] for r in got.select("event_group_id").distinct().collect()} == {"BUILDING", "MACHINERY"}
    from plotcover.operators import groups
    expected = groups.abs_cover_by_group(t).where("event_group_id in ('BUILDING','MACHINERY')")
    # sums of non-integer products, added in an order that follows the join
    # strategy: equal to 9 digits
    expected = expected.withColumn("abs_cover", F.round("abs_cover", 9))
    got = got.select(*expected.columns).withColumn("abs_cover", F.round("abs_cover", 9))
    assert got.exceptAll(expected).count() == 0
    assert expected.exceptAll(got).count() == 0
