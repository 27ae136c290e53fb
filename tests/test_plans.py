"""Physical plans: no Python in the hot path, dimension tables broadcast,
filters and projections at the scan, one join shuffle of the big tables."""

import pytest

import __spark_entry__ as entry_mod
from plotcover import bounds
from plotcover.operators import cover, frames
from plotcover.sources.fixtures import fixture_tables
from plotcover.sources.tables import read_parquet_tables, write_tables


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(spark, df):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("name", sorted(entry_mod._survey_queries()))
def test_no_python_udf(spark, sf_dir, name):
    plan = _plan(entry_mod._survey_queries()[name](spark, sf_dir))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "FlatMapGroupsInPandas" not in plan and "MapInPandas" not in plan
    # every join is an equi-join: no cross product, no nested-loop join
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_locations_broadcast_and_scan_pruned(spark, sf_dir):
    df = cover.abs_cover_long(cover.point_cover_rows(fixture_tables(spark, sf_dir)))
    plan = _plan(df)
    assert "BroadcastExchange" in plan
    # lineitem is read for five of its columns only
    assert ("ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,"
            "l_quantity:double,l_returnflag:string>") in _formatted(spark, df)


def test_group_filter_reaches_parquet_scan(spark, sf_dir, tmp_path):
    t = fixture_tables(spark, sf_dir)
    tables = read_parquet_tables(spark, write_tables(t, str(tmp_path)))
    df = cover.point_cover_rows(tables, event_group="{automobile}")
    text = _formatted(spark, df)
    # events are partitioned by group: the group filter prunes folders
    assert "PartitionFilters: [isnotnull(event_group_id" in text
    assert "(event_group_id" in text and "= AUTOMOBILE)" in text
    assert "EqualTo(event_type,Marker Visit)" in text
    assert df.count() == cover.point_cover_rows(t, event_group="AUTOMOBILE").count()


def test_bounded_broadcast_refuses_large_tables(spark):
    big = spark.range(1000)
    assert "ResolvedHint" not in big._jdf.queryExecution().analyzed().toString()
    hinted = bounds.broadcast_if_bounded(big, max_rows=10)
    assert "broadcast" not in hinted._jdf.queryExecution().analyzed().toString().lower()
    small = bounds.broadcast_if_bounded(spark.range(5), max_rows=10)
    assert "broadcast" in small._jdf.queryExecution().analyzed().toString().lower()


def test_partition_sizing_grows_with_input():
    from plotcover.session import partition_conf
    small = partition_conf(10 * 1024**2, total_cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"          # two waves minimum
    big = partition_conf(100 * 1024**4, total_cores=8000)         # 100 TB, 1000 x 8 cores
    n = int(big["spark.sql.shuffle.partitions"])
    assert n > 16000 and 100 * 1024**4 * 0.25 / n <= 200 * 1024**2
    assert big["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"


def test_stored_bytes_reads_file_sizes(spark, sf_dir):
    import os
    from plotcover.session import stored_bytes
    path = f"{sf_dir}/nation.parquet"
    want = os.path.getsize(path) if os.path.isfile(path) else sum(
        os.path.getsize(os.path.join(path, f)) for f in os.listdir(path))
    assert stored_bytes(spark, path) == want


def test_bounded_broadcast_recounts_when_files_change(spark, tmp_path):
    from plotcover import bounds
    path = str(tmp_path / "dim")
    spark.range(5).write.parquet(path)
    small = spark.read.parquet(path)
    hinted = bounds.broadcast_if_bounded(small, max_rows=10)
    assert _has_broadcast_hint(hinted)
    spark.range(100, 120).write.mode("append").parquet(path)     # the table grows
    bounds.forget_bounds()                                        # and is loaded again
    grown = spark.read.parquet(path)
    assert not _has_broadcast_hint(bounds.broadcast_if_bounded(grown, max_rows=10))


def _has_broadcast_hint(df):
    return "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()


def test_building_a_query_runs_no_job(spark, sf_dir):
    """Sizes come from footers: nothing runs until the result is asked for
    (the ordered results write their sorted rows first, by design)."""
    sc = spark.sparkContext
    lazy = {n: query for n, query in entry_mod._survey_queries().items() if not n.endswith("_positions")}
    for query in lazy.values():
        query(spark, sf_dir)                  # opens the tables: Spark reads their schemas
    sc.setJobGroup("building", "no job")
    try:
        for name, query in lazy.items():
            bounds.forget_bounds()
            query(spark, sf_dir)
            assert not sc.statusTracker().getJobIdsForGroup("building"), name
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_row_bounds_from_footers(spark, sf_dir, tmp_path, monkeypatch):
    t = fixture_tables(spark, sf_dir)
    n = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet").count() for name in ("customer", "orders", "nation", "region")}
    assert bounds.row_bound(t.events) == bounds.row_bound(t.event_groups) == n["customer"]
    assert bounds.row_bound(t.locations) == n["nation"] * n["region"]
    assert bounds.row_bound(t.events.join(t.locations, "location_id", "left_semi")) == n["customer"]
    assert bounds.row_bound(t.markers.where("point_id < 0")) == n["orders"]
    assert bounds.row_bound(spark.range(7)) == 7
    assert bounds.row_bound(t.events.selectExpr("explode(array(1, 2)) as x")) is None
    assert bounds.row_bound(t.events.union(t.events)) is None
    spark.range(100).repartition(5).write.parquet(str(tmp_path / "many"))
    many = spark.read.parquet(str(tmp_path / "many"))
    assert bounds.row_bound(many) == 100
    monkeypatch.setattr(bounds, "FOOTER_MAX_FILES", 4)
    assert bounds.row_bound(many) is None
    monkeypatch.setattr(bounds, "FOOTER_MAX_FILES", 5)
    monkeypatch.setattr(bounds, "FOOTER_MAX_BYTES", 10)
    assert bounds.row_bound(many) is None


def test_visits_over_the_bound_are_joined_by_shuffle(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(bounds, "BROADCAST_MAX_ROWS", 125)
    t = fixture_tables(spark, sf_dir)
    assert bounds.is_bounded(t.locations) and not bounds.is_bounded(t.events)
    rows = frames.vegetation_frame(t, event_type="Marker Visit")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(point_id" in plan and "hashpartitioning(event_id" in plan
    monkeypatch.undo()
    rows = frames.vegetation_frame(t, event_type="Marker Visit")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(point_id" in plan and "hashpartitioning(event_id" not in plan
