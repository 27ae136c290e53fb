"""The all-groups report plan and its sinks."""

from plotcover.plans.report import build_report, write_report
from plotcover.sources import sinks
from plotcover.sources.fixtures import fixture_tables
from plotcover.operators import groups


def test_report_writes_every_result_partitioned_by_group(spark, sf_dir, tmp_path):
    t = fixture_tables(spark, sf_dir)
    paths = write_report(t, str(tmp_path / "out"))
    assert set(paths) >= {sinks.SHEET_STRATA_CHECK, sinks.SHEET_POINT_COUNT, sinks.SHEET_POINT_SUM,
                          sinks.SHEET_ABS_COVER, sinks.SHEET_STRATUM, sinks.SHEET_DISTANCE}
    back = sinks.read_result(spark, str(tmp_path / "out"), sinks.SHEET_ABS_COVER)
    assert "event_group_id" in back.columns
    groups_written = {r[0] for r in back.select("event_group_id").distinct().collect()}
    assert groups_written == {r[0] for r in t.event_groups.select("event_group_id").collect()}
    # one group's folder prunes to that group
    one = back.where("event_group_id = 'AUTOMOBILE'")
    assert one.count() == groups.abs_cover_by_group(t).where("event_group_id = 'AUTOMOBILE'").count()


def test_report_matches_single_queries(spark, sf_dir):
    t = fixture_tables(spark, sf_dir)
    results = build_report(t)
    sums = groups.point_sum_by_group(t)
    assert _same_rows(results[sinks.SHEET_POINT_SUM].select(*sums.columns), sums)
    flags = groups.relcover_by_group(t)
    assert _same_rows(results[sinks.SHEET_POINT_SUM].select(*flags.columns).distinct(), flags)
    years = {r.event_group_id: (r.event_group_name, r.event_group_year)
             for r in results[sinks.SHEET_EVENT_GROUPS].collect()}
    for name, df in results.items():
        labels = df.select("event_group_id", "event_group_name", "event_group_year").distinct().collect()
        assert labels and all(years[r[0]] == (r[1], r[2]) for r in labels), name
    assert results[sinks.SHEET_ABS_COVER].count() == groups.abs_cover_by_group(t).count()


def test_report_removes_its_shared_frames(spark, sf_dir, tmp_path):
    import os
    from plotcover.session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(spark).replace("file:", "")
    before = set(os.listdir(root))
    write_report(fixture_tables(spark, sf_dir), str(tmp_path / "out"))
    assert set(os.listdir(root)) == before
    assert sinks.read_result(spark, str(tmp_path / "out"), sinks.SHEET_POINT_SUM).count() > 0


def _rounded(df, col="abs_cover"):
    from pyspark.sql import functions as F
    return df.withColumn(col, F.round(col, 9))


def _same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_protocol_report_without_groups(spark, sf_dir):
    from plotcover.operators import checks, cover
    t = fixture_tables(spark, sf_dir).with_(event_groups=None)
    results = build_report(t, generation="protocol")
    assert sinks.SHEET_DISTANCE not in results
    assert "event_group_id" not in results[sinks.SHEET_ABS_COVER].columns
    sums = checks.point_sum_long(checks.point_rows(t))
    assert _same_rows(results[sinks.SHEET_POINT_SUM].select(*sums.columns), sums)
    # sums of non-integer products: the order of addition follows the join
    # strategy, so compare to 9 digits
    assert _same_rows(_rounded(results[sinks.SHEET_ABS_COVER]),
                      _rounded(cover.abs_cover_long(cover.point_cover_rows(t))))
    assert results[sinks.SHEET_STRATUM].count() == cover.abs_cover_by_stratum(t).count()


def test_pilot_report_keys_sites_and_lookup_region(spark, sf_dir, tmp_path):
    from pyspark.sql import functions as F
    from plotcover.operators import checks, cover, frames
    from plotcover.sources.lookup import site_region_lookup
    base = fixture_tables(spark, sf_dir)
    geo = base.locations.select(F.col("location_id").alias("GlobalID"),
                                F.col("location_name").alias("Loc_Name_Short"))
    t = base.with_(locations=frames.locations_from_pilot(geo), event_groups=None)
    results = build_report(t, generation="pilot")
    rows = checks.point_rows(t)
    sums = checks.point_sum_long(rows, checks.PILOT_POINT_KEYS)
    assert _same_rows(results[sinks.SHEET_POINT_SUM].select(*sums.columns), sums)
    assert _same_rows(_rounded(results[sinks.SHEET_ABS_COVER]), _rounded(
        cover.abs_cover_long(frames.filter_site_codes(cover.point_cover_rows(t)))))
    stratum = results[sinks.SHEET_STRATUM]
    assert stratum.count() > 0
    lookup_regions = {r[0] for r in site_region_lookup(spark).select("region").collect()}
    assert {r[0] for r in stratum.select("region").distinct().collect()} <= lookup_regions
    assert stratum.where(F.col("region").isNull()).count() == 0
    from plotcover.operators import charts
    regions = results["SOP8-3-Regions"].orderBy("region_order").collect()
    assert [r.region for r in regions] == list(charts.FIXED_REGIONS)
    series = results["SOP8-3-ChartSeries"]
    assert series.count() > 0
    assert {r[0] for r in series.select("region").distinct().collect()} <= set(charts.FIXED_REGIONS)
    paths = write_report(t, str(tmp_path / "pilot"), generation="pilot")
    assert sinks.read_result(spark, str(tmp_path / "pilot"), sinks.SHEET_STRATUM).count() \
        == stratum.count()
    assert sinks.SHEET_DISTANCE not in paths


def test_report_when_visits_are_too_many_to_broadcast(spark, sf_dir, monkeypatch):
    from plotcover.plans import report
    from plotcover.operators import cover, frames
    monkeypatch.setattr(frames, "is_bounded", lambda df, *a, **k: False)
    t = fixture_tables(spark, sf_dir)
    species, markers = report.shared_frames(t)
    assert "broadcast" not in markers._jdf.queryExecution().analyzed().toString().lower()
    results = build_report(t)
    sums = groups.point_sum_by_group(t)
    assert _same_rows(results[sinks.SHEET_POINT_SUM].select(*sums.columns), sums)
    stratum = cover.abs_cover_by_stratum(t)
    assert _same_rows(results[sinks.SHEET_STRATUM].select(*stratum.columns), stratum)


def test_wide_tables_are_lazy_and_leave_nothing(spark, sf_dir):
    import os
    import __spark_entry__ as entry_mod
    from plotcover.session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(spark).replace("file:", "")
    before = set(os.listdir(root))
    for name in ("point_count_wide", "point_sum_wide", "abs_cover_wide", "abs_cover_site_order"):
        assert entry_mod._survey_queries()[name](spark, sf_dir).count() > 0
    assert set(os.listdir(root)) == before


def test_protocol_report_with_groups_has_distances(spark, sf_dir):
    from plotcover.operators import distance
    t = fixture_tables(spark, sf_dir)
    results = build_report(t, generation="protocol")
    want = distance.distance_summary(distance.distance_rows(t), ordered=False)
    assert _same_rows(results[sinks.SHEET_DISTANCE].select("event_group_id", "segment", "rec_count"),
                      want.select("event_group_id", "segment", "rec_count"))


def test_full_write_replaces_and_refresh_keeps_other_groups(spark, tmp_path):
    def rows(*pairs):
        return spark.createDataFrame(pairs, "event_group_id string, v int")

    def stored():
        return {(r.event_group_id, r.v) for r in sinks.read_result(spark, out, "x").collect()}

    out = str(tmp_path)
    sinks.write_result(rows(("001", 1), ("01", 2), ("B", 3)), out, "x")
    assert stored() == {("001", 1), ("01", 2), ("B", 3)}
    sinks.write_result(rows(("001", 5)), out, "x", touched=["001"])
    assert stored() == {("001", 5), ("01", 2), ("B", 3)}
    sinks.write_result(rows(), out, "x", touched=["01"])              # nothing is left of a group
    assert stored() == {("001", 5), ("B", 3)}
    sinks.write_result(rows(("a b/c=%", 7), (None, 8)), out, "x", touched=["a b/c=%", None])
    assert stored() == {("001", 5), ("B", 3), ("a b/c=%", 7), (None, 8)}
    sinks.write_result(rows(("a b/c=%", 9)), out, "x", touched=["a b/c=%", None])
    assert stored() == {("001", 5), ("B", 3), ("a b/c=%", 9)}
    sinks.write_result(rows(("001", 1)), out, "x")
    assert stored() == {("001", 1)}


def test_a_group_is_few_files(spark, tmp_path):
    import glob
    many = spark.range(0, 20_000, 1, 64).selectExpr("concat('G', id % 5) as event_group_id", "id")
    sinks.write_result(many, str(tmp_path), "x")
    assert len(glob.glob(f"{tmp_path}/x/run-*/*/*.parquet")) <= 10


def test_a_killed_run_leaves_the_old_result(spark, tmp_path):
    out = str(tmp_path)
    first = spark.createDataFrame([("A", 1)], "event_group_id string, v int")
    sinks.write_result(first, out, "x")
    # written but never committed: what a killed job leaves
    sinks.stage_result(first.selectExpr("event_group_id", "v + 1 as v"), out, "x", sinks.new_run())
    assert [tuple(r) for r in sinks.read_result(spark, out, "x").collect()] == [("A", 1)]
    held = sinks.read_result(spark, out, "x")
    sinks.write_result(first.selectExpr("event_group_id", "v + 2 as v"), out, "x")
    assert [tuple(r) for r in held.collect()] == [("A", 1)]          # a reader goes on
    assert len(sinks.remove_stale(spark, out)) == 3                  # two folders, one manifest
    assert [tuple(r) for r in sinks.read_result(spark, out, "x").collect()] == [("A", 3)]
    sinks.write_result(first.limit(0), out, "empty")
    assert sinks.read_result(spark, out, "empty").columns == ["event_group_id", "v"]


def test_a_failing_report_removes_its_folders(spark, sf_dir, tmp_path, monkeypatch):
    import os
    import pytest
    t = fixture_tables(spark, sf_dir)

    def broken(*a, **k):
        raise RuntimeError("no commit")

    monkeypatch.setattr(sinks, "commit", broken)
    with pytest.raises(RuntimeError):
        write_report(t, str(tmp_path))
    assert all(not os.listdir(tmp_path / name) for name in os.listdir(tmp_path))


def test_a_refreshed_group_without_marker_visits_loses_its_rows(spark, sf_dir, tmp_path):
    from pyspark.sql import functions as F
    from plotcover.streaming.refresh import restrict_to_groups
    t, out = fixture_tables(spark, sf_dir), str(tmp_path)
    write_report(t, out)
    before = sinks.read_result(spark, out, sinks.SHEET_ABS_COVER)
    others = before.where("event_group_id <> 'BUILDING'").count()
    assert before.count() > others
    # the group's visits are no longer marker visits
    changed = t.with_(events=t.events.withColumn("event_type", F.when(
        F.col("event_group_id") == "BUILDING", "Segment Visit").otherwise(F.col("event_type"))))
    one = spark.createDataFrame([("BUILDING",)], "event_group_id string")
    write_report(restrict_to_groups(changed, one), out, touched=["BUILDING"])
    after = sinks.read_result(spark, out, sinks.SHEET_ABS_COVER)
    assert after.count() == others and after.where("event_group_id = 'BUILDING'").count() == 0
    # its checks cover every visit type and are still there
    assert sinks.read_result(spark, out, sinks.SHEET_STRATA_CHECK).where("event_group_id = 'BUILDING'").count() > 0
