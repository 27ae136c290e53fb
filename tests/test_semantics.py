"""Missing-value and coercion rules on small hand-made frames (SURVEY §1,
N1-N7, D2, D6, D7, D9, F6, F10), with pandas as the brute-force reference
where pandas defines the behaviour."""

import math
import random
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plotcover.functions.cover import absolute_cover, equals_exactly, row_sum, to_number
from plotcover.functions.exact import exact_sum
from plotcover.functions.text import normalise_id, segment_number, site_point, site_segment
from plotcover.operators import charts, checks, cover, distance, frames, groups, pivots
from plotcover.schema import COVER_COLS, SCHEMAS
from plotcover.sources.lookup import site_region_lookup
from plotcover.sources.tables import SurveyTables


def _none(v):
    return None if v is None or (isinstance(v, float) and math.isnan(v)) else v


# ---------------------------------------------------------------- E3 / D9

COERCION_CASES = [" 2 ", "1e2", "+3", "inf", "-inf", "Inf", "INF", "Infinity", "-Infinity",
                  "nan", "NaN", "1.5d", "", "abc", "1,000", "5%", "0x1A", ".5", "5.",
                  "-.5e-3", "1E5", " +1.0e+2 ", "1_000", "\t7\n", "1e", "e5", "+", "-",
                  "++1", "1.2.3", "0005", "-0", "1e400", "  ", None, "trace", "12"]


def _pandas_number(values):
    out = pd.to_numeric(pd.Series(values, dtype=object), errors="coerce")
    return [_none(float(v)) if v is not None else None for v in out.tolist()]


def _spark_number(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, raw string")
    rows = df.select("i", to_number("raw").alias("n")).orderBy("i").collect()
    return [r["n"] for r in rows]


def test_coercion_matches_pandas_on_known_cases(spark):
    assert _spark_number(spark, COERCION_CASES) == _pandas_number(COERCION_CASES)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=" +-.eE0123456789infatyIN\t", max_size=8), min_size=1, max_size=30))
def test_coercion_matches_pandas_on_generated_text(spark, values):
    assert _spark_number(spark, values) == _pandas_number(values)


def test_coercion_of_numeric_column_maps_nan_to_null(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "x double")
    got = [r[0] for r in df.select(to_number("x", df.schema["x"].dataType)).collect()]
    assert got == [1.5, None, None]


# ---------------------------------------------------------------- N1 N2 D7

def test_row_sum_skips_missing_and_all_missing_is_zero(spark):
    df = spark.createDataFrame([(1.0, None, 2.0), (None, None, None), (50.0, 25.0, 25.0)],
                               "a double, b double, c double")
    got = df.select(row_sum("a", "b", "c").alias("s"),
                    equals_exactly(row_sum("a", "b", "c"), 100.0).alias("f")).collect()
    assert [(r.s, r.f) for r in got] == [(3.0, False), (0.0, False), (100.0, True)]


def test_exact_equality_is_exact(spark):
    # 6.9 + 29.2 + 39.2 + 24.7 is 100.00000000000001 left to right
    df = spark.createDataFrame([(6.9, 29.2, 39.2, 24.7)], "a double, b double, c double, d double")
    r = df.select(row_sum("a", "b", "c", "d").alias("s")).first()
    assert r.s == 6.9 + 29.2 + 39.2 + 24.7
    assert df.select(equals_exactly(row_sum("a", "b", "c", "d"), 100.0)).first()[0] is False
    assert df.select(equals_exactly(F.lit(None).cast("double"), 100.0)).first()[0] is False


# ---------------------------------------------------------------- E2 / D6

def _cover_row(ct, vt, pc):
    return (ct, vt, pc, 80.0, 50.0, 30.0, 20.0, 60.0, 10.0, 40.0, 50.0)


def _cover_by_rule(row):
    """The per-row rule written out in plain Python."""
    ct, vt, pc = row[:3]
    cols = dict(zip(["mo", "mt", "ms", "mh", "so", "st", "ss", "sh"], row[3:]))
    side = {"Mangrove": "m", "Marsh": "s"}.get(ct)
    layer = {"Tree": "t", "Shrub": "s", "Herb": "h", "Overall": "o"}.get(vt)
    if side is None or layer is None or pc is None:
        return None
    return cols[side + "o"] * (cols[side + layer] / 100) * (pc / 100)


def test_absolute_cover_rule(spark):
    rows = [_cover_row(ct, vt, pc) for ct in ("Mangrove", "Marsh", "Upland", None, "marsh")
            for vt in ("Tree", "Shrub", "Herb", "Overall", "Vine", None, "tree")
            for pc in (40.0, None)]
    df = spark.createDataFrame(rows, "communitytype string, vegetationtype string, "
                                     "percentcover double, " + ", ".join(f"{c} double" for c in COVER_COLS))
    got = [r[0] for r in df.select(absolute_cover()).collect()]
    assert got == [_cover_by_rule(r) for r in rows]


# ---------------------------------------------------------------- pivots N3-N5

PIVOT_ROWS = [
    # key1, key2, col, value
    ("a", "x", "s1", 10.0), ("a", "x", "s1", 5.0), ("a", "x", "s2", None),
    ("a", "y", "s2", 7.0), ("b", "x", "s3", None), ("b", "x", None, 3.0),
    (None, "x", "s1", 1.0), ("b", None, "s1", 2.0), ("c", "z", "s1", 100.0),
]


def _pandas_pivot(agg):
    pdf = pd.DataFrame(PIVOT_ROWS, columns=["k1", "k2", "col", "v"])
    return pdf.pivot_table(index=["k1", "k2"], columns="col", values="v", aggfunc=agg)


@pytest.mark.parametrize("agg", ["sum", "count"])
def test_wide_pivot_matches_pandas(spark, agg):
    df = spark.createDataFrame(PIVOT_ROWS, "k1 string, k2 string, col string, v double")
    expected = _pandas_pivot(agg)
    wide = pivots.pandas_pivot(df, ["k1", "k2"], "col", "v", list(expected.columns), agg)
    wide = wide.toPandas().set_index(["k1", "k2"])
    assert list(wide.columns) == list(expected.columns)
    assert list(wide.index) == list(expected.index)
    for c in expected.columns:
        for idx in expected.index:
            e, g = expected.loc[idx, c], wide.loc[idx, c]
            if pd.isna(e):
                assert pd.isna(g), (idx, c)
            else:
                assert float(g) == float(e), (idx, c)


def test_long_pivot_keeps_zero_and_drops_missing_keys(spark):
    df = spark.createDataFrame(PIVOT_ROWS, "k1 string, k2 string, col string, v double")
    got = {(r.k1, r.k2, r.col): r.sum_v for r in pivots.long_pivot(df, ["k1", "k2"], "col", "v").collect()}
    assert got[("a", "x", "s2")] == 0.0          # N4: all missing -> 0.0
    assert got[("b", "x", "s3")] == 0.0
    assert ("a", "y", "s1") not in got           # absent combination: no row
    assert all(None not in k for k in got)       # N3


def test_wide_pivot_takes_any_number_of_values_and_rejects_others(spark):
    rows = spark.createDataFrame([("k", "c7", 1.0), ("k", "c10000", 2.0)], "k string, c string, v double")
    names = [f"c{i}" for i in range(10_001)]
    wide = pivots.wide_pivot(rows, ["k"], "c", "v", names)
    assert len(wide.columns) == 10_002
    assert wide.select("c7", "c10000", "c5").first()[:] == (1.0, 2.0, None)
    with pytest.raises(Exception, match="outside the wide table"):
        pivots.wide_pivot(rows, ["k"], "c", "v", ["c7"]).collect()


def test_site_order_of_pivot_columns():
    names = ["10_1", "02_2", "2_1", "01_4", "x", "01_10"]
    assert pivots.site_order(names) == ["01_4", "01_10", "2_1", "02_2", "10_1", "x"]


# ---------------------------------------------------------------- survey frames

def _tables(spark, locations, events, markers, vegetation, event_groups=None):
    def frame(name, rows):
        return spark.createDataFrame(rows, SCHEMAS[name])
    return SurveyTables(
        locations=frame("locations", locations), events=frame("events", events),
        markers=frame("markers", markers), vegetation=frame("vegetation", vegetation),
        event_groups=frame("event_groups", event_groups) if event_groups else None)


def _marker(pid, eid, dist, covers=(80.0, 50.0, 30.0, 20.0, 60.0, 10.0, 40.0, 50.0)):
    return (pid, eid, dist, "GPS") + tuple(covers)


@pytest.fixture(scope="module")
def small(spark):
    import datetime as dt
    d = dt.date(2020, 5, 1)
    locations = [("L1", "North", "Segment 1", "01_1"), ("L2", "North", None, "01_2"),
                 ("L3", "South", "Seg 12b", "03_1")]
    groups_ = [("G1", "Segment 2020", d, d, "first"), ("G2", "Index 2021", d, None, None)]
    events = [("E1", "G1", "L1", "Marker Visit", d), ("E2", "G1", "L2", "Marker Visit", d),
              ("E3", "G2", "L2", "Marker Visit", d), ("E4", "G2", "L3", "Segment Visit", d),
              ("E5", "G2", "L3", "Marker Visit", d)]
    markers = [_marker("P1", "E1", 1.0), _marker("P2", "E1", 3.0), _marker("P3", "E2", 5.0),
               _marker("P4", "E3", None), _marker("P5", "E4", 2.0), _marker("P6", "E5", 4.0),
               _marker("P7", "E5", None)]
    veg = [("P1", "Mangrove", "Tree", "S1", "60"), ("P1", "Mangrove", "Tree", "S2", "40"),
           ("P2", "Marsh", "Herb", "S1", "trace"), ("P3", "Marsh", "Herb", "S1", "100"),
           ("P4", "Mangrove", "Shrub", None, "20"), ("P4", "Mangrove", "Shrub", "S3", "80"),
           ("P5", "Marsh", "Tree", "S2", "50"), ("P6", "Mangrove", "Overall", "S1", "10"),
           ("P7", "Marsh", "Herb", "S2", None)]
    return _tables(spark, locations, events, markers, veg, groups_)


def test_conditional_segment_key(small):
    got = {(r.event_group_id, r.location_name, r.segment)
           for r in groups.point_sum_by_group(small).collect()}
    # G1 is a 'Segment' group: L2 has no segment and leaves the report
    assert ("G1", "01_2", None) not in got
    assert ("G1", "01_1", "Segment 1") in got
    # G2 is not: segment is not a key, rows stay with segment NULL
    assert ("G2", "01_2", None) in got
    assert all(seg is None for g, _, seg in got if g == "G2")


def test_sop82_filters_and_order_of_steps(small):
    rows = cover.point_cover_rows(small)
    long_ = {(r.communitytype, r.vegetationtype, r.speciescode, r.location_name): r.abs_cover
             for r in cover.abs_cover_long(rows).collect()}
    # 'trace' passes the missing-value filter, then reads as missing: 0.0
    assert long_[("Marsh", "Herb", "S1", "01_1")] == 0.0
    # Segment visits are not marker visits (F2); a missing raw cover is dropped
    assert ("Marsh", "Tree", "S2", "03_1") not in long_
    assert ("Marsh", "Herb", "S2", "03_1") not in long_
    # 'Overall' layer picks the side's overall cover (D6): 80 * 0.8 * 0.1
    assert long_[("Mangrove", "Overall", "S1", "03_1")] == pytest.approx(80 * 0.8 * 0.1)
    assert long_[("Mangrove", "Tree", "S1", "01_1")] == pytest.approx(80 * 0.5 * 0.6)


def test_event_group_filter_normalises_ids(spark, small):
    t = small.with_(events=small.events.withColumn("event_group_id", normalise_id("event_group_id")))
    a = cover.point_cover_rows(t, event_group="{g1}").count()
    b = cover.point_cover_rows(t, event_group="G1").count()
    assert a == b == 4
    df = spark.createDataFrame([("{ab-1c}",), ("AB-1C",), ("ab-1c",)], "x string")
    assert {r[0] for r in df.select(normalise_id("x")).collect()} == {"AB-1C"}


def test_within_stratum_check(small):
    got = {(r.location_name, r.communitytype, r.vegetationtype): (r.sum_relcover, r.relcover_is_100)
           for r in checks.relcover_check(checks.point_rows(small)).collect()}
    assert got[("01_1", "Mangrove", "Tree")] == (100.0, True)
    assert got[("01_1", "Marsh", "Herb")] == (0.0, False)     # only 'trace'
    assert ("01_2", "Marsh", "Herb") not in got              # L2 has no segment (N3)


def test_strata_check_sums(small):
    r = {x.location_name: x for x in checks.strata_check(small).collect()}["01_1"]
    assert (r.sum_mangrove, r.sum_marsh) == (100.0, 100.0)
    assert r.mangrove_is_100 and r.marsh_is_100


# ---------------------------------------------------------------- distance

def test_distance_summary_by_hand(small):
    got = distance.distance_summary(distance.distance_rows(small)).collect()
    # Segment 1 of G1 holds 1 m and 3 m: mean 2, standard deviation sqrt(2),
    # standard error 1.  Seg 12b of G2 holds 4 m and a missing one.  L2 has no
    # segment.  Sorted by the segment's number, missing last.
    assert [(r.event_group_id, r.segment, r.rec_count, r.average_dist_m, r.min_difference,
             r.max_difference) for r in got] == [
        ("G1", "Segment 1", 2, 2.0, 1.0, 3.0), ("G2", "Seg 12b", 1, 4.0, 4.0, 4.0)]
    assert got[0].standard_error == pytest.approx(1.0)
    assert got[1].standard_error is None and got[1].lower_ci_95 is None


def test_confidence_names_the_limits(small):
    rows = distance.distance_rows(small)
    assert {"lower_ci_90", "upper_ci_90"} <= set(distance.distance_summary(rows, confidence=0.9).columns)
    assert {"group_end_date", "assessment"} <= set(rows.columns)


def test_nan_is_missing_after_the_read(spark, small):
    from plotcover.sources.tables import normalise_table
    nan = float("nan")
    rows = [r[:] for r in small.markers.collect()]
    rows = [r[:2] + (nan if r[0] == "P2" else r[2],) + r[3:5] + (nan if r[0] == "P2" else r[5],) + r[6:]
            for r in rows]
    t = small.with_(markers=normalise_table(spark.createDataFrame(rows, SCHEMAS["markers"]), "markers"))
    first = distance.distance_summary(distance.distance_rows(t)).collect()[0]
    assert (first.rec_count, first.average_dist_m) == (1, 1.0)
    sums = {r.point_id: r.sum_mangrove for r in checks.strata_check(t, extra_cols=["point_id"]).collect()}
    assert sums["P1"] == 100.0 and sums["P2"] == 50.0


def test_infinite_cover_on_an_empty_layer_is_missing(spark):
    rows = [_cover_row("Mangrove", "Tree", math.inf)[:4] + (0.0,) + _cover_row("", "", 0)[5:]]
    df = spark.createDataFrame(rows, "communitytype string, vegetationtype string, "
                                     "percentcover double, " + ", ".join(f"{c} double" for c in COVER_COLS))
    assert df.select(absolute_cover()).first()[0] is None


def test_counts_take_what_was_recorded(spark, small):
    got = {(r.location_name, r.speciescode): r.n_percentcover
           for r in checks.point_count_long(checks.point_rows(small)).collect()}
    assert got[("01_1", "S1")] == 1 and ("03_1", "S2") in got
    marsh = checks.point_count_long(checks.point_rows(small)).where(
        "location_name = '01_1' and communitytype = 'Marsh'").first()
    assert marsh.n_percentcover == 1          # 'trace' is a recorded cover


def test_sem_null_for_one_or_no_distance(spark):
    df = spark.createDataFrame([("g", "r", "s1", 2.0), ("g", "r", "s2", None),
                                ("g", "r", "s3", 1.0), ("g", "r", "s3", 3.0)],
                               "event_group_id string, region string, segment string, distance double")
    got = {r.segment: r for r in distance.distance_summary(df).collect()}
    assert got["s1"].standard_error is None and got["s1"].upper_ci_95 is None
    assert got["s2"].rec_count == 0 and got["s2"].average_dist_m is None
    # n = 2: mean 2, sd sqrt(2), sem 1, t(1) = 12.7062...
    assert got["s3"].standard_error == pytest.approx(1.0)
    assert got["s3"].upper_ci_95 == pytest.approx(2.0 + 12.706204736174698)


def test_segment_number(spark):
    df = spark.createDataFrame([("Segment 12",), ("S3b7",), ("none",), (None,), ("007",)], "segment string")
    assert [r[0] for r in df.select(segment_number("segment")).collect()] == [12, 3, None, None, 7]


# ---------------------------------------------------------------- S3 / J6 / D2

def test_site_region_lookup(spark):
    rows = site_region_lookup(spark).collect()
    assert len(rows) == 56
    counts = pd.Series([r.region for r in rows]).value_counts().to_dict()
    assert counts == {"Turner River": 20, "Taylor Slough": 20, "Shark Slough": 16}
    names = [r.location_name for r in rows]
    assert names[:5] == ["01-01", "01-02", "01-03", "01-04", "02-01"] and names[-1] == "14-04"
    by_name = {r.location_name: r.region for r in rows}
    assert by_name["05-04"] == "Turner River" and by_name["06-01"] == "Shark Slough"
    assert by_name["09-04"] == "Shark Slough" and by_name["10-01"] == "Taylor Slough"


def test_lookup_join_matches_codes_by_number(spark):
    rows = spark.createDataFrame([("01_1", 1), ("6_2", 2), ("10-04", 3), ("15_1", 4), ("x", 5)],
                                 "location_name string, v int")
    got = {r.v: r.region for r in frames.with_lookup_region(rows, site_region_lookup(spark)).collect()}
    assert got == {1: "Turner River", 2: "Shark Slough", 3: "Taylor Slough"}


def test_site_code_parts(spark):
    df = spark.createDataFrame([("01_1",), ("12-04",), ("x_1",)], "c string")
    got = [(r[0], r[1]) for r in df.select(site_segment("c"), site_point("c")).collect()]
    assert got == [(1, 1), (12, 4), (None, None)]


# ---------------------------------------------------------------- C1 / F9

def test_chart_series_and_regions(small):
    stratum = cover.abs_cover_by_stratum(small)
    series = charts.chart_series(stratum).collect()
    assert len(series) == 6 * stratum.count()
    one = [r for r in series if r.point_id == "P1"]
    assert [(r.side, r.stratum) for r in sorted(one, key=lambda r: (r.side_order, r.stratum_order))] == [
        ("Marsh", "Tree"), ("Marsh", "Shrub"), ("Marsh", "Herb"),
        ("Mangrove", "Tree"), ("Mangrove", "Shrub"), ("Mangrove", "Herb")]
    regions = [r.region for r in charts.region_list(stratum).orderBy("region_order").collect()]
    assert regions == ["North", "South"]


# ---------------------------------------------------------------- D7: totals free of order

POINT_SCHEMA = ("location_name string, communitytype string, vegetationtype string, event_type string, "
                "region string, segment string, speciescode string, percentcover double")


def _cover_rows(pairs):
    return [("L", "Marsh", "Herb", "Marker Visit", "r", "s", sp, v) for sp, v in pairs]


def test_totals_do_not_depend_on_row_order(spark):
    one = [("a", v) for v in (6.9, 29.2, 39.2, 24.7)]        # one species: exactly 100
    four = list(zip("abcd", (6.9, 29.2, 39.2, 24.7)))        # added in species order: not 100
    for pairs, total in ((one, 100.0), (four, 6.9 + 29.2 + 39.2 + 24.7)):
        for order in ((0, 1, 2, 3), (3, 1, 0, 2), (2, 3, 1, 0)):
            rows = spark.createDataFrame(_cover_rows([pairs[i] for i in order]), POINT_SCHEMA).repartition(3)
            plain = checks.relcover_check(rows).first()
            wide = checks.point_sum_wide(rows, sorted({p for p, _ in pairs})).first()
            assert plain.sum_relcover == wide.sum_relcover == total
            assert plain.relcover_is_100 == wide.relcover_is_100 == (total == 100.0)


def test_exact_sum_keeps_infinities_and_large_values(spark):
    rows = spark.createDataFrame([(1, math.inf), (1, 2.0), (2, math.inf), (2, -math.inf), (3, 1e300),
                                  (3, 0.5), (4, None), (5, 99.9999996)], "k int, v double")
    got = {r.k: r.s for r in rows.groupBy("k").agg(exact_sum("v").alias("s")).collect()}
    assert got == {1: math.inf, 2: None, 3: 1e300, 4: 0.0, 5: 99.9999996}


def test_exact_sum_is_the_real_sum_rounded_once(spark):
    rng = random.Random(3)
    rows = []
    for k in range(150):
        scale = 2.0 ** rng.choice([0, 0, -30, 60])
        for _ in range(rng.choice([1, 2, 3, 7, 60])):
            v = rng.choice([rng.uniform(-100, 100), 100 / 3, 0.1, -rng.random(), 99.9, 2.0 ** -60, 1e-18, 1.6e23])
            rows.append((k, v * scale))
    rows += [(1000, 100 / 3)] * 3 + [(1001, v) for v in (1.6e23, 1e-15, -1.6e23)] + [(1002, -100 / 3)] * 3
    rows = [(k, v) for k, v in rows if abs(v) < 2.0 ** 95]
    want = {}
    for k, v in rows:
        want[k] = want.get(k, Fraction(0)) + Fraction(v)
    want = {k: f.numerator / f.denominator for k, f in want.items()}
    assert want[1000] == 100.0 and want[1001] == 1e-15 and want[1002] == -100.0
    for parts in (1, 5):
        frame = spark.createDataFrame(rng.sample(rows, len(rows)), "k int, v double").repartition(parts)
        assert {r.k: r.s for r in frame.groupBy("k").agg(exact_sum("v").alias("s")).collect()} == want


def test_thirds_are_100_as_pandas_adds_them(spark):
    pairs = [("a", 100 / 3)] * 3
    pdf = pd.DataFrame([r for r in _cover_rows(pairs)],
                       columns=[f.name for f in spark.createDataFrame([], POINT_SCHEMA).schema])
    cells = pdf.pivot_table(index="location_name", columns="speciescode", values="percentcover", aggfunc="sum")
    row = checks.relcover_check(spark.createDataFrame(_cover_rows(pairs), POINT_SCHEMA)).first()
    assert row.sum_relcover == cells.sum(axis=1).iloc[0] == 100.0 and row.relcover_is_100


def test_wide_total_over_ten_thousand_species(spark):
    names = [f"S{i:05d}" for i in range(10_001)]
    long_form = spark.createDataFrame([("L", n, 100 / 10_001) for n in names] + [("M", names[7], 100.0)],
                                      "location_name string, speciescode string, v double")
    wide = pivots.wide_pivot(long_form, ["location_name"], "speciescode", "v", names,
                             row_total="sum_relcover", total_flag="relcover_is_100")
    # the fold reads every cell; bringing 10,004 columns to the driver is not the point
    got = {r.location_name: r for r in wide.select("location_name", names[0], names[-1], "sum_relcover",
                                                   "relcover_is_100").collect()}
    total = 0.0
    for _ in names:
        total += 100 / 10_001
    assert len(wide.columns) == 10_004
    assert got["L"].sum_relcover == total and got["L"].relcover_is_100 == (total == 100.0)
    assert got["M"].sum_relcover == 100.0 and got["M"].relcover_is_100 and got["M"][names[0]] is None
    assert got["L"][names[-1]] == 100 / 10_001


def test_infinities_of_both_signs_are_missing_never_nan(spark):
    inf = math.inf
    cells = spark.createDataFrame([("L", "a", inf), ("L", "b", -inf), ("M", "a", inf)], "k string, c string, v double")
    wide = {r.k: r for r in pivots.wide_pivot(cells, ["k"], "c", "v", ["a", "b"], row_total="t",
                                              total_flag="f").collect()}
    assert wide["L"].t is None and wide["L"].f is False and wide["M"].t == inf
    assert {r.k: r.t for r in pivots.ordered_total(cells, ["k"], "c", "v", "t").collect()} == {"L": None, "M": inf}
    one = spark.createDataFrame([(inf, -inf, None)], "a double, b double, c double")
    assert one.select(row_sum("a", "b", "c")).first()[0] is None
    far = spark.createDataFrame([("g", "R", "Segment 1", v) for v in (1.0, inf, 3.0)]
                                + [("h", "R", "Segment 1", v) for v in (inf, -inf)],
                                "event_group_id string, region string, segment string, distance double")
    got = {r.event_group_id: r for r in distance.distance_summary(far).collect()}
    assert got["g"].average_dist_m == inf and got["h"].average_dist_m is None
    for r in got.values():
        assert r.standard_error is None and r.lower_ci_95 is None and r.upper_ci_95 is None


def test_absolute_cover_sums_are_bit_equal_under_any_join(spark, sf_dir):
    import __spark_entry__ as entry_mod
    found = []
    for threshold, parts in (("-1", "8"), ("100MB", "8"), ("-1", "3")):
        before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            rows = entry_mod._survey_queries()["abs_cover_long_exact"](spark, sf_dir).collect()
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)
        found.append(sorted(tuple(r) for r in rows))
    assert found[0] == found[1] == found[2] and len(found[0]) > 100


def test_join_strategy_changes_no_flag(spark, sf_dir):
    import __spark_entry__ as entry_mod
    found = []
    for threshold in ("-1", "100MB"):
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            for name in ("relcover_fractional", "relcover_fractional_wide"):
                rows = entry_mod._survey_queries()[name](spark, sf_dir).collect()
                found.append(sorted(tuple(r[c] for c in sorted(r.asDict())) for r in rows))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert all(f == found[0] for f in found)


def test_chart_series_region_subset(small):
    stratum = cover.abs_cover_by_stratum(small)
    south = charts.chart_series(stratum, region="South").collect()
    assert south and {r.region for r in south} == {"South"}


def test_ordered_outputs(small):
    rows = checks.strata_check(small, extra_cols=["point_id"], ordered=True).collect()
    keys = [(r.location_name, r.point_id) for r in rows]
    assert keys == sorted(keys)
    stratum = cover.order_stratum_rows(cover.abs_cover_by_stratum(small)).collect()
    keys = [(r.location_name, r.start_date, r.point_id) for r in stratum]
    assert keys == sorted(keys)
    d = distance.distance_rows(small, ordered=True).collect()
    keys = [(r.segment is not None, r.segment or "", r.location_name, r.point_id) for r in d]
    assert [k[1:] for k in keys if k[0]] == sorted(k[1:] for k in keys if k[0])


_pivot_row = st.tuples(
    st.sampled_from(["a", "b", None]), st.sampled_from(["x", "y", None]),
    st.sampled_from(["s1", "s2", "s3", None]),
    st.one_of(st.none(), st.integers(0, 100).map(float)))


@settings(max_examples=12, deadline=None)
@given(rows=st.lists(_pivot_row, min_size=1, max_size=25), agg=st.sampled_from(["sum", "count"]))
def test_wide_pivot_matches_pandas_on_generated_rows(spark, rows, agg):
    rows = rows + [("a", "x", "s1", 5.0)]            # at least one complete row
    pdf = pd.DataFrame(rows, columns=["k1", "k2", "col", "v"])
    expected = pdf.pivot_table(index=["k1", "k2"], columns="col", values="v", aggfunc=agg)
    df = spark.createDataFrame(rows, "k1 string, k2 string, col string, v double")
    wide = pivots.pandas_pivot(df, ["k1", "k2"], "col", "v", list(expected.columns), agg)
    wide = wide.toPandas().set_index(["k1", "k2"])
    assert list(wide.columns) == list(expected.columns)
    assert list(wide.index) == list(expected.index)
    for c in expected.columns:
        for idx in expected.index:
            e, g = expected.loc[idx, c], wide.loc[idx, c]
            assert pd.isna(g) if pd.isna(e) else float(g) == float(e), (idx, c, e, g)


def test_positions_over_many_partitions(spark):
    from plotcover.operators.ranks import with_position
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", "b", "b", None]), i) for i in range(2000)]
    frame = spark.createDataFrame(rng.sample(rows, len(rows)), "k string, i int").repartition(9)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = with_position(frame, ["k", F.col("i").desc()])
        assert got.select(F.spark_partition_id()).distinct().count() > 1
        places = {(r.k, r.i): r.position for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", -r[1]))
    assert places == {r: at for at, r in enumerate(want, 1)}
    assert with_position(frame.limit(0), ["k", "i"]).collect() == []
