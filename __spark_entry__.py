"""

Each query reads the driver's test tables in ``sf_dir`` through the survey
fixture views (``plotcover.sources.fixtures``, DataFrame API) and runs one
operator of the engine over all of them.  Each oracle is independent SQL for
DuckDB: the fixture views as CTEs (FIXTURES.md §2) and one SELECT.

Products and sums of doubles, and the statistics of the distance summary, are
rounded to 6 decimals on both sides; exact columns are left as they are.
"""

from __future__ import annotations

import importlib
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plotcover.functions.cover import to_number
from plotcover.functions.text import segment_number, site_point, site_segment
from plotcover.operators import charts, frames
from plotcover.operators import checks as chk
from plotcover.operators import cover as cov
from plotcover.operators import distance as dist
from plotcover.operators import groups as grp
from plotcover.operators import pivots
from plotcover.operators.ranks import with_position
from plotcover.schema import MARKER_VISIT, SIDES, STRATA, STRATUM_COLS, abs_cover_col
from plotcover.sources.fixtures import fixture_tables, stored_table
from plotcover.sources.lookup import site_region_lookup
from plotcover.sources.tables import normalise_table, rejected_values

SMOKE_DIR = "/root/testdata/sf0.001"


def _round(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------

# The fixture's species codes and location names follow from its rules
# (FIXTURES.md §2): 'SP00'..'SP11'; nation keys 0..24 as '01_1'..'07_1'.
SPECIES = [f"SP{i:02d}" for i in range(12)]
LOCATION_NAMES = [f"{k // 4 + 1:02d}_{k % 4 + 1}" for k in range(25)]

ABS_COLS = [abs_cover_col(side, s) for side in SIDES for s in STRATA]
PILOT_STRATUM_COLUMNS = ["location_name", "event_id"]


def _tables(spark: SparkSession, sf_dir: str):
    return fixture_tables(spark, sf_dir)


def q_event_groups(spark, sf_dir):
    return grp.event_group_list(_tables(spark, sf_dir))


def _pilot_tables(spark, sf_dir):
    """The fixture tables with a Pilot-generation location table in place of
    the common one: the engine reads it through the adapter (S4)."""
    t = _tables(spark, sf_dir)
    geo = t.locations.select(F.col("location_id").alias("GlobalID"),
                             F.col("location_name").alias("Loc_Name_Short"))
    return t.with_(locations=frames.locations_from_pilot(geo))


def q_locations_adapter(spark, sf_dir):
    t = _pilot_tables(spark, sf_dir)
    return chk.strata_check(t, columns=["start_date", "location_name", "event_type"] + STRATUM_COLS)


def q_site_code_filter(spark, sf_dir):
    rows = frames.filter_site_codes(cov.point_cover_rows(_tables(spark, sf_dir)))
    return _round(cov.abs_cover_long(rows), "abs_cover")


def q_event_group_filter(spark, sf_dir):
    rows = cov.point_cover_rows(_tables(spark, sf_dir), event_group="{automobile}")
    return _round(cov.abs_cover_long(rows), "abs_cover")


def q_numeric_coercion(spark, sf_dir):
    veg = _tables(spark, sf_dir).vegetation
    types = {f.name: f.dataType for f in veg.schema.fields}
    return veg.select("point_id", "percentcover_raw",
                      to_number("percentcover_raw", types["percentcover_raw"]).alias("percentcover"))


def q_strata_check(spark, sf_dir):
    return chk.strata_check(_tables(spark, sf_dir))


def _point_rows(spark, sf_dir):
    return chk.point_rows(_tables(spark, sf_dir))


def q_point_count_long(spark, sf_dir):
    return chk.point_count_long(_point_rows(spark, sf_dir))


def q_point_count_wide(spark, sf_dir):
    return chk.point_count_wide(_point_rows(spark, sf_dir), SPECIES)


def q_point_sum_long(spark, sf_dir):
    return chk.point_sum_long(_point_rows(spark, sf_dir))


def q_point_sum_wide(spark, sf_dir):
    return chk.point_sum_wide(_point_rows(spark, sf_dir), SPECIES)


def q_relcover_check(spark, sf_dir):
    return chk.relcover_check(_point_rows(spark, sf_dir))


def _fractional_rows(spark, sf_dir):
    """Species rows whose covers are tenths (text), so that their sums depend
    on how they are added."""
    t = _tables(spark, sf_dir)
    item = stored_table(spark, sf_dir, "lineitem")
    tenths = (F.col("l_partkey") * 7 + F.col("l_linenumber") * 131) % 1000
    cover = F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))
    veg = item.select(
        F.col("l_orderkey").alias("point_id"),
        F.when(F.col("l_returnflag") == "A", "Mangrove").otherwise("Marsh").alias("communitytype"),
        F.when(F.col("l_linenumber") <= 3, "Tree").otherwise("Herb").alias("vegetationtype"),
        F.concat(F.lit("SP"), F.lpad((F.col("l_partkey") % 12).cast("string"), 2, "0")).alias("speciescode"),
        cover.alias("percentcover_raw"))
    return chk.point_rows(t.with_(vegetation=veg))


def q_relcover_fractional(spark, sf_dir):
    return chk.relcover_check(_fractional_rows(spark, sf_dir))


def q_relcover_fractional_wide(spark, sf_dir):
    """The same totals from the wide form: both must agree to the last bit."""
    wide = chk.point_sum_wide(_fractional_rows(spark, sf_dir), SPECIES)
    return wide.select(*chk.POINT_KEYS, "sum_relcover", "relcover_is_100")


def _thirds_rows(spark, sf_dir):
    """Species rows whose covers are thirds, as doubles: three times 100/3 is
    100 only if the doubles are added exactly and rounded once."""
    t = _tables(spark, sf_dir)
    item = stored_table(spark, sf_dir, "lineitem")
    cover = F.when(F.col("l_orderkey") % 2 == 0, F.lit(100.0)).otherwise(
        ((F.col("l_partkey") * 7 + F.col("l_linenumber") * 131) % 300).cast("double")) / 3
    veg = item.select(
        F.col("l_orderkey").alias("point_id"),
        F.when(F.col("l_returnflag") == "A", "Mangrove").otherwise("Marsh").alias("communitytype"),
        F.when(F.col("l_linenumber") <= 3, "Tree").otherwise("Herb").alias("vegetationtype"),
        F.concat(F.lit("SP"), F.lpad((F.col("l_orderkey") % 3000).cast("string"), 4, "0")).alias("speciescode"),
        cover.alias("percentcover_raw"))
    return chk.point_rows(t.with_(vegetation=veg))


def q_relcover_thirds(spark, sf_dir):
    return chk.relcover_check(_thirds_rows(spark, sf_dir))


def q_point_sum_thirds(spark, sf_dir):
    """The cells behind it, each sum exact and rounded once."""
    return chk.point_sum_long(_thirds_rows(spark, sf_dir))


def q_abs_cover_long_exact(spark, sf_dir):
    """SOP8-2 without rounding: sums of products to the last bit."""
    return cov.abs_cover_long(cov.point_cover_rows(_tables(spark, sf_dir)))


def _raw_markers(spark, sf_dir):
    """Markers as an export writes them: source names, ids with braces, text
    covers with words among them, NaN distances."""
    key = F.col("o_orderkey")
    return stored_table(spark, sf_dir, "orders").select(
        F.concat(F.lit("{ab-"), key.cast("string"), F.lit("}")).alias("Point_ID"),
        F.concat(F.lit("ev-"), F.col("o_custkey").cast("string")).alias("Event_ID"),
        F.when(key % 5 == 0, F.lit(float("nan"))).otherwise((key % 77).cast("double") / 4).alias("Distance"),
        F.when(key % 2 == 0, "GPS").otherwise("Tape").alias("Method"),
        F.when(key % 3 == 0, "trace").when(key % 3 == 1, F.concat(F.lit(" "), (key % 90).cast("string"),
                                                                 F.lit(".5 "))).alias("MangroveSide_Cover_Tree"),
        (key % 100).cast("int").alias("MarshSide_Cover_Herb"))


def _raw_events(spark, sf_dir):
    """Visits with dates as text: month first, padded or with a time, ISO, and
    some that are no dates."""
    key = F.col("c_custkey")
    month, day = key % 12 + 1, key % 28 + 1
    us = F.concat_ws("/", month.cast("string"), day.cast("string"), F.lit("2010"))
    padded = F.format_string("%02d/%02d/2011", month, day)
    iso = F.format_string("2012-%02d-%02d", month, day)
    return stored_table(spark, sf_dir, "customer").select(
        F.concat(F.lit("{ev-"), key.cast("string"), F.lit("}")).alias("Event_ID"),
        F.when(key % 7 == 0, "13/40/2010").when(key % 7 == 1, us).when(key % 7 == 2, F.concat(us, F.lit(" 0:00:00")))
        .when(key % 7 == 3, padded).when(key % 7 == 4, iso).when(key % 7 == 5, " ").alias("Start_Date"))


def q_normalised_markers(spark, sf_dir):
    """The forgiving read."""
    return normalise_table(_raw_markers(spark, sf_dir), "markers")


def q_normalised_event_dates(spark, sf_dir):
    """The forgiving read of text dates."""
    return normalise_table(_raw_events(spark, sf_dir), "events").select("event_id", "start_date")


def q_rejected_values(spark, sf_dir):
    """What that read could not take, with its table, key and column."""
    return rejected_values(_raw_markers(spark, sf_dir), "markers").unionByName(
        rejected_values(_raw_events(spark, sf_dir), "events"))


def q_site_order(spark, sf_dir):
    """O6 as rows: unpadded site codes with one- and two-digit segments, each
    with its numbers and its place among the report's columns."""
    key = F.col("c_custkey")
    codes = stored_table(spark, sf_dir, "customer").select(F.concat(
        (key % 15 + 1).cast("string"), F.lit("_"), (F.floor(key / 15) % 4 + 1).cast("string")).alias("location_name"))
    names = codes.distinct()
    order = Window.orderBy(*pivots.site_order_key())
    return names.select("location_name", site_segment().alias("segment_number"),
                        site_point().alias("point_number"), F.row_number().over(order).alias("position"))


def q_strata_check_positions(spark, sf_dir):
    """O1: the check's rows, each with its place by location name."""
    rows = chk.strata_check(_tables(spark, sf_dir), extra_cols=["point_id"])
    return with_position(rows, ["location_name", "point_id"]).select(
        "position", "location_name", "point_id", "sum_mangrove", "sum_marsh")


def q_abs_cover_by_stratum_positions(spark, sf_dir):
    """O2: by location name, then visit date."""
    rows = cov.abs_cover_by_stratum(_tables(spark, sf_dir))
    return with_position(rows, ["location_name", "start_date", "point_id"]).select(
        "position", "location_name", "start_date", "point_id", "marshside_cover_overall")


def q_distance_summary_positions(spark, sf_dir):
    """O3: by the segment's number, missing last."""
    rows = dist.distance_summary(dist.distance_rows(_tables(spark, sf_dir)), confidence=None, ordered=False)
    order = [segment_number("segment").asc_nulls_last(), *dist.SUMMARY_KEYS]
    return with_position(rows, order).select("position", *dist.SUMMARY_KEYS, "rec_count", "min_difference")


def q_distance_rows_positions(spark, sf_dir):
    """By segment text, location name and visit type."""
    rows = dist.distance_rows(_tables(spark, sf_dir))
    return with_position(rows, ["segment", "location_name", "event_type", "point_id"]).select(
        "position", "segment", "location_name", "event_type", "point_id", "distance")


def q_point_sum_positions(spark, sf_dir):
    """Every cell of the wide table with the place of its row and column."""
    wide = chk.point_sum_wide(_point_rows(spark, sf_dir), list(reversed(SPECIES)))
    rows = with_position(wide, chk.POINT_KEYS, "row_position")
    return pivots.wide_cells(rows, ["row_position", *chk.POINT_KEYS], SPECIES, "speciescode", "sum_percentcover")


# Unpadded site codes with one- and two-digit segments, in text order.
UNPADDED_NAMES = sorted(f"{k % 14 + 1}_{k // 14 + 1}" for k in range(25))


def q_abs_cover_site_positions(spark, sf_dir):
    """The cells of the site-ordered wide table over unpadded codes, each
    with the place its column has there."""
    t = _tables(spark, sf_dir)
    k = F.col("location_id")
    code = F.concat((k % 14 + 1).cast("string"), F.lit("_"), (F.floor(k / 14) + 1).cast("string"))
    rows = cov.point_cover_rows(t.with_(locations=t.locations.withColumn("location_name", code)))
    wide = cov.abs_cover_wide(rows, UNPADDED_NAMES, order="site")
    return _round(pivots.wide_cells(wide, cov.SPECIES_KEYS, UNPADDED_NAMES, "location_name", "abs_cover"), "abs_cover")


def q_pilot_point_count_long(spark, sf_dir):
    return chk.point_count_long(chk.point_rows(_pilot_tables(spark, sf_dir)), chk.PILOT_POINT_KEYS)


def q_strata_check_by_group(spark, sf_dir):
    return grp.strata_check_by_group(_tables(spark, sf_dir))


def q_chart_series_region(spark, sf_dir):
    """the series of one region."""
    series = charts.chart_series(cov.abs_cover_by_stratum(_tables(spark, sf_dir)), region="AMERICA")
    return _round(series, "abs_cover")


def q_pilot_point_sum_long(spark, sf_dir):
    """A4 as the Pilot generation keys it: no region or segment (its
    locations carry neither), read through the location adapter (S4)."""
    rows = chk.point_rows(_pilot_tables(spark, sf_dir))
    return chk.point_sum_long(rows, chk.PILOT_POINT_KEYS)


def q_pilot_relcover_check(spark, sf_dir):
    rows = chk.point_rows(_pilot_tables(spark, sf_dir))
    return chk.relcover_check(rows, chk.PILOT_POINT_KEYS)


def q_point_sum_by_group(spark, sf_dir):
    return grp.point_sum_by_group(_tables(spark, sf_dir))


def q_point_count_by_group(spark, sf_dir):
    return grp.point_count_by_group(_tables(spark, sf_dir))


def q_relcover_by_group(spark, sf_dir):
    return grp.relcover_by_group(_tables(spark, sf_dir))


def q_point_cover_rows(spark, sf_dir):
    return cov.point_cover_rows(_tables(spark, sf_dir))


def q_abs_cover_rows(spark, sf_dir):
    rows = cov.abs_cover_rows(cov.point_cover_rows(_tables(spark, sf_dir)))
    return _round(rows, "abs_cover")


def q_abs_cover_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return _round(cov.abs_cover_long(cov.point_cover_rows(t)), "abs_cover")


def _round_wide(df: DataFrame, keys) -> DataFrame:
    return _round(df, *[c for c in df.columns if c not in keys])


def q_abs_cover_wide(spark, sf_dir):
    wide = cov.abs_cover_wide(cov.point_cover_rows(_tables(spark, sf_dir)), LOCATION_NAMES)
    return _round_wide(wide, cov.SPECIES_KEYS)


def q_abs_cover_site_order(spark, sf_dir):
    wide = cov.abs_cover_wide(cov.point_cover_rows(_tables(spark, sf_dir)), LOCATION_NAMES, order="site")
    return _round_wide(wide, cov.SPECIES_KEYS)


def q_abs_cover_by_group(spark, sf_dir):
    return _round(grp.abs_cover_by_group(_tables(spark, sf_dir)), "abs_cover")


def q_abs_cover_by_stratum(spark, sf_dir):
    return _round(cov.abs_cover_by_stratum(_tables(spark, sf_dir)), *ABS_COLS)


def q_stratum_fanout(spark, sf_dir):
    frame = frames.stratum_fanout_frame(_tables(spark, sf_dir))
    rows = cov.abs_cover_by_stratum(None, frame=frame, id_columns=PILOT_STRATUM_COLUMNS)
    return _round(rows, *ABS_COLS)


def q_stratum_with_region(spark, sf_dir):
    t = _tables(spark, sf_dir)
    frame = frames.filter_site_codes(frames.marker_frame(t, MARKER_VISIT))
    rows = cov.abs_cover_by_stratum(None, frame=frame, id_columns=PILOT_STRATUM_COLUMNS)
    joined = frames.with_lookup_region(rows, site_region_lookup(spark))
    return _round(joined, *ABS_COLS)


def q_region_list(spark, sf_dir):
    return charts.region_list(cov.abs_cover_by_stratum(_tables(spark, sf_dir)))


def q_chart_series(spark, sf_dir):
    series = charts.chart_series(cov.abs_cover_by_stratum(_tables(spark, sf_dir)))
    return _round(series, "abs_cover")


def q_segment_sort_key(spark, sf_dir):
    return dist.segment_sort_keys(dist.distance_rows(_tables(spark, sf_dir)))


def q_distance_rows(spark, sf_dir):
    return dist.distance_rows(_tables(spark, sf_dir))


def q_distance_summary(spark, sf_dir):
    summary = dist.distance_summary(dist.distance_rows(_tables(spark, sf_dir)), confidence=None)
    return _round(summary, "average_dist_m", "standard_error")


def q_distance_ci(spark, sf_dir):
    summary = dist.distance_summary(dist.distance_rows(_tables(spark, sf_dir)))
    return _round(summary, "average_dist_m", "standard_error", "lower_ci_95", "upper_ci_95")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the species x location absolute-cover table (SOP8-2) in long
    form over the sf0.001 tables."""
    return q_abs_cover_long(spark, SMOKE_DIR)


def _text_operators():
    """The module of the text-operator queries, or None where that subpackage
    (or the pipeline built on it) is not installed."""
    try:
        return importlib.import_module("plotcover.llm.queries")
    except ModuleNotFoundError as error:
        if (error.name or "").split(".")[:2] == ["plotcover", "llm"] or error.name == "corpus_pipeline":
            return None
        raise


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    text = _text_operators()
    return _survey_queries() | (text.queries() if text else {})


def _survey_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "event_groups": q_event_groups,
        "locations_adapter": q_locations_adapter,
        "site_code_filter": q_site_code_filter,
        "event_group_filter": q_event_group_filter,
        "numeric_coercion": q_numeric_coercion,
        "strata_check": q_strata_check,
        "point_count_long": q_point_count_long,
        "point_count_wide": q_point_count_wide,
        "point_sum_long": q_point_sum_long,
        "point_sum_wide": q_point_sum_wide,
        "relcover_check": q_relcover_check,
        "pilot_point_sum_long": q_pilot_point_sum_long,
        "pilot_relcover_check": q_pilot_relcover_check,
        "point_sum_by_group": q_point_sum_by_group,
        "point_count_by_group": q_point_count_by_group,
        "relcover_by_group": q_relcover_by_group,
        "point_cover_rows": q_point_cover_rows,
        "abs_cover_rows": q_abs_cover_rows,
        "abs_cover_long": q_abs_cover_long,
        "abs_cover_wide": q_abs_cover_wide,
        "abs_cover_site_order": q_abs_cover_site_order,
        "abs_cover_by_group": q_abs_cover_by_group,
        "abs_cover_by_stratum": q_abs_cover_by_stratum,
        "stratum_fanout": q_stratum_fanout,
        "stratum_with_region": q_stratum_with_region,
        "region_list": q_region_list,
        "chart_series": q_chart_series,
        "chart_series_region": q_chart_series_region,
        "site_order": q_site_order,
        "normalised_markers": q_normalised_markers,
        "normalised_event_dates": q_normalised_event_dates,
        "rejected_values": q_rejected_values,
        "strata_check_by_group": q_strata_check_by_group,
        "relcover_fractional": q_relcover_fractional,
        "relcover_fractional_wide": q_relcover_fractional_wide,
        "relcover_thirds": q_relcover_thirds,
        "point_sum_thirds": q_point_sum_thirds,
        "abs_cover_long_exact": q_abs_cover_long_exact,
        "pilot_point_count_long": q_pilot_point_count_long,
        "segment_sort_key": q_segment_sort_key,
        "strata_check_positions": q_strata_check_positions,
        "abs_cover_by_stratum_positions": q_abs_cover_by_stratum_positions,
        "distance_summary_positions": q_distance_summary_positions,
        "distance_rows_positions": q_distance_rows_positions,
        "point_sum_positions": q_point_sum_positions,
        "abs_cover_site_positions": q_abs_cover_site_positions,
        "distance_rows": q_distance_rows,
        "distance_summary": q_distance_summary,
        "distance_ci": q_distance_ci,
    }


# --------------------------------------------------------------------------
# Oracle side (DuckDB SQL)
# --------------------------------------------------------------------------

FIXTURE_CTES = """
fx_locations AS (
select cast(n_nationkey as int) as location_id, r_name as region,
  case when n_nationkey = 24 then null
       else 'Segment ' || cast(n_nationkey % 14 + 1 as varchar(10)) end as segment,
  lpad(cast(cast(floor(n_nationkey / 4) as int) + 1 as varchar(10)), 2, '0')
    || '_' || cast(n_nationkey % 4 + 1 as varchar(10)) as location_name
from nation join region on n_regionkey = r_regionkey),
fx_event_groups AS (
select c_mktsegment as event_group_id,
  case when c_mktsegment in ('AUTOMOBILE','BUILDING') then 'Segment ' else 'Index ' end
    || c_mktsegment as event_group_name,
  min(make_date(cast(2009 + c_custkey % 17 as int), cast(1 + c_custkey % 12 as int),
                cast(1 + c_custkey % 28 as int))) as start_date,
  max(make_date(cast(2009 + c_custkey % 17 as int), cast(1 + c_custkey % 12 as int),
                cast(1 + c_custkey % 28 as int))) as end_date,
  'Assessment ' || substr(c_mktsegment, 1, 1) as assessment
from customer group by c_mktsegment),
fx_events AS (
select c_custkey as event_id, c_mktsegment as event_group_id,
  cast(c_nationkey as int) as location_id,
  case when c_custkey % 10 < 8 then 'Marker Visit' else 'Segment Visit' end as event_type,
  make_date(cast(2009 + c_custkey % 17 as int), cast(1 + c_custkey % 12 as int),
            cast(1 + c_custkey % 28 as int)) as start_date
from customer),
fx_markers AS (
select o_orderkey as point_id, o_custkey as event_id,
  case when o_orderkey % 11 = 0 then null
       else cast((o_orderkey * 37) % 401 as double) / 4 - 50 end as distance,
  case when o_orderkey % 2 = 0 then 'GPS' else 'Tape' end as method,
  cast((o_orderkey * 7) % 21 * 5 as double) as mangroveside_cover_overall,
  case when o_orderkey % 13 = 0 then null else cast(o_orderkey % 5 * 10 as double) end as mangroveside_cover_tree,
  case when o_orderkey % 13 = 0 then null else cast(o_orderkey % 4 * 15 as double) end as mangroveside_cover_shrub,
  case when o_orderkey % 13 = 0 then null
       when o_orderkey % 3 = 0 then cast(5 as double)
       else cast(100 - o_orderkey % 5 * 10 - o_orderkey % 4 * 15 as double) end as mangroveside_cover_herb,
  cast((o_orderkey * 11) % 21 * 5 as double) as marshside_cover_overall,
  cast(o_orderkey % 3 * 20 as double) as marshside_cover_tree,
  case when o_orderkey % 7 = 0 then null else cast(o_orderkey % 6 * 5 as double) end as marshside_cover_shrub,
  cast(100 - o_orderkey % 3 * 20 - o_orderkey % 6 * 5 as double) as marshside_cover_herb
from orders),
fx_vegetation AS (
select l_orderkey as point_id,
  case l_returnflag when 'A' then 'Mangrove' when 'N' then 'Marsh' else 'Upland' end as communitytype,
  case when l_linenumber <= 2 then 'Tree' when l_linenumber <= 4 then 'Shrub'
       when l_linenumber <= 6 then 'Herb' else 'Vine' end as vegetationtype,
  case when l_partkey % 97 = 0 then null
       else 'SP' || lpad(cast(l_partkey % 12 as varchar(10)), 2, '0') end as speciescode,
  case when l_quantity = 50 then null when l_quantity = 49 then 'trace'
       else cast(cast(l_quantity * 2 as int) as varchar(10)) end as percentcover_raw
from lineitem)"""


def _with(*ctes: str) -> str:
    parts = [FIXTURE_CTES.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n"


# Coercion of text to a number, as in the engine's op E3 but written for
# DuckDB: trimmed text that reads as a decimal number or an infinity word.
def _sql_number(expr: str) -> str:
    txt = f"regexp_replace(cast({expr} as varchar), '^\\s+|\\s+$', '', 'g')"
    return (f"(case when regexp_full_match({txt}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')"
            f" and abs(try_cast({txt} as double)) <> 'inf'::double then try_cast({txt} as double)"
            f" when regexp_full_match(lower({txt}), '[+-]?inf(inity)?') then try_cast({txt} as double) end)")


def _sql_side(side: str) -> str:
    value = (f"{side}side_cover_overall * ((case vegetationtype "
            f"when 'Tree' then {side}side_cover_tree when 'Shrub' then {side}side_cover_shrub "
            f"when 'Herb' then {side}side_cover_herb when 'Overall' then {side}side_cover_overall "
            f"end) / 100.0) * (percentcover / 100.0)")
    return f"(case when not isnan({value}) then {value} end)"


def _sql_abs_rows(where_extra: str = "") -> str:
    return f"""
point_rows AS (
select e.event_group_id, e.start_date, l.region, l.location_name, e.event_type,
  v.communitytype, v.vegetationtype, v.speciescode, v.percentcover_raw,
  m.mangroveside_cover_overall, m.mangroveside_cover_tree, m.mangroveside_cover_shrub,
  m.mangroveside_cover_herb, m.marshside_cover_overall, m.marshside_cover_tree,
  m.marshside_cover_shrub, m.marshside_cover_herb
from fx_vegetation v join fx_markers m on v.point_id = m.point_id
  join fx_events e on m.event_id = e.event_id
  join fx_locations l on e.location_id = l.location_id
where v.percentcover_raw is not null and e.event_type = 'Marker Visit' {where_extra}),
coerced AS (
select *, {_sql_number('percentcover_raw')} as percentcover
from point_rows),
abs_rows AS (
select *, case communitytype when 'Mangrove' then {_sql_side('mangrove')}
  when 'Marsh' then {_sql_side('marsh')} end as abs_cover
from coerced)"""


def _not_null(keys: str) -> str:
    return " and ".join(f"{k.strip()} is not null" for k in keys.split(","))


def _sql_abs_cover_long(extra: str = "", where_extra: str = "") -> str:
    keys = f"{extra}communitytype, vegetationtype, speciescode, location_name"
    return _with(_sql_abs_rows(where_extra)) + f"""
select {keys}, round(coalesce(sum(abs_cover), 0.0), 6) as abs_cover
from abs_rows where {_not_null(keys)}
group by {keys}"""


# Marker rows of every visit type with visit and location.
SQL_MK = """
mk AS (
select m.*, e.event_group_id, e.event_type, e.start_date, e.location_id,
  l.region, l.segment, l.location_name
from fx_markers m join fx_events e on m.event_id = e.event_id
  join fx_locations l on e.location_id = l.location_id)"""

# Species rows of every visit type, percent cover read as a number.
SQL_PR = f"""
pr AS (
select v.communitytype, v.vegetationtype, v.speciescode, v.percentcover_raw,
  {_sql_number('v.percentcover_raw')} as percentcover,
  mk.event_group_id, mk.event_type, mk.region, mk.segment, mk.location_name
from fx_vegetation v join mk on v.point_id = mk.point_id)"""

# Marker visits with their event group.
SQL_DR = """
dr AS (
select mk.event_group_id, g.event_group_name, g.start_date as group_start_date,
  g.end_date as group_end_date, g.assessment,
  mk.event_type, mk.location_id, mk.region, mk.segment, mk.location_name,
  mk.point_id, mk.distance, mk.method
from mk join fx_event_groups g on mk.event_group_id = g.event_group_id
where mk.event_type = 'Marker Visit')"""

POINT_KEYS_SQL = "region, segment, location_name, communitytype, vegetationtype, event_type"
PILOT_POINT_KEYS_SQL = "location_name, communitytype, vegetationtype, event_type"
STRATA_SQL = ", ".join(f"{s}side_cover_{t}" for s in ("mangrove", "marsh")
                       for t in ("tree", "shrub", "herb"))


def _sql_sums() -> str:
    out = []
    for side in ("mangrove", "marsh"):
        total = " + ".join(f"coalesce({side}side_cover_{t}, 0.0)" for t in ("tree", "shrub", "herb"))
        out.append(f"{total} as sum_{side}")
        out.append(f"({total}) = 100.0 as {side}_is_100")
    return ",\n  ".join(out)


def _sql_covers_and_abs(prefix: str = "") -> str:
    cols = []
    for side in ("mangrove", "marsh"):
        for t in ("overall", "tree", "shrub", "herb"):
            cols.append(f"{prefix}{side}side_cover_{t}")
        for t in ("tree", "shrub", "herb"):
            cols.append(f"round({prefix}{side}side_cover_overall * ({prefix}{side}side_cover_{t} / 100.0), 6)"
                        f" as abscover_{side}_{t}")
    return ", ".join(cols)


def _wide_cells(column: str, values: list[str], value: str, agg: str, digits: int | None = None) -> str:
    cells = []
    for v in values:
        present = f"count(case when {column} = '{v}' then 1 end) > 0"
        if agg == "sum":
            cell = f"coalesce(sum(case when {column} = '{v}' then {value} end), 0.0)"
        else:
            cell = f"count(case when {column} = '{v}' then percentcover_raw end)"
        if digits is not None:
            cell = f"round({cell}, {digits})"
        cells.append(f'case when {present} then {cell} end as "{v}"')
    return ",\n  ".join(cells)


def _sql_point_long(agg: str, keys: str = POINT_KEYS_SQL) -> str:
    out = "n_percentcover" if agg == "count" else "sum_percentcover"
    cell = "count(percentcover_raw)" if agg == "count" else "coalesce(sum(percentcover), 0.0)"
    keys = keys + ", speciescode"
    return _with(SQL_MK, SQL_PR) + f"""
select {keys}, {cell} as {out}
from pr where {_not_null(keys)}
group by {keys}"""


def _sql_point_wide(agg: str) -> str:
    keys = POINT_KEYS_SQL
    extra = ""
    if agg == "sum":
        extra = (",\n  coalesce(sum(percentcover), 0.0) as sum_relcover,"
                 "\n  coalesce(sum(percentcover), 0.0) = 100.0 as relcover_is_100")
    return _with(SQL_MK, SQL_PR) + f"""
select {keys},
  {_wide_cells('speciescode', SPECIES, 'percentcover', agg)}{extra}
from pr where {_not_null(keys + ', speciescode')}
group by {keys}"""


def _sql_relcover(keys: str = POINT_KEYS_SQL) -> str:
    return _with(SQL_MK, SQL_PR) + f"""
select {keys}, coalesce(sum(percentcover), 0.0) as sum_relcover,
  coalesce(sum(percentcover), 0.0) = 100.0 as relcover_is_100
from pr where {_not_null(keys + ', speciescode')}
group by {keys}"""


def _sql_exact_sum(value: str, bits: int = 64) -> str:
    """The sum of doubles of at least 0 whose last bit is above 2^-bits, exact
    and rounded once: a whole number of 2^-bits, in two halves of which each is
    a double without rounding."""
    total = f"sum(cast({value} * {2 ** bits}::double as hugeint))"
    return (f"((cast({total} // {2 ** 48} as double) * {2 ** 48}::double + cast({total} % {2 ** 48} as double))"
            f" / {2 ** bits}::double)")


def _sql_folded(rows: str, value: str) -> str:
    """Exact totals per species, then added as doubles in species order."""
    keys = POINT_KEYS_SQL
    return _with(SQL_MK) + f""",
fr AS ({rows}),
sp AS (
select {keys}, speciescode, {_sql_exact_sum(value)} as total
from fr where {_not_null(keys)} group by {keys}, speciescode),
folded AS (
select {keys}, list_reduce(list_prepend(cast(0 as double), list(total order by speciescode)),
                           lambda a, b: a + b) as sum_relcover
from sp group by {keys})
"""


def _sql_made_rows(species: str, cover: str) -> str:
    return f"""
select region, segment, location_name, event_type,
  case when l_returnflag = 'A' then 'Mangrove' else 'Marsh' end as communitytype,
  case when l_linenumber <= 3 then 'Tree' else 'Herb' end as vegetationtype,
  {species} as speciescode, {cover} as percentcover
from lineitem join mk on l_orderkey = mk.point_id"""


FRACTIONAL_ROWS = _sql_made_rows("'SP' || lpad(cast(l_partkey % 12 as varchar), 2, '0')",
                                 "cast((l_partkey * 7 + l_linenumber * 131) % 1000 as double) / 10")
THIRDS_ROWS = _sql_made_rows(
    "'SP' || lpad(cast(l_orderkey % 3000 as varchar), 4, '0')",
    "case when l_orderkey % 2 = 0 then 100.0::double "
    "else cast((l_partkey * 7 + l_linenumber * 131) % 300 as double) end / 3")
FOLDED_CHECK = "select *, sum_relcover = 100.0 as relcover_is_100 from folded"


SQL_GROUP_ROWS = """
gpr AS (
select pr.* replace (case when contains(g.event_group_name, 'Segment') then pr.segment end as segment)
from pr join fx_event_groups g on pr.event_group_id = g.event_group_id
where not contains(g.event_group_name, 'Segment') or pr.segment is not null)"""

GROUP_KEYS_SQL = "event_group_id, " + POINT_KEYS_SQL
GROUP_REQUIRED = "event_group_id, region, location_name, communitytype, vegetationtype, event_type, speciescode"


def _sql_group(select: str, keys: str) -> str:
    return _with(SQL_MK, SQL_PR, SQL_GROUP_ROWS) + f"""
select {keys}, {select}
from gpr where {_not_null(GROUP_REQUIRED)}
group by {keys}"""


def _sql_abs_wide() -> str:
    keys = "communitytype, vegetationtype, speciescode"
    return _with(_sql_abs_rows()) + f"""
select {keys},
  {_wide_cells('location_name', LOCATION_NAMES, 'abs_cover', 'sum', 6)}
from abs_rows where {_not_null(keys + ', location_name')}
group by {keys}"""


SQL_ST = f"""
st AS (
select event_group_id, point_id, location_id, region, location_name, start_date,
  {_sql_covers_and_abs()}
from mk where event_type = 'Marker Visit')"""

SITE_CODE_SQL = "regexp_full_match(location_name, '(0[1-9]|1[0-4])_[1-4]')"


def _sql_chart_series() -> str:
    parts = []
    for side_rank, side in enumerate(("marsh", "mangrove"), start=1):
        for rank, t in enumerate(("tree", "shrub", "herb"), start=1):
            parts.append(
                f"select event_group_id, region, location_name, start_date, point_id, "
                f"'{side.capitalize()}' as side, {side_rank} as side_order, "
                f"'{t.capitalize()}' as stratum, {rank} as stratum_order, "
                f"{side}side_cover_overall as overall_cover, abscover_{side}_{t} as abs_cover from st")
    return _with(SQL_MK, SQL_ST) + "\nunion all\n".join(parts)


# ---- Student-t critical values for the oracle ---------------------------
# Computed here independently of the engine: for whole degrees of freedom
# the t distribution function has a closed form (Abramowitz & Stegun
# 26.7.3-4), solved by Newton steps; above ORACLE_T_MAX the published
# Cornish-Fisher expansion (A&S 26.7.5) is written into the SQL.
ORACLE_T_MAX = 300


def _t_central_probability(t: float, nu: int) -> float:
    """P(|T| <= t) for whole nu, by the closed form."""
    theta = math.atan(t / math.sqrt(nu))
    s, c = math.sin(theta), math.cos(theta)
    if nu % 2 == 1:
        total, term = 0.0, c
        for k in range(1, (nu - 1) // 2 + 1):
            total += term
            term *= c * c * (2 * k) / (2 * k + 1)
        return 2.0 / math.pi * (theta + s * total)
    total, term = 0.0, 1.0
    for k in range(1, nu // 2 + 1):
        total += term
        term *= c * c * (2 * k - 1) / (2 * k)
    return s * total


def _t_quantile(nu: int, confidence: float) -> float:
    log_norm = math.lgamma((nu + 1) / 2) - math.lgamma(nu / 2) - 0.5 * math.log(nu * math.pi)
    t = 1.0
    for _ in range(200):
        density = math.exp(log_norm - (nu + 1) / 2 * math.log1p(t * t / nu))
        step = (confidence - _t_central_probability(t, nu)) / (2 * density)
        t += step
        if abs(step) < 1e-15 * t:
            break
    return t


def _sql_t_values(confidence: float = 0.95) -> str:
    rows = ", ".join(f"({nu}, {_t_quantile(nu, confidence)!r})" for nu in range(1, ORACLE_T_MAX + 1))
    return f"tt AS (select * from (values {rows}) v(dof, t_crit))"


def _sql_cornish_fisher(nu: str, confidence: float = 0.95) -> str:
    from statistics import NormalDist
    z = NormalDist().inv_cdf((1 + confidence) / 2)
    g = [(z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96,
         (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
         (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160]
    return (f"({z!r} + {g[0]!r} / {nu} + {g[1]!r} / power({nu}, 2) "
            f"+ {g[2]!r} / power({nu}, 3) + {g[3]!r} / power({nu}, 4))")


def _sql_distance(with_ci: bool) -> str:
    keys = "event_group_id, region, segment"
    stats = f"""
ds AS (
select {keys}, avg(distance) as average_dist_m,
  stddev_samp(distance) / sqrt(count(distance)) as standard_error,
  count(distance) as rec_count, min(distance) as min_difference,
  max(distance) as max_difference
from dr where {_not_null(keys)}
group by {keys})"""
    cols = (f"{keys}, round(average_dist_m, 6) as average_dist_m, "
            "round(standard_error, 6) as standard_error, rec_count, min_difference, max_difference")
    if not with_ci:
        return _with(SQL_MK, SQL_DR, stats) + f"select {cols} from ds"
    dof = "(ds.rec_count - 1)"
    t = (f"(case when {dof} > {ORACLE_T_MAX} then {_sql_cornish_fisher(dof)} "
         f"when {dof} >= 1 then tt.t_crit end)")
    return _with(SQL_MK, SQL_DR, stats, _sql_t_values()) + f"""
select {cols},
  round(average_dist_m - {t} * standard_error, 6) as lower_ci_95,
  round(average_dist_m + {t} * standard_error, 6) as upper_ci_95
from ds left join tt on {dof} = tt.dof"""


def oracle_sql() -> dict[str, str]:
    text = _text_operators()
    return _survey_oracles() | (text.oracle_sql() if text else {})


def _survey_oracles() -> dict[str, str]:
    return {
        "event_groups": _with() + """
select event_group_id, event_group_name, cast(year(start_date) as int) as event_group_year
from fx_event_groups""",
        "locations_adapter": _with(SQL_MK) + f"""
select start_date, location_name, event_type, {STRATA_SQL},
  {_sql_sums()}
from mk""",
        "site_code_filter": _sql_abs_cover_long(where_extra=f"and {SITE_CODE_SQL.replace('location_name', 'l.location_name')}"),
        "event_group_filter": _sql_abs_cover_long(
            where_extra="and upper(replace(replace(e.event_group_id, '{', ''), '}', '')) = 'AUTOMOBILE'"),
        "numeric_coercion": _with() + f"""
select point_id, percentcover_raw, {_sql_number('percentcover_raw')} as percentcover
from fx_vegetation""",
        "strata_check": _with(SQL_MK) + f"""
select region, segment, location_name, event_type, {STRATA_SQL},
  {_sql_sums()}
from mk""",
        "point_count_long": _sql_point_long("count"),
        "point_count_wide": _sql_point_wide("count"),
        "point_sum_long": _sql_point_long("sum"),
        "point_sum_wide": _sql_point_wide("sum"),
        "relcover_check": _sql_relcover(),
        "pilot_point_sum_long": _sql_point_long("sum", PILOT_POINT_KEYS_SQL),
        "pilot_relcover_check": _sql_relcover(PILOT_POINT_KEYS_SQL),
        "point_sum_by_group": _sql_group("coalesce(sum(percentcover), 0.0) as sum_percentcover",
                                         GROUP_KEYS_SQL + ", speciescode"),
        "point_count_by_group": _sql_group("count(percentcover_raw) as n_percentcover",
                                           GROUP_KEYS_SQL + ", speciescode"),
        "relcover_by_group": _sql_group(
            "coalesce(sum(percentcover), 0.0) as sum_relcover, "
            "coalesce(sum(percentcover), 0.0) = 100.0 as relcover_is_100", GROUP_KEYS_SQL),
        "point_cover_rows": _with(_sql_abs_rows()) + "select * from point_rows",
        "abs_cover_rows": _with(_sql_abs_rows()) + """
select * replace (round(abs_cover, 6) as abs_cover) from abs_rows""",
        "abs_cover_long": _sql_abs_cover_long(),
        "abs_cover_wide": _sql_abs_wide(),
        "abs_cover_site_order": _sql_abs_wide(),
        "abs_cover_by_group": _sql_abs_cover_long(extra="event_group_id, "),
        "abs_cover_by_stratum": _with(SQL_MK, SQL_ST) + "select * from st",
        "stratum_fanout": _with(SQL_MK) + f"""
select mk.location_name, mk.event_id, {_sql_covers_and_abs('mk.')}
from mk join fx_vegetation v on v.point_id = mk.point_id
where mk.event_type = 'Marker Visit' and {SITE_CODE_SQL.replace('location_name', 'mk.location_name')}""",
        "stratum_with_region": _with(SQL_MK) + f""",
lk AS (
select case when i < 20 then 'Turner River' when i < 36 then 'Shark Slough'
            else 'Taylor Slough' end as region,
  cast(i // 4 + 1 as int) as seg, cast(i % 4 + 1 as int) as pt
from range(56) r(i)),
pilot AS (
select location_name, event_id, {_sql_covers_and_abs()}
from mk where event_type = 'Marker Visit' and {SITE_CODE_SQL})
select lk.region, pilot.*
from pilot join lk
  on try_cast(regexp_extract(pilot.location_name, '^\\s*([0-9]+)[_-]([0-9]+)\\s*$', 1) as int) = lk.seg
 and try_cast(regexp_extract(pilot.location_name, '^\\s*([0-9]+)[_-]([0-9]+)\\s*$', 2) as int) = lk.pt""",
        "region_list": _with(SQL_MK, SQL_ST) + """
select region, min(location_name) as first_location_name,
  cast(row_number() over (order by min(location_name) asc nulls last, region asc nulls last) as int)
    as region_order
from st group by region""",
        "chart_series": _sql_chart_series(),
        "chart_series_region": f"select * from ({_sql_chart_series()}) where region = 'AMERICA'",
        "site_order": """
select distinct location_name, segment_number, point_number,
  dense_rank() over (order by segment_number, point_number) as position
from (select cast(c_custkey % 15 + 1 as varchar) || '_' || cast(c_custkey // 15 % 4 + 1 as varchar) as location_name,
  cast(c_custkey % 15 + 1 as int) as segment_number, cast(c_custkey // 15 % 4 + 1 as int) as point_number
from customer)""",
        "normalised_markers": """
select 'AB-' || o_orderkey as point_id, 'EV-' || o_custkey as event_id,
  case when o_orderkey % 5 <> 0 then cast(o_orderkey % 77 as double) / 4 end as distance,
  case when o_orderkey % 2 = 0 then 'GPS' else 'Tape' end as method,
  cast(null as double) as mangroveside_cover_overall,
  case when o_orderkey % 3 = 1 then cast(o_orderkey % 90 as double) + 0.5 end as mangroveside_cover_tree,
  cast(null as double) as mangroveside_cover_shrub, cast(null as double) as mangroveside_cover_herb,
  cast(null as double) as marshside_cover_overall, cast(null as double) as marshside_cover_tree,
  cast(null as double) as marshside_cover_shrub, cast(o_orderkey % 100 as double) as marshside_cover_herb
from orders""",
        "normalised_event_dates": """
select 'EV-' || c_custkey as event_id, case when c_custkey % 7 in (1, 2, 3, 4) then make_date(
  cast(case c_custkey % 7 when 3 then 2011 when 4 then 2012 else 2010 end as int),
  cast(c_custkey % 12 + 1 as int), cast(c_custkey % 28 + 1 as int)) end as start_date
from customer""",
        "rejected_values": """
select 'markers' as table_name, 'AB-' || o_orderkey as row_key, 'mangroveside_cover_tree' as column_name,
  'trace' as raw_value from orders where o_orderkey % 3 = 0
union all
select 'events', 'EV-' || c_custkey, 'start_date', '13/40/2010' from customer where c_custkey % 7 = 0""",
        "strata_check_by_group": _with(SQL_MK) + f"""
select mk.event_group_id, point_id, region, segment, location_name, event_type, {STRATA_SQL},
  {_sql_sums()}
from mk join fx_event_groups g on mk.event_group_id = g.event_group_id""",
        "relcover_fractional": _sql_folded(FRACTIONAL_ROWS, "percentcover") + FOLDED_CHECK,
        "relcover_fractional_wide": _sql_folded(FRACTIONAL_ROWS, "percentcover") + FOLDED_CHECK,
        "relcover_thirds": _sql_folded(THIRDS_ROWS, "percentcover") + FOLDED_CHECK,
        "point_sum_thirds": _sql_folded(THIRDS_ROWS, "percentcover") + f"""
select {POINT_KEYS_SQL}, speciescode, total as sum_percentcover from sp""",
        "abs_cover_long_exact": _with(_sql_abs_rows()) + f"""
select communitytype, vegetationtype, speciescode, location_name,
  coalesce({_sql_exact_sum('abs_cover')}, 0.0) as abs_cover
from abs_rows where {_not_null('communitytype, vegetationtype, speciescode, location_name')}
group by communitytype, vegetationtype, speciescode, location_name""",
        "pilot_point_count_long": _sql_point_long("count", PILOT_POINT_KEYS_SQL),
        "strata_check_positions": _with(SQL_MK) + f"""
select row_number() over (order by location_name nulls first, point_id) as position, location_name, point_id,
  sum_mangrove, sum_marsh
from (select *, {_sql_sums()} from mk)""",
        "abs_cover_by_stratum_positions": _with(SQL_MK, SQL_ST) + """
select row_number() over (order by location_name nulls first, start_date nulls first, point_id) as position,
  location_name, start_date, point_id, marshside_cover_overall from st""",
        "distance_summary_positions": _with(SQL_MK, SQL_DR) + """
select row_number() over (order by try_cast(regexp_extract(segment, '([0-9]+)', 1) as bigint) nulls last,
  event_group_id, region, segment) as position, event_group_id, region, segment,
  count(distance) as rec_count, min(distance) as min_difference
from dr where event_group_id is not null and region is not null and segment is not null
group by event_group_id, region, segment""",
        "distance_rows_positions": _with(SQL_MK, SQL_DR) + """
select row_number() over (order by segment nulls first, location_name nulls first, event_type nulls first, point_id)
  as position, segment, location_name, event_type, point_id, distance from dr""",
        "point_sum_positions": _with(SQL_MK, SQL_PR) + f"""
, cells AS (
select {POINT_KEYS_SQL}, speciescode, coalesce(sum(percentcover), 0.0) as sum_percentcover
from pr where {_not_null(POINT_KEYS_SQL + ', speciescode')} group by {POINT_KEYS_SQL}, speciescode),
places AS (
select *, row_number() over (order by {POINT_KEYS_SQL}) as row_position
from (select distinct {POINT_KEYS_SQL} from cells)),
species AS (
select cast(i + 1 as int) as column_position, 'SP' || lpad(cast(i as varchar), 2, '0') as speciescode
from range(12) r(i))
select row_position, {', '.join('places.' + c.strip() for c in POINT_KEYS_SQL.split(','))}, column_position,
  species.speciescode, sum_percentcover
from places cross join species left join cells using ({POINT_KEYS_SQL}, speciescode)""",
        "abs_cover_site_positions": _with(_sql_abs_rows()).replace(
            """lpad(cast(cast(floor(n_nationkey / 4) as int) + 1 as varchar(10)), 2, '0')
    || '_' || cast(n_nationkey % 4 + 1 as varchar(10)) as location_name""",
            """cast(n_nationkey % 14 + 1 as varchar) || '_' || cast(n_nationkey // 14 + 1 as varchar) as location_name""") + """
, cells AS (
select communitytype, vegetationtype, speciescode, location_name, round(coalesce(sum(abs_cover), 0.0), 6) as abs_cover
from abs_rows where communitytype is not null and vegetationtype is not null and speciescode is not null
group by all),
sites AS (
select cast(row_number() over (order by k % 14, k // 14) as int) as column_position,
  cast(k % 14 + 1 as varchar) || '_' || cast(k // 14 + 1 as varchar) as location_name from range(25) r(k))
select communitytype, vegetationtype, speciescode, column_position, sites.location_name, abs_cover
from (select distinct communitytype, vegetationtype, speciescode from cells) cross join sites
left join cells using (communitytype, vegetationtype, speciescode, location_name)""",
        "segment_sort_key": _with(SQL_MK, SQL_DR) + """
select distinct segment, try_cast(regexp_extract(segment, '([0-9]+)', 1) as bigint) as segment_number
from dr""",
        "distance_rows": _with(SQL_MK, SQL_DR) + "select * from dr",
        "distance_summary": _sql_distance(False),
        "distance_ci": _sql_distance(True),
    }
