"""Survey tables derived from the driver's TPC-H-style test tables.

The test data has no survey tables of its own, so each survey table is a
projection of one test table (the mapping is fixed in FIXTURES.md §2):

* locations    <- nation x region    (25 rows, fixed by the nation table)
* event_groups <- customer, one row per market segment
* events       <- customer           (a visit per customer)
* markers      <- orders             (a point per order)
* vegetation   <- lineitem           (a species row per line item)

Every derivation is a narrow projection (no shuffle) except event groups,
which is one small aggregate with map-side combine.  The oracle builds the
same columns in SQL; this module builds them with the DataFrame API.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plotcover.bounds import broadcast_if_bounded
from plotcover.sources.tables import SurveyTables

# Fixed values of the fixture mapping (FIXTURES.md §2).
SEGMENT_GROUP_MARKETS = ("AUTOMOBILE", "BUILDING")
MISSING_SEGMENT_NATION = 24


_handles: dict[tuple[int, str, str], DataFrame] = {}


def stored_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy handle on one test table, made once per session and folder, as a
    catalog table would be: it holds the file listing and schema, no data."""
    key = (id(spark), sf_dir, name)
    if key not in _handles:
        _handles[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _handles[key]


def _double(c: Column) -> Column:
    return c.cast("double")


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(~cond, value)


def fixture_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = stored_table(spark, sf_dir, "nation")
    region = stored_table(spark, sf_dir, "region")
    k = F.col("n_nationkey")
    segment = _null_when(
        k == F.lit(MISSING_SEGMENT_NATION),
        F.concat(F.lit("Segment "), (k % 14 + 1).cast("string")),
    )
    name = F.concat(
        F.lpad((F.floor(k / 4) + 1).cast("int").cast("string"), 2, "0"),
        F.lit("_"),
        (k % 4 + 1).cast("string"),
    )
    region = broadcast_if_bounded(region.select("r_regionkey", "r_name"))
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        k.cast("int").alias("location_id"),
        F.col("r_name").alias("region"),
        segment.alias("segment"),
        name.alias("location_name"),
    )


def _visit_date(key: Column) -> Column:
    return F.make_date(
        (F.lit(2009) + key % 17).cast("int"),
        (F.lit(1) + key % 12).cast("int"),
        (F.lit(1) + key % 28).cast("int"),
    )


def fixture_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ck = F.col("c_custkey")
    return stored_table(spark, sf_dir, "customer").select(
        ck.alias("event_id"),
        F.col("c_mktsegment").alias("event_group_id"),
        F.col("c_nationkey").cast("int").alias("location_id"),
        F.when(ck % 10 < 8, F.lit("Marker Visit")).otherwise(F.lit("Segment Visit")).alias("event_type"),
        _visit_date(ck).alias("start_date"),
    )


def fixture_event_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = stored_table(spark, sf_dir, "customer")
    gid = F.col("event_group_id")
    prefix = F.when(gid.isin(*SEGMENT_GROUP_MARKETS), F.lit("Segment ")).otherwise(F.lit("Index "))
    return (
        customer.groupBy(F.col("c_mktsegment").alias("event_group_id"))
        .agg(F.min(_visit_date(F.col("c_custkey"))).alias("start_date"),
             F.max(_visit_date(F.col("c_custkey"))).alias("end_date"))
        .select(gid, F.concat(prefix, gid).alias("event_group_name"), "start_date", "end_date",
                F.concat(F.lit("Assessment "), F.substring(gid, 1, 1)).alias("assessment"))
    )


def fixture_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = F.col("o_orderkey")
    every13 = ok % 13 == 0
    mangrove_tree = ok % 5 * 10
    mangrove_shrub = ok % 4 * 15
    marsh_tree = ok % 3 * 20
    marsh_shrub = ok % 6 * 5
    return stored_table(spark, sf_dir, "orders").select(
        ok.alias("point_id"),
        F.col("o_custkey").alias("event_id"),
        _null_when(ok % 11 == 0, _double((ok * 37) % 401) / 4 - 50).alias("distance"),
        F.when(ok % 2 == 0, F.lit("GPS")).otherwise(F.lit("Tape")).alias("method"),
        _double((ok * 7) % 21 * 5).alias("mangroveside_cover_overall"),
        _null_when(every13, _double(mangrove_tree)).alias("mangroveside_cover_tree"),
        _null_when(every13, _double(mangrove_shrub)).alias("mangroveside_cover_shrub"),
        F.when(every13, F.lit(None).cast("double"))
        .when(ok % 3 == 0, F.lit(5.0))
        .otherwise(_double(100 - mangrove_tree - mangrove_shrub))
        .alias("mangroveside_cover_herb"),
        _double((ok * 11) % 21 * 5).alias("marshside_cover_overall"),
        _double(marsh_tree).alias("marshside_cover_tree"),
        _null_when(ok % 7 == 0, _double(marsh_shrub)).alias("marshside_cover_shrub"),
        _double(100 - marsh_tree - marsh_shrub).alias("marshside_cover_herb"),
    )


def fixture_vegetation(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    line = F.col("l_linenumber")
    part = F.col("l_partkey")
    qty = F.col("l_quantity")
    return stored_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("point_id"),
        F.when(flag == "A", F.lit("Mangrove")).when(flag == "N", F.lit("Marsh"))
        .otherwise(F.lit("Upland")).alias("communitytype"),
        F.when(line <= 2, F.lit("Tree")).when(line <= 4, F.lit("Shrub"))
        .when(line <= 6, F.lit("Herb")).otherwise(F.lit("Vine")).alias("vegetationtype"),
        _null_when(part % 97 == 0,
                   F.concat(F.lit("SP"), F.lpad((part % 12).cast("string"), 2, "0"))).alias("speciescode"),
        F.when(qty == 50, F.lit(None).cast("string")).when(qty == 49, F.lit("trace"))
        .otherwise(F.round(qty * 2).cast("int").cast("string")).alias("percentcover_raw"),
    )


_tables: dict[tuple[int, str], SurveyTables] = {}


def fixture_tables(spark: SparkSession, sf_dir: str) -> SurveyTables:
    """All five survey tables over the test tables in ``sf_dir`` (lazy
    DataFrames, built once per session and folder)."""
    key = (id(spark), sf_dir)
    if key not in _tables:
        _tables[key] = _build_tables(spark, sf_dir)
    return _tables[key]


def _build_tables(spark: SparkSession, sf_dir: str) -> SurveyTables:
    return SurveyTables(
        locations=fixture_locations(spark, sf_dir),
        events=fixture_events(spark, sf_dir),
        markers=fixture_markers(spark, sf_dir),
        vegetation=fixture_vegetation(spark, sf_dir),
        event_groups=fixture_event_groups(spark, sf_dir),
    )
