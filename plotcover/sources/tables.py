"""Loading the five survey tables (op S1).

Tables come from Parquet (one folder or file per table) or a JDBC database.
Column names are normalised to the lower-case names of ``plotcover.schema``,
identifiers (GUIDs) to upper case without braces, and text dates to dates —
here and nowhere else, so every operator sees one data model.

Normalising an id wraps the column in an expression, and a filter on an
expression cannot reach the Parquet scan.  So normalisation is an ingest
step: ``read_jdbc_tables`` (or ``read_parquet_tables(normalise_ids=True)``)
on the raw export, then ``write_tables`` once; day-to-day reads of the
written tables use ``read_parquet_tables`` as is, and a group or id filter
becomes a pushed-down equality.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotcover.bounds import forget_bounds
from plotcover.functions.cover import no_nan, to_number
from plotcover.functions.text import normalise_id
from plotcover.schema import SCHEMAS

ID_COLUMNS = ("location_id", "event_group_id", "event_id", "point_id")

# Source column names that differ from the engine's after lower-casing.
SOURCE_RENAMES = {
    "percentcover": "percentcover_raw",
    "globalid": "location_id",
    "loc_name_short": "location_name",
}


@dataclass(frozen=True)
class SurveyTables:
    """The survey data model: one DataFrame per table."""

    locations: DataFrame
    events: DataFrame
    markers: DataFrame
    vegetation: DataFrame
    event_groups: DataFrame | None = None

    def with_(self, **tables: DataFrame) -> "SurveyTables":
        return replace(self, **tables)


# How dates are written in exports besides ISO: month first, with or without a
# time.  A source that writes them otherwise passes its own formats.
DATE_FORMATS = ("M/d/yyyy", "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy h:mm:ss a")


def read_date(col: Column, kind: T.DataType, date_formats: Sequence[str] = DATE_FORMATS) -> Column:
    """A date from text (ISO, or the first of ``date_formats`` that fits), or
    from a timestamp; text that is no date gives NULL."""
    if not isinstance(kind, T.StringType):
        return F.to_date(col)
    text = F.trim(col)
    return F.coalesce(F.try_to_timestamp(text), *[F.try_to_timestamp(text, F.lit(f)) for f in date_formats]).cast("date")


def _renamed(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(SOURCE_RENAMES.get(c.lower(), c.lower())) for c in df.columns])


def normalise_table(df: DataFrame, name: str, normalise_ids: bool = True,
                    date_formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Lower-case and rename columns, then bring each known column to its
    schema type; unknown columns pass through, missing ones become NULL.
    Reading forgives: text that is not a number or a date is missing, and so
    is NaN (op E3); ``rejected_values`` lists it."""
    df = _renamed(df)
    present = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for field in SCHEMAS[name].fields:
        if field.name not in present:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        col = F.col(field.name)
        kind = present[field.name]
        if normalise_ids and field.name in ID_COLUMNS and isinstance(kind, T.StringType):
            col = normalise_id(col)
        elif isinstance(field.dataType, T.DateType) and not isinstance(kind, T.DateType):
            col = read_date(col, kind, date_formats)
        elif field.name == "percentcover_raw":
            # kept as read: the coercion (op E3) needs the raw value; only NaN is missing
            col = no_nan(col) if isinstance(kind, (T.DoubleType, T.FloatType)) else col
        elif isinstance(field.dataType, T.DoubleType):
            col = to_number(col, kind)
        elif present[field.name] != field.dataType and not (
            field.name in ID_COLUMNS and not isinstance(present[field.name], T.StringType)
        ):
            col = col.cast(field.dataType)
        out.append(col.alias(field.name))
    extra = [F.col(f"`{c}`") for c in df.columns if c not in SCHEMAS[name].fieldNames()]
    return df.select(*out, *extra)


# The column each table's rows are named by.
TABLE_KEYS = {"locations": "location_id", "event_groups": "event_group_id", "events": "event_id",
              "markers": "point_id", "vegetation": "point_id"}


def rejected_values(df: DataFrame, name: str, normalise_ids: bool = True,
                    date_formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """table_name, row_key, column_name, raw_value: every text of a source
    table that should be a date or a number, is not blank, and is read as
    missing.  One pass over the raw table, no shuffle; the raw table is the one
    given to ``normalise_table``."""
    df = _renamed(df)
    present = {f.name: f.dataType for f in df.schema.fields}
    checks = []
    for field in SCHEMAS[name].fields:
        if not isinstance(present.get(field.name), T.StringType):
            continue
        col = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            value = read_date(col, present[field.name], date_formats)
        elif isinstance(field.dataType, T.DoubleType) or field.name == "percentcover_raw":
            value = to_number(col, present[field.name])
        else:
            continue
        bad = (F.trim(col) != "") & value.isNull()
        checks.append(F.when(bad, F.struct(F.lit(field.name).alias("column_name"), col.alias("raw_value"))))
    key = F.col(TABLE_KEYS[name])
    if normalise_ids and isinstance(present[TABLE_KEYS[name]], T.StringType):
        key = normalise_id(key)
    rows = df.select(F.lit(name).alias("table_name"), key.cast("string").alias("row_key"),
                     F.inline(F.array_compact(F.array(*checks))) if checks else F.lit(None).alias("column_name"))
    return rows if checks else rows.withColumn("raw_value", F.lit(None).cast("string")).limit(0)


def read_as_stored(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored table with its partition columns as the text in their folder
    names: a group id '001' must not come back as the number 1."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key, "true")
    spark.conf.set(key, "false")
    try:
        return spark.read.format(fmt).load(path)
    finally:
        spark.conf.set(key, before)


def read_parquet_tables(spark: SparkSession, paths: dict[str, str],
                        normalise_ids: bool = False,
                        date_formats: Sequence[str] = DATE_FORMATS) -> SurveyTables:
    """Read each table from its Parquet path: keys ``locations``, ``events``,
    ``markers``, ``vegetation`` and optionally ``event_groups``.  Ids are
    taken as stored unless ``normalise_ids`` (raw exports)."""
    forget_bounds()
    frames = {name: normalise_table(read_as_stored(spark, path), name, normalise_ids, date_formats)
              for name, path in paths.items()}
    return SurveyTables(**frames)


# Tables of points: too large to be read by one task.
LARGE_TABLES = ("markers", "vegetation")


def guid_predicates(column: str, parts: int = 16) -> list[str]:
    """WHERE clauses that split a table by the leading hex digits of a GUID
    column (braces or not, any case); the first also takes what is no GUID.
    ``parts`` is a power of 16, so that each clause is a list of prefixes of
    one length."""
    digits, n = 0, 1
    while n < parts:
        digits, n = digits + 1, n * 16
    if n != parts or parts < 16:
        raise ValueError("the number of parts must be a power of 16")
    head = f"UPPER(SUBSTRING(REPLACE(REPLACE({column}, '{{', ''), '}}', ''), 1, {digits}))"
    clauses = [f"{head} = '{i:0{digits}X}'" for i in range(parts)]
    known = ", ".join(f"'{i:0{digits}X}'" for i in range(parts))
    clauses[0] = f"({clauses[0]} OR {column} IS NULL OR {head} NOT IN ({known}))"
    return clauses


def key_cuts(keys: DataFrame, column: str, parts: int) -> list:
    """At most ``parts - 1`` values that cut a key column into ranges of equal
    row counts, measured: keys are ranked in a distributed sort and the first of
    each part taken.  ``keys`` may be the key column read over JDBC, or an
    earlier ingest of the table.  A value that fills several parts cuts once."""
    from plotcover.operators.ranks import with_position
    known = keys.select(column).where(F.col(column).isNotNull())
    ranked = with_position(known, [column])
    size = max(1, -(-ranked.count() // parts))
    cuts = ranked.where((F.col("position") > 1) & ((F.col("position") - 1) % size == 0)).select(column).distinct()
    return sorted(r[0] for r in cuts.collect())


def range_predicates(column: str, cuts: Sequence) -> list[str]:
    """WHERE clauses that split a table at ``cuts`` into ranges of the bare key
    column, which an index on it can serve; the first also takes missing keys.
    Each row meets one clause if the cuts ascend in the source's own order (for
    GUIDs of one letter case they do in any common collation)."""
    def literal(value) -> str:
        return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)

    marks = [literal(c) for c in cuts]
    if not marks:
        return ["1 = 1"]
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(marks, marks[1:])]
    return [f"({column} < {marks[0]} OR {column} IS NULL)", *between, f"{column} >= {marks[-1]}"]


def read_jdbc_tables(spark: SparkSession, url: str, tables: dict[str, str],
                     properties: dict[str, str] | None = None,
                     normalise_ids: bool = True,
                     splits: dict[str, list[str] | dict[str, str]] | None = None,
                     date_formats: Sequence[str] = DATE_FORMATS) -> SurveyTables:
    """Read each table over JDBC; ``tables`` maps our table names to the
    source's (e.g. ``{'markers': 'tbl_MarkerData', ...}``).  ``splits`` says
    per table how the read is divided among tasks: a list of predicates (see
    ``range_predicates``, which an index can serve, or ``guid_predicates``, which
    needs no measured keys but scans), or options ``column``, ``lowerBound``, ``upperBound``
    and ``numPartitions`` for a numeric key.  Markers and vegetation must be
    split: read by one task, they would not fit it."""
    splits = splits or {}
    whole = [name for name in LARGE_TABLES if name in tables and not splits.get(name)]
    if whole:
        raise ValueError(f"{', '.join(whole)}: give splits, one task can't read them")
    forget_bounds()
    frames = {}
    for name, source in tables.items():
        split = splits.get(name)
        if isinstance(split, list):
            df = spark.read.jdbc(url, source, predicates=split, properties=properties or {})
        else:
            df = spark.read.jdbc(url, source, properties=properties or {}, **(split or {}))
        frames[name] = normalise_table(df, name, normalise_ids, date_formats)
    return SurveyTables(**frames)


def write_tables(t: SurveyTables, out_dir: str, group_layout: bool = False) -> dict[str, str]:
    """Ingest: write the (normalised) tables as Parquet, events partitioned
    by event group so a one-group report reads one folder.  Returns the
    paths for ``read_parquet_tables``.

    ``group_layout`` also writes markers and species rows with the event
    group of their visit, partitioned by it (one join of each at ingest), so
    a report or refresh of some groups reads only those groups' folders of
    every table.  Rows without a group keep a folder of their own: reports by
    group do not show them, all others do.  Rows are gathered by group before
    they are written, a large group in several files."""
    tables = {name: getattr(t, name) for name in
              ("locations", "events", "markers", "vegetation", "event_groups")}
    if group_layout and t.event_groups is None:
        raise ValueError("the group layout needs a source with event groups")
    if group_layout:
        visit_groups = t.events.where(F.col("event_group_id").isNotNull()).select(
            "event_id", "event_group_id")
        markers = t.markers.join(visit_groups, "event_id", "left")
        tables["markers"] = markers
        tables["vegetation"] = t.vegetation.join(
            markers.select("point_id", "event_group_id"), "point_id", "left")
    paths = {}
    for name, df in tables.items():
        if df is None:
            continue
        path = f"{out_dir.rstrip('/')}/{name}"
        grouped = "event_group_id" in df.columns and name != "event_groups"
        writer = (df.hint("rebalance", "event_group_id") if grouped else df).write.mode("overwrite")
        if grouped:
            writer = writer.partitionBy("event_group_id")
        writer.parquet(path)
        paths[name] = path
    return paths
