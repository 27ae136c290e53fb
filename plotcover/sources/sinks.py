"""Named result datasets (ops S5, S6), committed by a manifest.

The reference writes one workbook per event group with one sheet per
result.  Here each result is one dataset named after its sheet, written for
all event groups in one job and partitioned by ``event_group_id`` (not by the
group's name, which need not be unique, D16).

Every run writes to folders of its own, then commits them all at once: a
manifest names the live folders of each result and the groups that are live in
each.  Until the manifest is there readers see what was before, so a job killed
while it writes changes nothing.  A full run replaces its results; a refresh
names the groups it touched, and these are replaced in every result, also where
nothing is left of them.  Manifests and folders are small in number: a manifest
holds one name a group and result.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from plotcover.session import ensure_checkpoint_dir

# The sheet names of the report, used as dataset names.
SHEET_EVENT_GROUPS = "EventGroups"
SHEET_STRATA_CHECK = "QAQC_RelCovByStrata"
SHEET_POINT_COUNT = "QAQC_RelCoverByPoint_Count"
SHEET_POINT_SUM = "QAQC_RelCoverByPoint_Sum"
SHEET_ABS_COVER = "SOP8-2-AbsCov"
SHEET_STRATUM = "SOP8-3-AbsCovByStratum"
SHEET_DISTANCE = "SOP8-1"


@dataclass(frozen=True)
class Written:
    """A result of one run, written but not yet committed."""
    name: str
    folder: str                     # below the output folder
    fmt: str
    schema: str                     # JSON
    groups: tuple[str, ...] | None  # names of its group folders, None if not grouped


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(sc._jsc.hadoopConfiguration()), hpath


def _listed(spark: SparkSession, path: str) -> list[str]:
    fs, hpath = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath)) if fs.exists(hpath) else []


def new_run() -> str:
    return f"run-{uuid.uuid4().hex}"


def stage_result(df: DataFrame, out_dir: str, name: str, run: str,
                 partition_by: Sequence[str] = ("event_group_id",),
                 sort_within: Sequence[str] = (), fmt: str = "parquet") -> Written:
    """Write one result of a run to a folder of its own.

    Rows are rebalanced by group first, so a group is a few files however many
    tasks made it, and Spark splits a large one; they are sorted within a file
    by ``sort_within``."""
    schema = df.schema.json()
    parts = [c for c in partition_by if c in df.columns]
    if parts:
        df = df.hint("rebalance", *parts)
    if sort_within:
        df = df.sortWithinPartitions(*parts, *sort_within)
    writer = df.write.mode("errorifexists")
    if parts:
        writer = writer.partitionBy(*parts)
    folder = f"{name}/{run}"
    writer.format(fmt).save(f"{out_dir.rstrip('/')}/{folder}")
    groups = tuple(n for n in _listed(df.sparkSession, f"{out_dir.rstrip('/')}/{folder}") if "=" in n) \
        if parts else None
    return Written(name, folder, fmt, schema, groups)


MANIFESTS = "_manifests"


def manifest(spark: SparkSession, out_dir: str, version: int | None = None) -> tuple[int, dict]:
    """The newest (or a given) manifest and its version; version 0, nothing, if
    there is none."""
    root = f"{out_dir.rstrip('/')}/{MANIFESTS}"
    versions = [int(n[:-5]) for n in _listed(spark, root) if n.endswith(".json") and n[:-5].isdigit()]
    if version is None and not versions:
        return 0, {}
    version = max(versions) if version is None else version
    fs, path = _fs(spark, f"{root}/{version:012d}.json")
    stream = fs.open(path)
    try:
        return version, json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def group_folder(spark: SparkSession, group: str | None) -> str:
    """The name of a group's folder in a partitioned dataset."""
    if group is None:
        return "event_group_id=__HIVE_DEFAULT_PARTITION__"
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"event_group_id={escape(str(group))}"


def commit(spark: SparkSession, out_dir: str, written: Sequence[Written],
           touched: Sequence[str] | None = None) -> int:
    """Make the results of a run the live ones, all at once.  ``touched`` names
    the groups a refresh covers: they leave the older folders of these results,
    whether or not the new ones hold them.  A file appears under its final name
    or not at all, and no version is written twice: of two runs that end
    together the later one builds on the other."""
    gone = None if touched is None else {group_folder(spark, g) for g in touched}
    root = f"{out_dir.rstrip('/')}/{MANIFESTS}"
    while True:
        version, live = manifest(spark, out_dir)
        for w in written:
            kept = []
            for old in live.get(w.name, []) if gone is not None and w.groups is not None else []:
                groups = [g for g in old["groups"] or [] if g not in gone]
                if groups:
                    kept.append({**old, "groups": groups})
            live[w.name] = [*kept, {"folder": w.folder, "format": w.fmt, "schema": w.schema,
                                    "groups": None if w.groups is None else list(w.groups)}]
        fs, temporary = _fs(spark, f"{root}/.{uuid.uuid4().hex}")
        _, final = _fs(spark, f"{root}/{version + 1:012d}.json")
        stream = fs.create(temporary, False)
        try:
            stream.write(bytearray(json.dumps(live).encode()))
        finally:
            stream.close()
        if not fs.exists(final) and fs.rename(temporary, final):
            return version + 1
        fs.delete(temporary, False)


def write_result(df: DataFrame, out_dir: str, name: str,
                 partition_by: Sequence[str] = ("event_group_id",),
                 sort_within: Sequence[str] = (), fmt: str = "parquet",
                 touched: Sequence[str] | None = None) -> str:
    """Write and commit one result; returns the folder of this run."""
    staged = stage_result(df, out_dir, name, new_run(), partition_by, sort_within, fmt)
    commit(df.sparkSession, out_dir, [staged], touched)
    return f"{out_dir.rstrip('/')}/{staged.folder}"


def read_result(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """The live rows of a result.  Group ids come back as they were written (a
    group '001' is not the number 1)."""
    entries = manifest(spark, out_dir)[1].get(name)
    if not entries:
        raise FileNotFoundError(f"no committed result {name!r} in {out_dir}")
    frames = []
    for e in entries:
        folder, schema = f"{out_dir.rstrip('/')}/{e['folder']}", T.StructType.fromJson(json.loads(e["schema"]))
        reader = spark.read.schema(schema).format(e["format"])
        if e["groups"] is None:
            frames.append(reader.load(folder))
        elif e["groups"]:
            frames.append(reader.option("basePath", folder).load([f"{folder}/{g}" for g in e["groups"]])
                          .select(*schema.fieldNames()))
        else:
            frames.append(spark.createDataFrame([], schema))
    return reduce(DataFrame.unionByName, frames)


def remove_stale(spark: SparkSession, out_dir: str, keep: int = 1) -> list[str]:
    """Delete what the ``keep`` newest manifests do not name: older manifests
    and the folders of replaced or unfinished runs.  Only call it when no run is
    writing; readers of the kept versions go on."""
    newest, _ = manifest(spark, out_dir)
    if not newest:
        return []
    root = out_dir.rstrip("/")
    kept = range(max(1, newest - keep + 1), newest + 1)
    known = set(_listed(spark, f"{root}/{MANIFESTS}"))
    live = {e["folder"] for v in kept if f"{v:012d}.json" in known
            for entries in manifest(spark, out_dir, v)[1].values() for e in entries}
    names = set(manifest(spark, out_dir)[1])
    gone = [f"{n}/{run}" for n in sorted(names) for run in _listed(spark, f"{root}/{n}")
            if run.startswith("run-") and f"{n}/{run}" not in live]
    gone += [f"{MANIFESTS}/{f}" for f in sorted(known) if f not in {f"{v:012d}.json" for v in kept}]
    for path in gone:
        remove_folder(spark, f"{root}/{path}")
    return gone


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name under the shared checkpoint folder, for tables a
    job writes for itself and removes when it is done."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/plotcover-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: the
    lineage is cut there, so a lost executor costs a re-read of this table,
    not a re-run of the joins behind it, and later reads prune columns.
    ``folder`` (from ``scratch_folder``) groups tables a caller removes
    together with ``remove_folder`` once nothing reads them any more."""
    spark = df.sparkSession
    path = f"{folder or scratch_folder(spark)}/{name}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder on whatever file system holds it (HDFS, object store
    or local), through the session's Hadoop configuration."""
    fs, hpath = _fs(spark, path)
    return bool(fs.delete(hpath, True))
