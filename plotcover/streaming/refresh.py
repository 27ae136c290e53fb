"""Incremental report refresh with Structured Streaming.

The reference rebuilds the report of each event group in a loop.  Here new
visits arrive as files in a landing folder (rows of the events table); a
streaming query reads them and, per micro-batch, re-runs the batch report
(``plans.report``) for exactly the event groups the batch touches.  Result
datasets are partitioned by group and committed by a manifest that names the
touched groups, so each refresh replaces just those, also where nothing is left
of them, and a replayed micro-batch (after a failure) gives the same result.

The touched groups stay in Spark: the tables are restricted by a semi-join
with the batch's distinct ids, normalised as the stored ones are, so a batch
may touch any number of groups.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from plotcover.bounds import broadcast_if_bounded, forget_bounds
from plotcover.functions.text import normalise_id
from plotcover.plans.report import write_report
from plotcover.sources import sinks
from plotcover.sources.tables import SurveyTables

def touched_groups(batch: DataFrame) -> DataFrame:
    """The distinct event groups of a batch of visits, ids as they are stored."""
    kept = batch.where(F.col("event_group_id").isNotNull())
    group = F.col("event_group_id")
    if isinstance(batch.schema["event_group_id"].dataType, T.StringType):
        group = normalise_id(group)
    return kept.select(group.alias("event_group_id")).distinct()


def restrict_to_groups(t: SurveyTables, groups: DataFrame) -> SurveyTables:
    """The tables seen through the groups in ``groups`` (event_group_id) only:
    visits and groups are semi-joined, markers and species rows follow through
    the joins (and are semi-joined on their partition column when stored in
    the group layout)."""
    # a broadcast list lets Spark prune the folders of other groups while it
    # runs; it only considers a list with a filter, so there is one that any
    # text passes
    if isinstance(groups.schema["event_group_id"].dataType, T.StringType):
        groups = groups.where(F.col("event_group_id") >= F.lit(""))
    groups = broadcast_if_bounded(groups)
    restricted = {}
    for name in ("events", "event_groups", "markers", "vegetation"):
        df = getattr(t, name)
        if df is not None and "event_group_id" in df.columns:
            restricted[name] = df.join(groups, "event_group_id", "left_semi")
    return t.with_(**restricted)


def refresh_batch(batch: DataFrame, batch_id: int, load_tables: Callable[[], SurveyTables],
                  out_dir: str, confidence: float = 0.95) -> bool:
    """foreachBatch body: re-run the report for the groups in ``batch``.
    Whether there was any."""
    spark = batch.sparkSession
    folder = sinks.scratch_folder(spark)
    try:
        groups = sinks.materialize(touched_groups(batch), "touched_groups", folder)
        # group ids are a catalogue: the manifest names them
        touched = [r.event_group_id for r in groups.collect()]
        if not touched:
            return False
        forget_bounds()          # new visits: the tables' sizes are proven again
        write_report(restrict_to_groups(load_tables(), groups), out_dir, confidence, touched=touched)
        sinks.remove_stale(spark, out_dir, keep=2)
    finally:
        sinks.remove_folder(spark, folder)
    return True


def start_refresh_stream(spark: SparkSession, landing_dir: str,
                         load_tables: Callable[[], SurveyTables], out_dir: str,
                         checkpoint_location: str, confidence: float = 0.95,
                         available_now: bool = False,
                         processing_time: str = "5 minutes",
                         schema=None) -> StreamingQuery:
    """Start the refresh stream over new event files in ``landing_dir``
    (Parquet files directly in that folder).

    ``load_tables`` must read the current tables (including the new visits)
    each time it is called; ``checkpoint_location`` is the stream's progress
    log on shared storage.  ``schema`` defaults to the events table's."""
    schema = schema or load_tables().events.schema
    new_visits = spark.readStream.schema(schema).parquet(landing_dir)
    writer = (new_visits.writeStream
              .foreachBatch(lambda df, bid: refresh_batch(df, bid, load_tables, out_dir, confidence))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now \
        else writer.trigger(processingTime=processing_time)
    return writer.start()
