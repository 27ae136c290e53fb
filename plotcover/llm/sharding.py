"""Sharding by balanced label propagation (operator 2), DataFrame functions only.

Documents with equal texts are linked; an edge is cut when both ends lie in
different shards.  Shard sizes follow the ``rows`` law: row counts at most one
apart.

* A linked document starts in a shard given by its doc_id.  Documents with the
  same text and the same start move together as an *atom*; a text has at most
  24 x 16 atoms, so no atom and no neighbourhood grows without bound.
* Each round, an atom looks at the shards of its neighbours (the atoms of the
  same text) and wants to move where more of them are, among the shards that
  have room; atoms that the first choice can't hold look at the next.  Each
  shard takes as many of those as fit its quota, those of the smallest groups
  first (they come together with the fewest moves), then by gain.  Rounds end
  when nothing moves, however many that takes.  They do end: within a text,
  rows only move to shards that come earlier by (rows of the text there, turn),
  so the sums over its fullest shards grow with every move and have a bound.
* Documents without a link go wherever room is left, at no cost; so do those
  linked documents that their start put beyond a shard's quota.  That makes the
  counts exact.

Ranks (for quotas and gapless slots) are sums over buckets plus a row number
within a bucket, so no task sorts a whole shard.  A null text is linked to
other null texts and has no bytes.  Repeated rows are documents of their own.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotcover.llm.common import materialize
from plotcover.session import ensure_checkpoint_dir
from plotcover.sources.sinks import remove_folder, scratch_folder

N_SHARDS = 24
SPLIT = 16               # atoms of one text per shard it may start in
BUCKET_ROWS = 500
MAX_BUCKETS = 4000       # beyond this many a bucket grows instead: its rows are sorted, not held


def _buckets(rows: int, shards: int) -> int:
    return max(1, min(MAX_BUCKETS, -(-rows // (shards * BUCKET_ROWS))))


def _pick(values: list[int], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), (index + 1).cast("int"))


def before_bucket(df: DataFrame, keys: list[str], amount: Column) -> DataFrame:
    """``df`` with ``before``: the amount in earlier buckets of the same keys."""
    sums = df.groupBy(*keys, "bucket").agg(F.sum(amount).alias("in_bucket"))
    earlier = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*keys, "bucket",
                         F.coalesce(F.sum("in_bucket").over(earlier), F.lit(0)).alias("before"))
    return df.join(before, [*keys, "bucket"])


def propagate(atoms: DataFrame, caps: list[int]) -> DataFrame:
    """Move atoms (key, atom, n, shard) towards their neighbours' shards until
    none moves.  Only the last two rounds' tables are kept."""
    spark, shards = atoms.sparkSession, len(caps)
    folder = scratch_folder(spark)
    state = materialize(atoms, "atoms", folder)
    buckets = _buckets(state.count(), shards)
    nowhere = F.struct(*[F.lit(v).cast("long").alias(c) for c, v in
                         (("have", None), ("turn", None), ("shard", None), ("room", 0))])
    while True:
        loads = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        room = [max(0, c - loads.get(s, 0)) for s, c in enumerate(caps)]
        # ties between shards are broken by an order that differs from text to text
        turn = F.pmod(F.col("shard") + F.pmod(F.xxhash64("key"), F.lit(shards)), F.lit(shards))
        by_key = Window.partitionBy("key")
        choice = F.struct(F.col("have").alias("have"), (-turn).cast("long").alias("turn"),
                          F.col("shard").cast("long").alias("shard"),
                          _pick(room, F.col("shard")).alias("room"))
        seen = (state.repartition("key")
                .withColumn("links", F.sum("n").over(by_key))
                .withColumn("have", F.sum("n").over(Window.partitionBy("key", "shard")))
                .withColumn("open", F.sort_array(F.collect_set(
                    F.when(_pick(room, F.col("shard")) > 0, choice)).over(by_key), asc=False))
                # the atoms with the fewest neighbours about them are the first to go
                .withColumn("place", F.sum("n").over(
                    by_key.orderBy("have", -turn, "atom").rowsBetween(Window.unboundedPreceding, 0)))
                .withColumn("best", F.aggregate("open", nowhere, lambda held, shard: F.when(
                    held["room"] < F.col("place"),
                    F.struct(shard["have"].alias("have"), shard["turn"].alias("turn"),
                             shard["shard"].alias("shard"),
                             (held["room"] + shard["room"]).alias("room"))).otherwise(held))))
        gain = F.col("best.have") - F.col("have")
        wants = F.coalesce((F.col("best.shard") != F.col("shard"))
                           & ((gain > 0) | ((gain == 0) & (F.col("best.turn") > -turn))), F.lit(False))
        asked = seen.select(
            "key", "atom", "n", "shard", "links", wants.alias("wants"), gain.alias("gain"),
            F.when(wants, F.col("best.shard")).otherwise(F.col("shard")).cast("int").alias("to"),
            F.pmod(F.xxhash64("key", "atom"), F.lit(buckets)).alias("bucket"))
        amount = F.when(F.col("wants"), F.col("n")).otherwise(0)
        in_order = (Window.partitionBy("to", "bucket").orderBy(F.desc("wants"), "links", F.desc("gain"), "key", "atom")
                    .rowsBetween(Window.unboundedPreceding, 0))
        taken = (before_bucket(asked, ["to"], amount)
                 .withColumn("reached", F.col("before") + F.sum(amount).over(in_order)))
        moves = F.col("wants") & (F.col("reached") <= _pick(room, F.col("to")))
        old, folder = folder, scratch_folder(spark)
        state = materialize(taken.select(
            "key", "atom", "n", F.when(moves, F.col("to")).otherwise(F.col("shard")).alias("shard"),
            moves.alias("moved")), "atoms", folder)
        remove_folder(spark, old)
        if not state.where("moved").take(1):
            return state.select("key", "atom", "shard")
        state = state.drop("moved")


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    ensure_checkpoint_dir(docs.sparkSession)
    own = F.xxhash64("doc_id")
    base = materialize(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit("null")).alias("key"),
        F.pmod(own, F.lit(n_shards * SPLIT)).cast("int").alias("atom")), "documents")
    n = base.count()
    caps = [n // n_shards + (s < n % n_shards) for s in range(n_shards)]

    atoms = base.groupBy("key", "atom").agg(F.count("*").alias("n"))
    linked = atoms.withColumn("links", F.sum("n").over(Window.partitionBy("key"))).where("links > 1")
    placed = propagate(linked.select("key", "atom", "n",
                                     F.pmod(F.col("atom"), F.lit(n_shards)).alias("shard")), caps)

    # unlinked documents stand in pseudo-shard -1, spread over more buckets
    buckets = _buckets(n, n_shards)
    labelled = base.join(placed, ["key", "atom"], "left").select(
        "doc_id", "size", "text_crc32", "key", F.coalesce("shard", F.lit(-1)).alias("label"))
    labelled = materialize(labelled.withColumn("bucket", F.when(
        F.col("label") < 0, F.pmod(own, F.lit(buckets * n_shards))).otherwise(F.pmod(own, F.lit(buckets)))),
        "labelled")
    loads = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    stays = [min(c, loads.get(s, 0)) for s, c in enumerate(caps)]
    ranked = before_bucket(labelled, ["label"], F.lit(1)).withColumn(
        "rank", F.col("before") - 1 + F.row_number().over(
            Window.partitionBy("label", "bucket").orderBy("doc_id", "key")))

    # documents without a place, numbered: first the unlinked, then each shard's surplus
    surplus_from, at = [], loads.get(-1, 0)
    for s in range(n_shards):
        surplus_from.append(at)
        at += loads.get(s, 0) - stays[s]
    label = F.col("label")
    safe = F.greatest(label, F.lit(0))
    stay = (label >= 0) & (F.col("rank") < _pick(stays, safe))
    number = F.when(label < 0, F.col("rank")).otherwise(
        _pick(surplus_from, safe) + F.col("rank") - _pick(stays, safe))
    room_from, at = [], 0
    for s in range(n_shards):
        room_from.append(at)
        at += caps[s] - stays[s]
    # the last shard whose room begins at or before the number and is not empty
    poured = F.lit(0)
    for s in range(n_shards):
        if caps[s] > stays[s]:
            poured = F.when(number >= room_from[s], s).otherwise(poured)
    shard = F.when(stay, label).otherwise(poured).cast("int")
    slot = F.when(stay, F.col("rank")).otherwise(
        number - _pick(room_from, poured) + _pick(stays, poured)).cast("long")
    return ranked.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
                         shard.alias("shard"), slot.alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))
