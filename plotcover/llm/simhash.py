"""SimHash near-duplicates by meet-in-the-middle ball hashing (operator 10).

The fingerprint of a text is the bitwise majority of the XXH64 hashes (seed 42)
of its shingles of ``shingle`` words (ASCII letters in lower case).  Documents
link when their fingerprints differ in at most ``radius`` bits.

Two fingerprints within the radius share a variant: one that both reach by
flipping at most radius / 2 bits.  And two that share such a variant are within
the radius.  So all fingerprints that emit the same variant are linked to the
smallest of them, and no pair needs to be listed to keep every connection;
each link is still checked by its bit distance, and a bucket of variants gives a
spanning forest of its links, not the links.

A full ball of a 64-bit fingerprint has 2081 variants at half radius 2, most of
them met by nobody.  So the ball is first taken on each 32-bit half (at most
radius / 2 differing bits fall into one of the halves, so half of that again
must be flipped on each side: 33 variants a half).  A fingerprint that meets no
other within the radius there has no neighbour and emits nothing more.  For
a key of up to ``PAIR_CHECK`` fingerprints the check is exact; for a larger one
all count as met.  What these half balls link is labelled by components; then
those that met another emit their full balls, with their labels, and only links
between different labels are kept.

Variants cross the network packed: one row per task and bucket holds a block of
(variant, fingerprint) numbers.  Links become components by repeated joins
(each fingerprint takes the smallest label around it, then the label of its
label) with the state written to the shared folder in each round.

Null, empty and blank texts have fingerprint zero and link like any other.
Equal fingerprints are one node with its smallest doc_id; null doc_ids sort
first and give no component id of their own unless they stand alone.  An empty
table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotcover.llm.common import bounded_batches, materialize, regroup, text_column

SHINGLE = 4
RADIUS = 4
SEED = 42
PAIR_CHECK = 64
FINGERPRINTS_AT_ONCE = 2048
BUCKET_VARIANTS = 400_000     # variants of a bucket, on average
MAX_ROUNDS = 60


def fingerprints(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text, as uint64."""
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    out = np.zeros(len(texts), np.uint64)
    first = 0
    for i, text in enumerate(texts.to_pylist()):
        words = text.encode("utf-8", "surrogatepass").lower().split()
        n = len(words)
        if n <= shingle:
            own = [digest(b" ".join(words), SEED)] if n else []
        else:
            body = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
            begins = (ends - np.fromiter(map(len, words), np.int64, n) - 1)[:n - shingle + 1].tolist()
            ends = (ends - 1)[shingle - 1:].tolist()
            own = [digest(body[b:e], SEED) for b, e in zip(begins, ends)]
        hashes += own
        counts[i] = len(own)
        if len(hashes) >= 1 << 17 or i == len(texts) - 1:
            out[first:i + 1] = majority(np.array(hashes, np.uint64), counts[first:i + 1])
            hashes, first = [], i + 1
    return out


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each run of hashes the bits set in over half of them."""
    out = np.zeros(len(counts), np.uint64)
    some = np.nonzero(counts)[0]
    if len(some):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = (np.cumsum(counts) - counts)[some]
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        over = (2 * ones > counts[some][:, None]).astype(np.uint8)
        out[some] = np.packbits(over, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def ball(bits: int, radius: int) -> np.ndarray:
    """The flips of at most ``radius`` of that many bits."""
    return np.array([sum(1 << b for b in flips) for r in range(radius + 1)
                     for flips in combinations(range(bits), r)], np.uint64)


def _packed(batches: Iterator[pa.RecordBatch], emit, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, block) with the rows (key, fingerprint, label) that
    ``emit`` makes of blocks of fingerprints and labels.  Each block is sorted
    by bucket."""
    for batch in batches:
        values, labels = (batch.column(c).to_numpy().view(np.uint64) for c in (0, 1))
        for at in range(0, len(values), FINGERPRINTS_AT_ONCE):
            part = slice(at, at + FINGERPRINTS_AT_ONCE)
            key, owner = emit(values[part])
            bucket = ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            rows = np.stack([key[order], values[part][owner[order]], labels[part][owner[order]]], axis=1)
            bucket = bucket[order].astype(np.int64)
            ends = np.searchsorted(bucket, np.arange(buckets), "right")
            begins = np.concatenate([[0], ends[:-1]])
            some = np.nonzero(ends > begins)[0]
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array(some, pa.int64()),
                "block": pa.array([rows[begins[b]:ends[b]].tobytes() for b in some], pa.binary())})


def _rows_of(table: pa.Table) -> np.ndarray:
    """The (key, fingerprint, label) rows of a bucket's blocks, sorted, each once."""
    rows = np.frombuffer(b"".join(table.column("block").to_pylist()), np.uint64).reshape(-1, 3)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    return rows[new]


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links (a, b) with the smallest one it is connected
    with, itself left out: links no more than nodes."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, two = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[one], label[two])
        new = label.copy()
        for end in (one, two, label[one], label[two]):
            np.minimum.at(new, end, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def met(rows: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The fingerprints that share a key with another within the radius, and
    links that connect those found so.  A key of more than ``PAIR_CHECK``
    fingerprints counts all as met and links them to its smallest one only."""
    keys, starts, counts = np.unique(rows[:, 0], return_index=True, return_counts=True)
    found, one, two = ([np.zeros(0, np.uint64)] for _ in range(3))
    for n in np.unique(counts[counts > 1]):
        begins = starts[counts == n]
        for part in np.array_split(begins, max(1, len(begins) * min(n, PAIR_CHECK) * n >> 20)):
            group = rows[part[:, None] + np.arange(n), 1]
            if n > PAIR_CHECK:
                found.append(group.ravel())
                near = distance(group, group[:, :1]) <= radius
                at, j = np.nonzero(near)
                i = np.zeros(len(at), np.int64)
            else:
                near = distance(group[:, :, None], group[:, None, :]) <= radius
                found.append(group[near.sum(2) > 1])
                at, i, j = np.nonzero(np.triu(near, 1))
            a, b = forest(group[at, i], group[at, j])
            one.append(a)
            two.append(b)
    return np.unique(np.concatenate(found)), *forest(np.concatenate(one), np.concatenate(two))


def links(rows: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between the labels of fingerprints that share a variant, checked
    against its smallest one: a forest over the bucket's labels."""
    first = np.searchsorted(rows[:, 0], rows[:, 0], "left")
    apart = (rows[:, 2] != rows[first, 2]) & (distance(rows[:, 1], rows[first, 1]) <= radius)
    pairs = np.unique(np.stack([rows[apart, 2], rows[first[apart], 2]], axis=1), axis=0)
    return forest(pairs[:, 0], pairs[:, 1])


def neighbours(values: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column fp) within
    the radius: those of the half balls as a forest a bucket, then, between
    what these connect, those of the full balls.  So a dense cluster gives a
    small multiple of its fingerprints, not of their pairs."""
    half, n = radius // 2, values.count()
    quarter = half // 2
    flips, half_flips = ball(64, half), ball(32, quarter)

    def halves(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = (fp & np.uint64(0xFFFFFFFF))[:, None] ^ half_flips
        high = (fp >> np.uint64(32))[:, None] ^ half_flips
        # the top bit of the key's upper word tells the halves apart
        key = np.concatenate([low, high | np.uint64(1 << 63)], axis=1)
        return key.ravel(), np.repeat(np.arange(len(fp)), key.shape[1])

    def full(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (fp[:, None] ^ flips).ravel(), np.repeat(np.arange(len(fp)), len(flips))

    def active(table: pa.Table) -> pa.Table:
        # a row without b only says that a has met another
        fps, a, b = met(_rows_of(table), radius)
        alone = np.setdiff1d(fps, a)
        return pa.table({"a": np.concatenate([a, alone]).view(np.int64),
                         "b": pa.array(np.concatenate([b, alone]).view(np.int64),
                                       mask=np.arange(len(a) + len(alone)) >= len(a))})

    def joined(table: pa.Table) -> pa.Table:
        a, b = links(_rows_of(table), radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    def meet(fps: DataFrame, size: int, emit, reduce) -> DataFrame:
        buckets = max(1, size // BUCKET_VARIANTS)
        return (fps.mapInArrow(lambda batches: _packed(batches, emit, buckets), "bucket long, block binary")
                .groupBy("bucket").applyInArrow(reduce, "a long, b long"))

    near = materialize(meet(values.select("fp", F.col("fp").alias("label")), n * 2 * len(half_flips), halves, active), "near")
    some = near.select(F.col("a").alias("fp")).union(near.select("b").where("b is not null")).distinct()
    first = near.where("b is not null").distinct()
    labels = components(first, some.select("fp", F.col("fp").alias("first")))
    labelled = materialize(some.join(labels, "fp", "left").select("fp", F.coalesce("label", "fp").alias("label")), "met")
    return first.union(meet(labelled, labelled.count() * len(flips), full, joined)).distinct()


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """fp, label: the smallest ``first`` of the nodes (fp, first) connected with
    each node that has an edge."""
    both = materialize(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    state = materialize(both.select(F.col("a").alias("fp")).distinct().join(nodes, "fp")
                        .select("fp", F.col("fp").alias("parent"), F.col("first").alias("label")), "labels")
    for _ in range(MAX_ROUNDS):
        # the smallest (label, fingerprint) around each fingerprint ...
        around = (both.join(state.select(F.col("fp").alias("b"), F.struct("label", "parent").alias("there")), "b")
                  .groupBy(F.col("a").alias("fp")).agg(F.min("there").alias("there")))
        low = state.join(around, "fp").select(
            "fp", F.col("label").alias("was"),
            F.least(F.struct("label", "parent"), F.col("there")).alias("low"))
        # ... and then what that fingerprint itself has reached
        there = low.select(F.col("fp").alias("parent"), F.col("low").alias("next"))
        state = materialize(
            low.select("fp", "was", "low", F.col("low.parent").alias("parent")).join(there, "parent").select(
                "fp", F.col("next.parent").alias("parent"), F.col("next.label").alias("label"),
                (F.col("next.label") != F.col("was")).alias("moved")), "labels")
        if not state.where("moved").take(1):
            return state.select("fp", "label")
        state = state.drop("moved")
    raise RuntimeError("components did not settle")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document."""
    spark = docs.sparkSession
    bounded_batches(spark)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches):
            values = fingerprints(text_column(batch), shingle)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "fp": values.view(np.int64)})

    marked = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                         .mapInArrow(hashed, "doc_id long, fp long"), "fingerprints")
    nodes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    labels = components(neighbours(nodes, radius), nodes.na.fill({"first": (1 << 63) - 1}))
    placed = nodes.join(labels, "fp", "left").select(
        "fp", F.coalesce(F.nullif("label", F.lit((1 << 63) - 1)), "first").alias("component_id"))
    return marked.join(placed, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each component of fingerprints: the one with the smallest
    doc_id, a null one last, then by a digest of the text, then of the whole
    row.  Rows of other components stay, also with the same or a null doc_id.
    Extra columns may have any name and type."""
    bounded_batches(docs.sparkSession)
    columns = [F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]
    # maps have no hash of their own
    hashable = [F.to_json(F.struct(c.alias("value"))) if re.search("map<|variant", field.dataType.simpleString()) else c
                for c, field in zip(columns, docs.schema)]
    own = F.struct(
        F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").cast("long").alias("id"),
        F.xxhash64("text").alias("words"),
        # null columns do not enter the hash, so where they are does
        *[F.xxhash64(F.lit(seed), *[x for h, c in zip(hashable, columns) for x in (h, c.isNull())])
          .alias(f"row{seed}") for seed in (1, 2)])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches):
            values = fingerprints(text_column(batch), shingle)
            yield pa.RecordBatch.from_pydict({"own": batch.column(0), "fp": values.view(np.int64)})

    rows = docs.select(own.alias("own"), "text")
    marked = rows.mapInArrow(hashed, f"own {rows.schema['own'].dataType.simpleString()}, fp long")
    nodes = materialize(marked.groupBy("fp").agg(F.min("own").alias("own")), "nodes")
    firsts = nodes.select("fp", F.col("fp").alias("first"))
    kept = (nodes.join(components(neighbours(firsts, radius), firsts), "fp", "left")
            .groupBy(F.coalesce("label", "fp").alias("kept_of")).agg(F.min("own").alias("own"))
            .select("kept_of", F.col("own.row1").alias("row1"), F.col("own.row2").alias("row2")))
    # given columns travel in one struct: their names can't clash with those of the join
    return (docs.select(F.struct(*columns).alias("row"), own["row1"].alias("row1"), own["row2"].alias("row2"))
            .join(kept, ["row1", "row2"])
            # only equal rows are left to choose from
            .dropDuplicates(["kept_of"])
            .select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))
