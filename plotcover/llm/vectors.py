"""Embedding near-duplicates as an exact metric range join (operator 11).

Two vectors of one label link when the angle between them is at most that of
the cosine ``threshold``.  Angles are a metric, so distances to pivots bound
distances between vectors:

* Each label gets pivots, at least one angle limit apart, dense places first.
  A vector's home is its nearest pivot.  Homes within half the limit of their
  pivot are its *core*: any two of them link, by the triangle inequality, and
  are counted without being compared.  The others are its *shell*.
* Boundary vectors are replicated.  Into the core of another pivot go vectors
  within one and a half limits of that pivot; into the shell of another pivot
  those at most two limits farther from it than from their own.  No pair
  outside these can link.  Of two cells only one gets the other's vectors, so
  each pair is compared once.
* Cells are joined independently: a chunk of a cell's homes is held, the other
  homes and the visitors stream past it in batches.  Links are counted, not
  listed: a cell gives each vector's count and a spanning forest of its links.

Equal vectors of a label are one node with its number of copies.  Pivots come
from ``SAMPLE`` vectors a label at most; they decide how the work is cut, never
a result.  A label whose vectors lie apart like random directions cannot be cut
by any metric: its pairs are all compared, in chunks of bounded size.

Vectors that are null, empty, zero or hold null or non-finite components, and
those with a null label, link with nothing: n_links 0, component_id their own
vec_id.  Vectors of different lengths do not link.  Null vec_ids count as links
but never name a component unless all of it has none; ``kept`` is true where
vec_id and component_id are equal or both null.  Repeated rows (also of one
vec_id) are vectors of their own.  Other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotcover.llm.common import bounded_batches, grouped, materialize
from plotcover.llm.simhash import components

THRESHOLD = 0.93
CELL = 512            # vectors a pivot, on average
MAX_PIVOTS = 64       # pivots of a label
SAMPLE = 1024         # vectors of a label its pivots are chosen from
PART = 8192           # vectors assigned to pivots in one group
CHUNK = 4096          # homes of a cell held at once
MARGIN = 1e-6         # radians; far above the error of an arc cosine
NO_ID = (1 << 63) - 1


def mark(vectors: DataFrame) -> DataFrame:
    """vec_id, label, dim, vec (its bytes) and a 128-bit digest of them; the
    last three are null where the vector can link with nothing."""
    kind = vectors.schema["embedding"].dataType.elementType
    narrow = isinstance(kind, T.FloatType)
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label",
        F.col("embedding").cast(f"array<{'float' if narrow else 'double'}>").alias("embedding"))
    label = rows.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, known = batch.column(2), batch.column(1).is_valid().to_pylist()
            flat = lists.flatten().to_numpy(zero_copy_only=False) + 0.0    # no negative zeros
            lens = lists.value_lengths().fill_null(0).to_numpy()
            ends = np.cumsum(lens)
            dims, vecs, digests = [], [], []
            for n, end, has_label in zip(lens.tolist(), ends.tolist(), known):
                own = flat[end - n:end]
                if has_label and n and np.isfinite(own).all() and own.any():
                    data = own.tobytes()
                    dims.append(n)
                    vecs.append(data)
                    digests.append(xxhash.xxh3_128_digest(data))
                else:
                    dims.append(None)
                    vecs.append(None)
                    digests.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(dims, pa.int32()),
                 pa.array(vecs, pa.binary()), pa.array(digests, pa.binary())],
                names=["vec_id", "label", "dim", "vec", "digest"])

    return rows.mapInArrow(run, f"vec_id long, label {label}, dim int, vec binary, digest binary")


def units(vecs: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """The vectors in double precision, one a row, scaled to length one."""
    data = b"".join(vecs.to_pylist())
    width = len(data) // max(1, len(vecs) * dim)
    out = np.frombuffer(data, np.float32 if width == 4 else np.float64).reshape(-1, dim).astype(np.float64)
    out /= np.abs(out).max(1, keepdims=True)
    return out / np.sqrt((out * out).sum(1, keepdims=True))


def choose_pivots(unit: np.ndarray, count: int, limit: float) -> list[int]:
    """At most ``count`` of the vectors, more than ``limit`` apart: each time
    the one with most others, not yet in a core, within half the limit."""
    cosines = unit @ unit.T
    near = cosines >= math.cos(limit / 2)
    free, open_ = np.ones(len(unit), bool), np.ones(len(unit), bool)
    out: list[int] = []
    while len(out) < count and free.any():
        best = int(np.where(free, near[:, open_].sum(1), -1).argmax())
        out.append(best)
        open_ &= ~near[best]
        free &= cosines[best] < math.cos(limit)
        free[best] = False
    return out


def _pivots(nodes: DataFrame, parts: DataFrame, limit: float) -> DataFrame:
    """part, pivot (0, 1, ...), vec: the pivots of each label."""
    order = Window.partitionBy("part").orderBy(F.xxhash64("digest"), "node")
    sample = (nodes.select("part", "dim", "vec", "digest", "node")
              .withColumn("at", F.row_number().over(order)).where(F.col("at") <= SAMPLE)
              .join(parts.select("part", "pivots"), "part"))

    def choose(table: pa.Table) -> pa.Table:
        dim, count = table.column("dim")[0].as_py(), table.column("pivots")[0].as_py()
        table = table.sort_by("at")
        picked = choose_pivots(units(table.column("vec"), dim), count, limit)
        return pa.table({"part": table.column("part").take(picked), "pivot": pa.array(range(len(picked)), pa.int64()),
                         "vec": table.column("vec").take(picked)})

    return sample.groupBy("part").applyInArrow(choose, "part long, pivot long, vec binary")


VISIT = "part long, dim int, pivot long, core boolean, home boolean, node long, copies long, vec binary"


def _visits(nodes: DataFrame, parts: DataFrame, pivots: DataFrame, limit: float) -> DataFrame:
    """Each node in its home cell and in those it visits (``VISIT``)."""
    salts = parts.select("part", "salts")
    salted = nodes.join(salts, "part").select(
        "part", F.pmod(F.xxhash64("node"), F.col("salts")).alias("salt"), F.lit(1).alias("role"),
        "dim", F.lit(0).cast("long").alias("pivot"), "node", "copies", "vec")
    everywhere = pivots.join(parts.select("part", "salts", "dim"), "part").select(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"),
        F.lit(0).alias("role"), "dim", "pivot", F.lit(None).cast("long").alias("node"),
        F.lit(None).cast("long").alias("copies"), "vec")

    def assign(key: tuple[int, int], slices: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        axes = None
        for batch in slices:
            n_pivots = int((batch.column("role").to_numpy() == 0).sum())
            if n_pivots:
                held.append(batch.slice(0, n_pivots))
                batch = batch.slice(n_pivots)
            if batch.num_rows == 0:
                continue
            dim = batch.column("dim")[0].as_py()
            if axes is None:
                axes = units(pa.Table.from_batches(held).column("vec"), dim)
            angle = np.arccos(np.clip(units(batch.column("vec"), dim) @ axes.T, -1, 1))
            home = angle.argmin(1)
            least = angle[np.arange(len(home)), home]
            core = least <= limit / 2 - MARGIN
            cells = np.arange(len(axes))
            earlier = cells < home[:, None]
            into_core = (angle <= 1.5 * limit + MARGIN) & np.where(core[:, None], earlier, True)
            into_core[np.arange(len(home)), home] &= ~core
            into_shell = (angle <= least[:, None] + 2 * limit + MARGIN) & earlier & ~core[:, None]
            row, cell, is_core, is_home = (np.concatenate(c) for c in zip(
                (np.arange(len(home)), home, core, np.ones(len(home), bool)),
                *((*np.nonzero(into), np.full(into.sum(), kind), np.zeros(into.sum(), bool))
                  for into, kind in ((into_core, True), (into_shell, False)))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("part").take(row), batch.column("dim").take(row), pa.array(cell, pa.int64()),
                 pa.array(is_core), pa.array(is_home), batch.column("node").take(row),
                 batch.column("copies").take(row), batch.column("vec").take(row)],
                names=["part", "dim", "pivot", "core", "home", "node", "copies", "vec"])

    return grouped(salted.unionByName(everywhere), ("part", "salt"), ("role", "pivot"), assign, VISIT)


class Forest:
    """Which of the held vectors are linked so far, through each other or
    through vectors that streamed past."""

    def __init__(self, size: int):
        self.tree = np.arange(size)

    def join(self, links: np.ndarray) -> list[tuple[int, int]]:
        """Pairs (held, other) of the matrix that connect what its links
        connect: one for each other vector with a link, and one for each two
        trees of held ones that become one."""
        out = []
        for other in np.nonzero(links.any(0))[0].tolist():
            held = np.nonzero(links[:, other])[0]
            trees, first = np.unique(self.tree[held], return_index=True)
            out += [(int(h), other) for h in held[first]]
            for t in trees[1:].tolist():
                self.tree[self.tree == t] = trees[0]
        return out


def _compare(cells: DataFrame, threshold: float) -> DataFrame:
    """a, b, n: rows without b add n links to node a, rows with b link a and b."""
    def compare(key: tuple[int, int], slices: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        own = None
        for batch in slices:
            n_held = int((batch.column("role").to_numpy() == 0).sum())
            if n_held:
                held.append(batch.slice(0, n_held))
                batch = batch.slice(n_held)
            if own is None and (batch.num_rows or not n_held):
                own = Held(held, threshold)
                yield from own.among_themselves()
            if batch.num_rows:
                yield from own.against(batch)
        if own is None:
            own = Held(held, threshold)
            yield from own.among_themselves()
        yield from own.counts()

    return grouped(cells, ("cell", "chunk"), ("role",), compare, "a long, b long, n long")


class Held:
    def __init__(self, batches: list[pa.RecordBatch], threshold: float):
        table = pa.Table.from_batches(batches)
        self.dim = table.column("dim")[0].as_py()
        self.core = table.column("core")[0].as_py()
        self.node = table.column("node").to_numpy()
        self.copies = table.column("copies").to_numpy()
        self.unit = units(table.column("vec"), self.dim)
        self.threshold = threshold
        self.found = np.zeros(len(self.node), np.int64)
        self.forest = Forest(len(self.node))

    def among_themselves(self) -> Iterator[pa.RecordBatch]:
        if self.core:
            return                                    # all linked, counted by their cell
        for at in range(0, len(self.node), 1024):
            links = self.unit @ self.unit[at:at + 1024].T >= self.threshold
            columns = np.arange(links.shape[1])
            links[at + columns, columns] = False
            self.found[at:at + 1024] += self.copies @ links
            links[np.arange(len(self.node))[:, None] > at + columns] = False
            yield self.edges(links, self.node[at:at + 1024])

    def against(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        node, copies = batch.column("node").to_numpy(), batch.column("copies").to_numpy()
        links = self.unit @ units(batch.column("vec"), self.dim).T >= self.threshold
        self.found += links @ copies
        yield self.added(node, self.copies @ links)
        yield self.edges(links, node)

    def counts(self) -> Iterator[pa.RecordBatch]:
        yield self.added(self.node, self.found)

    def added(self, node: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        some = n > 0
        return pa.RecordBatch.from_pydict({"a": pa.array(node[some]), "b": pa.nulls(int(some.sum()), pa.int64()),
                                           "n": pa.array(n[some], pa.int64())})

    def edges(self, links: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        pairs = self.forest.join(links)
        return pa.RecordBatch.from_pydict({
            "a": pa.array([self.node[h] for h, _ in pairs], pa.int64()),
            "b": pa.array([node[o] for _, o in pairs], pa.int64()),
            "n": pa.array([0] * len(pairs), pa.int64())})


def _id(table: DataFrame, name: str) -> DataFrame:
    """The table with a number for each row, written with it."""
    return materialize(table.withColumn(name, F.monotonically_increasing_id()), name)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors``
    (vec_id, embedding, label)."""
    bounded_batches(vectors.sparkSession)
    limit = math.acos(threshold)
    marked = materialize(mark(vectors), "marked")
    nodes = _id(marked.where("digest is not null").groupBy("label", "dim", "digest", "vec").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first")), "node")
    parts = _id(nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "label", "dim", F.least(F.lit(MAX_PIVOTS), F.ceil(F.col("n") / CELL)).cast("int").alias("pivots"),
        F.ceil(F.col("n") / PART).cast("long").alias("salts")), "part")
    placed = nodes.join(parts.select("label", "dim", "part"), ["label", "dim"])
    visits = materialize(_visits(placed, parts, _pivots(placed, parts, limit), limit), "visits")

    at = ["part", "pivot", "core"]
    cells = _id(visits.groupBy(*at).agg(
        F.count_if("home").alias("homes"), F.count_if(~F.col("home")).alias("visitors"),
        F.sum(F.when(F.col("home"), F.col("copies"))).alias("core_copies"),
        F.min(F.when(F.col("home"), F.col("node"))).alias("core_node"))
        .where("homes > 0").withColumn("chunks", F.ceil(F.col("homes") / CHUNK).cast("long")), "cell")
    # a core without visitors has nothing to compare
    spread = visits.join(cells.where("not core or visitors > 0").select(*at, "cell", "chunks"), at)
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks"))
    goes_to = F.when(F.col("home") & F.col("core"), F.array(chunk)) \
        .when(F.col("home"), F.sequence(F.lit(0).cast("long"), chunk)) \
        .otherwise(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    spread = spread.select("cell", "core", "home", "dim", "node", "copies", "vec", chunk.alias("own"),
                           F.explode(goes_to).alias("chunk"))
    held = F.col("home") & (F.col("chunk") == F.col("own"))
    found = materialize(_compare(spread.select("cell", "chunk", (~held).cast("int").alias("role"), "core", "dim",
                                               "node", "copies", "vec"), threshold), "found")

    cores = visits.where("home and core").select(*at, "node", "copies").join(
        cells.select(*at, "core_copies", "core_node"), at)
    core_links = cores.select("node", (F.col("core_copies") - F.col("copies")).alias("n"))
    links = (found.where("b is null").select(F.col("a").alias("node"), "n").unionByName(core_links)
             .groupBy("node").agg(F.sum("n").alias("others")))
    edges = found.where("b is not null").select("a", "b").unionByName(
        cores.where("node <> core_node").select(F.col("node").alias("a"), F.col("core_node").alias("b")))
    reached = components(edges, nodes.select(F.col("node").alias("fp"),
                                             F.coalesce("first", F.lit(NO_ID)).alias("first"))
                         ).select(F.col("fp").alias("node"), F.col("label").alias("least"))
    known = nodes.join(links, "node", "left").join(reached, "node", "left").select(
        "label", "digest", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce(F.nullif("least", F.lit(NO_ID)), "first").alias("component_id"))
    return _per_vector(marked, known)


def _per_vector(marked: DataFrame, known: DataFrame) -> DataFrame:
    component: Column = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return (marked.select("vec_id", "label", "digest").join(known, ["label", "digest"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                    component.alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
