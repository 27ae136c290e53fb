"""Ranked lexical search by a dual-tree search (operator 13).

Every document is ranked for every item by a term score (term weight times a
saturating count, damped by the document's length) in whole numbers.  Both sides
are put in trees: items by likeness, the documents of a task in blocks of a few
thousand, in the order of the items that their rarer terms stand in.  A node holds, for
each term, the largest weight (items) or count part (documents) below it, so the
product of two nodes is at least any score between their leaves.  A pair of
nodes whose product is below the weakest k-th score of the items under it is
left with all its documents; what reaches a single item and a single document is
the exact score.  Best bounds go first, so that k-th scores rise early.

The documents are read once: a task keeps the counts of the terms that items
hold.  From that table come the document counts of the terms, and the search.
Each task gives the best k of each item; they meet in two ranked steps.  Items
are worked on in groups of at most ``GROUP_BYTES`` of text, broadcast; the
documents are read once a group.

Terms are runs of ASCII letters, digits and non-ASCII characters, only A-Z
lower-cased.  Null and empty texts have none; such documents are not counted,
such items give no rows.  Equal items (item_id and text) are answered once,
items of one item_id but different texts each on their own.  Repeated rows of
documents are documents of their own; equal scores go by doc_id, null ones last.
Other columns are ignored; an empty table on either side gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plotcover.llm.common import Words, bounded_batches, gather_lists, materialize, regroup, text_column

TOP = 20
GROUP_BYTES = 8 << 20      # text of the items broadcast at once
FAN = 8                    # children of a node
BLOCK_DOCS = 4096          # documents of a tree ...
BLOCK_TERMS = 1 << 19      # ... or terms of all of them, whichever comes first
SALTS = 64

# Bytes that end a term become blanks, A-Z becomes a-z, the rest stays.
BLANKED = bytes(b if chr(b).isalnum() and b < 128 or b > 127 else 32 for b in range(256)).lower()


def terms(texts: pa.Array) -> Words:
    """The terms of a batch of texts."""
    _, offsets, data = texts.buffers()
    if data is None:
        return Words(texts)
    plain = pa.py_buffer(data.to_pybytes().translate(BLANKED))
    return Words(pa.StringArray.from_buffers(len(texts), offsets, plain, None, 0, texts.offset))


def _counted(keys: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and count of each distinct key ``row * width + term``."""
    keys, counts = np.unique(keys, return_counts=True)
    return keys // width, keys % width, counts


class Items:
    """The items of a group: ids, their distinct terms, and (item, term, repeats)."""

    def __init__(self, rows: list[tuple[int | None, str]]):
        self.ids = [i for i, _ in rows]
        found = terms(pa.array([t for _, t in rows], pa.string()))
        self.vocabulary = found.vocabulary
        width = max(1, len(self.vocabulary))
        self.item, self.term, self.repeats = _counted(found.owner * width + found.codes, width)


class Rows:
    """Sparse rows: row i has the terms and values at ``starts[i]:starts[i + 1]``."""

    def __init__(self, row: np.ndarray, term: np.ndarray, value: np.ndarray, size: int):
        self.starts = np.searchsorted(row, np.arange(size + 1))
        self.lens = np.diff(self.starts)
        self.term, self.value = term, value

    def __len__(self) -> int:
        return len(self.lens)

    def row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.starts[i], self.starts[i + 1])
        return self.term[part], self.value[part]

    def times(self, weights: np.ndarray, picks: np.ndarray) -> np.ndarray:
        """The product of each picked row (none of them empty) with ``weights``."""
        n = self.lens[picks]
        made = weights[gather_lists(self.term, self.starts[:-1], self.lens, picks)]
        made *= gather_lists(self.value, self.starts[:-1], self.lens, picks)
        return np.add.reduceat(made, np.cumsum(n) - n)


def maxima(row: np.ndarray, term: np.ndarray, value: np.ndarray, width: int
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The largest value of each term in each row, sorted by row and term."""
    key = row * width + term
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    first = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0]
    return key[first] // width, key[first] % width, np.maximum.reduceat(value, first)


class ItemTree:
    """Items in an order that puts like ones together, and nodes over ranges of
    it: the root first; a node's children are nodes, a leaf is one item."""

    def __init__(self, items: Items, weight: np.ndarray):
        self.width = len(weight)
        value = weight[items.term] * items.repeats
        own = Rows(items.item, items.term, value, len(items.ids))
        some = np.nonzero(own.lens)[0]
        self.order = self._arranged(own, some) if len(some) else []
        self.span: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        if self.order:
            self._node(0, len(self.order))
        place = np.full(len(items.ids), -1)
        place[self.order] = np.arange(len(self.order))
        by_place = np.argsort(place[items.item], kind="stable")
        ends = np.searchsorted(place[items.item][by_place], np.arange(len(self.order) + 1))
        parts = []
        for node, (low, high) in enumerate(self.span):
            at = by_place[ends[low]:ends[high]]
            parts.append(maxima(np.full(len(at), node), items.term[at], value[at], self.width))
        row, term, top = (np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3
        self.nodes = Rows(row, term, top, len(self.span))
        # where, in the order of items, each term stands on average
        sums = np.bincount(items.term, place[items.item], self.width)
        self.place = sums / np.maximum(1, np.bincount(items.term, minlength=self.width))
        self.weight = weight.astype(np.float64) ** 2 + 1e-9

    def _node(self, low: int, high: int) -> int:
        node = len(self.span)
        self.span.append((low, high))
        self.children.append([])
        if high - low > 1:
            edges = np.linspace(low, high, min(FAN, high - low) + 1).astype(int).tolist()
            self.children[node] = [self._node(a, b) for a, b in pairwise(edges)]
        return node

    def _arranged(self, own: Rows, items: np.ndarray) -> list[int]:
        """The items, halved again and again between two that are unlike."""
        weights = np.zeros(self.width, np.int64)
        out: list[int] = []
        stack = [items]
        while stack:
            items = stack.pop()
            if len(items) <= 2:
                out += items.tolist()
                continue
            one = self._like(own, items, items[0], weights)
            two = self._like(own, items, items[int(one.argmin())], weights)
            items = items[np.argsort(two - one, kind="stable")]
            stack += [items[len(items) // 2:], items[:len(items) // 2]]
        return out

    def _like(self, own: Rows, items: np.ndarray, pivot: int, weights: np.ndarray) -> np.ndarray:
        term, value = own.row(pivot)
        weights[term] = value
        out = own.times(weights, items).astype(np.float64)
        weights[term] = 0
        return out / np.maximum(1, np.add.reduceat(
            gather_lists(own.value, own.starts[:-1], own.lens, items),
            np.cumsum(own.lens[items]) - own.lens[items]))


def count_part(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What a term's count adds, times its weight, in a document of n terms."""
    longest = int(n.max()) if len(n) else 0
    if 25 * longest * documents < 1 << 63:
        damping = 75 + 25 * n * documents // length
    else:
        damping = np.array([75 + 25 * int(x) * documents // length for x in n.tolist()], np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 12 * damping)


class Block:
    """A tree over some documents: levels from the top down, the last one the
    documents; node i's children are i * FAN and the following ones."""

    def __init__(self, owner: np.ndarray, term: np.ndarray, value: np.ndarray, size: int, tree: ItemTree):
        share = value * tree.weight[term]
        mean = np.bincount(owner, share * tree.place[term], size) / np.bincount(owner, share, size)
        self.order = np.argsort(mean, kind="stable")
        place = np.empty(size, np.int64)
        place[self.order] = np.arange(size)
        row, term, value = maxima(place[owner], term, value, tree.width)
        self.levels = [Rows(row, term, value, size)]
        while len(self.levels[0]) > FAN:
            row, term, value = maxima(row // FAN, term, value, tree.width)
            self.levels.insert(0, Rows(row, term, value, -(-len(self.levels[0]) // FAN)))

    def below(self, level: int, nodes: np.ndarray) -> np.ndarray:
        children = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
        return children[children < len(self.levels[level + 1])]


class Best:
    """The best k documents of each item so far, and the score to reach."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.score = [np.zeros(0, np.int64)] * items
        self.doc = [np.zeros(0, np.int64)] * items
        self.no_id = [np.zeros(0, bool)] * items
        self.reach = np.ones(items, np.int64)        # only scores above 0 count

    def add(self, item: int, score: np.ndarray, doc: np.ndarray, no_id: np.ndarray) -> None:
        score = np.concatenate([self.score[item], score])
        doc = np.concatenate([self.doc[item], doc])
        no_id = np.concatenate([self.no_id[item], no_id])
        order = np.lexsort((doc, no_id, -score))[:self.k]
        self.score[item], self.doc[item], self.no_id[item] = score[order], doc[order], no_id[order]
        if len(order) == self.k:
            self.reach[item] = max(1, score[order[-1]])


class Search:
    """Searches block after block for the best documents of a tree's items."""

    def __init__(self, tree: ItemTree, k: int):
        self.tree = tree
        self.best = Best(len(tree.order), k)
        self.weights = np.zeros(tree.width, np.int64)
        self.compared = 0                             # exact scores, for tests

    def run(self, block: Block, doc: np.ndarray, no_id: np.ndarray) -> None:
        self.block, self.doc, self.no_id = block, doc[block.order], no_id[block.order]
        if self.tree.span:
            self._pair(0, 0, np.arange(len(block.levels[0])))

    def _pair(self, node: int, level: int, nodes: np.ndarray) -> None:
        """An item node with nodes of one level of the documents' tree."""
        low, high = self.tree.span[node]
        term, value = self.tree.nodes.row(node)
        self.weights[term] = value
        bound = self.block.levels[level].times(self.weights, nodes)
        if high - low == 1:
            self._item(low, level, nodes, bound)
            self.weights[term] = 0
            return
        self.weights[term] = 0
        nodes = nodes[bound >= self.best.reach[low:high].min()]
        if not len(nodes):
            return
        # single documents are left to single items, which take the best first
        if level + 2 < len(self.block.levels):
            nodes, level = self.block.below(level, nodes), level + 1
        for child in self.tree.children[node]:
            self._pair(child, level, nodes)

    def _item(self, item: int, level: int, nodes: np.ndarray, bound: np.ndarray) -> None:
        """One item: the best nodes first, until none can reach its k-th score."""
        if level + 1 == len(self.block.levels):
            self.compared += len(nodes)
            hits = bound >= self.best.reach[item]
            if hits.any():
                self.best.add(item, bound[hits], self.doc[nodes[hits]], self.no_id[nodes[hits]])
            return
        order = np.argsort(-bound, kind="stable")
        at, size = 0, FAN
        while at < len(order) and bound[order[at]] >= self.best.reach[item]:
            part = order[at:at + size]
            part = part[bound[part] >= self.best.reach[item]]
            children = self.block.below(level, nodes[part])
            self._item(item, level + 1, children, self.block.levels[level + 1].times(self.weights, children))
            at, size = at + size, size * 2


def _counts(docs: DataFrame, items: Broadcast) -> DataFrame:
    """doc_id, n, and the terms of items in it with their counts, of every
    document with a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = max(1, len(items.value.vocabulary))
        for batch in regroup(batches):
            found = terms(text_column(batch))
            known = pc.fill_null(pc.index_in(found.vocabulary, items.value.vocabulary), -1).to_numpy()
            codes = known[found.codes].astype(np.int64)
            owner, term, count = _counted((found.owner * width + codes)[codes >= 0], width)
            at = pa.array(np.searchsorted(owner, np.arange(batch.num_rows + 1)), pa.int32())
            some = pa.array(found.counts > 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.counts, pa.int64()),
                 pa.ListArray.from_arrays(at, pa.array(term, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(count, pa.int64()))],
                names=["doc_id", "n", "terms", "counts"]).filter(some)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n long, terms array<int>, counts array<long>")


def _searched(counts: DataFrame, tree: Broadcast, documents: int, length: int, k: int) -> DataFrame:
    """item (a place in the tree's order), doc_id, score: the best k of each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(tree.value, k)
        held: list[pa.RecordBatch] = []
        size = 0

        def work() -> None:
            table = pa.Table.from_batches(held)
            lens = pc.list_value_length(table.column("terms")).to_numpy()
            some = np.nonzero(lens)[0]
            if not len(some):
                return
            owner = np.repeat(np.arange(len(some)), lens[some])
            term = pc.list_flatten(table.column("terms")).to_numpy().astype(np.int64)
            tf = pc.list_flatten(table.column("counts")).to_numpy()
            value = count_part(tf, table.column("n").to_numpy()[some][owner], documents, length)
            known = value > 0
            some, owner = (some, owner) if known.all() else _fewer(some, owner, known)
            if len(some):
                ids = table.column("doc_id")
                search.run(Block(owner, term[known], value[known], len(some), tree.value),
                           pc.fill_null(ids, 0).to_numpy()[some], pc.is_null(ids).to_numpy()[some])

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_DOCS):
                part = batch.slice(at, BLOCK_DOCS)
                terms_here = int(pc.sum(pc.list_value_length(part.column("terms"))).as_py() or 0)
                rows = sum(b.num_rows for b in held)
                if held and (rows + part.num_rows > BLOCK_DOCS or size + terms_here > BLOCK_TERMS):
                    work()
                    held, size = [], 0
                held.append(part)
                size += terms_here
        if held:
            work()
        best = search.best
        lens = [len(s) for s in best.score]
        if sum(lens):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(lens)), lens), pa.int64()),
                 pa.array(np.concatenate(best.doc), mask=np.concatenate(best.no_id)),
                 pa.array(np.concatenate(best.score))], names=["item", "doc_id", "score"])

    return counts.select("doc_id", "n", "terms", "counts").mapInArrow(run, "item long, doc_id long, score long")


def _fewer(some: np.ndarray, owner: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents that still have a term, renumbered."""
    left, owner = np.unique(owner[known], return_inverse=True)
    return some[left], owner


def _ranked(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents (doc_id, text) with
    the highest scores above 0 for each item (item_id, text)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    asked = materialize(items.select(F.col("item_id").cast("long").alias("item_id"), "text")
                        .where("text is not null").distinct(), "items")
    total = asked.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    groups = max(1, math.ceil(total / group_bytes))
    found = []
    for g in range(groups):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g).collect()
        rows = sorted(((r.item_id, r.text) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        found.append(_search_group(docs, Items(rows), k))
    return reduce(DataFrame.unionByName, found)


def _search_group(docs: DataFrame, items: Items, k: int) -> DataFrame:
    spark = docs.sparkSession
    counts = materialize(_counts(docs, spark.sparkContext.broadcast(items)), "counts")
    documents, length = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = np.zeros(max(1, len(items.vocabulary)), np.int64)
    # at most one row a term of the group's items
    held = counts.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    df[held.column("term").to_numpy()] = held.column("count").to_numpy()
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    tree = ItemTree(items, weight)
    hits = _searched(counts, spark.sparkContext.broadcast(tree), documents, length or 1, k)
    hits = materialize(hits.withColumn("salt", F.spark_partition_id() % SALTS), "hits")
    best = _ranked(_ranked(hits, ["item", "salt"], k).drop("rank", "salt"), ["item"], k)
    ids = spark.createDataFrame([(at, items.ids[i]) for at, i in enumerate(tree.order)], "item long, item_id long")
    return best.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")
