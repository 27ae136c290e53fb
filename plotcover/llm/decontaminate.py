"""Benchmark decontamination by CGK embedding and bit-sampling LSH (operator 7).

A document is contaminated by an item when some stretch of it is within
``max_edit`` of the item's words by edit distance (words inserted, deleted or
replaced; words compare in lower case without punctuation).

1. Windows.  An item of m words with at most k = max_edit * m edits is cut into
   k + 1 pieces; one of them must stand unchanged in any such stretch.  Every
   word position of every document is looked up in the table of piece
   beginnings; a hit gives the item-sized windows that start within k words of
   the place where the item would.  No matching stretch is lost here.
2. Embedding.  A random walk reads each window and each item: at step j it
   writes the symbol under it and moves on if a random bit of (j, symbol) is
   set.  Two sequences at small edit distance differ in few places (Hamming
   distance).  ``WALKS`` walks are taken: a walk that an early edit throws off
   for long is made up for by the others.
3. LSH.  Each of L repetitions samples places of one walk and looks the
   sample's hash up among the items of that size.  Places are drawn only from
   steps at which no item of the size has ended, so agreement is always that of
   words.  L is the least number at which both of two sets of simulated edits at
   the threshold reach the target recall on the places drawn; a size that
   ``MAX_REPETITIONS`` do not bring there has all its windows verified.
4. Verification.  Exact edit distance of the item against the words around the
   window, starting and ending anywhere.

The benchmark is the query set: it is taken in blocks of about
``BLOCK_BYTES`` bytes of texts and signatures, each block broadcast and run against all rows of
all documents.  Documents are never shuffled.

Null or word-free texts match nothing, and so do items without words.  Items
under 1 / max_edit words must match exactly.  The result has one row per
(document row, item): the best stretch, the leftmost on ties; repeated rows
each get theirs.  Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotcover.llm.common import Words, bounded_batches, regroup, text_column

MAX_EDIT = 0.2
TARGET_RECALL = 0.985
SAMPLE_PLACES = 3
WALKS = 8
MAX_REPETITIONS = 256
TRIALS = 384                  # simulated edits of each of two sets, over the first items of a size
BLOCK_BYTES = 16 << 20
ITEM_BYTES = 512              # signatures of an item, counted with its text
AT_ONCE = 2048                # windows embedded or verified together, fewer of long items
HELD = 1 << 21                # symbols of their embeddings
PAIRS = 1 << 18               # pairs of windows and items looked at together
PAD = np.uint64(0)
RESULT = "doc_id long, item_id long, start_word long, n_words long, edits long"


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mixing rule (fixed constants), seeded."""
    x = (x ^ np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


class Symbols:
    """The words of a batch of texts as 64-bit symbols: lower case, letters and
    digits only; words with neither are left out.  ``places`` are the indices
    of the words among all words of their text."""

    def __init__(self, texts: pa.Array):
        words = Words(texts)
        plain = pc.replace_substring_regex(pc.utf8_lower(words.vocabulary), r"[^\pL\pN]+", "")
        table = np.fromiter((xxhash.xxh3_64_intdigest(w) | 1 if w else 0 for w in plain.to_pylist()),
                            np.uint64, len(plain))
        every = table[words.codes] if len(words.codes) else np.zeros(0, np.uint64)
        kept = every != 0
        total = np.concatenate([[0], np.cumsum(kept)])
        self.symbols = every[kept]
        self.starts = total[words.starts]
        self.places = (np.arange(len(every)) - np.repeat(words.starts[:-1], words.counts))[kept]


def rolling(symbols: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n symbols that begin at each place."""
    if len(symbols) < n:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(symbols) - n + 1, np.uint64)
    for i in range(n):
        h = mix(h ^ symbols[i:len(symbols) - n + 1 + i], i + 1)
    return h


def moves(symbols: np.ndarray, step: int) -> np.ndarray:
    """Whether each walk (a line of symbols) moves on after a step: 0 or 1."""
    seeds = (step * WALKS + np.arange(1, WALKS + 1)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mix(symbols ^ seeds[:, None], 0) >> np.uint64(63)).astype(np.int64)


def walked(rows: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The random-walk embeddings of rows of symbols at the given steps (in
    ascending order): step x walk x row."""
    n, m = rows.shape
    padded = np.concatenate([rows, np.full((n, 1), PAD)], axis=1)
    at, each = np.zeros((WALKS, n), np.int64), np.arange(n)
    out = np.empty((len(places), WALKS, n), np.uint64)
    line = 0
    for j in range(int(places[-1]) + 1 if len(places) else 0):
        symbols = padded[each, at]
        if places[line] == j:
            out[line] = symbols
            line += 1
        at += moves(symbols, j)
        np.minimum(at, m, out=at)
    return out


def steps_read(items: np.ndarray) -> np.ndarray:
    """The steps at which each walk is still inside every item."""
    n, m = items.shape
    at, each, steps = np.zeros((WALKS, n), np.int64), np.arange(n), np.zeros(WALKS, np.int64)
    inside, step = np.ones(WALKS, bool), 0
    while inside.any():
        steps += inside
        at += moves(items[each, np.minimum(at, m - 1)], step)
        inside &= at.max(1) < m
        step += 1
    return steps


def signatures(rows: np.ndarray, samples: np.ndarray) -> np.ndarray:
    """A hash of the symbols at the places of each sample, one line a sample.
    Sample r reads walk r (mod ``WALKS``)."""
    places, line = np.unique(samples, return_inverse=True)
    embedded = walked(rows, places)
    walk = np.arange(len(samples)) % WALKS
    out = np.zeros((len(samples), len(rows)), np.uint64)
    for i, lines in enumerate(line.reshape(samples.shape).T):
        out = mix(out ^ embedded[lines, walk], i + 1)
    return out


@dataclass
class SizeClass:
    """The items of one length, and the samples drawn for them."""
    m: int
    k: int
    items: np.ndarray                     # rows of symbols
    ids: list[int]
    samples: np.ndarray | None = field(init=False)   # repetition x place
    tables: list[tuple[np.ndarray, np.ndarray]] = field(init=False)

    def __post_init__(self):
        self.samples = draw_samples(self.items, self.k)
        self.tables = []
        if self.samples is not None:
            known = signatures(self.items, self.samples)
            order = np.argsort(known, axis=1, kind="stable").astype(np.int32)
            self.tables = list(zip(np.take_along_axis(known, order, axis=1), order))

    @property
    def at_once(self) -> int:
        """Windows taken together: fewer of long items."""
        return max(1, min(AT_ONCE, HELD // (2 * self.m * WALKS)))

    def collide(self, windows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The (window, item) pairs that share a bucket in some repetition, each
        pair once, in parts of about ``PAIRS`` as the repetitions go."""
        n_items = len(self.items)
        if self.samples is None:
            step = max(1, PAIRS // n_items)
            for at in range(0, len(windows), step):
                n = min(step, len(windows) - at)
                yield np.repeat(np.arange(at, at + n), n_items), np.tile(np.arange(n_items), n)
            return
        seen = np.zeros(0, np.int64)
        for (known, order), s in zip(self.tables, signatures(windows, self.samples)):
            low, high = np.searchsorted(known, s, "left"), np.searchsorted(known, s, "right")
            hit = np.nonzero(high > low)[0]
            part = np.cumsum((high - low)[hit]) // PAIRS
            for own in np.split(hit, np.nonzero(np.diff(part))[0] + 1):
                n = (high - low)[own]
                item = order[np.repeat(low[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                pairs = np.setdiff1d(np.repeat(own, n) * n_items + item, seen)
                if len(pairs):
                    seen = np.union1d(seen, pairs)
                    yield pairs // n_items, pairs % n_items


def draw_samples(items: np.ndarray, k: int) -> np.ndarray | None:
    """The places of each repetition, so many repetitions that windows with k
    random edits meet their item with the target probability; None if
    ``MAX_REPETITIONS`` are not enough."""
    m = items.shape[1]
    rng = np.random.default_rng(1000 + m)
    steps = steps_read(items)
    if k == 0:
        return rng.integers(0, steps[0], (1, min(3 * m, 8)))
    samples = rng.integers(0, steps[np.arange(MAX_REPETITIONS) % WALKS][:, None],
                           (MAX_REPETITIONS, SAMPLE_PLACES))
    found = []
    for trial in range(2):
        which = (np.arange(TRIALS) + trial * TRIALS) % len(items)
        met = np.zeros((MAX_REPETITIONS, TRIALS), bool)
        step = max(1, HELD // (2 * m * WALKS))
        for at in range(0, TRIALS, step):
            own = items[which[at:at + step]]
            edited = np.array([edit_at_random(item, k, rng) for item in own])
            met[:, at:at + step] = signatures(own, samples) == signatures(edited, samples)
        found.append(np.logical_or.accumulate(met, axis=0).mean(1))
    reached = np.nonzero(np.minimum(*found) >= TARGET_RECALL)[0]
    return samples[:reached[0] + 1] if len(reached) else None


def edit_at_random(item: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """The item after k random edits, cut or padded to its length."""
    words = item.tolist()
    for _ in range(k):
        kind, at = rng.integers(3), int(rng.integers(len(words)))
        if kind == 0:
            words[at] = int(rng.integers(1, 1 << 62))
        elif kind == 1 and len(words) > 1:
            del words[at]
        else:
            words.insert(at, int(rng.integers(1, 1 << 62)))
    words += [int(rng.integers(1, 1 << 62)) for _ in range(len(item))]
    return np.array(words[:len(item)], np.uint64)


@dataclass
class Block:
    """A block of items: size classes, and the piece beginnings by length."""
    classes: list[SizeClass]
    anchors: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # hash, class, offset

    def matches(self, texts: pa.Array) -> list[tuple[int, int, int, int, int]]:
        """(text, item id, start word, words, edits) of the best stretch of each
        text and item."""
        found = Symbols(texts)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for c, (begins, owner) in self._windows(found).items():
            size = self.classes[c]
            for at in range(0, len(begins), size.at_once):
                part = slice(at, at + size.at_once)
                self._verify(found, size, begins[part], owner[part], best)
        return [(t, i, int(found.places[b]), int(found.places[b + n - 1] - found.places[b]) + 1, e)
                for (t, i), (e, b, n) in sorted(best.items(), key=str)]

    def _windows(self, found: Symbols) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """The window starts to look at, by size class, and their texts."""
        starts: dict[int, list[np.ndarray]] = defaultdict(list)
        text_of = np.repeat(np.arange(len(found.starts) - 1), np.diff(found.starts))
        for n, (hashes, size, offset) in self.anchors.items():
            h = rolling(found.symbols, n)
            filter_bits = np.zeros(1 << 20, bool)
            filter_bits[(hashes >> np.uint64(44)).astype(np.int64)] = True
            maybe = np.nonzero(filter_bits[(h >> np.uint64(44)).astype(np.int64)])[0]
            maybe = maybe[text_of[maybe] == text_of[maybe + n - 1]]
            low, high = (np.searchsorted(hashes, h[maybe], side) for side in ("left", "right"))
            count = high - low
            places = np.repeat(maybe, count)
            which = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(len(places))
            for c in np.unique(size[which]):
                mine = which[size[which] == c]
                begin = places[size[which] == c] - offset[mine]
                k = self.classes[c].k
                # no window begins before its text, so a cut-off beginning starts with it
                own = text_of[places[size[which] == c]]
                all_ = np.maximum(begin[:, None] + np.arange(-k, k + 1), found.starts[own][:, None])
                starts[c].append(np.unique(all_))
        out = {}
        for c, parts in starts.items():
            begins = np.unique(np.concatenate(parts))
            begins = begins[begins < len(found.symbols)]
            out[c] = begins, text_of[begins]
        return out

    @staticmethod
    def _verify(found: Symbols, size: SizeClass, begins: np.ndarray, owner: np.ndarray, best: dict
                ) -> None:
        m = size.m
        ends = found.starts[owner + 1]
        for windows, items in size.collide(stretch(found.symbols, begins, ends, m)):
            for at in range(0, len(windows), size.at_once):
                Block._verify_pairs(found, size, begins, owner, windows[at:at + size.at_once],
                                    items[at:at + size.at_once], best)

    @staticmethod
    def _verify_pairs(found: Symbols, size: SizeClass, begins: np.ndarray, owner: np.ndarray,
                      window: np.ndarray, item: np.ndarray, best: dict) -> None:
        m, k = size.m, size.k
        first = np.maximum(begins[window] - k, found.starts[owner[window]])
        around = stretch(found.symbols, first, found.starts[owner[window] + 1], m + 3 * k)
        edits, end = edit_distance(size.items[item], around)
        good = np.nonzero(edits <= k)[0]
        if not len(good):
            return
        n = stretch_length(size.items[item[good]], around[good], end[good], edits[good])
        for g, length in zip(good.tolist(), n.tolist()):
            text = int(owner[window[g]])
            # never beyond the text: padding there matches no word
            begin = int(first[g] + end[g] - length)
            key, got = (text, size.ids[item[g]]), (int(edits[g]), begin, length)
            best[key] = min(best.get(key, got), got)


def stretch(symbols: np.ndarray, begins: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Rows of n symbols from each beginning, padded beyond each end."""
    at = begins[:, None] + np.arange(n)
    inside = at < ends[:, None]
    return np.where(inside, symbols[np.where(inside, at, 0)], PAD)


def _last_row(items: np.ndarray, texts: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The last row of the edit distance tables, from a given first row."""
    n, width = texts.shape
    ramp = np.arange(width + 1)
    row = np.broadcast_to(first, (n, width + 1))
    for i in range(items.shape[1]):
        new = np.empty((n, width + 1), np.int64)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, :-1] + (texts != items[:, i:i + 1]), row[:, 1:] + 1)
        row = np.minimum.accumulate(new - ramp, axis=1) + ramp
    return row


def edit_distance(items: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the least edit distance of the item to any stretch of the
    text, and where the first such stretch ends."""
    row = _last_row(items, texts, np.zeros(texts.shape[1] + 1, np.int64))
    return row.min(1), row.argmin(1)


def stretch_length(items: np.ndarray, texts: np.ndarray, end: np.ndarray, edits: np.ndarray
                   ) -> np.ndarray:
    """The length of the stretch that ends there at that distance, the nearest
    to the item's (the shorter on ties)."""
    m, width = items.shape[1], texts.shape[1]
    at = end[:, None] - 1 - np.arange(width)
    backward = np.where(at >= 0, np.take_along_axis(texts, np.maximum(at, 0), axis=1), PAD)
    row = _last_row(items[:, ::-1], backward, np.arange(width + 1))
    length = np.arange(width + 1)
    fits = (row == edits[:, None]) & (length <= end[:, None])
    return np.where(fits, np.abs(length - m) * 2 + (length > m), 4 * width).argmin(1)


def build_block(items: list[tuple[int, str]], max_edit: float) -> Block:
    texts = pa.array([t for _, t in items], pa.string())
    found = Symbols(texts)
    by_size: dict[int, list[int]] = defaultdict(list)
    for i, n in enumerate(np.diff(found.starts).tolist()):
        if n:
            by_size[n].append(i)
    classes, anchors = [], defaultdict(list)
    for m, members in sorted(by_size.items()):
        k = int(max_edit * m + 1e-9)
        rows = np.array([found.symbols[found.starts[i]:found.starts[i + 1]] for i in members])
        n = m // (k + 1)
        for piece in range(k + 1):
            offset = piece * m // (k + 1)
            for h in {int(rolling(r[offset:offset + n], n)[0]) for r in rows}:
                anchors[n].append((h, len(classes), offset))
        classes.append(SizeClass(m, k, rows, [items[i][0] for i in members]))
    tables = {}
    for n, rows in anchors.items():
        rows.sort()
        tables[n] = (np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows]),
                     np.array([r[2] for r in rows]))
    return Block(classes, tables)


def blocks_of(benchmark: DataFrame, max_edit: float, block_bytes: int) -> list[Broadcast]:
    """The items of ``benchmark`` (item_id, text) as broadcast blocks of bounded size."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    total = items.agg(F.sum(F.octet_length("text") + ITEM_BYTES)).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    out = []
    for b in range(n):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()
        out.append(spark.sparkContext.broadcast(build_block(
            sorted({(r.item_id, r.text) for r in mine}, key=lambda r: (r[0] is not None, r[0], r[1])),
            max_edit)))
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, max_edit: float = MAX_EDIT,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, start_word, n_words, edits for each document (doc_id,
    text) and item (item_id, text) that match."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def search(block: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in regroup(batches):
                hits = block.value.matches(text_column(batch))
                if hits:
                    columns = [pa.array(c, pa.int64()) for c in zip(*hits)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(columns[0]), *columns[1:]],
                        names=["doc_id", "item_id", "start_word", "n_words", "edits"])

        return rows.mapInArrow(run, RESULT)

    return reduce(DataFrame.unionByName, map(search, blocks_of(benchmark, max_edit, block_bytes)))


def keep_clean(docs: DataFrame, benchmark: DataFrame, max_edit: float = MAX_EDIT,
               block_bytes: int = BLOCK_BYTES, column: str = "text") -> DataFrame:
    """The rows of ``docs`` that match no item."""
    bounded_batches(docs.sparkSession)

    def without(rows: DataFrame, block: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in regroup(batches):
                keep = np.ones(batch.num_rows, bool)
                keep[[hit[0] for hit in block.value.matches(text_column(batch, column))]] = False
                yield batch.filter(pa.array(keep))

        return rows.mapInArrow(run, rows.schema)

    return reduce(without, blocks_of(benchmark, max_edit, block_bytes), docs)
