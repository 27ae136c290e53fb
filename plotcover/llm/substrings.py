"""Exact substring deduplication by a distributed merge sort of suffixes (operator 9).

A byte goes when it is covered by a string of ``LENGTH`` bytes that also starts
in a document with a smaller doc_id.

1. Anchors.  Every window of ``LENGTH`` bytes has a minimizer: the leftmost of
   its ``KMER``-byte strings with the smallest hash.  Equal windows have it at
   the same place, so each window belongs to one anchor and windows need only
   be compared between equal anchors.  Each task sends the hashes of its
   anchors, sorted and packed; a hash that two documents hold is shared.
   Shared hashes go into a bitmap of fixed size, which is broadcast; a false
   bit costs work, never a result.
2. Suffixes.  For each shared anchor a task takes the suffix that begins there, as far as the anchor's
   windows reach, followed by what stands before it, read backwards.  A task
   sorts its suffixes and sends front-coded runs: of each suffix only what
   differs from the one before, with the smallest doc_id that has it.
3. Merge.  The runs of a bucket meet in a loser tree that keeps, for each
   loser, the length of the prefix it shares with the winner; suffixes are
   compared only beyond prefixes known to be equal.  Equal suffixes fall
   together.  The windows of the distinct suffixes are then grouped by content,
   and each gets the smallest doc_id that holds it.
   An anchor that stands at more than ``HOT`` places (a phrase shorter than a
   window, each time among other text) would meet in one merge task as a whole.
   Its suffixes skip the merge: each task sends the windows of its distinct
   ones by 128 bits of content hash, and the smallest doc_id of each window
   comes from an aggregate that Spark combines before its shuffle.
4. Verdicts.  Suffixes whose windows occur in a smaller document are joined to
   the places that hold them; the covered stretches are collected by document.
   Only documents that lose bytes are shuffled, found by a Bloom filter of
   fixed size over their names.

Hot passages: equal suffixes of a task travel once, and the join of places and
verdicts is one that Spark can split.  A null text counts as empty; a null
doc_id is smaller than any other; rows with the same doc_id do not remove from
each other.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plotcover.llm import bloom
from plotcover.llm.chunks import text_bytes
from plotcover.llm.common import bounded_batches, materialize, regroup, text_column

LENGTH = 50
KMER = 24                         # three words of eight bytes
PLACES = LENGTH - KMER + 1        # k-mers of a window
REACH = PLACES - 1                # how far before its anchor a window may begin
WIDTH = LENGTH + REACH + 4        # bytes of a suffix row, a multiple of eight
PARTS = ("known", "rests", "ids", "several")   # columns of a run
BITMAP_BITS = 27                  # 16 MB, whatever the input
BUCKET_ANCHORS = 1_000_000
MERGE_ANCHORS = 500_000            # anchors to a merge bucket; few of them are shared
RUN_SUFFIXES = 300_000             # suffixes of a run, over all buckets
SLICE = 50_000                     # distinct suffixes whose windows are compared at once
HOT = 20_000                       # places of an anchor beyond which its windows are spread
HOT_SUFFIXES = 1 << 16             # hot suffixes of a task made distinct at once
PART = 1024                        # suffixes whose windows are hashed at once, in the CPU's cache
HOT_PART = 4096                    # distinct hot suffixes whose windows are made at once
FLUSH = 1_000_000
TEXT_BYTES = 1 << 19              # text whose anchors are found at once
BLOCK = 1 << 15                   # windows whose minimizers are found at once, in the CPU's cache
NO_ID = -(1 << 63)
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
A, B, C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9))
SECOND = np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Anchors:
    """The anchors of a batch of texts: place in the joined bytes, text, hash,
    and the first and last window start that belong to each."""
    body: np.ndarray
    starts: np.ndarray
    at: np.ndarray
    owner: np.ndarray
    hash: np.ndarray
    low: np.ndarray
    high: np.ndarray


def find_anchors(texts: pa.Array) -> Anchors:
    body, starts = text_bytes(texts)
    none = np.zeros(0, np.int64)
    if len(body) < LENGTH:
        return Anchors(body, starts, none, none, none.astype(np.uint64), none, none)
    words = np.ndarray(len(body) - 7, "<u8", body, strides=(1,))     # eight bytes from each place
    at = minimizers(words)
    # a text's windows end LENGTH bytes before the next text begins
    some = np.diff(starts) >= LENGTH
    new = np.concatenate([[True], at[1:] != at[:-1]])
    ends = starts[1:][some] - LENGTH + 1
    new[starts[:-1][some]] = new[ends[ends < len(new)]] = True
    low = np.nonzero(new)[0]
    high = np.append(low[1:], len(new)) - 1
    owner = np.searchsorted(starts, low, side="right") - 1
    inside = low + LENGTH <= starts[owner + 1]
    low, high, owner = low[inside], high[inside], owner[inside]
    at = at[low].astype(np.int64)
    return Anchors(body, starts, at, owner, kmer_hashes(*(words[at + n] for n in (0, 8, 16))), low, high)


def kmer_hashes(one: np.ndarray, two: np.ndarray, three: np.ndarray) -> np.ndarray:
    """A hash of each k-mer from its three words."""
    h, t = one * A, two * B
    t >>= np.uint64(7)
    h ^= t
    np.multiply(three, C, out=t)
    t >>= np.uint64(13)
    h ^= t
    np.right_shift(h, np.uint64(29), out=t)
    h ^= t
    h *= C
    return h


def minimizers(words: np.ndarray) -> np.ndarray:
    """Where the minimizer of the window from each place begins, whatever text it is in."""
    total = len(words) + 8 - LENGTH
    out = np.empty(total, np.uint32)
    places = np.arange(BLOCK + REACH, dtype=np.uint64)
    for begin in range(0, total, BLOCK):
        size = min(BLOCK, total - begin)
        own = words[begin:begin + size + REACH + 16].copy()
        least = kmer_hashes(own[:-16], own[8:-8], own[16:])
        least &= np.uint64(0xFFFFFFFF00000000)
        least |= places[:len(least)]
        n = 1
        while 2 * n <= PLACES:
            least = np.minimum(least[:-n], least[n:])
            n *= 2
        if n < PLACES:
            least = np.minimum(least[:len(least) - (PLACES - n)], least[PLACES - n:])
        out[begin:begin + size] = least.astype(np.uint32)      # the low half
        out[begin:begin + size] += np.uint32(begin)
    return out


def slots(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each hash, and 32 bits of it within the bucket."""
    bucket = (hashes >> np.uint64(40)) % np.uint64(buckets)
    return bucket.astype(np.int64), (hashes * A >> np.uint64(32)).astype(np.uint32)


def bit_of(bucket: np.ndarray, value: np.ndarray, buckets: int) -> np.ndarray:
    """The bitmap bit of a value: each bucket has its own stretch."""
    each = (1 << BITMAP_BITS) // buckets // 8 * 8
    return bucket * each + (value.astype(np.uint64) * np.uint64(each) >> np.uint64(32)).astype(np.int64)


def shared_bitmap(docs: DataFrame, buckets: int, hot: int = HOT) -> tuple[np.ndarray, np.ndarray]:
    """A bitmap of the anchor hashes that two documents hold, and the sorted keys
    (bucket and 32 bits) of those that stand at more than ``hot`` places."""
    each = (1 << BITMAP_BITS) // buckets // 8 * 8

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        docs_before = 0
        for batch in regroup(batches, TEXT_BYTES):
            found = find_anchors(text_column(batch))
            held.append((found.hash, found.owner + docs_before))
            docs_before += batch.num_rows
            if sum(len(h) for h, _ in held) >= FLUSH:
                yield flushed(held)
                held = []
        if held:
            yield flushed(held)

    def flushed(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        values, owner = (np.concatenate(x) for x in zip(*held))
        keys = hot_keys(*slots(values, buckets))
        order = np.argsort(keys)
        keys, owner = keys[order], owner[order]
        equal = keys[1:] == keys[:-1]
        new = np.concatenate([[True], ~equal])[:len(keys)]
        first = np.nonzero(new)[0]
        # held by several documents here: sent twice, so it counts as shared at once
        several = np.zeros(len(first), bool)
        several[(np.cumsum(new) - 1)[1:][equal & (owner[1:] != owner[:-1])]] = True
        count = np.repeat(np.diff(np.append(first, len(keys))), 1 + several).astype(np.uint32)
        count[(np.cumsum(1 + several) - 1)[several]] = 0    # the second time without its places
        keys = np.repeat(keys[first], 1 + several)
        bucket, value = (keys >> np.uint64(32)).astype(np.int64), keys.astype(np.uint32)
        ends = np.searchsorted(bucket, np.arange(buckets), "right")
        begins = np.concatenate([[0], ends[:-1]])
        some = np.nonzero(ends > begins)[0]
        return pa.RecordBatch.from_pydict({
            "bucket": pa.array(some, pa.int64()),
            "block": pa.array([value[begins[b]:ends[b]].tobytes() for b in some], pa.binary()),
            "counts": pa.array([count[begins[b]:ends[b]].tobytes() for b in some], pa.binary())})

    def meet(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        values, counts = (np.frombuffer(b"".join(table.column(c).to_pylist()), np.uint32)
                          for c in ("block", "counts"))
        pairs = np.sort(values.astype(np.uint64) << np.uint64(32) | counts)
        values, counts = (pairs >> np.uint64(32)).astype(np.uint32), pairs.astype(np.uint32)
        shared = values[:-1][values[1:] == values[:-1]]
        first = np.nonzero(np.concatenate([[True], values[1:] != values[:-1]]))[0]
        many = values[first][np.add.reduceat(counts, first, dtype=np.int64) > hot]
        bit = np.unique(bit_of(np.zeros(1, np.int64), shared, buckets))
        bits = np.zeros(each // 8, np.uint8)
        np.bitwise_or.at(bits, bit >> 3, np.uint8(1) << (bit & 7).astype(np.uint8))
        return pa.table({"bucket": pa.array([bucket], pa.int64()), "bits": pa.array([bits.tobytes()], pa.binary()),
                         "hot": pa.array([many.tobytes()], pa.binary())})

    rows = (docs.select("text").mapInArrow(send, "bucket long, block binary, counts binary")
            .groupBy("bucket").applyInArrow(meet, "bucket long, bits binary, hot binary").toArrow())
    out = np.zeros((1 << BITMAP_BITS) // 8, np.uint8)
    for bucket, bits in zip(rows.column("bucket").to_pylist(), rows.column("bits").to_pylist()):
        out[bucket * each // 8:(bucket + 1) * each // 8] = np.frombuffer(bits, np.uint8)
    keys = [hot_keys(np.int64(bucket), np.frombuffer(many, np.uint32))
            for bucket, many in zip(rows.column("bucket").to_pylist(), rows.column("hot").to_pylist())]
    return out, np.sort(np.concatenate([np.zeros(0, np.uint64), *keys]))


def hot_keys(bucket: np.ndarray, value: np.ndarray) -> np.ndarray:
    return bucket.astype(np.uint64) << np.uint64(32) | value.astype(np.uint64)


def is_hot(hashes: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(hashes), bool)
    keys = hot_keys(*slots(hashes, buckets))
    return hot[np.minimum(np.searchsorted(hot, keys), len(hot) - 1)] == keys


def is_shared(found: Anchors, bitmap: np.ndarray, buckets: int) -> np.ndarray:
    bit = bit_of(*slots(found.hash, buckets), buckets)
    return (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0


# -- suffixes -----------------------------------------------------------------

#: Row n keeps the first n bytes of a row.
UP_TO = np.where(np.arange(LENGTH) < np.arange(LENGTH + 1)[:, None], 255, 0).astype(np.uint8)


def suffix_rows(found: Anchors, picks: np.ndarray) -> np.ndarray:
    """Of each picked anchor a row of ``WIDTH`` bytes: from the anchor to the end
    of its last window, then from before the anchor back to its first window
    (both padded with zeros), and at the end both lengths."""
    at, low, end = found.at[picks], found.low[picks], found.high[picks] + LENGTH
    ahead, behind = end - at, at - low
    rows = np.zeros((len(picks), WIDTH), np.uint8)
    padded = np.zeros(len(found.body) + 2 * LENGTH, np.uint8)
    padded[LENGTH:-LENGTH] = found.body
    rows[:, :LENGTH] = bytes_from(padded, at + LENGTH, LENGTH) & UP_TO[ahead]
    rows[:, LENGTH:LENGTH + REACH] = bytes_from(
        padded[::-1].copy(), len(padded) - LENGTH - at, REACH) & UP_TO[behind, :REACH]
    rows[:, -2], rows[:, -1] = behind, ahead
    return rows


def bytes_from(body: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """A row of the ``size`` bytes from each place."""
    strings = np.ndarray(len(body) - size + 1, f"V{size}", body, strides=(1,))
    return strings[places].view(np.uint8).reshape(-1, size)


def row_hashes(rows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row, whose width is a multiple of eight."""
    h = np.full(len(rows), C)
    for word in np.ascontiguousarray(rows).view(np.uint64).T:
        h = (h ^ word) * A
        h ^= h >> np.uint64(31)
        h *= B
        h ^= h >> np.uint64(28)
    return h


def sorted_runs(rows: np.ndarray, ids: np.ndarray, merges: int
                ) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
    """(bucket, shared prefixes, rests, smallest ids, held by several) of the
    distinct rows of each bucket in order, front-coded."""
    bucket = (row_hashes(rows[:, :KMER]) >> np.uint64(20)) % np.uint64(merges)
    order = np.argsort(rows.view(f"S{WIDTH}").ravel(), kind="stable")
    order = order[np.argsort(bucket[order], kind="stable")]
    rows, ids, bucket = rows[order], ids[order], bucket[order]
    same = rows[1:] == rows[:-1]
    known = np.where(same.all(1), WIDTH, same.argmin(1))
    known = np.concatenate([[0], np.where(bucket[1:] == bucket[:-1], known, 0)])
    first = np.nonzero(known < WIDTH)[0]
    least = np.minimum.reduceat(ids, first)
    several = (np.maximum.reduceat(ids, first) != least).astype(np.uint8)
    rows, known, bucket = rows[first], known[first].astype(np.uint8), bucket[first].astype(np.int64)
    fresh = np.arange(WIDTH) >= known[:, None]
    cuts = np.concatenate([[0], np.nonzero(np.diff(bucket))[0] + 1, [len(bucket)]])
    for b, e in zip(cuts[:-1], cuts[1:]):
        yield (int(bucket[b]), known[b:e].tobytes(), rows[b:e][fresh[b:e]].tobytes(),
               least[b:e].tobytes(), several[b:e].tobytes())


class Run:
    """A front-coded run, read one suffix after the other."""

    __slots__ = ("known", "rests", "ids", "several", "next", "at", "string")

    def __init__(self, known: bytes, rests: bytes, ids: bytes, several: bytes):
        self.known, self.rests, self.several = known, rests, several
        self.ids = np.frombuffer(ids, np.int64).tolist()
        self.next = self.at = 0
        self.string: bytes | None = b""

    def step(self) -> int:
        """On to the next suffix: the bytes it shares with the one before, or -1
        at the end."""
        if self.next == len(self.known):
            self.string = None
            return -1
        n = self.known[self.next]
        end = self.at + WIDTH - n
        self.string = self.string[:n] + self.rests[self.at:end]
        self.at = end
        self.next += 1
        return n


def shared_prefix(a: int, b: int) -> int:
    """How many bytes two suffixes, given as big-endian integers, share."""
    return WIDTH - ((a ^ b).bit_length() + 7 >> 3)


def merged(runs: list[Run]) -> Iterator[tuple[bytes, int, int, int]]:
    """The suffixes of sorted runs in order: (suffix, bytes shared with the one
    before, id, held by several).  A loser tree: each inner node keeps the run
    that lost there, and ``known[run]`` the prefix that its head shares with the
    last winner along its path.  The head with the longer one is smaller, and
    only where both are as long are suffixes compared, as integers."""
    width = 1
    while width < len(runs):
        width *= 2
    known = [r.step() for r in runs] + [-1] * (width - len(runs))
    heads = [int.from_bytes(r.string or b"") for r in runs] + [0] * (width - len(runs))
    tree = [0] * width

    def loses(a: int, b: int) -> bool:
        """Whether head a loses to head b; the loser's known prefix is set."""
        x, y = known[a], known[b]
        if x != y or x < 0:
            return x < y or x == y
        n = shared_prefix(heads[a], heads[b])
        if heads[a] <= heads[b]:
            known[b] = n
            return False
        known[a] = n
        return True

    def play(node: int) -> int:
        if node >= width:
            return node - width
        a, b = play(2 * node), play(2 * node + 1)
        if loses(a, b):
            a, b = b, a
        tree[node] = b
        return a

    winner = play(1) if runs else 0
    while runs and known[winner] >= 0:
        run = runs[winner]
        at = run.next - 1
        yield run.string, known[winner], run.ids[at], run.several[at]
        mine = known[winner] = run.step()
        head = heads[winner] = int.from_bytes(run.string or b"")
        node = (winner + width) >> 1
        while node:
            other = tree[node]
            theirs = known[other]
            # most matches are decided here, by the known prefixes alone
            if theirs > mine or theirs == mine >= 0:
                rival = heads[other]
                if theirs == mine:
                    shared = shared_prefix(head, rival)
                    if head <= rival:
                        known[other] = shared
                        node >>= 1
                        continue
                    known[winner] = shared
                tree[node] = winner
                winner, mine, head = other, theirs, rival
            node >>= 1


def slices(suffixes_in_order: Iterator[tuple[bytes, int, int, int]], size: int = SLICE
           ) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """The distinct suffixes in order, with the smallest id of each and whether
    several documents hold it, in slices that end between two anchors.  A suffix
    that shares all its bytes with the one before is the same one."""
    strings: list[bytes] = []
    ids: list[int] = []
    shared: list[int] = []
    for string, known, doc, several in suffixes_in_order:
        if known == WIDTH:
            shared[-1] |= several | (doc != ids[-1])
            if doc < ids[-1]:
                ids[-1] = doc
            continue
        if known < KMER and len(strings) >= size:
            yield strings, np.array(ids, np.int64), np.array(shared, bool)
            strings, ids, shared = [], [], []
        strings.append(string)
        ids.append(doc)
        shared.append(several)
    if strings:
        yield strings, np.array(ids, np.int64), np.array(shared, bool)


def suffix_windows(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The windows of joined suffix rows: all their text in reading order, where
    each window begins there, its row and its offset before the anchor."""
    at = np.arange(0, len(flat), WIDTH)
    behind, ahead = flat[at + WIDTH - 2].astype(np.int64), flat[at + WIDTH - 1].astype(np.int64)
    n = ahead - LENGTH + behind + 1                    # windows of each suffix
    # the text of a suffix in reading order
    size = ahead + behind
    base = np.cumsum(size) - size
    j = np.arange(size.sum()) - np.repeat(base, size)
    s, b = np.repeat(at, size), np.repeat(behind, size)
    text = flat[s + np.where(j < b, LENGTH + b - 1 - j, j - b)]
    window = np.repeat(base - (np.cumsum(n) - n), n) + np.arange(n.sum())
    row = np.repeat(np.arange(len(at)), n)
    return text, window, row, behind[row] - (window - base[row])


def hashed_windows(flat: np.ndarray) -> tuple[np.ndarray, ...]:
    """``suffix_windows`` with the hash of each window, from a few suffixes at a time."""
    parts, length = [], 0
    for at in range(0, len(flat), PART * WIDTH):
        text, window, row, offset = suffix_windows(flat[at:at + PART * WIDTH])
        parts.append((text, window + length, row + at // WIDTH, offset, window_hashes(text)[window]))
        length += len(text)
    return tuple(np.concatenate(x) for x in zip(*parts))


def window_owners(strings: list[bytes], ids: np.ndarray, shared: np.ndarray
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(suffix, first offset, last offset, smallest id) of runs of windows, where
    some holder of the suffix may come after that id.  Offset o: the window that
    begins o bytes before the anchor."""
    text, window, row, offset, h = hashed_windows(np.frombuffer(b"".join(strings), np.uint8))
    order = np.argsort(h)
    group = np.concatenate([[0], np.cumsum(h[order][1:] != h[order][:-1])])
    sizes = np.bincount(group)
    many = np.nonzero(sizes[group] > 1)[0]
    least = ids[row].copy()
    if len(many):
        w = window[order[many]]
        same_next = group[many][1:] == group[many][:-1]
        step = 1 << 16
        for at in range(0, len(w) - 1, step):           # equal hashes, so equal bytes: make sure
            to = min(at + step, len(w) - 1)
            differ = (text[w[at:to, None] + np.arange(LENGTH)]
                      != text[w[at + 1:to + 1, None] + np.arange(LENGTH)]).any(1)
            if (differ & same_next[at:to]).any():
                raise ArithmeticError("two windows share a 64-bit hash")
        first = np.nonzero(np.concatenate([[True], ~same_next]))[0]
        smallest = np.minimum.reduceat(ids[row[order[many]]], first)
        least[order[many]] = np.repeat(smallest, np.diff(np.append(first, len(many))))
    # offsets fall along a suffix; runs of equal smallest ids become one
    begin = np.nonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (least[1:] != least[:-1])]))[0]
    last = np.append(begin[1:], len(row)) - 1
    some = shared[row[begin]] | (least[begin] < ids[row[begin]])
    begin, last = begin[some], last[some]
    return row[begin], offset[last], offset[begin], least[begin]


def hot_windows(rows: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The windows of the distinct ones of suffix rows: the suffix, the offset, two
    hashes of the content, the smallest and the largest id that has the suffix."""
    hashes = row_hashes(rows)
    order = np.argsort(hashes, kind="stable")
    first = np.nonzero(np.concatenate([[True], np.diff(hashes[order]) != 0]))[0]
    least, most = (f.reduceat(ids[order], first) for f in (np.minimum, np.maximum))
    picks = order[first]
    for at in range(0, len(picks), HOT_PART):
        part = slice(at, at + HOT_PART)
        text, window, row, offset = suffix_windows(rows[picks[part]].ravel())
        yield pa.RecordBatch.from_pydict({
            "suffix": hashes[picks[part]][row].view(np.int64), "offset": offset.astype(np.int32),
            "one": window_hashes(text)[window].view(np.int64),
            "two": window_hashes(text, SECOND)[window].view(np.int64),
            "low": least[part][row], "high": most[part][row]})


def hot_verdicts(windows: DataFrame) -> DataFrame:
    """The verdicts (suffix, first, last, least) of hot suffixes from their windows."""
    owners = (windows.groupBy("one", "two").agg(F.min("low").alias("least"), F.max("high").alias("top"))
              .where("least < top").drop("top"))
    found = (windows.join(owners, ["one", "two"]).where("least < high")
             .groupBy("suffix", "offset").agg(F.min("least").alias("least")))
    # runs of offsets with equal smallest ids become one; a suffix has at most PLACES
    along = Window.partitionBy("suffix").orderBy("offset")
    goes_on = (F.lag("offset").over(along) == F.col("offset") - 1) & (F.lag("least").over(along) == F.col("least"))
    return (found.withColumn("new", F.when(goes_on, 0).otherwise(1))
            .withColumn("run", F.sum("new").over(along))
            .groupBy("suffix", "run").agg(F.min("offset").alias("first"), F.max("offset").alias("last"),
                                          F.min("least").alias("least"))
            .select("suffix", "first", "last", "least"))


def window_hashes(text: np.ndarray, factor_of: np.uint64 = B) -> np.ndarray:
    """A 64-bit hash of the LENGTH bytes from each place (short at the end)."""
    table = (np.arange(1, 257, dtype=np.uint64) * A)
    table = (table ^ (table >> np.uint64(31))) * C
    table ^= table >> np.uint64(28)
    h = np.zeros(len(text), np.uint64)
    coded = table[text]
    # doubling: the hash of 2 n bytes from two hashes of n bytes
    parts, n, power = {1: coded}, 1, {1: int(factor_of)}
    while 2 * n <= LENGTH:
        longer = parts[n].copy()
        longer[:len(text) - n] += parts[n][n:] * np.uint64(power[n])
        parts[2 * n], power[2 * n] = longer, power[n] * power[n] & (1 << 64) - 1
        n *= 2
    done, factor = 0, 1
    for n in sorted(parts, reverse=True):
        if done + n <= LENGTH:
            h[:len(text) - done] += parts[n][done:] * np.uint64(factor)
            factor = factor * power[n] & (1 << 64) - 1
            done += n
    return (h ^ (h >> np.uint64(32))) * A


# -- Spark --------------------------------------------------------------------

def deduplicate(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    spark = docs.sparkSession
    bounded_batches(spark, TEXT_BYTES)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    anchors = int(total * 2 / (PLACES + 1))
    buckets = max(1, min(1 << 20, anchors // BUCKET_ANCHORS))
    shared, spread = shared_bitmap(rows, buckets, hot)
    bitmap, hot_anchors = spark.sparkContext.broadcast(shared), spark.sparkContext.broadcast(spread)

    merges = max(1, anchors // MERGE_ANCHORS)

    def shared_of(batch: pa.RecordBatch) -> tuple[Anchors, np.ndarray]:
        found = find_anchors(text_column(batch))
        return found, np.nonzero(is_shared(found, bitmap.value, buckets))[0]

    def ids_of(batch: pa.RecordBatch) -> np.ndarray:
        return np.array([NO_ID if d is None else d for d in batch.column(0).to_pylist()], np.int64)

    def suffixes(batches: Iterator[pa.RecordBatch], hot_ones: bool, most: int
                 ) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in regroup(batches, TEXT_BYTES):
            found, picks = shared_of(batch)
            picks = picks[is_hot(found.hash[picks], hot_anchors.value, buckets) == hot_ones]
            if len(picks):
                held.append((suffix_rows(found, picks), ids_of(batch)[found.owner[picks]]))
            if sum(len(h) for _, h in held) >= most:
                yield held
                held = []
        if held:
            yield held

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in suffixes(batches, False, RUN_SUFFIXES):
            yield run_rows(held)

    def spread_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in suffixes(batches, True, HOT_SUFFIXES):
            yield from hot_windows(*(np.concatenate(x) for x in zip(*held)))

    def run_rows(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        packed = zstandard.ZstdCompressor(1)
        columns = list(zip(*sorted_runs(*(np.concatenate(x) for x in zip(*held)), merges)))
        return pa.RecordBatch.from_pydict(
            {"bucket": pa.array(columns[0], pa.int64())}
            | {name: pa.array(map(packed.compress, column), pa.binary())
               for name, column in zip(PARTS, columns[1:])})

    def merge(table: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor().decompress
        own = [Run(*map(unpack, row)) for row in zip(*[table.column(c).to_pylist() for c in PARTS])]
        return pa.concat_tables([_no_verdicts(), *(_verdicts(*part) for part in slices(merged(own)))])

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, TEXT_BYTES):
            found, picks = shared_of(batch)
            owner = found.owner[picks]
            hashes = row_hashes(suffix_rows(found, picks))
            yield pa.RecordBatch.from_pydict({
                "suffix": hashes.view(np.int64), "name": names_of(batch)[owner],
                "doc": ids_of(batch)[owner],
                "at": (found.at[picks] - found.starts[owner]).astype(np.int32)})

    verdicts = (rows.mapInArrow(runs, "bucket long, " + ", ".join(f"{c} binary" for c in PARTS))
                .groupBy("bucket").applyInArrow(merge, "suffix long, first int, last int, least long"))
    if len(spread):
        windows = rows.mapInArrow(
            spread_windows, "suffix long, offset int, one long, two long, low long, high long")
        verdicts = verdicts.unionByName(hot_verdicts(materialize(windows, "hot_windows")))
    covered = (rows.mapInArrow(places, "suffix long, name long, doc long, at int")
               .join(verdicts, "suffix").where("least < doc")
               .select("name", F.struct((F.col("at") - F.col("last")).alias("begin"),
                                        (F.col("at") - F.col("first") + LENGTH).alias("end")).alias("span")))
    spans = materialize(covered.groupBy("name").agg(F.collect_set("span").alias("spans")), "spans")
    touched = spark.sparkContext.broadcast(bloom.build(spans, "name"))

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches):
            batch = batch.filter(pa.array(~bloom.contains(touched.value, names_of(batch).view(np.uint64))))
            if batch.num_rows:
                yield judged(batch.column(0), text_column(batch), [[]] * batch.num_rows)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches):
            batch = batch.append_column("name", pa.array(names_of(batch)))
            batch = batch.filter(pa.array(bloom.contains(
                touched.value, batch.column(2).to_numpy().view(np.uint64))))
            if batch.num_rows:
                yield batch

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches):
            yield judged(batch.column(0), text_column(batch), span_lists(batch.column(2)))

    whole = (rows.mapInArrow(named, "doc_id long, text string, name long")
             .join(spans, "name", "left").select("doc_id", "text", "spans"))
    return rows.mapInArrow(plain, RESULT).unionByName(whole.mapInArrow(finish, RESULT))


def _verdicts(strings: list[bytes], ids: np.ndarray, shared: np.ndarray) -> pa.Table:
    """Suffixes by their hash, with the runs of windows and their smallest id."""
    row, first, last, least = window_owners(strings, ids, shared)
    hashes = row_hashes(np.frombuffer(b"".join(strings), np.uint8).reshape(-1, WIDTH))[row]
    return pa.table({"suffix": hashes.view(np.int64), "first": first.astype(np.int32),
                     "last": last.astype(np.int32), "least": least})


def _no_verdicts() -> pa.Table:
    return pa.schema([("suffix", pa.int64()), ("first", pa.int32()), ("last", pa.int32()),
                      ("least", pa.int64())]).empty_table()


def names_of(batch: pa.RecordBatch) -> np.ndarray:
    """A name for each (doc_id, text): equal rows share it, and so their result."""
    return np.fromiter((xxhash.xxh3_64_intdigest(f"{d}\0{t}") for d, t in zip(
        batch.column(0).to_pylist(), text_column(batch).to_pylist())), np.uint64,
        batch.num_rows).view(np.int64)


def span_lists(spans: pa.ListArray) -> list[list[tuple[int, int]]]:
    """The spans of each row as pairs; of a null none."""
    flat = spans.flatten()
    pairs = list(zip(*(flat.field(k).to_numpy().tolist() for k in ("begin", "end"))))
    ends = np.cumsum(pc.fill_null(pc.list_value_length(spans), 0).to_numpy()).tolist()
    return [pairs[b:e] for b, e in pairwise([0, *ends])]


def judged(doc_ids: pa.Array, texts: pa.Array, spans: list[list[tuple[int, int]]]) -> pa.RecordBatch:
    rows = []
    for text, own in zip(texts.to_pylist(), spans):
        data = text.encode()
        kept, removed, n_spans, at = [], 0, 0, 0
        end = -1
        for b, e in sorted(own):
            if b > end:
                kept.append(data[at:b])
                n_spans += 1
                removed += e - b
                end = at = e
            elif e > end:
                removed += e - end
                end = at = e
        kept.append(data[at:])
        rows.append((len(data), removed, n_spans, hashlib.sha256(b"".join(kept)).hexdigest()))
    columns = list(zip(*rows))
    return pa.RecordBatch.from_pydict({
        "doc_id": doc_ids, "n_bytes": pa.array(columns[0], pa.int64()),
        "n_removed": pa.array(columns[1], pa.int64()), "n_spans": pa.array(columns[2], pa.int64()),
        "kept_sha256": columns[3]})
