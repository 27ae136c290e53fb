"""BPE encoding with content-defined chunk reuse, and decoding (operator 1).

A rolling hash over the last 16 bytes cuts each text where the hash has ten
leading zero bits, so equal passages of different documents fall into equal
chunks whatever stands around them.

1. Each task lists the keys (128-bit hashes) of its chunks; the keys of chunks
   that two or more documents hold are the shared ones.
2. A Bloom filter of fixed size over the shared keys splits the documents.
   Those without a shared chunk are encoded where they are read: no shuffle.
3. The others are stored.  Each of their shared chunks is encoded once, and
   its ids are joined to the documents that hold it.
4. A document is put together from the ids of its shared chunks and of the
   runs between them.  A cut may fall inside a word, so at every join the word
   across it is encoded anew, and the words next to it are encoded again and
   compared with what the chunks have at that end; while they differ, the span
   encoded anew grows by a word.

A null text counts as empty; documents may repeat, and every row gets its
result.  An empty table gives no rows.  A chunk is at most ``MAX_CHUNK``
bytes, so a text without cuts is still cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotcover.llm import bloom
from plotcover.llm.bpe import encoder
from plotcover.llm.common import bounded_batches, materialize, regroup, text_column

WINDOW = 16        # bytes the rolling hash sees
CUT_BITS = 10      # one cut in about 2^10 bytes
MAX_CHUNK = 1 << 14
TEXT_BYTES = 2 << 20   # text a task works on at once
BLANKS = b" \t\n\r\x0b\x0c"


def gear_table() -> np.ndarray:
    """256 random-looking 32-bit numbers, from a fixed mixing rule."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(32)).astype(np.uint32)


GEAR = gear_table()


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and where each begins (one entry more)."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[at[0]:at[-1]], (at - at[0]).astype(np.int64)


def cut_points(body: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sorted positions where a chunk begins, the beginnings of texts included."""
    h = GEAR[body]
    step = 1
    while step < WINDOW:
        h[step:] += h[:-step] << np.uint32(step)
        step *= 2
    cuts = np.nonzero(h >> np.uint32(32 - CUT_BITS) == 0)[0] + 1
    cuts = cuts[cuts < len(body)]
    cuts = cuts[(body[cuts] & 0xC0) != 0x80]              # never inside a character
    begins = starts[np.searchsorted(starts, cuts, side="right") - 1]
    cuts = cuts[cuts - begins >= WINDOW]                  # the window lies in the text
    points = np.union1d(cuts, starts)
    long = np.nonzero(np.diff(points) > MAX_CHUNK)[0]
    forced = [p for i in long for p in _forced(body, points[i], points[i + 1])]
    return np.union1d(points, np.array(forced, np.int64)) if forced else points


def _forced(body: np.ndarray, begin: int, end: int) -> Iterator[int]:
    p = begin + MAX_CHUNK
    while p < end:
        while p < end and body[p] & 0xC0 == 0x80:
            p += 1
        if p < end:
            yield p
        p += MAX_CHUNK


class Chunked:
    """The chunks of a batch of texts: bounds, owners and 128-bit keys."""

    def __init__(self, texts: pa.Array):
        body, self.starts = text_bytes(texts)
        points = cut_points(body, self.starts) if len(body) else np.zeros(1, np.int64)
        self.data = body.tobytes()
        self.begins, self.ends = points[:-1], points[1:]
        self.owner = np.searchsorted(self.starts, self.begins, side="right") - 1
        data = memoryview(self.data)
        self.keys = [xxhash.xxh3_128_digest(data[b:e])
                     for b, e in zip(self.begins.tolist(), self.ends.tolist())]

    def hashes(self) -> np.ndarray:
        return np.frombuffer(b"".join(self.keys), np.uint64)[::2]

    def shared(self, words: np.ndarray) -> np.ndarray:
        return bloom.contains(words, self.hashes())


def shared_keys(docs: DataFrame) -> DataFrame:
    """The keys of chunks that two or more documents hold, with the number of
    documents.  Counts are joined in each batch before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, TEXT_BYTES):
            chunks = Chunked(text_column(batch))
            pairs = pa.table({"key": pa.array(chunks.keys, pa.binary()),
                              "owner": pa.array(chunks.owner)}).group_by(["key", "owner"]).aggregate([])
            found = pairs.group_by("key").aggregate([("owner", "count")])
            keys = found.column("key").combine_chunks()
            heads = np.frombuffer(b"".join(keys.to_pylist()), np.int64)[::2]
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(heads), found.column("owner_count").combine_chunks()],
                names=["key", "hash", "n"])

    return (docs.select("text").mapInArrow(count, "key binary, hash long, n long")
            .groupBy("key", "hash").agg(F.sum("n").alias("n_docs")).where("n_docs > 1"))


def encode_documents(docs: DataFrame, tokenizer: str, digests: bool = False) -> DataFrame:
    """Encode ``docs`` (doc_id, text): doc_id, n_tokens, ids (array of int) and
    decoded text; with ``digests`` SHA-256 digests instead of ids and text."""
    spark = docs.sparkSession
    bounded_batches(spark, TEXT_BYTES)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    words = spark.sparkContext.broadcast(bloom.build(shared_keys(rows), "hash"))

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, TEXT_BYTES):
            chunks = Chunked(text_column(batch))
            hit = np.unique(chunks.owner[chunks.shared(words.value)])
            if len(hit):
                yield batch.take(pa.array(hit))

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, TEXT_BYTES):
            chunks = Chunked(text_column(batch))
            own = np.ones(batch.num_rows, bool)
            own[chunks.owner[chunks.shared(words.value)]] = False
            batch = batch.filter(pa.array(own))
            if batch.num_rows:
                ids, starts = encoder(tokenizer).encode(text_column(batch))
                yield _finish(batch.column(0), [ids[a:b] for a, b in zip(starts, starts[1:])],
                              tokenizer, digests)

    def chunk_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, TEXT_BYTES):
            chunks = Chunked(text_column(batch))
            at = {chunks.keys[i]: i for i in np.nonzero(chunks.shared(words.value))[0]}
            yield pa.RecordBatch.from_pydict({
                "key": pa.array(list(at), pa.binary()),
                "text": pa.array([chunks.data[chunks.begins[i]:chunks.ends[i]].decode()
                                  for i in at.values()], pa.string())})

    def chunk_refs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, TEXT_BYTES):
            chunks = Chunked(text_column(batch))
            hit = np.nonzero(chunks.shared(words.value))[0]
            names = _names(batch)
            pairs = {(chunks.owner[i], chunks.keys[i]) for i in hit}
            yield pa.RecordBatch.from_pydict({
                "name": pa.array([names[o] for o, _ in pairs], pa.binary()),
                "key": pa.array([k for _, k in pairs], pa.binary())})

    def encode_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, TEXT_BYTES):
            ids, starts = encoder(tokenizer).encode(text_column(batch))
            data = ids.astype("<u4").tobytes()
            yield pa.RecordBatch.from_pydict({
                "key": batch.column(0),
                "ids": pa.array([data[4 * a:4 * b] for a, b in zip(starts, starts[1:])], pa.binary())})

    def with_name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("name", pa.array(_names(batch), pa.binary()))

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, TEXT_BYTES):
            known = [dict((p["key"], p["ids"]) for p in parts) for parts in
                     batch.column(2).to_pylist()]
            yield _finish(batch.column(0),
                          assemble(text_column(batch), known, encoder(tokenizer)),
                          tokenizer, digests)

    out = "doc_id long, n_tokens long, " + (
        "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string")
    stored = materialize(rows.mapInArrow(linked, "doc_id long, text string"), "linked")
    once = (stored.select("text").mapInArrow(chunk_texts, "key binary, text string")
            .dropDuplicates(["key"]).mapInArrow(encode_chunks, "key binary, ids binary"))
    parts = (stored.mapInArrow(chunk_refs, "name binary, key binary")
             .dropDuplicates(["name", "key"]).join(once, "key")
             .groupBy("name").agg(F.collect_list(F.struct("key", "ids")).alias("parts")))
    joined = (stored.mapInArrow(with_name, "doc_id long, text string, name binary")
              .join(parts, "name").select("doc_id", "text", "parts"))
    return rows.mapInArrow(plain, out).unionByName(joined.mapInArrow(put_together, out))


def _names(batch: pa.RecordBatch) -> list[bytes]:
    """A name for each (doc_id, text): equal rows share it, and so their result."""
    texts = text_column(batch).to_pylist()
    return [xxhash.xxh3_128_digest(f"{d}\0{t}") for d, t in zip(batch.column(0).to_pylist(), texts)]


def _finish(doc_ids: pa.Array, ids: list[np.ndarray], tokenizer: str, digests: bool
            ) -> pa.RecordBatch:
    decoded = encoder(tokenizer).decode([i.tolist() for i in ids])
    columns = {"doc_id": doc_ids, "n_tokens": pa.array(map(len, ids), pa.int64())}
    if digests:
        columns["ids_sha256"] = pa.array([hashlib.sha256(i.astype("<u4").tobytes()).hexdigest()
                                          for i in ids])
        columns["decoded_sha256"] = pa.array([hashlib.sha256(t.encode()).hexdigest()
                                              for t in decoded])
    else:
        columns["ids"] = pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32()))
        columns["decoded"] = pa.array(decoded, pa.string())
    return pa.RecordBatch.from_pydict(columns)


# -- joins ------------------------------------------------------------------

Span = tuple[int, int]
Piece = tuple[int, int, np.ndarray]  # a stretch of a text and its ids, encoded alone


def assemble(texts: pa.Array, known: list[dict[bytes, bytes]], encode) -> list[np.ndarray]:
    """The ids of each text, from the ids of its known chunks and of the runs
    between them, with the joins repaired."""
    chunks = Chunked(texts)
    stretches: list[list[tuple[int, int, np.ndarray | None]]] = [[] for _ in range(len(texts))]
    for i, key in enumerate(chunks.keys):
        begin, end = int(chunks.begins[i]), int(chunks.ends[i])
        own = stretches[chunks.owner[i]]
        ids = known[chunks.owner[i]].get(key)
        if ids is not None:
            own.append((begin, end, np.frombuffer(ids, "<u4")))
        elif own and own[-1][2] is None:
            own[-1] = (own[-1][0], end, None)
        else:
            own.append((begin, end, None))
    data = chunks.data
    memory: dict[Span, np.ndarray] = {}

    def encoded(spans: list[Span]) -> dict[Span, np.ndarray]:
        """Each span of the texts encoded alone, many in one call."""
        new = [s for s in dict.fromkeys(spans) if s not in memory]
        if new:
            ids, at = encode.encode(pa.array([data[b:e].decode() for b, e in new], pa.string()))
            memory.update((s, ids[at[i]:at[i + 1]]) for i, s in enumerate(new))
        return memory

    ids = encoded([(b, e) for own in stretches for b, e, i in own if i is None])
    pieces = [[(b, e, ids[b, e] if i is None else i) for b, e, i in own] for own in stretches]
    encoded([span for own in pieces for bridge in bridges(data, own, 1)
             for span in needed(own, bridge)])
    return [repair(data, own, encoded) for own in pieces]


def _back(data: bytes, at: int, low: int) -> int:
    """Where the word before ``at`` begins, ``low`` at the least."""
    while at > low and data[at - 1] in BLANKS:
        at -= 1
    while at > low and data[at - 1] not in BLANKS:
        at -= 1
    return at


def _on(data: bytes, at: int, high: int) -> int:
    """Where the word after ``at`` ends, ``high`` at the most."""
    while at < high and data[at] in BLANKS:
        at += 1
    while at < high and data[at] not in BLANKS:
        at += 1
    return at


Bridge = tuple[int, int, int, int]  # a <= a2 <= b2 <= b: anchors are [a, a2) and [b2, b)


def bridges(data: bytes, pieces: list[Piece], words: int) -> list[Bridge]:
    """For each cut between pieces the stretch to encode anew: the word across
    the cut, ``words - 1`` more on both sides, and an anchor word beyond.
    Stretches that meet become one."""
    out: list[Bridge] = []
    low, high = (pieces[0][0], pieces[-1][1]) if pieces else (0, 0)
    for _, cut, _ in pieces[:-1]:
        a2 = b2 = cut
        while a2 > low and data[a2 - 1] not in BLANKS:
            a2 -= 1
        while b2 < high and data[b2] not in BLANKS:
            b2 += 1
        for _ in range(words - 1):
            a2, b2 = _back(data, a2, low), _on(data, b2, high)
        bridge = _back(data, a2, low), a2, b2, _on(data, b2, high)
        if out and bridge[0] < out[-1][3]:
            out[-1] = out[-1][0], out[-1][1], bridge[2], bridge[3]
        else:
            out.append(bridge)
    return out


def needed(pieces: list[Piece], bridge: Bridge) -> list[Span]:
    """What must be encoded alone for a bridge: all of it, its anchors, and the
    ends of pieces that it covers in part."""
    a, a2, b2, b = bridge
    ends = [(max(a, p[0]), min(b, p[1])) for p in pieces if p[0] < b and a < p[1]]
    return [(a, b), (a, a2), (b2, b), *ends]


def repair(data: bytes, pieces: list[Piece], encoded) -> np.ndarray:
    """Join the pieces of one text.  A bridge is accepted when it begins and
    ends with the ids of its anchor words and the pieces end and begin with the
    ids of what it covers of them; else all bridges grow by a word.  Once one
    covers the whole text, its ids are the text's."""
    if not pieces:
        return np.zeros(0, np.uint32)
    words = 1
    while True:
        over = bridges(data, pieces, words)
        if over and over[0][0] == pieces[0][0] and over[0][3] == pieces[-1][1]:
            return encoded([over[0][::3]])[over[0][::3]]
        ids = encoded([span for bridge in over for span in needed(pieces, bridge)])
        out = _joined(pieces, over, ids)
        if out is not None:
            return np.concatenate(out)
        words += 1


def _same_ends(whole: np.ndarray, head: np.ndarray, tail: np.ndarray) -> bool:
    return np.array_equal(whole[:len(head)], head) and \
        np.array_equal(whole[len(whole) - len(tail):], tail)


def _joined(pieces: list[Piece], over: list[Bridge], ids: dict) -> list[np.ndarray] | None:
    """The stretches of ids in order, or None where an end does not agree."""
    for a, a2, b2, b in over:
        if not _same_ends(ids[a, b], ids[a, a2], ids[b2, b]):
            return None
    out: list[np.ndarray] = []
    at = 0                       # the next bridge
    for begin, end, own in pieces:
        head = tail = own[:0]
        if at and over[at - 1][3] > begin:
            if over[at - 1][3] >= end:
                continue         # inside the bridge before
            head = ids[begin, over[at - 1][3]]
        if at < len(over) and over[at][0] < end:
            tail = ids[max(begin, over[at][0]), end]
        if not _same_ends(own, head, tail):
            return None
        out.append(own[len(head):max(len(head), len(own) - len(tail))])
        if at < len(over) and over[at][0] < end:
            out.append(ids[over[at][::3]])
            at += 1
    return out
