"""Token-id output as length-delimited binary records (operator 6).

A record file is a run of frames.  One frame holds one document:

    length   u64   bytes of data
    check    u32   masked CRC-32 of the eight length bytes
    data           doc_id i64, id width u8 (2 or 4 bytes), the ids
    check    u32   masked CRC-32 of data

All integers are little-endian.  The mask is the usual rotation by 15 bits
plus a constant, so that a checksum stored inside checksummed data is no
fixed point.  Beside each file lies its offset index: ``doc_id i64, offset
u64, bytes u64`` per frame, for reads in any order.

Files are written by tasks into the shared folder, each under a name of its
own attempt, and count only if the manifest (a table) names them: a lost,
repeated or speculative task leaves nothing that is read.  Documents are
range-partitioned by doc_id and sorted, so the parts in order are the ids in
ascending doc_id order; equal doc_ids are ordered by text.  A null text is the
empty sequence (just the end id), a null doc_id sorts first and is kept as
null through a reserved smallest value.  An empty table gives an empty
manifest.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plotcover.llm.bpe import encoder
from plotcover.llm.common import bounded_batches, materialize, regroup, text_column
from plotcover.sources.sinks import scratch_folder

MASK_DELTA = 0xA282EAD8  # fixed value of the masked checksum
NO_ID = -(1 << 63)       # stands for a null doc_id in a frame
INDEX_ENTRY = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("bytes", "<u8")])
READ_BYTES = 8 << 20
ENCODE_BYTES = 8 << 20   # text encoded at once: each of its distinct words once
MANIFEST = "part int, path string, index_path string, records long, tokens long"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(data: bytes) -> bytes:
    length = struct.pack("<Q", len(data))
    return b"".join((length, struct.pack("<I", masked_crc(length)), data,
                     struct.pack("<I", masked_crc(data))))


def unframe(block: bytes | memoryview, at: int) -> tuple[bytes, int]:
    """The data of the frame that begins at ``at``, and where the next begins."""
    length = bytes(block[at:at + 8])
    if struct.unpack_from("<I", block, at + 8)[0] != masked_crc(length):
        raise ValueError(f"record length at byte {at} fails its checksum")
    end = at + 12 + struct.unpack("<Q", length)[0]
    data = bytes(block[at + 12:end])
    if struct.unpack_from("<I", block, end)[0] != masked_crc(data):
        raise ValueError(f"record data at byte {at} fails its checksum")
    return data, end + 4


def pack_ids(doc_id: int | None, ids: np.ndarray) -> bytes:
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    return struct.pack("<qB", NO_ID if doc_id is None else doc_id, width) + \
        ids.astype(f"<u{width}").tobytes()


def unpack_ids(data: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, width = struct.unpack_from("<qB", data)
    return None if doc_id == NO_ID else doc_id, np.frombuffer(data, f"<u{width}", offset=9)


def open_folder(uri: str):
    """The file system and path of a folder given by URI or plain path."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (
        fs.LocalFileSystem(), uri)


def write_token_records(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None
                        ) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write record files; the manifest."""
    spark = docs.sparkSession
    bounded_batches(spark)
    folder = folder or scratch_folder(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        store, root = open_folder(folder)
        name = f"{root}/part-{part:06d}-{uuid.uuid4().hex}"
        out, entries, at, tokens, records = None, [], 0, 0, 0
        for batch in regroup(batches, ENCODE_BYTES):
            if out is None:
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(f"{name}.rec")
            ids, starts = encoder(tokenizer).encode(text_column(batch))
            doc_ids = batch.column(0).to_pylist()
            frames = []
            for i, doc_id in enumerate(doc_ids):
                own = np.append(ids[starts[i]:starts[i + 1]], np.uint32(end_id))
                framed = frame(pack_ids(doc_id, own))
                entries.append((NO_ID if doc_id is None else doc_id, at, len(framed)))
                at += len(framed)
                frames.append(framed)
            out.write(b"".join(frames))
            tokens += int(starts[-1]) + len(doc_ids)
            records += len(doc_ids)
        if out is None:
            return
        out.close()
        with store.open_output_stream(f"{name}.idx") as index:
            index.write(np.array(entries, INDEX_ENTRY).tobytes())
        yield pa.RecordBatch.from_pydict(
            {"part": [part], "path": [f"{name}.rec"], "index_path": [f"{name}.idx"],
             "records": [records], "tokens": [tokens]},
            schema=pa.schema([("part", pa.int32()), ("path", pa.string()),
                              ("index_path", pa.string()), ("records", pa.int64()),
                              ("tokens", pa.int64())]))

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange("doc_id", F.xxhash64("text"))
               .sortWithinPartitions("doc_id", "text"))
    written = ordered.mapInArrow(write, MANIFEST)
    # what is read is the manifest that was stored, never a task run again
    return materialize(written.withColumn("folder", F.lit(folder)), "manifest")


def read_token_records(spark: SparkSession, manifest: DataFrame, shuffle_seed: int | None = None
                       ) -> DataFrame:
    """Every record of the files in a manifest: doc_id, start (ids of all
    records before it), n_tokens, ids_crc32.  With a seed the frames of a file
    are fetched in random order through its offset index, each checked alone."""
    bounded_batches(spark)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.withColumn(
        "base", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long")))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                store, _ = open_folder(part["folder"])
                with store.open_input_file(part["index_path"]) as f:
                    index = np.frombuffer(f.read(), INDEX_ENTRY)
                with store.open_input_file(part["path"]) as f:
                    yield from read_file(f, index, part["base"])

    def read_file(f, index: np.ndarray, base: int) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        if shuffle_seed is None:
            # frames lie one after the other: fetch them by runs of READ_BYTES
            run = (np.cumsum(index["bytes"]) // READ_BYTES).astype(np.int64)
            for group in np.split(np.arange(len(index)), np.nonzero(np.diff(run))[0] + 1):
                first, last = index[group[0]], index[group[-1]]
                f.seek(int(first["offset"]))
                block = memoryview(f.read(int(last["offset"] + last["bytes"] - first["offset"])))
                at = 0
                for _ in group:
                    data, at = unframe(block, at)
                    doc_id, ids = unpack_ids(data)
                    rows.append((doc_id, base, len(ids),
                                 zlib.crc32(ids.astype("<u4").tobytes())))
                    base += len(ids)
                yield as_batch(rows)
                rows = []
            return
        for i in np.random.default_rng(shuffle_seed).permutation(len(index)):
            f.seek(int(index["offset"][i]))
            data, _ = unframe(f.read(int(index["bytes"][i])), 0)
            doc_id, ids = unpack_ids(data)
            rows.append((doc_id, None, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
            if len(rows) == 4096:
                yield as_batch(rows)
                rows = []
        yield as_batch(rows)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    spread = parts.select("path", "index_path", "folder", "base").repartition(
        spark.sparkContext.defaultParallelism * 4, "path")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
