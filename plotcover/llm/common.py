"""Helpers the text operators share: Arrow batch bounds, batches regrouped by
bytes, words of a batch as integer codes, per-document digests."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby, pairwise
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from plotcover.session import ensure_checkpoint_dir
from plotcover.sources.sinks import materialize  # noqa: F401  (used by the operators)

BATCH_BYTES = 2 << 20    # bytes of text a Python task works on at once
BATCH_ROWS = 2000


def bounded_batches(spark: SparkSession, max_bytes: int = BATCH_BYTES,
                    max_rows: int = BATCH_ROWS) -> None:
    """Bound the Arrow batches sent to Python by bytes, so that a run of very
    long texts never fills a worker's memory."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(max_rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(max_bytes))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def regroup(batches: Iterable[pa.RecordBatch], max_bytes: int = BATCH_BYTES
            ) -> Iterator[pa.RecordBatch]:
    """Join small record batches until they hold ``max_bytes``; empty ones go."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        size += batch.nbytes
        if size >= max_bytes:
            yield joined(held)
            held, size = [], 0
    if held:
        yield joined(held)
    # a worker lives on after its task: give back what Arrow keeps for later
    pa.default_memory_pool().release_unused()


def joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(batches) == 1:
        return batches[0]
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The texts, a null text as the empty string."""
    return pc.fill_null(batch.column(batch.schema.get_field_index(name)), "")


class Words:
    """The words (runs without ASCII white space) of a batch of texts.

    ``codes`` has one entry per word in order, an index into ``vocabulary``
    (the distinct words); document i has words ``starts[i]:starts[i + 1]``."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(texts)
        at = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        self.vocabulary: pa.Array = coded.dictionary
        self.starts = (at - at[0]).astype(np.int64)
        blank = pc.index(self.vocabulary, "").as_py()
        if blank >= 0:
            kept = codes != blank
            self.starts = np.concatenate([[0], np.cumsum(kept)])[self.starts]
            codes = codes[kept]
        self.codes: np.ndarray = codes

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.starts)

    @property
    def owner(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.starts) - 1), self.counts)


def gather_lists(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray,
                 picks: np.ndarray) -> np.ndarray:
    """Concatenate the lists ``flat[starts[p]:starts[p] + lens[p]]`` for p in picks."""
    n = lens[picks]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts[picks] - (ends - n), n) + np.arange(total)]


def grouped(frame: DataFrame, keys: tuple[str, str], order: tuple[str, ...],
            work: Callable[[tuple[int, int], Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
            schema: str) -> DataFrame:
    """Run ``work`` on the rows of each value of two long keys, sorted by
    ``order`` and handed over batch by batch, so that a group never has to be
    in memory as a whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def slices():
            for batch in batches:
                one, two = (batch.column(batch.schema.get_field_index(k)).to_numpy() for k in keys)
                new = np.nonzero((one[1:] != one[:-1]) | (two[1:] != two[:-1]))[0] + 1
                for a, b in pairwise([0, *new.tolist(), batch.num_rows]):
                    if b > a:
                        yield (int(one[a]), int(two[a])), batch.slice(a, b - a)

        for key, own in groupby(slices(), itemgetter(0)):
            yield from work(key, (s for _, s in own))

    return (frame.repartition(*keys).sortWithinPartitions(*keys, *order)
            .mapInArrow(run, schema))
