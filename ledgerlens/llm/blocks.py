"""Documents packed into blocks, the unit that talks to hash-partitioned parts.

A corpus-wide question about hashes (who else has this anchor, how often does
this word occur) goes out as one row per block and part, and comes back as
one row per part and block. Each distinct hash leaves a block once, so a
hash that a third of all rows have reaches its part once per block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, slices, text_bytes

#: Text bytes of a block; a longer text is a block of its own.
BLOCK_BYTES = 2 << 20


@dataclass(frozen=True)
class Block:
    """Texts in ascending order of id; ``known[k]`` is False for a NULL id."""

    ids: np.ndarray
    known: np.ndarray
    offsets: np.ndarray
    data: np.ndarray


def blocks_of(batches: Iterator[pa.RecordBatch], block_bytes: int = BLOCK_BYTES
              ) -> Iterator[tuple[int, Block]]:
    """Number and texts of the blocks of a task's ``doc_id, text`` batches, one at a time."""
    from pyspark import TaskContext
    first = TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []
    size = count = 0

    def block() -> Block:
        t = pa.Table.from_batches(held).combine_chunks()
        ids = t["doc_id"].combine_chunks()
        known = np.asarray(ids.is_valid())
        ids = np.asarray(ids.fill_null(0))
        order = np.lexsort((ids, ~known))
        raw, offsets = text_bytes(t["text"].combine_chunks().take(pa.array(order)))
        return Block(ids[order], known[order], offsets, raw)

    for batch in slices(batches, max(1, block_bytes // 4)):
        held.append(batch)
        size += int(pa.compute.sum(pa.compute.binary_length(batch.column(1))).as_py() or 0)
        if size >= block_bytes:
            yield first + count, block()
            held, size, count = [], 0, count + 1
    if held:
        yield first + count, block()


def packable(docs: DataFrame) -> DataFrame:
    """The columns that ``blocks_of`` takes."""
    return id_and_text(docs).withColumn("doc_id", F.col("doc_id").cast("long"))


def packed(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``block, ids, known, lengths, payload`` with the texts compressed.

    The layout follows the partitions of the scan: write the result once
    and read that wherever blocks have to be the same.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block in blocks_of(batches, block_bytes):
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([block.ids.tobytes()]),
                 pa.array([block.known.tobytes()]), pa.array([np.diff(block.offsets).tobytes()]),
                 pa.array([zstandard.ZstdCompressor(level=1).compress(block.data.tobytes())])],
                names=["block", "ids", "known", "lengths", "payload"])

    return packable(docs).mapInArrow(
        run, "block long, ids binary, known binary, lengths binary, payload binary")


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch one by one, so that one block is held at a time."""
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


def unpack(row: dict) -> Block:
    lengths = np.frombuffer(row["lengths"], np.int64)
    raw = zstandard.ZstdDecompressor().decompress(row["payload"],
                                                  max_output_size=int(lengths.sum()) + 1)
    return Block(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["known"], bool),
                 np.concatenate([[0], np.cumsum(lengths)]), np.frombuffer(raw, np.uint8))


def by_part(part: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Positions of each part that occurs, parts in order."""
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    for k in range(parts):
        if cuts[k] < cuts[k + 1]:
            yield k, order[cuts[k]:cuts[k + 1]]
