"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handled at once inside a task; a longer text is one slice of its own.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` only (NULL text as empty); extra columns cannot clash."""
    return docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def remainder(doc_id: str | Column, modulus: int) -> Column:
    """``crc32(doc_id as text) mod modulus``; NULL ids count as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus)).cast("int")


def crc32_of(doc_id: object) -> int:
    """Python twin of the hash inside ``remainder``."""
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


#: A group with more than this part of all rows is looked up by broadcast.
HOT_PART = 1000


def spread_join(rows: DataFrame, groups: DataFrame, keys: list[str], size: str,
                total: int) -> DataFrame:
    """``rows`` left joined with ``groups`` (one row per key, no NULL keys) without a hot task.

    ``size`` names the column of ``groups`` that tells how many of ``total`` rows a
    key has; it is dropped. At most ``HOT_PART`` groups hold more than a
    ``HOT_PART``-th of the rows: those are broadcast, and their rows are dealt evenly
    in the shuffle that meets the other groups.
    """
    limit = max(1, total // HOT_PART)
    values = [c for c in groups.columns if c not in (*keys, size)]
    hot = groups.filter(F.col(size) > limit).select(
        *keys, F.struct(*values).alias("_hot"), F.lit(True).alias("_is_hot"))
    rest = groups.filter(F.col(size) <= limit).select(
        *keys, F.struct(*values).alias("_rest"), F.lit(0).cast("long").alias("_deal"))
    dealt = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "_deal", F.when(F.col("_is_hot"), F.monotonically_increasing_id() + 1).otherwise(F.lit(0)))
    return dealt.join(rest, [*keys, "_deal"], "left").select(
        *rows.columns,
        *[F.when(F.col("_is_hot"), F.col(f"_hot.{c}")).otherwise(F.col(f"_rest.{c}")).alias(c)
          for c in values])


def slices(batches: Iterator[pa.RecordBatch], size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches with a ``text`` column into slices of about ``size`` text bytes.

    Row order is kept and every row is in one slice, so the working memory
    of a task follows ``size`` and the longest text, not the batch length.
    """
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        col = batch.column(batch.schema.get_field_index("text"))
        lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(col), 0), dtype=np.int64)
        ends = np.cumsum(lengths)
        at = 0
        while at < n:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + size, side="right")))
            yield batch.slice(at, to - at)
            at = to


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one uint8 array, and the n + 1 offsets into it (NULL: empty)."""
    col = pa.compute.fill_null(col, "")
    if pa.types.is_large_string(col.type):
        kind = np.int64
    else:
        col, kind = col.cast(pa.string()), np.int32
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, dtype=kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = (np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]] if data is not None
           else np.zeros(0, np.uint8))
    return raw, at - at[0]


SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of every code point: white space, letter, number, other."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            a, b = ord(m[0][0]), ord(m[0][-1])
            out[a:b + 1] = kind
    return out


def byte_symbols() -> dict[str, int]:
    """Printable stand-in of each byte in byte-level vocabularies, and the byte it stands for.

    Bytes that print as one visible character stand for themselves, the
    others take the code points from 256 on in order.
    """
    visible = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1),
               *range(ord("®"), ord("ÿ") + 1)]
    symbols = {chr(b): b for b in visible}
    for k, b in enumerate(sorted(set(range(256)) - set(visible))):
        symbols[chr(256 + k)] = b
    return symbols
