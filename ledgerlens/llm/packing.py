"""Packing of token sequences by exact-complement hashing.

Pieces are at most ``cap`` tokens long, so everything the packing decides on
is the histogram of lengths: at most ``cap`` counters, whatever the corpus.
The plan is made on those counters: for the longest open length, a single
length, a pair or a triple that fills the gap exactly is looked up among the
lengths still available and consumed as often as the counts allow; what
finds no exact complement is packed best-fit. Every step uses up a length,
so the plan has a few times ``cap`` patterns at most. Spark then numbers the
pieces of each length and a join on (length, rank) puts each one in its
place. A length that holds a third of all pieces is numbered in salted parts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialized
from .common import byte_symbols, id_and_text, slices

CAP = 2048
PIECES_SCHEMA = ("doc_id long, piece int, start long, length long, ids_crc32 long")

# ---- token ids ----------------------------------------------------------
#: Texts made of these characters only are split alike by every reading of the
#: vocabulary's pattern; other texts go through the tokenizer's own library.
_OUTSIDE = re.compile("[^\t\n\r\x20-\x7eÀ-ÖØ-öø-ɏ]")
#: The pattern of byte-level vocabularies.
_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
            r"|\s+(?!\S)|\s+")


class Encoder:
    """Ids of a text as little-endian uint32 bytes, as the tokenizer's library gives them.

    The merges of a byte-level vocabulary are ranked by token id, so the
    library's vocabulary also serves as the rank table of a faster encoder.
    Texts with special strings or rare characters take the library itself.
    """

    def __init__(self, tokenizer_path: str):
        import tiktoken
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(tokenizer_path)
        special = sorted((t.content for t in self.library.get_added_tokens_decoder().values()),
                         key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        of = byte_symbols()
        ranks = {bytes(of[c] for c in token): rank for token, rank in
                 self.library.get_vocab(with_added_tokens=False).items()}
        self.fast = tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)   # bytes of each id
        self.sizes[list(ranks.values())] = [len(b) for b in ranks]

    def encode(self, text: str) -> bytes:
        if _OUTSIDE.search(text) or self.special.search(text):
            ids = self.library.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut(n: int, cap: int = CAP) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` ids; only the first may be shorter."""
    if n <= cap:
        return [(0, n)]
    first = n % cap
    starts = ([0] if first else []) + list(range(first, n, cap))
    return list(zip(starts, np.diff([*starts, n]).tolist()))


def pieces(docs: DataFrame, tokenizer_path: str, cap: int = CAP, end_id: int = 0) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document's ids and one end id."""
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        for batch in slices(batches):
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoder.encode(text) + end
                view = memoryview(ids)
                for k, (start, length) in enumerate(cut(len(ids) // 4, cap)):
                    crc = zlib.crc32(view[4 * start:4 * (start + length)])
                    for column, value in zip(out, (doc, k, start, length, crc)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()),
                 *(pa.array(c, pa.int64()) for c in out[2:])],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return (id_and_text(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
            .mapInArrow(run, PIECES_SCHEMA))


# ---- plan on the length histogram ---------------------------------------
@dataclass(frozen=True)
class Pattern:
    """``times`` sequences, each holding ``parts`` = ((length, copies), ...)."""

    times: int
    parts: tuple[tuple[int, int], ...]


def _grouped(lengths: list[int]) -> tuple[tuple[int, int], ...]:
    return tuple((n, lengths.count(n)) for n in sorted(set(lengths), reverse=True))


def _single(left: np.ndarray, gap: int) -> list[int] | None:
    return [gap] if left[gap] > 0 else None


def _pair(left: np.ndarray, gap: int) -> list[int] | None:
    a = np.arange(gap - 1, (gap - 1) // 2, -1)
    a = a[a >= 1]
    ok = (left[a] > 0) & (left[gap - a] > (a == gap - a))
    return [int(a[i]), gap - int(a[i])] if a.size and ok[i := int(ok.argmax())] else None


def _triple(left: np.ndarray, gap: int) -> list[int] | None:
    for a in np.flatnonzero(left[:gap - 1] > 0)[::-1]:
        if 3 * a < gap:
            return None
        left[a] -= 1
        rest = _pair(left, gap - int(a))
        left[a] += 1
        if rest and rest[0] <= a:
            return [int(a), *rest]
    return None


def exact_complements(left: np.ndarray, cap: int) -> list[Pattern]:
    """Consume exact fills from ``left`` (count by length), longest length first."""
    found = []
    for n in range(cap, 0, -1):
        while left[n] > 0:
            left[n] -= 1
            gap = cap - n
            rest: list[int] | None = []
            if gap:
                rest = _single(left, gap) or _pair(left, gap) or _triple(left, gap)
            left[n] += 1
            if rest is None:
                break
            parts = _grouped([n, *rest])
            times = int(min(left[m] // k for m, k in parts))
            for m, k in parts:
                left[m] -= times * k
            found.append(Pattern(times, parts))
    return found


def best_fit(left: np.ndarray, cap: int) -> list[Pattern]:
    """Pack what is left: open with the longest length, fill each gap with the longest fit."""
    found = []
    while (open_lengths := np.flatnonzero(left)).size:
        parts: list[tuple[int, int]] = []
        gap = cap
        for m in open_lengths[::-1].tolist():
            if m <= gap and (k := int(min(left[m], gap // m))):
                parts.append((m, k))
                gap -= m * k
        times = int(min(left[m] // k for m, k in parts))
        for m, k in parts:
            left[m] -= times * k
        found.append(Pattern(times, tuple(parts)))
    return found


def plan(histogram: dict[int, int], cap: int = CAP) -> list[Pattern]:
    left = np.zeros(cap + 1, np.int64)
    for n, count in histogram.items():
        left[n] = count
    return exact_complements(left, cap) + best_fit(left, cap)


def slot_rows(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """``(length, rank_from, rank_to, copies, first_sequence, offset)`` of each pattern's parts."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for p in patterns:
        offset = 0
        for n, k in p.parts:
            at = used.get(n, 0)
            rows.append((n, at, at + p.times * k, k, sequence, offset))
            used[n] = at + p.times * k
            offset += n * k
        sequence += p.times
    return rows


# ---- placement ----------------------------------------------------------
#: Rows that one part of a length's numbering is meant to hold.
RANK_ROWS = 500_000


def _ranked(cut_pieces: DataFrame, salts: int) -> DataFrame:
    """0-based rank of each piece among those of its length, in salted parts.

    Parts go by the written row number ``_n``, so that rows of one id spread as well.
    """
    salted = cut_pieces.withColumn(
        "_salt", F.pmod(F.xxhash64("_n"), F.lit(salts)).cast("int"))
    sizes = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("length").orderBy("_salt")
    offsets = sizes.select("length", "_salt", (F.sum("_size").over(before) - F.col("_size"))
                           .alias("_before"))
    inside = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "_n")
    return (salted.withColumn("_row", F.row_number().over(inside) - 1)
            .join(offsets, ["length", "_salt"])
            .withColumn("_rank", F.col("_before") + F.col("_row"))
            .drop("_salt", "_row", "_before", "_n"))


def pack(docs: DataFrame, tokenizer_path: str, cap: int = CAP, end_id: int = 0) -> DataFrame:
    """Pack all documents into sequences of at most ``cap`` tokens.

    Per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.
    A NULL or empty text is the end id alone. Pieces of a longer document
    are ``cap`` long, but for the first, which takes the remainder. Repeated
    rows are packed as often as they occur. An empty table gives no rows.

    The driver sees the histogram of lengths (at most ``cap`` rows) and makes
    the plan; its slot table has a few rows per length and is broadcast.
    """
    spark = docs.sparkSession
    cut_pieces = materialized(pieces(docs, tokenizer_path, cap, end_id).withColumn(
        "_n", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["n"] for r in cut_pieces.groupBy("length").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    rows = slot_rows(plan(histogram, cap))
    slots = spark.createDataFrame(
        rows, "length long, rank_from long, rank_to long, copies long, first long, at long")
    salts = 4 + sum(histogram.values()) // RANK_ROWS
    placed = _ranked(cut_pieces, salts).alias("p").join(
        F.broadcast(slots).alias("s"),
        F.expr("p.length = s.length AND p._rank >= s.rank_from AND p._rank < s.rank_to"))
    return placed.selectExpr(
        "p.doc_id", "p.piece", "p.start", "p.length", "p.ids_crc32",
        "s.first + (p._rank - s.rank_from) DIV s.copies AS sequence_id",
        "s.at + ((p._rank - s.rank_from) % s.copies) * p.length AS offset")
