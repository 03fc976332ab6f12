"""Removal of repeated passages by longest-previous-factor arrays.

A byte goes when a string of ``width`` bytes that covers it also starts in a
document with a smaller id. Suffixes that share so long a prefix must meet, but
not all suffixes can travel. Every window of ``width`` bytes therefore names an
anchor, the least hash among its short substrings: equal windows name equal
anchors, and about one position in eighteen is one. Documents are packed into
blocks, and then

1. the blocks send their anchors' hashes, once per block; anchors met in
   one document only are out of the game;
2. the blocks send, for each anchor left, the bytes that its windows span
   (its zone), equal zones once per block and with their smallest id;
3. each task sorts the suffixes of its zones and reads from them, for each
   suffix, the previous and the next suffix of an earlier document and the
   common prefix with it: the longest previous factor. Windows whose
   factor reaches ``width`` go back to their block;
4. the blocks mark the bytes of those windows and cut them out.

An anchor that very many documents have (a licence line, a hot page) does not
gather its zones in one task: its windows travel one by one under their own
hash, where equal ones fold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialized
from .blocks import BLOCK_BYTES, Block, by_part, packed, rows_of, unpack
from .words import mix, span_hashes

WIDTH = 50
#: Bytes of the substrings among which a window's anchor is the least.
GRAM = 16
#: Text bytes for each of the parts over which anchors and zones are dealt.
PART_BYTES = 4 << 20
#: An anchor of more documents sends its windows one by one.
HOT_DOCUMENTS = 2000
ALONE, SHARED, HOT = 0, 1, 2
_WHOLE = 255   # in an answer: all windows of the zone

_GRAMS = np.random.default_rng(11).integers(0, 1 << 64, 256, dtype=np.uint64)


# ---- anchors and zones --------------------------------------------------
@dataclass(frozen=True)
class Zones:
    """Runs of windows with one anchor: ``first`` to ``last`` window, the anchor and its hash."""

    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    hashes: np.ndarray
    text: np.ndarray


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each position on."""
    h = _GRAMS[data]
    span = 1
    while span < GRAM:
        h = h[:-span] * np.uint64(0x9E3779B97F4A7C15) + (h[span:] ^ (h[span:] >> np.uint64(29)))
        span *= 2
    return mix(h)


def zones(block: Block, width: int = WIDTH) -> Zones:
    """Zones of all windows that lie inside one text with a known id."""
    data, offsets = block.data, block.offsets
    empty = np.zeros(0, np.int64)
    if data.size < width:
        return Zones(empty, empty, empty, np.zeros(0, np.uint64), empty)
    hashes = gram_hashes(data)
    place = np.uint64((1 << 32) - 1)   # ties go to the first, alike in equal windows
    low = (hashes & ~place) | np.arange(hashes.size, dtype=np.uint64)
    count = width - GRAM + 1   # substrings of a window
    span = 1
    while 2 * span <= count:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[:low.size - (count - span)], low[count - span:])
    anchor = (low & place).astype(np.int64)
    inside = np.zeros(data.size + 1, np.int32)   # windows that start in the text and fit
    fits = np.maximum(offsets[1:] - width + 1, offsets[:-1])
    fits[~block.known] = offsets[:-1][~block.known]
    np.add.at(inside, offsets[:-1], 1)
    np.add.at(inside, fits, -1)
    valid = np.cumsum(inside[:anchor.size]) > 0
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
    end = valid.copy()
    end[:-1] &= ~valid[1:] | (anchor[1:] != anchor[:-1])
    edges = offsets[:-1][offsets[:-1] < anchor.size]
    new[edges] |= valid[edges]
    end[edges[edges > 0] - 1] |= valid[edges[edges > 0] - 1]
    first, last = np.flatnonzero(new), np.flatnonzero(end)
    at = anchor[first]
    return Zones(first, last, at, hashes[at], np.searchsorted(offsets, first, side="right") - 1)


def _unique_anchors(z: Zones) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct anchor hashes of a block, the zones' index into them, documents of each (to 255)."""
    known, at = np.unique(z.hashes, return_inverse=True)
    pairs = np.unique(at * np.int64(1 << 31) + z.text)
    return known, at, np.minimum(np.bincount(pairs >> 31, minlength=known.size), 255)


def anchor_rows(blocks: DataFrame, parts: int, width: int) -> DataFrame:
    """``part, block, low, high, documents``: 40 bits of each distinct anchor's hash, by part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                known, _, documents = _unique_anchors(zones(unpack(row), width))
                rest = known // np.uint64(parts)
                out: list[tuple] = []
                for k, pick in by_part((known % np.uint64(parts)).astype(np.int64), parts):
                    out.append((k, row["block"], rest[pick].astype(np.uint32).tobytes(),
                                (rest[pick] >> np.uint64(32)).astype(np.uint8).tobytes(),
                                documents[pick].astype(np.uint8).tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), (
                            pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                        names=["part", "block", "low", "high", "documents"])

    return blocks.mapInArrow(
        run, "part int, block long, low binary, high binary, documents binary")


def anchor_flags(rows: DataFrame, hot: int) -> DataFrame:
    """``block, part, flags``: of each anchor sent, whether it is alone, shared or hot."""
    def decide(t: pd.DataFrame) -> pd.DataFrame:
        low = np.frombuffer(b"".join(t["low"]), np.uint32).astype(np.uint64)
        high = np.frombuffer(b"".join(t["high"]), np.uint8).astype(np.uint64)
        documents = np.frombuffer(b"".join(t["documents"]), np.uint8)
        _, at = np.unique(low | high << np.uint64(32), return_inverse=True)
        total = np.bincount(at, documents)[at]
        flags = np.where(total > hot, HOT, np.where(total > 1, SHARED, ALONE)).astype(np.uint8)
        cuts = np.cumsum([len(x) for x in t["high"]])[:-1]
        return pd.DataFrame({"block": t["block"], "part": t["part"],
                             "flags": [f.tobytes() for f in np.split(flags, cuts)]})

    return rows.groupBy("part").applyInPandas(decide, "block long, part int, flags binary")


def _zone_flags(z: Zones, flags: list, parts: int) -> np.ndarray:
    """Flag of each zone, from what the parts sent back."""
    known, at, _ = _unique_anchors(z)
    out = np.zeros(known.size, np.uint8)
    sent = {f["part"]: f["flags"] for f in flags or ()}
    for k, pick in by_part((known % np.uint64(parts)).astype(np.int64), parts):
        out[pick] = np.frombuffer(sent[k], np.uint8)
    return out[at]


@dataclass(frozen=True)
class Sent:
    """What a block sends: spans of windows under a key, each distinct one once.

    ``copies`` are further spans of the block equal to a sent one, with the
    number of that one in ``copy_of``.
    """

    key: np.ndarray
    first: np.ndarray
    last: np.ndarray
    text: np.ndarray
    copies: tuple[np.ndarray, np.ndarray, np.ndarray]   # first, last, text
    copy_of: np.ndarray


def spans_to_send(block: Block, z: Zones, flags: np.ndarray, width: int) -> Sent:
    shared, hot = np.flatnonzero(flags == SHARED), np.flatnonzero(flags == HOT)
    count = z.last[hot] - z.first[hot] + 1
    windows = np.repeat(z.first[hot], count) + (
        np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
    first = np.concatenate([z.first[shared], windows])
    last = np.concatenate([z.last[shared], windows])
    text = np.concatenate([z.text[shared], np.repeat(z.text[hot], count)])
    content = span_hashes(block.data, first, last + width)
    key = content.copy()
    key[:shared.size] = z.hashes[shared]
    left = np.zeros(first.size, np.uint64)
    left[:shared.size] = (z.anchor[shared] - z.first[shared]).astype(np.uint64)
    same = mix(mix(content + left) ^ key)
    order = np.lexsort((text, same))
    new = np.ones(order.size, bool)
    new[1:] = same[order[1:]] != same[order[:-1]]
    number = np.cumsum(new) - 1
    lead, copy = order[new], order[~new]
    return Sent(key[lead], first[lead], last[lead], text[lead],
                (first[copy], last[copy], text[copy]), number[~new])


def zone_rows(flagged: DataFrame, parts: int, width: int) -> DataFrame:
    """``part, block, payload``: spans sent to the parts of their keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                block = unpack(row)
                z = zones(block, width)
                s = spans_to_send(block, z, _zone_flags(z, row["flags"], parts), width)
                out = []
                for k, pick in by_part((s.key % np.uint64(parts)).astype(np.int64), parts):
                    lengths = s.last[pick] - s.first[pick] + width
                    take = np.repeat(s.first[pick], lengths) + (
                        np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths))
                    out.append((k, row["block"], _pack_spans(
                        s.key[pick], block.ids[s.text[pick]], pick, lengths, block.data[take])))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), (
                            pa.int32(), pa.int64(), pa.binary()))],
                        names=["part", "block", "payload"])

    return flagged.mapInArrow(run, "part int, block long, payload binary")


def _pack_spans(key, doc, number, lengths, data) -> bytes:
    body = (np.int64(key.size).tobytes() + key.tobytes() + doc.astype(np.int64).tobytes()
            + number.astype(np.uint32).tobytes() + lengths.astype(np.uint8).tobytes()
            + data.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(body)


def _unpack_spans(payload: bytes):
    body = zstandard.ZstdDecompressor().decompress(payload)
    n = int(np.frombuffer(body, np.int64, 1)[0])
    at = 8
    out = []
    for kind in (np.uint64, np.int64, np.uint32, np.uint8):
        out.append(np.frombuffer(body, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return (*out, np.frombuffer(body, np.uint8, offset=at))


# ---- suffix order and longest previous factors --------------------------
def suffix_order(data: np.ndarray, start: np.ndarray, doc: np.ndarray, width: int) -> np.ndarray:
    """Order of the suffixes from ``start`` on by their first ``width`` bytes, then by document."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((padded.size - 7,), ">u8", padded, strides=(1,))
    keys = [doc]
    for at in reversed(range(0, width, 8)):
        word = eight[start + at].astype(np.uint64)
        if at + 8 > width:
            word >>= np.uint64(8 * (at + 8 - width))
        keys.append(word)
    return np.lexsort(keys)


def common_prefixes(data: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """Common prefix, up to ``width``, of each suffix with the one before it; 0 for the first."""
    out = np.zeros(start.size, np.int64)
    steps = np.arange(width)
    for at in range(1, start.size, 65536):
        here, before = start[at:at + 65536], start[at - 1:at - 1 + start[at:at + 65536].size]
        differ = data[here[:, None] + steps] != data[before[:, None] + steps]
        out[at:at + 65536] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return out


def _previous_smaller(doc: np.ndarray, prefix: np.ndarray, least: int) -> np.ndarray:
    """Common prefix of each suffix with the nearest one before it of a smaller document.

    Pointers jump over suffixes of documents that are not smaller, taking
    the least common prefix on the way; a jump ends once that is below ``least``.
    """
    at, low = np.arange(doc.size) - 1, prefix.copy()
    while True:
        go = np.flatnonzero((at >= 0) & (low >= least))
        go = go[doc[at[go]] >= doc[go]]
        if not go.size:
            break
        to = at[go]
        low[go], at[go] = np.minimum(low[go], low[to]), at[to]
    ok = (at >= 0) & (low >= least)
    ok[ok] = doc[at[ok]] < doc[ok]
    return np.where(ok, low, 0)


def longest_previous_factors(doc: np.ndarray, prefix: np.ndarray, least: int) -> np.ndarray:
    """Per suffix, in suffix order, the longest prefix that an earlier document has.

    ``prefix[k]`` is the common prefix of suffixes k - 1 and k. Factors
    below ``least`` are given as 0.
    """
    before = _previous_smaller(doc, prefix, least)
    after = _previous_smaller(doc[::-1], np.concatenate([[0], prefix[:0:-1]]), least)[::-1]
    return np.maximum(before, after)


def earlier_windows(data: np.ndarray, start: np.ndarray, doc: np.ndarray, width: int) -> np.ndarray:
    """Whether each window's string also starts in an earlier document."""
    out = np.zeros(start.size, bool)
    hashes = span_hashes(data, start, start + width)
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    twice = np.zeros(start.size, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)   # suffixes met once have no factor of this length
    if at.size:
        at = at[suffix_order(data, start[at], doc[at], width)]
        prefix = common_prefixes(data, start[at], width)
        out[at] = longest_previous_factors(doc[at], prefix, width) >= width
    return out


def answers(rows: DataFrame, width: int) -> DataFrame:
    """``block, payload``: spans (by number) and windows in them that an earlier document has."""
    def decide(t: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpack_spans(p) for p in t["payload"]]
        key, doc, number, lengths, data = (np.concatenate(c) for c in zip(*parts))
        block = np.repeat(np.arange(len(parts)), [p[0].size for p in parts])
        begin = np.concatenate([[0], np.cumsum(lengths.astype(np.int64))])
        # Equal spans: all but those of the smallest document are found as a whole.
        same = mix(mix(span_hashes(data, begin[:-1], begin[1:])) ^ key)
        order = np.lexsort((doc, same))
        new = np.ones(order.size, bool)
        new[1:] = same[order[1:]] != same[order[:-1]]
        lead = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        whole = np.zeros(key.size, bool)
        whole[order] = doc[order] > doc[lead]
        left = order[new]
        # Different spans under one key: their windows are compared as suffixes.
        left = left[np.argsort(key[left], kind="stable")]
        several = np.zeros(left.size, bool)
        pair = key[left[1:]] == key[left[:-1]]
        several[1:] |= pair
        several[:-1] |= pair
        left = left[several]
        count = lengths[left].astype(np.int64) - width + 1
        span = np.repeat(left, count)
        inside = np.arange(span.size) - np.repeat(np.cumsum(count) - count, count)
        found = np.flatnonzero(earlier_windows(data, begin[span] + inside, doc[span], width))
        got = np.concatenate([np.flatnonzero(whole), span[found]])
        window = np.concatenate([np.full(whole.sum(), _WHOLE), inside[found]]).astype(np.uint8)
        out = []
        for k, pick in by_part(block[got], len(parts)):
            out.append((t["block"].iloc[k], np.int64(pick.size).tobytes()
                        + number[got[pick]].tobytes() + window[pick].tobytes()))
        return pd.DataFrame(out, columns=["block", "payload"])

    return rows.groupBy("part").applyInPandas(decide, "block long, payload binary")


# ---- cutting ------------------------------------------------------------
def covered(block: Block, s: Sent, found: list, width: int) -> np.ndarray:
    """Bytes that go: those of the windows found, and of copies inside the block."""
    change = np.zeros(block.data.size + 1, np.int32)

    def mark(first: np.ndarray, last: np.ndarray) -> None:
        np.add.at(change, first, 1)
        np.add.at(change, last + width, -1)

    first, last, text = s.copies
    later = block.ids[text] > block.ids[s.text[s.copy_of]]
    mark(first[later], last[later])
    # A copy in a document with the same id as the sent span shares its answer.
    same = np.flatnonzero(~later)
    for payload in found or ():
        n = int(np.frombuffer(payload, np.int64, 1)[0])
        number = np.frombuffer(payload, np.uint32, n, 8).astype(np.int64)
        window = np.frombuffer(payload, np.uint8, n, 8 + 4 * n).astype(np.int64)
        starts = [(s.first[number], s.last[number])]
        if same.size:
            order = same[np.argsort(s.copy_of[same], kind="stable")]
            low = np.searchsorted(s.copy_of[order], number)
            high = np.searchsorted(s.copy_of[order], number, side="right")
            times = high - low
            pick = order[np.repeat(low, times) + (
                np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times))]
            starts.append((first[pick], last[pick]))
            window = np.concatenate([window, np.repeat(window, times)])
        begin = np.concatenate([a for a, _ in starts])
        end = np.concatenate([b for _, b in starts])
        all_of = window == _WHOLE
        mark(begin[all_of], end[all_of])
        one = begin[~all_of] + window[~all_of]
        mark(one, one)
    return np.cumsum(change[:-1]) > 0


def _cut(block: Block, gone: np.ndarray, with_text: bool) -> pa.RecordBatch:
    sums = np.concatenate([[0], np.cumsum(gone)])
    starts = gone.copy()
    starts[1:] &= ~gone[:-1]
    begin = block.offsets[:-1][np.diff(block.offsets) > 0]
    starts[begin] |= gone[begin]
    spans = np.concatenate([[0], np.cumsum(starts)])
    kept = block.data[~gone].tobytes()
    at = block.offsets - sums[block.offsets]
    texts = [kept[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
    columns = {
        "doc_id": pa.array(block.ids, mask=~block.known),
        "n_bytes": pa.array(np.diff(block.offsets)),
        "n_removed": pa.array(np.diff(sums[block.offsets])),
        "n_spans": pa.array(np.diff(spans[block.offsets])),
        "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())}
    if with_text:
        columns["kept_bytes"] = pa.array(texts, pa.binary())
    return pa.RecordBatch.from_pydict(columns)


def remove_repeats(docs: DataFrame, width: int = WIDTH, hot: int = HOT_DOCUMENTS,
                   block_bytes: int = BLOCK_BYTES, with_text: bool = False) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    Texts are their UTF-8 bytes (NULL: empty). Each byte covered by a
    ``width``-byte string that also starts in a document with a smaller id
    goes; strings are judged on the input and never cross documents. A span is
    a maximal run of removed bytes. ``with_text`` adds the remaining bytes
    (a cut can fall inside a character). Texts shorter than ``width`` stay
    whole, as do texts with a NULL id, which is neither smaller nor larger
    than any other. Rows that repeat an id do not remove each other. An empty
    table gives no rows. ``width`` is from 32 to 200.
    """
    if not 2 * GRAM <= width <= 200:
        raise ValueError(f"width={width}")
    blocks = materialized(packed(docs, block_bytes), "blocks")
    n_blocks = blocks.count()
    parts = max(8, n_blocks * block_bytes // PART_BYTES)
    flags = materialized(anchor_flags(anchor_rows(blocks, parts, width), hot), "flags")
    per_block = flags.groupBy("block").agg(F.collect_list(F.struct("part", "flags")).alias("flags"))
    flagged = blocks.join(per_block, "block", "left")
    found = materialized(answers(zone_rows(flagged, parts, width), width), "answers")
    marked = flagged.join(found.groupBy("block").agg(F.collect_list("payload").alias("found")),
                          "block", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                block = unpack(row)
                z = zones(block, width)
                s = spans_to_send(block, z, _zone_flags(z, row["flags"], parts), width)
                yield _cut(block, covered(block, s, row["found"], width), with_text)

    return marked.mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
             + (", kept_bytes binary" if with_text else ""))
