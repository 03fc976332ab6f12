"""Benchmark decontamination by latent semantic retrieval.

Documents are read as passages of words, weighted by TF-IDF over hashed
words. A randomised singular value decomposition of all passages is made in
one pass: every task multiplies its passages with a random test matrix and
back, Spark adds up the products block by block, and the driver (which sees a
matrix of fixed size) finishes with a Nystroem step. Benchmark items and
windows of every document are projected to the latent space, scaled so that
the leading directions (languages, common words) do not drown the others. The
items are a stated query set, held against all windows in blocks; pairs above
a cosine that follows the item's length are candidates, and no others. Each
candidate is checked word by word: enough of the item's words near the window,
the longest common subsequence with the item, and for paraphrases the item's
answer (its last words) as well.

The search is approximate: a paraphrase can stay below the cosine. With
``exact=True`` every pair with enough words is a candidate, whatever its cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, slices, text_bytes
from .words import LETTERS, Words, words

#: Bytes of words: letters and digits, so that numbers are words too.
WORD = LETTERS.copy()
WORD[ord("0"):ord("9") + 1] = True
BUCKETS = 1 << 13
RANK, OVERSAMPLING = 48, 8
#: Columns of the test matrix in which each bucket has a random sign.
SIGNS = 4
#: Words of a passage in the decomposition.
PASSAGE = 32
#: A pair is a candidate from this cosine on, times sqrt(words of item / words of window):
#: the other words of a window lengthen it by so much.
COSINE = 0.34
#: A window holds a copy when so much of the item is a common subsequence, and
#: a paraphrase when this much is and so much of the answer.
COPY, PARAPHRASE, ANSWER = 0.7, 0.5, 0.8
#: The answer is the last words of the item: this share, and at least so many.
ANSWER_SHARE, ANSWER_WORDS = 0.2, 4
#: Items held against the documents in one pass, and the bytes of their texts.
ITEM_BLOCK, ITEM_BYTES = 20_000, 16 << 20
#: Bytes of text in one piece of the decomposition, and of the search.
_SLICE, _SEARCH = 1 << 20, 1 << 18
#: Items of one class that are searched at once, and windows.
_ITEMS, _WINDOWS = 128, 4096
_BLOCK = 256


def _buckets(found: Words) -> np.ndarray:
    return (found.hashes % np.uint64(BUCKETS)).astype(np.int64)


def _passages(found: Words) -> np.ndarray:
    """First word of every passage; the last one of a text may be shorter."""
    rank = np.arange(found.text.size) - found.first[found.text]
    return np.flatnonzero(rank % PASSAGE == 0)


def _sums_of_runs(rows: np.ndarray, index: np.ndarray, start: np.ndarray, end: np.ndarray,
                  most: int) -> np.ndarray:
    """Per run the sum of ``rows[index[start:end]]``; runs are at most ``most`` long.

    The last of ``rows`` is 0: it fills the shorter runs up, so that one product adds all up.
    """
    out = np.empty((start.size, rows.shape[1]), rows.dtype)
    every, index = np.arange(most), np.append(index, len(rows) - 1)
    ones, step = np.ones((1, most), rows.dtype), max(1, (1 << 13) // most)
    for at in range(0, start.size, step):
        a, b = start[at:at + step, None], end[at:at + step, None]
        inside = a + every
        pick = index[np.where(inside < b, inside, index.size - 1)]
        got = np.empty((pick.size, rows.shape[1]), rows.dtype)
        np.take(rows, pick.ravel(), axis=0, out=got, mode="clip")
        out[at:at + step] = (ones @ got.reshape(len(pick), most, -1))[:, 0]
    return out


# ---- sums over all tasks ------------------------------------------------
#: Payloads of one block that one task adds up.
FAN_IN = 32


def _added(rows: DataFrame, parts: int) -> dict[int, np.ndarray]:
    """Sum of the float64 payloads ``(block, part, payload)`` by block, in a tree.

    Parts are numbered from 0; a task reads at most ``FAN_IN`` of them, however many there are.
    """
    def add(t: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(p, np.float64) for p in t["payload"])
        return pd.DataFrame({"block": t["block"].iloc[:1], "part": t["part"].iloc[:1],
                             "payload": [total.tobytes()]})

    while parts > 1:
        parts = -(-parts // FAN_IN)
        rows = (rows.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
                .groupBy("block", "part").applyInPandas(add, "block int, part int, payload binary"))
    return {r["block"]: np.frombuffer(r["payload"], np.float64) for r in rows.collect()}


def _matrix(texts: DataFrame, width: int, contribution) -> tuple[np.ndarray, np.ndarray]:
    """Sum over all tasks of a (BUCKETS, width) matrix and of a number per slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        total, count = np.zeros((BUCKETS, width)), 0.0
        for batch in slices(batches, _SLICE):
            found = words(*text_bytes(batch.column(0)), WORD)
            if found.hashes.size:
                count += contribution(found, total)
        blocks = list(range(BUCKETS // _BLOCK)) + [-1]
        payloads = [total[k * _BLOCK:(k + 1) * _BLOCK].tobytes() for k in blocks[:-1]]
        payloads.append(np.array([count]).tobytes())
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks, pa.int32()), pa.array([part] * len(blocks), pa.int32()),
             pa.array(payloads, pa.binary())], names=["block", "part", "payload"])

    got = _added(texts.mapInArrow(run, "block int, part int, payload binary"),
                 texts.rdd.getNumPartitions())
    full = np.zeros((BUCKETS, width))
    for k, payload in got.items():
        if k >= 0:
            full[k * _BLOCK:(k + 1) * _BLOCK] = payload.reshape(_BLOCK, width)
    return full, got.get(-1, np.zeros(1))


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """IDF of each bucket over the passages of all documents."""
    def count(found: Words, total: np.ndarray) -> float:
        starts = _passages(found)
        passage = np.repeat(np.arange(starts.size), np.diff([*starts, found.text.size]))
        pairs = np.sort(passage * BUCKETS + _buckets(found))
        total[:, 0] += np.bincount(pairs[np.diff(pairs, prepend=-1) > 0] % BUCKETS,
                                   minlength=BUCKETS)
        return float(starts.size)

    frequency, n = _matrix(texts, 1, count)
    return np.log((n[0] + 1) / (frequency[:, 0] + 1)) + 0.1


def projection(texts: DataFrame, idf: np.ndarray, rank: int = RANK, seed: int = 7) -> np.ndarray:
    """(rank, BUCKETS): weighted words to scaled latent coordinates.

    With A the matrix of weighted, normalised passages and T the test
    matrix, the tasks add up Y = A' (A T); then A'A is about Y (T'Y)^-1 Y'.
    """
    width = rank + OVERSAMPLING
    rng = np.random.default_rng(seed)
    column = np.argsort(rng.random((BUCKETS, width)), axis=1)[:, :SIGNS]
    sign = rng.choice([-1.0, 1.0], (BUCKETS, SIGNS)) / np.sqrt(SIGNS)
    test = np.zeros((BUCKETS, width))
    np.put_along_axis(test, column, sign, axis=1)
    weighted = idf[:, None] * sign

    def multiply(found: Words, total: np.ndarray) -> float:
        bucket, starts = _buckets(found), _passages(found)
        passage = np.repeat(np.arange(starts.size), np.diff([*starts, bucket.size]))
        z = np.zeros(starts.size * width)
        for k in range(SIGNS):
            z += np.bincount(passage * width + column[bucket, k], weighted[bucket, k], z.size)
        norm = np.add.reduceat(idf[bucket] ** 2, starts)
        rows = np.zeros((starts.size + 1, width), np.float32)
        np.divide(z.reshape(-1, width), norm[:, None], out=rows[:-1], casting="same_kind")
        order = np.argsort(bucket.astype(np.uint16), kind="stable")
        heads = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        met = bucket[order[heads]]
        # Passages of a bucket in runs of eight, then the runs of a bucket.
        runs = -(-np.diff([*heads, bucket.size]) // 8)
        first = np.cumsum(runs) - runs
        begin = np.repeat(heads, runs) + 8 * (np.arange(int(runs.sum())) - np.repeat(first, runs))
        end = np.minimum(begin + 8, np.repeat([*heads[1:], bucket.size], runs))
        sums = _sums_of_runs(rows, passage[order], begin, end, 8)
        total[met] += idf[met, None] * np.add.reduceat(sums, first, axis=0)
        return float(starts.size)

    y, _ = _matrix(texts, width, multiply)
    shift = 1e-9 * max(1e-12, float(np.linalg.norm(y)))
    y = y + shift * test
    core = test.T @ y
    # With too few passages the sketch has no more directions than they span.
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    half = vectors / np.sqrt(np.maximum(values, shift))
    directions, strength, _ = np.linalg.svd(y @ half, full_matrices=False)
    # Directions that the passages do not span are noise and count nothing.
    strength = strength[:rank]
    scale = np.where(strength > 1e-3 * strength[0], 1 / np.maximum(strength, 1e-12), 0)
    return np.ascontiguousarray((idf[:, None] * directions[:, :rank] * scale).T, np.float32)


# ---- items and windows --------------------------------------------------
def length_class(n: int) -> int:
    """Items are searched with windows of three hops, in all at least as many words as they have
    and, from nine words on, less than twice as many."""
    c = 9
    while c < n:
        c *= 2
    return c


@dataclass(frozen=True)
class Items:
    """Items of one block with their words, grouped by length class."""

    ids: list[int]
    words: list[np.ndarray]
    project: np.ndarray   # (BUCKETS + 1, rank), the last row 0
    classes: dict[int, tuple[np.ndarray, np.ndarray]]   # class: item numbers, unit vectors
    vocabulary: np.ndarray   # sorted word hashes of all items
    entries: tuple[np.ndarray, np.ndarray, np.ndarray]   # item, word, times: by item and word


def prepare_items(rows: list, project: np.ndarray) -> Items:
    """Items without a word are left out; equal items are searched each."""
    texts = pa.array([r["text"] for r in rows], pa.string())
    found = words(*text_bytes(texts), WORD)
    cuts = list(zip(found.first[:-1].tolist(), found.first[1:].tolist()))
    own = [found.hashes[a:b] for a, b in cuts if b > a]
    ids = [r["item_id"] for r, (a, b) in zip(rows, cuts) if b > a]
    vectors = np.array([project[:, (h % np.uint64(BUCKETS)).astype(np.int64)].sum(axis=1)
                        for h in own]).reshape(len(own), project.shape[0])
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    of_class: dict[int, list[int]] = {}
    for k, h in enumerate(own):
        of_class.setdefault(length_class(h.size), []).append(k)
    vocabulary, word = np.unique(found.hashes, return_inverse=True)
    item = np.repeat(np.arange(len(own)), [h.size for h in own])
    entry, times = np.unique(item * max(1, vocabulary.size) + word, return_counts=True)
    by_bucket = np.zeros((BUCKETS + 1, len(project)), np.float32)
    by_bucket[:-1] = project.T
    return Items(ids, own, by_bucket,
                 {c: (np.array(k), vectors[k].astype(np.float32)) for c, k in of_class.items()},
                 vocabulary, (*np.divmod(entry, max(1, vocabulary.size)), times))


def _table(items: Items, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word of the vocabulary to column, and (items, columns): how often the item has the word.

    Column 0 stands for all words that none of the items has.
    """
    item, word, times = items.entries
    first = np.searchsorted(item, numbers)
    last = np.searchsorted(item, numbers, side="right")
    cut = np.concatenate([np.arange(a, b) for a, b in zip(first, last)])
    column = np.zeros(items.vocabulary.size + 1, np.int64)
    own = np.unique(word[cut])
    column[own] = np.arange(own.size) + 1
    held = np.zeros((numbers.size, own.size + 1), np.int32)
    held[np.repeat(np.arange(numbers.size), last - first), column[word[cut]]] = times[cut]
    return column, held


def common_subsequence(item: np.ndarray, region: list[int]) -> int:
    """Length of the longest common subsequence, one machine word row per word of the region."""
    masks: dict[int, int] = {}
    for k, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | 1 << k
    full = (1 << item.size) - 1
    row = full
    for w in region:
        hit = row & masks.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return item.size - row.bit_count()


def share_found(item: np.ndarray, region: np.ndarray) -> float:
    """Share of the item that the region holds, 0 unless it is a copy or a paraphrase."""
    near = region.tolist()
    share = common_subsequence(item, near) / item.size
    if share >= COPY:
        return share
    answer = item[-max(ANSWER_WORDS, int(ANSWER_SHARE * item.size)):]
    answered = common_subsequence(answer, near) >= ANSWER * answer.size
    return share if share >= PARAPHRASE and answered else 0.0


def _marks(rows: np.ndarray, columns: np.ndarray, n: int, size: int) -> np.ndarray:
    """(n, size) 64-bit words; row ``rows[k]`` has the bit of ``columns[k]``, none for column 0."""
    flags = np.zeros((n, size * 64), np.uint8)
    inside = columns > 0
    flags[rows[inside], columns[inside] % (size * 64)] = 1
    return np.packbits(flags, axis=1).view(np.uint64)


def _words_met(held: np.ndarray, item: np.ndarray, column: np.ndarray, start: np.ndarray,
               end: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Which (item, region) pairs have enough words; an LCS is no longer than their number.

    Every word of the region counts once. Counting repeats as well is cheaper and gives
    no less, so only pairs with enough by that count are looked at in full.
    """
    out = np.zeros(item.size, bool)
    step = max(1, (1 << 18) // max(1, int((end - start).max(initial=1))))
    for at in range(0, item.size, step):
        a, b, k = start[at:at + step], end[at:at + step], item[at:at + step]
        inside = a[:, None] + np.arange(int((b - a).max()))
        ids = column[np.minimum(inside, column.size - 1)]
        ids[inside >= b[:, None]] = 0
        met = held.ravel()[k[:, None] * held.shape[1] + ids].sum(axis=1)
        left = np.flatnonzero(met >= least[k])
        ids, k = np.sort(ids[left], axis=1), k[left]
        met = held.ravel()[k[:, None] * held.shape[1] + ids]
        met[:, 1:][ids[:, 1:] == ids[:, :-1]] = 0
        out[at + left] = met.sum(axis=1) >= least[k]
    return out


def _telling(items: Items, known: np.ndarray) -> tuple[tuple, np.ndarray]:
    """Entries of each item's words without the ones most frequent here, and how many must be met.

    The words left out are less than half of what a paraphrase needs, so a window
    with enough of the item's words has the rest of that among the others.
    """
    item, word, times = items.entries
    frequency = np.bincount(known, minlength=items.vocabulary.size + 1)
    order = np.lexsort((-frequency[word], item))
    item, word, times = item[order], word[order], times[order]
    least = PARAPHRASE * np.array([w.size for w in items.words])
    upto = np.cumsum(times)
    first = np.searchsorted(item, np.arange(least.size))
    upto -= (upto[first] - times[first])[item]
    left = upto <= least[item] / 2
    need = least - np.bincount(item[left], times[left], least.size)
    by_word = np.argsort(word[~left], kind="stable")
    return tuple(x[~left][by_word] for x in (item, word, times)), need


def _counted(telling: tuple, numbers: np.ndarray, known: np.ndarray, block: np.ndarray
             ) -> np.ndarray:
    """(blocks + 1, items): the telling words of each item in all blocks before."""
    item, word, times = telling
    own = np.full(int(item.max(initial=0)) + 1, -1)
    own[numbers[numbers < own.size]] = np.flatnonzero(numbers < own.size)
    mine = own[item] >= 0
    column, word, times = own[item[mine]], word[mine], times[mine]
    top = int(known.max()) + 1
    start = np.searchsorted(word, np.arange(top + 1))
    held = np.diff(start)[known]
    at = np.flatnonzero(held)
    held = held[at]
    entry = (np.arange(int(held.sum())) - np.repeat(np.cumsum(held) - held, held)
             + np.repeat(start[known[at]], held))
    size = int(block[-1]) + 1
    out = np.zeros((size + 1, numbers.size))
    cell = np.repeat(block[at], held) * numbers.size + column[entry]
    np.cumsum(np.bincount(cell, times[entry], size * numbers.size).reshape(size, -1), axis=0,
              out=out[1:])
    return out


def matches(texts: pa.Array, items: Items, exact: bool = False) -> list[dict[int, float]]:
    """Per text: share found of each item that it holds.

    Candidates are the windows near an item by the latent cosine; ``exact`` takes
    all windows that have enough of the item's words instead.
    """
    found = words(*text_bytes(texts), WORD)
    out: list[dict[int, float]] = [{} for _ in range(len(texts))]
    if not found.hashes.size or not items.ids:
        return out
    n = np.diff(found.first)
    known = np.minimum(np.searchsorted(items.vocabulary, found.hashes), items.vocabulary.size - 1)
    known[items.vocabulary[known] != found.hashes] = items.vocabulary.size   # no item's word
    bucket = _buckets(found)
    telling, need = _telling(items, known) if exact else (None, None)
    for size, numbers, vectors in (
            (c, k[at:at + _ITEMS], v[at:at + _ITEMS]) for c, (k, v) in items.classes.items()
            for at in range(0, k.size, _ITEMS)):
        hop = size // 3
        own = np.array([items.words[k].size for k in numbers])
        to_column, held = _table(items, numbers)
        column = to_column[known]
        # Blocks of ``hop`` words that never cross texts, and two empty ones after each text;
        # a window is a block and the next two.
        blocks = -(-n // hop) + 2
        before = np.cumsum(blocks) - blocks
        text = np.repeat(np.arange(n.size), blocks)
        limit = found.first[text + 1]
        start = np.minimum(limit, found.first[text] + hop * (np.arange(text.size) - before[text]))
        end = np.minimum(limit, start + hop)
        # Near a window: a hop to either side for its words, two for their order.
        low, high = np.maximum(found.first[text], start - hop), np.minimum(limit, start + 4 * hop)
        block = np.repeat(np.arange(text.size), end - start)
        if exact:
            counted = _counted(telling, numbers, known, block)
        else:
            of_block = _sums_of_runs(items.project, bucket, start, end, hop)
        # A bit for each of an item's words, so that most windows are told by their bits; words
        # that share a bit may all be met by one.
        bits = min(16, max(2, size // 8))
        marked = _marks(block + 1, column, text.size + 4, bits)   # nothing before and after all
        item_marks = _marks(*np.nonzero(held), numbers.size, bits)
        least = PARAPHRASE * own
        need_bits = least - own + np.bitwise_count(item_marks).sum(axis=1, dtype=np.int64)
        # Longer vectors for a lower cosine, so that one comparison serves all items.
        scaled = (vectors / (COSINE * np.sqrt(np.minimum(1, own / size)))[:, None]).T
        scaled = np.ascontiguousarray(scaled, np.float32)
        for at in range(0, text.size - 2, _WINDOWS):
            to = min(at + _WINDOWS, text.size - 2)
            if exact:
                real = np.flatnonzero(start[at:to] < end[at:to])
                last, before_all = block[high[at + real] - 1] + 1, block[low[at + real]]
                near, item = np.nonzero(counted[last] - counted[before_all] >= need[numbers])
                near = real[near]
            else:
                window = of_block[at:to] + of_block[at + 1:to + 1]
                window += of_block[at + 2:to + 2]
                length = np.sqrt(np.einsum("ij,ij->i", window, window))
                length[(length < 1e-12) | (start[at:to] == end[at:to])] = np.inf
                near, item = np.nonzero(window @ scaled >= length[:, None])
            marks = marked[at:to].copy()
            for k in range(1, 5):
                marks |= marked[at + k:to + k]
            met = np.bitwise_count(marks[near] & item_marks[item]).sum(axis=1, dtype=np.int32)
            likely = met >= need_bits[item]
            near, item = near[likely] + at, item[likely]
            enough = _words_met(held, item, column, low[near], high[near], least)
            for w, row in zip(near[enough].tolist(), item[enough].tolist()):
                k, seen = int(numbers[row]), out[text[w]]
                if items.ids[k] in seen:
                    continue
                a = max(found.first[text[w]], start[w] - 2 * hop)
                b = min(found.first[text[w] + 1], start[w] + 5 * hop)
                # Words that the item does not have change no common subsequence.
                own_words = held[row, column[a:b]] > 0
                share = share_found(items.words[k], found.hashes[a:b][own_words])
                if share:
                    seen[items.ids[k]] = share
    return out


def fit(docs: DataFrame, rank: int = RANK) -> np.ndarray:
    """The latent projection of the documents' passages."""
    texts = id_and_text(docs).select("text")
    return projection(texts, inverse_frequencies(texts), rank)


def _holds(held: Broadcast, exact: bool):
    @F.arrow_udf("array<long>")
    def holds(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        out = [sorted(m) for b in slices([batch], _SEARCH)
               for m in matches(b.column(0), held.value, exact)]
        return pa.array(out, pa.list_(pa.int64()))

    return holds


def _item_blocks(benchmark: DataFrame, most: int, most_bytes: int) -> Iterator[list]:
    """Rows of the benchmark in blocks of at most so many rows and, beyond one row, bytes."""
    rows = benchmark.select(F.col("item_id").cast("long"), "text").orderBy("item_id", "text")
    part, size = [], 0
    for row in rows.toLocalIterator():
        n = len((row["text"] or "").encode())
        if part and (len(part) == most or size + n > most_bytes):
            yield part
            part, size = [], 0
        part.append(row)
        size += n
    if part:
        yield part


def with_matches(docs: DataFrame, benchmark: DataFrame, project: np.ndarray,
                 name: str = "item_ids", block: int = ITEM_BLOCK, exact: bool = False
                 ) -> DataFrame:
    """``docs`` with the ids of the benchmark items each whole text holds, in column ``name``.

    Items are taken in blocks of at most ``block`` rows and ``ITEM_BYTES``, and go out as
    words and a vector each, so what is broadcast is bounded but for a single longer item;
    a NULL or empty text holds none, an item without a word is held by none, and
    an empty benchmark gives empty lists. No row moves. ``exact`` passes the
    cosine by and looks at every window with enough of an item's words.
    """
    found = F.array().cast("array<long>")
    for part in _item_blocks(benchmark, block, ITEM_BYTES):
        held = docs.sparkSession.sparkContext.broadcast(prepare_items(part, project))
        found = F.array_union(found, _holds(held, exact)(F.coalesce(F.col("text"), F.lit(""))))
    return docs.withColumn(name, found)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, contaminated, n_items, item_ids, kept`` of every document.

    ``item_ids`` are the benchmark items of which the document holds a copy
    or a paraphrase; a document that holds one is contaminated and not kept.
    Repeated rows get equal results; empty tables give no rows.
    """
    marked = with_matches(docs.select("doc_id", "text"), benchmark, fit(docs))
    return marked.select(
        "doc_id", (F.size("item_ids") > 0).alias("contaminated"),
        F.size("item_ids").alias("n_items"), F.array_sort("item_ids").alias("item_ids"),
        (F.size("item_ids") == 0).alias("kept"))
