"""Language-model scores of whole texts: a causal self-attention model in numpy.

Texts are lower-cased word by word; each distinct word of a block is encoded
once into subword ids, and a block keeps its words as numbers of those. Every
id has an embedding of its own: its neighbours, counted over all training
documents and projected on their main directions, beside a learned one of its
class. Attention over the ids before gives the probability of an id's group
and of its class in the group, and the counts of all training documents its
probability within the class. Frequent ids are classes of their own, the others
share one class a group; groups hold ids that stand beside the same ids.

The weights are learned from all windows of all whole training texts, in
rounds: each task takes its blocks of the round in a stream, starting from the
last mean, and the tasks' weights are averaged by the positions they were
trained on. Every text is scored in overlapping windows, batched and masked,
each id once.

Beside that stands a word unigram base. Word counts cover all training
documents and are not broadcast: blocks of documents send their distinct words
to hash-partitioned parts and get the corpus-wide counts back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import large_rows, materialized
from .blocks import (
    BLOCK_BYTES,
    Block,
    blocks_of,
    by_part,
    packable,
    packed,  # noqa: F401
    rows_of,
    unpack,
)
from .common import crc32_of
from .packing import _OUTSIDE, Encoder, _encoder
from .words import Words, words

#: Rounds of training; windows of a step, and the first round's rate.
ROUNDS = 4
BATCH, RATE = 256, 0.015
#: Tasks' weights added up at once, and levels of it; the driver adds what is left.
FAN_IN, LEVELS = 64, 3
#: Groups, and classes of each; the last class of a group holds its less frequent ids.
GROUPS, MEMBERS = 32, 32
CLASSES = GROUPS * MEMBERS
#: Ids whose neighbourhood makes the groups.
NEIGHBOURS = 96
#: Ids that a window scores, and those before them that it reads as well.
HOP, CONTEXT = 18, 6
WINDOW = CONTEXT + HOP
WIDTH = 16
#: Text bytes for each of the parts that add up word counts.
PART_BYTES = 8 << 20


# ---- ids ----------------------------------------------------------------
def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _unpack(data: bytes, kind: type, n: int) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(
        data, max_output_size=n * np.dtype(kind).itemsize + 1)
    return np.frombuffer(raw, kind)


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of many stretches, one stretch after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if ends.size else 0)


def word_ids(encoder: Encoder, found: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words numbered ``at``, each encoded by itself after a space, and how many.

    The vocabulary's pattern splits before every space, so the ids of a text
    are those of its words in a row. Words of ordinary characters are encoded
    together and cut by the bytes of the ids.
    """
    starts, ends = found.starts[at], found.ends[at]
    joined = found.data[_ragged(starts - 1, ends - starts + 1)]
    cuts = np.concatenate([[0], np.cumsum(ends - starts + 1)])
    joined[cuts[:-1]] = 0x20
    text = joined.tobytes()
    odd = np.zeros(at.size, bool)
    if encoder.special.search(text.decode()):
        odd[:] = True
    else:
        strange = np.concatenate([[0], np.cumsum((joined < 0x20) | (joined >= 0x7F))])
        odd = strange[cuts[1:]] > strange[cuts[:-1]]
    apart: dict[int, np.ndarray] = {}
    for k in np.flatnonzero(odd).tolist():
        word = text[cuts[k]:cuts[k + 1]].decode()
        if _OUTSIDE.search(word) or encoder.special.search(word):
            apart[k] = np.frombuffer(encoder.encode(word), "<u4").astype(np.int64)
    plain = np.ones(at.size, bool)
    plain[list(apart)] = False
    size = np.diff(cuts)[plain]
    rest = text if plain.all() else joined[_ragged(cuts[:-1][plain], size)].tobytes()
    ids = np.array(encoder.fast.encode_ordinary(rest.decode()), np.int64)
    upto = np.concatenate([[0], np.cumsum(encoder.sizes[ids])])
    n = np.zeros(at.size, np.int64)
    n[plain] = np.diff(np.searchsorted(upto, np.concatenate([[0], np.cumsum(size)])))
    if not apart:
        return ids, n
    for k, own in apart.items():
        n[k] = own.size
    out = np.empty(n.sum(), np.int64)
    mine = np.repeat(plain, n)
    out[mine] = ids
    out[~mine] = np.concatenate([apart[k] for k in sorted(apart)])
    return out, n


ENCODED = ("block long, ids binary, known binary, train binary, first binary, hashes binary, "
           "word_ids binary, word_lengths binary, at binary")
IDS = ["train", "first", "hashes", "word_ids", "word_lengths", "at"]


def _encoded(encoder: Encoder, number: int, block: Block, modulus: int, held_out: int
             ) -> pa.RecordBatch:
    """The row of a block in ``ENCODED``."""
    found = words(block.data, block.offsets)
    hashes, one, at = np.unique(found.hashes, return_index=True, return_inverse=True)
    ids, lengths = word_ids(encoder, found, one)
    train = np.array([crc32_of(int(i) if ok else None) % modulus != held_out
                      for i, ok in zip(block.ids, block.known)], bool)
    values = (block.ids.tobytes(), block.known.tobytes(), train.tobytes(),
              found.first.astype(np.int64).tobytes(), hashes.tobytes(),
              _pack(ids.astype(np.int32)), _pack(lengths.astype(np.int32)),
              _pack(at.astype(np.uint32)))
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), *(pa.array([v], pa.binary()) for v in values)],
        names=[c.split()[0] for c in ENCODED.split(", ")])


def encoded_blocks(blocks: DataFrame, tokenizer_path: str, modulus: int, held_out: int
                   ) -> DataFrame:
    """Blocks as words: distinct words (hashes, subword ids), their order, texts and ``train``.

    The texts themselves are not kept.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        for batch in batches:
            for row in rows_of(batch):
                yield _encoded(encoder, row["block"], unpack(row), modulus, held_out)

    return blocks.mapInArrow(run, ENCODED)


def encoded_documents(docs: DataFrame, tokenizer_path: str, modulus: int, held_out: int,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``encoded_blocks`` of the packed documents, in one Python step.

    Two steps in a row are two Python workers a core; an executor keeps them
    all and deals later tasks out to them in turn, so that each comes to hold
    the encoder and a task's arrays.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        for number, block in blocks_of(batches, block_bytes):
            yield _encoded(encoder, number, block, modulus, held_out)

    return packable(docs).mapInArrow(run, ENCODED)


def _words_at(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of a block in order, and the words before each text."""
    first = np.frombuffer(row["first"], np.int64)
    return _unpack(row["at"], np.uint32, int(first[-1])).astype(np.int64), first


def _sequences(row: dict, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a block in a row, each followed by ``end``, and the n + 1 offsets."""
    at, first = _words_at(row)
    lengths = _unpack(row["word_lengths"], np.int32, len(row["hashes"]) // 8).astype(np.int64)
    n = lengths[at]
    ids = _unpack(row["word_ids"], np.int32, int(lengths.sum()))[_ragged((np.cumsum(lengths) - lengths)[at], n)]
    upto = np.concatenate([[0], np.cumsum(n)])[first]
    return (np.insert(ids.astype(np.int64), upto[1:], end), upto + np.arange(first.size))


def _training(row: dict, end: int) -> tuple[np.ndarray, np.ndarray]:
    """``_sequences`` of the training documents of a block only."""
    ids, offsets = _sequences(row, end)
    used, n = np.frombuffer(row["train"], bool), np.diff(offsets)
    return ids[np.repeat(used, n)], np.concatenate([[0], np.cumsum(n[used])])


def id_counts(encoded: DataFrame, size: int) -> np.ndarray:
    """How often each id, and the end, occurs in the training documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            for row in rows_of(batch):
                total += np.bincount(_training(row, size)[0], minlength=size + 1)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["id", "n"])

    rows = (encoded.select(*IDS).mapInArrow(run, "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(size + 1, np.int64)
    for r in rows:
        out[r["id"]] = r["n"]
    return out


# ---- the model ----------------------------------------------------------
@dataclass
class Attention:
    """Class probabilities from the ids before; the id after the last one starts a text."""

    class_of: np.ndarray     # id -> class
    inside: np.ndarray       # id -> log probability within its class
    weights: dict[str, np.ndarray]
    own: np.ndarray          # id, or the start -> embedding from its neighbours

    def __post_init__(self) -> None:
        self.classes = np.append(self.class_of, CLASSES)

    @staticmethod
    def initial(class_of: np.ndarray, inside: np.ndarray, start: tuple[np.ndarray, np.ndarray],
                own: np.ndarray, seed: int = 5) -> "Attention":
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape).astype(np.float32)
        w = {"embed": rng.normal(0, 0.3, (CLASSES + 1, WIDTH)).astype(np.float32),
             "place": rng.normal(0, 0.1, (WINDOW, WIDTH)).astype(np.float32),
             "qkv": draw(WIDTH, 3 * WIDTH), "mixed": draw(WIDTH, WIDTH),
             "hidden": draw(WIDTH, WIDTH), "hidden_bias": np.zeros(WIDTH, np.float32),
             "group": draw(WIDTH, GROUPS) * 0.1, "group_bias": start[0].astype(np.float32),
             "member": rng.normal(0, 0.02, (GROUPS, WIDTH, MEMBERS)).astype(np.float32),
             "member_bias": start[1].astype(np.float32)}
        return Attention(class_of, inside, w, own)

    def copy(self) -> "Attention":
        return Attention(self.class_of, self.inside,
                         {k: v.copy() for k, v in self.weights.items()}, self.own)

    def forward(self, x: np.ndarray, table: np.ndarray | None = None) -> tuple[np.ndarray, tuple]:
        """State (windows, HOP, WIDTH) from which the class after each of the last ``HOP`` follows.

        ``table`` holds the whole embedding of every id, if it was made before.
        """
        w = self.weights
        flat = lambda z: z.reshape(-1, WIDTH)  # noqa: E731  one product for all windows
        if table is None:
            e = w["embed"][self.classes[x]]
            e += self.own[x]
        else:
            e = table[x]
        e += w["place"]
        kv = (flat(e) @ w["qkv"][:, WIDTH:]).reshape(*x.shape, 2 * WIDTH)
        k, v = kv[..., :WIDTH], kv[..., WIDTH:]
        last = np.ascontiguousarray(e[:, CONTEXT:])
        q = (flat(last) @ (w["qkv"][:, :WIDTH] * np.float32(WIDTH ** -0.5))).reshape(last.shape)
        att = q @ k.transpose(0, 2, 1)
        np.minimum(att, 30, out=att)
        np.exp(att, out=att)
        att *= _SEEN
        mass = _sums(att)
        a = att @ v
        a /= mass
        h = last + (flat(a) @ w["mixed"]).reshape(a.shape)
        t = (flat(h) @ w["hidden"]).reshape(h.shape)
        t += w["hidden_bias"]
        np.maximum(t, 0, out=t)
        return h + t, (e, q, k, v, att, mass, a, h, t)

    def _by_group(self, state: np.ndarray, y: np.ndarray):
        """Positions sorted by the group to predict: order, states, group, member, slices."""
        order = np.argsort((y.ravel() // MEMBERS).astype(np.uint8), kind="stable")
        group, member = np.divmod(y.ravel()[order], MEMBERS)
        cuts = np.searchsorted(group, np.arange(GROUPS + 1)).tolist()
        own = [(c, slice(a, b)) for c, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b]
        return order, state.reshape(-1, WIDTH)[order], group, member, own

    def _logits(self, out: np.ndarray, own: list) -> tuple[np.ndarray, np.ndarray]:
        """Logits of the groups, and of the members of each position's own group."""
        w = self.weights
        groups = out @ w["group"]
        groups += w["group_bias"]
        members = np.empty((len(out), MEMBERS), out.dtype)
        for c, rows in own:
            np.matmul(out[rows], w["member"][c], out=members[rows])
            members[rows] += w["member_bias"][c]
        return groups, members

    def gradients(self, x: np.ndarray, y: np.ndarray, used: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean log loss over the positions ``used``."""
        w = self.weights
        state, (e, q, k, v, att, mass, a, h, t) = self.forward(x)
        flat = lambda z: z.reshape(-1, z.shape[-1])
        order, out, group, member, own = self._by_group(state, y)
        share = (used.ravel()[order] / max(1, used.sum())).astype(out.dtype)[:, None]
        dg, dm = self._logits(out, own)
        n = np.arange(len(out))
        for d, target in ((dg, group), (dm, member)):
            _softmax(d)
            d[n, target] -= 1
            d *= share
        g = {"group": out.T @ dg, "group_bias": _totals(dg),
             "member": np.zeros_like(w["member"]), "member_bias": np.zeros_like(w["member_bias"])}
        sorted_back = dg @ w["group"].T
        for c, rows in own:
            g["member"][c], g["member_bias"][c] = out[rows].T @ dm[rows], _totals(dm[rows])
            sorted_back[rows] += dm[rows] @ w["member"][c].T
        back = np.empty_like(sorted_back)
        back[order] = sorted_back
        dh = back.reshape(state.shape)
        dt = dh * (t > 0)
        g["hidden"], g["hidden_bias"] = flat(h).T @ flat(dt), _totals(flat(dt))
        dh += (flat(dt) @ w["hidden"].T).reshape(dt.shape)
        g["mixed"] = flat(a).T @ flat(dh)
        da = (flat(dh) @ w["mixed"].T).reshape(dh.shape)
        da /= mass
        datt = da @ v.transpose(0, 2, 1)
        datt -= _sums(da * a)
        datt *= att
        dq = datt @ k
        dq *= np.float32(WIDTH ** -0.5)
        dkv = np.concatenate([datt.transpose(0, 2, 1) @ q, att.transpose(0, 2, 1) @ da], axis=2)
        g["qkv"] = np.concatenate([flat(e[:, CONTEXT:]).T @ flat(dq), flat(e).T @ flat(dkv)], axis=1)
        de = (flat(dkv) @ w["qkv"][:, WIDTH:].T).reshape(e.shape)
        dh += (flat(dq) @ w["qkv"][:, :WIDTH].T).reshape(dh.shape)
        de[:, CONTEXT:] += dh
        g["place"] = de.sum(axis=0)
        read = self.classes[x].ravel().astype(np.uint16)
        by_class = np.argsort(read, kind="stable")
        read = read[by_class]
        begin = np.flatnonzero(np.concatenate([[True], read[1:] != read[:-1]]))
        g["embed"] = np.zeros_like(w["embed"])
        g["embed"][read[begin]] = np.add.reduceat(flat(de)[by_class], begin, axis=0)
        return g

    def log_probabilities(self, ids: np.ndarray, offsets: np.ndarray, batch: int = 256
                          ) -> np.ndarray:
        """Natural log probability of each id given the ones before it in its text."""
        table = self.weights["embed"][self.classes] + self.own
        starts = _window_starts(offsets)
        out = np.empty(ids.size)
        for k in range(0, len(starts[0]), batch):
            x, at, used = _windows(ids, starts, slice(k, k + batch), self.class_of.size)
            state, _ = self.forward(x, table)
            order, state, group, member, own = self._by_group(state, self.class_of[ids[at]])
            groups, members = self._logits(state, own)
            value = np.empty(order.size)
            value[order] = _chosen(groups, group) + _chosen(members, member)
            out[at[used]] = value[used.ravel()]
        return out + self.inside[ids]


def _sums(z: np.ndarray) -> np.ndarray:
    """Sums over the last axis, kept; a product with ones is much faster than ``sum`` here."""
    return (z.reshape(-1, z.shape[-1]) @ np.ones(z.shape[-1], z.dtype)).reshape(*z.shape[:-1], 1)


def _totals(z: np.ndarray) -> np.ndarray:
    """Sums over the rows of a matrix."""
    return np.ones(len(z), z.dtype) @ z


def _softmax(logits: np.ndarray) -> None:
    np.minimum(logits, 80, out=logits)
    np.exp(logits, out=logits)
    logits /= _sums(logits)


def _chosen(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log probability of one entry of each row."""
    np.minimum(logits, 80, out=logits)
    own = logits[np.arange(at.size), at].astype(np.float64)
    np.exp(logits, out=logits)
    return own - np.log(_sums(logits)[:, 0])


#: A position sees itself and what stands before it in the window.
_SEEN = np.tril(np.ones((WINDOW, WINDOW), np.float32))[CONTEXT:]


def _window_starts(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First position to predict of every window, and where its text begins and ends."""
    per = -(-np.diff(offsets) // HOP)
    text = np.repeat(np.arange(per.size), per)
    first = offsets[text] + (np.arange(text.size) - np.repeat(np.cumsum(per) - per, per)) * HOP
    return first, offsets[text], offsets[text + 1]


def _windows(ids: np.ndarray, starts: tuple, pick: slice | np.ndarray, start_id: int
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping windows: ids read, positions to predict, which of them count.

    A window reads ``CONTEXT`` ids for their sake only and predicts what
    follows each of the others, so every position is scored once. A text
    is preceded by start ids.
    """
    first, begin, end = (s[pick][:, None] for s in starts)
    at = first + np.arange(HOP)
    used = at < end
    read = first + np.arange(-CONTEXT - 1, HOP - 1)
    x = ids[np.clip(read, 0, ids.size - 1)]
    x[read < begin] = start_id
    return x, np.minimum(at, end - 1), used


def _neighbour_cells(counts: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Cells (id, frequent neighbour before or after it) of the ids in a row."""
    size = counts.size
    rank = np.full(size, NEIGHBOURS)
    rank[np.lexsort((np.arange(size), -counts))[:NEIGHBOURS]] = np.arange(NEIGHBOURS)
    width = 2 * (NEIGHBOURS + 1)
    return np.concatenate([ids[1:] * width + rank[ids[:-1]],
                           ids[:-1] * width + NEIGHBOURS + 1 + rank[ids[1:]]])


def neighbours(counts: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """How often each id stands after and before each of the frequent ids."""
    width = 2 * (NEIGHBOURS + 1)
    return np.bincount(_neighbour_cells(counts, ids), minlength=counts.size * width).reshape(
        -1, width).astype(np.float32)


def corpus_neighbours(encoded: DataFrame, counts: np.ndarray) -> np.ndarray:
    """``neighbours`` over all training documents, no pair across two texts."""
    size, width = counts.size, 2 * (NEIGHBOURS + 1)
    held = encoded.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                ids, offsets = _training(row, size - 1)
                # The end of one text stands before the next one: that pair goes out.
                cells = _neighbour_cells(held.value, ids).reshape(2, -1)
                met, n = np.unique(np.delete(cells, offsets[1:-1] - 1, axis=1),
                                   return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(n)], names=["cell", "n"])

    got = (encoded.select(*IDS).mapInArrow(run, "cell long, n long")
           .groupBy("cell").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(size * width, np.float32)
    out[np.asarray(got["cell"])] = np.asarray(got["n"])
    return out.reshape(size, width)


def classes_of(counts: np.ndarray, beside: np.ndarray, rounds: int = 8, seed: int = 5
               ) -> np.ndarray:
    """Class of each id (the last id is the end): groups by neighbours, members by frequency."""
    size = counts.size
    order = np.lexsort((np.arange(size), -counts))
    rows = np.sqrt(beside)
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    met = np.flatnonzero(beside.any(axis=1))
    group = np.arange(size) % GROUPS   # ids without neighbours
    near = np.zeros((size, GROUPS), np.float32)
    if met.size:
        rng = np.random.default_rng(seed)
        centres = rows[rng.choice(met, GROUPS, replace=met.size < GROUPS)]
        for _ in range(rounds):
            group[met] = (rows[met] @ centres.T).argmax(axis=1)
            for c in range(GROUPS):
                own = rows[met[group[met] == c]] * np.sqrt(counts[met[group[met] == c]] + 1)[:, None]
                if own.size:
                    centres[c] = own.sum(axis=0) / max(1e-9, np.linalg.norm(own.sum(axis=0)))
        near = rows @ centres.T
        group[met] = near[met].argmax(axis=1)
    out = group * MEMBERS + MEMBERS - 1
    room = np.zeros(GROUPS, np.int64)
    for i in order[:GROUPS * (MEMBERS - 1)].tolist():   # the nearest group with a class left
        c = int(np.where(room < MEMBERS - 1, near[i], -1.0).argmax())
        out[i] = c * MEMBERS + room[c]
        room[c] += 1
    return out


def embeddings(beside: np.ndarray) -> np.ndarray:
    """Embedding of each id, and of the start: its neighbours on their main directions."""
    rows = np.sqrt(beside)
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    met = beside.any(axis=1)
    if met.any():
        rows[met] -= rows[met].mean(axis=0)
    _, directions = np.linalg.eigh(rows.T.astype(np.float64) @ rows)
    directions *= np.where(directions.sum(axis=0) < 0, -1, 1)
    own = rows @ directions[:, -WIDTH:].astype(np.float32)
    own *= 0.5 / max(1e-9, float(own[met].std()) if met.any() else 1.0)
    return np.concatenate([own, np.zeros((1, WIDTH), np.float32)]).astype(np.float32)


class _Descent:
    """Adam steps on the weights of a model, in place."""

    def __init__(self, model: Attention) -> None:
        self.weights, self.step = model.weights, 0
        self.state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.weights.items()}

    def go(self, gradients: dict[str, np.ndarray], speed: float) -> None:
        self.step += 1
        speed /= 1 - 0.9 ** self.step
        even = np.float32(1 / (1 - 0.99 ** self.step))
        for k, g in gradients.items():
            m, v = self.state[k]
            m *= 0.9
            m += 0.1 * g
            g *= g
            g *= 0.01
            v *= 0.99
            v += g
            self.weights[k] -= speed * m / (np.sqrt(v * even) + 1e-8)


def untrained(counts: np.ndarray, beside: np.ndarray, seed: int = 5) -> Attention:
    """Classes, probabilities within them and embeddings from all counts; weights by chance."""
    class_of = classes_of(counts, beside)
    smoothed = counts + 0.5
    total = np.bincount(class_of, smoothed, minlength=CLASSES)
    inside = np.log(smoothed / total[class_of])
    total = np.maximum(total, 0.5).reshape(GROUPS, MEMBERS)
    return Attention.initial(class_of, inside, (np.log(total.sum(axis=1) / total.sum()),
                                                np.log(total / total.sum(axis=1, keepdims=True))),
                             embeddings(beside), seed)


def train(counts: np.ndarray, sample: np.ndarray, offsets: np.ndarray, steps: int,
          batch: int = 64, rate: float = RATE, seed: int = 5, beside: np.ndarray | None = None
          ) -> Attention:
    """A model trained on the given texts alone, by random windows of them.

    ``beside`` holds the neighbours of all training documents (default: the sample's).
    """
    model = untrained(counts, neighbours(counts, sample) if beside is None else beside, seed)
    starts = _window_starts(offsets)
    if not len(starts[0]):
        return model
    rng = np.random.default_rng(seed)
    descent = _Descent(model)
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(starts[0]), batch)
        x, at, used = _windows(sample, starts, pick, model.class_of.size)
        speed = rate * min(1.0, step / 20, 3 * (1 - (step - 1) / steps))
        descent.go(model.gradients(x, model.class_of[sample[at]], used), speed)
    return model


def _added(rows: DataFrame) -> DataFrame:
    """Sums of ``part, positions, payload`` over ``FAN_IN`` parts at a time, level by level."""
    def add(t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values("part")
        total = np.frombuffer(t["payload"].iloc[0], np.float64).copy()
        for p in t["payload"].iloc[1:]:
            total += np.frombuffer(p, np.float64)
        return pd.DataFrame({"part": t["part"].iloc[:1] // FAN_IN,
                             "positions": [t["positions"].sum()], "payload": [total.tobytes()]})

    for _ in range(LEVELS):
        rows = rows.groupBy(F.floor(F.col("part") / FAN_IN)).applyInPandas(
            add, "part long, positions long, payload binary")
    return rows


def _round(encoded: DataFrame, model: Attention, number: int, rounds: int, batch: int,
           rate: float) -> tuple[Attention, int]:
    """The mean of the weights that the tasks come to on the blocks of one round."""
    held = encoded.sparkSession.sparkContext.broadcast(model)
    names = sorted(model.weights)
    blocks = (encoded.filter(F.pmod(F.xxhash64("block"), F.lit(rounds)) == number)
              .select("block", *IDS))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        own, positions = held.value.copy(), 0
        descent, end = _Descent(own), own.class_of.size - 1
        for arrow in batches:
            for row in rows_of(arrow):
                ids, offsets = _training(row, end)
                positions += ids.size
                starts = _window_starts(offsets)
                order = np.random.default_rng([5, row["block"]]).permutation(len(starts[0]))
                for k in range(0, order.size, batch):
                    pick = order[k:k + batch]
                    x, at, used = _windows(ids, starts, pick, end + 1)
                    # A short last batch moves the weights by its share.
                    descent.go(own.gradients(x, own.class_of[ids[at]], used),
                               rate * min(1.0, (descent.step + 1) / 20) * pick.size / batch)
        if positions:
            flat = np.concatenate([own.weights[k].ravel() for k in names]).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()),
                 pa.array([positions], pa.int64()), pa.array([(flat * positions).tobytes()])],
                names=["part", "positions", "payload"])

    rows = _added(blocks.mapInArrow(learn, "part long, positions long, payload binary")).collect()
    positions = sum(r["positions"] for r in rows)
    if not positions:
        return model, 0
    flat = sum(np.frombuffer(r["payload"], np.float64)
               for r in sorted(rows, key=lambda r: r["part"])) / positions
    cuts = np.cumsum([model.weights[k].size for k in names])[:-1]
    weights = {k: w.reshape(model.weights[k].shape).astype(np.float32)
               for k, w in zip(names, np.split(flat, cuts))}
    return Attention(model.class_of, model.inside, weights, model.own), positions


def train_on_all(encoded: DataFrame, model: Attention, rounds: int = ROUNDS, batch: int = BATCH,
                 rate: float = RATE) -> tuple[Attention, int]:
    """The model after every window of every training text, and the positions trained on.

    A hash deals the blocks out to the rounds; the rate falls from round to round. In a
    round each task streams its blocks, one held at a time. Weights are added up in a tree;
    the driver sees a row of fixed size for up to 64 ** 3 tasks.
    """
    positions = 0
    for number in range(rounds):
        model, n = _round(encoded, model, number, rounds, batch, rate * (1 - number / rounds))
        positions += n
    return model, positions


def fit(encoded: DataFrame, tokenizer_path: str, rounds: int = ROUNDS) -> Attention:
    """Counts, embeddings and attention weights over all training documents."""
    counts = id_counts(
        encoded, _encoder(tokenizer_path).library.get_vocab_size(with_added_tokens=True))
    start = untrained(counts, corpus_neighbours(encoded, counts))
    return train_on_all(encoded, start, rounds)[0]


# ---- word counts --------------------------------------------------------
def word_rows(encoded: DataFrame, parts: int) -> DataFrame:
    """``part, block, hashes, counts``: distinct words of a block, occurrences in training texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                at, first = _words_at(row)
                known = np.frombuffer(row["hashes"], np.uint64)
                train = np.repeat(np.frombuffer(row["train"], bool), np.diff(first))
                n = np.bincount(at[train], minlength=known.size)
                out = [(k, row["block"], known[pick].tobytes(), n[pick].astype(np.uint32).tobytes())
                       for k, pick in by_part((known % np.uint64(parts)).astype(np.int64), parts)]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), (
                            pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                        names=["part", "block", "hashes", "counts"])

    return encoded.select("block", "train", "first", "hashes", "at").mapInArrow(
        run, "part int, block long, hashes binary, counts binary")


def corpus_counts(rows: DataFrame) -> DataFrame:
    """``block, part, counts, total, distinct``: counts of the words sent, and the part's totals."""
    def add(t: pd.DataFrame) -> pd.DataFrame:
        hashes = np.frombuffer(b"".join(t["hashes"]), np.uint64)
        counts = np.frombuffer(b"".join(t["counts"]), np.uint32)
        _, at = np.unique(hashes, return_inverse=True)
        sums = np.bincount(at, counts).astype(np.int64)
        cuts = np.cumsum([len(x) // 8 for x in t["hashes"]])[:-1]
        first = np.arange(len(t)) == 0
        return pd.DataFrame({
            "block": t["block"], "part": t["part"],
            "counts": [c.tobytes() for c in np.split(sums[at], cuts)],
            "total": np.where(first, sums.sum(), 0), "distinct": np.where(first, (sums > 0).sum(), 0)})

    return rows.groupBy("part").applyInPandas(
        add, "block long, part int, counts binary, total long, distinct long")


def base_scores(encoded: DataFrame, block_bytes: int, ends: int) -> DataFrame:
    """``block, row, doc_id, held_out, n_tokens, n_known, train_tokens, base_score``."""
    parts = max(8, encoded.count() * block_bytes // PART_BYTES)
    counted = materialized(corpus_counts(word_rows(encoded, parts)), "word_counts")
    sums = counted.agg(F.sum("total").alias("n"), F.sum("distinct").alias("v")).first()
    total = (sums["n"] or 0) + ends                     # the ends are tokens too
    distinct = (sums["v"] or 0) + (1 if ends else 0)
    replies = counted.groupBy("block").agg(
        F.collect_list(F.struct("part", "counts")).alias("counts"))
    room = np.log10(total + 0.5 * (distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                at, first = _words_at(row)
                known = np.frombuffer(row["hashes"], np.uint64)
                counts = np.zeros(known.size, np.int64)
                sent = {c["part"]: c["counts"] for c in row["counts"] or ()}
                for k, pick in by_part((known % np.uint64(parts)).astype(np.int64), parts):
                    counts[pick] = np.frombuffer(sent[k], np.int64)
                value = (np.log10(counts + 0.5) - room)[at]
                n = np.diff(first)
                upto = np.concatenate([[0], np.cumsum(value)])
                seen = np.concatenate([[0], np.cumsum(counts[at] > 0)])
                ids, ok = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["known"], bool)
                base = np.array([value[a:b].sum() for a, b in zip(first[:-1], first[1:])])
                size = n.size
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(size, row["block"])), pa.array(np.arange(size)),
                     pa.array(ids, mask=~ok), pa.array(~np.frombuffer(row["train"], bool)),
                     pa.array(n + 1), pa.array(np.diff(seen[first]) + (1 if ends else 0)),
                     pa.array(np.full(size, total)),
                     pa.array(base.reshape(size) + np.log10(ends + 0.5) - room)],
                    names=["block", "row", "doc_id", "held_out", "n_tokens", "n_known",
                           "train_tokens", "base_score"])

    return (encoded.select("block", "ids", "known", "train", "first", "hashes", "at")
            .join(replies, "block", "left").mapInArrow(
                run, "block long, row long, doc_id long, held_out boolean, n_tokens long, "
                     "n_known long, train_tokens long, base_score double"))


def model_scores(encoded: DataFrame, model: Attention) -> DataFrame:
    """``block, row, score``: log10 probability of each text's ids and end."""
    held = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            for row in rows_of(batch):
                ids, offsets = _sequences(row, m.class_of.size - 1)
                score = np.add.reduceat(m.log_probabilities(ids, offsets), offsets[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(score.size, row["block"])), pa.array(np.arange(score.size)),
                     pa.array(score / np.log(10))], names=["block", "row", "score"])

    return encoded.select("block", *IDS).mapInArrow(
        run, "block long, row long, score double")


def score_documents(docs: DataFrame, tokenizer_path: str, modulus: int = 5, held_out: int = 1,
                    block_bytes: int = BLOCK_BYTES, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every text.

    Tokens are the words of the lower-cased text and one end; the model is
    learned from documents outside the held-out remainder. A NULL or blank
    text is its end alone. Repeated rows are scored (and counted) each; a
    NULL id hashes as the empty text; an empty table gives no rows. Without
    training documents every count is 0 and the model is the untrained one.
    """
    encoded = materialized(
        encoded_documents(docs, tokenizer_path, modulus, held_out, block_bytes), "encoded")
    ends = docs.filter(F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
                                      .cast("binary")), F.lit(modulus)) != held_out).count()
    with large_rows(docs.sparkSession):
        model = fit(encoded, tokenizer_path, rounds)
        base = materialized(base_scores(encoded, block_bytes, ends), "base_scores")
        scores = materialized(model_scores(encoded, model), "model_scores")
    return base.join(scores, ["block", "row"]).drop("block", "row")
