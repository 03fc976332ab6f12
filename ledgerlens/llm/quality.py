"""Quality classifier: a convolutional network over bytes, in numpy.

Learned filters look at windows of eight bytes, four bytes apart, through a
learned embedding of bytes; one more input tells whether the window repeats
an earlier one nearby. Windows are read in overlapping chunks that cover the
whole text. Each chunk keeps the largest answer of every filter; a document
is the largest and the mean of its chunks' answers, combined by a logistic
layer into one probability. The network is trained by gradient descent on a
bounded sample of labelled rows; documents are then scored where they lie.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, remainder, slices, text_bytes

#: Labelled rows the network is trained on, half of each class where there are
#: enough, and the longest text among them in characters.
TRAINING_ROWS = 4000
TRAINING_CHARS = 50_000
STEPS = 700
THRESHOLD = 0.7
STRIDE, WIDTH, EMBEDDING, FILTERS = 4, 8, 8, 32
#: Windows in a chunk, and windows from one chunk's start to the next one's.
CHUNK, HOP = 64, 48
#: A window counts as repeated when it equals one that starts up to so many bytes earlier.
LAGS = 40
_GAP = 48
#: Text bytes that are laid out and convolved at once.
_SLICE = 1 << 20
_INPUTS = WIDTH * EMBEDDING + 1


@dataclass(frozen=True)
class Layout:
    """Texts in one padded buffer: windows, repeats, and chunks with the text they belong to."""

    data: np.ndarray       # bytes, texts at multiples of STRIDE with gaps of zeros
    repeats: np.ndarray    # per window
    first: np.ndarray      # per chunk: its first window
    last: np.ndarray       # per chunk: one past its last window
    text: np.ndarray       # per chunk


def lay_out(raw: np.ndarray, offsets: np.ndarray) -> Layout:
    lengths = np.diff(offsets)
    windows = np.maximum(1, -(-lengths // STRIDE))
    room = windows * STRIDE + _GAP
    begin = _GAP + np.concatenate([[0], np.cumsum(room)])
    data = np.zeros(int(begin[-1]) + WIDTH, np.uint8)
    for a, b, to in zip(offsets[:-1].tolist(), offsets[1:].tolist(), begin.tolist()):
        data[to:to + b - a] = raw[a:b]
    words = np.ndarray((data.size - WIDTH + 1,), "<u8", data, strides=(1,))
    count = int(begin[-1]) // STRIDE
    here = words[_GAP:_GAP + STRIDE * count:STRIDE].copy()
    repeats = np.zeros(here.size, bool)
    for lag in range(1, LAGS + 1):
        repeats |= here == words[_GAP - lag:_GAP - lag + STRIDE * here.size:STRIDE][:here.size]
    repeats &= here != 0
    chunks = np.maximum(1, -(-(windows - CHUNK) // HOP) + 1)
    text = np.repeat(np.arange(lengths.size), chunks)
    rank = np.arange(text.size) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    start = (begin[:-1] - _GAP) // STRIDE
    first = start[text] + rank * HOP
    last = np.minimum(first + CHUNK, start[text] + windows[text])
    return Layout(data[_GAP:], repeats.astype(np.float32), first, last, text)


@dataclass
class Network:
    embedding: np.ndarray   # (256, EMBEDDING)
    filters: np.ndarray     # (_INPUTS, FILTERS)
    offset: np.ndarray      # (FILTERS,)
    output: np.ndarray      # (2 * FILTERS,): of the largest and of the mean answers
    bias: float

    @staticmethod
    def initial(seed: int = 3) -> "Network":
        rng = np.random.default_rng(seed)
        return Network(rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
                       rng.normal(0, _INPUTS ** -0.5, (_INPUTS, FILTERS)).astype(np.float32),
                       np.zeros(FILTERS, np.float32),
                       rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32), 0.0)

    def answers(self, t: Layout) -> np.ndarray:
        """Answer of each filter at each window."""
        n = t.repeats.size
        half = STRIDE * EMBEDDING
        blocks = self.embedding[t.data[:STRIDE * (n + 1)]].reshape(n + 1, half)
        out = blocks[:n] @ self.filters[:half]
        out += blocks[1:] @ self.filters[half:2 * half]
        out += t.repeats[:, None] * self.filters[2 * half]
        out += self.offset
        return np.maximum(out, 0, out=out)

    def chunk_answers(self, t: Layout) -> np.ndarray:
        answers = self.answers(t)
        answers = np.concatenate([answers, np.zeros((1, FILTERS), np.float32)])
        pairs = np.stack([t.first, t.last], axis=1).ravel()
        return np.maximum.reduceat(answers, pairs, axis=0)[::2]

    def pooled(self, chunk: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
        starts = np.searchsorted(text, np.arange(n))
        counts = np.bincount(text, minlength=n)[:, None]
        return np.concatenate([np.maximum.reduceat(chunk, starts, axis=0),
                               np.add.reduceat(chunk, starts, axis=0) / counts], axis=1)

    def score(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if offsets.size < 2:
            return np.zeros(0)
        t = lay_out(raw, offsets)
        total = self.pooled(self.chunk_answers(t), t.text, offsets.size - 1) @ self.output
        return 1.0 / (1.0 + np.exp(-np.clip(total.astype(np.float64) + self.bias, -50, 50)))


def _gradients(net: Network, t: Layout, label: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean log loss, in the order of the network's fields."""
    n = label.size
    answers = net.answers(t)
    at = np.minimum(t.first[:, None] + np.arange(CHUNK), t.last[:, None] - 1)
    best = answers[at].argmax(axis=1)                         # (chunks, filters)
    where = np.take_along_axis(at, best, axis=1)
    chunk = np.take_along_axis(answers, where, axis=0)
    pooled = net.pooled(chunk, t.text, n)
    error = (1 / (1 + np.exp(-(pooled @ net.output + net.bias))) - label) / n
    back = error[:, None] * net.output
    starts = np.searchsorted(t.text, np.arange(n))
    counts = np.bincount(t.text, minlength=n)
    is_top = chunk == pooled[t.text, :FILTERS]
    share = np.add.reduceat(is_top, starts, axis=0).astype(np.float32)
    g = (back[t.text, :FILTERS] * is_top / share[t.text]
         + back[t.text, FILTERS:] / counts[t.text, None]) * (chunk > 0)
    codes = t.data[(where * STRIDE)[..., None] + np.arange(WIDTH)]   # (chunks, filters, WIDTH)
    inputs = net.embedding[codes].reshape(*where.shape, WIDTH * EMBEDDING)
    filters = np.empty_like(net.filters)
    filters[:-1] = np.einsum("cf,cfi->if", g, inputs, optimize=True)
    filters[-1] = (g * t.repeats[where]).sum(axis=0)
    spread = (g[..., None] * net.filters[:-1].T).reshape(-1, EMBEDDING)
    embedding = np.stack([np.bincount(codes.ravel(), spread[:, k], minlength=256)
                          for k in range(EMBEDDING)], axis=1)
    return [embedding, filters, g.sum(axis=0), error @ pooled, np.array([error.sum()])]


def train(texts: list[bytes], labels: np.ndarray, steps: int = STEPS, batch: int = 64,
          rate: float = 0.004, seed: int = 3) -> Network:
    """Gradient descent with per-weight scaling; both classes weigh the same in a batch."""
    net, rng = Network.initial(seed), np.random.default_rng(seed)
    classes = [np.flatnonzero(labels == k) for k in (0, 1)]
    if not classes[0].size or not classes[1].size:
        net.output[:] = 0
        net.bias = 8.0 if classes[1].size else (-8.0 if classes[0].size else 0.0)
        return net
    state = [[0.0, 0.0] for _ in range(5)]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(c, batch // 2) for c in classes])
        offsets = np.concatenate([[0], np.cumsum([len(texts[i]) for i in pick])])
        raw = np.frombuffer(b"".join(texts[i] for i in pick), np.uint8)
        grads = _gradients(net, lay_out(raw, offsets), labels[pick].astype(np.float64))
        speed = rate * min(1.0, 3 * (1 - (step - 1) / steps))
        fields = [net.embedding, net.filters, net.offset, net.output, np.array([net.bias])]
        for k, (field, grad) in enumerate(zip(fields, grads)):
            m, v = state[k]
            m, v = 0.9 * m + 0.1 * grad, 0.995 * v + 0.005 * grad ** 2
            state[k] = [m, v]
            field -= (speed * (m / (1 - 0.9 ** step))
                      / (np.sqrt(v / (1 - 0.995 ** step)) + 1e-8)).astype(field.dtype)
        net.bias = float(fields[4][0])
    return net


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int, modulus: int,
                  held_out: int) -> DataFrame:
    """At most ``rows / 2`` texts of each class outside the held-out remainder, by id hash.

    The chosen ids are bounded by ``rows`` and are broadcast; no other text moves.
    """
    usable = (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()
                            & (remainder("doc_id", modulus) != held_out))
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("label")))
    halves = [usable.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id")
              .limit(rows // 2) for k in (0, 1)]
    return (id_and_text(docs).filter(F.length("text") <= TRAINING_CHARS)
            .join(F.broadcast(halves[0].union(halves[1])), "doc_id").select("text", "label"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 4,
        held_out: int = 2, rows: int = TRAINING_ROWS, steps: int = STEPS) -> Network:
    """Train on a bounded sample and set the bias to the share of good rows.

    Without labelled rows of both classes the score is one constant.
    """
    sample = labelled_rows(docs, labels, label, rows, modulus, held_out).toPandas()
    net = train([t.encode() for t in sample["text"]], sample["label"].to_numpy(), steps)
    counts = (labels.filter(F.col(label).isNotNull() & (remainder("doc_id", modulus) != held_out))
              .agg(F.sum(F.expr(f"CAST({label} > 0 AS INT)")).alias("good"),
                   F.count(F.lit(1)).alias("n")).first())
    if sample["label"].nunique() > 1:
        net.bias += float(np.log(counts["good"] / (counts["n"] - counts["good"])))
    return net


def with_score(docs: DataFrame, net: Network, name: str = "score") -> DataFrame:
    """``docs`` with the probability that each whole text is good, in column ``name``.

    NULL and empty texts are scored as one empty window; repeated rows are
    scored each; no row moves.
    """
    held = docs.sparkSession.sparkContext.broadcast(net)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        parts = [held.value.score(*text_bytes(b.column(0))) for b in slices([batch], _SLICE)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn(name, score(F.coalesce(F.col("text"), F.lit(""))))


def score_documents(docs: DataFrame, labels: DataFrame, modulus: int = 4, held_out: int = 2,
                    threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    rows = docs.select("doc_id", "text")
    scored = with_score(rows, fit(docs, labels, modulus=modulus, held_out=held_out))
    return scored.select(
        "doc_id", (remainder("doc_id", modulus) == held_out).alias("held_out"), "score",
        F.expr(f"CAST(score >= {threshold} AS INT)").alias("predicted"))
