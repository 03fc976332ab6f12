"""Toxicity by weak supervision.

Voters are words of a lexicon, mined from labelled rows, and fixed patterns;
each fires or stays silent on a text. One pass over all documents, labelled or
not, counts how often voters fire alone and together. From these moments a
generative label model estimates the voters' correlations and accuracies.
Voters that fire together form blocks (the lexicon of one language, say), and
a text is toxic when one of its blocks is. Inside a block, given its state,
voters are taken as independent, so their covariances form a rank-one matrix
whose factor tells how far apart a voter's firing rates in the two states
lie. What the factor leaves over is correlation that the state does not
explain; voters tied by it share their weight. The model's posteriors label a
bounded sample of documents, on which a linear classifier over words is
trained. Its score is the result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, remainder, slices, text_bytes
from .words import LETTERS, Words, words

#: Labelled rows used to mine the lexicon, and documents the classifier is trained on.
LABELLED_ROWS = 20_000
TRAINING_ROWS = 20_000
LEXICON = 256
VOCABULARY = 4096
THRESHOLD = 0.3
#: A lexicon word occurs in at least so many toxic rows and this share of them.
MIN_ROWS, MIN_SHARE = 5, 0.01
#: A word votes only if at least this share of the labelled rows with it are toxic.
MIN_PRECISION = 0.8

#: Patterns that vote beside the lexicon.
PATTERNS = (
    rb"!{3,}",
    rb"\b[A-Z]{4,}(?:\W+[A-Z]{4,}){3,}",
    rb"(?i)\byou (?:are|people|all)\b|\byou're\b",
    rb"(?i)\b(?:hate|kill|shut up|go away)\b",
    rb"[@#$%&*]{4,}",
    rb"(?i)\b(\w{3,})(?:\W+\1\b){3,}",
)
_COMPILED = [re.compile(p) for p in PATTERNS]


def _distinct(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, word hash) pairs without repeats, in order."""
    order = np.lexsort((found.hashes, found.text))
    text, h = found.text[order], found.hashes[order]
    new = np.ones(order.size, bool)
    new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1])
    return text[new], h[new]


def _look_up(hashes: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index into the sorted array ``known`` and whether the hash is there."""
    if not known.size:
        return np.zeros(hashes.size, np.int64), np.zeros(hashes.size, bool)
    at = np.minimum(np.searchsorted(known, hashes), known.size - 1)
    return at, known[at] == hashes


def _pattern_votes(texts: pa.Array) -> np.ndarray:
    return np.array([[p.search(t) is not None for p in _COMPILED]
                     for t in texts.cast(pa.binary()).to_pylist()],
                    bool).reshape(len(texts), len(_COMPILED))


def votes(texts: pa.Array, lexicon: np.ndarray, found: Words | None = None) -> np.ndarray:
    """Which voters fire on each text: the lexicon's words, then the patterns."""
    found = found or words(*text_bytes(texts), LETTERS)
    at, ok = _look_up(found.hashes, lexicon)
    fired = np.zeros((len(texts), lexicon.size), bool)
    fired[found.text[ok], at[ok]] = True
    return np.concatenate([fired, _pattern_votes(texts)], axis=1)


# ---- lexicon ------------------------------------------------------------
def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int,
                    modulus: int = 4, held_out: int = 2) -> DataFrame:
    """Texts and labels of at most ``rows`` labelled rows outside the held-out remainder.

    Rows are taken in the order of a hash of their id. The sample of ids
    is bounded by ``rows`` and is broadcast, so the texts of other rows never move.
    """
    wanted = (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()
                            & (remainder("doc_id", modulus) != held_out))
              .groupBy("doc_id").agg(F.max(label).alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return id_and_text(docs).join(F.broadcast(wanted), "doc_id").select("text", "label")


def _class_counts(sample: DataFrame) -> DataFrame:
    """``hash, clean, toxic``: rows of each class whose text has the word; copies count once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in slices(batches):
            label = np.asarray(batch.column(1)).astype(np.int64)
            text, h = _distinct(words(*text_bytes(batch.column(0)), LETTERS))
            held.append((h, label[text]))
        if not held:
            return
        known, at = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
        label = np.concatenate([x for _, x in held])
        both = np.bincount(2 * at + label, minlength=2 * known.size).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(known.view(np.int64)), pa.array(both[:, 0]), pa.array(both[:, 1])],
            names=["hash", "clean", "toxic"])

    return (sample.select("text", F.expr("CASE WHEN label > 0 THEN 1 ELSE 0 END").alias("label"))
            .mapInArrow(run, "hash long, clean long, toxic long")
            .groupBy("hash").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))


def mine_lexicon(sample: DataFrame) -> np.ndarray:
    """Sorted hashes of the words that mark toxic rows most clearly."""
    distinct = sample.groupBy("text").agg(F.max("label").alias("label"))
    n, toxic = distinct.agg(F.count(F.lit(1)), F.sum(F.expr("CAST(label > 0 AS INT)"))).first()
    toxic = toxic or 0
    if not toxic or toxic == n:
        return np.zeros(0, np.uint64)
    least = max(MIN_ROWS, int(MIN_SHARE * toxic))
    z = (F.col("toxic") - (F.col("toxic") + F.col("clean")) * F.lit(toxic / n)) / F.sqrt(
        (F.col("toxic") + F.col("clean")).cast("double"))
    rows = (_class_counts(distinct)
            .filter((F.col("toxic") >= least)
                    & (F.col("toxic") >= MIN_PRECISION * (F.col("toxic") + F.col("clean"))))
            .orderBy(z.desc(), "hash").limit(LEXICON).select("hash").collect())
    return np.sort(np.array([r["hash"] for r in rows], np.int64).view(np.uint64))


# ---- label model --------------------------------------------------------
#: Voters correlated by this much belong to one block; what the factor leaves
#: over counts as correlation from TIE on.
BLOCK_CORRELATION = 0.08
TIE = 0.3


@dataclass(frozen=True)
class Block:
    """Voters that share a hidden state, their log odds of firing and silence, the prior's."""

    voters: np.ndarray
    prior: float
    fires: np.ndarray
    silent: np.ndarray
    weight: np.ndarray


@dataclass(frozen=True)
class LabelModel:
    base: float
    blocks: tuple[Block, ...]

    def posterior(self, fired: np.ndarray) -> np.ndarray:
        """Probability that a text is toxic: at least one of its blocks is."""
        clean = np.full(len(fired), 1.0 - self.base)
        for b in self.blocks:
            evidence = np.where(fired[:, b.voters], b.fires, b.silent) @ b.weight
            clean *= 1.0 / (1.0 + np.exp(np.clip(b.prior + evidence, -50, 50)))
        return 1.0 - clean


def joint_counts(docs: DataFrame, lexicon: np.ndarray) -> tuple[np.ndarray, int]:
    """How often each pair of voters fires on one text, over all documents, and their number."""
    size = lexicon.size + len(PATTERNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((size, size)), 0
        for batch in slices(batches):
            fired = votes(batch.column(0), lexicon).astype(np.float32)
            total += fired.T @ fired
            n += len(fired)
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*i, -1], pa.int32()), pa.array([*j, -1], pa.int32()),
             pa.array([*total[i, j].astype(np.int64), n], pa.int64())], names=["i", "j", "n"])

    rows = (id_and_text(docs).select("text").mapInArrow(run, "i int, j int, n long")
            .groupBy("i", "j").agg(F.sum("n").alias("n")).collect())
    counts, n = np.zeros((size, size)), 0
    for r in rows:
        if r["i"] < 0:
            n = r["n"]
        else:
            counts[r["i"], r["j"]] = r["n"]
    return counts, n


def _blocks(tied: np.ndarray) -> list[np.ndarray]:
    """Connected sets of the symmetric relation ``tied``."""
    left, found = set(range(len(tied))), []
    while left:
        block, reach = set(), {left.pop()}
        while reach:
            i = reach.pop()
            block.add(i)
            reach |= set(np.flatnonzero(tied[i]).tolist()) & left
            left -= reach
        found.append(np.array(sorted(block)))
    return found


def _fit_block(voters: np.ndarray, counts: np.ndarray, n: int) -> Block:
    """One block from its joint moments: state share, firing rates, ties, weights."""
    joint = counts[np.ix_(voters, voters)] / n
    rate = np.diag(joint)
    off = ~np.eye(voters.size, dtype=bool)
    # Voters that hardly fire in the clean state: rate_i * rate_j / joint_ij is the share.
    share = float(np.clip((np.outer(rate, rate) * off).sum() / (joint * off).sum(), 1e-6, 0.5))
    cov = np.where(off, joint - np.outer(rate, rate), 0)
    factor = np.sqrt(np.maximum(cov.mean(axis=1), 0)) + 1e-12
    for _ in range(200):
        power = np.maximum((factor ** 2).sum() - factor ** 2, 1e-18)
        factor = 0.5 * factor + 0.5 * np.maximum(cov @ factor / power, 0)
    spread = np.clip(factor / np.sqrt(share * (1 - share)), 0, rate / share)
    on = np.clip(rate + (1 - share) * spread, 1e-4, 1 - 1e-3)
    out = np.minimum(np.clip(rate - share * spread, 1e-5, 1 - 1e-4), on)
    inner = share * on * (1 - on) + (1 - share) * out * (1 - out)
    ties = np.where(off, cov - np.outer(factor, factor), 0) / np.sqrt(np.outer(inner, inner))
    weight = 1.0 / (1.0 + np.where(ties > TIE, np.minimum(ties, 1.0), 0).sum(axis=1))
    return Block(voters, float(np.log(share / (1 - share))), np.log(on / out),
                 np.log((1 - on) / (1 - out)), weight)


def fit_label_model(counts: np.ndarray, n: int, lexicon_size: int) -> LabelModel:
    """Blocks from the voters' correlations; accuracies and ties inside each.

    A voter that fires with no other one has no say: there is nothing to
    estimate its accuracy from. Nor has a block without a lexicon word.
    """
    if not n:
        return LabelModel(0.001, ())
    rate = np.diag(counts) / n
    spread = np.sqrt(np.maximum(rate * (1 - rate), 1e-12))
    correlation = (counts / n - np.outer(rate, rate)) / np.outer(spread, spread)
    tied = (correlation > BLOCK_CORRELATION) & (counts >= 3)
    np.fill_diagonal(tied, False)
    blocks = []
    for voters in _blocks(tied):
        if voters.size > 1 and voters.min() < lexicon_size and rate[voters].all():
            blocks.append(_fit_block(voters, counts, n))
    return LabelModel(0.001, tuple(blocks))


# ---- linear classifier --------------------------------------------------
@dataclass(frozen=True)
class ToxicityModel:
    vocabulary: np.ndarray   # sorted word hashes
    weight: np.ndarray       # vocabulary, then patterns
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        text, h = _distinct(words(*text_bytes(texts), LETTERS))
        at, ok = _look_up(h, self.vocabulary)
        total = np.bincount(text[ok], self.weight[at[ok]], len(texts)).astype(np.float64)
        total += _pattern_votes(texts) @ self.weight[self.vocabulary.size:] + self.bias
        return 1.0 / (1.0 + np.exp(-total))


def _training_rows(docs: DataFrame, vocabulary: np.ndarray, lexicon: np.ndarray, model: LabelModel,
                   rows: int) -> list:
    """Vocabulary indices, patterns and posterior of a bounded sample of documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(0)
            found = words(*text_bytes(texts), LETTERS)
            target = model.posterior(votes(texts, lexicon, found))
            text, h = _distinct(found)
            at, ok = _look_up(h, vocabulary)
            row, col = np.nonzero(_pattern_votes(texts))
            row, col = np.append(text[ok], row), np.append(at[ok], col + vocabulary.size)
            order = np.argsort(row, kind="stable")
            cuts = np.searchsorted(row[order], np.arange(1, len(texts)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.split(col[order].astype(np.int32), cuts), pa.list_(pa.int32())),
                 pa.array(target)], names=["at", "target"])

    ids = (docs.select("doc_id").dropna().distinct()
           .orderBy(F.xxhash64(F.col("doc_id"), F.lit(6)), "doc_id").limit(rows))
    sample = id_and_text(docs).join(F.broadcast(ids), "doc_id").select("text")
    return sample.mapInArrow(run, "at array<int>, target double").collect()


def _vocabulary(sample: DataFrame, lexicon: np.ndarray) -> np.ndarray:
    rows = (_class_counts(sample).orderBy((F.col("clean") + F.col("toxic")).desc(), "hash")
            .limit(VOCABULARY).select("hash").collect())
    return np.union1d(np.array([r["hash"] for r in rows], np.int64).view(np.uint64), lexicon)


def train_linear(rows: list, size: int, steps: int = 300, penalty: float = 1e-4
                 ) -> tuple[np.ndarray, float]:
    """Logistic regression on posterior labels, by gradient steps with per-weight scaling."""
    lengths = [len(r["at"]) for r in rows]
    at = np.fromiter((i for r in rows for i in r["at"]), np.int64, sum(lengths))
    doc = np.repeat(np.arange(len(rows)), lengths)
    target = np.array([r["target"] for r in rows])
    w, n = np.zeros(size + 1), max(1, len(rows))
    mean, square = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, steps + 1):
        p = 1.0 / (1.0 + np.exp(-(np.bincount(doc, w[at], minlength=len(rows)) + w[size])))
        error = (p - target) / n
        grad = np.append(np.bincount(at, error[doc], minlength=size), error.sum())
        grad[:size] += penalty * w[:size] / n
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad ** 2
        w -= 0.1 * (mean / (1 - 0.9 ** t)) / (np.sqrt(square / (1 - 0.99 ** t)) + 1e-10)
    return w[:size], float(w[size])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 4,
        held_out: int = 2, labelled_rows: int = LABELLED_ROWS,
        training_rows: int = TRAINING_ROWS) -> ToxicityModel:
    """Mine voters, fit the label model over all documents, train the classifier.

    Labels are learned from at most ``labelled_rows`` rows whose remainder
    is not ``held_out``; the classifier is trained on the posteriors of at
    most ``training_rows`` documents. Without toxic labels there is no
    lexicon and every score is low.
    """
    sample = labelled_sample(docs, labels, label, labelled_rows, modulus, held_out)
    lexicon = mine_lexicon(sample)
    counts, n = joint_counts(docs, lexicon)
    model = fit_label_model(counts, n, lexicon.size)
    vocabulary = _vocabulary(sample, lexicon)
    size = vocabulary.size + len(PATTERNS)
    rows = _training_rows(docs, vocabulary, lexicon, model, training_rows)
    weight, bias = train_linear(rows, size) if rows else (np.zeros(size), -7.0)
    return ToxicityModel(vocabulary, weight, bias)


def with_score(docs: DataFrame, model: ToxicityModel, name: str = "score") -> DataFrame:
    """``docs`` with the toxicity score of every whole text (0 to 1) in column ``name``.

    NULL and empty texts get the score of a text without words; repeated
    rows are scored each; no row moves.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        parts = [held.value.score(b.column(0)) for b in slices([batch])]
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
