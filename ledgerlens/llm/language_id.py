"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training is a count: every task adds up the n-gram buckets of its rows per
language, Spark sums the partial counts, and the driver receives one number
per language and bucket. The matrix of log-probabilities has that same fixed
size and is broadcast. Scoring is a sparse product: the buckets of a slice of
texts pick rows of the matrix, which are added up per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LETTER, char_classes, remainder, slices

#: Buckets of the n-gram hash; the model has this many numbers per language.
BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
UNKNOWN = "und"
_MULTIPLIER = np.uint32(2654435761)  # odd, spreads code points over the upper bits


def ngram_buckets(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each order by start, each text's start, and its letter count.

    Lower-cased letters count as themselves, every other character as a gap.
    Gaps after each text keep n-grams from crossing into the next one;
    bucket 0 stands for n-grams without a letter and carries no evidence.
    """
    gap = "\n" * max(ORDERS)
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer((gap.join(lowered) + gap).encode("utf-32-le"), np.uint32)
    letter = char_classes()[codes] == LETTER
    codes = np.where(letter, codes, 0)
    lengths = np.array([len(t) + len(gap) for t in lowered], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    out, rolled, any_letter = [], np.zeros_like(codes), np.zeros(codes.size, bool)
    for n in range(1, max(ORDERS) + 1):
        shifted = np.zeros_like(codes)
        shifted[:codes.size - n + 1] = codes[n - 1:]
        any_letter = any_letter | (shifted > 0)
        rolled = (rolled ^ (shifted + np.uint32(n))) * _MULTIPLIER
        rolled ^= rolled >> np.uint32(15)
        if n in ORDERS:
            out.append(np.where(any_letter, rolled % np.uint32(BUCKETS - 1) + 1, 0))
    return out, starts, np.add.reduceat(letter, starts, dtype=np.int64)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    log_prior: np.ndarray   # (languages,)
    log_prob: np.ndarray    # (languages, buckets), 0 in bucket 0

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Most probable language of each text and its posterior probability."""
        buckets, starts, letters = ngram_buckets(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        total = np.empty((len(texts), len(self.languages)))
        for k, row in enumerate(self.log_prob):
            evidence = row[buckets[0]]
            for b in buckets[1:]:
                evidence += row[b]
            total[:, k] = np.add.reduceat(evidence, starts, dtype=np.float64)
        total += self.log_prior
        best = total.argmax(axis=1)
        top = total.max(axis=1, keepdims=True)
        score = 1.0 / np.exp(total - top).sum(axis=1)
        named = [self.languages[k] if n else UNKNOWN for k, n in zip(best.tolist(), letters)]
        return named, np.where(letters > 0, score, 0.0)


def fit(docs: DataFrame, label: str = "lang") -> LanguageModel:
    """Count n-grams per language over all rows with a text and a label."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            names = np.array(batch.column(0).to_pylist(), dtype=object)
            texts = np.array(batch.column(1).to_pylist(), dtype=object)
            for name in set(names.tolist()):
                own = texts[names == name].tolist()
                held = counts.setdefault(name, np.zeros(BUCKETS + 1, np.int64))
                for b in ngram_buckets(own)[0]:
                    held[:BUCKETS] += np.bincount(b, minlength=BUCKETS)
                held[BUCKETS] += len(own)  # the last cell counts texts
        for name, held in counts.items():
            met = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * met.size, pa.string()), pa.array(met, pa.int32()),
                 pa.array(held[met], pa.int64())], names=["label", "bucket", "n"])

    labelled = docs.select(F.col(label).alias("label"), "text").dropna()
    summed = (labelled.mapInArrow(count, "label string, bucket int, n long")
              .groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(summed["label"].unique().tolist())
    counts = np.zeros((len(languages), BUCKETS + 1))
    rows = np.searchsorted(np.array(languages, dtype=str), summed["label"].to_numpy(dtype=str))
    counts[rows, summed["bucket"].to_numpy(dtype=int)] = summed["n"].to_numpy(dtype=float)
    texts, counts = counts[:, BUCKETS], counts[:, :BUCKETS]
    counts[:, 0] = 0
    smoothed = counts + SMOOTHING
    log_prob = np.log(smoothed / smoothed[:, 1:].sum(axis=1, keepdims=True))
    log_prob[:, 0] = 0
    return LanguageModel(languages, np.log(texts / max(1.0, texts.sum())),
                         log_prob.astype(np.float32))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text.

    A NULL text and one without a letter get ``und`` and 0.0, as does
    every text when the model has learned no language. Each repeated row is
    scored; an empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            names, score = held.value.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    return (docs.select(F.col("doc_id").cast("long"), "text")
            .mapInArrow(run, "doc_id long, lang_pred string, score double"))


def fit_and_identify(docs: DataFrame, modulus: int = 3, held_out: int = 1) -> DataFrame:
    """Learn from rows outside the held-out remainder, predict all rows."""
    model = fit(docs.filter(remainder("doc_id", modulus) != held_out))
    return (identify(docs, model)
            .withColumn("held_out", remainder("doc_id", modulus) == held_out)
            .select("doc_id", "held_out", "lang_pred", "score"))
