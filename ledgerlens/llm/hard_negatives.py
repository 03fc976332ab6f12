"""Hard negatives by angular triangle filtering.

Every row stores its norm and its angles to a few reference directions. For an anchor
a and a row v the angle between them lies in
``[max |ra - rv|, min(ra + rv, 2 pi - ra - rv)]`` over the references r, so its cosine
lies in an interval, and with the norms so does the score. Rows are held in windows of
``WINDOW`` neighbours (same label, same nearest reference, similar angle); the bounds
of a window, widened by what rounding can do, decide whether it can hold a wanted
score. Only the windows that overlap are scored, on whole numbers.

Two passes over a grid of row blocks and anchor blocks, both of bounded size, joined on
the block numbers: the first gives each anchor's positives, the second the negatives
below each positive. A task returns the best few of its block per anchor, and these
are ranked once more. The references come from a sample of ``SAMPLE`` rows; they change
which windows are passed over, never the result.

Defined results:

* rows with a NULL label, a NULL vector, or a component that is NULL or not finite (also
  after scaling) take no part; an empty vector has score 0 with other empty ones;
* vectors of another length than the anchor's have no score with it;
* rows that repeat a vec_id are rows of their own; a NULL vec_id is no anchor, keeps
  its label, and comes after all others among ties;
* scores beyond the range of a long count as its ends;
* an empty table gives no rows; columns other than the three named are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialized

#: Positives per anchor, negatives per positive, and the shares (in hundredths of the
#: positive's score) between which a negative's score lies.
POSITIVES, NEGATIVES, LEAST, MOST = 5, 10, 30, 90
#: Anchors are the ids divisible by this.
ANCHOR_STEP = 100
REFERENCES, SAMPLE, ROUNDS = 16, 2048, 8
#: Rows of a window; rows and vector bytes of a row block at most; anchors of an anchor block.
WINDOW = 32
LEAST_ROWS, BLOCK_BYTES, ROW_BLOCKS = 4096, 32 << 20, 64
ANCHORS = 1024
#: Bytes of scores held at once.
SCORE_BYTES = 32 << 20
#: What rounding may do to an angle (radians), and to a bound (share of the norms' product).
ANGLE_SLACK, SCORE_SLACK = 2e-6, 1e-9
#: Whole numbers up to here are exact in a product of doubles.
EXACT = 2.0 ** 53
LONG = 2 ** 63 - 1


# ---- stored angles --------------------------------------------------------

def reference_directions(vectors: np.ndarray, count: int = REFERENCES) -> np.ndarray:
    """Unit directions by spherical k-means from far-apart starts; rows of zeros are left out."""
    norms = np.linalg.norm(vectors, axis=1)
    units = vectors[norms > 0] / norms[norms > 0, None]
    if not len(units):
        return np.zeros((0, vectors.shape[1]))
    chosen = [0]
    near = units @ units[0]
    while len(chosen) < min(count, len(units)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, units @ units[chosen[-1]])
    refs = units[chosen]
    for _ in range(ROUNDS):
        owner = np.argmax(units @ refs.T, axis=1)
        for k in range(len(refs)):
            total = units[owner == k].sum(axis=0)
            size = np.linalg.norm(total)
            if size > 0:
                refs[k] = total / size
    return refs


def _angles(vectors: np.ndarray, norms: np.ndarray, refs: np.ndarray) -> np.ndarray:
    cosines = (vectors / np.where(norms > 0, norms, 1)[:, None]) @ refs.T
    return np.arccos(np.clip(cosines, -1, 1))


def quantised(components: np.ndarray) -> np.ndarray:
    """``floor(256 * x)`` as doubles that hold whole numbers."""
    with np.errstate(over="ignore"):
        return np.floor(256.0 * components)


def with_angles(embeddings: DataFrame) -> DataFrame:
    """``row, vec_id, label, dim, v, norm, angles`` of the rows that take part, as a written table."""
    rows = embeddings.selectExpr(
        "CAST(vec_id AS BIGINT) AS vec_id", "CAST(label AS BIGINT) AS label",
        "CAST(embedding AS ARRAY<DOUBLE>) AS embedding").filter(
        "label IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL"
        " AND NOT isnan(x) AND abs(256 * x) < double('infinity'))")
    sample = rows.orderBy(F.xxhash64("vec_id")).limit(SAMPLE).select("embedding").toPandas()
    by_length: dict[int, list] = {}
    for v in sample["embedding"]:
        by_length.setdefault(len(v), []).append(v)
    refs = {n: reference_directions(quantised(np.array(vs, dtype=float).reshape(len(vs), n)))
            for n, vs in by_length.items()}

    def run(batches):
        first = TaskContext.get().partitionId() << 33
        for batch in batches:
            vectors = batch.column(2)
            lengths = np.asarray(vectors.value_lengths(), np.int64)
            flat = np.asarray(vectors.flatten(), float)
            starts = np.cumsum(lengths) - lengths
            out: list[tuple] = []
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                v = quantised(flat[starts[at][:, None] + np.arange(n)])
                norms = np.sqrt((v * v).sum(axis=1))
                angles = _angles(v, norms, refs.get(int(n), np.zeros((0, n))))
                out += [(k, a.tobytes(), size, b.tobytes())
                        for k, a, size, b in zip(at, v, norms, angles)]
            out.sort(key=lambda r: r[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(first + np.arange(batch.num_rows)), batch.column(0), batch.column(1),
                 pa.array(lengths.astype(np.int32)), pa.array([r[1] for r in out], pa.binary()),
                 pa.array([r[2] for r in out], pa.float64()),
                 pa.array([r[3] for r in out], pa.binary())],
                names=["row", "vec_id", "label", "dim", "v", "norm", "angles"])
            first += batch.num_rows

    stored = rows.mapInArrow(run, "row long, vec_id long, label long, dim int, v binary,"
                                  " norm double, angles binary")
    return materialized(stored, "angles")


# ---- one block of rows against one block of anchors ------------------------

def _matrix(t: pa.Table, name: str, width: int | None = None) -> np.ndarray:
    flat = np.frombuffer(b"".join(t[name].to_pylist()), float)
    return flat.reshape(t.num_rows, width if width is not None else -1 if t.num_rows else 0)


class Block:
    """Rows of one block in windows, with bounds on their scores with any anchor."""

    def __init__(self, t: pa.Table, dim: int):
        label = np.asarray(t["label"])
        angles, norm = _matrix(t, "angles"), np.asarray(t["norm"])
        nearest = angles.argmin(axis=1) if angles.shape[1] else np.zeros(len(label), int)
        along = (angles[np.arange(len(label)), nearest] if angles.shape[1] else norm)
        order = np.lexsort((along, nearest, label))
        self.label, self.row = label[order], np.asarray(t["row"])[order]
        self.v = _matrix(t, "v", dim)[order]
        ids = t["vec_id"].combine_chunks()
        self.known = np.asarray(ids.is_valid())[order]
        self.ids = np.asarray(ids.fill_null(0))[order]
        self.rank = np.empty(len(order), np.int64)
        self.rank[np.lexsort((self.ids, ~self.known))] = np.arange(len(order))
        # a window never spans two labels
        edge = np.flatnonzero(np.diff(self.label)) + 1
        bounds = np.concatenate([[0], edge, [len(order)]])
        self.starts = np.concatenate([np.arange(a, b, WINDOW)
                                      for a, b in zip(bounds, bounds[1:])] or [[]]).astype(int)
        self.ends = np.concatenate([self.starts[1:], [len(order)]])
        angles, norm = angles[order], norm[order]
        cut = np.minimum.reduceat, np.maximum.reduceat
        self.low, self.high = (f(angles, self.starts, axis=0) for f in cut)
        self.least, self.most = (f(norm, self.starts) for f in cut)
        self.window_label = self.label[self.starts]

    def bounds(self, angles: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of each anchor with each window, rounding allowed for."""
        shape = (len(norm), len(self.starts))
        near, far = np.zeros(shape), np.full(shape, np.pi)
        for r in range(angles.shape[1]):
            a = angles[:, r, None]
            np.maximum(near, a - self.high[:, r], out=near)
            np.maximum(near, self.low[:, r] - a, out=near)
            np.minimum(far, a + self.high[:, r], out=far)
            np.minimum(far, 2 * np.pi - a - self.low[:, r], out=far)
        top = np.cos(np.clip(near - ANGLE_SLACK, 0, np.pi))
        bottom = np.cos(np.clip(far + ANGLE_SLACK, 0, np.pi))
        slack = SCORE_SLACK * norm[:, None] * self.most + 1
        return (norm[:, None] * bottom * np.where(bottom > 0, self.least, self.most) - slack,
                norm[:, None] * top * np.where(top > 0, self.most, self.least) + slack)

    def score(self, scores: np.ndarray, vectors: np.ndarray, wanted: np.ndarray) -> None:
        """Fill in the whole-number scores of the wanted (anchor, window) pairs."""
        for w in np.flatnonzero(wanted.any(axis=0)):
            who, a, b = np.flatnonzero(wanted[:, w]), self.starts[w], self.ends[w]
            scores[who, a:b] = _products(vectors[who], self.v[a:b])


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products, exact; those beyond a long count as its ends."""
    peak = (np.abs(a).max(initial=0) * np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if peak < EXACT:
        return a @ b.T
    whole_a = [[int(x) for x in row] for row in a]
    whole_b = [[int(x) for x in row] for row in b]
    return np.array([[min(LONG, max(-LONG, sum(x * y for x, y in zip(p, q)))) for q in whole_b]
                     for p in whole_a], dtype=object)


def _scores_like(vectors: np.ndarray, block: Block) -> np.ndarray:
    """Empty table of scores: doubles where they are exact, else Python's whole numbers."""
    peak = (np.abs(vectors).max(initial=0) * np.abs(block.v).max(initial=0)
            * max(1, vectors.shape[1]))
    if peak < EXACT:
        return np.full((len(vectors), len(block.row)), -np.inf)
    return np.full((len(vectors), len(block.row)), float("-inf"), dtype=object)


def _best(scores: np.ndarray, rank: np.ndarray, count: int) -> np.ndarray:
    """Positions of the ``count`` best finite scores, ties by rank."""
    at = np.flatnonzero(scores > -np.inf)
    if len(at) > count and scores.dtype == float:
        at = at[scores[at] >= np.partition(scores[at], -count)[-count]]
    return at[np.lexsort((rank[at], -scores[at]))][:count]


def _reached(scores: np.ndarray, count: int) -> np.ndarray:
    """Per anchor the ``count``-th best score so far (minus infinity if there are fewer)."""
    if scores.shape[1] < count or scores.dtype != float:
        return np.full(len(scores), -np.inf)
    return np.partition(scores, -count, axis=1)[:, -count]


def _first_windows(order_by: np.ndarray, allowed: np.ndarray, sizes: np.ndarray,
                   rows: int) -> np.ndarray:
    """Per anchor the allowed windows of highest ``order_by`` that hold ``rows`` rows."""
    key = np.where(allowed, order_by, -np.inf)
    order = np.argsort(-key, axis=1, kind="stable")
    held = np.cumsum(np.take_along_axis(allowed * sizes, order, axis=1), axis=1)
    first = np.zeros(allowed.shape, bool)
    before = np.concatenate([np.zeros((len(held), 1)), held[:, :-1]], axis=1)
    np.put_along_axis(first, order, before < rows, axis=1)
    return first & allowed


def positives_in(block: Block, anchors: pa.Table, dim: int) -> list[tuple]:
    """``(anchor, score, vec_id)``: each anchor's best rows of its own label in the block."""
    out: list[tuple] = []
    sizes = block.ends - block.starts
    step = max(1, SCORE_BYTES // (8 * max(1, len(block.row))))
    for at in range(0, anchors.num_rows, step):
        part = anchors.slice(at, step)
        row, label = np.asarray(part["row"]), np.asarray(part["label"])
        vectors = _matrix(part, "v", dim)
        _, high = block.bounds(_matrix(part, "angles"), np.asarray(part["norm"]))
        same = label[:, None] == block.window_label
        scores = _scores_like(vectors, block)
        first = _first_windows(high, same, sizes, POSITIVES + 1)
        block.score(scores, vectors, first)
        # one more than wanted: an anchor may have met itself
        need = _reached(scores, POSITIVES + 1)
        block.score(scores, vectors, same & ~first & (high >= need[:, None]))
        for k in range(part.num_rows):
            scores[k, block.row == row[k]] = -np.inf
            out += [(int(row[k]), int(scores[k, j]), int(block.ids[j]) if block.known[j] else None)
                    for j in _best(scores[k], block.rank, POSITIVES)]
    return out


def score_limits(score: int) -> tuple[int, int]:
    """Least and greatest score of a negative for a positive's score."""
    return -(-LEAST * score // 100), MOST * score // 100


def negatives_in(block: Block, anchors: pa.Table, dim: int) -> list[tuple]:
    """``(anchor, target, score, vec_id)``: the best rows of other labels for each positive score."""
    out: list[tuple] = []
    sizes = block.ends - block.starts
    step = max(1, SCORE_BYTES // (8 * max(1, len(block.row))))
    for at in range(0, anchors.num_rows, step):
        part = anchors.slice(at, step)
        row, label = np.asarray(part["row"]), np.asarray(part["label"])
        targets = part["targets"].to_pylist()
        vectors = _matrix(part, "v", dim)
        low, high = block.bounds(_matrix(part, "angles"), np.asarray(part["norm"]))
        other = label[:, None] != block.window_label
        scores = _scores_like(vectors, block)
        done = np.zeros(other.shape, bool)
        width = max(map(len, targets), default=0)
        for j in range(width):
            # limits as doubles, widened; a missing target wants nothing
            limits = [score_limits(t[j]) if j < len(t) else (1, 0) for t in targets]
            least = np.array([float(a) - 1 - abs(a) * 1e-12 for a, _ in limits])
            most = np.array([float(b) + 1 + abs(b) * 1e-12 for _, b in limits])
            wanted = np.array([a <= b for a, b in limits])
            can = (other & (low <= most[:, None]) & (high >= least[:, None]) & wanted[:, None])
            first = _first_windows(np.minimum(high, most[:, None]) - 1e-6 * low, can, sizes,
                                   4 * NEGATIVES)
            block.score(scores, vectors, first & ~done)
            done |= first
            inside = scores
            if scores.dtype == float:
                inside = np.where((scores >= np.array([float(a) for a, _ in limits])[:, None])
                                  & (scores <= np.array([float(b) for _, b in limits])[:, None]),
                                  scores, -np.inf)
            need = _reached(inside, NEGATIVES)
            more = can & ~done & (high >= need[:, None])
            block.score(scores, vectors, more)
            done |= more
            for k in np.flatnonzero(wanted):
                a, b = limits[k]
                held = np.where((scores[k] >= a) & (scores[k] <= b), scores[k], -np.inf)
                out += [(int(row[k]), targets[k][j], int(scores[k, i]),
                         int(block.ids[i]) if block.known[i] else None)
                        for i in _best(held, block.rank, NEGATIVES)]
    return out


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)


# ---- the grid -------------------------------------------------------------

def _met(rows: DataFrame, anchors: DataFrame, grid: tuple[int, int],
         run: Callable[[Block, pa.Table, int], list[tuple]], names: list[str]) -> DataFrame:
    """``run`` for every pair of a row block and an anchor block of equal vector length.

    Both sides deal by keys of the same types, as equal keys of other types hash apart.
    """
    row_blocks, anchor_blocks = grid

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _table([], names)
        dim = int(left["dim"][0].as_py())
        return _table(run(Block(left, dim), right, dim), names)

    dealt_rows = rows.selectExpr(
        "*", f"CAST(pmod(xxhash64(row), {row_blocks}) AS INT) AS h",
        f"explode(sequence(0, {anchor_blocks - 1})) AS g")
    # new column identities: anchors are rows as well
    dealt_anchors = anchors.toDF(*anchors.columns).selectExpr(
        "*", f"CAST(pmod(xxhash64(row, 1), {anchor_blocks}) AS INT) AS g",
        f"explode(sequence(0, {row_blocks - 1})) AS h")
    return dealt_rows.groupBy("dim", "g", "h").cogroup(
        dealt_anchors.groupBy("dim", "g", "h")).applyInArrow(
        cell, ", ".join(f"{n} long" for n in names))


def _ranked(df: DataFrame, keys: str, count: int) -> DataFrame:
    order = "score DESC, vec_id ASC NULLS LAST"
    return df.selectExpr(
        "*", f"CAST(row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS INT) AS rank"
    ).filter(f"rank <= {count}")


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    For ids divisible by 7 the label first becomes ``(label + 1) % 10``.
    """
    rows = with_angles(embeddings).selectExpr(
        "row", "vec_id", "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label",
        "dim", "v", "norm", "angles")
    anchors = rows.filter(f"vec_id % {ANCHOR_STEP} = 0")
    size = rows.selectExpr("count(1) AS n", f"count_if(vec_id % {ANCHOR_STEP} = 0) AS anchors",
                           "coalesce(max(dim), 0) AS dim").first()
    # few rows are dealt finer than many, up to blocks of bounded bytes
    per_block = max(LEAST_ROWS, min(size["n"] // ROW_BLOCKS,
                                    BLOCK_BYTES // (8 * (size["dim"] + REFERENCES))))
    grid = max(1, -(-size["n"] // per_block)), max(1, -(-size["anchors"] // ANCHORS))
    positives = materialized(_ranked(
        _met(rows, anchors, grid, positives_in, ["row", "score", "vec_id"]), "row", POSITIVES),
        "positives")
    # the same score asks for the same negatives, and one below zero for none
    targets = positives.filter("score >= 0").groupBy("row").agg(
        F.expr("sort_array(collect_set(score), false) AS targets"))
    negatives = _ranked(
        _met(rows, anchors.join(targets, "row"), grid, negatives_in,
             ["row", "target", "score", "vec_id"]), "row, target", NEGATIVES)
    found = negatives.selectExpr("row", "target", "rank", "vec_id AS negative_id",
                                 "score AS negative_score")
    wanted = positives.selectExpr("row", "score AS target", "vec_id AS positive_id",
                                  "score AS positive_score")
    return (found.join(wanted, ["row", "target"])
            .join(anchors.selectExpr("row", "vec_id AS anchor_id"), "row")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                    "negative_score"))
