"""The decision tree as tables: its best root split in SQL, and its nodes applied by joins
(checks on M3-M6, S14).

``root_split`` does not fit a second tree. It works out, with one grouped class
histogram per feature and running sums, which split the learner has to put at the root:

* split candidates as the learner picks them: the midpoints between neighbouring
  distinct values when there are at most ``bins - 1``; otherwise the places where
  the running count passes multiples of ``rows / bins``, the value before the
  multiple if that lies nearer. At most one candidate lies between two neighbours,
  so a heavy value delays later ones: after i values, the number of candidates is
  ``i + min(0, min over j <= i of (q_j - j))``, where q_j multiples lie before the middle
  of the running counts around value j;
* the gain of each candidate in gini impurity from the class counts on both sides.

The learner samples rows for its candidates beyond 10,000 of them; here all rows count.

``node_table`` reads the nodes of a saved model, and ``predictions_from_nodes`` walks
them with one join per level.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ranking import before_each
from .model import TREE_PARAMS, feature_vectors, model_features

NODE_COLUMNS = "node INT, prediction DOUBLE, feature INT, threshold DOUBLE, left INT, right INT"


# ---- best root split --------------------------------------------------------

def class_histogram(merged: DataFrame, compat: bool = False) -> DataFrame:
    """``feature, x, n, n1``: rows, and rows of class 1, per value of each feature."""
    vectors = feature_vectors(merged, compat, keep=["label"])
    return (vectors.selectExpr("label", "posexplode(features) AS (feature, x)")
            .groupBy("feature", "x")
            .agg(F.expr("count(1) AS n"), F.expr("count_if(label = 1) AS n1")))


def split_candidates(histogram: DataFrame, max_bins: int = TREE_PARAMS["maxBins"]) -> DataFrame:
    """``feature, threshold, n_left, n1_left, n_all, n1_all`` of every candidate split."""
    whole = histogram.groupBy("feature").agg(
        F.expr("sum(n) AS n_all"), F.expr("sum(n1) AS n1_all"), F.expr("count(1) AS n_values"))
    running = before_each(histogram, ["feature"], ["x"], {
        "n_left": "sum(n)", "n1_left": "sum(n1)", "i": "sum(1)", "x_before": "max(x)"})
    # one row per feature
    placed = running.join(F.broadcast(whole), "feature").selectExpr(
        "*", f"least({int(max_bins)}L, n_all) AS bins").filter("i IS NOT NULL").selectExpr(
        "*", "((2 * n_left + n) * bins - 1) div (2 * n_all) - i AS lag")
    delayed = before_each(placed, ["feature"], ["x"], {"lag_before": "min(lag)"})
    many = "n_values > bins"
    here = "i + least(0, lag, coalesce(lag_before, 0))"
    past = "i - 1 + least(0, coalesce(lag_before, 0))"
    return (delayed.filter(f"NOT ({many}) OR {here} > {past}")
            .selectExpr("feature", "(x_before + x) / 2.0D AS threshold", "n_left", "n1_left",
                        "n_all", "n1_all"))


def _gini(n: str, n1: str) -> str:
    p1, p0 = f"CAST({n1} AS DOUBLE) / {n}", f"CAST({n} - {n1} AS DOUBLE) / {n}"
    return f"(1.0D - ({p0}) * ({p0}) - ({p1}) * ({p1}))"


def root_split(merged: DataFrame, compat: bool = False,
               max_bins: int = TREE_PARAMS["maxBins"]) -> DataFrame:
    """One row: the split of highest gain over all rows, ties by feature and threshold.

    ``feature`` (name), ``feature_index, threshold, gain``, and the rows of class 0 and 1
    on both sides. No row when no split gains anything.
    """
    names = ", ".join(f"'{c}'" for c in model_features(compat))
    found = split_candidates(class_histogram(merged, compat), max_bins).selectExpr(
        "*", "n_all - n_left AS n_right", "n1_all - n1_left AS n1_right").selectExpr(
        "*", f"{_gini('n_all', 'n1_all')}"
             f" - CAST(n_left AS DOUBLE) / n_all * {_gini('n_left', 'n1_left')}"
             f" - CAST(n_right AS DOUBLE) / n_all * {_gini('n_right', 'n1_right')} AS gain")
    return (found.filter("gain > 0")
            .orderBy(F.desc("gain"), "feature", "threshold").limit(1)
            .selectExpr(f"element_at(array({names}), feature + 1) AS feature",
                        "feature AS feature_index", "threshold", "gain",
                        "n_left - n1_left AS left_0", "n1_left AS left_1",
                        "n_right - n1_right AS right_0", "n1_right AS right_1"))


# ---- nodes --------------------------------------------------------------------

def node_table(spark: SparkSession, model_path: str) -> DataFrame:
    """The nodes of a saved tree: ``node, prediction, feature, threshold, left, right``.

    ``feature`` is the position in the feature vector; a leaf has no feature, threshold
    or children.
    """
    nodes = spark.read.parquet(f"{model_path.rstrip('/')}/stages/*DecisionTree*/data")
    if "nodeData" in nodes.columns:   # saved with a column per tree
        nodes = nodes.select("nodeData.*")
    return nodes.selectExpr(
        "id AS node", "prediction",
        "CASE WHEN leftChild >= 0 THEN split.featureIndex END AS feature",
        "CASE WHEN leftChild >= 0 THEN split.leftCategoriesOrThreshold[0] END AS threshold",
        "CASE WHEN leftChild >= 0 THEN leftChild END AS left",
        "CASE WHEN leftChild >= 0 THEN rightChild END AS right")


def predictions_from_nodes(vectors: DataFrame, nodes: DataFrame,
                           levels: int = TREE_PARAMS["maxDepth"]) -> DataFrame:
    """M4/M6: ``uid, prediction`` by walking ``nodes`` from node 0, one join per level.

    ``vectors``: ``uid, features`` (arrays). A binary tree of ``levels`` levels has less
    than ``2 ** (levels + 1)`` nodes, which bounds what is broadcast; a table with
    more is an error, and so is a row that has not met a leaf after all levels.
    """
    limit = 2 ** (int(levels) + 1)
    if nodes.limit(limit).count() >= limit:
        raise ValueError(f"more nodes than a tree of {levels} levels has")
    small = F.broadcast(nodes.toDF("at", "prediction", "feature", "threshold", "left", "right"))
    rows = vectors.selectExpr("uid", "features", "0 AS at")
    for _ in range(int(levels)):
        rows = rows.join(small, "at", "left").selectExpr(
            "uid", "features",
            "CASE WHEN feature IS NULL THEN at"
            " WHEN features[feature] <= threshold THEN left ELSE right END AS at")
    return rows.join(small, "at", "left").selectExpr(
        "uid", "CASE WHEN feature IS NULL AND prediction IS NOT NULL THEN CAST(prediction AS INT)"
               " ELSE raise_error('no leaf after all levels') END AS prediction")
