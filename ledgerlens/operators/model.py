"""Decision-tree training, evaluation and scoring.

Training uses ``pyspark.ml``: the tree learner aggregates split
statistics per level across the cluster. Type ids enter the model as
plain numbers (``"017"`` -> 17.0, K6) and missing features as 0.0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .merge import FEATURE_COLUMNS

# The original tree settings.
TREE_PARAMS = dict(impurity="gini", maxDepth=5, maxBins=32)


def split_bucket(key: str = "uid") -> Column:
    """M1: a bucket 0-9 from the first 32 bits of md5(key), the same on any partitioning."""
    h = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(10)).cast("int")


def hash_split(df: DataFrame, key: str = "uid", train_buckets: int = 8) -> DataFrame:
    """M1: adds ``bucket`` and ``is_train`` (buckets below ``train_buckets``: about 80%)."""
    return (df.withColumn("bucket", split_bucket(key))
            .withColumn("is_train", F.col("bucket") < train_buckets))


def model_features(compat: bool = False) -> list[str]:
    """The feature columns fed to the model.

    ``compat=True`` leaves out the last one (``flag3``) as the original
    column slice did (D1).
    """
    return FEATURE_COLUMNS[:-1] if compat else list(FEATURE_COLUMNS)


def feature_width(compat: bool = False) -> int:
    """Number of model features (the label is not counted, D6)."""
    return len(model_features(compat))


def _numeric_stage(cols: list[str]) -> SQLTransformer:
    # Numbers as double, missing -> 0.0; part of the saved model, so
    # scoring applies the same conversion.
    # Blank text is 0.0 too; other text that is not a number fails the job.
    exprs = ", ".join(
        f"CASE WHEN coalesce(trim(CAST({c} AS STRING)), '') = '' THEN 0.0D ELSE "
        f"coalesce(try_cast(trim(CAST({c} AS STRING)) AS DOUBLE), "
        f"raise_error('not a number in {c}')) END AS {c}__x" for c in cols)
    return SQLTransformer(statement=f"SELECT *, {exprs} FROM __THIS__")


def feature_vectors(merged: DataFrame, compat: bool = False,
                    keep: Sequence[str] = ("uid",)) -> DataFrame:
    """``keep`` and the model's feature vector as an array of doubles."""
    cols = model_features(compat)
    numeric = _numeric_stage(cols).transform(merged)
    assembled = VectorAssembler(inputCols=[f"{c}__x" for c in cols],
                                outputCol="features").transform(numeric)
    return assembled.select(*keep, vector_to_array("features").alias("features"))


def tree_pipeline(compat: bool = False, seed: int = 7, label: str = "label") -> Pipeline:
    """M2 + M3: numeric conversion -> ``VectorAssembler`` -> ``DecisionTreeClassifier``."""
    cols = model_features(compat)
    return Pipeline(stages=[
        _numeric_stage(cols),
        VectorAssembler(inputCols=[f"{c}__x" for c in cols], outputCol="features"),
        DecisionTreeClassifier(labelCol=label, featuresCol="features", seed=seed,
                               **TREE_PARAMS),
    ])


# The label is declared binary, so a training sample that happens to hold
# one class still yields a two-class tree.
_BINARY_LABEL = {"ml_attr": {"type": "nominal", "num_vals": 2, "name": "label"}}


def train(merged: DataFrame, compat: bool = False, seed: int = 7) -> PipelineModel:
    """M3: fit on labelled rows (``label`` as double)."""
    data = merged.withColumn(
        "label", F.col("label").cast("double").alias("label", metadata=_BINARY_LABEL))
    return tree_pipeline(compat, seed).fit(data)


def predict(model: PipelineModel, merged: DataFrame) -> DataFrame:
    """M4/M6: ``uid, prediction int`` (plus ``label`` when present)."""
    keep = ["uid"] + (["label"] if "label" in merged.columns else [])
    scored = model.transform(merged)
    return scored.select(*keep, F.col("prediction").cast("int").alias("prediction"))


def accuracy(predictions: DataFrame) -> DataFrame:
    """One row -- share of rows whose prediction equals the label, and the row count."""
    hit = (F.col("prediction").cast("double") == F.col("label").cast("double")).cast("double")
    return predictions.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n_rows"))


def save_model(model: PipelineModel, path: str) -> None:
    """S14."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """S14."""
    return PipelineModel.load(path)
