"""Feature merge and its text forms.

All inputs are one row per ``uid``; the chain of equi-joins on ``uid``
shuffles each input once at most (inputs produced by a grouping on
``uid`` are already partitioned that way) and the intermediate results
keep that partitioning, so no join re-shuffles the growing table.
None of the inputs is broadcast by hand: each grows with the user count.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.expressions import delimited
from ..session import bucketed
from ..sources.tables import parse_lines

AMOUNT_STAT_COLUMNS = ["min_amt", "max_amt", "mid_amt", "avg_amt", "var_amt"]
AMOUNT_RANGE_COLUMNS = ["amt_count", "thousand_rate", "ten_thousand_rate",
                        "hundred_thousand_rate"]
DAY_COLUMNS = [f"{side}_{c}" for side in ("op", "trans")
               for c in ("days_span", "early_rate", "middle_rate", "end_rate")]
HOUR_COLUMNS = [f"{side}_{c}" for side in ("op", "trans")
                for c in ("hour_span", "night_rate", "morning_rate", "noon_rate",
                          "afternoon_rate", "evening_rate")]
TOP_OP_COLUMNS = ["op_top1", "op_top2", "op_top3"]
TOP_TRANS_COLUMNS = ["trans_top1", "trans_top2", "trans_top3"]
FLAG_COLUMNS = ["flag1", "flag2", "flag3"]

FEATURE_COLUMNS = (AMOUNT_STAT_COLUMNS + AMOUNT_RANGE_COLUMNS + DAY_COLUMNS + HOUR_COLUMNS
                   + TOP_OP_COLUMNS + TOP_TRANS_COLUMNS + FLAG_COLUMNS)   # 38
MERGED_COLUMNS = ["uid", "label"] + FEATURE_COLUMNS


def merge_features(labels: DataFrame, tables: Sequence[DataFrame],
                   how: str = "inner") -> DataFrame:
    """``uid, label`` + the 38 features, taken from per-user ``tables``.

    Each table holds one row per ``uid`` and some of the feature columns;
    together they must cover ``FEATURE_COLUMNS``. ``how="inner"`` (default,
    K5) keeps users present in every table; ``how="left"`` keeps every
    labelled user (missing features NULL) so that every user can be scored.
    """
    wanted = set(FEATURE_COLUMNS)
    parts = [t.selectExpr("uid", *[c for c in t.columns if c in wanted]) for t in tables]
    merged = reduce(lambda acc, t: acc.join(t, "uid", how), parts,
                    labels.selectExpr("uid", "label"))
    return merged.selectExpr(*MERGED_COLUMNS)


def merge_bucketed(labels: DataFrame, tables: Sequence[DataFrame], buckets: int,
                   how: str = "inner") -> DataFrame:
    """J9 over tables written bucketed by ``uid``: the joins themselves shuffle nothing.

    Worth it where the feature tables are written anyway or merged more than once:
    each is shuffled once, when it is written.
    """
    return merge_features(bucketed(labels, "labels", "uid", buckets),
                          [bucketed(t, f"features_{k}", "uid", buckets)
                           for k, t in enumerate(tables)], how)


def to_delimited(merged: DataFrame, sep: str = "|") -> DataFrame:
    """One line per user ``uid|label|f1|...|f38``; NULL prints blank."""
    return merged.select(delimited(MERGED_COLUMNS, sep).alias("value"))


def feature_schema(columns: Sequence[str]) -> T.StructType:
    """``uid`` and numeric columns, the layout of every feature table in text form."""
    return T.StructType([T.StructField("uid", T.StringType()),
                         *[T.StructField(c, T.DoubleType()) for c in columns]])


def parse_delimited(lines: DataFrame, value: str = "value", sep: str = "|",
                    columns: Sequence[str] = ("label", *FEATURE_COLUMNS)) -> DataFrame:
    """Lines ``uid|...`` of any feature table back to ``uid`` and numbers.

    Blank features are 0.0; a blank label and text that is not a number raise
    an error.
    """
    return parse_lines(lines, feature_schema(columns), sep, value,
                       blank_zero=[c for c in columns if c != "label"])
