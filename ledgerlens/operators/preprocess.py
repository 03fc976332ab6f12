"""Step 0: slim, de-duplicated logs.

The load step writes every missing text as blank (S2); tables that did not come
through it get the same here, so rows without a user, time, type or channel belong to
the blank one and no later join or window loses them.

Duplicates are dropped after the projection (K1): two operations with the
same uid, day, type and time count once in every later feature. The
``distinct`` is a hash aggregate with a map-side partial step, so a hot
user's copies collapse before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import sql_user, strict_number


def _number(df: DataFrame, c: str, kind: str) -> Column:
    """``c`` as a number: text strictly, a numeric column as it is."""
    is_text = dict(df.dtypes)[c] == "string"
    return (strict_number(c, kind) if is_text else F.col(c).cast(kind)).alias(c)


def slim_operations(raw_ops: DataFrame) -> DataFrame:
    """``uid, op_day int, op_type, op_time`` of the operation log, distinct."""
    slim = raw_ops.selectExpr(
        sql_user(),
        "day AS op_day",
        "coalesce(CAST(mode AS STRING), '') AS op_type",
        "coalesce(CAST(time AS STRING), '') AS op_time",
    ).distinct()
    return slim.select("uid", _number(slim, "op_day", "int"), "op_type", "op_time")


def slim_transactions(raw_trans: DataFrame) -> DataFrame:
    """Seven columns of the transaction log, amount as double, distinct.

    The amount is converted before the de-duplication, so ``1.0`` and
    ``1.00`` are the same amount; the day is converted after it, as the
    text day was. Casts trim blanks and fail on bad or missing text.
    """
    slim = raw_trans.selectExpr(
        sql_user(),
        "coalesce(CAST(channel AS STRING), '') AS trans_channel",
        "day AS trans_day",
        "trans_amt",
        "coalesce(CAST(time AS STRING), '') AS trans_time",
        "coalesce(CAST(trans_type1 AS STRING), '') AS trans_type1",
        "coalesce(CAST(trans_type2 AS STRING), '') AS trans_type2",
    )
    slim = slim.withColumn("trans_amt", _number(slim, "trans_amt", "double")).distinct()
    return slim.select("uid", "trans_channel", _number(slim, "trans_day", "int"),
                       "trans_amt", "trans_time", "trans_type1", "trans_type2")


def all_users(op_base: DataFrame, trans_base: DataFrame) -> DataFrame:
    """Every uid seen in either log."""
    return op_base.selectExpr("uid").union(trans_base.selectExpr("uid")).distinct()


def labels_or_default(labels: DataFrame | None, op_base: DataFrame,
                      trans_base: DataFrame) -> DataFrame:
    """The label table, or ``(uid, 0.0)`` for every user seen when it is absent.

    A uid listed twice would fan out every later join; it keeps one row
    with the larger label, which is deterministic.
    """
    if labels is None:
        return all_users(op_base, trans_base).selectExpr("uid", "0.0D AS label")
    return labels.groupBy("uid").agg(F.expr("max(label) AS label"))
