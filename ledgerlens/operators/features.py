"""Per-user day and hour features of both logs side by side.

Each side is one grouped aggregate keyed by ``uid``; the full outer join
of the two then needs no further shuffle, because both sides already
come out hash-partitioned on ``uid``. A user missing from one log gets
NULL on that side (the original wrote blanks); ``fillna(0.0)`` happens
only when features are assembled for the model. Rows without a user belong to
the user ``""`` on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.expressions import sql_user
from .stats import day_aggs, days_range, hour_aggs, hours_range


def _known(log: DataFrame) -> DataFrame:
    return log.selectExpr(sql_user(), *[f"`{c}`" for c in log.columns if c != "uid"])


def action_days(op_base: DataFrame, trans_base: DataFrame) -> DataFrame:
    """A7 + J4: ``uid`` + op_{days_span, early, middle, end} + trans_{...}."""
    op = days_range(_known(op_base), "op_day", prefix="op_")
    tr = days_range(_known(trans_base), "trans_day", prefix="trans_")
    return op.join(tr, "uid", "full_outer")


def action_hours(op_base: DataFrame, trans_base: DataFrame) -> DataFrame:
    """A9 + J5: ``uid`` + op_{hour_span, night..evening} + trans_{...}."""
    op = hours_range(_known(op_base), "op_time", prefix="op_")
    tr = hours_range(_known(trans_base), "trans_time", prefix="trans_")
    return op.join(tr, "uid", "full_outer")


def user_time_profile(op_base: DataFrame, trans_base: DataFrame) -> DataFrame:
    """A7 + A9 in one pass per log: ``uid`` + 8 day and 12 hour features.

    Day and hour statistics of a log share one grouping by ``uid`` (one
    scan, one shuffle per log) and the two logs meet in one full outer
    join, instead of four groupings and two joins.
    """
    op = _known(op_base).groupBy("uid").agg(*day_aggs("op_day", "op_"), *hour_aggs("op_time", "op_"))
    tr = _known(trans_base).groupBy("uid").agg(*day_aggs("trans_day", "trans_"),
                                       *hour_aggs("trans_time", "trans_"))
    return op.join(tr, "uid", "full_outer")
