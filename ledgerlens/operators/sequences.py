"""Daily action sequences, adjacent-action tokens and follow rates
(W5-W8, A13-A15, A17, J6-J8, P3-P6, F5, F9, F10).

A user-day's sequence is every action of both logs ordered by time, then
source (operations before transactions), then type id (W5). The
sequence is kept as rows, not as one array per user-day: identical
``(uid, day, time, src, type_id)`` actions are first counted into one
row with a multiplicity ``mult`` (a partial aggregate before the
shuffle). One window per user-day puts them in order. A user-day with more
than ``HEAVY_ACTIONS`` actions is cut into its hours; what one hour hands to the
next (position, neighbours) travels as two more rows per hour, in the same shuffle
as the actions, so the sequence is never joined with itself.

Tokens (W6), for a sequence s of length n: for each i < n-1 emit
``s[i]-s[i+1]`` when they differ; when equal emit the single ``s[i]``
only if i+1 is the last index; a one-action sequence emits ``s[0]``.
In terms of runs of equal ids: one pair per run boundary, plus a single
for the last run when that run is longer than one action or is the only
run. On the counted rows (cur, prev, next = neighbour ids in the order):

* pair ``cur-next`` where ``next`` exists and differs from ``cur``;
* single ``cur`` at the last row when ``mult >= 2``, or there is no
  ``prev``, or ``prev = cur``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import expr, sql_second_of_day, sql_share
from ..session import checkpointed

SEQ_ORDER = ("time", "src", "type_id")
OP_SRC = 0
TRANS_SRC = 1


def encoded_actions(op_encoded: DataFrame, trans_encoded: DataFrame) -> DataFrame:
    """Both logs as one bag ``(uid, day, time, src, type_id)``.

    A union then one grouping replaces the per-log grouping + full outer
    join: same rows, one shuffle.
    """
    ops = op_encoded.selectExpr("uid", "op_day AS day", "op_time AS time",
                                f"{OP_SRC} AS src", "type_id")
    trans = trans_encoded.selectExpr("uid", "trans_day AS day", "trans_time AS time",
                                     f"{TRANS_SRC} AS src", "type_id")
    return ops.unionByName(trans)


def keyed_actions(actions: DataFrame) -> DataFrame:
    """Count identical actions of a user-day into ``mult``."""
    return actions.groupBy("uid", "day", *SEQ_ORDER).agg(expr("count(1)", "mult"))


def sequence_keys(op_encoded: DataFrame, trans_encoded: DataFrame) -> DataFrame:
    """A17 for the slim logs: ``keyed_actions(encoded_actions(...))``.

    Two operations become one key when their day texts name the same day or
    their types have the same id, so both logs are counted.
    """
    return keyed_actions(encoded_actions(op_encoded, trans_encoded))


#: A user-day with more actions than this is cut into its hours.
HEAVY_ACTIONS = 4_000_000
HOUR = "substring(time, 1, 2)"
#: Most heavy days that are broadcast.
BROADCAST_DAYS = 100_000
HOUR_WINDOW = "PARTITION BY uid, day, _hour ORDER BY _rank, time, src, type_id"
DAY_HOURS = "PARTITION BY uid, day ORDER BY _hour"
UP_TO_HERE = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def heavy_days(op_base: DataFrame, trans_base: DataFrame, limit: int = HEAVY_ACTIONS,
               rows: int | None = None) -> DataFrame:
    """``uid, day`` of the user-days with more than ``limit`` actions.

    One count of the slim logs with a partial step, written once. ``rows`` is the
    length of both logs, where known: no day can have more, which may save the count.
    """
    actions = op_base.selectExpr("uid", "op_day AS day").unionByName(
        trans_base.selectExpr("uid", "trans_day AS day"))
    if rows is not None and rows <= limit:
        spark = actions.sparkSession
        return spark.createDataFrame(spark.sparkContext.emptyRDD(), actions.schema)
    return checkpointed(actions.groupBy("uid", "day").agg(expr("count(1)", "n"))
                        .filter(f"n > {int(limit)}").select("uid", "day"))


def _same_day(other: DataFrame) -> tuple[DataFrame, Column]:
    """``other`` under names of its own, and the condition that it names the same user-day."""
    moved = other.withColumnsRenamed({"uid": "_uid", "day": "_day"})
    return moved, F.col("uid").eqNullSafe(F.col("_uid")) & F.col("day").eqNullSafe(F.col("_day"))


def _edges(keyed: DataFrame) -> DataFrame:
    """Two rows per (user, day, hour) that hand a day over from one hour to the next.

    ``_rank`` 0 stands before the hour's actions (the id before them as ``type_id``, the
    number of actions before them as ``mult``), ``_rank`` 2 after them (the id that
    follows). ``time`` sorts by its first two characters first, NULL before all others.
    """
    ends = keyed.groupBy("uid", "day", "_hour").agg(
        expr("sum(mult)", "_actions"),
        expr("min(struct(time, src, type_id)).type_id", "_first"),
        expr("max(struct(time, src, type_id)).type_id", "_last"))
    hours = ends.selectExpr(
        "uid", "day", "_hour",
        f"sum(_actions) OVER ({DAY_HOURS} {UP_TO_HERE}) - _actions AS _before",
        f"lag(_last) OVER ({DAY_HOURS}) AS _last_before",
        f"lead(_first) OVER ({DAY_HOURS}) AS _first_after")
    return hours.selectExpr(
        "uid", "day", "_hour", "stack(2, 0, _last_before, _before, 2, _first_after, 0L)"
                               " AS (_rank, type_id, mult)").filter(
        "_rank = 0 OR type_id IS NOT NULL").selectExpr(
        "uid", "day", "_hour", "_rank", "CAST(NULL AS STRING) AS time", "CAST(NULL AS INT) AS src",
        "type_id", "mult")


def _in_order(keyed: DataFrame, heavy: DataFrame | None) -> DataFrame:
    """Actions (``_rank`` 1) in pieces ``uid, day, _hour`` that one window can order.

    ``_hour`` is NULL for a day that is not heavy: it is one piece. The hours of a heavy
    day also get the rows of ``_edges``, in the same shuffle as the actions. Without
    a list (``None``) every day is cut.
    """
    if heavy is None:
        cut = keyed.selectExpr("uid", "day", f"{HOUR} AS _hour", "1 AS _rank", *SEQ_ORDER, "mult")
        return cut.unionByName(_edges(cut))
    named, same = _same_day(heavy.selectExpr("*", "true AS _cut"))
    cut = (keyed.join(F.broadcast(named) if _is_small(heavy) else named, same, "left")
           .selectExpr("uid", "day", f"CASE WHEN _cut THEN {HOUR} END AS _hour", "1 AS _rank",
                       *SEQ_ORDER, "mult", "_cut"))
    return cut.drop("_cut").unionByName(_edges(cut.filter("_cut")))


def _is_small(heavy: DataFrame) -> bool:
    """A heavy day stands for millions of actions, so the list is short; its length is checked."""
    if heavy.rdd.getNumPartitions() == 0:
        return True
    return heavy.limit(BROADCAST_DAYS + 1).count() <= BROADCAST_DAYS


def daily_sequences(keyed: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """The ordered sequence as rows; ``pos`` = 1-based position of the
    first of the ``mult`` copies. ``uid, day, pos, time, src, type_id, mult``.

    A NULL uid, day or time is a key like any other; a NULL time comes first in its day.
    ``heavy`` (from ``heavy_days``) changes the plan, never the result.
    """
    return _in_order(keyed, heavy).selectExpr(
        "uid", "day", f"sum(mult) OVER ({HOUR_WINDOW} {UP_TO_HERE}) - mult + 1 AS pos",
        *SEQ_ORDER, "mult", "_rank").filter("_rank = 1").drop("_rank")


def token_occurrences(keyed: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """One row per emitted token, ``(uid, day, a1, a2)``; ``a2`` NULL for singles."""
    marked = _in_order(keyed, heavy).selectExpr(
        "uid", "day", "type_id", "mult", "_rank", f"lead(type_id) OVER ({HOUR_WINDOW}) AS _next",
        f"lag(type_id) OVER ({HOUR_WINDOW}) AS _prev")
    is_pair = "(_next IS NOT NULL AND _next <> type_id)"
    is_single = "(_next IS NULL AND (mult >= 2 OR _prev IS NULL OR _prev = type_id))"
    return (marked.filter(f"_rank = 1 AND ({is_pair} OR {is_single})")
            .selectExpr("uid", "day", "type_id AS a1", f"CASE WHEN {is_pair} THEN _next END AS a2"))


TOK = "concat_ws('-', a1, a2) AS tok"


def action_tokens(keyed: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """W6 per user-day: ``uid, day, tok, a1, a2, n`` (n = occurrences that day)."""
    return (token_occurrences(keyed, heavy).groupBy("uid", "day", "a1", "a2")
            .agg(expr("count(1)", "n"))
            .selectExpr("uid", "day", TOK, "a1", "a2", "n"))


def user_action_rank(keyed: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """``uid, tok, a1, a2, cnt`` -- token occurrences over all days of a user."""
    return (token_occurrences(keyed, heavy).groupBy("uid", "a1", "a2")
            .agg(expr("count(1)", "cnt"))
            .selectExpr("uid", TOK, "a1", "a2", "cnt"))


def restrict_to_label(df: DataFrame, labels: DataFrame, value: float) -> DataFrame:
    """P3 + J7/J8: keep rows of users whose label equals ``value`` (semi join)."""
    users = labels.filter(f"label = {float(value)}D").selectExpr("uid")
    return df.join(users, "uid", "left_semi")


def follow_rates(rank: DataFrame, k: int = 3) -> DataFrame:
    """W7 (A14, A15, P4, F7): for each leader, the top-``k`` followers by support.

    Support of a pair = number of users having it (not occurrences).
    ``share`` = support / total support of the leader over *all* its
    followers, cut to ``k`` afterwards; ties by follower id.
    Columns ``a1, a2, support, total, share, rn``.
    """
    pairs = (rank.filter("a2 IS NOT NULL")
             .groupBy("a1", "a2").agg(expr("count(1)", "support")))
    ranked = pairs.selectExpr(
        "a1", "a2", "support",
        "sum(support) OVER (PARTITION BY a1) AS total",
        "row_number() OVER (PARTITION BY a1 ORDER BY support DESC, a2) AS rn",
    ).filter(f"rn <= {int(k)}")
    return ranked.selectExpr("a1", "a2", "support", "total",
                             f"{sql_share('support', 'total')} AS share", "rn")


def follow_rates_text(rates: DataFrame) -> DataFrame:
    """``a1, related`` with ``related`` like ``[(d,0.43),(b,0.29)]``.

    Each leader gathers at most ``k`` rows (already cut), so the list is bounded.
    """
    items = F.array_sort(F.collect_list(F.struct("rn", "a2", "share")))
    text = F.transform(items, lambda x: F.concat(
        F.lit("("), x["a2"], F.lit(","), F.format_string("%.2f", x["share"]), F.lit(")")))
    return rates.groupBy("a1").agg(
        F.concat(F.lit("["), F.array_join(text, ","), F.lit("]")).alias("related"))


def long_days(keyed: DataFrame, threshold: int = 20, n_series: int | None = None,
              heavy: DataFrame | None = None) -> DataFrame:
    """Plotting data -- the user-days with more than ``threshold`` actions, as
    ``(second_of_day, action id)`` points.

    Days are counted first and only the long ones are put in order. ``n_series``
    keeps the first so many of them (by uid, day) for a plot; by default all are given.
    """
    long = (keyed.groupBy("uid", "day").agg(expr("sum(mult)", "n_actions"))
            .filter(f"n_actions > {int(threshold)}"))
    if n_series is not None:
        long = long.orderBy("uid", "day").limit(int(n_series))
    named, same = _same_day(long)
    points = daily_sequences(keyed, heavy).join(named, same)
    return points.select("uid", "day", "pos", "mult", "n_actions",
                         expr(sql_second_of_day("time"), "second"),
                         F.col("type_id").cast("double").alias("action"))
