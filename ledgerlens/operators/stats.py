"""Amount, day and hour statistics.

Every statistic is a grouped aggregate with a map-side partial step, so a
user holding a large share of the rows is reduced in every map task
before anything is shuffled. Bucket edges are kept exactly as the
original rules state them (K2): amounts of exactly 1000 or 10000 and
hour 0 fall in no bucket, and rates need not sum to 100.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exact import sql_decimal_double, sql_product, sql_strict, sql_units, sql_wide
from ..functions.expressions import expr, sql_hour_of, sql_in_range, sql_pct, sql_span


@dataclass(frozen=True)
class Bucket:
    name: str
    low: float | None
    high: float | None
    low_inclusive: bool = False
    high_inclusive: bool = False

    def holds(self, value: str) -> str:
        """SQL condition: ``value`` lies in this bucket."""
        return sql_in_range(value, self.low, self.high, self.low_inclusive, self.high_inclusive)


# Bucket edges of the original features.
AMOUNT_BUCKETS = [
    Bucket("hundred_rate", None, 100, high_inclusive=True),   # amt <= 100
    Bucket("thousand_rate", 100, 1000),                        # 100 < amt < 1000
    Bucket("ten_thousand_rate", 1000, 10000),                  # 1000 < amt < 10000
    Bucket("hundred_thousand_rate", 10000, None),              # amt > 10000
]
USER_AMOUNT_BUCKETS = AMOUNT_BUCKETS[1:]  # the per-user table has no <=100 column
DAY_BUCKETS = [
    Bucket("early_rate", None, 10, high_inclusive=True),      # day <= 10
    Bucket("middle_rate", 10, 20, high_inclusive=True),       # 10 < day <= 20
    Bucket("end_rate", 20, None),                             # day > 20
]
HOUR_BUCKETS = [
    Bucket("night_rate", 0, 8, high_inclusive=True),          # 0 < h <= 8
    Bucket("morning_rate", 8, 12, high_inclusive=True),       # 8 < h <= 12
    Bucket("noon_rate", 12, 14, high_inclusive=True),         # 12 < h <= 14
    Bucket("afternoon_rate", 14, 18, high_inclusive=True),    # 14 < h <= 18
    Bucket("evening_rate", 18, 24, high_inclusive=True),      # 18 < h <= 24
]


def rate_aggs(value: str, buckets: Sequence[Bucket], prefix: str = "",
              weight: str | None = None) -> list[Column]:
    """Percent of rows (or of ``weight``) in each bucket, two decimals, half-up.

    ``value`` and ``weight`` are column names or SQL expression text.
    """
    if weight is None:
        return [expr(sql_pct(f"count_if({b.holds(value)})", "count(1)"), prefix + b.name)
                for b in buckets]
    return [expr(sql_pct(f"sum(CASE WHEN {b.holds(value)} THEN {weight} ELSE 0 END)",
                         f"sum({weight})"), prefix + b.name)
            for b in buckets]


def day_aggs(day: str, prefix: str = "") -> list[Column]:
    """A6 aggregates: day span and the three day-of-month percents."""
    return [expr(sql_span(day), prefix + "days_span"), *rate_aggs(day, DAY_BUCKETS, prefix)]


def hour_aggs(time: str, prefix: str = "") -> list[Column]:
    """A8 aggregates: hour span and the five day-part percents (hour 0 in none)."""
    h = sql_hour_of(time)
    return [expr(sql_span(h), prefix + "hour_span"), *rate_aggs(h, HOUR_BUCKETS, prefix)]


def bucket_rates(df: DataFrame, keys: Sequence[str], value: str,
                 buckets: Sequence[Bucket], extra: Sequence[Column] = ()) -> DataFrame:
    """Per group: percent of rows in each bucket, two decimals, half-up.

    ``keys`` may be empty for one whole-table row (A4); the ungrouped
    aggregate still combines per-partition partials.
    """
    aggs = list(extra) + rate_aggs(value, buckets)
    grouped = df.groupBy(*keys) if keys else df
    return grouped.agg(*aggs)


# Units (10^-scale of the currency) in a piece of a user's amounts.
PIECE_UNITS = 1_000_000
MISSING_AMOUNT = "amount is missing or not a number"


def sql_amount(amount: str) -> str:
    """The amount, or an error where it is NULL or NaN."""
    return sql_strict(f"CASE WHEN NOT isnan(CAST(`{amount}` AS DOUBLE)) THEN `{amount}` END",
                      MISSING_AMOUNT)


def amount_stats(trans: DataFrame, key: str = "uid", amount: str = "trans_amt",
                 exact_scale: int = 2, with_ranges: bool = False,
                 piece_units: int = PIECE_UNITS) -> DataFrame:
    """A1-A3: per user min, max, exact median, mean and population variance.

    Plan: each user's amounts are cut into pieces of ``piece_units``. One
    grouping by (user, piece), with a partial step in every map task, gives
    counts, extremes and exact sums; a window over those few rows names the
    one or two pieces that hold the middle ranks. Only the amounts of those
    pieces are counted and ranked, at most ``piece_units`` distinct ones in
    a window group, however many rows the user has.

    ``exact_scale`` = number of decimals of the amounts, up to 6. An amount
    that is NULL or NaN, has more decimals or is beyond 9.2e18 units raises an error,
    as do sums beyond decimal(38); nothing is rounded or dropped. Rows without a
    key are one group like any other (of the blank text, where the key is text).

    ``with_ranges`` adds the A5 columns (``amt_count`` and the per-user
    bucket percents) from the same pass.
    """
    if not 0 <= exact_scale <= 6:
        raise ValueError(f"exact_scale={exact_scale}")
    w = int(piece_units)
    is_text = dict(trans.dtypes)[key] == "string"
    whose = f"coalesce(`{key}`, '') AS `{key}`" if is_text else f"`{key}`"
    rows = trans.selectExpr(whose, f"`{amount}` AS _a",
                            f"{sql_units(f'`{amount}`', exact_scale)} AS _u")
    rows = rows.selectExpr("*", f"pmod(_u, {w}L) AS _o")
    rows = rows.selectExpr("*", f"CAST((_u - _o) DIV {w} AS BIGINT) AS _piece")
    counts = [expr(f"count_if({b.holds('_a')})", f"_{b.name}")
              for b in USER_AMOUNT_BUCKETS] if with_ranges else []
    pieces = rows.groupBy(key, "_piece").agg(
        expr("count(1)", "_n"), expr("min(_a)", "_min"), expr("max(_a)", "_max"),
        expr("sum(CAST(_o AS DECIMAL(20,0)))", "_s"),
        expr("sum(CAST(_o AS DECIMAL(20,0)) * CAST(_o AS DECIMAL(18,0)))", "_q"), *counts)
    whole, upto = f"PARTITION BY `{key}`", f"PARTITION BY `{key}` ORDER BY _piece"
    pieces = pieces.selectExpr(
        "*", f"sum(_n) OVER ({whole}) AS _total", f"min(_piece) OVER ({whole}) AS _first",
        f"sum(_n) OVER ({upto} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - _n AS _before")
    # Amounts relative to the user's first piece: d = (piece - first) * width + offset.
    shift = f"{sql_wide('_piece')} - {sql_wide('_first')}"
    moved = pieces.selectExpr("*", f"{sql_product(shift, str(w))} AS _d").selectExpr(
        "*", f"{sql_wide('_s')} + {sql_product('_n', '_d')} AS _ds",
        f"{sql_wide('_q')} + {sql_product('2', '_d', '_s')} + {sql_product('_n', '_d', '_d')}"
        " AS _dq")
    strict_sum = "amounts are too large for exact sums"
    per_user = moved.groupBy(key).agg(
        expr("min(_min)", "min_amt"), expr("max(_max)", "max_amt"), expr("sum(_n)", "amt_count"),
        expr("min(_first)", "_first"), expr(sql_strict("try_sum(_ds)", strict_sum), "_ds"),
        expr(sql_strict("try_sum(_dq)", strict_sum), "_dq"),
        *[expr(sql_pct(f"sum(`_{b.name}`)", "sum(_n)"), b.name)
          for b in (USER_AMOUNT_BUCKETS if with_ranges else ())])
    spread = (f"try_subtract({sql_product('amt_count', '_dq')}, {sql_product('_ds', '_ds')})")
    total = f"{sql_product('amt_count', '_first', str(w))} + {sql_wide('_ds')}"
    stats = per_user.selectExpr(
        f"`{key}`", "min_amt", "max_amt",
        f"{sql_decimal_double(total, exact_scale)} / CAST(amt_count AS DOUBLE) AS avg_amt",
        f"{sql_decimal_double(sql_strict(spread, strict_sum), 2 * exact_scale)}"
        " / (CAST(amt_count AS DOUBLE) * CAST(amt_count AS DOUBLE)) AS var_amt",
        *(["amt_count", *[b.name for b in USER_AMOUNT_BUCKETS]] if with_ranges else []))
    medians = _medians(rows, pieces, key)
    out = _by_key(stats, medians, [key])
    lead = [key, "min_amt", "max_amt", "mid_amt"]
    return out.select(*lead, *[c for c in out.columns if c not in lead])


def _by_key(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys``; those that are no text are compared NULL-safe."""
    if dict(left.dtypes)[keys[0]] == "string":
        return left.join(right, keys)
    other = right.selectExpr(f"`{keys[0]}` AS _key", *[c for c in right.columns if c != keys[0]])
    same = F.col(keys[0]).eqNullSafe(F.col("_key"))
    if len(keys) == 1:
        return left.join(other, same).drop("_key")
    moved = other.withColumnsRenamed({k: f"_other_{k}" for k in keys[1:]})
    for k in keys[1:]:
        same = same & (F.col(k) == F.col(f"_other_{k}"))
    return left.join(moved, same).drop("_key", *[f"_other_{k}" for k in keys[1:]])


def _medians(rows: DataFrame, pieces: DataFrame, key: str) -> DataFrame:
    """``mid_amt`` per user, from the amounts of the pieces that hold the middle ranks."""
    lo, hi = "(_total - 1) DIV 2", "_total DIV 2"   # 0-based middle ranks, equal when n is odd
    chosen = pieces.selectExpr(f"`{key}`", "_piece", "_before", "_n", f"{lo} AS _lo",
                               f"{hi} AS _hi").filter(
        "(_lo >= _before AND _lo < _before + _n) OR (_hi >= _before AND _hi < _before + _n)")
    counted = (_by_key(rows, chosen.select(key, "_piece", "_before", "_lo", "_hi"),
                       [key, "_piece"])
               .groupBy(key, "_piece", "_before", "_lo", "_hi", "_a").agg(expr("count(1)", "_m")))
    ranked = counted.selectExpr(
        "*", f"_before + sum(_m) OVER (PARTITION BY `{key}`, _piece ORDER BY _a"
             " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _cum")

    def at(rank: str) -> str:
        # the amount whose copies cover 0-based rank `rank`: first copy at _cum - _m
        return f"max(CASE WHEN _cum - _m <= {rank} AND {rank} < _cum THEN _a END)"

    return ranked.groupBy(key).agg(expr(f"({at('_lo')} + {at('_hi')}) / 2.0D", "mid_amt"))


def amount_range(trans: DataFrame, amount: str = "trans_amt") -> DataFrame:
    """A4: one row -- count, min, max and the four amount-bucket percents.

    A NULL or NaN amount raises an error, as in ``amount_stats``.
    """
    return bucket_rates(trans, [], amount, AMOUNT_BUCKETS, extra=[
        expr(f"count({sql_amount(amount)})", "amt_count"),
        F.min(amount).alias("amt_min"),
        F.max(amount).alias("amt_max"),
    ])


def user_amount_range(trans: DataFrame, key: str = "uid",
                      amount: str = "trans_amt") -> DataFrame:
    """A5: per user -- count and percents of (100,1000), (1000,10000), >10000.

    A NULL or NaN amount raises an error, as in ``amount_stats``.
    """
    return bucket_rates(trans, [key], amount, USER_AMOUNT_BUCKETS,
                        extra=[expr(f"count({sql_amount(amount)})",
                                    "amt_count")])


def days_range(log: DataFrame, day: str, key: str = "uid", prefix: str = "") -> DataFrame:
    """Per user -- day span (max-min+1) and percents of days <=10, 11-20, >20."""
    return log.groupBy(key).agg(*day_aggs(day, prefix))


def hours_range(log: DataFrame, time: str, key: str = "uid", prefix: str = "") -> DataFrame:
    """Per user -- hour span and percents of five day parts (hour 0 in none)."""
    return log.groupBy(key).agg(*hour_aggs(time, prefix))


def value_counts(log: DataFrame, column: str, name: str = "type") -> DataFrame:
    """Rows per value, as ``(type, cnt)``."""
    return log.groupBy(F.col(column).alias(name)).agg(F.count(F.lit(1)).alias("cnt"))
