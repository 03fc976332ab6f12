"""Column expressions shared by the operators (inventory F1-F13).

The ``sql_*`` builders return Spark SQL expression text over column
names; the operators compose them and hand each finished expression to
``F.expr`` once. The result is the same Catalyst expression as the
equivalent ``Column`` calls, built with one round trip to the JVM
instead of one per sub-expression, which keeps plan construction cheap
for queries with dozens of aggregates. Everything stays a built-in
expression, inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def expr(text: str, name: str | None = None) -> Column:
    """One Column from SQL expression text, aliased when ``name`` is given."""
    return F.expr(f"{text} AS `{name}`" if name else text)


# ---- SQL text builders --------------------------------------------------
def sql_hms(ts: str) -> str:
    """``HH:mm:ss`` of a timestamp from hour/minute/second.

    No ``date_format`` (session time zone) and no ``format_string`` (a
    formatter per row).
    """
    def two(unit: str) -> str:
        return f"lpad(CAST({unit}({ts}) AS STRING), 2, '0')"
    return f"concat({two('hour')}, ':', {two('minute')}, ':', {two('second')})"


def sql_hour_of(time_str: str) -> str:
    """hour from an ``HH:mm:ss`` string (first two characters, trimmed); blank has none."""
    return f"CAST(nullif(substring(trim({time_str}), 1, 2), '') AS INT)"


def sql_second_of_day(t: str) -> str:
    """``hour*3600 + minute*60 + second`` of an ``HH:mm:ss`` string, as double; blank: NULL."""
    return (f"CAST(nullif(substring({t}, 1, 2), '') AS DOUBLE) * 3600.0D"
            f" + CAST(nullif(substring({t}, 4, 2), '') AS DOUBLE) * 60.0D"
            f" + CAST(nullif(substring({t}, 7, 2), '') AS DOUBLE)")


def sql_pct(part: str, total: str) -> str:
    """``part*100/total`` rounded half-up to two decimals, as double."""
    return f"round(CAST({part} AS DOUBLE) * 100.0D / CAST({total} AS DOUBLE), 2)"


def sql_share(part: str, total: str) -> str:
    """``part/total`` rounded half-up to two decimals, as double."""
    return f"round(CAST({part} AS DOUBLE) / CAST({total} AS DOUBLE), 2)"


def sql_in_range(v: str, low: float | None, high: float | None,
                 low_inclusive: bool = False, high_inclusive: bool = False) -> str:
    """the value lies between the bounds (open unless flagged; ``None`` = unbounded)."""
    conds = []
    if low is not None:
        conds.append(f"{v} {'>=' if low_inclusive else '>'} {low}")
    if high is not None:
        conds.append(f"{v} {'<=' if high_inclusive else '<'} {high}")
    return "(" + " AND ".join(conds) + ")" if conds else "true"


def sql_user(uid: str = "uid") -> str:
    """A row without a user belongs to the user ``""``, as the load step writes it."""
    return f"coalesce(CAST({uid} AS STRING), '') AS uid"


def sql_span(v: str) -> str:
    """inclusive spread ``max - min + 1`` (aggregate)."""
    return f"CAST(max({v}) - min({v}) + 1 AS INT)"


# ---- Column helpers -----------------------------------------------------
def type_id(prefix: str, index: Column) -> Column:
    """F8: prefix + index with at least two digits (``7`` -> ``07``, ``100`` stays ``100``)."""
    return F.concat(F.lit(prefix), F.format_string("%02d", index.cast("long")))


def delimited(cols: Sequence[str | Column], sep: str = "|") -> Column:
    """Tuple to delimited line; NULL prints as an empty field."""
    return F.concat_ws(sep, *[F.coalesce(col(c).cast("string"), F.lit("")) for c in cols])


def strict_number(c: str | Column, kind: str = "double", blank: object = None) -> Column:
    """Text to a number; anything that is none raises an error, with ANSI on or off.

    ``blank`` is the value of blank and NULL text (``None``: an error too).
    """
    text = F.trim(col(c).cast("string"))
    number = F.coalesce(text.try_cast(kind), F.raise_error(
        F.concat(F.lit("not a number: "), F.coalesce(text, F.lit("NULL")))).cast(kind))
    if blank is None:
        return number
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(blank).cast(kind)).otherwise(number)


def number_or_zero(c: str | Column) -> Column:
    """Feature text to double; blank becomes 0.0, other text must be a number."""
    return strict_number(c, "double", 0.0)
