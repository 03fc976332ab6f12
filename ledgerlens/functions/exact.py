"""Exact sums, mean and population variance of fixed-point amounts.

Double ``avg``/``var_pop`` change in the last bits with the partitioning. An
amount with ``scale`` decimals is a whole number of units of 10^-scale; whole
numbers are added exactly and in any order, and only the final division is in
double. Nothing is rounded on the way: an amount that is missing or has more
decimals, and a sum that leaves decimal(38), raise an error whatever the
session's ANSI setting. All builders return SQL expression text.
"""

from __future__ import annotations


def sql_strict(expression: str, message: str) -> str:
    """``expression``, or an error where it is NULL."""
    return f"coalesce({expression}, raise_error('{message}'))"


def sql_units(value: str, scale: int) -> str:
    """``value`` as a whole number of units, exactly."""
    exact = f"try_cast({value} AS DECIMAL(38,{scale}))"
    units = f"try_cast({exact} * {10 ** scale}BD AS BIGINT)"
    kept = f"CASE WHEN CAST({exact} AS DOUBLE) = {value} THEN {units} END"
    return sql_strict(kept, f"amount is missing, too large or has more than {scale} decimals")


def sql_decimal_double(units: str, scale: int) -> str:
    """A whole number of units of 10^-scale as the nearest double."""
    return f"CAST(concat(CAST({units} AS STRING), 'E-{scale}') AS DOUBLE)"


def sql_wide(value: str) -> str:
    return f"CAST({value} AS DECIMAL(38,0))"


def sql_product(*factors: str) -> str:
    """Product of whole numbers in decimal(38), or an error."""
    out = sql_wide(factors[0])
    for f in factors[1:]:
        out = f"try_cast(try_multiply({out}, {sql_wide(f)}) AS DECIMAL(38,0))"
    return sql_strict(out, "amounts are too large for exact sums")
