"""Type dictionaries and per-user top types.

A dictionary maps each type string to an id: the prefix (``0`` for
operations, ``1`` for transactions) and the 1-based rank by count,
descending, ties broken by the type text (D3). The dictionary is a fitted
artefact: fit it once on training logs, store it, and apply the stored one
when scoring (D4), so ids cannot shift between the two.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expressions import expr, type_id
from ..functions.ranking import global_position
from ..session import checkpointed
from ..sources.tables import read_table, write_table
from .stats import value_counts

# Id prefixes of the two dictionaries.
OP_PREFIX = "0"
TRANS_PREFIX = "1"

# Largest dictionary joined by broadcast, in bytes; a bigger one takes a shuffle
# join, where AQE can split a hot type.
BROADCAST_MAX_BYTES = 16 << 20
# Bytes of a dictionary row beside its type text, generously.
ROW_BYTES = 64
_SIZE = f"coalesce(sum(octet_length(type) + {ROW_BYTES}), 0)"


@dataclass(frozen=True)
class TypeIndex:
    """A fitted dictionary ``(type, type_id, cnt)`` and its size in bytes."""

    table: DataFrame
    size: int

    def save(self, path: str) -> None:
        write_table(self.table, path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TypeIndex":
        table = read_table(spark, path)
        return TypeIndex(table, int(table.agg(F.expr(_SIZE)).first()[0]))


def type_counts(log: DataFrame, column: str) -> DataFrame:
    """``(type, cnt)``."""
    return value_counts(log, column, "type")


def fit_type_index(log: DataFrame, column: str, prefix: str) -> TypeIndex:
    """``(type, type_id, cnt)``; rank by count desc, then type.

    The log is aggregated once and the counted table (one row per type) is
    materialised in the checkpoint folder; ranking and every later use read
    that. Its size is observed while it is written (no extra job). It is
    ranked over range partitions, whatever its size.
    """
    observed = Observation(f"type_index_{column}")
    counts = checkpointed(type_counts(log, column).observe(observed, F.expr(f"{_SIZE} AS n")))
    size = int(observed.get["n"] or 0)
    ranked = global_position(counts, [F.desc("cnt"), F.asc("type")], "rank")
    table = ranked.select("type", type_id(prefix, F.col("rank")).alias("type_id"), "cnt")
    return TypeIndex(table, size)


def encode(log: DataFrame, index: TypeIndex, column: str, out: str = "type_id",
           unknown: str = "drop") -> DataFrame:
    """Replace a type string by its id.

    ``unknown``: ``"drop"`` rows whose type has no id (inner join, J1/J2),
    ``"error"`` fails the job (the lookup of J3), ``"zero"`` maps to ``"0"``.
    The dictionary is broadcast only when its known size allows it.
    """
    if unknown not in ("drop", "error", "zero"):
        raise ValueError(f"unknown={unknown!r}")
    lookup = index.table.select(F.col("type").alias(column), F.col("type_id").alias(out))
    if index.size <= BROADCAST_MAX_BYTES:
        lookup = F.broadcast(lookup)
    cols = [*log.columns, out]
    if unknown == "drop":
        return log.join(lookup, column, "inner").select(*cols)
    joined = log.join(lookup, column, "left")
    if unknown == "zero":
        return joined.withColumn(out, F.coalesce(F.col(out), F.lit("0"))).select(*cols)
    return joined.withColumn(out, F.when(
        F.col(out).isNull(),
        F.raise_error(F.concat(F.lit("type without id: "), F.col(column)))
    ).otherwise(F.col(out))).select(*cols)


def user_type_counts(encoded: DataFrame, type_col: str = "type_id") -> DataFrame:
    """``(uid, type_id, cnt)``."""
    return encoded.groupBy("uid", type_col).agg(F.count(F.lit(1)).alias("cnt"))


def top_types(encoded: DataFrame, k: int = 3, prefix: str = "", type_col: str = "type_id"
              ) -> DataFrame:
    """A user's ``k`` most frequent type ids, ties by id, missing -> ``"0"``.

    The window per user sees one row per (user, type) -- at most the
    dictionary size -- because the counting aggregate runs first.
    """
    counted = user_type_counts(encoded, type_col)
    w = Window.partitionBy("uid").orderBy(F.desc("cnt"), F.asc(type_col))
    ranked = counted.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k)
    return ranked.groupBy("uid").agg(*[
        expr(f"coalesce(max(CASE WHEN _rn = {i} THEN `{type_col}` END), '0')", f"{prefix}top{i}")
        for i in range(1, k + 1)
    ])
