"""Order-dependent numbering without gathering all rows into one task.

``global_position``: 1-based position of every row in a total order.
``before_each``: running sums and extremes of the rows before each row of its key.

``row_number()`` over a window without ``partitionBy`` moves every row into
one task. This version keeps the work spread out:

1. range-partition on the order and sort inside each partition;
2. tag each row with its partition id and its index inside the partition
   (``monotonically_increasing_id`` holds both), and checkpoint, so the
   rows and their tags are fixed once;
3. count rows per partition -- one row per partition, a bound set by the
   partition count and not by the data -- and turn the counts into
   running offsets;
4. position = offset of the partition + index inside it + 1.

The order must be total (no ties), otherwise positions of tied rows are
arbitrary; callers pass a unique tie-breaker last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed

_LOCAL_BITS = 33  # monotonically_increasing_id = partition << 33 | index


def global_position(df: DataFrame, order: list[Column], name: str = "pos") -> DataFrame:
    tagged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_local", F.monotonically_increasing_id()
                    .bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
    )
    tagged = checkpointed(tagged)
    sizes = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select(
        "_part",
        (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_offset"),
    )
    return (
        tagged.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_local") + F.lit(1))
        .drop("_part", "_local", "_offset")
    )


def before_each(df: DataFrame, keys: list[str], order: list[str],
                values: dict[str, str]) -> DataFrame:
    """Running aggregates over the rows before each row of its key, without a hot task.

    ``values`` maps a new column to an aggregate in SQL (``sum``, ``min`` or ``max`` of an
    expression); it is NULL in the first row of a key. Rows are sorted once over range
    partitions, so a key may hold any share of them. A window runs inside each
    (partition, key); what a key has gathered in earlier partitions comes from a table with
    at most one row per partition. NULL is a key like any other. The order must be total
    within a key.
    """
    order_cols = [F.col(c) for c in (*keys, *order)]
    tagged = checkpointed(df.repartitionByRange(*order_cols)
                          .withColumn("_part", F.spark_partition_id()))
    sort, group = ", ".join(order), ", ".join(["_part", *keys])
    local = tagged.selectExpr("*", *[
        f"{agg} OVER (PARTITION BY {group} ORDER BY {sort}"
        f" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS `{name}`"
        for name, agg in values.items()])
    whole = tagged.groupBy("_part", *keys).agg(
        *[F.expr(f"{agg} AS `{name}`") for name, agg in values.items()])
    past = f"(PARTITION BY {', '.join(keys)} ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING" \
           " AND 1 PRECEDING)"
    carried = whole.selectExpr(
        "_part AS _p", *[f"{k} AS `_k_{k}`" for k in keys], f"count(1) OVER {past} AS _earlier",
        *[f"{agg.split('(')[0]}(`{name}`) OVER {past} AS `_c_{name}`"
          for name, agg in values.items()]).filter("_earlier > 0")
    same = F.col("_part") == F.col("_p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = local.join(F.broadcast(carried), same, "left")
    merge = {"sum": "CASE WHEN `_c_{n}` IS NULL THEN `{n}` ELSE `_c_{n}` + coalesce(`{n}`, 0) END",
             "min": "least(`_c_{n}`, `{n}`)", "max": "greatest(`_c_{n}`, `{n}`)"}
    return joined.selectExpr(*df.columns, *[
        f"{merge[agg.split('(')[0].strip().lower()].format(n=name)} AS `{name}`"
        for name, agg in values.items()])
