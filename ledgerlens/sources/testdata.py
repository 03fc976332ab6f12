"""Adapter from the benchmark tables to the raw-log shapes.

The benchmark tables are not user logs, so they are mapped:

* operations   = ``events`` rows whose type is not ``purchase``;
* transactions = ``events`` rows of type ``purchase`` (and, for the
  amount operators, ``orders`` and ``lineitem``, whose amounts reach the
  upper buckets);
* labels       = ``customer``: tag 1 when the account balance is negative.

Each adapter returns the raw column names the preprocessing expects
(day and amount keep their numeric types; the preprocessing casts are
no-ops on them). Only the needed columns are selected, which keeps the
Parquet scans pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from ..functions.expressions import sql_hms
from .raw import OPERATION_COLUMNS

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def operations_from_events(events: DataFrame) -> DataFrame:
    """Raw operation columns ``uid, day, mode, time``; a NULL type becomes ``""``."""
    # written as IS NULL OR <> so that Parquet can skip row groups with it
    return events.filter("event_type IS NULL OR event_type <> 'purchase'").selectExpr(
        "CAST(user_id AS STRING) AS uid",
        "dayofmonth(ts) AS day",
        "coalesce(event_type, '') AS mode",
        f"{sql_hms('ts')} AS time",
    )


#: Users whose operations also come as malformed lines in ``csv_from_operations``.
BAD_EVERY = 97


def csv_from_operations(spark: SparkSession, ops: DataFrame, folder: str) -> tuple[str, str]:
    """Raw operation files: a CSV with header of all columns, and one without, of bad lines.

    Users divisible by ``BAD_EVERY`` get a line that is too short for each operation.
    Returns both folders.
    """
    known = set(ops.columns)
    ops.selectExpr(*[c if c in known else f"CAST(NULL AS STRING) AS {c}"
                     for c in OPERATION_COLUMNS]).write.option("header", "true").csv(
        f"{folder}/good")
    ops.filter(f"try_cast(uid AS BIGINT) % {BAD_EVERY} = 0").selectExpr(
        "concat_ws(',', uid, day, mode) AS value").write.text(f"{folder}/bad")
    return f"{folder}/good", f"{folder}/bad"


def transactions_from_events(events: DataFrame) -> DataFrame:
    """Raw transaction columns; channel and both types derive from ``props.k``."""
    k = "CAST(get_json_object(props, '$.k') AS INT)"
    return events.filter("event_type = 'purchase'").selectExpr(
        "CAST(user_id AS STRING) AS uid",
        f"concat('c', CAST({k} % 3 AS STRING)) AS channel",
        "dayofmonth(ts) AS day",
        f"{sql_hms('ts')} AS time",
        "value AS trans_amt",
        f"concat('t', CAST({k} % 8 AS STRING)) AS trans_type1",
        f"concat('u', CAST({k} % 5 AS STRING)) AS trans_type2",
    )


def transactions_from_orders(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "CAST(o_custkey AS STRING) AS uid",
        "o_orderstatus AS channel",
        "dayofmonth(o_orderdate) AS day",
        f"{sql_hms('o_orderdate')} AS time",
        "o_totalprice AS trans_amt",
        "o_orderpriority AS trans_type1",
        "'' AS trans_type2",
    )


def transactions_from_lineitem(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "CAST(l_suppkey AS STRING) AS uid",
        "l_linestatus AS channel",
        "dayofmonth(l_shipdate) AS day",
        f"{sql_hms('l_shipdate')} AS time",
        "l_extendedprice AS trans_amt",
        "l_returnflag AS trans_type1",
        "l_linestatus AS trans_type2",
    )


def transactions_net(lineitem: DataFrame) -> DataFrame:
    """Discounted prices per supplier: amounts with four decimals."""
    net = ("CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"
           " AS DECIMAL(18,4))")
    return lineitem.selectExpr("CAST(l_suppkey AS STRING) AS uid",
                               f"CAST({net} AS DOUBLE) AS trans_amt")


def tags_from_customer(customer: DataFrame) -> DataFrame:
    """Raw label columns ``uid, tag`` as text, like the label CSV."""
    return customer.selectExpr(
        "CAST(c_custkey AS STRING) AS uid",
        "CASE WHEN c_acctbal < 0 THEN '1' ELSE '0' END AS tag",
    )
