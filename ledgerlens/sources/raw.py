"""Raw log sources.

The raw logs are CSV files with a header where every column is text.
They are read with an explicit all-string schema (no inference pass over
the data) and NULLs become empty strings, which later count as a real
value (an empty operation type gets its own id).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import strict_number
from ..session import materialized

# Column names of the raw logs, in file order. They must
# match the input files.
OPERATION_COLUMNS = [
    "uid", "day", "mode", "success", "time", "os", "version", "device1",
    "device2", "device_code1", "device_code2", "device_code3", "mac1", "mac2",
    "ip1", "ip2", "wifi", "geo_code", "ip1_sub", "ip2_sub",
]
TRANSACTION_COLUMNS = [
    "uid", "channel", "day", "time", "trans_amt", "amt_src1", "merchant",
    "code1", "code2", "trans_type1", "acc_id1", "device_code1", "device_code2",
    "device_code3", "device1", "device2", "mac1", "ip1", "bal", "amt_src2",
    "acc_id2", "acc_id3", "geo_code", "trans_type2", "market_code",
    "market_type", "ip1_sub",
]
LABEL_COLUMNS = ["uid", "tag"]


def string_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def read_raw_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """S1 + S2: header CSV, all columns string, NULL -> ``""``.

    Permissive parsing, as the default CSV reader: a short row gets NULLs
    for its missing fields, which then become ``""`` like any other NULL.
    """
    df = (
        spark.read.option("header", "true")
        .option("mode", "PERMISSIVE")
        .schema(string_schema(columns))
        .csv(path)
    )
    return df.na.fill("")


#: Text of a line that does not have the columns of its file.
BAD_LINE = "_bad_line"


def read_checked_csv(spark: SparkSession, path: str, columns: list[str],
                     header: bool = True) -> tuple[DataFrame, DataFrame]:
    """S1 + S2 with malformed lines set aside: ``(rows, quarantine)``.

    A line with more or fewer fields than ``columns`` is not padded or cut: it goes whole
    into ``quarantine`` (``line, file``), a table written here, the other lines into ``rows``.
    Every line is in one of the two. All fields are parsed whatever a query selects,
    so a line is judged alike in every query.
    """
    schema = string_schema([*columns, BAD_LINE])
    df = (spark.read.option("header", str(header).lower()).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", BAD_LINE).option("columnPruning", "false")
          .schema(schema).csv(path))
    # Spark refuses to read the bad-line column alone, so the filter reads a field as well
    good = F.col(BAD_LINE).isNull() & (F.length(F.coalesce(columns[0], F.lit(""))) >= 0)
    rows = df.filter(good).select(*columns).na.fill("")
    bad = materialized(df.select("*", F.col("_metadata.file_path").alias("file")).filter(
        F.col(BAD_LINE).isNotNull()), "quarantine")
    return rows, bad.select(F.col(BAD_LINE).alias("line"), "file")


def read_raw_operations(spark: SparkSession, path: str) -> DataFrame:
    return read_raw_csv(spark, path, OPERATION_COLUMNS)


def read_raw_transactions(spark: SparkSession, path: str) -> DataFrame:
    return read_raw_csv(spark, path, TRANSACTION_COLUMNS)


def read_raw_labels(spark: SparkSession, path: str | None) -> DataFrame | None:
    """``uid, tag``; ``None`` when the label file is absent (S13 handles it)."""
    if path is None:
        return None
    try:
        return read_raw_csv(spark, path, LABEL_COLUMNS)
    except AnalysisException as err:  # the path is resolved eagerly on load
        if "PATH_NOT_FOUND" in str(err) or "Path does not exist" in str(err):
            return None
        raise


def labels_from_tags(tags: DataFrame, uid: str = "uid", tag: str = "tag") -> DataFrame:
    """``(uid, label double)``; text like ``0.0`` reads as 0, other text than numbers fails."""
    return tags.select(F.col(uid).cast("string").alias("uid"), strict_number(tag).alias("label"))
