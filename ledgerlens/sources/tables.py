"""Table reads and sinks.

Parquet is the format between stages: typed, columnar, and a ``|`` inside
a value cannot break a row (D5). The delimited text forms exist for
users who need the old line layout.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import delimited, strict_number

OP_BASE_SCHEMA = T.StructType([
    T.StructField("uid", T.StringType()),
    T.StructField("op_day", T.IntegerType()),
    T.StructField("op_type", T.StringType()),
    T.StructField("op_time", T.StringType()),
])
TRANS_BASE_SCHEMA = T.StructType([
    T.StructField("uid", T.StringType()),
    T.StructField("trans_channel", T.StringType()),
    T.StructField("trans_day", T.IntegerType()),
    T.StructField("trans_amt", T.DoubleType()),
    T.StructField("trans_time", T.StringType()),
    T.StructField("trans_type1", T.StringType()),
    T.StructField("trans_type2", T.StringType()),
])


# The order each stage table had in the original text output
# ("-" = descending). Only applied when a caller asks for ordered files (a
# global sort is a range shuffle); ties end in a key so the order is total.
SINK_ORDER: dict[str, list[str]] = {
    "user_amount": ["-amt_count", "uid"],                 # O1
    "op_type_count": ["-cnt", "type"],                    # O2
    "trans_type_count": ["-cnt", "type"],                 # O2
    "user_actions": ["uid", "day", "pos"],                # O3
    "user_action_rank": ["uid", "-cnt", "tok"],           # O4
    "related_action_feature": ["uid"],                    # O5
    "related_action": ["a1", "rn"],                       # O5
    "risky_related_action": ["a1", "rn"],                 # O5
    "no_risky_related_action": ["a1", "rn"],              # O5
}


def sink_order(name: str) -> list[Column]:
    return [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in SINK_ORDER.get(name, [])]


def sorted_for_sink(df: DataFrame, name: str) -> DataFrame:
    """``df`` in the original output order of table ``name`` (unchanged if none)."""
    order = sink_order(name)
    return df.orderBy(*order) if order else df


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path.rstrip("/"))
    return hadoop, p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def finish_swap(spark: SparkSession, path: str) -> None:
    """Carry out the swap that the note ``<path>.swap`` asks for, if there is one.

    The note names the folder with the new output and the one that takes the old. Every
    step may have been done before: a swap that was cut off is ended by the next
    reader or writer.
    """
    hadoop, folder, fs = _fs(spark, path)
    note = hadoop.Path(folder.toString() + ".swap")
    if not fs.exists(note):
        return
    stream = fs.open(note)
    try:
        fresh, old = (hadoop.Path(p) for p in spark._jvm.org.apache.commons.io.IOUtils.toString(
            stream, "UTF-8").split("\n"))
    finally:
        stream.close()
    if fs.exists(fresh):
        for source, target in ((folder, old), (fresh, folder)):
            if fs.exists(source) and not fs.rename(source, target):
                raise OSError(f"cannot move {source} to {target}")
    fs.delete(old, True)
    fs.delete(note, True)


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Replace the output at ``path`` by what ``write`` writes to a folder beside it.

    A failed write changes nothing, and output may be made from what it replaces. When
    the new folder is whole, a note is left that decides for it, and the folders
    change places; ``path`` stays a plain folder that others can read.
    """
    finish_swap(spark, path)
    hadoop, folder, fs = _fs(spark, path)
    name = f"{folder}.{uuid.uuid4().hex}"
    fresh, old = hadoop.Path(name + ".new"), hadoop.Path(name + ".old")
    try:
        write(fresh.toString())
    except BaseException:
        fs.delete(fresh, True)
        raise
    draft = hadoop.Path(name + ".note")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(f"{fresh}\n{old}".encode()))
    finally:
        out.close()
    if not fs.rename(draft, hadoop.Path(folder.toString() + ".swap")):
        raise OSError(f"cannot leave a note for {path}")
    finish_swap(spark, path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Stage tables are Parquet with named, typed columns."""
    finish_swap(spark, path)
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace existing output; Parquet."""
    replace_folder(df.sparkSession, path,
                   lambda p: df.write.partitionBy(*partition_by).parquet(p))


def parse_lines(lines: DataFrame, schema: T.StructType, sep: str = "|", value: str = "value",
                blank_zero: Sequence[str] = ()) -> DataFrame:
    """Delimited lines to typed columns (F1: blank fields are kept).

    The separator is the only special character; quotes and backslashes are
    text. A line with another number of fields, or a field that is not a
    number where one is due, raises an error; only the columns in
    ``blank_zero`` read a blank as 0.
    """
    n = len(schema.fields)
    fields = F.split(F.col(value), re.escape(sep), -1)
    checked = F.when(F.size(fields) == n, fields).otherwise(F.raise_error(
        F.concat(F.lit(f"not {n} fields: "), F.col(value))).cast("array<string>"))
    rows = lines.select(checked.alias("_f"))

    def column(k: int, f: T.StructField) -> Column:
        text = F.col("_f").getItem(k)
        if isinstance(f.dataType, T.StringType):
            return text.alias(f.name)
        blank = 0 if f.name in blank_zero else None
        return strict_number(text, f.dataType.simpleString(), blank).alias(f.name)

    return rows.select(*[column(k, f) for k, f in enumerate(schema.fields)])


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = "|",
                   blank_zero: Sequence[str] = ()) -> DataFrame:
    """S5/S6/S8 text form: delimited lines without header, as ``write_delimited`` leaves them."""
    return parse_lines(spark.read.text(path), schema, sep, blank_zero=blank_zero)


def to_lines(df: DataFrame, cols: Sequence[str | Column] | None = None,
             sep: str = "|") -> DataFrame:
    """One text column ``value`` per row, fields joined by ``sep``."""
    cols = list(cols) if cols is not None else df.columns
    return df.select(delimited(cols, sep).alias("value"))


def write_delimited(df: DataFrame, path: str, cols: Sequence[str | Column] | None = None,
                    sep: str = "|") -> None:
    """S3: text lines; the number of files follows the data."""
    replace_folder(df.sparkSession, path, lambda p: to_lines(df, cols, sep).write.text(p))


def write_predictions(pred: DataFrame, path: str) -> None:
    """``uid,prediction`` lines, no header.

    The reference wrote one file; here the file count follows the data so
    that scoring many users does not funnel into one task.
    """
    lines = pred.select("uid", F.col("prediction").cast("int"))
    replace_folder(pred.sparkSession, path,
                   lambda p: lines.write.option("header", "false").csv(p))


def preview(df: DataFrame, name: str, n: int = 20) -> list:
    """Row count and first ``n`` rows, in one job.

    The rows are counted on their way to a top-``n`` by position, which reads all of them.
    """
    seen = Observation(f"preview_{uuid.uuid4().hex}")
    rows = (df.observe(seen, F.count(F.lit(1)).alias("n"))
            .withColumn("_at", F.monotonically_increasing_id())
            .orderBy("_at").limit(n).drop("_at").collect())
    print(f"{name} count: {seen.get['n']}")
    for r in rows:
        print(r)
    return rows
