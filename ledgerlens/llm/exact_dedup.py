"""Exact de-duplication with DataFrame operations only.

Texts are grouped by a 128-bit content hash (MD5) together with their
bytes, so two texts that share a hash but differ in a byte fall in
different groups. The partial aggregate of that grouping folds copies
inside every map task: a text that holds a third of all rows reaches the
shuffle once per task. Which rows belong to a group is then found by a
join on small keys (hashes, no text), and only groups of more than one row
take part; their rows are spread over salts, so the largest group is not
one task either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text

#: Parts over which the rows of one group are spread in the join.
SALTS = 16


def text_groups(docs: DataFrame, keep: str = "max") -> DataFrame:
    """One row per text that occurs more than once.

    ``hash128``, ``text_sha256``, ``keep_id`` (largest or smallest ``doc_id``
    as ``keep`` says) and ``group_size``.
    """
    if keep not in ("max", "min"):
        raise ValueError(f"keep={keep!r}")
    pick = F.max if keep == "max" else F.min
    hashed = id_and_text(docs).select("doc_id", F.md5("text").alias("hash128"), "text")
    return (hashed.groupBy("hash128", "text")
            .agg(pick("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            .filter("group_size > 1")
            .select("hash128", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"))


def exact_duplicates(docs: DataFrame, keep: str = "max", salts: int = SALTS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes are; NULL counts as empty, and empty
    texts form one group. Of equal texts the row with the largest ``doc_id``
    stays (``keep="min"``: the smallest). An empty table gives no rows. Rows
    that repeat a ``doc_id`` with the same text are all marked kept when that
    id is the one that stays; rows with a NULL id are kept only when their
    text occurs under no id.
    """
    groups = (text_groups(docs, keep)
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    rows = id_and_text(docs).select(
        "doc_id", F.md5("text").alias("hash128"), F.sha2("text", 256).alias("text_sha256"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("_salt"))
    keep_id = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return (rows.join(groups, ["_salt", "hash128", "text_sha256"], "left")
            .select("doc_id", keep_id.alias("keep_id"),
                    F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                    F.coalesce(F.col("doc_id").eqNullSafe(keep_id), F.lit(False)).alias("kept"),
                    "text_sha256"))


def drop_exact_duplicates(docs: DataFrame, keep: str = "max") -> DataFrame:
    """Rows of ``docs`` that ``exact_duplicates`` keeps, all columns unchanged.

    A row goes by its id and its text: an id that also has another text keeps
    that one, and a NULL id goes only where its own text occurs under an id.
    """
    dropped = exact_duplicates(docs, keep).filter("NOT kept").select(
        F.col("doc_id").alias("_dropped"), F.col("text_sha256").alias("_sha256")).distinct()
    own = F.sha2(F.coalesce(docs["text"], F.lit("")), 256)
    return docs.join(dropped, docs["doc_id"].eqNullSafe(dropped["_dropped"])
                     & (own == dropped["_sha256"]), "left_anti")
