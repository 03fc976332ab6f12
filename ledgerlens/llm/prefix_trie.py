"""Conversation prefix trie: every shared beginning of conversations as one node.

``ROLLUP`` over positional turn-id columns aggregates all prefixes of a block of
``BLOCK`` turns together, and ``grouping_id`` tells the depth of a group. A node is
named by its depth and the smallest conversation in it; that name keys the next
block of columns, in which only conversations whose prefix is shared go on. Below a
node with a single conversation nothing can be shared, so the rest of it is written
down as a chain without looking at its turns. The number of rounds therefore
follows the longest *shared* prefix, not the longest conversation.

A turn's id is the first half of the SHA-256 of its role and text (128 bits).

Hot groups: turns are numbered over range partitions with a carry per partition, so
one conversation may hold a third of all turns; a common beginning is folded by the
map-side part of the grouping; groups of more than a thousandth of all
conversations are looked up by broadcast (there are at most a thousand a depth), and the ids that
end in a node are gathered in runs of 4096 ids and hashed as a stream.

Defined results:

* rows without ``conv_id`` belong to no conversation and are left out;
* NULL role or text is the empty text; a NULL turn comes first; turns of equal number
  are ordered by role and turn id, and a row that occurs twice is two turns;
* an empty table has no nodes, not even a root;
* other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialized
from .common import spread_join

#: Turns of one block of columns.
BLOCK = 8
#: Bytes of a turn id.
ID_BYTES = 16
#: A conversation's turns travel to its attributes in chunks of so many.
CHUNK = 4096
#: log2 of the ids of one run of conversations that end in a node.
RUN_BITS = 12
#: Conversations ``c - c % GROUP`` lend their first turns to those of their hundred.
GROUP, LENT = 100, 6

TURN_ID = (f"substring(unhex(sha2(concat(length(role), ':', role, text), 256)), 1, {ID_BYTES})"
           " AS tid")


# ---- turns ----------------------------------------------------------------

def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos`` (from 1)``, tid, points`` for every turn, as a written table.

    Turns are sorted once over range partitions. A partition counts the runs of
    equal ``conv_id`` it sees; what came before in other partitions is added from a
    table with at most one row per partition.
    """
    turns = conversations.selectExpr(
        "CAST(conv_id AS BIGINT) AS conv_id", "turn", "coalesce(role, '') AS role",
        "coalesce(text, '') AS text").filter("conv_id IS NOT NULL").selectExpr(
        "conv_id", "turn", "role", TURN_ID, "CAST(char_length(text) AS BIGINT) AS points")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("tid")]
    ranged = turns.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, count = None, 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            at = []
            for c in ids:
                count = count + 1 if c == last else 1
                last = c
                at.append(count)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(at, pa.int64()), batch.column(1), batch.column(2),
                 pa.array([part] * len(at), pa.int32())],
                names=["conv_id", "local", "tid", "points", "part"])

    runs = materialized(
        ranged.select("conv_id", "tid", "points").mapInArrow(
            run, "conv_id long, local long, tid binary, points long, part int"), "turn_runs")
    before = (runs.groupBy("conv_id", "part").agg(F.expr("count(1) AS n"))
              .selectExpr("conv_id", "part", "coalesce(sum(n) OVER (PARTITION BY conv_id ORDER BY"
                          " part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS carry")
              .filter("carry > 0"))  # at most one row per partition
    return (runs.join(F.broadcast(before), ["conv_id", "part"], "left")
            .selectExpr("conv_id", "local + coalesce(carry, 0) AS pos", "tid", "points"))


def conversation_lengths(turns: DataFrame) -> DataFrame:
    """``conv_id, len`` of numbered turns."""
    return turns.groupBy("conv_id").agg(F.expr("count(1) AS len"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are lent by the first one of their hundred.

    Conversation c gets the first h turns of ``c - c % 100`` (all if fewer, none if
    absent), then its own turns after its first h; h is ``crc32(c as text) % 6``.
    Returns ``conv_id, len`` of all conversations, turnless ones too, and their
    ``conv_id, pos, tid, points``.
    """
    lent = (turns.filter(f"conv_id % {GROUP} = 0 AND pos < {LENT}").groupBy("conv_id")
            .agg(F.expr("array_sort(collect_list(struct(pos, tid, points))) AS lent"))
            .withColumnRenamed("conv_id", "base"))
    convs = materialized(
        conversation_lengths(turns)
        .selectExpr("conv_id", "len", f"conv_id - conv_id % {GROUP} AS base",
                    f"CAST(crc32(CAST(CAST(conv_id AS STRING) AS BINARY)) % {LENT} AS INT) AS h")
        .join(lent, "base", "left")
        .selectExpr("conv_id", "len AS own", "h",
                    "slice(coalesce(lent, array()), 1, h) AS lent")
        .selectExpr("*", "CAST(size(lent) AS BIGINT) AS b")
        .selectExpr("*", "b + greatest(own - h, 0) AS len"), "rebuilt_conversations")
    first = convs.selectExpr("conv_id", "inline(lent)")
    # a conversation's turns meet its attributes chunk by chunk
    moves = convs.filter("own > h").selectExpr(
        "conv_id", "h", "b", f"explode(sequence(0L, own div {CHUNK})) AS chunk")
    own = (turns.selectExpr("*", f"pos div {CHUNK} AS chunk")
           .join(moves, ["conv_id", "chunk"]).filter("pos > h")
           .selectExpr("conv_id", "pos - h + b AS pos", "tid", "points"))
    return convs.select("conv_id", "len"), first.unionByName(own)


# ---- trie -----------------------------------------------------------------

def _names(prefix: str) -> list[str]:
    return [f"{prefix}{i}" for i in range(1, BLOCK + 1)]


def _path(cols: list[str]) -> str:
    return "concat(" + ", ".join(f"coalesce({c}, X'')" for c in cols) + ")"


def _column_blocks(turns: DataFrame) -> DataFrame:
    """One row per conversation and block: ``conv_id, k``, turn ids and code points by position."""
    place = f"(pos - 1) % {BLOCK}"
    return (turns.selectExpr("conv_id", f"(pos - 1) div {BLOCK} AS k", f"{place} AS i", "tid",
                             "points")
            .groupBy("conv_id", "k")
            .agg(*[F.expr(f"max(CASE WHEN i = {i} THEN tid END) AS t{i + 1}")
                   for i in range(BLOCK)],
                 *[F.expr(f"max(CASE WHEN i = {i} THEN points END) AS p{i + 1}")
                   for i in range(BLOCK)]))


def _block_nodes(rows: DataFrame, start: int) -> DataFrame:
    """All prefixes of one block by one ``ROLLUP``; ``d`` is the depth inside the block.

    ``rows``: ``top, conv_id, len``, turn ids, code points. A group whose last
    grouped column is NULL holds conversations that ended before; it is no node.
    """
    ids, points = ", ".join(_names("t")), _names("p")
    nodes = rows.sparkSession.sql(
        f"SELECT top, {ids}, {BLOCK} - bit_count(grouping_id()) AS d, count(1) AS n_convs, "
        f"min(conv_id) AS conv_id, max(len) AS longest, "
        + ", ".join(f"max({p}) AS {p}" for p in points)
        + f" FROM {{rows}} GROUP BY top, ROLLUP({ids})", rows=rows)
    last = "CASE d " + " ".join(f"WHEN {i + 1} THEN p{i + 1}" for i in range(BLOCK)) + " ELSE 0 END"
    return (nodes.selectExpr("top", *_names("t"), "CAST(d AS INT) AS d", "n_convs", "conv_id",
                             "longest", f"{_path(_names('t'))} AS path",
                             f"(n_convs - 1) * {last} AS saved")
            .filter(f"length(path) = {ID_BYTES} * d")
            .withColumn("leaf", F.expr(f"longest = {start} + d")))


def _ends(rows: DataFrame, start: int) -> DataFrame:
    """``top, path, ends``: SHA-256 of the ids of the conversations that end in a node.

    Ids are gathered in runs of at most 4096 (each conversation has one id), and the
    runs of a node go through one hash in order.
    """
    runs = (rows.filter(f"len <= {start + BLOCK}")
            .selectExpr("top", f"{_path(_names('t'))} AS path", "conv_id",
                        f"shiftright(conv_id, {RUN_BITS}) AS run")
            .groupBy("top", "path", "run")
            .agg(F.expr("concat_ws(',', transform(array_sort(collect_list(conv_id)),"
                        " x -> CAST(x AS STRING))) AS ids"))
            .repartition("top", "path").sortWithinPartitions("top", "path", "run"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for top, path, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2))):
                if (top, path) == node:
                    state.update(b",")
                else:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = (top, path), hashlib.sha256()
                state.update(ids.encode())
            yield _ends_batch(done)
        if node is not None:
            yield _ends_batch([(*node, state.hexdigest())])

    return runs.select("top", "path", "ids").mapInArrow(
        hashed, "top long, path binary, ends string")


def _ends_batch(rows: list[tuple]) -> pa.RecordBatch:
    top, path, ends = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(top, pa.int64()), pa.array(path, pa.binary()), pa.array(ends, pa.string())],
        names=["top", "path", "ends"])


def _below(nodes: DataFrame, deeper: DataFrame | None) -> DataFrame:
    """Sums over subtrees: ``top, path, leaves, saved_below`` by a second ``ROLLUP``, over nodes.

    ``deeper``: the sums of the next block for each of this block's deepest nodes
    (``conv_id, more_leaves, more_saved, more_children``).
    """
    # a deepest node of one conversation that goes on ends in one leaf further down
    own = nodes.selectExpr(
        "top", *_names("t"), "d", "conv_id", "saved",
        f"CAST(leaf OR (d = {BLOCK} AND n_convs = 1) AS BIGINT) AS leaves")
    if deeper is not None:
        own = (own.join(deeper.selectExpr("conv_id", f"{BLOCK} AS d", "more_leaves", "more_saved"),
                        ["conv_id", "d"], "left")
               .selectExpr("top", *_names("t"), "saved + coalesce(more_saved, 0) AS saved",
                           "leaves + coalesce(more_leaves, 0) AS leaves"))
    ids = ", ".join(_names("t"))
    sums = nodes.sparkSession.sql(
        f"SELECT top, {ids}, {BLOCK} - bit_count(grouping_id()) AS d, sum(leaves) AS leaves,"
        f" sum(saved) AS saved_below FROM {{own}} GROUP BY top, ROLLUP({ids})", own=own)
    return (sums.selectExpr("top", f"{_path(_names('t'))} AS path", "d", "leaves", "saved_below")
            .filter(f"length(path) = {ID_BYTES} * d").drop("d"))


def _children(nodes: DataFrame, deeper: DataFrame | None) -> DataFrame:
    """``top, path, children`` of every node that has some."""
    inside = (nodes.filter("d > 0")
              .selectExpr("top", f"substring(path, 1, {ID_BYTES} * (d - 1)) AS path")
              .groupBy("top", "path").agg(F.expr("count(1) AS children")))
    chain = nodes.filter(f"d = {BLOCK} AND n_convs = 1 AND NOT leaf").selectExpr(
        "top", "path", "1L AS children")
    out = inside.unionByName(chain)
    if deeper is not None:
        out = out.unionByName(
            nodes.filter(f"d = {BLOCK}").select("conv_id", "top", "path")
            .join(deeper.selectExpr("conv_id", "more_children AS children"), "conv_id")
            .select("top", "path", "children"))
    return out


NO_END = hashlib.sha256(b"").hexdigest()
OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
       "ends_sha256"]


def _finished(nodes: DataFrame, rows: DataFrame, start: int, total: int,
              deeper: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The block's nodes with all columns, and what the block before needs of them."""
    def part(df: DataFrame, **given: str) -> DataFrame:
        kinds = {"conv_id": "BIGINT", "d": "INT", "n_convs": "BIGINT", "children": "BIGINT",
                 "leaves": "BIGINT", "saved_below": "BIGINT", "ends": "STRING"}
        return df.selectExpr("top", "path", *[
            f"CAST({given.get(c, 'NULL')} AS {kind}) AS {c}" for c, kind in kinds.items()])

    pieces = part(nodes, conv_id="conv_id", d="d", n_convs="n_convs")
    pieces = pieces.unionByName(part(_children(nodes, deeper), children="children"))
    pieces = pieces.unionByName(part(_below(nodes, deeper), leaves="leaves",
                                     saved_below="saved_below"))
    pieces = pieces.unionByName(part(_ends(rows, start), ends="ends"))
    whole = materialized(pieces.groupBy("top", "path").agg(
        *[F.expr(f"max({c}) AS {c}") for c in ("conv_id", "d", "n_convs", "ends")],
        *[F.expr(f"coalesce(sum({c}), 0) AS {c}") for c in ("children", "leaves", "saved_below")]),
        "trie_block")
    # a node of one conversation has one child at most, which has the same conversation
    parents = whole.filter("n_convs > 1").selectExpr("top", "path AS above", "conv_id AS parent",
                                                     "n_convs AS members")
    found = spread_join(
        whole.selectExpr("*", f"substring(path, 1, {ID_BYTES} * (d - 1)) AS above")
        .filter("d > 0"), parents, ["top", "above"], "members", total)
    out = found.selectExpr("conv_id", "d", "coalesce(parent, conv_id) AS parent_conv_id",
                           "n_convs", "children", "leaves", "saved_below", "ends")
    if not start:
        out = out.unionByName(whole.filter("d = 0").selectExpr(
            "conv_id", "d", "CAST(NULL AS BIGINT) AS parent_conv_id", "n_convs", "children",
            "leaves", "saved_below", "ends"))
    out = out.selectExpr(
        "conv_id", f"CAST(d + {start} AS BIGINT) AS depth", "parent_conv_id", "n_convs",
        "children AS n_children", "leaves AS n_leaves", "saved_below AS saved_tokens",
        f"coalesce(ends, '{NO_END}') AS ends_sha256")
    more = whole.filter("d = 0").selectExpr(
        "top AS conv_id", "leaves AS more_leaves", "saved_below AS more_saved",
        "children AS more_children")
    return out, more


def _chains(nodes: DataFrame, start: int) -> DataFrame:
    """Nodes below the deepest ones of a block that hold one conversation, as one chain each."""
    pieces = (nodes.filter(f"d = {BLOCK} AND n_convs = 1 AND NOT leaf")
              .selectExpr("conv_id", "longest",
                          f"explode(sequence({start + BLOCK + 1}L, longest, {CHUNK}L)) AS at")
              .repartition("conv_id", "at"))
    return (pieces.selectExpr("conv_id", "longest",
                              f"explode(sequence(at, least(at + {CHUNK - 1}, longest))) AS depth")
            .selectExpr("conv_id", "depth", "conv_id AS parent_conv_id", "1L AS n_convs",
                        "CAST(depth < longest AS BIGINT) AS n_children", "1L AS n_leaves",
                        "0L AS saved_tokens",
                        "CASE WHEN depth = longest THEN"
                        " sha2(CAST(CAST(conv_id AS STRING) AS BINARY), 256)"
                        f" ELSE '{NO_END}' END AS ends_sha256"))


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The trie of ``convs`` (``conv_id, len``) over their ``turns`` (``conv_id, pos, tid, points``).

    One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` (code points that
    sharing the node's subtree saves), ``ends_sha256`` (of the members that end here).
    """
    blocks = materialized(_column_blocks(turns), "turn_columns")
    columns = _names("t") + _names("p")
    rows = materialized(convs.join(blocks.filter("k = 0"), "conv_id", "left")
                        .selectExpr("0L AS top", "conv_id", "len", *columns), "trie_rows")
    total = rows.count()
    steps: list[tuple[DataFrame, DataFrame, int]] = []
    while True:
        start = len(steps) * BLOCK
        nodes = materialized(_block_nodes(rows, start), "trie_nodes")
        steps.append((nodes, rows, start))
        shared = nodes.filter(f"d = {BLOCK} AND n_convs > 1 AND NOT leaf")
        if shared.isEmpty():
            break
        going = spread_join(
            rows.filter(f"len > {start + BLOCK}")
            .selectExpr("top", "conv_id", "len", f"{_path(_names('t'))} AS path"),
            shared.selectExpr("top", "path", "conv_id AS next_top", "n_convs AS members"),
            ["top", "path"], "members", total)
        rows = materialized(
            going.filter("next_top IS NOT NULL").selectExpr("next_top AS top", "conv_id", "len")
            .join(blocks.filter(f"k = {len(steps)}"), "conv_id")
            .select("top", "conv_id", "len", *columns), "trie_rows")
        # members that end in a shared node take no part below it, but are part of it
    out: DataFrame | None = None
    deeper = None
    for nodes, rows, start in reversed(steps):
        finished, deeper = _finished(nodes, rows, start, total, deeper)
        finished = finished.unionByName(_chains(nodes, start))
        out = finished if out is None else finished.unionByName(out)
    return out.select(*OUT)


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """Number the turns, rebuild the conversations, and give their trie."""
    convs, turns = rebuilt(numbered_turns(conversations))
    return prefix_trie(convs, turns)
