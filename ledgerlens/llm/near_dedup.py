"""Near-duplicate detection: MinHash with tensored banding, links confirmed on full sets.

Two collections of ``m`` bands each are drawn from ``2 * m * r`` minhashes. A
table key is a pair of a band of the first and one of the second collection,
so there are ``m * m`` tables for the minhash work of ``2 * m`` bands. Two
sets of similarity J meet in a table with probability J ** (2 * r), and in at
least one with (1 - (1 - J ** r) ** m) ** 2; for r = 4, m = 28 that misses
5 of 100,000 pairs at J = 0.75 and next to none above 0.8.

Copies of a set are folded first. A band that only one set has cannot give a
key, so only bands shared by several sets go on; there the second collection
is compared inside the groups. A group too large for that is dealt out anew
under the pair keys themselves. In each table every set is first held against
the smallest id (no pairs inside a group are written out), and sets that this
one does not cover against all others of the table, by size and signature. Of
a group's pairs only a spanning forest goes out, at most one pair per set
less one, pairs of greatest agreement first. The tables of large groups take
their sets together whatever the smallest id is like. After those links are
confirmed, sets that were taken together but lie in different components are
held against each other too, so no link between them is lost.

A set stands for all documents that have it. Its node is the smallest of their ids;
where an id has several texts and would stand for several sets, a hash of id
and set takes its place until the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialized
from .common import id_and_text, slices, spread_join, text_bytes
from .components import components
from .words import mix, shingle_sets, words

SHINGLE = 5
SIMILARITY = 75  # percent
BAND_ROWS = 4   # four low bytes make the 32 bits by which bands are compared
BANDS = 28
#: A group of more sets is dealt out anew under its pair keys.
LARGE_GROUP = 2000
#: In a table of up to so many sets, those that its head does not cover are paired at once.
SMALL_RUN = 64
#: Standard errors by which the signatures may fall short of the similarity.
SLACK = 4.2


def _hash_parameters(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(4)
    return (rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 1 << 63, count, dtype=np.uint64))


def minhashes(hashes: np.ndarray, count: int) -> np.ndarray:
    """``count`` minhashes of a set of 64-bit hashes."""
    a, b = _hash_parameters(count)
    low = np.full(count, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, hashes.size, 4096):
        part = hashes[at:at + 4096, None]
        low = np.minimum(low, ((part * a + b) >> np.uint64(32)).astype(np.uint32).min(axis=0))
    return low


def band_keys(low: np.ndarray, bands: int) -> np.ndarray:
    """64-bit keys of the bands of one collection."""
    keys = np.arange(bands, dtype=np.uint64)
    for k in range(BAND_ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + low.reshape(bands, BAND_ROWS)[:, k])
    return keys


def signatures(docs: DataFrame, bands: int = BANDS, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b`` (128 bits over the set), ``first``, ``sketch``, ``text_key``.

    ``first`` holds the keys of the first collection's bands; ``sketch`` the
    low byte of every minhash, four a band, the second collection last;
    ``text_key`` is the MD5 of the text, which tells the texts of one id apart.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets(words(*text_bytes(batch.column(1))), shingle)
            folded = [(int(s.sum(dtype=np.uint64)), int(mix(s ^ np.uint64(7)).sum(dtype=np.uint64)))
                      for s in sets]
            low = [minhashes(s, 2 * bands * BAND_ROWS) if s.size else None for s in sets]
            keys = [np.zeros(0, np.int64) if m is None else
                    band_keys(m[:bands * BAND_ROWS], bands).view(np.int64) for m in low]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s.size for s in sets], pa.int64()),
                 pa.array(np.array([f[0] for f in folded], np.uint64).view(np.int64)),
                 pa.array(np.array([f[1] for f in folded], np.uint64).view(np.int64)),
                 pa.array(keys, pa.list_(pa.int64())),
                 pa.array([b"" if m is None else m.astype(np.uint8).tobytes() for m in low],
                          pa.binary()), batch.column(2)],
                names=["doc_id", "n_shingles", "set_a", "set_b", "first", "sketch", "text_key"])

    return _keyed_texts(docs).mapInArrow(
        run, "doc_id long, n_shingles long, set_a long, set_b long, first array<long>, "
             "sketch binary, text_key binary")


def _keyed_texts(docs: DataFrame) -> DataFrame:
    return id_and_text(docs).selectExpr(
        "CAST(doc_id AS BIGINT) AS doc_id", "text",
        "unhex(md5(CAST(text AS BINARY))) AS text_key")


# ---- groups of a shared band --------------------------------------------
def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by ``key``, in tables that never cut a group."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.asarray(batch.column(0))
        at = int(np.searchsorted(keys, keys[-1], side="left"))  # sorted: start of the last group
        if at or (held and np.asarray(held[-1].column(0))[-1] != keys[0]):
            if not at:
                yield pa.Table.from_batches(held)
                held = [batch]
                continue
            yield pa.Table.from_batches([*held, batch.slice(0, at)])
            held = [batch.slice(at)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _runs(key: np.ndarray, band: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows ordered by (key, band, doc), and the start of each run of equal (key, band)."""
    order = np.lexsort((doc, band, key))
    k, b = key[order], band[order]
    new = np.ones(order.size, bool)
    new[1:] = (k[1:] != k[:-1]) | (b[1:] != b[:-1])
    return order, np.flatnonzero(new)


def _agreement(sketch: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Equal signature bytes of each pair."""
    out = np.zeros(i.size, np.int64)
    for at in range(0, i.size, 8192):
        part = slice(at, at + 8192)
        out[part] = (sketch[i[part]] == sketch[j[part]]).sum(axis=1)
    return out


def _plausible(sketch: np.ndarray, i: np.ndarray, j: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Pairs whose sizes allow the similarity and whose signatures do not speak against it."""
    ok = 100 * np.minimum(size[i], size[j]) >= SIMILARITY * np.maximum(size[i], size[j])
    wanted, count = SIMILARITY / 100, sketch.shape[1]
    least = wanted - SLACK * np.sqrt(wanted * (1 - wanted) / count)
    least += (1 - least) / 256   # bytes that agree by chance
    at = np.flatnonzero(ok)
    ok[at] = _agreement(sketch, i[at], j[at]) >= least * count
    return ok


def _spread(run: np.ndarray, reached: np.ndarray, size: np.ndarray, sketch: np.ndarray
            ) -> np.ndarray:
    """Plausible pairs that join what the plausible pairs of a run join; ``reached`` are joined."""
    queue, rest, found = run[reached].tolist(), run[~reached], [np.zeros((0, 2), np.int64)]
    while rest.size:
        if queue:
            i = queue.pop()
        else:
            i, rest = int(rest[0]), rest[1:]
        ok = _plausible(sketch, np.full(rest.size, i), rest, size)
        if ok.any():
            found.append(np.stack([np.full(int(ok.sum()), i), rest[ok]], axis=1))
            queue.extend(rest[ok].tolist())
            rest = rest[~ok]
    return np.concatenate(found)


def _star_pairs(key: np.ndarray, doc: np.ndarray, size: np.ndarray, bands: np.ndarray,
                sketch: np.ndarray) -> np.ndarray:
    """Pairs of ids that join whatever the plausible pairs inside the runs join.

    First (smallest id, id) of every run, where plausible. Ids that the smallest
    does not cover are held against all others of the run. Rows of different keys never
    meet, so the forest has at most one pair less than rows for each key.
    """
    n, runs, stars = max(1, doc.size), [], [np.zeros(0, np.int64)]
    for j in range(bands.shape[1]):
        order, starts = _runs(key, bands[:, j], doc)
        length = np.diff([*starts, order.size])
        code = np.repeat(order[starts], length) * n + order
        runs.append((order, starts, length, code))
        other = np.ones(order.size, bool)
        other[starts] = False
        stars.append(code[other])
    codes = np.unique(np.concatenate(stars))
    ok = _plausible(sketch, codes // n, codes % n, size)
    near = codes[ok]
    more, joined = [np.zeros(0, np.int64)], [np.zeros((0, 2), np.int64)]
    for order, starts, length, code in runs:
        covered = np.isin(code, near)
        open_ = np.add.reduceat((~covered).astype(np.int64), starts) > 1   # the head is one
        open_ &= length > 2
        for k in np.unique(length[open_]).tolist():
            at = starts[open_ & (length == k)]
            if k > SMALL_RUN:
                joined += [_spread(order[x + 1:x + k], covered[x + 1:x + k], size, sketch)
                           for x in at.tolist()]
                continue
            inside = at[:, None] + np.arange(1, k)
            a, b = np.triu_indices(k - 1, 1)
            wanted = ~(covered[inside[:, a]] & covered[inside[:, b]])
            x, y = order[inside[:, a]][wanted], order[inside[:, b]][wanted]
            more.append(np.unique(np.minimum(x, y) * n + np.maximum(x, y)))
    codes = np.unique(np.concatenate(more))
    codes = codes[_plausible(sketch, codes // n, codes % n, size)]
    found = np.unique(np.concatenate(
        [near, codes, *[j.min(axis=1) * n + j.max(axis=1) for j in joined]]))
    return np.unique(doc[_forest(found // n, found % n, sketch)], axis=0)


def _forest(i: np.ndarray, j: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """The pairs of a spanning forest, those of greatest agreement first."""
    order = np.lexsort((j, i, -_agreement(sketch, i, j)))
    part: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := part.get(x, x)) != x:
            part[x] = x = part.get(up, up)
        return x

    kept = []
    for x, y in zip(i[order].tolist(), j[order].tolist()):
        if (a := root(x)) != (b := root(y)):
            part[a] = b
            kept.append((x, y))
    return np.array(kept, np.int64).reshape(-1, 2)


def _pairs(rows: DataFrame) -> DataFrame:
    """Joining pairs ``a < b`` inside the groups of ``key``; a second band must meet as well."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_groups(batches):
            t = t.combine_chunks()
            sketch = _sketches(t)
            half = np.ascontiguousarray(sketch[:, sketch.shape[1] // 2:])
            got = _star_pairs(np.asarray(t["key"]), np.asarray(t["doc_id"]),
                              np.asarray(t["n_shingles"]), half.view(np.int32), sketch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(got.min(axis=1)), pa.array(got.max(axis=1))], names=["a", "b"])

    return (rows.select("key", "doc_id", "n_shingles", "sketch")
            .repartition("key").sortWithinPartitions("key", "doc_id")
            .mapInArrow(run, "a long, b long").distinct())


def _sketches(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint8).reshape(t.num_rows, -1)


def _large_star(rows: DataFrame) -> DataFrame:
    """Star pairs of the large groups' tables by grouping, with partial minima per task.

    ``near`` tells whether the sizes allow the similarity. The other pairs cannot
    be links, but what stands in a table with them may have one.
    """
    heads = rows.groupBy("key").agg(F.min(F.struct("doc_id", "n_shingles")).alias("head"))
    return (rows.join(heads, "key").filter("doc_id <> head.doc_id")
            .selectExpr("head.doc_id AS a", "doc_id AS b",
                        f"100 * least(n_shingles, head.n_shingles) >= "
                        f"{SIMILARITY} * greatest(n_shingles, head.n_shingles) AS near").distinct())


# ---- between components -------------------------------------------------
def _cells(stars: DataFrame, parts: DataFrame, size: int) -> DataFrame:
    """Sets of the clusters with several components, dealt into cells.

    ``key, doc_id, component, outside, asks``: a cell holds at most about
    ``size`` sets that ask (outside the cluster's largest component) and as
    many that are asked. Together the cells of a cluster hold each pair.
    """
    nodes = (components(stars).withColumnRenamed("component", "cluster")
             .join(parts, "node", "left")
             .select(F.col("node").alias("doc_id"), "cluster",
                     F.coalesce("component", "node").alias("component")))
    sizes = nodes.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = (sizes.groupBy("cluster").agg(
        F.max(F.struct("n", (-F.col("component")).alias("c"))).alias("top"),
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).filter("k > 1")
        .selectExpr("cluster", "-top.c AS main", f"CAST(ceil(n / {size}) AS INT) AS asked_parts",
                    f"CAST(ceil((n - top.n) / {size}) AS INT) AS asking_parts"))
    rows = (nodes.join(mixed, "cluster")
            .withColumn("outside", F.expr("component <> main"))
            .withColumn("own", F.xxhash64("doc_id")))
    asked = rows.selectExpr(
        "*", "false AS asks", "CAST(pmod(own, asked_parts) AS INT) AS y",
        "explode(sequence(0, asking_parts - 1)) AS x")
    asking = rows.filter("outside").selectExpr(
        "*", "true AS asks", "CAST(pmod(own, asking_parts) AS INT) AS x",
        "explode(sequence(0, asked_parts - 1)) AS y")
    return asked.unionByName(asking).select(
        F.xxhash64("cluster", "x", "y").alias("key"), "doc_id", "component", "outside", "asks")


def _links_between(cells: DataFrame, sets: DataFrame, texts: DataFrame, shingle: int
                   ) -> DataFrame:
    """Links ``(a, b)`` that join components inside the cells, confirmed on the full sets.

    Within a cell, components that a link has joined are one from then on.
    """
    rows = (cells.join(sets.selectExpr("node AS doc_id", "rep", "rep_key", "sketch"), "doc_id")
            .join(texts, ["rep", "rep_key"])
            .select("key", "doc_id", "component", "outside", "asks", "sketch", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_groups(batches):
            t = t.combine_chunks()
            key, doc = np.asarray(t["key"]), np.asarray(t["doc_id"])
            outside, asks = np.asarray(t["outside"]), np.asarray(t["asks"])
            sketch = _sketches(t)
            sets = [s for b in slices(t.select(["text"]).to_batches()) for s in shingle_sets(
                words(*text_bytes(b.column(0))), shingle)]
            size = np.array([s.size for s in sets])
            part = np.asarray(t["component"]).copy()
            starts = np.flatnonzero(np.diff(key, prepend=key[0] - 1))
            found = []
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), key.size]):
                there = np.arange(a, b)
                asked = there[~asks[a:b]]
                for i in there[asks[a:b]].tolist():
                    # Of two sets that both ask, the smaller id does.
                    other = asked[~outside[asked] | (doc[asked] > doc[i])]
                    other = other[part[other] != part[i]]
                    other = other[_plausible(sketch, np.full(other.size, i), other, size)]
                    for j in other.tolist():
                        if part[i] == part[j]:
                            continue
                        common = np.intersect1d(sets[i], sets[j], assume_unique=True).size
                        if 100 * common >= SIMILARITY * (size[i] + size[j] - common):
                            found.append((min(doc[i], doc[j]), max(doc[i], doc[j])))
                            part[there[part[there] == part[j]]] = part[i]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.int64()),
                 pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    return (rows.repartition("key").sortWithinPartitions("key", "doc_id")
            .mapInArrow(run, "a long, b long"))


def confirmed(pairs: DataFrame, sets: DataFrame, texts: DataFrame, shingle: int = SHINGLE
              ) -> DataFrame:
    """The pairs ``(a, b)`` of nodes whose full shingle sets reach the similarity.

    ``texts`` has one text per ``rep, rep_key``, the document that stands for a set.
    """
    where = sets.select("node", "rep", "rep_key")
    joined = (pairs.join(where.toDF("b", "rep", "rep_key"), "b").join(texts, ["rep", "rep_key"])
              .selectExpr("a", "b", "text AS text_b")
              .join(where.toDF("a", "rep", "rep_key"), "a").join(texts, ["rep", "rep_key"])
              .select("a", "b", "text_b", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            a, b = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            own, row_of = np.unique(a, return_index=True)
            sets_a = dict(zip(own.tolist(), shingle_sets(
                words(*text_bytes(batch.column(3).take(pa.array(row_of)))), shingle)))
            sets_b = shingle_sets(words(*text_bytes(batch.column(2))), shingle)
            ok = []
            for x, y in zip(a.tolist(), sets_b):
                common = np.intersect1d(sets_a[x], y, assume_unique=True).size
                ok.append(100 * common >= SIMILARITY * (sets_a[x].size + y.size - common))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return joined.mapInArrow(run, "a long, b long")


def _sets(signed: DataFrame) -> DataFrame:
    """One row per set: ``set_a, set_b, n_shingles, rep, rep_key, first, sketch, node``.

    ``rep`` is the smallest id that has the set, ``rep_key`` the text it has it with.
    """
    one = materialized(
        signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("set_a", "set_b", "n_shingles")
        .agg(F.min(F.struct("doc_id", "text_key", "first", "sketch")).alias("r"))
        .selectExpr("set_a", "set_b", "n_shingles", "r.doc_id AS rep", "r.text_key AS rep_key",
                    "r.first AS first", "r.sketch AS sketch"), "sets")
    several = one.groupBy("rep").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if several.isEmpty():
        return one.withColumn("node", F.col("rep"))
    marked = spread_join(one, several.withColumn("several", F.lit(True)), ["rep"], "n",
                         one.count())
    return materialized(marked.withColumn("node", F.expr(
        "CASE WHEN several THEN xxhash64(rep, set_a, set_b) ELSE rep END")).drop("several"),
        "nodes")


def _smallest_ids(final: DataFrame, sets: DataFrame) -> DataFrame:
    """``node, c``: the smallest id of the node's component."""
    named = materialized(final.join(sets.select("node", "rep"), "node"), "named")
    least = named.groupBy("component").agg(F.min("rep").alias("c"), F.count(F.lit(1)).alias("n"))
    return spread_join(named.select("node", "component"), least, ["component"], "n",
                       named.count()).select("node", "c")


def marked_rows(docs: DataFrame, bands: int = BANDS, large_group: int = LARGE_GROUP) -> DataFrame:
    """``near_duplicates`` with the ``text_key`` of each row."""
    signed = materialized(signatures(docs, bands), "signatures")
    sets = _sets(signed)
    texts = _keyed_texts(docs).dropDuplicates(["doc_id", "text_key"]).selectExpr(
        "doc_id AS rep", "text_key AS rep_key", "text")
    reps = sets.selectExpr("node AS doc_id", "n_shingles", "first", "sketch")
    keyed = reps.select("doc_id", F.explode("first").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    grouped = materialized(
        keyed.join(shared, "key").join(reps.select("doc_id", "n_shingles", "sketch"), "doc_id")
        .select("key", "n", "doc_id", "n_shingles", "sketch"), "groups")
    small = grouped.filter(F.col("n") <= large_group)
    # A band of the second collection is so many bytes of the sketch's second half.
    band = F.expr(f"substring(sketch, {bands * BAND_ROWS} + j * {BAND_ROWS} + 1, {BAND_ROWS})")
    large = (grouped.filter(F.col("n") > large_group)
             .withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))))
             .select(F.xxhash64("key", "j", band).alias("key"), "doc_id", "n_shingles"))
    stars = materialized(_pairs(small).withColumn("near", F.lit(True))
                         .union(_large_star(large)).distinct(), "stars")
    links = materialized(confirmed(stars.filter("near").select("a", "b"), sets, texts),
                         "confirmed")
    parts = components(links)
    cells = materialized(_cells(stars.select("a", "b"), parts, large_group), "cells")
    more = _links_between(cells, sets, texts, SHINGLE)
    linked = parts.selectExpr("node AS a", "component AS b").union(more)
    final = components(linked)
    least = (final.withColumnRenamed("component", "c")
             if sets.filter("node <> rep").isEmpty() else _smallest_ids(final, sets))
    of_set = (sets.select("set_a", "set_b", "n_shingles", "node", "rep")
              .join(least, "node", "left")
              .select("set_a", "set_b", "n_shingles", F.coalesce("c", "rep").alias("c")))
    return (signed.select("doc_id", "n_shingles", "set_a", "set_b", "text_key")
            .join(of_set, ["set_a", "set_b", "n_shingles"], "left")
            .select("doc_id", "n_shingles", F.coalesce("c", "doc_id").alias("component_id"),
                    "text_key")
            .withColumn("kept", F.coalesce(F.expr("doc_id = component_id"), F.lit(False))))


def near_duplicates(docs: DataFrame, bands: int = BANDS, large_group: int = LARGE_GROUP
                    ) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    A document's set holds the distinct 5-word shingles of its whole text,
    A-Z lower-cased; a shorter text has its whole sequence as one shingle; a
    NULL or blank text has the empty set and is linked with nothing.
    Documents with a similarity of 0.75 or more are linked.
    ``component_id`` is the smallest ``doc_id`` reachable over links, and
    ``kept`` marks the document that has that id. Repeated rows get equal
    results; rows of one id with different texts are linked each by its own text.
    A row without an id gets the smallest id that has its set, if any, and links no
    sets. An empty table gives no rows; other columns are not read.
    """
    return marked_rows(docs, bands, large_group).select("doc_id", "n_shingles", "component_id",
                                                        "kept")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their group of near duplicates.

    Rows go by id and text, so another text of a dropped row's id stays. A row without an
    id is never dropped.
    """
    dropped = marked_rows(docs).filter("NOT kept AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias("_dropped"), F.col("text_key").alias("_key")).distinct()
    text = F.coalesce(docs["text"], F.lit("")).cast("binary")
    return docs.join(dropped, (docs["doc_id"] == dropped["_dropped"])
                     & (F.unhex(F.md5(text)) == dropped["_key"]), "left_anti")
