"""Exact, near and passage de-duplication against brute force."""

import hashlib
import re

import numpy as np
import pytest

from ledgerlens.llm import exact_dedup, near_dedup, suffix_dedup


# ---- exact --------------------------------------------------------------
def test_exact_duplicates_match_brute_force(documents, texts):
    last, size = {}, {}
    for i, t in texts.items():
        last[t] = max(last.get(t, -1), i)
        size[t] = size.get(t, 0) + 1
    got = {r["doc_id"]: r for r in exact_dedup.exact_duplicates(documents).collect()}
    assert len(got) == len(texts)
    for i, t in texts.items():
        assert (got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) == (
            last[t], size[t], last[t] == i)
        assert got[i]["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_exact_duplicates_edges(odd, none):
    got = exact_dedup.exact_duplicates(odd).collect()
    assert len(got) == odd.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert (by[2]["keep_id"], by[2]["group_size"], by[2]["kept"]) == (3, 3, False)
    assert by[3]["kept"] and by[4]["kept"] and not by[1]["kept"]
    assert by[1]["group_size"] == 3   # with the row without an id
    assert by[12]["group_size"] == 3 and by[12]["kept"] and not by[5]["kept"]
    assert not any(r["kept"] for r in got if r["doc_id"] is None)
    assert exact_dedup.exact_duplicates(none).count() == 0
    assert exact_dedup.drop_exact_duplicates(odd).columns == odd.columns


def test_exact_keeps_the_smallest_when_asked(odd):
    by = {r["doc_id"]: r["keep_id"] for r in exact_dedup.exact_duplicates(odd, "min").collect()}
    assert by[4] == 1 and by[12] == 5
    with pytest.raises(ValueError):
        exact_dedup.exact_duplicates(odd, "first")


def test_same_hash_other_bytes_are_apart(spark, monkeypatch):
    """With a hash that always collides, groups still follow the bytes."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(exact_dedup.F, "md5", lambda c: F.lit("same"))
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string")
    got = {r["doc_id"]: (r["keep_id"], r["group_size"])
           for r in exact_dedup.exact_duplicates(docs).collect()}
    assert got == {1: (3, 2), 2: (2, 1), 3: (3, 2)}


# ---- near ---------------------------------------------------------------
def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def brute_components(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


@pytest.mark.parametrize("large_group", [2000, 2])
def test_near_duplicates_match_brute_force(documents, texts, large_group):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
           for r in near_dedup.near_duplicates(documents, large_group=large_group).collect()}
    assert got == brute_components(texts)


def test_near_duplicates_in_a_chain(spark):
    """Neighbours of a chain are linked, its ends are not; all are one component."""
    words = [f"w{i}" for i in range(160)]
    texts = {i: " ".join(words[6 * i:6 * i + 100]) for i in range(10)}
    texts[50] = " ".join(reversed(words))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
           for r in near_dedup.near_duplicates(docs, large_group=3).collect()}
    assert got == brute_components(texts)
    assert {got[i][1] for i in range(10)} == {0}


def passage_texts():
    """Short texts with a passage, then pairs of longer ones at 0.75 or a little more."""
    passage = " ".join(f"p{i}" for i in range(60))
    texts = {i: passage + " " + " ".join(f"h{i}x{k}" for k in range(12)) for i in range(40)}
    for i in range(40, 80):
        own = [f"d{i}w{k}" for k in range(90)]
        texts[i] = " ".join([passage, *own])
        texts[100 + i] = " ".join([passage, *own[:70], *(f"e{i}y{k}" for k in range(20))])
    return texts


@pytest.mark.parametrize("small_run", [200, 2])
def test_a_table_joins_pairs_that_its_head_does_not_cover(monkeypatch, small_run):
    monkeypatch.setattr(near_dedup, "SMALL_RUN", small_run, raising=False)
    texts = passage_texts()
    doc = np.array(sorted(texts))
    sets = near_dedup.shingle_sets(near_dedup.words(*near_dedup.text_bytes(
        near_dedup.pa.array([texts[i] for i in doc.tolist()]))))
    sketch = np.array([near_dedup.minhashes(s, 224).astype(np.uint8) for s in sets])
    one = np.zeros((doc.size, 1), np.int32)   # the passage's band, which all texts share
    got = near_dedup._star_pairs(one[:, 0], doc, np.array([s.size for s in sets]), one, sketch)
    part = {i: i for i in doc.tolist()}
    for a, b in got.tolist() * 40:
        part[a] = part[b] = min(part[a], part[b])
    assert all(part[i] == part[100 + i] for i in range(40, 80))
    assert len(got) < doc.size


def test_a_large_groups_table_hides_no_pair_behind_its_head(spark):
    rows = spark.createDataFrame([(7, 1, 60), (7, 2, 150), (7, 3, 148), (8, 4, 10), (8, 5, 11)],
                                 "key long, doc_id long, n_shingles long")
    got = {(r["a"], r["b"]): r["near"] for r in near_dedup._large_star(rows).collect()}
    assert got == {(1, 2): False, (1, 3): False, (4, 5): True}


@pytest.mark.parametrize("large_group", [2000, 3])
def test_near_duplicates_behind_a_frequent_passage(spark, large_group):
    texts = passage_texts()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
           for r in near_dedup.near_duplicates(docs, large_group=large_group).collect()}
    assert got == brute_components(texts)


@pytest.mark.parametrize("large_group", [2000, 3])
def test_ids_with_several_texts(spark, large_group):
    """One id with texts of different groups, as a set's smallest id or not, NULL ids beside it."""
    a, b, c = ([f"{x}{k}" for k in range(90)] for x in "abc")
    rows = [(1, " ".join(a)), (5, " ".join(a + ["tail"])), (5, " ".join(b)), (7, " ".join(b[1:])),
            (5, " ".join(c)), (5, " ".join(c + ["more"])), (9, " ".join(c[2:])),
            (None, " ".join(b)), (None, "only here and nowhere else at all"), (6, "x y"),
            (4, " ".join(c + ["less"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    marked = near_dedup.marked_rows(docs, large_group=large_group)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])
                  for r in marked.collect()), key=str)
    assert got == sorted([
        (1, 86, 1, True), (5, 87, 1, False), (5, 86, 5, True), (7, 85, 5, False),
        (5, 86, 4, False), (5, 87, 4, False), (9, 84, 4, False), (None, 86, 5, False),
        (None, 3, None, False), (6, 1, 6, True), (4, 87, 4, True)], key=str)
    left = [tuple(r) for r in near_dedup.drop_near_duplicates(docs).collect()]
    assert sorted(left, key=str) == sorted([rows[0], rows[2], rows[7], rows[8], rows[9], rows[10]],
                                           key=str)


@pytest.mark.parametrize("n", [100, 400, 800])
def test_a_groups_pairs_are_a_forest(n):
    """Near copies that share every table: a pair less than sets, however many tables."""
    rng = np.random.default_rng(n)
    sets = []
    for _ in range(n):
        words = np.arange(200, dtype=np.uint64)
        words[rng.integers(0, 200, 4)] = rng.integers(1000, 1 << 60, 4, dtype=np.uint64)
        sets.append(np.unique(near_dedup.mix(words)))
    sketch = np.array([near_dedup.minhashes(s, 224).astype(np.uint8) for s in sets])
    half = np.ascontiguousarray(sketch[:, 112:]).view(np.int32)
    doc, size = np.arange(n), np.array([s.size for s in sets])
    keys = np.zeros(n, np.int64)
    got = near_dedup._star_pairs(keys, doc, size, half, sketch)
    part = list(range(n))
    for _ in range(n):
        for a, b in got.tolist():
            part[a] = part[b] = min(part[a], part[b])
    assert len(got) == n - 1 and set(part) == {0}


def test_near_duplicates_edges(odd, none):
    got = near_dedup.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[1]["component_id"] == by[4]["component_id"] == by[10]["component_id"] == 1
    assert by[2]["n_shingles"] == by[3]["n_shingles"] == by[6]["n_shingles"] == 0
    assert by[2]["kept"] and by[3]["kept"] and by[6]["kept"]
    assert by[9]["n_shingles"] == 1 and by[9]["component_id"] == 9
    assert by[12]["component_id"] == 5 and not by[12]["kept"]
    assert near_dedup.near_duplicates(none).count() == 0


# ---- passages -----------------------------------------------------------
def brute_repeats(pairs, width=50):
    first, out = {}, {}
    for i, t in sorted(pairs):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - width + 1):
            w = b[k:k + width]
            if first.setdefault(w, i) < i:
                gone[k:k + width] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def repeats(docs, **options):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
            for r in suffix_dedup.remove_repeats(docs, **options).collect()}


@pytest.mark.parametrize("options", [{}, {"hot": 2, "block_bytes": 40_000}])
def test_repeats_match_brute_force(documents, texts, options):
    assert repeats(documents.repartition(3), **options) == brute_repeats(texts.items())


def test_repeats_edges(odd, none):
    got = suffix_dedup.remove_repeats(odd, with_text=True).collect()
    assert len(got) == odd.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[1]["n_removed"] == 0 and by[4]["n_removed"] == by[4]["n_bytes"]
    assert by[7]["n_spans"] == 2 and bytes(by[7]["kept_bytes"]) == b" "
    assert by[8]["n_removed"] == by[9]["n_removed"] == 0   # repeats inside one document stay
    assert by[2]["n_bytes"] == by[3]["n_bytes"] == 0 and by[5]["n_removed"] == 0
    assert by[15]["n_removed"] == 199
    assert all(r["n_removed"] == 0 for r in got if r["doc_id"] is None)
    assert suffix_dedup.remove_repeats(none).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(odd, width=20)


def test_longest_previous_factors():
    """Against every pair of suffixes of a small text."""
    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, 300).astype(np.uint8)
    width = 12
    start = np.arange(data.size - width)
    doc = rng.integers(0, 9, start.size)
    order = suffix_dedup.suffix_order(data, start, doc, width)
    prefix = suffix_dedup.common_prefixes(data, start[order], width)
    got = suffix_dedup.longest_previous_factors(doc[order], prefix, 1)

    def common(a, b):
        k = 0
        while k < width and data[a + k] == data[b + k]:
            k += 1
        return k

    for at, i in enumerate(order.tolist()):
        best = max((common(i, j) for j in range(start.size) if doc[j] < doc[i]), default=0)
        assert got[at] == best
