"""Hard negatives, WARC archives and the conversation trie against brute force and SQL."""

import base64
import gzip
import hashlib
import io
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import hard_negatives, prefix_trie, queries, warc
from ledgerlens.session import ensure_checkpoint_dir
from tests.llm.conftest import SF
from tests.oracle_compare import compare, duck_connection

LONG = 2 ** 63 - 1


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_warc"])
def test_sql_twin(spark, name):
    ok, message = compare(spark, duck_connection(SF), name, queries.QUERIES[name](spark, SF),
                          queries.ORACLE_SQL[name])
    assert ok, message


# ---- hard negatives ---------------------------------------------------------

def mined(rows):
    """Every pair by whole-number products."""
    part = []
    for i, v, label in rows:
        if label is None or v is None or any(
                x is None or not math.isfinite(256.0 * x) for x in v):
            continue
        if i is not None and i % 7 == 0:
            label = int(math.fmod(label + 1, 10))
        part.append((i, label, [math.floor(256.0 * x) for x in v]))
    out = []

    def order(t):
        return -t[0], t[1] is None, t[1] or 0

    for k, (anchor, label, v) in enumerate(part):
        if anchor is None or anchor % 100:
            continue
        scored = [(max(-LONG, min(LONG, sum(x * y for x, y in zip(v, w)))), i, other)
                  for j, (i, other, w) in enumerate(part) if j != k and len(w) == len(v)]
        negatives = sorted((s for s in scored if s[2] != label), key=order)
        for score, positive, _ in sorted((s for s in scored if s[2] == label), key=order)[:5]:
            found = [s for s in negatives if 30 * score <= 100 * s[0] <= 90 * score][:10]
            out += [(anchor, positive, r, s[1], score, s[0]) for r, s in enumerate(found, 1)]
    return sorted(out, key=str)


def test_hard_negatives_odd_rows(spark):
    """NULLs, NaN, huge components, other lengths, empty vectors, repeated ids, many ties."""
    rnd = np.random.default_rng(3)
    rows = []
    for k in range(500):
        n = int(rnd.choice([3, 3, 3, 0, 2]))
        v = [float(x) for x in np.round(rnd.normal(size=n), 1)]
        if n and k % 50 == 1:
            v[0] = float("nan")
        if n and k % 50 == 2:
            v[0] = None
        if n and k % 40 == 4:
            v = [1e9] * n
        if n and k % 41 == 4:
            v = [3e15] * n
        if n and k % 97 == 5:
            v = [1.7e308] * n
        rows.append((int(rnd.integers(0, 120)) * 50 if k % 9 else None,
                     None if k % 50 == 3 else v, int(rnd.integers(-2, 3)) if k % 30 else None))
    rows += rows[:30]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "vec_id long, embedding array<double>, label int, score string,"
                               " row int").repartition(5)
    got = rows_of(hard_negatives.hard_negatives(df))
    assert got == mined(rows) and len(got) > 1000
    assert hard_negatives.hard_negatives(df.limit(0)).collect() == []


@pytest.mark.parametrize("cells", [(1, 1), (3, 2)])
def test_hard_negatives_on_any_grid(spark, monkeypatch, cells):
    """Clustered vectors, a hot vector, and blocks small enough for several cells."""
    rnd = np.random.default_rng(1)
    centres = rnd.normal(size=(6, 8))
    rows = [(i, [float(x) for x in (centres[0] if i % 3 == 0 else
                                    centres[i % 6] + rnd.normal(size=8) * 0.05)], i % 4)
            for i in range(900)]
    monkeypatch.setattr(hard_negatives, "LEAST_ROWS", 900 // cells[0])
    monkeypatch.setattr(hard_negatives, "ANCHORS", 9 // cells[1] + 1)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert rows_of(hard_negatives.hard_negatives(df)) == mined(rows)


def test_windows_are_passed_over_and_bounds_hold():
    rnd = np.random.default_rng(2)
    centres = rnd.normal(size=(12, 16)) * 3
    v = hard_negatives.quantised(centres[rnd.integers(0, 12, 3000)] + rnd.normal(size=(3000, 16)) * .1)
    norms = np.sqrt((v * v).sum(axis=1))
    angles = hard_negatives._angles(v, norms, hard_negatives.reference_directions(v[:1000]))
    t = pa.table({"row": pa.array(np.arange(3000)), "vec_id": pa.array(np.arange(3000)),
                  "label": pa.array(np.arange(3000) % 2),
                  "v": pa.array([x.tobytes() for x in v]), "norm": pa.array(norms),
                  "angles": pa.array([x.tobytes() for x in angles])})
    block = hard_negatives.Block(t, 16)
    low, high = block.bounds(angles[:50], norms[:50])
    exact = v[:50] @ block.v.T
    for w, (a, b) in enumerate(zip(block.starts, block.ends)):
        assert (exact[:, a:b] >= low[:, w, None]).all() and (exact[:, a:b] <= high[:, w, None]).all()
    scored = []
    fill = block.score
    block.score = lambda s, x, wanted: (scored.append(wanted.sum()), fill(s, x, wanted))
    hard_negatives.positives_in(block, t.slice(0, 50), 16)
    assert sum(scored) < 0.4 * 50 * len(block.starts) / 2


# ---- archives ---------------------------------------------------------------

def archived(rows):
    groups = defaultdict(list)
    for i, _, html in rows:
        groups[(html or "").encode()].append(i)
    out = []
    for i, _, html in rows:
        payload = (html or "").encode()
        ids = [x for x in groups[payload] if x is not None]
        again = bool(ids) and i != max(ids)
        out.append((i, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                    "revisit" if again else "response", max(ids) if again else None))
    return sorted(out, key=str)


PAGES = [(1, "http://a b\r\nX: y", "p"), (2, None, None), (3, "u", ""), (None, "u", "p"),
         (None, "u", "q"), (7, "u", "p"), (7, "v", "p"), (8, "w", "é" * 300000),
         (9, "w", "é" * 300000), (10, "w", "WARC/1.1\r\n\r\n" * 1000), (11, "w", "solo")]


@pytest.fixture(scope="module")
def folder(spark):
    return ensure_checkpoint_dir(spark) + "/archives"


def test_pages_round_trip(spark, folder):
    df = spark.createDataFrame([(*r, "x") for r in PAGES],
                               "page_id long, url string, html string, payload string")
    found = warc.archived(df.repartition(3), folder + "/pages")
    assert [r[:5] for r in rows_of(found)] == archived(PAGES)
    assert found.filter("page_id = 1").first()["url"] == "http://a%20b%0D%0AX:%20y"
    read = warc.read_archives(spark, folder + "/pages")
    texts = {r["record_id"]: bytes(r["payload"]).decode() for r in read.filter(
        "record_type = 'response'").collect()}
    assert texts["urn:page:9"] == "é" * 300000 and texts["urn:page:11"] == "solo"
    assert texts["urn:page:10"] == "WARC/1.1\r\n\r\n" * 1000
    assert warc.archived(df.limit(0), folder + "/none").collect() == []


def test_small_payloads_may_stay_responses(spark, folder):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    kinds = Counter(r["record_type"] for r in warc.deduplicated(df, least_bytes=2).collect())
    assert kinds == {"response": len(PAGES) - 1, "revisit": 1}


def test_header_predicates_reach_the_source(spark, folder):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    warc.write_archives(warc.deduplicated(df), folder + "/pushed")
    read = warc.read_archives(spark, folder + "/pushed", "skip", headers=["WARC-Profile"])
    for condition, n in [("record_type = 'warcinfo'", None), ("refers_to = 'urn:page:7'", 2),
                         ("record_id IN ('urn:page:9', 'urn:page:11')", 2),
                         ("target_uri IS NULL", None), ("`WARC-Profile` LIKE 'http%'", 4),
                         ("record_type = 'response' AND target_uri LIKE 'w%'", 3)]:
        found = read.filter(condition)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: []" not in plan, plan
        assert n is None or found.count() == n, condition
    assert all(r["payload"] is None for r in read.collect())
    assert read.filter("record_type = 'response' AND record_id = 'urn:page:9'").first()[
        "payload_length"] == 600000


def test_foreign_archives(spark, tmp_path):
    """Plain files, members without a stored length, other header case, folded lines."""
    raw = b"".join(
        b"WARC/1.0\r\nwarc-type: resource\r\nWARC-Record-ID: <urn:%d>\r\nX-Note: a\r\n  b\r\n"
        b"Content-Length: %d\r\n\r\n%s\r\n\r\n" % (k, len(p), p)
        for k, p in enumerate([b"one", b"", b"WARC/1.0\r\n" * 9000]))
    (tmp_path / "plain.warc").write_bytes(raw)
    parts = [b"WARC/1.0" + p for p in raw.replace(b"WARC/1.0\r\n" * 9000, b"z" * 90000)
             .split(b"WARC/1.0")[1:]]
    (tmp_path / "packed.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
    read = warc.read_archives(spark, str(tmp_path), headers=["X-Note"])
    got = [(r["record_id"], r["X-Note"], len(r["payload"])) for r in read.collect()]
    assert sorted(got) == sorted(2 * [("urn:0", "a b", 3), ("urn:1", "a b", 0),
                                      ("urn:2", "a b", 90000)])
    assert read.filter("record_id = 'urn:2'").count() == 2
    assert len(gzip.decompress((tmp_path / "packed.warc.gz").read_bytes())) > 90000


def test_unwanted_payloads_are_not_read():
    """Only the wanted record's payload is inflated."""
    file = b"".join(warc.gzip_member(warc.encode_record(
        {"record_type": "resource", "record_id": f"r{k}", "payload": bytes(500_000) + bytes([k])}))
        for k in range(5))
    assert gzip.decompress(file).count(b"WARC/1.1") == 5  # any gzip reader takes them
    inflated = []

    class Counted(warc._Gzip):
        def _more(self):
            more = super()._more()
            inflated.append(more)
            return more

    kept, warc._Gzip = warc._Gzip, Counted
    try:
        reader = io.BufferedReader(io.BytesIO(file))
        got = list(warc.records(reader, lambda r: r["record_id"] == "r3", "read"))
    finally:
        warc._Gzip = kept
    assert [len(r["payload"]) for r in got] == [500_001] and sum(inflated) <= 4 + 3


def test_damaged_payload_is_found():
    member = warc.encode_record({"record_type": "resource", "record_id": "r", "payload": b"abc"})
    reader = io.BufferedReader(io.BytesIO(member.replace(b"\r\nabc", b"\r\nabd")))
    with pytest.raises(ValueError, match="digest"):
        list(warc.records(reader, lambda r: True, "check"))


def test_only_committed_files_are_read(spark, folder):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    warc.write_archives(warc.deduplicated(df), folder + "/commit")
    files, root = warc._open_fs(folder + "/commit")
    with files.open_output_stream(root + "/part-stray.warc.gz", compression=None) as f:
        f.write(warc.gzip_member(warc.encode_record({"record_type": "response", "payload": b"x"})))
    wanted = warc.read_archives(spark, folder + "/commit").filter("record_type <> 'warcinfo'")
    assert wanted.count() == len(PAGES)
    warc.write_archives(warc.deduplicated(df.limit(2)), folder + "/commit", mode="overwrite")
    assert wanted.count() == 2


# ---- trie -------------------------------------------------------------------

def rebuilt(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tid = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            turns[conv].append((turn is not None, turn or 0, role, tid, text))
    turns = {c: [(t[2], t[4]) for t in sorted(v)] for c, v in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = turns.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:]
    return out


def trie(conversations):
    members, below = defaultdict(list), defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for p in members:
        if p:
            below[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in below[p]) or 1
        own = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        saved[p] = own + sum(saved[k] for k in below[p])
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(conversations[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(below[p]),
                    leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


TURNS = "conv_id long, turn long, role string, text string, k string, len string"


def test_trie_of_the_given_conversations(spark):
    got = rows_of(queries.op13_prefix_trie(spark, SF))
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()
    assert got == trie(rebuilt(map(tuple, rows)))


def test_trie_of_odd_conversations(spark):
    """NULLs, ties, repeated rows, long shared and long single conversations, turnless ones."""
    import random
    rnd = random.Random(5)
    rows = []
    for c in [*range(-20, 60), 100, 250, 300, None]:
        kind = rnd.choice([0, 1, 2])
        for t in range(rnd.choice([0, 1, 3, 9, 20, 30])):
            rows.append((c, rnd.choice([t, t, None]), rnd.choice(["u", None]),
                         f"x{kind}{t // 7}" if t < 25 else rnd.choice(["z", None, "é"])))
    for c in range(500, 520):
        rows += [(c, t, "u", "same") for t in range(19 + c % 3)]
    rows += [(777, t, "u", "alone" if t > 3 else "same") for t in range(5000)] + rows[:10]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS).repartition(5)
    assert rows_of(prefix_trie.rebuilt_trie(df)) == trie(rebuilt(rows))
    assert prefix_trie.rebuilt_trie(df.limit(0)).collect() == []


def test_equal_conversations_end_in_one_node(spark, monkeypatch):
    """More members than a run of ids, and hot groups beside small ones."""
    monkeypatch.setattr(prefix_trie, "RUN_BITS", 4)
    rows = [(c, t, "u", f"t{t}") for c in range(0, 3000, 3) for t in range(3)]
    rows += [(c, 0, "u", f"o{c % 40}") for c in range(1, 3000, 30)]
    df = spark.createDataFrame([(*r, None, None) for r in rows], TURNS)
    assert rows_of(prefix_trie.rebuilt_trie(df)) == trie(rebuilt(rows))


def test_a_conversation_may_span_partitions(spark):
    rows = [(5, t, "u", str(t % 7)) for t in range(20000)] + [(6, 1, "u", "a")]
    df = spark.createDataFrame([(*r, None, None) for r in rows], TURNS).repartition(6)
    turns = prefix_trie.numbered_turns(df)
    assert turns.groupBy("conv_id").agg({"pos": "max"}).orderBy("conv_id").collect() == [
        (5, 20000), (6, 1)]
    assert turns.select("conv_id", "pos").distinct().count() == 20001
