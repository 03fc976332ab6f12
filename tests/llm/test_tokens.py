"""Token counts and packing against the tokenizers' library."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm import packing, token_counts

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(WORDS)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def count(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


PIECES = st.sampled_from(list("abcdesltrvmd '\"!?.,0189\t\n\x0b\x1c\x85 éÉßİΣς²Ⅷ中한😀́‍<|>Z")
                         + ["<|endoftext|>", "'re", "'ll", "don't", "the ", "x" * 600])


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.lists(PIECES, max_size=40).map("".join), min_size=1, max_size=4))
def test_counts_of_any_text(counter, library, texts):
    assert counter.counts(texts).tolist() == count(library, texts)


def test_chunks_do_not_show(counter, library):
    text = ("antidisestablishmentarianism " * 40 + "y" * 3000 + "!?" * 500) * 3
    counts = [counter.counts([text, "", text[:777]]).tolist()]
    for chunk in (1, 7, 64):
        t = counter.transducer
        changes = t.changes
        t.changes = lambda s, c=chunk, f=changes: f(s, c)
        counts.append(counter.counts([text, "", text[:777]]).tolist())
        del t.changes
    assert counts == [count(library, [text, "", text[:777]])] * 4


def test_a_small_state_table_starts_anew(library):
    small = token_counts.Counter(WORDS)
    small.transducer.max_states = 50
    texts = ["several words to fill the table", "other words afterwards", "and more"]
    for t in texts:
        assert small.counts([t]).tolist() == count(library, [t])


def test_token_counts(odd, none, documents, texts, library):
    got = {r["doc_id"]: r for r in token_counts.token_counts(documents, WORDS).collect()}
    ids = sorted(texts)
    assert [got[i]["n_tokens"] for i in ids] == count(library, [texts[i] for i in ids])
    assert all(got[i]["over_limit"] == (got[i]["n_tokens"] > 2048) for i in ids)
    by = {r["doc_id"]: r for r in token_counts.token_counts(odd, WORDS).collect()}
    assert (by[2]["n_bytes"], by[2]["n_tokens"]) == (0, 0)
    assert by[8]["n_bytes"] == 6000 and by[9]["over_limit"]
    assert token_counts.token_counts(odd, WORDS).count() == odd.count()
    assert token_counts.token_counts(none, WORDS).count() == 0


# ---- packing ------------------------------------------------------------
def placed(rows, cap):
    """Lengths of the sequences, after a check that places are gapless."""
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= cap
    return by


def test_pack_round_trip(documents, texts):
    library = Tokenizer.from_file(BYTES)
    rows = packing.pack(documents, BYTES).collect()
    total = 0
    for i, t in texts.items():
        ids = np.array(library.encode(t, add_special_tokens=False).ids + [0], "<u4")
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [(r["start"], r["length"]) for r in own] == packing.cut(ids.size)
        for r in own:
            part = ids[r["start"]:r["start"] + r["length"]]
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
        total += ids.size
    assert len(placed(rows, 2048)) <= 1.02 * total / 2048 + 1


def test_pack_edges(odd, none):
    library = Tokenizer.from_file(BYTES)
    rows = packing.pack(odd, BYTES, cap=64).collect()
    placed(rows, 64)
    assert sum(r["piece"] == 0 for r in rows) == odd.count()
    by = {(r["doc_id"], r["piece"]): r for r in rows}
    assert by[2, 0]["length"] == by[3, 0]["length"] == 1
    n = sum(r["length"] for r in rows if r["doc_id"] == 11)
    assert n == 1 + len(library.encode("don't stop 'til 3.14 €5 中文 \U0001F600 <|endoftext|> it's",
                                       add_special_tokens=False).ids)
    assert packing.pack(none, BYTES).count() == 0


def test_cut():
    assert packing.cut(2048) == [(0, 2048)]
    assert packing.cut(2050) == [(0, 2), (2, 2048)]
    assert packing.cut(4096) == [(0, 2048), (2048, 2048)]


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=25))
def test_plan_uses_every_piece_once(histogram):
    patterns = packing.plan(histogram, 40)
    used = {}
    for p in patterns:
        assert sum(n * k for n, k in p.parts) <= 40 and p.times > 0
        for n, k in p.parts:
            used[n] = used.get(n, 0) + k * p.times
    assert used == histogram


def test_exact_complements_are_found():
    """Pairs and triples that fill up exactly are used before anything else."""
    assert sum(p.times for p in packing.plan({30: 2, 10: 2, 20: 2}, 40)) == 3
    assert sum(p.times for p in packing.plan({25: 1, 7: 1, 6: 1, 2: 1}, 40)) == 1


def test_rows_of_one_id_are_numbered_in_many_parts(spark):
    """Parts of a length's numbering are even though all rows have one id and one text."""
    docs = spark.createDataFrame([(1, "x")] * 400 + [(None, "x")] * 400, "doc_id long, text string")
    table = packing.pieces(docs, BYTES).withColumn("_n", F.monotonically_increasing_id())
    ranked = packing._ranked(table.cache(), 8)
    assert sorted(r["_rank"] for r in ranked.collect()) == list(range(800))
    rows = packing.pack(docs, BYTES).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows) == 800
