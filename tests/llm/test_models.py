"""Learned operators: held-out quality, edge cases, and the parts that have an exact result."""

import math
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from ledgerlens import session
from ledgerlens.llm import (
    decontamination,
    language_id,
    lm_scoring,
    quality,
    toxicity,
)
from ledgerlens.llm.common import text_bytes

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def remainder(i, m):
    return zlib.crc32(("" if i is None else str(i)).encode()) % m


# ---- language -----------------------------------------------------------
def test_language_held_out(documents):
    rows = language_id.fit_and_identify(documents).join(
        documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert held and all(r["held_out"] == (remainder(r["doc_id"], 3) == 1) for r in rows)
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edges(odd, none, documents):
    by = {r["doc_id"]: r for r in language_id.fit_and_identify(odd).collect()}
    assert by[2]["lang_pred"] == by[3]["lang_pred"] == by[6]["lang_pred"] == "und"
    assert by[1]["lang_pred"] == "en" and by[2]["score"] == 0
    assert language_id.fit_and_identify(none).count() == 0
    model = language_id.fit(none)   # nothing learned
    assert {r["lang_pred"] for r in language_id.identify(odd, model).collect()} == {"und"}


def test_language_matches_a_plain_sum():
    """The sparse product equals adding up one n-gram after the other."""
    texts = ["Ab c", "", "ééé 12 xyz"]
    rng = np.random.default_rng(1)
    model = language_id.LanguageModel(
        ["p", "q"], np.log([0.5, 0.5]), rng.normal(size=(2, language_id.BUCKETS)).astype(np.float32))
    model.log_prob[:, 0] = 0
    for t in texts:
        buckets, _, _ = language_id.ngram_buckets([t])
        total = sum(model.log_prob[:, b].sum(axis=1) for b in buckets) + model.log_prior
        name, score = model.predict(["zzz", t, "qq"])
        if any(c.isalpha() for c in t):
            assert name[1] == ["p", "q"][int(total.argmax())]
            assert score[1] == pytest.approx(1 / np.exp(total - total.max()).sum(), rel=1e-4)


# ---- toxicity and quality -----------------------------------------------
@pytest.fixture(scope="module")
def labelled(spark):
    """Invented documents: toxic ones hold words of one of two lexicons, bad ones are junk."""
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(400)]
    lexicons = [[f"vile{c}" for c in "abcdefgh"], [f"merde{c}" for c in "abcdefgh"]]
    docs, labels = [], []
    for i in range(900):
        w = rng.choice(words, 60).tolist()
        toxic, good = int(rng.random() < 0.15), int(rng.random() < 0.8)
        if toxic:
            w[5:5] = rng.choice(lexicons[i % 2], 4).tolist()
        text = " ".join(w if good else [x + "%%%$$" for x in w])
        docs.append((i, text))
        if i % 3:
            labels.append((i, good, toxic))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
            {i: (t, "vile" in t or "merde" in t, "%%%" not in t) for i, t in docs})


def test_toxicity_held_out(labelled):
    docs, labels, truth = labelled
    rows = toxicity.score_documents(docs, labels).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r["held_out"] == (remainder(r["doc_id"], 4) == 2)
        assert r["predicted"] == int(r["score"] >= 0.3)
    wrong = [r["doc_id"] for r in rows if r["predicted"] != truth[r["doc_id"]][1]]
    assert len(wrong) < 0.02 * len(rows)


def test_label_model_finds_two_lexicons_and_ties():
    """Blocks follow the hidden states; a copied voter shares its weight."""
    rng = np.random.default_rng(3)
    n = 40_000
    state = rng.random((n, 2)) < 0.04
    fired = np.concatenate([(rng.random((n, 6)) < 0.4) & state[:, :1],
                            (rng.random((n, 6)) < 0.4) & state[:, 1:]], axis=1)
    fired[:, 5] = fired[:, 4]
    model = toxicity.fit_label_model((fired.T.astype(float) @ fired), n, 12)
    assert sorted(tuple(b.voters) for b in model.blocks) == [tuple(range(6)), tuple(range(6, 12))]
    first = min(model.blocks, key=lambda b: b.voters[0])
    assert first.weight[4] < 0.8 and first.weight[0] > 0.9
    p = model.posterior(fired)
    assert p[fired.sum(axis=1) >= 2].min() > 0.5 and p[~fired.any(axis=1)].max() < 0.1


@pytest.mark.parametrize("fit", [toxicity.score_documents, quality.score_documents])
def test_scores_of_odd_tables(spark, odd, none, labelled, fit):
    _, labels, _ = labelled
    got = fit(odd, labels).collect() if fit is toxicity.score_documents else \
        quality.with_score(odd.select("doc_id", "text"), quality.Network.initial()).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fit(none, empty).count() == 0
    assert all(0 <= r["score"] <= 1 for r in fit(odd, empty).collect())


def test_quality_held_out(labelled):
    docs, labels, truth = labelled
    net = quality.fit(docs, labels, steps=80)
    rows = quality.with_score(docs, net).collect()
    held = [r for r in rows if remainder(r["doc_id"], 4) == 2]
    assert np.mean([(r["score"] >= 0.7) == truth[r["doc_id"]][2] for r in held]) > 0.95


def test_quality_gradients():
    """Against finite differences."""
    net = quality.Network.initial(1)
    for name in ("embedding", "filters", "offset", "output"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    texts = pa.array(["some text, long enough " * 30, "short", "other words here " * 9])
    layout = quality.lay_out(*text_bytes(texts))
    label = np.array([1.0, 0.0, 1.0])

    def loss():
        p = net.score(*text_bytes(texts))
        return -np.mean(label * np.log(p) + (1 - label) * np.log(1 - p))

    grads = quality._gradients(net, layout, label)
    for name, grad, at in (("filters", grads[1], (5, 3)), ("output", grads[3], (40,)),
                           ("embedding", grads[0], (ord("e"), 2)), ("offset", grads[2], (7,))):
        field = getattr(net, name)
        before = field[at]
        field[at] = before + 1e-5
        up = loss()
        field[at] = before - 1e-5
        down = loss()
        field[at] = before
        assert grad[at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-7)


def test_quality_chunks_cover_long_texts():
    raw, offsets = text_bytes(pa.array(["a" * 5000, "", "b"]))
    t = quality.lay_out(raw, offsets)
    for k, n in ((0, 1250), (1, 1), (2, 1)):
        own = t.text == k
        seen = {w for a, b in zip(t.first[own], t.last[own]) for w in range(a, b)}
        assert len(seen) == n


# ---- decontamination ----------------------------------------------------
def test_decontamination(documents, texts, spark):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = {r["item_id"]: r["text"] for r in benchmark.collect()}

    def flat(t):
        return " " + " ".join(re.findall(r"[a-z\x80-\U0010ffff]+", t.lower())) + " "

    holds = {i: {k for k, b in items.items() if flat(b) in flat(t)} for i, t in texts.items()}
    assert any(holds.values())
    got = {r["doc_id"]: r for r in decontamination.decontaminate(documents, benchmark).collect()}
    assert len(got) == len(texts)
    for i, r in got.items():
        assert holds[i] <= set(r["item_ids"])
        assert r["contaminated"] == bool(r["item_ids"]) != r["kept"]
    extra = sum(len(set(r["item_ids"]) - holds[i]) for i, r in got.items())
    assert extra <= 1


def test_paraphrases_need_their_answer(spark):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("klmnoprst"), 6)) for _ in range(3000)]
    item = rng.choice(words, 40, replace=False).tolist()
    changed = [w if k % 3 or k >= 32 else "other" for k, w in enumerate(item)]
    without = changed[:32] + ["nothing"] * 8
    docs = [(i, " ".join(rng.choice(words, 200))) for i in range(60)]
    pad = rng.choice(words, 50).tolist()
    docs += [(100, " ".join(pad + item + pad)), (101, " ".join(pad + changed + pad)),
             (102, " ".join(pad + without[:24] + pad)), (103, None)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(item)), (8, None), (9, "")],
                                  "item_id long, text string")
    found = {r["doc_id"] for r in decontamination.decontaminate(docs, bench).collect()
             if r["contaminated"]}
    assert found == {100, 101}


def brute_matches(text, items):
    """The acceptance rule on every window, without any candidates."""
    h = decontamination.words(*text_bytes(pa.array([text])), decontamination.WORD).hashes
    out = set()
    for i, w in zip(items.ids, items.words):
        width = decontamination.length_class(w.size)
        hop = width // 3
        for at in range(0, h.size, hop):
            near = set(h[max(0, at - hop):at + width + hop].tolist())
            if sum(x in near for x in w.tolist()) >= decontamination.PARAPHRASE * w.size:
                region = h[max(0, at - 2 * hop):at + width + 2 * hop]
                if decontamination.share_found(w, region):
                    out.add(i)
    return out


def paraphrases(rng, words, lists, share, pad_words):
    """A text for each list that keeps this share of its words, the answer among them."""
    texts = []
    for w in lists:
        answer = max(4, len(w) // 5)
        kept = max(0, int(np.ceil(share * len(w))) - answer)
        held = set(rng.choice(len(w) - answer, kept, replace=False).tolist())
        spread = [x if k in held or k >= len(w) - answer else str(rng.choice(words))
                  for k, x in enumerate(w)]
        pad = rng.choice(pad_words, 80).tolist()
        texts.append(" ".join(pad[:int(rng.integers(0, 60))] + spread + pad[60:]))
    return texts


def as_items(lists, project):
    return decontamination.prepare_items(
        [{"item_id": k, "text": " ".join(w)} for k, w in enumerate(lists)],
        np.ascontiguousarray(project, np.float32))


def test_exact_search_needs_no_cosine():
    """Items just above a class edge, of which the text has half and the answer, spread out."""
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("klmnoprst"), 6)) for _ in range(3000)]
    often = words + ["the"] * 800
    lists = [rng.choice(often, n).tolist() for n in (9, 13, 19, 20, 28, 29, 41, 42, 62) * 4]
    texts = paraphrases(rng, words, lists, 0.5, often)
    for project in (np.zeros((2, decontamination.BUCKETS)),
                    rng.normal(size=(64, decontamination.BUCKETS)) / 8):
        items = as_items(lists, project)
        got = decontamination.matches(pa.array(texts), items, exact=True)
        want = [brute_matches(t, items) for t in texts]
        assert [set(m) for m in got] == want
        assert sum(k in m for k, m in enumerate(want)) > 30


def test_recall_by_share_and_use_of_the_projection(documents, texts):
    """The latent cosine finds nine in ten of what the rule accepts, at every share kept."""
    found = re.findall(r"[a-z]+", " ".join(t.lower() for t in texts.values()))
    rng = np.random.default_rng(5)
    at = rng.integers(0, len(found) - 60, 120)
    lists = [found[a:a + n] for a, n in zip(at, rng.integers(15, 60, at.size).tolist())]
    items = as_items(lists, decontamination.fit(documents))
    blind = as_items(lists, np.zeros((4, decontamination.BUCKETS)))
    for share in (0.5, 0.6, 0.7, 0.8, 0.9, 1.0):
        batch = pa.array(paraphrases(rng, found, lists, share, found))
        got = decontamination.matches(batch, items)
        want = decontamination.matches(batch, items, exact=True)
        assert all(set(g) <= set(w) for g, w in zip(got, want))
        total = sum(len(w) for w in want)
        assert total >= 110 and sum(len(g) for g in got) >= 0.9 * total
        assert not any(decontamination.matches(batch, blind))


def test_sums_of_many_parts_are_added_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "FAN_IN", 3)
    rows = [(b, p, np.array([1.0 * b, p]).tobytes()) for b in range(2) for p in range(20)]
    table = spark.createDataFrame(rows, "block int, part int, payload binary")
    got = decontamination._added(table, 20)
    assert {b: x.tolist() for b, x in got.items()} == {0: [0, 190], 1: [20, 190]}


def test_numbers_are_words(spark):
    """An item of numbers is found, and a numeric answer is checked."""
    rng = np.random.default_rng(6)
    numbers = [str(x) for x in rng.integers(1000, 9999, 20)]
    asked = ["".join(rng.choice(list("klmnoprst"), 6)) for _ in range(16)]
    told = [w if k % 2 else "other" for k, w in enumerate(asked)]
    pad = ["".join(rng.choice(list("abcdefghi"), 6)) for _ in range(40)]
    docs = spark.createDataFrame(
        [(1, " ".join(pad + numbers + pad)), (2, " ".join(pad + told + numbers[:4] + pad)),
         (3, " ".join(pad + told + ["1", "2", "3", "4"] + pad)), (4, " ".join(pad))],
        "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(numbers)), (8, " ".join(asked + numbers[:4]))],
                                  "item_id long, text string")
    got = {r["doc_id"]: r["item_ids"] for r in decontamination.decontaminate(docs, bench).collect()}
    assert got == {1: [7], 2: [8], 3: [], 4: []}


def test_decontamination_edges(odd, none, spark):
    bench = spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog while nine wise")],
                                  "item_id long, text string")
    got = decontamination.decontaminate(odd, bench).collect()
    assert len(got) == odd.count()
    assert {r["doc_id"] for r in got if r["contaminated"]} >= {1, 4, 7}
    assert not any(r["contaminated"] for r in got if r["doc_id"] in (2, 3, 5, 6, 8))
    assert decontamination.decontaminate(none, bench).count() == 0
    assert not any(r["contaminated"] for r in
                   decontamination.decontaminate(odd, bench.limit(0)).collect())


def test_common_subsequence():
    rng = np.random.default_rng(5)
    for _ in range(40):
        a, b = rng.integers(0, 6, rng.integers(1, 90)), rng.integers(0, 6, rng.integers(0, 90))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for k, y in enumerate(b):
                new.append(row[k] + 1 if x == y else max(row[k + 1], new[k]))
            row = new
        assert decontamination.common_subsequence(a, b.tolist()) == row[-1]


# ---- language model -----------------------------------------------------
def brute_base(texts):
    tokens = {i: re.findall(r"[^\x20\x09-\x0D]+",
                            re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]
              for i, t in texts.items()}
    counts = {}
    for i, w in tokens.items():
        if remainder(i, 5) != 1:
            for x in w:
                counts[x] = counts.get(x, 0) + 1
    n, v = sum(counts.values()), len(counts)
    return {i: (len(w), sum(x in counts for x in w), n,
                sum(math.log10((counts.get(x, 0) + 0.5) / (n + 0.5 * (v + 1))) for x in w))
            for i, w in tokens.items()}


def test_lm_scores(documents, texts):
    rows = lm_scoring.score_documents(documents.repartition(3), BYTES, block_bytes=60_000).collect()
    base = brute_base(texts)
    assert len(rows) == len(texts)
    for r in rows:
        n, known, total, score = base[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(score, rel=1e-9)
        assert r["score"] < 0 and r["held_out"] == (remainder(r["doc_id"], 5) == 1)


def test_lm_edges(odd, none):
    rows = lm_scoring.score_documents(odd, BYTES).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["n_tokens"] == by[3]["n_tokens"] == by[6]["n_tokens"] == 1
    assert by[2]["score"] == pytest.approx(by[6]["score"])
    assert lm_scoring.score_documents(none, BYTES).count() == 0


def test_lm_documents_are_encoded_in_one_python_step(spark, documents, monkeypatch):
    """A step more is a worker more on each core, and those stay with the executor. Blocks
    are read a few at a time wherever they are read."""
    plans, sizes = {}, {}
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        sizes[name] = spark.conf.get(key, None)
        return materialized(df, name)

    materialized = lm_scoring.materialized
    monkeypatch.setattr(lm_scoring, "materialized", kept)
    lm_scoring.score_documents(documents.limit(40), BYTES)
    assert plans["encoded"].count("MapInArrow") == 1 and sizes["encoded"] == before
    assert sizes["word_counts"] == sizes["base_scores"] == sizes["model_scores"] == str(4 << 20)
    assert spark.conf.get(key, None) == before
    docs = documents.repartition(2, "doc_id")
    two = lm_scoring.encoded_blocks(lm_scoring.packed(docs, 60_000), BYTES, 5, 1)
    one = lm_scoring.encoded_documents(docs, BYTES, 5, 1, 60_000)
    assert sorted(one.collect()) == sorted(two.collect())


def test_large_rows_come_a_few_at_a_time(spark, tmp_path):
    rows = spark.range(24).selectExpr("id", "cast(repeat('x', 1 << 20) as binary) as payload")
    rows.coalesce(1).write.parquet(str(tmp_path / "rows"))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    def met():
        read = spark.read.parquet(str(tmp_path / "rows")).coalesce(1)
        return [r["n"] for r in read.mapInArrow(run, "n long").collect()]

    assert met() == [24]
    with session.large_rows(spark):
        few = met()
    assert sum(few) == 24 and max(few) <= 5
    assert met() == [24]


@pytest.fixture(scope="module")
def small_model():
    rng = np.random.default_rng(6)
    # An alternating language: an id's class tells the next one.
    ids = np.stack([rng.integers(0, 40, 4000), rng.integers(40, 80, 4000)], 1).ravel()
    offsets = np.arange(0, 8001, 100)
    counts = np.bincount(ids, minlength=101)
    counts[100] = 80
    return lm_scoring.train(counts, ids, offsets, steps=150), ids, offsets, counts


def test_lm_learns_what_stands_before(small_model):
    model, ids, offsets, counts = small_model
    got = model.log_probabilities(ids[:1000], offsets[:11]).mean()
    unigram = np.log((counts + 1e-9) / counts.sum())[ids[:1000]].mean()
    assert got > unigram + 0.4


def test_lm_is_causal_and_scores_once(small_model):
    model, ids, _, _ = small_model
    text = ids[:90]
    whole = model.log_probabilities(text, np.array([0, 90]))
    cut = model.log_probabilities(text[:60], np.array([0, 60]))
    assert np.allclose(whole[:60], cut, atol=1e-4)
    two = model.log_probabilities(np.concatenate([text, text]), np.array([0, 90, 180]))
    assert np.allclose(two[:90], two[90:], atol=1e-4)


def test_lm_probabilities_add_up(small_model):
    """Over all ids that can follow, probabilities sum to one."""
    model, ids, _, counts = small_model
    total = 0.0
    for i in range(counts.size):
        total += np.exp(model.log_probabilities(np.append(ids[:30], i), np.array([0, 31]))[-1])
    # Classes without ids keep a little of the mass.
    assert 0.8 < total <= 1.0001


def test_lm_gradients(small_model):
    model, ids, offsets, _ = small_model
    m = lm_scoring.Attention(model.class_of, model.inside,
                             {k: v.astype(np.float64) for k, v in model.weights.items()}, model.own)
    x, at, used = lm_scoring._windows(
        ids[:230], lm_scoring._window_starts(np.array([0, 100, 100, 230])), slice(None), 101)
    y = m.class_of[ids[at]]

    def loss():
        state, _ = m.forward(x)
        state, target = state[used], y[used]
        w = m.weights
        group = state @ w["group"] + w["group_bias"]
        lm = lm_scoring
        own = np.einsum("nw,nwm->nm", state, w["member"][target // lm.MEMBERS])
        own += w["member_bias"][target // lm.MEMBERS]

        def log_softmax(z):
            z = z - z.max(axis=1, keepdims=True)
            return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

        n = np.arange(target.size)
        return -(log_softmax(group)[n, target // lm.MEMBERS]
                 + log_softmax(own)[n, target % lm.MEMBERS]).mean()

    grads = m.gradients(x, y, used)
    c, g = m.class_of[x[0, 12]], y[0, 3] // lm_scoring.MEMBERS
    for name, at in (("qkv", (3, 5)), ("qkv", (4, 20)), ("qkv", (2, 40)), ("mixed", (1, 2)),
                     ("hidden", (3, 3)), ("place", (10, 4)), ("embed", (c, 5)),
                     ("group", (2, g)), ("member", (g, 3, 1)), ("hidden_bias", (6,))):
        w = m.weights[name]
        before = w[at]
        w[at] = before + 1e-7
        up = loss()
        w[at] = before - 1e-7
        down = loss()
        w[at] = before
        assert grads[name][at] == pytest.approx((up - down) / 2e-7, rel=5e-3, abs=1e-6)


def test_all_of_every_training_text_is_trained_on(spark):
    """Neighbours and positions of whole training texts, however many and long; none held out."""
    texts = {i: f"red blue {i} " * (3 + i) for i in range(60)}
    texts[100] = "green yellow " * 9000
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    blocks = lm_scoring.packed(docs.repartition(3), 4000)
    encoded = lm_scoring.materialized(
        lm_scoring.encoded_blocks(blocks, BYTES, 5, 1), "encoded").cache()
    size = lm_scoring._encoder(BYTES).library.get_vocab_size(with_added_tokens=True)
    rows = [lm_scoring._training(r.asDict(), size) for r in encoded.collect()]
    counts = lm_scoring.id_counts(encoded, size)
    assert counts.sum() == sum(ids.size for ids, _ in rows)
    want = sum(lm_scoring.neighbours(counts, ids[a:b]) for ids, at in rows
               for a, b in zip(at[:-1], at[1:]) if b - a > 1)
    beside = lm_scoring.corpus_neighbours(encoded, counts)
    assert (beside == want).all()
    few = rows[0][0][:50]
    start = lm_scoring.train(counts, few, np.array([0, few.size]), steps=2, beside=beside)
    got, positions = lm_scoring.train_on_all(encoded, start)
    assert positions == counts.sum() > 18000
    assert all(np.isfinite(w).all() for w in got.weights.values())

    def loss(m):
        return -np.mean(np.concatenate([m.log_probabilities(i, at) for i, at in rows if i.size]))

    assert loss(got) < loss(start)


def test_lm_words_are_encoded_like_texts():
    """The ids of words one by one are those of the text with single spaces."""
    encoder = lm_scoring._encoder(BYTES)
    text = ("it's 12ab don't, naïve straße русский 漢字 \x01x a\u00a0b e\u0301 !!! ''s "
            + "z" * 3000 + " it's it's \U0001f600\U0001f600 x")
    for extra in ("", " a<|endoftext|>b <|endoftext|> c"):
        raw = np.frombuffer((text + extra).encode(), np.uint8)
        found = lm_scoring.words(raw, np.array([0, raw.size]))
        got, n = lm_scoring.word_ids(encoder, found, np.arange(found.starts.size))
        want = [encoder.library.encode(" " + w, add_special_tokens=False).ids
                for w in (text + extra).split(" ")]
        assert n.tolist() == [len(w) for w in want]
        assert got.tolist() == [i for w in want for i in w]


def test_lm_score_by_plain_attention(small_model):
    """Position by position, with loops and float64, from the formulas alone."""
    model, ids, _, _ = small_model
    lm, w = lm_scoring, {k: v.astype(float) for k, v in model.weights.items()}
    text = [int(i) for i in ids[:61]]
    want = []
    for at, target in enumerate(text):
        first = at // lm.HOP * lm.HOP - lm.CONTEXT - 1     # the window's first position
        seen = range(first, at)
        e = []
        for place, p in enumerate(seen):
            i = text[p] if p >= 0 else model.class_of.size
            c = model.class_of[i] if p >= 0 else lm.CLASSES
            e.append(w["embed"][c] + model.own[i] + w["place"][place])
        q, k, v = (w["qkv"][:, j * lm.WIDTH:(j + 1) * lm.WIDTH] for j in range(3))
        weight = np.array([np.exp((e[-1] @ q) @ (x @ k) / lm.WIDTH ** 0.5) for x in e])
        a = sum(s * (x @ v) for s, x in zip(weight / weight.sum(), e))
        h = e[-1] + a @ w["mixed"]
        state = h + np.maximum(h @ w["hidden"] + w["hidden_bias"], 0)
        g, m = divmod(int(model.class_of[target]), lm.MEMBERS)
        groups = np.exp(state @ w["group"] + w["group_bias"])
        members = np.exp(state @ w["member"][g] + w["member_bias"][g])
        want.append(np.log(groups[g] / groups.sum()) + np.log(members[m] / members.sum())
                    + model.inside[target])
    got = model.log_probabilities(np.array(text), np.array([0, len(text)]))
    assert np.allclose(got, want, atol=1e-4)
