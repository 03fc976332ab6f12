"""The pipeline's stages against the operators and brute force."""

import corpus_pipeline
from .test_dedup import brute_components

from ledgerlens.llm import exact_dedup

SF = "/root/testdata/sf0.001"


def test_stages(spark, documents, texts, tmp_path):
    docs = documents.withColumnRenamed("source", "source")
    left = dict(texts)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        path = str(tmp_path / name)
        out.write.parquet(path)
        out = spark.read.parquet(path)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == documents.columns
        ids = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert ids <= set(left)
        if name == "exact_dedup":
            last = {}
            for i, t in left.items():
                last[t] = max(i, last.get(t, -1))
            assert ids == set(last.values())
        if name == "minhash_near_dedup":
            assert ids == {i for i, (_, _, kept) in brute_components(left).items() if kept}
        left = {i: left[i] for i in ids}
        docs = out
    assert len(left) > 0.7 * len(set(texts.values()))
    pieces = corpus_pipeline.run(spark, SF)
    assert {r["doc_id"] for r in pieces.collect()} == set(left)


def test_stages_take_odd_tables(spark, odd, none):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "best_fit_packing":
                assert out.columns == docs.columns
            assert out.count() <= (docs.count() if name != "best_fit_packing" else 10 ** 6)


def test_copies_go_and_clean_documents_stay(spark, odd):
    kept = exact_dedup.drop_exact_duplicates(odd)
    ids = [r["doc_id"] for r in kept.collect()]
    assert 13 in ids and 4 in ids and 1 not in ids


def test_copies_go_by_id_and_text(spark):
    """A dropped copy takes no other row of its id along, NULL or not."""
    rows = [(None, "a"), (1, "a"), (None, "unique"), (None, None),
            (5, "b"), (5, "c"), (9, "b"), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [tuple(r) for r in exact_dedup.drop_exact_duplicates(docs).collect()]
    assert sorted(kept, key=str) == sorted(
        [(1, "a"), (None, "unique"), (5, "c"), (9, "b"), (9, "")], key=str)
