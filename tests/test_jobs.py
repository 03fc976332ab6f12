"""The file-based jobs end to end on the sf0.01 tables (enough users for a held-out part)."""

from ledgerlens.plans.catalogue import QUERIES
from ledgerlens.plans.jobs import Layout, fit_pipeline, score_pipeline
from ledgerlens.sources import testdata as td

from conftest import SF_ORACLE as SF


def test_fit_then_score(spark, tmp_path):
    events = td.table(spark, SF, "events")
    ops, trans = td.operations_from_events(events), td.transactions_from_events(events)
    tags = td.tags_from_customer(td.table(spark, SF, "customer"))
    train_out, score_out = Layout(str(tmp_path / "train")), Layout(str(tmp_path / "score"))
    model_path = str(tmp_path / "model")
    acc = fit_pipeline(spark, ops, trans, tags, train_out, model_path)
    assert 0.0 <= acc <= 1.0

    merged = spark.read.parquet(train_out("merged_features"))
    expected = QUERIES["merged_features"](spark, SF)
    assert sorted(merged.collect()) == sorted(expected.collect())
    text = spark.read.text(train_out("related_action_text")).collect()
    assert text and all(r.value.count("|") == 1 and "[(" in r.value for r in text)

    preds = str(tmp_path / "predictions")
    score_pipeline(spark, ops, trans, train_out, score_out, model_path, preds, how="left")
    lines = spark.read.text(preds).collect()
    users = {r.uid for r in spark.read.parquet(score_out("labels")).collect()}
    assert {line.value.split(",")[0] for line in lines} == users
    assert {line.value.split(",")[1] for line in lines} <= {"0", "1"}


def test_preprocess_text_copies_and_default_labels(spark, mini, tmp_path):
    from ledgerlens.plans.jobs import preprocess_job

    out = Layout(str(tmp_path / "pre"))
    preprocess_job(spark, mini["raw_ops"], mini["raw_trans"], None, out, text_copies=True)
    lines = sorted(r.value for r in spark.read.text(out("operation_log")).collect())
    assert len(lines) == 8 and "u2|11||13:00:00" in lines       # raw copy keeps duplicates, blanks
    assert spark.read.parquet(out("op_base")).count() == 7
    labels = sorted((r.uid, r.label) for r in spark.read.parquet(out("labels")).collect())
    assert labels == [("u1", 0.0), ("u2", 0.0), ("u3", 0.0), ("u4", 0.0)]
    tags = spark.createDataFrame([("u1", "1"), ("u2", "0")], "uid string, tag string")
    preprocess_job(spark, mini["raw_ops"], mini["raw_trans"], tags, out, text_copies=True)
    assert {r.value for r in spark.read.text(out("tag_log")).collect()} == {"u1|1", "u2|0"}


def test_scoring_a_log_with_a_new_type(spark, mini, tmp_path):
    import pytest

    from ledgerlens.plans.jobs import feature_job, preprocess_job

    fit = Layout(str(tmp_path / "fit"), ordered=True)
    tags = spark.createDataFrame([("u1", "1"), ("u2", "0")], "uid string, tag string")
    preprocess_job(spark, mini["raw_ops"], mini["raw_trans"], tags, fit)
    feature_job(spark, fit)
    rates = [(r.a1, r.rn) for r in spark.read.parquet(fit("risky_related_action")).collect()]
    assert rates == sorted(rates)
    counts = {r.type: r.cnt for r in spark.read.parquet(fit("op_type_count")).collect()}
    assert counts == {"A": 3, "B": 2, "": 1, "C": 1}
    new = mini["raw_ops"].union(spark.createDataFrame(
        [("u1", "4", "NEW", "10:00:00")], mini["raw_ops"].schema))
    score = Layout(str(tmp_path / "score"))
    preprocess_job(spark, new, mini["raw_trans"], None, score)
    with pytest.raises(Exception, match="type without id: NEW"):
        feature_job(spark, score, index_from=fit, eda=False)
    feature_job(spark, score, index_from=fit, eda=False, unknown="zero")
    ids = {r.type_id for r in spark.read.parquet(score("action_keys")).collect()}
    assert "0" in ids
    feature_job(spark, score, index_from=fit, eda=False, unknown="drop")
    ids = {r.type_id for r in spark.read.parquet(score("action_keys")).collect()}
    assert "0" not in ids
