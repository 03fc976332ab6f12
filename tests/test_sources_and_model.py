"""Sources, sinks, distributed ranking and the model round trip."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.ranking import global_position
from ledgerlens.operators import merge, model, preprocess
from ledgerlens.plans.catalogue import QUERIES
from ledgerlens.session import ensure_checkpoint_dir, stages
from ledgerlens.sources import raw, tables

from conftest import OPS, SF_SMALL, TAGS, TRANS


def _write_csv(path, header, data):
    with open(path, "w") as f:
        f.write(",".join(header) + "\n")
        for row in data:
            f.write(",".join(row) + "\n")


def test_raw_csv_logs(spark, tmp_path):
    op_cols = raw.OPERATION_COLUMNS
    full_ops = [dict(zip(["uid", "day", "mode", "time"], r)) for r in OPS]
    _write_csv(tmp_path / "ops.csv", op_cols,
               [[r.get(c, "") for c in op_cols] for r in full_ops])
    tr_cols = raw.TRANSACTION_COLUMNS
    names = ["uid", "channel", "day", "time", "trans_amt", "trans_type1", "trans_type2"]
    full_tr = [dict(zip(names, r)) for r in TRANS]
    _write_csv(tmp_path / "trans.csv", tr_cols, [[r.get(c, "") for c in tr_cols] for r in full_tr])
    _write_csv(tmp_path / "tags.csv", raw.LABEL_COLUMNS, [list(t) for t in TAGS])

    ops = raw.read_raw_operations(spark, str(tmp_path / "ops.csv"))
    assert ops.columns == op_cols
    assert ops.filter(F.col("os").isNull()).count() == 0          # NULL -> "" (S2)
    op_base = preprocess.slim_operations(ops)
    assert op_base.count() == 7
    assert op_base.filter(F.col("op_type") == "").count() == 1    # blank type kept
    trans = preprocess.slim_transactions(raw.read_raw_transactions(spark, str(tmp_path / "trans.csv")))
    assert trans.count() == 5
    labels = raw.labels_from_tags(raw.read_raw_labels(spark, str(tmp_path / "tags.csv")))
    assert sorted((r.uid, r.label) for r in labels.collect()) == [
        ("u1", 1.0), ("u2", 0.0), ("u3", 0.0), ("u4", 1.0)]


def test_short_csv_rows_are_padded_with_blanks(spark, tmp_path):
    path = tmp_path / "short.csv"
    path.write_text(",".join(raw.OPERATION_COLUMNS) + "\nu1,3,A\n")
    ops = raw.read_raw_operations(spark, str(path)).collect()
    assert ops[0]["mode"] == "A" and ops[0]["time"] == "" and ops[0]["ip2_sub"] == ""


def test_delimited_round_trip(spark, tmp_path, mini):
    out = str(tmp_path / "ops_text")
    tables.write_delimited(mini["op_base"], out)
    back = tables.read_delimited(spark, out, tables.OP_BASE_SCHEMA)
    cols = ["uid", "op_day", "op_type", "op_time"]
    assert sorted(back.select(cols).collect()) == sorted(mini["op_base"].select(cols).collect())


def test_delimited_text_is_taken_as_it_is(spark, tmp_path):
    rows = [("u1", 3, '"q', "08:00:00"), ("u2", 4, 'a"b\\', ""), ("u3", 5, "", " "),
            ("", 6, "x,y", "'")]
    df = spark.createDataFrame(rows, tables.OP_BASE_SCHEMA)
    out = str(tmp_path / "odd")
    tables.write_delimited(df, out)
    back = tables.read_delimited(spark, out, tables.OP_BASE_SCHEMA)
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


@pytest.mark.parametrize("line", ["u1|zz|A|08:00:00", "u1||A|08:00:00", "u1|3|A", "u1|3|A|b|c"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_lines_raise(spark, line, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        lines = spark.createDataFrame([(line,)], "value string")
        with pytest.raises(Exception, match="not a number|not 4 fields"):
            tables.parse_lines(lines, tables.OP_BASE_SCHEMA).collect()
        with pytest.raises(Exception, match="not a number"):
            raw.labels_from_tags(spark.createDataFrame([("u", "oops")], "uid string, tag string")
                                 ).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_any_feature_table_as_text(spark):
    lines = spark.createDataFrame([("u1|0.5|",), ("u2||3",)], "value string")
    got = merge.parse_delimited(lines, columns=["x", "y"]).collect()
    assert sorted(tuple(r) for r in got) == [("u1", 0.5, 0.0), ("u2", 0.0, 3.0)]
    for bad in ("u1|oops|1", "u1|1|bad"):
        with pytest.raises(Exception, match="not a number"):
            merge.parse_delimited(spark.createDataFrame([(bad,)], "value string"),
                                  columns=["label", "x"]).collect()
    with pytest.raises(Exception, match="not a number"):   # a blank label
        merge.parse_delimited(spark.createDataFrame([("u1||1",)], "value string"),
                              columns=["label", "x"]).collect()


def test_stage_tables_have_an_owner(spark):
    root = Path(ensure_checkpoint_dir(spark).removeprefix("file:")) / "tables"
    before = set(root.glob("*/*")) if root.exists() else set()
    with stages(spark):
        assert QUERIES["user_amount_stats"](spark, SF_SMALL).count() == 15
        assert set(root.glob("*/*")) - before
    assert set(root.glob("*/*")) == before


def test_a_session_without_checkpoint_folder_is_an_error(spark, monkeypatch):
    class Bare:
        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Bare()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_global_position_spreads_and_orders(spark):
    vals = list(range(5000))
    random.Random(3).shuffle(vals)
    df = spark.createDataFrame([(v, f"k{v % 7}") for v in vals], "v long, k string").repartition(9)
    pos = global_position(df, [F.desc("v")], "p")
    got = {r.v: r.p for r in pos.collect()}
    assert got == {v: 5000 - v for v in range(5000)}


def test_model_save_load_same_predictions(spark, tmp_path):
    merged = QUERIES["merged_features"](spark, SF_SMALL)
    fitted = model.train(merged)
    first = model.predict(fitted, merged)
    path = str(tmp_path / "tree")
    model.save_model(fitted, path)
    again = model.predict(model.load_model(path), merged)
    assert sorted(first.collect()) == sorted(again.collect())
    assert model.feature_width() == 38 and model.feature_width(compat=True) == 37
    acc = model.accuracy(first).collect()[0]
    assert 0.0 <= acc["accuracy"] <= 1.0 and acc["n_rows"] == merged.count()
    out = str(tmp_path / "pred")
    tables.write_predictions(first, out)
    lines = spark.read.text(out).collect()
    assert len(lines) == merged.count() and all("," in r.value for r in lines)


def test_parse_delimited_features(spark):
    merged = QUERIES["merged_features"](spark, SF_SMALL)
    parsed = merge.parse_delimited(merge.to_delimited(merged))
    a = {r.uid: r for r in parsed.collect()}
    b = {r.uid: r for r in merged.collect()}
    assert a.keys() == b.keys()
    for uid, r in b.items():
        assert a[uid]["var_amt"] == r["var_amt"] and a[uid]["op_top1"] == float(r["op_top1"])


def test_tree_with_one_class_in_training(spark):
    merged = QUERIES["merged_features"](spark, SF_SMALL)
    only_zero = merged.withColumn("label", F.lit(0.0))
    fitted = model.train(only_zero)
    preds = model.predict(fitted, merged).collect()
    assert {r.prediction for r in preds} == {0}
