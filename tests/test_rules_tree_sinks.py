"""Rows without user, day or time; heavy days; learned rules; the tree as tables; sinks."""

import contextlib
import io
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.ranking import before_each
from ledgerlens.operators import features, merge, model, preprocess, rules, sequences, stats, tree
from ledgerlens.plans.catalogue import Inputs
from ledgerlens.session import release_stages, stages
from ledgerlens.sources import raw, tables

from conftest import SF_ORACLE, SF_SMALL


# ---- rows without a user, day or time -----------------------------------------

def test_missing_text_is_blank_in_the_slim_logs(spark):
    ops = spark.createDataFrame([(None, 1, None, None), ("u", 1, "A", "08:00:00")],
                                "uid string, day int, mode string, time string")
    assert sorted(map(tuple, preprocess.slim_operations(ops).collect())) == [
        ("", 1, "", ""), ("u", 1, "A", "08:00:00")]
    trans = spark.createDataFrame(
        [(None, None, 2, None, 5.0, None, None)],
        "uid string, channel string, day int, time string, trans_amt double,"
        " trans_type1 string, trans_type2 string")
    assert [tuple(r) for r in preprocess.slim_transactions(trans).collect()] == [
        ("", "", 2, 5.0, "", "", "")]


def plain_sequences(events):
    """Positions and tokens of each user-day by sorting; NULL first."""
    days, pos, toks = {}, Counter(), Counter()
    for e in events:
        days.setdefault(e[:2], []).append(e[2:])
    for day, acts in days.items():
        acts.sort(key=lambda a: (a[0] is not None, a[0] or "", a[1], a[2]))
        for at, a in enumerate(acts, 1):
            pos[(*day, *a, at)] += 1
        s = [a[2] for a in acts]
        for i in range(len(s) - 1):
            if s[i] != s[i + 1]:
                toks[(*day, f"{s[i]}-{s[i + 1]}")] += 1
            elif i == len(s) - 2:
                toks[(*day, s[i])] += 1
        if len(s) == 1:
            toks[(*day, s[0])] += 1
    return pos, toks


@pytest.mark.parametrize("cut", ["all", "some", "none"])
def test_sequences_keep_null_keys_on_every_plan(spark, cut):
    """NULL uid, day and time, ties and repeats; every day, some days or no day cut into hours."""
    rnd = random.Random(11)
    events = [(rnd.choice(["a", "b", None]), rnd.choice([1, 2, None]),
               rnd.choice([None, *(f"{h:02d}:{m:02d}:00" for h in (0, 1, 7, 23) for m in (0, 5))]),
               rnd.randint(0, 1), rnd.choice(["001", "002", "103"])) for _ in range(600)]
    events += [("once", 1, None, 0, "001"), ("twice", 1, "05:00:00", 0, "001"),
               ("twice", 1, "06:00:00", 0, "001")]
    df = spark.createDataFrame(events, "uid string, day int, time string, src int, type_id string")
    keyed = sequences.keyed_actions(df)
    heavy = None
    if cut != "all":
        ops = df.selectExpr("uid", "day AS op_day")
        none = spark.createDataFrame([], "uid string, trans_day int")
        heavy = sequences.heavy_days(ops, none, limit=60 if cut == "some" else 10 ** 9)
        n_heavy = heavy.count()
        assert (0 < n_heavy < 11) if cut == "some" else n_heavy == 0
    pos, toks = plain_sequences(events)
    got = Counter()
    for r in sequences.daily_sequences(keyed, heavy).collect():
        for k in range(r.mult):
            got[(r.uid, r.day, r.time, r.src, r.type_id, r.pos + k)] += 1
    assert got == pos
    found = Counter()
    for r in sequences.action_tokens(keyed, heavy).collect():
        found[(r.uid, r.day, r.tok)] += r.n
    assert found == toks
    sizes = Counter((e[0], e[1]) for e in events)
    long = Counter((r.uid, r.day) for r in sequences.long_days(keyed, 40, heavy=heavy).collect()
                   for _ in range(r.mult))
    assert long == {d: n for d, n in sizes.items() if n > 40}


def test_heavy_days_from_a_known_row_count_need_no_count(spark):
    ops = spark.createDataFrame([("u", 1)] * 5, "uid string, op_day int")
    trans = spark.createDataFrame([("u", 1)], "uid string, trans_day int")
    assert sequences.heavy_days(ops, trans, limit=5).collect() == [("u", 1)]
    assert sequences.heavy_days(ops, trans, limit=6).collect() == []
    assert sequences.heavy_days(ops, trans, limit=6, rows=6).rdd.getNumPartitions() == 0


def test_amounts_days_and_hours_of_rows_without_a_user(spark):
    trans = spark.createDataFrame([(None, 5.0), (None, 150.0), ("u", 1.0)],
                                  "uid string, trans_amt double")
    got = {r.uid: (r.min_amt, r.max_amt, r.mid_amt) for r in stats.amount_stats(trans).collect()}
    assert got == {"": (5.0, 150.0, 77.5), "u": (1.0, 1.0, 1.0)}
    numbered = trans.selectExpr("CASE WHEN uid IS NOT NULL THEN 7 END AS uid", "trans_amt")
    assert {r.uid: r.mid_amt for r in stats.amount_stats(numbered).collect()} == {
        None: 77.5, 7: 1.0}
    ops = spark.createDataFrame([(None, 3, "08:00:00")], "uid string, op_day int, op_time string")
    log = spark.createDataFrame([(None, 5, None)],
                                "uid string, trans_day int, trans_time string")
    for f in (features.action_days, features.action_hours, features.user_time_profile):
        rows = f(ops, log).collect()
        assert len(rows) == 1 and rows[0].uid == ""
    row = features.action_hours(ops, log).first()
    assert row.op_hour_span == 1 and row.trans_hour_span is None and row.trans_night_rate == 0.0


@pytest.mark.parametrize("f", [stats.amount_range, stats.user_amount_range, stats.amount_stats])
def test_nan_amounts_raise(spark, f):
    df = spark.createDataFrame([("u", float("nan")), ("u", 5.0)], "uid string, trans_amt double")
    with pytest.raises(Exception, match="amount is missing"):
        f(df).collect()


# ---- running values over range partitions ---------------------------------------

def test_before_each_crosses_partitions(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice(["hot", "hot", "hot", "x", None]), i, rnd.randint(-9, 9))
            for i in range(800)]
    df = spark.createDataFrame(rows, "k string, i int, v int").repartition(7)
    got = {r.i: (r.s, r.lo, r.hi) for r in before_each(
        df, ["k"], ["i"], {"s": "sum(v)", "lo": "min(v)", "hi": "max(v)"}).collect()}
    past = {}
    for k, i, v in rows:
        p = past.setdefault(k, [])
        assert got[i] == ((sum(p), min(p), max(p)) if p else (None, None, None))
        p.append(v)


# ---- learned rules ----------------------------------------------------------------

RANK = "uid string, tok string, a1 string, a2 string, cnt long"


def ranked(spark, pairs):
    return spark.createDataFrame([(u, "-", a, b, n) for u, a, b, n in pairs], RANK)


def test_learned_rules_find_the_planted_pair(spark):
    pairs, labels = [], []
    for k in range(200):
        risky = k % 4 == 0
        labels.append((f"u{k}", 1.0 if risky else 0.0))
        pairs.append((f"u{k}", "001", "002", 3))
        if risky or k % 10 == 1:
            pairs.append((f"u{k}", "005", "006", 2))
        if k % 3 == 0:
            pairs.append((f"u{k}", "007", "008", 1))
    labels.append(("silent", 1.0))
    rank, lbl = ranked(spark, pairs), spark.createDataFrame(labels, "uid string, label double")
    learned = rules.learned_rules(rank, lbl)
    (row,) = learned.collect()
    assert (row.a1, row.a2, row.n_risky, row.risky_users, row.safe_users) == (
        "005", "006", 50, 50, 150)
    a, b, c, d = 50, row.n_safe, 0, 150 - row.n_safe
    assert row.chi2 == pytest.approx(200 * (a * d - b * c) ** 2 / ((a + b) * (c + d) * 50 * 150))
    found = rules.rules_from(learned)
    assert found.flag1 == rules.FollowRule("005", ("006",)) and found.flag2.followers == ()
    flags = {r.uid: (r.flag1, r.flag2) for r in rules.risk_flags(rank, found).collect()}
    assert flags["u0"] == (1.0, 0.0) and flags["u2"] == (0.0, 0.0)
    one_class = lbl.filter("label = 1")
    assert rules.learned_rules(rank, one_class).collect() == []
    assert rules.rules_from(rules.learned_rules(rank, one_class)).flag1.followers == ()


# ---- the tree ------------------------------------------------------------------------

def wide(spark, n, seed, distinct):
    """Rows of all feature columns; the label follows one of them, noisily."""
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        values = [float(rnd.choice([0, 0, 0, rnd.randint(0, distinct)])) if j % 3 == 0
                  else round(rnd.gauss(0, 40), 2) if j % 3 == 1 else float(rnd.randint(0, distinct))
                  for j in range(len(merge.FEATURE_COLUMNS))]
        label = float((values[seed % 30 + 1] > 4) != (rnd.random() < 0.2))
        rows.append((f"u{k}", label, *values))
    return spark.createDataFrame(rows, "uid string, label double, " + ", ".join(
        f"{c} double" for c in merge.FEATURE_COLUMNS))


@pytest.mark.parametrize("n, seed, distinct", [(20, 1, 5), (300, 2, 9), (900, 3, 60)])
def test_root_split_is_the_fitted_root(spark, n, seed, distinct):
    """Few rows, heavy values that delay candidates, and many distinct values."""
    data = wide(spark, n, seed, distinct)
    row = tree.root_split(data).first()
    fitted = model.train(data).stages[-1]._java_obj.rootNode()
    assert (row.feature_index, row.threshold) == (
        fitted.split().featureIndex(), fitted.split().threshold())
    assert row.gain == pytest.approx(fitted.gain(), abs=1e-12)
    assert row.left_0 + row.left_1 + row.right_0 + row.right_1 == n


def test_no_root_split_without_gain(spark):
    data = wide(spark, 40, 1, 5).withColumn("label", F.lit(1.0))
    assert tree.root_split(data).collect() == []


def test_saved_nodes_predict_like_the_model(spark, tmp_path):
    data = wide(spark, 500, 2, 30)
    fitted = model.train(data)
    path = str(tmp_path / "m")
    model.save_model(fitted, path)
    nodes = tree.node_table(spark, path)
    assert nodes.count() == fitted.stages[-1].numNodes > 5
    got = dict(map(tuple, tree.predictions_from_nodes(
        model.feature_vectors(data), nodes).collect()))
    assert got == {r.uid: r.prediction for r in model.predict(fitted, data).collect()}
    with pytest.raises(Exception, match="no leaf"):
        tree.predictions_from_nodes(model.feature_vectors(data), nodes.filter(
            "node < 15"), levels=3).collect()
    with pytest.raises(ValueError, match="more nodes"):
        tree.predictions_from_nodes(model.feature_vectors(data), nodes, levels=1)


# ---- raw files, sinks, buckets ----------------------------------------------------------

def test_malformed_lines_are_set_aside(spark, tmp_path):
    (tmp_path / "a.csv").write_text("uid,tag\nu1,0\nshort\nu2,1,extra\n,\n\"q,1\",x\n")
    rows, bad = raw.read_checked_csv(spark, str(tmp_path), raw.LABEL_COLUMNS)
    assert sorted(map(tuple, rows.collect())) == [("", ""), ("q,1", "x"), ("u1", "0")]
    assert sorted(r.line for r in bad.collect()) == ["short", "u2,1,extra"]
    assert bad.first().file.endswith("a.csv")
    # judged alike when few columns are read
    assert rows.select("uid").count() == 3 and bad.count() == 2


def test_a_failed_write_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(5).toDF("x"), path)
    failing = spark.range(9).selectExpr("CAST(raise_error('stop') AS BIGINT) AS x")
    with pytest.raises(Exception, match="stop"):
        tables.write_table(failing, path)
    assert tables.read_table(spark, path).count() == 5
    # a table can be rewritten from itself, and only the new version stays
    tables.write_table(tables.read_table(spark, path).selectExpr("x + 10 AS x"), path)
    assert sorted(r.x for r in tables.read_table(spark, path).collect()) == [10, 11, 12, 13, 14]
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [10, 11, 12, 13, 14]
    assert os.listdir(tmp_path) == ["t"]
    tables.write_table(spark.range(6).selectExpr("id AS x", "id % 2 AS p"), path, ["p"])
    assert tables.read_table(spark, path).filter("p = 1").count() == 3


def test_a_swap_that_was_cut_off_is_ended(spark, tmp_path):
    """Killed after the note, or between the two moves: the next reader sees the new rows."""
    for step in ("noted", "moved"):
        path = tmp_path / step
        tables.write_table(spark.range(2).toDF("x"), str(path))
        spark.range(7).toDF("x").write.parquet(str(path) + ".1.new")
        (tmp_path / f"{step}.swap").write_text(f"{path}.1.new\n{path}.1.old")
        if step == "moved":
            path.rename(f"{path}.1.old")
        assert tables.read_table(spark, str(path)).count() == 7
    assert sorted(os.listdir(tmp_path)) == ["moved", "noted"]


def test_a_failed_text_write_keeps_the_folder(spark, tmp_path):
    path = str(tmp_path / "lines")
    tables.write_delimited(spark.range(3).toDF("x"), path)
    with pytest.raises(Exception, match="stop"):
        tables.write_delimited(
            spark.range(3).selectExpr("CAST(raise_error('stop') AS STRING) AS x"), path)
    assert spark.read.text(path).count() == 3 and os.listdir(tmp_path) == ["lines"]
    tables.write_delimited(spark.range(4).toDF("x"), path)
    assert spark.read.text(path).count() == 4 and os.listdir(tmp_path) == ["lines"]


def test_preview_is_one_job(spark, capsys):
    tracker = spark.sparkContext.statusTracker()
    df = spark.range(0, 1000, 1, 6).toDF("x")
    spark.sparkContext.setJobGroup("preview", "")
    try:
        rows = tables.preview(df, "numbers", 3)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [r.x for r in rows] == [0, 1, 2]
    assert "numbers count: 1000" in capsys.readouterr().out
    assert len(tracker.getJobIdsForGroup("preview")) == 1


def test_bucketed_merge_shuffles_nothing(spark):
    with stages(spark):
        i = Inputs(spark, SF_SMALL)
        merged = merge.merge_bucketed(i.labels, i.feature_tables(), 4)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            merged.explain()
        assert "Join" in buf.getvalue() and "Exchange hash" not in buf.getvalue()
        key = "uid"
        assert sorted(map(str, merged.orderBy(key).collect())) == sorted(
            map(str, i.merged().orderBy(key).collect()))


def test_root_split_of_the_given_tables(spark):
    with stages(spark):
        split = model.hash_split(Inputs(spark, SF_ORACLE).merged()).filter("is_train").cache()
        row = tree.root_split(split).first()
        root = model.train(split).stages[-1]._java_obj.rootNode()
        assert (row.feature_index, row.threshold) == (
            root.split().featureIndex(), root.split().threshold())
        split.unpersist()
    release_stages(spark)
