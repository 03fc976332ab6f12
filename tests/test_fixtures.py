"""Hand-worked cases of FIXTURES.md, one block per operator."""

from pyspark.sql import functions as F

from ledgerlens.operators import features, merge, preprocess, rules, sequences, stats
from ledgerlens.operators import type_index as ti


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def by_uid(df):
    return {r["uid"]: r.asDict() for r in df.collect()}


def fitted(mini):
    op_idx = ti.fit_type_index(mini["op_base"], "op_type", ti.OP_PREFIX)
    tr_idx = ti.fit_type_index(mini["trans_base"], "trans_type1", ti.TRANS_PREFIX)
    op_enc = ti.encode(mini["op_base"], op_idx, "op_type")
    tr_enc = ti.encode(mini["trans_base"], tr_idx, "trans_type1")
    return op_idx, tr_idx, op_enc, tr_enc


def test_slim_logs_and_users(mini):
    assert mini["op_base"].count() == 7                    # duplicate removed (K1)
    assert mini["trans_base"].count() == 5
    users = preprocess.all_users(mini["op_base"], mini["trans_base"])
    assert rows(users, "uid") == [("u1",), ("u2",), ("u3",), ("u4",)]
    assert dict(mini["op_base"].dtypes)["op_day"] == "int"
    assert dict(mini["trans_base"].dtypes)["trans_amt"] == "double"


def test_dictionaries(mini):
    op_idx, tr_idx, _, _ = fitted(mini)
    assert rows(op_idx.table, "type", "type_id", "cnt") == [
        ("", "003", 1), ("A", "001", 3), ("B", "002", 2), ("C", "004", 1)]
    assert rows(tr_idx.table, "type", "type_id", "cnt") == [("T1", "101", 3), ("T2", "102", 2)]
    assert op_idx.size == 4 * ti.ROW_BYTES + 3 and tr_idx.size == 2 * ti.ROW_BYTES + 4


def test_amount_stats(mini):
    got = by_uid(stats.amount_stats(mini["trans_base"]))
    u1 = got["u1"]
    assert (u1["min_amt"], u1["max_amt"], u1["mid_amt"], u1["avg_amt"], u1["var_amt"]) == (
        100.0, 10000.0, 625.0, 2837.5, 17216718.75)
    u4 = got["u4"]
    assert (u4["min_amt"], u4["max_amt"], u4["mid_amt"], u4["avg_amt"], u4["var_amt"]) == (
        20000.0, 20000.0, 20000.0, 20000.0, 0.0)
    assert by_uid(stats.amount_stats(mini["trans_base"], piece_units=7)) == got
    assert by_uid(stats.amount_stats(mini["trans_base"], exact_scale=4)) == got


def test_amount_ranges(mini):
    per_user = by_uid(stats.user_amount_range(mini["trans_base"]))
    cols = ["amt_count", "thousand_rate", "ten_thousand_rate", "hundred_thousand_rate"]
    assert [per_user["u1"][c] for c in cols] == [4, 25.0, 0.0, 0.0]   # 1000, 10000 in no bucket
    assert [per_user["u4"][c] for c in cols] == [1, 0.0, 0.0, 100.0]
    g = stats.amount_range(mini["trans_base"]).collect()[0]
    assert list(g) == [5, 100.0, 20000.0, 20.0, 20.0, 0.0, 20.0]


def test_days_and_hours(mini):
    op, tr = mini["op_base"], mini["trans_base"]
    d = by_uid(stats.days_range(op, "op_day"))
    cols = ["days_span", "early_rate", "middle_rate", "end_rate"]
    assert [d["u1"][c] for c in cols] == [19, 75.0, 0.0, 25.0]
    assert [d["u2"][c] for c in cols] == [2, 50.0, 50.0, 0.0]
    assert [d["u3"][c] for c in cols] == [1, 0.0, 100.0, 0.0]
    t = by_uid(stats.days_range(tr, "trans_day"))
    assert [t["u1"][c] for c in cols] == [3, 100.0, 0.0, 0.0]
    assert [t["u4"][c] for c in cols] == [1, 0.0, 0.0, 100.0]
    both = by_uid(features.action_days(op, tr))
    assert len(both) == 4
    assert both["u2"]["trans_days_span"] is None and both["u3"]["trans_early_rate"] is None
    assert both["u4"]["op_days_span"] is None

    hcols = ["hour_span", "night_rate", "morning_rate", "noon_rate", "afternoon_rate",
             "evening_rate"]
    h = by_uid(stats.hours_range(op, "op_time"))
    assert [h["u1"][c] for c in hcols] == [10, 50.0, 25.0, 0.0, 0.0, 0.0]   # hour 0 in none
    assert [h["u2"][c] for c in hcols] == [2, 0.0, 50.0, 50.0, 0.0, 0.0]
    assert [h["u3"][c] for c in hcols] == [1, 0.0, 0.0, 0.0, 0.0, 100.0]
    th = by_uid(stats.hours_range(tr, "trans_time"))
    assert [th["u1"][c] for c in hcols] == [16, 25.0, 50.0, 0.0, 0.0, 25.0]
    assert [th["u4"][c] for c in hcols] == [1, 0.0, 0.0, 100.0, 0.0, 0.0]
    assert features.action_hours(op, tr).count() == 4


def test_top_types(mini):
    _, _, op_enc, tr_enc = fitted(mini)
    top = by_uid(ti.top_types(op_enc, 3, "op_"))
    assert [top["u1"][f"op_top{k}"] for k in (1, 2, 3)] == ["001", "002", "0"]   # tie 2-2
    assert [top["u2"][f"op_top{k}"] for k in (1, 2, 3)] == ["001", "003", "0"]
    assert [top["u3"][f"op_top{k}"] for k in (1, 2, 3)] == ["004", "0", "0"]
    tt = by_uid(ti.top_types(tr_enc, 3, "trans_"))
    assert [tt["u1"][f"trans_top{k}"] for k in (1, 2, 3)] == ["101", "102", "0"]
    assert [tt["u4"][f"trans_top{k}"] for k in (1, 2, 3)] == ["102", "0", "0"]


def test_sequences_tokens_rates_flags(mini):
    _, _, op_enc, tr_enc = fitted(mini)
    keyed = sequences.sequence_keys(op_enc, tr_enc)
    text = {}
    for r in sequences.daily_sequences(keyed).orderBy("uid", "day", "pos").collect():
        text.setdefault((r["uid"], r["day"]), []).extend([r["type_id"]] * r["mult"])
    text = {k: "-".join(v) for k, v in text.items()}
    assert text == {("u1", 3): "001-002-101-002-102", ("u1", 5): "101-101",
                     ("u1", 21): "001", ("u2", 10): "001", ("u2", 11): "003",
                     ("u3", 20): "004", ("u4", 31): "102"}
    rank = sequences.user_action_rank(keyed)
    assert rows(rank, "uid", "tok", "cnt") == sorted([
        ("u1", "001-002", 1), ("u1", "002-101", 1), ("u1", "101-002", 1), ("u1", "002-102", 1),
        ("u1", "101", 1), ("u1", "001", 1), ("u2", "001", 1), ("u2", "003", 1),
        ("u3", "004", 1), ("u4", "102", 1)])
    fr = rows(sequences.follow_rates(rank), "a1", "a2", "share")
    assert fr == [("001", "002", 1.0), ("002", "101", 0.5), ("002", "102", 0.5),
                  ("101", "002", 1.0)]
    flags = by_uid(rules.risk_flags(rank))
    assert list(flags) == ["u1"]
    assert (flags["u1"]["flag1"], flags["u1"]["flag2"], flags["u1"]["flag3"]) == (0.0, 0.0, 1.0)


def test_merge_keeps_only_complete_users(mini):
    op_idx, tr_idx, op_enc, tr_enc = fitted(mini)
    op, tr = mini["op_base"], mini["trans_base"]
    rank = sequences.user_action_rank(sequences.sequence_keys(op_enc, tr_enc))
    separate = [stats.amount_stats(tr), stats.user_amount_range(tr),
                features.action_days(op, tr), features.action_hours(op, tr),
                ti.top_types(op_enc, 3, "op_"), ti.top_types(tr_enc, 3, "trans_"),
                rules.risk_flags(rank)]
    combined = [stats.amount_stats(tr, with_ranges=True), features.user_time_profile(op, tr),
                ti.top_types(op_enc, 3, "op_"), ti.top_types(tr_enc, 3, "trans_"),
                rules.risk_flags(rank)]
    merged = merge.merge_features(mini["labels"], separate)
    assert sorted(merge.merge_features(mini["labels"], combined).collect()) == sorted(
        merged.collect())
    got = merged.collect()
    assert [r["uid"] for r in got] == ["u1"]
    assert len(merged.columns) == 40 and len(merge.FEATURE_COLUMNS) == 38
    left = merge.merge_features(mini["labels"], combined, how="left")
    assert left.count() == 4


def _keyed_from(spark, seqs):
    data = []
    for uid, seq in seqs.items():
        for pos, item in enumerate(seq.split("-")):
            data.append((uid, 1, f"00:00:{pos:02d}", 0, item, 1))
    return spark.createDataFrame(
        data, "uid string, day int, time string, src int, type_id string, mult long")


def test_adjacent_token_rule(spark):
    cases = {"s1": "a", "s2": "a-a", "s3": "a-a-a", "s4": "a-a-b", "s5": "a-b-b",
             "s6": "a-b-a", "s7": "a-a-b-b"}
    expect = {"s1": ["a"], "s2": ["a"], "s3": ["a"], "s4": ["a-b"], "s5": ["a-b", "b"],
              "s6": ["a-b", "b-a"], "s7": ["a-b", "b"]}
    toks = sequences.action_tokens(_keyed_from(spark, cases))
    got = {}
    for r in toks.collect():
        got.setdefault(r["uid"], []).extend([r["tok"]] * r["n"])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in expect.items()}


def test_adjacent_token_rule_with_multiplicity(spark):
    # "a-a" as one key with mult 2, and "b-a-a" with the repeat folded in one key
    data = [("m1", 1, "00:00:00", 0, "a", 2),
            ("m2", 1, "00:00:00", 0, "b", 1), ("m2", 1, "00:00:01", 0, "a", 2)]
    keyed = spark.createDataFrame(
        data, "uid string, day int, time string, src int, type_id string, mult long")
    got = rows(sequences.action_tokens(keyed), "uid", "tok", "n")
    assert got == [("m1", "a", 1), ("m2", "a", 1), ("m2", "b-a", 1)]


def test_follow_rates_support_is_users(spark):
    data = [("u1", "a", "b", 5), ("u2", "a", "b", 1), ("u1", "a", "c", 9), ("u1", "a", "d", 1),
            ("u2", "a", "d", 1), ("u3", "a", "d", 1), ("u1", "a", "e", 1)]
    rank = spark.createDataFrame(data, "uid string, a1 string, a2 string, cnt long")
    fr = sequences.follow_rates(rank)
    assert rows(fr, "rn", "a2", "share") == [(1, "d", 0.43), (2, "b", 0.29), (3, "c", 0.14)]
    text = sequences.follow_rates_text(fr).collect()[0]["related"]
    assert text == "[(d,0.43),(b,0.29),(c,0.14)]"


def test_flag_rules(spark):
    data = [("x", "017", "001", 3), ("x", "017", "002", 1),
            ("y", "017", "002", 3), ("y", "017", "040", 2),
            ("z", "102", "103", 1), ("z", "106", "001", 1)]
    rank = spark.createDataFrame(data, "uid string, a1 string, a2 string, cnt long")
    got = rows(rules.risk_flags(rank), "uid", "flag1", "flag2", "flag3")
    assert got == [("x", 1.0, 0.0, 1.0), ("y", 0.0, 0.0, 1.0), ("z", 0.0, 1.0, 0.0)]
    dom = rows(rules.dominant_follower(rank), "uid", "a1", "a2")
    assert ("x", "017", "001") in dom and ("y", "017", "002") in dom


def test_scalar_rules(spark):
    from ledgerlens.functions.expressions import number_or_zero, sql_share, type_id
    r = spark.range(1).select(
        type_id("0", F.lit(100)).alias("id100"), type_id("1", F.lit(7)).alias("id7"),
        F.expr(sql_share("23", "40")).alias("s"),
        number_or_zero(F.lit("")).alias("blank"), number_or_zero(F.lit("0.0")).alias("z"),
        F.lit("0.0").cast("double").cast("int").alias("label")).collect()[0]
    assert (r["id100"], r["id7"], r["s"], r["blank"], r["z"], r["label"]) == (
        "0100", "107", 0.58, 0.0, 0.0, 0)


def test_default_labels_when_file_missing(spark, mini, tmp_path):
    from ledgerlens.sources import raw
    assert raw.read_raw_labels(spark, str(tmp_path / "missing.csv")) is None
    d = preprocess.labels_or_default(None, mini["op_base"], mini["trans_base"])
    assert rows(d, "uid", "label") == [("u1", 0.0), ("u2", 0.0), ("u3", 0.0), ("u4", 0.0)]


def test_unknown_types_with_a_stored_dictionary(spark, mini):
    import pytest
    op_idx = ti.fit_type_index(mini["op_base"], "op_type", ti.OP_PREFIX)
    new = spark.createDataFrame([("u9", 1, "Z", "10:00:00"), ("u9", 1, "A", "10:00:01")],
                                "uid string, op_day int, op_type string, op_time string")
    assert rows(ti.encode(new, op_idx, "op_type"), "op_type", "type_id") == [("A", "001")]
    assert rows(ti.encode(new, op_idx, "op_type", unknown="zero"), "op_type", "type_id") == [
        ("A", "001"), ("Z", "0")]
    with pytest.raises(Exception, match="type without id"):
        ti.encode(new, op_idx, "op_type", unknown="error").collect()
