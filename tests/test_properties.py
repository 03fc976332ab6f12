
import itertools
import random

from pyspark.sql import functions as F

from ledgerlens.operators import sequences
from ledgerlens.plans.catalogue import Inputs, QUERIES
from ledgerlens.plans.jobs import Layout
from ledgerlens.sources import tables

from conftest import SF_SMALL


def tokens_of(seq):
    """The rule on runs of equal ids: a pair at each boundary, and the last id alone
    when its run is longer than one or there is no other run."""
    runs = [(k, len(list(g))) for k, g in itertools.groupby(seq)]
    out = [f"{a}-{b}" for (a, _), (b, _) in zip(runs, runs[1:])]
    if len(runs) == 1 or runs[-1][1] > 1:
        out.append(runs[-1][0])
    return sorted(out)


def test_tokens_match_brute_force_on_random_sequences(spark):
    rnd = random.Random(11)
    seqs, data = {}, []
    for k in range(400):
        uid = f"s{k}"
        n = rnd.randint(1, 9)
        seq = [rnd.choice("abc") for _ in range(n)]
        seqs[uid] = seq
        # identical consecutive actions sometimes share a second: one key, mult > 1
        pos, t = 0, 0
        while pos < n:
            run = 1
            while pos + run < n and seq[pos + run] == seq[pos] and rnd.random() < 0.5:
                run += 1
            data.append((uid, 1, f"00:{t // 60:02d}:{t % 60:02d}", 0, seq[pos], run))
            pos, t = pos + run, t + 1
    keyed = spark.createDataFrame(
        data, "uid string, day int, time string, src int, type_id string, mult long")
    got = {}
    for r in sequences.action_tokens(keyed).collect():
        got.setdefault(r["uid"], []).extend([r["tok"]] * r["n"])
    assert {u: sorted(v) for u, v in got.items()} == {u: tokens_of(s) for u, s in seqs.items()}


def test_sequence_invariants(spark):
    i = Inputs(spark, SF_SMALL)
    seq = sequences.daily_sequences(i.keyed)
    sizes = seq.groupBy("uid", "day").agg(F.sum("mult").alias("n"))
    toks = sequences.action_tokens(i.keyed).groupBy("uid", "day").agg(F.sum("n").alias("t"))
    bad = sizes.join(toks, ["uid", "day"]).filter(
        F.col("t") > F.greatest(F.lit(1), F.col("n") - 1)).count()
    assert bad == 0
    # positions are 1..n without gaps
    gaps = seq.groupBy("uid", "day").agg(
        (F.max(F.col("pos") + F.col("mult") - 1) == F.sum("mult")).alias("ok")).filter(~F.col("ok"))
    assert gaps.count() == 0


def test_shares_ids_and_merge_keys(spark):
    fr = QUERIES["follow_rates"](spark, SF_SMALL)
    over = fr.groupBy("a1").agg(F.sum("share").alias("s")).filter(F.col("s") > 1.0 + 0.015)
    assert over.count() == 0
    for name in ("op_type_index", "trans_type_index"):
        idx = QUERIES[name](spark, SF_SMALL)
        assert idx.select("type_id").distinct().count() == idx.count()
    merged = QUERIES["merged_features"](spark, SF_SMALL)
    assert merged.select("uid").distinct().count() == merged.count()


def test_sorted_sink_order(spark, tmp_path):
    rank = QUERIES["user_action_rank"](spark, SF_SMALL)
    out = Layout(str(tmp_path), ordered=True)
    tables.write_table(tables.sorted_for_sink(rank, "user_action_rank"), out("rank"))
    rows = spark.read.parquet(out("rank")).collect()
    keys = [(r.uid, -r.cnt, r.tok) for r in rows]
    assert keys == sorted(keys)


def test_amount_stats_match_brute_force_across_many_pieces(spark):
    from fractions import Fraction

    from ledgerlens.operators import stats

    rnd = random.Random(5)
    data = []
    for u in range(40):
        n = rnd.randint(1, 60)
        hot = u == 0
        for _ in range(n * (25 if hot else 1)):          # one user with many more rows
            data.append((f"u{u}", round(rnd.uniform(-50, 400), 2)))
    df = spark.createDataFrame(data, "uid string, trans_amt double")
    got = {r.uid: r for r in stats.amount_stats(df, piece_units=500).collect()}
    by_user = {}
    for uid, a in data:
        by_user.setdefault(uid, []).append(a)
    for uid, xs in by_user.items():
        r = got[uid]
        # the recipe: exact sums, then one double division
        exact = [Fraction(str(x)) for x in xs]
        n, total = len(exact), sum(exact)
        squares = sum(x * x for x in exact)
        assert r.min_amt == min(xs) and r.max_amt == max(xs)
        s = sorted(xs)
        assert r.mid_amt == (s[(n - 1) // 2] + s[n // 2]) / 2.0
        assert r.avg_amt == float(total) / float(n)
        assert r.var_amt == float(n * squares - total * total) / (float(n) * float(n))
        assert abs(r.avg_amt - float(total / n)) <= 1e-12 * max(1.0, abs(float(total / n)))


def test_amounts_out_of_the_ordinary(spark):
    import pytest

    from ledgerlens.operators import stats

    def one(amounts, **options):
        df = spark.createDataFrame([("u", a) for a in amounts], "uid string, trans_amt double")
        return stats.amount_stats(df, **options).collect()[0]

    r = one([0.001, 0.004, 0.004], exact_scale=3)
    assert r.avg_amt == pytest.approx(0.003, rel=1e-12) and r.mid_amt == 0.004
    assert r.var_amt == pytest.approx(2e-06, rel=1e-12)
    assert one([1.005, 2.344], exact_scale=3).var_amt == pytest.approx(0.44823025, rel=1e-12)
    r = one([1e15 + k % 3 for k in range(1000)])
    assert r.var_amt == pytest.approx(0.666999, rel=1e-12) and r.mid_amt == 1e15 + 1
    assert one([5e16, 5e16]).var_amt == 0.0
    r = one([k / 10000 for k in range(1000)], exact_scale=4)
    assert abs(r.var_amt - 0.00083333250) < 1e-15
    for ansi in ("true", "false"):
        old = spark.conf.get("spark.sql.ansi.enabled")
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            for bad in ([0.001], [None, 5.0], [None], [1e18], [-4e16, 4e16] * 3):
                with pytest.raises(Exception, match="amount"):
                    one(bad)
            missing = spark.createDataFrame([("u", None)], "uid string, trans_amt double")
            for f in (stats.amount_range, stats.user_amount_range):
                with pytest.raises(Exception, match="missing"):
                    f(missing).collect()
        finally:
            spark.conf.set("spark.sql.ansi.enabled", old)


def test_a_user_with_most_rows_keeps_its_sequence(spark):
    """One user-day with nearly all actions over many hours, against a plain loop."""
    rnd = random.Random(8)
    events = [("hot", 1, f"{rnd.randint(0, 23):02d}:{rnd.randint(0, 59):02d}:{rnd.randint(0, 59):02d}",
               rnd.randint(0, 1), rnd.choice(["001", "002", "103"])) for _ in range(3000)]
    events += [("u", 1, "23:59:59", 0, "001"), ("u", 2, "00:00:01", 0, "001")]
    df = spark.createDataFrame(events, "uid string, day int, time string, src int, type_id string")
    keyed = sequences.keyed_actions(df)
    seq = sorted((t, s, k) for u, _, t, s, k in events if u == "hot")
    got = [r for r in sequences.daily_sequences(keyed).collect() if r.uid == "hot"]
    at = 1
    for r in sorted(got, key=lambda r: r.pos):
        assert r.pos == at
        assert [(r.time, r.src, r.type_id)] * r.mult == seq[at - 1:at - 1 + r.mult]
        at += r.mult
    toks = []
    for r in sequences.action_tokens(keyed).collect():
        toks += [r.tok] * r.n if r.uid == "hot" else []
    assert sorted(toks) == tokens_of([k for _, _, k in seq])
    days = sequences.long_days(keyed, 1)
    assert {r.uid for r in days.collect()} == {"hot"}
    assert sequences.long_days(keyed, 0, n_series=1).select("uid", "day").distinct().count() == 1
