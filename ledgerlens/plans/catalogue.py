"""Query catalogue over the benchmark tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame built from
the library operators over whole tables. ``Inputs`` wires the shared stages
once per call. A query that reads a log from several branches (dictionaries,
sequences, exact medians) writes the slim log once while it is built;
``session.stages`` owns those tables.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.ranking import global_position
from ..operators import (
    features,
    merge,
    model,
    preprocess,
    rules,
    sequences,
    stats,
    tree,
    type_index,
)
from ..session import checkpointed, materialized, stage_path
from ..sources import raw, tables, testdata

# Rules with ids that occur in the benchmark tables (four operation
# types, eight transaction types), used next to the original defaults.
TUNED_RULES = rules.RiskRules(flag1=rules.FollowRule("003", ("001", "104")),
                              flag2=rules.FollowRule("102", ("103",)), id_limit=105)
LONG_DAY_THRESHOLD = 5
# Buckets of the feature tables in ``merged_features_bucketed``.
BUCKETS = 32
# Feature columns, thresholds and leaves of a fixed tree, for ``predictions_from_nodes``:
# node, prediction, feature, threshold, left, right.
FIXED_TREE = [
    (0, 0.0, "avg_amt", 45.0, 1, 2),
    (1, 0.0, "op_afternoon_rate", 18.275, 3, 4), (2, 1.0, "var_amt", 2000.0, 7, 8),
    (3, 0.0, None, None, None, None), (4, 1.0, "trans_days_span", 27.0, 5, 6),
    (5, 0.0, None, None, None, None), (6, 1.0, None, None, None, None),
    (7, 1.0, None, None, None, None), (8, 0.0, None, None, None, None),
]


class Inputs:
    """Stages of one run over the tables of ``sf_dir``, built lazily and once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.op_rows, self.trans_rows = Observation("op_rows"), Observation("trans_rows")

    def table(self, name: str) -> DataFrame:
        return testdata.table(self.spark, self.sf_dir, name)

    @cached_property
    def op_base(self) -> DataFrame:
        return preprocess.slim_operations(testdata.operations_from_events(self.table("events")))

    @cached_property
    def trans_base(self) -> DataFrame:
        return preprocess.slim_transactions(
            testdata.transactions_from_events(self.table("events")))

    @cached_property
    def op_log(self) -> DataFrame:
        """The slim operation log, written once and counted on the way."""
        return materialized(self.op_base.observe(self.op_rows, F.expr("count(1) AS n")), "op_base")

    @cached_property
    def trans_log(self) -> DataFrame:
        """The slim transaction log, written once and counted on the way."""
        return materialized(self.trans_base.observe(self.trans_rows, F.expr("count(1) AS n")),
                            "trans_base")

    @cached_property
    def order_trans(self) -> DataFrame:
        return preprocess.slim_transactions(
            testdata.transactions_from_orders(self.table("orders")))

    @cached_property
    def order_log(self) -> DataFrame:
        return materialized(self.order_trans, "order_trans")

    @cached_property
    def net_log(self) -> DataFrame:
        return materialized(testdata.transactions_net(self.table("lineitem")), "net_trans")

    @cached_property
    def lineitem_trans(self) -> DataFrame:
        return preprocess.slim_transactions(
            testdata.transactions_from_lineitem(self.table("lineitem")))

    @cached_property
    def labels(self) -> DataFrame:
        tags = testdata.tags_from_customer(self.table("customer"))
        return preprocess.labels_or_default(raw.labels_from_tags(tags), self.op_base,
                                            self.trans_base)

    @cached_property
    def op_index(self) -> type_index.TypeIndex:
        return type_index.fit_type_index(self.op_log, "op_type", type_index.OP_PREFIX)

    @cached_property
    def trans_index(self) -> type_index.TypeIndex:
        return type_index.fit_type_index(self.trans_log, "trans_type1", type_index.TRANS_PREFIX)

    @cached_property
    def op_encoded(self) -> DataFrame:
        return type_index.encode(self.op_log, self.op_index, "op_type")

    @cached_property
    def trans_encoded(self) -> DataFrame:
        return type_index.encode(self.trans_log, self.trans_index, "trans_type1")

    @cached_property
    def keyed(self) -> DataFrame:
        """Counted actions."""
        self.both_logs()
        return sequences.sequence_keys(self.op_encoded, self.trans_encoded)

    def both_logs(self) -> None:
        """Write both logs and fit both dictionaries, side by side: neither needs the other."""
        with ThreadPoolExecutor(2) as pool:
            for done in [pool.submit(lambda: self.op_index), pool.submit(lambda: self.trans_index)]:
                done.result()

    @cached_property
    def heavy(self) -> DataFrame:
        self.both_logs()
        return sequences.heavy_days(self.op_log, self.trans_log,
                                    rows=self.op_rows.get["n"] + self.trans_rows.get["n"])

    def keyed_of(self, label: int) -> DataFrame:
        """Counted actions of one label class, restricted before any window."""
        return sequences.restrict_to_label(self.keyed, self.labels, label)

    @cached_property
    def rank(self) -> DataFrame:
        return sequences.user_action_rank(self.keyed, self.heavy)

    def rank_of(self, label: int) -> DataFrame:
        return sequences.user_action_rank(self.keyed_of(label), self.heavy)

    def feature_tables(self) -> list[DataFrame]:
        self.both_logs()
        return [
            stats.amount_stats(self.trans_log, with_ranges=True),   # A1-A5, one pass
            features.user_time_profile(self.op_log, self.trans_log),  # A6-A9
            type_index.top_types(self.op_encoded, 3, "op_"),
            type_index.top_types(self.trans_encoded, 3, "trans_"),
            rules.risk_flags(self.rank),
        ]

    def merged(self, how: str = "inner") -> DataFrame:
        return merge.merge_features(self.labels, self.feature_tables(), how=how)

    def merged_buckets(self) -> DataFrame:
        return merge.merge_bucketed(self.labels, self.feature_tables(), BUCKETS)

    @cached_property
    def raw_files(self) -> tuple[DataFrame, DataFrame]:
        """Operations as CSV files and back: rows, and the lines set aside."""
        ops = testdata.operations_from_events(self.table("events"))
        good, bad = testdata.csv_from_operations(self.spark, ops,
                                                 stage_path(self.spark, "raw_operations"))
        rows, none = raw.read_checked_csv(self.spark, good, raw.OPERATION_COLUMNS)
        more, lines = raw.read_checked_csv(self.spark, bad, raw.OPERATION_COLUMNS, header=False)
        return rows.unionByName(more), none.unionByName(lines)

    @cached_property
    def learned(self) -> DataFrame:
        return rules.learned_rules(self.rank_table, self.labels)

    @cached_property
    def rank_table(self) -> DataFrame:
        """Pair counts, written once: learning and applying rules both read them."""
        return materialized(self.rank, "rank")

    def ordered(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` with its position in the order of sink ``name``."""
        return global_position(df, tables.sink_order(name), "position")


def _q(build: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Inputs(spark, sf_dir))
    run.__doc__ = build.__doc__
    return run


def _tree_predictions(i: Inputs) -> DataFrame:
    # The learner passes over its input several times; materialise the
    # merged table once instead of re-running its whole lineage each pass.
    split = model.hash_split(checkpointed(i.merged()))
    fitted = model.train(split.filter("is_train"))
    return model.predict(fitted, split.filter(~F.col("is_train")))


def _fixed_tree(spark: SparkSession) -> DataFrame:
    names = model.model_features()
    return spark.createDataFrame(
        [(node, prediction, None if f is None else names.index(f), *rest)
         for node, prediction, f, *rest in FIXED_TREE], tree.NODE_COLUMNS)


def _root_split(i: Inputs) -> DataFrame:
    split = model.hash_split(checkpointed(i.merged()))
    return tree.root_split(split.filter("is_train"))


def _flag_accuracy(i: Inputs) -> DataFrame:
    """A18 on the rule flag: share of users whose ``flag3`` equals their label."""
    flagged = rules.risk_flags(i.rank).join(i.labels, "uid")
    return model.accuracy(flagged.selectExpr("flag3 AS prediction", "label"))


def _feature_vectors(i: Inputs) -> DataFrame:
    """Length and sum of each user's feature vector."""
    return model.feature_vectors(i.merged()).selectExpr(
        "uid", "CAST(size(features) AS BIGINT) AS n_features",
        "round(aggregate(features, 0.0D, (x, y) -> x + y), 3) AS total")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # step 0
    "raw_csv_operations": _q(lambda i: i.raw_files[0].select("uid", "day", "mode", "time")),
    "raw_csv_quarantine": _q(lambda i: i.raw_files[1].groupBy("line")
                             .agg(F.count(F.lit(1)).alias("n"))),
    "slim_operations": _q(lambda i: i.op_base),
    "slim_transactions": _q(lambda i: i.trans_base),
    "all_users": _q(lambda i: preprocess.all_users(i.op_base, i.order_trans)),
    "default_labels": _q(lambda i: preprocess.labels_or_default(None, i.op_base, i.trans_base)),
    "customer_labels": _q(lambda i: i.labels),
    # amounts
    "user_amount_stats": _q(lambda i: stats.amount_stats(i.trans_log)),
    "user_amount_stats_orders": _q(lambda i: stats.amount_stats(i.order_log)),
    "user_amount_stats_net": _q(lambda i: stats.amount_stats(i.net_log, exact_scale=4)),
    "amount_range_global": _q(lambda i: stats.amount_range(i.lineitem_trans)),
    "amount_range_global_orders": _q(lambda i: stats.amount_range(i.order_trans)),
    "amount_range_user": _q(lambda i: stats.user_amount_range(i.lineitem_trans)),
    # days and hours
    "days_range": _q(lambda i: stats.days_range(i.op_base, "op_day")),
    "action_days": _q(lambda i: features.action_days(i.op_base, i.trans_base)),
    "hours_range": _q(lambda i: stats.hours_range(i.op_base, "op_time")),
    "hours_range_orders": _q(lambda i: stats.hours_range(i.order_trans, "trans_time")),
    "action_hours": _q(lambda i: features.action_hours(i.op_base, i.trans_base)),
    # types
    "op_type_counts": _q(lambda i: type_index.type_counts(i.op_base, "op_type")),
    "trans_type_counts": _q(lambda i: type_index.type_counts(i.trans_base, "trans_type1")),
    # the only reader of the log: nothing is written but the counts
    "op_type_index": _q(lambda i: type_index.fit_type_index(
        i.op_base, "op_type", type_index.OP_PREFIX).table),
    "trans_type_index": _q(lambda i: type_index.fit_type_index(
        i.trans_base, "trans_type1", type_index.TRANS_PREFIX).table),
    "encoded_operations": _q(lambda i: i.op_encoded),
    "encoded_transactions": _q(lambda i: i.trans_encoded),
    "user_type_counts": _q(lambda i: type_index.user_type_counts(i.op_encoded)),
    "user_trans_type_counts": _q(lambda i: type_index.user_type_counts(i.trans_encoded)),
    "top3_op_types": _q(lambda i: type_index.top_types(i.op_encoded, 3, "op_")),
    "top3_trans_types": _q(lambda i: type_index.top_types(i.trans_encoded, 3, "trans_")),
    # sequences
    "daily_sequences": _q(lambda i: sequences.daily_sequences(i.keyed, i.heavy)),
    "long_days": _q(lambda i: sequences.long_days(i.keyed, LONG_DAY_THRESHOLD, heavy=i.heavy)),
    "action_tokens": _q(lambda i: sequences.action_tokens(i.keyed, i.heavy)),
    "user_action_rank": _q(lambda i: i.rank),
    "risky_sequences": _q(lambda i: sequences.daily_sequences(i.keyed_of(1), i.heavy)),
    "not_risky_sequences": _q(lambda i: sequences.daily_sequences(i.keyed_of(0), i.heavy)),
    "risky_action_rank": _q(lambda i: i.rank_of(1)),
    "not_risky_action_rank": _q(lambda i: i.rank_of(0)),
    "follow_rates": _q(lambda i: sequences.follow_rates(i.rank)),
    "follow_rates_risky": _q(lambda i: sequences.follow_rates(i.rank_of(1))),
    "follow_rates_not_risky": _q(lambda i: sequences.follow_rates(i.rank_of(0))),
    "follow_rates_text": _q(lambda i: sequences.follow_rates_text(
        sequences.follow_rates(i.rank))),
    # rules
    "dominant_follower": _q(lambda i: rules.dominant_follower(i.rank)),
    "risk_flags": _q(lambda i: rules.risk_flags(i.rank)),
    "risk_flags_tuned": _q(lambda i: rules.risk_flags(i.rank, TUNED_RULES)),
    "learned_rules": _q(lambda i: i.learned),
    "risk_flags_learned": _q(lambda i: rules.risk_flags(
        i.rank_table, rules.rules_from(i.learned))),
    # merge, text forms, model
    "merged_features": _q(lambda i: i.merged()),
    "merged_features_left": _q(lambda i: i.merged("left")),
    "merged_features_bucketed": _q(lambda i: i.merged_buckets()),
    "delimited_features": _q(lambda i: merge.to_delimited(i.merged())),
    "parsed_features": _q(lambda i: merge.parse_delimited(merge.to_delimited(i.merged()))),
    "delimited_operations": _q(lambda i: tables.to_lines(i.op_base)),
    "parsed_operations": _q(lambda i: tables.parse_lines(
        tables.to_lines(i.op_base), tables.OP_BASE_SCHEMA)),
    "delimited_transactions": _q(lambda i: tables.to_lines(i.trans_base)),
    "parsed_transactions": _q(lambda i: tables.parse_lines(
        tables.to_lines(i.trans_base), tables.TRANS_BASE_SCHEMA)),
    "strict_operations": _q(lambda i: type_index.encode(
        i.op_log, i.op_index, "op_type", unknown="error")),
    "feature_vectors": _q(_feature_vectors),
    "hash_split": _q(lambda i: model.hash_split(
        preprocess.all_users(i.op_base, i.trans_base)).select("uid", "bucket", "is_train")),
    "heldout_users": _q(lambda i: model.hash_split(i.labels).filter("NOT is_train")
                        .select("uid", "label")),
    "flag_accuracy": _q(_flag_accuracy),
    "tree_root_split": _q(_root_split),
    "predictions_from_nodes": _q(lambda i: tree.predictions_from_nodes(
        model.feature_vectors(i.merged()), _fixed_tree(i.spark), levels=3)),
    "tree_predictions": _q(_tree_predictions),
    "tree_accuracy": _q(lambda i: model.accuracy(_tree_predictions(i))),
    # sink orders
    "ordered_user_amount": _q(lambda i: i.ordered(stats.amount_stats(
        i.trans_log, with_ranges=True).select("uid", "amt_count"), "user_amount")),
    "ordered_op_type_count": _q(lambda i: i.ordered(
        type_index.type_counts(i.op_base, "op_type"), "op_type_count")),
    "ordered_user_actions": _q(lambda i: i.ordered(
        sequences.daily_sequences(i.keyed, i.heavy).select("uid", "day", "pos"), "user_actions")),
    "ordered_user_action_rank": _q(lambda i: i.ordered(
        i.rank.select("uid", "tok", "cnt"), "user_action_rank")),
    "ordered_risky_related_action": _q(lambda i: i.ordered(
        sequences.follow_rates(i.rank_of(1)).select("a1", "a2", "rn"), "risky_related_action")),
}
