"""End-to-end jobs: preprocess -> features -> train -> predict (section 0 of SURVEY).

Every stage writes Parquet tables under one output root and the next
stage reads them back: a stage boundary is a written table, so a lost
executor never forces a recompute from the raw logs, and each later
stage scans only the columns it needs.

Fitting and scoring share one feature job. When fitting, the type
dictionaries are fitted and written; when scoring, the stored ones are
read (D4), so ids cannot shift between training and scoring data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features, merge, model, preprocess, rules, sequences, stats
from ..operators import type_index as ti
from ..sources import raw, tables


@dataclass(frozen=True)
class Layout:
    """Table locations under one root folder (shared storage on a cluster).

    ``ordered=True`` writes the tables that had an order in the original
    output (O1-O5) sorted that way; it costs a range shuffle per table.
    """

    root: str
    ordered: bool = False

    def __call__(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def _write(df: DataFrame, layout: Layout, name: str) -> None:
    if layout.ordered:
        df = tables.sorted_for_sink(df, name)
    tables.write_table(df, layout(name))


def _read(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    return tables.read_table(spark, layout(name))


def preprocess_job(spark: SparkSession, raw_ops: DataFrame, raw_trans: DataFrame,
                   tags: DataFrame | None, out: Layout, text_copies: bool = False) -> None:
    """Step 0 (P1, P2, S3, S7, S13): slim logs and labels.

    ``tags`` is the raw ``uid, tag`` table or ``None`` (every user gets 0.0).
    ``text_copies`` also writes the raw logs as ``|``-delimited text (S3).
    """
    if text_copies:
        tables.write_delimited(raw_ops, out("operation_log"))
        tables.write_delimited(raw_trans, out("transaction_log"))
        if tags is not None:
            tables.write_delimited(tags, out("tag_log"))
    _write(preprocess.slim_operations(raw_ops), out, "op_base")
    _write(preprocess.slim_transactions(raw_trans), out, "trans_base")
    op_base, trans_base = _read(spark, out, "op_base"), _read(spark, out, "trans_base")
    labels = raw.labels_from_tags(tags) if tags is not None else None
    _write(preprocess.labels_or_default(labels, op_base, trans_base), out, "labels")


def preprocess_files(spark: SparkSession, operations_csv: str, transactions_csv: str,
                     labels_csv: str | None, out: Layout, text_copies: bool = False) -> None:
    """Step 0 from the raw CSV files (S1, S2); a missing label file is allowed."""
    preprocess_job(spark, raw.read_raw_operations(spark, operations_csv),
                   raw.read_raw_transactions(spark, transactions_csv),
                   raw.read_raw_labels(spark, labels_csv), out, text_copies)


def feature_job(spark: SparkSession, out: Layout, index_from: Layout | None = None,
                risk_rules: rules.RiskRules = rules.DEFAULT_RULES, how: str = "inner",
                eda: bool = True, unknown: str = "error") -> None:
    """Steps 1.1-1.4 and the sequence analysis, ending in ``merged_features``.

    ``index_from=None`` fits the dictionaries on these logs and writes them;
    otherwise the dictionaries stored under ``index_from`` are applied.
    ``unknown`` says what becomes of a type they do not know: ``"error"``
    fails the job, ``"zero"`` maps it to ``"0"``, ``"drop"`` leaves its rows out.
    """
    op_base, trans_base = _read(spark, out, "op_base"), _read(spark, out, "trans_base")
    labels = _read(spark, out, "labels")

    # 1.1 amounts, 1.2 days and hours
    _write(stats.amount_stats(trans_base, with_ranges=True), out, "user_amount")
    _write(stats.amount_range(trans_base), out, "trans_amt_range")
    _write(features.user_time_profile(op_base, trans_base), out, "action_time_profile")

    # 1.3 dictionaries and top types
    if index_from is None:
        for log, column, prefix, name in (
                (op_base, "op_type", ti.OP_PREFIX, "op_type"),
                (trans_base, "trans_type1", ti.TRANS_PREFIX, "trans_type")):
            ti.fit_type_index(log, column, prefix).save(out(f"{name}_index"))
            _write(_read(spark, out, f"{name}_index").select("type", "cnt"), out, f"{name}_count")
        index_from = out
    op_index = ti.TypeIndex.load(spark, index_from("op_type_index"))
    trans_index = ti.TypeIndex.load(spark, index_from("trans_type_index"))
    if index_from is out:
        unknown = "drop"   # fitted on these logs: there is none
    op_enc = ti.encode(op_base, op_index, "op_type", unknown=unknown)
    trans_enc = ti.encode(trans_base, trans_index, "trans_type1", unknown=unknown)
    _write(ti.top_types(op_enc, 3, "op_"), out, "top3_op_types")
    _write(ti.top_types(trans_enc, 3, "trans_"), out, "top3_trans_types")

    # sequences, pairs, follow rates, flags
    _write(sequences.sequence_keys(op_enc, trans_enc), out, "action_keys")
    keyed = _read(spark, out, "action_keys")
    heavy = sequences.heavy_days(op_base, trans_base)
    _write(sequences.daily_sequences(keyed, heavy), out, "user_actions")
    _write(sequences.user_action_rank(keyed, heavy), out, "user_action_rank")
    rank = _read(spark, out, "user_action_rank")
    if eda:
        seqs = _read(spark, out, "user_actions")
        for value, tag in ((1, "risky"), (0, "no_risky")):
            _write(sequences.restrict_to_label(seqs, labels, value), out,
                   f"{tag}_user_actions")
        for name, part in (("related_action", rank),
                           ("risky_related_action", sequences.restrict_to_label(rank, labels, 1)),
                           ("no_risky_related_action",
                            sequences.restrict_to_label(rank, labels, 0))):
            _write(sequences.follow_rates(part), out, name)
            tables.write_delimited(
                sequences.follow_rates_text(_read(spark, out, name)).orderBy("a1"),
                out(name + "_text"))
    _write(rules.risk_flags(rank, risk_rules), out, "related_action_feature")

    # 1.4 merge
    merged = merge.merge_features(labels, [
        _read(spark, out, "user_amount"), _read(spark, out, "action_time_profile"),
        _read(spark, out, "top3_op_types"), _read(spark, out, "top3_trans_types"),
        _read(spark, out, "related_action_feature")], how=how)
    _write(merged, out, "merged_features")


def train_job(spark: SparkSession, out: Layout, model_path: str, compat: bool = False,
              seed: int = 7) -> float:
    """Step 2 (M1-M5): hash split, fit the tree, save it, score the held-out part.

    Writes ``heldout_predictions`` and ``accuracy``; returns the accuracy.
    """
    split = model.hash_split(_read(spark, out, "merged_features"))
    fitted = model.train(split.filter("is_train"), compat=compat, seed=seed)
    model.save_model(fitted, model_path)
    _write(model.predict(fitted, split.filter(~F.col("is_train"))), out, "heldout_predictions")
    _write(model.accuracy(_read(spark, out, "heldout_predictions")), out, "accuracy")
    row = _read(spark, out, "accuracy").first()
    return float(row["accuracy"]) if row and row["accuracy"] is not None else float("nan")


def predict_job(spark: SparkSession, out: Layout, model_path: str,
                predictions_path: str) -> None:
    """Step 3 (M6, S12): score ``merged_features`` with a stored model."""
    scored = model.predict(model.load_model(model_path), _read(spark, out, "merged_features"))
    tables.write_predictions(scored, predictions_path)


def fit_pipeline(spark: SparkSession, raw_ops: DataFrame, raw_trans: DataFrame,
                 tags: DataFrame | None, out: Layout, model_path: str, **kw) -> float:
    """Preprocess, fit dictionaries and features, train; returns held-out accuracy."""
    preprocess_job(spark, raw_ops, raw_trans, tags, out)
    feature_job(spark, out, risk_rules=kw.get("risk_rules", rules.DEFAULT_RULES))
    return train_job(spark, out, model_path, kw.get("compat", False), kw.get("seed", 7))


def score_pipeline(spark: SparkSession, raw_ops: DataFrame, raw_trans: DataFrame,
                   train_out: Layout, out: Layout, model_path: str, predictions_path: str,
                   how: str = "inner", unknown: str = "error", **kw) -> None:
    """Preprocess new logs, build features with the training dictionaries, predict."""
    preprocess_job(spark, raw_ops, raw_trans, None, out)
    feature_job(spark, out, index_from=train_out, how=how, eda=False, unknown=unknown,
                risk_rules=kw.get("risk_rules", rules.DEFAULT_RULES))
    predict_job(spark, out, model_path, predictions_path)
