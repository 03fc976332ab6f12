"""Plan shape: pushdown and pruning, per-piece windows, size-checked broadcasts."""

import contextlib
import io

from ledgerlens.operators import stats
from ledgerlens.plans.catalogue import Inputs, QUERIES

from conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_event_scans_are_pruned_and_filtered(spark):
    ops = plan(QUERIES["slim_operations"](spark, SF_SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in ops
    assert "PushedFilters: [Or(IsNull(event_type),Not(EqualTo(event_type,purchase)))]" in ops
    trans = plan(QUERIES["slim_transactions"](spark, SF_SMALL))
    assert "EqualTo(event_type,purchase)" in trans
    assert "event_id" not in trans.split("ReadSchema:")[1].split("\n")[0]


def test_median_windows_run_per_amount_piece(spark):
    text = plan(stats.amount_stats(Inputs(spark, SF_SMALL).trans_log))
    windows = [line for line in text.splitlines() if "windowspecdefinition" in line]
    assert windows and all("_piece" in line for line in windows if "_a#" in line)
    # the partial aggregate before the first shuffle reduces a hot user's rows
    assert "partial_count" in text


def test_sequence_windows_run_per_hour(spark):
    for name in ("daily_sequences", "action_tokens", "long_days"):
        text = plan(QUERIES[name](spark, SF_SMALL))
        windows = [line for line in text.splitlines() if "windowspecdefinition" in line]
        # log-sized rows (they have a time or a type) never go by (uid, day) alone
        assert windows and all("_hour" in line for line in windows if "type_id" in line)


def test_rules_need_no_window(spark):
    for name in ("dominant_follower", "risk_flags"):
        tail = plan(QUERIES[name](spark, SF_SMALL))
        assert "DESC" not in "".join(
            line for line in tail.splitlines() if "windowspecdefinition" in line)


def test_label_classes_are_restricted_before_the_windows(spark):
    text = plan(QUERIES["risky_sequences"](spark, SF_SMALL))
    # listed from the leaves up: the semi join comes first
    assert text.index("LeftSemi") < text.index("windowspecdefinition")


def test_dictionary_joins_are_broadcast(spark):
    text = plan(QUERIES["encoded_operations"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in text
