"""Rule flags from a user's behaviour pairs.

The leader/follower ids depend on the frequency order of the training
logs, so the rules are parameters with the original values as defaults. For other logs
they can be learned: ``learned_rules`` compares how many users of each label class
show a pair, and ``rules_from`` turns the result into rules.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import expr


@dataclass(frozen=True)
class FollowRule:
    leader: str
    followers: tuple[str, ...]


@dataclass(frozen=True)
class RiskRules:
    # The original rule constants.
    flag1: FollowRule = field(default_factory=lambda: FollowRule("017", ("001", "040")))
    flag2: FollowRule = field(default_factory=lambda: FollowRule("102", ("103",)))
    id_limit: int = 105


DEFAULT_RULES = RiskRules()


def _pairs(rank: DataFrame) -> DataFrame:
    """True pairs only, leader ``a1`` and follower ``a2``."""
    return rank.filter("a2 IS NOT NULL").selectExpr("uid", "a1", "a2", "cnt")


def dominant_follower(rank: DataFrame) -> DataFrame:
    """Per (user, leader) the follower with the highest count, ties by id.

    One grouping with a partial minimum. Columns ``uid, a1, a2, cnt``.
    """
    return (_pairs(rank).groupBy("uid", "a1").agg(expr("min(struct(-cnt AS c, a2))", "_top"))
            .selectExpr("uid", "a1", "_top.a2 AS a2", "-_top.c AS cnt"))


def risk_flags(rank: DataFrame, rules: RiskRules = DEFAULT_RULES) -> DataFrame:
    """``uid, flag1, flag2, flag3``; only users with a true pair appear.

    * flag1 = 1.0 when the dominant follower of ``rules.flag1.leader`` is one
      of its followers (0.0 also when the user never shows the leader);
    * flag2 likewise for ``rules.flag2``;
    * flag3 = 0.0 when any leader or follower id, as a number, exceeds
      ``rules.id_limit``, else 1.0.
    """
    def follows(rule: FollowRule) -> str:
        if not rule.followers:
            return "0.0D"
        followers = ", ".join(_quote(f) for f in rule.followers)
        top = f"min(CASE WHEN a1 = {_quote(rule.leader)} THEN struct(-cnt AS c, a2) END).a2"
        return f"CASE WHEN {top} IN ({followers}) THEN 1.0D ELSE 0.0D END"

    top_id = "max(greatest(CAST(a1 AS INT), CAST(a2 AS INT)))"
    return _pairs(rank).groupBy("uid").agg(
        expr(follows(rules.flag1), "flag1"),
        expr(follows(rules.flag2), "flag2"),
        expr(f"CASE WHEN {top_id} > {int(rules.id_limit)} THEN 0.0D ELSE 1.0D END", "flag3"),
    )


# ---- learned rules ------------------------------------------------------------

#: Fixed value: 95th percentile of chi-squared with one degree of freedom.
CHI2_95 = 3.841458820694124


def learned_rules(rank: DataFrame, labels: DataFrame, min_chi2: float = CHI2_95) -> DataFrame:
    """Pairs that significantly more risky than other users show.

    Counts users (not occurrences) of both classes per pair, in one grouping. A pair is
    kept when its lift, the smoothed ratio of the two shares, is above 1 and the
    chi-squared statistic of the two-by-two table reaches ``min_chi2``. Columns
    ``a1, a2, n_risky, n_safe, risky_users, safe_users, lift, chi2, rn`` (place among
    the leader's followers, by ``chi2``, then id). Users without a true pair or label
    take no part; a class without users gives no rules.
    """
    pairs = _pairs(rank).join(labels.filter("label IN (0.0D, 1.0D)"), "uid")
    users = (pairs.select("uid", "label").distinct()
             .selectExpr("count_if(label = 1) AS risky", "count_if(label = 0) AS safe").first())
    n1, n0 = f"CAST({users['risky']} AS DOUBLE)", f"CAST({users['safe']} AS DOUBLE)"
    counted = (pairs.groupBy("a1", "a2")
               .agg(expr("count_if(label = 1)", "n_risky"), expr("count_if(label = 0)", "n_safe"))
               .selectExpr("*", "CAST(n_risky AS DOUBLE) AS _a", "CAST(n_safe AS DOUBLE) AS _b"))
    gap = f"(_a * ({n0} - _b) - _b * ({n1} - _a))"
    tested = counted.selectExpr(
        "a1", "a2", "n_risky", "n_safe", f"{users['risky']}L AS risky_users",
        f"{users['safe']}L AS safe_users",
        f"((_a + 0.5D) / ({n1} + 1.0D)) / ((_b + 0.5D) / ({n0} + 1.0D)) AS lift",
        f"CASE WHEN {n1} > 0 AND {n0} > 0 AND _a + _b < {n1} + {n0} THEN"
        f" ({n1} + {n0}) * {gap} * {gap} / ((_a + _b) * ({n1} + {n0} - _a - _b) * {n1} * {n0})"
        " END AS chi2")
    # one row per pair of types: the window sees at most the dictionary
    return tested.filter(f"lift > 1 AND chi2 >= {float(min_chi2)!r}D").selectExpr(
        "*", "CAST(row_number() OVER (PARTITION BY a1 ORDER BY chi2 DESC, a2) AS INT) AS rn")


def rules_from(learned: DataFrame, followers: int = 2,
               id_limit: int = DEFAULT_RULES.id_limit) -> RiskRules:
    """The two leaders with the strongest pair, each with its first ``followers`` followers.

    At most ``2 * followers`` rows come to the driver. A missing second (or first)
    leader gives a rule that never holds.
    """
    top = (learned.groupBy("a1").agg(expr("max(chi2)", "best"))
           .orderBy(F.desc("best"), "a1").limit(2))
    rows = learned.filter(f"rn <= {int(followers)}").join(F.broadcast(top), "a1").orderBy(
        F.desc("best"), "a1", "rn").select("a1", "a2").collect()
    found: dict[str, list[str]] = {}
    for r in rows:
        found.setdefault(r["a1"], []).append(r["a2"])
    rules = [FollowRule(leader, tuple(ids)) for leader, ids in found.items()]
    rules += [FollowRule("", ())] * (2 - len(rules))
    return RiskRules(rules[0], rules[1], id_limit)


def _quote(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
