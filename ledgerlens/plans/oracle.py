"""DuckDB SQL twins of the catalogue queries (the correctness oracle).

Written independently of the Spark operators where it matters: the token
rule is a literal restatement of the original loop over raw sequence
positions (not the run/multiplicity form the Spark side uses), and the
median picks the middle rows by row number. Mean and variance use the
exact decimal recipe; percents and shares round through decimal so that
DuckDB rounds half-up like Spark.

Queries are assembled from named CTEs; each CTE lists the CTEs it reads.
"""

from __future__ import annotations


def pct(num: str, den: str) -> str:
    return (f"CAST(round(CAST(CAST({num} AS DOUBLE) * 100.0::DOUBLE / CAST({den} AS DOUBLE)"
            f" AS DECIMAL(38,12)), 2) AS DOUBLE)")


def share(num: str, den: str) -> str:
    return (f"CAST(round(CAST(CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE)"
            f" AS DECIMAL(38,12)), 2) AS DOUBLE)")


def hms(ts: str) -> str:
    return f"strftime({ts}, '%H:%M:%S')"


CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


def build(body: str, *needs: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order) + "\n" + body


# ---- slim logs (P1, P2) ---------------------------------------------------
cte("ops", (), f"""
  SELECT DISTINCT CAST(user_id AS VARCHAR) AS uid, CAST(day(ts) AS INTEGER) AS op_day,
         coalesce(event_type, '') AS op_type, {hms('ts')} AS op_time
  FROM events WHERE coalesce(event_type, '') <> 'purchase'""")
cte("trans", (), f"""
  SELECT DISTINCT CAST(user_id AS VARCHAR) AS uid, 'c' || CAST(k % 3 AS VARCHAR) AS trans_channel,
         CAST(day(ts) AS INTEGER) AS trans_day, CAST(value AS DOUBLE) AS trans_amt,
         {hms('ts')} AS trans_time, 't' || CAST(k % 8 AS VARCHAR) AS trans_type1,
         'u' || CAST(k % 5 AS VARCHAR) AS trans_type2
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events WHERE event_type = 'purchase')""")
cte("otrans", (), f"""
  SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS uid, o_orderstatus AS trans_channel,
         CAST(day(o_orderdate) AS INTEGER) AS trans_day, o_totalprice AS trans_amt,
         {hms('o_orderdate')} AS trans_time, coalesce(o_orderpriority, '') AS trans_type1,
         '' AS trans_type2
  FROM orders""")
cte("ltrans", (), f"""
  SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS uid, l_linestatus AS trans_channel,
         CAST(day(l_shipdate) AS INTEGER) AS trans_day, l_extendedprice AS trans_amt,
         {hms('l_shipdate')} AS trans_time, coalesce(l_returnflag, '') AS trans_type1,
         coalesce(l_linestatus, '') AS trans_type2
  FROM lineitem""")
cte("ntrans", (), """
  SELECT CAST(l_suppkey AS VARCHAR) AS uid,
         CAST(CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
              AS DECIMAL(18,4)) AS DOUBLE) AS trans_amt
  FROM lineitem""")
cte("lbl", (), """
  SELECT CAST(c_custkey AS VARCHAR) AS uid,
         CAST(max(CASE WHEN c_acctbal < 0 THEN 1.0 ELSE 0.0 END) AS DOUBLE) AS label
  FROM customer GROUP BY 1""")


# ---- amounts (A1-A5) --------------------------------------------------------
def amount_stats_sql(src: str) -> str:
    return build(amount_stats_body(src), src)


def amount_stats_body(src: str) -> str:
    return f"""
SELECT agg.uid, min_amt, max_amt, mid_amt,
       CAST(s AS DOUBLE) / CAST(n AS DOUBLE) AS avg_amt,
       CAST(CAST(n AS DECIMAL(9,0)) * q - CAST(s AS DECIMAL(19,2)) * CAST(s AS DECIMAL(19,2)) AS DOUBLE)
         / (CAST(n AS DOUBLE) * CAST(n AS DOUBLE)) AS var_amt
FROM (SELECT uid, min(trans_amt) AS min_amt, max(trans_amt) AS max_amt, count(*) AS n,
             sum(CAST(trans_amt AS DECIMAL(12,2))) AS s,
             sum(CAST(trans_amt AS DECIMAL(12,2)) * CAST(trans_amt AS DECIMAL(12,2))) AS q
      FROM {src} GROUP BY uid) agg
JOIN (SELECT uid, (max(CASE WHEN r = (n - 1) // 2 THEN trans_amt END)
                   + max(CASE WHEN r = n // 2 THEN trans_amt END)) / 2.0 AS mid_amt
      FROM (SELECT uid, trans_amt,
                   row_number() OVER (PARTITION BY uid ORDER BY trans_amt) - 1 AS r,
                   count(*) OVER (PARTITION BY uid) AS n
            FROM {src})
      GROUP BY uid) med ON agg.uid = med.uid"""


def net_stats_sql() -> str:
    """Four decimals: the same recipe in DECIMAL."""
    d = "CAST(trans_amt AS DECIMAL(19,4))"
    s = "CAST(s AS DECIMAL(19,4))"
    return build(f"""
SELECT agg.uid, min_amt, max_amt, mid_amt, CAST(s AS DOUBLE) / CAST(n AS DOUBLE) AS avg_amt,
       CAST(CAST(n AS DECIMAL(9,0)) * CAST(q AS DECIMAL(29,8)) - {s} * {s} AS DOUBLE)
         / (CAST(n AS DOUBLE) * CAST(n AS DOUBLE)) AS var_amt
FROM (SELECT uid, min(trans_amt) AS min_amt, max(trans_amt) AS max_amt, count(*) AS n,
             sum({d}) AS s, sum({d} * {d}) AS q
      FROM ntrans GROUP BY uid) agg
JOIN (SELECT uid, (max(CASE WHEN r = (n - 1) // 2 THEN trans_amt END)
                   + max(CASE WHEN r = n // 2 THEN trans_amt END)) / 2.0 AS mid_amt
      FROM (SELECT uid, trans_amt,
                   row_number() OVER (PARTITION BY uid ORDER BY trans_amt) - 1 AS r,
                   count(*) OVER (PARTITION BY uid) AS n
            FROM ntrans)
      GROUP BY uid) med ON agg.uid = med.uid""", "ntrans")


AMOUNT_BUCKETS = {
    "hundred_rate": "trans_amt <= 100",
    "thousand_rate": "trans_amt > 100 AND trans_amt < 1000",
    "ten_thousand_rate": "trans_amt > 1000 AND trans_amt < 10000",
    "hundred_thousand_rate": "trans_amt > 10000",
}


def amount_range_sql(src: str) -> str:
    rates = ", ".join(f"{pct(f'count_if({c})', 'count(*)')} AS {n}"
                      for n, c in AMOUNT_BUCKETS.items())
    return build(f"""SELECT count(*) AS amt_count, min(trans_amt) AS amt_min,
       max(trans_amt) AS amt_max, {rates} FROM {src}""", src)


def user_amount_range_body(src: str) -> str:
    rates = ", ".join(f"{pct(f'count_if({c})', 'count(*)')} AS {n}"
                      for n, c in list(AMOUNT_BUCKETS.items())[1:])
    return f"SELECT uid, count(*) AS amt_count, {rates} FROM {src} GROUP BY uid"


def user_amount_range_sql(src: str) -> str:
    return build(user_amount_range_body(src), src)


# ---- days and hours (A6-A9) -----------------------------------------------
DAY_BUCKETS = {"early_rate": "{d} <= 10", "middle_rate": "{d} > 10 AND {d} <= 20",
               "end_rate": "{d} > 20"}
HOUR_BUCKETS = {"night_rate": (0, 8), "morning_rate": (8, 12), "noon_rate": (12, 14),
                "afternoon_rate": (14, 18), "evening_rate": (18, 24)}


def days_select(src: str, day: str, prefix: str = "") -> str:
    rates = ", ".join(f"{pct('count_if(' + c.format(d=day) + ')', 'count(*)')} AS {prefix}{n}"
                      for n, c in DAY_BUCKETS.items())
    return (f"SELECT uid, CAST(max({day}) - min({day}) + 1 AS INTEGER) AS {prefix}days_span, "
            f"{rates} FROM {src} GROUP BY uid")


def hours_select(src: str, time: str, prefix: str = "") -> str:
    h = f"CAST(substr(trim({time}), 1, 2) AS INTEGER)"
    rates = ", ".join(f"{pct(f'count_if({h} > {lo} AND {h} <= {hi})', 'count(*)')} AS {prefix}{n}"
                      for n, (lo, hi) in HOUR_BUCKETS.items())
    return (f"SELECT uid, CAST(max({h}) - min({h}) + 1 AS INTEGER) AS {prefix}hour_span, "
            f"{rates} FROM {src} GROUP BY uid")


def _full_outer(left: str, right: str, cols_l: list[str], cols_r: list[str]) -> str:
    sel = ", ".join([f"l.{c}" for c in cols_l] + [f"r.{c}" for c in cols_r])
    return (f"SELECT coalesce(l.uid, r.uid) AS uid, {sel} FROM ({left}) l "
            f"FULL OUTER JOIN ({right}) r ON l.uid = r.uid")


DAY_COLS = ["days_span", "early_rate", "middle_rate", "end_rate"]
HOUR_COLS = ["hour_span", "night_rate", "morning_rate", "noon_rate", "afternoon_rate",
             "evening_rate"]
cte("action_days", ("ops", "trans"), _full_outer(
    days_select("ops", "op_day", "op_"), days_select("trans", "trans_day", "trans_"),
    ["op_" + c for c in DAY_COLS], ["trans_" + c for c in DAY_COLS]))
cte("action_hours", ("ops", "trans"), _full_outer(
    hours_select("ops", "op_time", "op_"), hours_select("trans", "trans_time", "trans_"),
    ["op_" + c for c in HOUR_COLS], ["trans_" + c for c in HOUR_COLS]))


# ---- dictionaries, encoding, top types (W1-W4, A10-A12, J1, J2) -------------
def _index(src: str, col: str, prefix: str) -> str:
    return f"""
  SELECT type, '{prefix}' || printf('%02d', row_number() OVER (ORDER BY cnt DESC, type)) AS type_id, cnt
  FROM (SELECT {col} AS type, count(*) AS cnt FROM {src} GROUP BY {col})"""


cte("op_idx", ("ops",), _index("ops", "op_type", "0"))
cte("trans_idx", ("trans",), _index("trans", "trans_type1", "1"))
cte("op_enc", ("ops", "op_idx"), """
  SELECT o.uid, o.op_day, o.op_type, o.op_time, i.type_id FROM ops o JOIN op_idx i ON o.op_type = i.type""")
cte("trans_enc", ("trans", "trans_idx"), """
  SELECT t.uid, t.trans_channel, t.trans_day, t.trans_amt, t.trans_time, t.trans_type1,
         t.trans_type2, i.type_id
  FROM trans t JOIN trans_idx i ON t.trans_type1 = i.type""")


def top3_body(enc: str, prefix: str) -> str:
    slots = ", ".join(f"coalesce(max(CASE WHEN rn = {k} THEN type_id END), '0') AS {prefix}top{k}"
                      for k in (1, 2, 3))
    return f"""
  SELECT uid, {slots}
  FROM (SELECT uid, type_id, row_number() OVER (PARTITION BY uid ORDER BY cnt DESC, type_id) AS rn
        FROM (SELECT uid, type_id, count(*) AS cnt FROM {enc} GROUP BY uid, type_id))
  WHERE rn <= 3 GROUP BY uid"""


cte("top_op", ("op_enc",), top3_body("op_enc", "op_"))
cte("top_trans", ("trans_enc",), top3_body("trans_enc", "trans_"))

# ---- sequences and tokens (W5, W6, A13) -------------------------------------
cte("actions", ("op_enc", "trans_enc"), """
  SELECT uid, op_day AS day, op_time AS time, 0 AS src, type_id FROM op_enc
  UNION ALL
  SELECT uid, trans_day AS day, trans_time AS time, 1 AS src, type_id FROM trans_enc""")
cte("keyed", ("actions",), """
  SELECT uid, day, time, src, type_id, count(*) AS mult
  FROM actions GROUP BY uid, day, time, src, type_id""")
cte("seq", ("keyed",), """
  SELECT uid, day,
         CAST(sum(mult) OVER (PARTITION BY uid, day ORDER BY time, src, type_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - mult + 1 AS BIGINT) AS pos,
         time, src, type_id, mult
  FROM keyed""")
# Literal token rule on raw positions: for i < n-1 a pair when s[i] <> s[i+1],
# else a single when i+1 is the last index; n = 1 gives the single s[0].
cte("raw_seq", ("actions",), """
  SELECT uid, day, type_id,
         lead(type_id) OVER w AS nxt, lead(type_id, 2) OVER w AS nxt2,
         count(*) OVER (PARTITION BY uid, day) AS n
  FROM actions WINDOW w AS (PARTITION BY uid, day ORDER BY time, src, type_id)""")
cte("occ", ("raw_seq",), """
  SELECT uid, day, type_id AS a1, CASE WHEN nxt <> type_id THEN nxt END AS a2
  FROM raw_seq
  WHERE n = 1 OR (nxt IS NOT NULL AND (nxt <> type_id OR nxt2 IS NULL))""")
cte("rnk", ("occ",), """
  SELECT uid, concat_ws('-', a1, a2) AS tok, a1, a2, count(*) AS cnt
  FROM occ GROUP BY uid, a1, a2""")
cte("risky_rnk", ("rnk", "lbl"), "SELECT * FROM rnk WHERE uid IN (SELECT uid FROM lbl WHERE label = 1.0)")
cte("safe_rnk", ("rnk", "lbl"), "SELECT * FROM rnk WHERE uid IN (SELECT uid FROM lbl WHERE label = 0.0)")


def follow_rates_body(rank: str) -> str:
    return f"""
  SELECT a1, a2, support, total, {share('support', 'total')} AS share, CAST(rn AS INTEGER) AS rn
  FROM (SELECT a1, a2, support, CAST(sum(support) OVER (PARTITION BY a1) AS BIGINT) AS total,
               row_number() OVER (PARTITION BY a1 ORDER BY support DESC, a2) AS rn
        FROM (SELECT a1, a2, count(*) AS support FROM {rank} WHERE a2 IS NOT NULL GROUP BY a1, a2))
  WHERE rn <= 3"""


cte("fr", ("rnk",), follow_rates_body("rnk"))


# ---- rules (W9, R1-R4) -----------------------------------------------------
cte("ranked_pairs", ("rnk",), """
  SELECT uid, a1, a2, cnt, row_number() OVER (PARTITION BY uid, a1 ORDER BY cnt DESC, a2) AS rn
  FROM rnk WHERE a2 IS NOT NULL""")


def flags_body(l1: str, f1: tuple[str, ...], l2: str, f2: tuple[str, ...], limit: int) -> str:
    def inlist(xs):
        return ", ".join(f"'{x}'" for x in xs)
    return f"""
  SELECT uid,
         CAST(max(CASE WHEN rn = 1 AND a1 = '{l1}' AND a2 IN ({inlist(f1)}) THEN 1.0 ELSE 0.0 END) AS DOUBLE) AS flag1,
         CAST(max(CASE WHEN rn = 1 AND a1 = '{l2}' AND a2 IN ({inlist(f2)}) THEN 1.0 ELSE 0.0 END) AS DOUBLE) AS flag2,
         CAST(CASE WHEN max(greatest(CAST(a1 AS INTEGER), CAST(a2 AS INTEGER))) > {limit}
              THEN 0.0 ELSE 1.0 END AS DOUBLE) AS flag3
  FROM ranked_pairs GROUP BY uid"""


cte("flags", ("ranked_pairs",), flags_body("017", ("001", "040"), "102", ("103",), 105))

MERGED_COLS = (
    ["min_amt", "max_amt", "mid_amt", "avg_amt", "var_amt"]
    + ["amt_count", "thousand_rate", "ten_thousand_rate", "hundred_thousand_rate"]
    + ["op_" + c for c in DAY_COLS] + ["trans_" + c for c in DAY_COLS]
    + ["op_" + c for c in HOUR_COLS] + ["trans_" + c for c in HOUR_COLS]
    + ["op_top1", "op_top2", "op_top3", "trans_top1", "trans_top2", "trans_top3"]
    + ["flag1", "flag2", "flag3"]
)


def merged_sql(how: str = "JOIN") -> str:
    joins = [("sta", amount_stats_body("trans")), ("rng", user_amount_range_body("trans")), ("dy", "SELECT * FROM action_days"),
             ("hr", "SELECT * FROM action_hours"), ("tpo", "SELECT * FROM top_op"),
             ("tpt", "SELECT * FROM top_trans"), ("fl", "SELECT * FROM flags")]
    src = "lbl"
    for alias, body in joins:
        src += f"\n {how} ({body}) {alias} USING (uid)"
    return build(f"SELECT uid, label, {', '.join(MERGED_COLS)} FROM {src}",
                 "lbl", "trans", "action_days", "action_hours", "top_op", "top_trans", "flags")


def delimited_sql() -> str:
    # Doubles print the same in both engines between 1e-3 and 1e7 (Java
    # switches to exponent notation outside); all values here are in range.
    cols = ["uid", "label"] + MERGED_COLS
    line = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols)
    return f"SELECT concat_ws('|', {line}) AS value FROM ({merged_sql()})"


def parsed_sql() -> str:
    cols = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in MERGED_COLS)
    return f"SELECT uid, label, {cols} FROM ({merged_sql()})"


def _seq_restricted(value: str) -> str:
    return build(f"SELECT * FROM seq WHERE uid IN (SELECT uid FROM lbl WHERE label = {value})",
                 "seq", "lbl")


SECOND = ("CAST(substr(time, 1, 2) AS DOUBLE) * 3600.0 + CAST(substr(time, 4, 2) AS DOUBLE) * 60.0"
          " + CAST(substr(time, 7, 2) AS DOUBLE)")


def long_days_sql(threshold: int) -> str:
    return build(f"""
SELECT s.uid, s.day, s.pos, s.mult, CAST(c.n_actions AS BIGINT) AS n_actions,
       {SECOND.replace('time', 's.time')} AS second, CAST(s.type_id AS DOUBLE) AS action
FROM seq s JOIN (SELECT uid, day, sum(mult) AS n_actions FROM keyed GROUP BY uid, day
                 HAVING sum(mult) > {threshold}) c
  ON s.uid = c.uid AND s.day = c.day""", "seq", "keyed")


def hash_split_sql() -> str:
    b = "CAST((('0x' || substr(md5(uid), 1, 8))::BIGINT) % 10 AS INTEGER)"
    return build(f"SELECT uid, {b} AS bucket, {b} < 8 AS is_train "
                 "FROM (SELECT uid FROM ops UNION SELECT uid FROM trans)", "ops", "trans")


# ---- raw files (S1, S2) --------------------------------------------------------
RAW_OPS = f"""
  SELECT CAST(user_id AS VARCHAR) AS uid, CAST(day(ts) AS VARCHAR) AS day,
         coalesce(event_type, '') AS mode, {hms('ts')} AS time
  FROM events WHERE coalesce(event_type, '') <> 'purchase'"""


# ---- learned rules -----------------------------------------------------------
# Users of both classes per pair, from the ranked pairs of each class.
cte("class_pairs", ("ranked_pairs", "lbl"), """
  SELECT uid, a1, a2, label FROM ranked_pairs JOIN lbl USING (uid)""")
cte("learned", ("class_pairs",), """
  SELECT a1, a2, n_risky, n_safe, risky_users, safe_users, lift, chi2,
         CAST(row_number() OVER (PARTITION BY a1 ORDER BY chi2 DESC, a2) AS INTEGER) AS rn
  FROM (SELECT *, ((a + 0.5::DOUBLE) / (r + 1.0::DOUBLE)) / ((b + 0.5::DOUBLE) / (s + 1.0::DOUBLE)) AS lift,
               CASE WHEN r > 0 AND s > 0 AND a + b < r + s
                    THEN (r + s) * (a * (s - b) - b * (r - a)) * (a * (s - b) - b * (r - a))
                         / ((a + b) * (r + s - a - b) * r * s) END AS chi2
        FROM (SELECT *, CAST(n_risky AS DOUBLE) AS a, CAST(n_safe AS DOUBLE) AS b,
                     CAST(risky_users AS DOUBLE) AS r, CAST(safe_users AS DOUBLE) AS s
              FROM (SELECT a1, a2, CAST(count_if(label = 1) AS BIGINT) AS n_risky,
                           CAST(count_if(label = 0) AS BIGINT) AS n_safe
                    FROM class_pairs GROUP BY a1, a2)
              CROSS JOIN (SELECT count(DISTINCT CASE WHEN label = 1 THEN uid END) AS risky_users,
                                 count(DISTINCT CASE WHEN label = 0 THEN uid END) AS safe_users
                          FROM class_pairs)))
  WHERE lift > 1 AND chi2 >= 3.841458820694124::DOUBLE""")
cte("rule", ("learned",), """
  SELECT l.a1, l.a2, t.place FROM learned l JOIN (
    SELECT a1, row_number() OVER (ORDER BY max(chi2) DESC, a1) AS place FROM learned GROUP BY a1
  ) t USING (a1) WHERE l.rn <= 2 AND t.place <= 2""")


def learned_flags_sql() -> str:
    def flag(place: int) -> str:
        return (f"CAST(max(CASE WHEN p.rn = 1 AND r.place = {place} THEN 1.0 ELSE 0.0 END)"
                f" AS DOUBLE) AS flag{place}")
    return build(f"""
  SELECT p.uid, {flag(1)}, {flag(2)},
         CAST(CASE WHEN max(greatest(CAST(p.a1 AS INTEGER), CAST(p.a2 AS INTEGER))) > 105
              THEN 0.0 ELSE 1.0 END AS DOUBLE) AS flag3
  FROM ranked_pairs p LEFT JOIN rule r ON p.a1 = r.a1 AND p.a2 = r.a2 GROUP BY p.uid""",
                 "ranked_pairs", "rule")


# ---- tree (M3-M6) ---------------------------------------------------------------
def root_split_sql() -> str:
    """The learner's loop over the sorted values, one step at a time, then every gain.

    A candidate lies before a value when the running count before it is nearer to the next
    multiple of rows / bins than the running count after it.
    """
    values = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0)" for c in MERGED_COLS)
    names = ", ".join(f"'{c}'" for c in MERGED_COLS)

    def gini(n: str, n1: str) -> str:
        p0, p1 = f"(({n} - {n1})::DOUBLE / {n}::DOUBLE)", f"({n1}::DOUBLE / {n}::DOUBLE)"
        return f"(1.0::DOUBLE - {p0} * {p0} - {p1} * {p1})"

    return f"""
WITH RECURSIVE train AS (
  SELECT label, [{values}] AS v FROM ({merged_sql()})
  WHERE CAST((('0x' || substr(md5(uid), 1, 8))::BIGINT) % 10 AS INTEGER) < 8
), long AS (
  SELECT label, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS f FROM train
), hist AS (
  SELECT f, x, count(*) AS n, count_if(label = 1) AS n1 FROM long GROUP BY f, x
), pre AS (
  SELECT f, x, lead(x) OVER o AS x_next, row_number() OVER o AS i,
         sum(n) OVER o AS c, sum(n) OVER o + lead(n) OVER o AS c_next, sum(n1) OVER o AS c1,
         count(*) OVER w AS vals, sum(n) OVER w AS n_all, sum(n1) OVER w AS n1_all
  FROM hist WINDOW w AS (PARTITION BY f), o AS (PARTITION BY f ORDER BY x)
), steps AS (
  SELECT *, least(32, n_all) AS bins, n_all::DOUBLE / least(32, n_all) AS stride
  FROM pre WHERE x_next IS NOT NULL
), walk(f, i, k, cut) AS (
  SELECT f, i, CASE WHEN abs(c - stride) < abs(c_next - stride) THEN 1 ELSE 0 END,
         abs(c - stride) < abs(c_next - stride) FROM steps WHERE i = 1
  UNION ALL
  SELECT s.f, s.i,
         w.k + CASE WHEN abs(c - stride * (k + 1)) < abs(c_next - stride * (k + 1))
                    THEN 1 ELSE 0 END,
         abs(c - stride * (k + 1)) < abs(c_next - stride * (k + 1))
  FROM walk w JOIN steps s ON s.f = w.f AND s.i = w.i + 1
), gains AS (
  SELECT s.f, (x + x_next) / 2.0::DOUBLE AS threshold, c, c1, n_all - c AS d, n1_all - c1 AS d1,
         {gini('n_all', 'n1_all')} - c::DOUBLE / n_all::DOUBLE * {gini('c', 'c1')}
         - (n_all - c)::DOUBLE / n_all::DOUBLE * {gini('(n_all - c)', '(n1_all - c1)')} AS gain
  FROM steps s JOIN walk USING (f, i) WHERE vals <= bins OR cut
)
SELECT [{names}][f + 1] AS feature, CAST(f AS INTEGER) AS feature_index, threshold, gain,
       CAST(c - c1 AS BIGINT) AS left_0, CAST(c1 AS BIGINT) AS left_1,
       CAST(d - d1 AS BIGINT) AS right_0, CAST(d1 AS BIGINT) AS right_1
FROM gains WHERE gain > 0 ORDER BY gains.gain DESC, f, threshold LIMIT 1"""


def fixed_tree_sql() -> str:
    """The fixed tree of the catalogue as nested conditions."""
    def n(c: str) -> str:
        return f"coalesce(CAST({c} AS DOUBLE), 0.0)"
    return f"""SELECT uid, CASE
  WHEN {n('avg_amt')} <= 45.0 THEN
    CASE WHEN {n('op_afternoon_rate')} <= 18.275 THEN 0
         WHEN {n('trans_days_span')} <= 27.0 THEN 0 ELSE 1 END
  WHEN {n('var_amt')} <= 2000.0 THEN 1 ELSE 0 END AS prediction
FROM ({merged_sql()})"""


def oracle_queries() -> dict[str, str]:
    tuned = flags_body("003", ("001", "104"), "102", ("103",), 105)
    return {
        "slim_operations": build("SELECT * FROM ops", "ops"),
        "slim_transactions": build("SELECT * FROM trans", "trans"),
        "all_users": build("SELECT uid FROM ops UNION SELECT uid FROM otrans", "ops", "otrans"),
        "default_labels": build("SELECT uid, 0.0::DOUBLE AS label FROM "
                                "(SELECT uid FROM ops UNION SELECT uid FROM trans)", "ops", "trans"),
        "customer_labels": build("SELECT * FROM lbl", "lbl"),
        "user_amount_stats": amount_stats_sql("trans"),
        "user_amount_stats_orders": amount_stats_sql("otrans"),
        "user_amount_stats_net": net_stats_sql(),
        "amount_range_global": amount_range_sql("ltrans"),
        "amount_range_global_orders": amount_range_sql("otrans"),
        "amount_range_user": user_amount_range_sql("ltrans"),
        "days_range": build(days_select("ops", "op_day"), "ops"),
        "action_days": build("SELECT * FROM action_days", "action_days"),
        "hours_range": build(hours_select("ops", "op_time"), "ops"),
        "hours_range_orders": build(hours_select("otrans", "trans_time"), "otrans"),
        "action_hours": build("SELECT * FROM action_hours", "action_hours"),
        "op_type_counts": build("SELECT op_type AS type, count(*) AS cnt FROM ops GROUP BY op_type",
                                "ops"),
        "trans_type_counts": build("SELECT trans_type1 AS type, count(*) AS cnt FROM trans "
                                   "GROUP BY trans_type1", "trans"),
        "op_type_index": build("SELECT * FROM op_idx", "op_idx"),
        "trans_type_index": build("SELECT * FROM trans_idx", "trans_idx"),
        "encoded_operations": build("SELECT * FROM op_enc", "op_enc"),
        "encoded_transactions": build("SELECT * FROM trans_enc", "trans_enc"),
        "user_type_counts": build("SELECT uid, type_id, count(*) AS cnt FROM op_enc "
                                  "GROUP BY uid, type_id", "op_enc"),
        "user_trans_type_counts": build("SELECT uid, type_id, count(*) AS cnt FROM trans_enc "
                                        "GROUP BY uid, type_id", "trans_enc"),
        "top3_op_types": build("SELECT * FROM top_op", "top_op"),
        "top3_trans_types": build("SELECT * FROM top_trans", "top_trans"),
        "daily_sequences": build("SELECT * FROM seq", "seq"),
        "long_days": long_days_sql(5),
        "action_tokens": build("SELECT uid, day, concat_ws('-', a1, a2) AS tok, a1, a2, "
                               "count(*) AS n FROM occ GROUP BY uid, day, a1, a2", "occ"),
        "user_action_rank": build("SELECT * FROM rnk", "rnk"),
        "risky_sequences": _seq_restricted("1.0"),
        "not_risky_sequences": _seq_restricted("0.0"),
        "risky_action_rank": build("SELECT * FROM risky_rnk", "risky_rnk"),
        "not_risky_action_rank": build("SELECT * FROM safe_rnk", "safe_rnk"),
        "follow_rates": build("SELECT * FROM fr", "fr"),
        "follow_rates_risky": build(follow_rates_body("risky_rnk"), "risky_rnk"),
        "follow_rates_not_risky": build(follow_rates_body("safe_rnk"), "safe_rnk"),
        "follow_rates_text": build(
            "SELECT a1, '[' || string_agg('(' || a2 || ',' || printf('%.2f', share) || ')', ','"
            " ORDER BY rn) || ']' AS related FROM fr GROUP BY a1", "fr"),
        "dominant_follower": build("SELECT uid, a1, a2, cnt FROM ranked_pairs WHERE rn = 1",
                                   "ranked_pairs"),
        "risk_flags": build("SELECT * FROM flags", "flags"),
        "risk_flags_tuned": build(tuned, "ranked_pairs"),
        "merged_features": merged_sql("JOIN"),
        "merged_features_left": merged_sql("LEFT JOIN"),
        "merged_features_bucketed": merged_sql("JOIN"),
        "raw_csv_operations": RAW_OPS,
        "raw_csv_quarantine": "SELECT concat_ws(',', uid, day, mode) AS line, count(*) AS n"
                              f" FROM ({RAW_OPS}) WHERE CAST(uid AS BIGINT) % 97 = 0 GROUP BY 1",
        "learned_rules": build("SELECT * FROM learned", "learned"),
        "risk_flags_learned": learned_flags_sql(),
        "tree_root_split": root_split_sql(),
        "predictions_from_nodes": fixed_tree_sql(),
        "delimited_features": delimited_sql(),
        "parsed_features": parsed_sql(),
        "hash_split": hash_split_sql(),
        "delimited_operations": build(
            "SELECT concat_ws('|', uid, CAST(op_day AS VARCHAR), op_type, op_time) AS value FROM ops",
            "ops"),
        "parsed_operations": build("SELECT * FROM ops", "ops"),
        "delimited_transactions": build(
            "SELECT concat_ws('|', uid, trans_channel, CAST(trans_day AS VARCHAR),"
            " CAST(trans_amt AS VARCHAR), trans_time, trans_type1, trans_type2) AS value FROM trans",
            "trans"),
        "parsed_transactions": build("SELECT * FROM trans", "trans"),
        "strict_operations": build("SELECT * FROM op_enc", "op_enc"),
        "feature_vectors": f"""
            SELECT uid, CAST({len(MERGED_COLS)} AS BIGINT) AS n_features,
                   round({' + '.join(f'coalesce(CAST({c} AS DOUBLE), 0.0)' for c in MERGED_COLS)}, 3)
                   AS total
            FROM ({merged_sql('JOIN')})""",
        "heldout_users": build(
            "SELECT uid, label FROM lbl"
            " WHERE CAST((('0x' || substr(md5(uid), 1, 8))::BIGINT) % 10 AS INTEGER) >= 8", "lbl"),
        "flag_accuracy": build(
            "SELECT CAST(avg(CASE WHEN flag3 = label THEN 1.0 ELSE 0.0 END) AS DOUBLE) AS accuracy,"
            " count(*) AS n_rows FROM flags JOIN lbl USING (uid)", "flags", "lbl"),
        "ordered_user_amount": build(
            "SELECT uid, amt_count, row_number() OVER (ORDER BY amt_count DESC, uid) AS position"
            " FROM (SELECT uid, count(*) AS amt_count FROM trans GROUP BY uid)", "trans"),
        "ordered_op_type_count": build(
            "SELECT type, cnt, row_number() OVER (ORDER BY cnt DESC, type) AS position FROM"
            " (SELECT op_type AS type, count(*) AS cnt FROM ops GROUP BY op_type)", "ops"),
        "ordered_user_actions": build(
            "SELECT uid, day, pos, row_number() OVER (ORDER BY uid, day, pos) AS position FROM seq",
            "seq"),
        "ordered_user_action_rank": build(
            "SELECT uid, tok, cnt, row_number() OVER (ORDER BY uid, cnt DESC, tok) AS position"
            " FROM rnk", "rnk"),
        "ordered_risky_related_action": build(
            "SELECT a1, a2, rn, row_number() OVER (ORDER BY a1, rn) AS position FROM ("
            + follow_rates_body("risky_rnk") + ")", "risky_rnk"),
    }
