"""DuckDB SQL that computes the same rows as each query, written on its own terms."""

from __future__ import annotations

NUMBER = r"[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|inf|infinity)"

ACCOUNTS = """
o AS (
  SELECT o_custkey AS k, count(*) AS n_orders, min(o_orderdate) AS first_dt, max(o_orderdate) AS last_dt,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total_amt
  FROM orders WHERE o_orderdate < TIMESTAMP '2000-09-22 00:00:00' GROUP BY o_custkey),
f AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderdate >= TIMESTAMP '2000-09-22 00:00:00'),
b AS (
  SELECT c.c_custkey AS k, c.c_mktsegment AS seg, n.n_regionkey AS rk, c.c_acctbal AS bal,
         o.n_orders, o.total_amt,
         CASE WHEN c.c_custkey % 101 = 0 THEN 0
              ELSE (year(o.last_dt) - year(o.first_dt)) * 12 + month(o.last_dt) - month(o.first_dt) END AS tenure,
         CASE WHEN f.k IS NULL THEN 'Yes' ELSE 'No' END AS label,
         CASE c.c_custkey % 3 WHEN 0 THEN 'No' WHEN 1 THEN 'DSL' ELSE 'Fiber optic' END AS inet
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN o ON o.k = c.c_custkey LEFT JOIN f ON f.k = c.c_custkey),
accounts AS (
  SELECT CAST(k AS VARCHAR) AS account_id, seg AS segment,
    CASE WHEN bal < 0 THEN 1 ELSE 0 END AS in_debt,
    rk % 2 = 0 AS partner,
    CAST(tenure AS INTEGER) AS tenure,
    inet AS internet,
    CASE WHEN inet = 'No' THEN 'No internet service' WHEN k % 5 < 2 THEN 'Yes' ELSE 'No' END AS security,
    CASE WHEN inet = 'No' THEN 'No internet service' WHEN k % 7 < 3 THEN 'Yes' ELSE 'No' END AS backup,
    CASE k % 4 WHEN 0 THEN 'One year' WHEN 1 THEN 'Two year' ELSE 'Month-to-month' END AS contract,
    CASE k % 2 WHEN 0 THEN 'Electronic check' ELSE 'Mailed check' END AS payment,
    CAST(total_amt AS DOUBLE) / n_orders AS monthly,
    CASE WHEN tenure = 0 AND k % 2 = 0 THEN ' ' WHEN k % 97 = 0 THEN '' ELSE CAST(total_amt AS VARCHAR) END AS total_text,
    label
  FROM b)
"""

SCORE_LOG = """
score_log AS (
  SELECT CAST(user_id AS VARCHAR) AS account_id, round(value / (value + 50), 6) AS probability,
    CASE WHEN round(value / (value + 50), 6) >= 0.441 THEN 1 ELSE 0 END AS flag,
    CAST(0.441 AS DOUBLE) AS threshold, event_type AS model, 'm/v1' AS model_version,
    concat(event_type, '-', lpad(CAST(event_id AS VARCHAR), 10, '0')) AS run_id,
    'events' AS source_table, ts AS scored_at
  FROM events)
"""

SCORED_EVENTS = """
scored AS (
  SELECT run_id, account_id, model, CASE WHEN model IN ('error', 'click') THEN 1 ELSE 0 END AS y,
    probability AS p
  FROM score_log)
"""

SCORED_DOCS = """
scored AS (
  SELECT d.doc_id, d.lang AS grp, l.quality AS y,
    round(CAST(((d.doc_id * 7919) % 1000 + 500 * l.quality) AS DOUBLE) / 1500, 3) AS p
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
"""

AMOUNTS = f"""
amounts AS (
  SELECT *, CASE WHEN regexp_full_match(trim(total_text), '{NUMBER}')
                 THEN CAST(trim(total_text) AS DOUBLE) END AS amount,
    CASE label WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS y
  FROM accounts)
"""

CLEANED = """
cleaned AS (
  SELECT account_id, segment, CAST(in_debt AS DOUBLE) AS in_debt,
    CASE WHEN partner THEN 'True' ELSE 'False' END AS partner, CAST(tenure AS DOUBLE) AS tenure,
    internet, security, backup, contract, payment, monthly,
    CASE WHEN tenure = 0 THEN coalesce(amount, 0) ELSE amount END AS total_text, label, y
  FROM amounts WHERE tenure = 0 OR amount IS NOT NULL)
"""

# Distinct scores with cumulative counts from the top.
CURVE = """
steps AS (SELECT p, sum(y) AS pos, count(*) AS n FROM scored GROUP BY p),
curve AS (
  SELECT p, CAST(pos AS DOUBLE) AS pos, CAST(n AS DOUBLE) AS n,
    CAST(sum(pos) OVER down AS DOUBLE) AS cum_pos, CAST(sum(n) OVER down AS DOUBLE) AS cum_n,
    CAST(sum(pos) OVER () AS DOUBLE) AS total_pos, CAST(sum(n) OVER () AS DOUBLE) AS total_n
  FROM steps WINDOW down AS (ORDER BY p DESC ROWS UNBOUNDED PRECEDING)),
points AS (SELECT p AS threshold, cum_pos / cum_n AS "precision", cum_pos / total_pos AS recall FROM curve)
"""

# Rank of each row in its class by hash, and the sizes of the three parts.
SPLIT = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5(concat('split:', account_id)), account_id) AS rk
  FROM cleaned),
sizes AS (SELECT y, count(*) AS c FROM cleaned GROUP BY y),
dev AS (
  SELECT y, c, total, n_dev, floor(n_dev * c / total) AS base, n_dev * c / total - floor(n_dev * c / total) AS frac
  FROM (SELECT y, c, CAST(sum(c) OVER () AS DOUBLE) AS total,
          sum(c) OVER () - ceil(CAST(0.15 AS DOUBLE) * CAST(sum(c) OVER () AS DOUBLE)) AS n_dev FROM sizes)),
dev2 AS (
  SELECT y, c, n_dev, base + CASE WHEN row_number() OVER (ORDER BY frac DESC, y) <= n_dev - sum(base) OVER () THEN 1 ELSE 0 END AS d
  FROM dev),
tr AS (
  SELECT y, c, d, n_train, floor(n_train * d / n_dev) AS base, n_train * d / n_dev - floor(n_train * d / n_dev) AS frac
  FROM (SELECT *, n_dev - ceil(CAST(0.15 AS DOUBLE) / (1.0 - CAST(0.15 AS DOUBLE)) * n_dev) AS n_train FROM dev2)),
quotas AS (
  SELECT y, c - d AS n_test,
    d - (base + CASE WHEN row_number() OVER (ORDER BY frac DESC, y) <= n_train - sum(base) OVER () THEN 1 ELSE 0 END) AS n_val
  FROM tr),
parts AS (
  SELECT r.* EXCLUDE (rk), CASE WHEN rk <= n_test THEN 'test' WHEN rk <= n_test + n_val THEN 'validation' ELSE 'train' END AS split
  FROM ranked r JOIN quotas q ON r.y = q.y)
"""

NUMERIC = ("tenure", "monthly", "total_text", "in_debt")
# The levels of the categorical columns of `accounts`.
LEVELS = {
    "partner": ("False", "True"),
    "internet": ("DSL", "Fiber optic", "No"),
    "security": ("No", "No internet service", "Yes"),
    "backup": ("No", "No internet service", "Yes"),
    "contract": ("Month-to-month", "One year", "Two year"),
    "payment": ("Electronic check", "Mailed check"),
}
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def _with(*parts: str) -> str:
    return "WITH " + ",".join(p.strip().rstrip(",") for p in parts) + "\n"


FROM_ACCOUNTS = _with(ACCOUNTS)
FROM_AMOUNTS = _with(ACCOUNTS, AMOUNTS)
FROM_CLEANED = _with(ACCOUNTS, AMOUNTS, CLEANED)
FROM_PARTS = _with(ACCOUNTS, AMOUNTS, CLEANED, SPLIT)
FROM_LOG = _with(SCORE_LOG)
FROM_EVENTS = _with(SCORE_LOG, SCORED_EVENTS)
FROM_DOCS = _with(SCORED_DOCS)
CURVE_EVENTS = _with(SCORE_LOG, SCORED_EVENTS, CURVE)
CURVE_DOCS = _with(SCORED_DOCS, CURVE)


def _dummies(*, drop_first: bool = False, prefix: str = "", markers: bool = True) -> list[tuple[str, str]]:
    """(expression, name) of each dummy of the cleaned table."""
    out = []
    for column, levels in LEVELS.items():
        for level in levels[1 if drop_first else 0 :]:
            if markers and "No internet service" in level:
                continue
            test = f"CASE WHEN {column} = '{level}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"
            out.append((test, f"{prefix}{column}_{level}"))
    return out


def _select(columns: list[tuple[str, str]]) -> str:
    return ", ".join(f'{e} AS "{n}"' for e, n in columns)


CLEANED_COLUMNS = """account_id, segment, in_debt, partner, tenure, internet, security, backup, contract,
  payment, monthly, total_text, label"""
ACCOUNT_COLUMNS = """account_id, segment, in_debt, partner, tenure, internet, security, backup, contract,
  payment, monthly, total_text, label"""
FEATURES = """tenure, monthly, total_text, in_debt,
  partner, internet, security, backup, contract, payment"""
ENGINEERED = """
  total_text / greatest(tenure, 1) AS avg_monthly_charge,
  CASE WHEN tenure <= -1 THEN 'nan' WHEN tenure <= 12 THEN '0-12' WHEN tenure <= 24 THEN '13-24'
       WHEN tenure <= 48 THEN '25-48' ELSE '49+' END AS tenure_bucket,
  CAST((security = 'Yes')::INT + (backup = 'Yes')::INT AS DOUBLE) AS addon_count,
  CAST((contract = 'Month-to-month' AND payment = 'Electronic check')::INT AS DOUBLE) AS month_to_month_electronic"""


def _describe(source: str, columns: list[str], digits: int) -> str:
    parts = [
        f"""SELECT '{c}' AS "column", count(v) AS count, round(avg(v), {digits}) AS mean,
        round(stddev_samp(v), {digits}) AS std, round(min(v), {digits}) AS min,
        round(quantile_cont(v, 0.25), {digits}) AS q25, round(quantile_cont(v, 0.5), {digits}) AS q50,
        round(quantile_cont(v, 0.75), {digits}) AS q75, round(max(v), {digits}) AS max
        FROM (SELECT CAST({e} AS DOUBLE) AS v FROM {source})"""
        for e, c in ((c.split(" AS ")[0], c.split(" AS ")[-1]) for c in columns)
    ]
    return "\nUNION ALL\n".join(parts)


def _exploration(*, drop_first: bool, markers: bool = False) -> list[tuple[str, str]]:
    columns = [
        ("CAST(in_debt AS DOUBLE)", "in_debt"),
        ("CAST(partner AS INT)::DOUBLE", "partner"),
        ("CAST(tenure AS DOUBLE)", "tenure"),
        ("monthly", "monthly"),
        ("amount", "total_text"),
    ]
    dummies = [(e, n) for e, n in _dummies(drop_first=drop_first, markers=markers) if not n.startswith("partner_")]
    segments = [
        (f"CASE WHEN segment = '{s}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END", f"segment_{s}")
        for s in SEGMENTS[1 if drop_first else 0 :]
    ]
    return columns + dummies + segments


def _corr_rows(columns: list[tuple[str, str]], source: str) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{n}' AS feature, CASE WHEN min(v) < max(v) THEN corr(v, y) END AS correlation
        FROM (SELECT {e} AS v, CAST(y AS DOUBLE) AS y FROM {source})"""
        for e, n in columns
    )


def _top_corr(columns: list[tuple[str, str]], source: str, k: int, *, signed: bool = False) -> str:
    key = "correlation" if signed else "abs(correlation)"
    return f"""SELECT feature, round(correlation, 6) AS correlation FROM ({_corr_rows(columns, source)})
    WHERE correlation IS NOT NULL ORDER BY round({key}, 9) DESC, feature LIMIT {k}"""


def _pairs(*, markers: bool) -> str:
    columns = [("CAST(y AS DOUBLE)", "label_flag"), *_exploration(drop_first=True, markers=markers)]
    rows = []
    for i, (a, name_a) in enumerate(columns):
        for b, name_b in columns[i + 1 :]:
            first, second = sorted((name_a, name_b))
            rows.append(
                f"SELECT '{first}' AS feature_a, '{second}' AS feature_b, corr({a}, {b}) AS correlation FROM amounts"
            )
    return f"""SELECT feature_a, feature_b, round(correlation, 6) AS correlation
    FROM ({" UNION ALL ".join(rows)})
    WHERE correlation IS NOT NULL AND NOT isnan(correlation)
    ORDER BY round(abs(correlation), 9) DESC, feature_a, feature_b LIMIT 10"""


def _scaled(columns: tuple[str, ...], fitted: str, alias: str = "") -> str:
    return ", ".join(
        f"""round(({c} - (SELECT avg({c}) FROM {fitted})) / (SELECT stddev_pop({c}) FROM {fitted}), 6) AS "{alias}{c}" """
        for c in columns
    )


RATES = """
  CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS "precision",
  CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall"""


def _evaluate(threshold: float) -> str:
    return f"""
, cells AS (
  SELECT sum(CASE WHEN p >= {threshold} THEN pos ELSE 0 END) AS tp,
    sum(CASE WHEN p >= {threshold} THEN n - pos ELSE 0 END) AS fp,
    sum(pos) AS positives, sum(n) AS rows_all,
    sum(pos * cum_pos / cum_n) / sum(pos) AS pr_auc,
    sum((n - pos) * (cum_pos - pos / 2)) / (sum(pos) * (sum(n) - sum(pos))) AS roc_auc
  FROM curve),
four AS (SELECT *, positives - tp AS fn, rows_all - positives - fp AS tn FROM cells),
rates AS (SELECT *, {RATES} FROM four),
scores AS (
  SELECT *, 2 * "precision" * recall / nullif("precision" + recall, 0) AS f1,
    5 * "precision" * recall / nullif(4 * "precision" + recall, 0) AS f2,
    (tp * tn - fp * fn) / nullif(sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 0) AS mcc
  FROM rates)
"""


EVALUATION = """SELECT CAST({t} AS DOUBLE) AS threshold, round(pr_auc, 6) AS pr_auc, round(roc_auc, 6) AS roc_auc,
  round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1, round(f2, 6) AS f2,
  round(mcc, 6) AS mcc, CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn,
  CAST(tp AS BIGINT) AS tp, CAST(positives AS BIGINT) AS positives, CAST(rows_all AS BIGINT) AS "rows"
  FROM scores"""

POINTS = """SELECT round(threshold, 6) AS threshold, round("precision", 6) AS "precision", round(recall, 6) AS recall
  FROM (SELECT * FROM points UNION ALL SELECT CAST(NULL AS DOUBLE), 1, 0)"""


def _best(strategy: str) -> str:
    objective = {
        "f1": '2 * "precision" * recall / ("precision" + recall + 1e-12)',
        "f2": '5 * "precision" * recall / (4 * "precision" + recall + 1e-12)',
        "recall_floor": 'CASE WHEN recall >= 0.75 THEN "precision" ELSE recall END',
    }[strategy]
    first = "recall >= 0.75 DESC, " if strategy == "recall_floor" else ""
    return f"""SELECT '{strategy}' AS strategy, round(threshold, 6) AS threshold, round("precision", 6) AS "precision",
      round(recall, 6) AS recall, round(objective, 6) AS objective
      FROM (SELECT *, {objective} AS objective FROM points) ORDER BY {first}objective DESC, threshold LIMIT 1"""


def _groups(group: str, attribute: str, threshold: float) -> str:
    return f"""SELECT '{attribute}' AS attribute, {group} AS grp, count(*) AS n,
      round(avg(y), 6) AS actual_rate,
      round(avg(CASE WHEN p >= {threshold} THEN 1.0::DOUBLE ELSE 0 END), 6) AS flagged_rate,
      round(coalesce(CAST(sum(CASE WHEN p >= {threshold} THEN y END) AS DOUBLE) / nullif(sum(y), 0), 0), 6) AS recall,
      round(coalesce(CAST(sum(CASE WHEN p >= {threshold} THEN y END) AS DOUBLE)
            / nullif(sum(CASE WHEN p >= {threshold} THEN 1 END), 0), 0), 6) AS "precision"
      FROM {{source}} GROUP BY {group}"""


LOG_COLUMNS = "account_id, probability, flag, threshold, model, model_version, run_id, source_table, scored_at"
LATEST = f"""SELECT {LOG_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY scored_at DESC, run_id DESC) AS rn FROM score_log)
  WHERE rn = 1"""

_describe_accounts = _describe("amounts", ["tenure", "monthly", "amount AS total_text", "in_debt"], 4)
_drift = """, drift AS (SELECT *, amount / tenure AS avg_charge, monthly - amount / tenure AS charge_diff
  FROM amounts WHERE tenure > 0 AND amount IS NOT NULL) """

ORACLE: dict[str, str] = {
    "load_csv": f"{FROM_ACCOUNTS} SELECT {ACCOUNT_COLUMNS} FROM accounts",
    "load_table": "SELECT * FROM customer",
    "load_scoring": f"{FROM_ACCOUNTS} SELECT * EXCLUDE (label) FROM accounts",
    "seed_scoring": f"""{FROM_ACCOUNTS} SELECT * EXCLUDE (label),
        true AS stamped_today
        FROM accounts ORDER BY md5(concat('seed:', account_id)), account_id LIMIT 500""",
    "write_predictions": f"""{FROM_LOG} SELECT account_id, probability, CAST(flag AS BIGINT) AS flag, threshold, model,
        model_version, model AS run_id, source_table, scored_at FROM score_log""",
    "export_jsonl": f"{FROM_CLEANED} SELECT {FEATURES}, account_id FROM cleaned",
    "parse_jsonl": f"""{FROM_LOG} SELECT account_id, probability, CAST(flag AS BIGINT) AS flag, threshold FROM score_log
        UNION ALL SELECT account_id, probability, CAST(flag AS BIGINT), threshold FROM score_log WHERE model = 'view'""",
    "export_cache": f"""{FROM_LOG} SELECT account_id, CAST(flag AS BIGINT) AS flag, model, model_version, probability,
        run_id, CAST(scored_at AS VARCHAR) AS scored_at, threshold FROM ({LATEST})""",
    "lookup_keys": f"""{FROM_LOG} SELECT CAST(c_custkey AS VARCHAR) AS account_id, probability, flag, threshold, model,
        model_version, run_id, source_table, scored_at, l.account_id IS NOT NULL AS found
        FROM customer LEFT JOIN ({LATEST}) l ON l.account_id = CAST(c_custkey AS VARCHAR)""",
    "lookup_keyed": f"""{FROM_LOG} SELECT CAST(c_custkey AS VARCHAR) AS account_id, probability, flag, threshold, model,
        model_version, run_id, source_table, scored_at, l.account_id IS NOT NULL AS found
        FROM customer LEFT JOIN ({LATEST}) l ON l.account_id = CAST(c_custkey AS VARCHAR)""",
    "lookup_keyed_few": f"""{FROM_LOG} SELECT k.account_id, probability, flag, threshold, model,
        model_version, run_id, source_table, scored_at, l.account_id IS NOT NULL AS found
        FROM (VALUES ('7'), ('17'), ('170'), ('absent')) k(account_id) LEFT JOIN ({LATEST}) l USING (account_id)""",
    "lookup_one": f"{FROM_LOG} SELECT * FROM score_log WHERE account_id = '7'",
    "clean_customers": f"{FROM_CLEANED} SELECT {CLEANED_COLUMNS} FROM cleaned",
    "quarantine": f"""{FROM_AMOUNTS} SELECT {ACCOUNT_COLUMNS},
        CASE WHEN coalesce(trim(total_text), '') = '' THEN 'missing amount' ELSE 'unreadable amount' END AS reason
        FROM amounts WHERE amount IS NULL AND tenure <> 0""",
    "quarantine_summary": f"""{FROM_AMOUNTS} SELECT
        CASE WHEN coalesce(trim(total_text), '') = '' THEN 'missing amount' ELSE 'unreadable amount' END AS reason,
        count(*) AS n FROM amounts WHERE amount IS NULL AND tenure <> 0 GROUP BY 1""",
    "select_features": f"{FROM_CLEANED} SELECT {FEATURES} FROM cleaned",
    "split_roles": f"""{FROM_CLEANED} SELECT account_id, CAST(y AS INTEGER) AS y, {FEATURES}, {ENGINEERED} FROM cleaned""",
    "make_dataset": f"{FROM_CLEANED} SELECT account_id, CAST(y AS INTEGER) AS y, {FEATURES} FROM cleaned",
    "unknown_labels": f"""{FROM_AMOUNTS} SELECT CAST(count(*) FILTER (WHERE y IS NULL) AS BIGINT) AS unknown,
        count(*) AS total FROM amounts""",
    "scoring_features": f"{FROM_CLEANED} SELECT account_id, {FEATURES} FROM cleaned",
    "demographics": f"{FROM_CLEANED} SELECT account_id, segment FROM cleaned",
    "validate_schema": f"{FROM_CLEANED} SELECT contract, payment, count(*) AS n FROM cleaned GROUP BY ALL",
    "threshold_flag": f"""{FROM_LOG} SELECT run_id, probability, CASE WHEN probability >= 0.441 THEN 1 ELSE 0 END AS flag,
        CAST(0.441 AS DOUBLE) AS threshold FROM score_log""",
    "reapply_threshold": f"""{FROM_LOG} SELECT * REPLACE (CASE WHEN probability >= 0.8 THEN 1 ELSE 0 END AS flag,
        CAST(0.8 AS DOUBLE) AS threshold) FROM ({LATEST})""",
    "filter_run": f"""{FROM_LOG} SELECT * REPLACE (model AS run_id) FROM score_log WHERE model = 'purchase'
        ORDER BY probability DESC, account_id, model LIMIT 20""",
    "fairness_join": f"""{FROM_EVENTS} {_groups("c_mktsegment", "segment", 0.441).format(
        source="scored JOIN customer ON CAST(c_custkey AS VARCHAR) = account_id")}""",
    "fairness_unmatched": f"""{FROM_EVENTS} SELECT
        CAST(count(*) FILTER (WHERE account_id NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer)) AS BIGINT) AS unmatched_rows,
        CAST(0 AS BIGINT) AS ambiguous_ids FROM scored""",
    "label_balance": f"""{FROM_ACCOUNTS} SELECT label, count(*) AS customers,
        round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 1) AS pct FROM accounts GROUP BY label""",
    "dup_check": f"""{FROM_LOG} SELECT count(*) AS total_rows, count(DISTINCT account_id) AS distinct_keys FROM score_log""",
    "rate_by_category": FROM_AMOUNTS
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {e} AS level, count(*) AS customers,
        round(100.0::DOUBLE * sum(y) / count(*), 1) AS rate_pct FROM amounts GROUP BY 2"""
        for c, e in (
            ("contract", "contract"),
            ("internet", "internet"),
            ("payment", "payment"),
            ("partner", "CASE WHEN partner THEN 'True' ELSE 'False' END"),
        )
    ),
    "rate_by_bucket_sql": f"""{FROM_AMOUNTS} SELECT CASE WHEN tenure < 12 THEN '0-11 months' WHEN tenure < 24 THEN '12-23 months'
        WHEN tenure < 48 THEN '24-47 months' ELSE '48+ months' END AS tenure_bucket, count(*) AS customers,
        round(100.0::DOUBLE * sum(y) / count(*), 1) AS rate_pct FROM amounts GROUP BY 1""",
    "rate_by_bins": f"""{FROM_AMOUNTS}, bins AS (SELECT CAST(i AS INTEGER) AS bin FROM range(6) t(i))
        SELECT bin, concat('(', bin * 12, ', ', bin * 12 + 12, ']') AS label, count(a.y) AS n, round(avg(a.y), 6) AS rate
        FROM bins LEFT JOIN amounts a ON a.tenure > bin * 12 AND a.tenure <= bin * 12 + 12 GROUP BY bin""",
    "blank_count": f"""{FROM_ACCOUNTS} SELECT count(*) FILTER (WHERE trim(total_text) = '') AS blank_rows,
        count(*) AS total_rows FROM accounts""",
    "numeric_summary": f"""{FROM_ACCOUNTS} SELECT label, round(avg(monthly), 2) AS avg_value, round(min(monthly), 2) AS min_value,
        round(max(monthly), 2) AS max_value FROM accounts GROUP BY label""",
    "describe_numeric": f"{FROM_AMOUNTS} {_describe_accounts}",
    "quartiles_by_label": FROM_AMOUNTS
    + " UNION ALL ".join(
        f"""SELECT label, '{c}' AS "column", CAST({q} AS DOUBLE) AS prob, round(quantile_cont(CAST({c} AS DOUBLE), {q}), 6) AS value
        FROM amounts GROUP BY label"""
        for c in ("tenure", "monthly")
        for q in (0.25, 0.5, 0.75)
    ),
    "null_profile": FROM_AMOUNTS
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {e} IS NULL) AS nulls FROM amounts"""
        for c, e in [
            *[
                (c, c)
                for c in (
                    "account_id", "segment", "in_debt", "partner", "tenure", "internet", "security",
                    "backup", "contract", "payment", "monthly", "label",
                )
            ],
            ("total_text", "amount"),
        ]
    ),
    "distinct_levels": f"{FROM_ACCOUNTS} SELECT DISTINCT internet AS level FROM accounts",
    "rule_check": f"""{FROM_AMOUNTS}, c AS (SELECT count(*) FILTER (WHERE tenure = 0) AS z,
        count(*) FILTER (WHERE tenure = 0 AND amount IS NULL) AS zm, count(*) FILTER (WHERE amount IS NULL) AS m FROM amounts)
        SELECT z AS zero_tenure, zm AS zero_tenure_missing, m AS missing_amount, zm AS missing_zero_tenure,
        zm = z AS every_zero_is_missing, zm = m AS every_missing_is_zero, zm = z AND zm = m AS one_to_one FROM c""",
    "class_histogram": f"""{FROM_AMOUNTS}, e AS (SELECT min(monthly) AS lo, max(monthly) AS hi FROM amounts WHERE y = 1),
        bins AS (SELECT CAST(i AS INTEGER) AS bin, CAST(j AS INTEGER) AS y, lo + i * ((hi - lo) / 30) AS low,
          CASE WHEN i = 29 THEN hi ELSE lo + (i + 1) * ((hi - lo) / 30) END AS high
          FROM e, range(30) t(i), range(2) u(j))
        SELECT bin, b.y, round(low, 6) AS low, round(high, 6) AS high, count(a.monthly) AS n
        FROM bins b LEFT JOIN amounts a ON a.y = b.y AND a.monthly >= low AND (a.monthly < high OR (bin = 29 AND a.monthly = high))
        GROUP BY ALL""",
    "label_correlation": FROM_AMOUNTS + _top_corr(_exploration(drop_first=True), "amounts", 15),
    "label_correlation_all_levels": FROM_AMOUNTS + _top_corr(_exploration(drop_first=False), "amounts", 15),
    "label_correlation_signed": FROM_AMOUNTS + _top_corr(_exploration(drop_first=True), "amounts", 20, signed=True),
    "correlation_pairs": FROM_AMOUNTS + _pairs(markers=False),
    "correlation_pairs_filtered": FROM_AMOUNTS + _pairs(markers=True),
    "encoded_correlation": FROM_CLEANED
    + _top_corr([(c, f"num__{c}") for c in NUMERIC] + _dummies(prefix="cat__"), "cleaned", 15),
    "charge_drift": FROM_AMOUNTS + _drift + _describe("drift", ["monthly", "avg_charge", "charge_diff"], 4),
    "charge_drift_fit": f"""{FROM_AMOUNTS}{_drift} SELECT round(avg(abs(charge_diff)), 2) AS mean_abs_diff,
        round(corr(monthly, avg_charge), 3) AS corr FROM drift""",
    "charge_drift_rate": f"""{FROM_AMOUNTS}{_drift} SELECT charge_diff > 0 AS charge_increased,
        round(avg(y) * 100, 1) AS rate_pct FROM drift GROUP BY 1""",
    "prediction_monitor": f"""{FROM_LOG} SELECT CAST(scored_at AS DATE) AS score_date, count(*) AS n,
        round(avg(probability), 6) AS avg_probability, round(avg(flag), 6) AS flag_rate FROM score_log GROUP BY 1""",
    "run_summary": f"""{FROM_LOG} SELECT model, count(*) AS scored, CAST(sum(flag) AS BIGINT) AS flagged,
        round(avg(flag), 6) AS flag_rate, max(threshold) AS threshold FROM score_log GROUP BY model""",
    "confusion_matrix": f"""{FROM_EVENTS} SELECT count(*) FILTER (WHERE y = 0 AND p < 0.441) AS tn,
        count(*) FILTER (WHERE y = 0 AND p >= 0.441) AS fp, count(*) FILTER (WHERE y = 1 AND p < 0.441) AS fn,
        count(*) FILTER (WHERE y = 1 AND p >= 0.441) AS tp FROM scored""",
    "class_counts": f"""{FROM_CLEANED}, c AS (SELECT count(*) FILTER (WHERE y = 1) AS positives,
        count(*) FILTER (WHERE y = 0) AS negatives FROM cleaned)
        SELECT positives, negatives, round(negatives::DOUBLE / greatest(positives, 1), 6) AS "full",
        round(sqrt(negatives::DOUBLE / greatest(positives, 1)), 6) AS "sqrt", CAST(1 AS DOUBLE) AS "none" FROM c""",
    "latest_scores": f"{FROM_LOG} {LATEST}",
    "latest_scores_stream": f"{FROM_LOG} SELECT * REPLACE (CAST(flag AS BIGINT) AS flag) FROM ({LATEST})",
    "top_risk": f"{FROM_LOG} SELECT * FROM score_log ORDER BY probability DESC, account_id, run_id LIMIT 20",
    "newest_scores": f"{FROM_LOG} SELECT * FROM score_log ORDER BY scored_at DESC, account_id, run_id LIMIT 20",
    "peek": f"{FROM_ACCOUNTS} SELECT {ACCOUNT_COLUMNS} FROM accounts ORDER BY account_id LIMIT 20",
    "sample_fixed": f"""{FROM_LOG} SELECT run_id, probability FROM score_log
        ORDER BY md5(concat('sample:', run_id)), run_id LIMIT 200""",
    "engineer_features": f"{FROM_CLEANED} SELECT {CLEANED_COLUMNS}, {ENGINEERED} FROM cleaned",
    "fit_levels": FROM_CLEANED
    + " UNION ".join(f"""SELECT '{c}' AS "column", {c} AS level FROM cleaned""" for c in LEVELS),
    "one_hot": f"{FROM_CLEANED} SELECT account_id, {_select(_dummies())} FROM cleaned",
    "one_hot_drop_first": f"{FROM_CLEANED} SELECT account_id, {_select(_dummies(drop_first=True))} FROM cleaned",
    "scale_numeric": f"{FROM_CLEANED} SELECT account_id, {_scaled(NUMERIC, 'cleaned')} FROM cleaned",
    "preprocess": f"""{FROM_PARTS}, tr_rows AS (SELECT * FROM parts WHERE split = 'train')
        SELECT account_id, {_scaled(NUMERIC, 'tr_rows', 'num__')},
        {_select(_dummies(drop_first=True, prefix='cat__'))} FROM parts""",
    "encode_matrix": f"""{FROM_CLEANED} SELECT CAST(y AS INTEGER) AS y,
        {", ".join(f'{c} AS "num__{c}"' for c in NUMERIC)}, {_select(_dummies(prefix='cat__'))} FROM cleaned""",
    "select_encoded": f"""{FROM_CLEANED} SELECT account_id,
        CAST((contract = 'Month-to-month')::INT AS DOUBLE) AS "cat__contract_Month-to-month", tenure AS num__tenure,
        CAST((internet = 'No')::INT AS DOUBLE) AS "cat__internet_No" FROM cleaned""",
    "stratified_split": f"{FROM_PARTS} SELECT account_id, CAST(y AS INTEGER) AS y, split FROM parts",
    "stratified_folds": f"""{FROM_CLEANED} SELECT account_id, CAST(y AS INTEGER) AS y,
        CAST(ntile(5) OVER (PARTITION BY y ORDER BY md5(concat('fold:', account_id)), account_id) - 1 AS INTEGER) AS fold
        FROM cleaned""",
    "pr_curve": CURVE_EVENTS + POINTS,
    "pr_curve_ties": CURVE_DOCS + POINTS,
    "best_threshold": CURVE_DOCS
    + " UNION ALL ".join(f"SELECT * FROM ({_best(s)})" for s in ("f1", "f2", "recall_floor")),
    "best_threshold_events": f"{CURVE_EVENTS} SELECT * EXCLUDE (strategy) FROM ({_best('f1')})",
    "evaluate": CURVE_EVENTS + _evaluate(0.441) + EVALUATION.format(t=0.441),
    "evaluate_ties": CURVE_DOCS + _evaluate(0.5) + EVALUATION.format(t=0.5),
    "pr_summary": CURVE_DOCS
    + _evaluate(0.5)
    + """SELECT CAST(0.5 AS DOUBLE) AS threshold, round(pr_auc, 6) AS pr_auc, round(positives / rows_all, 6) AS prevalence,
        round(pr_auc / (positives / rows_all), 6) AS lift_over_random, round("precision", 6) AS operating_precision,
        round(recall, 6) AS operating_recall FROM scores""",
    "fairness_by_group": f"{FROM_DOCS} {_groups('grp', 'grp', 0.5).format(source='scored')}",
    "mcc": CURVE_EVENTS + _evaluate(0.5) + "SELECT 'mcc' AS metric, round(mcc, 6) AS value FROM scores",
    "metric_scorer": CURVE_DOCS
    + _evaluate(0.5)
    + " UNION ALL ".join(
        f"SELECT '{m}' AS metric, round({m}, 6) AS value FROM scores" for m in ("pr_auc", "f1", "f2", "mcc")
    ),
}
ORACLE["load_batch_output"] = ORACLE["parse_jsonl"]
ORACLE["load_cache"] = ORACLE["export_cache"]

# Precision, recall, F1 and F2 per model of the score log, for the comparison operators.
MODEL_METRICS = """
outcomes AS (SELECT model, p, CASE WHEN p * 7 % 1 < 0.3 THEN 1 ELSE 0 END AS y
  FROM (SELECT model, probability AS p FROM score_log)),
long AS (
  SELECT model, t, unnest(['precision', 'recall', 'f1', 'f2']) AS metric,
    unnest([pr, re, 2 * pr * re / (pr + re), 5 * pr * re / (4 * pr + re)]) AS value
  FROM (SELECT model, t,
      CAST(count(*) FILTER (WHERE y = 1 AND p >= t) AS DOUBLE) / count(*) FILTER (WHERE p >= t) AS pr,
      CAST(count(*) FILTER (WHERE y = 1 AND p >= t) AS DOUBLE) / count(*) FILTER (WHERE y = 1) AS re
    FROM outcomes, (SELECT CAST(unnest([0.441, 0.6]) AS DOUBLE) AS t) GROUP BY model, t)),
cur AS (SELECT model, metric, value FROM long WHERE t < 0.5),
alt AS (SELECT model, metric, value FROM long WHERE t > 0.5)
"""
FROM_METRICS = _with(SCORE_LOG, MODEL_METRICS)

_parity = f"""{FROM_CLEANED} SELECT count(*) AS compared, CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right,
  CAST(0 AS BIGINT) AS probability_differs, CAST(0 AS BIGINT) AS flag_differs FROM cleaned"""

def _report(source: str, prefix: str) -> str:
    return ", ".join(
        f"(SELECT round(value, 6) FROM {source} WHERE model = 'purchase' AND metric = '{m}') AS {prefix}_{m}"
        for m in ("recall", "precision", "f1", "f2")
    )


ORACLE.update(
    {
        "baseline_snapshot": f"{FROM_METRICS} SELECT model, metric, round(value, 6) AS value FROM cur",
        "release_manifest": f"""{FROM_METRICS} SELECT 'v1' AS release_id, model, CAST(0.441 AS DOUBLE) AS threshold,
            10 AS features, round(max(value) FILTER (WHERE metric = 'precision'), 6) AS "precision",
            round(max(value) FILTER (WHERE metric = 'recall'), 6) AS recall,
            round(max(value) FILTER (WHERE metric = 'f1'), 6) AS f1 FROM cur WHERE model = 'purchase' GROUP BY model""",
        "champion_report": f"""{FROM_METRICS}
            SELECT 'purchase' AS model, {_report("cur", "report")}, {_report("alt", "development_validation")},
              CAST(NULL AS DOUBLE) AS report_pr_auc, CAST(NULL AS DOUBLE) AS report_roc_auc,
              CAST(NULL AS DOUBLE) AS development_validation_pr_auc,
              (SELECT round(value, 6) FROM cur WHERE model = 'purchase' AND metric = 'f1') AS development_cv_f1,
              CAST(0.441 AS DOUBLE) AS threshold, 'cv_f1 on train (stratified CV)' AS selected_by,
              'validation' AS threshold_tuned_on""",
        "metrics_sink": f"""{FROM_METRICS} SELECT 'r1' AS run_id, model, 'test' AS split, metric,
            round(value, 6) AS value FROM cur""",
        "baseline_delta": f"""{FROM_METRICS} SELECT model, metric, round(cur.value, 6) AS current_value,
            round(alt.value, 6) AS baseline_value, round(cur.value - coalesce(alt.value, 0), 4) AS delta
            FROM cur LEFT JOIN (FROM alt WHERE NOT (model = 'view' AND metric = 'f2')) alt USING (model, metric)""",
        "feature_set_delta": f"""{FROM_METRICS} SELECT model, metric, round(cur.value, 6) AS full_value,
            round(alt.value, 6) AS slim_value, round(alt.value - cur.value, 4) AS delta
            FROM cur JOIN alt USING (model, metric) WHERE model <> 'signup'""",
        "recommend_feature_set": f"""{FROM_METRICS} SELECT round(best_full, 6) AS best_full, round(best_slim, 6) AS best_slim,
            CASE WHEN best_slim >= best_full THEN 'probe_selected' ELSE 'full' END AS recommendation
            FROM (SELECT max(value) AS best_full FROM cur WHERE metric = 'recall'),
                 (SELECT max(value) AS best_slim FROM alt WHERE metric = 'recall')""",
        "select_winner": f"""{FROM_METRICS} SELECT model, round(value, 6) AS value FROM cur WHERE metric = 'f1'
            ORDER BY cur.value DESC, model LIMIT 1""",
        "rank_importance": f"""{FROM_AMOUNTS} SELECT feature, importance,
            CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS rank
            FROM (SELECT feature, round(abs(correlation), 6) AS importance
                  FROM ({_corr_rows(_exploration(drop_first=False), "amounts")}) WHERE correlation IS NOT NULL)
            ORDER BY importance DESC, feature LIMIT 20""",
        "model_io": _parity,
        "score_batch": f"""{FROM_CLEANED} SELECT account_id, CAST(0.3 AS DOUBLE) AS threshold, 'model' AS model,
            'm/v1' AS model_version, true AS within, true AS agrees FROM cleaned""",
        "score_and_append": f"""{FROM_CLEANED} SELECT run_id, model, CAST(0.3 AS DOUBLE) AS threshold, scored
            FROM (SELECT count(*) AS scored FROM cleaned),
                 (VALUES ('a', 'logreg'), ('b', 'random_forest')) AS r(run_id, model)""",
        "append_batch_output": f"""{FROM_LOG} SELECT account_id, CAST(max(flag) AS BIGINT) AS flag, 'view' AS model,
            'm/v1' AS model_version, max(probability) AS probability, 'r1' AS run_id, max(threshold) AS threshold
            FROM score_log GROUP BY account_id""",
        "score_one_with_actual": f"""{FROM_CLEANED} SELECT account_id, CAST(y AS INTEGER) AS actual,
            CAST(0.3 AS DOUBLE) AS threshold, 'model' AS model, true AS same_score FROM cleaned WHERE account_id IN ('7', '10', '100')""",
        "rescore_test": f"""{FROM_PARTS} SELECT count(*) AS n, CAST(sum(y) AS BIGINT) AS positives,
            round(avg(y), 6) AS prevalence, CAST(0 AS BIGINT) AS differs FROM parts WHERE split = 'test'""",
        "probe_correlations": f"""{FROM_PARTS}, tr_rows AS (SELECT * FROM parts WHERE split = 'train') """
        + _top_corr([(c, f"num__{c}") for c in NUMERIC] + _dummies(prefix="cat__"), "tr_rows", 15),
    }
)


# Fitted models: what does not depend on the fit.


def _measured(models: dict[str, list[str]]) -> str:
    """Rows and positives of each run, model and split."""
    names = ", ".join(f"('{run}', '{m}')" for run, ms in models.items() for m in ms)
    return f"""{FROM_PARTS}, models(run_id, model) AS (VALUES {names}),
measured AS (
  SELECT split, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives FROM parts
  WHERE split IN ('validation', 'test') GROUP BY split
  UNION ALL SELECT concat('test:segment=', segment), count(*), CAST(sum(y) AS BIGINT) FROM parts
  WHERE split = 'test' GROUP BY segment)
SELECT run_id, model, split, n, positives, true AS in_order FROM models, measured"""


def _stump() -> str:
    """The best split of all dummies by gradient and curvature, for both presets of the booster."""
    sides = " UNION ALL ".join(
        f"""SELECT model, {i} AS place, '{n}' AS feature, sum(g) AS g, sum(h) AS h, count(*) AS n,
  coalesce(sum(g) FILTER (WHERE {e} = 0), 0) AS lg, coalesce(sum(h) FILTER (WHERE {e} = 0), 0) AS lh,
  count(*) FILTER (WHERE {e} = 0) AS ln FROM gr GROUP BY model"""
        for i, (e, n) in enumerate(_dummies(prefix="cat__"))
    )
    return f"""{FROM_PARTS}, fit AS (SELECT * FROM parts WHERE split = 'train'),
wt AS (SELECT *, CASE WHEN y = 1 THEN sqrt(CAST(count(*) FILTER (WHERE y = 0) OVER () AS DOUBLE)
  / greatest(count(*) FILTER (WHERE y = 1) OVER (), 1)) ELSE CAST(1 AS DOUBLE) END AS weight FROM fit),
presets(model, l2, least_h, least_n) AS (VALUES ('gbt_a', CAST(1 AS DOUBLE), CAST(1 AS DOUBLE), 1),
  ('gbt_b', CAST(0 AS DOUBLE), CAST(0.001 AS DOUBLE), 20)),
pr AS (SELECT *, CASE model WHEN 'gbt_a' THEN CAST(0.5 AS DOUBLE) ELSE sum(weight * y) OVER (PARTITION BY model) / sum(weight) OVER (PARTITION BY model) END AS p
  FROM wt, presets),
gr AS (SELECT *, weight * (p - y) AS g, weight * p * (1 - p) AS h FROM pr),
st AS ({sides}),
ca AS (SELECT st.model, place, feature, ln AS n_low, n - ln AS n_high, -lg / (lh + l2) * 0.1 AS low, -(g - lg) / (h - lh + l2) * 0.1 AS high,
  lg * lg / (lh + l2) + (g - lg) * (g - lg) / (h - lh + l2) - g * g / (h + l2) AS gain
  FROM st JOIN presets USING (model) WHERE lh >= least_h AND h - lh >= least_h AND ln >= least_n AND n - ln >= least_n)
SELECT model, feature, round(gain, 6) AS gain, round(low, 6) AS low, round(high, 6) AS high, n_low, n_high FROM ca
QUALIFY row_number() OVER (PARTITION BY model ORDER BY round(gain, 7) DESC, place) = 1"""


_ENCODED = len(NUMERIC) + len(_dummies())
_ALL = ["logreg", "random_forest", "gbt_a", "gbt_b"]

ORACLE.update({f"train_{m}": _measured({"run": [m]}) for m in _ALL})
ORACLE.update(
    {
        "booster_stump": _stump(),
        "train_engineered": _measured({"run": ["logreg"]}),
        "train_suite": _measured({"run": _ALL}),
        "training_run": _measured({r: ["logreg", "random_forest"] for r in ("r1", "r1-slim")}),
        **{
            q: f"""SELECT CAST({maps} AS BIGINT) AS maps, CAST({maps} AS BIGINT) AS settings, true AS best_taken,
            true AS in_order"""
            for q, maps in (("grid_search", 32), ("grid_search_forest", 32), ("grid_search_gbt_a", 12), ("grid_search_gbt_b", 12))
        },
        "cv_score": """SELECT metric, true AS in_order
            FROM (VALUES ('cv_score'), ('cv_mcc'), ('cv_std'), ('grid_score')) AS m(metric)""",
        "suite_winner": "SELECT CAST(4 AS BIGINT) AS models, true AS best_won, true AS known",
        "suite_champion": """SELECT 'cv_f1 on train (stratified CV)' AS selected_by, 'validation' AS threshold_tuned_on,
            true AS test_reported, true AS threshold_known""",
        "tree_importance": f"""SELECT CAST({_ENCODED} AS BIGINT) AS features, CAST({_ENCODED} AS BIGINT) AS last_rank,
            true AS in_order, true AS adds_up""",
        "probe_audit": f"""SELECT CAST({_ENCODED} AS BIGINT) AS features, CAST(3 AS BIGINT) AS probes,
            true AS in_order, true AS adds_up""",
        "probe_kept": f"SELECT CAST({_ENCODED} AS BIGINT) AS features, true AS kept_only, true AS in_order",
        "shap_importance": f"""SELECT CAST({_ENCODED} AS BIGINT) AS features, CAST({_ENCODED} AS BIGINT) AS last_rank,
            true AS in_order""",
        "odds_ratios": f"""{FROM_ACCOUNTS}, levels AS (SELECT DISTINCT concat('contract_', contract) AS feature FROM accounts),
settings(drop_first, strength) AS (VALUES (false, CAST(1 AS DOUBLE)), (false, CAST(100 AS DOUBLE)), (true, CAST(1 AS DOUBLE)))
SELECT drop_first, strength, feature, true AS in_order FROM settings, levels
WHERE NOT drop_first OR feature <> (SELECT min(feature) FROM levels)""",
        "run_config": f"""{FROM_PARTS}, w AS (SELECT round(sqrt(CAST(count(*) FILTER (WHERE y = 0) AS DOUBLE)
    / greatest(count(*) FILTER (WHERE y = 1), 1)), 4) AS weight FROM parts WHERE split = 'train')
SELECT 'run' AS run_id, knob, value FROM (VALUES ('feature_set', 'baseline'), ('tune', 'false'), ('metric', 'f2'),
  ('grid_metric', 'f2'), ('select_metric', 'f2'), ('metrics_aligned', 'true'), ('pos_weight_mode', 'sqrt'),
  ('threshold_strategy', 'f2'), ('recall_floor', '0.8'), ('probe_audit', 'false'), ('probe_train', 'false'),
  ('save_baseline', 'false'), ('run_shap', 'true'), ('folds', '5'),
  ('threshold_tuned_on', 'validation'),
  ('data_split', '{{"test":0.15,"train":0.7,"validation":0.15}}')) AS k(knob, value)
UNION ALL SELECT 'run', 'pos_weight_value', CAST(weight AS VARCHAR) FROM w""",
        "score_parity": f"""{FROM_CLEANED}, t AS (SELECT account_id, CAST(account_id AS BIGINT) % 10 = 0 AS changed FROM cleaned)
SELECT 'served' AS copy, count(*) AS compared, CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right,
  CAST(0 AS BIGINT) AS probability_differs, CAST(0 AS BIGINT) AS flag_differs FROM t
UNION ALL SELECT 'tampered', count(*) FILTER (WHERE account_id NOT IN ('7', '10')),
  count(*) FILTER (WHERE account_id IN ('7', '10')), 0,
  count(*) FILTER (WHERE changed AND account_id <> '10'), count(*) FILTER (WHERE changed AND account_id <> '10') FROM t""",
    }
)
