"""DuckDB SQL for each query, written against the raw test tables and independent of the Spark code."""

from __future__ import annotations

SNAPSHOT = "DATE '2000-06-30'"
WINDOW_START = f"CAST({SNAPSHOT} - INTERVAL 36 MONTH AS DATE)"
RECENT_START = f"CAST({SNAPSHOT} - INTERVAL 18 MONTH AS DATE)"
LAST_DAYS = f"CAST({SNAPSHOT} - INTERVAL 30 DAY AS DATE)"
OUTCOME_END = f"CAST({SNAPSHOT} + INTERVAL 12 MONTH AS DATE)"


def _window(day: str) -> str:
    return f"{day} > {WINDOW_START} AND {day} <= {SNAPSHOT}"


def _bucket(key: str) -> str:
    return f"CAST(('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT) % 100"


def _split(key: str) -> str:
    return f"CASE WHEN {_bucket(key)} < 70 THEN 'train' WHEN {_bucket(key)} < 85 THEN 'val' ELSE 'test' END"


def _charge(balance: str) -> str:
    return f"20E0 + FLOOR(ABS({balance}) / 25E0) * 25E-2"


CONTRACT = (
    "CASE c_mktsegment WHEN 'FURNITURE' THEN 'One year' WHEN 'HOUSEHOLD' THEN 'Two year' ELSE 'Month-to-month' END"
)

RELATIONS = f"""
day_orders AS (SELECT *, CAST(o_orderdate AS DATE) AS o_day FROM orders),
order_history AS (
  SELECT o_custkey, MIN(o_day) AS first_day,
         COUNT(*) FILTER (WHERE o_day > {SNAPSHOT} AND o_day <= {OUTCOME_END}) AS later
  FROM day_orders GROUP BY o_custkey
),
customers AS (
  SELECT c_custkey AS customer_id,
         LEAST(COALESCE(first_day, {LAST_DAYS}), {LAST_DAYS}) AS signup_date,
         CAST(20 + c_custkey % 66 AS INT) AS age, r_name AS region, {CONTRACT} AS contract,
         CASE WHEN c_acctbal < 2000 THEN 'Basic' WHEN c_acctbal < 7000 THEN 'Standard' ELSE 'Premium' END AS plan,
         CASE c_nationkey % 3 WHEN 0 THEN 'Fiber' WHEN 1 THEN 'DSL' ELSE 'None' END AS internet_service,
         CASE c_custkey % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
              WHEN 2 THEN 'Bank transfer (auto)' ELSE 'Credit card (auto)' END AS payment_method,
         {_charge('c_acctbal')} AS monthly_charges,
         CASE WHEN COALESCE(later, 0) > 0 THEN 0 ELSE 1 END AS churned
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN order_history ON o_custkey = c_custkey
),
usage AS (
  SELECT o_custkey AS customer_id, CAST(date_trunc('month', o_day) AS DATE) AS month,
         CAST(SUM(FLOOR(o_totalprice / 1000E0)) AS DOUBLE) AS call_minutes,
         CASE WHEN MAX(c_nationkey % 3) = 2 THEN 0E0 ELSE FLOOR(MAX(o_totalprice) / 10000E0) * 25E-2 END AS data_gb,
         COUNT(*) AS sms_count, CAST(SUM(CAST(substr(o_orderpriority, 1, 1) AS INT)) AS BIGINT) AS app_logins
  FROM day_orders JOIN customer ON c_custkey = o_custkey
  WHERE {_window('o_day')} GROUP BY 1, 2
),
payments AS (
  SELECT o_custkey AS customer_id, o_day AS due_date,
         CASE substr(o_orderpriority, 1, 1) WHEN '5' THEN 10 WHEN '4' THEN 3 ELSE 0 END AS days_late,
         CAST(o_day + CAST(days_late AS INT) AS DATE) AS paid_date, o_totalprice AS amount
  FROM day_orders WHERE {_window('o_day')}
),
tickets AS (
  SELECT o_custkey AS customer_id, CAST(l_shipdate AS DATE) AS created_date,
         CASE l_linenumber % 4 WHEN 0 THEN 'Billing' WHEN 1 THEN 'Network' WHEN 2 THEN 'Service'
              ELSE 'Cancellation inquiry' END AS category,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_complaint, l_quantity AS resolution_hours,
         CASE WHEN l_linestatus = 'F' AND l_tax >= 6E-2 THEN 1 ELSE 0 END AS escalated,
         CASE WHEN l_linenumber % 3 <> 0 THEN CAST(1 + CAST(ROUND(l_discount * 100) AS BIGINT) % 5 AS DOUBLE) END
           AS satisfaction
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  WHERE l_returnflag <> 'N' AND {_window('CAST(l_shipdate AS DATE)')}
),
service_calls AS (
  SELECT user_id AS customer_id,
         {SNAPSHOT} - CAST(6 * (DATE '2024-01-30' - CAST(ts AS DATE)) AS INT) AS call_date,
         FLOOR(value * 4E0) / 4E0 AS duration_min,
         CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS resolved,
         CASE event_type WHEN 'error' THEN -5E-1 WHEN 'purchase' THEN 75E-2 WHEN 'signup' THEN 5E-1 ELSE 0E0 END
           AS sentiment
  FROM events
)"""


def _trend(column: str) -> str:
    return (
        f"COALESCE(AVG(CAST({column} AS DOUBLE)) FILTER (WHERE month > {RECENT_START})"
        f" / NULLIF(AVG(CAST({column} AS DOUBLE)) FILTER (WHERE month <= {RECENT_START}), 0E0), 1E0)"
    )


def _hits(condition: str) -> str:
    return f"COUNT(*) FILTER (WHERE {condition})"


BLOCKS = f"""
usage_block AS (
  SELECT customer_id, AVG(call_minutes) AS avg_call_minutes, AVG(data_gb) AS avg_data_gb, AVG(sms_count) AS avg_sms,
         AVG(app_logins) AS avg_app_logins, {_trend('call_minutes')} AS minutes_trend,
         {_trend('data_gb')} AS data_trend, {_trend('app_logins')} AS logins_trend
  FROM usage WHERE {_window('month')} GROUP BY customer_id
),
payment_block AS (
  SELECT customer_id, {_hits('days_late > 0')} AS late_payments,
         AVG(CASE WHEN days_late > 0 THEN 1E0 ELSE 0E0 END) AS late_payment_ratio, AVG(days_late) AS avg_days_late,
         CAST(MAX(days_late) AS BIGINT) AS max_days_late,
         {_hits(f'days_late > 0 AND due_date > {RECENT_START}')} AS late_payments_recent
  FROM payments GROUP BY customer_id
),
ticket_block AS (
  SELECT customer_id, COUNT(*) AS ticket_count, CAST(SUM(is_complaint) AS BIGINT) AS complaint_count,
         CAST(SUM(escalated) AS BIGINT) AS escalated_count, {_hits("category = 'Billing'")} AS billing_tickets,
         {_hits("category = 'Network'")} AS network_tickets,
         {_hits("category = 'Cancellation inquiry'")} AS cancellation_inquiries,
         AVG(resolution_hours) AS avg_resolution_hours, AVG(satisfaction) AS avg_satisfaction,
         {_hits(f'created_date >= {LAST_DAYS}')} AS tickets_last_30d
  FROM tickets GROUP BY customer_id
),
call_block AS (
  SELECT customer_id, COUNT(*) AS call_count, AVG(duration_min) AS avg_call_duration,
         CAST(SUM(1 - resolved) AS BIGINT) AS unresolved_calls, AVG(sentiment) AS avg_sentiment,
         {_hits(f'call_date >= {LAST_DAYS}')} AS calls_last_30d
  FROM service_calls WHERE {_window('call_date')} GROUP BY customer_id
)"""

HISTORY_DEFAULTS = {
    "avg_call_minutes": 0, "avg_data_gb": 0, "avg_sms": 0, "avg_app_logins": 0, "minutes_trend": 1,
    "data_trend": 1, "logins_trend": 1, "late_payments": 0, "late_payment_ratio": 0, "avg_days_late": 0,
    "max_days_late": 0, "late_payments_recent": 0, "ticket_count": 0, "complaint_count": 0, "escalated_count": 0,
    "billing_tickets": 0, "network_tickets": 0, "cancellation_inquiries": 0, "avg_resolution_hours": 0,
    "avg_satisfaction": 3, "tickets_last_30d": 0, "call_count": 0, "avg_call_duration": 0, "unresolved_calls": 0,
    "avg_sentiment": 0, "calls_last_30d": 0,
}
_FILLED = ",\n         ".join(
    f"CAST(COALESCE({name}, {value}) AS DOUBLE) AS {name}" for name, value in HISTORY_DEFAULTS.items()
)
CATEGORIES = ["contract", "plan", "internet_service", "payment_method", "region"]
NUMBERS = ["age", "tenure_months", "monthly_charges", "total_charges", *HISTORY_DEFAULTS, "contacts_per_month"]

FEATURES = f"""
filled AS (
  SELECT customer_id, churned AS label, contract, plan, internet_service, payment_method, region,
         CAST(age AS DOUBLE) AS age, CAST(FLOOR(({SNAPSHOT} - signup_date) / 30E0) AS DOUBLE) AS tenure_months,
         monthly_charges,
         {_FILLED},
         {_split('customer_id')} AS split
  FROM customers LEFT JOIN usage_block USING (customer_id) LEFT JOIN payment_block USING (customer_id)
  LEFT JOIN ticket_block USING (customer_id) LEFT JOIN call_block USING (customer_id)
),
features AS (
  SELECT *, monthly_charges * tenure_months AS total_charges,
         (ticket_count + call_count) / LEAST(36E0, GREATEST(tenure_months, 1E0)) AS contacts_per_month
  FROM filled
)"""

POINTS = f"""
points AS (
  SELECT *, CAST(LEAST(9999, 500 + CASE WHEN contract = 'Month-to-month' THEN 2000 ELSE 0 END
         + 300 * LEAST(late_payments, 5) + 400 * LEAST(complaint_count, 5) + 20 * ({_bucket('customer_id')})) AS BIGINT)
         AS bp
  FROM features
),
scored AS (
  SELECT 's1' AS model, split, customer_id, label, bp AS score FROM points
  UNION ALL SELECT 's2', split, customer_id, label, 9999 - bp FROM points
)"""


def _ranking(source: str = "scored") -> str:
    """Groups of equal scores with cumulative counts, highest score first."""
    return f"""
grouped AS (
  SELECT model, split, score, CAST(SUM(label) AS BIGINT) AS pos, CAST(SUM(1 - label) AS BIGINT) AS neg
  FROM {source} GROUP BY 1, 2, 3
),
ranked AS (
  SELECT *, CAST(SUM(pos) OVER down AS BIGINT) AS tp, CAST(SUM(neg) OVER down AS BIGINT) AS fp,
         CAST(SUM(pos) OVER whole AS BIGINT) AS p_all, CAST(SUM(neg) OVER whole AS BIGINT) AS n_all,
         ROW_NUMBER() OVER down AS place, COUNT(*) OVER whole AS places,
         LEAD(pos) OVER down AS next_pos, LEAD(neg) OVER down AS next_neg
  FROM grouped
  WINDOW down AS (PARTITION BY model, split ORDER BY score DESC), whole AS (PARTITION BY model, split)
),
summary AS (
  SELECT model, split, MAX(p_all + n_all) AS n, MAX(p_all) AS positives,
         CAST(SUM(CAST(pos AS HUGEINT) * (2 * (n_all - fp) + neg)) AS DOUBLE)
           / NULLIF(2E0 * CAST(CAST(MAX(p_all) AS HUGEINT) * MAX(n_all) AS DOUBLE), 0E0) AS roc_auc,
         SUM(pos * (CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE))) / NULLIF(CAST(MAX(p_all) AS DOUBLE), 0E0)
           AS average_precision
  FROM ranked GROUP BY 1, 2
),
best_cut AS (
  SELECT model, split, score AS best_threshold, f1 AS best_f1 FROM (
    SELECT model, split, score, CAST(2 * tp AS DOUBLE) / CAST(tp + fp + p_all AS DOUBLE) AS f1 FROM ranked)
  QUALIFY ROW_NUMBER() OVER (PARTITION BY model, split ORDER BY f1 DESC, score) = 1
)"""


RANKING = _ranking()
CHOICE = """
choice AS (
  SELECT model, roc_auc, best_threshold AS threshold FROM summary JOIN best_cut USING (model, split)
  WHERE split = 'val' ORDER BY roc_auc DESC, model LIMIT 1
)"""

CONFUSION = """
cuts AS (
  SELECT model, 'at_tuned' AS cut, best_threshold AS threshold FROM best_cut WHERE split = 'val'
  UNION ALL SELECT model, 'at_default_0.5', CAST(5000 AS BIGINT) FROM best_cut WHERE split = 'val'
),
confusion AS (
  SELECT model, cut, threshold, COUNT(*) FILTER (WHERE score < threshold AND label = 0) AS tn,
         COUNT(*) FILTER (WHERE score >= threshold AND label = 0) AS fp,
         COUNT(*) FILTER (WHERE score < threshold AND label = 1) AS fn,
         COUNT(*) FILTER (WHERE score >= threshold AND label = 1) AS tp
  FROM scored JOIN cuts USING (model) WHERE split = 'test' GROUP BY 1, 2, 3
),
rates AS (
  SELECT *, COALESCE(CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fp AS DOUBLE), 0E0), 0E0) AS precision,
         COALESCE(CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fn AS DOUBLE), 0E0), 0E0) AS recall
  FROM confusion
),
cut_metrics AS (
  SELECT model, cut, ROUND(threshold / 10000E0, 4) AS threshold, precision, recall,
         COALESCE(2E0 * precision * recall / NULLIF(precision + recall, 0E0), 0E0) AS f1,
         CAST(tp + tn AS DOUBLE) / CAST(tp + fp + fn + tn AS DOUBLE) AS accuracy, tp, fp, fn, tn
  FROM rates
)"""


def _ordered(source: str = "scored") -> str:
    return f"""
ordered AS (
  SELECT model, ROW_NUMBER() OVER down AS rank, CAST(SUM(label) OVER down AS BIGINT) AS found,
         COUNT(*) OVER whole AS n, CAST(SUM(label) OVER whole AS BIGINT) AS positives
  FROM {source} WHERE split = 'test'
  WINDOW down AS (PARTITION BY model ORDER BY score DESC, md5(CAST(customer_id AS VARCHAR)), customer_id
                  ROWS UNBOUNDED PRECEDING),
         whole AS (PARTITION BY model)
),
lift AS (
  SELECT model, rank AS k, CAST(CAST(found AS HUGEINT) * n AS DOUBLE)
         / NULLIF(CAST(CAST(rank AS HUGEINT) * positives AS DOUBLE), 0E0) AS top_decile_lift
  FROM ordered WHERE rank = GREATEST(1, n // 10)
)"""


CURVES = """
kept AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY model ORDER BY score DESC) AS idx,
         COUNT(*) OVER (PARTITION BY model) + 1 AS length
  FROM ranked WHERE split = 'test'
    AND (place = 1 OR place = places OR pos <> next_pos OR neg <> next_neg)
),
roc AS (
  SELECT model, idx, length, fp / CAST(n_all AS DOUBLE) AS x, tp / CAST(p_all AS DOUBLE) AS y FROM kept
  UNION ALL SELECT model, 0, length, 0E0, 0E0 FROM kept WHERE idx = 1
),
pr AS (
  SELECT model, places - place AS idx, places + 1 AS length, tp / CAST(p_all AS DOUBLE) AS x,
         tp / CAST(tp + fp AS DOUBLE) AS y
  FROM ranked WHERE split = 'test'
  UNION ALL SELECT model, places, places + 1, 0E0, 1E0 FROM ranked WHERE split = 'test' AND place = 1
),
both_curves AS (
  SELECT 'roc' AS curve, * FROM roc UNION ALL SELECT 'pr', * FROM pr
),
thinned AS (
  SELECT model, curve, idx, ROUND(x, 4) AS x, ROUND(y, 4) AS y FROM both_curves
  WHERE idx = length - 1 OR EXISTS (
    SELECT 1 FROM range(0, 119) AS spread(i)
    WHERE CAST(FLOOR(spread.i * (CAST(length - 1 AS DOUBLE) / 119E0)) AS BIGINT) = idx)
)"""

SCORES = """
scores AS (
  SELECT points.*, bp / 10000E0 AS prob_s1, (9999 - bp) / 10000E0 AS prob_s2,
         CASE WHEN model = 's1' THEN bp ELSE 9999 - bp END AS best_bp, threshold
  FROM points, choice
),
export AS (
  SELECT customer_id, label AS actual_churn, contract, plan, internet_service, payment_method, region, tenure_months,
         monthly_charges, late_payments, ticket_count, complaint_count, call_count, unresolved_calls,
         cancellation_inquiries, minutes_trend, split, best_bp, best_bp / 10000E0 AS churn_probability,
         CASE WHEN best_bp >= 5000 THEN 'High' WHEN best_bp >= 2500 THEN 'Medium' ELSE 'Low' END AS risk_band,
         CASE WHEN best_bp >= threshold THEN 1 ELSE 0 END AS predicted_churn, prob_s1, prob_s2,
         COALESCE(NULLIF(array_to_string(list_slice(list_filter([
           CASE WHEN contract = 'Month-to-month' THEN 'Month-to-month contract' END,
           CASE WHEN late_payments_recent >= 2
                THEN CAST(CAST(late_payments_recent AS BIGINT) AS VARCHAR) || ' late payments in last 18 months' END,
           CASE WHEN minutes_trend < 75E-2 OR logins_trend < 75E-2 THEN 'Usage declining' END,
           CASE WHEN cancellation_inquiries >= 1 THEN 'Asked about cancelling' END,
           CASE WHEN complaint_count >= 2
                THEN CAST(CAST(complaint_count AS BIGINT) AS VARCHAR) || ' complaints' END,
           CASE WHEN unresolved_calls >= 2
                THEN CAST(CAST(unresolved_calls AS BIGINT) AS VARCHAR) || ' unresolved calls' END,
           CASE WHEN avg_satisfaction <= 25E-1 THEN 'Low satisfaction score' END,
           CASE WHEN payment_method = 'Electronic check' THEN 'Pays by electronic check' END
         ], lambda reason: reason IS NOT NULL), 1, 4), '; '), ''), 'No standout risk signals') AS risk_factors
  FROM scores
)"""

LIST_COLUMNS = (
    "customer_id, churn_probability, risk_band, risk_factors, contract, plan, tenure_months, monthly_charges, "
    "late_payments, ticket_count, call_count, minutes_trend, region"
)

_ADDON_COUNT = " + ".join(f"((c_custkey >> {bit}) & 1)" for bit in range(6))
_TENURE = "LEAST(GREATEST(c_custkey % 80 - 2, 0), 72)"
NORMALIZED = f"""
normalized AS (
  SELECT c_name AS customer_id, CAST({SNAPSHOT} - CAST(GREATEST({_TENURE}, 1) * 30 AS INT) AS DATE) AS signup_date,
         CAST({_TENURE} AS INT) AS tenure, CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS senior_citizen,
         {CONTRACT} AS contract,
         CASE WHEN {_ADDON_COUNT} >= 5 THEN 'Premium' WHEN {_ADDON_COUNT} >= 2 THEN 'Standard' ELSE 'Basic' END AS plan,
         CASE c_nationkey % 4 WHEN 0 THEN 'Fiber' WHEN 1 THEN 'DSL' WHEN 2 THEN 'None' END AS internet_service,
         CASE c_custkey % 5 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
              WHEN 2 THEN 'Bank transfer (auto)' WHEN 3 THEN 'Credit card (auto)' END AS payment_method,
         {_charge('c_acctbal')} AS monthly_charges,
         ({_charge('c_acctbal')}) * CASE WHEN c_custkey % 80 - 2 <= 0 THEN 1 ELSE c_custkey % 80 - 2 END
           AS total_charges,
         CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS churned
  FROM customer
)"""


def _hex(text: str, first: int, digits: int) -> str:
    return f"CAST(('0x' || substr(md5({text}), {first}, {digits})) AS BIGINT)"


_DRAW = "CAST(draw AS VARCHAR)"
BOOTSTRAP = f"""
placed AS (SELECT *, ROW_NUMBER() OVER (ORDER BY md5(customer_id), customer_id) - 1 AS position FROM normalized),
draws AS (
  SELECT draw, {_hex(f"'draw-' || {_DRAW}", 1, 12)} % (SELECT COUNT(*) FROM normalized) AS position
  FROM range(0, 2 * (SELECT COUNT(*) FROM normalized)) AS drawn(draw)
),
drawn AS (
  SELECT placed.* EXCLUDE (position, customer_id), customer_id AS source_customer_id,
         customer_id || '-' || lpad({_DRAW}, 7, '0') AS customer_id, draw
  FROM draws JOIN placed USING (position)
)"""
_NORMAL = (
    f"sqrt(-2E0 * ln(({_hex(f"'jitter-' || {_DRAW}", 1, 8)} + 1) / 4294967296E0)) "
    f"* cos(2E0 * pi() * ({_hex(f"'jitter-' || {_DRAW}", 9, 8)} / 4294967296E0))"
)


def _with(*parts: str, then: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + then


BASE = (RELATIONS, BLOCKS, FEATURES)
SCORED = (*BASE, POINTS)
RANKED = (*SCORED, RANKING)
EXPORT = (*RANKED, CHOICE, SCORES)
EXACT_SCORED = f"""
exact_scored AS (
  SELECT model, split, customer_id, label,
         (CAST(score AS DOUBLE) + {_hex('CAST(customer_id AS VARCHAR)', 9, 8)} / 4294967296E0) / 10000E0 AS score
  FROM scored
)"""
EXACT = (*SCORED, EXACT_SCORED, _ranking("exact_scored"))


def _fingerprint(table: str, measure: str, day: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, COUNT(*) AS row_count, COUNT(DISTINCT customer_id) AS customers, "
        f"CAST(SUM({measure}) AS DOUBLE) AS measure_sum, COUNT(*) FILTER (WHERE {measure} IS NULL) AS measure_missing, "
        f"MIN({day}) AS first_day, MAX({day}) AS last_day FROM {table}"
    )


def _slot(column: str) -> str:
    return (
        f"{column}_slots AS (SELECT {column}, CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {column}) - 1 AS INT) AS at, "
        f"CAST(COUNT(*) OVER () AS INT) AS known FROM features WHERE split = 'train' GROUP BY {column})"
    )


def _slot_offset(position: int) -> str:
    before = [f"(SELECT MAX(known) + 1 FROM {c}_slots)" for c in CATEGORIES[:position]]
    return " + ".join([str(len(NUMBERS)), *before])


def _slot_of(position: int) -> str:
    column = CATEGORIES[position]
    unknown = f"(SELECT MAX(known) FROM {column}_slots)"
    return f"CAST({_slot_offset(position)} + COALESCE({column}_slots.at, {unknown}) AS INT) AS {column}_slot"


_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}"
    for t in ("customers", "usage", "payments", "tickets", "service_calls")
)
_SEGMENTS = " UNION ALL ".join(
    f"SELECT '{c}' AS segment, {c} AS value, best_bp, actual_churn FROM export" for c in CATEGORIES
)
_FACETS = " UNION ".join(f"SELECT '{c}' AS facet, {c} AS value FROM export" for c in ("contract", "region", "plan"))
_BEHAVIOUR = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CASE WHEN {c} >= 5 THEN '5+' ELSE CAST(CAST({c} AS INT) AS VARCHAR) END AS bucket, "
    f"actual_churn FROM export"
    for c in ("late_payments", "ticket_count", "complaint_count", "call_count", "unresolved_calls",
              "cancellation_inquiries")
)

MASK = "18446744073709551615"


def _wide(value: str) -> str:
    return f"CAST({value} AS UHUGEINT)"


def _times(value: str, factor: int) -> str:
    return f"(({value} * {_wide(factor)}) % {_wide(2 ** 64)})"


def _left(value: str, bits: int) -> str:
    """A 64-bit number rotated to the left."""
    return f"({_times(value, 2 ** bits)} + {value} // {_wide(2 ** (64 - bits))})"


# XXH64 of one 64-bit number with seed 42, a published algorithm; its five primes are fixed values.
_P1, _P2, _P3, _P4, _P5 = (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261,
)
XXHASH = f"""
x1 AS (SELECT c_custkey AS customer_id, {_times(_left(_times(_wide('c_custkey'), _P2), 31), _P1)} AS k FROM customer),
x2 AS (SELECT customer_id, xor({_wide(42 + _P5 + 8)}, k) AS h FROM x1),
x3 AS (SELECT customer_id, ({_times(_left('h', 27), _P1)} + {_wide(_P4)}) % {_wide(2 ** 64)} AS h FROM x2),
x4 AS (SELECT customer_id, {_times(f"xor(h, h // {_wide(2 ** 33)})", _P2)} AS h FROM x3),
x5 AS (SELECT customer_id, {_times(f"xor(h, h // {_wide(2 ** 29)})", _P3)} AS h FROM x4),
x6 AS (SELECT customer_id, xor(h, h // {_wide(2 ** 32)}) AS h FROM x5),
xbuckets AS (
  SELECT customer_id,
         (CAST(h % 100 AS INT) + CASE WHEN h >= {_wide(2 ** 63)} THEN 100 - {2 ** 64 % 100} ELSE 0 END) % 100 AS bucket
  FROM x6
)"""
MODELS = {
    "logistic_regression": "Logistic Regression (MLlib)", "random_forest": "Random Forest (MLlib)",
    "gbt": "Gradient Boosted Trees (MLlib)", "boosted_deep": "Early-stopped boosting, depth 5 (MLlib)",
    "boosted_shallow": "Early-stopped boosting, depth 4 (MLlib)",
}


def _checked(columns: str) -> str:
    return _with(*BASE, then=f"SELECT customer_id, split, label, TRUE AS valid, {columns} FROM features")


def _searched(model: str, *points: str) -> str:
    """Every training row is judged once by every grid point."""
    return _with(*BASE, then=" UNION ALL ".join(
        f"SELECT '{model}' AS model, CAST({i} AS INT) AS point, '{point}' AS parameters, CAST(3 AS BIGINT) AS folds, "
        "COUNT(*) AS n, CAST(SUM(label) AS BIGINT) AS positives, TRUE AS is_area, TRUE AS in_order FROM features WHERE split = 'train'"
        for i, point in enumerate(points)
    ))


# Hyper-parameters as the run report shows them.
_REPORTED = {
    "logistic_regression": {"regParam": 0.01, "elasticNetParam": 0, "maxIter": 100}, "random_forest": {"maxDepth": 8, "numTrees": 100},
    "gbt": {"maxIter": 100, "maxDepth": 5, "stepSize": 0.1}, "boosted_deep": {}, "boosted_shallow": {},
}
_PARAMETERS = ("regParam", "elasticNetParam", "maxIter", "maxDepth", "numTrees", "stepSize")


def _reported(model: str) -> str:
    known = _REPORTED[model]
    return ", ".join(f"CAST({known.get(name, 'NULL')} AS DOUBLE) AS {name}" for name in _PARAMETERS) + (
        f", {'CAST(NULL AS BOOLEAN)' if known else 'TRUE'} AS early_stopped"
    )


def _scaled(column: str) -> str:
    """By the standard deviation of the training rows; a constant column is 0."""
    deviation = f"(SELECT stddev_samp({column}) FROM features WHERE split = 'train')"
    return f"round(COALESCE({column} / NULLIF({deviation}, 0), 0E0), 6) AS {column}_scaled"


_COLUMN_KINDS = {
    "customers": ("customer_id signup_date age region contract plan internet_service payment_method monthly_charges churned",
                  "customer_id age monthly_charges churned"),
    "usage": ("customer_id month call_minutes data_gb sms_count app_logins",
              "customer_id call_minutes data_gb sms_count app_logins"),
    "payments": ("customer_id due_date paid_date amount days_late", "customer_id amount days_late"),
    "tickets": ("customer_id created_date category is_complaint resolution_hours escalated satisfaction",
                "customer_id is_complaint resolution_hours escalated satisfaction"),
    "service_calls": ("customer_id call_date duration_min resolved sentiment",
                      "customer_id duration_min resolved sentiment"),
}
_EVERY_COLUMN = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{c}' AS column_name, COUNT(*) AS row_count, COUNT({c}) AS present, "
    f"COUNT(DISTINCT {c}) AS different, "
    + (f"SUM(FLOOR(CAST({c} AS DOUBLE)))" if c in numbers.split() else "CAST(NULL AS DOUBLE)") + f" AS total FROM {table}"
    for table, (columns, numbers) in _COLUMN_KINDS.items() for c in columns.split()
)

SQL: dict[str, str] = {
    "parquet_roundtrip": _with(RELATIONS, then=_EVERY_COLUMN),
    "split_xxhash": _with(
        XXHASH,
        then="SELECT customer_id, CASE WHEN bucket < 70 THEN 'train' WHEN bucket < 85 THEN 'val' ELSE 'test' END AS split "
        "FROM xbuckets",
    ),
    "scores_lr": _with(
        *BASE, *[_slot(c) for c in CATEGORIES],
        then="SELECT customer_id, split, label, TRUE AS valid, TRUE AS optimal, "
        f"CAST({_slot_offset(len(CATEGORIES))} + 1 AS BIGINT) AS n_weights FROM features",
    ),
    "scores_rf": _checked("TRUE AS as_walked, CAST(100 AS INT) AS n_trees"),
    "scores_gbt": _checked("TRUE AS as_walked, CAST(100 AS INT) AS n_trees"),
    "scores_gbt_es": _checked("TRUE AS as_walked, TRUE AS kept_best, TRUE AS stopped_or_full"),
    "tuned_params": _searched(
        "logistic_regression", *[f"regParam={r},elasticNetParam={e}" for r in ("0.001", "0.01", "0.1") for e in ("0.0", "0.5")]
    ),
    "tuned_params_rf": _searched("random_forest", *[f"maxDepth={d}.0,numTrees={t}.0" for d in (6, 8) for t in (60, 100)]),
    "tuned_params_gbt": _searched("gbt", *[f"maxDepth={d}.0,maxIter={i}.0" for d in (3, 5) for i in (60, 120)]),
    "feature_importance": " UNION ALL ".join(
        f"SELECT '{m}' AS model, CAST(r AS INT) AS rank, TRUE AS in_order, TRUE AS as_in_nodes, TRUE AS reads, TRUE AS is_slot "
        "FROM range(1, 16) AS ranks(r)" for m in MODELS
    ),
    "scored_customers": _with(
        *BASE,
        then=f"SELECT customer_id, label AS actual_churn, split, {', '.join(CATEGORIES)}, tenure_months, monthly_charges, "
        "late_payments, TRUE AS best_model_used, TRUE AS band_fits, TRUE AS prediction_fits FROM features",
    ),
    "run_metrics": _with(
        *BASE,
        then=" UNION ALL ".join(
            "SELECT '2000-06-30' AS snapshot_date, 'raw/2000-06-30' AS raw_source, CAST(36 AS INT) AS n_features, "
            + ", ".join(
                f"(SELECT COUNT(*) FROM {t}) AS n_{t}" for t in ("customers", "usage", "payments", "tickets", "service_calls")
            )
            + f", '{m}' AS model, '{shown}' AS display_name, 'Spark MLlib' AS engine, CAST(15 AS INT) AS n_importance, "
            "(SELECT COUNT(*) FROM features WHERE split = 'test') AS n_test, TRUE AS areas, TRUE AS timed, TRUE AS curves, "
            + _reported(m)
            for m, shown in MODELS.items()
        ),
    ),
    "ingest_counts": _with(RELATIONS, then=_COUNTS),
    "csv_roundtrip": _with(
        RELATIONS,
        then=" UNION ALL ".join(
            [
                _fingerprint("customers", "monthly_charges", "signup_date"),
                _fingerprint("usage", "call_minutes", "month"),
                _fingerprint("payments", "days_late", "due_date"),
                _fingerprint("tickets", "satisfaction", "created_date"),
                _fingerprint("service_calls", "sentiment", "call_date"),
            ]
        ),
    ),
    "norm_customers": _with(NORMALIZED, then="SELECT * FROM normalized"),
    "bootstrap_customers": _with(NORMALIZED, BOOTSTRAP, then="SELECT * EXCLUDE (draw) FROM drawn"),
    "bootstrap_jitter": _with(
        NORMALIZED, BOOTSTRAP,
        then="SELECT customer_id, source_customer_id, "
        f"GREATEST(ROUND(monthly_charges * (1E0 + 3E-2 * ({_NORMAL})), 2), 15E0) AS monthly_charges FROM drawn",
    ),
    "label_rate": _with(
        RELATIONS,
        then="SELECT COUNT(*) AS n, CAST(SUM(churned) AS BIGINT) AS positives, AVG(churned) AS rate FROM customers",
    ),
    "usage_features": _with(RELATIONS, BLOCKS, then="SELECT * FROM usage_block"),
    "payment_features": _with(RELATIONS, BLOCKS, then="SELECT * FROM payment_block"),
    "ticket_features": _with(RELATIONS, BLOCKS, then="SELECT * FROM ticket_block"),
    "call_features": _with(RELATIONS, BLOCKS, then="SELECT * FROM call_block"),
    "feature_table": _with(
        *BASE, then=f"SELECT customer_id, label, {', '.join(CATEGORIES + NUMBERS)}, split FROM features"
    ),
    "split_assignment": f"SELECT c_custkey AS customer_id, {_split('c_custkey')} AS split FROM customer",
    "split_profile": _with(
        *BASE,
        then="SELECT split, COUNT(*) AS n, AVG(label) AS label_rate, CAST(36 AS INT) AS n_features "
        "FROM features GROUP BY split",
    ),
    "roc_auc": _with(*RANKED, then="SELECT model, split, n, positives, roc_auc FROM summary WHERE split <> 'train'"),
    "average_precision": _with(
        *RANKED,
        then="SELECT model, split, ROUND(average_precision, 9) AS average_precision FROM summary WHERE split <> 'train'",
    ),
    "best_f1_threshold": _with(*RANKED, then="SELECT * FROM best_cut WHERE split <> 'train'"),
    "best_model": _with(*RANKED, CHOICE, then="SELECT * FROM choice"),
    "confusion_at_threshold": _with(*RANKED, CONFUSION, then="SELECT * FROM confusion"),
    "threshold_metrics": _with(*RANKED, CONFUSION, then="SELECT * FROM cut_metrics"),
    "roc_curve": _with(*RANKED, CURVES, then="SELECT model, idx, x AS fpr, y AS tpr FROM roc"),
    "pr_curve": _with(*RANKED, CURVES, then="SELECT model, idx, x AS recall, y AS precision FROM pr"),
    "curve_downsample": _with(*RANKED, CURVES, then="SELECT * FROM thinned"),
    "top_decile_lift": _with(*SCORED, _ordered(), then="SELECT * FROM lift"),
    "cumulative_gains": _with(
        *SCORED, _ordered(),
        then="SELECT model, rank, CAST(rank AS DOUBLE) / CAST(n AS DOUBLE) AS contacted, "
        "CAST(found AS DOUBLE) / NULLIF(CAST(positives AS DOUBLE), 0E0) AS captured "
        "FROM ordered WHERE (rank - 1) % GREATEST(1, n // 200) = 0",
    ),
    "gains_at_decile": _with(
        *SCORED, _ordered(),
        then="SELECT model, rank, CAST(found AS DOUBLE) / NULLIF(CAST(positives AS DOUBLE), 0E0) AS captured "
        "FROM ordered WHERE rank = CAST(FLOOR(1E-1 * n) AS BIGINT) + 1",
    ),
    "exact_score_summary": _with(
        *EXACT, _ordered("exact_scored"),
        then="SELECT model, summary.n, summary.positives, roc_auc, ROUND(average_precision, 9) AS average_precision, "
        "best_threshold, best_f1, top_decile_lift "
        "FROM summary JOIN best_cut USING (model, split) JOIN lift USING (model) WHERE split = 'test'",
    ),
    "exact_score_curves": _with(*EXACT, CURVES, then="SELECT * FROM thinned"),
    "model_comparison": _with(
        *RANKED, CONFUSION, _ordered(),
        then="SELECT model, 'Surrogate ' || model AS display_name, 'Spark SQL' AS engine, 0E0 AS train_seconds, roc_auc, "
        "ROUND(average_precision, 9) AS pr_auc, threshold, precision, recall, f1, "
        "top_decile_lift FROM summary JOIN cut_metrics USING (model) JOIN lift USING (model) "
        "WHERE split = 'test' AND cut = 'at_tuned'",
    ),
    "risk_scores": _with(
        *EXPORT,
        then="SELECT customer_id, churn_probability, risk_band, predicted_churn, actual_churn, split, prob_s1, prob_s2 "
        "FROM export",
    ),
    "risk_scores_exact": _with(
        *EXACT, CHOICE,
        """exact_wide AS (
  SELECT customer_id, MAX(CASE WHEN model = 's1' THEN score END) AS p1, MAX(CASE WHEN model = 's2' THEN score END) AS p2
  FROM exact_scored GROUP BY customer_id
),
chosen AS (
  SELECT customer_id, ROUND(CASE WHEN model = 's1' THEN p1 ELSE p2 END, 4) AS churn_probability, threshold,
         ROUND(p1, 4) AS prob_s1, ROUND(p2, 4) AS prob_s2
  FROM exact_wide, choice
)""",
        then="SELECT customer_id, churn_probability, "
        "CASE WHEN churn_probability >= 5E-1 THEN 'High' WHEN churn_probability >= 25E-2 THEN 'Medium' ELSE 'Low' END "
        "AS risk_band, CASE WHEN churn_probability >= threshold THEN 1 ELSE 0 END AS predicted_churn, prob_s1, prob_s2 "
        "FROM chosen",
    ),
    "risk_factors": _with(*EXPORT, then="SELECT customer_id, risk_factors FROM export"),
    "portfolio_kpis": _with(
        *EXPORT,
        then=f"SELECT COUNT(*) AS customers, AVG(actual_churn) AS actual_rate, {_hits("risk_band = 'High'")} AS high_risk, "
        "COALESCE(SUM(monthly_charges) FILTER (WHERE risk_band = 'High'), 0E0) AS revenue_at_risk, "
        f"CAST({_hits("risk_band = 'High'")} AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS high_share FROM export",
    ),
    "band_rollup": _with(
        *EXPORT,
        then="SELECT position, band AS risk_band, NULLIF(COUNT(customer_id), 0) AS n, AVG(actual_churn) AS actual_rate "
        "FROM (VALUES (0, 'Low'), (1, 'Medium'), (2, 'High')) AS bands(position, band) "
        "LEFT JOIN export ON risk_band = band GROUP BY 1, 2",
    ),
    "probability_histogram": _with(
        *EXPORT, 
        then="SELECT CAST(bins.bin AS INT) AS bin, COUNT(best_bp) AS n FROM range(40) AS bins(bin) "
        "LEFT JOIN export ON bins.bin = LEAST(best_bp // 250, 39) GROUP BY 1",
    ),
    "segment_rollup": _with(
        *EXPORT,
        then="SELECT segment, value, CAST(SUM(best_bp) AS DOUBLE) / CAST(COUNT(*) * 10000 AS DOUBLE) AS mean_probability, "
        f"AVG(actual_churn) AS actual_rate, COUNT(*) AS n FROM ({_SEGMENTS}) GROUP BY 1, 2",
    ),
    "facet_values": _with(*EXPORT, then=_FACETS),
    "customer_list": _with(
        *EXPORT,
        then=f"SELECT {LIST_COLUMNS} FROM export WHERE risk_band IN ('High', 'Medium') "
        "ORDER BY churn_probability DESC, customer_id LIMIT 1000",
    ),
    "customer_list_export": _with(
        *EXPORT,
        then=f"SELECT {LIST_COLUMNS}, ROW_NUMBER() OVER (ORDER BY churn_probability DESC, customer_id) AS position "
        "FROM export WHERE contract IN ('Month-to-month', 'One year') "
        "AND region IN ('ASIA', 'EUROPE', 'AFRICA') AND plan IN ('Standard', 'Premium') "
        "AND best_bp BETWEEN 1000 AND 4500 AND split = 'test'",
    ),
    "customer_list_summary": _with(
        *EXPORT,
        then="SELECT COUNT(*) AS n, AVG(monthly_charges) AS mean_monthly_charge FROM export "
        "WHERE risk_band IN ('High', 'Medium')",
    ),
    "customer_lookup": _with(
        *EXPORT,
        then="SELECT customer_id, churn_probability, risk_band, tenure_months, contract, monthly_charges, plan, "
        "risk_factors, prob_s1, prob_s2, actual_churn, split FROM export "
        "WHERE upper(CAST(customer_id AS VARCHAR)) = upper(trim(' 7 '))",
    ),
    "model_scores_long": _with(
        *EXPORT,
        then="SELECT customer_id, 'Surrogate s1' AS model, prob_s1 AS probability FROM export "
        "UNION ALL SELECT customer_id, 'Surrogate s2', prob_s2 FROM export",
    ),
    "rate_by_behaviour": _with(
        *EXPORT,
        then=f"SELECT feature, bucket, AVG(actual_churn) AS rate, COUNT(*) AS n FROM ({_BEHAVIOUR}) GROUP BY 1, 2",
    ),
    "rate_by_tenure": _with(
        *EXPORT,
        then="SELECT label AS bucket, AVG(actual_churn) AS rate, COUNT(*) AS n FROM export JOIN "
        "(VALUES (-1, 6, '0–6'), (6, 12, '7–12'), (12, 24, '13–24'), (24, 36, '25–36'), (36, 48, '37–48'), "
        "(48, 100, '49+')) AS buckets(above, upto, label) ON tenure_months > above AND tenure_months <= upto GROUP BY 1",
    ),
    "encoded_features": _with(
        *BASE, *[_slot(c) for c in CATEGORIES],
        then=f"SELECT customer_id, CAST({_slot_offset(len(CATEGORIES))} AS INT) AS n_slots, "
        f"{', '.join(_slot_of(i) for i in range(len(CATEGORIES)))}, {', '.join(NUMBERS)}, "
        f"{', '.join(_scaled(c) for c in NUMBERS)} FROM features "
        + " ".join(f"LEFT JOIN {c}_slots USING ({c})" for c in CATEGORIES),
    ),
}
