"""SQL that states each registered query over the supplied tables, for a second engine.

Every text is a chain of named parts.  ``_sql`` puts the parts a query needs, in order,
in front of its last SELECT.
"""

from __future__ import annotations

import re

PARTS: dict[str, str] = {}
ORACLES: dict[str, str] = {}


def _uses(text: str) -> list[str]:
    words = set(re.findall(r"\b[a-z_0-9]+\b", text))
    return [name for name in PARTS if name in words]


def _sql(body: str) -> str:
    needed: dict[str, None] = {}

    def add(text: str) -> None:
        for name in _uses(text):
            if name not in needed:
                add(PARTS[name])
                needed[name] = None

    add(body)
    ordered = [name for name in PARTS if name in needed]
    if not ordered:
        return body.strip()
    head = ",\n".join(f"{name} AS ({PARTS[name].strip()})" for name in ordered)
    return f"WITH {head}\n{body.strip()}"


def _id(prefix: str, key: str) -> str:
    number = f"CAST({key} AS VARCHAR)"
    return f"'{prefix}' || lpad({number}, CAST(greatest(9, length({number})) AS INTEGER), '0')"


def _folded(column: str) -> str:
    return (
        "CAST(DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', "
        f"CAST({column} AS DATE)) % 1096 AS INTEGER) AS DATE)"
    )


def _tier(key: str) -> str:
    return (
        f"CASE {key} % 4 WHEN 0 THEN 'Free' WHEN 1 THEN 'Basic' WHEN 2 THEN 'Pro' "
        "ELSE 'Enterprise' END"
    )


_ORDER_START = _folded("o_orderdate")
_ORDER_END = (
    f"CAST({_ORDER_START} AS TIMESTAMP) + to_days(CAST(30 + o_orderkey % 151 AS INTEGER)) "
    "+ to_hours(CAST(o_orderkey % 24 AS INTEGER))"
)

PARTS["src_subscriptions"] = f"""
SELECT {_id('S', 'o_orderkey')} AS subscription_id, {_id('A', 'o_custkey')} AS account_id,
  {_ORDER_START} AS start_date, {_ORDER_END} AS end_ts, {_tier('o_orderkey')} AS plan_tier,
  CAST(1 + o_orderkey % 50 AS INTEGER) AS seats,
  CAST((1 + o_orderkey % 50) * (CASE o_orderkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 10 WHEN 2 THEN 25 ELSE 60 END) AS DOUBLE) AS mrr_amount,
  CASE WHEN o_orderkey % 2 = 0 THEN 'monthly' ELSE 'annual' END AS billing_frequency,
  o_orderkey AS n
FROM orders"""

PARTS["src_churn_events"] = f"""
SELECT {_id('C', 'o_orderkey')} AS churn_event_id, {_id('A', 'o_custkey')} AS account_id,
  CAST({_ORDER_END} AS DATE) AS churn_date,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'price_too_high' WHEN '2-HIGH' THEN 'missing_features'
    WHEN '3-MEDIUM' THEN 'bugs' WHEN '4-NOT SPECIFIED' THEN 'competitor'
    WHEN '5-LOW' THEN 'no_longer_needed' END AS reason_code,
  CAST(CASE WHEN o_orderkey % 151 < 30 THEN o_orderkey % 97 ELSE 0 END AS DOUBLE) AS refund_amount_usd,
  o_orderkey % 10 < 3 AS is_reactivation, o_orderkey AS n
FROM orders WHERE o_orderstatus = 'F'"""

PARTS["src_parties"] = f"""
SELECT {_id('A', 'c_custkey')} AS account_id, c_custkey AS n, c_name AS account_name,
  c_mktsegment AS industry, c_nationkey AS nation FROM customer
UNION ALL
SELECT {_id('V', 's_suppkey')}, s_suppkey, s_name, 'SUPPLIER', s_nationkey FROM supplier"""

PARTS["src_accounts"] = f"""
SELECT account_id, account_name, industry, n_name AS country,
  CAST(DATE '2024-01-01' + CAST(n % 1096 AS INTEGER) AS DATE) AS signup_date,
  CASE n % 6 WHEN 0 THEN 'organic' WHEN 1 THEN 'ads' WHEN 2 THEN 'partner'
    WHEN 3 THEN 'outbound' WHEN 4 THEN 'event' ELSE 'other' END AS referral_source,
  {_tier('n')} AS plan_tier, CAST(1 + n % 50 AS INTEGER) AS seats, n % 5 < 2 AS is_trial,
  account_id IN (SELECT account_id FROM src_churn_events) AS churn_flag, n
FROM src_parties JOIN nation ON nation = n_nationkey"""

PARTS["src_feature_usage"] = f"""
SELECT {_id('U', 'l_orderkey')} || '-' || CAST(l_linenumber AS VARCHAR) AS usage_id,
  {_id('S', 'l_orderkey')} AS subscription_id, {_folded('l_shipdate')} AS usage_date,
  CASE l_partkey % 5 WHEN 0 THEN 'dashboard' WHEN 1 THEN 'api' WHEN 2 THEN 'export'
    WHEN 3 THEN 'automation' ELSE 'integration' END AS feature_name,
  CAST(l_quantity AS BIGINT) AS usage_count,
  CAST(l_quantity * (10 + l_suppkey % 51) AS BIGINT) AS usage_duration_secs,
  CAST(l_linenumber % 4 AS BIGINT) AS error_count, l_partkey % 10 = 0 AS is_beta_feature,
  l_orderkey AS n
FROM lineitem"""

PARTS["src_support_tickets"] = f"""
SELECT {_id('T', 'event_id')} AS ticket_id, {_id('A', 'user_id')} AS account_id, ts AS submitted_at,
  CASE WHEN event_id % 7 <> 0 THEN ts + to_hours(CAST(1 + event_id % 72 AS INTEGER)) END AS closed_at,
  CASE WHEN event_id % 7 <> 0 THEN CAST(1 + event_id % 72 AS DOUBLE) END AS resolution_time_hours,
  CASE WHEN event_type = 'error' THEN 'high' WHEN event_type IN ('purchase', 'signup') THEN 'medium'
    ELSE 'low' END AS priority,
  CAST(5 + event_id % 116 AS INTEGER) AS first_response_time_minutes,
  CASE WHEN event_id % 5 >= 2 THEN CAST(1 + (event_id % 9) * 0.5 AS DOUBLE) END AS satisfaction_score,
  event_id % 10 = 0 AS escalation_flag, event_id AS n
FROM events"""


# --- subscription lifecycle -----------------------------------------------------------


def _days(later: str, earlier: str) -> str:
    return (
        f"CAST(floor((epoch(CAST({later} AS TIMESTAMP)) - epoch(CAST({earlier} AS TIMESTAMP))) "
        "/ 86400) AS BIGINT)"
    )


def _lifecycle(partition: str, churned: str, source: str = "src_subscriptions") -> str:
    return f"""
SELECT subscription_id, account_id, start_date, CAST(end_ts AS DATE) AS end_date, plan_tier, seats,
  billing_frequency, CAST(seq AS BIGINT) AS subscription_sequence,
  CAST(greatest({_days('end_ts', 'start_date')}, 0) AS INTEGER) AS days_active,
  {churned} AS churn_flag,
  coalesce({_days('start_date', 'prev_end')} > 60, FALSE) AS reactivation_flag,
  round_even(greatest(mrr_amount, 0), 2) AS mrr_amount,
  round_even(greatest(mrr_amount, 0) * 12, 2) AS arr_amount, n
FROM (SELECT *, lead(start_date) OVER w AS next_start, lag(end_ts) OVER w AS prev_end,
        row_number() OVER w AS seq
      FROM {source}
      WINDOW w AS (PARTITION BY {partition} ORDER BY start_date, subscription_id)) placed"""


_REFERENCE_TAIL = f"(next_start IS NULL OR {_days('next_start', 'end_ts')} > 60)"
_AS_OF_TAIL = (
    f"CASE WHEN next_start IS NULL THEN {_days(chr(39) + '2026-06-30' + chr(39), 'end_ts')} > 60 "
    f"ELSE {_days('next_start', 'end_ts')} > 60 END"
)
_BATCH = "account_id, year(start_date) * 100 + month(start_date)"
PARTS["facts"] = _lifecycle("account_id", _REFERENCE_TAIL)
PARTS["facts_asof"] = _lifecycle("account_id", _AS_OF_TAIL)
PARTS["facts_batch"] = _lifecycle(_BATCH, _REFERENCE_TAIL)

_LIFECYCLE_COLUMNS = """subscription_id, account_id, start_date, end_date, subscription_sequence,
  days_active, churn_flag, reactivation_flag, mrr_amount, arr_amount"""
ORACLES["subscription_lifecycle"] = _sql(f"SELECT {_LIFECYCLE_COLUMNS} FROM facts")
ORACLES["subscription_lifecycle_split"] = ORACLES["subscription_lifecycle"]
ORACLES["subscription_lifecycle_asof"] = _sql(f"SELECT {_LIFECYCLE_COLUMNS} FROM facts_asof")
ORACLES["subscription_lifecycle_batch_scope"] = _sql(
    f"SELECT {_LIFECYCLE_COLUMNS}, CAST(year(start_date) * 100 + month(start_date) AS INTEGER) "
    "AS batch_month FROM facts_batch"
)

# --- feature usage mart ------------------------------------------------------------------


def _usage(source: str, where: str = "TRUE") -> str:
    return f"""
SELECT CAST(year(usage_date) AS INTEGER) AS year, CAST(month(usage_date) AS INTEGER) AS month,
  feature_name, CAST(sum(usage_count) AS BIGINT) AS total_usage_count,
  CAST(sum(usage_duration_secs) AS BIGINT) AS total_duration_secs,
  CAST(sum(error_count) AS BIGINT) AS total_error_count,
  count(DISTINCT subscription_id) AS unique_subscriptions,
  round_even(CAST(sum(usage_count) AS DOUBLE) / nullif(count(DISTINCT subscription_id), 0), 2) AS avg_usage_per_sub,
  count(*) FILTER (WHERE is_beta_feature) AS beta_usage_count
FROM {source} WHERE {where} GROUP BY 1, 2, 3"""


PARTS["mart_usage"] = _usage("src_feature_usage")
ORACLES["feature_usage_summary"] = _sql("SELECT * FROM mart_usage")
ORACLES["feature_usage_from_state"] = ORACLES["feature_usage_summary"]
ORACLES["feature_usage_one_month"] = _sql(
    "SELECT * FROM mart_usage WHERE year = 2025 AND month = 3"
)
ORACLES["month_highwater_refresh"] = ORACLES["feature_usage_summary"]

PARTS["usage_target"] = _usage("src_feature_usage", "usage_date < DATE '2025-07-01'")
PARTS["usage_new"] = _usage(
    "src_feature_usage",
    "usage_date >= DATE '2025-03-01' AND feature_name <> 'export' AND error_count < 3",
)
ORACLES["delete_insert"] = _sql("""
SELECT * FROM usage_new UNION ALL
SELECT * FROM usage_target t WHERE NOT EXISTS (SELECT 1 FROM usage_new u
  WHERE u.year = t.year AND u.month = t.month AND u.feature_name = t.feature_name)""")

PARTS["usage_later"] = _usage("src_feature_usage", "usage_date >= DATE '2025-03-01'")
ORACLES["schema_evolution"] = _sql("""
SELECT *, CAST(NULL AS VARCHAR) AS grade FROM usage_later UNION ALL
SELECT * REPLACE (CAST(NULL AS BIGINT) AS beta_usage_count), upper(feature_name) AS grade
FROM usage_target t WHERE NOT EXISTS (SELECT 1 FROM usage_later u
  WHERE u.year = t.year AND u.month = t.month AND u.feature_name = t.feature_name)""")

ORACLES["month_replace"] = _sql("""
SELECT * FROM mart_usage
WHERE feature_name <> 'api' OR (year = 2025 AND month = 3) OR (year = 2026 AND month = 2)""")

# --- churn mart ----------------------------------------------------------------------------

_CALENDAR_SPAN = "s.start_date <= last_day(m.m) AND CAST(s.end_ts AS DATE) >= m.m"
def _churn_of(source: str) -> str:
    return f"""
SELECT CAST(year(churn_date) AS INTEGER) AS year, CAST(month(churn_date) AS INTEGER) AS month,
  reason_code, count(*) AS churn_count, round_even(sum(refund_amount_usd), 2) AS total_refund_usd,
  count(*) FILTER (WHERE is_reactivation) AS reactivation_count
FROM {source} GROUP BY 1, 2, 3"""


PARTS["churn_groups"] = _churn_of("src_churn_events")
_STARTING = """
SELECT year(start_date) AS y, month(start_date) AS m, count(DISTINCT account_id) AS cnt
FROM {} GROUP BY 1, 2"""
PARTS["starting_accounts"] = _STARTING.format("src_subscriptions")
PARTS["all_months"] = """
SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2026-12-01', INTERVAL 1 MONTH)) AS DATE) AS m"""
PARTS["active_accounts_by_month"] = f"""
SELECT year(m.m) AS y, month(m.m) AS m, count(DISTINCT account_id) AS cnt
FROM src_subscriptions s JOIN all_months m ON {_CALENDAR_SPAN} GROUP BY 1, 2"""


def _churn_rate(base: str, groups: str = "churn_groups") -> str:
    return f"""
SELECT c.*, round_even(CASE WHEN b.cnt > 0 THEN CAST(c.churn_count AS DOUBLE) / b.cnt * 100 ELSE 0 END, 2) AS churn_rate_pct
FROM {groups} c LEFT JOIN {base} b ON c.year = b.y AND c.month = b.m"""


PARTS["mart_churn"] = _churn_rate("starting_accounts")
ORACLES["churn_summary"] = _sql("SELECT * FROM mart_churn")
ORACLES["churn_summary_active_base"] = _sql(_churn_rate("active_accounts_by_month"))
PARTS["spanning_accounts"] = """
SELECT count(DISTINCT account_id) AS cnt FROM src_subscriptions
WHERE year(start_date) <= 2025 AND month(start_date) <= 3
  AND (year(end_ts) > 2025 OR (year(end_ts) = 2025 AND month(end_ts) >= 3))"""
ORACLES["churn_one_month"] = _sql("""
SELECT c.*, round_even(CASE WHEN b.cnt > 0 THEN CAST(c.churn_count AS DOUBLE) / b.cnt * 100 ELSE 0 END, 2) AS churn_rate_pct
FROM churn_groups c CROSS JOIN spanning_accounts b WHERE c.year = 2025 AND c.month = 3""")

# --- revenue mart ------------------------------------------------------------------------------

# Months are counted from year 0, so a subscription's span is a range of whole numbers.


def _month_number(day: str) -> str:
    return f"(12 * year({day}) + month({day}) - 1)"


PARTS["calendar_months"] = "SELECT unnest(range(12 * 2024, 12 * 2026 + 6)) AS nth"
PARTS["stepped_months"] = f"""
SELECT DISTINCT {_month_number('d')} AS nth
FROM (SELECT DATE '2024-01-01' + CAST(30 * i AS INTEGER) AS d FROM range(30) t(i))"""


def _revenue(
    months: str, by_calendar: bool = False, keep: str = "TRUE",
    facts: str = "facts", churn: str = "src_churn_events",
) -> str:
    """Revenue per month and tier.  As written, month numbers within a year must not fall either."""
    season = "TRUE" if by_calendar else "nth % 12 >= month(start_date) - 1"
    return f"""
SELECT CAST(nth // 12 AS INTEGER) AS year, CAST(nth % 12 + 1 AS INTEGER) AS month, plan_tier,
  count(DISTINCT account_id) AS active_accounts,
  count(DISTINCT account_id) FILTER (WHERE arrived) AS new_accounts,
  count(DISTINCT account_id) FILTER (WHERE gone) AS churned_accounts,
  round_even(sum(mrr_amount), 2) AS total_mrr, round_even(sum(arr_amount), 2) AS total_arr,
  round_even(sum(mrr_amount) / count(mrr_amount), 2) AS avg_mrr_per_account,
  CAST(sum(seats) AS BIGINT) AS total_seats
FROM (SELECT *, unnest(range({_month_number('start_date')}, {_month_number('end_date')} + 1)) AS nth
      FROM {facts}) listed
LEFT JOIN (
  SELECT account_id, nth, bool_or(first_one) AS arrived, bool_or(NOT first_one) AS gone
  FROM (SELECT account_id, {_month_number('start_date')} AS nth, TRUE AS first_one
        FROM {facts} WHERE subscription_sequence = 1
        UNION ALL SELECT account_id, {_month_number('churn_date')}, FALSE FROM {churn}) turns
  GROUP BY ALL) marked USING (account_id, nth)
WHERE nth IN (SELECT nth FROM {months}) AND {season} AND {keep}
GROUP BY nth, plan_tier"""


PARTS["mart_mrr"] = _revenue("stepped_months")
ORACLES["mrr_monthly_reference"] = _sql("SELECT * FROM mart_mrr")
ORACLES["mrr_monthly_calendar"] = _sql(_revenue("calendar_months", by_calendar=True))
ORACLES["mrr_monthly_refresh_reference"] = _sql(
    _revenue("stepped_months", keep="nth >= 12 * 2026 AND start_date >= DATE '2026-01-01'")
)
ORACLES["mrr_monthly_refresh_corrected"] = _sql(
    _revenue("calendar_months", by_calendar=True, keep="nth >= 12 * 2026")
)
ORACLES["mrr_monthly_sweep"] = ORACLES["mrr_monthly_calendar"]
ORACLES["mrr_one_month"] = _sql(_revenue("calendar_months", keep="nth = 12 * 2025 + 2"))

# --- health mart ---------------------------------------------------------------------------------


def _health(
    facts: str = "facts", zeroes: bool = True, usage_upto: str = "9999-12-31", touched: str = "TRUE",
    tickets: str = "src_support_tickets", churn: str = "src_churn_events", accounts: str = "src_accounts",
    usage: str = "src_feature_usage", as_of: str = "2026-06-30",
) -> str:
    """Score per account from one grouped part per source.

    ``zeroes`` puts 0, '' and 1970-01-01 where an account has no subscription; ``touched`` is a
    condition on ``day`` that one event of the account must meet.
    """
    inputs = (
        "coalesce(churned, FALSE) AS churned, coalesce(mrr, 0) AS mrr, coalesce(tier, '') AS tier, "
        "coalesce(newest, DATE '1970-01-01') AS newest"
        if zeroes
        else "churned, mrr, coalesce(tier, plan_tier) AS tier, newest"
    )
    return f"""
SELECT account_id, account_name, tier AS plan_tier, country, industry,
  CAST(least(greatest(50 + CASE churned WHEN TRUE THEN -15 WHEN FALSE THEN 15 ELSE 0 END
    + 10 * (CAST(coalesce(mrr > 0, FALSE) AS INTEGER) + CAST(coalesce(mood >= 4, FALSE) AS INTEGER)
      + CAST(uses > 0 AS INTEGER) - CAST(waiting > 0 AS INTEGER)
      - CAST(coalesce(idle > 90, FALSE) AS INTEGER)), 0), 100) AS BIGINT) AS health_score,
  round_even(CAST(coalesce(mrr, 0) AS DOUBLE), 2) AS mrr_last_month,
  round_even(mood, 2) AS avg_satisfaction,
  CAST(uses AS BIGINT) AS total_usage_30d, CAST(waiting AS BIGINT) AS open_high_tickets,
  CASE WHEN coalesce(churned, FALSE) OR uses = 0 THEN 'high'
    WHEN coalesce(idle > 90, FALSE) OR coalesce(mood < 3, FALSE) THEN 'medium' ELSE 'low' END AS churn_risk,
  CAST(idle AS BIGINT) AS days_since_last_activity
FROM (
  SELECT *, DATE '{as_of}' - newest AS idle
  FROM (
    SELECT account_id, account_name, country, industry, mood, coalesce(waiting, 0) AS waiting,
      coalesce(uses, 0) AS uses, {inputs}
    FROM {accounts}
    LEFT JOIN (
      SELECT account_id, max(start_date) AS newest, max_by(churn_flag, rank) AS churned,
        max_by(mrr_amount, rank) AS mrr, max_by(plan_tier, rank) AS tier
      FROM (SELECT *, CAST(start_date AS VARCHAR) || subscription_id AS rank FROM {facts}) ranked
      GROUP BY account_id) held USING (account_id)
    LEFT JOIN (
      SELECT account_id, sum(uses) AS uses
      FROM (SELECT subscription_id, sum(usage_count) AS uses FROM {usage}
            WHERE usage_date BETWEEN DATE '{as_of}' - 30 AND DATE '{usage_upto}'
            GROUP BY subscription_id) per_subscription
      JOIN {facts} USING (subscription_id) GROUP BY account_id) used USING (account_id)
    LEFT JOIN (
      SELECT account_id, avg(satisfaction_score) AS mood,
        count(CASE WHEN priority = 'high' AND closed_at IS NULL THEN 1 END) AS waiting
      FROM {tickets} GROUP BY account_id) asked USING (account_id)
    WHERE account_id IN (
      SELECT account_id
      FROM (SELECT account_id, start_date AS day FROM {facts}
            UNION ALL SELECT account_id, churn_date FROM {churn}
            UNION ALL SELECT account_id, CAST(submitted_at AS DATE) FROM {tickets}) moves
      WHERE {touched})))"""


PARTS["mart_health"] = _health()
ORACLES["health_score_reference"] = _sql("SELECT * FROM mart_health")
ORACLES["health_score_corrected"] = _sql(_health("facts_asof", zeroes=False, usage_upto="2026-06-30"))
ORACLES["health_affected_window"] = _sql(
    _health(touched="day > DATE '2026-05-31' AND day <= DATE '2026-06-30'")
)

# --- source derivations --------------------------------------------------------------------------

_RATE = "CASE plan_tier WHEN 'Basic' THEN 0.05 WHEN 'Pro' THEN 0.1 WHEN 'Enterprise' THEN 0.2 ELSE 0 END"
_PRICE = "CASE plan_tier WHEN 'Basic' THEN 10 WHEN 'Pro' THEN 25 WHEN 'Enterprise' THEN 60 ELSE 0 END"
PARTS["priced_subs"] = f"""
SELECT *, CAST(seats * {_PRICE} AS DOUBLE) AS gross,
  round_even(CAST(seats * {_PRICE} AS DOUBLE) * CAST({_RATE} AS DOUBLE), 2) AS discount
FROM src_subscriptions"""
ORACLES["plan_revenue"] = _sql("""
SELECT subscription_id, plan_tier, seats, round_even(gross / seats, 2) AS price, gross AS gross_revenue,
  discount AS discount_value, round_even(gross - discount, 2) AS mrr_amount,
  round_even(round_even(gross - discount, 2) * 12, 2) AS arr_amount
FROM priced_subs""")

PARTS["move_flags"] = """
SELECT *, coalesce(tier_rank > lag(tier_rank) OVER w, FALSE) AS upgrade_flag,
  coalesce(tier_rank < lag(tier_rank) OVER w, FALSE) AS downgrade_flag,
  row_number() OVER (PARTITION BY account_id, plan_tier ORDER BY start_date, subscription_id) = 1 AS is_trial,
  n % 10 < 3 AS churned,
  lead(start_date) OVER w IS NOT NULL AS has_next
FROM (SELECT *, n % 4 AS tier_rank FROM src_subscriptions) t
WINDOW w AS (PARTITION BY account_id ORDER BY start_date, subscription_id)"""
ORACLES["plan_moves"] = _sql(
    "SELECT subscription_id, account_id, plan_tier, upgrade_flag, downgrade_flag FROM move_flags"
)
ORACLES["plan_moves_split"] = ORACLES["plan_moves"]
ORACLES["trial_flags"] = _sql("SELECT subscription_id, account_id, plan_tier, is_trial FROM move_flags")
ORACLES["reactivations"] = _sql("""
SELECT subscription_id, account_id, churned AS churn_flag, churned AND has_next AS is_reactivation
FROM move_flags""")
PARTS["ended_subs"] = f"""
SELECT *, {_days('CASE WHEN seats % 3 = 0 THEN start_date + INTERVAL 500 HOUR ELSE end_ts END', 'start_date')} AS days,
  CASE WHEN seats % 3 = 0 THEN start_date + INTERVAL 500 HOUR ELSE end_ts END AS over_at
FROM move_flags"""
ORACLES["churn_refunds"] = _sql(f"""
SELECT {_id('C', 'n')} AS churn_event_id, account_id, CAST(over_at AS DATE) AS churn_date,
  CASE WHEN days < 30 THEN round_even(mrr_amount * greatest(days / 20.0::DOUBLE, 0.1::DOUBLE) * 0.5::DOUBLE, 2) ELSE 0 END AS refund_amount_usd,
  upgrade_flag AS preceding_upgrade_flag, downgrade_flag AS preceding_downgrade_flag,
  has_next AS is_reactivation
FROM ended_subs WHERE churned""")
ORACLES["account_churn_flag"] = _sql("SELECT account_id, churn_flag FROM src_accounts")
ORACLES["ticket_satisfaction"] = _sql("""
SELECT ticket_id, submitted_at,
  submitted_at + to_milliseconds(CAST(round(h * 3600000) AS BIGINT)) AS closed_at, escalation_flag,
  round_even(greatest(5 - h / 24 - CASE WHEN escalation_flag THEN 2 ELSE 0 END, 1), 2) AS satisfaction_score
FROM (SELECT *, 2 + CAST(n % 700 AS DOUBLE) / 10 AS h FROM src_support_tickets) t""")

# --- cleaning ----------------------------------------------------------------------------------------

ORACLES["accounts_clean"] = _sql("""
SELECT account_id, account_name, CASE WHEN n % 11 <> 0 THEN industry END AS industry, country,
  CASE WHEN n % 13 <> 0 THEN signup_date END AS signup_date,
  CASE WHEN n % 7 <> 0 THEN referral_source END AS referral_source, plan_tier,
  CASE WHEN n % 19 <> 0 THEN seats END AS seats,
  CASE WHEN n % 17 <> 0 THEN is_trial ELSE FALSE END AS is_trial,
  CASE WHEN n % 23 <> 0 THEN churn_flag ELSE FALSE END AS churn_flag
FROM src_accounts""")
ORACLES["churn_clean"] = _sql("""
SELECT churn_event_id, account_id, CASE WHEN n % 13 <> 0 THEN churn_date END AS churn_date,
  CASE WHEN n % 11 = 0 THEN 'unknown' ELSE reason_code END AS reason_code,
  CAST(CASE WHEN n % 5 = 0 OR n % 7 = 0 THEN 0 ELSE refund_amount_usd END AS DOUBLE) AS refund_amount_usd,
  is_reactivation
FROM src_churn_events""")
ORACLES["usage_clean"] = _sql("""
SELECT usage_id, subscription_id, CASE WHEN n % 13 <> 0 THEN usage_date END AS usage_date, feature_name,
  CAST(CASE WHEN n % 6 = 0 THEN 0 ELSE usage_count END AS BIGINT) AS usage_count,
  CAST(CASE WHEN n % 10 = 0 THEN 0 ELSE usage_duration_secs END AS BIGINT) AS usage_duration_secs,
  CAST(CASE WHEN n % 15 = 0 THEN 0 ELSE error_count END AS BIGINT) AS error_count,
  CASE WHEN n % 9 = 0 THEN FALSE ELSE is_beta_feature END AS is_beta_feature
FROM src_feature_usage""")
ORACLES["tickets_clean"] = _sql("""
SELECT ticket_id, account_id, CAST(submitted_at AS DATE) + INTERVAL 0 HOUR AS submitted_at,
  CASE WHEN n % 13 <> 0 THEN closed_at END AS closed_at,
  CAST(CASE WHEN n % 6 = 0 THEN 0 ELSE coalesce(resolution_time_hours, 0) END AS DOUBLE) AS resolution_time_hours,
  priority,
  CAST(CASE WHEN n % 8 = 0 THEN 0 ELSE first_response_time_minutes END AS INTEGER) AS first_response_time_minutes,
  CAST(CASE WHEN n % 4 = 0 THEN 5 WHEN n % 9 = 0 THEN 1 WHEN satisfaction_score < 1 THEN 1 WHEN satisfaction_score > 5 THEN 5 ELSE satisfaction_score END AS DOUBLE) AS satisfaction_score,
  CASE WHEN n % 14 = 0 THEN FALSE ELSE escalation_flag END AS escalation_flag
FROM src_support_tickets""")

_USAGE_COLUMNS = """usage_id, subscription_id, usage_date, feature_name, usage_count,
  usage_duration_secs, error_count, is_beta_feature"""


def _usage_last(keys: str = "usage_id", upto: str = "9999-12-31") -> str:
    return f"""
SELECT {_USAGE_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY usage_date DESC,
  subscription_id DESC, feature_name DESC, usage_count DESC, usage_duration_secs DESC,
  error_count DESC, is_beta_feature DESC) AS rn FROM src_feature_usage WHERE usage_date <= DATE '{upto}') r
WHERE rn = 1"""


PARTS["usage_last"] = _usage_last()
ORACLES["usage_dedup_keep_last"] = _sql("SELECT * FROM usage_last")
ORACLES["backfill_union"] = ORACLES["usage_dedup_keep_last"]

PARTS["event_days"] = """
SELECT 'accounts' AS table_name, signup_date AS day FROM src_accounts UNION ALL
SELECT 'subscriptions', start_date FROM src_subscriptions UNION ALL
SELECT 'churn_events', churn_date FROM src_churn_events UNION ALL
SELECT 'feature_usage', usage_date FROM src_feature_usage UNION ALL
SELECT 'support_tickets', CAST(submitted_at AS DATE) FROM src_support_tickets"""
ORACLES["ingest_window"] = _sql("""
SELECT table_name, CAST(year(day) * 100 + month(day) AS INTEGER) AS month, count(*) AS rows FROM event_days
WHERE day > DATE '2025-03-31' AND day <= DATE '2025-06-30' GROUP BY 1, 2""")
ORACLES["rolling_window"] = _sql("""
SELECT table_name, b.batch_date, day, count(*) AS rows
FROM event_days JOIN (VALUES (DATE '2024-01-20'), (DATE '2026-06-30')) b(batch_date)
  ON day >= greatest(b.batch_date - 30, DATE '2024-01-01') AND day <= b.batch_date
GROUP BY 1, 2, 3""")
ORACLES["event_ranges"] = _sql("""
SELECT table_name, min(day) AS first_day, max(day) AS last_day, count(*) AS rows, count(day) AS dated_rows
FROM event_days GROUP BY 1""")

ORACLES["staging_align"] = _sql("""
SELECT subscription_id, account_id, start_date, end_date, plan_tier, seats,
  CAST(NULL AS DOUBLE) AS price, CAST(NULL AS DOUBLE) AS discount_value, mrr_amount, arr_amount,
  CAST(NULL AS INTEGER) AS is_trial, CAST(NULL AS INTEGER) AS upgrade_flag,
  CAST(NULL AS INTEGER) AS downgrade_flag, CAST(churn_flag AS INTEGER) AS churn_flag,
  CAST(reactivation_flag AS INTEGER) AS reactivation_flag, billing_frequency,
  CAST(NULL AS INTEGER) AS auto_renew_flag, subscription_sequence, days_active,
  '2026-07-01T00:00:00' AS _ingestion_time, 'transactional_system' AS _source_system,
  'batch-1' AS _batch_id
FROM facts""")

_ABSENT = {
    "subscriptions": (
        "price", "discount_value", "arr_amount", "is_trial", "upgrade_flag", "downgrade_flag",
        "churn_flag", "reactivation_flag", "auto_renew_flag", "subscription_sequence", "days_active",
    ),
    "churn_events": ("preceding_upgrade_flag", "preceding_downgrade_flag", "feedback_text"),
}
_drift = [
    f"SELECT '{t}' AS table_name, 'not_in_staging' AS column_name, 'only_in_source' AS side, "
    f"count(*) AS filled_values FROM src_{t}"
    for t in ("accounts", "subscriptions", "churn_events", "feature_usage", "support_tickets")
]
_drift += [
    f"SELECT '{t}', '{c}', 'only_in_target', 0" for t, cols in _ABSENT.items() for c in cols
]
ORACLES["schema_drift"] = _sql(" UNION ALL ".join(_drift))

# --- dimensions ------------------------------------------------------------------------------------------

PARTS["calendar_days"] = """
SELECT CAST(DATE '2024-01-01' + CAST(i AS INTEGER) AS DATE) AS d FROM range(0, 1096) t(i)"""
PARTS["starts_per_day"] = "SELECT start_date, count(*) AS starts FROM src_subscriptions GROUP BY 1"
ORACLES["dim_date_starts"] = _sql("""
SELECT d AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
  CAST(strftime(d, '%U') AS INTEGER) AS week_of_year, CAST(day(d) AS INTEGER) AS day_of_month,
  CAST(isodow(d) AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name,
  isodow(d) IN (6, 7) AS is_weekend, day(d) = 1 AS is_month_start, d = last_day(d) AS is_month_end,
  coalesce(s.starts, 0) AS starts
FROM calendar_days LEFT JOIN starts_per_day s ON s.start_date = d""")

PARTS["plan_seed"] = """
SELECT * FROM (VALUES ('Free', 0.0::DOUBLE, 'none', 'Free tier, no billing'),
  ('Basic', 10.0::DOUBLE, 'monthly', 'Basic plan, per seat per month'),
  ('Pro', 25.0::DOUBLE, 'monthly', 'Pro plan, per seat per month'),
  ('Enterprise', 60.0::DOUBLE, 'mixed', 'Enterprise, negotiated pricing'))
  v(plan_tier, price_per_seat_usd, billing_type, description)"""
ORACLES["dim_plans_subscriptions"] = _sql("""
SELECT p.plan_tier, price_per_seat_usd, billing_type, description, count(s.plan_tier) AS subscriptions,
  CAST(coalesce(sum(s.seats), 0) AS BIGINT) AS seats,
  price_per_seat_usd * CAST(coalesce(sum(s.seats), 0) AS BIGINT) AS list_revenue
FROM plan_seed p LEFT JOIN src_subscriptions s ON p.plan_tier = s.plan_tier GROUP BY 1, 2, 3, 4""")

ORACLES["account_fact_counts"] = _sql("""
SELECT a.account_id, a.plan_tier,
  (SELECT count(*) FROM src_subscriptions s WHERE s.account_id = a.account_id) AS subscriptions,
  (SELECT count(*) FROM src_churn_events c WHERE c.account_id = a.account_id) AS churn_events,
  (SELECT count(*) FROM src_support_tickets t WHERE t.account_id = a.account_id) AS tickets,
  (SELECT count(*) FROM src_feature_usage u JOIN src_subscriptions s USING (subscription_id)
   WHERE s.account_id = a.account_id) AS usage_rows
FROM src_accounts a""")

# --- versions and incremental runs --------------------------------------------------------------------------

PARTS["sub_versions"] = """
SELECT subscription_id, account_id, start_date, plan_tier, seats, CAST(1000 AS BIGINT) AS _updated_at FROM src_subscriptions
UNION ALL SELECT subscription_id, account_id, start_date, plan_tier, seats + 1, 2000 FROM src_subscriptions WHERE n % 3 = 0
UNION ALL SELECT subscription_id, account_id,
  CASE WHEN n % 10 = 0 THEN CAST(start_date + 1 AS DATE) ELSE start_date END, plan_tier, seats, 3000
FROM src_subscriptions WHERE n % 5 = 0"""
for _name, _keys in (
    ("latest_version", "account_id, start_date, subscription_id"),
    ("latest_version_by_pk", "subscription_id"),
):
    ORACLES[_name] = _sql(f"""
SELECT subscription_id, account_id, start_date, plan_tier, CAST(seats AS INTEGER) AS seats, _updated_at
FROM (SELECT *, row_number() OVER (PARTITION BY {_keys} ORDER BY _updated_at DESC) AS rn FROM sub_versions) v
WHERE rn = 1""")

ORACLES["late_rows_dropped"] = _sql("""
SELECT feature_name,
  count(*) FILTER (WHERE usage_date > DATE '2025-06-30' AND usage_date <= DATE '2025-12-31') AS taken,
  count(*) FILTER (WHERE usage_date <= DATE '2025-06-30') AS late,
  count(*) FILTER (WHERE usage_date > DATE '2025-12-31') AS not_yet
FROM src_feature_usage GROUP BY 1""")

ORACLES["watermark_state"] = _sql("""
SELECT 'ingestion_' || table_name AS key,
  CASE WHEN table_name = 'subscriptions' THEN DATE '2024-01-01' ELSE max(day) END AS watermark
FROM event_days GROUP BY table_name""")

ORACLES["warehouse_load"] = _sql("""
SELECT CAST(year(usage_date) * 100 + month(usage_date) AS INTEGER) AS month,
  'application_logs' AS _source_system, 't' AS _ingestion_time,
  CAST(1751328000000 AS BIGINT) AS _updated_at, count(*) AS rows,
  CAST(sum(usage_count) AS BIGINT) AS uses
FROM src_feature_usage WHERE usage_date > DATE '2024-12-31' AND usage_date <= DATE '2025-12-31'
GROUP BY 1""")

ORACLES["lake_roundtrip"] = _sql("""
SELECT usage_date, count(*) AS rows, CAST(sum(usage_count) AS BIGINT) AS uses,
  CAST(0 AS BIGINT) AS with_batch_id
FROM src_feature_usage WHERE usage_date > DATE '2025-01-31' AND usage_date <= DATE '2025-07-31' GROUP BY 1""")
ORACLES["csv_roundtrip"] = _sql("SELECT * EXCLUDE (n) FROM src_accounts")
ORACLES["ingest_stream_usage"] = _sql("""
SELECT CAST(year(usage_date) * 100 + month(usage_date) AS INTEGER) AS month, feature_name,
  count(*) AS rows, CAST(sum(usage_count) AS BIGINT) AS uses
FROM usage_last GROUP BY 1, 2""")
PARTS["usage_merged"] = """
SELECT usage_id, usage_date, feature_name, usage_count
FROM (SELECT *, row_number() OVER (PARTITION BY usage_id ORDER BY usage_date DESC, arrival DESC,
        subscription_id DESC, feature_name DESC, usage_count DESC, usage_duration_secs DESC,
        error_count DESC, is_beta_feature DESC) AS rn
      FROM (SELECT * REPLACE (CAST(1 AS BIGINT) AS usage_count), 0 AS arrival FROM src_feature_usage
            WHERE usage_date <= DATE '2025-12-31'
            UNION ALL
            SELECT *, 1 AS arrival FROM src_feature_usage
            WHERE usage_date > (SELECT max(usage_date) - 30 FROM src_feature_usage
                                WHERE usage_date <= DATE '2025-12-31')) arrived) r
WHERE rn = 1"""
ORACLES["stream_upsert_usage"] = _sql("""
SELECT CAST(year(usage_date) * 100 + month(usage_date) AS INTEGER) AS month, feature_name,
  count(*) AS rows, CAST(sum(usage_count) AS BIGINT) AS uses
FROM usage_merged GROUP BY 1, 2""")
ORACLES["csv_records_in_parts"] = _sql("""
SELECT churn_event_id, account_id, churn_date,
  CASE WHEN right(churn_event_id, 1) < '3'
    THEN reason_code || ' said "no",' || chr(10) || churn_event_id || chr(10) || chr(10) || 'and left'
    ELSE reason_code END AS feedback_text
FROM src_churn_events""")
# A run takes in rows dated up to its batch date, so its marts are those of these rows.
for _run, _day in (("early", "2026-05-31"), ("run", "2026-06-30")):
    for _table, _column in (
        ("subscriptions", "start_date"), ("churn_events", "churn_date"),
        ("support_tickets", "CAST(submitted_at AS DATE)"), ("accounts", "signup_date"),
    ):
        PARTS[f"{_run}_{_table}"] = f"SELECT * FROM src_{_table} WHERE {_column} <= DATE '{_day}'"
    PARTS[f"{_run}_feature_usage"] = _usage_last(upto=_day)
    PARTS[f"{_run}_facts"] = _lifecycle("account_id", _REFERENCE_TAIL, f"{_run}_subscriptions")
    PARTS[f"{_run}_churn_groups"] = _churn_of(f"{_run}_churn_events")
    PARTS[f"{_run}_starting"] = _STARTING.format(f"{_run}_subscriptions")
# As written, a step sees the rows of its own batch only.
PARTS["step_facts"] = _lifecycle(
    "account_id, start_date > DATE '2026-05-31'", _REFERENCE_TAIL, "run_subscriptions"
)
PARTS["step_feature_usage"] = _usage_last("usage_id, usage_date > DATE '2026-05-31'", "2026-06-30")


def _tables(run: str) -> dict[str, str]:
    return {
        "accounts": f"{run}_accounts", "tickets": f"{run}_support_tickets",
        "churn": f"{run}_churn_events", "usage": f"{run}_feature_usage",
    }


def _over(old: str, new: str, keys: str) -> str:
    """Rows of the newer result and those of the older one whose key it lacks."""
    return f"""
SELECT * FROM ({new}) fresh UNION ALL BY NAME
SELECT * FROM ({old}) stale WHERE ({keys}) NOT IN (SELECT ({keys}) FROM ({new}) fresh)"""


def _scores_over(facts: str, zeroes: bool, touched: str) -> str:
    old = _health("early_facts", zeroes, as_of="2026-05-31", **_tables("early"))
    tables = _tables("run") | {"usage": facts.replace("facts", "feature_usage")}
    return _over(old, _health(facts, zeroes, touched=touched, **tables), "account_id")


ORACLES["daily_run_mrr"] = _sql(_revenue("stepped_months", facts="run_facts", churn="run_churn_events"))
# The list of months of a run at the end of May stops with April, so April is refreshed first.
_EARLY_REVENUE = _revenue(
    "stepped_months", keep="nth <= 12 * 2026 + 3", facts="early_facts", churn="early_churn_events"
)
ORACLES["daily_run_incremental_mrr_monthly_reference"] = _sql(_over(
    _EARLY_REVENUE,
    _revenue("stepped_months", keep="nth >= 12 * 2026 + 3 AND start_date >= DATE '2026-04-01'",
             facts="step_facts", churn="run_churn_events"),
    "year, month, plan_tier",
))
ORACLES["daily_run_incremental_mrr_monthly_corrected"] = _sql(
    _revenue("calendar_months", by_calendar=True, facts="run_facts", churn="run_churn_events")
)
ORACLES["daily_run_incremental_customer_health_score_reference"] = _sql(
    _scores_over("step_facts", True, "day > DATE '2026-06-28'")
)
ORACLES["daily_run_incremental_customer_health_score_corrected"] = _sql(
    _scores_over("run_facts", False, "day > DATE '2026-06-28'")
)
for _mode in ("incremental_churn_summary_reference", "incremental_churn_summary_corrected", "corrected_steps_churn_summary"):
    ORACLES[f"daily_run_{_mode}"] = _sql(_churn_rate("run_starting", "run_churn_groups"))
ORACLES["daily_run_incremental_feature_usage_summary_reference"] = _sql(_usage("step_feature_usage"))
ORACLES["daily_run_incremental_feature_usage_summary_corrected"] = _sql(_over(
    _usage("early_feature_usage"), _usage("run_feature_usage", "usage_date >= DATE '2026-05-01'"),
    "year, month, feature_name",
))
for _mart in ("mrr_monthly", "feature_usage_summary"):
    ORACLES[f"daily_run_corrected_steps_{_mart}"] = ORACLES[f"daily_run_incremental_{_mart}_corrected"]
ORACLES["mrr_month_refresh"] = _sql(_over(
    _EARLY_REVENUE,
    _revenue("calendar_months", keep="nth = 12 * 2026 + 5", facts="step_facts", churn="run_churn_events"),
    "year, month, plan_tier",
))
ORACLES["churn_month_refresh"] = _sql(f"""
SELECT * FROM ({_churn_rate('early_starting', 'early_churn_groups')}) known WHERE year * 100 + month < 202606
UNION ALL BY NAME
SELECT g.*, round_even(CASE WHEN a.cnt > 0 THEN 100 * CAST(g.churn_count AS DOUBLE) / a.cnt ELSE 0 END, 2) AS churn_rate_pct
FROM run_churn_groups g, (
  SELECT count(DISTINCT account_id) AS cnt FROM run_subscriptions
  WHERE year(start_date) <= 2026 AND month(start_date) <= 6 AND {_month_number('end_ts')} >= 12 * 2026 + 5) a
WHERE g.year = 2026 AND g.month = 6""")
ORACLES["usage_month_refresh"] = _sql(_usage("step_feature_usage"))
ORACLES["health_window_refresh"] = _sql(
    _scores_over("step_facts", True, "day > DATE '2026-05-31' AND day <= DATE '2026-06-30'")
)
PARTS["run_facts_asof"] = _lifecycle("account_id", _AS_OF_TAIL, "run_subscriptions")
PARTS["run_facts_later"] = _lifecycle(
    "account_id", _AS_OF_TAIL.replace("2026-06-30", "2026-08-14"), "run_subscriptions"
)
ORACLES["daily_run_corrected_steps_customer_health_score"] = _sql(
    _health("run_facts_asof", zeroes=False, usage_upto="2026-06-30", **_tables("run"))
)
ORACLES["account_scores_later"] = _sql(
    _health("run_facts_later", zeroes=False, usage_upto="2026-08-14", as_of="2026-08-14", **_tables("run"))
)
ORACLES["changed_accounts_feed"] = _sql("""
SELECT DISTINCT account_id
FROM (SELECT account_id, start_date AS day FROM run_subscriptions
      UNION ALL SELECT account_id, churn_date FROM run_churn_events
      UNION ALL SELECT account_id, CAST(submitted_at AS DATE) FROM run_support_tickets
      UNION ALL SELECT account_id, signup_date FROM run_accounts
      UNION ALL SELECT account_id, usage_date FROM run_feature_usage JOIN run_subscriptions USING (subscription_id)
     ) moves
WHERE day > DATE '2026-05-31'""")
ORACLES["pk_rows_from_month"] = _sql("\nUNION ALL ".join(
    f"SELECT '{t.split('_', 1)[1]}' AS table_name, CAST(year({c}) * 100 + month({c}) AS INTEGER) AS month, "
    f"count(*) AS rows FROM {t} WHERE {c} >= DATE '2026-06-01' GROUP BY 2"
    for t, c in (("run_subscriptions", "start_date"), ("run_churn_events", "churn_date"),
                 ("run_accounts", "signup_date"), ("run_feature_usage", "usage_date"),
                 ("run_support_tickets", "submitted_at"))
))
ORACLES["backfill_run"] = _sql("\nUNION ALL ".join(
    f"SELECT '{t.split('_', 1)[1]}' AS table_name, CAST(year({c}) * 100 + month({c}) AS INTEGER) AS month, "
    f"count(*) AS rows FROM {t} GROUP BY 2"
    for t, c in (("run_subscriptions", "start_date"), ("run_churn_events", "churn_date"),
                 ("run_accounts", "signup_date"), ("step_feature_usage", "usage_date"),
                 ("run_support_tickets", "submitted_at"))
))
PARTS["usage_in_two"] = _usage_last("usage_id, usage_date > DATE '2025-06-30'", "2025-12-31")
PARTS["usage_late"] = _usage_last("usage_id, usage_date > DATE '2025-06-30', feature_name = 'api'", "2025-06-30")
ORACLES["late_data_run"] = _sql("""
SELECT feature_name, CAST(year(usage_date) * 100 + month(usage_date) AS INTEGER) AS month,
  count(*) AS rows, CAST(sum(usage_count) AS BIGINT) AS uses
FROM (SELECT * FROM usage_in_two WHERE usage_date > DATE '2025-06-30'
      UNION ALL SELECT * FROM usage_late WHERE feature_name <> 'api') held
GROUP BY 1, 2""")
ORACLES["watermark_replay"] = _sql("""
SELECT step, count(churn_event_id) AS taken, watermark
FROM (VALUES ('first', DATE '2023-12-31', DATE '2024-06-30', DATE '2024-06-30'),
             ('next', DATE '2024-06-30', DATE '2024-12-31', DATE '2024-12-31'),
             ('earlier date', DATE '2024-12-31', DATE '2024-09-30', DATE '2024-12-31'),
             ('after reset', DATE '2023-12-31', DATE '2024-09-30', DATE '2024-09-30'),
             ('after reset of all', DATE '2024-01-01', DATE '2024-03-31', DATE '2024-03-31'))
  steps(step, after, upto, watermark)
LEFT JOIN src_churn_events ON churn_date > after AND churn_date <= upto
GROUP BY step, watermark""")

# --- checks ----------------------------------------------------------------------------------------------------

PARTS["bad_subscriptions"] = """
SELECT CASE WHEN n % 997 <> 0 THEN subscription_id END AS subscription_id, account_id, start_date,
  CASE WHEN n % 211 = 0 THEN CAST(start_date - 1 AS DATE) ELSE end_date END AS end_date,
  CASE WHEN n % 307 <> 0 THEN plan_tier END AS plan_tier,
  CASE WHEN n % 101 = 0 THEN -5 ELSE mrr_amount END AS mrr_amount,
  CASE WHEN n % 103 = 0 THEN -60 ELSE arr_amount END AS arr_amount
FROM facts"""
PARTS["bad_churn"] = """
SELECT churn_event_id, CASE WHEN n % 401 <> 0 THEN account_id END AS account_id, churn_date, reason_code,
  CASE WHEN n % 89 = 0 THEN -1 ELSE refund_amount_usd END AS refund_amount_usd
FROM src_churn_events"""
PARTS["bad_tickets"] = """
SELECT * REPLACE (CASE WHEN n % 503 = 0 THEN submitted_at - INTERVAL 1 HOUR ELSE closed_at END AS closed_at)
FROM src_support_tickets"""


def _check(table: str, name: str, bad: str, status: str, detail: str, source: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{name}' AS check_name, "
        f"CASE WHEN v > 0 THEN '{status}' ELSE 'PASS' END AS status, {detail} AS detail, "
        f"CAST(v AS BIGINT) AS violations FROM (SELECT {bad} AS v, count(*) AS c FROM {source}) q"
    )


def _skip(table: str, name: str, detail: str) -> str:
    return f"SELECT '{table}', '{name}', 'SKIP', '{detail}', CAST(0 AS BIGINT)"


def _listed(columns: tuple, word: str, condition: str, empty: str, source: str, table: str, name: str) -> str:
    counts = ", ".join(
        f"count(*) FILTER (WHERE {condition.format(c=c)}) AS c{i}" for i, c in enumerate(columns)
    )
    texts = ", ".join(
        f"CASE WHEN c{i} > 0 THEN '{c}: ' || c{i} || ' {word}' END" for i, c in enumerate(columns)
    )
    total = " + ".join(f"c{i}" for i in range(len(columns)))
    return (
        f"SELECT '{table}', '{name}', CASE WHEN {total} > 0 THEN 'FAIL' ELSE 'PASS' END, "
        f"coalesce(nullif(concat_ws(', ', {texts}), ''), '{empty}'), CAST({total} AS BIGINT) "
        f"FROM (SELECT {counts} FROM {source}) q"
    )


def _checks(table, source, pk, day, critical, revenue=(), order=None) -> list[str]:
    outside = f"count(*) FILTER (WHERE {day} < DATE '2024-01-01' OR {day} > DATE '2026-12-31')"
    rows = [
        _check(table, "non_empty_batch", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END", "WARNING",
               "format('{:,}', c) || ' rows'", source),
        _check(table, "no_null_pk", f"count(*) FILTER (WHERE {pk} IS NULL)", "FAIL",
               f"v || ' nulls in ''{pk}'''", source),
        _check(table, "no_duplicate_pk",
               f"count(*) - count(DISTINCT {pk}) - max(CASE WHEN {pk} IS NULL THEN 1 ELSE 0 END)",
               "WARNING", f"v || ' duplicates in ''{pk}'''", source),
        _listed(revenue, "negative", "{c} < 0", "all >= 0", source, table, "no_negative_revenue")
        if revenue else _skip(table, "no_negative_revenue", "no revenue columns"),
        _check(table, "date_order", f"count(*) FILTER (WHERE {order[1]} < {order[0]})", "FAIL",
               "v || ' rows where end < start'", source)
        if order else _skip(table, "date_order", "not applicable"),
        _check(table, "date_bounds", outside, "WARNING",
               "v || ' rows outside [2024-01-01, 2026-12-31]'", source),
        _listed(critical, "nulls", "{c} IS NULL", "all critical cols non-null", source, table,
                "no_null_critical_cols"),
    ]
    return rows


_ALL_CHECKS = " UNION ALL ".join(
    _checks("accounts", "src_accounts", "account_id", "signup_date",
            ("account_name", "industry", "country", "signup_date"))
    + _checks("subscriptions", "bad_subscriptions", "subscription_id", "start_date",
              ("account_id", "plan_tier", "start_date", "end_date"), ("mrr_amount", "arr_amount"),
              ("start_date", "end_date"))
    + _checks("churn_events", "bad_churn", "churn_event_id", "churn_date",
              ("account_id", "churn_date", "reason_code"), ("refund_amount_usd",))
    + _checks("feature_usage", "src_feature_usage", "usage_id", "usage_date",
              ("subscription_id", "usage_date", "feature_name"))
    + _checks("support_tickets", "bad_tickets", "ticket_id", "CAST(submitted_at AS DATE)",
              ("account_id", "submitted_at", "priority"), (), ("submitted_at", "closed_at"))
)
ORACLES["dq_results"] = _sql(_ALL_CHECKS)
ORACLES["dq_gate_status"] = _sql(f"""
SELECT count(*) FILTER (WHERE status = 'PASS') AS pass, count(*) FILTER (WHERE status = 'WARNING') AS warning,
  count(*) FILTER (WHERE status = 'FAIL') AS fail, count(*) FILTER (WHERE status = 'SKIP') AS skip,
  CASE WHEN count(*) FILTER (WHERE status = 'FAIL') > 0 THEN 'stop' ELSE 'go' END AS gate
FROM ({_ALL_CHECKS}) r""")

_MODELS = {
    "dim_accounts": ("src_accounts", "u:account_id n:account_id n:signup_date"),
    "dim_plans": ("plan_seed", "u:plan_tier n:plan_tier"),
    "fact_subscriptions": (
        "bad_subscriptions", "u:subscription_id n:subscription_id n:account_id n:mrr_amount g:mrr_amount"),
    "fact_churn_events": ("bad_churn", "u:churn_event_id n:churn_event_id n:account_id g:refund_amount_usd"),
    "fact_feature_usage": ("src_feature_usage", "u:usage_id n:usage_id n:subscription_id"),
    "fact_support_tickets": ("src_support_tickets", "u:ticket_id n:ticket_id n:account_id"),
    "mrr_monthly": ("mart_mrr", "n:year n:month n:plan_tier n:total_mrr g:total_mrr g:total_arr g:active_accounts"),
    "churn_summary": ("mart_churn", "n:year n:month n:reason_code p:churn_count g:total_refund_usd g:churn_rate_pct"),
    "feature_usage_summary": (
        "mart_usage", "n:year n:month n:feature_name g:total_usage_count p:unique_subscriptions"),
    "customer_health_score": (
        "mart_health", "u:account_id n:account_id n:health_score g:health_score h:health_score a:churn_risk g:mrr_last_month"),
}
_TEST_SQL = {
    "u": ("unique", "count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) x"),
    "n": ("not_null", "count(*) FROM {t} WHERE {c} IS NULL"),
    "g": ("expression_is_true >= 0", "count(*) FROM {t} WHERE NOT ({c} >= 0)"),
    "p": ("expression_is_true > 0", "count(*) FROM {t} WHERE NOT ({c} > 0)"),
    "h": ("expression_is_true <= 100", "count(*) FROM {t} WHERE NOT ({c} <= 100)"),
    "a": ("accepted_values low,medium,high",
          "count(DISTINCT {c}) FROM {t} WHERE {c} NOT IN ('low', 'medium', 'high')"),
}


def _declared() -> str:
    selects = []
    for model, (table, tests) in _MODELS.items():
        for item in tests.split():
            kind, column = item.split(":")
            name, body = _TEST_SQL[kind]
            selects.append(
                f"SELECT '{model}' AS model, '{column}' AS column_name, '{name}' AS test, "
                f"(SELECT {body.format(c=column, t=table)}) AS failures"
            )
    union = " UNION ALL ".join(selects)
    return f"SELECT *, CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status FROM ({union}) t"


ORACLES["declarative_checks"] = _sql(_declared())

_TYPES = {
    "accounts": "account_id:string account_name:string industry:string country:string signup_date:date "
    "referral_source:string plan_tier:string seats:int is_trial:boolean churn_flag:boolean",
    "subscriptions": "subscription_id:string account_id:string start_date:date end_date:timestamp "
    "plan_tier:string seats:int mrr_amount:double billing_frequency:string",
    "churn_events": "churn_event_id:string account_id:string churn_date:date reason_code:string "
    "refund_amount_usd:double is_reactivation:boolean",
    "feature_usage": "usage_id:string subscription_id:string usage_date:date feature_name:string "
    "usage_count:bigint usage_duration_secs:bigint error_count:bigint is_beta_feature:boolean",
    "support_tickets": "ticket_id:string account_id:string submitted_at:timestamp closed_at:timestamp "
    "resolution_time_hours:double priority:string first_response_time_minutes:int "
    "satisfaction_score:double escalation_flag:boolean",
}


def _cells(table: str, column: str) -> str:
    source = "end_ts" if column == "end_date" and table == "subscriptions" else column
    return f"SELECT CAST({source} AS VARCHAR) AS value FROM src_{table}"


def _profile(table: str, column: str, dtype: str) -> str:
    cells = _cells(table, column)
    return f"""
SELECT '{table}' AS table_name, '{column}' AS column_name, '{dtype}' AS dtype,
  (SELECT count(DISTINCT value) FROM ({cells}) x) AS n_unique,
  (SELECT count(value) FROM ({cells}) x) AS non_null,
  (SELECT string_agg(value, '|' ORDER BY value) FROM (
     SELECT value, row_number() OVER (ORDER BY value) AS r, count(*) OVER () AS k
     FROM (SELECT DISTINCT value FROM ({cells}) x WHERE value IS NOT NULL) y) z
   WHERE r <= CASE WHEN k <= 5 THEN 5 ELSE 4 END) AS sample_values"""


ORACLES["profile_columns"] = _sql(
    " UNION ALL ".join(
        _profile(t, *c.split(":")) for t, columns in _TYPES.items() for c in columns.split()
    )
)
_CATEGORIES = {
    "accounts": "industry plan_tier is_trial churn_flag referral_source country",
    "subscriptions": "plan_tier billing_frequency",
    "churn_events": "reason_code is_reactivation",
    "feature_usage": "feature_name is_beta_feature",
    "support_tickets": "priority escalation_flag",
}
ORACLES["value_sets"] = _sql(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, value, count(*) AS rows "
        f"FROM ({_cells(t, c)}) x WHERE value IS NOT NULL GROUP BY value"
        for t, columns in _CATEGORIES.items()
        for c in columns.split()
    )
)
ORACLES["adhoc_filters"] = _sql("""
SELECT 'churned' AS look, count(*) AS rows FROM move_flags WHERE churned UNION ALL
SELECT 'one_account', count(*) FROM move_flags WHERE account_id = 'A000000179' UNION ALL
SELECT 'both_moves', count(*) FROM move_flags WHERE upgrade_flag AND upgrade_flag = downgrade_flag UNION ALL
SELECT 'churned_after_upgrade', count(*) FROM move_flags WHERE churned AND upgrade_flag UNION ALL
SELECT 'reactivated', count(*) FROM src_churn_events WHERE is_reactivation UNION ALL
SELECT 'refunded', count(*) FROM src_churn_events WHERE refund_amount_usd > 0""")
ORACLES["stable_sample"] = _sql("""
SELECT subscription_id, account_id, plan_tier, seats FROM src_subscriptions
ORDER BY md5(subscription_id), subscription_id LIMIT 200""")
