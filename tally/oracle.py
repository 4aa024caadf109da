"""DuckDB oracle SQL for every registered query.

Written from the job definitions in other shapes than the DataFrame code, so
that one checks the other: a user's rows gathered into a list and numbered or
looked up by position where the jobs use prefix offsets, LAG and LEAD; as-of
joins and correlated lookups where they use windows; a recursive walk where they
double pointers; a map or a list position where they pivot or rank. Each text inlines the raw views of ``tally.sources.fixtures`` as
CTEs, since DuckDB only has the base parquet tables.
"""

from __future__ import annotations

from tally.sources.fixtures import duckdb_ctes

# The test clock (same as tally.catalog).
AS_OF = "DATE '2024-01-31'"
AS_OF_TS = "TIMESTAMP '2024-01-31 00:00:00'"


def _days_before(n: int) -> str:
    return f"CAST({AS_OF} - INTERVAL {n} DAY AS DATE)"


def _round2(expr: str) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(20,6)), 2) AS DOUBLE)"


# --- job CTEs: (name, raw views needed, body) -----------------------------

_EVENT_LOG_LO = f"CAST(epoch(CAST({_days_before(30)} AS TIMESTAMP)) AS BIGINT)"

CTE: dict[str, tuple[tuple[str, ...], tuple[str, ...], str]] = {}


def cte(name: str, views: tuple[str, ...], deps: tuple[str, ...], body: str) -> None:
    CTE[name] = (views, deps, body)


cte("event_log", ("user_events", "system_events", "api_events"), (), f"""
WITH tagged AS (
  SELECT 'user' AS tag, user_id AS owner, * FROM user_events
  UNION ALL BY NAME SELECT 'system' AS tag, ifnull(user_id, -1) AS owner, * FROM system_events
  UNION ALL BY NAME SELECT 'api' AS tag, ifnull(user_id, -1) AS owner, * FROM api_events
), logs AS (
  SELECT owner, list({{'id': event_id, 'kind': event_type, 'load': event_payload, 'tag': tag,
                      'at': make_timestamp(epoch_ts * 1000000), 'made': created_at}}
                     ORDER BY epoch_ts, tag, event_id) AS entries
  FROM tagged WHERE epoch_ts >= {_EVENT_LOG_LO} GROUP BY owner
), numbered AS (
  SELECT owner, unnest(entries) AS e, unnest(range(1, len(entries) + 1)) AS n, len(entries) AS size FROM logs)
SELECT e.id AS event_id, owner AS user_id, e.kind AS event_type, e.load AS event_payload,
  e.tag AS event_source, e.at AS event_ts, e.at::DATE AS event_date, e.made AS source_created_at,
  n AS idx, size - n + 1 AS idx_inverse, size AS user_event_count
FROM numbered""")

cte("staging", ("billing_transactions",), ("event_log",), f"""
WITH changes AS (
  SELECT user_id, list({{'at': event_ts, 'kind': event_type, 'plan': plan_id, 'cents': amount_cents,
                        'cur': currency, 'state': transaction_status}}
                       ORDER BY event_ts, event_source, event_id, plan_id, amount_cents, currency, transaction_status) AS c
  FROM (SELECT * FROM event_log WHERE starts_with(event_type, 'subscription_'))
  JOIN (SELECT * RENAME (reference_event_id AS event_id) FROM billing_transactions) USING (user_id, event_id)
  GROUP BY user_id
), steps AS (SELECT user_id, c, unnest(range(1, len(c) + 1)) AS n FROM changes)
SELECT user_id, c[n].plan AS plan_id, CASE WHEN n > 1 THEN c[n - 1].plan END AS prev_plan_id,
  c[n].at AS period_start, ifnull(c[n + 1].at, {AS_OF_TS}) AS period_end,
  CASE WHEN n = 1 AND c[n].kind = 'subscription_created' THEN 'new'
       ELSE ifnull(map {{'subscription_upgraded': 'upgrade', 'subscription_downgraded': 'downgrade',
                        'subscription_cancelled': 'churn', 'subscription_renewed': 'renewal'}}[c[n].kind], 'other')
  END AS transition_type,
  c[n].cents AS amount_cents, c[n].cur AS currency, c[n].state AS transaction_status, n AS event_seq,
  (ifnull(c[n + 1].at, {AS_OF_TS})::DATE - c[n].at::DATE)::INTEGER AS period_days, n = len(c) AS is_open
FROM steps""")


def _daily_events_body(as_of: str, lookback: int) -> str:
    return f"""
WITH per_day AS (
  SELECT event_date AS metric_date, count(*) AS total_events, count_if(event_source = 'user') AS user_events,
    count_if(event_source = 'system') AS system_events, count_if(event_source = 'api') AS api_events,
    len(list(DISTINCT user_id) FILTER (WHERE user_id > 0)) AS people
  FROM event_log WHERE event_date >= CAST({as_of} - INTERVAL {lookback} DAY AS DATE) GROUP BY ALL)
SELECT x.metric_date, x.total_events, x.user_events::BIGINT AS user_events, x.system_events::BIGINT AS system_events,
  x.api_events::BIGINT AS api_events, ifnull(x.people, 0) AS unique_users,
  ifnull(y.total_events, 0) AS prev_day_total_events,
  ifnull({_round2('(x.total_events - y.total_events)::DOUBLE / nullif(y.total_events, 0) * 100')}, 0.0) AS dod_change_pct
FROM per_day x ASOF LEFT JOIN per_day y ON x.metric_date > y.metric_date"""


cte("daily_event_counts", (), ("event_log",), _daily_events_body(AS_OF, 30))
cte("dec_0120", (), ("event_log",), _daily_events_body("DATE '2024-01-20'", 30))
cte("dec_0131_10", (), ("event_log",), _daily_events_body(AS_OF, 10))


cte("plan_info", ("plans", "plan_features", "plan_pricing"), (), """
WITH has AS (SELECT plan_id, list(DISTINCT feature_key) AS keys FROM plan_features GROUP BY plan_id),
costs AS (
  SELECT plan_id, map_from_entries(list((billing_interval, price_cents) ORDER BY price_cents)) AS price,
         max(currency) AS cur, max(trial_days) AS trial
  FROM (SELECT plan_id, billing_interval, max(price_cents) AS price_cents, max(currency) AS currency,
               max(trial_days) AS trial_days
        FROM plan_pricing WHERE effective_end IS NULL GROUP BY ALL)
  GROUP BY plan_id)
SELECT plan_id, plan_name, ifnull(plan_tier, 'standard') AS plan_tier, ifnull(is_active, true) AS is_active,
  ifnull(max_seats, 1) AS max_seats, ifnull(list_contains(keys, 'sso'), false)::INTEGER AS has_sso,
  ifnull(list_contains(keys, 'api_access'), false)::INTEGER AS has_api_access,
  ifnull(list_contains(keys, 'priority_support'), false)::INTEGER AS has_priority_support,
  ifnull(price['month'], 0) AS monthly_price_cents, ifnull(price['year'], 0) AS annual_price_cents,
  ifnull(cur, 'USD') AS currency, ifnull(trial, 0) AS trial_days, created_at, updated_at
FROM plans LEFT JOIN has USING (plan_id) LEFT JOIN costs USING (plan_id)
WHERE deleted_at IS NULL""")

# a user's periods follow one another without a gap, so the walk from the first one is all of them
cte("chain", (), ("staging",), f"""
SELECT * RENAME (event_seq AS period_seq) FROM staging
WHERE user_id IN (SELECT user_id FROM staging GROUP BY user_id
                  HAVING min(period_start) >= CAST({_days_before(90)} AS TIMESTAMP))""")

cte("periods", (), ("chain", "plan_info"), f"""
WITH tiers AS (SELECT map_from_entries(list((plan_id, plan_tier))) AS tier_of FROM plan_info),
priced AS (
  SELECT user_id, period_seq::BIGINT AS period_seq, plan_id, plan_name, plan_tier, period_start, period_end,
    period_days, transition_type, tier_of[prev_plan_id] AS prev_plan_tier,
    if(ifnull(plan_tier, '') = 'free', 0, amount_cents) AS mrr_cents,
    ifnull(transition_type = 'new' AND trial_days > 0 AND period_days <= trial_days, false) AS is_trial,
    transition_type <> 'churn' AND (is_open OR period_end > {AS_OF_TS}) AS is_active
  FROM chain CROSS JOIN tiers LEFT JOIN plan_info USING (plan_id)
), earned AS (SELECT user_id, list(mrr_cents ORDER BY period_seq) AS amounts FROM priced GROUP BY user_id)
SELECT priced.*, list_sum(amounts[1:period_seq])::BIGINT AS cumulative_revenue_cents
FROM priced JOIN earned USING (user_id)""")

cte("user_activity", (), ("event_log",), f"""
SELECT user_id, event_date AS activity_date, count(DISTINCT time_bucket(INTERVAL 30 MINUTE, event_ts)) AS session_count,
  count(*) AS total_events, min(event_ts) AS first_event_ts, max(event_ts) AS last_event_ts,
  first(event_type ORDER BY event_ts, event_source, event_id) AS first_event_type,
  last(event_type ORDER BY event_ts, event_source, event_id) AS last_event_type,
  date_diff('second', min(event_ts), max(event_ts)) AS active_seconds,
  ['low_activity', 'active', 'power_user'][1 + (count(*) >= 3)::INT + (count(*) >= 10)::INT] AS activity_status
FROM event_log WHERE user_id > 0 AND event_date >= {_days_before(30)} GROUP BY ALL""")

cte("active_users_weekly", (), ("user_activity",), f"""
WITH days AS (SELECT date_trunc('week', activity_date)::DATE AS week_start, * FROM user_activity)
SELECT week_start, week_start + 6 AS week_end, count(DISTINCT user_id) AS total_active_users,
  count(DISTINCT user_id) FILTER (activity_status = 'power_user') AS power_users,
  count(DISTINCT user_id) FILTER (activity_status = 'active') AS regular_active_users,
  count(DISTINCT user_id) FILTER (activity_status = 'low_activity') AS low_activity_users,
  {_round2('sum(session_count) / count(DISTINCT (user_id, activity_status))')} AS avg_sessions_per_user,
  {_round2('sum(total_events) / count(DISTINCT (user_id, activity_status))')} AS avg_events_per_user
FROM days WHERE week_start >= date_trunc('week', {_days_before(28)}) GROUP BY week_start""")


def _billing_body(where: str) -> str:
    return f"""
WITH order_of AS (SELECT ['subscription', 'addon', 'refund', 'other'] AS names),
bills AS (
  SELECT invoice_id, count(*) AS lines, sum(amount_cents * quantity)::BIGINT AS subtotal,
    min(CASE WHEN item_type IN ('subscription', 'addon') THEN list_position(names, item_type)
             WHEN item_type = 'credit' OR amount_cents < 0 THEN 3 ELSE 4 END) AS best
  FROM invoice_line_items, order_of GROUP BY invoice_id)
SELECT invoice_id, user_id, invoice_date::DATE AS invoice_date, names[best] AS invoice_category,
  lines AS line_item_count, subtotal AS subtotal_cents, ifnull(tax_cents, 0) AS tax_cents,
  subtotal + ifnull(tax_cents, 0) AS total_cents, ifnull(currency, 'USD') AS currency,
  status AS payment_status, ifnull(method_type, 'unknown') AS payment_method_type, paid_at, refunded_at,
  map {{'refunded': 0, 'completed': subtotal + ifnull(tax_cents, 0)}}[status]::BIGINT AS net_revenue_cents
FROM order_of, invoices JOIN bills USING (invoice_id) LEFT JOIN payment_methods USING (payment_method_id)
{where}"""


_BILLING_VIEWS = ("invoices", "invoice_line_items", "payment_methods")
cte("payment_billing", _BILLING_VIEWS, (),
    _billing_body(f"WHERE invoices.invoice_date >= CAST({_days_before(30)} AS TIMESTAMP)"))
cte("payment_billing_all", _BILLING_VIEWS, (), _billing_body(""))


cte("daily_user_counts", (), ("user_activity", "periods"), f"""
WITH people AS (
  SELECT activity_date, user_id,
    bool_or(period_seq = 1 AND period_start::DATE = activity_date) AS fresh,
    bool_or(period_seq > 1 OR period_start::DATE < activity_date) AS back,
    bool_or(transition_type = 'churn' AND period_end::DATE = activity_date) AS gone
  FROM (SELECT user_id, activity_date FROM user_activity WHERE activity_date >= {_days_before(30)}) act
  LEFT JOIN periods USING (user_id)
  WHERE period_seq IS NULL OR activity_date BETWEEN period_start::DATE AND period_end::DATE
  GROUP BY ALL
), everyone AS (
  SELECT a.activity_date AS metric_date, count_if(fresh) AS fresh, count_if(back) AS back, count(*) AS active,
    count_if(gone) AS gone
  FROM (SELECT DISTINCT user_id, activity_date FROM user_activity WHERE activity_date >= {_days_before(30)}) a
  LEFT JOIN people USING (user_id, activity_date) GROUP BY ALL
), known AS (
  SELECT *, (SELECT sum(x.fresh) FROM everyone x WHERE x.metric_date <= e.metric_date)::BIGINT AS so_far,
    (SELECT arg_min(x.active, x.metric_date) FROM everyone x WHERE x.metric_date > e.metric_date) AS after
  FROM everyone e)
SELECT metric_date, fresh::BIGINT AS new_users, back::BIGINT AS returning_users, active AS total_active_users,
  gone::BIGINT AS churned_users, so_far AS cumulative_users, after AS next_day_active_users,
  {_round2('(after - active)::DOUBLE / active * 100')} AS dod_change_pct
FROM known""")


def _revenue_body(active: str) -> str:
    return f"""
WITH paid AS (
  SELECT invoice_date AS metric_date, map_from_entries(list((invoice_category, cents))) AS by_kind,
    sum(cents) AS cents, sum(abs_cents) FILTER (invoice_category = 'refund') AS refunds, sum(net) AS net
  FROM (SELECT invoice_date, invoice_category, sum(total_cents) AS cents, sum(abs(total_cents)) AS abs_cents,
               sum(ifnull(net_revenue_cents, 0)) AS net
        FROM payment_billing WHERE payment_status <> 'pending' AND invoice_date >= {_days_before(30)} GROUP BY ALL)
  GROUP BY invoice_date
), covered AS (
  SELECT unnest(generate_series(greatest(period_start::DATE, {_days_before(30)})::TIMESTAMP,
                                least(period_end::DATE, {AS_OF})::TIMESTAMP, INTERVAL 1 DAY))::DATE AS metric_date,
         user_id, plan_tier, mrr_cents
  FROM periods WHERE {active}
), recurring AS (
  SELECT metric_date, sum(mrr_cents) AS mrr, count(DISTINCT user_id) FILTER (plan_tier = 'free') AS free,
    count(DISTINCT user_id) FILTER (plan_tier = 'standard') AS standard,
    count(DISTINCT user_id) FILTER (plan_tier = 'premium') AS premium,
    count(DISTINCT user_id) FILTER (plan_tier = 'enterprise') AS enterprise,
    count(DISTINCT user_id) FILTER (plan_tier <> 'free') AS paying
  FROM covered GROUP BY metric_date
), days AS (SELECT metric_date FROM paid UNION SELECT metric_date FROM recurring)
SELECT metric_date, ifnull(cents, 0)::BIGINT AS total_revenue_cents,
  ifnull(by_kind['subscription'], 0)::BIGINT AS subscription_revenue_cents,
  ifnull(by_kind['addon'], 0)::BIGINT AS addon_revenue_cents, ifnull(refunds, 0)::BIGINT AS refund_cents,
  ifnull(net, 0)::BIGINT AS net_revenue_cents, ifnull(mrr, 0)::BIGINT AS mrr_cents,
  (ifnull(mrr, 0) * 12)::BIGINT AS arr_cents, ifnull(free, 0) AS free_tier_users,
  ifnull(standard, 0) AS standard_tier_users, ifnull(premium, 0) AS premium_tier_users,
  ifnull(enterprise, 0) AS enterprise_tier_users, ifnull(paying, 0) AS paying_users,
  ifnull({_round2('mrr::DOUBLE / nullif(paying, 0)')}, 0.0) AS arpu_cents
FROM days LEFT JOIN paid USING (metric_date) LEFT JOIN recurring USING (metric_date)"""


cte("daily_revenue_counts", (), ("payment_billing", "periods"), _revenue_body("is_active"))
cte("daily_revenue_pit", (), ("payment_billing", "periods"), _revenue_body("transition_type <> 'churn'"))

cte("walked_links", ("order_links",), (), """
WITH RECURSIVE walk AS (
  SELECT *, 1 AS step FROM order_links WHERE is_first
  UNION
  SELECT l.*, w.step + 1 FROM walk w JOIN order_links l
    ON l.user_id = w.user_id AND l.period_start = w.period_end AND w.period_end > w.period_start)
SELECT order_id, user_id, period_start, period_end, min(step)::BIGINT AS period_seq
FROM walk GROUP BY ALL""")

cte("hours", (), ("staging",), """
SELECT metric_hour, count(*) AS active_periods, sum(amount_cents)::BIGINT AS amount_cents
FROM (SELECT unnest(generate_series(date_trunc('hour', min(period_start)), max(period_end), INTERVAL 1 HOUR)) AS metric_hour
      FROM staging)
JOIN staging ON period_start <= metric_hour AND metric_hour < period_end
GROUP BY metric_hour""")

cte("dictionary", ("dictionary_files",), (), """
WITH entries AS (
  SELECT file_no, value, unnest(json_keys(value)) AS category, unnest(range(len(json_keys(value)))) AS pos
  FROM dictionary_files
), kept AS (
  SELECT category, row_number() OVER (ORDER BY min((file_no, pos))) AS ord, arg_max(value, file_no) AS value
  FROM entries GROUP BY category)
SELECT ord, category, array_to_string(from_json(json_extract(value, '$."' || category || '"'), '["VARCHAR"]'), ',') AS keywords
FROM kept""")

_SHEET_TYPES = {"plan_id": "BIGINT", "plan_name": "VARCHAR", "max_seats": "INTEGER", "monthly_price": "DOUBLE",
                "is_active": "BOOLEAN", "valid_from": "DATE"}
cte("sheet_cells", ("plan_sheet",), (), " UNION ALL ".join(
    f"SELECT sheet_row, '{c}' AS \"column\", trim({c}) AS value, TRY_CAST(trim({c}) AS {t}) IS NULL AS wrong "
    f"FROM plan_sheet WHERE trim({c}) <> ''" for c, t in _SHEET_TYPES.items()))


# The test dictionary (ordered).
TEST_DICTIONARY = (("motion", ("from", "with")), ("quality", ("tion", "thon")),
                   ("people", ("ther",)))
_TERMS = r"regexp_extract_all(lower(title), '\p{L}{2,}')"


def _dict_cats(terms: str) -> str:
    parts = ", ".join(
        f"CASE WHEN list_has_any({terms}, [{', '.join(repr(k) for k in kws)}]) THEN '{cat}' END"
        for cat, kws in TEST_DICTIONARY)
    return f"concat_ws(',', {parts})"


def categorize(view: str, category_type: str) -> str:
    return query(f"""
WITH t AS (SELECT id, title, {_TERMS} AS terms FROM {view} WHERE title IS NOT NULL),
c AS (SELECT id, title, array_to_string(terms, ',') AS nouns, {_dict_cats('terms')} AS cats
      FROM t WHERE len(terms) > 0)
SELECT id, title, nouns, CASE WHEN cats = '' THEN 'uncategorized' ELSE cats END AS category,
  '{category_type}' AS category_type
FROM c""", [], extra_views=(view,))


cte("cohort_base", ("order_periods",), (), """
SELECT user_id, CAST(date_trunc('month', MIN(period_start)) AS DATE) AS cohort_month,
  MIN(period_start) AS first_period_start
FROM order_periods GROUP BY user_id""")



cte("billing_t", (), ("payment_billing_all",), """
SELECT invoice_id AS billing_id, user_id, invoice_date, invoice_category, line_item_count,
  subtotal_cents, tax_cents, total_cents, currency, payment_status, payment_method_type,
  paid_at, refunded_at, net_revenue_cents, payment_status = 'completed' AS is_paid
FROM payment_billing_all""")

cte("summary_t", (), ("periods",), """
SELECT user_id, count(*) AS period_count, arg_max(plan_id, period_seq) AS latest_plan_id,
  last(plan_tier ORDER BY period_seq) AS latest_plan_tier, arg_max(transition_type, period_seq) AS latest_transition_type,
  max(period_start) AS latest_period_start, sum(mrr_cents)::BIGINT AS lifetime_revenue_cents,
  arg_max(is_active, period_seq) AS is_active
FROM periods GROUP BY user_id""")


def _closure(names: list[str]) -> tuple[list[str], list[str]]:
    """Raw views and job CTEs (dependency order) needed by ``names``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTE[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    views: list[str] = []
    for n in order:
        for v in CTE[n][0]:
            if v not in views:
                views.append(v)
    return views, order


def query(final: str, uses: list[str], extra_views: tuple[str, ...] = ()) -> str:
    """``WITH <raw views>, <job CTEs> <final>`` (``final`` may start with WITH)."""
    views, jobs = _closure(uses)
    for v in extra_views:
        if v not in views:
            views.append(v)
    parts = []
    if views:
        parts.append(duckdb_ctes(views))
    for j in jobs:
        parts.append(f"{j} AS (\n{CTE[j][2].strip()}\n)")
    final = final.strip()
    if final.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + final[5:]
    return "WITH " + ",\n".join(parts) + "\n" + final


def job(name: str) -> str:
    return query(f"SELECT * FROM {name}", [name])


_SPINE = (f"SELECT CAST(g AS DATE) AS metric_date FROM generate_series("
          f"CAST({_days_before(30)} AS TIMESTAMP), CAST({AS_OF} AS TIMESTAMP), INTERVAL 1 DAY) t(g)")

N_ORACLE = {
    "billing_events": query(f"""
SELECT e.user_id, e.event_id, e.event_ts, e.event_type, b.plan_id, b.amount_cents, b.currency,
  b.transaction_status
FROM event_log e JOIN billing_transactions b
  ON e.user_id = b.user_id AND e.event_id = b.reference_event_id
WHERE e.event_date >= CAST(date_trunc('month', {AS_OF}) AS DATE)
  AND e.event_date < CAST(date_trunc('month', {AS_OF}) + INTERVAL 1 MONTH AS DATE)""",
                            ["event_log"], ("billing_transactions",)),
    "subscription_events_enriched": query("""
SELECT s.user_id, s.event_seq, s.plan_id, s.prev_plan_id, s.transition_type, s.period_start,
  s.period_end, s.amount_cents, s.currency, p.plan_name, p.plan_tier,
  p.is_active AS plan_is_active, p.monthly_price_cents, p.annual_price_cents, p.trial_days
FROM staging s LEFT JOIN plan_info p ON s.plan_id = p.plan_id""", ["staging", "plan_info"]),
    "period_calc": query("""
SELECT user_id, event_seq, plan_id, period_start, period_end, period_days AS days_active,
  (transition_type = 'churn'
   OR COALESCE(LEAD(transition_type) OVER (PARTITION BY user_id ORDER BY event_seq) = 'churn',
               FALSE)) AS is_churned
FROM staging""", ["staging"]),
    "merged_periods": query("""
WITH d AS (SELECT DISTINCT * FROM order_periods),
m AS (
  SELECT *, MAX(period_end) OVER (PARTITION BY user_id, plan_id
      ORDER BY period_start, period_end, mrr_cents
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end
  FROM d),
f AS (SELECT *, CASE WHEN prev_end IS NULL OR period_start > prev_end THEN 1 ELSE 0 END AS brk
      FROM m),
i AS (
  SELECT *, SUM(brk) OVER (PARTITION BY user_id, plan_id
      ORDER BY period_start, period_end, mrr_cents ROWS UNBOUNDED PRECEDING) AS island_seq
  FROM f)
SELECT user_id, plan_id, CAST(island_seq AS BIGINT) AS island_seq,
  MIN(period_start) AS period_start, MAX(period_end) AS period_end, COUNT(*) AS period_count
FROM i GROUP BY user_id, plan_id, island_seq""", [], ("order_periods",)),
    "cohort_base": job("cohort_base"),
    "retention_matrix": query("""
WITH mm AS (
  SELECT user_id, unnest(generate_series(date_trunc('month', period_start),
                                         date_trunc('month', period_end),
                                         INTERVAL 1 MONTH)) AS m
  FROM order_periods),
am AS (SELECT DISTINCT user_id, CAST(m AS DATE) AS activity_month FROM mm),
a AS (
  SELECT c.cohort_month,
    CAST(date_diff('month', c.cohort_month, am.activity_month) AS INTEGER) AS month_offset,
    COUNT(*) AS active_users
  FROM am JOIN cohort_base c ON am.user_id = c.user_id GROUP BY 1, 2),
sz AS (SELECT cohort_month, COUNT(*) AS cohort_size FROM cohort_base GROUP BY 1)
SELECT a.cohort_month, a.month_offset, a.active_users, sz.cohort_size,
  CAST(ROUND(CAST(a.active_users / sz.cohort_size AS DECIMAL(20,6)), 4) AS DOUBLE)
    AS retention_rate
FROM a JOIN sz ON a.cohort_month = sz.cohort_month""", ["cohort_base"]),
    "revenue_by_cohort": query("""
SELECT c.cohort_month, CAST(date_trunc('month', o.period_start) AS DATE) AS revenue_month,
  CAST(date_diff('month', c.cohort_month, CAST(date_trunc('month', o.period_start) AS DATE))
       AS INTEGER) AS month_offset,
  CAST(SUM(o.mrr_cents) AS BIGINT) AS revenue_cents,
  COUNT(DISTINCT CASE WHEN o.mrr_cents > 0 THEN o.user_id END) AS paying_users
FROM order_periods o JOIN cohort_base c ON o.user_id = c.user_id
GROUP BY 1, 2, 3""", ["cohort_base"]),
    "user_accounts": query("""
WITH e AS (
  SELECT user_id, MIN(event_ts) AS first_event_ts, MAX(event_ts) AS last_event_ts,
    COUNT(*) AS event_count, COUNT(DISTINCT event_source) AS source_count
  FROM event_log WHERE user_id > 0 GROUP BY user_id),
l AS (
  SELECT user_id, plan_id, plan_tier, is_active,
    ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY period_seq DESC) AS rn
  FROM periods)
SELECT e.user_id, e.first_event_ts, e.last_event_ts, e.event_count, e.source_count,
  l.plan_id AS current_plan_id, l.plan_tier AS current_plan_tier,
  l.is_active AS subscription_active
FROM e LEFT JOIN l ON e.user_id = l.user_id AND l.rn = 1""", ["event_log", "periods"]),
    "daily_signups": query(f"""
WITH f AS (
  SELECT user_id, MIN(CAST(period_start AS DATE)) AS d FROM staging
  WHERE transition_type = 'new' GROUP BY user_id),
c AS (SELECT d, COUNT(*) AS n FROM f GROUP BY d),
sp AS ({_SPINE})
SELECT sp.metric_date, COALESCE(c.n, 0) AS signups
FROM sp LEFT JOIN c ON sp.metric_date = c.d""", ["staging"]),
    "billing": job("billing_t"),
    "subscription_events": query(
        "SELECT * FROM staging WHERE transition_type <> 'renewal'", ["staging"]),
    "payment_history": query("""
SELECT user_id, invoice_id, invoice_date, payment_status, net_revenue_cents,
  ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY invoice_date, invoice_id) AS payment_number,
  CAST(SUM(COALESCE(net_revenue_cents, 0)) OVER (PARTITION BY user_id
       ORDER BY invoice_date, invoice_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
    AS running_net_revenue_cents,
  CAST(date_diff('day', LAG(invoice_date) OVER (PARTITION BY user_id
       ORDER BY invoice_date, invoice_id), invoice_date) AS INTEGER) AS days_since_prev_payment
FROM payment_billing_all""", ["payment_billing_all"]),
    "subscription_summary": job("summary_t"),
}


def _rule(table: str, rule: str, passed: str, detail: str, src: str) -> str:
    return (f"SELECT '{table}' AS \"table\", '{rule}' AS rule, {passed} AS passed, "
            f"{detail} AS detail FROM {src}")


def _n(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


_FRESH_CUT = "TIMESTAMP '2024-01-29 00:00:00'"


def _fresh(col: str) -> tuple[str, str]:
    return (f"COALESCE(MAX({col}) >= {_FRESH_CUT}, FALSE)",
            f"'latest=' || COALESCE(strftime(MAX({col}), '%Y-%m-%d %H:%M:%S'), 'NULL') "
            f"|| ', cutoff=2024-01-29 00:00:00'")


_DQ_REPORT = " UNION ALL ".join([
    _rule("subscription_periods", "not_empty", "COUNT(*) > 0",
          f"'row_count=' || {_n('COUNT(*)')}", "periods"),
    _rule("subscription_periods", "no_nulls", "COUNT(*) FILTER (WHERE user_id IS NULL) = 0",
          f"'null_count(user_id)=' || {_n('COUNT(*) FILTER (WHERE user_id IS NULL)')}",
          "periods"),
    _rule("subscription_periods", "unique", "COUNT(*) - COUNT(DISTINCT user_id) = 0",
          f"'duplicates(user_id)=' || {_n('COUNT(*) - COUNT(DISTINCT user_id)')}", "periods"),
    _rule("subscription_periods", "unique_key", "COUNT(*) = 0",
          f"'duplicate_keys(user_id,period_seq)=' || {_n('COUNT(*)')}",
          "(SELECT user_id, period_seq FROM periods GROUP BY 1, 2 HAVING COUNT(*) > 1) k"),
    _rule("subscription_periods", "expression",
          "COUNT(*) FILTER (WHERE period_start > period_end) = 0",
          "'violations(period_start > period_end)=' || "
          + _n("COUNT(*) FILTER (WHERE period_start > period_end)"), "periods"),
    _rule("subscription_periods", "freshness", *_fresh("period_start"), "periods"),
    _rule("subscription_periods", "row_count_range", "COUNT(*) >= 1",
          f"'row_count=' || {_n('COUNT(*)')} || ' expected=[1, inf]'", "periods"),
])

OPERATOR_ORACLE = {
    "union_sources": query("""
SELECT event_id, user_id, event_type, event_payload, epoch_ts, created_at,
  'user' AS event_source FROM user_events
UNION ALL
SELECT event_id, COALESCE(user_id, -1), event_type, event_payload, epoch_ts, created_at,
  'system' FROM system_events
UNION ALL
SELECT event_id, COALESCE(user_id, -1), event_type, event_payload, epoch_ts, created_at,
  'api' FROM api_events""", [], ("user_events", "system_events", "api_events")),
    "sequence_index": query("""
SELECT invoice_id, user_id, invoice_date,
  ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY invoice_date, invoice_id) AS idx,
  ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY invoice_date DESC, invoice_id DESC)
    AS idx_inverse,
  COUNT(*) OVER (PARTITION BY user_id) AS group_count
FROM invoices""", [], ("invoices",)),
    "transitions": query("""
WITH t AS (
  SELECT user_id, plan_id, period_start,
    ROW_NUMBER() OVER w AS seq, LAG(plan_id) OVER w AS prev_plan_id,
    LEAD(period_start) OVER w AS next_period_start
  FROM order_periods
  WINDOW w AS (PARTITION BY user_id ORDER BY period_start, plan_id, period_end, mrr_cents))
SELECT user_id, seq, plan_id, prev_plan_id, period_start, next_period_start,
  CASE WHEN seq = 1 THEN 'new' WHEN plan_id > prev_plan_id THEN 'upgrade'
       WHEN plan_id < prev_plan_id THEN 'downgrade' ELSE 'renewal' END AS transition_type
FROM t""", [], ("order_periods",)),
    "pivot_flags": query("""
SELECT plan_id,
  bool_or(feature_key = 'sso')::INTEGER AS has_sso, bool_or(feature_key = 'api_access')::INTEGER AS has_api_access,
  bool_or(feature_key = 'priority_support')::INTEGER AS has_priority_support
FROM plan_features GROUP BY plan_id""", [], ("plan_features",)),
    "pivot_max": query("""
SELECT plan_id,
  max(price_cents) FILTER (billing_interval = 'month') AS monthly_price_cents,
  max(price_cents) FILTER (billing_interval = 'year') AS annual_price_cents
FROM plan_pricing GROUP BY plan_id""", [], ("plan_pricing",)),
    "walk_chain": query("""
SELECT user_id, CAST(period_seq AS BIGINT) AS period_seq, plan_id, period_start, period_end
FROM chain""", ["chain"]),
    "session_buckets": query("""
SELECT user_id, event_date AS activity_date,
  COUNT(DISTINCT hour(event_ts) * 100 + floor(minute(event_ts) / 30)) AS session_count
FROM event_log GROUP BY 1, 2""", ["event_log"]),
    "first_last_by": query("""
WITH e AS (
  SELECT user_id, event_date,
    FIRST_VALUE(event_type) OVER w AS fv, LAST_VALUE(event_type) OVER w AS lv
  FROM event_log
  WINDOW w AS (PARTITION BY user_id, event_date ORDER BY event_ts, event_source, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT user_id, event_date AS activity_date, MIN(fv) AS first_event_type,
  MIN(lv) AS last_event_type
FROM e GROUP BY 1, 2""", ["event_log"]),
    "active_by_day": query("""
WITH days AS (
  SELECT unnest(generate_series(period_start::DATE::TIMESTAMP, period_end::DATE::TIMESTAMP, INTERVAL 1 DAY))::DATE AS metric_date,
         user_id, mrr_cents FROM order_periods)
SELECT metric_date, count(*) AS active_periods, count(DISTINCT user_id) AS active_users, sum(mrr_cents)::BIGINT AS mrr_cents
FROM days GROUP BY metric_date""", [], ("order_periods",)),
    "chain_links": job("walked_links"),
    "subscription_periods_incremental": job("periods"),
    "active_by_hour": job("hours"),
    "load_dictionaries": job("dictionary"),
    "load_sheet": query("SELECT " + ", ".join(
        f"TRY_CAST(nullif(trim({c}), '') AS {t}) AS {c}" for c, t in _SHEET_TYPES.items())
        + " FROM plan_sheet WHERE sheet_row NOT IN (SELECT sheet_row FROM sheet_cells WHERE wrong)", ["sheet_cells"]),
    "load_sheet_rejects": query('SELECT sheet_row AS "row", "column", value FROM sheet_cells WHERE wrong', ["sheet_cells"]),
    "categorize_incremental": query(f"""
WITH t AS (SELECT id, {_TERMS} AS terms FROM text_documents),
c AS (SELECT id, array_to_string(terms, ',') AS nouns, {_dict_cats('terms')} AS cats FROM t WHERE len(terms) > 0)
SELECT id, CASE WHEN cats = '' THEN 'uncategorized' ELSE cats END AS category, 'faq_article' AS category_type,
  sha256(nouns) AS nouns_sha256 FROM c""", [], ("text_documents",)),
    "point_in_period": query("""
SELECT a.user_id, a.activity_date, p.period_seq, p.plan_id
FROM user_activity a LEFT JOIN periods p ON a.user_id = p.user_id
  AND a.activity_date BETWEEN CAST(p.period_start AS DATE) AND CAST(p.period_end AS DATE)""",
                             ["user_activity", "periods"]),
    "dominant_category": query("""
WITH c AS (
  SELECT invoice_id, CASE WHEN item_type = 'subscription' THEN 'subscription'
    WHEN item_type = 'addon' THEN 'addon' WHEN item_type = 'credit' THEN 'refund'
    WHEN amount_cents < 0 THEN 'refund' ELSE 'other' END AS cat
  FROM invoice_line_items)
SELECT invoice_id,
  CASE WHEN bool_or(cat = 'subscription') THEN 'subscription'
       WHEN bool_or(cat = 'addon') THEN 'addon'
       WHEN bool_or(cat = 'refund') THEN 'refund' ELSE 'other' END AS invoice_category
FROM c GROUP BY invoice_id""", [], ("invoice_line_items",)),
    "running_total": query("""
SELECT invoice_id, invoice_date, total_cents,
  CAST(SUM(total_cents) OVER (ORDER BY invoice_date, invoice_id ROWS UNBOUNDED PRECEDING)
       AS BIGINT) AS running_total_cents
FROM payment_billing_all""", ["payment_billing_all"]),
    "dod_change_lag": query(f"""
WITH d AS (SELECT invoice_date AS metric_date, COUNT(*) AS invoices
           FROM payment_billing_all GROUP BY 1),
c AS (SELECT *, LAG(invoices) OVER (ORDER BY metric_date) AS prev FROM d)
SELECT metric_date, invoices, COALESCE(prev, 0) AS prev_invoices,
  CASE WHEN prev IS NULL OR prev = 0 THEN 0.0
       ELSE {_round2('CAST(invoices - prev AS DOUBLE) / prev * 100')} END AS dod_change_pct
FROM c""", ["payment_billing_all"]),
    "dod_change_lead": query(f"""
WITH d AS (SELECT invoice_date AS metric_date, COUNT(*) AS invoices
           FROM payment_billing_all GROUP BY 1),
c AS (SELECT *, LEAD(invoices) OVER (ORDER BY metric_date) AS next_invoices FROM d)
SELECT metric_date, invoices, next_invoices,
  CASE WHEN invoices = 0 THEN 0.0
       ELSE {_round2('CAST(next_invoices - invoices AS DOUBLE) / invoices * 100')} END
    AS dod_change_pct
FROM c""", ["payment_billing_all"]),
    "tier_users": query("""
SELECT CAST(date_trunc('month', o.period_start) AS DATE) AS metric_month,
  COUNT(DISTINCT CASE WHEN p.plan_tier = 'free' THEN o.user_id END) AS free_users,
  COUNT(DISTINCT CASE WHEN p.plan_tier = 'standard' THEN o.user_id END) AS standard_users,
  COUNT(DISTINCT CASE WHEN p.plan_tier = 'premium' THEN o.user_id END) AS premium_users,
  COUNT(DISTINCT CASE WHEN p.plan_tier = 'enterprise' THEN o.user_id END) AS enterprise_users
FROM order_periods o LEFT JOIN plans p ON o.plan_id = p.plan_id
GROUP BY 1""", [], ("order_periods", "plans")),
    "weekly_users_from_days": query("""
SELECT week_start, total_active_users, power_users, regular_active_users, low_activity_users
FROM active_users_weekly""", ["active_users_weekly"]),
    "tier_users_from_days": query("""
SELECT date_trunc('month', period_start)::DATE AS metric_month,
  count(DISTINCT user_id) FILTER (plan_tier = 'free') AS free_users,
  count(DISTINCT user_id) FILTER (plan_tier = 'standard') AS standard_users,
  count(DISTINCT user_id) FILTER (plan_tier = 'premium') AS premium_users,
  count(DISTINCT user_id) FILTER (plan_tier = 'enterprise') AS enterprise_users
FROM order_periods LEFT JOIN plans USING (plan_id) GROUP BY 1""", [], ("order_periods", "plans")),
    "merge_metrics": query("""
WITH a AS (SELECT invoice_date AS metric_date, COUNT(*) AS invoices
           FROM payment_billing_all GROUP BY 1),
b AS (SELECT CAST(period_start AS DATE) AS metric_date, COUNT(*) AS periods_started
      FROM order_periods GROUP BY 1)
SELECT COALESCE(a.metric_date, b.metric_date) AS metric_date,
  COALESCE(a.invoices, 0) AS invoices, COALESCE(b.periods_started, 0) AS periods_started
FROM a FULL OUTER JOIN b ON a.metric_date = b.metric_date""", ["payment_billing_all"],
                           ("order_periods",)),
    "replace_window": query("""
SELECT * FROM dec_0120 WHERE metric_date IS NULL OR metric_date < DATE '2024-01-21'
UNION ALL SELECT * FROM dec_0131_10""", ["dec_0120", "dec_0131_10"]),
    "dq_not_empty": query(_rule("subscription_summary", "not_empty", "COUNT(*) > 0",
                                f"'row_count=' || {_n('COUNT(*)')}", "summary_t"),
                          ["summary_t"]),
    "dq_row_count": query(_rule("daily_user_counts", "row_count_range",
                                "COUNT(*) BETWEEN 1 AND 500000",
                                f"'row_count=' || {_n('COUNT(*)')} || ' expected=[1, 500000]'",
                                "daily_user_counts"), ["daily_user_counts"]),
    "dq_no_nulls": query(_rule("billing", "no_nulls",
                               "COUNT(*) FILTER (WHERE billing_id IS NULL) = 0",
                               "'null_count(billing_id)=' || "
                               + _n("COUNT(*) FILTER (WHERE billing_id IS NULL)"),
                               "billing_t"), ["billing_t"]),
    "dq_unique": query(_rule("event_log", "unique", "COUNT(*) - COUNT(DISTINCT event_id) = 0",
                             f"'duplicates(event_id)=' || {_n('COUNT(*) - COUNT(DISTINCT event_id)')}",
                             "event_log"), ["event_log"]),
    "dq_freshness": query(_rule("daily_user_counts", "freshness", *_fresh("metric_date"),
                                "daily_user_counts"), ["daily_user_counts"]),
    "dq_period_order": query(_rule(
        "subscription_periods", "expression",
        "COUNT(*) FILTER (WHERE period_start > period_end) = 0",
        "'violations(period_start > period_end)=' || "
        + _n("COUNT(*) FILTER (WHERE period_start > period_end)"), "periods"), ["periods"]),
    "dq_unique_key": query(_rule(
        "subscription_periods", "unique_key", "COUNT(*) = 0",
        f"'duplicate_keys(user_id,period_seq)=' || {_n('COUNT(*)')}",
        "(SELECT user_id, period_seq FROM periods GROUP BY 1, 2 HAVING COUNT(*) > 1) k"),
        ["periods"]),
    "dq_report": query(_DQ_REPORT, ["periods"]),
}


ORACLE: dict[str, str] = {
    "event_log": job("event_log"),
    "subscription_staging": job("staging"),
    "daily_event_counts": job("daily_event_counts"),
    "plan_info": job("plan_info"),
    "subscription_periods": job("periods"),
    "user_activity": job("user_activity"),
    "active_users_weekly": job("active_users_weekly"),
    "payment_billing": job("payment_billing"),
    "daily_user_counts": job("daily_user_counts"),
    "daily_revenue_counts": job("daily_revenue_counts"),
    "daily_revenue_point_in_time": job("daily_revenue_pit"),
    "categorize_reviews": categorize("text_reviews", "product_review"),
    "categorize_tickets": categorize("text_tickets", "support_ticket"),
    "categorize_faq": categorize("text_faq", "faq_article"),
    "categorize_feedback": categorize("text_feedback", "user_feedback"),
    "extract_terms": query(f"""
WITH t AS (SELECT id, {_TERMS} AS terms FROM text_documents)
SELECT id, CAST(len(terms) AS BIGINT) AS n_terms, array_to_string(terms, ',') AS terms
FROM t WHERE len(terms) > 0""", [], extra_views=("text_documents",)),
    "match_categories": query(f"""
WITH t AS (SELECT id, {_TERMS} AS terms FROM text_turns),
c AS (SELECT id, {_dict_cats('terms')} AS cats FROM t WHERE len(terms) > 0)
SELECT id, CASE WHEN cats = '' THEN 'uncategorized' ELSE cats END AS category FROM c""", [],
        extra_views=("text_turns",)),
    **N_ORACLE,
    **OPERATOR_ORACLE,
}
