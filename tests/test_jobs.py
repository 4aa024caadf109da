"""Edge rows per job (hand-made), as listed in FIXTURES.md section 3."""

import datetime as dt


from tally.plans import bronze, gold, silver

T = dt.datetime
D = dt.date
EV = ("event_id long, user_id long, event_type string, event_payload string, epoch_ts long, "
      "created_at timestamp_ntz")
BILL = ("user_id long, reference_event_id long, plan_id long, amount_cents long, "
        "currency string, transaction_status string")
EPOCH_0131 = 1706659200  # 2024-01-31 00:00:00 UTC


def ev(df, rows):
    return df([(i, u, t, "{}", e, T(2024, 1, 1)) for i, u, t, e in rows], EV)


def empty_ev(df):
    return df([], EV)


def test_event_log_nulls_ties_and_bound(df):
    lo = EPOCH_0131 - 3 * 86400
    user = ev(df, [(1, None, "view", lo), (2, 7, "view", lo - 1), (3, 7, "view", lo + 5)])
    system = ev(df, [(4, None, "error", lo + 5), (5, 7, "error", lo + 5)])
    api = ev(df, [(6, None, "click", lo + 9), (7, 7, "click", lo + 5)])
    out = {r["event_id"]: r for r in bronze.event_log(user, system, api, "2024-01-31", 3).collect()}
    assert 2 not in out                     # one second before the bound
    assert out[1]["user_id"] is None        # user events keep NULL
    assert out[4]["user_id"] == -1 and out[6]["user_id"] == -1
    # user 7: three events tied at lo+5 -> order by source (api, system, user), then id
    assert [out[i]["idx"] for i in (7, 5, 3)] == [1, 2, 3]
    assert [out[i]["idx_inverse"] for i in (7, 5, 3)] == [3, 2, 1]
    assert {out[i]["user_event_count"] for i in (7, 5, 3)} == {3}
    assert out[4]["event_ts"] == T(2024, 1, 28, 0, 0, 5)
    assert out[4]["event_date"] == D(2024, 1, 28)


def _staging(df, events, bills):
    log = bronze.event_log(ev(df, events), empty_ev(df), empty_ev(df), "2024-01-31", None)
    return bronze.subscription_staging(log, df(bills, BILL), "2024-01-31 00:00:00")


def test_staging_transitions(df):
    e0 = EPOCH_0131 - 10 * 86400
    events = [(1, 1, "subscription_upgraded", e0), (2, 1, "subscription_created", e0 + 100),
              (3, 2, "subscription_created", e0), (4, 3, "subscription_created", e0),
              (5, 4, "subscription_created", e0)]
    bills = [(1, 1, 10, 500, "USD", "completed"), (1, 2, 11, 600, "USD", "completed"),
             (2, 3, 12, 700, "USD", "completed"),
             # user 4: two billing rows for one event; user 3's event has none
             (4, 5, 21, 100, "USD", "completed"), (4, 5, 20, 100, "USD", "completed")]
    rows = {(r["user_id"], r["event_seq"]): r for r in _staging(df, events, bills).collect()}
    assert rows[(1, 1)]["transition_type"] == "upgrade"      # first event not 'created'
    assert rows[(1, 2)]["transition_type"] == "other"        # second 'created'
    assert rows[(1, 2)]["prev_plan_id"] == 10
    assert rows[(1, 1)]["period_end"] == T(2024, 1, 21, 0, 1, 40)
    one = rows[(2, 1)]                                        # one event only
    assert one["transition_type"] == "new" and one["is_open"]
    assert one["period_end"] == T(2024, 1, 31) and one["period_days"] == 10
    assert not any(k[0] == 3 for k in rows)                   # event without billing
    assert [rows[(4, s)]["plan_id"] for s in (1, 2)] == [20, 21]


PLANS = ("plan_id long, plan_name string, plan_tier string, is_active boolean, max_seats int, "
         "deleted_at timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz")
FEAT = "plan_id long, feature_key string"
PRICE = ("plan_id long, billing_interval string, price_cents long, currency string, "
         "trial_days int, effective_end timestamp_ntz")


def _plan_info(df):
    plans = df([(1, "a", None, None, None, None, T(2023, 1, 1), T(2023, 6, 1)),
                (2, "b", "free", False, 3, None, T(2023, 1, 1), T(2023, 6, 1)),
                (3, "c", "premium", True, 5, T(2023, 12, 1), T(2023, 1, 1), T(2023, 6, 1)),
                (4, "d", "premium", True, 5, None, T(2023, 1, 1), T(2023, 6, 1))], PLANS)
    feats = df([(2, "sso"), (2, "api_access"), (4, "priority_support")], FEAT)
    prices = df([(2, "month", 100, "EUR", 14, None), (2, "year", 1000, None, None, None),
                 (4, "month", 900, "USD", None, T(2023, 7, 1))], PRICE)
    return silver.plan_info(plans, feats, prices)


def test_plan_info_defaults(df):
    rows = {r["plan_id"]: r for r in _plan_info(df).collect()}
    assert set(rows) == {1, 2, 4}                             # deleted plan 3 dropped
    a = rows[1]                                               # nothing but the name
    assert (a["plan_tier"], a["is_active"], a["max_seats"]) == ("standard", True, 1)
    assert (a["has_sso"], a["monthly_price_cents"], a["currency"], a["trial_days"]) == \
        (0, 0, "USD", 0)
    b = rows[2]
    assert (b["has_sso"], b["has_api_access"], b["has_priority_support"]) == (1, 1, 0)
    assert (b["monthly_price_cents"], b["annual_price_cents"], b["trial_days"]) == (100, 1000, 14)
    assert rows[4]["monthly_price_cents"] == 0                # expired price only


def test_subscription_periods_anchor_trial(df):
    e_recent = EPOCH_0131 - 20 * 86400
    e_old = EPOCH_0131 - 91 * 86400
    events = [(1000 + i, 1, "subscription_created" if i == 0 else "subscription_renewed",
               e_recent + i * 60) for i in range(60)]
    events += [(2000, 2, "subscription_created", e_old), (2001, 2, "subscription_renewed",
                                                          e_recent)]
    events += [(3000, 3, "subscription_created", EPOCH_0131 - 14 * 86400)]
    events += [(4000, 4, "subscription_created", e_recent)]
    events += [(5000, 5, "subscription_created", e_recent)]
    bills = [(1, 1000 + i, 4, 100, "USD", "completed") for i in range(60)]
    bills += [(2, 2000, 4, 1, "USD", "completed"), (2, 2001, 4, 1, "USD", "completed")]
    bills += [(3, 3000, 2, 250, "USD", "completed"), (4, 4000, 99, 300, "USD", "completed")]
    bills += [(5, 5000, 4, 250, "EUR", "completed")]
    staging = _staging(df, events, bills)
    per = silver.subscription_periods(staging, _plan_info(df), "2024-01-31").collect()
    by_user = {}
    for r in per:
        by_user.setdefault(r["user_id"], []).append(r)
    assert len(by_user[1]) == 60                              # every period
    assert 2 not in by_user                                   # first event 91 days old
    u3 = by_user[3][0]                                        # free plan, trial at limit
    assert u3["mrr_cents"] == 0 and u3["period_days"] == 14 and u3["is_trial"]
    assert u3["is_active"]                                    # open and not churned
    u4 = by_user[4][0]                                        # unknown plan
    assert u4["plan_name"] is None and u4["mrr_cents"] == 300 and not u4["is_trial"]
    assert by_user[5][0]["mrr_cents"] == 250                  # EUR: placeholder rate 1
    last = max(by_user[1], key=lambda r: r["period_seq"])
    assert last["cumulative_revenue_cents"] == 6000 and last["period_seq"] == 60


def test_subscription_periods_tied_times_no_fanout(df):
    e = EPOCH_0131 - 5 * 86400
    events = [(1, 1, "subscription_created", e), (2, 1, "subscription_renewed", e),
              (3, 1, "subscription_renewed", e)]
    bills = [(1, i, 2, 10, "USD", "completed") for i in (1, 2, 3)]
    staging = _staging(df, events, bills)
    per = silver.subscription_periods(staging, _plan_info(df), "2024-01-31").collect()
    assert sorted(r["period_seq"] for r in per) == [1, 2, 3]


def _log(df, rows):
    """event_log rows: (user, ts, type, source, id)."""
    return df([(i, u, t, "{}", s, ts, ts.date(), ts, 0, 0, 0) for u, ts, t, s, i in rows],
              "event_id long, user_id long, event_type string, event_payload string, "
              "event_source string, event_ts timestamp_ntz, event_date date, "
              "source_created_at timestamp_ntz, idx long, idx_inverse long, "
              "user_event_count long")


def test_user_activity_classes_buckets_midnight(df):
    base = T(2024, 1, 29, 10, 0)
    rows = [(1, base + dt.timedelta(minutes=i), "view", "user", 100 + i) for i in range(10)]
    rows += [(2, base + dt.timedelta(minutes=i), "view", "user", 200 + i) for i in range(9)]
    rows += [(3, base + dt.timedelta(minutes=i), "view", "user", 300 + i) for i in range(3)]
    rows += [(4, T(2024, 1, 29, 10, 29), "a", "user", 400), (4, T(2024, 1, 29, 10, 30), "b",
                                                                   "user", 401)]
    rows += [(5, T(2024, 1, 29, 23, 59, 59), "x", "api", 500),
             (5, T(2024, 1, 30, 0, 0, 1), "y", "api", 501), (-1, base, "e", "system", 600)]
    out = {(r["user_id"], r["activity_date"]): r for r in
           silver.user_activity(_log(df, rows), "2024-01-31", 7).collect()}
    assert out[(1, D(2024, 1, 29))]["activity_status"] == "power_user"
    assert out[(2, D(2024, 1, 29))]["activity_status"] == "active"
    assert out[(3, D(2024, 1, 29))]["activity_status"] == "active"
    u4 = out[(4, D(2024, 1, 29))]
    assert u4["activity_status"] == "low_activity" and u4["session_count"] == 2
    assert (u4["first_event_type"], u4["last_event_type"], u4["active_seconds"]) == ("a", "b", 60)
    assert (5, D(2024, 1, 29)) in out and (5, D(2024, 1, 30)) in out   # midnight crossing
    assert not any(k[0] == -1 for k in out)


def test_weekly_sunday_monday_and_two_classes(df):
    ua = df([(1, D(2024, 1, 21), 1, 2, "low_activity"),     # Sunday
             (1, D(2024, 1, 22), 1, 5, "active"),           # Monday
             (1, D(2024, 1, 23), 2, 1, "low_activity")],
            "user_id long, activity_date date, session_count long, total_events long, "
            "activity_status string")
    rows = {r["week_start"]: r for r in silver.active_users_weekly(ua, "2024-01-31").collect()}
    assert set(rows) == {D(2024, 1, 15), D(2024, 1, 22)}
    w = rows[D(2024, 1, 22)]
    assert (w["total_active_users"], w["regular_active_users"], w["low_activity_users"]) == (1, 1, 1)
    assert w["week_end"] == D(2024, 1, 28)
    assert w["avg_sessions_per_user"] == 1.5                 # (1 + 2) / 2 class rows


INV = ("invoice_id long, user_id long, invoice_date timestamp_ntz, tax_cents long, "
       "currency string, status string, paid_at timestamp_ntz, refunded_at timestamp_ntz, "
       "payment_method_id int")
ITEMS = "invoice_id long, line_item_id int, amount_cents long, quantity long, item_type string"


def test_payment_billing_categories(df):
    d = T(2024, 1, 20)
    inv = df([(1, 1, d, None, None, "completed", d, None, 1),
              (2, 1, d, 5, "USD", "refunded", d, d, 9),
              (3, 2, d, 0, "USD", "failed", None, None, 1),
              (4, 2, d, 0, "USD", "completed", d, None, 1),
              (5, 3, d, 0, "USD", "completed", d, None, 1),
              (6, 3, T(2023, 1, 1), 0, "USD", "completed", d, None, 1)], INV)
    items = df([(1, 1, 100, 2, "misc"), (1, 2, 50, 1, "addon"), (1, 3, -10, 1, "subscription"),
                (2, 1, 100, 1, "misc"),
                (3, 1, 10, 1, "credit"), (3, 2, -5, 1, "misc"),
                (5, 1, 7, 1, "misc"), (6, 1, 1, 1, "subscription")], ITEMS)
    pm = df([(1, "card")], "payment_method_id int, method_type string")
    out = {r["invoice_id"]: r for r in
           silver.payment_billing(inv, items, pm, "2024-01-31", 30).collect()}
    assert set(out) == {1, 2, 3, 5}                          # 4: no items; 6: too old
    one = out[1]
    assert one["invoice_category"] == "subscription"         # negative subscription line
    assert (one["line_item_count"], one["subtotal_cents"]) == (3, 240)
    assert (one["tax_cents"], one["total_cents"], one["currency"]) == (0, 240, "USD")
    assert one["net_revenue_cents"] == 240
    assert out[2]["invoice_category"] == "other" and out[2]["net_revenue_cents"] == 0
    assert out[2]["payment_method_type"] == "unknown"
    assert out[3]["invoice_category"] == "refund" and out[3]["net_revenue_cents"] is None
    assert out[5]["invoice_category"] == "other"


def test_payment_billing_plan_prunes_line_items(df):
    inv = df([], INV)
    items = df([], ITEMS)
    pm = df([], "payment_method_id int, method_type string")
    plan = silver.payment_billing(inv, items, pm, "2024-01-31", 30)._jdf.queryExecution() \
        .optimizedPlan().toString()
    assert "LeftSemi" in plan


def test_daily_event_counts_one_day_and_gap(df):
    rows = [(1, T(2024, 1, 10, 1), "v", "user", 1), (-1, T(2024, 1, 10, 2), "e", "system", 2),
            (2, T(2024, 1, 12, 1), "v", "api", 3), (0, T(2024, 1, 12, 2), "v", "user", 4),
            (2, T(2024, 1, 12, 3), "v", "user", 5), (3, T(2024, 1, 12, 3), "v", "user", 6)]
    out = {r["metric_date"]: r for r in
           gold.daily_event_counts(_log(df, rows), "2024-01-31").collect()}
    first, second = out[D(2024, 1, 10)], out[D(2024, 1, 12)]
    assert (first["prev_day_total_events"], first["dod_change_pct"]) == (0, 0.0)
    assert first["unique_users"] == 1                         # -1 excluded
    assert (second["prev_day_total_events"], second["dod_change_pct"]) == (2, 100.0)
    assert second["unique_users"] == 2                        # user 0 excluded
    assert (second["user_events"], second["api_events"]) == (3, 1)


PER = ("user_id long, period_seq long, plan_id long, plan_name string, plan_tier string, "
       "period_start timestamp_ntz, period_end timestamp_ntz, period_days int, "
       "transition_type string, prev_plan_tier string, mrr_cents long, is_trial boolean, "
       "is_active boolean, cumulative_revenue_cents long")


def _per(df, rows):
    return df([(u, s, 1, "p", tier, a, b, (b.date() - a.date()).days, tt, None, m, False, act, m)
               for u, s, tier, a, b, tt, m, act in rows], PER)


def test_daily_user_counts_edges(df):
    act = df([(1, D(2024, 1, 10)), (1, D(2024, 1, 12)), (2, D(2024, 1, 12)),
              (3, D(2024, 1, 12))], "user_id long, activity_date date")
    per = _per(df, [(1, 1, "standard", T(2024, 1, 10, 5), T(2024, 1, 12, 3), "new", 1, False),
                    (1, 2, "standard", T(2024, 1, 12, 3), T(2024, 1, 31), "churn", 1, False),
                    (2, 1, "standard", T(2024, 1, 12, 8), T(2024, 1, 31), "new", 1, True)])
    out = {r["metric_date"]: r for r in
           gold.daily_user_counts(act, per, "2024-01-31").collect()}
    d10, d12 = out[D(2024, 1, 10)], out[D(2024, 1, 12)]
    assert (d10["new_users"], d10["returning_users"], d10["total_active_users"]) == (1, 0, 1)
    # day 12: user 1 ends period 1 and starts period 2 (returning); user 2 new; user 3 none
    assert (d12["new_users"], d12["returning_users"], d12["total_active_users"]) == (1, 1, 3)
    assert d12["cumulative_users"] == 2
    assert d10["next_day_active_users"] == 3 and d10["dod_change_pct"] == 200.0
    assert d12["next_day_active_users"] is None and d12["dod_change_pct"] is None


def test_daily_revenue_edges_and_plan(df):
    per = _per(df, [(1, 1, "premium", T(2023, 6, 1), T(2024, 1, 31), "new", 300, True),
                    (2, 1, None, T(2024, 1, 20), T(2024, 1, 31), "new", 50, True),
                    (3, 1, "free", T(2024, 1, 25), T(2024, 1, 31), "churn", 0, False)])
    bill = df([(D(2024, 1, 5), "subscription", 1000, "completed", 1000),
               (D(2024, 1, 5), "refund", -200, "refunded", 0),
               (D(2024, 1, 6), "addon", 10, "pending", None)],
              "invoice_date date, invoice_category string, total_cents long, "
              "payment_status string, net_revenue_cents long")
    res = gold.daily_revenue_counts(bill, per, "2024-01-31")
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan
    out = {r["metric_date"]: r for r in res.collect()}
    assert len(out) == 31                                     # the period spans the window
    d5 = out[D(2024, 1, 5)]
    assert (d5["total_revenue_cents"], d5["refund_cents"], d5["net_revenue_cents"]) == \
        (800, 200, 1000)
    assert (d5["mrr_cents"], d5["paying_users"], d5["arpu_cents"]) == (300, 1, 300.0)
    d25 = out[D(2024, 1, 25)]                                 # NULL tier: not paying
    assert (d25["mrr_cents"], d25["paying_users"], d25["premium_tier_users"]) == (350, 1, 1)
    assert d25["arr_cents"] == 350 * 12 and d25["total_revenue_cents"] == 0
    pit = {r["metric_date"]: r for r in
           gold.daily_revenue_counts(bill, per, "2024-01-31", point_in_time=True).collect()}
    assert pit[D(2024, 1, 25)]["free_tier_users"] == 0        # churn period excluded
