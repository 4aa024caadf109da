"""Edge rows for the derived jobs (N1-N13) and the smaller operators."""

import datetime as dt

from pyspark.sql import functions as F

from tally.operators.category import dominant_category
from tally.operators.counting import count_distinct_by
from tally.operators.periods import explode_days, join_containing, merge_metrics
from tally.operators.pivot import pivot_flags, pivot_max
from tally.operators.transitions import transitions
from tally.operators.union import union_sources
from tally.plans import derived

T = dt.datetime
D = dt.date
STG = ("user_id long, plan_id long, prev_plan_id long, period_start timestamp_ntz, "
       "period_end timestamp_ntz, transition_type string, amount_cents long, currency string, "
       "transaction_status string, event_seq long, period_days int, is_open boolean")


def _stg(df, rows):
    return df([(u, p, None, a, b, tt, 10, "USD", "completed", s, (b.date() - a.date()).days,
                o) for u, s, p, a, b, tt, o in rows], STG)


def test_billing_events_month(df):
    log = df([(1, 5, T(2024, 1, 3), D(2024, 1, 3), "subscription_created"),
              (2, 5, T(2024, 2, 1), D(2024, 2, 1), "subscription_renewed"),
              (3, 6, T(2024, 1, 9), D(2024, 1, 9), "view")],
             "event_id long, user_id long, event_ts timestamp_ntz, event_date date, "
             "event_type string")
    bill = df([(5, 1, 7, 100, "USD", "completed"), (5, 2, 7, 100, "USD", "completed"),
               (9, 3, 7, 1, "USD", "completed")],
              "user_id long, reference_event_id long, plan_id long, amount_cents long, "
              "currency string, transaction_status string")
    out = derived.billing_events(log, bill, "2024-01-31").collect()
    assert [(r["user_id"], r["event_id"]) for r in out] == [(5, 1)]


def test_period_calc_and_events_and_signups(df):
    s = _stg(df, [(1, 1, 1, T(2024, 1, 2), T(2024, 1, 5), "new", False),
                  (1, 2, 1, T(2024, 1, 5), T(2024, 1, 9), "renewal", False),
                  (1, 3, 2, T(2024, 1, 9), T(2024, 1, 31), "churn", True),
                  (2, 1, 1, T(2024, 1, 20), T(2024, 1, 31), "new", True)])
    pc = {(r["user_id"], r["event_seq"]): r["is_churned"] for r in
          derived.period_calc(s).collect()}
    assert pc == {(1, 1): False, (1, 2): True, (1, 3): True, (2, 1): False}
    ev = derived.subscription_events(s).collect()
    assert sorted(r["transition_type"] for r in ev) == ["churn", "new", "new"]
    sign = {r["metric_date"]: r["signups"] for r in
            derived.daily_signups(s, "2024-01-31", 30).collect()}
    assert len(sign) == 31 and sum(sign.values()) == 2
    assert sign[D(2024, 1, 2)] == 1 and sign[D(2024, 1, 3)] == 0


PER = ("user_id long, period_seq long, plan_id long, plan_tier string, "
       "period_start timestamp_ntz, transition_type string, mrr_cents long, is_active boolean")


def test_accounts_and_summary(df):
    per = df([(1, 1, 3, "free", T(2024, 1, 2), "new", 0, False),
              (1, 2, 4, "premium", T(2024, 1, 5), "upgrade", 900, True)], PER)
    log = df([(1, "user", T(2024, 1, 3)), (1, "api", T(2024, 1, 4)), (2, "user", T(2024, 1, 5)),
              (-1, "system", T(2024, 1, 5))], "user_id long, event_source string, "
                                              "event_ts timestamp_ntz")
    acc = {r["user_id"]: r for r in derived.user_accounts(log, per).collect()}
    assert set(acc) == {1, 2}
    assert (acc[1]["source_count"], acc[1]["current_plan_id"], acc[1]["subscription_active"]) == \
        (2, 4, True)
    assert acc[2]["current_plan_id"] is None and acc[2]["event_count"] == 1
    summ = derived.subscription_summary(per).collect()[0]
    assert (summ["period_count"], summ["latest_plan_tier"], summ["lifetime_revenue_cents"]) == \
        (2, "premium", 900)


def test_billing_and_payment_history(df):
    pb = df([(10, 1, D(2024, 1, 5), "completed", 100), (9, 1, D(2024, 1, 5), "pending", None),
             (11, 1, D(2024, 1, 9), "refunded", 0), (12, 2, D(2024, 1, 1), "completed", 5)],
            "invoice_id long, user_id long, invoice_date date, payment_status string, "
            "net_revenue_cents long")
    bl = {r["billing_id"]: r["is_paid"] for r in derived.billing(pb).collect()}
    assert bl == {10: True, 9: False, 11: False, 12: True}
    h = {r["invoice_id"]: r for r in derived.payment_history(pb).collect()}
    assert [h[i]["payment_number"] for i in (9, 10, 11)] == [1, 2, 3]   # date, then id
    assert [h[i]["running_net_revenue_cents"] for i in (9, 10, 11)] == [0, 100, 100]
    assert [h[i]["days_since_prev_payment"] for i in (9, 10, 11)] == [None, 0, 4]


def test_union_and_transitions(df):
    a = df([(1, None)], "id long, user_id long")
    b = df([(2, None), (3, 7)], "id long, user_id long")
    u = {r["id"]: r for r in union_sources({"user": a, "api": b}, "src",
                                           null_key=("user_id", -1),
                                           except_tags=("user",)).collect()}
    assert (u[1]["user_id"], u[2]["user_id"], u[3]["user_id"], u[2]["src"]) == (None, -1, 7, "api")
    per = df([(1, 5, T(2024, 1, 1)), (1, 9, T(2024, 2, 1)), (1, 2, T(2024, 3, 1)),
              (1, 2, T(2024, 4, 1))], "user_id long, plan_id long, period_start timestamp_ntz")
    rules = [(F.col("plan_id") > F.col("prev_plan_id"), "upgrade"),
             (F.col("plan_id") < F.col("prev_plan_id"), "downgrade")]
    t = transitions(per, ["user_id"], ["period_start"], value="plan_id", time="period_start",
                    rules=rules, default="renewal")
    got = [(r["seq"], r["transition_type"], r["next_period_start"]) for r in
           t.orderBy("seq").collect()]
    assert got == [(1, "new", T(2024, 2, 1)), (2, "upgrade", T(2024, 3, 1)),
                   (3, "downgrade", T(2024, 4, 1)), (4, "renewal", None)]


def test_pivots_category_counts_merge(df):
    f = df([(1, "sso"), (1, "sso"), (2, "other")], "plan_id long, feature_key string")
    flags = {r["plan_id"]: (r["has_sso"], r["has_x"]) for r in
             pivot_flags(f, "plan_id", "feature_key", {"sso": "has_sso", "x": "has_x"}).collect()}
    assert flags == {1: (1, 0), 2: (0, 0)}
    pr = df([(1, "month", 5), (1, "month", 7)], "plan_id long, iv string, p long")
    mx = pivot_max(pr, "plan_id", "iv", "p", {"month": "m", "year": "y"}).collect()[0]
    assert (mx["m"], mx["y"]) == (7, None)
    li = df([(1, "refund"), (1, "addon"), (2, "zzz")], "i long, c string")
    dom = {r["i"]: r["d"] for r in li.groupBy("i").agg(
        dominant_category("c", ["subscription", "addon", "refund"], "other").alias("d")).collect()}
    assert dom == {1: "addon", 2: "other"}
    cl = df([(1, 1, "a"), (1, 1, "b"), (1, 2, "a"), (2, 3, None)], "k long, u long, c string")
    cnt = {r["k"]: (r["na"], r["nb"], r["all"]) for r in
           count_distinct_by(cl, ["k"], "u", "c", {"a": "na", "b": "nb"}, any_name="all").collect()}
    assert cnt == {1: (2, 1, 2), 2: (0, 0, 1)}
    m = merge_metrics(df([(1, 5)], "d long, x long"), df([(2, 6)], "d long, y long"), "d")
    assert sorted(map(tuple, m.collect())) == [(1, 5, 0), (2, 0, 6)]


def test_explode_days_and_containing_join(df):
    per = df([(1, T(2023, 12, 25), T(2024, 1, 2, 5)), (2, T(2024, 2, 1), T(2024, 2, 3)),
              (3, T(2024, 1, 31, 23), T(2024, 3, 1))], "user_id long, s timestamp_ntz, "
                                                      "e timestamp_ntz")
    days = explode_days(per, "s", "e", "2024-01-01", "2024-01-31").collect()
    assert sorted((r["user_id"], r["metric_date"]) for r in days) == \
        [(1, D(2024, 1, 1)), (1, D(2024, 1, 2)), (3, D(2024, 1, 31))]
    act = df([(1, D(2023, 12, 25)), (1, D(2024, 1, 2)), (1, D(2024, 1, 3))],
             "user_id long, day date")
    j = join_containing(act, "day", per, "s", "e", "user_id").collect()
    assert sorted((r["day"], r["s"] is not None) for r in j) == \
        [(D(2023, 12, 25), True), (D(2024, 1, 2), True), (D(2024, 1, 3), False)]
