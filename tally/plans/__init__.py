"""Table jobs. Each takes DataFrames and parameters and returns a DataFrame.

Data dependency order: event_log -> {subscription_staging, user_activity,
daily_event_counts}; plan_info; {staging, plan_info} -> subscription_periods;
user_activity -> active_users_weekly; payment_billing;
{user_activity, periods} -> daily_user_counts; {payment_billing, periods} ->
daily_revenue_counts; periods -> cohorts; text and quality are independent.
"""
