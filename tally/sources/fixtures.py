"""Raw source views over the driver's parquet test tables.

The jobs read a billing / event warehouse (``user_events``, ``invoices``, ...).
The test data is a TPC-H-like star schema plus an ``events`` table; each raw
table below is a view over it. The same SQL text is rendered for Spark (the
parquet tables are passed as DataFrame arguments of ``spark.sql``) and for
DuckDB (plain table names), so the oracle and the Spark job read identical
input. Only the epoch conversion and the timestamp literal keyword differ.

Order dates are shifted by 8,217 days so that invoices (2017-07 .. 2024-01)
overlap the January 2024 events.
"""

from __future__ import annotations

from string import Template

from pyspark.sql import DataFrame, SparkSession

from tally.session import utc_session

# Base parquet tables read by the views.
BASE_TABLES = ("events", "orders", "lineitem", "part", "region", "documents",
               "conversations")

_DIALECT = {
    "spark": {
        "ep": "unix_timestamp(CAST(ts AS TIMESTAMP))",
        "ts": "TIMESTAMP_NTZ",
        "text": "STRING", "lb": "{{", "rb": "}}",
        "agg1": "listagg(entry, ', ') WITHIN GROUP (ORDER BY category DESC)",
        "agg2": "listagg('\"w' || CAST(p_partkey AS STRING) || '\"', ', ') WITHIN GROUP (ORDER BY p_partkey)",
    },
    "duckdb": {
        "ep": "CAST(floor(epoch(ts)) AS BIGINT)",
        "ts": "TIMESTAMP",
        "text": "VARCHAR", "lb": "{", "rb": "}",
        "agg1": "string_agg(entry, ', ' ORDER BY category DESC)",
        "agg2": "string_agg('\"w' || CAST(p_partkey AS VARCHAR) || '\"', ', ' ORDER BY p_partkey)",
    },
}

_SHIFT = "(o_orderdate + INTERVAL 8217 DAYS)"

# view name -> (SQL template, base tables it reads)
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "user_events": ("""
SELECT event_id, user_id,
  CASE WHEN event_type = 'signup' THEN 'subscription_created'
       WHEN event_type = 'purchase' THEN CASE event_id % 4
            WHEN 0 THEN 'subscription_upgraded' WHEN 1 THEN 'subscription_downgraded'
            WHEN 2 THEN 'subscription_renewed' ELSE 'subscription_cancelled' END
       ELSE event_type END AS event_type,
  props AS event_payload, $ep AS epoch_ts, ts AS created_at
FROM $events WHERE event_type IN ('signup', 'purchase', 'view')""", ("events",)),
    "system_events": ("""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END AS user_id,
  event_type, props AS event_payload, $ep AS epoch_ts, ts AS created_at
FROM $events WHERE event_type = 'error'""", ("events",)),
    "api_events": ("""
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id END AS user_id,
  event_type, props AS event_payload, $ep AS epoch_ts, ts AS created_at
FROM $events WHERE event_type = 'click'""", ("events",)),
    "billing_transactions": ("""
SELECT user_id, event_id AS reference_event_id, event_id % (SELECT count(*) FROM $part) AS plan_id,
  CAST(round(value * 100) AS BIGINT) AS amount_cents,
  CASE WHEN event_id % 3 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
  'completed' AS transaction_status
FROM $events WHERE event_type IN ('signup', 'purchase')""", ("events", "part")),
    "plans": ("""
SELECT p_partkey AS plan_id, p_name AS plan_name,
  CASE p_type WHEN 'ECONOMY' THEN 'free' WHEN 'STANDARD' THEN 'standard'
       WHEN 'PROMO' THEN 'premium' WHEN 'LARGE' THEN 'enterprise' END AS plan_tier,
  CASE WHEN p_size > 10 THEN p_size % 2 = 0 END AS is_active,
  CASE WHEN p_size > 5 THEN p_size END AS max_seats,
  CASE WHEN p_partkey % 17 = 3 THEN $ts '2023-12-01 00:00:00' END AS deleted_at,
  $ts '2023-01-01 00:00:00' AS created_at,
  $ts '2023-06-01 00:00:00' AS updated_at
FROM $part""", ("part",)),
    "plan_features": ("""
SELECT p_partkey AS plan_id, 'sso' AS feature_key FROM $part WHERE p_size % 2 = 0
UNION ALL SELECT p_partkey, 'api_access' FROM $part WHERE p_size % 3 = 0
UNION ALL SELECT p_partkey, 'priority_support' FROM $part WHERE p_size % 5 = 0""",
                      ("part",)),
    "plan_pricing": ("""
SELECT p_partkey AS plan_id, 'month' AS billing_interval,
  CAST(round(p_retailprice * 100) AS BIGINT) AS price_cents, 'USD' AS currency,
  CASE WHEN p_size % 2 = 0 THEN 14 END AS trial_days,
  CASE WHEN p_partkey % 7 = 0 THEN $ts '2023-07-01 00:00:00' END AS effective_end
FROM $part WHERE p_size > 3
UNION ALL SELECT p_partkey, 'year', CAST(round(p_retailprice * 1000) AS BIGINT), 'USD', NULL, NULL
FROM $part WHERE p_size > 8""", ("part",)),
    "invoices": ("""
SELECT o_orderkey AS invoice_id, o_custkey AS user_id, $shift AS invoice_date,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(round(o_totalprice) AS BIGINT) END AS tax_cents,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE 'USD' END AS currency,
  CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'refunded' ELSE 'pending' END AS status,
  $shift AS paid_at, CASE WHEN o_orderstatus = 'P' THEN $shift END AS refunded_at,
  CAST(substr(o_orderpriority, 1, 1) AS INT) AS payment_method_id
FROM $orders""", ("orders",)),
    "invoice_line_items": ("""
SELECT l_orderkey AS invoice_id, l_linenumber AS line_item_id,
  CASE WHEN l_returnflag = 'R' AND l_linenumber % 2 = 0 THEN -1 ELSE 1 END
    * CAST(round(l_extendedprice * 100) AS BIGINT) AS amount_cents,
  CAST(l_quantity AS BIGINT) AS quantity,
  CASE WHEN l_returnflag = 'N' THEN 'subscription' WHEN l_returnflag = 'A' THEN 'addon'
       WHEN l_linenumber % 3 = 0 THEN 'credit' ELSE 'misc' END AS item_type
FROM $lineitem""", ("lineitem",)),
    "payment_methods": ("""
SELECT r_regionkey AS payment_method_id, lower(r_name) AS method_type FROM $region""",
                        ("region",)),
    "order_periods": ("""
SELECT o_custkey AS user_id, (o_custkey * 7 + o_orderkey % 3) % (SELECT count(*) FROM $part) AS plan_id, o_orderdate AS period_start,
  o_orderdate + INTERVAL 30 DAYS AS period_end, CAST(round(o_totalprice) AS BIGINT) AS mrr_cents
FROM $orders""", ("orders", "part")),
    # whole months, so that a user's periods miss, meet, branch and have no length at all
    "order_links": ("""
SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderpriority = '1-URGENT' AS is_first,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS period_start,
  CAST(CASE o_orderkey % 4 WHEN 0 THEN date_trunc('month', o_orderdate)
       WHEN 1 THEN date_trunc('month', o_orderdate) + INTERVAL 2 MONTH
       ELSE date_trunc('month', o_orderdate) + INTERVAL 1 MONTH END AS DATE) AS period_end
FROM $orders""", ("orders",)),
    # one JSON object per hundred parts, of the form that dictionary files have; types recur in other files
    "dictionary_files": ("""
SELECT file_no, '$lb' || $agg1 || '$rb' AS value FROM (
  SELECT file_no, category, '"' || category || '": [' || $agg2 || ']' AS entry FROM (
    SELECT CAST(floor(p_partkey / 100) AS BIGINT) AS file_no, p_partkey,
      lower(p_type) || '-' || CAST(p_size % 20 AS $text) AS category FROM $part) AS p
  GROUP BY file_no, category) AS e
GROUP BY file_no""", ("part",)),
    # every cell a string, some of them not of the column's type
    "plan_sheet": ("""
SELECT p_partkey AS sheet_row, CASE WHEN p_partkey % 101 = 7 THEN 'P-' || CAST(p_partkey AS $text) ELSE ' ' || CAST(p_partkey AS $text) END AS plan_id,
  CASE WHEN p_partkey % 13 = 0 THEN '  ' ELSE p_name END AS plan_name,
  CASE WHEN p_partkey % 17 = 0 THEN 'many' WHEN p_partkey % 19 = 0 THEN '' ELSE CAST(p_size AS $text) END AS max_seats,
  CASE WHEN p_partkey % 23 = 0 THEN 'n/a' ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS $text) END AS monthly_price,
  CASE p_partkey % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END AS is_active,
  CASE WHEN p_partkey % 29 = 0 THEN '2024-13-01' ELSE '2024-01-' || substr('0' || CAST(p_partkey % 28 + 1 AS $text), -2) END AS valid_from
FROM $part""", ("part",)),
    "text_documents": ("SELECT doc_id AS id, text AS title FROM $documents", ("documents",)),
    "text_turns": ("SELECT conv_id * 1000 + turn AS id, text AS title FROM $conversations", ("conversations",)),
    "text_reviews": ("""
SELECT doc_id AS id, text AS title FROM $documents WHERE lang IN ('en', 'fr')""", ("documents",)),
    "text_faq": ("""
SELECT doc_id AS id, text AS title FROM $documents WHERE lang IS NULL OR lang NOT IN ('en', 'fr')""", ("documents",)),
    "text_tickets": ("""
SELECT conv_id * 1000 + turn AS id, text AS title FROM $conversations WHERE role = 'user'""",
                     ("conversations",)),
    "text_feedback": ("""
SELECT conv_id * 1000 + turn AS id, text AS title FROM $conversations WHERE role IS NULL OR role <> 'user'""",
                      ("conversations",)),
}


def render(view: str, dialect: str) -> str:
    """SQL text of one raw view for ``spark`` or ``duckdb``."""
    text, tables = VIEWS[view]
    subst = dict(_DIALECT[dialect], shift=_SHIFT)
    for t in tables:
        subst[t] = "{%s}" % t if dialect == "spark" else t
    return Template(text).substitute(subst).strip()


def duckdb_ctes(views: list[str] | tuple[str, ...]) -> str:
    """``name AS (...)`` fragments for a DuckDB ``WITH`` clause."""
    return ",\n".join(f"{v} AS (\n{render(v, 'duckdb')}\n)" for v in views)


class RawTables:
    """Lazily built raw views over ``<sf_dir>/<table>.parquet``.

    ``raw["invoices"]`` returns a DataFrame; nothing is read until an action.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = utc_session(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self._base: dict[str, DataFrame] = {}
        self._views: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        if name not in self._base:
            self._base[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._base[name]

    def __getitem__(self, view: str) -> DataFrame:
        if view not in self._views:
            _, tables = VIEWS[view]
            kwargs = {t: self.base(t) for t in tables}
            self._views[view] = self.spark.sql(render(view, "spark"), **kwargs)
        return self._views[view]
