"""Reference SQL (DuckDB dialect) for the registered queries.

Written independently of the Spark code from the shop-event mapping of the
generated tables; views ``events`` and ``part`` are expected to exist.
"""

from __future__ import annotations

# Fixed parameters; must equal those in :mod:`basketry.plans.registry`.
AS_OF = "2024-01-30"
NEXT_DAY = "2024-01-31"
UNION_CUTOFF = "2024-01-16"

SHOP = """
cat AS (
    SELECT p_partkey, upper(trim(p_type)) AS p_category FROM part
),
ev AS (
    SELECT *, CASE WHEN event_type NOT IN ('signup', 'error')
                   THEN TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k
    FROM events
),
shop AS (
    SELECT printf('U%04d', ev.user_id) AS user_id,
           CASE WHEN ev.k IS NOT NULL THEN printf('P%04d', ev.k) END AS product_id,
           coalesce(cat.p_category, 'UNKNOWN') AS category,
           CASE WHEN ev.event_type = 'click' THEN 'add_to_cart' ELSE ev.event_type END AS event_type,
           ev.ts AS "timestamp"
    FROM ev LEFT JOIN cat ON cat.p_partkey = ev.k
)"""

DAILY = f"""
daily AS (
    SELECT * FROM shop
    WHERE "timestamp" >= TIMESTAMP '{AS_OF}' AND "timestamp" < TIMESTAMP '{NEXT_DAY}'
)"""

FUNNEL = """
funnel AS (
    SELECT category,
           CAST(count_if(event_type = 'view') AS BIGINT) AS views,
           CAST(count_if(event_type = 'purchase') AS BIGINT) AS purchases,
           CAST(count_if(event_type = 'add_to_cart') AS BIGINT) AS cart_adds
    FROM shop WHERE category IS NOT NULL
    GROUP BY category
    HAVING count_if(event_type = 'view') > 0
)"""

REPORT = """
report AS (
    SELECT category, views, purchases, cart_adds,
           CASE WHEN views > 0 THEN round(CAST(purchases AS DOUBLE) / views, 4) ELSE 0.0 END AS conversion_rate,
           CASE WHEN cart_adds > 0 THEN round(CAST(purchases AS DOUBLE) / cart_adds, 4) ELSE 0.0 END
               AS cart_to_purchase_rate
    FROM funnel
)"""

USER_COUNTS = """
user_counts AS (
    SELECT user_id,
           CAST(count_if(event_type = 'purchase') AS BIGINT) AS purchases,
           CAST(count_if(event_type = 'add_to_cart') AS BIGINT) AS cart_adds,
           CAST(count_if(event_type = 'view') AS BIGINT) AS views
    FROM daily WHERE user_id IS NOT NULL GROUP BY user_id
),
segments AS (
    SELECT user_id,
           CASE WHEN purchases >= 1 THEN 'Buyer'
                WHEN cart_adds >= 1 THEN 'Cart_Abandoner'
                WHEN views > 0 THEN 'Window_Shopper'
                ELSE 'Unknown' END AS segment
    FROM user_counts
)"""

TOP = """
product_views AS (
    SELECT product_id, category, count(*) AS views
    FROM daily
    WHERE event_type = 'view' AND product_id IS NOT NULL AND category IS NOT NULL
    GROUP BY product_id, category
),
top AS (
    SELECT CAST(row_number() OVER (ORDER BY views DESC, product_id, category) AS INTEGER) AS rank,
           product_id, category, views
    FROM product_views
    ORDER BY views DESC, product_id, category
    LIMIT 5
)"""


def _windowed(width: str) -> str:
    return (f"time_bucket(INTERVAL '{width}', \"timestamp\") AS window_start, "
            f"time_bucket(INTERVAL '{width}', \"timestamp\") + INTERVAL '{width}' AS window_end")


CATEGORY_METRICS = f"""
category_metrics AS (
    SELECT {_windowed('5 minutes')}, category,
           count(*) AS total_events,
           CAST(count_if(event_type = 'purchase') AS BIGINT) AS purchases,
           CAST(count_if(event_type = 'view') AS BIGINT) AS views
    FROM shop WHERE "timestamp" IS NOT NULL
    GROUP BY ALL
)"""

PRODUCT_METRICS = f"""
product_metrics AS (
    SELECT {_windowed('5 minutes')}, product_id,
           count(*) AS total_events,
           CAST(count_if(event_type = 'view') AS BIGINT) AS views,
           CAST(count_if(event_type = 'purchase') AS BIGINT) AS purchases
    FROM shop WHERE "timestamp" IS NOT NULL
    GROUP BY ALL
)"""

ALERTS = f"""
alerts AS (
    SELECT {_windowed('1 day')}, product_id, category, count(*) AS event_count
    FROM shop WHERE "timestamp" IS NOT NULL
    GROUP BY ALL
    HAVING count(*) > 5
)"""

def _anomalies(closed: str, until: str) -> str:
    """Counts a product and day against the median of its last 8 days with events (4 at least) within 15 days."""
    return f"""
counts AS (
    SELECT * FROM (
        SELECT {_windowed('1 day')}, product_id, category, count(*) AS event_count
        FROM shop WHERE "timestamp" IS NOT NULL AND product_id IS NOT NULL GROUP BY ALL)
    WHERE {closed}
),
held AS (
    SELECT *, lead(window_start) OVER (PARTITION BY product_id, category ORDER BY window_start) AS following,
           (list(event_count) OVER before)[-8:] AS past,
           (list(event_count) OVER through)[-8:] AS upto
    FROM counts
    WINDOW before AS (PARTITION BY product_id, category ORDER BY window_start
                      RANGE BETWEEN INTERVAL '15 days' PRECEDING AND INTERVAL '1 microsecond' PRECEDING),
           through AS (PARTITION BY product_id, category ORDER BY window_start
                       RANGE BETWEEN INTERVAL '15 days' PRECEDING AND CURRENT ROW)
),
middles AS (
    SELECT *, list_aggregate(past, 'median')::DOUBLE AS past_middle, list_aggregate(upto, 'median')::DOUBLE AS upto_middle
    FROM held
),
spreads AS (
    SELECT *, list_aggregate(list_transform(past, lambda c: abs(c - past_middle)), 'median')::DOUBLE AS past_spread,
           list_aggregate(list_transform(upto, lambda c: abs(c - upto_middle)), 'median')::DOUBLE AS upto_spread
    FROM middles
),
anomalies AS (
    SELECT window_start, window_end, product_id, category,
           CASE WHEN event_count > past_middle THEN 'spike' ELSE 'drop' END AS kind, event_count,
           past_middle AS baseline, past_spread AS spread, CAST(len(past) AS INTEGER) AS windows
    FROM spreads
    WHERE len(past) >= 4 AND abs(event_count - past_middle) > 2.0 * greatest(past_spread, 0.5)
    UNION ALL
    SELECT window_end, window_end + INTERVAL '3 days', product_id, category, 'silence', 0,
           upto_middle, upto_spread, CAST(len(upto) AS INTEGER)
    FROM spreads
    WHERE len(upto) >= 4 AND upto_middle >= 1.0
      AND CASE WHEN following IS NULL THEN {until} ELSE following >= window_end + INTERVAL '3 days' END
)"""


SESSIONS = """
starts AS (
    SELECT *, CASE WHEN "timestamp" <= lag("timestamp") OVER (PARTITION BY user_id ORDER BY "timestamp") + INTERVAL '6 hours'
                   THEN 0 ELSE 1 END AS first
    FROM shop WHERE user_id IS NOT NULL
),
numbered AS (
    SELECT *, sum(first) OVER (PARTITION BY user_id ORDER BY "timestamp" RANGE UNBOUNDED PRECEDING) AS session FROM starts
),
sessions AS (
    SELECT min("timestamp") AS session_start, max("timestamp") + INTERVAL '6 hours' AS session_end, user_id, count(*) AS events,
           CAST(count_if(event_type = 'view') AS BIGINT) AS views,
           CAST(count_if(event_type = 'purchase') AS BIGINT) AS purchases,
           CAST(count_if(event_type = 'add_to_cart') AS BIGINT) AS cart_adds
    FROM numbered GROUP BY user_id, session
),
labelled AS (
    SELECT *, CASE WHEN purchases >= 1 THEN 'Buyer' WHEN cart_adds >= 1 THEN 'Cart_Abandoner'
                   WHEN views > 0 THEN 'Window_Shopper' ELSE 'Unknown' END AS segment
    FROM sessions
)"""

GRAINS = """
grains AS (
    SELECT CASE grouping(day, category, product_id) WHEN 1 THEN 'event_date,category' WHEN 3 THEN 'event_date'
                WHEN 5 THEN 'category' WHEN 6 THEN 'product_id' ELSE 'total' END AS grain,
           CAST(day AS VARCHAR) AS event_date, category, product_id, count(*) AS events,
           CAST(count_if(event_type = 'view') AS BIGINT) AS views,
           CAST(count_if(event_type = 'purchase') AS BIGINT) AS purchases,
           CAST(count_if(event_type = 'add_to_cart') AS BIGINT) AS cart_adds
    FROM (SELECT *, CAST("timestamp" AS DATE) AS day FROM shop)
    GROUP BY GROUPING SETS ((day, category), (day), (category), (product_id), ())
)"""

FOLLOWED = """
followed AS (
    SELECT v.user_id, v.product_id, v.category, v."timestamp" AS viewed_at, v.carted_at,
           (SELECT min(p."timestamp") FROM shop p
            WHERE p.user_id = v.user_id AND p.product_id = v.product_id AND p.event_type = 'purchase'
              AND p."timestamp" > v.carted_at AND p."timestamp" <= v."timestamp" + INTERVAL '10 days') AS purchased_at
    FROM (SELECT w.*, (SELECT min(c."timestamp") FROM shop c
                       WHERE c.user_id = w.user_id AND c.product_id = w.product_id AND c.event_type = 'add_to_cart'
                         AND c."timestamp" > w."timestamp" AND c."timestamp" <= w."timestamp" + INTERVAL '10 days') AS carted_at
          FROM shop w WHERE w.event_type = 'view' AND w.user_id IS NOT NULL AND w.product_id IS NOT NULL) v
)"""


# Append-mode streams emit a window once the watermark (latest event time
# minus the delay, one slice of the messages) has reached its end.
CLOSED = "window_end <= (SELECT max(ts) FROM events) - INTERVAL '5 days'"

ISO = "strftime(\"timestamp\", '%Y-%m-%dT%H:%M:%S.%f+00:00')"

RAW = ('SELECT user_id, product_id, event_type, "timestamp", CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS event_date, '
       'category FROM shop')


def _q(body: str, *ctes: str) -> str:
    return "WITH " + ",".join((SHOP,) + ctes) + "\n" + body


def _type_counts(event_type: str, alias: str) -> str:
    return _q(f"SELECT category, count(*) AS {alias} FROM shop "
              f"WHERE category IS NOT NULL AND event_type = '{event_type}' GROUP BY category")


ORACLE_SQL: dict[str, str] = {
    "shop_events": _q("SELECT * FROM shop"),
    "record_counts": _q(
        "SELECT count(*) AS loaded_events, "
        "CAST(count_if(category IS NOT NULL) AS BIGINT) AS retained_events, "
        "count(DISTINCT category) FILTER (WHERE category IS NOT NULL AND event_type = 'view') AS report_groups "
        "FROM shop"),
    "events_by_date": _q('SELECT CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS event_date, count(*) AS events '
                         'FROM shop GROUP BY 1'),
    "event_union": _q(
        f"SELECT user_id, product_id, CAST(NULL AS VARCHAR) AS category, event_type, \"timestamp\" FROM shop "
        f"WHERE \"timestamp\" < TIMESTAMP '{UNION_CUTOFF}' "
        f"UNION ALL SELECT user_id, product_id, category, event_type, \"timestamp\" FROM shop "
        f"WHERE \"timestamp\" >= TIMESTAMP '{UNION_CUTOFF}'"),
    "views_by_category": _type_counts("view", "views"),
    "purchases_by_category": _type_counts("purchase", "purchases"),
    "cart_adds_by_category": _type_counts("add_to_cart", "cart_adds"),
    "funnel_counts": _q("SELECT * FROM funnel", FUNNEL),
    "funnel_join_form": _q(
        "SELECT v.category, v.views, coalesce(p.purchases, 0) AS purchases, coalesce(c.cart_adds, 0) AS cart_adds "
        "FROM v LEFT JOIN p ON p.category = v.category LEFT JOIN c ON c.category = v.category",
        "v AS (SELECT category, count(*) AS views FROM shop WHERE category IS NOT NULL AND event_type = 'view' "
        "GROUP BY 1)",
        "p AS (SELECT category, count(*) AS purchases FROM shop WHERE category IS NOT NULL "
        "AND event_type = 'purchase' GROUP BY 1)",
        "c AS (SELECT category, count(*) AS cart_adds FROM shop WHERE category IS NOT NULL "
        "AND event_type = 'add_to_cart' GROUP BY 1)"),
    "conversion_report": _q("SELECT * FROM report ORDER BY conversion_rate DESC, category", FUNNEL, REPORT),
    "avg_conversion_rate": _q(
        "SELECT CAST(sum(CAST(conversion_rate AS DECIMAL(38, 4))) AS DOUBLE) / count(conversion_rate) "
        "AS avg_conversion_rate FROM report", FUNNEL, REPORT),
    "top_categories": _q("SELECT * FROM report ORDER BY conversion_rate DESC, category LIMIT 3", FUNNEL, REPORT),
    "low_performers": _q(
        "SELECT product_id, CAST(event_date AS VARCHAR) AS event_date, views, purchases, cart_adds, "
        "CASE WHEN views > 0 THEN round(CAST(purchases AS DOUBLE) / views, 4) ELSE 0.0 END AS conversion_rate, "
        "CASE WHEN cart_adds > 0 THEN round(CAST(purchases AS DOUBLE) / cart_adds, 4) ELSE 0.0 END "
        "AS cart_to_purchase_rate "
        "FROM pd WHERE views > 1 AND purchases = 0 ORDER BY views DESC, product_id, event_date LIMIT 3",
        "pd AS (SELECT product_id, CAST(\"timestamp\" AS DATE) AS event_date, "
        "CAST(count_if(event_type = 'view') AS BIGINT) AS views, "
        "CAST(count_if(event_type = 'purchase') AS BIGINT) AS purchases, "
        "CAST(count_if(event_type = 'add_to_cart') AS BIGINT) AS cart_adds "
        "FROM shop WHERE product_id IS NOT NULL AND \"timestamp\" IS NOT NULL GROUP BY 1, 2 "
        "HAVING count_if(event_type = 'view') > 0)"),
    "report_csv_roundtrip": _q("SELECT * FROM report", FUNNEL, REPORT),
    "report_validation": _q(
        "SELECT 'schema_matches' AS \"check\", CAST(0 AS BIGINT) AS failures, true AS passed "
        "UNION ALL SELECT 'has_rows', CASE WHEN n > 0 THEN 0 ELSE 1 END, n > 0 FROM s "
        "UNION ALL SELECT 'unreadable_values', CAST(0 AS BIGINT), true "
        "UNION ALL SELECT 'negative_counts', neg, neg = 0 FROM s "
        "UNION ALL SELECT 'null_category', nul, nul = 0 FROM s "
        "UNION ALL SELECT 'duplicate_category', dup, dup = 0 FROM s "
        "UNION ALL SELECT 'conversion_rate_mismatch', conv, conv = 0 FROM s "
        "UNION ALL SELECT 'cart_rate_mismatch', cart, cart = 0 FROM s",
        FUNNEL, REPORT,
        "s AS (SELECT count(*) AS n, "
        "CAST(count_if(views < 0 OR purchases < 0 OR cart_adds < 0) AS BIGINT) AS neg, "
        "CAST(count_if(category IS NULL) AS BIGINT) AS nul, "
        "count(category) - count(DISTINCT category) AS dup, "
        "CAST(count_if(abs(conversion_rate - CASE WHEN views > 0 THEN round(CAST(purchases AS DOUBLE) / views, 4) "
        "ELSE 0.0 END) > 1e-9) AS BIGINT) AS conv, "
        "CAST(count_if(abs(cart_to_purchase_rate - CASE WHEN cart_adds > 0 THEN "
        "round(CAST(purchases AS DOUBLE) / cart_adds, 4) ELSE 0.0 END) > 1e-9) AS BIGINT) AS cart FROM report)"),
    "daily_events": _q("SELECT * FROM daily", DAILY),
    "user_event_lists": _q(
        "SELECT user_id, string_agg(event_type || ':' || n, ',' ORDER BY event_type) AS event_list, "
        "CAST(coalesce(sum(n) FILTER (WHERE event_type = 'purchase'), 0) AS BIGINT) AS purchases, "
        "CAST(coalesce(sum(n) FILTER (WHERE event_type = 'add_to_cart'), 0) AS BIGINT) AS cart_adds, "
        "CAST(coalesce(sum(n) FILTER (WHERE event_type = 'view'), 0) AS BIGINT) AS views "
        "FROM per_type GROUP BY user_id",
        DAILY,
        "per_type AS (SELECT user_id, event_type, count(*) AS n FROM daily WHERE user_id IS NOT NULL GROUP BY 1, 2)"),
    "user_event_counts": _q("SELECT * FROM user_counts", DAILY, USER_COUNTS),
    "user_segments": _q("SELECT * FROM segments", DAILY, USER_COUNTS),
    "segment_summary": _q("SELECT segment, count(*) AS users FROM segments GROUP BY segment "
                          "ORDER BY users DESC, segment", DAILY, USER_COUNTS),
    "product_views": _q("SELECT * FROM product_views", DAILY, TOP),
    "top_products": _q("SELECT * FROM top ORDER BY rank", DAILY, TOP),
    "top_products_lines": _q(
        "SELECT CAST(line_no AS INTEGER) AS line_no, line FROM ("
        "SELECT 1 AS line_no, repeat('=', 60) AS line "
        f"UNION ALL SELECT 2, 'TOP 5 MOST VIEWED PRODUCTS - {AS_OF}' "
        "UNION ALL SELECT 3, repeat('=', 60) "
        "UNION ALL SELECT 4, '' "
        "UNION ALL SELECT 4 * rank + 1, rank || '. Product ID: ' || product_id FROM top "
        "UNION ALL SELECT 4 * rank + 2, '   Category: ' || category FROM top "
        "UNION ALL SELECT 4 * rank + 3, '   Views: ' || views FROM top "
        "UNION ALL SELECT 4 * rank + 4, '' FROM top)",
        DAILY, TOP),
    "window_category_metrics": _q("SELECT * FROM category_metrics", CATEGORY_METRICS),
    "window_category_metrics_literal": _q(
        f"SELECT {_windowed('5 minutes')}, category, count(*) AS total_events, "
        "count(event_type) AS purchases, count(event_type) AS views "
        "FROM shop WHERE \"timestamp\" IS NOT NULL GROUP BY ALL"),
    "window_product_alerts": _q("SELECT * FROM alerts", ALERTS),
    "window_product_metrics": _q("SELECT * FROM product_metrics", PRODUCT_METRICS),
    "window_anomalies": _q("SELECT * FROM anomalies", _anomalies("true", "false")),
    "catalog_as_of": _q(
        "SELECT s.user_id, s.product_id, s.event_type, s.\"timestamp\", coalesce(v.category, 'UNKNOWN') AS category "
        "FROM shop s ASOF LEFT JOIN versions v ON s.product_id = v.product_id AND s.\"timestamp\" >= v.valid_from",
        "listed AS (SELECT *, TIMESTAMP '2024-01-04' + to_minutes(p_partkey * 37 % 5000) AS t FROM part)",
        "versions AS (SELECT printf('P%04d', p_partkey) AS product_id, t AS valid_from, upper(p_brand) AS category FROM listed "
        "UNION ALL SELECT printf('P%04d', p_partkey), t + INTERVAL '10 days', upper(p_type) FROM listed "
        "UNION ALL SELECT printf('P%04d', p_partkey), t + INTERVAL '16 days', NULL FROM listed WHERE p_partkey % 5 = 0)"),
    "follow_views": _q("SELECT * FROM followed", FOLLOWED),
    "ordered_funnel": _q(
        "SELECT *, round(carted::DOUBLE / views, 4) AS cart_rate, round(purchased::DOUBLE / views, 4) AS purchase_rate FROM ("
        "SELECT category, count(*) AS views, count(carted_at) AS carted, count(purchased_at) AS purchased "
        "FROM followed GROUP BY category)", FOLLOWED),
    "stream_restarted_ingest": _q(RAW),
    "tolerant_scan": _q('SELECT CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS event_date, count(*) AS events FROM shop GROUP BY 1'),
    "missing_input_report": _q("SELECT *, 'raw' AS source FROM report", FUNNEL, REPORT),
    "job_quiet_day": _q(
        f"SELECT segment, count(*) AS users, '{AS_OF}' AS day FROM segments GROUP BY segment "
        f"UNION ALL SELECT 'report lines', 4 + 4 * count(*), '{AS_OF}' FROM top "
        "UNION ALL SELECT 'report lines', 0, '2031-01-01'", DAILY, USER_COUNTS, TOP),
    "segments_today": _q("SELECT * FROM segments", DAILY, USER_COUNTS),
    "user_sessions": _q("SELECT * FROM labelled", SESSIONS),
    "stream_user_sessions": _q("SELECT * FROM labelled WHERE " + CLOSED.replace("window_end", "session_end"), SESSIONS),
    "report_grains": _q(
        "SELECT *, CASE WHEN views > 0 THEN round(CAST(purchases AS DOUBLE) / views, 4) ELSE 0.0 END AS conversion_rate, "
        "CASE WHEN cart_adds > 0 THEN round(CAST(purchases AS DOUBLE) / cart_adds, 4) ELSE 0.0 END AS cart_to_purchase_rate "
        "FROM grains", GRAINS),
    "incremental_report": _q("SELECT * FROM report", FUNNEL, REPORT),
    "hot_products": _q("SELECT * FROM alerts", ALERTS),
    "stream_hot_products": _q(f"SELECT * FROM alerts WHERE {CLOSED}", ALERTS),
    "stream_repaired_metrics": _q(
        f"SELECT * FROM category_metrics WHERE {CLOSED}",
        CATEGORY_METRICS.replace("FROM shop", "FROM (SELECT * FROM shop UNION ALL SELECT * FROM shop "
                                 "WHERE user_id LIKE '%7' AND \"timestamp\" < TIMESTAMP '2024-01-16')")),
    "stream_repeated_metrics": _q(
        f"SELECT * FROM category_metrics WHERE {CLOSED}",
        CATEGORY_METRICS.replace("FROM shop", "FROM (SELECT DISTINCT * FROM shop)")),
    "stream_anomaly_alerts": _q(
        "SELECT * FROM anomalies",
        _anomalies(CLOSED, "window_end + INTERVAL '3 days' <= (SELECT max(ts) FROM events) - INTERVAL '5 days'")),
    "window_category_rates": _q(
        "SELECT *, CASE WHEN views > 0 THEN round(CAST(purchases AS DOUBLE) / views, 4) ELSE 0.0 END "
        "AS conversion_rate FROM category_metrics", CATEGORY_METRICS),
    "product_category_map": _q(
        "SELECT product_id, max(category) AS category FROM shop "
        "WHERE product_id IS NOT NULL AND category IS NOT NULL GROUP BY product_id"),
    "category_conversion_report": _q(
        "SELECT m.category, CAST(sum(pm.views) AS BIGINT) AS views, CAST(sum(pm.purchases) AS BIGINT) AS purchases, "
        "CASE WHEN sum(pm.views) > 0 THEN CAST(sum(pm.purchases) AS DOUBLE) / sum(pm.views) ELSE 0.0 END "
        "AS conversion_rate "
        "FROM product_metrics pm LEFT JOIN m ON m.product_id = pm.product_id GROUP BY m.category",
        PRODUCT_METRICS,
        "m AS (SELECT product_id, max(category) AS category FROM shop "
        "WHERE product_id IS NOT NULL AND category IS NOT NULL GROUP BY product_id)"),
    "catalog_normalize": (
        "SELECT printf('P%04d', p_partkey) AS product_id, arg_max(trim(p_type), p_partkey) AS category "
        "FROM part GROUP BY 1"),
    "catalog_enrich": _q("SELECT * FROM shop"),
    "event_json_encode": _q(
        "SELECT CAST(json_object('user_id', user_id, 'product_id', product_id, 'category', category, "
        f"'event_type', event_type, 'timestamp', {ISO}) AS VARCHAR) AS value FROM shop"),
    "event_json_decode": _q("SELECT * FROM shop"),
    "timestamp_parse": _q(f'SELECT {ISO} AS timestamp_text, "timestamp" FROM shop'),
    "stream_raw_ingest": _q(RAW),
    "stream_category_metrics": _q(f"SELECT * FROM category_metrics WHERE {CLOSED}", CATEGORY_METRICS),
    "stream_category_rates": _q(
        "SELECT *, CASE WHEN views > 0 THEN round(CAST(purchases AS DOUBLE) / views, 4) ELSE 0.0 END "
        f"AS conversion_rate FROM category_metrics WHERE {CLOSED}", CATEGORY_METRICS),
    "stream_product_alerts": _q(f"SELECT * FROM alerts WHERE {CLOSED}", ALERTS),
    "stream_product_metrics": _q(f"SELECT * FROM product_metrics WHERE {CLOSED}", PRODUCT_METRICS),
    "stream_catalog_enrich": _q(RAW),
    "stream_disordered_raw": _q(
        RAW + " UNION ALL " + RAW + " WHERE user_id LIKE '%7' AND \"timestamp\" < TIMESTAMP '2024-01-16'"
        " UNION ALL SELECT user_id, product_id, event_type, NULL, NULL, category FROM shop WHERE user_id LIKE '%03'"
        " UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL FROM shop WHERE user_id LIKE '%11'"),
    "stream_disordered_metrics": _q(f"SELECT * FROM category_metrics WHERE {CLOSED}", CATEGORY_METRICS),
    "output_audit": _q(
        "SELECT 'raw' AS dataset, count(*) AS rows, count(*) > 0 AS has_files, min(\"timestamp\") AS first_time, "
        "max(\"timestamp\") AS last_time, CAST(count_if(product_id IS NULL) AS BIGINT) AS null_key_rows FROM shop "
        "UNION ALL SELECT 'category_metrics', count(*), count(*) > 0, min(window_start), max(window_start), 0 "
        f"FROM category_metrics WHERE {CLOSED} "
        "UNION ALL SELECT 'product_metrics', count(*), count(*) > 0, min(window_start), max(window_start), "
        f"CAST(count_if(product_id IS NULL) AS BIGINT) FROM product_metrics WHERE {CLOSED} "
        # An alert stream without alerts still writes header-only files.
        "UNION ALL SELECT 'alerts', count(*), count(*) > 0, min(window_start), max(window_start), "
        f"CAST(count_if(product_id IS NULL) AS BIGINT) FROM alerts WHERE {CLOSED}",
        CATEGORY_METRICS, PRODUCT_METRICS, ALERTS),
    # Batch jobs over the stream outputs: raw keeps every event; the product
    # metrics hold closed windows only.
    "job_conversion_report": _q("SELECT * FROM report", FUNNEL, REPORT),
    "job_segment_summary": _q("SELECT segment, count(*) AS users FROM segments GROUP BY segment",
                              DAILY, USER_COUNTS),
    "job_top_products": _q(
        "SELECT CAST(line_no AS INTEGER) AS line_no, line FROM ("
        "SELECT 1 AS line_no, repeat('=', 60) AS line "
        f"UNION ALL SELECT 2, 'TOP 5 MOST VIEWED PRODUCTS - {AS_OF}' "
        "UNION ALL SELECT 3, repeat('=', 60) "
        "UNION ALL SELECT 4, '' "
        "UNION ALL SELECT 4 * rank + 1, rank || '. Product ID: ' || product_id FROM top "
        "UNION ALL SELECT 4 * rank + 2, '   Category: ' || category FROM top "
        "UNION ALL SELECT 4 * rank + 3, '   Views: ' || views FROM top "
        "UNION ALL SELECT 4 * rank + 4, '' FROM top)",
        DAILY, TOP),
    "job_category_conversion": _q(
        "SELECT m.category, CAST(sum(pm.views) AS BIGINT) AS views, CAST(sum(pm.purchases) AS BIGINT) AS purchases, "
        "CASE WHEN sum(pm.views) > 0 THEN CAST(sum(pm.purchases) AS DOUBLE) / sum(pm.views) ELSE 0.0 END "
        "AS conversion_rate "
        f"FROM (SELECT * FROM product_metrics WHERE {CLOSED}) pm LEFT JOIN m ON m.product_id = pm.product_id "
        "GROUP BY m.category",
        PRODUCT_METRICS,
        "m AS (SELECT product_id, max(category) AS category FROM shop "
        "WHERE product_id IS NOT NULL AND category IS NOT NULL GROUP BY product_id)"),
}
