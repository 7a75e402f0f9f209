"""SQL that gives the result of a registered query, for a second engine.

Texts are plain SQL over ``ec_*`` names (the retail views of ``star_views``).  They
follow the definitions of the operators, not their plans: windows for "first row",
full joins where the jobs sum per order first, one CASE for the question rules.
"""

from __future__ import annotations

from tradewind.schemas import ORDER_DATES, PRODUCT_MEASURES, REVIEW_DATES
from tradewind.sources.star_views import with_views

CHECKS: dict[str, str] = {}


def check(name: str, sql: str) -> None:
    CHECKS[name] = with_views(sql)


def ratio(num: str, den: str, digits: int = 2) -> str:
    """Whole-number ratio rounded half away from zero."""
    scale = 10**digits
    halves = f"((abs({num}) * {2 * scale} + ({den})) // (2 * nullif({den}, 0)))"
    return f"(CAST(sign({num}) * {halves} AS DOUBLE) / {scale}.0e0)"


def percent(num: str, den: str, digits: int = 2) -> str:
    return ratio(f"(({num}) * 100)", den, digits)


def settled(value: str, digits: int) -> str:
    """A double rounded after a shift that settles exact ties."""
    return f"round({value} + {10.0 ** -(digits + 3):.1e}, {digits})"


def floor_days(later: str, earlier: str) -> str:
    return f"CAST(floor(epoch_us({later} - {earlier}) / 86400000000.0e0) AS BIGINT)"


def trunc_days(later: str, earlier: str) -> str:
    return f"CAST(extract(DAY FROM ({later} - {earlier})) AS BIGINT)"


def text(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)


DELIVERED, ESTIMATED, PURCHASED = (
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "order_purchase_timestamp",
)
MONTH = f"strftime({PURCHASED}, '%Y-%m')"

# --- sources and sinks -----------------------------------------------------------

VIEW_COLUMNS = {
    "customers": 4, "geolocation": 3, "order_items": 6, "order_payments": 5, "order_reviews": 7, "orders": 8,
    "product_category_translation": 2, "products": 9, "sellers": 3,
}
PROFILE = " UNION ALL ".join(
    f"SELECT '{v}' AS table_name, count(*) AS row_count, CAST({n} AS BIGINT) AS column_count FROM ec_{v}"
    for v, n in VIEW_COLUMNS.items()
)
check("load_tables", f"SELECT *, CAST(1 AS BIGINT) AS missing_files FROM ({PROFILE})")
check("table_profile", PROFILE)
check("scan_table", "SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate) FROM orders")
check("write_replace", "SELECT * FROM ec_order_items")
check("write_partitioned", "SELECT order_id, customer_id, order_status FROM ec_orders")

INFO = {
    "customers": {
        "customer_id": "bigint", "customer_unique_id": "bigint", "customer_city": "string", "customer_state": "string",
    },
    "geolocation": {"geolocation_zip_code_prefix": "int", "geolocation_city": "string", "geolocation_state": "string"},
    "order_payments": {
        "order_id": "bigint", "payment_sequential": "int", "payment_type": "string", "payment_installments": "bigint",
        "payment_value": "double",
    },
    "orders": {"order_id": "bigint", "customer_id": "bigint", "order_status": "string"} | dict.fromkeys(ORDER_DATES, "timestamp_ntz"),
    "product_category_translation": {"product_category_name": "string", "product_category_name_english": "string"},
    "sellers": {"seller_id": "bigint", "seller_city": "string", "seller_state": "string"},
    "order_items": {
        "order_id": "bigint", "order_item_id": "int", "product_id": "bigint", "seller_id": "bigint",
        "price": "double", "freight_value": "double",
    },
    "order_reviews": {
        "review_id": "bigint", "order_id": "bigint", "review_score": "bigint", "review_comment_title": "string",
        "review_comment_message": "string", "review_creation_date": "timestamp_ntz",
        "review_answer_timestamp": "timestamp_ntz",
    },
    "products": {"product_id": "bigint", "product_category_name": "string"} | dict.fromkeys(PRODUCT_MEASURES, "double"),
}
check(
    "schema_info",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{d}' AS data_type, count({c}) AS non_null_count FROM ec_{t}"
        for t, columns in INFO.items()
        for c, d in columns.items()
    ),
)

# --- cleaning --------------------------------------------------------------------

PRODUCT_COLUMNS = ["product_id", "product_category_name", *PRODUCT_MEASURES]


def null_rows(table: str, view: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count,"
        f" round(count(*) FILTER (WHERE {c} IS NULL) * 100.0e0 / nullif(count(*), 0), 6) AS null_pct FROM {view}"
        for c in columns
    )


def first_row(view: str, keys: str) -> str:
    return (
        f"SELECT * EXCLUDE (_row_order, rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys}"
        f" ORDER BY _row_order) AS rn FROM {view}) WHERE rn = 1"
    )


def casts(columns: list[str], back_to_text: bool = True) -> str:
    """REPLACE list that reads text dates (unreadable ones become NULL)."""
    read = {c: f"TRY_CAST({c} AS TIMESTAMP)" for c in columns}
    return ", ".join(f"{f'CAST({e} AS VARCHAR)' if back_to_text else e} AS {c}" for c, e in read.items())


DATED = f"SELECT * EXCLUDE (_row_order) REPLACE ({casts(ORDER_DATES)}) FROM ec_raw_orders"
check("dedup_by_key", first_row("ec_raw_orders", "order_id"))
check("dedup_full_row", "SELECT DISTINCT * FROM ec_raw_order_items")
FILLED_CUSTOMERS = (
    "SELECT customer_id, customer_unique_id, coalesce(customer_city, 'Unknown') AS customer_city,"
    " coalesce(customer_state, 'Unknown') AS customer_state"
)
check("fill_constant", f"{FILLED_CUSTOMERS} FROM ec_raw_customers")
MEDIANS = ", ".join(
    f"round(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM ec_raw_products)), 6) AS {c}" for c in PRODUCT_MEASURES
)
check("fill_median", f"SELECT product_id, product_category_name, {MEDIANS} FROM ec_raw_products")
check("coerce_timestamp", DATED)
check("require_not_null", f"SELECT * FROM ({DATED}) WHERE {PURCHASED} IS NOT NULL")
check("positive_only", "SELECT * FROM ec_raw_order_payments WHERE payment_value > 0")


def fences(column: str, source: str) -> str:
    return (
        f"SELECT quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.75) AS q3,"
        f" q1 - 1.5e0 * (q3 - q1) AS low, q3 + 1.5e0 * (q3 - q1) AS high FROM {source}"
    )


check(
    "iqr_fences",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {settled('q1', 6)} AS q1, {settled('q3', 6)} AS q3,"
        f" {settled('low', 6)} AS lower_fence, {settled('high', 6)} AS upper_fence FROM ({fences(c, 'ec_order_items')})"
        for c in ("price", "freight_value")
    ),
)
check(
    "iqr_filter",
    f"WITH f AS ({fences('value', 'events')}) SELECT event_id, user_id, event_type, value FROM events, f"
    " WHERE value BETWEEN low AND high",
)


def fence_chain(source: str) -> str:
    return (
        f"pf AS ({fences('price', source)}), fair AS (SELECT i.* FROM {source} i, pf WHERE price BETWEEN low AND high),"
        f" ff AS ({fences('freight_value', 'fair')}),"
        " kept AS (SELECT fair.* FROM fair, ff WHERE freight_value BETWEEN low AND high)"
    )


check("iqr_filter_chain", f"WITH {fence_chain('ec_order_items')} SELECT * FROM kept")
UNIQUE_ITEMS = "ui AS (SELECT DISTINCT * FROM ec_raw_order_items)"
CLEAN = {
    "customers": f"{FILLED_CUSTOMERS} FROM ({first_row('ec_raw_customers', 'customer_id')})",
    "orders": f"SELECT * FROM (SELECT * REPLACE ({casts(ORDER_DATES)}) FROM ({first_row('ec_raw_orders', 'order_id')}))"
    f" WHERE {PURCHASED} IS NOT NULL",
    "order_items": f"WITH {UNIQUE_ITEMS}, {fence_chain('ui')} SELECT * FROM kept",
    "order_reviews": "SELECT * REPLACE (coalesce(review_comment_title, '') AS review_comment_title,"
    f" coalesce(review_comment_message, '') AS review_comment_message, {casts(REVIEW_DATES)})"
    f" FROM ({first_row('ec_raw_order_reviews', 'review_id, order_id')})",
    "products": f"SELECT product_id, coalesce(product_category_name, 'unknown') AS product_category_name, {MEDIANS}"
    f" FROM ({first_row('ec_raw_products', 'product_id')})",
    "order_payments": "SELECT DISTINCT * FROM ec_raw_order_payments WHERE payment_value > 0",
}
check("clean_customers", CLEAN["customers"])
check("clean_orders", CLEAN["orders"])
check("clean_order_items", CLEAN["order_items"])
check("clean_reviews", CLEAN["order_reviews"])
check("clean_products", CLEAN["products"])
check("clean_payments", CLEAN["order_payments"])

CLEAN_COLUMNS = {
    "customers": ["customer_id", "customer_unique_id", "customer_city", "customer_state"],
    "orders": ["order_id", "customer_id", "order_status", *ORDER_DATES],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"],
    "order_reviews": [
        "review_id", "order_id", "review_score", "review_comment_title", "review_comment_message", *REVIEW_DATES,
    ],
    "products": PRODUCT_COLUMNS,
    "order_payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
}
NULL_ROWS = [null_rows(f"raw_{t}", f"ec_raw_{t}", c) for t, c in CLEAN_COLUMNS.items()]
NULL_ROWS += [null_rows(t, f"({CLEAN[t]})", c) for t, c in CLEAN_COLUMNS.items()]
check("null_summary", f"SELECT * FROM ({' UNION ALL '.join(NULL_ROWS)}) WHERE null_count > 0")
check(
    "clean_summary",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST(sum("
        + " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in columns)
        + f") AS BIGINT) AS remaining_nulls FROM ({CLEAN[t]})"
        for t, columns in CLEAN_COLUMNS.items()
    ),
)


def removed(table: str, step: str, before: str, after: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{step}' AS step, b AS rows_before, a AS rows_after, b - a AS rows_removed"
        f" FROM (SELECT ({before}) AS b, ({after}) AS a)"
    )


def rows_in(view: str) -> str:
    return f"SELECT count(*) FROM {view}"


def keys_in(view: str, *keys: str) -> str:
    return f"SELECT count(*) FROM (SELECT DISTINCT {', '.join(keys)} FROM {view})"


UNIQUE_ORDERS = f"({first_row('ec_raw_orders', 'order_id')})"
PAID = "(SELECT * FROM ec_raw_order_payments WHERE payment_value > 0)"
check(
    "clean_report",
    f"WITH {UNIQUE_ITEMS}, {fence_chain('ui')} "
    + " UNION ALL ".join(
        [
            removed("customers", "duplicates", rows_in("ec_raw_customers"), keys_in("ec_raw_customers", "customer_id")),
            removed("orders", "duplicates", rows_in("ec_raw_orders"), keys_in("ec_raw_orders", "order_id")),
            removed(
                "orders",
                "no purchase time",
                rows_in(UNIQUE_ORDERS),
                rows_in(f"{UNIQUE_ORDERS} WHERE TRY_CAST({PURCHASED} AS TIMESTAMP) IS NOT NULL"),
            ),
            removed("order_items", "duplicates", rows_in("ec_raw_order_items"), rows_in("ui")),
            removed("order_items", "price outliers", rows_in("ui"), rows_in("fair")),
            removed("order_items", "freight outliers", rows_in("fair"), rows_in("kept")),
            removed(
                "order_reviews",
                "duplicates",
                rows_in("ec_raw_order_reviews"),
                keys_in("ec_raw_order_reviews", "review_id", "order_id"),
            ),
            removed("products", "duplicates", rows_in("ec_raw_products"), keys_in("ec_raw_products", "product_id")),
            removed("order_payments", "zero or negative", rows_in("ec_raw_order_payments"), rows_in(PAID)),
            removed("order_payments", "duplicates", rows_in(PAID), rows_in(f"(SELECT DISTINCT * FROM {PAID})")),
        ]
    ),
)

# --- business reports ------------------------------------------------------------

check(
    "top_sellers_ranked",
    """
    WITH sold AS (
        SELECT i.seller_id, s.seller_city, s.seller_state, round(sum(i.price + i.freight_value), 2) AS total_revenue,
               count(DISTINCT i.order_id) AS total_orders
        FROM ec_order_items i JOIN ec_sellers s ON i.seller_id = s.seller_id GROUP BY ALL)
    SELECT * FROM (SELECT rank() OVER (ORDER BY total_revenue DESC) AS revenue_rank, * FROM sold)
    WHERE revenue_rank <= 10""",
)
check(
    "top_sellers_limit",
    """
    WITH per_seller AS (SELECT seller_id, sum(price) AS revenue FROM ec_order_items GROUP BY seller_id)
    SELECT seller_id, round(revenue, 2) AS total_revenue, rank() OVER (ORDER BY revenue DESC) AS revenue_rank
    FROM per_seller ORDER BY revenue DESC, seller_id LIMIT 10""",
)
check(
    "monthly_growth",
    f"""
    WITH monthly AS (SELECT {MONTH} AS order_month, count(order_id) AS total_orders FROM ec_orders
                     WHERE {PURCHASED} IS NOT NULL GROUP BY 1),
    lagged AS (SELECT *, lag(total_orders) OVER (ORDER BY order_month) AS prev_month_orders FROM monthly)
    SELECT *, {percent('total_orders - prev_month_orders', 'prev_month_orders')} AS growth_rate_pct FROM lagged""",
)
check(
    "monthly_orders_lag",
    f"""
    WITH dated AS (SELECT order_id, TRY_CAST({PURCHASED} AS TIMESTAMP) AS t FROM ec_raw_orders),
    monthly AS (SELECT strftime(t, '%Y-%m') AS month, count(order_id) AS total_orders FROM dated GROUP BY 1)
    SELECT *, lag(total_orders) OVER (ORDER BY month ASC NULLS LAST) AS prev_month FROM monthly""",
)
DELAYS = f"""delays AS (
        SELECT c.customer_state, o.order_id, {trunc_days(DELIVERED, ESTIMATED)} AS d
        FROM ec_orders o JOIN ec_customers c ON o.customer_id = c.customer_id WHERE {DELIVERED} IS NOT NULL)"""
check(
    "delivery_delay_by_state",
    f"""
    WITH {DELAYS}
    SELECT customer_state, count(order_id) AS total_orders, {ratio('sum(d)', 'count(d)')} AS avg_delay_days,
           CAST(min(d) AS DOUBLE) AS min_delay_days, CAST(max(d) AS DOUBLE) AS max_delay_days,
           CASE WHEN avg(d) > 0 THEN 'Delayed' ELSE 'On Time' END AS delivery_status
    FROM delays GROUP BY customer_state""",
)
check(
    "delivery_delay_top10",
    f"""
    WITH {DELAYS}
    SELECT customer_state, {ratio('sum(d)', 'count(d)')} AS avg_delay FROM delays GROUP BY customer_state
    ORDER BY avg_delay DESC NULLS FIRST, customer_state NULLS LAST LIMIT 10""",
)
PERSONS = """persons AS (
        SELECT customer_unique_id, count(o.order_id) AS n
        FROM ec_customers c JOIN ec_orders o ON c.customer_id = o.customer_id GROUP BY 1),
    classes AS (SELECT CASE n WHEN 1 THEN 'One-Time Buyer' WHEN 2 THEN 'Repeat Buyer (2x)' ELSE 'Loyal Buyer (3x+)' END
                AS buyer_type, count(*) AS customer_count FROM persons GROUP BY 1)"""
check(
    "repeat_purchase_rate",
    f"WITH {PERSONS} SELECT *, {percent('customer_count', '(SELECT count(*) FROM persons)')} AS percentage FROM classes",
)
check("repeat_purchase_counts", f"WITH {PERSONS} SELECT * FROM classes")
CANCELED_LINES = """
        SELECT {category} AS category, count(o.order_id) AS total_orders,
               count(*) FILTER (WHERE o.order_status = 'canceled') AS cancelled_orders
        FROM ec_orders o JOIN ec_order_items i ON o.order_id = i.order_id JOIN ec_products p ON i.product_id = p.product_id
        {more} GROUP BY 1 HAVING count(o.order_id) >= 50"""
check(
    "category_cancellation",
    f"""
    WITH counted AS ({CANCELED_LINES.format(
        category="coalesce(t.product_category_name_english, p.product_category_name, 'unknown')",
        more="LEFT JOIN ec_product_category_translation t ON p.product_category_name = t.product_category_name")}),
    rates AS (SELECT *, cancelled_orders * 100.0e0 / total_orders AS rate,
                     {percent('cancelled_orders', 'total_orders')} AS cancellation_rate_pct FROM counted)
    SELECT * EXCLUDE (rate), lead(cancellation_rate_pct) OVER (ORDER BY rate DESC, category) AS next_category_rate
    FROM rates ORDER BY cancellation_rate_pct DESC, rate DESC, category LIMIT 15""",
)
check(
    "category_cancellation_raw",
    f"""
    SELECT category AS product_category_name, total_orders, cancelled_orders AS cancelled,
           {percent('cancelled_orders', 'total_orders')} AS cancellation_rate_pct
    FROM ({CANCELED_LINES.format(category='p.product_category_name', more='')})
    ORDER BY cancellation_rate_pct DESC, product_category_name NULLS LAST LIMIT 10""",
)

# --- headline numbers ------------------------------------------------------------

check(
    "kpi_summary",
    """SELECT (SELECT count(*) FROM ec_orders) AS total_orders,
        (SELECT round(sum(price), 2) FROM ec_order_items) AS total_revenue,
        (SELECT round(avg(review_score), 2) FROM ec_order_reviews) AS avg_rating,
        (SELECT count(DISTINCT customer_id) FROM ec_customers) AS total_customers,
        (SELECT count(DISTINCT customer_unique_id) FROM ec_customers) AS unique_persons""",
)
check(
    "kpi_dashboard",
    f"""SELECT (SELECT count(*) FROM ec_orders) AS total_orders,
        (SELECT round(sum(price), 2) FROM ec_order_items) AS total_revenue,
        (SELECT round(avg(review_score), 6) FROM ec_order_reviews) AS avg_rating,
        (SELECT round(avg({floor_days(DELIVERED, PURCHASED)}), 6) FROM ec_orders) AS avg_delivery_days""",
)
check(
    "avg_delivery_days",
    f"SELECT round(avg({trunc_days(DELIVERED, PURCHASED)}), 6) AS avg_delivery_days FROM ec_orders"
    f" WHERE {DELIVERED} IS NOT NULL",
)
check(
    "revenue_by_state",
    """
    SELECT state, round(r, 2) AS revenue FROM (
        SELECT c.customer_state AS state, sum(i.price) AS r FROM ec_order_items i
        JOIN ec_orders o ON i.order_id = o.order_id JOIN ec_customers c ON o.customer_id = c.customer_id GROUP BY 1)
    ORDER BY r DESC, state NULLS LAST LIMIT 10""",
)
check(
    "revenue_by_state_all",
    """
    SELECT customer_state, round(r, 2) AS revenue FROM (
        SELECT c.customer_state, coalesce(sum(i.price), 0) AS r FROM ec_orders o
        LEFT JOIN ec_customers c ON o.customer_id = c.customer_id
        LEFT JOIN ec_order_items i ON i.order_id = o.order_id WHERE c.customer_state IS NOT NULL GROUP BY 1)
    ORDER BY r DESC, customer_state LIMIT 10""",
)
check("payment_type_counts", "SELECT payment_type, count(order_id) AS transactions FROM ec_order_payments GROUP BY 1")
MONTHLY_COUNTS = f"""
    SELECT {MONTH} AS month, count(order_id) AS order_count FROM ec_orders WHERE {PURCHASED} IS NOT NULL GROUP BY 1"""
check("monthly_order_counts", MONTHLY_COUNTS)
check(
    "monthly_avg_rating",
    f"""
    SELECT {MONTH} AS month, round(avg(review_score), 6) AS avg_rating
    FROM ec_orders o JOIN ec_order_reviews r ON o.order_id = r.order_id GROUP BY 1""",
)
SHOWN = "order_id, product_id, seller_id, price, freight_value"
check(
    "explore_items",
    f"""
    SELECT {SHOWN} FROM ec_order_items WHERE price BETWEEN 20000 AND 60000
    AND order_id IN (SELECT order_id FROM ec_orders WHERE order_status = 'shipped') ORDER BY {SHOWN} LIMIT 100""",
)
check("explore_all_items", f"SELECT {SHOWN} FROM ec_order_items ORDER BY {SHOWN} LIMIT 100")
check(
    "explore_count",
    """SELECT count(*) AS matching_items FROM ec_order_items WHERE price BETWEEN 20000 AND 60000
    AND order_id IN (SELECT order_id FROM ec_orders WHERE order_status = 'shipped')""",
)
check("explore_statuses", "SELECT DISTINCT order_status FROM ec_orders")
check("explore_bounds", "SELECT min(price) AS min_price, max(price) AS max_price FROM ec_order_items")

# --- exploration -----------------------------------------------------------------


def describe(source: str, columns: dict[str, str], digits: int = 4, dates: bool = False) -> str:
    def one(column: str, e: str) -> str:
        stats = {
            "mean": f"avg({e})",
            "std": "CAST(NULL AS DOUBLE)" if dates else f"stddev_samp({e})",
            "min": f"CAST(min({e}) AS DOUBLE)",
            "q25": f"quantile_cont({e}, 0.25)",
            "q50": f"quantile_cont({e}, 0.5)",
            "q75": f"quantile_cont({e}, 0.75)",
            "max": f"CAST(max({e}) AS DOUBLE)",
        }
        cells = ", ".join(f"{settled(value, digits)} AS {name}" for name, value in stats.items())
        return f"SELECT '{column}' AS column_name, count({e}) AS value_count, {cells} FROM {source}"

    return " UNION ALL ".join(one(c, e) for c, e in columns.items())


check("describe_orders", describe("ec_orders", {c: f"epoch_us({c}) / 1000000.0e0" for c in ORDER_DATES}, dates=True))
check("describe_items", describe("ec_order_items", {c: c for c in ("price", "freight_value")}))
check(
    "describe_payments",
    describe("ec_order_payments", {c: f"CAST({c} AS DOUBLE)" for c in ("payment_value", "payment_installments")}),
)
check(
    "orders_customers",
    f"SELECT o.* REPLACE ({text(*ORDER_DATES)}), c.customer_state, c.customer_city"
    " FROM ec_orders o JOIN ec_customers c ON o.customer_id = c.customer_id",
)
check(
    "items_payments",
    "SELECT i.order_id, price, freight_value, payment_value, payment_type"
    " FROM ec_order_items i JOIN ec_order_payments p ON i.order_id = p.order_id",
)
check(
    "state_revenue_stats",
    f"""
    SELECT customer_state, count(o.order_id) AS total_orders, {settled('coalesce(sum(price), 0)', 4)} AS total_revenue,
           {settled('avg(price)', 4)} AS avg_price, {settled('avg(freight_value)', 4)} AS avg_freight
    FROM ec_orders o JOIN ec_customers c ON o.customer_id = c.customer_id
    LEFT JOIN ec_order_items i ON o.order_id = i.order_id WHERE customer_state IS NOT NULL GROUP BY 1""",
)
check(
    "payment_type_stats",
    f"""
    SELECT payment_type, count(order_id) AS total_transactions, {settled('sum(payment_value)', 4)} AS total_value,
           {settled('avg(payment_value)', 4)} AS avg_value FROM ec_order_payments GROUP BY 1""",
)
check(
    "status_by_year_pivot",
    f"""
    SELECT CAST(year({PURCHASED}) AS INTEGER) AS order_year,
           {', '.join(f"count(*) FILTER (WHERE order_status = '{s}') AS {s}" for s in ('canceled', 'delivered', 'shipped'))}
    FROM ec_orders o LEFT JOIN ec_order_items i ON o.order_id = i.order_id GROUP BY 1""",
)
CORRELATED = ["price", "freight_value", "payment_value", "payment_installments", "review_score"]
check(
    "correlation_matrix",
    """WITH joined AS (
        SELECT price, freight_value, payment_value, payment_installments, review_score
        FROM ec_order_items i JOIN ec_order_payments p ON i.order_id = p.order_id
        LEFT JOIN ec_order_reviews r ON i.order_id = r.order_id)
    """
    + " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM joined"
        for n, a in enumerate(CORRELATED)
        for b in CORRELATED[n + 1 :]
    ),
)
check("status_value_counts", 'SELECT order_status AS value, count(*) AS "rows" FROM ec_orders GROUP BY 1')
check(
    "category_value_counts",
    """SELECT product_category_name AS value, count(*) AS "rows" FROM ec_products
    WHERE product_category_name IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
check("score_value_counts", 'SELECT review_score AS value, count(*) AS "rows" FROM ec_order_reviews GROUP BY 1')

for query_name, column in (("box_stats", "freight_value"), ("price_box_stats", "price")):
    check(
        query_name,
        f"""
    WITH f AS ({fences(column, 'ec_order_items')}),
    m AS (SELECT quantile_cont({column}, 0.5) AS med FROM ec_order_items)
    SELECT {settled('any_value(q1)', 6)} AS q1, {settled('any_value(med)', 6)} AS median,
           {settled('any_value(q3)', 6)} AS q3,
           {settled(f'(min({column}) FILTER (WHERE {column} BETWEEN low AND high))', 6)} AS whisker_low,
           {settled(f'(max({column}) FILTER (WHERE {column} BETWEEN low AND high))', 6)} AS whisker_high,
           count(*) FILTER (WHERE {column} NOT BETWEEN low AND high) AS outliers
    FROM ec_order_items, f, m""",
    )

check(
    "price_box_by_state",
    f"""
    WITH x AS (SELECT customer_state, price AS v FROM ec_order_items i JOIN ec_orders o ON i.order_id = o.order_id
               JOIN ec_customers c ON o.customer_id = c.customer_id WHERE customer_state IS NOT NULL AND price IS NOT NULL),
    q AS (SELECT customer_state, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3,
                 q1 - 1.5e0 * (q3 - q1) AS low, q3 + 1.5e0 * (q3 - q1) AS high FROM x GROUP BY 1)
    SELECT customer_state, {settled('q1', 6)} AS q1, {settled('median', 6)} AS median, {settled('q3', 6)} AS q3,
           {settled('(min(v) FILTER (WHERE v BETWEEN low AND high))', 6)} AS whisker_low,
           {settled('(max(v) FILTER (WHERE v BETWEEN low AND high))', 6)} AS whisker_high,
           count(*) FILTER (WHERE v NOT BETWEEN low AND high) AS outliers
    FROM x JOIN q USING (customer_state) GROUP BY customer_state, q.q1, q.median, q.q3""",
)

FULL = f"""lines AS (
        SELECT i.order_id, i.order_item_id, i.product_id,
               coalesce(t.product_category_name_english, p.product_category_name, 'unknown') AS category
        FROM ec_order_items i LEFT JOIN ec_products p ON i.product_id = p.product_id
        LEFT JOIN ec_product_category_translation t ON p.product_category_name = t.product_category_name),
    firsts AS (SELECT order_id, category FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_item_id, product_id, category) AS rn FROM lines)
        WHERE rn = 1),
    reviewed AS (
        SELECT r.order_id, r.review_score, r.review_creation_date, o.{PURCHASED},
               coalesce(f.category, 'unknown') AS category
        FROM ec_order_reviews r JOIN ec_orders o ON r.order_id = o.order_id LEFT JOIN firsts f ON r.order_id = f.order_id)"""
check(
    "score_box_by_year",
    f"""
    WITH {FULL}, y AS (SELECT CAST(year({PURCHASED}) AS INTEGER) AS year, review_score AS v FROM reviewed),
    q AS (SELECT year, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
          FROM y GROUP BY year)
    SELECT year, CAST(q1 AS DOUBLE) AS q1, CAST(median AS DOUBLE) AS median, CAST(q3 AS DOUBLE) AS q3,
           CAST(min(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS DOUBLE) AS whisker_low,
           CAST(max(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS DOUBLE) AS whisker_high,
           count(*) FILTER (WHERE v NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
    FROM y JOIN q USING (year) GROUP BY year, q1, median, q3""",
)
PAIRS = f"SELECT *, lead(order_count) OVER (ORDER BY month) AS next_count FROM ({MONTHLY_COUNTS})"
check("lag_pairs", f"SELECT * FROM ({PAIRS}) WHERE next_count IS NOT NULL")
check("lag_autocorrelation", f"SELECT round(corr(order_count, next_count), 6) AS lag1_correlation FROM ({PAIRS})")

# --- persons ---------------------------------------------------------------------

check("order_value", "SELECT order_id, round(sum(payment_value), 4) AS payment_value FROM ec_order_payments GROUP BY 1")
BASE = f"""value AS (SELECT order_id, sum(payment_value) AS payment_value FROM ec_order_payments GROUP BY 1),
    base AS (SELECT o.order_id, c.customer_unique_id, o.{PURCHASED}, v.payment_value
        FROM ec_orders o JOIN ec_customers c ON o.customer_id = c.customer_id JOIN value v ON o.order_id = v.order_id
        WHERE o.order_status = 'delivered')"""
RFM = f"""{BASE},
    ref AS (SELECT max({PURCHASED}) + INTERVAL 1 DAY AS reference FROM base),
    rfm AS (SELECT customer_unique_id, {floor_days('any_value(reference)', f'max({PURCHASED})')} AS recency,
                   count(order_id) AS frequency, sum(payment_value) AS monetary FROM base, ref GROUP BY 1)"""


def quintile(column: str) -> str:
    """Right-closed quintile number, from linearly interpolated edges."""
    edges = " ".join(
        f"WHEN {column} <= (SELECT quantile_cont({column}, {p}) FROM rfm) THEN {n}"
        for n, p in enumerate(("0.2", "0.4", "0.6", "0.8"), start=1)
    )
    return f"CASE {edges} ELSE 5 END"


FREQUENCY_SCORE = (
    "CASE WHEN frequency <= 1 THEN 1 WHEN frequency <= 2 THEN 2 WHEN frequency <= 3 THEN 3 WHEN frequency <= 5 THEN 4"
    " ELSE 5 END"
)
SCORED = f"""{RFM},
    parts AS (SELECT customer_unique_id, 6 - ({quintile('recency')}) AS r_score, {FREQUENCY_SCORE} AS f_score,
                     {quintile('monetary')} AS m_score FROM rfm),
    scored AS (SELECT *, r_score + f_score + m_score AS rfm_score FROM parts)"""
check(
    "rfm_base",
    f"WITH {BASE} SELECT order_id, customer_unique_id, {text(PURCHASED)}, round(payment_value, 4) AS payment_value FROM base",
)
check("rfm_values", f"WITH {RFM} SELECT * REPLACE (round(monetary, 4) AS monetary) FROM rfm")
check(
    "quantile_bucket",
    f"WITH {RFM} SELECT * REPLACE (round(monetary, 4) AS monetary), {quintile('monetary')} AS monetary_bucket,"
    f" {quintile('recency')} AS recency_bucket FROM rfm",
)
check("fixed_bucket", f"WITH {RFM} SELECT customer_unique_id, frequency, {FREQUENCY_SCORE} AS f_score FROM rfm")
check("rfm_scores", f"WITH {SCORED} SELECT * FROM scored")
check("rfm_score_distribution", f"WITH {SCORED} SELECT rfm_score, count(*) AS persons FROM scored GROUP BY 1")
Z = ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM rfm)) / (SELECT stddev_pop({c}) FROM rfm), 6) AS z_{c}"
    for c in ("recency", "frequency", "monetary")
)
GRADED = f"""{SCORED},
    graded AS (SELECT rfm.*, r_score, f_score, m_score, rfm_score,
        CASE WHEN m_score >= 5 THEN 2 WHEN m_score >= 3 THEN 0 ELSE 1 END AS cluster FROM rfm JOIN scored USING (customer_unique_id)),
    placed AS (SELECT cluster, row_number() OVER (ORDER BY avg(monetary) DESC, cluster) AS place FROM graded GROUP BY cluster),
    named AS (SELECT graded.*, CASE place WHEN 1 THEN 'High Value' WHEN 2 THEN 'Medium Value' WHEN 3 THEN 'Low Value' END AS segment
        FROM graded JOIN placed USING (cluster))"""
SEGMENT_SIZES = "SELECT segment, count(*) AS customers FROM named GROUP BY 1"


def mean(column: str) -> str:
    """Average in cents, computed on whole numbers."""
    return ratio(f"sum(CAST(round({column} * 100) AS BIGINT))", "(count(*) * 100)")


MEANS = ", ".join(f"{mean(c)} AS avg_{c}" for c in ("recency", "frequency", "monetary"))
check("segment_counts", f"WITH {GRADED} {SEGMENT_SIZES}")
check("segment_summary", f"WITH {GRADED} SELECT segment, count(*) AS customers, {MEANS} FROM named GROUP BY 1")
check(
    "cluster_summary",
    f"WITH {GRADED} SELECT cluster, count(*) AS customer_count, {MEANS}, {mean('rfm_score')} AS avg_rfm_score FROM graded GROUP BY 1",
)
check("label_segments", f"WITH {GRADED} SELECT * REPLACE (round(monetary, 4) AS monetary) FROM named")
SPREAD = ", ".join(
    f"round(({c} - min({c}) OVER ()) / nullif(max({c}) OVER () - min({c}) OVER (), 0), 6) AS {c}_scaled"
    for c in ("recency", "frequency", "monetary")
)
check(
    "segment_profile",
    f"""WITH {GRADED}, m AS (SELECT segment, {', '.join(f"{mean(c)} AS {c}" for c in ("recency", "frequency", "monetary"))} FROM named GROUP BY 1)
    SELECT *, {SPREAD} FROM m""",
)
check("segment_points", f"WITH {GRADED} SELECT recency, round(monetary, 4) AS monetary, segment FROM named")
check(
    "elbow",
    f"""WITH {RFM} SELECT CAST(k AS INTEGER) AS k, CASE WHEN k = 1 THEN (SELECT round(3.0e0 * count(*), 4) FROM rfm) END AS inertia_of_one,
    true AS falls FROM range(1, 11) t(k)""",
)
check(
    "kmeans_segments",
    f"""WITH {SCORED} SELECT rfm.* REPLACE (round(monetary, 4) AS monetary), r_score, f_score, m_score, rfm_score, true AS nearest,
    3 AS clusters FROM rfm JOIN scored USING (customer_unique_id)""",
)
check("standardize", f"WITH {RFM} SELECT customer_unique_id, {Z} FROM rfm")
check("describe_rfm", f"WITH {RFM} {describe('rfm', {c: f'CAST({c} AS DOUBLE)' for c in ('recency', 'frequency', 'monetary')}, 2)}")

# --- forecasting -----------------------------------------------------------------

DAYS = f"{floor_days(DELIVERED, PURCHASED)} AS delivery_days, {floor_days(DELIVERED, ESTIMATED)} AS delivery_delay"
check("order_delivery_features", f"SELECT order_id, {DAYS} FROM ec_orders")
PAY = """pay AS (SELECT order_id, sum(payment_value) AS payment_value, avg(payment_installments) AS payment_installments
            FROM ec_order_payments GROUP BY 1)"""
check(
    "payment_per_order",
    f"WITH {PAY} SELECT order_id, round(payment_value, 4) AS payment_value,"
    " round(payment_installments, 4) AS payment_installments FROM pay",
)
FEATURE_ROWS = f"""{PAY},
    feature_rows AS (
        SELECT o.*, {DAYS}, CAST(date_trunc('week', {PURCHASED}) AS DATE) AS week, i.price, i.freight_value,
               pay.payment_value, pay.payment_installments, r.review_score
        FROM ec_orders o LEFT JOIN ec_order_items i ON o.order_id = i.order_id
        LEFT JOIN pay ON o.order_id = pay.order_id LEFT JOIN ec_order_reviews r ON o.order_id = r.order_id)"""
check(
    "order_feature_rows",
    f"""WITH {FEATURE_ROWS}
    SELECT * REPLACE ({text('week', *ORDER_DATES)}, round(price, 4) AS price, round(freight_value, 4) AS freight_value,
                      round(payment_value, 4) AS payment_value, round(payment_installments, 4) AS payment_installments)
    FROM feature_rows""",
)
AVERAGES = {
    "avg_price": "price", "avg_freight": "freight_value", "avg_payment_value": "payment_value",
    "avg_installments": "payment_installments", "avg_review_score": "review_score",
    "avg_delivery_days": "delivery_days", "avg_delivery_delay": "delivery_delay",
}
WEEKLY_COLUMNS = (
    f"{settled('coalesce(sum(price), 0)', 4)} AS total_revenue, count(DISTINCT order_id) AS order_count, "
    + ", ".join(f"{settled(f'avg({e})', 4)} AS {n}" for n, e in AVERAGES.items())
)
COMPLETE = " AND ".join(f"{n} IS NOT NULL" for n in AVERAGES)
WEEKLY = f"""{FEATURE_ROWS},
    grouped AS (SELECT week, {WEEKLY_COLUMNS} FROM feature_rows GROUP BY week),
    weekly AS (SELECT * FROM grouped WHERE {COMPLETE})"""
check("weekly_features", f"WITH {WEEKLY} SELECT * REPLACE ({text('week')}) FROM weekly")
PANEL = f"""{FEATURE_ROWS},
    grouped AS (SELECT week, customer_state, {WEEKLY_COLUMNS} FROM feature_rows f
                JOIN ec_customers c ON f.customer_id = c.customer_id WHERE customer_state IS NOT NULL GROUP BY ALL),
    panel AS (SELECT * FROM grouped WHERE {COMPLETE})"""
check("weekly_features_by_state", f"WITH {PANEL} SELECT * REPLACE ({text('week')}) FROM panel")
check(
    "calendar_features",
    f"""WITH {WEEKLY}
    SELECT {text('week')}, CAST(month(week + INTERVAL 6 DAY) AS INTEGER) AS month_num,
           CAST(year(week + INTERVAL 6 DAY) AS INTEGER) AS year_num,
           CAST(week(week + INTERVAL 6 DAY) AS INTEGER) AS week_num FROM weekly""",
)
check(
    "time_split",
    f"""WITH {WEEKLY}, placed AS (SELECT week, order_count, row_number() OVER (ORDER BY week) AS place FROM weekly)
    SELECT {text('week')}, order_count,
           CAST(place > (SELECT count(*) - ceil(0.2e0 * count(*)) FROM weekly) AS INTEGER) AS is_test FROM placed""",
)

TARGET = "total_revenue"
FEATURES = ["order_count", *AVERAGES, "month_num", "week_num", "year_num"]
SPLIT_WEEKS = f"""{WEEKLY}, ordered AS (SELECT *, row_number() OVER (ORDER BY week) AS place,
        lag({TARGET}) OVER (ORDER BY week) AS prediction FROM weekly),
    carried AS (SELECT *, {TARGET} - prediction AS error FROM ordered
        WHERE place > (SELECT count(*) - ceil(0.2e0 * count(*)) FROM weekly))"""
check(
    "evaluate",
    f"""WITH {SPLIT_WEEKS} SELECT round(avg(abs(error)), 4) AS mae, round(sqrt(avg(error * error)), 4) AS rmse,
    round(1 - sum(error * error) / nullif(var_pop({TARGET}) * count(*), 0), 4) AS r2 FROM carried""",
)
check(
    "residuals",
    f"""WITH {SPLIT_WEEKS} SELECT {text('week')}, round({TARGET}, 4) AS actual, round(prediction, 4) AS predicted,
    round(error, 4) AS residual FROM carried""",
)
check("train_forest", f"WITH {WEEKLY} SELECT {text('week')}, round({TARGET}, 4) AS {TARGET}, true AS within FROM weekly")
check("feature_importance", f"SELECT '[{', '.join(sorted(FEATURES))}]' AS features, 1.0e0 AS total, true AS none_below_zero")
check("score_batch", f"WITH {PANEL} SELECT {text('week')}, customer_state, true AS as_in_memory FROM panel")
check(
    "train_forest_by_state",
    f"""WITH {PANEL}, calendar AS (SELECT week, row_number() OVER (ORDER BY week) AS place, count(*) OVER () AS n
        FROM (SELECT DISTINCT week FROM panel))
    SELECT count(*) AS test_rows, true AS errors_fit FROM panel JOIN calendar USING (week) WHERE place > n - ceil(0.2e0 * n)""",
)

# --- ratings ---------------------------------------------------------------------

check("item_category", f"WITH {FULL} SELECT * FROM lines")
check("order_category", f"WITH {FULL} SELECT * FROM firsts")
check("reviews_full", f"WITH {FULL} SELECT * REPLACE ({text('review_creation_date', PURCHASED)}) FROM reviewed")


def star_share(stars: int) -> str:
    return percent(f"count(*) FILTER (WHERE review_score = {stars})", "count(*)", 4)


RATED = (
    "round(avg(review_score), 6) AS avg_rating, count(review_score) AS total_reviews,"
    f" {star_share(5)} AS pct_5star, {star_share(1)} AS pct_1star"
)
TREND = f"SELECT {MONTH} AS month, {RATED}, round(stddev_samp(review_score), 6) AS rating_std FROM reviewed GROUP BY 1"
check("monthly_rating_trend", f"WITH {FULL} {TREND}")
check("star_share_trend", f"WITH {FULL} SELECT month, pct_5star, pct_1star FROM ({TREND})")
check(
    "best_worst_month",
    f"""WITH {FULL}, m AS (SELECT {MONTH} AS month, avg(review_score) AS rating FROM reviewed GROUP BY 1),
    best AS (SELECT * FROM m ORDER BY rating DESC, month LIMIT 1),
    worst AS (SELECT * FROM m ORDER BY rating, month LIMIT 1)
    SELECT (SELECT round(avg(review_score), 6) FROM reviewed) AS overall_rating, best.month AS best_month,
           round(best.rating, 6) AS best_rating, worst.month AS worst_month, round(worst.rating, 6) AS worst_rating
    FROM best, worst""",
)
CATEGORIES = f"SELECT category, {RATED} FROM reviewed GROUP BY 1 HAVING count(review_score) >= 100"
check("category_ratings", f"WITH {FULL} {CATEGORIES}")
check(
    "category_top_bottom",
    f"""WITH {FULL}, exact AS (SELECT category, avg(review_score) AS a FROM reviewed GROUP BY 1
                               HAVING count(review_score) >= 100),
    placed AS (SELECT category, row_number() OVER (ORDER BY a DESC, category) AS down,
                      row_number() OVER (ORDER BY a, category DESC) AS up FROM exact),
    rated AS ({CATEGORIES})
    SELECT 'top' AS side, rated.* FROM rated JOIN placed USING (category) WHERE down <= 10
    UNION ALL SELECT 'bottom', rated.* FROM rated JOIN placed USING (category) WHERE up <= 10""",
)
SCORE_COLUMNS = ", ".join(f'count(*) FILTER (WHERE review_score = {s}) AS "Score_{s}"' for s in range(1, 6))
check(
    "score_by_year_pivot",
    f"WITH {FULL} SELECT CAST(year({PURCHASED}) AS INTEGER) AS year, {SCORE_COLUMNS} FROM reviewed GROUP BY 1",
)
check("score_by_month_pivot", f"WITH {FULL} SELECT {MONTH} AS month, {SCORE_COLUMNS} FROM reviewed GROUP BY 1")

# --- questions and answers -------------------------------------------------------

STATE_ORDERS = """
    SELECT customer_state, count(o.order_id) AS orders, round(coalesce(sum(price), 0), 2) AS revenue
    FROM ec_orders o JOIN ec_customers c ON o.customer_id = c.customer_id
    LEFT JOIN ec_order_items i ON o.order_id = i.order_id {where} GROUP BY 1"""
ANSWERS = {
    "state_orders_revenue": STATE_ORDERS.format(where=""),
    "orders_revenue_of_state": STATE_ORDERS.format(where="WHERE customer_state = 'NATION_7'"),
    "top_seller": """SELECT seller_id, round(r, 2) AS revenue, item_lines FROM (
        SELECT seller_id, sum(price) AS r, count(*) AS item_lines FROM ec_order_items GROUP BY 1)
        ORDER BY r DESC, seller_id LIMIT 1""",
    "seller_count": "SELECT count(*) AS seller_count FROM ec_sellers",
    "top_state": """SELECT customer_state, count(*) AS orders FROM ec_orders o
        JOIN ec_customers c ON o.customer_id = c.customer_id GROUP BY 1
        ORDER BY orders DESC, customer_state NULLS LAST LIMIT 1""",
    "total_revenue": "SELECT round(sum(price), 2) AS total_revenue FROM ec_order_items",
    "avg_item_value": "SELECT round(avg(price), 4) AS avg_item_value FROM ec_order_items",
    "rating_overview": """WITH n AS (SELECT review_score AS s, count(*) AS c FROM ec_order_reviews GROUP BY 1)
        SELECT (SELECT round(avg(review_score), 6) FROM ec_order_reviews) AS avg_score,
        (SELECT s FROM n ORDER BY s DESC LIMIT 1) AS highest_score,
        (SELECT c FROM n ORDER BY s DESC LIMIT 1) AS highest_score_reviews,
        (SELECT s FROM n ORDER BY c DESC, s LIMIT 1) AS most_common_score,
        (SELECT c FROM n ORDER BY c DESC, s LIMIT 1) AS most_common_reviews""",
    "order_count": "SELECT count(*) AS order_count FROM ec_orders",
    "repeat_customer_share": f"""WITH {PERSONS}
        SELECT count(*) FILTER (WHERE n = 1) AS one_time, count(*) FILTER (WHERE n > 1) AS repeat_buyers,
        count(*) AS total_persons, {percent('count(*) FILTER (WHERE n > 1)', 'count(*)')} AS repeat_pct FROM persons""",
    "customer_count": "SELECT count(DISTINCT customer_id) AS customer_count FROM ec_customers",
    "cancellation_share": f"""SELECT count(*) FILTER (WHERE order_status = 'canceled') AS cancelled,
        count(*) AS total_orders,
        {percent("count(*) FILTER (WHERE order_status = 'canceled')", 'count(*)')} AS cancel_pct FROM ec_orders""",
    "top_payment_type": f"""SELECT payment_type, n AS transactions,
        {percent('n', '(SELECT count(*) FROM ec_order_payments)')} AS share_pct
        FROM (SELECT payment_type, count(*) AS n FROM ec_order_payments GROUP BY 1) ORDER BY n DESC, payment_type LIMIT 1""",
    "category_count": "SELECT count(DISTINCT product_category_name) AS category_count FROM ec_products",
    "product_count": "SELECT count(*) AS product_count FROM ec_products",
}
for best, order in (("best_category", "DESC NULLS FIRST"), ("worst_category", "ASC NULLS LAST")):
    ANSWERS[best] = f"""SELECT product_category_name, round(a, 6) AS avg_score, reviews FROM (
        SELECT p.product_category_name, avg(r.review_score) AS a, count(*) AS reviews FROM ec_order_reviews r
        JOIN ec_order_items i ON r.order_id = i.order_id JOIN ec_products p ON i.product_id = p.product_id
        GROUP BY 1 HAVING count(*) >= 50) ORDER BY a {order}, product_category_name NULLS LAST LIMIT 1"""
for answer_name, answer in ANSWERS.items():
    check(answer_name, answer)


# The question rules as the answers define them, written out here on their own.
CODED = (
    "'SP', 'RJ', 'MG', 'RS', 'PR', 'SC', 'BA', 'DF', 'ES', 'GO', 'PE', 'CE', 'PA', 'MT', "
    "'MA', 'MS', 'PB', 'PI', 'RN', 'AL', 'SE', 'TO', 'RO', 'AM', 'AC', 'AP', 'RR'"
)
STATE_OF = f"""list_filter([{CODED}], lambda c:
    contains(' ' || upper(q) || ' ', ' ' || c || ' ') OR ends_with(upper(q), c))[1]"""
ABOUT_STATE = "regexp_matches(q, 'order|revenue|sales')"
MANY = "regexp_matches(q, 'how many|total|number of')"
INTENT_CASE = f"""CASE
    WHEN s IS NOT NULL AND {ABOUT_STATE} THEN 'state_orders_revenue'
    WHEN contains(q, 'top') AND contains(q, 'seller') THEN 'top_seller'
    WHEN contains(q, 'seller') AND {MANY} THEN 'seller_count'
    WHEN contains(q, 'state') AND regexp_matches(q, 'most|top|highest') THEN 'top_state'
    WHEN regexp_matches(q, 'total revenue|how much revenue') OR contains(q, 'revenue') AND contains(q, 'total') THEN 'total_revenue'
    WHEN regexp_matches(q, 'average order|avg order value') THEN 'avg_item_value'
    WHEN regexp_matches(q, 'rating|review') THEN 'rating_overview'
    WHEN contains(q, 'order') AND contains(q, 'how many') OR regexp_matches(q, 'total orders|number of orders') THEN 'order_count'
    WHEN contains(q, 'repeat') AND contains(q, 'customer') THEN 'repeat_customer_share'
    WHEN contains(q, 'customer') AND {MANY} THEN 'customer_count'
    WHEN regexp_matches(q, 'delivery|delay|shipping time') THEN 'avg_delivery_days'
    WHEN contains(q, 'cancel') THEN 'cancellation_share'
    WHEN contains(q, 'payment') THEN 'top_payment_type'
    WHEN contains(q, 'category') AND regexp_matches(q, 'best|top|highest rated') THEN 'best_category'
    WHEN contains(q, 'category') AND regexp_matches(q, 'worst|lowest') THEN 'worst_category'
    WHEN contains(q, 'category') AND regexp_matches(q, 'how many|number of') THEN 'category_count'
    WHEN regexp_matches(q, 'high value|segment|rfm') THEN 'segment_counts'
    WHEN contains(q, 'product') AND {MANY} THEN 'product_count'
    WHEN regexp_matches(q, 'csv|dataset|how many files|about this project|about the project') THEN 'dataset'
    WHEN regexp_replace(q, '^\\s+|\\s+$', '', 'g') IN ('hi', 'hello', 'hey', 'hi there', 'hello there') THEN 'greeting'
    ELSE 'fallback' END"""
TAGGED = f"""asked AS (SELECT conv_id, turn, lower(coalesce(text, '')) AS q FROM conversations WHERE role = 'user'),
    located AS (SELECT *, {STATE_OF} AS s FROM asked),
    tagged AS (SELECT conv_id, turn, {INTENT_CASE} AS intent, CASE WHEN {ABOUT_STATE} THEN s END AS state FROM located)"""
check("tag_questions", f"WITH {TAGGED} SELECT intent, state, count(*) AS questions FROM tagged GROUP BY ALL")

METRICS = {
    "top_seller": ("seller_id", ["revenue", "item_lines"]),
    "seller_count": (None, ["seller_count"]),
    "top_state": ("customer_state", ["orders"]),
    "total_revenue": (None, ["total_revenue"]),
    "avg_item_value": (None, ["avg_item_value"]),
    "rating_overview": (
        None,
        ["avg_score", "highest_score", "highest_score_reviews", "most_common_score", "most_common_reviews"],
    ),
    "order_count": (None, ["order_count"]),
    "repeat_customer_share": (None, ["one_time", "repeat_buyers", "total_persons", "repeat_pct"]),
    "customer_count": (None, ["customer_count"]),
    "avg_delivery_days": (None, ["avg_delivery_days"]),
    "cancellation_share": (None, ["cancelled", "total_orders", "cancel_pct"]),
    "top_payment_type": ("payment_type", ["transactions", "share_pct"]),
    "best_category": ("product_category_name", ["avg_score", "reviews"]),
    "worst_category": ("product_category_name", ["avg_score", "reviews"]),
    "category_count": (None, ["category_count"]),
    "product_count": (None, ["product_count"]),
    "segment_counts": ("segment", ["customers"]),
}
ANSWER_SQL = ANSWERS | {
    "segment_counts": f"WITH {GRADED} {SEGMENT_SIZES}",
    "avg_delivery_days": f"SELECT round(avg({trunc_days(DELIVERED, PURCHASED)}), 6) AS avg_delivery_days FROM ec_orders"
}
METRIC_ROWS = " UNION ALL ".join(
    [
        f"SELECT 'state_orders_revenue' AS intent, customer_state AS state, '{m}' AS metric,"
        f" CAST(NULL AS VARCHAR) AS label, CAST({m} AS DOUBLE) AS value"
        f" FROM ({ANSWERS['state_orders_revenue']}) WHERE customer_state IS NOT NULL"
        f" UNION ALL SELECT 'state_orders_revenue', code, '{m}', CAST(NULL AS VARCHAR), 0.0"
        f" FROM (SELECT unnest([{CODED}]) AS code) WHERE code NOT IN"
        f" (SELECT customer_state FROM ec_customers WHERE customer_state IS NOT NULL)"
        for m in ("orders", "revenue")
    ]
    + [
        f"SELECT '{intent}', CAST(NULL AS VARCHAR), '{m}', CAST({label or 'NULL'} AS VARCHAR),"
        f" round(CAST({m} AS DOUBLE), 4) FROM ({ANSWER_SQL[intent]})"
        for intent, (label, metrics) in METRICS.items()
        for m in metrics
    ]
)
check("answer_metrics", METRIC_ROWS)
check(
    "answer_questions",
    f"""WITH {TAGGED}, metrics AS ({METRIC_ROWS})
    SELECT t.conv_id, t.turn, t.intent, t.state, m.metric, m.label, m.value FROM tagged t LEFT JOIN metrics m
    ON t.intent IS NOT DISTINCT FROM m.intent AND t.state IS NOT DISTINCT FROM m.state""",
)

# --- streams ---------------------------------------------------------------------

check(
    "live_kpis",
    f"""SELECT (SELECT count(*) FROM ec_orders) AS total_orders,
        (SELECT round(sum(price), 4) FROM ec_order_items) AS total_revenue,
        (SELECT round(avg(review_score), 4) FROM ec_order_reviews) AS avg_rating,
        (SELECT round(avg({floor_days(DELIVERED, PURCHASED)}), 4) FROM ec_orders) AS avg_delivery_days""",
)
check(
    "live_order_volume",
    f"""
    WITH w AS (SELECT time_bucket(INTERVAL 7 DAY, {PURCHASED}, TIMESTAMP '1970-01-01') AS s, order_id FROM ec_orders),
    counted AS (SELECT s, s + INTERVAL 7 DAY AS e, count(DISTINCT order_id) AS orders FROM w GROUP BY 1)
    SELECT CAST(s AS VARCHAR) AS window_start, CAST(e AS VARCHAR) AS window_end, orders FROM counted
    WHERE s IS NOT NULL""",
)
