"""The retail tables expressed over a generic order star schema.

Maps ``region nation customer supplier part orders lineitem conversations`` Parquet
tables to the retail tables of ``schemas.py``.  Every expression is plain SQL that
reads the same in any engine, so a second engine can check results over one mapping.

``VIEWS`` are tables as cleaning would leave them, ``RAW_VIEWS`` the same rows as they
arrive: every row twice (a repeated delivery), text timestamps, missing cells.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tradewind.functions.shaping import ROW_ORDER

BASE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

VIEWS = {
    "customers": """
        SELECT o.o_orderkey AS customer_id, o.o_custkey AS customer_unique_id,
               c.c_mktsegment AS customer_city,
               CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE n.n_name END AS customer_state
        FROM {orders} o
        JOIN {customer} c ON o.o_custkey = c.c_custkey
        JOIN {nation} n ON c.c_nationkey = n.n_nationkey""",
    "orders": """
        SELECT o_orderkey AS order_id, o_orderkey AS customer_id,
               CASE WHEN o_orderkey % 31 = 0 THEN 'canceled'
                    WHEN o_orderstatus = 'P' THEN 'shipped' ELSE 'delivered' END AS order_status,
               o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 24) AS order_purchase_timestamp,
               o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 24 + 2) AS order_approved_at,
               o_orderdate + INTERVAL '1' DAY * (o_custkey % 3 + 1) AS order_delivered_carrier_date,
               CASE WHEN o_orderkey % 17 = 0 THEN NULL
                    ELSE o_orderdate + INTERVAL '1' DAY * (o_custkey * 13 % 40)
                         + INTERVAL '1' HOUR * (o_orderkey * 7 % 24) + INTERVAL '1' DAY
               END AS order_delivered_customer_date,
               o_orderdate + INTERVAL '1' DAY * 25 AS order_estimated_delivery_date
        FROM {orders}""",
    "order_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, l_extendedprice AS price, l_extendedprice * l_tax AS freight_value
        FROM {lineitem}""",
    "order_payments": """
        SELECT o_orderkey AS order_id, 1 AS payment_sequential,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'boleto'
                    WHEN '3-MEDIUM' THEN 'debit_card' ELSE 'voucher' END AS payment_type,
               1 + o_custkey % 10 AS payment_installments,
               CASE WHEN o_orderkey % 101 = 0 THEN 0.0E0 ELSE o_totalprice END AS payment_value
        FROM {orders}
        UNION ALL
        SELECT o_orderkey, 2, 'voucher', 1, o_totalprice * 0.1E0
        FROM {orders} WHERE o_orderpriority = '5-LOW'""",
    "order_reviews": """
        SELECT o_orderkey AS review_id, o_orderkey AS order_id,
               1 + (o_orderkey * 7 + o_custkey * 3) % 5 AS review_score,
               CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS review_comment_title,
               CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderstatus END AS review_comment_message,
               o_orderdate + INTERVAL '1' DAY * 30 AS review_creation_date,
               o_orderdate + INTERVAL '1' DAY * 32 AS review_answer_timestamp
        FROM {orders} WHERE o_orderstatus <> 'P'""",
    "products": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE p_brand END AS product_category_name,
               CAST(length(p_name) AS DOUBLE) AS product_name_lenght,
               CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE CAST(length(p_name) * 7 AS DOUBLE) END
                    AS product_description_lenght,
               CAST(p_size % 6 AS DOUBLE) AS product_photos_qty,
               CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_retailprice END AS product_weight_g,
               CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS product_length_cm,
               CAST(p_size + 3 AS DOUBLE) AS product_height_cm,
               CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE CAST(p_size * 2 AS DOUBLE) END AS product_width_cm
        FROM {part}""",
    "sellers": """
        SELECT s.s_suppkey AS seller_id, r.r_name AS seller_city, n.n_name AS seller_state
        FROM {supplier} s
        JOIN {nation} n ON s.s_nationkey = n.n_nationkey
        JOIN {region} r ON n.n_regionkey = r.r_regionkey""",
    "product_category_translation": """
        SELECT DISTINCT p_brand AS product_category_name, concat('EN_', p_brand) AS product_category_name_english
        FROM {part} WHERE p_brand <> 'Brand#4'""",
    "geolocation": """
        SELECT n.n_nationkey AS geolocation_zip_code_prefix, r.r_name AS geolocation_city,
               n.n_name AS geolocation_state
        FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey""",
}


def _text_dates(columns: list[str], broken: str) -> str:
    return ", ".join(
        f"CASE WHEN {broken} THEN 'not a date' ELSE CAST({c} AS VARCHAR(30)) END AS {c}" if i == 0
        else f"CAST({c} AS VARCHAR(30)) AS {c}"
        for i, c in enumerate(columns)
    )


def _twice(select: str, changed: str, view: str) -> str:
    """Each row of a view twice: as it is, and again with a changed payload."""
    return f"""
        SELECT {select}, 0 AS {ROW_ORDER} FROM {{{view}}}
        UNION ALL
        SELECT {changed}, 1 AS {ROW_ORDER} FROM {{{view}}}"""


_ORDER_DATES = _text_dates(
    ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
     "order_delivered_customer_date", "order_estimated_delivery_date"],
    "order_id % 41 = 0",
)
_REVIEW_DATES = _text_dates(["review_creation_date", "review_answer_timestamp"], "review_id % 43 = 0")
_MEASURES = (
    "product_name_lenght, product_description_lenght, product_photos_qty, product_weight_g,"
    " product_length_cm, product_height_cm, product_width_cm"
)

RAW_VIEWS = {
    "raw_customers": _twice(
        "customer_id, customer_unique_id, customer_city, customer_state",
        "customer_id, customer_unique_id, 'elsewhere', NULL",
        "customers",
    ),
    "raw_orders": _twice(
        f"order_id, customer_id, order_status, {_ORDER_DATES}",
        f"order_id, customer_id, 'created', {_ORDER_DATES}",
        "orders",
    ),
    "raw_order_items": "\n        SELECT * FROM {order_items} UNION ALL SELECT * FROM {order_items}",
    "raw_order_payments": "\n        SELECT * FROM {order_payments} UNION ALL SELECT * FROM {order_payments}",
    "raw_order_reviews": _twice(
        f"review_id, order_id, review_score, review_comment_title, review_comment_message, {_REVIEW_DATES}",
        f"review_id, order_id, 6 - review_score, 'again', NULL, {_REVIEW_DATES}",
        "order_reviews",
    ),
    "raw_products": _twice(
        f"product_id, product_category_name, {_MEASURES}",
        f"product_id, 'other', {_MEASURES}",
        "products",
    ),
}

_ALL = {**VIEWS, **RAW_VIEWS}


def _inputs(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", sql)))


def _prefixed(name: str) -> str:
    return f"ec_{name}"


def _is_base(view: str, name: str) -> bool:
    """The star table `orders` and the retail view `orders` share a name."""
    return name in BASE_SCHEMAS and view in VIEWS


class StarRetail:
    """Retail tables over one folder of star-schema Parquet tables (all lazy)."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder.rstrip("/")
        self._views: dict[str, DataFrame] = {}

    @property
    def spark(self) -> SparkSession:
        return self._spark

    def path(self, name: str) -> str:
        """Where a star-schema table lies."""
        return f"{self._folder}/{name}.parquet"

    def base(self, name: str) -> DataFrame:
        """A star-schema table."""
        key = f"base.{name}"
        if key not in self._views:
            reader = self._spark.read.schema(BASE_SCHEMAS[name])
            self._views[key] = reader.parquet(self.path(name))
        return self._views[key]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._views:
            sql = _ALL[name]
            frames = {n: self.base(n) if _is_base(name, n) else self[n] for n in _inputs(sql)}
            self._views[name] = self._spark.sql(sql, **frames)
        return self._views[name]

    def all(self, prefix: str = "") -> dict[str, DataFrame]:
        """Tables by retail name; ``prefix='raw_'`` gives the rows as they arrive."""
        names = RAW_VIEWS if prefix else VIEWS
        return {n.removeprefix(prefix): self[n] for n in names}


def over_star(spark: SparkSession, view: str, **frames: DataFrame) -> DataFrame:
    """A retail view over given star-schema frames, which may be streams."""
    return spark.sql(VIEWS[view], **frames)


def with_views(sql: str) -> str:
    """SQL text over ``ec_*`` names, completed with the view definitions it uses."""
    needed: list[str] = []

    def visit(name: str) -> None:
        if name in needed:
            return
        for n in _inputs(_ALL[name]):
            if not _is_base(name, n):
                visit(n)
        needed.append(name)

    for name in re.findall(r"\bec_(\w+)\b", sql):
        visit(name)
    if not needed:
        return sql
    ctes = []
    for name in needed:
        names = {n: n if _is_base(name, n) else _prefixed(n) for n in _inputs(_ALL[name])}
        ctes.append(f"{_prefixed(name)} AS ({_ALL[name].format(**names)})")
    head = "WITH " + ",\n".join(ctes)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"{head},\n{body[5:]}"
    return f"{head}\n{body}"
