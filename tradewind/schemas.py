"""Columns and types of the retail tables.

Orders and reviews arrive with text timestamps; cleaning turns the columns listed in
``ORDER_DATES`` and ``REVIEW_DATES`` into zone-less timestamps.
"""

from __future__ import annotations

ORDER_DATES = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]
REVIEW_DATES = ["review_creation_date", "review_answer_timestamp"]
# the first two keep the spelling of the source files
# Column names of the source, spelled as there.
PRODUCT_MEASURES = [
    "product_name_lenght",
    "product_description_lenght",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
]

# their cells may hold line breaks
FREE_TEXT_TABLES = {"order_reviews"}

# column definitions as the CSV files have them
RAW_SCHEMAS: dict[str, str] = {
    "customers": (
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string,"
        " customer_city string, customer_state string"
    ),
    "geolocation": (
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double,"
        " geolocation_city string, geolocation_state string"
    ),
    "orders": (
        "order_id string, customer_id string, order_status string," + ",".join(f" {c} string" for c in ORDER_DATES)
    ),
    "order_items": (
        "order_id string, order_item_id bigint, product_id string, seller_id string,"
        " shipping_limit_date string, price double, freight_value double"
    ),
    "order_payments": (
        "order_id string, payment_sequential bigint, payment_type string,"
        " payment_installments bigint, payment_value double"
    ),
    "order_reviews": (
        "review_id string, order_id string, review_score bigint, review_comment_title string,"
        " review_comment_message string," + ",".join(f" {c} string" for c in REVIEW_DATES)
    ),
    "products": (
        "product_id string, product_category_name string," + ",".join(f" {c} double" for c in PRODUCT_MEASURES)
    ),
    "sellers": (
        "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string"
    ),
    "product_category_translation": (
        "product_category_name string, product_category_name_english string"
    ),
}

TABLES = sorted(RAW_SCHEMAS)
