"""Declared schemas of the landed files, so that no read has to infer types."""

# Raw commerce CSV files. Timestamps and numbers that may be dirty stay text and are parsed later.
RAW_CUSTOMERS = (
    "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
    "customer_city string, customer_state string"
)
RAW_SELLERS = (
    "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string"
)
RAW_PRODUCTS = (
    "product_id string, product_category_name string, product_weight_g string, "
    "product_length_cm string, product_height_cm string, product_width_cm string"
)
RAW_TRANSLATIONS = "product_category_name string, product_category_name_english string"
RAW_ORDERS = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
    "order_approved_at string, order_delivered_customer_date string, "
    "order_estimated_delivery_date string"
)
RAW_ORDER_ITEMS = (
    "order_id string, order_item_id int, product_id string, seller_id string, "
    "shipping_limit_date string, price decimal(12,2), freight_value decimal(12,2)"
)
RAW_PAYMENTS = (
    "order_id string, payment_sequential int, payment_type string, payment_installments int, "
    "payment_value decimal(12,2)"
)
RAW_REVIEWS = (
    "review_id string, order_id string, review_score int, review_comment_message string, "
    "review_creation_date string"
)
RAW_GEOLOCATION = (
    "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
    "geolocation_city string, geolocation_state string"
)

# Schemas of files whose values may hold line breaks; such files cannot be split.
LINE_BREAKS = frozenset({RAW_REVIEWS})

# Daily weather response: parallel arrays, one entry per day.
WEATHER_PAYLOAD = (
    "daily struct<time: array<string>, temperature_2m_max: array<double>, "
    "temperature_2m_min: array<double>, precipitation_sum: array<double>, "
    "windspeed_10m_max: array<double>, weather_code: array<double>>"
)

# Exchange rate responses: nested by date, a list of daily objects, or a flat date map.
FX_NESTED_PAYLOAD = "rates map<string, map<string, double>>"
FX_LIST_PAYLOAD = "array<struct<date: string, base: string, quote: string, rate: double>>"
FX_FLAT_PAYLOAD = "map<string, double>"

# Append-only log of check results.
QUALITY_LOG = (
    "check_id string, run_at timestamp, check_name string, table_name string, "
    "check_category string, severity string, status string, expected_value string, "
    "actual_value string, rows_affected bigint, message string, check_metadata string"
)
RUN_HISTORY = (
    "run_id string, stage string, status string, rows_processed bigint, duration_seconds double, "
    "started_at timestamp, error string"
)
