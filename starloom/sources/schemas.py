"""Fixed schemas of the nine source extracts.

Zip prefixes are strings (an inferred int loses the leading zero of 01001);
source timestamps carry no zone, so they are ``timestamp_ntz``.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _D, _TS = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampNTZType()
#: Money: sums are exact and do not depend on order or partitions.
_M = T.DecimalType(18, 2)


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


ORDERS = _st(("order_id", _S), ("customer_id", _S), ("order_status", _S),
             ("order_purchase_timestamp", _TS), ("order_approved_at", _TS),
             ("order_delivered_carrier_date", _TS), ("order_delivered_customer_date", _TS),
             ("order_estimated_delivery_date", _TS))

ORDER_REVIEWS = _st(("review_id", _S), ("order_id", _S), ("review_score", _I),
                    ("review_comment_title", _S), ("review_comment_message", _S),
                    ("review_creation_date", _TS), ("review_answer_timestamp", _TS))

CUSTOMERS = _st(("customer_id", _S), ("customer_unique_id", _S),
                ("customer_zip_code_prefix", _S), ("customer_city", _S), ("customer_state", _S))

# The source spells "lenght" this way; the names are part of the schema.
PRODUCTS = _st(("product_id", _S), ("product_category_name", _S),
               ("product_name_lenght", _I), ("product_description_lenght", _I),
               ("product_photos_qty", _I), ("product_weight_g", _D),
               ("product_length_cm", _D), ("product_height_cm", _D), ("product_width_cm", _D))

CATEGORY_TRANSLATION = _st(("product_category_name", _S), ("product_category_name_english", _S))

SELLERS = _st(("seller_id", _S), ("seller_zip_code_prefix", _S), ("seller_city", _S),
              ("seller_state", _S))

ORDER_PAYMENTS = _st(("order_id", _S), ("payment_sequential", _I), ("payment_type", _S),
                     ("payment_installments", _I), ("payment_value", _M))

ORDER_ITEMS = _st(("order_id", _S), ("order_item_id", _I), ("product_id", _S), ("seller_id", _S),
                  ("shipping_limit_date", _TS), ("price", _M), ("freight_value", _M))

GEOLOCATION = _st(("geolocation_zip_code_prefix", _S), ("geolocation_lat", _D),
                  ("geolocation_lng", _D), ("geolocation_city", _S), ("geolocation_state", _S))

SCHEMAS = {
    "orders": ORDERS,
    "order_reviews": ORDER_REVIEWS,
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "category_translation": CATEGORY_TRANSLATION,
    "sellers": SELLERS,
    "order_payments": ORDER_PAYMENTS,
    "order_items": ORDER_ITEMS,
    "geolocation": GEOLOCATION,
}

# Sources a star can be built without.
OPTIONAL_SOURCES = ("category_translation", "geolocation")

# Default extract file names: ``<source>.csv`` (also ``<source>_2.csv`` and so
# on, see ``readers.extract_files``).  Pass ``file_names`` to ``load_sources``
# for extracts named otherwise.
FILE_NAMES = {name: f"{name}.csv" for name in SCHEMAS}
