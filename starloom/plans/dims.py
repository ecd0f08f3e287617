"""Dimension builders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import calendar_columns, date_id
from starloom.functions.text import title_case, upper_case
from starloom.operators.casts import narrow_key
from starloom.operators.keys import dense_key, keep_existing_keys, keep_first
from starloom.operators.lookups import (broadcast_bounded, known_bytes, known_rows, known_top, remember_bytes,
                                       remember_rows, remember_top)
from starloom.operators.members import INFERRED, with_inferred, with_unknown
from starloom.operators.registry import RETIRED, registered_keys

# The timestamp columns that feed the date dimension, per source.
ORDER_DATE_COLUMNS = ["order_purchase_timestamp", "order_approved_at",
                      "order_delivered_carrier_date", "order_delivered_customer_date",
                      "order_estimated_delivery_date"]
REVIEW_DATE_COLUMNS = ["review_creation_date", "review_answer_timestamp"]
ITEM_DATE_COLUMNS = ["shipping_limit_date"]

# The columns of the published date dimension, in their order.
DIM_DATE_COLUMNS = ["date_id", "date", "year", "quarter", "month", "month_name", "day",
                    "weekday", "weekday_name", "is_weekend"]


def date_sources(sources: dict[str, DataFrame], include_shipping: bool = True) -> list[tuple[DataFrame, list[str]]]:
    """(frame, timestamp columns) pairs that feed the date dimension."""
    pairs = [(sources["orders"], ORDER_DATE_COLUMNS)]
    if "order_reviews" in sources:
        pairs.append((sources["order_reviews"], REVIEW_DATE_COLUMNS))
    if include_shipping and "order_items" in sources:
        pairs.append((sources["order_items"], ITEM_DATE_COLUMNS))
    return pairs


def build_dim_date(sources: dict[str, DataFrame], grain: str = "day",
                   include_shipping: bool = True) -> DataFrame:
    """B1: one row per distinct date (``grain="day"``, the default) or per
    distinct timestamp (``grain="timestamp"``, the literal behaviour, whose
    date_id is not unique).

    Each source is scanned once: its date columns are stacked with
    ``explode(array(...))``, reduced to dates first, and the distinct is
    combined map-side, so only a few thousand values reach the shuffle.
    """
    return build_dim_date_from(date_sources(sources, include_shipping), grain)


def build_dim_date_from(pairs: list[tuple[DataFrame, list[str]]], grain: str = "day") -> DataFrame:
    """B1 over any (frame, timestamp columns) pairs."""
    if grain not in ("day", "timestamp"):
        raise ValueError("grain must be 'day' or 'timestamp'")
    conv = F.to_date if grain == "day" else (lambda c: c)
    parts = [df.select(F.explode(F.array(*[conv(F.col(c)) for c in cols])).alias("date"))
             for df, cols in pairs]
    values = reduce(DataFrame.union, parts).where(F.col("date").isNotNull()).distinct()
    return values.select(date_id("date").alias("date_id"), "date",
                         *[v.alias(k) for k, v in calendar_columns("date").items()])


def assign_keys(members: DataFrame, natural_key: str, key_name: str, num_buckets=None,
                previous: DataFrame | None = None) -> DataFrame:
    """Dense keys in natural-key order, or, given the previous version of the
    dimension or its key registry, its keys for known members and new keys
    after its maximum."""
    if previous is None:
        return dense_key(members, natural_key, key_name, num_buckets=num_buckets)
    if RETIRED in previous.columns:
        return registered_keys(members, previous, natural_key, key_name, num_buckets=num_buckets)
    return keep_existing_keys(members, previous, natural_key, key_name, num_buckets=num_buckets)


def _same_rows(src: DataFrame, out: DataFrame) -> DataFrame:
    """``out`` is a projection of ``src``: same rows, same remembered count and keys."""
    return remember_bytes(remember_top(remember_rows(out, known_rows(src)), known_top(src)), known_bytes(src))


def _members(first: DataFrame, natural_key: str, used) -> DataFrame:
    return first if used is None else with_inferred(first, natural_key, used)


def _with_unknown(dim: DataFrame, key_name: str, used) -> DataFrame:
    return dim if used is None else with_unknown(dim, key_name)


def _flag(used) -> list[str]:
    return [] if used is None else [INFERRED]


def _geo_dim(df: DataFrame, prefix: str, key_name: str, num_buckets=None,
             previous: DataFrame | None = None, used: list[DataFrame] | None = None) -> DataFrame:
    nk = f"{prefix}_id"
    first = _members(keep_first(df, nk), nk, used)
    keyed = assign_keys(first, nk, key_name, num_buckets, previous)
    return _same_rows(keyed, keyed.withColumns({f"{prefix}_city": title_case(f"{prefix}_city"),
                                                f"{prefix}_state": upper_case(f"{prefix}_state")}))


def build_dim_customers(customers: DataFrame, num_buckets=None,
                        previous: DataFrame | None = None, used: list[DataFrame] | None = None) -> DataFrame:
    """B2: one row per customer_id (first by the other columns), dense key in
    customer_id order, city in title case, state upper case.  ``previous``
    (the last published dimension) keeps existing keys stable.  ``used``
    (frames of the keys that facts use) adds inferred members for those that
    have no row, the unknown member, and the column that flags them."""
    keyed = _geo_dim(customers, "customer", "customer_sk", num_buckets, previous, used)
    return _with_unknown(_same_rows(keyed, keyed.select(narrow_key(keyed, "customer_sk"), "customer_id",
                        "customer_unique_id", "customer_zip_code_prefix", "customer_city",
                        "customer_state", *_flag(used))), "customer_sk", used)


def build_dim_seller(sellers: DataFrame, num_buckets=None,
                     previous: DataFrame | None = None, used: list[DataFrame] | None = None) -> DataFrame:
    """As customers, for sellers."""
    keyed = _geo_dim(sellers, "seller", "seller_sk", num_buckets, previous, used)
    return _with_unknown(_same_rows(keyed, keyed.select(narrow_key(keyed, "seller_sk"), "seller_id",
                        "seller_zip_code_prefix", "seller_city", "seller_state", *_flag(used))), "seller_sk", used)


# The measures of a product, in the order of the published table.
PRODUCT_MEASURES = ["product_name_lenght", "product_description_lenght", "product_photos_qty",
                    "product_weight_g", "product_length_cm", "product_height_cm",
                    "product_width_cm"]


def build_dim_products(products: DataFrame, translation: DataFrame | None = None,
                       unknown: str = "unknown", num_buckets=None,
                       translation_max_rows: int = 100_000,
                       previous: DataFrame | None = None, used: list[DataFrame] | None = None) -> DataFrame:
    """Products with the English category name (``unknown`` when the
    category is null or untranslated), one row per product_id, dense key.
    ``used`` as in ``build_dim_customers``."""
    if translation is not None:
        tr = keep_first(translation.select("product_category_name",
                                           "product_category_name_english"),
                        "product_category_name")
        # a known row count of the input bounds the deduplicated side
        enriched = products.join(broadcast_bounded(tr, translation_max_rows,
                                                   rows=known_rows(translation),
                                                   text_bytes=known_bytes(translation)),
                                 "product_category_name", "left")
    else:
        enriched = products.withColumn("product_category_name_english", F.lit(None).cast("string"))
    enriched = enriched.withColumn("product_category_name_english",
                                   F.coalesce("product_category_name_english", F.lit(unknown)))
    first = _members(keep_first(enriched, "product_id"), "product_id", used)
    keyed = assign_keys(first, "product_id", "product_sk", num_buckets, previous)
    out = _with_unknown(_same_rows(keyed, keyed.select(narrow_key(keyed, "product_sk"), "product_id",
                        "product_category_name", "product_category_name_english",
                        *PRODUCT_MEASURES, *_flag(used))), "product_sk", used)
    if used is None:
        return out
    return _same_rows(out, out.withColumn("product_category_name_english",
                                          F.coalesce("product_category_name_english", F.lit(unknown))))


def build_dim_payments(payments: DataFrame, num_buckets=None,
                       previous: DataFrame | None = None) -> DataFrame:
    """Distinct payment types, dense key in type order."""
    types = payments.select("payment_type").distinct()
    keyed = assign_keys(types, "payment_type", "payment_sk", num_buckets, previous)
    return _same_rows(keyed, keyed.select("payment_type",
                                          narrow_key(keyed, "payment_sk")))
