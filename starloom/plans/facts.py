"""Fact builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import floor_days
from starloom.operators.lookups import date_key, exact_date_keys, lookup_key

# The date keys of the published order fact, and the column each is of.
ORDER_DATE_KEYS = {
    "purchase_date_id": "order_purchase_timestamp",
    "approved_date_id": "order_approved_at",
    "delivered_carrier_date_id": "order_delivered_carrier_date",
    "delivered_customer_date_id": "order_delivered_customer_date",
    "estimated_delivery_date_id": "order_estimated_delivery_date",
}


def delivery_performance(delivered: Column, delay_days: Column) -> Column:
    """Early / on_time / late from delay_days; undelivered when there is
    no delivery time; unknown when there is no estimate to compare with."""
    return (F.when(delivered.isNull(), F.lit("undelivered"))
             .when(delay_days.isNull(), F.lit("unknown"))
             .when(delay_days < 0, F.lit("early"))
             .when(delay_days == 0, F.lit("on_time"))
             .otherwise(F.lit("late")))


def _date_keys(df: DataFrame, mapping: dict[str, str], dim_date: DataFrame | None,
               date_lookup: str) -> DataFrame:
    if date_lookup == "computed":
        return date_key(df, mapping)
    if date_lookup != "exact" or dim_date is None:
        raise ValueError("date_lookup='exact' needs dim_date")
    return exact_date_keys(df, mapping, dim_date)


def build_fact_orders(orders: DataFrame, dim_customers: DataFrame | None, null_safe: bool = False,
                      date_lookup: str = "computed", dim_date: DataFrame | None = None,
                      unknown_key: int | None = None) -> DataFrame:
    """Orders with customer_sk (null, or ``unknown_key``, when absent), five
    date keys, floored delivery and delay days and a delivery class.  Every
    other order column passes through.  Without ``dim_customers`` the fact has
    no customer_sk, and no join."""
    raw = [c for c in orders.columns if c != "customer_id"]
    f = orders
    if dim_customers is not None:
        f = lookup_key(f, dim_customers, "customer_id", "customer_sk", null_safe=null_safe, unknown=unknown_key)
        f = f.withColumn("customer_sk", _typed("customer_sk", dim_customers))
    f = _date_keys(f, ORDER_DATE_KEYS, dim_date, date_lookup)
    delivered = F.col("order_delivered_customer_date")
    f = f.withColumns({
        "delivery_days": floor_days(delivered, "order_purchase_timestamp"),
        "delay_days": floor_days(delivered, "order_estimated_delivery_date"),
    })
    f = f.withColumn("delivery_performance", delivery_performance(delivered, F.col("delay_days")))
    return f.select(*raw, *(["customer_sk"] if dim_customers is not None else []), *ORDER_DATE_KEYS, "delivery_days", "delay_days",
                    "delivery_performance")


def _typed(key: str, dim: DataFrame) -> Column:
    """The key in the type its dimension publishes (proven there to fit)."""
    return F.col(key).cast(dim.schema[key].dataType).alias(key)


def build_fact_order_items(items: DataFrame, dim_products: DataFrame | None, dim_seller: DataFrame | None,
                           unknown_key: int = 0, null_safe: bool = False,
                           date_lookup: str = "computed",
                           dim_date: DataFrame | None = None) -> DataFrame:
    """Items with product_sk / seller_sk (``unknown_key`` when absent),
    shipping date key, and item_total = price + freight_value.  A dimension
    that is not given is not looked up, and its key is no column."""
    f = _date_keys(items, {"shipping_limit_date_id": "shipping_limit_date"}, dim_date, date_lookup)
    looked_up = [(d, nk, sk) for d, nk, sk in ((dim_products, "product_id", "product_sk"), (dim_seller, "seller_id", "seller_sk"))
                 if d is not None]
    for dim, nk, sk in looked_up:
        f = lookup_key(f, dim, nk, sk, unknown=unknown_key, null_safe=null_safe)
    f = f.withColumn("item_total", F.col("price") + F.col("freight_value"))
    return f.select("order_id", "order_item_id", *[_typed(sk, dim) for dim, _, sk in looked_up], "shipping_limit_date_id",
                    "price", "freight_value", "item_total")


def build_fact_payments(payments: DataFrame, dim_payments: DataFrame | None,
                        null_safe: bool = False) -> DataFrame:
    """Payments with payment_sk (if ``dim_payments`` is given) and the installment flag."""
    f, key = payments, []
    if dim_payments is not None:
        f, key = lookup_key(f, dim_payments, "payment_type", "payment_sk", null_safe=null_safe), ["payment_sk"]
    return f.select("order_id", *key, "payment_installments", "payment_value",
                    (F.col("payment_installments") > 1).alias("is_installment"))


def build_fact_reviews(reviews: DataFrame, literal: bool = False, date_lookup: str = "computed",
                       dim_date: DataFrame | None = None) -> DataFrame:
    """Reviews with creation/answer date keys next to the timestamps.

    ``literal=True`` reproduces the original shape, where the two timestamp
    columns are overwritten by their date ids under the old names (D12).
    """
    keys = {"creation_date_id": "review_creation_date", "answer_date_id": "review_answer_timestamp"}
    f = _date_keys(reviews, keys, dim_date, date_lookup)
    base = ["review_id", "order_id", "review_score", "review_comment_title",
            "review_comment_message"]
    if literal:
        return f.select(*base, F.col("creation_date_id").alias("review_creation_date"),
                        F.col("answer_date_id").alias("review_answer_timestamp"))
    return f.select(*base, "review_creation_date", "review_answer_timestamp",
                    "creation_date_id", "answer_date_id")
