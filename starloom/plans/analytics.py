"""Business questions over the star.

Money is summed in decimal (exact, independent of partitioning and order)
and turned into double at the end.  Where a query joins a fact to a small
dimension only to label the groups, the fact is aggregated first so the join
sees one row per group instead of one per fact row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.lookups import (DEFAULT_BROADCAST_ROWS, broadcast_bounded,
                                       fits_broadcast, known_rows)


def _money(c) -> F.Column:
    return F.sum(c).cast("double")


def date_multiplicity(dim_date: DataFrame, cols=("year", "month")) -> DataFrame:
    """(date_id, *cols, k): how many date rows carry each date_id (1 at day
    grain, the number of distinct timestamps at timestamp grain)."""
    return dim_date.groupBy("date_id", *cols).agg(F.count(F.lit(1)).alias("__sl_k"))


def sum_by_calendar(df: DataFrame, date_key: str, amount: str, dim_date: DataFrame,
                    by=(), cols=("year", "month"), count_name: str | None = None) -> DataFrame:
    """Inner-join ``df`` to ``dim_date`` on ``date_key`` and sum ``amount`` by
    ``cols`` + ``by``, exactly as the row join would, without emitting one
    row per (fact row, date row) pair: both sides are reduced per date_id
    first and the sum is multiplied by the date rows of that id.
    """
    per_day = df.groupBy(date_key, *by).agg(F.sum(amount).alias("__sl_amt"),
                                             F.count(F.lit(1)).alias("__sl_n"))
    dates = date_multiplicity(dim_date, cols).withColumnRenamed("date_id", date_key)
    j = per_day.join(dates, date_key)
    aggs = [F.sum(F.col("__sl_amt") * F.col("__sl_k")).alias(amount)]
    if count_name:
        aggs.append(F.sum(F.col("__sl_n") * F.col("__sl_k")).cast("long").alias(count_name))
    return j.groupBy(*cols, *by).agg(*aggs)


def revenue_by_category_month(fact_order_items: DataFrame, fact_orders: DataFrame,
                              dim_products: DataFrame, dim_date: DataFrame,
                              broadcast_max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """A1: sum(price + freight) by product category, year and month of purchase.

    Same result as joining items, orders, products and dates and grouping
    (inner joins, so unmatched rows drop out and duplicates multiply).  The
    only join over whole facts is items-orders on order_id.  A product
    dimension within the broadcast bound labels the joined rows map-side, so
    they are aggregated once, by (purchase day, category), before any
    shuffle; a larger one meets rows already summed per (purchase day,
    product).  A date dimension with several rows per date_id multiplies
    sums instead of rows.
    """
    items = fact_order_items.select("order_id", "product_sk",
                                    (F.col("price") + F.col("freight_value")).alias("amount"))
    orders = fact_orders.select("order_id", "purchase_date_id")
    joined = items.join(orders, "order_id")
    products = dim_products.select("product_sk", "product_category_name")
    if fits_broadcast(products, broadcast_max_rows, rows=known_rows(dim_products)):
        labelled = joined.join(F.broadcast(products), "product_sk")
    else:
        per_day_product = (joined.groupBy("purchase_date_id", "product_sk")
                                 .agg(F.sum("amount").alias("amount")))
        labelled = per_day_product.join(products, "product_sk")
    out = sum_by_calendar(labelled, "purchase_date_id", "amount", dim_date,
                          by=("product_category_name",))
    return (out.select("product_category_name", F.col("amount").cast("double").alias("total_price"),
                       "year", "month")
               .orderBy(F.asc_nulls_last("year"), F.asc_nulls_last("month"),
                        F.desc_nulls_first("product_category_name")))


def _seller_revenue(fact_order_items: DataFrame) -> DataFrame:
    return (fact_order_items.groupBy("seller_sk")
            .agg(F.sum(F.col("price") + F.col("freight_value")).alias("amount")))


def seller_locations_first10(fact_order_items: DataFrame, dim_seller: DataFrame,
                             n: int | None = 10) -> DataFrame:
    """A2 (literal): revenue by seller city/state, the first ``n`` locations in
    alphabetical order (what the original "top sellers" query returns); all of
    them without ``n``."""
    by_seller = _seller_revenue(fact_order_items)
    loc = (by_seller.join(dim_seller.select("seller_sk", "seller_city", "seller_state"), "seller_sk")
           .groupBy("seller_city", "seller_state").agg(_money("amount").alias("total_price")))
    ordered = loc.orderBy(F.asc_nulls_last("seller_city"), F.asc_nulls_last("seller_state"))
    return ordered if n is None else ordered.limit(n)


def top_sellers_by_revenue(fact_order_items: DataFrame, dim_seller: DataFrame,
                           n: int | None = 10) -> DataFrame:
    """A3: the ``n`` sellers with the highest revenue (ties by seller_id), or all."""
    by_seller = _seller_revenue(fact_order_items)
    out = (by_seller.join(dim_seller.select("seller_sk", "seller_id", "seller_city", "seller_state"),
                          "seller_sk")
           .select("seller_sk", "seller_id", "seller_city", "seller_state",
                   F.col("amount").cast("double").alias("total_price")))
    ordered = out.orderBy(F.desc_nulls_last("total_price"), F.asc_nulls_last("seller_id"))
    return ordered if n is None else ordered.limit(n)


def average_delivery(fact_orders: DataFrame) -> DataFrame:
    """A4: mean delivery and delay days over orders with a known delay."""
    return (fact_orders.where(F.col("delay_days").isNotNull())
            .agg(F.avg("delivery_days").alias("average_delivery"),
                 F.avg("delay_days").alias("average_delays")))


def review_distribution(fact_reviews: DataFrame) -> DataFrame:
    """A5: reviews per score, by score."""
    return (fact_reviews.groupBy("review_score").agg(F.count(F.lit(1)).alias("review_count"))
            .orderBy(F.asc_nulls_last("review_score")))


def payment_distribution(fact_payments: DataFrame, dim_payments: DataFrame) -> DataFrame:
    """Payments and their total value per payment type."""
    per_key = (fact_payments.groupBy("payment_sk")
               .agg(F.count(F.lit(1)).alias("payment_count"),
                    F.sum("payment_value").alias("total_value")))
    out = dim_payments.select("payment_sk", "payment_type").join(per_key, "payment_sk")
    return (out.groupBy("payment_type")
            .agg(F.sum("payment_count").cast("long").alias("payment_count"),
                 _money("total_value").alias("total_value")))


def multi_payment_orders(fact_payments: DataFrame, min_payments: int = 2) -> DataFrame:
    """Orders paid with at least ``min_payments`` payments."""
    return (fact_payments.groupBy("order_id")
            .agg(F.count(F.lit(1)).alias("orders_multiple_payments"))
            .where(F.col("orders_multiple_payments") >= min_payments))


def repeat_customers(fact_orders: DataFrame, min_orders: int = 2, key: str = "customer_sk",
                     dim_customers: DataFrame | None = None) -> DataFrame:
    """Customers with at least ``min_orders`` distinct orders, most first.

    ``key="customer_unique_id"`` counts per person instead of per customer_id
    (needs ``dim_customers``).
    """
    f = fact_orders.select("customer_sk", "order_id")
    if key != "customer_sk":
        if dim_customers is None:
            raise ValueError("grouping by %r needs dim_customers" % key)
        # one row per (customer, order) before the lookup of the person key
        f = f.distinct().join(broadcast_bounded(dim_customers.select("customer_sk", key)),
                              "customer_sk")
    out = (f.groupBy(key).agg(F.count_distinct("order_id").alias("num_orders"))
            .where(F.col("num_orders") >= min_orders))
    return out.orderBy(F.desc_nulls_first("num_orders"))


def delivery_performance_mix(fact_orders: DataFrame) -> DataFrame:
    """Orders per delivery class with the mean delay of each class."""
    return (fact_orders.groupBy("delivery_performance")
            .agg(F.count(F.lit(1)).alias("order_count"),
                 F.avg("delay_days").alias("average_delay")))
