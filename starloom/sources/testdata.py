"""Source roles over the TPC-H-style test tables.

The builders work on the extract schemas of ``schemas.py``; this module
projects the test tables onto those roles so the same builders run on them.
Every role is derived by Spark from the given tables:

=============== ===========================================================
orders          ``orders``; delivered-to-carrier / -customer = first / last
                ``l_shipdate`` of the order; estimated = order date + 30 days;
                approved = order date unless the status is pending ("P")
order_items     ``lineitem``; price = extended price as decimal(18,2);
                freight = price x tax, exact at 4 places
customers       ``customer`` + ``nation`` (city) + ``region`` (state)
products        ``part``; category = ``p_type``
sellers         ``supplier`` + ``nation`` + ``region``
order_payments  ``events``; one order per user and day; type = event_type;
                installments = ``props.k``
order_reviews   ``labels`` + ``events`` (doc_id = event_id gives the time);
                answered one day later unless the label is toxic
=============== ===========================================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import date_id
from starloom.sources.readers import category_translation

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")
STAR_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "labels")

# Stand-in category translation for the part types; STANDARD is
# left out on purpose so one category falls back to "unknown".
TRANSLATION_ROWS = [("ECONOMY", "economy"), ("LARGE", "large"), ("MEDIUM", "medium"),
                    ("PROMO", "promo"), ("SMALL", "small")]

ORDER_DAY_FACTOR = 100_000_000  # user_id * factor + yyyymmdd = payment order id


_TABLES: dict[tuple, tuple[SparkSession, DataFrame]] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The test table as a DataFrame; the plan (not data) is reused per
    session, so its footer is read once however many roles use it."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    hit = _TABLES.get(key)
    if hit is None or hit[0] is not spark:  # the session is held, so its id is not reused
        _TABLES[key] = hit = (spark, spark.read.parquet(path))
    return hit[1]


def _tables(spark, sf_dir, names):
    return {n: read_table(spark, sf_dir, n) for n in names}


def payment_order_id(user_col, ts_col):
    return (F.col(user_col) * F.lit(ORDER_DAY_FACTOR) + date_id(ts_col)).cast("long")


def _geo(spark, sf_dir, key_col: str):
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
                  .select(F.col("n_nationkey").alias(key_col), "n_name", "r_name"))


def orders_role(spark, sf_dir) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    li = (read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
          .agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")))
    j = o.join(li, o.o_orderkey == li.l_orderkey, "left")
    return j.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("order_approved_at"),
        F.col("first_ship").alias("order_delivered_carrier_date"),
        F.col("last_ship").alias("order_delivered_customer_date"),
        (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("order_estimated_delivery_date"),
    )


def order_items_role(spark, sf_dir) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        price.alias("price"),
        (price * F.col("l_tax").cast("decimal(18,2)")).cast("decimal(18,4)").alias("freight_value"),
    )


def customers_role(spark, sf_dir) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    g = _geo(spark, sf_dir, "c_nationkey")
    return c.join(g, "c_nationkey", "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.concat_ws("-", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("customer_unique_id"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("customer_zip_code_prefix"),
        F.col("n_name").alias("customer_city"),
        F.lower("r_name").alias("customer_state"),
    )


def sellers_role(spark, sf_dir) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    g = _geo(spark, sf_dir, "s_nationkey")
    return s.join(g, "s_nationkey", "left").select(
        F.col("s_suppkey").alias("seller_id"),
        F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("seller_zip_code_prefix"),
        F.col("n_name").alias("seller_city"),
        F.lower("r_name").alias("seller_state"),
    )


def products_role(spark, sf_dir) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.length("p_brand").alias("product_description_lenght"),
        F.col("p_size").alias("product_photos_qty"),
        F.col("p_retailprice").alias("product_weight_g"),
        F.col("p_size").cast("double").alias("product_length_cm"),
        (F.col("p_size") % 10).cast("double").alias("product_height_cm"),
        (F.col("p_size") % 7).cast("double").alias("product_width_cm"),
    )


def translation_role(spark) -> DataFrame:
    return category_translation(spark, rows=TRANSLATION_ROWS)


def payments_role(spark, sf_dir) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(
        payment_order_id("user_id", "ts").alias("order_id"),
        F.col("event_type").alias("payment_type"),
        F.get_json_object("props", "$.k").cast("int").alias("payment_installments"),
        F.col("value").cast("decimal(18,2)").alias("payment_value"),
    )


def reviews_role(spark, sf_dir) -> DataFrame:
    lab = read_table(spark, sf_dir, "labels")
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    j = lab.join(ev, lab.doc_id == ev.event_id, "left")
    return j.select(
        F.col("doc_id").alias("review_id"),
        payment_order_id("user_id", "ts").alias("order_id"),
        F.col("quality").alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        F.lit(None).cast("string").alias("review_comment_message"),
        F.col("ts").alias("review_creation_date"),
        F.when(F.col("toxic") == 0, F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("review_answer_timestamp"),
    )


ROLE_BUILDERS = {
    "orders": orders_role,
    "order_items": order_items_role,
    "customers": customers_role,
    "sellers": sellers_role,
    "products": products_role,
    "order_payments": payments_role,
    "order_reviews": reviews_role,
}


def testdata_sources(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    """All source roles (lazy) plus ``category_translation``."""
    out = {n: ROLE_BUILDERS[n](spark, sf_dir) for n in (names or ROLE_BUILDERS)}
    if names is None or "category_translation" in names:
        out["category_translation"] = translation_role(spark)
    return out


def flawed_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The same roles over the same whole tables with the faults checks look for:

    * orders: pending ones have no customer, those without items no purchase time;
    * customers: a segment is missing, another is delivered twice with another city;
    * products: a category is missing, the small ones of up to size 10 have no id;
    * sellers: a region is missing;
    * items: no product where the tax is zero; payments: no type below 10 installments;
    * reviews: title and text from the documents.
    """
    s = testdata_sources(spark, sf_dir)
    none = lambda df, col, when: df.withColumn(col, F.when(~F.coalesce(when, F.lit(False)), F.col(col)))
    orders = none(s["orders"], "customer_id", F.col("order_status") == "P")
    segment = F.col("customer_unique_id")
    customers = s["customers"].where(~segment.startswith("MACHINERY"))
    again = customers.where(segment.startswith("BUILDING")).withColumn("customer_city", F.lit("elsewhere"))
    products = s["products"].where(F.col("product_category_name") != "LARGE")
    small = (F.col("product_category_name") == "SMALL") & (F.col("product_photos_qty") <= 10)
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("review_id"), "source", "text")
    reviews = s["order_reviews"].drop("review_comment_title", "review_comment_message").join(docs, "review_id", "left")
    return {**s,
            "orders": none(orders, "order_purchase_timestamp", F.col("order_delivered_carrier_date").isNull()),
            "customers": customers.unionByName(again),
            "products": none(products, "product_id", small),
            "sellers": s["sellers"].where(F.col("seller_state") != "asia"),
            "order_items": none(s["order_items"], "product_id", F.col("freight_value") == 0),
            "order_payments": none(s["order_payments"], "payment_type", F.col("payment_installments") < 10),
            "order_reviews": reviews.withColumnsRenamed({"source": "review_comment_title", "text": "review_comment_message"})}


def corrected_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders role after a late correction: June 1997 has another status,
    and the orders of 3 March 1998 are withdrawn."""
    o = orders_role(spark, sf_dir)
    day = F.to_date("order_purchase_timestamp")
    june = day.between(F.lit("1997-06-01").cast("date"), F.lit("1997-06-30").cast("date"))
    return (o.where(F.coalesce(day != F.lit("1998-03-03").cast("date"), F.lit(True)))
            .withColumn("order_status", F.when(june, F.lit("X")).otherwise(F.col("order_status"))))
