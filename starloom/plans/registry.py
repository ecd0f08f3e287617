"""Named queries over a test-data folder: ``name -> f(spark, sf_dir) -> DataFrame``.

Every query reads the whole test tables (through the source roles in
``starloom.sources.testdata``) and builds only the parts of the star it
needs; Catalyst prunes the rest.  Results are made portable for comparison
with other engines: decimals become double, dates become ``yyyy-MM-dd`` text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.dates import date_id, floor_days
from starloom.functions.text import title_case
from starloom.operators.casts import downcast_report
from starloom.operators.keys import dense_key, keep_first
from starloom.operators.lookups import broadcast_bounded, exact_date_key, lookup_key
from starloom.operators.registry import next_registry, registered_keys
from starloom.plans import analytics as A
from starloom.plans import checks as C
from starloom.plans import dims as D
from starloom.plans import facts as FX
from starloom.plans.sketches import daily_sketches, distinct_keys, standard_error
from starloom.plans.star import Star
from starloom.sinks.parts import PART_COLUMNS, changed_parts
from starloom.sources import testdata as TD
from starloom.sources.profile import profile_sources


def portable(df: DataFrame) -> DataFrame:
    """Decimal -> double, date -> 'yyyy-MM-dd', timestamp ->
    'yyyy-MM-dd HH:mm:ss.SSSSSS' (order of columns kept), so results compare
    across engines whatever time unit each hands to its client."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        cols.append(c.alias(f.name))
    return df.select(*cols)


class _Star(Star):
    """Star over one test-data folder, each table built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(TD.testdata_sources(spark, sf_dir))
        self.src = self.sources

    @property
    def tables(self) -> dict[str, DataFrame]:
        self.prepare()
        return {n: self[n] for n in self}


def _star(spark, sf_dir) -> _Star:
    return _Star(spark, sf_dir)


# ---- sources and dimensions -------------------------------------------------

def q_source_profile(spark, sf_dir):
    return profile_sources({n: TD.read_table(spark, sf_dir, n) for n in TD.STAR_TABLES})


def q_dim_date_day(spark, sf_dir):
    return D.build_dim_date(TD.testdata_sources(spark, sf_dir), grain="day")


def q_dim_date_timestamp(spark, sf_dir):
    return D.build_dim_date(TD.testdata_sources(spark, sf_dir), grain="timestamp",
                            include_shipping=False)


def q_dim_customers(spark, sf_dir):
    return D.build_dim_customers(TD.customers_role(spark, sf_dir))


def q_dim_products(spark, sf_dir):
    return D.build_dim_products(TD.products_role(spark, sf_dir), TD.translation_role(spark))


def q_dim_seller(spark, sf_dir):
    return D.build_dim_seller(TD.sellers_role(spark, sf_dir))


def q_dim_payments(spark, sf_dir):
    return D.build_dim_payments(TD.payments_role(spark, sf_dir))


# ---- facts ------------------------------------------------------------------

def q_fact_orders(spark, sf_dir):
    return _star(spark, sf_dir)["fact_orders"]


def q_fact_order_items(spark, sf_dir):
    return _star(spark, sf_dir)["fact_order_items"]


def q_fact_payments(spark, sf_dir):
    return _star(spark, sf_dir)["fact_payments"]


def q_fact_reviews(spark, sf_dir):
    return _star(spark, sf_dir)["fact_reviews"]


def q_fact_reviews_literal(spark, sf_dir):
    return FX.build_fact_reviews(TD.reviews_role(spark, sf_dir), literal=True)


def q_delivery_days_floor(spark, sf_dir):
    return _star(spark, sf_dir).fact("fact_orders").select("order_id", "delivery_days", "delay_days", "delivery_performance")


def q_delivery_performance_mix(spark, sf_dir):
    return A.delivery_performance_mix(_star(spark, sf_dir).fact("fact_orders"))


def q_event_day_offsets(spark, sf_dir):
    """Floored day offsets of every event from its user's first event, both
    directions (the negative one checks flooring toward -infinity)."""
    ev = TD.read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    first = ev.groupBy("user_id").agg(F.min("ts").alias("first_ts"))
    j = ev.join(broadcast_bounded(first), "user_id")
    return j.select("event_id", floor_days("ts", "first_ts").alias("days_since_first"),
                    floor_days("first_ts", "ts").alias("days_before_first"))


def q_title_case(spark, sf_dir):
    p = TD.read_table(spark, sf_dir, "part")
    return p.select("p_partkey", title_case("p_name").alias("p_name_title"),
                    title_case("p_brand").alias("p_brand_title"),
                    title_case("p_type").alias("p_type_title"))


LINEITEM_TIEBREAK = ["l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice",
                     "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def q_dedupe_keep_first(spark, sf_dir):
    li = TD.read_table(spark, sf_dir, "lineitem")
    return keep_first(li, ["l_orderkey", "l_linenumber"], order_by=LINEITEM_TIEBREAK)


def q_date_lookup_exact(spark, sf_dir):
    src = TD.testdata_sources(spark, sf_dir, names=["orders", "order_reviews", "order_items"])
    dd = D.build_dim_date(src, grain="timestamp", include_shipping=False)
    items = src["order_items"].select("order_id", "order_item_id", "shipping_limit_date")
    return exact_date_key(items, "shipping_limit_date", dd, "shipping_limit_date_id")


def q_null_safe_join(spark, sf_dir):
    """Answer-time members (null = unanswered, numbered last) looked up by
    null-safe equality and by plain equality."""
    rv = TD.reviews_role(spark, sf_dir).select("review_id", "review_answer_timestamp")
    members = dense_key(rv.select("review_answer_timestamp").distinct(),
                        "review_answer_timestamp", "answer_key")
    safe = lookup_key(rv, members, "review_answer_timestamp", "answer_key", null_safe=True)
    plain = lookup_key(rv, members, "review_answer_timestamp", "answer_key") \
        .select("review_id", F.col("answer_key").alias("answer_key_plain"))
    return (safe.select("review_id", F.col("answer_key").alias("answer_key_null_safe"))
                .join(plain, "review_id"))


# ---- analytics --------------------------------------------------------------

def q_revenue_by_category_month(spark, sf_dir):
    s = _star(spark, sf_dir)
    return A.revenue_by_category_month(s.fact("fact_order_items", ["dim_products"]), s.fact("fact_orders"), s["dim_products"],
                                       s["dim_date"])


def q_revenue_by_category_month_literal(spark, sf_dir):
    """A1 joined to the timestamp-grain date dimension of the original (D1):
    a day with k distinct timestamps counts its revenue k times."""
    s = _star(spark, sf_dir)
    dd = D.build_dim_date(s.src, grain="timestamp", include_shipping=False)
    return A.revenue_by_category_month(s.fact("fact_order_items", ["dim_products"]), s.fact("fact_orders"), s["dim_products"], dd)


def q_revenue_fanout_literal(spark, sf_dir):
    """D1 on purchase events: revenue and rows per month when purchases are
    joined on date_id to a day-grain and to a timestamp-grain date dimension
    built from the event times (the latter repeats each date_id once per
    distinct timestamp of that day)."""
    ev = TD.read_table(spark, sf_dir, "events")
    purchases = (ev.where(F.col("event_type") == "purchase")
                   .select(date_id("ts").alias("date_id"),
                           F.col("value").cast("decimal(18,2)").alias("revenue")))
    out = []
    for grain in ("day", "timestamp"):
        dd = D.build_dim_date_from([(ev, ["ts"])], grain=grain)
        r = A.sum_by_calendar(purchases, "date_id", "revenue", dd, count_name="joined_rows")
        out.append(r.select(F.lit(grain).alias("grain"), "year", "month", "joined_rows",
                            F.col("revenue").cast("double").alias("revenue")))
    return out[0].unionByName(out[1])


def q_seller_location_first10(spark, sf_dir):
    s = _star(spark, sf_dir)
    return A.seller_locations_first10(s.fact("fact_order_items", ["dim_seller"]), s["dim_seller"])


def q_top10_sellers(spark, sf_dir):
    s = _star(spark, sf_dir)
    return A.top_sellers_by_revenue(s.fact("fact_order_items", ["dim_seller"]), s["dim_seller"])


def q_avg_delivery(spark, sf_dir):
    out = A.average_delivery(_star(spark, sf_dir).fact("fact_orders"))
    return out.select(F.round("average_delivery", 6).alias("average_delivery"),
                      F.round("average_delays", 6).alias("average_delays"))


def q_review_distribution(spark, sf_dir):
    return A.review_distribution(_star(spark, sf_dir)["fact_reviews"])


def q_payment_distribution(spark, sf_dir):
    s = _star(spark, sf_dir)
    return A.payment_distribution(s["fact_payments"], s["dim_payments"])


def q_multi_payment_orders(spark, sf_dir):
    return A.multi_payment_orders(_star(spark, sf_dir).fact("fact_payments"))


def q_repeat_customers(spark, sf_dir):
    return A.repeat_customers(_star(spark, sf_dir)["fact_orders"])


def q_repeat_customers_unique(spark, sf_dir):
    s = _star(spark, sf_dir)
    return A.repeat_customers(s["fact_orders"], min_orders=2, key="customer_unique_id",
                              dim_customers=s["dim_customers"])


def q_repeat_customers_min15(spark, sf_dir):
    return A.repeat_customers(_star(spark, sf_dir)["fact_orders"], min_orders=15)


# ---- check queries and checks ------------------------------------------------

def q_table_counts(spark, sf_dir):
    return C.table_counts(_star(spark, sf_dir).tables)


def q_orders_without_customer(spark, sf_dir):
    s = _star(spark, sf_dir)
    return C.orders_without_customer(s["fact_orders"], s["dim_customers"])


def q_products_without_items(spark, sf_dir):
    s = _star(spark, sf_dir)
    return C.products_without_items(s["dim_products"], s.fact("fact_order_items", ["dim_products"]))


def q_items_without_product(spark, sf_dir):
    s = _star(spark, sf_dir)
    return C.items_without_product(s.fact("fact_order_items", ["dim_products"]), s["dim_products"])


def q_duplicate_customer_keys(spark, sf_dir):
    return C.duplicate_keys(_star(spark, sf_dir)["dim_customers"], "customer_sk")


def q_duplicate_item_keys(spark, sf_dir):
    return C.duplicate_keys(_star(spark, sf_dir).fact("fact_order_items"), ["order_id", "order_item_id"])


def q_row_count_match(spark, sf_dir):
    s = _star(spark, sf_dir)
    return C.row_count_checks(s.src, s.tables)


def q_null_key_counts(spark, sf_dir):
    return C.null_key_checks(_star(spark, sf_dir).tables)


def q_key_uniqueness(spark, sf_dir):
    return C.uniqueness_checks(_star(spark, sf_dir).tables)


def q_fk_coverage(spark, sf_dir):
    s = _star(spark, sf_dir)
    return C.coverage_checks(s.src, s.tables)


def q_star_checks(spark, sf_dir):
    s = _star(spark, sf_dir)
    return C.check_star(s.src, s.tables)


# ---- faults and refreshes ------------------------------------------------------

def _flawed(spark, sf_dir):
    """Sources with faults, their star, and in it customers of one region twice."""
    src = TD.flawed_sources(spark, sf_dir)
    st = Star(src)
    st.prepare()
    customers = st["dim_customers"]
    return src, {**{n: st[n] for n in st},
                 "dim_customers": customers.unionByName(customers.where("customer_state = 'EUROPE'"))}


def q_flawed_star_checks(spark, sf_dir):
    return C.check_star(*_flawed(spark, sf_dir))


def q_key_reconciliation(spark, sf_dir):
    return C.reconciled_keys(*_flawed(spark, sf_dir))


def q_flawed_integrity(spark, sf_dir):
    _, s = _flawed(spark, sf_dir)
    found = [C.orders_without_customer(s["fact_orders"], s["dim_customers"]),
             C.products_without_items(s["dim_products"], s["fact_order_items"]),
             C.items_without_product(s["fact_order_items"], s["dim_products"]),
             C.duplicate_keys(s["dim_customers"], "customer_sk").agg(F.count(F.lit(1)).alias("duplicate_customer_keys"))]
    rows = reduce(DataFrame.unionByName, [df.select(F.lit(df.columns[0]).alias("what"), F.col(df.columns[0]).alias("n")) for df in found])
    return rows.agg(*[F.max(F.when(F.col("what") == df.columns[0], F.col("n"))).alias(df.columns[0]) for df in found])


def q_flawed_fact_reviews(spark, sf_dir):
    return FX.build_fact_reviews(TD.flawed_sources(spark, sf_dir)["order_reviews"])


def _inferred(spark, sf_dir) -> Star:
    st = Star(TD.flawed_sources(spark, sf_dir), infer_members=True)
    st.prepare()
    return st


def q_dim_products_inferred(spark, sf_dir):
    return _inferred(spark, sf_dir)["dim_products"].select("product_sk", "product_id", "product_category_name_english", "is_inferred")


def q_inferred_totals(spark, sf_dir):
    """Revenue in the fact, and as the reports by category, location and seller
    add it up: with inferred and unknown members none of it is lost."""
    s = _inferred(spark, sf_dir)
    # a fact's lookups keep its rows: each report takes the keys that it uses
    by_product, items = (s.fact("fact_order_items", (d,)) for d in ("dim_products", "dim_seller"))
    reports = {"fact": items.select((F.col("price") + F.col("freight_value")).alias("total_price")),
               "category": A.revenue_by_category_month(by_product, s["fact_orders"], s["dim_products"], s["dim_date"]),
               "location": A.seller_locations_first10(items, s["dim_seller"], n=None),
               "seller": A.top_sellers_by_revenue(items, s["dim_seller"], n=None)}
    return reduce(DataFrame.unionByName, [
        df.agg(F.round(F.sum("total_price").cast("double"), 2).alias("revenue")).select(F.lit(name).alias("report"), "revenue")
        for name, df in reports.items()])


def q_key_registry_refresh(spark, sf_dir):
    """A refresh a year: members are the customers of that year's orders (null
    while pending); what the registry holds after the last."""
    orders = TD.orders_role(spark, sf_dir).select(
        F.year("order_purchase_timestamp").alias("year"),
        F.when(F.col("order_status") != "P", F.col("customer_id")).alias("customer_id"))
    registry = None
    for (year,) in orders.select("year").where("year IS NOT NULL").distinct().orderBy("year").collect():
        members = orders.where(F.col("year") == year).select("customer_id").distinct()
        keyed = (dense_key(members, "customer_id", "customer_sk") if registry is None
                 else registered_keys(members, registry, "customer_id", "customer_sk"))
        registry = next_registry(registry, keyed, "customer_id", "customer_sk").checkpoint()
    return registry


def q_customers_by_year_sketched(spark, sf_dir):
    """Distinct customers a year: exact, and whether the merge of day sketches
    is within four standard errors of it."""
    fact = _star(spark, sf_dir)["fact_orders"]
    year = F.floor(F.col("purchase_date_id") / 10000).cast("int").alias("year")
    exact = fact.groupBy(year).agg(F.count_distinct("customer_sk").alias("customers"))
    guess = distinct_keys(daily_sketches(fact, "customer_sk"), [year], "estimate")
    near = F.abs(F.col("estimate") / F.col("customers") - 1) <= 4 * standard_error()
    return exact.join(guess, exact["year"].eqNullSafe(guess["year"])).select(exact["year"], "customers", near.alias("estimate_within_bound"))


def q_refresh_changed_days(spark, sf_dir):
    """The days of the order fact that a refresh after a late correction would write."""
    old = Star(TD.testdata_sources(spark, sf_dir))
    new = Star({**old.sources, "orders": TD.corrected_orders(spark, sf_dir)}, dimensions={"dim_customers": old["dim_customers"]})
    return changed_parts(old["fact_orders"], new["fact_orders"], "fact_orders", PART_COLUMNS["fact_orders"])


def q_downcast_check(spark, sf_dir):
    return downcast_report(_star(spark, sf_dir)["fact_orders"],
                           ["order_id", "customer_sk", "approved_date_id",
                            "delivered_customer_date_id"], to="int")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "source_profile": q_source_profile,
    "dim_date_day": q_dim_date_day,
    "dim_date_timestamp": q_dim_date_timestamp,
    "dim_customers": q_dim_customers,
    "dim_products": q_dim_products,
    "dim_seller": q_dim_seller,
    "dim_payments": q_dim_payments,
    "fact_orders": q_fact_orders,
    "fact_order_items": q_fact_order_items,
    "fact_payments": q_fact_payments,
    "fact_reviews": q_fact_reviews,
    "fact_reviews_literal": q_fact_reviews_literal,
    "delivery_days_floor": q_delivery_days_floor,
    "delivery_performance_mix": q_delivery_performance_mix,
    "event_day_offsets": q_event_day_offsets,
    "title_case": q_title_case,
    "dedupe_keep_first": q_dedupe_keep_first,
    "date_lookup_exact": q_date_lookup_exact,
    "null_safe_join": q_null_safe_join,
    "revenue_by_category_month": q_revenue_by_category_month,
    "revenue_by_category_month_literal": q_revenue_by_category_month_literal,
    "revenue_fanout_literal": q_revenue_fanout_literal,
    "seller_location_first10": q_seller_location_first10,
    "top10_sellers": q_top10_sellers,
    "avg_delivery": q_avg_delivery,
    "review_distribution": q_review_distribution,
    "payment_distribution": q_payment_distribution,
    "multi_payment_orders": q_multi_payment_orders,
    "repeat_customers": q_repeat_customers,
    "repeat_customers_unique": q_repeat_customers_unique,
    "repeat_customers_min15": q_repeat_customers_min15,
    "table_counts": q_table_counts,
    "orders_without_customer": q_orders_without_customer,
    "products_without_items": q_products_without_items,
    "items_without_product": q_items_without_product,
    "duplicate_customer_keys": q_duplicate_customer_keys,
    "duplicate_item_keys": q_duplicate_item_keys,
    "row_count_match": q_row_count_match,
    "null_key_counts": q_null_key_counts,
    "key_uniqueness": q_key_uniqueness,
    "fk_coverage": q_fk_coverage,
    "star_checks": q_star_checks,
    "downcast_check": q_downcast_check,
    "flawed_star_checks": q_flawed_star_checks,
    "key_reconciliation": q_key_reconciliation,
    "flawed_integrity": q_flawed_integrity,
    "flawed_fact_reviews": q_flawed_fact_reviews,
    "dim_products_inferred": q_dim_products_inferred,
    "inferred_totals": q_inferred_totals,
    "key_registry_refresh": q_key_registry_refresh,
    "customers_by_year_sketched": q_customers_by_year_sketched,
    "refresh_changed_days": q_refresh_changed_days,
}


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(QUERIES[name](spark, sf_dir))
