"""Builders, checks and analytics on hand-made extracts with the source schemas."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql.types import DecimalType

from starloom.plans import analytics as A
from starloom.plans import checks as C
from starloom.plans import dims as D
from starloom.plans import facts as FX
from starloom.plans.star import Star, build_star
from starloom.sources.schemas import SCHEMAS

T = dt.datetime


@pytest.fixture(scope="module")
def sources(spark):
    def df(name, rows):
        money = [isinstance(f.dataType, DecimalType) for f in SCHEMAS[name].fields]
        return spark.createDataFrame([tuple(Decimal(str(v)) if m else v for m, v in zip(money, r)) for r in rows], SCHEMAS[name])
    return {
        "orders": df("orders", [
            ("o1", "c1", "delivered", T(2024, 3, 1, 9), T(2024, 3, 1, 10), T(2024, 3, 2, 8),
             T(2024, 3, 5, 12), T(2024, 3, 6, 0)),
            ("o2", "c2", "delivered", T(2024, 3, 1, 15), None, None, T(2024, 3, 9, 1), T(2024, 3, 8, 0)),
            ("o3", "c9", "shipped", T(2024, 3, 1, 20), None, None, None, T(2024, 3, 10, 0)),
            ("o4", "c1", "delivered", T(2024, 4, 2, 9), None, None, T(2024, 4, 3, 9), T(2024, 4, 3, 9)),
        ]),
        "customers": df("customers", [
            ("c1", "u1", "01001", "santa barbara d'oeste", "sp"),
            ("c1", "u1", "01001", "zzz duplicate", "sp"),
            ("c2", "u1", "02002", "mogi-guacu", "mg"),
        ]),
        "products": df("products", [
            ("p1", "beleza_saude", 10, 100, 1, 200.0, 10.0, 10.0, 10.0),
            ("p2", None, None, None, None, None, None, None, None),
            ("p3", "novo", 1, 1, 1, 1.0, 1.0, 1.0, 1.0),
        ]),
        "category_translation": df("category_translation", [("beleza_saude", "health_beauty")]),
        "sellers": df("sellers", [("s1", "13000", "campinas", "sp"), ("s2", "20000", "rio de janeiro", "rj")]),
        "order_items": df("order_items", [
            ("o1", 1, "p1", "s1", T(2024, 3, 3, 11, 30), 10.0, 2.5),
            ("o1", 2, "p2", "s2", T(2024, 3, 3, 11, 30), 5.0, 1.0),
            ("o2", 1, "p9", "s1", T(2024, 3, 7, 0), 7.0, 0.5),
            ("o4", 1, "p1", "s2", T(2024, 4, 2, 9), 3.0, 0.0),
        ]),
        "order_payments": df("order_payments", [
            ("o1", 1, "credit_card", 3, 10.0), ("o1", 2, "voucher", 1, 9.0),
            ("o2", 1, "boleto", 1, 7.5), ("o4", 1, "credit_card", 1, 3.0),
        ]),
        "order_reviews": df("order_reviews", [
            ("r1", "o1", 5, None, "ok\nfine", T(2024, 3, 6, 0), T(2024, 3, 7, 10, 5)),
            ("r2", "o2", 1, "bad", None, T(2024, 3, 9, 0), None),
        ]),
    }


@pytest.fixture(scope="module")
def star(sources):
    return build_star(sources)


def test_dim_date_day_grain_and_shipping(star):
    dd = star["dim_date"]
    rows = {r.date_id: r for r in dd.collect()}
    assert len(rows) == dd.count()  # date_id unique at day grain
    assert 20240303 in rows  # shipping date included by default (D2)
    r = rows[20240301]
    assert (r.month_name, r.weekday_name, r.weekday, r.is_weekend) == ("March", "Friday", 5, False)


def test_dim_date_timestamp_grain_fans_out(sources):
    ts = D.build_dim_date(sources, grain="timestamp", include_shipping=False)
    per_day = {r.date_id: r["count"] for r in ts.groupBy("date_id").count().collect()}
    assert per_day[20240301] == 4  # 9:00, 10:00, 15:00, 20:00 on one day


def test_dim_customers_dedupe_keys_title_case(star):
    got = [(r.customer_sk, r.customer_id, r.customer_city, r.customer_state)
           for r in star["dim_customers"].orderBy("customer_sk").collect()]
    assert got == [(1, "c1", "Santa Barbara D'Oeste", "SP"), (2, "c2", "Mogi-Guacu", "MG")]


def test_dim_products_unknown_category(star):
    got = {r.product_id: (r.product_sk, r.product_category_name_english)
           for r in star["dim_products"].collect()}
    assert got == {"p1": (1, "health_beauty"), "p2": (2, "unknown"), "p3": (3, "unknown")}


def test_dim_payments_dense(star):
    got = {r.payment_type: r.payment_sk for r in star["dim_payments"].collect()}
    assert got == {"boleto": 1, "credit_card": 2, "voucher": 3}


def test_fact_orders(star):
    got = {r.order_id: r for r in star["fact_orders"].collect()}
    assert "customer_id" not in star["fact_orders"].columns
    o1, o2, o3 = got["o1"], got["o2"], got["o3"]
    # delivered 12 hours before the estimate: -0.5 days floors to -1
    assert (o1.customer_sk, o1.purchase_date_id, o1.delivery_days, o1.delay_days) == (1, 20240301, 4, -1)
    assert o1.delivery_performance == "early"
    assert (o2.approved_date_id, o2.delivery_days, o2.delay_days, o2.delivery_performance) == \
        (None, 7, 1, "late")
    assert (o3.customer_sk, o3.delivery_performance) == (None, "undelivered")
    assert got["o4"].delivery_performance == "on_time"


def test_fact_items_unknown_member_and_total(star):
    got = {(r.order_id, r.order_item_id): r for r in star["fact_order_items"].collect()}
    assert got[("o2", 1)].product_sk == 0  # p9 is not a product
    assert got[("o1", 1)].shipping_limit_date_id == 20240303
    assert got[("o1", 1)].item_total == 12.5


def test_fact_payments_and_reviews(star, sources):
    pay = {(r.order_id, r.payment_sk): r.is_installment for r in star["fact_payments"].collect()}
    assert pay == {("o1", 2): True, ("o1", 3): False, ("o2", 1): False, ("o4", 2): False}
    rv = {r.review_id: r for r in star["fact_reviews"].collect()}
    assert (rv["r1"].creation_date_id, rv["r1"].answer_date_id) == (20240306, 20240307)
    assert rv["r1"].review_comment_message == "ok\nfine"
    lit = {r.review_id: r for r in FX.build_fact_reviews(sources["order_reviews"], literal=True).collect()}
    assert lit["r2"].review_answer_timestamp is None and lit["r2"].review_creation_date == 20240309


def test_exact_lookup_leaves_shipping_null(sources):
    st = Star(sources, grain="timestamp", include_shipping=False, date_lookup="exact")
    items = {(r.order_id, r.order_item_id): r.shipping_limit_date_id
             for r in st["fact_order_items"].collect()}
    assert items[("o1", 1)] is None  # 11:30 is none of the seven date sources (D2)
    assert items[("o4", 1)] == 20240402  # equals o4's purchase timestamp


def test_checks_find_orphans_and_unknown_keys(star, sources):
    chk = {(r.check, r.subject): r for r in C.check_star(sources, star).collect()}
    assert chk[("row_count", "fact_orders")].passed
    assert chk[("null_key", "fact_orders.customer_sk")].observed == 1
    assert chk[("unknown_key", "fact_order_items.product_sk")].observed == 1
    assert chk[("orphan_keys", "order_items.product_id")].observed == 1
    assert chk[("orphan_keys", "fact_order_items.product_sk")].observed == 1  # key 0
    assert chk[("unique", "dim_customers.customer_id")].passed
    with pytest.raises(C.StarCheckFailed):
        C.assert_star(C.check_star(sources, star))


def test_check_queries(star):
    assert C.orders_without_customer(star["fact_orders"], star["dim_customers"]).first()[0] == 1
    assert C.products_without_items(star["dim_products"], star["fact_order_items"]).first()[0] == 1  # p3
    assert C.items_without_product(star["fact_order_items"], star["dim_products"]).first()[0] == 1
    assert C.duplicate_keys(star["dim_customers"], "customer_sk").count() == 0
    counts = {r.table_name: r.row_count for r in C.table_counts(star).collect()}
    assert counts["fact_order_items"] == 4 and counts["dim_customers"] == 2


def test_analytics(star):
    rev = A.revenue_by_category_month(star["fact_order_items"], star["fact_orders"],
                                      star["dim_products"], star["dim_date"]).collect()
    got = {(r.year, r.month, r.product_category_name): r.total_price for r in rev}
    # o2's item has product key 0 and drops out of the inner join
    assert got == {(2024, 3, "beleza_saude"): 12.5, (2024, 3, None): 6.0, (2024, 4, "beleza_saude"): 3.0}
    assert [r.product_category_name for r in rev][:2] == [None, "beleza_saude"]  # DESC, nulls first
    top = A.top_sellers_by_revenue(star["fact_order_items"], star["dim_seller"]).collect()
    assert [(r.seller_id, r.total_price) for r in top] == [("s1", 20.0), ("s2", 9.0)]
    loc = A.seller_locations_first10(star["fact_order_items"], star["dim_seller"]).collect()
    assert [r.seller_city for r in loc] == ["Campinas", "Rio De Janeiro"]
    avg = A.average_delivery(star["fact_orders"]).first()
    assert (avg.average_delivery, avg.average_delays) == (pytest.approx(4.0), pytest.approx(0.0))
    mix = {r.payment_type: (r.payment_count, r.total_value)
           for r in A.payment_distribution(star["fact_payments"], star["dim_payments"]).collect()}
    assert mix == {"credit_card": (2, 13.0), "voucher": (1, 9.0), "boleto": (1, 7.5)}
    assert [r.order_id for r in A.multi_payment_orders(star["fact_payments"]).collect()] == ["o1"]
    rep = A.repeat_customers(star["fact_orders"]).collect()
    assert [(r.customer_sk, r.num_orders) for r in rep] == [(1, 2)]
    rep_u = A.repeat_customers(star["fact_orders"], key="customer_unique_id",
                               dim_customers=star["dim_customers"]).collect()
    assert [(r.customer_unique_id, r.num_orders) for r in rep_u] == [("u1", 3)]
    scores = [(r.review_score, r.review_count) for r in A.review_distribution(star["fact_reviews"]).collect()]
    assert scores == [(1, 1), (5, 1)]


def test_revenue_fanout_at_timestamp_grain(star, sources):
    """The literal timestamp-grain date dimension repeats date_id, and
    joining on it multiplies revenue by the timestamps of that day."""
    ts = D.build_dim_date(sources, grain="timestamp", include_shipping=False)
    lit = A.revenue_by_category_month(star["fact_order_items"], star["fact_orders"],
                                      star["dim_products"], ts).collect()
    got = {(r.month, r.product_category_name): r.total_price for r in lit}
    assert got[(3, "beleza_saude")] == 12.5 * 4


def test_star_is_order_independent(spark, sources):
    shuffled = {k: v.repartition(3) for k, v in sources.items()}
    a = build_star(sources)
    b = build_star(shuffled)
    for name in ("dim_customers", "dim_products", "fact_order_items", "fact_orders"):
        assert sorted(map(tuple, a[name].collect()), key=repr) == sorted(map(tuple, b[name].collect()), key=repr)


def test_money_stays_exact_in_decimal(spark):
    rows = [("o1", Decimal("0.10")), ("o1", Decimal("0.20"))]
    df = spark.createDataFrame(rows, "order_id string, payment_value decimal(18,2)")
    dim = spark.createDataFrame([("x", 1)], "payment_type string, payment_sk int")
    fp = df.selectExpr("order_id", "1 AS payment_sk", "payment_value")
    got = A.payment_distribution(fp, dim).first()
    assert got.total_value == 0.3


def test_stable_keys_across_refresh(spark, sources, star):
    more = sources["customers"].unionByName(
        spark.createDataFrame([("c0", "u0", "00001", "novo", "ba")], SCHEMAS["customers"]))
    st = Star({**sources, "customers": more}, previous={"dim_customers": star["dim_customers"]})
    got = {r.customer_id: r.customer_sk for r in st["dim_customers"].collect()}
    assert got == {"c1": 1, "c2": 2, "c0": 3}  # c0 sorts first but is new: numbered after the max
    fresh = {r.customer_id: r.customer_sk for r in Star({**sources, "customers": more})["dim_customers"].collect()}
    assert fresh == {"c0": 1, "c1": 2, "c2": 3}


def test_spark_sql_over_registered_views(spark, star):
    """The star answers plain SQL once registered as views."""
    from starloom.sinks import register_views
    register_views(spark, star)
    by_sql = spark.sql("""
        SELECT p.product_category_name, SUM(i.price + i.freight_value) AS total_price, d.year, d.month
        FROM fact_order_items i
        JOIN fact_orders o ON o.order_id = i.order_id
        JOIN dim_products p ON i.product_sk = p.product_sk
        JOIN dim_date d ON d.date_id = o.purchase_date_id
        GROUP BY d.year, d.month, p.product_category_name""").collect()
    by_df = A.revenue_by_category_month(star["fact_order_items"], star["fact_orders"],
                                        star["dim_products"], star["dim_date"]).collect()
    assert sorted(map(tuple, by_sql), key=repr) == sorted(map(tuple, by_df), key=repr)
    rep = spark.sql("""SELECT customer_sk, COUNT(DISTINCT order_id) AS num_orders FROM fact_orders
                       GROUP BY customer_sk HAVING COUNT(DISTINCT order_id) > 1
                       ORDER BY num_orders DESC""").collect()
    assert [(r.customer_sk, r.num_orders) for r in rep] == [(1, 2)]
    for name in star:
        spark.catalog.dropTempView(name)


def test_database_names_as_view_aliases(spark, star):
    """SQL that names the item fact as the original database load did runs as is."""
    from starloom.sinks import DATABASE_NAMES, register_views
    register_views(spark, star, aliases=DATABASE_NAMES)
    got = spark.sql("""SELECT ds.seller_city, ds.seller_state, SUM(fa.price + fa.freight_value) AS total_price
                       FROM fact_orders_items fa JOIN dim_seller ds ON fa.seller_sk = ds.seller_sk
                       GROUP BY ds.seller_city, ds.seller_state
                       ORDER BY ds.seller_city, ds.seller_state LIMIT 10""").collect()
    want = A.seller_locations_first10(star["fact_order_items"], star["dim_seller"]).collect()
    assert [(r.seller_city, r.seller_state, float(r.total_price)) for r in got] == \
        [(r.seller_city, r.seller_state, r.total_price) for r in want]
    for name in [*star, *DATABASE_NAMES]:
        spark.catalog.dropTempView(name)
