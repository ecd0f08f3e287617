"""DuckDB statements that answer the same questions as the Spark queries.

They read the test tables (pre-registered as views) and spell out the source
roles, dimensions and facts as CTEs, so each statement is self-contained.
Types are cast to what the Spark side produces; decimals end as DOUBLE,
dates as 'YYYY-MM-DD' and timestamps as 'YYYY-MM-DD HH:MM:SS.ffffff' text, as
in ``starloom.plans.registry.portable``.
"""

from __future__ import annotations

TITLE = ("array_to_string(list_transform(regexp_extract_all(lower({c}), "
         "'(\\p{{L}}+|[^\\p{{L}}]+)', 1), lambda w: upper(w[1]) || w[2:]), '')")


def title(c: str) -> str:
    return TITLE.format(c=c)


def date_id(c: str) -> str:
    return f"CAST(strftime({c}, '%Y%m%d') AS INTEGER)"


def ts_text(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


def floor_days(end: str, start: str) -> str:
    return f"CAST(floor((epoch_us({end}) - epoch_us({start})) / 86400000000) AS INTEGER)"


CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name, sql, deps=()):
    CTES[name] = (sql, tuple(deps))


cte("src_orders", f"""
SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, o.o_orderstatus AS order_status,
       o.o_orderdate AS order_purchase_timestamp,
       CASE WHEN o.o_orderstatus <> 'P' THEN o.o_orderdate END AS order_approved_at,
       li.first_ship AS order_delivered_carrier_date,
       li.last_ship AS order_delivered_customer_date,
       o.o_orderdate + INTERVAL 30 DAY AS order_estimated_delivery_date
FROM orders o
LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
           FROM lineitem GROUP BY l_orderkey) li ON o.o_orderkey = li.l_orderkey""")

cte("src_items", """
SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
       l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS freight_value
FROM lineitem""")

cte("src_customers", """
SELECT c.c_custkey AS customer_id,
       concat_ws('-', c.c_mktsegment, CAST(c.c_nationkey AS VARCHAR)) AS customer_unique_id,
       lpad(CAST(c.c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
       n.n_name AS customer_city, lower(r.r_name) AS customer_state
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")

cte("src_sellers", """
SELECT s.s_suppkey AS seller_id, lpad(CAST(s.s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
       n.n_name AS seller_city, lower(r.r_name) AS seller_state
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")

cte("src_products", """
SELECT p_partkey AS product_id, p_type AS product_category_name,
       CAST(length(p_name) AS INTEGER) AS product_name_lenght,
       CAST(length(p_brand) AS INTEGER) AS product_description_lenght,
       p_size AS product_photos_qty, p_retailprice AS product_weight_g,
       CAST(p_size AS DOUBLE) AS product_length_cm, CAST(p_size % 10 AS DOUBLE) AS product_height_cm,
       CAST(p_size % 7 AS DOUBLE) AS product_width_cm
FROM part""")

cte("translation", """
SELECT * FROM (VALUES ('ECONOMY', 'economy'), ('LARGE', 'large'), ('MEDIUM', 'medium'),
                      ('PROMO', 'promo'), ('SMALL', 'small'))
       AS t(product_category_name, product_category_name_english)""")

cte("src_payments", f"""
SELECT CAST(user_id * 100000000 + {date_id('ts')} AS BIGINT) AS order_id, event_type AS payment_type,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS payment_installments,
       CAST(value AS DECIMAL(18,2)) AS payment_value
FROM events""")

cte("src_reviews", f"""
SELECT l.doc_id AS review_id, CAST(e.user_id * 100000000 + {date_id('e.ts')} AS BIGINT) AS order_id,
       l.quality AS review_score, CAST(NULL AS VARCHAR) AS review_comment_title,
       CAST(NULL AS VARCHAR) AS review_comment_message, e.ts AS review_creation_date,
       CASE WHEN l.toxic = 0 THEN e.ts + INTERVAL 1 DAY END AS review_answer_timestamp
FROM labels l LEFT JOIN events e ON l.doc_id = e.event_id""")

ORDER_TS = ("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date")
REVIEW_TS = ("review_creation_date", "review_answer_timestamp")


def _dim_date(values_cte: str) -> str:
    return f"""
SELECT {date_id('d')} AS date_id, d AS date, CAST(year(d) AS INTEGER) AS year,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
       monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS day,
       CAST(isodow(d) AS INTEGER) AS weekday, dayname(d) AS weekday_name,
       isodow(d) >= 6 AS is_weekend
FROM {values_cte}"""


cte("dd_day_values", f"""
SELECT DISTINCT d FROM (
  SELECT CAST(unnest([{', '.join(ORDER_TS)}]) AS DATE) AS d FROM src_orders
  UNION ALL SELECT CAST(unnest([{', '.join(REVIEW_TS)}]) AS DATE) FROM src_reviews
  UNION ALL SELECT CAST(shipping_limit_date AS DATE) FROM src_items) v
WHERE d IS NOT NULL""", ("src_orders", "src_reviews", "src_items"))
cte("dim_date", _dim_date("dd_day_values"), ("dd_day_values",))

cte("dd_ts_values", f"""
SELECT DISTINCT d FROM (
  SELECT unnest([{', '.join(ORDER_TS)}]) AS d FROM src_orders
  UNION ALL SELECT unnest([{', '.join(REVIEW_TS)}]) FROM src_reviews) v
WHERE d IS NOT NULL""", ("src_orders", "src_reviews"))
cte("dim_date_ts", _dim_date("dd_ts_values"), ("dd_ts_values",))

cte("dim_customers", f"""
SELECT CAST(row_number() OVER (ORDER BY customer_id NULLS LAST) AS INTEGER) AS customer_sk,
       customer_id, customer_unique_id, customer_zip_code_prefix,
       {title('customer_city')} AS customer_city, upper(customer_state) AS customer_state
FROM (SELECT * FROM src_customers
      QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY customer_unique_id NULLS FIRST,
              customer_zip_code_prefix NULLS FIRST, customer_city NULLS FIRST,
              customer_state NULLS FIRST) = 1) c""", ("src_customers",))

cte("dim_seller", f"""
SELECT CAST(row_number() OVER (ORDER BY seller_id NULLS LAST) AS INTEGER) AS seller_sk,
       seller_id, seller_zip_code_prefix, {title('seller_city')} AS seller_city,
       upper(seller_state) AS seller_state
FROM (SELECT * FROM src_sellers
      QUALIFY row_number() OVER (PARTITION BY seller_id ORDER BY seller_zip_code_prefix NULLS FIRST,
              seller_city NULLS FIRST, seller_state NULLS FIRST) = 1) s""", ("src_sellers",))

PRODUCT_MEASURES = ("product_name_lenght", "product_description_lenght", "product_photos_qty",
                    "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")

cte("dim_products", f"""
SELECT CAST(row_number() OVER (ORDER BY product_id NULLS LAST) AS INTEGER) AS product_sk,
       product_id, product_category_name, product_category_name_english, {', '.join(PRODUCT_MEASURES)}
FROM (SELECT p.*, coalesce(t.product_category_name_english, 'unknown') AS product_category_name_english
      FROM src_products p LEFT JOIN translation t ON p.product_category_name = t.product_category_name
      QUALIFY row_number() OVER (PARTITION BY p.product_id ORDER BY p.product_category_name NULLS FIRST,
      {', '.join('p.' + m + ' NULLS FIRST' for m in PRODUCT_MEASURES)},
      t.product_category_name_english NULLS FIRST) = 1) x""", ("src_products", "translation"))

cte("dim_payments", """
SELECT payment_type, CAST(row_number() OVER (ORDER BY payment_type NULLS LAST) AS INTEGER) AS payment_sk
FROM (SELECT DISTINCT payment_type FROM src_payments) p""", ("src_payments",))

cte("fact_orders", f"""
SELECT o.order_id, o.order_status, o.order_purchase_timestamp, o.order_approved_at,
       o.order_delivered_carrier_date, o.order_delivered_customer_date,
       o.order_estimated_delivery_date, c.customer_sk,
       {date_id('o.order_purchase_timestamp')} AS purchase_date_id,
       {date_id('o.order_approved_at')} AS approved_date_id,
       {date_id('o.order_delivered_carrier_date')} AS delivered_carrier_date_id,
       {date_id('o.order_delivered_customer_date')} AS delivered_customer_date_id,
       {date_id('o.order_estimated_delivery_date')} AS estimated_delivery_date_id,
       {floor_days('o.order_delivered_customer_date', 'o.order_purchase_timestamp')} AS delivery_days,
       {floor_days('o.order_delivered_customer_date', 'o.order_estimated_delivery_date')} AS delay_days,
       CASE WHEN o.order_delivered_customer_date IS NULL THEN 'undelivered'
            WHEN o.order_estimated_delivery_date IS NULL THEN 'unknown'
            WHEN {floor_days('o.order_delivered_customer_date', 'o.order_estimated_delivery_date')} < 0 THEN 'early'
            WHEN {floor_days('o.order_delivered_customer_date', 'o.order_estimated_delivery_date')} = 0 THEN 'on_time'
            ELSE 'late' END AS delivery_performance
FROM src_orders o LEFT JOIN dim_customers c ON o.customer_id = c.customer_id""",
    ("src_orders", "dim_customers"))

cte("fact_order_items", f"""
SELECT i.order_id, i.order_item_id, CAST(coalesce(p.product_sk, 0) AS INTEGER) AS product_sk,
       CAST(coalesce(s.seller_sk, 0) AS INTEGER) AS seller_sk,
       {date_id('i.shipping_limit_date')} AS shipping_limit_date_id,
       i.price, i.freight_value, i.price + i.freight_value AS item_total
FROM src_items i LEFT JOIN dim_products p ON i.product_id = p.product_id
LEFT JOIN dim_seller s ON i.seller_id = s.seller_id""", ("src_items", "dim_products", "dim_seller"))

cte("fact_payments", """
SELECT p.order_id, d.payment_sk, p.payment_installments, p.payment_value,
       p.payment_installments > 1 AS is_installment
FROM src_payments p LEFT JOIN dim_payments d ON p.payment_type = d.payment_type""",
    ("src_payments", "dim_payments"))

cte("fact_reviews", f"""
SELECT review_id, order_id, review_score, review_comment_title, review_comment_message,
       review_creation_date, review_answer_timestamp,
       {date_id('review_creation_date')} AS creation_date_id,
       {date_id('review_answer_timestamp')} AS answer_date_id
FROM src_reviews""", ("src_reviews",))


def with_ctes(body: str, *needs: str, over: dict[str, tuple[str, tuple[str, ...]]] | None = None) -> str:
    """``body`` behind the CTEs it needs; ``over`` replaces some of them."""
    known = {**CTES, **(over or {})}
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in known[n][1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({known[n][0]}\n)" for n in order) + "\n" + body


def _replaced(name: str, **columns: str) -> tuple[str, tuple[str, ...]]:
    return (f"SELECT * REPLACE ({', '.join(f'{sql} AS {c}' for c, sql in columns.items())}) FROM ({CTES[name][0]}) x", CTES[name][1])


# the sources with faults, and the customer dimension with one region twice
FLAWED = {
    "src_orders": _replaced("src_orders", customer_id="CASE WHEN order_status <> 'P' THEN customer_id END",
                            order_purchase_timestamp="CASE WHEN order_delivered_carrier_date IS NOT NULL THEN order_purchase_timestamp END"),
    "src_customers": (f"""
SELECT * FROM ({CTES['src_customers'][0]}) x WHERE customer_unique_id NOT LIKE 'MACHINERY%'
UNION ALL SELECT * REPLACE ('elsewhere' AS customer_city) FROM ({CTES['src_customers'][0]}) y WHERE customer_unique_id LIKE 'BUILDING%'""", ()),
    "src_products": (_replaced("src_products", product_id="CASE WHEN NOT (product_category_name = 'SMALL' AND product_photos_qty <= 10) "
                               "THEN product_id END")[0] + " WHERE product_category_name <> 'LARGE'", ()),
    "src_sellers": (f"SELECT * FROM ({CTES['src_sellers'][0]}) x WHERE seller_state <> 'asia'", ()),
    "src_items": _replaced("src_items", product_id="CASE WHEN freight_value <> 0 THEN product_id END"),
    "src_payments": _replaced("src_payments", payment_type="CASE WHEN payment_installments >= 10 THEN payment_type END"),
    "src_reviews": (f"""
SELECT x.* REPLACE (d.source AS review_comment_title, d.text AS review_comment_message)
FROM ({CTES['src_reviews'][0]}) x LEFT JOIN documents d ON x.review_id = d.doc_id""", ()),
    "dim_customers_twice": ("SELECT * FROM dim_customers UNION ALL SELECT * FROM dim_customers WHERE customer_state = 'EUROPE'",
                            ("dim_customers",)),
}


def with_flaws(body: str, *needs: str) -> str:
    body = body.replace("FROM dim_customers", "FROM dim_customers_twice").replace("JOIN dim_customers", "JOIN dim_customers_twice")
    return with_ctes(body, *needs, "dim_customers_twice", over=FLAWED)


STAR = ("dim_date", "dim_customers", "dim_products", "dim_seller", "dim_payments",
        "fact_orders", "fact_order_items", "fact_payments", "fact_reviews")
STAR_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "labels")
STAR_TABLE_WIDTH = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6,
                    "orders": 6, "lineitem": 11, "events": 6, "labels": 3}


def _revenue(dim_date_cte: str) -> str:
    return with_ctes(f"""
SELECT p.product_category_name, CAST(SUM(i.price + i.freight_value) AS DOUBLE) AS total_price,
       dd.year, dd.month
FROM fact_order_items i JOIN fact_orders o ON o.order_id = i.order_id
JOIN dim_products p ON i.product_sk = p.product_sk
JOIN {dim_date_cte} dd ON dd.date_id = o.purchase_date_id
GROUP BY dd.year, dd.month, p.product_category_name""",
                     "fact_order_items", "fact_orders", "dim_products", dim_date_cte)


DATE_COLS = ("date_id, strftime(date, '%Y-%m-%d') AS date, year, quarter, month, month_name, day, "
             "weekday, weekday_name, is_weekend")
DATE_COLS_TS = (f"date_id, {ts_text('date')} AS date, year, quarter, month, month_name, day, "
                "weekday, weekday_name, is_weekend")

LINEITEM_COLS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                 "l_shipdate")
LINEITEM_TIEBREAK = ("l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice",
                     "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def _check_rows(rows: list[tuple[str, str, str, str]], source: str) -> str:
    """(check, subject, observed expr, expected expr) rows over one aggregate."""
    parts = [f"SELECT '{c}' AS \"check\", '{s}' AS subject, CAST({o} AS BIGINT) AS observed, "
             f"CAST({e} AS BIGINT) AS expected FROM {source}" for c, s, o, e in rows]
    return "\nUNION ALL ".join(parts)


def _row_count_sql() -> str:
    pairs = [("src_orders", "fact_orders"), ("src_items", "fact_order_items"),
             ("src_payments", "fact_payments"), ("src_reviews", "fact_reviews")]
    parts = [f"SELECT 'row_count' AS \"check\", '{f}' AS subject, "
             f"(SELECT count(*) FROM {f}) AS observed, (SELECT count(*) FROM {s}) AS expected"
             for s, f in pairs]
    return "SELECT *, observed = expected AS passed FROM (" + "\nUNION ALL ".join(parts) + ") r"


def _null_key_sql() -> str:
    fo = "(SELECT count(*) FILTER (WHERE customer_sk IS NULL) AS a, count(*) FILTER (WHERE purchase_date_id IS NULL) AS b FROM fact_orders) x"
    fp = "(SELECT count(*) FILTER (WHERE payment_sk IS NULL) AS a FROM fact_payments) x"
    fi = ("(SELECT count(*) FILTER (WHERE product_sk IS NULL) AS a, count(*) FILTER (WHERE product_sk = 0) AS b, "
          "count(*) FILTER (WHERE seller_sk IS NULL) AS c, count(*) FILTER (WHERE seller_sk = 0) AS d "
          "FROM fact_order_items) x")
    body = "\nUNION ALL ".join([
        _check_rows([("null_key", "fact_orders.customer_sk", "a", "0"),
                     ("null_key", "fact_orders.purchase_date_id", "b", "0")], fo),
        _check_rows([("null_key", "fact_payments.payment_sk", "a", "0")], fp),
        _check_rows([("null_key", "fact_order_items.product_sk", "a", "0"),
                     ("unknown_key", "fact_order_items.product_sk", "b", "0"),
                     ("null_key", "fact_order_items.seller_sk", "c", "0"),
                     ("unknown_key", "fact_order_items.seller_sk", "d", "0")], fi)])
    return "SELECT *, observed = expected AS passed FROM (" + body + ") r"


UNIQUE_KEYS = (("dim_customers", "customer_id", "customer_sk"), ("dim_date", "date", "date_id"),
               ("dim_payments", "payment_type", "payment_sk"),
               ("dim_products", "product_id", "product_sk"), ("dim_seller", "seller_id", "seller_sk"))


def _unique_sql() -> str:
    parts = []
    for t, nk, sk in UNIQUE_KEYS:
        src = f"(SELECT count(*) AS n, count(DISTINCT {nk}) AS u, count(DISTINCT {sk}) AS s FROM {t}) x"
        parts.append(_check_rows([("unique", f"{t}.{nk}", "u", "n"),
                                  ("unique", f"{t}.{sk}", "s", "n")], src))
    return "SELECT *, observed = expected AS passed FROM (" + "\nUNION ALL ".join(parts) + ") r"


def _orphans(subject, left, lk, right, rk) -> str:
    return (f"SELECT 'orphan_keys' AS \"check\", '{subject}' AS subject, "
            f"(SELECT count(*) FROM (SELECT DISTINCT {lk} AS k FROM {left} WHERE {lk} IS NOT NULL) a "
            f"WHERE NOT EXISTS (SELECT 1 FROM {right} b WHERE b.{rk} = a.k)) AS observed, "
            f"CAST(0 AS BIGINT) AS expected")


def _coverage_sql() -> str:
    parts = [
        _orphans("fact_orders.customer_sk", "fact_orders", "customer_sk", "dim_customers", "customer_sk"),
        _orphans("fact_orders.purchase_date", "fact_orders", "CAST(order_purchase_timestamp AS DATE)",
                 "dim_date", "date"),
        _orphans("order_payments.payment_type", "src_payments", "payment_type", "dim_payments", "payment_type"),
        _orphans("fact_payments.payment_sk", "fact_payments", "payment_sk", "dim_payments", "payment_sk"),
        _orphans("order_items.product_id", "src_items", "product_id", "dim_products", "product_id"),
        _orphans("fact_order_items.product_sk", "fact_order_items", "product_sk", "dim_products", "product_sk"),
        _orphans("order_items.seller_id", "src_items", "seller_id", "dim_seller", "seller_id"),
        _orphans("fact_order_items.seller_sk", "fact_order_items", "seller_sk", "dim_seller", "seller_sk"),
    ]
    return ("SELECT *, observed = expected AS passed FROM (" + "\nUNION ALL ".join(parts) + ") r")


# family: where keys come from, and where they are used
FAMILIES = {
    "day": (("dim_date", "CAST(date AS DATE)"), ("fact_orders", "CAST(order_purchase_timestamp AS DATE)")),
    "dim_customers.customer_id": (("dim_customers", "customer_id"), None),
    "dim_customers.customer_sk": (("dim_customers", "customer_sk"), ("fact_orders", "customer_sk")),
    "dim_date.date": (("dim_date", "date"), None),
    "dim_date.date_id": (("dim_date", "date_id"), None),
    "dim_payments.payment_type": (("dim_payments", "payment_type"), ("src_payments", "payment_type")),
    "dim_payments.payment_sk": (("dim_payments", "payment_sk"), ("fact_payments", "payment_sk")),
    "dim_products.product_id": (("dim_products", "product_id"), ("src_items", "product_id")),
    "dim_products.product_sk": (("dim_products", "product_sk"), ("fact_order_items", "product_sk")),
    "dim_seller.seller_id": (("dim_seller", "seller_id"), ("src_items", "seller_id")),
    "dim_seller.seller_sk": (("dim_seller", "seller_sk"), ("fact_order_items", "seller_sk")),
}


def _reconcile_sql() -> str:
    parts = []
    for family, (home, used) in FAMILIES.items():
        side = lambda s: (f"(SELECT CAST({s[1]} AS VARCHAR) AS k, count(*) AS n FROM {s[0]} GROUP BY 1)" if s
                          else "(SELECT CAST(NULL AS VARCHAR) AS k, CAST(0 AS BIGINT) AS n WHERE false)")
        n = lambda what, where: f"CAST(coalesce({what} FILTER (WHERE {where}), 0) AS BIGINT)"
        has, lacks = "k IS NOT NULL", "k IS NULL"
        parts.append(f"""
SELECT '{family}' AS family, {n('sum(h)', 'true')} AS home_rows, {n('sum(h)', lacks)} AS home_nulls,
       {n('count(*)', has + ' AND h > 0')} AS home_keys, {n('count(*)', has + ' AND h > 1')} AS home_repeated,
       {n('sum(u)', 'true')} AS used_rows, {n('sum(u)', lacks)} AS used_nulls,
       {n('count(*)', has + ' AND u > 0')} AS used_keys, {n('count(*)', has + ' AND u > 0 AND h = 0')} AS orphans,
       {n('count(*)', has + ' AND h > 0 AND u = 0')} AS unused, {n('count(*)', has + ' AND h > 0 AND u > 0')} AS shared,
       {n('sum(u)', "k = '0'")} AS unknown_rows
FROM (SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) AS h, coalesce(b.n, 0) AS u
      FROM {side(home)} a FULL JOIN {side(used)} b ON a.k IS NOT DISTINCT FROM b.k) z""")
    return "\nUNION ALL ".join(parts)


_ALL = STAR + ("src_orders", "src_items", "src_payments", "src_reviews")


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["source_profile"] = "\nUNION ALL ".join(
        f"SELECT '{t}' AS source, CAST(count(*) AS BIGINT) AS row_count, "
        f"CAST({STAR_TABLE_WIDTH[t]} AS INTEGER) AS column_count FROM {t}" for t in STAR_TABLES)
    q["dim_date_day"] = with_ctes(f"SELECT {DATE_COLS} FROM dim_date", "dim_date")
    q["dim_date_timestamp"] = with_ctes(f"SELECT {DATE_COLS_TS} FROM dim_date_ts", "dim_date_ts")
    for t in ("dim_customers", "dim_products", "dim_seller", "dim_payments"):
        q[t] = with_ctes(f"SELECT * FROM {t}", t)
    q["fact_orders"] = with_ctes(
        "SELECT * REPLACE (" + ", ".join(f"{ts_text(c)} AS {c}" for c in ORDER_TS) + ") FROM fact_orders",
        "fact_orders")
    q["fact_reviews"] = with_ctes(
        "SELECT * REPLACE (" + ", ".join(f"{ts_text(c)} AS {c}" for c in REVIEW_TS) + ") FROM fact_reviews",
        "fact_reviews")
    q["fact_order_items"] = with_ctes(
        "SELECT order_id, order_item_id, product_sk, seller_sk, shipping_limit_date_id, "
        "CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value, "
        "CAST(item_total AS DOUBLE) AS item_total FROM fact_order_items", "fact_order_items")
    q["fact_payments"] = with_ctes(
        "SELECT order_id, payment_sk, payment_installments, CAST(payment_value AS DOUBLE) AS payment_value, "
        "is_installment FROM fact_payments", "fact_payments")
    q["fact_reviews_literal"] = with_ctes(
        f"SELECT review_id, order_id, review_score, review_comment_title, review_comment_message, "
        f"{date_id('review_creation_date')} AS review_creation_date, "
        f"{date_id('review_answer_timestamp')} AS review_answer_timestamp FROM src_reviews", "src_reviews")
    q["delivery_days_floor"] = with_ctes(
        "SELECT order_id, delivery_days, delay_days, delivery_performance FROM fact_orders", "fact_orders")
    q["delivery_performance_mix"] = with_ctes(
        "SELECT delivery_performance, count(*) AS order_count, avg(delay_days) AS average_delay "
        "FROM fact_orders GROUP BY delivery_performance", "fact_orders")
    q["event_day_offsets"] = f"""
SELECT e.event_id, {floor_days('e.ts', 'f.first_ts')} AS days_since_first,
       {floor_days('f.first_ts', 'e.ts')} AS days_before_first
FROM events e JOIN (SELECT user_id, min(ts) AS first_ts FROM events GROUP BY user_id) f
  ON e.user_id = f.user_id"""
    q["title_case"] = (f"SELECT p_partkey, {title('p_name')} AS p_name_title, "
                       f"{title('p_brand')} AS p_brand_title, {title('p_type')} AS p_type_title FROM part")
    q["dedupe_keep_first"] = (
        f"SELECT {', '.join(c if c != 'l_shipdate' else ts_text(c) + ' AS l_shipdate' for c in LINEITEM_COLS)} "
        f"FROM lineitem QUALIFY row_number() OVER ("
        f"PARTITION BY l_orderkey, l_linenumber ORDER BY "
        f"{', '.join(c + ' NULLS FIRST' for c in LINEITEM_TIEBREAK)}) = 1")
    q["date_lookup_exact"] = with_ctes(
        f"SELECT i.order_id, i.order_item_id, {ts_text('i.shipping_limit_date')} AS shipping_limit_date, "
        "d.date_id AS shipping_limit_date_id "
        "FROM src_items i LEFT JOIN dim_date_ts d ON i.shipping_limit_date = d.date",
        "src_items", "dim_date_ts")
    q["null_safe_join"] = with_ctes("""
SELECT r.review_id, s.answer_key AS answer_key_null_safe, p.answer_key AS answer_key_plain
FROM src_reviews r
LEFT JOIN m s ON r.review_answer_timestamp IS NOT DISTINCT FROM s.review_answer_timestamp
LEFT JOIN m p ON r.review_answer_timestamp = p.review_answer_timestamp""".replace(
        "FROM src_reviews r", "FROM src_reviews r").replace(
        "\nSELECT r.review_id", """, m AS (SELECT review_answer_timestamp,
  CAST(row_number() OVER (ORDER BY review_answer_timestamp NULLS LAST) AS BIGINT) AS answer_key
  FROM (SELECT DISTINCT review_answer_timestamp FROM src_reviews) t)
SELECT r.review_id""", 1), "src_reviews")
    q["revenue_by_category_month"] = _revenue("dim_date")
    q["revenue_by_category_month_literal"] = _revenue("dim_date_ts")
    q["revenue_fanout_literal"] = f"""
WITH p AS (SELECT {date_id('ts')} AS date_id, CAST(value AS DECIMAL(18,2)) AS revenue
           FROM events WHERE event_type = 'purchase'),
dd_day AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events WHERE ts IS NOT NULL),
dd_ts AS (SELECT DISTINCT ts AS d FROM events WHERE ts IS NOT NULL),
g AS (
  SELECT 'day' AS grain, CAST(year(d.d) AS INTEGER) AS year, CAST(month(d.d) AS INTEGER) AS month,
         p.revenue FROM p JOIN dd_day d ON p.date_id = {date_id('d.d')}
  UNION ALL
  SELECT 'timestamp', CAST(year(d.d) AS INTEGER), CAST(month(d.d) AS INTEGER), p.revenue
  FROM p JOIN dd_ts d ON p.date_id = {date_id('d.d')})
SELECT grain, year, month, count(*) AS joined_rows, CAST(SUM(revenue) AS DOUBLE) AS revenue
FROM g GROUP BY grain, year, month"""
    q["seller_location_first10"] = with_ctes("""
SELECT s.seller_city, s.seller_state, CAST(SUM(i.price + i.freight_value) AS DOUBLE) AS total_price
FROM fact_order_items i JOIN dim_seller s ON i.seller_sk = s.seller_sk
GROUP BY s.seller_city, s.seller_state
ORDER BY s.seller_city NULLS LAST, s.seller_state NULLS LAST LIMIT 10""", "fact_order_items", "dim_seller")
    q["top10_sellers"] = with_ctes("""
SELECT s.seller_sk, s.seller_id, s.seller_city, s.seller_state,
       CAST(SUM(i.price + i.freight_value) AS DOUBLE) AS total_price
FROM fact_order_items i JOIN dim_seller s ON i.seller_sk = s.seller_sk
GROUP BY s.seller_sk, s.seller_id, s.seller_city, s.seller_state
ORDER BY total_price DESC NULLS LAST, s.seller_id LIMIT 10""", "fact_order_items", "dim_seller")
    q["avg_delivery"] = with_ctes("""
SELECT round(avg(delivery_days), 6) AS average_delivery, round(avg(delay_days), 6) AS average_delays
FROM fact_orders WHERE delay_days IS NOT NULL""", "fact_orders")
    q["review_distribution"] = with_ctes(
        "SELECT review_score, count(*) AS review_count FROM fact_reviews GROUP BY review_score",
        "fact_reviews")
    q["payment_distribution"] = with_ctes("""
SELECT dp.payment_type, count(*) AS payment_count, CAST(SUM(fp.payment_value) AS DOUBLE) AS total_value
FROM dim_payments dp JOIN fact_payments fp ON dp.payment_sk = fp.payment_sk
GROUP BY dp.payment_type""", "dim_payments", "fact_payments")
    q["multi_payment_orders"] = with_ctes("""
SELECT order_id, count(*) AS orders_multiple_payments FROM fact_payments
GROUP BY order_id HAVING count(*) > 1""", "fact_payments")
    q["repeat_customers"] = with_ctes("""
SELECT customer_sk, count(DISTINCT order_id) AS num_orders FROM fact_orders
GROUP BY customer_sk HAVING count(DISTINCT order_id) > 1""", "fact_orders")
    q["repeat_customers_unique"] = with_ctes("""
SELECT c.customer_unique_id, count(DISTINCT o.order_id) AS num_orders
FROM fact_orders o JOIN dim_customers c ON o.customer_sk = c.customer_sk
GROUP BY c.customer_unique_id HAVING count(DISTINCT o.order_id) > 1""", "fact_orders", "dim_customers")
    q["repeat_customers_min15"] = with_ctes("""
SELECT customer_sk, count(DISTINCT order_id) AS num_orders FROM fact_orders
GROUP BY customer_sk HAVING count(DISTINCT order_id) >= 15""", "fact_orders")
    q["table_counts"] = with_ctes("\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in STAR), *STAR)
    q["orders_without_customer"] = with_ctes("""
SELECT count(*) AS orders_without_customer FROM fact_orders f1
LEFT JOIN dim_customers c1 ON f1.customer_sk = c1.customer_sk WHERE c1.customer_sk IS NULL""",
                                             "fact_orders", "dim_customers")
    q["products_without_items"] = with_ctes("""
SELECT count(*) AS products_without_items FROM dim_products p1
WHERE NOT EXISTS (SELECT 1 FROM fact_order_items f1 WHERE f1.product_sk = p1.product_sk)""",
                                            "dim_products", "fact_order_items")
    q["items_without_product"] = with_ctes("""
SELECT count(*) AS items_without_product FROM fact_order_items f1
LEFT JOIN dim_products p1 ON p1.product_sk = f1.product_sk WHERE p1.product_sk IS NULL""",
                                           "dim_products", "fact_order_items")
    q["duplicate_customer_keys"] = with_ctes("""
SELECT customer_sk, count(*) AS n FROM dim_customers GROUP BY customer_sk HAVING count(*) > 1""",
                                             "dim_customers")
    q["duplicate_item_keys"] = with_ctes("""
SELECT order_id, order_item_id, count(*) AS n FROM fact_order_items
GROUP BY order_id, order_item_id HAVING count(*) > 1""", "fact_order_items")
    q["row_count_match"] = with_ctes(_row_count_sql(), *_ALL)
    q["null_key_counts"] = with_ctes(_null_key_sql(), *_ALL)
    q["key_uniqueness"] = with_ctes(_unique_sql(), *_ALL)
    q["fk_coverage"] = with_ctes(_coverage_sql(), *_ALL)
    q["star_checks"] = with_ctes(
        "\nUNION ALL ".join(f"SELECT * FROM ({s}) z" for s in
                            (_row_count_sql(), _null_key_sql(), _unique_sql(), _coverage_sql())), *_ALL)
    cols = ("order_id", "customer_sk", "approved_date_id", "delivered_customer_date_id")
    q["downcast_check"] = with_ctes("\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS row_count, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"count(*) FILTER (WHERE {c} < -2147483648 OR {c} > 2147483647) AS overflow_count, "
        f"count(*) FILTER (WHERE {c} IS NULL) = 0 AND count(*) FILTER (WHERE {c} < -2147483648 OR {c} > 2147483647) = 0 AS castable "
        f"FROM fact_orders" for c in cols), "fact_orders")
    q["flawed_star_checks"] = with_flaws(
        "\nUNION ALL ".join(f"SELECT * FROM ({s}) z" for s in
                            (_row_count_sql(), _null_key_sql(), _unique_sql(), _coverage_sql())), *_ALL)
    q["key_reconciliation"] = with_flaws(_reconcile_sql(), *_ALL)
    q["flawed_integrity"] = with_flaws("""
SELECT (SELECT count(*) FROM fact_orders f WHERE NOT EXISTS (SELECT 1 FROM dim_customers d WHERE d.customer_sk = f.customer_sk))
         AS orders_without_customer,
       (SELECT count(*) FROM dim_products d WHERE NOT EXISTS (SELECT 1 FROM fact_order_items f WHERE d.product_sk = f.product_sk))
         AS products_without_items,
       (SELECT count(*) FROM fact_order_items f WHERE NOT EXISTS (SELECT 1 FROM dim_products d WHERE d.product_sk = f.product_sk))
         AS items_without_product,
       (SELECT count(*) FROM (SELECT customer_sk FROM dim_customers GROUP BY customer_sk HAVING count(*) > 1) x)
         AS duplicate_customer_keys""", *_ALL)
    q["flawed_fact_reviews"] = with_flaws(
        "SELECT * REPLACE (" + ", ".join(f"{ts_text(c)} AS {c}" for c in REVIEW_TS) + ") FROM fact_reviews", "fact_reviews")
    q["dim_products_inferred"] = with_flaws("""
SELECT CAST(row_number() OVER (ORDER BY product_id NULLS LAST) AS INTEGER) AS product_sk, product_id, product_category_name_english, is_inferred
FROM (SELECT product_id, product_category_name_english, false AS is_inferred FROM dim_products
      UNION ALL SELECT DISTINCT product_id, 'unknown', true FROM src_items i
      WHERE product_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_products p WHERE p.product_id = i.product_id)) m
UNION ALL SELECT 0, NULL, 'unknown', true""", "dim_products", "src_items")
    q["inferred_totals"] = with_flaws("""
SELECT report, (SELECT round(CAST(sum(price + freight_value) AS DOUBLE), 2) FROM src_items) AS revenue
FROM (VALUES ('fact'), ('category'), ('location'), ('seller')) v(report)""", "src_items")
    q["key_registry_refresh"] = with_ctes("""
SELECT customer_id, row_number() OVER (ORDER BY first_year, customer_id NULLS LAST) AS customer_sk,
       last_year < (SELECT max(year(order_purchase_timestamp)) FROM src_orders) AS retired
FROM (SELECT customer_id, min(y) AS first_year, max(y) AS last_year
      FROM (SELECT year(order_purchase_timestamp) AS y, CASE WHEN order_status <> 'P' THEN customer_id END AS customer_id
            FROM src_orders WHERE order_purchase_timestamp IS NOT NULL) m GROUP BY customer_id) g""", "src_orders")
    q["customers_by_year_sketched"] = with_ctes("""
SELECT CAST(purchase_date_id // 10000 AS INTEGER) AS year, count(DISTINCT customer_sk) AS customers, true AS estimate_within_bound
FROM fact_orders GROUP BY 1""", "fact_orders")
    q["refresh_changed_days"] = with_ctes(f"""
SELECT part, CASE WHEN old_rows = 0 THEN 'new' WHEN new_rows = 0 THEN 'gone' ELSE 'changed' END AS change, old_rows, new_rows
FROM (SELECT coalesce(CAST(a.d AS VARCHAR), 'none') AS part, coalesce(a.n, 0) AS old_rows, coalesce(b.n, 0) AS new_rows
      FROM (SELECT {date_id('order_purchase_timestamp')} AS d, count(*) AS n,
                   list_sort(list(concat_ws('|', order_id, order_status))) AS held FROM src_orders GROUP BY 1) a
      FULL JOIN (SELECT {date_id('order_purchase_timestamp')} AS d, count(*) AS n,
                        list_sort(list(concat_ws('|', order_id, order_status))) AS held
                 FROM (SELECT * REPLACE (CASE WHEN CAST(order_purchase_timestamp AS DATE) BETWEEN DATE '1997-06-01' AND DATE '1997-06-30'
                                              THEN 'X' ELSE order_status END AS order_status)
                       FROM src_orders WHERE CAST(order_purchase_timestamp AS DATE) IS DISTINCT FROM DATE '1998-03-03') c
                 GROUP BY 1) b ON a.d IS NOT DISTINCT FROM b.d
      WHERE a.held IS DISTINCT FROM b.held) x""", "src_orders")
    return q


ORACLE = build()
