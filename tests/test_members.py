"""Inferred and unknown members, proven key types, day sketches, database loads."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from starloom.operators.casts import checked, downcast, narrow_key
from starloom.operators.keys import dense_key
from starloom.operators.lookups import known_top, remember_top
from starloom.operators.members import INFERRED, with_inferred
from starloom.plans import analytics as A
from starloom.plans import checks as C
from starloom.plans.sketches import daily_sketches, distinct_keys, merged, standard_error
from starloom.plans.star import Star
from starloom.sinks import jdbc_options, published_checks, read_star, write_star_tables
from starloom.sinks.jdbc import append_batch, replace_tables
from starloom.sources.testdata import flawed_sources
from test_star import sources  # noqa: F401  (the fixture)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def total(df, col="total_price"):
    return round(float(df.agg(F.sum(col)).first()[0]), 6)


def test_reports_lose_no_revenue(spark, sources):  # noqa: F811
    plain, st = Star(sources), Star(sources, infer_members=True)
    paid = total(sources["order_items"].select((F.col("price") + F.col("freight_value")).alias("total_price")))
    by = lambda s: [total(A.revenue_by_category_month(s["fact_order_items"], s["fact_orders"], s["dim_products"], s["dim_date"])),
                    total(A.top_sellers_by_revenue(s["fact_order_items"], s["dim_seller"], n=None)),
                    total(A.seller_locations_first10(s["fact_order_items"], s["dim_seller"], n=None))]
    assert by(st) == [paid] * 3 and by(plain)[0] < paid  # p9 is no known product
    assert rows(st["dim_products"].where(INFERRED).select("product_sk", "product_id", "product_category_name_english")) == [
        (0, None, "unknown"), (4, "p9", "unknown")]
    assert rows(st["dim_customers"].where(INFERRED).select("customer_sk", "customer_id")) == [(0, None), (3, "c9")]
    failed = [r for r in C.check_star(sources, st).collect() if not r.passed]
    # c1 and p9 are members now; product_id in the dimension's own rows is unique again
    assert not [r for r in failed if r.check in ("orphan_keys", "unique", "null_key", "unknown_key")]


def test_an_inferred_member_is_filled_in_place(spark, sources, tmp_path):  # noqa: F811
    target = str(tmp_path)
    opts = {"stable_keys": True, "infer_members": True, "checks": "all"}
    first = write_star_tables(spark, sources, target, **opts)
    assert first["dim_products"].where("product_id = 'p9'").first()[INFERRED] is True
    real = spark.createDataFrame([("p9", "casa", 1, 1, 1, 1.0, 1.0, 1.0, 1.0)], sources["products"].schema)
    more = spark.createDataFrame([("p0", "casa", 1, 1, 1, 1.0, 1.0, 1.0, 1.0)], sources["products"].schema)
    second = write_star_tables(spark, {**sources, "products": sources["products"].union(real).union(more)}, target, **opts)
    keys = {r.product_id: (r.product_sk, r.product_category_name, r[INFERRED]) for r in second["dim_products"].collect()}
    assert keys["p9"] == (4, "casa", False) and keys["p0"] == (5, "casa", False) and keys[None] == (0, None, True)
    kept = read_star(spark, target, names=["keys_dim_products"])["keys_dim_products"]
    assert 0 not in {r.product_sk for r in kept.collect()}
    assert published_checks(spark, target).where("not passed").count() == 0


def test_members_of_null_and_repeated_keys(spark):
    members = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    used = spark.createDataFrame([(1,), (2,), (2,), (None,)], "x int")
    assert rows(with_inferred(members, "k", [used, used])) == [(1, "a", False), (2, None, True), (None, "n", False)]
    assert rows(with_inferred(members.limit(0), "k", [used.limit(0)])) == []


def test_flawed_sources_fail_every_kind_of_check(spark):
    st = Star(flawed_sources(spark, SF_SMALL))
    failed = {r.check for r in C.check_star(st.sources, st).collect() if not r.passed}
    assert failed == {"null_key", "unknown_key", "orphan_keys", "unique"}


def test_keys_are_narrowed_where_they_are_proven_to_fit(spark):
    keyed = dense_key(spark.range(5).toDF("n"), "n", "sk")
    assert known_top(keyed) == 5
    assert keyed.select(narrow_key(keyed, "sk")).dtypes == [("sk", "int")]
    far = dense_key(spark.range(3).toDF("n"), "n", "sk", first=2 ** 31 - 2)
    assert known_top(far) == 2 ** 31
    wide = far.select(narrow_key(far, "sk"))
    assert wide.dtypes == [("sk", "bigint")] and rows(wide) == [(2 ** 31 - 2,), (2 ** 31 - 1,), (2 ** 31,)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_an_overflow_never_wraps(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(1, 2 ** 31), (None, 3)], "a long, b long")
        assert known_top(df) is None
        for cast in (downcast(df, ["a", "b"]), df.select(narrow_key(df, "b")), df.select(checked(F.col("b"), "int"))):
            with pytest.raises(Exception, match="out of range"):
                cast.collect()
        assert rows(downcast(df, ["a"])) == [(1, 2 ** 31), (None, 3)]
        widened = downcast(df, ["a", "b"], on_overflow="widen")
        assert widened.dtypes == [("a", "int"), ("b", "bigint")] and widened.count() == 2
        assert rows(downcast(df, ["b"], on_overflow="null")) == [(1, None), (None, 3)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_a_key_beyond_int_reaches_the_fact_whole(spark, sources):  # noqa: F811
    dim = Star(sources)["dim_products"]
    big = remember_top(dim.withColumn("product_sk", F.col("product_sk").cast("long") + 2 ** 31), 2 ** 31 + 3)
    fact = Star(sources, dimensions={"dim_products": big})["fact_order_items"]
    assert dict(fact.dtypes)["product_sk"] == "bigint"
    assert {r.product_sk for r in fact.collect()} == {0, 2 ** 31 + 1, 2 ** 31 + 2}


def test_sketches_of_days_merge(spark):
    rng = random.Random(1)
    data = [(d, rng.randrange(30_000)) for d in range(40) for _ in range(2000)] + [(None, 7), (3, None)]
    fact = spark.createDataFrame(data, "purchase_date_id int, customer_sk long").repartition(4)
    days = daily_sketches(fact, "customer_sk")
    assert days.count() == 41 and {r.purchase_date_id: r.rows for r in days.collect()}[3] == 2001
    for size in (1, 7, 40):
        part = F.floor(F.col("purchase_date_id") / size).alias("part")
        got = {r.part: r.distinct_keys for r in distinct_keys(days, [part]).collect()}
        for p in range(40 // size):
            exact = len({k for d, k in data if d is not None and d // size == p and k is not None})
            assert abs(got[p] / exact - 1) < 4 * standard_error()
    changed = spark.createDataFrame([(3, 1), (3, 2)], fact.schema)
    after = merged(days, daily_sketches(changed, "customer_sk"), "purchase_date_id", [3])
    got = {r.purchase_date_id: (r.rows, r.distinct_keys) for r in distinct_keys(after, ["purchase_date_id"]).collect()}
    assert got[3] == (2, 2) and got[None] == (1, 1) and len(got) == 41


@pytest.fixture()
def database(request):
    return jdbc_options(f"jdbc:derby:memory:starloom_{abs(hash(request.node.name))};create=true",
                        driver="org.apache.derby.jdbc.EmbeddedDriver", batchsize=50)


def read(spark, options, table):
    return rows(spark.read.format("jdbc").options(**options).option("dbtable", table).load())


def frames(spark, v, n=3):
    return {t: spark.createDataFrame([(i, f"{t}{v}") for i in range(n)], "k int, v string") for t in ("dim_a", "fact_b")}


def test_a_database_refresh_is_one_step(spark, database):
    for v in (1, 2):
        replace_tables(spark, frames(spark, v), database)
        assert read(spark, database, "fact_b") == [(i, f"fact_b{v}") for i in range(3)]
    broken = frames(spark, 3)
    broken["fact_b"] = broken["fact_b"].withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        replace_tables(spark, broken, database)
    assert read(spark, database, "dim_a") == [(i, "dim_a2") for i in range(3)]  # loaded, and not switched
    replace_tables(spark, frames(spark, 4, n=1), database)
    assert read(spark, database, "dim_a") == [(0, "dim_a4")] and read(spark, database, "fact_b") == [(0, "fact_b4")]


def test_a_star_is_published_and_loaded_in_one_call(spark, sources, tmp_path, database):  # noqa: F811
    star = write_star_tables(spark, sources, str(tmp_path), jdbc=database, jdbc_names={"fact_order_items": "fact_orders_items"})
    assert read(spark, database, "dim_seller") == rows(star["dim_seller"])
    items = spark.read.format("jdbc").options(**database).option("dbtable", "fact_orders_items").load()
    assert rows(items) == rows(star["fact_order_items"])
    orders = spark.read.format("jdbc").options(**database).option("dbtable", "fact_orders").load()
    assert rows(orders.select("order_id", "customer_sk", "delay_days")) == rows(star["fact_orders"].select("order_id", "customer_sk", "delay_days"))


def test_a_switch_that_fails_is_undone(spark, database, monkeypatch):
    from starloom.sinks import jdbc
    replace_tables(spark, frames(spark, 1), database)
    real, calls = jdbc.Connection.run, []

    def run(self, sql):
        calls.append(sql)
        if len(calls) == 4:
            raise RuntimeError("lost connection")
        return real(self, sql)
    monkeypatch.setattr(jdbc.Connection, "run", run)
    with pytest.raises(RuntimeError):
        replace_tables(spark, frames(spark, 2), database)
    monkeypatch.undo()
    assert read(spark, database, "dim_a") == [(i, "dim_a1") for i in range(3)]
    assert read(spark, database, "fact_b") == [(i, "fact_b1") for i in range(3)]
    replace_tables(spark, frames(spark, 3), database)
    assert read(spark, database, "dim_a") == [(i, "dim_a3") for i in range(3)]


def test_a_batch_is_appended_once(spark, database):
    assert append_batch(spark, frames(spark, 1, 2), database, "2024-01-01")
    assert not append_batch(spark, frames(spark, 1, 2), database, "2024-01-01")
    broken = frames(spark, 2, 2)
    broken["fact_b"] = broken["fact_b"].withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        append_batch(spark, broken, database, "2024-01-02")
    assert len(read(spark, database, "dim_a")) == 2  # nothing of the failed batch
    assert append_batch(spark, frames(spark, 2, 2), database, "2024-01-02")
    assert read(spark, database, "dim_a") == [(0, "dim_a1"), (0, "dim_a2"), (1, "dim_a1"), (1, "dim_a2")]


def test_names_are_checked(spark, database):
    with pytest.raises(ValueError):
        replace_tables(spark, {"x; DROP TABLE y": spark.range(1)}, database)
    with pytest.raises(ValueError):
        append_batch(spark, frames(spark, 1), database, "it's")
    with pytest.raises(ValueError, match="rename"):
        replace_tables(spark, frames(spark, 1), {"url": "jdbc:other:x"})
