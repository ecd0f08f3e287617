"""Sources (S1-S6) and sinks (K1-K6) on small files in a fresh scratch folder."""

import os
import tempfile

import pytest

from starloom.sinks import jdbc_options, read_star, write_csv, write_jdbc, write_star, write_star_tables
from starloom.sources import SCHEMAS, category_translation, load_sources, profile_sources, read_csv
from starloom.sources.readers import MissingExtract
from starloom.sources.testdata import testdata_sources as roles_of

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="starloom-test-")


def test_csv_bom_quotes_newlines_and_null_tokens(spark, scratch):
    path = os.path.join(scratch, "reviews.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("﻿review_id,order_id,review_score,review_comment_title,review_comment_message,"
                "review_creation_date,review_answer_timestamp\n")
        f.write('r1,o1,5,NA,"x\nyz",2024-01-01 00:00:00,2024-01-02 10:00:00\n')
        f.write('r2,o2,1,,"he said ""hi""",2024-01-03 00:00:00,\n')
    df = read_csv(spark, path, SCHEMAS["order_reviews"])
    assert df.columns[0] == "review_id"  # BOM dropped from the header
    rows = {r.review_id: r for r in df.collect()}
    assert rows["r1"].review_comment_message == "x\nyz"
    assert rows["r1"].review_comment_title == "NA"  # text unless listed as a null token
    assert rows["r2"].review_comment_message == 'he said "hi"'
    assert rows["r2"].review_comment_title is None and rows["r2"].review_answer_timestamp is None
    nulled = read_csv(spark, path, SCHEMAS["order_reviews"], null_tokens=["NA"])
    assert nulled.where("review_id = 'r1'").first().review_comment_title is None


def test_zip_prefix_keeps_leading_zero(spark, scratch):
    path = os.path.join(scratch, "customers.csv")
    with open(path, "w") as f:
        f.write("customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n")
        f.write("c1,u1,01001,sao paulo,SP\n")
    src = load_sources(spark, scratch, names=["customers", "geolocation"])
    assert list(src) == ["customers"]  # an absent optional extract is skipped
    with pytest.raises(MissingExtract, match="orders.csv"):
        load_sources(spark, scratch, names=["customers", "orders"])
    assert src["customers"].first().customer_zip_code_prefix == "01001"
    prof = profile_sources(src).first()
    assert (prof.source, prof.row_count, prof.column_count) == ("customers", 1, 5)


def test_translation_from_csv_and_rows(spark, scratch):
    path = os.path.join(scratch, "t.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("﻿product_category_name,product_category_name_english\nbeleza_saude,health_beauty")
    assert category_translation(spark, path).first().product_category_name == "beleza_saude"
    assert category_translation(spark, rows=[("a", "b")]).count() == 1


def test_csv_sink_round_trip(spark, scratch):
    df = spark.createDataFrame([("a\nb", 'q"x', None)], "s string, t string, u string")
    out = os.path.join(scratch, "csv")
    write_csv(df, out)
    back = read_csv(spark, out, df.schema).first()
    assert (back.s, back.t, back.u) == ("a\nb", 'q"x', None)


def test_jdbc_sink_append_and_overwrite(spark):
    opts = jdbc_options("jdbc:derby:memory:starloom_test;create=true",
                        driver="org.apache.derby.jdbc.EmbeddedDriver", batchsize=2)
    df = spark.createDataFrame([(i, f"v{i}") for i in range(5)], "k int, v string")
    write_jdbc(df, "dim_x", opts, mode="overwrite")
    write_jdbc(df, "dim_x", opts, mode="overwrite", truncate=True)
    write_jdbc(df, "dim_x", opts, mode="append")
    back = spark.read.format("jdbc").options(**opts).option("dbtable", "dim_x").load()
    assert back.count() == 10


def test_write_star_tables_and_staged_swap(spark, scratch):
    star = write_star_tables(spark, roles_of(spark, SF), scratch)
    assert set(star) == {"dim_date", "dim_customers", "dim_products", "dim_seller", "dim_payments",
                         "fact_orders", "fact_order_items", "fact_payments", "fact_reviews"}
    assert sorted(os.listdir(scratch)) == ["_manifest", "data"] and len(os.listdir(os.path.join(scratch, "data"))) == 1
    n_items = star["fact_order_items"].count()
    assert n_items == spark.read.parquet(f"{SF}/lineitem.parquet").count()
    # a second write replaces its tables and leaves the others of the version
    write_star({"dim_payments": star["dim_payments"].limit(2)}, scratch)
    after = read_star(spark, scratch)
    assert after["dim_payments"].count() == 2 and after["fact_order_items"].count() == n_items


def test_failed_refresh_leaves_previous_star_whole(spark, scratch):
    """Dimensions and facts are published together: a refresh that fails while
    writing the facts changes no table and removes its run folder."""
    from pyspark.sql import functions as F
    first = write_star_tables(spark, roles_of(spark, SF), scratch)
    before = {n: sorted(map(tuple, first[n].collect())) for n in ("dim_customers", "fact_orders")}
    broken = roles_of(spark, SF)
    # a column only the item fact reads fails at run time; the dimensions build fine
    broken["order_items"] = broken["order_items"].withColumn(
        "price", F.raise_error(F.lit("boom")).cast("decimal(18,2)"))
    broken["customers"] = broken["customers"].where(F.col("customer_id") % 2 == 0)
    with pytest.raises(Exception):
        write_star_tables(spark, broken, scratch)
    after = read_star(spark, scratch)
    assert len(os.listdir(os.path.join(scratch, "data"))) == 1
    for n, rows in before.items():
        assert sorted(map(tuple, after[n].collect())) == rows
    assert after["fact_order_items"].count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()


def test_write_star_tables_to_csv(spark, scratch):
    star = write_star_tables(spark, roles_of(spark, SF), scratch, fmt="csv", parallel=2)
    back = read_star(spark, scratch)
    assert sorted(back["dim_payments"].collect()) == sorted(star["dim_payments"].collect())
    assert back["fact_order_items"].count() == star["fact_order_items"].count()
    assert star["fact_order_items"].count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()


def test_write_star_csv(spark, scratch):
    df = spark.createDataFrame([(1, "x")], "k int, v string")
    locs = write_star({"t1": df}, scratch, fmt="csv")
    assert read_csv(spark, locs["t1"], df.schema).count() == 1


def test_write_star_over_jdbc(spark, scratch):
    opts = jdbc_options("jdbc:derby:memory:starloom_star;create=true",
                        driver="org.apache.derby.jdbc.EmbeddedDriver")
    star = write_star_tables(spark, roles_of(spark, SF), scratch)
    small = {n: star[n] for n in ("dim_payments", "dim_seller")}
    write_star(small, "", fmt="jdbc", jdbc=opts)
    write_star(small, "", fmt="jdbc", jdbc=opts)  # full refresh replaces, not appends
    back = spark.read.format("jdbc").options(**opts).option("dbtable", "dim_seller").load()
    assert back.count() == star["dim_seller"].count()


def test_bucketed_facts_join_without_shuffle(spark, scratch):
    from starloom.plans import analytics as A
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        star = write_star_tables(spark, roles_of(spark, SF), scratch, fmt="table",
                                 table_opts={"num_buckets": 4})
        joined = star["fact_order_items"].join(star["fact_orders"], "order_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == star["fact_order_items"].count()
        rev = A.revenue_by_category_month(star["fact_order_items"], star["fact_orders"],
                                          star["dim_products"], star["dim_date"], broadcast_max_rows=0)
        assert rev.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_csv_header_is_checked_against_schema(spark, scratch):
    path = os.path.join(scratch, "sellers.csv")
    with open(path, "w") as f:
        f.write("seller_zip_code_prefix,seller_id,seller_city,seller_state\n13000,s1,campinas,sp\n")
    with pytest.raises(Exception):
        read_csv(spark, path, SCHEMAS["sellers"]).collect()


def test_only_free_text_extracts_are_read_multi_line(spark, scratch):
    """Line-by-line extracts split across tasks; review text keeps its line breaks."""
    with open(os.path.join(scratch, "sellers.csv"), "w") as f:
        f.write("seller_id,seller_zip_code_prefix,seller_city,seller_state\n")
        for i in range(5000):
            f.write(f"s{i:05d},{i % 99999:05d},campinas,SP\n")
    with open(os.path.join(scratch, "order_reviews.csv"), "w") as f:
        f.write("review_id,order_id,review_score,review_comment_title,review_comment_message,"
                "review_creation_date,review_answer_timestamp\n")
        f.write('r1,o1,5,,"two\nlines",2024-01-01 00:00:00,\n')
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        src = load_sources(spark, scratch, names=["sellers", "order_reviews"])
        assert src["sellers"].rdd.getNumPartitions() > 1
        assert src["sellers"].count() == 5000
        assert src["order_reviews"].count() == 1
        assert src["order_reviews"].first().review_comment_message == "two\nlines"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_write_star_tables_with_exact_date_lookup(spark, scratch):
    """Exact lookups tie every fact to dim_date, so the build runs as one group."""
    from starloom.plans.star import DIMENSIONS, FACTS, table_groups
    assert table_groups("exact") == [(list(DIMENSIONS), list(FACTS))]
    star = write_star_tables(spark, roles_of(spark, SF), scratch, grain="timestamp",
                             include_shipping=False, date_lookup="exact")
    assert set(read_star(spark, scratch)) == {*DIMENSIONS, *FACTS}
    items = star["fact_order_items"]
    assert items.count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()
    # Shipping times are not date sources, so most have no exact id
    assert items.where("shipping_limit_date_id IS NULL").count() > 0
