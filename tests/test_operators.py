import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators import (DuplicateLookupKey, anti_rows, dense_key, downcast, downcast_report,
                                exact_date_key, keep_existing_keys, keep_first, lookup_key,
                                missing_keys, stack_columns)


def test_keep_first_uses_tiebreak_and_all_columns(spark):
    df = spark.createDataFrame([("c1", "b", 2), ("c1", "a", 9), ("c2", "z", 1), (None, "q", 1),
                                (None, "p", 5)], "k string, city string, n int")
    got = sorted(keep_first(df, "k", order_by=["n"]).collect(), key=lambda r: str(r.k))
    assert [(r.k, r.city, r.n) for r in got] == [(None, "q", 1), ("c1", "b", 2), ("c2", "z", 1)]
    got2 = {r.k: r.city for r in keep_first(df, "k").collect()}
    assert got2 == {"c1": "a", "c2": "z", None: "p"}


def test_keep_first_hot_key_is_combined_map_side(spark):
    # a third of all rows share one key; the plan must aggregate partially
    rows = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
                                     (F.col("id") * 7 % 1000).alias("v"))
    out = keep_first(rows, "k", order_by=["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan or "partial_" in plan
    assert out.where("k = -1").collect()[0].v == 0
    assert out.count() == 20001


def test_dense_key_matches_global_rank_when_bounds_are_sampled(spark):
    # big enough that range bounds come from a sample, spread over many input partitions
    n = 300_000
    df = spark.range(n).select(((F.col("id") * 7919) % n).cast("string").alias("k")).repartition(23)
    out = dense_key(df, "k", "sk", num_buckets=17)
    got = out.select("k", "sk").toPandas()
    assert len(got) == n
    assert sorted(got.sk) == list(range(1, n + 1))
    assert (got.sort_values("k").sk.values == range(1, n + 1)).all()


def test_dense_key_is_independent_of_input_partitioning(spark):
    base = spark.createDataFrame([(f"id{i:03d}", i) for i in range(200)], "k string, v int")
    a = {r.k: r.sk for r in dense_key(base.repartition(1), "k", "sk", 3).collect()}
    b = {r.k: r.sk for r in dense_key(base.repartition(9), "k", "sk", 7).collect()}
    assert a == b and sorted(a.values()) == list(range(1, 201))


def test_dense_key_nulls_last(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    got = {r.k: r.sk for r in dense_key(df, "k", "sk").collect()}
    assert got == {"a": 1, "b": 2, None: 3}


def test_keep_existing_keys(spark):
    prev = spark.createDataFrame([("a", 1), ("c", 2)], "k string, sk long")
    new = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "k string")
    got = {r.k: r.sk for r in keep_existing_keys(new, prev, "k", "sk").collect()}
    assert got == {"a": 1, "c": 2, "b": 3, "d": 4}


def test_lookup_null_keys_and_unknown_member(spark):
    fact = spark.createDataFrame([("x",), (None,), ("zz",)], "k string")
    dim = spark.createDataFrame([("x", 1), (None, 2)], "k string, sk int")
    plain = {r.k: r.sk for r in lookup_key(fact, dim, "k", "sk").collect()}
    assert plain == {"x": 1, None: None, "zz": None}
    safe = {r.k: r.sk for r in lookup_key(fact, dim, "k", "sk", null_safe=True).collect()}
    assert safe == {"x": 1, None: 2, "zz": None}
    unk = {r.k: r.sk for r in lookup_key(fact, dim, "k", "sk", unknown=0).collect()}
    assert unk == {"x": 1, None: 0, "zz": 0}


def test_exact_date_key_literal_behaviour(spark):
    lookup = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10), 20240101)], "date timestamp_ntz, date_id int")
    fact = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10),), (dt.datetime(2024, 1, 1, 11),)],
                                 "t timestamp_ntz")
    got = sorted(r.t_id or 0 for r in exact_date_key(fact, "t", lookup, "t_id").collect())
    assert got == [0, 20240101]  # the 11:00 timestamp is not in the lookup: null (D2)
    dup = lookup.union(lookup)
    with pytest.raises(DuplicateLookupKey):
        exact_date_key(fact, "t", dup, "t_id")


def test_stack_and_set_difference(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "a int, b int")
    assert sorted(r.v for r in stack_columns(df, ["a", "b"], "v").where("v is not null").collect()) == [1, 2, 3]
    left = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,)], "k int")
    assert [r.k for r in missing_keys(left, right, "k").collect()] == [2]
    # the LEFT JOIN ... IS NULL form keeps null keys and duplicates
    assert sorted(str(r.k) for r in anti_rows(left, right, "k").collect()) == ["2", "2", "None"]


def test_downcast_report_and_overflow(spark):
    df = spark.createDataFrame([(1, 3000000000), (None, 5)], "a long, b long")
    rep = {r.column: r for r in downcast_report(df, ["a", "b"]).collect()}
    assert (rep["a"].null_count, rep["a"].overflow_count, rep["a"].castable) == (1, 0, False)
    assert (rep["b"].null_count, rep["b"].overflow_count, rep["b"].castable) == (0, 1, False)
    assert [r.b for r in downcast(df, ["b"], on_overflow="null").collect()] == [None, 5]
    with pytest.raises(Exception):
        downcast(df, ["b"]).collect()


def test_dense_key_with_coalesced_slices(spark):
    """Default slicing lets AQE merge neighbouring ranges; keys stay exact."""
    n = 200_000
    df = spark.range(n).select(((F.col("id") * 104729) % n).cast("string").alias("k")).repartition(13)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        out = dense_key(df, "k", "sk")
        slices = out.select(F.spark_partition_id().alias("p")).distinct().count()
        got = out.select("k", "sk").toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    assert 1 < slices < 40
    assert (got.sort_values("k").sk.values == range(1, n + 1)).all()
