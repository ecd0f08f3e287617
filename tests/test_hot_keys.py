"""Keys that hold a large part of a table take no task's memory."""

from __future__ import annotations

from starloom.operators.lookups import lookup_key, remember_rows
from starloom.plans import checks as C


def plan(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def test_rows_without_partner_are_counted_by_key_before_the_join(spark):
    fact = spark.createDataFrame([(0,)] * 50 + [(1,), (2,), (None,)], "product_sk int")
    dim = spark.createDataFrame([(1,), (2,), (3,), (None,)], "product_sk int")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for dimensions too large to broadcast
    try:
        out = C.items_without_product(fact, dim)
        text = out._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert text.index("Join LeftAnti") < text.index("Aggregate [product_sk")
    assert out.first()[0] == 51


def test_lookup_beyond_the_broadcast_bound_sorts_no_fact_rows(spark):
    fact = spark.createDataFrame([(None, 1)] * 20 + [("a", 2), ("b", 3), ("z", 4)], "nk string, v int")
    dim = remember_rows(spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "nk string, sk long"), 3)
    for null_safe, nulls in ((False, 0), (True, 3)):
        out = lookup_key(fact, dim, "nk", "sk", unknown=0, null_safe=null_safe, broadcast_max_rows=2)
        assert "ShuffledHashJoin" in plan(out) and "Sort" not in plan(out).replace("SortMerge", "Sort")
        assert sorted(map(tuple, out.collect()), key=str) == sorted(
            [(None, 1, nulls)] * 20 + [("a", 2, 1), ("b", 3, 2), ("z", 4, 0)], key=str)
