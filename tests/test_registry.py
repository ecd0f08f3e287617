"""Key registries against a plain model over many refreshes."""

import random

import pytest

from starloom.operators.registry import RETIRED, as_registry, high_water, next_registry, registered_keys
from starloom.operators.keys import dense_key
from starloom.plans.star import Star
from starloom.sinks import KEYED, read_star, registry_name, write_star_tables
from test_star import sources  # noqa: F401  (the fixture)


def frame(spark, members):
    return spark.createDataFrame([(m, f"v{m}") for m in members], "k string, v string")


def test_keys_over_refreshes(spark):
    """Members come, go and come back; the null member is one of them."""
    rng = random.Random(3)
    everyone = [None, *(f"m{i:02d}" for i in range(30))]
    registry, model, top = None, {}, 0
    for refresh in range(5):
        members = rng.sample(everyone, rng.randrange(8, 20))
        if refresh == 2:  # the member with the highest key goes, with others new in its place
            members = [m for m in members if model.get(m) != top]
        df = frame(spark, members).repartition(3)
        keyed = (dense_key(df, "k", "sk") if registry is None else registered_keys(df, registry, "k", "sk"))
        for m in sorted([m for m in members if m not in model], key=lambda m: (m is None, m or "")):
            top += 1
            model[m] = top
        assert {r.k: r.sk for r in keyed.collect()} == {m: model[m] for m in members}
        assert {r.k: r.v for r in keyed.collect()} == {m: f"v{m}" for m in members}
        registry = next_registry(registry, keyed, "k", "sk").checkpoint()
        assert {(r.k, r.sk, r[RETIRED]) for r in registry.collect()} == {(m, k, m not in members) for m, k in model.items()}
        assert high_water(registry, "sk") == top


def test_empty_refresh_retires_everyone(spark):
    keyed = dense_key(frame(spark, ["a", "b"]), "k", "sk")
    registry = as_registry(keyed, "k", "sk").checkpoint()
    none = registered_keys(frame(spark, ["a"]).where("k = 'z'"), registry, "k", "sk")
    assert none.count() == 0
    registry = next_registry(registry, none, "k", "sk").checkpoint()
    assert [r[RETIRED] for r in registry.collect()] == [True, True]
    back = registered_keys(frame(spark, ["b", "c"]), registry, "k", "sk")
    assert {r.k: r.sk for r in back.collect()} == {"b": 2, "c": 3}


@pytest.mark.parametrize("fmt", ["parquet", "table"])
def test_a_retired_key_is_not_given_to_another_member(spark, sources, tmp_path, fmt):  # noqa: F811
    target = str(tmp_path / "star")
    opts = {"fmt": fmt, "stable_keys": True}
    if fmt == "table":
        spark.sql("CREATE DATABASE IF NOT EXISTS registry_test")
        opts["table_opts"] = {"database": "registry_test", "num_buckets": 2}
    keys = lambda star: {r.customer_id: r.customer_sk for r in star["dim_customers"].collect()}
    customers = sources["customers"]
    first = write_star_tables(spark, sources, target, **opts)
    assert keys(first) == {"c1": 1, "c2": 2}
    gone = write_star_tables(spark, {**sources, "customers": customers.where("customer_id = 'c1'")}, target, **opts)
    assert keys(gone) == {"c1": 1}
    new = spark.createDataFrame([("c0", "u", "1", "x", "y")], customers.schema)
    third = write_star_tables(spark, {**sources, "customers": customers.where("customer_id = 'c1'").union(new)}, target, **opts)
    assert keys(third) == {"c1": 1, "c0": 3}  # 2 was c2's
    back = write_star_tables(spark, sources, target, **opts)
    assert keys(back) == {"c1": 1, "c2": 2}
    if fmt == "parquet":
        kept = read_star(spark, target, names=[registry_name("dim_customers")])[registry_name("dim_customers")]
        assert {(r.customer_id, r.customer_sk, r[RETIRED]) for r in kept.collect()} == {("c1", 1, False), ("c2", 2, False), ("c0", 3, True)}


def test_star_published_without_registry_starts_one(spark, sources, tmp_path):  # noqa: F811
    target = str(tmp_path)
    write_star_tables(spark, sources, target)
    more = spark.createDataFrame([("a0", "u", "1", "x", "y")], sources["customers"].schema)
    star = write_star_tables(spark, {**sources, "customers": sources["customers"].union(more)}, target, stable_keys=True)
    assert {r.customer_id: r.customer_sk for r in star["dim_customers"].collect()} == {"c1": 1, "c2": 2, "a0": 3}
    assert set(read_star(spark, target, names=[registry_name(d) for d in KEYED]))


def test_keys_do_not_depend_on_partitions(spark, sources):  # noqa: F811
    st = Star(sources)
    registry = {"dim_customers": as_registry(st["dim_customers"].where("customer_id <> 'c1'"), "customer_id", "customer_sk")}
    one, two = (Star({**sources, "customers": sources["customers"].repartition(n)}, registries=registry) for n in (1, 5))
    assert sorted(one["dim_customers"].collect()) == sorted(two["dim_customers"].collect())
