"""Publication by one rename, checks taken by the writes, incremental refreshes."""

import os
import subprocess
import sys
import tempfile
import textwrap
import threading

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SF_SMALL
from starloom.plans import checks as C
from starloom.plans import observed
from starloom.plans.star import TABLES
from starloom.sinks import (PublishConflict, TableEntry, Versions, published_checks, published_counts, read_star,
                            write_star, write_star_tables)
from starloom.sinks.parts import changed_parts, part_digests
from starloom.sources.testdata import testdata_sources as roles_of


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="starloom-test-")


def runs(target):
    return set(os.listdir(os.path.join(target, "data")))


def files(target):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(os.path.join(target, "data")) for f in names if f.endswith(".parquet")}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def small(spark):
    """The sources as small written tables, so that builds are quick."""
    folder = tempfile.mkdtemp(prefix="starloom-sources-")
    out = {}
    for name, df in roles_of(spark, SF_SMALL).items():
        df.write.parquet(f"{folder}/{name}")
        out[name] = spark.read.parquet(f"{folder}/{name}")
    return out


def test_a_reader_sees_one_version_only(spark, scratch):
    """While a writer publishes, every read finds all tables of one version."""
    names = [f"t{i}" for i in range(4)]
    put = lambda v: write_star({n: spark.range(3).withColumn("v", F.lit(v)) for n in names}, scratch, keep=10)
    put(0)
    seen, wrong, stop = set(), [], threading.Event()

    def read():
        while not stop.is_set():
            got = {n: {r.v for r in df.collect()} for n, df in read_star(spark, scratch, names=names).items()}
            values = set().union(*got.values())
            seen.update(values)
            if len(values) != 1:
                wrong.append(got)
    reader = threading.Thread(target=read)
    reader.start()
    try:
        for v in range(1, 6):
            put(v)  # the versions a reader may hold are kept
    finally:
        stop.set()
        reader.join()
    assert not wrong and len(seen) > 1
    assert {r.v for r in read_star(spark, scratch, names=names)["t3"].collect()} == {5}


def test_old_versions_go_and_kept_ones_stay_readable(spark, scratch):
    for v in range(4):
        write_star({"a": spark.range(v + 1), "b": spark.range(1)} if v == 0 else {"a": spark.range(v + 1)}, scratch)
    versions = Versions(spark, scratch)
    assert versions.numbers() == [3, 4]
    assert [read_star(spark, scratch, ["a"], version=n)["a"].count() for n in (3, 4)] == [3, 4]
    assert read_star(spark, scratch, ["b"])["b"].count() == 1  # of the first run, named by every version since
    assert len(runs(scratch)) == 3


def test_the_second_of_two_publishers_is_refused(spark, scratch):
    versions = Versions(spark, scratch)
    base = versions.current()
    entry = TableEntry([], spark.range(1).schema.jsonValue())
    versions.publish({"t": entry}, base)
    with pytest.raises(PublishConflict):
        versions.publish({"t": entry}, base)
    assert versions.numbers() == [1] and not [n for n in os.listdir(f"{scratch}/_manifest") if n.startswith("draft")]


def test_a_build_killed_before_the_rename_changes_nothing(spark, small, scratch):
    """The driver of a refresh dies with all tables written; the next build
    publishes and removes what it left."""
    first = write_star_tables(spark, small, scratch)
    before = {n: rows(first[n]) for n in ("dim_customers", "fact_payments")}
    script = textwrap.dedent("""
        import os, sys
        sys.path.insert(0, sys.argv[1])
        from starloom import get_session
        from starloom.sinks import versions
        from starloom.sinks import write_star
        spark = get_session(master="local[2]", shuffle_partitions=2)
        real = versions.Folders.rename
        versions.Folders.rename = lambda self, src, dst: os._exit(9) if "_manifest" in dst else real(self, src, dst)
        write_star({"dim_customers": spark.range(3), "fact_payments": spark.range(4)}, sys.argv[2])
    """)
    done = subprocess.run([sys.executable, "-c", script, ROOT, scratch], capture_output=True, timeout=300)
    assert done.returncode == 9
    versions = Versions(spark, scratch)
    assert versions.numbers() == [1] and len(runs(scratch)) == 2
    assert any(n.startswith("draft") for n in os.listdir(f"{scratch}/_manifest"))
    now = read_star(spark, scratch)
    assert {n: rows(now[n]) for n in before} == before
    assert versions.recover() == []  # too young: it may be a build at work
    assert len(versions.recover(older_than=0)) == 2
    assert len(runs(scratch)) == 1
    write_star({"dim_payments": now["dim_payments"]}, scratch)
    assert Versions(spark, scratch).numbers() == [1, 2]


def test_a_failing_check_publishes_nothing(spark, small, scratch):
    write_star_tables(spark, small, scratch, checks="all", require=True)
    assert published_checks(spark, scratch).where("not passed").count() == 0
    fewer = {**small, "customers": small["customers"].where("customer_id > 20")}
    with pytest.raises(C.StarCheckFailed, match="orphan_keys|null_key"):
        write_star_tables(spark, fewer, scratch, checks="all", require=True)
    assert Versions(spark, scratch).numbers() == [1] and len(runs(scratch)) == 1
    # the same build, reported instead of required
    write_star_tables(spark, fewer, scratch, checks="all")
    failed = {(r.check, r.subject) for r in published_checks(spark, scratch).where("not passed").collect()}
    assert ("null_key", "fact_orders.customer_sk") in failed


def test_checks_of_the_writes_equal_those_of_a_scan(spark, small, scratch):
    fewer = {**small, "products": small["products"].where("product_id % 3 = 0")}
    star = write_star_tables(spark, fewer, scratch, checks="all")
    assert rows(published_checks(spark, scratch)) == rows(C.check_star(fewer, star).select(*C.CHECK_COLUMNS))
    assert rows(published_counts(spark, scratch)) == rows(C.table_counts(star))


def test_counting_while_writing_adds_no_scan(spark, small, scratch):
    """V1, V2 and C1 come from the jobs that write; no other job reads a fact."""
    watch = observed.Watch(small)
    from starloom.plans.star import build_dimensions, build_facts
    dims = build_dimensions(small)
    fact = build_facts(watch.fact_sources("fact_payments"), dims, names=["fact_payments"])["fact_payments"]
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    watch.table("fact_payments", fact).write.parquet(os.path.join(scratch, "t"))
    jobs = len(set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - set(before))
    metrics = {"fact_payments": watch.metrics("fact_payments")}
    n = small["order_payments"].count()
    assert metrics["fact_payments"] == {"rows": n, "null payment_sk": 0}
    assert watch.source_rows(metrics) == {"fact_payments": n}
    plain = os.path.join(scratch, "plain")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    fact.write.parquet(plain)
    assert jobs == len(set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - set(before))


def test_a_source_counted_twice_is_counted_again(spark, small, monkeypatch):
    """Metrics below a shuffle may count a task twice when an executor is lost."""
    watch = observed.Watch(small)
    watch._read["fact_payments"] = observed.Observation()
    monkeypatch.setattr(observed, "taken", lambda seen: {"rows": 10 ** 9})
    n = small["order_payments"].count()
    assert watch.source_rows({"fact_payments": {"rows": n}}) == {"fact_payments": n}
    monkeypatch.setattr(observed, "taken", lambda seen: None)
    assert watch.source_rows({"fact_payments": {"rows": n}}) == {"fact_payments": n}


def test_check_star_scans_every_table_once(spark, small, scratch):
    star = write_star_tables(spark, small, scratch)
    plan = C.check_star(small, star)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == len(TABLES) + 4  # and the sources of the four facts
    assert plan.count("Aggregate [family") == 2
    assert "Join" not in plan


def changed_sources(small, spark):
    """A day's orders get another status, a day's items go, one customer is new."""
    day = small["orders"].agg(F.min("order_purchase_timestamp")).first()[0]
    ship = small["order_items"].agg(F.max("shipping_limit_date")).first()[0]
    orders = small["orders"].withColumn("order_status", F.when(F.col("order_purchase_timestamp") == F.lit(day), "changed")
                                        .otherwise(F.col("order_status")))
    new = small["customers"].limit(1).withColumn("customer_id", F.lit(-5).cast(small["customers"].schema["customer_id"].dataType))
    return {**small, "orders": orders, "customers": small["customers"].unionByName(new),
            "order_items": small["order_items"].where(F.col("shipping_limit_date") != F.lit(ship))}


def test_incremental_refresh_writes_changed_days_only(spark, small, scratch):
    sources = {**small, "orders": small["orders"].where("order_id <= 300")}
    sources["order_items"] = small["order_items"].where("order_id <= 60")
    first = write_star_tables(spark, sources, scratch, incremental=True)
    v1 = Versions(spark, scratch).current()
    assert rows(first["fact_orders"].select("order_id")) == rows(sources["orders"].select("order_id"))
    stamps = files(scratch)

    write_star_tables(spark, sources, scratch, incremental=True)  # nothing changed: no fact file is written
    v2 = Versions(spark, scratch).current()
    for fact in ("fact_orders", "fact_order_items", "fact_payments", "fact_reviews"):
        assert v2.tables[fact].folders == v1.tables[fact].folders

    after = changed_sources(sources, spark)
    star = write_star_tables(spark, after, scratch, incremental=True)
    v3 = Versions(spark, scratch).current()
    moved = {f: set(v3.tables[f].folders) ^ set(v2.tables[f].folders) for f in v3.tables if f.startswith("fact")}
    assert len(moved["fact_orders"]) == 2 and len(moved["fact_order_items"]) == 1  # one day rewritten, one gone
    assert not moved["fact_payments"] and not moved["fact_reviews"]
    now = files(scratch)
    kept = [f for f in stamps if "/fact_" in f and f in now]
    assert kept and all(now[f] == stamps[f] for f in kept)

    # equal to a full rebuild with the same keys
    full = write_star_tables(spark, after, tempfile.mkdtemp(prefix="starloom-test-"), previous=read_star(spark, scratch, version=2))
    for n in TABLES:
        assert rows(star[n].select(*full[n].columns)) == rows(full[n]), n
    assert rows(published_counts(spark, scratch)) == rows(C.table_counts(star))


def test_digests_tell_rows_apart(spark):
    base = [(1, "a", None), (1, None, "a"), (2, "b", "c"), (None, "d", "e")]
    frame = lambda r: spark.createDataFrame(r, "d int, x string, y string")
    of = lambda r: {d["part"]: d.asDict() for d in part_digests(frame(r), "t", "d").collect()}
    one = of(base)
    assert set(one) == {"1", "2", "none"} and one["1"]["rows"] == 2
    assert of(base[::-1]) == one
    assert of([(1, "a", None), (1, "a", None), *base[2:]])["1"] != one["1"]
    assert of([(1, None, "a"), (1, None, "a"), *base[2:]])["1"] != one["1"]
    twice = of([base[0], base[0], base[1], base[1]])["1"]
    assert twice["digest"] != one["1"]["digest"] and twice["rows"] == 4
    assert rows(changed_parts(frame(base[:3]), frame([*base[:2], (3, "n", "n"), base[3]]), "t", "d")) == [
        ("2", "gone", 1, 0), ("3", "new", 0, 1), ("none", "new", 0, 1)]


def test_unknown_options_are_refused(spark, small, scratch):
    for bad in ({"fmt": "csv", "stable_keys": True}, {"fmt": "table", "require": True}, {"checks": "some"}):
        with pytest.raises(ValueError):
            write_star_tables(spark, small, scratch, **bad)
