"""Extracts that do not fit: nothing is lost in silence."""

import datetime as dt
import os
from decimal import Decimal

import pytest

from starloom.cli import main
from starloom.sinks import QUARANTINE, Versions, published_checks, read_star, write_star_tables
from starloom.sources import SCHEMAS, load_sources
from starloom.sources.quarantine import parse_csv
from starloom.sources.readers import MissingExtract, extract_files, extract_glob

ITEMS = ",".join(SCHEMAS["order_items"].names)
GOOD = ['o1,1,p1,s1,2024-01-02 00:00:00,10.5,1.5', 'o1,2,p1,s1,,3,']
BAD = {"a bad int": 'o2,x1,p1,s1,2024-01-02 00:00:00,1,1', "a bad timestamp": 'o3,1,p1,s1,not a date,1,1',
       "a date without time": 'o3,2,p1,s1,2024-01-02,1,1', "a short record": 'o4,1,p1', "a long one": 'o5,1,p1,s1,,1,1,extra',
       "two faults": 'o6,y,p1,s1,,z,1', "an int out of range": 'o7,99999999999,p1,s1,,1,1',
       "too many decimals": 'o8,1,p1,s1,,1.005,1'}


def put(folder, name, lines, header=None):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join([header or ",".join(SCHEMAS[name.split(".")[0].rstrip("_0123456789")].names), *lines]) + "\n")
    return path


def extracts(folder, items=GOOD):
    put(folder, "orders.csv", ["o1,c1,delivered,2024-01-01 10:00:00,,,2024-01-03 12:00:00,2024-01-05 00:00:00"])
    put(folder, "customers.csv", ["c1,u1,01001,sao paulo,sp"])
    put(folder, "products.csv", ["p1,casa,1,2,3,4.0,5.0,6.0,7.0"])
    put(folder, "sellers.csv", ["s1,13000,campinas,sp"])
    put(folder, "order_items.csv", items)
    put(folder, "order_payments.csv", ["o1,1,credit_card,2,11.5"])
    put(folder, "order_reviews.csv", ['r1,o1,5,,"good\nvery",2024-01-06 00:00:00,2024-01-07 08:00:00'])


@pytest.mark.parametrize("multi_line", [True, False])
def test_every_bad_record_is_kept_with_its_reason(spark, tmp_path, multi_line):
    path = put(tmp_path, "order_items.csv", [*GOOD, *BAD.values()])
    got = parse_csv(spark, path, SCHEMAS["order_items"], "order_items", multi_line=multi_line)
    assert got.rows.schema == SCHEMAS["order_items"]
    assert sorted(map(tuple, got.rows.collect()), key=repr) == [
        ("o1", 1, "p1", "s1", dt.datetime(2024, 1, 2), Decimal("10.50"), Decimal("1.50")), ("o1", 2, "p1", "s1", None, Decimal("3.00"), None)]
    reasons = {r.record.split(",")[0] + r.record.split(",")[1]: r.reason for r in got.rejected.collect()}
    assert reasons == {"o2x1": "order_item_id is no int", "o31": "shipping_limit_date is no timestamp_ntz",
                       "o32": "shipping_limit_date is no timestamp_ntz", "o41": "number of fields", "o51": "number of fields",
                       "o6y": "order_item_id is no int; price is no decimal(18,2)", "o81": "price is no decimal(18,2)", "o799999999999": "order_item_id is no int"}
    first = got.rejected.where("record LIKE 'o2,%'").first()
    assert first.source == "order_items" and first.file.endswith("order_items.csv")
    # whatever columns are read, the same records are rejected
    assert got.rows.select("order_id").count() == 2 and got.rejected.select("source").count() == len(BAD)
    assert got.rows.count() == 2


def test_null_tokens_are_no_fault(spark, tmp_path):
    path = put(tmp_path, "order_items.csv", ["o1,NA,p1,NA,NA,1,1"])
    got = parse_csv(spark, path, SCHEMAS["order_items"], "order_items", null_tokens=["NA", ""])
    row = got.rows.first()
    assert (row.order_item_id, row.seller_id, row.shipping_limit_date) == (None, None, None)
    assert got.rejected.count() == 0


def test_other_timestamp_formats(spark, tmp_path):
    path = put(tmp_path, "order_items.csv", ["o1,1,p1,s1,02/01/2024 10:30,1,1", "o2,1,p1,s1,2024-01-02 00:00:00,1,1"])
    got = parse_csv(spark, path, SCHEMAS["order_items"], "order_items", timestamp_format="dd/MM/yyyy HH:mm")
    assert got.rows.first().shipping_limit_date == dt.datetime(2024, 1, 2, 10, 30) and got.rejected.count() == 1


@pytest.mark.parametrize("fault", ["a bad int", "a bad timestamp", "a short record"])
def test_by_default_a_bad_record_fails(spark, tmp_path, fault):
    extracts(tmp_path, [*GOOD, BAD[fault]])
    src = load_sources(spark, str(tmp_path))
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|FAILED_READ_FILE"):
        src["order_items"].collect()
    null = load_sources(spark, str(tmp_path), on_bad="null")["order_items"]
    assert null.count() == 3


def test_files_of_an_extract():
    there = ["orders.csv", "orders_2.csv", "orders_10.csv", "orders_backup.csv", "orders_2_old.csv", "orders.csv.bak", "xorders.csv"]
    assert extract_files(there, "orders.csv") == ["orders.csv", "orders_10.csv", "orders_2.csv"]
    assert extract_files(["orders", "orders_1", "orders2"], "orders") == ["orders", "orders_1"]
    assert extract_glob("orders.csv").startswith("{orders.csv,orders_[0-9].csv,orders_[0-9][0-9].csv")


def test_a_backup_file_is_not_an_extract(spark, tmp_path):
    extracts(tmp_path)
    put(tmp_path, "customers_backup.csv", ["c9,u9,1,x,y"], header=",".join(SCHEMAS["customers"].names))
    put(tmp_path, "customers_2.csv", ["c2,u2,2,x,y"], header=",".join(SCHEMAS["customers"].names))
    src = load_sources(spark, str(tmp_path))
    assert sorted(r.customer_id for r in src["customers"].collect()) == ["c1", "c2"]
    assert "category_translation" not in src
    os.rename(tmp_path / "sellers.csv", tmp_path / "vendors.csv")
    with pytest.raises(MissingExtract, match="sellers.csv"):
        load_sources(spark, str(tmp_path))
    assert load_sources(spark, str(tmp_path), file_names={"sellers": "vendors.csv"})["sellers"].count() == 1


def test_quarantine_is_published_with_the_star(spark, tmp_path):
    land, target = tmp_path / "land", str(tmp_path / "star")
    land.mkdir()
    extracts(land, [*GOOD, BAD["a bad int"], BAD["a short record"]])
    src = load_sources(spark, str(land), on_bad="quarantine")
    star = write_star_tables(spark, src, target, checks="all")
    assert star["fact_order_items"].count() == 2
    kept = read_star(spark, target, names=[QUARANTINE])[QUARANTINE]
    assert sorted((r.source, r.reason) for r in kept.collect()) == [
        ("order_items", "number of fields"), ("order_items", "order_item_id is no int")]
    checks = {(r.check, r.subject): r for r in published_checks(spark, target).collect()}
    assert checks["rejected_records", "order_items"].observed == 2 and not checks["rejected_records", "order_items"].passed
    assert checks["rejected_records", "orders"].passed
    assert checks["row_count", "fact_order_items"].passed


def test_command_line_with_other_names_and_bad_records(spark, tmp_path, capsys):
    land, target = tmp_path / "land", str(tmp_path / "star")
    land.mkdir()
    extracts(land)
    os.rename(land / "orders.csv", land / "shop_orders_dataset.csv")
    args = ["--extracts", str(land), "--target", target, "--file-name", "orders=shop_orders_dataset.csv"]
    assert main([*args, "--fail-on-check"]) == 0
    put(land, "order_items.csv", [*GOOD, BAD["a bad timestamp"]])
    assert main([*args, "--fail-on-check", "--bad-records", "quarantine"]) == 2
    assert Versions(spark, target).numbers() == [1]
    assert main([*args, "--bad-records", "quarantine", "--incremental"]) == 0
    assert "rejected_records" in capsys.readouterr().out
    assert Versions(spark, target).numbers() == [1, 2]
