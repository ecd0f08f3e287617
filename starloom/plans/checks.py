"""Checks on a built star (V1-V5) and the check queries.

Every check is one row (check, subject, observed, expected, passed).  All of
them come from one tagged union of the tables' key columns (see
``operators.reconcile``): one scan a table, one shuffle of distinct keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.reconcile import HOME, USE, Side, reconcile
from starloom.operators.setops import anti_rows
from starloom.plans.observed import FACT_SOURCES, MAY_BE_UNKNOWN, NOT_NULL

CHECK_COLUMNS = ["check", "subject", "observed", "expected", "passed"]


class StarCheckFailed(AssertionError):
    pass


def _count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


UNIQUE_KEYS = [("dim_customers", "customer_id", "customer_sk"),
               ("dim_date", "date", "date_id"),
               ("dim_payments", "payment_type", "payment_sk"),
               ("dim_products", "product_id", "product_sk"),
               ("dim_seller", "seller_id", "seller_sk")]

# (dimension key, table or source that uses it, its column); sources stand
# under "source <name>".  Purchase dates are compared at day grain (D5), and the
# fact side of payment types and products is checked as well.
USED_KEYS = [("dim_customers.customer_sk", "fact_orders", "customer_sk"),
             ("dim_payments.payment_type", "source order_payments", "payment_type"),
             ("dim_payments.payment_sk", "fact_payments", "payment_sk"),
             ("dim_products.product_id", "source order_items", "product_id"),
             ("dim_products.product_sk", "fact_order_items", "product_sk"),
             ("dim_seller.seller_id", "source order_items", "seller_id"),
             ("dim_seller.seller_sk", "fact_order_items", "seller_sk")]

UNKNOWN_KEY = 0
KINDS = ("row_count", "null_key", "unique", "orphan_keys")


def _home_key(table: str, key: str):
    """A dimension's key; the unknown member has no natural key, and stands under a name."""
    nk, sk = next((nk, sk) for t, nk, sk in UNIQUE_KEYS if t == table)
    if key == sk or table == "dim_date":
        return F.col(key)
    return F.when(F.col(sk) == UNKNOWN_KEY, F.lit("(unknown member)")).otherwise(F.col(nk).cast("string"))


def check_sides(kinds=KINDS) -> list[Side]:
    """The key columns that the checks of ``kinds`` compare, per family."""
    homes, uses = set(), set()
    sides = []
    if "row_count" in kinds:
        for fact, src in FACT_SOURCES.items():
            sides += [Side(f"rows {fact}", HOME, f"source {src}"), Side(f"rows {fact}", USE, fact)]
    if "unique" in kinds:
        homes |= {f"{table}.{key}" for table, nk, sk in UNIQUE_KEYS for key in (nk, sk)}
    if "orphan_keys" in kinds:
        uses |= {u for u in USED_KEYS}
        homes |= {family for family, *_ in USED_KEYS}
        sides += [Side("day", HOME, "dim_date", F.to_date("date")),
                  Side("day", USE, "fact_orders", F.to_date("order_purchase_timestamp"))]
    if "null_key" in kinds:
        uses |= {u for u in USED_KEYS if not u[1].startswith("source ")}
        sides.append(Side("fact_orders.purchase_date_id", USE, "fact_orders", F.col("purchase_date_id")))
    sides += [Side(h, HOME, h.split(".")[0], _home_key(*h.split("."))) for h in sorted(homes)]
    return sides + [Side(f, USE, table, F.col(c)) for f, table, c in sorted(uses)]


def _specs(kinds) -> dict[str, list[tuple]]:
    """Family -> (check, subject, observed, expected column or number)."""
    out: dict[str, list[tuple]] = {}
    add = lambda family, *spec: out.setdefault(family, []).append(spec)
    if "row_count" in kinds:
        for fact in FACT_SOURCES:
            add(f"rows {fact}", "row_count", fact, "used_rows", "home_rows")
    if "unique" in kinds:
        for table, nk, sk in UNIQUE_KEYS:
            for key in (nk, sk):
                add(f"{table}.{key}", "unique", f"{table}.{key}", "home_keys", "home_rows")
    if "orphan_keys" in kinds:
        add("day", "orphan_keys", "fact_orders.purchase_date", "orphans", 0)
        for family, table, column in USED_KEYS:
            add(family, "orphan_keys", f"{table.removeprefix('source ')}.{column}", "orphans", 0)
    if "null_key" in kinds:
        add("fact_orders.purchase_date_id", "null_key", "fact_orders.purchase_date_id", "used_nulls", 0)
        for family, table, column in USED_KEYS:
            if column in NOT_NULL.get(table, ()):
                add(family, "null_key", f"{table}.{column}", "used_nulls", 0)
            if column in MAY_BE_UNKNOWN.get(table, ()):
                add(family, "unknown_key", f"{table}.{column}", "unknown_rows", 0)
    return out


def checked(sources: dict[str, DataFrame], star: dict[str, DataFrame], kinds) -> DataFrame:
    """The checks of ``kinds`` from one scan of every table they touch."""
    sides = check_sides(kinds)
    names = dict.fromkeys(s.table for s in sides)
    tables = {n: sources[n.removeprefix("source ")] if n.startswith("source ") else star[n] for n in names}
    found = None
    for family, specs in _specs(kinds).items():
        rows = F.array(*[F.struct(F.lit(check).alias("check"), F.lit(subject).alias("subject"),
                                  F.col(observed).alias("observed"),
                                  (F.lit(expected).cast("long") if isinstance(expected, int) else F.col(expected)).alias("expected"))
                         for check, subject, observed, expected in specs])
        mine = F.col("family") == family
        found = F.when(mine, rows) if found is None else found.when(mine, rows)
    out = reconcile(tables, sides).select(F.explode(found).alias("r")).select("r.*")
    return out.withColumn("passed", F.col("observed") == F.col("expected"))


def row_count_checks(sources: dict[str, DataFrame], star: dict[str, DataFrame]) -> DataFrame:
    """V1: each fact keeps the row count of its source."""
    return checked(sources, star, ("row_count",))


def null_key_checks(star: dict[str, DataFrame]) -> DataFrame:
    """V2: null surrogate/date keys in the facts, and items mapped to the
    unknown member (key 0), which an inner join to the dimension would lose."""
    return checked({}, star, ("null_key",))


def uniqueness_checks(star: dict[str, DataFrame]) -> DataFrame:
    """V3: natural and surrogate keys are unique in every dimension.

    Distinct counts exclude nulls, as a pandas ``nunique`` does."""
    return checked({}, star, ("unique",))


def coverage_checks(sources: dict[str, DataFrame], star: dict[str, DataFrame]) -> DataFrame:
    """V4: keys used by facts (and sources) that the dimension lacks.

    Orphans are distinct non-null keys; nulls are reported by V2 (D8)."""
    return checked(sources, star, ("orphan_keys",))


def check_star(sources: dict[str, DataFrame], star: dict[str, DataFrame]) -> DataFrame:
    """V5: every check as one DataFrame.  Each table is scanned once, and one
    shuffle of distinct keys answers all checks."""
    return checked(sources, star, KINDS)


def reconciled_keys(sources: dict[str, DataFrame], star: dict[str, DataFrame]) -> DataFrame:
    """Both directions of every key: what facts use and dimensions lack, and
    what dimensions hold and no fact uses, with nulls and repeats of both sides."""
    sides = check_sides(("unique", "orphan_keys"))
    tables = {s.table: sources[s.table.removeprefix("source ")] if s.table.startswith("source ") else star[s.table]
              for s in sides}
    return reconcile(tables, sides)


def assert_star(checks: DataFrame) -> DataFrame:
    """Fail fast: raise when any check fails (the checks frame is a few rows)."""
    assert_rows(checks.where(~F.col("passed")).select(*CHECK_COLUMNS).collect())
    return checks


def assert_rows(rows) -> None:
    """Raise when any of the check rows failed."""
    failed = [r for r in rows if not r[4]]
    if failed:
        raise StarCheckFailed("; ".join(f"{check} {subject}: {seen} != {due}" for check, subject, seen, due, _ in failed))


# ---- check queries (C1-C5) -------------------------------------------------

def table_counts(star: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for every table, one job."""
    parts = [df.agg(F.count(F.lit(1)).cast("long").alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in star.items()]
    return reduce(DataFrame.unionByName, parts)


def _count_as(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("long").alias(name))


def _rows_without_partner(fact: DataFrame, key: str, dim: DataFrame, dim_key: str, name: str) -> DataFrame:
    """Count of ``fact`` rows whose ``key`` has no ``dim`` row (the LEFT JOIN
    ... IS NULL count; null keys count).  The fact is first cut to one row per
    key with its row count, combined map-side, so a hot key (say the unknown
    member 0) never reaches the join as a third of the fact.  The condition on
    the count, always true, keeps the optimizer from moving the join below the
    aggregate, where a task would sort all rows of a hot key."""
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("__sl_n")).where(F.col("__sl_n") > 0)
    orphans = anti_rows(per_key, dim, key, dim_key)
    return orphans.agg(F.coalesce(F.sum("__sl_n"), F.lit(0)).cast("long").alias(name))


def orders_without_customer(fact_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Fact orders whose customer_sk has no dimension row (null keys count)."""
    return _rows_without_partner(fact_orders, "customer_sk", dim_customers, "customer_sk",
                                 "orders_without_customer")


def products_without_items(dim_products: DataFrame, fact_order_items: DataFrame) -> DataFrame:
    """C3 (literal): products that no item refers to."""
    return _count_as(anti_rows(dim_products.select("product_sk"), fact_order_items, "product_sk"),
                     "products_without_items")


def items_without_product(fact_order_items: DataFrame, dim_products: DataFrame) -> DataFrame:
    """C4: items whose product_sk (including the unknown key 0) has no product."""
    return _rows_without_partner(fact_order_items, "product_sk", dim_products, "product_sk",
                                 "items_without_product")


def duplicate_keys(df: DataFrame, key) -> DataFrame:
    """One row per key value that occurs more than once, with its count."""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))
