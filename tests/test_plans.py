"""The physical plans keep the properties the design relies on at scale."""

from starloom.plans import analytics as A
from starloom.plans.star import Star
from starloom.sources.testdata import testdata_sources as roles_of

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_item_fact_is_built_without_a_shuffle(spark):
    st = Star(roles_of(spark, SF))
    plan = _plan(st["fact_order_items"])
    assert plan.count("BroadcastHashJoin") == 2
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan


def test_date_dimension_distinct_is_combined_map_side(spark):
    plan = _plan(Star(roles_of(spark, SF))["dim_date"])
    # the distinct runs as two HashAggregates around its exchange: map-side, then final
    assert plan.count("HashAggregate") >= 2


def test_reports_read_only_needed_columns(spark, tmp_path):
    from starloom.sinks import write_star_tables
    star = write_star_tables(spark, roles_of(spark, SF), str(tmp_path))
    rev = A.revenue_by_category_month(star["fact_order_items"], star["fact_orders"],
                                      star["dim_products"], star["dim_date"])
    text = rev._jdf.queryExecution().executedPlan().toString()
    assert "price" in text and "item_total" not in text and "seller_sk" not in text
    rep = A.repeat_customers(star["fact_orders"])
    text = _plan(rep)
    assert "order_status" not in text and "delivery_days" not in text


def test_revenue_labels_fact_rows_map_side_and_both_paths_agree(spark, tmp_path):
    import re

    from starloom.sinks import write_star_tables
    star = write_star_tables(spark, roles_of(spark, SF), str(tmp_path))
    args = (star["fact_order_items"], star["fact_orders"], star["dim_products"], star["dim_date"])
    small = A.revenue_by_category_month(*args)
    text = _plan(small)
    # a broadcastable product dimension: no aggregate keyed by product
    assert not re.search(r"HashAggregate\(keys=\[[^\]]*product_sk", text)
    # over the bound: rows are summed per (day, product) before the product join
    large = A.revenue_by_category_month(*args, broadcast_max_rows=0)
    assert re.search(r"HashAggregate\(keys=\[[^\]]*product_sk", _plan(large))
    assert sorted(small.collect()) == sorted(large.collect())


def test_no_registered_query_runs_python(spark):
    """Every registered query stays JVM-side: no Python UDF or Arrow eval node."""
    import re

    import __spark_entry__ as E
    python_nodes = re.compile(r"BatchEvalPython|ArrowEvalPython|PythonUDF|MapInPandas|FlatMapGroupsInPandas")
    for name, q in E.queries().items():
        assert not python_nodes.search(_plan(q(spark, SF))), name
