"""Query-shape operators: parameterised SQL with an allowlisted table (B10),
CASE bands, predicates as text, pivots."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidepool.operators import aggregates as AG
from tidepool.operators import shape as S
from tidepool.sources.io import register_views


def test_param_query_binds_values_and_checks_table(spark):
    register_views(spark, SF_SMALL, ["orders", "lineitem"])
    sql = "SELECT COUNT(*) AS n FROM IDENTIFIER(:table) WHERE o_totalprice > :p"
    n = S.run_param(spark, sql, {"p": 100000}, table="orders", allowed_tables=["orders"]).first().n
    assert n == spark.table("orders").filter("o_totalprice > 100000").count()
    for bad in ("customer", "orders; DROP TABLE x", "orders--"):
        with pytest.raises(S.TableNotAllowed):
            S.run_param(spark, sql, {"p": 1}, table=bad, allowed_tables=["orders"])
    # a value that looks like SQL stays a value
    out = S.run_param(spark, "SELECT COUNT(*) AS n FROM orders WHERE o_orderpriority = :v",
                      {"v": "1-URGENT' OR '1'='1"}).first().n
    assert out == 0


def test_execute_immediate_binds_statement_and_values(spark):
    register_views(spark, SF_SMALL, ["orders"])
    stmt = "SELECT COUNT(*) AS n FROM orders WHERE o_totalprice > :p AND o_orderpriority = :prio"
    n = S.execute_immediate(spark, stmt, {"p": 100000, "prio": "1-URGENT"}).first().n
    assert n == spark.table("orders").filter("o_totalprice > 100000 AND o_orderpriority = '1-URGENT'").count()
    with pytest.raises(ValueError):
        S.execute_immediate(spark, stmt, {"p; DROP": 1})


def test_segment_bands_and_text_predicates(spark):
    df = spark.createDataFrame([(-5.0,), (10.0,), (500.0,), (None,)], "x double")
    seg = [r.s for r in df.select(S.segment(F.col("x"), [(0, "neg"), (100, "low")], "high").alias("s")).collect()]
    assert seg == ["neg", "low", "high", "high"]          # NULL falls to ELSE, as in SQL CASE
    assert S.filter_expr(df, "x > 0 AND x < 100").count() == 1


def test_pivot_static_values_are_case_sensitive(spark):
    df = spark.createDataFrame([("a", "X", 1), ("a", "x", 2), ("b", "X", 3)], "k string, c string, v int")
    out = {r.k: (r.X, r["x"]) for r in AG.pivot(df, "k", "c", [F.sum("v")], values=["X", "x"]).collect()}
    assert out == {"a": (1, 2), "b": (3, None)}
    dyn = AG.pivot(df, "k", "c", [F.sum("v")])
    assert set(dyn.columns) == {"k", "X", "x"}
