"""Plan checks: the physical plans we rely on for scale (pushdown, pruning,
join strategy, partial aggregation, group limits)."""

import contextlib
import io

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidepool.operators import aggregates as AG
from tidepool.operators import joins as J
from tidepool.operators import shape as S
from tidepool.operators import windows as W
from tidepool.plans.common import t


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_scan_prunes_columns_and_pushes_filters(spark):
    import __spark_entry__ as E
    p = plan(E.queries()["A1_parquet_scan_pruned"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in p
    assert "GreaterThanOrEqual(l_quantity,45.0)" in p


def test_sargable_range_pushes_bounds_but_function_does_not(spark):
    li = t(spark, SF_SMALL, "lineitem")
    good = plan(S.date_range_filter(li, "l_shipdate", "1996-01-01", "1997-01-01"))
    assert "GreaterThanOrEqual(l_shipdate" in good and "LessThan(l_shipdate" in good
    bad = plan(li.filter(F.year("l_shipdate") == 1996))
    assert "GreaterThanOrEqual(l_shipdate" not in bad


def test_join_strategies(spark):
    li = t(spark, SF_SMALL, "lineitem").select(F.col("l_orderkey").alias("k"), "l_quantity")
    o = t(spark, SF_SMALL, "orders").select(F.col("o_orderkey").alias("k"), "o_orderstatus")
    assert "BroadcastHashJoin" in plan(J.join_dim(li, o, "k"))
    assert "SortMergeJoin" in plan(J.hinted_join(li, o, "k", "merge"))
    assert "ShuffledHashJoin" in plan(J.hinted_join(li, o, "k", "shuffle_hash"))
    n, r = t(spark, SF_SMALL, "nation"), t(spark, SF_SMALL, "region")
    nl = n.hint("shuffle_replicate_nl").join(r, n.n_regionkey <= r.r_regionkey)
    assert "CartesianProduct" in plan(nl)


def test_join_dim_falls_back_to_shuffle_when_dimension_is_large(spark):
    li = t(spark, SF_SMALL, "lineitem").select(F.col("l_orderkey").alias("k"), "l_quantity")
    o = t(spark, SF_SMALL, "orders").select(F.col("o_orderkey").alias("k"), "o_orderstatus")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(J.join_dim(li, o, "k", max_bytes=100))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    assert "BroadcastHashJoin" not in p and "SortMergeJoin" in p


def test_theta_join_is_broadcast_nested_loop(spark):
    import __spark_entry__ as E
    assert "BroadcastNestedLoopJoin" in plan(E.queries()["C7_theta_join_price_bands"](spark, SF_SMALL))


def test_keep_latest_combines_rows_before_the_shuffle(spark):
    o = t(spark, SF_SMALL, "orders")
    p = plan(W.keep_latest(o, "o_custkey", ["o_orderdate", "o_orderkey"]))
    assert "Window" not in p
    # the whole row is in the buffer, so Spark sorts for it, on both sides of the shuffle
    assert p.count("SortAggregate") >= 2 and p.index("Exchange") < p.rindex("SortAggregate")


def test_top_n_per_group_uses_group_limit(spark):
    o = t(spark, SF_SMALL, "orders")
    p = plan(W.top_n_per_group(o, "o_custkey", F.col("o_totalprice").desc(), 3))
    assert "WindowGroupLimit" in p


def test_distinct_counts_use_one_expand(spark):
    p = plan(AG.distinct_counts(t(spark, SF_SMALL, "lineitem"), ["l_partkey", "l_suppkey"], keys=["l_returnflag"]))
    assert "Expand" in p and "collect_set" not in p


def test_top_k_uses_take_ordered(spark):
    li = t(spark, SF_SMALL, "lineitem")
    assert "TakeOrderedAndProject" in plan(S.top_k(li, 5, F.col("l_extendedprice").desc(), "l_orderkey"))


def test_top_k_dense_has_no_window_over_all_rows(spark):
    import __spark_entry__ as E
    p = plan(E.queries()["L1_top_customers"](spark, SF_SMALL))
    # the only window ranks the k broadcast values; the customer rows are joined to it
    assert "TakeOrderedAndProject" in p and "BroadcastHashJoin" in p


def test_whole_stage_codegen_in_group_aggregate(spark):
    import __spark_entry__ as E
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # show the static codegen stages
    try:
        p = plan(E.queries()["D1_group_aggregate"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "* HashAggregate" in p   # "*" marks operators inside whole-stage codegen
