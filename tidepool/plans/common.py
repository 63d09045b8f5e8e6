"""Shared helpers for the registered queries: table loading and the mapping
from the test tables to the reference's concepts (orders, customers,
channels, categories)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.sources.io import read_table

MONEY = "decimal(18,2)"


def money(c) -> Column:
    """Exact 2-decimal money; sums of it are exact and engine independent."""
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def dbl(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def money_words(c, high: str, low: str) -> list[Column]:
    """The cents of a money column as two whole numbers, high * 2^32 + low, made
    once for rows that a join repeats: sums of numbers cost a fraction of those
    of decimals this wide."""
    cents = ((F.col(c) if isinstance(c, str) else c) * 100).cast("bigint")
    return [F.shiftright(cents, 32).alias(high), cents.bitwiseAND(F.lit(2 ** 32 - 1)).alias(low)]


def sum_of_words(high: str, low: str) -> Column:
    """SUM of the money that ``money_words`` has split, as a decimal.  Exact: each
    word's sum fits its 64 bits for 2^31 rows, and an overflow is an error."""
    cents = F.sum(high).cast("decimal(20,0)") * F.lit(2 ** 32) + F.sum(low).cast("decimal(20,0)")
    return (cents * F.lit(Decimal("0.01"))).cast("decimal(28,2)")


def t(spark: SparkSession, base: str, name: str) -> DataFrame:
    return read_table(spark, base, name)


def order_facts(spark: SparkSession, base: str) -> DataFrame:
    """Reference ``orders`` view over the ``orders`` table.

    customer_id <- o_custkey, amount <- o_totalprice, order_date <- date of
    o_orderdate, channel (last touch) <- o_orderpriority, status completed
    <- o_orderstatus 'F' (O open -> pending, P partial -> shipped).
    """
    o = t(spark, base, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("amount"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_orderpriority").alias("channel"),
        F.when(F.col("o_orderstatus") == "F", "completed")
         .when(F.col("o_orderstatus") == "O", "pending")
         .when(F.col("o_orderstatus") == "P", "shipped").alias("status"),
    )


# SQL twin of order_facts for the DuckDB oracles.
ORDER_FACTS_SQL = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS amount,
       CAST(o_orderdate AS DATE) AS order_date, o_orderpriority AS channel,
       CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending'
                          WHEN 'P' THEN 'shipped' END AS status
FROM orders
"""
