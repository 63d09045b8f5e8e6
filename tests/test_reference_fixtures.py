"""The reference's own small inputs (retyped), with the results stated in
FIXTURES.md section 1 -- including the reference defects we do NOT copy."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StringType, StructField, StructType

from tidepool.operators import quality as Q
from tidepool.operators import windows as W
from tidepool.plans import medallion as M

# Sample rows, which must be these for the stated results.
RAW_EVENTS = [
    ("evt-001", "ord-1001", "cust-A", "prod-X", "2", "49.99", "completed", "us-west", "2024-01-15 08:00:00"),
    ("evt-002", "ord-1002", "cust-B", "prod-Y", "1", "129.00", "completed", "us-east", "2024-01-15 09:00:00"),
    ("evt-003", "ord-1001", "cust-A", "prod-X", "2", "49.99", "completed", "us-west", "2024-01-15 08:00:00"),
    ("evt-004", "ord-1003", "cust-C", "prod-X", "3", "49.99", "cancelled", "eu-west", "2024-01-15 10:00:00"),
    ("evt-005", "ord-1004", "cust-D", "prod-Z", "1", None, "pending", "us-west", "2024-01-15 11:00:00"),
    ("evt-006", "ord-1002", "cust-B", "prod-Y", "1", "129.00", "shipped", "us-east", "2024-01-15 14:00:00"),
]
TS = "2024-01-16 00:00:00"


@pytest.fixture()
def raw(spark):
    return spark.createDataFrame(RAW_EVENTS, M.BRONZE_SCHEMA)


def test_bronze_keeps_six_distinct_event_ids(raw):
    # reference comment says 5; event ids all differ, so 6 (defect 1)
    bronze = M.to_bronze(raw, TS)
    assert bronze.count() == 6
    assert set(bronze.columns) == set(M.BRONZE_COLUMNS) | {"ingestion_ts"}


def test_bronze_rerun_adds_nothing(raw):
    first = M.to_bronze(raw, TS)
    assert M.to_bronze(raw, TS, existing=first).count() == 0


def test_silver_three_rows_and_reject(raw):
    # reference says 5; ord-1004 has a NULL price -> 3 (defect 2)
    silver, rejects = M.silver_split(M.to_bronze(raw, TS), TS)
    got = {r.order_id: (r.amount, r.status) for r in silver.collect()}
    assert got == {"ord-1001": (Decimal("99.98"), "completed"),
                   "ord-1002": (Decimal("129.00"), "shipped"),
                   "ord-1003": (Decimal("149.97"), "cancelled")}
    rej = rejects.collect()
    assert [r.order_id for r in rej] == ["ord-1004"]
    assert "unit_price" in rej[0].reject_reason


def test_silver_schema_is_the_contract(raw):
    silver = M.to_silver(M.to_bronze(raw, TS), TS)
    types = dict(silver.dtypes)
    assert types["quantity"] == "int" and types["unit_price"] == "decimal(10,2)"
    assert types["amount"] == "decimal(10,2)" and types["order_date"] == "date"


def test_gold_two_rows(raw):
    gold = M.to_gold(M.to_silver(M.to_bronze(raw, TS), TS))
    rows = sorted((r.product_id, r.region, r.total_orders, r.total_revenue, r.avg_order_value,
                   r.order_date) for r in gold.collect())
    d = dt.date(2024, 1, 15)
    assert rows == [("prod-X", "us-west", 1, Decimal("99.98"), Decimal("99.98"), d),
                    ("prod-Y", "us-east", 1, Decimal("129.00"), Decimal("129.00"), d)]


def test_silver_upsert_updates_only_listed_columns(spark, raw):
    silver = M.to_silver(M.to_bronze(raw, TS), TS)
    upd = silver.filter("order_id = 'ord-1002'").withColumn("status", F.lit("delivered")) \
        .withColumn("quantity", F.lit(9))
    out = {r.order_id: r for r in M.upsert_silver(silver, upd).collect()}
    assert out["ord-1002"].status == "delivered"
    assert out["ord-1002"].quantity == 1          # not in update_cols (defect 7 kept as the default)
    assert len(out) == 3


def test_upsert_rejects_repeated_source_key(spark, raw):
    silver = M.to_silver(M.to_bronze(raw, TS), TS)
    dup = silver.unionByName(silver.filter("order_id = 'ord-1001'"))
    with pytest.raises(Exception, match="more than once"):
        M.upsert_silver(silver, dup).collect()


LEADERBOARD = [("Alice", 100), ("Bob", 100), ("Carol", 85), ("Dave", 70)]


def test_rank_ties(spark):
    df = spark.createDataFrame(LEADERBOARD, "name string, score int")
    out = W.with_rankings(df, None, [F.col("score").desc(), "name"]).orderBy("row_number").collect()
    assert [r.row_number for r in out] == [1, 2, 3, 4]
    w_rank = W.with_rankings(df, None, F.col("score").desc()).orderBy("name").collect()
    assert [r["rank"] for r in w_rank] == [1, 1, 3, 4]
    assert [r["dense_rank"] for r in w_rank] == [1, 1, 2, 3]


def test_top_k_dense_keeps_ties(spark):
    df = spark.createDataFrame(LEADERBOARD, "name string, score int")
    out = W.top_k_dense(df, "score", 2).collect()
    assert sorted((r.name, r["rank"]) for r in out) == [("Alice", 1), ("Bob", 1), ("Carol", 2)]


DQ_SCHEMA = StructType([StructField("order_id", StringType()), StructField("customer_id", StringType()),
                        StructField("amount", DoubleType()), StructField("status", StringType()),
                        StructField("order_date", DateType())])


def test_quality_null_status_fails_and_every_row_lands_somewhere(spark):
    d = dt.date(2024, 3, 1)
    rows = [("o1", "c1", 10.0, "completed", d), ("o2", "c2", None, "shipped", d),
            ("o3", None, 5.0, "pending", d), ("o4", "c4", 7.0, None, d),          # NULL status (defect 9)
            ("o5", "c5", -1.0, "INVALID", dt.date(2024, 5, 1))]
    df = spark.createDataFrame(rows, DQ_SCHEMA)
    checks = Q.order_checks("2024-04-01")
    flagged = Q.flag(df, checks)
    p, f = Q.evaluate(flagged, checks)
    assert p.count() + f.count() == df.count()
    assert [r.order_id for r in p.collect()] == ["o1"]
    reasons = {r.order_id: r.fail_reason for r in f.withColumn("fail_reason", Q.fail_reason(checks)).collect()}
    assert reasons["o4"] == "valid_status"
    assert reasons["o5"] == "amount_positive, valid_status, order_date_not_future"   # not NULL (defect 10)
    m = {r.check_name: r for r in Q.metrics(flagged, checks, "t", run_ts="2024-04-01 00:00:00").collect()}
    assert m["valid_status"].fail_count == 2 and m["valid_status"].fail_pct == 40.0
    score = Q.quality_score(Q.metrics(flagged, checks, "t", run_ts="2024-04-01 00:00:00")).first()
    # weighted pass: ERROR checks 2 x (3 + 4 + 3 + 4) + WARNING 1 x 4 = 32 of 2 x 20 + 5 = 45
    assert score.quality_score == 71.1


def test_quality_threshold_raises(spark):
    d = dt.date(2024, 3, 1)
    df = spark.createDataFrame([("o1", "c1", None, "completed", d), ("o2", "c2", 3.0, "completed", d)], DQ_SCHEMA)
    checks = Q.order_checks("2024-04-01")
    m = Q.metrics(Q.flag(df, checks), checks, "t", run_ts="2024-04-01 00:00:00")
    with pytest.raises(Q.DataQualityError):
        Q.assert_thresholds(m, 10.0)
    Q.assert_thresholds(m, 60.0)


def test_make_orders_fault_rates(spark):
    from tidepool.sources.contracts import make_orders
    df = make_orders(spark, 20_000, bad_pct=0.5, seed=7)
    n_null_amount = df.filter("amount IS NULL").count() / 20_000
    n_bad_status = df.filter("status = 'INVALID_STATUS'").count() / 20_000
    assert abs(n_null_amount - 0.2) < 0.02     # 0.4 x 0.5
    assert abs(n_bad_status - 0.15) < 0.02     # 0.3 x 0.5
    assert df.select("order_id").distinct().count() == 20_000
    # deterministic: a rerun gives the same rows
    assert df.exceptAll(make_orders(spark, 20_000, bad_pct=0.5, seed=7)).count() == 0


def test_mask_example(spark):
    from tidepool.operators.policy import apply_mask
    df = spark.createDataFrame([("john.doe@company.com",)], "email string")
    assert apply_mask(df, "email", False).first().email == "jo****@****.com"
    assert apply_mask(df, "email", True).first().email == "john.doe@company.com"


def test_row_filter_user_with_two_regions(spark):
    from tidepool.operators.policy import apply_row_filter
    ent = spark.createDataFrame([("alice", "US"), ("bob", "EU"), ("carol", "US"), ("carol", "EU")],
                                "user string, region string")
    data = spark.createDataFrame([(1, "US"), (2, "EU"), (3, "APAC")], "id int, region string")
    assert sorted(r.id for r in apply_row_filter(data, ent, "alice").collect()) == [1]
    assert sorted(r.id for r in apply_row_filter(data, ent, "carol").collect()) == [1, 2]
    assert apply_row_filter(data, ent, "dave").count() == 0
    assert apply_row_filter(data, ent, "dave", groups=["admins"]).count() == 3


def test_nested_orders_fixture(spark):
    """Empty array, NULL array and malformed JSON (FIXTURES 1.5)."""
    from tidepool.functions import nested as N
    rows = [("o1", [("p1", 2, Decimal("3.50")), ("p2", 1, Decimal("10.00"))], ["a", "b"], {"gift": "yes"},
             '{"user": {"id": "u1"}, "event_type": "click", "metadata": {"source": "web"}}'),
            ("o2", [], [], {}, '{"user": {"id": "u2"}, "event_type": "view"}'),
            ("o3", None, None, None, "{not json")]
    schema = ("order_id string, items array<struct<product_id:string,qty:int,price:decimal(10,2)>>, "
              "tags array<string>, attributes map<string,string>, payload string")
    df = spark.createDataFrame(rows, schema)
    assert df.select(F.explode("items")).count() == 2
    assert df.select("order_id", F.explode_outer("items")).count() == 4
    assert df.select(F.posexplode("tags")).collect()[1].pos == 1
    total = {r.order_id: r.t for r in df.select("order_id", F.aggregate(
        "items", F.lit(0).cast("decimal(20,2)"),
        lambda a, x: (a + x.qty * x.price).cast("decimal(20,2)")).alias("t")).collect()}
    assert total == {"o1": Decimal("17.00"), "o2": Decimal("0.00"), "o3": None}
    parsed = df.select("order_id", N.json_field("payload", "$.user.id").alias("uid"),
                       N.parse_json("payload", "user struct<id:string>, event_type string").alias("p"))
    got = {r.order_id: (r.uid, r.p.event_type if r.p else None) for r in parsed.collect()}
    assert got["o1"] == ("u1", "click") and got["o2"] == ("u2", "view")
    assert got["o3"][0] is None and got["o3"][1] is None
    sizes = {r.order_id: r.n for r in df.select("order_id", F.size("items").alias("n")).collect()}
    assert sizes["o1"] == 2 and sizes["o2"] == 0 and sizes["o3"] in (None, -1)


def test_late_bad_event_moves_order_to_reject_side(spark):
    """Latest event first, validation second (as the reference orders it):
    a later event with an unparsable price removes a previously good order
    from Silver and shows it on the reject side with its reason.  Equal
    event times are broken by the numeric event id."""
    rows = [("10", "ord-9", "c", "p", "1", "5.00", "completed", "eu", "2024-01-15 08:00:00"),
            ("11", "ord-9", "c", "p", "1", "oops", "shipped", "eu", "2024-01-15 09:00:00"),
            ("12", "ord-8", "c", "p", "2", "3.00", "pending", "eu", "2024-01-15 09:00:00"),
            ("13", "ord-8", "c", "p", "2", "4.00", "shipped", "eu", "2024-01-15 09:00:00")]
    raw = spark.createDataFrame(rows, M.BRONZE_SCHEMA)
    silver, rejects = M.silver_split(M.to_bronze(raw, TS), TS)
    got = {r.order_id: (r.status, r.unit_price) for r in silver.collect()}
    assert got == {"ord-8": ("shipped", Decimal("4.00"))}          # tie on time: event 13 wins
    rej = {r.order_id: r.reject_reason for r in rejects.collect()}
    assert rej == {"ord-9": "unit_price:null_or_bad"}
