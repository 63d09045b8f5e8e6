"""Registered queries: upserts, SCD2, time travel and change feeds.

Snapshots come from the customer table: ``old`` is the table; ``new``
raises the balance of every 7th key by 1 (and upper-cases its name),
removes every 11th key, and adds a copy of every 13th key under key +
1,000,000.  The same rules are written in SQL for the oracles.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidepool.operators import changes as CH
from tidepool.plans.common import t
from tidepool.plans.registry import register

COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
NEW_KEY_OFFSET = 1_000_000


def old_snapshot(spark, d):
    return t(spark, d, "customer").select(*COLS)


def updates(spark, d):
    old = old_snapshot(spark, d)
    k = F.col("c_custkey")
    changed = old.filter((k % 7 == 0) & (k % 11 != 0)).select(
        "c_custkey", F.upper("c_name").alias("c_name"), "c_nationkey",
        (F.col("c_acctbal") + 1).alias("c_acctbal"), "c_mktsegment")
    added = old.filter(k % 13 == 0).select(
        (k + NEW_KEY_OFFSET).alias("c_custkey"), F.concat("c_name", F.lit("-new")).alias("c_name"),
        "c_nationkey", "c_acctbal", "c_mktsegment")
    return changed.unionByName(added)


def deletes(spark, d):
    return old_snapshot(spark, d).filter(F.col("c_custkey") % 11 == 0)


def new_snapshot(spark, d):
    old = old_snapshot(spark, d)
    kept = old.filter(F.col("c_custkey") % 11 != 0)
    return CH.merge_upsert(kept, updates(spark, d), "c_custkey")


OLD_SQL = "(SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer)"
UPD_SQL = f"""(
  SELECT c_custkey, upper(c_name) AS c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment
  FROM customer WHERE c_custkey % 7 = 0 AND c_custkey % 11 <> 0
  UNION ALL
  SELECT c_custkey + {NEW_KEY_OFFSET}, c_name || '-new', c_nationkey, c_acctbal, c_mktsegment
  FROM customer WHERE c_custkey % 13 = 0)"""
DEL_SQL = f"(SELECT * FROM {OLD_SQL} WHERE c_custkey % 11 = 0)"
NEW_SQL = f"""(
  SELECT * FROM {OLD_SQL} o WHERE c_custkey % 11 <> 0 AND c_custkey NOT IN (SELECT c_custkey FROM {UPD_SQL})
  UNION ALL SELECT * FROM {UPD_SQL})"""


def _merge_sql(update_cols):
    def pick(c):
        matched = f"s.{c}" if c in update_cols else f"t.{c}"
        return (f"CASE WHEN s.c_custkey IS NULL THEN t.{c} WHEN t.c_custkey IS NULL THEN s.{c} "
                f"ELSE {matched} END AS {c}")
    body = ",\n  ".join(pick(c) for c in COLS[1:])
    return f"""
SELECT COALESCE(t.c_custkey, s.c_custkey) AS c_custkey,
  {body}
FROM {OLD_SQL} t FULL JOIN {UPD_SQL} s ON t.c_custkey = s.c_custkey
"""


@register("I1_upsert_listed_columns", oracle=_merge_sql(["c_acctbal"]))
def i1(spark, d):
    return CH.merge_upsert(old_snapshot(spark, d), updates(spark, d), "c_custkey", update_cols=["c_acctbal"])


@register("I2_upsert_all_columns", oracle=f"""
SELECT * FROM {OLD_SQL} t WHERE c_custkey NOT IN (SELECT c_custkey FROM {UPD_SQL})
UNION ALL SELECT * FROM {UPD_SQL}
""")
def i2(spark, d):
    return CH.merge_upsert(old_snapshot(spark, d), updates(spark, d), "c_custkey")


@register("I3_upsert_with_delete_marker", oracle=f"""
WITH s AS (SELECT *, false AS is_deleted FROM {UPD_SQL} UNION ALL SELECT *, true AS is_deleted FROM {DEL_SQL})
SELECT COALESCE(t.c_custkey, s.c_custkey) AS c_custkey,
  CASE WHEN t.c_custkey IS NULL THEN s.c_name ELSE s.c_name END AS c_name,
  COALESCE(s.c_nationkey, t.c_nationkey) AS c_nationkey,
  CASE WHEN s.c_custkey IS NULL THEN t.c_acctbal ELSE s.c_acctbal END AS c_acctbal,
  CASE WHEN s.c_custkey IS NULL THEN t.c_mktsegment ELSE s.c_mktsegment END AS c_mktsegment
FROM {OLD_SQL} t FULL JOIN s ON t.c_custkey = s.c_custkey
WHERE NOT (t.c_custkey IS NOT NULL AND s.c_custkey IS NOT NULL AND s.is_deleted)
  AND s.c_custkey IS NOT NULL
UNION ALL
SELECT * FROM {OLD_SQL} t WHERE c_custkey NOT IN (SELECT c_custkey FROM {UPD_SQL}) AND c_custkey % 11 <> 0
""")
def i3(spark, d):
    src = (updates(spark, d).withColumn("is_deleted", F.lit(False))
           .unionByName(deletes(spark, d).withColumn("is_deleted", F.lit(True))))
    return CH.merge_cdc(old_snapshot(spark, d), src, "c_custkey", F.col("is_deleted"))


T1, T2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)


SCD2_SQL = f"""
WITH ch AS (
  SELECT *, DATE '2024-01-01' AS ts FROM {OLD_SQL}
  UNION ALL SELECT *, DATE '2024-02-01' AS ts FROM {NEW_SQL}),
flag AS (
  SELECT *, LAG(c_name) OVER w AS p_name, LAG(c_nationkey) OVER w AS p_nation, LAG(c_acctbal) OVER w AS p_bal,
         LAG(c_mktsegment) OVER w AS p_seg, LAG(ts) OVER w AS p_ts
  FROM ch WINDOW w AS (PARTITION BY c_custkey ORDER BY ts)),
v AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, ts FROM flag
  WHERE p_ts IS NULL OR c_name IS DISTINCT FROM p_name OR c_nationkey IS DISTINCT FROM p_nation
     OR c_acctbal IS DISTINCT FROM p_bal OR c_mktsegment IS DISTINCT FROM p_seg)
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, ts AS valid_from,
       LEAD(ts) OVER (PARTITION BY c_custkey ORDER BY ts) AS valid_to,
       LEAD(ts) OVER (PARTITION BY c_custkey ORDER BY ts) IS NULL AS is_current
FROM v
"""


@register("I4_scd2_history", oracle=SCD2_SQL)
def i4(spark, d):
    ch = (old_snapshot(spark, d).withColumn("ts", F.lit(T1))
          .unionByName(new_snapshot(spark, d).withColumn("ts", F.lit(T2))))
    return CH.scd2(ch, "c_custkey", "ts")


@register("I4s_scd2_history_skew_safe", oracle=SCD2_SQL)
def i4s(spark, d):
    ch = (old_snapshot(spark, d).withColumn("ts", F.lit(T1))
          .unionByName(new_snapshot(spark, d).withColumn("ts", F.lit(T2))))
    return CH.scd2(ch, "c_custkey", "ts", skew_safe=True)


@register("I4b_scd2_from_late_batches", oracle=SCD2_SQL)
def i4b(spark, d):
    """The same history kept from four batches, the later records first and
    one batch delivered twice."""
    from tidepool.session import materialize, scratch_path
    from tidepool.sources.partitions import PartitionStore
    ch = (old_snapshot(spark, d).withColumn("ts", F.lit(T1))
          .unionByName(new_snapshot(spark, d).withColumn("ts", F.lit(T2)))
          .withColumn("bucket", CH.key_bucket("c_custkey", 4)))
    ch = materialize(ch, "i4b-changes")
    even = F.col("c_custkey") % 2 == 0
    late, early = ch.where(F.col("ts") == F.lit(T2)), ch.where(F.col("ts") == F.lit(T1))
    store = PartitionStore(spark, scratch_path(spark, "i4b-history"), "bucket")
    for batch in (late.where(even), early.where(~even), late.where(~even), early.where(even), late.where(even)):
        CH.scd2_store(store, batch, "c_custkey", "ts")
    return CH.scd2_versions(store.read()).drop("bucket")


def history(spark, d):
    """Row-version history: version 1 loads the old snapshot, version 2
    upserts the updates and tombstones the deleted keys."""
    v1 = old_snapshot(spark, d).withColumn("_version", F.lit(1)).withColumn("_deleted", F.lit(False))
    v2u = updates(spark, d).withColumn("_version", F.lit(2)).withColumn("_deleted", F.lit(False))
    v2d = deletes(spark, d).withColumn("_version", F.lit(2)).withColumn("_deleted", F.lit(True))
    return v1.unionByName(v2u).unionByName(v2d).withColumn(
        "_commit_ts", F.when(F.col("_version") == 1, F.lit(T1)).otherwise(F.lit(T2)))


HIST_SQL = f"""(
  SELECT *, 1 AS _version, false AS _deleted FROM {OLD_SQL}
  UNION ALL SELECT *, 2, false FROM {UPD_SQL}
  UNION ALL SELECT *, 2, true FROM {DEL_SQL})"""


@register("I5_snapshot_as_of_version", oracle=f"""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM {HIST_SQL} h
WHERE _version <= 2
QUALIFY ROW_NUMBER() OVER (PARTITION BY c_custkey ORDER BY _version DESC) = 1 AND NOT _deleted
""")
def i5(spark, d):
    return CH.as_of(history(spark, d).drop("_commit_ts"), "c_custkey", "_version", 2, deleted_col="_deleted")


@register("I5c_snapshot_as_of_timestamp", oracle=f"SELECT * FROM {OLD_SQL}")
def i5c(spark, d):
    """The snapshot as of a time between the two commits."""
    h = history(spark, d).withColumn("_commit_ts", F.col("_commit_ts").cast("timestamp"))
    at = F.lit("2024-01-15 12:00:00").cast("timestamp")
    return CH.as_of(h.drop("_version"), "c_custkey", "_commit_ts", at, deleted_col="_deleted")


@register("I5b_snapshot_as_of_first_version", oracle=f"SELECT * FROM {OLD_SQL}")
def i5b(spark, d):
    return CH.as_of(history(spark, d).drop("_commit_ts"), "c_custkey", "_version", 1, deleted_col="_deleted")


@register("I6_change_feed", oracle=f"""
SELECT n.*, 'insert' AS _change_type FROM {NEW_SQL} n WHERE c_custkey NOT IN (SELECT c_custkey FROM {OLD_SQL})
UNION ALL
SELECT o.*, 'delete' FROM {OLD_SQL} o WHERE c_custkey NOT IN (SELECT c_custkey FROM {NEW_SQL})
UNION ALL
SELECT o.*, 'update_preimage' FROM {OLD_SQL} o JOIN {NEW_SQL} n USING (c_custkey)
WHERE o.c_name IS DISTINCT FROM n.c_name OR o.c_nationkey IS DISTINCT FROM n.c_nationkey
   OR o.c_acctbal IS DISTINCT FROM n.c_acctbal OR o.c_mktsegment IS DISTINCT FROM n.c_mktsegment
UNION ALL
SELECT n.*, 'update_postimage' FROM {OLD_SQL} o JOIN {NEW_SQL} n USING (c_custkey)
WHERE o.c_name IS DISTINCT FROM n.c_name OR o.c_nationkey IS DISTINCT FROM n.c_nationkey
   OR o.c_acctbal IS DISTINCT FROM n.c_acctbal OR o.c_mktsegment IS DISTINCT FROM n.c_mktsegment
""")
def i6(spark, d):
    return CH.change_feed(old_snapshot(spark, d), new_snapshot(spark, d), "c_custkey")


@register("I7_state_from_change_rows", oracle=f"SELECT * FROM {NEW_SQL}")
def i7(spark, d):
    feed = CH.change_feed(old_snapshot(spark, d), new_snapshot(spark, d), "c_custkey").withColumn(
        "_commit_version", F.lit(2))
    return CH.apply_changes(old_snapshot(spark, d), feed, "c_custkey")


def third_snapshot(spark, d):
    """After ``new``: some added keys go again, some changed rows come back
    as they were, some removed keys return under another name."""
    k, old = F.col("c_custkey"), old_snapshot(spark, d)
    new = new_snapshot(spark, d).where(~((k > NEW_KEY_OFFSET) & (k % 3 == 0)) & ~((k < NEW_KEY_OFFSET) & (k % 35 == 0)))
    back = old.where((k % 35 == 0) & (k % 11 != 0))
    return new.unionByName(back).unionByName(old.where(k % 22 == 0).withColumn("c_name", F.upper("c_name")))


THIRD_SQL = f"""(
  SELECT * FROM {NEW_SQL} n WHERE NOT (c_custkey > {NEW_KEY_OFFSET} AND c_custkey % 3 = 0)
    AND NOT (c_custkey < {NEW_KEY_OFFSET} AND c_custkey % 35 = 0)
  UNION ALL SELECT * FROM {OLD_SQL} o WHERE c_custkey % 35 = 0 AND c_custkey % 11 <> 0
  UNION ALL SELECT c_custkey, upper(c_name), c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 22 = 0)"""

DIFFERS = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in COLS[1:])


@register("I6c_net_change_of_feeds", oracle=f"""
SELECT n.*, 'insert' AS _change_type FROM {THIRD_SQL} n WHERE c_custkey NOT IN (SELECT c_custkey FROM {OLD_SQL})
UNION ALL SELECT o.*, 'delete' FROM {OLD_SQL} o WHERE c_custkey NOT IN (SELECT c_custkey FROM {THIRD_SQL})
UNION ALL SELECT o.*, 'update_preimage' FROM {OLD_SQL} o JOIN {THIRD_SQL} n USING (c_custkey) WHERE {DIFFERS}
UNION ALL SELECT n.*, 'update_postimage' FROM {OLD_SQL} o JOIN {THIRD_SQL} n USING (c_custkey) WHERE {DIFFERS}
""")
def i6c(spark, d):
    """Feeds from version 1 to 2 and from 2 to 3, composed."""
    v1, v2, v3 = old_snapshot(spark, d), new_snapshot(spark, d), third_snapshot(spark, d)
    feeds = (CH.change_feed(v1, v2, "c_custkey").withColumn("_commit_version", F.lit(2))
             .unionByName(CH.change_feed(v2, v3, "c_custkey").withColumn("_commit_version", F.lit(3))))
    return CH.compose_feeds(feeds, "c_custkey")
