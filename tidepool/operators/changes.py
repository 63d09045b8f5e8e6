"""Upserts, change data and history over plain Parquet.

Each operator returns a new DataFrame (the next table state or the change
rows); the caller writes it to a NEW path (never over the one it reads).
Source and target are joined once on the keys; the key-uniqueness check on
the source is a window over the same keys, so it shares the join's
partitioning instead of adding a separate job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class DuplicateSourceKey(ValueError):
    pass


def _keys(keys):
    return [keys] if isinstance(keys, str) else list(keys)


def _assert_unique(source: DataFrame, keys) -> DataFrame:
    """Fail the job (not silently pick a row) when the source repeats a key,
    as MERGE does.  The check runs inside the same plan as the merge."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    ok = F.when(n > 1, F.raise_error(F.lit("merge source has a key more than once"))).otherwise(F.lit(True))
    return source.withColumn("_unique_key", ok).filter(F.col("_unique_key")).drop("_unique_key")


def merge_upsert(target: DataFrame, source: DataFrame, keys, update_cols=None,
                 check_unique: bool = True) -> DataFrame:
    """WHEN MATCHED UPDATE SET <update_cols> (all when None),
    WHEN NOT MATCHED INSERT *.  Target rows without a source row stay."""
    keys = _keys(keys)
    if check_unique:
        source = _assert_unique(source, keys)
    if update_cols is None:
        # Replace matched rows wholesale: anti join + union
        kept = target.join(source.select(*keys), keys, "left_anti")
        return kept.unionByName(source.select(*target.columns))
    cols = [c for c in target.columns if c not in keys]
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_t"))
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in cols], F.lit(True).alias("_s"))
    j = t.join(s, keys, "full_outer")
    out = []
    for c in cols:
        tv, sv = F.col(f"_t_{c}"), F.col(f"_s_{c}")
        matched_v = sv if c in update_cols else tv
        out.append(F.when(F.col("_s").isNull(), tv).when(F.col("_t").isNull(), sv)
                   .otherwise(matched_v).alias(c))
    return j.select(*keys, *out).select(*target.columns)


def merge_cdc(target: DataFrame, source: DataFrame, keys, delete_when: Column,
              update_cols=None, insert_deleted: bool = True, check_unique: bool = True) -> DataFrame:
    """MERGE with a delete marker, clauses tried in this order:
    WHEN MATCHED AND <delete_when> THEN DELETE; WHEN MATCHED THEN UPDATE;
    WHEN NOT MATCHED THEN INSERT (rows carrying the marker included unless
    ``insert_deleted`` is False).  ``delete_when`` is evaluated on source
    columns; the marker columns are not part of the target."""
    keys = _keys(keys)
    if check_unique:
        source = _assert_unique(source, keys)
    src = source.withColumn("_del", F.coalesce(delete_when, F.lit(False)))
    cols = [c for c in target.columns if c not in keys]
    upd = cols if update_cols is None else list(update_cols)
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_t"))
    s = src.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in cols], F.lit(True).alias("_s"), "_del")
    j = t.join(s, keys, "full_outer")
    matched = F.col("_t").isNotNull() & F.col("_s").isNotNull()
    keep = ~(matched & F.col("_del"))
    if not insert_deleted:
        keep = keep & ~(F.col("_t").isNull() & F.col("_del"))
    out = []
    for c in cols:
        tv, sv = F.col(f"_t_{c}"), F.col(f"_s_{c}")
        out.append(F.when(F.col("_s").isNull(), tv).when(F.col("_t").isNull(), sv)
                   .otherwise(sv if c in upd else tv).alias(c))
    return j.filter(keep).select(*keys, *out).select(*target.columns)


def scd2(changes: DataFrame, keys, ts_col: str, tracked=None, skew_safe: bool = False) -> DataFrame:
    """I4: type-2 history from change records ``(keys, attrs..., ts)``.

    Records that repeat the previous version of their key (same tracked
    attributes) are dropped; each kept version gets ``valid_from`` (its ts),
    ``valid_to`` (the next version's ts, NULL when open) and ``is_current``.
    With ``skew_safe`` a key with very many records is split into chunks.
    """
    keys = _keys(keys)
    attrs = [c for c in changes.columns if c not in keys and c != ts_col]
    tracked = attrs if tracked is None else list(tracked)
    def framed(df: DataFrame, before: int, after: int, build) -> DataFrame:
        if skew_safe:
            from tidepool.operators.skew import bounded_frame
            return bounded_frame(df, keys, [ts_col], before, after, build)
        return df.select("*", *[c.alias(n) for n, c in build(Window.partitionBy(*keys).orderBy(ts_col)).items()])

    now = F.struct(*tracked)
    before = framed(changes, 1, 0, lambda w: {"_prev": F.lag(now).over(w)})
    versions = before.filter(F.col("_prev").isNull() | ~F.col("_prev").eqNullSafe(now)).drop("_prev")
    after = framed(versions, 0, 1, lambda w: {"valid_to": F.lead(ts_col).over(w)})
    return after.select(*keys, *attrs, F.col(ts_col).alias("valid_from"), "valid_to",
                        F.col("valid_to").isNull().alias("is_current"))


def scd2_apply(history: DataFrame | None, batch: DataFrame, keys, ts_col: str, tracked=None,
               skew_safe: bool = False) -> DataFrame:
    """I4 kept from batches: the history after one more batch of change
    records, which may be late.  A late record splits the interval it falls
    in; a record that repeats the version before it changes nothing now, but
    is kept (``is_version`` false), since a later batch may put another
    version between the two.  Batches in any order, also delivered twice,
    give the history of one run over all of them.

    Only the keys of the batch are worked on; the rows of all others pass.
    ``scd2_versions`` gives the plain history.  Records of one key with the
    same time are ordered by a digest of their values; records equal in all
    columns are one.  NULL keys are a key like any other."""
    from tidepool.operators.skew import null_safe_join
    keys = _keys(keys)
    attrs = [c for c in batch.columns if c not in keys and c != ts_col]
    now = F.struct(*(attrs if tracked is None else tracked))
    records = batch.select(*keys, *attrs, ts_col)
    rest = None
    if history is not None:
        touched = batch.select(*keys).distinct()
        mine = null_safe_join(history, touched, keys, "left_semi").withColumnRenamed("valid_from", ts_col)
        records = mine.select(*records.columns).unionByName(records)
        rest = null_safe_join(history, touched, keys, "left_anti")
    digest = F.xxhash64(F.to_json(F.struct(*[F.col(c) for c in attrs]), {"ignoreNullFields": "false"})) if attrs else F.lit(0)
    records = records.distinct().withColumn("_tie", digest)
    order = [ts_col, "_tie"]

    def framed(df: DataFrame, before: int, after: int, build) -> DataFrame:
        if skew_safe:
            from tidepool.operators.skew import bounded_frame
            return bounded_frame(df, keys, order, before, after, build)
        return df.select("*", *[c.alias(n) for n, c in build(Window.partitionBy(*keys).orderBy(*order)).items()])

    seen = framed(records, 1, 0, lambda w: {"_prev": F.lag(now).over(w)})
    seen = seen.withColumn("is_version", F.col("_prev").isNull() | ~F.col("_prev").eqNullSafe(now)).drop("_prev")
    versions = framed(seen.where("is_version"), 0, 1, lambda w: {"valid_to": F.lead(ts_col).over(w)})
    repeats = seen.where("NOT is_version").withColumn("valid_to", F.lit(None).cast(batch.schema[ts_col].dataType))
    out = versions.unionByName(repeats).select(
        *keys, *attrs, F.col(ts_col).alias("valid_from"), "valid_to",
        (F.col("is_version") & F.col("valid_to").isNull()).alias("is_current"), "is_version")
    return out if rest is None else rest.unionByName(out)


def scd2_versions(history: DataFrame) -> DataFrame:
    """The plain type-2 history of ``scd2_apply``'s table."""
    return history.where("is_version").drop("is_version")


def scd2_store(store, batch: DataFrame, keys, ts_col: str, tracked=None, skew_safe: bool = False) -> int:
    """``scd2_apply`` on a partition store (``sources.partitions``) whose
    partition column is a bucket of the key, named as the store says: only
    buckets with keys of the batch are read and published, in one step."""
    from tidepool.session import materialize
    batch = materialize(batch, "scd2-batch")
    bucket = store.partition_col
    old = store.read_touched(batch)
    kept = scd2_apply(None if old is None else old, batch, [*_keys(keys), bucket], ts_col, tracked, skew_safe)
    return store.replace(kept)


def key_bucket(keys, buckets: int) -> Column:
    """Bucket of a key, for a store partitioned by it."""
    return F.pmod(F.xxhash64(*_keys(keys)), F.lit(buckets)).cast("int")


def as_of(history: DataFrame, keys, version_col: str, version, deleted_col: str | None = None) -> DataFrame:
    """Table state at ``version`` from a history of row versions
    (``version_col``, optional tombstone flag ``deleted_col``): rows up to
    the version, the latest per key, tombstones removed.  Uses the max_by
    aggregate, which combines before the shuffle."""
    from tidepool.operators.windows import keep_latest
    keys = _keys(keys)
    upto = history.filter(F.col(version_col) <= F.lit(version))
    latest = keep_latest(upto, keys, [version_col])
    if deleted_col:
        latest = latest.filter(~F.coalesce(F.col(deleted_col), F.lit(False))).drop(deleted_col)
    return latest.drop(version_col)


# Change feed row types (names as in the reference's change data feed).
INSERT, DELETE, PRE, POST = "insert", "delete", "update_preimage", "update_postimage"


def change_feed(old: DataFrame, new: DataFrame, keys) -> DataFrame:
    """Change rows taking snapshot ``old`` to ``new``: inserts, deletes,
    and for changed keys an update_preimage (old values) and an
    update_postimage (new values).  Rows compare null-safely on all
    non-key columns; unchanged keys emit nothing."""
    keys = _keys(keys)
    cols = [c for c in old.columns if c not in keys]
    o = old.select(*keys, F.struct(*cols).alias("_o"))
    n = new.select(*keys, F.struct(*[F.col(c) for c in cols]).alias("_n"))
    return _images(o.join(n, keys, "full_outer"), keys, cols)


def _images(j: DataFrame, keys, cols) -> DataFrame:
    """Change rows of (keys, _o, _n), the old and the new image of a key."""
    kind = (F.when(F.col("_o").isNull() & F.col("_n").isNull(), F.lit(None))
             .when(F.col("_o").isNull(), F.array(F.lit(INSERT)))
             .when(F.col("_n").isNull(), F.array(F.lit(DELETE)))
             .when(~F.col("_o").eqNullSafe(F.col("_n")), F.array(F.lit(PRE), F.lit(POST))))
    rows = j.withColumn("_change_type", F.explode(kind))  # unchanged: NULL array -> no rows
    img = F.when(F.col("_change_type").isin(DELETE, PRE), F.col("_o")).otherwise(F.col("_n"))
    return rows.select(*keys, img.alias("_img"), "_change_type").select(
        *keys, *[F.col(f"_img.{c}").alias(c) for c in cols], "_change_type")


def compose_feeds(changes: DataFrame, keys, version_col: str = "_commit_version") -> DataFrame:
    """I6 over many versions: the net change of consecutive feeds.  For each
    key the image before its first change meets the image after its last:
    insert then delete is nothing, delete then insert an update, updates keep
    the first pre-image, a value that comes back is no change.  Both images
    are aggregates, combined before the shuffle, so a key that changes very
    often is one row a task."""
    keys = _keys(keys)
    cols = [c for c in changes.columns if c not in [*keys, "_change_type", version_col]]
    when = F.struct(F.col(version_col), F.when(F.col("_change_type").isin(PRE, DELETE), 0).otherwise(1))
    row = F.struct("_change_type", F.struct(*cols).alias("img"))
    ends = changes.groupBy(*keys).agg(F.min_by(row, when).alias("_first"), F.max_by(row, when).alias("_last"))
    old = F.when(F.col("_first._change_type") != INSERT, F.col("_first.img"))
    new = F.when(F.col("_last._change_type") != DELETE, F.col("_last.img"))
    return _images(ends.select(*keys, old.alias("_o"), new.alias("_n")), keys, cols)


def apply_changes(base: DataFrame, changes: DataFrame, keys, version_col: str = "_commit_version") -> DataFrame:
    """Current state from a base snapshot plus change rows: for each key
    the last change (by version; a postimage wins over its preimage) decides
    -- delete removes, insert / postimage replaces.  Keys never changed keep
    their base row."""
    keys = _keys(keys)
    cols = [c for c in base.columns if c not in keys]
    rank = F.when(F.col("_change_type") == PRE, 0).otherwise(1)
    ch = changes.filter(F.col("_change_type") != PRE).withColumn("_rk", rank)
    from tidepool.operators.windows import keep_latest
    last = keep_latest(ch.select(*keys, *cols, "_change_type", version_col, "_rk"), keys, [version_col, "_rk"])
    untouched = base.join(last.select(*keys), keys, "left_anti")
    alive = last.filter(F.col("_change_type") != DELETE).select(*keys, *cols)
    return untouched.unionByName(alive)


def upsert_partitions(spark, path: str, source: DataFrame, keys, partition_col: str,
                      update_cols=None) -> None:
    """MERGE into a Parquet table partitioned by ``partition_col``, touching
    only the partitions that hold source rows.

    The target rows of those partitions are read through a semi join on the
    partition column (Spark prunes the other partitions), merged with
    ``merge_upsert`` and written back with dynamic partition overwrite;
    every other partition is left as it is.  Keys must not move between
    partitions (the partition column is a function of the key, e.g. the
    order date of an order).  The merged rows are staged in the shared
    checkpoint folder first, so the overwrite never reads the files it
    replaces; rerunning the same source gives the same table.  A crash
    inside the overwrite can lose a partition: ``sources.partitions``
    publishes in one step instead.
    """
    from tidepool.session import materialize
    keys = _keys(keys)
    # the source is used three times (partition list, size check, merge):
    # stage it once instead of recomputing its plan each time
    source = materialize(source, "upsert-source")
    touched = source.select(F.col(partition_col).alias("_touched")).distinct()
    # NULL is a partition like any other
    target = spark.read.parquet(path).join(touched, F.col(partition_col).eqNullSafe(F.col("_touched")), "left_semi")
    merged = merge_upsert(target.select(*source.columns), source, keys, update_cols=update_cols)
    staged = materialize(merged, "upsert-partitions")
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path)
