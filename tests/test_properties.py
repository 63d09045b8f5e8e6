"""Property tests on random inputs (with ties and NULLs) for the operators
that are compositions of our own: change feed / replay, upsert, chunked
ranking and bounded frames.  Examples are few: each one runs Spark jobs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepool.operators import changes as CH
from tidepool.operators import skew as SK

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

vals = st.one_of(st.none(), st.integers(min_value=-3, max_value=3))
snapshot = st.dictionaries(st.integers(min_value=0, max_value=30), st.tuples(vals, vals), max_size=25)


def _df(spark, snap):
    rows = [(k, a, b) for k, (a, b) in snap.items()]
    return spark.createDataFrame(rows, "k int, a int, b int")


@SETTINGS
@given(old=snapshot, new=snapshot)
def test_change_feed_then_replay_gives_new(spark, old, new):
    o, n = _df(spark, old), _df(spark, new)
    feed = CH.change_feed(o, n, "k").withColumn("_commit_version", F.lit(1))
    got = {r.k: (r.a, r.b) for r in CH.apply_changes(o, feed, "k").collect()}
    assert got == new
    kinds = [r._change_type for r in feed.collect()]
    changed = [k for k in old.keys() & new.keys() if old[k] != new[k]]
    assert kinds.count("insert") == len(new.keys() - old.keys())
    assert kinds.count("delete") == len(old.keys() - new.keys())
    assert kinds.count("update_preimage") == kinds.count("update_postimage") == len(changed)


@SETTINGS
@given(tgt=snapshot, src=snapshot)
def test_merge_upsert_matches_dict_model(spark, tgt, src):
    t, s = _df(spark, tgt), _df(spark, src)
    got = {r.k: (r.a, r.b) for r in CH.merge_upsert(t, s, "k", update_cols=["a"]).collect()}
    model = dict(tgt)
    for k, (a, b) in src.items():
        model[k] = (a, model[k][1]) if k in model else (a, b)
    assert got == model
    got_all = {r.k: (r.a, r.b) for r in CH.merge_upsert(t, s, "k").collect()}
    assert got_all == {**tgt, **src}


rows = st.lists(st.tuples(st.sampled_from(["h", "h", None, None, "x", "y"]), st.integers(0, 6), st.one_of(st.none(), st.integers(-5, 5))),
                min_size=1, max_size=60)


@SETTINGS
@given(data=rows, n_chunks=st.integers(1, 12))
def test_chunked_ranking_equals_windows(spark, data, n_chunks):
    df = spark.createDataFrame([(k, o, v, i) for i, (k, o, v) in enumerate(data)], "k string, o int, v int, id int")
    w = Window.partitionBy("k").orderBy("o")
    exp = df.select("id", F.rank().over(w).alias("rank"), F.dense_rank().over(w).alias("dense_rank"))
    got = SK.ranked(df, ["k"], ["o"], n_chunks=n_chunks).select("id", "rank", "dense_rank")
    assert sorted(got.collect(), key=str) == sorted(exp.collect(), key=str)
    wt = Window.partitionBy("k").orderBy("o", "id")
    exp2 = df.select("id", F.row_number().over(wt).alias("row_number"), F.ntile(3).over(wt).alias("ntile"),
                     F.sum("v").over(wt.rowsBetween(Window.unboundedPreceding, 0)).alias("rs"))
    got2 = SK.ranked(df, ["k"], ["o", "id"], n_tiles=3, n_chunks=n_chunks).select("id", "row_number", "ntile")
    assert sorted(got2.collect(), key=str) == sorted(exp2.drop("rs").collect(), key=str)
    got3 = SK.running_sum(df, ["k"], ["o", "id"], "v", out="rs", n_chunks=n_chunks).select("id", "rs")
    assert sorted(got3.collect(), key=str) == sorted(exp2.select("id", "rs").collect(), key=str)


@SETTINGS
@given(data=rows, n_chunks=st.integers(1, 12), before=st.integers(0, 3), after=st.integers(0, 3))
def test_bounded_frames_equal_windows(spark, data, n_chunks, before, after):
    df = spark.createDataFrame([(k, o, v, i) for i, (k, o, v) in enumerate(data)], "k string, o int, v int, id int")

    def build(w):
        out = {"s": F.sum("v").over(w.rowsBetween(-before, after))}
        if before:
            out["lag"] = F.lag("v", before).over(w)
        if after:
            out["lead"] = F.lead("v", after).over(w)
        return out
    w = Window.partitionBy("k").orderBy("o", "id")
    exp = df.select("id", *[c.alias(n) for n, c in build(w).items()])
    got = SK.bounded_frame(df, ["k"], ["o", "id"], before, after, build, n_chunks=n_chunks).select(exp.columns)
    assert sorted(got.collect(), key=str) == sorted(exp.collect(), key=str)
