"""Sketches kept by day against exact answers."""

import os
import random

from pyspark.sql import functions as F

from tidepool.operators import sketches as SK
from tidepool.sources.partitions import PartitionStore


def test_days_kept_and_replaced(spark, tmp_out):
    rnd = random.Random(1)
    rows = [(day, rnd.randint(day * 300, day * 300 + 1500), rnd.gauss(50, 10)) for day in range(6) for _ in range(3000)]
    rows += [(0, None, None)]
    df = spark.createDataFrame(rows, "day int, user long, v double")
    store = PartitionStore(spark, os.path.join(tmp_out, "days"), "day")
    SK.keep_days(store, df.where("day < 5"), ["user"], ["v"])
    before = store._state(1)["partitions"]
    SK.keep_days(store, df.where("day = 5"), ["user"], ["v"])
    SK.keep_days(store, df.where("day = 2"), ["user"], ["v"])              # loaded again
    after = store._state(3)["partitions"]
    assert [p for p in before if before[p] != after[p]] == ["day=2"]       # the states of other days are not touched
    states = store.read()

    def users(lo, hi):
        return {u for d, u, _ in rows if lo <= d <= hi and u is not None}

    def near(got, want, of):
        return abs(got - want) <= 4 * 0.0163 * of

    whole = SK.distinct_over(states, "user").first()
    assert whole["n"] == len(rows) and near(whole["n_distinct"], len(users(0, 5)), len(users(0, 5)))
    part = SK.distinct_over(states, "user", F.col("day").between(2, 3)).first()
    assert near(part["n_distinct"], len(users(2, 3)), len(users(2, 3)))
    both = SK.overlap(states, "user", F.col("day") <= 2, F.col("day") >= 2).first()
    a, b = users(0, 2), users(2, 5)
    for name, want in (("in_a", a), ("in_b", b), ("in_both", a & b), ("only_a", a - b)):
        assert near(both[name], len(want), len(a | b)), name
    values = sorted(v for *_, v in rows if v is not None)
    got = SK.quantiles_over(states, "v", {"p10": 0.1, "p50": 0.5, "p99": 0.99}).first()
    for name, p in (("p10", 0.1), ("p50", 0.5), ("p99", 0.99)):
        assert abs(sum(v <= got[name] for v in values) / len(values) - p) <= 4 * 0.0133
