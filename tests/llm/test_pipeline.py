"""The pipeline against plain versions of its stages."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.conftest import SF_SMALL
from tests.llm import brute
from tidepool.llm import quality_rules, sharding
from tidepool.llm.common import release, stage, staging


def plain(rows, items):
    """{doc_id: (n_tokens, ids digest)} for (doc_id, text) rows with distinct ids."""
    def passes(t):
        words, chars, symbols, dup, repeat = brute.quality(t)
        lines = sum(1 for x in (t or "").split("\n") if brute.SPACE.search(x))
        bars = sum(w == "|" for w in brute.SPACE.findall(t or ""))
        return not (words < 50 or 100 * repeat > 50 * words or 10 * symbols > 2 * words or 10 * dup > 6 * lines
                    or chars < 2 * words or chars > 20 * words or 10 * bars > 3 * words)

    left = {i: t for i, t in rows if passes(t)}
    comps = brute.groups({i: brute.simhash(t) for i, t in left.items()}, lambda a, b: bin(a ^ b).count("1") <= 3)
    left = {i: t for i, t in left.items() if i == min(comps[i])}
    blobs = {i: t.encode() for i, t in left.items()}
    left = {i: brute.cut(b, m).decode("utf-8", "ignore") for (i, b), m in zip(blobs.items(), brute.repeats(list(blobs.values())))}
    sets = [(set(brute.shingles(t)), t) for t in items]
    left = {i: t for i, t in left.items()
            if not any(s & set(brute.shingles(t)) and brute.leaks(t, x) >= 0.8 for s, x in sets)}
    return {i: (len(e), brute.sha(np.array(e, "<u4").tobytes()), brute.sha(t.encode())) for i, t in left.items() for e in [brute.encoded(t)]}


def test_pipeline_matches_plain_stages(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in P.run(spark, SF_SMALL).collect()}
    assert got == plain(docs, items) and len(got) > 50


def test_stages_take_edge_rows_and_empty_tables(spark, edges, empty):
    for start in (edges, empty):
        docs = start
        for name, step in P.STAGES[:-1]:
            out = stage(step(spark, docs, SF_SMALL), f"test-{name}")
            assert out.columns == docs.columns, name
            docs = out
        last = P.STAGES[-1][1](spark, docs, SF_SMALL)
        assert last.count() == docs.count()


def test_stages_change_nothing_in_clean_rows(spark):
    rows = [(i, " ".join(f"word{(i * 977 + k * 31) % 100_003}" for k in range(80))) for i in range(20)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = docs
    for _, step in P.STAGES[:-1]:
        out = step(spark, out, SF_SMALL)
    assert Counter(map(tuple, out.collect())) == Counter(map(tuple, docs.collect()))


def test_rules_have_one_bit_each():
    assert sorted(quality_rules.BIT.values()) == [1 << i for i in range(len(quality_rules.RULES))]


def test_map_columns_are_carried_along(spark):
    words = lambda i: " ".join(f"word{(i * 977 + k * 31) % 100_003}" for k in range(80))
    rows = [(i, words(i)) for i in range(20)] + [(100 + i, words(i)) for i in range(5)] + [(3, words(3)), (None, words(50)), (7, None)]
    docs = (spark.createDataFrame(rows, "doc_id long, text string")
            .withColumn("tags", F.expr("if(doc_id = 5, null, map('id', doc_id, 'n', length(text)))"))
            .withColumn("deep", F.array(F.struct("tags"))))
    out = docs
    for name, step in P.STAGES[:-1]:
        out = stage(step(spark, out, SF_SMALL), f"test-{name}")
        assert out.columns == docs.columns, name
    got = {r.doc_id: (r.tags, r.deep[0].tags) for r in out.collect()}
    assert set(got) == {*range(20), None} and out.count() == 21
    assert all(a == b and (a is None if i == 5 else a["id"] == i) for i, (a, b) in got.items())
    dealt = sharding.shard(docs, 4).select("row.doc_id", "row.tags").collect()
    assert len(dealt) == len(rows) and all(r.tags is None if r.doc_id == 5 else r.doc_id is None or r.tags["id"] == r.doc_id for r in dealt)


def test_staging_blocks_are_apart(spark):
    with staging() as outer:
        a = stage(spark.range(3), "test-a")
        with staging() as inner:
            b = stage(spark.range(4), "test-b")
    c = stage(spark.range(5), "test-c")
    assert [p.rsplit("/", 1)[1][:6] for p in (*outer, *inner)] == ["test-a", "test-b"]
    release(spark, inner)
    assert a.count() == 3 and c.count() == 5
    with pytest.raises(Exception, match="test-b"):
        b.collect()
