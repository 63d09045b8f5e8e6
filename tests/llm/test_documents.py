"""Operators on documents against their plain versions: the small test table, and rows with
nulls, empty and very long texts, ties, repeats and clashing column names."""

from collections import Counter, defaultdict
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidepool.llm import (bpe, decontaminate, licenses, quality_rules, sharding, simhash, substring_dedup, suffix_dedup,
                          token_counts)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def same(got, expected):
    assert Counter(map(tuple, got)) == Counter(map(tuple, expected))


@pytest.fixture(params=["docs", "edges", "empty"])
def table(request):
    return request.getfixturevalue(request.param)


def test_bpe_round_trip(table):
    got = bpe.encode_digest(table, brute.RANKS, public_tokenizers.PATTERN).collect()
    expected = []
    for i, t in pairs(table):
        ids = brute.encoded(t)
        expected.append((i, len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha((t or "").encode())))
    same(got, expected)


def test_bpe_small_blocks(docs):
    from tidepool.llm.pretokens import cut, reassemble, solve_words
    blocks = cut(docs, public_tokenizers.PATTERN, block_bytes=3000)
    got = reassemble(blocks, solve_words(blocks, bpe._merger(brute.RANKS, public_tokenizers.PATTERN)), values=True)
    same([(r.id, r.n, bytes(r.vals)) for r in got.collect()],
         [(i, len(ids), np.array(ids, "<u4").tobytes()) for i, ids in ((i, brute.encoded(t)) for i, t in pairs(docs))])


def test_decode_refuses_unknown_ids(spark):
    with pytest.raises(Exception, match="token-byte table"):
        bpe.decode(spark.createDataFrame([(1, bytearray(b"\xff\xff\x00\x00"))], "doc_id long, ids binary"), brute.RANKS).collect()


def test_token_counts(table):
    costs = token_counts.costs(brute.RANKS)
    from tidepool.llm.pretokens import _cutter
    find = _cutter(public_tokenizers.PATTERN).findall
    known = {}

    def count(word):
        if word not in known:
            best = [(0, 0)]
            for end in range(1, len(word) + 1):
                best.append(min((best[s][0] + costs[word[s:end]], best[s][1] + 1) for s in range(max(0, end - 130), end) if word[s:end] in costs))
            known[word] = best[-1][1]
        return known[word]

    got = token_counts.token_counts(table, brute.RANKS, public_tokenizers.PATTERN).collect()
    same(got, [(i, len(w), sum(count(x.encode()) for x in w)) for i, w in ((i, find(t or "")) for i, t in pairs(table))])


def test_quality_measures(table):
    got = quality_rules.ledger_digest(table).collect()
    expected = []
    for i, t in pairs(table):
        m = brute.quality(t)
        expected.append((i, *m, m[0] < 50 or 100 * m[4] > 50 * m[0]))
    same([r[:7] for r in got], expected)
    assert not any(r.kept for r in got if r.base_failed)


def test_quality_keeps_rows_whole(edges):
    kept = quality_rules.keep_passing(edges)
    assert kept.columns == edges.columns
    good = quality_rules.ledger(edges).where(quality_rules.passes("standard-1")).count()
    assert kept.count() == good > 0
    assert kept.exceptAll(edges).count() == 0


def test_quality_ablation(docs):
    ledger = quality_rules.ledger(docs)
    bits = [r.failed for r in ledger.collect()]
    for r in quality_rules.ablation(ledger, "standard-1").collect():
        bit = quality_rules.BIT[r.rule]
        assert r.n_failed == sum(b & bit > 0 for b in bits) and r.n_only_this == sum(b == bit for b in bits)


def test_simhash(table):
    rows = pairs(table)
    prints = {n: brute.simhash(t) for n, (_, t) in enumerate(rows)}
    comps = brute.groups(prints, lambda a, b: bin(a ^ b).count("1") <= 3)
    least = lambda n: min((rows[m][0] for m in comps[n] if rows[m][0] is not None), default=None)
    got = simhash.near_duplicate_digest(table).collect()
    same(got, [(i, f"{prints[n]:016x}", least(n)) for n, (i, _) in enumerate(rows)])


def test_simhash_keeps_one_row_of_each_group(edges, edge_rows):
    kept = simhash.keep_one(edges)
    prints = {n: brute.simhash(t) for n, (_, t) in enumerate(edge_rows)}
    comps = {frozenset(s) for s in brute.groups(prints, lambda a, b: bin(a ^ b).count("1") <= 3).values()}
    ids = [min((edge_rows[m][0] for m in s if edge_rows[m][0] is not None), default=None) for s in comps]
    assert kept.columns == edges.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(ids)


@pytest.mark.parametrize("cap", [4, 50, 4096])
def test_bk_trees_lose_no_link(spark, cap):
    import random
    from tidepool.llm.graph import components
    rnd = random.Random(cap)
    base, fps = rnd.getrandbits(64), set()
    for _ in range(250):
        x = base
        for b in rnd.sample(range(64), rnd.randint(0, 4)):
            x ^= 1 << b
        fps.add(x)
    fps |= {rnd.getrandbits(64) for _ in range(50)}
    signed = {x - (1 << 64) if x >> 63 else x: x for x in fps}
    rows = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)
    found = {r.node: r.root for r in components(simhash.links(rows, 3, cap=cap)).collect()}
    comps = brute.groups(signed, lambda a, b: bin(a ^ b).count("1") <= 3)
    assert all(found.get(x, x) == min(comps[x]) for x in signed)


def test_a_large_shard_is_cut_again(spark, monkeypatch):
    """100,000 fingerprints agree on two blocks: ten rows more for each, no link lost."""
    import random
    from tidepool.llm.graph import components
    rnd = random.Random(8)
    low = (1 << 25) - 1
    fps = {rnd.getrandbits(39) << 25 | 12345 for _ in range(100_000)}
    near = []
    for x in rnd.sample(sorted(fps), 500):
        y = x
        for b in rnd.sample(range(25, 64), rnd.randint(1, 3)):
            y ^= 1 << b
        near.append((x, y))
    fps |= {y for _, y in near}
    assert {x & low for x in fps} == {12345}
    sizes, plain = {}, simhash.stage

    def counted(df, name):
        out = plain(df, name)
        sizes.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(simhash, "stage", counted)
    rows = spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long").repartition(8)
    found = {r.node: r.root for r in components(simhash.links(rows, 3)).collect()}
    assert sizes == {"llm-large-shards": [1, 0], "llm-cut-shards": [10 * len(fps)]}
    root = lambda x: found.get(simhash._signed(x), simhash._signed(x))
    assert all(root(x) == root(y) for x, y in near)


def test_components_of_a_long_path(spark):
    from tidepool.llm.graph import components
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    assert {(r.node, r.root) for r in components(edges).collect()} == {(i, 0) for i in range(1, 201)} | {(501, 500)}


def _repeats(rows):
    blobs = [(t or "").encode() for _, t in rows]
    masks = brute.repeats(blobs)
    return [(i, len(b), int(m.sum()), brute.spans(m), brute.sha(brute.cut(b, m))) for (i, _), b, m in zip(rows, blobs, masks)]


def test_suffix_dedup(table):
    same(suffix_dedup.repeats_digest(table).collect(), _repeats(pairs(table)))


def test_suffix_dedup_short_periods_overlaps_and_pieces(spark, monkeypatch):
    import random
    rnd = random.Random(3)
    text = lambda n: "".join(rnd.choice("ab") for _ in range(n))
    a, b = text(230), text(600)
    rows = [(1, "ab" * 400), (2, a + text(50) + b[:201]), (3, text(90) + a[10:215]), (4, b), (5, text(199)), (6, "x" * 199), (7, "x" * 200),
            (8, b[100:299] + "!"), (9, text(400) + b[250:460] + a[:200]), (10, "x" * 150 + "y" * 150), (11, "z" + "x" * 201)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    same(suffix_dedup.repeats_digest(df).collect(), _repeats(rows))
    monkeypatch.setattr(suffix_dedup, "PIECE", 256)       # long texts in parts
    same(suffix_dedup.repeats_digest(df).collect(), _repeats(rows))


def test_suffix_dedup_keeps_valid_text(edges, edge_rows):
    cut = suffix_dedup.dedup(edges)
    assert cut.columns == edges.columns and cut.dtypes == edges.dtypes
    blobs = [(t or "").encode() for _, t in edge_rows]
    expected = [(i, None if t is None else brute.cut(b, m).decode("utf-8", "ignore")) for (i, t), b, m in zip(edge_rows, blobs, brute.repeats(blobs))]
    same(pairs(cut), expected)


def test_suffix_dedup_lengths(spark, docs):
    blobs = [(t or "").encode() for _, t in pairs(docs)]
    got = [bytes(r.kept) for r in suffix_dedup.remove_repeats(docs, F.col("doc_id"), length=319).select("kept").collect()]
    same([(b,) for b in got], [(brute.cut(b, m),) for b, m in zip(blobs, brute.repeats(blobs, 319))])
    with pytest.raises(ValueError, match="8 bits"):
        suffix_dedup.remove_repeats(docs, F.col("doc_id"), length=320)


@pytest.mark.parametrize("min_run", [0, 20])
def test_substring_dedup(table, min_run):
    blob = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = [(r.doc_id, r.text, r.key) for r in table.select("doc_id", "text", F.xxhash64("doc_id", blob).alias("key")).collect()]
    seen, expected = set(), {}
    # rows equal in id and text are one; rows of one id rank by their digest
    for i, t, _ in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[2])):
        blob, gone = (t or "").encode(), []
        for a, b, name in brute.line_units(blob, 5):
            gone += [(a, b)] if name in seen else []
            seen.add(name)
        gone = brute.runs_of(blob, gone, 5, min_run)
        kept = b"".join(blob[x:y] for x, y in zip([0, *(b for _, b in gone)], [*(a for a, _ in gone), len(blob)]))
        expected[i, t] = (len(gone), tuple(gone) or None, len(kept), brute.sha(kept))
    got = [(r.doc_id, r.n_removed, tuple((s.start, s.end) for s in r.removed) if r.removed else None, r.kept_bytes, r.kept_sha256)
           for r in substring_dedup.dedup_digest(table, min_run).collect()]
    same(got, [(i, *expected[i, t]) for i, t, _ in rows])


def test_short_runs_stay(spark):
    passage = "One two three four five,\nsix. Seven eight nine ten eleven;\ntwelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty\n"
    title = "Notes of the whole week\n"
    fresh = "some words that no other text has\n"
    df = spark.createDataFrame([(1, title + passage), (2, title + fresh + passage + "new"), (3, "a " + passage[:40])], "doc_id long, text string")
    kept = {r.row: r.kept.decode() for r in substring_dedup.dedup_units(df, F.col("doc_id"), min_run=20).collect()}
    assert kept[1] == title + passage
    assert kept[2] == title + fresh + "new"
    assert kept[3] == "a " + passage[:40]


def test_substring_units():
    text = "One two three four five, six. SEVEN  eight\nnine ten eleven; twelve\n\nthirteen"
    cut = lambda unit, clauses: [text.encode()[a:b].decode() for a, b, _ in substring_dedup.units(text.encode(), unit, clauses, 1)]
    assert cut("line", False) == ["One two three four five, six. SEVEN  eight\n", "nine ten eleven; twelve\n", "thirteen"]
    assert cut("line", True) == ["One two three four five, ", "six. ", "SEVEN  eight\n", "nine ten eleven; ", "twelve\n", "thirteen"]
    assert cut("paragraph", False) == ["One two three four five, six. SEVEN  eight\nnine ten eleven; twelve\n\n", "thirteen"]
    digests = [d for _, _, d in substring_dedup.units(b"A  b\nc\na B", "line", False, 1)]
    assert digests[0] == digests[2] != digests[1]


def test_a_repeated_line_goes_whole(spark):
    short, mixed, tiny = "a, b c, d e. f g\n", "Yes, one two three four five six; no, never. Seven eight nine ten eleven, \n", "ok\n"
    other = "Yes, one two three four five six; but no.\n"
    rows = [(1, short + mixed + tiny), (2, "new " + tiny + "A,  B c,\x0bd E. f g\t\n" + mixed.upper() + tiny + other + "\n"), (3, "ok")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.row: r.kept.decode() for r in substring_dedup.dedup_units(df, F.col("doc_id")).collect()}
    assert kept == {1: rows[0][1], 2: "new ok\nYes, but no.\n\n", 3: ""}
    kept = {r.row: r.kept.decode() for r in substring_dedup.dedup_units(df, F.col("doc_id"), clauses=False).collect()}
    assert kept == {1: rows[0][1], 2: "new ok\n" + other + "\n", 3: ""}


def test_sharding(table):
    rows = pairs(table)
    got = sharding.shard_digest(table).collect()
    same([(r.doc_id, r.size, r.text_crc32) for r in got], [(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows])
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert 0 <= r.shard < 40 and r.law == "bytes" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_are_near_equal_and_split_only_large_groups(spark):
    rows = [(i, ("x" if i % 3 == 0 else f"t{i // 2} ") * 40) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sharding.shard(df, 10).select("row.text", "size", "shard").collect()
    sizes, where = Counter(), defaultdict(set)
    for text, size, shard in got:
        sizes[shard] += size
        where[text].add(shard)
    mean = sum(sizes.values()) / 10
    assert all(abs(s - mean) < 0.03 * mean for s in sizes.values())
    assert [t for t, s in where.items() if len(s) > 1] == ["x" * 40]      # a third of all rows


def test_shards_do_not_follow_the_session(spark):
    rows = [(i, f"t{i // 40} " * 40) for i in range(8000)]      # 200 groups of 0.5% each
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in (4, 40, 97):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            got = sharding.shard(df, 4, tolerance=0.02).select("row.doc_id", "row.text", "shard", "slot").collect()
            found.append(sorted(tuple(r) for r in got))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2]
    where = defaultdict(set)
    for _, text, shard, _ in found[0]:
        where[text].add(shard)
    assert all(len(s) == 1 for s in where.values())


def test_benchmark_leaks(docs, spark):
    from tests.conftest import SF_SMALL
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(docs, items).collect()}
    its = [(r.item_id, r.text) for r in items.collect()]
    found = {i: set(brute.shingles(t)) for i, t in its}
    expected = {}
    for d, t in pairs(docs):
        mine = set(brute.shingles(t))
        for i, item in its:
            if mine & found[i] and (s := brute.leaks(t, item)) >= 0.8:
                expected[d, i] = round(s, 6)
    assert got == expected and got


def test_benchmark_leaks_near_and_edges(spark, edges, empty):
    words = [f"q{i}" for i in range(60)]
    text = " ".join
    items = spark.createDataFrame([(1, text(words[:40])), (2, text(words)), (3, "one two"), (4, None), (5, ""), (1, text(words[:40]))],
                                  "item_id long, text string")
    rows = [(1, "before " + text(words[:40]).upper() + ", after"), (2, text(words[:35])), (3, text(words[:30])),
            (4, text(words[:20] + ["new"] + words[21:])), (5, text(words[:29] + ["other"] + words[30:40])), (6, "ONE, two!"),
            (7, "so one two"), (None, text(words)), (8, None), (9, text(["z"] * 3000 + words[5:40]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, items).collect()}
    want = {(d, r.item_id) for d, t in rows for r in items.collect() if brute.leaks(t, r.text) >= 0.8}
    assert got == want and (1, 1) in got and (2, 1) in got and (6, 3) in got and (7, 3) not in got and (3, 1) not in got
    kept = decontaminate.drop_contaminated(edges, items)
    assert kept.columns == edges.columns
    assert edges.count() - kept.count() == 2 and kept.where("text = 'one two'").count() == 0
    assert decontaminate.drop_contaminated(empty, items).count() == 0
    assert decontaminate.drop_contaminated(edges, items.where("1 = 0")).count() == edges.count()


def test_fingerprints_and_blocks(spark):
    import random
    rnd = random.Random(2)
    rows = [([rnd.getrandbits(64) - (1 << 63) for _ in range(n)],) for n in (1, 2, 7, 60)]
    got = decontaminate.with_fingerprint(spark.createDataFrame(rows, "h array<long>"), "h", "fp").collect()
    for r in got:
        u = [x % (1 << 64) for x in r.h]
        assert r.fp % (1 << 64) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in u) > len(u))
    parts = spark.createDataFrame([(-12345678987654321,)], "fp long").select(decontaminate.blocks("fp", 24).alias("b")).first().b
    edges = [64 * i // 25 for i in range(26)]
    assert sum(p.bits << e for p, e in zip(parts, edges)) == -12345678987654321 % (1 << 64)


def test_fingerprints_of_long_texts(spark):
    a, b = 0x0123456789ABCDEF, -0x123456789ABCDEF0
    rows = [(a, 40_000, b, 30_000), (b, 65_535, a, 1), (b, 65_536, a, 65_535), (a, 65_535, b, 0), (b, 65_536, a, 0), (a, 200_000, b, 0), (b, 32_767, a, 0), (b, 32_768, a, 0)]
    df = spark.createDataFrame(rows, "a long, n int, b long, m int").withColumn("h", F.expr("concat(array_repeat(a, n), array_repeat(b, m))"))
    assert [r.fp == r.a for r in decontaminate.with_fingerprint(df, "h", "fp").collect()] == [True] * len(rows)


def test_licenses(edges, empty, spark):
    got = licenses.scan(edges).collect()
    assert [(r.doc_id, r.kind, r.license, r.dice) for r in got] == [(12, "line", "MIT", 1.0)]
    assert licenses.scan(empty).count() == 0
    df = spark.createDataFrame([(1, "Licensed under the apache LICENSE,\nversion 2.0\n\nx\n\nnothing here"), (2, "Released under the GPL License.")],
                               "doc_id long, text string")
    assert [(r.doc_id, r.kind, r.unit, r.license) for r in licenses.scan(df).collect()] == [(1, "paragraph", 0, "Apache-2.0")]


def test_license_passages(edges, empty, spark):
    apache = ["# Copyright 2024 Acme", "#", '# Licensed under the Apache License, Version 2.0 (the "License");', "# you may not use this file except in compliance with the License.",
              "# You may obtain a copy of the License at", "#", "#     http://www.apache.org/licenses/LICENSE-2.0", "#",
              "# Unless required by applicable law or agreed to in writing, software", '# distributed under the License is distributed on an "AS IS" BASIS,',
              "# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.", "# See the License for the specific language governing permissions and",
              "# limitations under the License.", "#", "import os", "print(os.getcwd())"]
    prose = "It is of use to many. Released under the MIT License. See the site for more: it has all."
    rows = [(1, "\n".join(apache)), (2, "(c) 2024 Acme. Released under the MIT License."), (None, prose), (None, prose), (3, "x. " * 5000 + prose),
            (4, "Licensed under CC\nBY\n4.0. Licensed under the GPL"), (5, "released under my licensed under it"), (6, None), (7, "Released"),
            (8, "Released under the MIT License. Released under the MIT License."), (9, " ".join(dict(enumerate(licenses.TEMPLATES))[8][1].split()) + " Fine.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in licenses.passages(df).collect()]
    words = lambda x: re.findall(r"[^\W_]+", x.lower())
    grams = lambda w: set(zip(w, w[1:]))
    wanted = [(i, name, grams(words(t))) for i, (name, t) in enumerate(licenses.TEMPLATES)]
    longest = max(int((len(words(t)) - 1) * 1.1 / 0.9 + 1e-9) + 1 for _, t in licenses.TEMPLATES)
    expected = []
    for i, text in rows:
        pieces = [w for w in map(words, re.split(r"(?<=[.!?;:])\s+|\n", text or "")) if w]
        for a in range(len(pieces)):
            have = []
            for b in range(a, len(pieces)):
                have += pieces[b]
                if len(have) > longest:
                    break
                mine = grams(have) if len(set(have)) > 1 else set()
                for n, name, want in wanted if mine else []:
                    dice = 2 * len(mine & want) / (len(mine) + len(want))
                    if dice >= 0.9:
                        expected.append((i, a, b, name, n, round(dice, 6)))
    same(got, expected)
    assert {(1, "Apache-2.0"), (2, "MIT"), (None, "MIT"), (3, "MIT"), (4, "CC-BY-4.0"), (8, "MIT"), (9, "GPL-3.0")} == {(r[0], r[3]) for r in got}
    assert any(r[0] == 1 and r[5] == 1.0 and r[2] - r[1] > 5 for r in got)
    assert [r.doc_id for r in licenses.passages(edges).collect()] == [12]
    assert licenses.passages(empty).count() == 0 and licenses.passages(df, templates=[("x", "one")]).count() == 0
    paragraph = spark.createDataFrame([(1, "\n".join(apache[2:5]))], "doc_id long, text string")
    assert ("paragraph", "Apache-2.0", 1.0) in [(r.kind, r.license, r.dice) for r in licenses.scan(paragraph).collect()]
