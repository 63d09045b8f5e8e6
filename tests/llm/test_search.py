"""Operators 11 to 13 against plain versions: the small test tables, and rows with nulls, empty and
very long texts, ties, repeats and clashing column names."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidepool.llm import hamming_ann, lexical, phrases

LOWER = {i: i + 32 for i in range(65, 91)}


@pytest.fixture(params=["docs", "edges", "empty"])
def table(request):
    return request.getfixturevalue(request.param)


# ---------------------------------------------------------------- 11

def nearest(rows, asked, k):
    """(query, rank, id, score) for rows of (id, vector)."""
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    out = []
    for i in sorted({i for i in ids.tolist() if asked(i)}):
        d = np.sqrt(((x - x[ids == i][0]) ** 2).sum(1))
        near = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
        out += [(i, n + 1, int(ids[j]), float(d[j])) for n, j in enumerate(near)]
    return out


def found(df):
    return sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect()))


def test_ann_recall(spark):
    vectors = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    got = found(hamming_ann.search(vectors, F.col("id") % 20 == 0))
    expected = nearest([tuple(r) for r in vectors.select("vec_id", "embedding").collect()], lambda i: i % 20 == 0, 10)
    scores = {(q, v): s for q, _, v, s in expected}
    both = [(q, v) for q, _, v, _ in got if (q, v) in scores]
    assert len(got) == len(expected) and len(both) >= 0.9 * len(expected)
    assert all(s == scores[q, v] for q, _, v, s in got if (q, v) in scores)
    for q in {q for q, *_ in got}:
        mine = [(s, v) for a, _, v, s in got if a == q]
        assert mine == sorted(mine) and [r for a, r, *_ in got if a == q] == list(range(1, len(mine) + 1))


def test_ann_finds_all_near_vectors_among_many(spark, monkeypatch):
    """Cells and blocks of a few rows: prefixes, salts and several rounds, on clustered vectors."""
    monkeypatch.setattr(hamming_ann, "CELL", 64)
    monkeypatch.setattr(hamming_ann, "VISITS", 8)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + rng.normal(size=16) * 0.1).tolist()) for i in range(4000)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = found(hamming_ann.search(vectors, F.col("id") % 100 == 0, sample=100))
    expected = nearest(rows, lambda i: i % 100 == 0, 10)
    assert len(got) == len(expected)
    assert len({(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in expected}) >= 0.9 * len(expected)


def test_every_code_within_the_radius_is_found(spark, monkeypatch):
    monkeypatch.setattr(hamming_ann, "CELL", 32)
    monkeypatch.setattr(hamming_ann, "VISITS", 4)
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 256, (300, 32), np.uint8)
    codes[150:] = codes[:150] ^ (rng.random((150, 32)) < 0.2) * rng.integers(0, 256, (150, 32), np.uint8)
    have = spark.createDataFrame([(i, bytearray(c)) for i, c in enumerate(codes)], "id long, code binary")
    for radius in (0, 15, 40, 90, 256):
        ask = spark.createDataFrame([(i, bytearray(codes[i]), radius, i // 10) for i in range(0, 300, 30)],
                                    "id long, code binary, radius long, past long")
        got = sorted((r.query, r.vec) for r in hamming_ann._within(have, ask, 4).collect())
        bits = np.bitwise_count(codes[:, None] ^ codes[None]).sum(-1)
        assert got == [(q, v) for q in range(0, 300, 30) for v in range(300) if q // 10 < bits[q, v] <= radius]


def test_ann_copies_ties_and_bad_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 60)] + [(100, [1.0, 2.0, 3.5]), (200, [1.0, 2.0, 2.5]), (300, [9.0, 9.0, 9.0])]
    bad = [(400, None), (500, [0.0, 0.0, 0.0]), (600, [1.0, None, 2.0]), (700, [nan, 1.0, 1.0]), (800, [inf, 1.0, 1.0]), (900, [1.0]),
           (1000, []), (None, [1.0, 2.0, 3.0])]
    vectors = spark.createDataFrame(rows + bad + rows[:3], "vec_id long, embedding array<double>")
    vectors = vectors.withColumns({"id": F.lit(1), "vec": F.lit("x"), "score": F.lit(0.0), "rank": F.lit(1), "no": F.lit(2)}).repartition(4)
    got = found(hamming_ann.search(vectors, F.col("id") % 100 == 0))
    assert got == sorted(nearest(rows, lambda i: i % 100 == 0, 10))


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0])], [(0, [1.0, 2.0]), (1, [2.0, 1.0])], [(0, None)], [(1, [1.0, 2.0])]])
def test_ann_few_vectors(spark, rows):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    good = [r for r in rows if r[1]]
    assert found(hamming_ann.search(vectors, F.col("id") % 100 == 0)) == nearest(good, lambda i: i % 100 == 0, 10)


# ---------------------------------------------------------------- 12

def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def ranked(docs, items, k=20):
    """(item, rank, doc, score) for rows of (id, text)."""
    held = [(i, plain_terms(t)) for i, t in docs]
    held = [(i, len(ws), Counter(ws)) for i, ws in held if ws]
    total, df = sum(n for _, n, _ in held), Counter(t for *_, ws in held for t in ws)
    out = []
    for item, text in set(items):
        scores = []
        for doc, n, ws in held:
            m = 75 + 25 * n * len(held) // total
            s = sum(math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) * (10**9 * ws[t] // (1000 * ws[t] + 12 * m))
                    for t in plain_terms(text) if t in ws)
            if s > 0 and doc is not None:
                scores.append((-s, doc))
        out += [(item, r + 1, doc, -s) for r, (s, doc) in enumerate(sorted(scores)[:k])]
    return out


def items_of(spark, table):
    """The benchmark, and items of other kinds."""
    rows = [(900, "one two TWO two"), (901, None), (902, ""), (903, " ,. "), (904, "Ünïcode 日本語"), (905, "nosuchterm"), (906, "one two"),
            (906, "one two"), (None, "the r"), (907, " ".join(f"w{i * i % 9973}" for i in range(3000)))]
    more = spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, doc_id string")
    return spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").withColumn("doc_id", F.lit("y")).unionByName(more)


@pytest.mark.parametrize("owners", [1, 4])
def test_ranked_search(spark, table, owners):
    items = items_of(spark, table)
    got = lexical.search(table, items, owners=owners).collect()
    expected = ranked([(r.doc_id, r.text) for r in table.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert Counter(map(tuple, got)) == Counter(expected)


def test_ranked_search_small_bounds(spark, docs, monkeypatch):
    """Many blocks, bundles and passes give the same rows."""
    for name, value in (("BLOCK_DOCS", 7), ("BUNDLE_ITEMS", 3), ("PASS_BUNDLES", 5), ("PASS_BYTES", 4000)):
        monkeypatch.setattr(lexical, name, value)
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    got = lexical.search(docs, items, k=5).collect()
    expected = ranked([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 5)
    assert Counter(map(tuple, got)) == Counter(expected)


def test_ranked_search_without_items(spark, docs):
    assert lexical.search(docs, spark.createDataFrame([], "item_id long, text string")).collect() == []


def test_lengths_beyond_64_bits():
    n = np.array([10, 10**9], np.int64)
    assert lexical.lengths(n, 10**12, 10**15).tolist() == [75 + 25 * 10 * 10**12 // 10**15, 75 + 25 * 10**9 * 10**12 // 10**15]


# ---------------------------------------------------------------- 13

def collocated(rows, least=30, limit=2000, longest=4, inside=80):
    f, n, out = defaultdict(Counter), Counter(), []
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n["und" if lang is None else lang] += len(ws)
            for k in range(1, longest + 1):
                f["und" if lang is None else lang].update(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))
    for lang, count in f.items():
        several = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        gone = {p[i:i + k] for p, a in several.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
                if 100 * a >= inside * several[p[i:i + k]]}
        scored = []
        for p, a in several.items():
            if p not in gone:
                score, k = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:limit])]
    return sorted(out)


def listed(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


@pytest.mark.parametrize("least, limit", [(30, 2000), (3, 7)])
def test_collocations(table, least, limit):
    expected = collocated([(r.lang, r.text) for r in table.collect()], least, limit)
    assert listed(phrases.collocations(table, least=least, limit=limit)) == expected


def test_collocations_of_null_and_odd_languages(spark, edge_rows):
    rows = [(None if i % 3 else ("", "und", "日本")[i % 9 // 3], t) for i, (_, t) in enumerate(edge_rows)] + [("en", "a b\tc d. A B c")] * 40
    df = spark.createDataFrame([(a, b, 1, "w") for a, b in rows], "lang string, text string, id int, words string").repartition(3)
    assert listed(phrases.collocations(df, least=2)) == collocated(rows, 2)


def test_collocations_small_bounds(docs):
    """Many blocks and many tries give the same phrases."""
    expected = collocated([(r.lang, r.text) for r in docs.collect()], 4)
    assert len(expected) > 200
    assert listed(phrases.collocations(docs, least=4, block_bytes=20_000, trie_phrases=100)) == expected


def test_double_array():
    rng = np.random.default_rng(3)
    for level in (2, 3, 4):
        held = np.unique(rng.zipf(1.4, (5000, level)) % 400 + 1, axis=0)
        trie = phrases.double_array(held)
        text = rng.zipf(1.4, 30_000) % 400
        want = {tuple(p): i + 1 for i, p in enumerate(held.tolist())}
        places = text.tolist()
        assert phrases.accepted(trie, level, text).tolist() == [want.get(tuple(places[i:i + level]), 0) for i in range(len(places))]
