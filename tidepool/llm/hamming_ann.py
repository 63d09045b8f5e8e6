"""Approximate nearest neighbours by multi-index hashing.

Learned codes: the vectors, centred, are turned by learned rotations (principal axes, then
rotations that bring the vectors near the corners of a cube) and each coordinate's sign is a
bit, 256 in all.  They are fitted on a bounded sample, the ``sample`` distinct vectors of
least hash (8,192 unless said otherwise); every vector is coded and indexed.

Index: a code's 16 substrings of 16 bits each go to a cell, the substring's number and its
first ``p`` bits, so many that a cell holds 16,384 codes on average.  Two codes within
``r`` bits differ in ``r div 16`` bits or fewer in one substring at least (pigeonhole), so a
query visits, for each substring, the cells whose prefix is that near; there it meets the
codes whose whole substring is that near, and keeps those within ``r``, each pair in the
first substring that finds it.  All codes within the radius are found.  Then distances are
computed on the vectors themselves, in doubles.

Radius: the sample also gives the curve ``need(d)``, the bits within which 97% of the
pairs at distance ``d`` or less lie, and ``half(d)``, those that half of them need.  A query
is done when its k + 1 nearest lie at distance ``d`` and its radius is ``need(d)`` or more;
else it goes on with the larger radius in a further round, up to all bits, where only the
codes beyond its last radius are new.  The first radius is ``half`` of the distance to the
nearest sampled vectors where the sample is dense enough to tell (N up to 11 times the
sample for k = 10), else it starts at no bit per substring.  So the work follows the density
of the vectors and no number of candidates is fixed; there is no cap on a cell, a query or a
result.

Skew: equal vectors are indexed once, with their k + 1 smallest ids, which is all that a
result can hold of them; equal queries are searched once.  A cell with more codes or visits
than a block takes (16,384 and 4,096) is cut into blocks of both, and every block of codes
meets every block of visits.

Vectors that are null, zero, of another length than most rows have, or that hold a null or
non-finite component take no part, nor do rows without an id.  Rows that repeat an id and
its vector count once; an id with several vectors has several candidates and searches for
the least of its vectors.  Ties go to the smaller id.  With k other vectors or fewer all are
returned.  An empty table gives no rows.  Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import ragged, stage

BITS, WIDTH = 256, 16
SUBSTRINGS = BITS // WIDTH
CELL, VISITS = 16_384, 4_096
FLUSH = 1 << 16                           # codes or visits gathered before a task sends its cells
PACKED = "sub int, cell int, n int, ids binary, codes binary, radii binary, past binary"


# ---------------------------------------------------------------- learned codes

def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


class Coder:
    """Mean, turning matrix and need(d) of a sample of vectors (rows of ``x``)."""

    def __init__(self, x: np.ndarray, rounds: int = 30, covered: float = 0.97, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean = x.mean(0)
        z = x - self.mean
        axes = np.linalg.svd(z, full_matrices=len(z) < x.shape[1])[2][:BITS].T
        turned, bits = z @ axes, []
        while sum(b.shape[1] for b in bits) < BITS:
            r = np.linalg.qr(rng.normal(size=(axes.shape[1],) * 2))[0]
            for _ in range(rounds):
                u, _, w = np.linalg.svd(np.where(turned @ r > 0, 1.0, -1.0).T @ turned)
                r = (u @ w).T
            bits.append(axes @ r)
        self.turn = np.concatenate(bits, 1)[:, :BITS]
        self.sample, self.codes = x.astype(np.float32), self.code(x)
        self._calibrate(x, covered)

    def code(self, x: np.ndarray) -> np.ndarray:
        return np.packbits((x - self.mean) @ self.turn > 0, axis=1)

    def _calibrate(self, x: np.ndarray, covered: float) -> None:
        few = x[:512]                                      # in hash order: any of them
        far = np.sqrt(np.maximum((few ** 2).sum(1)[:, None] + (x ** 2).sum(1) - 2 * few @ x.T, 0)).ravel()
        bits = hamming(self.codes[:len(few), None], self.codes[None]).ravel()
        at = np.quantile(far, [0, 0.5])                    # nearer pairs than the median are the ones to tell
        edges = np.linspace(0, at[1] or 1.0, 129)[1:]
        bin_of = np.searchsorted(edges, far)
        self.edges, self.curves = edges, {}
        for name, part in (("need", covered), ("half", 0.5)):
            curve = np.zeros(len(edges) + 1)
            for b in range(len(edges)):
                own = bits[bin_of == b]
                if len(own) >= 32:
                    curve[b] = np.quantile(own, part, method="higher")
            known = np.flatnonzero(curve)
            curve[-1] = BITS
            for b in range(len(edges)):                    # between, the root of the distance from the next known bin
                if not curve[b]:
                    nxt = known[known > b]
                    curve[b] = np.ceil(curve[nxt[0]] * np.sqrt(edges[b] / edges[nxt[0]])) if len(nxt) else BITS
            self.curves[name] = np.maximum.accumulate(curve).astype(np.int64)

    def need(self, d: np.ndarray) -> np.ndarray:
        return self.curves["need"][np.searchsorted(self.edges, d)]

    def half(self, d: np.ndarray) -> np.ndarray:
        return self.curves["half"][np.searchsorted(self.edges, d)]


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(np.bitwise_xor(a.view(np.uint64), b.view(np.uint64))).sum(-1, dtype=np.int64)


# ---------------------------------------------------------------- tasks

def _code_rows(coder: Coder, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = coder.code(_matrix(batch.column(1), dim))
            body = pa.FixedSizeBinaryArray.from_buffers(pa.binary(BITS // 8), len(codes), [None, pa.py_buffer(codes.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), body.cast(pa.binary())], ["id", "code"])

    return run


def _first_radius(coder: Coder, dim: int, rank: float):
    """The radius at which a query's search begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = coder.sample.astype(np.float64)
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            radius = np.full(len(x), SUBSTRINGS - 1, np.int64)
            if rank >= 1:
                nth = min(int(np.ceil(rank)), len(sample) - 1)         # the query itself may be sampled
                for i in range(0, len(x), 256):
                    d = np.maximum((x[i:i + 256] ** 2).sum(1)[:, None] + (sample ** 2).sum(1) - 2 * x[i:i + 256] @ sample.T, 0)
                    radius[i:i + 256] = np.maximum(radius[i:i + 256], coder.half(np.sqrt(np.partition(d, nth, axis=1)[:, nth])))
            codes = coder.code(x)
            body = pa.FixedSizeBinaryArray.from_buffers(pa.binary(BITS // 8), len(codes), [None, pa.py_buffer(codes.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), body.cast(pa.binary()), pa.array(np.minimum(radius, BITS)),
                                              pa.array(np.full(len(x), -1, np.int64))], ["id", "code", "radius", "past"])

    return run


def _codes_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BITS // 8)


def _deal(prefix: int, queries: bool):
    """Codes to their cells, or queries to the cells they visit; a row for each cell and 65,536 of them."""

    def flush(ids, codes, radii, past):
        subs = codes.view(np.uint16)
        masks = np.arange(1 << prefix)
        masks = masks[np.argsort(np.bitwise_count(masks.astype(np.uint32)), kind="stable")]
        upto = np.searchsorted(np.bitwise_count(masks.astype(np.uint32)), np.arange(WIDTH + 1), "right")
        rows = []
        for sub in range(SUBSTRINGS):
            own = (subs[:, sub] >> (WIDTH - prefix)).astype(np.int64)
            who = np.arange(len(ids))
            if queries:
                visits = upto[np.minimum(radii // SUBSTRINGS, WIDTH)]
                who = np.repeat(who, visits)
                own = own[who] ^ masks[ragged(np.zeros(len(ids), np.int64), visits)]
            order = np.argsort(own, kind="stable")
            own, who = own[order], who[order]
            for part in np.split(np.arange(len(own)), np.flatnonzero(own[1:] != own[:-1]) + 1):
                for at in range(0, len(part), VISITS):
                    few = part[at:at + VISITS]
                    w = who[few]
                    asked = (radii[w].tobytes(), past[w].tobytes()) if queries else (None, None)
                    rows.append((sub, int(own[few[0]]), len(w), ids[w].tobytes(), codes[w].tobytes(), *asked))
        types = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                          ["sub", "cell", "n", "ids", "codes", "radii", "past"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            none = np.zeros(batch.num_rows, np.int64)
            radii, past = (batch.column(i).to_numpy() if queries else none for i in (2, 3))
            held.append((batch.column(0).to_numpy(), _codes_of(batch.column(1)), radii, past))
            size += batch.num_rows
            if size >= FLUSH:
                yield flush(*(np.concatenate(x) for x in zip(*held)))
                held, size = [], 0
        if held:
            yield flush(*(np.concatenate(x) for x in zip(*held)))

    return run


def _probe(left: pa.Table, right: pa.Table) -> pa.Table:
    """One block of a cell's codes and one of its visits: the pairs within the visit's radius and
    beyond its last one, where this substring is the first to find them."""
    out = {"query": [], "vec": []}
    if left.num_rows and right.num_rows:
        sub = left["sub"][0].as_py()
        vec, query, radius, past = (np.frombuffer(b"".join(c.to_pylist()), np.int64)
                                    for c in (left["ids"], right["ids"], right["radii"], right["past"]))
        have, want = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(-1, BITS // 8) for c in (left["codes"], right["codes"]))
        flips = (radius // SUBSTRINGS).astype(np.uint8)
        mine, theirs = (np.ascontiguousarray(x.view(np.uint16)[:, sub]) for x in (have, want))
        step = max(1, (1 << 22) // max(1, len(vec)))
        for i in range(0, len(query), step):
            near = np.bitwise_count(theirs[i:i + step, None] ^ mine[None]) <= flips[i:i + step, None]
            q, v = np.nonzero(near)
            q += i
            bits = hamming(want[q], have[v])
            ok = (bits <= radius[q]) & (bits > past[q])
            q, v = q[ok], v[ok]
            found_by = np.bitwise_count(want[q].view(np.uint16) ^ have[v].view(np.uint16)) <= flips[q][:, None]
            ok = found_by.argmax(1) == sub
            out["query"].append(query[q[ok]])
            out["vec"].append(vec[v[ok]])
    return pa.table({k: pa.array(np.concatenate(x) if x else np.empty(0, np.int64)) for k, x in out.items()})


def _distances(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gap = _matrix(batch.column(3), dim) - _matrix(batch.column(4), dim)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.sqrt((gap * gap).sum(1)))], ["query", "vec", "first", "score"])

    return run


def _next_radius(coder: Coder, enough: int):
    """(id, code, radius, found, d) to the radius that the query still needs (0 if it is done) and the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            radius, found = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            need = np.where(found >= enough, coder.need(np.nan_to_num(batch.column(4).to_numpy(zero_copy_only=False))), radius + SUBSTRINGS)
            left = np.where((radius >= BITS) | (need <= radius), 0, np.minimum(need, BITS))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(left), pa.array(radius)], ["id", "code", "radius", "past"])

    return run


# ---------------------------------------------------------------- jobs

def _usable(vec: Column) -> Column:
    sound = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vec.isNotNull() & sound & F.exists(vec, lambda x: x != 0), F.lit(False))


def _blocks(packed: DataFrame, counts: DataFrame, mine: str, other: str) -> DataFrame:
    """Rows of cells with the block they belong to, once for each block of the other side."""
    joined = packed.join(counts, ["sub", "cell"])
    return (joined.withColumn(mine, F.pmod(F.xxhash64("ids"), F.col(mine)))
                  .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))))


def _within(codes: DataFrame, pending: DataFrame, prefix: int) -> DataFrame:
    """All (query, vec) whose codes lie within the query's radius and beyond ``past``."""
    index = codes.mapInArrow(_deal(prefix, False), PACKED)
    visits = stage(pending.mapInArrow(_deal(prefix, True), PACKED), "llm-visits")
    blocks = lambda df, size, name: df.groupBy("sub", "cell").agg(F.ceil(F.sum("n") / size).alias(name))
    counts = blocks(index, CELL, "rows").join(blocks(visits, VISITS, "asks"), ["sub", "cell"])
    keys = ["sub", "cell", "rows", "asks"]
    have = _blocks(index, counts, "rows", "asks").select(*keys, "ids", "codes")
    want = _blocks(visits, counts, "asks", "rows").select(*keys, "ids", "codes", "radii", "past")
    return have.groupBy(*keys).cogroup(want.groupBy(*keys)).applyInArrow(_probe, "query long, vec long")


def search(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
           sample: int = 8192) -> DataFrame:
    """For each row that ``is_query`` selects (a condition on ``id``) its k nearest other rows by
    Euclidean distance: (query_id, rank, vec_id, score)."""
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec")).where("id IS NOT NULL").where(_usable(F.col("vec")))
    dims = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if dims is None:
        return spark.createDataFrame([], result)
    dim = dims["dim"]
    rows = rows.where(F.size("vec") == dim)

    same, by_id = Window.partitionBy("vec"), Window.partitionBy("vec").orderBy("id")
    ranked = rows.withColumn("place", F.dense_rank().over(by_id)).where(F.col("place") <= k + 1)
    number = F.min(F.monotonically_increasing_id()).over(same)          # fixed by the write
    members = ranked.dropDuplicates(["vec", "id"]).withColumn("row", F.monotonically_increasing_id())
    members = members.select(F.min("row").over(same).alias("no"), "id", F.when(F.col("place") == 1, F.col("vec")).alias("vec"))
    members = stage(members, "llm-vectors")
    distinct = members.where("vec IS NOT NULL").select("no", "vec", F.col("id").alias("first"))
    asked = (rows.where(is_query).groupBy("id").agg(F.min("vec").alias("vec")).withColumn("row", F.monotonically_increasing_id()))
    asked = asked.select(F.min("row").over(same).alias("no"), F.col("id").alias("query_id"),
                         F.when(F.row_number().over(by_id) == 1, F.col("vec")).alias("vec"))
    asked = stage(asked, "llm-queries")
    queries = asked.where("vec IS NOT NULL").select("no", "vec")

    n = distinct.count()
    picked = distinct.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(sample).toArrow()
    coder = Coder(_matrix(picked["vec"], dim))
    prefix = int(np.clip(np.ceil(np.log2(max(1, n) / CELL)), 0, WIDTH))
    codes = stage(distinct.select("no", "vec").mapInArrow(_code_rows(coder, dim), "id long, code binary"), "llm-codes")
    rank = (k + 1) * picked.num_rows / n
    asking = "id long, code binary, radius long, past long"
    pending = stage(queries.mapInArrow(_first_radius(coder, dim, rank), asking), "llm-pending")

    best = found = spark.createDataFrame([], "query long, vec long, first long, score double")
    while pending.count():
        near = stage(_within(codes, pending, prefix), "llm-near")
        both = near.join(distinct.select(F.col("no").alias("vec"), F.col("vec").alias("a"), "first"), "vec")
        both = both.join(queries.select(F.col("no").alias("query"), F.col("vec").alias("b")), "query").select("query", "vec", "first", "a", "b")
        scored = both.mapInArrow(_distances(dim), "query long, vec long, first long, score double")
        earlier = best.join(pending.select(F.col("id").alias("query")), "query", "left_semi")
        scored = scored.unionByName(earlier)
        place = F.row_number().over(Window.partitionBy("query").orderBy("score", "first", "vec"))
        best = stage(scored.withColumn("place", place).where(F.col("place") <= k + 1).drop("place"), "llm-best")
        state = best.groupBy(F.col("query").alias("id")).agg(F.count(F.lit(1)).alias("found"), F.max("score").alias("d"))
        state = pending.join(state, "id", "left").select("id", "code", "radius", F.coalesce("found", F.lit(0)).alias("found"), "d")
        after = stage(state.mapInArrow(_next_radius(coder, k + 1), asking), "llm-pending")
        done = after.where("radius = 0").select(F.col("id").alias("query"))
        found = found.unionByName(best.join(done, "query", "left_semi"))
        pending = after.where("radius > 0")

    ids = members.select(F.col("no").alias("vec"), F.col("id").alias("vec_id"))
    asked = asked.select(F.col("no").alias("query"), "query_id")
    pairs = found.join(ids, "vec").join(asked, "query").where("vec_id <> query_id").select("query_id", "vec_id", "score")
    pairs = pairs.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))      # an id with several vectors
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return pairs.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
