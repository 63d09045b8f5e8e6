"""Operator 2: benchmark decontamination with SimHash windows (DataFrame functions only).

Texts become lower-case words (runs of letters and digits) and five-word shingles.
A window is as many consecutive shingles as an item has; windows are taken at every
place of a document where they hold a shingle of an item of their size (any other
window shares nothing with an item, so its similarity is zero).  Windows and items
get 64-bit SimHash fingerprints, each shingle weighted by how often it occurs.  The
bits are cut into radius + 1 blocks: fingerprints within the radius agree on one
block at least, so an equality join on (window size, block, its bits) finds all of
them.  Candidates within the radius are verified by the exact similarity of their
weighted shingles (sum of least weights over sum of greatest): 0.8 or more.

Documents are worked on by a key of their text, so equal texts meet in one row.

Defined results: a null, empty or wordless text or item has no shingles and matches
nothing; a text or item of fewer than five words has one shingle, all its words;
texts of any length are read whole; repeated rows give the same answer for each;
empty tables give empty tables; only the named columns are read, so further columns
may have any name; ids may be null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import stage

SHINGLE = 5
# A weighted Jaccard similarity of 0.8 is an angle of 27 degrees: 9.7 differing bits
# on average with a deviation of 2.9, so 24 bits keep all but one pair in a million.
RADIUS = 24
# Item shingles up to this number (8 bytes each) are broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 200_000

# Lane width -> a one in each lane of a long.  Lanes of 16 bits hold the counts of most arrays, those of 32 bits any.
LANES = {16: 0x0001000100010001, 32: 0x0000000100000001}


def words(text: Column) -> Column:
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    return F.filter(F.split(plain, " "), lambda w: w != "")


def with_shingles(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df`` with the hashes of its five-word shingles in order, repeats included."""
    k = SHINGLE
    hashed = df.withColumn("__w", F.transform(words(F.col(text_col)), lambda w: F.xxhash64(w)))
    n = F.size("__w")
    full = F.transform(F.slice("__w", 1, F.greatest(n - (k - 1), F.lit(0))),
                       lambda x, i: F.xxhash64(x, *[F.col("__w")[i + j] for j in range(1, k)]))
    short = F.when(n > 0, F.array(F.xxhash64("__w"))).otherwise(F.array().cast("array<bigint>"))
    return hashed.withColumn(out, F.when(n >= k, full).otherwise(short)).drop("__w")


def with_fingerprint(df: DataFrame, shingles: str, out: str) -> DataFrame:
    """``df`` with the SimHash of an array column: bit b is set if more than half of its hashes have it."""
    def counts(width: int, j: int) -> Column:      # of bits j, j + width, ..
        return F.aggregate(shingles, F.lit(0).cast("long"),
                           lambda acc, x: acc + F.shiftrightunsigned(x, j).bitwiseAND(F.lit(LANES[width])))

    def count(width: int, b: int) -> Column:
        lane = F.shiftrightunsigned(F.col(f"__ones{width}")[b % width], width * (b // width))
        return lane.bitwiseAND(F.lit((1 << width) - 1))

    few = F.size(shingles) <= 0x7FFF      # the sign bit is in the last lane
    bits = []
    for b in range(64):
        bit = 1 << b
        bits.append(F.when(2 * F.when(few, count(16, b)).otherwise(count(32, b)) > F.size(shingles), F.lit(bit - (1 << 64) if bit >> 63 else bit))
                    .otherwise(F.lit(0).cast("long")))
    return (df.withColumn("__ones16", F.when(few, F.array(*[counts(16, j) for j in range(16)])))
            .withColumn("__ones32", F.when(~few, F.array(*[counts(32, j) for j in range(32)])))
            .withColumn(out, reduce(Column.bitwiseOR, bits)).drop("__ones16", "__ones32"))


def blocks(fp: str, radius: int) -> Column:
    """(block number, its bits) for each of radius + 1 blocks."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    return F.array(*[F.struct(F.lit(i).alias("no"), F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("bits"))
                     for i, (a, b) in enumerate(zip(edges, edges[1:]))])


def common_weight(a: str, b: str) -> Column:
    """Sum over shingles of the lesser of their weights in two arrays."""
    once = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    weighed = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda acc, x: acc + F.least(
        F.size(F.filter(a, lambda y: y == x)), F.size(F.filter(b, lambda y: y == x))))
    return F.when(once, F.size(F.array_intersect(a, b))).otherwise(weighed)


def text_key(text: Column) -> list[Column]:
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("key"), F.octet_length(text).alias("n_bytes")]


def matches(docs: DataFrame, items: DataFrame, item_id: str = "item_id", item_text: str = "text",
            text_col: str = "text", radius: int = RADIUS, tenths: int = 8) -> DataFrame:
    """(key, n_bytes, item_id, common, total) per text key and item that one of its
    windows matches; common / total is the best similarity.  Staged."""
    item = (with_shingles(items.select(F.col(item_id).alias("item"), F.col(item_text).alias("t")), "t", "item_sh")
            .drop("t").withColumn("size", F.size("item_sh")))
    item = stage(with_fingerprint(item, "item_sh", "item_fp"), "llm-items").where("size > 0")
    seeds = item.select(F.explode("item_sh").alias("sh"), "size").distinct()
    if seeds.count() <= BROADCAST_ROWS:
        seeds = F.broadcast(seeds)

    texts = docs.select(*text_key(F.col(text_col)), F.col(text_col).alias("t"))
    # The outer form: for the plain one Spark infers a filter on the array and moves a copy
    # of its whole expression below, where the words would be made anew for every shingle.
    placed = (with_shingles(texts, "t", "sh").select("key", "n_bytes", F.posexplode_outer("sh").alias("pos", "sh"))
              .where("sh is not null"))
    seen = (placed.join(seeds, "sh").groupBy("key", "n_bytes")
            .agg(F.collect_set(F.struct("size", "pos")).alias("seen")))
    seen = stage(seen, "llm-seeds")

    # Documents with a seed again, now with all their shingles and the windows around the seeds.
    # (The hints keep one plan at every size: texts move once, in a join that skew can split.)
    some = with_shingles(texts.join(seen.hint("merge"), ["key", "n_bytes"]), "t", "sh").select("key", "n_bytes", "sh", "seen")
    around = F.array_distinct(F.flatten(F.transform("seen", lambda s: F.transform(
        F.sequence(F.greatest(s["pos"] - s["size"] + 1, F.lit(0)), s["pos"]),
        lambda a: F.struct(s["size"].alias("size"), a.alias("start"))))))
    windows = (some.select("key", "n_bytes", "sh", F.explode_outer(around).alias("w")).where("w is not null")
               .select("key", "n_bytes", F.col("w.size").alias("size"), F.slice("sh", F.col("w.start") + 1, F.col("w.size")).alias("win")))
    windows = with_fingerprint(windows, "win", "fp")
    index = item.select("item", "item_sh", "item_fp", "size", F.explode(blocks("item_fp", radius)).alias("b"))
    index = index.select("item", "item_sh", "item_fp", "size", "b.no", "b.bits")
    found = (windows.select("*", F.explode(blocks("fp", radius)).alias("b")).select("*", "b.no", "b.bits").drop("b")
             .join(index, ["size", "no", "bits"])
             .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
             # a pair that agrees on several blocks is taken at the first of them
             .where(F.col("no") == first_agreement(F.col("fp").bitwiseXOR(F.col("item_fp")), radius)))
    common = found.withColumn("common", common_weight("win", "item_sh"))
    total = F.size("win") + F.size("item_sh") - F.col("common")
    good = common.withColumn("total", total).where(10 * F.col("common") >= tenths * F.col("total"))
    best = good.groupBy("key", "n_bytes", "item").agg(
        F.max(F.struct((F.col("common") / F.col("total")).alias("s"), "common", "total")).alias("best"))
    return stage(best.select("key", "n_bytes", F.col("item").alias(item_id), "best.common", "best.total"), "llm-matches")


def first_agreement(xor: Column, radius: int) -> Column:
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    return F.coalesce(*[F.when(F.shiftrightunsigned(xor, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) == 0, F.lit(i))
                        for i, (a, b) in enumerate(zip(edges, edges[1:]))])


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """(id_col, item_id, similarity): every document and item it holds."""
    found = matches(docs, items, **options)
    keys = docs.select(F.col(id_col), *text_key(F.col(options.get("text_col", "text"))))
    return keys.join(found, ["key", "n_bytes"]).select(
        id_col, options.get("item_id", "item_id"), F.round(F.col("common") / F.col("total"), 6).alias("similarity"))


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose text holds an item."""
    found = matches(docs, items, text_col=text_col, **options)
    bad = stage(found.select(F.col("key").alias("__key"), F.col("n_bytes").alias("__bytes")).distinct(), "llm-bad")
    key, size = text_key(F.col(f"`{text_col}`"))
    return docs.join(bad.hint("merge"), (key == F.col("__key")) & (size == F.col("__bytes")), "left_anti")
