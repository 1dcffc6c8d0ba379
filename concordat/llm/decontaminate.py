r"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

Words are runs of letters and digits, lower-cased; shingles are five words. Every benchmark item has a fingerprint
of its shingles, and so has each window of a document with as many shingles as an item; a document with fewer is one window for
that item. A window and an item of its length are compared if their fingerprints differ by RADIUS bits at most: 64 bits are cut into RADIUS + 1 blocks, of
which at least one is then untouched, so pairs meet under (length, block, value). What meets is verified by the exact
weighted similarity of the two bags of shingles, sum of lesser counts over sum of greater ones.

A similarity of 0.8 demands that eight ninths of a window's shingles occur in the item, so only windows of
which SHARE do are fingerprinted: documents' shingles meet the benchmark's in a join first. No pair that counts is lost by
it, and texts without a benchmark shingle, nearly all, leave after one scan. At 0.8 fingerprints differ by about 10 bits, by
more than 20 once in some thousand pairs.

The benchmark is the bounded side. Its distinct shingles are counted, and broadcast up to MAX_BROADCAST rows; beyond
that the join shuffles. So are the documents that hold such shingles, when their texts are read again. Nothing grows with the pairs within a group of documents: each document meets the items only.

Defined cases: null text is empty; items of fewer than five words have no shingle and are never found; rows with the same
item_id are variants of one item; repeated documents are found each; an empty table on either side gives no rows;
other columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.llm.common import MAX_BROADCAST, counted, numbered, steady
from concordat.llm.simhash import lane_sums, majority
from concordat.session import pin

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 20
SHARE = 0.75


def plain_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(text: Column) -> Column:
    """Hash of the five words from each word on; an empty array for shorter texts.

    The words are bound inside the expression, so that no rule of the optimizer can copy them to where each is used.
    """
    hashed = F.transform(plain_words(text), lambda w: F.xxhash64(w))

    def rolled(w):
        each = F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))
        return F.when(F.size(w) >= SHINGLE, each).otherwise(F.array().cast("array<bigint>"))

    return F.transform(F.array(hashed), rolled)[0]


def _blocks(radius: int) -> list[tuple[int, int]]:
    """(first bit, mask) of radius + 1 blocks that cover 64 bits."""
    n = radius + 1
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, (1 << (b - a)) - 1) for a, b in zip(edges, edges[1:], strict=False)]


def _block(fp: Column, first: int, mask: int) -> Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit(mask).cast("long"))


def similarity(a: Column, b: Column) -> Column:
    """Weighted similarity of two bags given as arrays."""
    def times(bag, x):
        return F.size(F.filter(bag, lambda y: y == x))

    # Without repeats the lesser counts are those of the common elements.
    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    bags = F.aggregate(F.transform(F.array_intersect(a, b), lambda x: F.least(times(a, x), times(b, x))), F.lit(0), lambda s, x: s + x)
    less = F.when(plain, F.size(F.array_intersect(a, b))).otherwise(bags)
    return F.transform(F.array(less), lambda n: n / (F.size(a) + F.size(b) - n))[0]


def items(benchmark: DataFrame) -> DataFrame:
    """_iid, item_id, its shingles, their number m and their fingerprint."""
    rows = pin(benchmark.select(F.monotonically_increasing_id().alias("_iid"), "item_id", shingles(F.col("text")).alias("_shingles")))
    rows = rows.where(F.size("_shingles") > 0)
    prints = rows.select("_iid", F.explode("_shingles").alias("_h")).groupBy("_iid").agg(F.count("*").alias("_n"), *lane_sums("_h"))
    return pin(rows.join(prints.select("_iid", majority("_n").alias("fp")), "_iid").withColumn("m", F.size("_shingles")))


def _starts(at: Column, m: Column, need: Column) -> Column:
    """Starts of windows of m shingles that hold at least need of the sorted places."""
    runs = F.transform(
        F.filter(
            F.transform(at, lambda p, j: F.struct(p.alias("last"), (F.get(at, j + need - 1) - m + 1).alias("first"))),
            lambda r: r["first"] <= r["last"],
        ),
        lambda r: F.sequence(F.greatest(r["first"], F.lit(0)), r["last"]),
    )
    return F.array_distinct(F.flatten(runs))


def found_in(
    docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, radius: int = RADIUS, share: float = SHARE,
) -> DataFrame:
    """_row, doc_id, item_id, similarity, window_start (in words) for each document and item found in it, at its best.

    _row is the row's number in docs (common.numbered).
    """
    docs = steady(docs)
    bench = items(benchmark)
    posts = pin(bench.select("_iid", "m", F.explode(F.array_distinct("_shingles")).alias("_h")))
    keys = posts.select("_h").distinct()
    if posts.count() <= MAX_BROADCAST:
        keys, posts, bench = F.broadcast(keys), F.broadcast(posts), F.broadcast(bench)
    read = numbered(docs).select("_row", F.col("_doc.doc_id").alias("doc_id"), F.col("_doc.text").alias("text"))
    # An outer explode, or the optimizer computes every array once more to drop empty ones.
    seeds = pin(read.select("_row", F.posexplode_outer(shingles(F.col("text"))).alias("_at", "_h")).join(keys, "_h", "left_semi"))
    need = F.ceil(F.col("m") * F.lit(share)).cast("int")
    places = (
        seeds.join(posts, "_h").groupBy("_row", "_iid", "m").agg(F.array_sort(F.collect_list("_at")).alias("_at"))
        .where(F.size("_at") >= need)
        .select("_row", "m", need.alias("_need"), "_at")
        .select("_row", "m", F.explode(_starts(F.col("_at"), F.col("m"), F.col("_need"))).alias("_start"))
        .groupBy("_row").agg(F.collect_set(F.struct("m", "_start")).alias("_windows"))
    )
    # Only row numbers are broadcast, never arrays, whose sizes nobody counted.
    places = pin(places)
    windows = (
        read.join(counted(places.select("_row")), "_row", "left_semi").join(places.hint("merge"), "_row").withColumn("_s", shingles(F.col("text")))
        .select("_row", "doc_id", "_s", F.explode("_windows").alias("_x"))
        # A document shorter than the item is its one window, named by start 0, which its runs always have.
        .where((F.col("_x._start") + F.col("_x.m") <= F.size("_s")) | ((F.col("_x._start") == 0) & (F.size("_s") < F.col("_x.m"))))
        .select("_row", "doc_id", F.col("_x.m").alias("m"), F.col("_x._start").alias("window_start"),
                F.array_sort(F.slice("_s", F.col("_x._start") + 1, F.col("_x.m"))).alias("_bag"))
    )
    prints = pin(
        windows.select("*", F.explode("_bag").alias("_h"))
        .groupBy("_row", "doc_id", "m", "window_start", "_bag").agg(*lane_sums("_h"))
        .select("_row", "doc_id", "m", "window_start", "_bag", majority(F.size("_bag")).alias("fp"))
    )

    def indexed(df, fp):
        cut = [F.struct(F.lit(i).alias("b"), _block(F.col(fp), *x).alias("v")) for i, x in enumerate(_blocks(radius))]
        return df.select("*", F.explode(F.array(*cut)).alias("_k")).select("*", "_k.b", "_k.v").drop("_k")

    left = indexed(prints, "fp")
    # Written first: blocks would otherwise repeat the long expression of the fingerprint.
    right = indexed(bench.select("_iid", "m", F.col("fp").alias("_ifp")), "_ifp")
    right = F.broadcast(right) if bench.count() * len(_blocks(radius)) <= MAX_BROADCAST else right.hint("merge")
    whole = bench.select("_iid", "item_id", F.array_sort("_shingles").alias("_item"))
    apart = F.col("fp").bitwiseXOR(F.col("_ifp"))
    untouched = F.coalesce(*[F.when(_block(apart, *x) == 0, i) for i, x in enumerate(_blocks(radius))])
    met = left.join(right, ["m", "b", "v"]).where((F.bit_count(apart) <= radius) & (F.col("b") == untouched)).join(whole, "_iid")
    return (
        met.withColumn("similarity", F.explode_outer(F.array(similarity(F.col("_bag"), F.col("_item")))))  # evaluated once
        .where(F.col("similarity") >= least)
        .groupBy("_row", "doc_id", "item_id")
        .agg(F.min(F.struct((-F.col("similarity")).alias("s"), F.col("window_start").alias("w"))).alias("_best"))
        .select("_row", "doc_id", "item_id", (-F.col("_best.s")).alias("similarity"), F.col("_best.w").cast("long").alias("window_start"))
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark item is found; same columns."""
    docs = steady(docs)
    hit = pin(found_in(docs, benchmark).select("_row").distinct())
    return numbered(docs).join(counted(hit), "_row", "left_anti").select("_doc.*")
