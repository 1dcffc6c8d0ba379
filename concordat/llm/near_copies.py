"""Near copies by SimHash at a stated similarity of word shingles.

Two documents are near copies if the sets of their five-word shingles have a Jaccard similarity of 0.8 or more. 64 bits are too
few to find such pairs: their fingerprints differ in some 15 % of the bits, those of unrelated documents in half. So this
operator takes fingerprints of WORDS times 64 bits. Distances to reference fingerprints that stand at one bit from a base, as in
`simhash`, say no more than the bits themselves, and scattered references discard nothing at such radii, so bits are
read directly: a cell is a random choice of `width` of them, and two fingerprints meet if they agree in all bits of a
cell. Pairs that meet are discarded by their Hamming distance, and survivors are verified exactly on the shingles of their
whole texts.

The width follows the number of distinct fingerprints, so that unrelated ones rarely meet, and the number of cells follows
the width, so that a pair at the similarity meets with the probability RECALL at every size. Equal fingerprints are one from the
first shuffle on. In a cell everyone is compared with the least member first; once those links are connected, only members
of one cell that still lie in different components are compared with each other, inside the join, so that only links
are rows. A cell full of copies of one text is thus linked by one pair a member, and no pair between different components
is left out.

Rows that another operator holds for copies may be given; they are linked like verified pairs.

What is cut out of an array or put out by Python looks to Spark like the table it is made of, however many rows it makes. Joins of such tables, and of
tables with a row per document, are told to merge, so that none is broadcast for a size it does not have.

Defined cases: null text is empty; texts of fewer words are one shingle; texts without words are copies of each other; of
rows that share the least doc_id of a group one stays, null being the greatest; an empty table gives an empty one; columns
of the input never clash with the operator's.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.llm.common import numbered, steady, words
from concordat.llm.components import components
from concordat.llm.simhash import lowered
from concordat.session import pin, ship_package

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.95  # of pairs at the similarity itself; closer ones meet more often
WORDS = 4
_LEAST_WIDTH = 16
_SLACK = 3.0  # deviations of the distance that survivors may lie above its mean
_AT_ONCE = 1 << 13
_U = np.uint64
_PRINT = [f"f{i}" for i in range(WORDS)]


def disagreement(least: float) -> float:
    """The share of bits in which fingerprints at a Jaccard similarity differ on average: the angle between the sets."""
    return math.acos(2 * least / (1 + least)) / math.pi


def radius(least: float) -> int:
    bits, share = 64 * WORDS, disagreement(least)
    return math.ceil(bits * share + _SLACK * math.sqrt(bits * share * (1 - share)))


def plan_cells(distinct: int, least: float) -> tuple[int, int]:
    """Coordinates in a cell, and how many cells, for a number of distinct fingerprints."""
    width = max(_LEAST_WIDTH, math.ceil(math.log2(max(distinct, 1))))
    meet = (1 - disagreement(least)) ** width
    return width, math.ceil(math.log(1 - RECALL) / math.log1p(-meet))


def _masks(width: int, cells: int) -> np.ndarray:
    pick = random.Random(width)
    out = np.zeros((cells, WORDS), _U)
    for c in range(cells):
        for bit in pick.sample(range(64 * WORDS), width):
            out[c, bit // 64] |= _U(1) << _U(bit % 64)
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def wide_print(hashes: np.ndarray) -> np.ndarray:
    """WORDS words of a SimHash of shingle hashes: bits set in over half of them; zero without any."""
    total = np.zeros(64 * WORDS, np.int64)
    salts = np.arange(1, WORDS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)
    for start in range(0, len(hashes), _AT_ONCE):
        each = _mixed(hashes[start : start + _AT_ONCE, None] ^ salts[None, :])
        bits = np.unpackbits(np.ascontiguousarray(each).view(np.uint8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int32)
    return np.packbits(2 * total > len(hashes), bitorder="little").view("<i8")


def shingle_set(words_: np.ndarray) -> np.ndarray:
    """Distinct hashes of each run of SHINGLE words given by their hashes; of the whole sequence if it is shorter."""
    if not len(words_):
        return words_
    n = min(SHINGLE, len(words_))
    runs = len(words_) - n + 1
    h = np.full(runs, n, _U)
    for k in range(n):
        h = _mixed(h * _U(0x9E3779B97F4A7C15) ^ words_[k : k + runs])
    return np.unique(h)


def _each(batch: pa.RecordBatch) -> list[np.ndarray]:
    lists = batch.column("_h")
    ends, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).view(_U)
    return [shingle_set(values[a:b]) for a, b in zip(ends, ends[1:])]


def _printer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [wide_print(s) for s in _each(batch)]
        table = np.stack(prints) if prints else np.zeros((0, WORDS), np.int64)
        yield pa.record_batch(
            [batch.column("_row"), batch.column("doc_id"), *[pa.array(np.ascontiguousarray(table[:, i])) for i in range(WORDS)]],
            ["_row", "doc_id", *_PRINT])


def _set_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = _each(batch)
        ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
        yield pa.record_batch([batch.column("_row"), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], ["_row", "s"])


def _cells(width: int, cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = _masks(width, cells)
        salts = _mixed(np.arange(1, cells + 1, dtype=_U))
        step = max(1, (1 << 18) // cells)
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                rows = batch.slice(start, step)
                keys = np.repeat(salts[None, :], rows.num_rows, axis=0)
                for i in range(WORDS):
                    word = rows.column(f"f{i}").to_numpy().view(_U)
                    keys = _mixed(keys ^ (word[:, None] & masks[None, :, i]))
                nodes = np.repeat(rows.column("node").to_numpy(), cells)
                yield pa.record_batch([pa.array(keys.reshape(-1).view(np.int64)), pa.array(nodes)], ["cell", "node"])

    return run


def _word_hashes(rows: DataFrame) -> DataFrame:
    """_row, doc_id and the hashes of all words, in order, of numbered rows."""
    each = F.transform(words(lowered(F.col("_doc.text").cast("string"))), lambda w: F.xxhash64(w))
    return rows.select("_row", F.col("_doc.doc_id").cast("long").alias("doc_id"), each.alias("_h"))


def wide_prints(docs: DataFrame) -> DataFrame:
    """_row, doc_id and f0 to f3 of every row."""
    ship_package(docs.sparkSession)
    return _word_hashes(numbered(docs)).mapInArrow(_printer, "_row long, doc_id long, " + ", ".join(f"{c} long" for c in _PRINT))


def _apart(a: str, b: str) -> Column:
    """Bits in which the fingerprints differ whose columns have these prefixes."""
    return sum((F.bit_count(F.col(f"{a}{c}").bitwiseXOR(F.col(f"{b}{c}"))) for c in _PRINT[1:]),
               F.bit_count(F.col(f"{a}f0").bitwiseXOR(F.col(f"{b}f0"))))


def _similar(x: str, y: str, least: float) -> Column:
    """Whether two sets of shingles have the similarity; sizes are looked at first."""
    m, n = F.size(x), F.size(y)
    both = F.size(F.array_intersect(x, y))
    return (F.least(m, n) >= F.greatest(m, n) * F.lit(least) - F.lit(1e-9)) & (both >= (m + n - both) * F.lit(least) - F.lit(1e-9))


def _near(pairs: DataFrame, distinct: DataFrame, least: float) -> DataFrame:
    """Pairs a, b whose fingerprints are within the radius."""
    a = distinct.select(F.col("node").alias("a"), *[F.col(c).alias(f"a_{c}") for c in _PRINT])
    b = distinct.select(F.col("node").alias("b"), *[F.col(c).alias(f"b_{c}") for c in _PRINT])
    return pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b").where(_apart("a_", "b_") <= radius(least)).select("a", "b")


def _sets(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """_row and s, the set of shingles, of the rows of docs that are listed in _row."""
    # The join comes first, so that only texts that met someone are cut again.
    texts = numbered(docs).join(pin(rows.distinct()), "_row", "left_semi")
    return pin(_word_hashes(texts).mapInArrow(_set_lists, "_row long, s array<long>"))


def verified(pairs: DataFrame, docs: DataFrame, least: float) -> DataFrame:
    """Pairs a, b of row numbers whose sets of shingles have the similarity."""
    pairs = pin(pairs)
    sets = _sets(pairs.select(F.explode(F.array("a", "b")).alias("_row")), docs)
    met = pairs.join(sets.select(F.col("_row").alias("a"), F.col("s").alias("x")).hint("merge"), "a").join(
        sets.select(F.col("_row").alias("b"), F.col("s").alias("y")).hint("merge"), "b")
    return met.where(_similar("x", "y", least)).select("a", "b")


def across(open_: DataFrame, docs: DataFrame, least: float) -> DataFrame:
    """Links a, b between members of one cell in different components; open_ has cell, node, component and f0 to f3.

    A family whose members are somewhat less alike than the similarity has nearly no links and a pair for every two members. So
    pairs are no rows here: members that are within the radius of another are found by a semi-join, their sets of
    shingles go to each of their cells, and the join compares sets itself and puts out links only. A pair is
    compared in the least of the cells that it shares.
    """
    def meet(*more: Column) -> Column:
        on = (F.col("a.cell") == F.col("b.cell")) & (F.col("a.component") != F.col("b.component")) & (_apart("a.", "b.") <= radius(least))
        for m in more:
            on = on & m
        return on

    close = pin(open_.alias("a").join(open_.alias("b").hint("merge"), meet(), "left_semi"))
    nodes = close.groupBy("node").agg(F.collect_set("cell").alias("cells"))
    sets = _sets(close.select(F.col("node").alias("_row")), docs).join(nodes.withColumnRenamed("node", "_row").hint("merge"), "_row")
    whole = pin(close.join(sets.withColumnRenamed("_row", "node").hint("merge"), "node"))
    first = F.array_min(F.array_intersect("a.cells", "b.cells")) == F.col("a.cell")
    return whole.alias("a").join(
        whole.alias("b").hint("merge"), meet(F.col("a.component") < F.col("b.component"), first, _similar("a.s", "b.s", least))
    ).select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))


def _told(also: DataFrame, prints: DataFrame, distinct: DataFrame) -> DataFrame:
    """Links a, b between the nodes of rows that have one group in also(_row, group)."""
    nodes = prints.select("_row", *_PRINT).join(distinct.hint("merge"), _PRINT).select("_row", "node")
    named = pin(also.select("_row", "group").join(nodes.hint("merge"), "_row").select("group", "node").distinct())
    leads = named.groupBy("group").agg(F.min("node").alias("a"), F.max("node").alias("last")).where("a < last")
    return named.join(leads.hint("merge"), "group").where("node <> a").select("a", F.col("node").alias("b"))


def near_copies(docs: DataFrame, least: float = SIMILARITY, also: DataFrame | None = None) -> DataFrame:
    """_row, doc_id and group (a row number) of every row; rows of one group are connected by near copies.

    also: _row (common.numbered) and group of rows that another operator found; those of one group are connected too.
    """
    docs = steady(docs)
    prints = pin(wide_prints(docs))
    distinct = pin(prints.groupBy(*_PRINT).agg(F.min("_row").alias("node")))
    width, cells = plan_cells(distinct.count(), least)
    keyed = distinct.select("node", *_PRINT).mapInArrow(_cells(width, cells), "cell long, node long")
    shared = pin(
        keyed.groupBy("cell").agg(F.min("node").alias("lead"), F.max("node").alias("last"), F.count("*").alias("members"))
        .where("lead < last").select("cell", "lead", "members"))
    inside = pin(keyed.join(shared.hint("merge"), "cell").select("cell", "node", "lead", "members"))
    stars = inside.where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    links = pin(verified(_near(stars, distinct, least), docs, least))
    if also is not None:
        links = links.unionByName(pin(_told(also, prints, distinct)))
    named = pin(components(links, "a", "b"))

    # What is left: members of one cell in different components, neither of them its least one.
    placed = inside.where("members > 2 and node <> lead").join(named.hint("merge"), "node", "left").select(
        "cell", "node", F.coalesce("component", "node").alias("component"))
    mixed = placed.groupBy("cell").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    open_ = pin(placed.join(mixed.select("cell").hint("merge"), "cell", "left_semi").join(distinct.hint("merge"), "node"))
    more = pin(across(open_, docs, least))
    if not more.isEmpty():
        named = pin(components(links.unionByName(more), "a", "b"))

    groups = distinct.join(named.hint("merge"), "node", "left").select(*_PRINT, F.coalesce("component", "node").alias("group"))
    return prints.join(groups.hint("merge"), _PRINT).select("_row", "doc_id", "group")


def keep_one(docs: DataFrame, least: float = SIMILARITY, also: DataFrame | None = None) -> DataFrame:
    """The document with the least doc_id (null is the greatest) of each group of near copies; same columns."""
    docs = steady(docs)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")
    found = pin(near_copies(docs, least, also))
    first = found.groupBy("group").agg(F.min(place).alias("first"), F.count("*").alias("rows")).where("rows > 1")
    # Rows that go are fewer than those that stay; written, so that Spark knows how many.
    gone = pin(found.join(first.hint("merge"), "group").where("_row <> first._row").select("_row"))
    return numbered(docs).join(gone, "_row", "left_anti").select("_doc.*")
