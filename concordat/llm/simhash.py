"""Near-duplicate documents by SimHash, with pivot distance tables to find close fingerprints.

Fingerprints are counted bit by bit in the JVM: hashes of a document's shingles are exploded and summed into 32
counters that hold two bits each, which combines before the shuffle. Equal fingerprints are one from then on.

The pivot table of a fingerprint holds its Hamming distances to many reference fingerprints. References come in
two kinds. Those that differ from a base reference in one bit each say, by their distance less that of the base, how a
fingerprint stands to the base in that bit, and make up join keys: within radius 2 at least two of four quarters are
untouched, so a pair meets under one of six keys of two quarters. The scattered references serve to discard: by the
triangle inequality no coordinate of a close pair differs by more than the radius. Survivors are verified
by their Hamming distance. All of it happens inside the join, so only true links come out of it.

A key that more than CROWD distinct fingerprints share is not joined with itself. Its fingerprints are linked by a
second exact way instead: each announces itself and its 64 neighbours at one bit, and two fingerprints announce a
common one exactly if they differ by two bits at most. That takes 65 rows each, however crowded the key.

Defined cases: null text is empty; documents without words have fingerprint zero, which is linked like any
other; equal rows share a component; the component is the least doc_id, null only if all its doc_ids are; an
empty table gives an empty one; other columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.llm.common import numbered, steady, words
from concordat.llm.components import components
from concordat.session import pin

RADIUS = 2  # the keys of two quarters and the announced neighbours are made for this radius
CROWD = 2_000
_BASE = 0x5851F42D4C957F2D
_SCATTERED = 16
_QUARTERS = ((0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3))


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def references() -> tuple[list[int], list[int]]:
    """The 64 references at one bit from the base, and the scattered ones, as signed 64-bit numbers."""
    near = [_signed(_BASE ^ (1 << b)) for b in range(64)]
    far, x = [], _BASE
    for _ in range(_SCATTERED):
        x = (x * 6364136223846793005 + 1442695040888963407) & ((1 << 64) - 1)
        far.append(_signed(x ^ (x >> 29)))
    return near, far


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: Column, n: int) -> Column:
    """XXH64 (seed 42) of each run of n words, repeats included; of the whole sequence if it is shorter."""
    w = words(lowered(text))
    return F.transform(
        F.array(w),
        lambda a: F.when(F.size(a) == 0, F.array().cast("array<bigint>"))
        .when(F.size(a) < n, F.array(F.xxhash64(F.array_join(a, " "))))
        .otherwise(F.transform(
            F.sequence(F.lit(0), F.size(a) - n), lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(a, i + k) for k in range(n)]))
        )),
    )[0]


def lane_sums(h: Column | str) -> list[Column]:
    """Aggregates _c0 to _c31: how many hashes have bit k set, and in the upper half bit k + 32."""
    two = F.lit((1 << 32) | 1)
    return [F.sum(F.shiftrightunsigned(h, k).bitwiseAND(two)).alias(f"_c{k}") for k in range(32)]


def majority(n: Column | str) -> Column:
    """The fingerprint of n hashes from their lane sums: bits set in over half of them."""
    fp, n = F.lit(0).cast("long"), F.col(n) if isinstance(n, str) else n
    for k in range(32):
        low, high = F.col(f"_c{k}").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(f"_c{k}", 32)
        fp = fp.bitwiseOR(F.when(low * 2 > n, F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
        fp = fp.bitwiseOR(F.when(high * 2 > n, F.lit(_signed(1 << (k + 32)))).otherwise(F.lit(0)).cast("long"))
    return fp


def fingerprints(docs: DataFrame, n: int = 3) -> DataFrame:
    """doc_id, _row and fp (the 64 bits as a signed number) of every row."""
    return _prints(numbered(docs), n)


def _prints(rows: DataFrame, n: int) -> DataFrame:
    rows = rows.select("_row", F.col("_doc.doc_id").alias("doc_id"), shingle_hashes(F.col("_doc.text"), n).alias("_s"))
    each = rows.select("_row", "doc_id", F.explode_outer("_s").alias("_h"))
    sums = each.groupBy("_row", "doc_id").agg(F.count("_h").alias("_n"), *lane_sums("_h"))
    return sums.select("_row", "doc_id", majority("_n").alias("fp"))


def pivot_table(fps: DataFrame) -> DataFrame:
    """fp, its distances to the base and to the scattered references (d), and its standing per quarter (q)."""
    near, far = references()
    fp, base = F.col("fp"), F.lit(_signed(_BASE))
    quarters = []
    for g in range(4):
        q = F.lit(0)
        for j in range(16):
            # Its distance to this reference is one less than to the base exactly if the bit differs from the base's.
            q = q + (_distance(fp, base) - _distance(fp, F.lit(near[16 * g + j])) + 1) / 2 * (1 << j)
        quarters.append(q.cast("int"))
    return fps.select(
        "fp", F.array(_distance(fp, base), *[_distance(fp, F.lit(r)) for r in far]).alias("d"), F.array(*quarters).alias("q"),
    )


def links(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Pairs a < b of distinct fingerprints that join everything within the radius.

    Under uncrowded keys these are all close pairs; under crowded ones, enough of them to connect the same groups.
    """
    table = pin(pivot_table(fps))
    keys = [
        F.struct(F.lit(i).alias("p"), F.get("q", F.lit(a)).alias("x"), F.get("q", F.lit(b)).alias("y"))
        for i, (a, b) in enumerate(_QUARTERS)
    ]
    keyed = table.select("fp", "d", F.explode(F.array(*keys)).alias("k")).select("fp", "d", "k.*")
    crowded = pin(keyed.groupBy("p", "x", "y").count().where(F.col("count") > crowd).select("p", "x", "y"))
    rest = keyed.join(crowded, ["p", "x", "y"], "left_anti")
    a, b = rest.alias("a"), rest.alias("b")
    close = (
        (F.col("a.p") == F.col("b.p")) & (F.col("a.x") == F.col("b.x")) & (F.col("a.y") == F.col("b.y"))
        & (F.col("a.fp") < F.col("b.fp"))
    )
    for i in range(_SCATTERED + 1):
        close = close & (F.abs(F.get("a.d", F.lit(i)) - F.get("b.d", F.lit(i))) <= RADIUS)
    close = close & (_distance(F.col("a.fp"), F.col("b.fp")) <= RADIUS)
    # Six rows each, which Spark does not know when it sizes a side of the join.
    found = a.join(b.hint("merge"), close).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    if crowded.isEmpty():
        return found.distinct()
    dense = keyed.join(crowded, ["p", "x", "y"], "left_semi").select("fp").distinct()
    flips = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)]
    met = dense.select("fp", F.explode(F.array(*flips)).alias("m"))
    least = met.groupBy("m").agg(F.min("fp").alias("a"))
    more = met.join(least.hint("merge"), "m").where("fp <> a").select("a", F.col("fp").alias("b"))
    return found.unionByName(more).distinct()


def near_duplicates(docs: DataFrame, n: int = 3, crowd: int = CROWD) -> DataFrame:
    """One row per document: _row, doc_id, fp, component_id and group; rows of one group are duplicates.

    group is a fingerprint of the component. It tells components apart whose component_id is the same or null.
    """
    prints = pin(fingerprints(docs, n))
    distinct = pin(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    groups = pin(components(links(distinct.select("fp"), crowd), "a", "b"))
    lead = (
        distinct.join(groups.withColumnRenamed("node", "fp"), "fp")
        .groupBy("component").agg(F.min("first_id").alias("least_id"))
    )
    named = groups.join(lead, "component").select(F.col("node").alias("fp"), "least_id", F.col("component").alias("group"))
    known = distinct.join(named, "fp", "left").select(
        "fp", F.coalesce("least_id", "first_id").alias("component_id"), F.coalesce("group", "fp").alias("group"))
    return prints.join(known, "fp").select("_row", "doc_id", "fp", "component_id", "group")


def keep_one(docs: DataFrame, n: int = 3) -> DataFrame:
    """One document of each component, that with the least doc_id (null is the greatest); same columns. Of rows that share it, one stays."""
    docs = steady(docs)
    found = near_duplicates(docs, n)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")
    first = found.groupBy("group").agg(F.min(place).alias("first"))
    kept = first.select("first._row").hint("merge")  # most documents, so never broadcast
    return numbered(docs).join(kept, "_row", "left_semi").select("_doc.*")
