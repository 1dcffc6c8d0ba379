"""Mixing sources to target weights with a low-discrepancy slot schedule.

Every source's documents are put in a shuffled, repeatable order and cut into blocks of equally many words. The
mix is a row of slots. Slot t looks at the golden-ratio point x = t * G mod 2^m, and cumulative weights map x to
a source; the k-th slot of a source takes the k-th block of its stream, which starts again when it is used up.
As t -> x is a bijection, the slots of a source are listed from its interval of points: no slot is ever
compared with every source, and a source's interval is cut so that many tasks list it.

Targets are filled exactly: slots that a source has beyond its target stay empty, those it lacks follow at the end,
and its last slot is cut to size.

Defined cases: null text is empty; a null source is a source of its own, the last one; a null doc_id is kept; rows
with equal doc_id and size follow each other as they are read; empty documents and an
empty table take nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordat.llm.common import n_words, numbered, running, steady
from concordat.session import pin

BLOCK = 1024
WEIGHTS = (3, 1, 2)
_ORDER_BITS = 60
_PIECES = 12  # bits of the shuffle order that cut a source into pieces
_LIST = 1 << 14  # points that one task lists at a time
_RUN = 16  # bits of a run of slots that is numbered by one task


def sized(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """doc_id, source, size and place in the shuffled order, without texts."""
    size = n_words(F.col("text"))
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), size.cast("string")))
    rows = numbered(docs).select(F.col("_row").alias("_number"), *[F.col(f"_doc.{c}").alias(c) for c in ("doc_id", "source", "text")])
    return rows.select(
        "_number", "doc_id", "source", size.alias("size"),
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")).alias("_src"),
        F.conv(F.substring(digest, 1, _ORDER_BITS // 4), 16, 10).cast("long").alias("_h"),
    )


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per source: its size and the words it is to give.

    The shared words are poured by weight; a source that reaches cap times its size stops, and what it leaves is
    poured over the rest. That level is found in one pass over the sources in the order in which they stop.
    """
    rows = sizes.groupBy("_src").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.when(F.col("_src") == "n", 1).otherwise(0), "_src")
    everything = Window.partitionBy(F.lit(1))
    before = Window.orderBy("_stop", "_src").rowsBetween(Window.unboundedPreceding, -1)
    which = (F.row_number().over(place) - 1) % len(weights)
    rows = (
        rows.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (which + 1).cast("int")))
        .withColumn("_cap", F.col("source_size") * F.lit(float(cap)))
        .withColumn("_stop", F.col("_cap") / F.col("_w"))
        .withColumn("_rest", F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_open", F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
        .withColumn("_level", F.col("_rest") / F.col("_open"))
        .withColumn("_level", F.max(F.when(F.col("_level") <= F.col("_stop"), F.col("_level"))).over(everything))
        .withColumn("target", F.least("_cap", F.coalesce(F.col("_level") * F.col("_w"), F.col("_cap"))))
    )
    return rows.select("_src", "source_size", "target", F.least(F.round("target"), F.floor("_cap")).cast("long").alias("_want"))


def schedule(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """slot, source key, block number, round, and the words of the block that the slot takes."""
    size, want = F.col("source_size"), F.col("_want")
    whole = F.when(size > 0, F.floor(want / size)).otherwise(0).cast("long")
    plan = (
        sources.withColumn("_blocks", F.ceil(size / block).cast("long"))
        .withColumn("_left", want - whole * size)
        .withColumn("_need", whole * F.col("_blocks") + F.ceil(F.col("_left") / block).cast("long"))
        .where(F.col("_need") > 0)
        .withColumn("_to", F.sum("_need").over(Window.orderBy("_src")))
    )
    plan = pin(plan)
    total = plan.agg(F.max("_to")).first()[0] or 1
    bits = max(1, (total - 1).bit_length())
    step = int((1 << bits) * 0.6180339887498949) | 1
    back = pow(step, -1, 1 << bits)
    points = 1 << bits
    whole_number = "long" if bits <= 31 else "decimal(38,0)"  # a product of two numbers below 2^bits

    def point(c):
        return F.ceil(F.col(c).cast("decimal(38,0)") * points / total).cast("long")

    lists = (
        plan.withColumn("_from", F.col("_to") - F.col("_need"))
        .select("_src", "source_size", "_want", "_blocks", "_left", "_need", point("_from").alias("_a"), point("_to").alias("_b"))
        .select("*", F.explode(F.expr(f"sequence(_a div {_LIST}, greatest(_b - 1, _a) div {_LIST})")).alias("_part"))
        .repartition("_src", "_part")
        .select("*", F.explode(F.expr(f"sequence(_part * {_LIST}, _part * {_LIST} + {_LIST - 1})")).alias("_x"))
        .where((F.col("_x") >= F.col("_a")) & (F.col("_x") < F.col("_b")))
        .withColumn("slot", ((F.col("_x").cast(whole_number) * F.lit(back).cast(whole_number)) % F.lit(points).cast(whole_number)).cast("long"))
        .where(F.col("slot") < total)
        .withColumn("_run", F.shiftright("slot", _RUN))
    )
    found = pin(running(lists, "_src", "_run", ["slot"], None, "_k", "_r").where(F.col("_k") < F.col("_need")).select("_src", "slot", "_k"))
    have = found.groupBy("_src").agg(F.count("*").alias("_have"))
    lacking = (
        plan.join(have, "_src", "left").withColumn("_have", F.coalesce("_have", F.lit(0)))
        .where(F.col("_have") < F.col("_need"))
        .select("_src", F.explode(F.expr("sequence(_have, _need - 1)")).alias("_k"))
        .select("_src", (F.lit(total) + F.col("_k")).alias("slot"), "_k")
    )
    lo = F.col("block") * block
    end = F.least(lo + block, F.col("source_size"))
    last = (F.col("_k") == F.col("_need") - 1) & (F.col("_left") > 0)
    return (
        found.unionByName(lacking).join(plan.select("_src", "source_size", "_blocks", "_left", "_need"), "_src")
        .withColumn("block", F.col("_k") % F.col("_blocks"))
        .withColumn("round", F.floor(F.col("_k") / F.col("_blocks")).cast("long"))
        .select("slot", "_src", "block", "round", lo.alias("_lo"), F.when(last, F.least(end, F.col("_left"))).otherwise(end).alias("_hi"))
    )


def mixture(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0,
    block: int = BLOCK, seed: str = "mix",
) -> DataFrame:
    """One row per document: _number, doc_id, source, size, source_size, target, taken, and rounds.

    _number is its number in docs (common.numbered); rounds says how often the mix has the document's first word; taken counts its words in the mix.
    """
    rows = pin(sized(docs, seed).withColumn("_piece_no", F.shiftright("_h", _ORDER_BITS - _PIECES)))
    sources = pin(targets(rows, weights, share, cap))
    slots = schedule(sources, block)
    placed = running(rows, "_src", "_piece_no", ["_h", "doc_id", "size", "_number"], "size", "_start", "_row")
    placed = pin(placed.select("_number", "doc_id", "source", "size", "_src", "_piece_no", "_row", "_start"))
    parts = (
        placed.where("size > 0")
        .select("_src", "_piece_no", "_row", "_start", (F.col("_start") + F.col("size")).alias("_end"),
                F.explode(F.expr(f"sequence(_start div {block}, (_start + size - 1) div {block})")).alias("block"))
        .join(slots.hint("merge"), ["_src", "block"])  # both grow with the words; Spark sizes neither
        .withColumn("_words", F.least("_end", "_hi") - F.greatest("_start", "_lo"))
        .where("_words > 0")
        .groupBy("_src", "_piece_no", "_row")
        .agg(F.sum("_words").alias("taken"), F.sum(F.when(F.col("_start") >= F.col("_lo"), 1).otherwise(0)).alias("rounds"))
    )
    zero = F.lit(0).cast("long")
    return (
        placed.join(parts.hint("merge"), ["_src", "_piece_no", "_row"], "left")
        .join(sources.select("_src", "source_size", "target"), "_src")
        .select("_number", "doc_id", "source", "size", "source_size", "target",
                F.coalesce("taken", zero).alias("taken"), F.coalesce("rounds", zero).alias("rounds"))
    )


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0, block: int = BLOCK) -> DataFrame:
    """The documents, each as often as its first word is in the mix; same columns."""
    docs = steady(docs)
    often = pin(mixture(docs, weights, share, cap, block).where("rounds > 0").select(F.col("_number").alias("_row"), "rounds"))
    rows = numbered(docs).join(often.hint("merge"), "_row")  # most documents, so never broadcast
    return rows.select("_doc", F.explode(F.expr("sequence(1, rounds)"))).select("_doc.*")
