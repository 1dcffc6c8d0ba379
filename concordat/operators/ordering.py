"""First-wins, top-n and previous-row operators that hold up under hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat.session import pin

_TWO_63, _TWO_64 = str(1 << 63), str(1 << 64)  # as texts: the JVM's whole numbers end below


def packed(major: Column, minor: Column) -> Column:
    """One number that orders like (major, minor): whole numbers, major from 0 to 2^31.

    Hash aggregation needs buffers of fixed width; structs and texts would make it sort every group.
    """
    low = minor.cast("decimal(20,0)") + F.lit(_TWO_63).cast("decimal(20,0)")
    return (major.cast("decimal(10,0)") * F.lit(_TWO_64).cast("decimal(20,0)") + low).cast("decimal(31,0)")


def unpacked(number: Column) -> tuple[Column, Column]:
    """The two numbers again."""
    unit = F.lit(_TWO_64).cast("decimal(31,0)")
    minor = (number % unit - F.lit(_TWO_63).cast("decimal(20,0)")).cast("bigint")
    return F.floor((number - number % unit) / unit).cast("bigint"), minor


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the earliest by `order`, which must be total: rows of a key that tie in it must be equal, and are one.

    By one whole number the winners' places are found by hashing, combined before the shuffle, and their rows fetched by them; the
    rest of a row is in no buffer. Other orders fall back on an aggregate that sorts.
    """
    integral = ("tinyint", "smallint", "int", "bigint")
    rest = [c for c in df.columns if c not in keys]
    if len(order) > 1 or dict(df.dtypes)[order[0]] not in integral:
        best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
        return df.groupBy(*keys).agg(best).select(*keys, "_row.*")
    first = df.groupBy(*keys).agg(F.min(order[0]).alias("_first"))
    same = F.col(f"x.{order[0]}").eqNullSafe(F.col("f._first"))
    for k in keys:
        same = same & F.col(f"x.{k}").eqNullSafe(F.col(f"f.{k}"))
    return df.alias("x").join(first.alias("f"), same, "left_semi").distinct().select(*keys, *rest)


def longest(df: DataFrame, keys: Sequence[str], text: str, order: str) -> DataFrame:
    """Key plus the `order` value of its longest text, ties to the earliest.

    Only lengths enter the shuffle; join the text back on (keys, order).
    """
    found = df.groupBy(*keys).agg(F.max(packed(F.length(text), -F.col(order))).alias("_best"))
    size, place = unpacked(F.col("_best"))
    return found.select(*keys, (-place).alias(order), size.alias("n_chars"))


def first_n(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, rank: str = "rank") -> DataFrame:
    """First n rows per key. The rank filter lets Spark cut each group before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def _ranges(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows cut into even ranges of `order`, numbered by `_range`.

    The range edges are sampled, so the layout is pinned before anything reads it twice.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pin(df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()))


def previous_row(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    small_groups: bool = False,
) -> DataFrame:
    """Add `prev_<value>` from the row before, per key in `order` (which must be total).

    Groups are cut into ranges of (keys, order), so a large one spreads over many tasks; the
    first row of a range takes the last row of the range before it, one row per range. A caller
    who knows that every group fits one task may say `small_groups` for a plain window.
    """
    if small_groups:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.select("*", *[F.lag(v).over(w).alias(f"prev_{v}") for v in values])

    ranged = _ranges(df, [*keys, *order])
    w = Window.partitionBy("_range", *keys).orderBy(*order)
    local = ranged.select(
        "*",
        (F.row_number().over(w) == 1).alias("_opens"),
        *[F.lag(v).over(w).alias(f"_lag_{v}") for v in values],
    )
    tail_key = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("_all"))
    tails = (
        ranged.groupBy("_range")
        .agg(F.max_by(F.struct(tail_key.alias("key"), F.struct(*values).alias("val")),
                      F.struct(*keys, *order)).alias("tail"))
        .select(F.lead("_range").over(Window.orderBy("_range")).alias("_range"), "tail")
    )
    joined = local.join(F.broadcast(tails), "_range", "left")
    carries = F.col("_opens") & F.col("tail.key").eqNullSafe(tail_key)
    prev = [
        F.when(carries, F.col(f"tail.val.{v}")).otherwise(F.col(f"_lag_{v}")).alias(f"prev_{v}") for v in values
    ]
    return joined.select(*df.columns, *prev)


def carry_forward(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Fills nulls of `value` with the last one before that is not null, per key in `order` (which must be total).

    Rows are cut into even ranges of (keys, order), so a key with any share of the rows spreads over many tasks. Each range is filled by
    itself; what is open where it begins comes from the last value of the ranges before, one row per range. Keys must not be null.
    """
    ranged = _ranges(df, [*keys, *order])
    inside = Window.partitionBy("_range", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    key = F.struct(*[F.col(k) for k in keys])
    held = ranged.where(F.col(value).isNotNull())
    last = held.groupBy("_range").agg(F.max_by(F.struct(key.alias("key"), F.col(value).alias("val")), F.struct(*keys, *order)).alias("last"))
    edges = ranged.select("_range").distinct().join(last, "_range", "left")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    opened = edges.select("_range", F.last("last", ignorenulls=True).over(before).alias("_open"))
    local = ranged.withColumn("_here", F.last(value, ignorenulls=True).over(inside))
    carried = F.when(F.col("_open.key") == key, F.col("_open.val"))
    rest = [F.col(c) for c in df.columns if c != value]
    return local.join(F.broadcast(opened), "_range", "left").select(*rest, F.coalesce("_here", carried).alias(value))


def audit_sample(df: DataFrame, key: Column, seed: str, n: int) -> DataFrame:
    """A repeatable sample of n rows: smallest hashes of (seed, key)."""
    return df.orderBy(F.sha2(F.concat_ws("|", F.lit(seed), key.cast("string")), 256), key).limit(n)


def sample_with_rest(df: DataFrame, order: Sequence[str], line: Column, n: int) -> DataFrame:
    """First n report lines and, when rows remain, one line that counts them."""
    shown = df.orderBy(*order).limit(n).select(line.alias("line"))
    rest = (
        df.agg((F.count(F.lit(1)) - n).alias("more"))
        .where("more > 0")
        .select(F.format_string("... and %d more", "more").alias("line"))
    )
    return shown.unionByName(rest)


def global_rank(df: DataFrame, order: Sequence[str], rank: str) -> DataFrame:
    """1-based place of every row in `order` (a total order), ranked range by range.

    Rows are cut into ranges; a range adds the row counts of the ranges before it, which
    are one number per range.
    """
    ranged = _ranges(df, order)
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    local = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        ranged.withColumn("_local", local)
        .join(F.broadcast(offsets), "_range")
        .select(*df.columns, (F.col("_offset") + F.col("_local")).alias(rank))
    )
