r"""Secret scan weighed by how many owners a credential has, in column functions only.

Base spans per kind are leftmost, non-overlapping matches (kinds below). Then the corpus is asked who owns each
value: hashes of candidate values are counted by distinct repositories and distinct owners. A value that several
owners or many repositories have is an example that people copy; one of few owners and few repositories that looks random is
taken for live, and its value gets a span of kind "live" beside the base span. Base spans are never taken away.

Positions come from splitting the text at the same pattern: pieces and matches alternate, so running lengths give the
code point at which each match begins. The sums run over rows, a match each, so that a text of many matches costs no more than
as many texts of one.

Counting is two-stage with combining before each shuffle: distinct (value, repository, owner), then counts per value.
A value that a third of all documents have is thus one row per task, and joining it back is left to skew-splitting
joins. Texts are scanned once and never shuffled.

Defined cases: null text is empty and has no spans; null repositories or owners count as one unnamed owner;
repeated rows keep a row each and count once for ownership; an empty table gives an empty one; other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat.session import pin

# Fixed patterns. Group VALUE holds the credential; matches whose value is shorter than the last number are dropped.
KINDS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"(AKIA[A-Z0-9]+)", 1, 16),
    ("hex", r"([0-9a-f]+)", 1, 32),
)
# As KINDS, but nothing shorter than a match that counts is looked at: greedy runs, so the matches are the same.
_QUICK = {"access": r"(AKIA[A-Z0-9]{12,})", "hex": r"([0-9a-f]{32,})"}
LIVE = "live"
MAX_OWNERS = 2
MAX_REPOSITORIES = 10
MIN_ENTROPY = 2.5  # bits per character


def matches(text: Column, kind: str, pattern: str, group: int) -> Column:
    """Structs of rank, i, gap, size, value for the matches of one kind: gap and size are code points before the match and in it."""
    rank = [k for k, *_ in KINDS].index(kind)
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern), F.length)
    # zipped, not looked up by place, so that each pattern runs over the text once
    zipped = F.filter(F.arrays_zip(sizes.alias("size"), values.alias("value"), gaps.alias("gap")), lambda x: x["size"].isNotNull())
    return F.transform(zipped, lambda x, i: F.struct(
        F.lit(rank).alias("rank"), i.alias("i"), x["gap"].alias("gap"), x["size"].alias("size"), x["value"].alias("value")))


def entropy(value: Column) -> Column:
    """Shannon entropy of a text's characters, in bits per character."""
    chars = F.split(value, "")
    n = F.size(chars).cast("double")
    return F.aggregate(
        F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)) / n),
        F.lit(0.0), lambda a, p: a - p * F.log2(p),
    )


def _listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


_MATCH = "array<struct<rank:int,i:int,gap:int,size:int,value:string>>"


def found_matches(docs: DataFrame, text: str, repository: str, owner: str) -> DataFrame:
    """_row, the id columns and the matches of all kinds, from one scan of the texts."""
    t = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast(_MATCH)
    per_kind = []
    for kind, pattern, group, _ in KINDS:
        quick = _QUICK.get(kind, pattern)
        per_kind.append(F.when(t.rlike(quick), matches(t, kind, quick, group)).otherwise(none))
    return docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(repository).alias("_repository"), F.col(owner).alias("_owner"),
        F.concat(*per_kind).alias("_matches"),
    )


def base_spans(found: DataFrame) -> DataFrame:
    """_row, the id columns, start, rank, kind, end (code points) and value of every base span, a row each.

    Running sums of a text's own gaps and matches give the places: linear in the matches, however many a text has.
    """
    each = found.where(F.size("_matches") > 0).select("_row", "_repository", "_owner", F.inline("_matches"))
    upto = Window.partitionBy("_row", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto).cast("int"))
    kinds, least = F.array(*[F.lit(k) for k, *_ in KINDS]), F.array(*[F.lit(n) for *_, n in KINDS])
    return placed.where(F.length("value") >= F.get(least, F.col("rank"))).select(
        "_row", "_repository", "_owner", (F.col("end") - F.col("size")).alias("start"), "rank", F.get(kinds, F.col("rank")).alias("kind"), "end", "value")


def ownership(spans: DataFrame) -> DataFrame:
    """value_hash, repositories, owners for each candidate value of the corpus."""
    each = spans.select(
        F.coalesce(F.col("_repository").cast("string"), F.lit("")).alias("_repository"),
        F.coalesce(F.col("_owner").cast("string"), F.lit("")).alias("_owner"), "value_hash",
    ).distinct()
    return each.groupBy("value_hash").agg(
        F.count_distinct("_repository").alias("repositories"), F.count_distinct("_owner").alias("owners"),
    )


def scan(
    docs: DataFrame, text: str = "text", repository: str = "doc_id", owner: str = "source",
    max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES, min_entropy: float = MIN_ENTROPY,
) -> DataFrame:
    """repository, n_assign, n_access, n_hex, base, spans, n_live, n_example for each row.

    base and spans are texts of kind:start:end, by start and then kind, base without and spans with the live ones.
    """
    found = pin(found_matches(docs, text, repository, owner))
    spans = pin(base_spans(found).withColumn("value_hash", F.sha2("value", 256)))
    copied = (F.col("owners") > max_owners) | (F.col("repositories") > max_repositories)
    live = ~copied & (entropy(F.col("value")) >= min_entropy)

    def span(start, rank, kind):
        return F.struct(start.alias("start"), rank.alias("rank"), kind.alias("kind"), F.col("end"))

    added = F.when(live, span(F.col("end") - F.length("value"), F.lit(len(KINDS)), F.lit(LIVE)))
    judged = (
        spans.join(ownership(spans), "value_hash")
        .select("_row", span(F.col("start"), F.col("rank"), F.col("kind")).alias("base"), added.alias("live"), copied.alias("copied"))
        .groupBy("_row").agg(
            F.collect_list("base").alias("_base"), F.collect_set("live").alias("_live"), F.sum(F.col("copied").cast("long")).alias("n_example"),
            *[F.count(F.when(F.col("base.rank") == i, 1)).alias(f"n_{k}") for i, (k, *_) in enumerate(KINDS)])
        .select(
            "_row", "n_example", *[f"n_{k}" for k, *_ in KINDS], F.size("_live").cast("long").alias("n_live"),
            _listed(F.array_sort("_base")).alias("base"), _listed(F.array_sort(F.concat("_base", "_live"))).alias("spans"))
    )
    counts = [F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k, *_ in KINDS]
    return found.select("_row", "_repository").join(judged, "_row", "left").select(
        F.col("_repository").alias(repository), *counts, *[F.coalesce(c, F.lit("")).alias(c) for c in ("base", "spans")],
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_live", "n_example")],
    )
