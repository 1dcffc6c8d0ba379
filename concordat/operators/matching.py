"""Directory-to-component matching, licence-file choice and canonical-text fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat import constants as C
from concordat.functions import spdx
from concordat.functions import text as T
from concordat.operators.ordering import first_wins


def name_key(name: Column) -> Column:
    return F.translate(F.lower(name), "_", "-")


def bucket_prefix(bucket: Column) -> Column:
    return F.element_at(spdx.literal_map(C.BUCKET_PREFIX), bucket)


def inventory_keys(*sides: DataFrame) -> list[str]:
    """['sbom_id'] if all sides say which inventory their rows belong to. Names mean nothing across inventories."""
    return ["sbom_id"] if all("sbom_id" in s.columns for s in sides) else []


def component_index(components: DataFrame) -> DataFrame:
    """First component per (inventory, prefix, dashed lower-case name).

    A name is reachable under its lower-case, dashed and underscored spellings and a
    directory probes dashed first. Two names share any spelling exactly when their dashed
    forms agree, so one key per side gives the same match as the spelling-by-spelling probe.
    Input: (prefix, ord, name, version, declared), and sbom_id where there are several inventories.
    """
    keyed = components.where(F.col("prefix").isNotNull()).withColumn("name_key", name_key(F.col("name")))
    return first_wins(keyed, [*inventory_keys(components), "prefix", "name_key"], ["ord"])


def match_dirs(dirs: DataFrame, components: DataFrame) -> DataFrame:
    """Left join of scanned directories to components of the same ecosystem and, where both sides name one, the same inventory."""
    if "sbom_id" in components.columns and "sbom_id" not in dirs.columns:
        raise ValueError("directories must say which of the inventories they belong to")
    shared = inventory_keys(dirs, components)
    index = component_index(components).drop("ord").withColumn("matched", F.lit(True))
    keyed = dirs.withColumn("prefix", bucket_prefix(F.col("bucket"))).withColumn(
        "name_key", name_key(F.col("top"))
    )
    return (
        keyed.join(index, [*shared, "prefix", "name_key"], "left")
        .withColumn("matched", F.coalesce("matched", F.lit(False)))
        .drop("name_key")
    )


def unaccounted(matched: DataFrame) -> DataFrame:
    return matched.where(~F.col("matched"))


def declared_by_name(components: DataFrame) -> DataFrame:
    """Declared licence per component name and inventory: the first component of that name only,
    and inside it the first usable licence (it does not fall through to the next)."""
    keys = [*inventory_keys(components), "name"]
    return first_wins(components.select(*keys, "ord", "declared"), keys, ["ord"]).select(*keys, "declared")


def rule_hits(files: DataFrame, keys: list[str]) -> DataFrame:
    """Earliest file per rule: maps id -> ord for name hints and for content phrases.

    All rules are tested in one pass over the text and reduced to two dozen integers per
    component before the shuffle, so no text and no file-by-id pairs are moved.
    """
    low = F.lower(F.col("rel_path"))
    head = F.lower(F.left("text", F.lit(C.PHRASE_HEAD_CHARS)))
    tests = {f"h_{n}": T.contains_any(low, h) for n, h in enumerate(C.FILENAME_HINTS.values())}
    tests |= {f"p_{n}": F.contains(head, F.lit(p.lower())) for n, p in enumerate(C.CONTENT_PHRASES.values())}
    # Flags are projected first: the aggregate below then never sees the text itself.
    flags = files.select(
        *keys, "ord",
        F.length("text").alias("n_chars"),
        F.contains(low, F.lit("notice")).alias("is_notice"),
        *[F.when(t, F.col("ord")).alias(name) for name, t in tests.items()],
    )

    def as_map(prefix: str, ids) -> Column:
        return F.create_map(*[x for n, i in enumerate(ids) for x in (F.lit(i), F.col(f"{prefix}_{n}"))])

    return flags.groupBy(*keys).agg(
        *[F.min(name).alias(name) for name in tests],
        F.count(F.lit(1)).alias("n_files"),
        F.max("is_notice").alias("has_notice"),
        F.min_by("ord", F.struct(-F.col("n_chars"), F.col("ord"))).alias("longest_ord"),
    ).select(
        *keys, "n_files", "has_notice", "longest_ord",
        as_map("h", C.FILENAME_HINTS).alias("hint_ord"),
        as_map("p", C.CONTENT_PHRASES).alias("phrase_ord"),
    )


def best_file(hint_ord: Column, phrase_ord: Column, spdx_id: Column) -> Column:
    """Ordinal of the best file for an id: name hint first, then content phrase, else null."""
    return F.coalesce(F.element_at(hint_ord, spdx_id), F.element_at(phrase_ord, spdx_id))


def canonical_fallback(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """First plausible canonical text over a component's ids in order, exceptions cut.

    `wanted(component_id, all_ids)`, `texts(id, text)`; returns (component_id, fallback_id, text).
    """
    usable = texts.where(T.is_plausible_licence(F.col("text")))
    ids = wanted.select("component_id", F.posexplode("all_ids").alias("pos", "spdx_id")).withColumn(
        "id", T.strip(F.get(F.split("spdx_id", " WITH "), F.lit(0)))
    )
    picked = first_wins(
        ids.join(usable.select("id"), "id", "left_semi"), ["component_id"], ["pos"]
    ).select("component_id", "id", F.col("spdx_id").alias("fallback_id"))
    return picked.join(usable, "id").drop("id")
