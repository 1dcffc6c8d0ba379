"""Licence-body selection as ordered text segments per component."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.functions import text as T
from concordat.operators.matching import best_file, rule_hits


def assign_files(all_ids: Column, hint_ord: Column, phrase_ord: Column) -> Column:
    """array<struct(ord, spdx_id)>: best file per id in id order, each file used once."""
    picks = F.filter(
        F.transform(
            all_ids,
            lambda i: F.struct(best_file(hint_ord, phrase_ord, i).alias("ord"), i.alias("spdx_id")),
        ),
        lambda p: p["ord"].isNotNull(),
    )
    ords = F.transform(picks, lambda p: p["ord"])
    return F.filter(picks, lambda p, i: F.array_position(ords, p["ord"]) == i + 1)


def choose(components: DataFrame, files: DataFrame) -> DataFrame:
    """Decision per component that has plausible files: tag and the files it leads with.

    `components(component_id, kind, value, all_ids)`, `files(component_id, ord, rel_path, text)`.
    """
    hits = rule_hits(files, ["component_id"])
    base = components.join(hits, "component_id")
    assigned = assign_files(F.col("all_ids"), F.col("hint_ord"), F.col("phrase_ord"))
    single = best_file(F.col("hint_ord"), F.col("phrase_ord"), F.col("value"))
    dual = (F.col("kind") == "expression") & (F.size("all_ids") > 1)
    lead = lambda o: F.array(F.struct(o.alias("ord"), F.lit("").alias("spdx_id")))
    return (
        base.withColumn("assigned", assigned)
        .withColumn("single", single)
        .withColumn(
            "source_tag",
            F.when(dual & ((F.size("assigned") > 0) | F.col("has_notice")), "concatenated-dual")
            .when((F.col("kind") == "id") & F.col("single").isNotNull(), "matched")
            .otherwise("longest-file"),
        )
        .withColumn(
            "leads",
            F.when(F.col("source_tag") == "concatenated-dual", F.col("assigned"))
            .when(F.col("source_tag") == "matched", lead(F.col("single")))
            .otherwise(lead(F.col("longest_ord"))),
        )
        .select("component_id", "source_tag", "leads")
    )


def is_notice() -> Column:
    return F.contains(F.lower("rel_path"), F.lit("notice"))


def segments(chosen: DataFrame, files: DataFrame) -> DataFrame:
    """(component_id, source_tag, seg, piece): lead files in order, then unused notice files."""
    pos = F.array_position(F.transform("leads", lambda x: x["ord"]), F.col("ord"))
    joined = files.join(chosen, "component_id").withColumn("pos", pos)
    lead_id = F.get(F.col("leads"), F.col("pos").cast("int") - 1)["spdx_id"]
    headed = F.concat(
        F.lit("=== "), F.col("rel_path"), F.lit(" ("), lead_id, F.lit(") ===\n\n"), F.col("text")
    )
    noted = F.concat(F.lit("=== NOTICE ("), F.col("rel_path"), F.lit(") ===\n\n"), F.col("text"))
    is_lead = F.col("pos") > 0
    piece = (
        F.when(is_lead & (F.col("source_tag") == "concatenated-dual"), headed)
        .when(is_lead, F.col("text"))
        .otherwise(noted)
    )
    return joined.where(is_lead | is_notice()).select(
        "component_id", "source_tag",
        F.when(is_lead, F.struct(F.lit(0).alias("part"), F.col("pos").cast("bigint").alias("at")))
        .otherwise(F.struct(F.lit(1).alias("part"), F.col("ord").alias("at"))).alias("seg"),
        piece.alias("piece"),
    )


def assemble(segs: DataFrame) -> DataFrame:
    """One body per component: the inventory format holds it as one value, so its segments meet in one row."""
    return (
        segs.groupBy("component_id", "source_tag")
        .agg(F.sum(F.length("piece") + 2).alias("n_chars"), F.array_sort(F.collect_list(F.struct("seg", "piece"))).alias("parts"))
        .select("component_id", "source_tag", "n_chars",
                F.array_join(F.transform("parts", lambda p: p["piece"]), "\n\n").alias("body"))
    )


def implausible_bodies(components: DataFrame) -> DataFrame:
    """Components whose embedded licence text does not read like one; empty before a release."""
    def entry_text(entry: Column) -> Column:
        body = entry["license"]["text"]
        return F.when(body["encoding"] == "base64", T.decode_text(body["content"]))

    texts = F.filter(F.transform("component.licenses", entry_text), lambda t: t.isNotNull())
    first = components.select("sbom_id", "ord", F.col("component.name").alias("name"), F.get(texts, F.lit(0)).alias("text"))
    return first.where(F.col("text").isNotNull() & ~T.is_plausible_licence(F.col("text"))).drop("text")
