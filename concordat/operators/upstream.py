"""Upstream-licence audit of mirrored models and the repository-level licence plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.functions import evidence, spdx, urls
from concordat.functions.text import quoted, shorten
from concordat.operators.curation import with_curation
from concordat.settings import DEFAULT_PROFILE, Profile


def audit(
    components: DataFrame,
    curation: DataFrame,
    readmes: DataFrame,
    hub_cards: DataFrame,
    git_licences: DataFrame,
    profile: Profile = DEFAULT_PROFILE,
) -> DataFrame:
    """Verdict per component: curated, else the upstream's own card, else its git licence.

    `components(name, version, recorded, homepage, vcs)`; `readmes(repo_id, text)`;
    `hub_cards(repo_id, card_json, error)`; `git_licences(repo_id, spdx_id, error)`, each
    with one row per repository. A card that failed or names no licence falls through.
    """
    home = F.coalesce(F.col("homepage"), F.lit(""))
    vcs = F.coalesce(F.col("vcs"), F.lit(""))
    up_readme = readmes.select(
        F.col("repo_id").alias("mirror_repo"), evidence.upstream_from_readme(F.col("text")).alias("readme_upstream")
    )
    cards = hub_cards.select(
        F.col("repo_id").alias("upstream_repo"),
        F.when(F.col("error").isNull(), F.nullif(evidence.card_licence(F.col("card_json")), F.lit("")))
        .alias("card_licence"),
    )
    git = git_licences.select(
        F.col("repo_id").alias("git_repo"),
        F.col("spdx_id").alias("git_spdx"),
        F.col("error").alias("git_error"),
        F.lit(True).alias("git_known"),
    )
    # Components without a repository never match; spreading their null keys keeps them from
    # meeting in one partition.
    spread = F.concat(F.lit("\x00"), F.xxhash64("name", "version", "recorded").cast("string"))
    key = lambda c: F.coalesce(F.col(c), spread)
    located = (
        with_curation(components, curation)
        .withColumn("mirror_repo", urls.hub_repo_id(home))
        .join(up_readme.withColumnRenamed("mirror_repo", "_r"), key("mirror_repo") == F.col("_r"), "left")
        .withColumn("upstream_repo", F.coalesce("readme_upstream", urls.hub_repo_id(vcs)))
        .join(cards.withColumnRenamed("upstream_repo", "_c"), key("upstream_repo") == F.col("_c"), "left")
        .withColumn("git_repo", F.coalesce(urls.git_repo_id(vcs), urls.git_repo_id(home)))
        .join(git.withColumnRenamed("git_repo", "_g"), key("git_repo") == F.col("_g"), "left")
    )
    recorded = F.col("recorded")
    same = lambda other: spdx.normalise_loose(recorded) == spdx.normalise_loose(other)
    none = F.lit(None).cast("string")

    card, spdx_id = F.col("card_licence"), F.col("git_spdx")
    hub_verdict = F.when(card.isNotNull(), F.when(same(card), "ACK").otherwise("MISMATCH"))
    hub_detail = F.when(
        card.isNotNull(),
        F.when(same(card), F.concat(F.lit("upstream HF publisher declares "), quoted(card))).otherwise(
            F.concat(F.lit("recorded="), quoted(recorded), F.lit(" vs upstream declares "), quoted(card))
        ),
    )
    has_git = F.col("git_repo").isNotNull()
    git_error = F.coalesce(F.col("git_error"), F.when(F.col("git_known").isNull(), F.lit("not landed")))
    no_id = F.coalesce(spdx_id, F.lit("")) == ""
    git_verdict = F.when(
        has_git,
        F.when(git_error.isNotNull() | no_id, "UNKNOWN").when(same(spdx_id), "ACK").otherwise("MISMATCH"),
    )
    git_detail = F.when(
        has_git,
        F.when(git_error.isNotNull(), F.concat(F.lit("github license API: "), git_error))
        .when(no_id, F.lit("github license API returned no SPDX id"))
        .when(same(spdx_id), F.concat(F.lit("github canonical LICENSE = "), quoted(spdx_id)))
        .otherwise(F.concat(F.lit("recorded="), quoted(recorded), F.lit(" vs github LICENSE = "), quoted(spdx_id))),
    )
    sources = {"hub": (hub_verdict, hub_detail), "git": (git_verdict, git_detail)}
    ladder = [sources[s] for s in profile.upstream_order]
    curated = F.col("curated")
    verdict = F.when(curated, "CURATED").otherwise(
        F.coalesce(*[v for v, _ in ladder], F.lit("UNKNOWN"))
    )
    rationale = F.coalesce(F.col("rationale"), F.lit("(no rationale)"))
    detail = F.when(curated, F.concat(F.lit(f"{profile.curation_label}: "), shorten(rationale))).otherwise(
        F.coalesce(*[d for _, d in ladder], F.lit("no documented upstream and no usable fallback"))
    )
    return located.select(
        *components.columns,
        F.when(curated, none).otherwise(F.col("upstream_repo")).alias("upstream_repo"),
        verdict.alias("verdict"),
        detail.alias("detail"),
    )


def repo_claims(components: DataFrame) -> DataFrame:
    """Components that name a hub repository and a licence; `hub` is null when unmapped."""
    return (
        components.withColumn("repo_id", urls.hub_repo_id(F.col("homepage")))
        .where(F.col("repo_id").isNotNull() & F.col("recorded").isNotNull())
        .withColumn("hub", spdx.hub_licence(F.col("recorded")))
    )


def unmapped_licences(claims: DataFrame) -> DataFrame:
    return claims.where(F.col("hub").isNull()).drop("hub")


def repo_plan(claims: DataFrame) -> DataFrame:
    """One row per repository: first licence kept, any later different one is a conflict.

    Inputs shrink to one row per (repository, licence) before the repository is formed. Claims of several inventories (sbom_id) are
    taken in the order of their ids, then of their components.
    """
    place = F.struct(*[c for c in ("sbom_id", "ord") if c in claims.columns])
    per_licence = (
        claims.where(F.col("hub").isNotNull())
        .groupBy("repo_id", "hub")
        .agg(F.min(place).alias("first_ord"), F.count(F.lit(1)).alias("n"),
             F.min_by("recorded", place).alias("spdx"))
    )
    return per_licence.groupBy("repo_id").agg(
        F.min_by("hub", "first_ord").alias("license"),
        F.min_by("spdx", "first_ord").alias("spdx"),
        (F.count(F.lit(1)) > 1).alias("conflict"),
        F.min_by("n", "first_ord").alias("n_components"),
    )


def repo_components(claims: DataFrame, plan: DataFrame) -> DataFrame:
    """Component rows behind each kept licence (long form of the component list)."""
    kept = plan.select("repo_id", F.col("license").alias("hub"), "conflict")
    return claims.join(kept, ["repo_id", "hub"]).select("repo_id", *[c for c in ("sbom_id",) if c in claims.columns], "ord", "name", "conflict")
