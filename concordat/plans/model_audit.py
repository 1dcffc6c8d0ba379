"""Model-licence audit and mirror-licence plan over flattened components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat import constants as C
from concordat.operators import upstream
from concordat.operators.counts import verdict_counts
from concordat.settings import DEFAULT_PROFILE, Profile


def models(flat: DataFrame) -> DataFrame:
    return flat.where(F.col("category") == C.CAT_MODELS)


def audit_models(
    flat: DataFrame, curation: DataFrame, readmes: DataFrame, hub_cards: DataFrame, git_licences: DataFrame,
    profile: Profile = DEFAULT_PROFILE,
) -> DataFrame:
    return upstream.audit(
        models(flat).select("sbom_id", "ord", "name", "version", "recorded", "homepage", "vcs"),
        curation.select("key", "rationale"), readmes, hub_cards, git_licences, profile,
    )


def audit_counts(audited: DataFrame) -> DataFrame:
    return verdict_counts(audited, C.AUDIT_VERDICTS)


def mirror_claims(flat: DataFrame) -> DataFrame:
    return upstream.repo_claims(
        models(flat).select("ord", "name", "homepage", F.col("first_license").alias("recorded"))
    )
