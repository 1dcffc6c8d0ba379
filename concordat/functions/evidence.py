"""Licence fingerprints, drift tests and copyright-line extraction on one text column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from concordat import constants as C
from concordat.functions import spdx
from concordat.functions.text import let, strip


def fingerprints(body: Column) -> Column:
    """Ids whose phrase occurs in the head of the body, in table order, no repeats."""
    def matches(head: Column) -> Column:
        hits = F.array(*[F.when(F.contains(head, F.lit(p)), F.lit(i)) for i, p in C.FINGERPRINTS])
        return F.array_distinct(F.filter(hits, lambda x: x.isNotNull()))

    return let(F.lower(F.left(body, F.lit(C.FINGERPRINT_HEAD_CHARS))), matches)


def drift_from(detected: Column, kind: Column, value: Column, all_ids: Column, body: Column) -> Column:
    """struct(declared, detected, evidence) when no declared id is among the detected ones."""
    candidates = F.transform(
        F.when(F.size(all_ids) > 0, all_ids).otherwise(F.array(value)), lambda d: spdx.normalise_family(d)
    )

    def judge(found: Column) -> Column:
        expanded = F.flatten(F.transform(found, lambda d: F.transform(
            F.split(spdx.normalise_family(d), r"\s+or\s+|\s+and\s+"), lambda part: strip(part))))
        drifts = (
            (F.coalesce(body, F.lit("")) != "")
            & (kind != "none")
            & (F.size(found) > 0)
            & ~F.arrays_overlap(candidates, expanded)
        )
        return F.when(
            drifts,
            F.struct(
                value.alias("declared"),
                F.array_join(found, ", ").alias("detected"),
                F.left(body, F.lit(C.EVIDENCE_CHARS)).alias("evidence"),
            ),
        )

    return let(detected, judge)


def copyright_lines(body: Column) -> Column:
    """Cleaned copyright statements in order of appearance (repeats kept)."""
    found = F.regexp_extract_all(body, F.lit(f"(?U){C.COPYRIGHT_PATTERN}"), F.lit(0))

    def clean(raw: Column) -> Column:
        one_line = strip(F.regexp_replace(raw, r"(?U)\s+", " "))
        return F.left(F.rtrim(one_line, F.lit(",;: ")), F.lit(C.COPYRIGHT_MAX_CHARS))

    def has_name(line: Column) -> Column:
        return F.rlike(F.substring(line, F.instr(line, " "), F.length(line)), F.lit("[A-Za-z]{2,}"))

    return F.filter(F.transform(found, clean), has_name)


def spdx_marker(header: Column) -> Column:
    """Ids named after an SPDX header tag; comment closers are cut."""
    found = F.regexp_extract_all(header, F.lit(r"SPDX-License-Identifier:[ \t]*([^\r\n]+)"), F.lit(1))
    cleaned = F.transform(found, lambda x: strip(F.regexp_replace(x, r"(\*/|-->|#\}).*$", "")))
    return F.filter(cleaned, lambda x: x != "")


def upstream_from_readme(readme: Column) -> Column:
    """Upstream repository named by a mirror's heading, else by its table row."""
    heading = F.regexp_extract(readme, r"(?U)#\s*Mirror of\s+([A-Za-z0-9._-]+/[A-Za-z0-9._-]+)", 1)
    row = F.regexp_extract(readme, r"(?U)\|\s*Upstream\s*\|\s*\[([^\]]+)\]", 1)
    return F.coalesce(F.nullif(heading, F.lit("")), F.nullif(row, F.lit("")))


def card_licence(card_json: Column) -> Column:
    """`cardData.license` of a model card: text, or a list joined by ` | `; else null."""
    raw = F.get_json_object(card_json, "$.cardData.license")
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(card_json), "$.cardData.license", "variant"))
    is_list = F.startswith(kind, F.lit("ARRAY"))
    items = F.from_json(raw, "array<string>")
    joined = F.when(F.size(items) > 0, F.concat_ws(" | ", items))
    return F.when(is_list, joined).when(kind == "STRING", raw)
