"""SPDX expression splitting, normalising, false-positive filtering and verdicts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from concordat import constants as C
from concordat.functions.text import let, quoted, strip

_MARK = "\x01"


def literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def split_expression(expr: Column) -> Column:
    """Ids of an expression; `X WITH Y` stays one id."""
    parts = F.split(F.translate(expr, "()", "  "), r"(?iU)\s+(?:AND|OR)\s+")
    return F.filter(F.transform(parts, strip), lambda t: t != "")


def normalise_loose(expr: Column) -> Column:
    """Trim, lower-case, `_` to `-`, no blanks. Null reads as ''."""
    folded = F.replace(F.translate(F.lower(strip(expr)), "_", "-"), F.lit(" "), F.lit(""))
    return F.coalesce(folded, F.lit(""))


def normalise_spdx(expr: Column) -> Column:
    """Loose form with deprecated bare GNU ids mapped to their `-only` names."""
    return let(
        normalise_loose(expr), lambda b: F.coalesce(F.element_at(literal_map(C.SPDX_SYNONYMS), b), b)
    )


def normalise_family(expr: Column) -> Column:
    """Base licence without exception clause or GNU version suffix."""
    base = F.get(F.split(expr, " WITH "), F.lit(0))
    for suffix in ("-or-later", "-only"):
        base = F.replace(base, F.lit(suffix), F.lit(""))
    return F.lower(strip(base))


def collapse_repeats(expr: Column) -> Column:
    """`X AND X` becomes `X` when all conjuncts agree ignoring case."""

    def settle(e: Column) -> Column:
        parts = F.split(e, " AND ")
        folded = F.array_distinct(F.transform(parts, lambda p: F.lower(strip(p))))
        repeats = F.contains(e, F.lit(" AND ")) & (F.size(folded) == 1)
        return F.when(repeats, strip(F.get(parts, F.lit(0)))).otherwise(e)

    return let(expr, settle)


def drop_commercial_alternative(expr: Column) -> Column:
    ref = C.COMMERCIAL_REF
    new = F.regexp_replace(expr, rf"\((\S+) OR {ref}\)", "$1")
    new = F.replace(new, F.lit(f"{ref} OR "), F.lit(""))
    new = F.replace(new, F.lit(f" OR {ref}"), F.lit(""))
    return F.when(F.contains(expr, F.lit(ref)), collapse_repeats(new)).otherwise(expr)


def drop_internal_refs(expr: Column) -> Column:
    """Remove scanner-internal terms together with the operator in front of each.

    A kept term carries the operator directly before it, so cutting the string in
    front of every operator gives pieces that can be filtered and glued back.
    """
    pieces = F.split(F.regexp_replace(expr, " (AND|OR) ", f"{_MARK} $1 "), _MARK)
    kept = F.filter(pieces, lambda p: ~F.contains(p, F.lit(C.INTERNAL_REF)))
    glued = F.regexp_replace(F.array_join(kept, ""), "^ (?:AND|OR) ", "")
    return F.when(F.contains(expr, F.lit(C.INTERNAL_REF)), strip(glued)).otherwise(expr)


def filter_false_positives(expr: Column) -> Column:
    def rewrite(cleaned: Column) -> Column:
        out = cleaned
        for raw, settled in C.APPENDIX_REWRITES:
            out = F.when(cleaned == raw, F.lit(settled)).otherwise(out)
        return out

    without_alternative = let(expr, drop_commercial_alternative)
    without_refs = let(without_alternative, drop_internal_refs)
    return let(collapse_repeats(without_refs), rewrite)


def verdict(declared: Column, detected: Column) -> Column:
    """struct(verdict, detail) for one declared / detected pair."""

    def ladder(v: Column) -> Column:
        dec, det, want = v["declared"], v["detected"], v["want"]

        def agrees(sep: str) -> Column:
            hit = F.exists(F.split(dec, sep), lambda t: normalise_spdx(F.trim(strip(t), F.lit("()"))) == want)
            return F.contains(dec, F.lit(sep)) & hit

        def said(name: str, *detail: Column) -> Column:
            return F.struct(F.lit(name).alias("verdict"), F.concat(*detail).alias("detail"))

        return (
            F.when(F.coalesce(det, F.lit("")) == "",
                   said("NO-DETECTION", F.lit("no detectable license in source")))
            .when(normalise_spdx(dec) == want,
                  said("ACK", F.lit("declared="), quoted(dec), F.lit(" matches detected="), quoted(det)))
            .when(agrees(" OR "),
                  said("ACK", F.lit("detected "), quoted(det),
                       F.lit(" is one of the declared alternatives in "), quoted(dec)))
            .when(agrees(" AND "),
                  said("ACK", F.lit("detected "), quoted(det),
                       F.lit(" is one component of declared composite "), quoted(dec)))
            .otherwise(said("MISMATCH", F.lit("declared="), quoted(dec), F.lit(" vs detected="), quoted(det)))
        )

    pair = F.struct(
        declared.alias("declared"), detected.alias("detected"), normalise_spdx(detected).alias("want")
    )
    return let(pair, ladder)


def hub_licence(spdx_id: Column) -> Column:
    return F.element_at(literal_map(C.HUB_LICENCE_IDS), spdx_id)
