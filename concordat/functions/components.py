"""Projections over the nested component record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from concordat import constants as C
from concordat.functions import spdx, text, urls
from concordat.settings import DEFAULT_PROFILE, Profile


def first_property(properties: Column, name: str) -> Column:
    return F.get(F.filter(properties, lambda p: p["name"] == name), F.lit(0))["value"]


def first_reference(references: Column, kind: str) -> Column:
    return F.get(F.filter(references, lambda r: r["type"] == kind), F.lit(0))["url"]


def licence_info(licenses: Column) -> Column:
    """struct(kind, value, all_ids); the first entry that names anything wins."""

    def tag(entry: Column) -> Column:
        lid, lname, expr = entry["license"]["id"], entry["license"]["name"], entry["expression"]
        kind = F.when(lid.isNotNull(), "id").when(lname.isNotNull(), "name").when(expr.isNotNull(), "expression")
        return F.struct(kind.alias("kind"), F.coalesce(lid, lname, expr).alias("value"))

    def with_ids(first: Column) -> Column:
        value = F.coalesce(first["value"], F.lit(""))
        kind = F.coalesce(first["kind"], F.lit("none"))
        ids = (
            F.when(kind == "id", F.array(value))
            .when(kind == "expression", spdx.split_expression(value))
            .otherwise(F.array().cast("array<string>"))
        )
        return F.struct(kind.alias("kind"), value.alias("value"), ids.alias("all_ids"))

    tagged = F.filter(F.transform(licenses, tag), lambda t: t["kind"].isNotNull())
    return text.let(F.get(tagged, F.lit(0)), with_ids)


def licence_labels(licenses: Column) -> Column:
    """Id, else name, else expression of every entry that has one; '' counts as absent."""

    def label(entry: Column) -> Column:
        blank = F.lit("")
        return F.coalesce(
            F.nullif(entry["license"]["id"], blank),
            F.nullif(entry["license"]["name"], blank),
            F.nullif(entry["expression"], blank),
        )

    return F.filter(F.transform(licenses, label), lambda x: x.isNotNull())


def joined_label(licenses: Column, sep: str) -> Column:
    joined = F.array_join(licence_labels(licenses), sep)
    return text.or_default(joined, "(none)")


def audit_label(licenses: Column) -> Column:
    return joined_label(licenses, " | ")


def declared_label(licenses: Column) -> Column:
    return joined_label(licenses, " AND ")


def first_label(licenses: Column) -> Column:
    return F.get(licence_labels(licenses), F.lit(0))


def scan_label(licenses: Column) -> Column:
    """First id or expression; entries that only carry a free-text name are passed over."""
    blank = F.lit("")
    usable = F.filter(
        F.transform(licenses, lambda e: F.coalesce(F.nullif(e["license"]["id"], blank), F.nullif(e["expression"], blank))),
        lambda x: x.isNotNull(),
    )
    return F.get(usable, F.lit(0))


def purl_prefix(purl: Column) -> Column:
    out = F.lit(None).cast("string")
    for prefix in reversed(C.PURL_PREFIXES):
        out = F.when(F.startswith(purl, F.lit(prefix)), F.lit(prefix)).otherwise(out)
    return out


def is_proprietary(info: Column) -> Column:
    return (info["kind"] == "name") & F.contains(info["value"], F.lit("LicenseRef-"))


def component_key(name: Column, version: Column) -> Column:
    return F.concat(F.coalesce(name, F.lit("")), F.lit("@"), F.coalesce(version, F.lit("")))


def source_plan(
    category: Column, name: Column, version: Column, homepage: Column, tool: Column
) -> Column:
    """Where a component's source would come from, as one struct.

    `tool` is the matched row of the system-tool map (null struct when none). Every field
    lists only the categories that set it, so reading one field costs one short CASE.
    """
    rust, npm, pypi = category == C.CAT_RUST, category == C.CAT_NPM, category == C.CAT_PYTHON
    system = category == C.CAT_SYSTEM
    home = F.coalesce(homepage, F.lit(""))
    version_or_main = F.coalesce(version, F.lit("main"))
    h_owner, h_repo = urls.hub_parts(home)
    g_owner, g_repo, g_ref = urls.git_parts(home)
    hub, git = category == C.CAT_MODELS, category.isin(*C.CAT_GIT_HOSTED)
    hub_ok, git_ok, tool_ok = hub & h_owner.isNotNull(), git & g_owner.isNotNull(), system & tool.isNotNull()
    g_rev = F.coalesce(g_ref, version_or_main)
    scoped = F.when(F.startswith(name, F.lit("@")), F.replace(name, F.lit("/"), F.lit("%2F"))).otherwise(name)
    quoted_version = urls.quote_path(version)

    def path(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])

    fields = {
        "kind": F.when(rust, "tarball").when(npm, "npm-via-metadata").when(pypi, "pypi-via-metadata")
        .when(hub_ok, "hf-probe").when(git_ok, "gh-raw-probe").when(tool_ok, "system-curated").otherwise("none"),
        "format": F.when(rust | npm, "tar.gz").when(pypi, "auto"),
        "url": F.when(rust, path("https://crates.io/api/v1/crates/", urls.quote_path(name), "/", quoted_version, "/download"))
        .when(tool_ok, tool["source_tarball"]),
        "metadata_url": F.when(npm, path("https://registry.npmjs.org/", scoped, "/", quoted_version))
        .when(pypi, path("https://pypi.org/pypi/", urls.quote_path(name), "/", quoted_version, "/json")),
        "path_prefix": F.when(rust, path(name, "-", version, "/")).when(npm, "package/")
        .when(tool_ok, F.coalesce(tool["tarball_root_prefix"], F.lit(""))),
        "owner": F.when(hub_ok, h_owner).when(git_ok, g_owner),
        "repo": F.when(hub_ok, h_repo).when(git_ok, g_repo),
        "revision": F.when(hub_ok, version_or_main).when(git_ok, g_rev),
        "base_url": F.when(hub_ok, path("https://huggingface.co/", h_owner, "/", h_repo, "/resolve/", version_or_main))
        .when(git_ok, path("https://raw.githubusercontent.com/", g_owner, "/", g_repo, "/", g_rev)),
        "homepage_fallback": F.when(pypi, home),
        "reason": F.when(hub & ~hub_ok, path("HF URL not parseable: ", home))
        .when(git & ~git_ok, path("GitHub URL not parseable: ", home))
        .when(system & ~tool_ok, path("No curation entry for ", component_key(name, version)))
        .when(~(rust | npm | pypi | hub | git | system), path("Unknown category: ", category)),
    }
    return F.struct(*[c.cast("string").alias(f) for f, c in fields.items()])


def probe_urls(base_url: Column) -> Column:
    """Candidate single-file licence URLs under a base, in probe order."""
    return F.transform(
        F.array(*[F.lit(n) for n in C.PROBE_NAMES]), lambda n: F.concat(base_url, F.lit("/"), n)
    )


def embedded_text(component: Column, profile: Profile = DEFAULT_PROFILE) -> Column:
    """Decoded licence body: first readable licence entry, else the text property, else ''."""
    def entry_text(entry: Column) -> Column:
        body = entry["license"]["text"]
        return F.when(body["encoding"] == "base64", text.decode_text(body["content"]))

    from_entries = F.get(
        F.filter(F.transform(component["licenses"], entry_text), lambda t: t.isNotNull()), F.lit(0)
    )
    held = F.filter(component["properties"], lambda p: p["name"] == profile.text_property)
    from_property = F.get(
        F.filter(F.transform(held, lambda p: text.decode_text(p["value"])), lambda t: t.isNotNull()), F.lit(0)
    )
    return F.coalesce(F.nullif(from_entries, F.lit("")), from_property, F.lit(""))


def embed_text(
    component: Column, kind: Column, body: Column, copyrights: Column, profile: Profile = DEFAULT_PROFILE
) -> Column:
    """Component with the body written in: into the first licence entry, or into a property
    for expressions; `copyright` is replaced only when there is something to write."""
    encoded = text.encode_text(body)
    prop = F.struct(F.lit(profile.text_property).alias("name"), encoded.alias("value"))
    empty_props = F.array().cast("array<struct<name:string,value:string>>")
    others = F.filter(
        F.coalesce(component["properties"], empty_props),
        lambda p: ~p["name"].eqNullSafe(F.lit(profile.text_property)),
    )
    body_struct = F.struct(
        F.lit("text/plain").alias("contentType"), F.lit("base64").alias("encoding"), encoded.alias("content")
    )
    positions = F.transform(
        component["licenses"], lambda e, i: F.when(e["license"].isNotNull(), i)
    )
    target = F.array_min(positions)
    licences = F.transform(
        component["licenses"],
        lambda e, i: F.when(
            i == target, e.withField("license", e["license"].withField("text", body_struct))
        ).otherwise(e),
    )
    is_expr = kind == "expression"
    return (
        component.withField(
            "properties",
            F.when(is_expr, F.array_append(others, prop)).otherwise(component["properties"]),
        )
        .withField("licenses", F.when(is_expr, component["licenses"]).otherwise(licences))
        .withField(
            "copyright",
            F.when(F.coalesce(copyrights, F.lit("")) != "", copyrights).otherwise(component["copyright"]),
        )
    )
