"""Repository ids, refs and percent-encoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quote_path(col: Column) -> Column:
    """Percent-encode, leaving `/` and the unreserved characters alone."""
    out = F.url_encode(col)
    for found, wanted in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(found), F.lit(wanted))
    return out


def repo_id(url: Column, host: str) -> Column:
    """`owner/name` behind `host/`, query, fragment and trailing slashes cut; else null."""
    needle = f"{host}/"
    tail = F.substring(url, F.instr(url, needle) + len(needle), F.length(url))
    tail = F.rtrim(F.get(F.split(tail, "[?#]"), F.lit(0)), F.lit("/"))
    parts = F.split(tail, "/")
    return F.when(
        F.contains(url, F.lit(needle)) & (F.size(parts) >= 2),
        F.concat_ws("/", F.get(parts, F.lit(0)), F.get(parts, F.lit(1))),
    )


def hub_repo_id(url: Column) -> Column:
    return repo_id(url, "huggingface.co")


def git_repo_id(url: Column) -> Column:
    return repo_id(url, "github.com")


def _group(url: Column, pattern: str, i: int) -> Column:
    return F.nullif(F.regexp_extract(url, pattern, i), F.lit(""))


HUB_PATTERN = r"^https?://huggingface\.co/([^/]+)/([^/?#]+)"
GIT_PATTERN = r"^https?://github\.com/([^/]+)/([^/?#]+)(?:/tree/([^/?#]+))?"


def hub_parts(url: Column) -> tuple[Column, Column]:
    return _group(url, HUB_PATTERN, 1), _group(url, HUB_PATTERN, 2)


def git_parts(url: Column) -> tuple[Column, Column, Column]:
    return tuple(_group(url, GIT_PATTERN, i) for i in (1, 2, 3))
