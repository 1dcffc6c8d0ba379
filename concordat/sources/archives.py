"""Landed archives and single files: extraction of licence files and source headers.

Downloads are landed under the SHA-256 of their URL, so a component finds its archive by
`content_key(url)` and components that share a URL share one extraction.
"""

from __future__ import annotations

import io
import re
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat import constants as C
from concordat import schemas as S
from concordat.functions.text import decode_utf8, head_lines
from concordat.session import ship_package
from concordat.settings import DEFAULT_PROFILE, Profile

_LICENCE = re.compile(C.LICENCE_FILE_PATTERN)
_SOURCE = re.compile(rf"\.({'|'.join(C.SOURCE_EXTENSIONS)})$", re.IGNORECASE)
_ARCHIVE_ERRORS = (tarfile.TarError, zipfile.BadZipFile, EOFError, OSError)


def read_landed(spark: SparkSession, folder: str) -> DataFrame:
    """(key, content) per landed file."""
    return spark.read.format("binaryFile").load(folder).select(
        F.substring_index(F.col("path"), "/", -1).alias("key"), "content"
    )


def _members(blob: bytes, is_zip: bool) -> Iterator[tuple[str, object]]:
    """(name, reader) of each regular file, in archive order."""
    if is_zip:
        with zipfile.ZipFile(io.BytesIO(blob)) as box:
            for info in box.infolist():
                if not info.is_dir():
                    yield info.filename, lambda i=info: box.read(i)
    else:
        with tarfile.open(fileobj=io.BytesIO(blob), mode="r:*") as box:
            for member in box:
                if member.isfile():
                    yield member.name, lambda m=member: box.extractfile(m).read()


def _walk(row, max_files: int | None) -> list[tuple]:
    """Extracted rows of one download: licence files, wanted files, first source files."""
    if row.format == "single":
        return [("single", 0, None, row.content, None)]
    out, n_source = [], 0
    prefix = row.prefix or ""
    wanted = {prefix + w for w in row.wanted} if row.wanted is not None else set()
    for at, (name, read) in enumerate(_members(row.content, row.format == "zip")):
        rel = name[len(prefix):] if prefix and name.startswith(prefix) else name
        kinds = []
        if name in wanted:
            kinds.append("wanted")
        if _LICENCE.search(rel):
            kinds.append("license")
        if _SOURCE.search(name) and (max_files is None or n_source < max_files):
            n_source += 1
            kinds.append("header")
        if kinds:
            try:
                body = read()
            except Exception as e:  # one unreadable member does not spoil its archive
                out.append(("member-error", at, rel, None, f"{type(e).__name__}: {e}"))
                continue
            out.extend((kind, at, rel, body, None) for kind in kinds)
    return out


def extract(archives: DataFrame, profile: Profile = DEFAULT_PROFILE) -> DataFrame:
    """Rows of `kind` license, wanted, header, single, member-error or archive-error.

    `archives(key, prefix, format, wanted, content)`, one row per distinct extraction. Each
    archive is one row of work; a broken one yields an error row and no others.
    """
    ship_package(archives.sparkSession)
    max_files = profile.header_max_files
    names = [f.split()[0] for f in S.EXTRACTED.split(", ")]

    def run(batches):
        for batch in batches:
            for row in batch.itertuples(index=False):
                try:
                    found = _walk(row, max_files)
                except _ARCHIVE_ERRORS as e:
                    found = [("archive-error", 0, None, None, str(e))]
                yield pd.DataFrame(
                    [(row.key, row.prefix, kind, at, rel, body, msg) for kind, at, rel, body, msg in found],
                    columns=names,
                )

    return archives.select("key", "prefix", "format", "wanted", "content").mapInPandas(run, S.EXTRACTED)


def header_text(content: Column, max_lines: int) -> Column:
    return F.array_join(head_lines(decode_utf8(content), max_lines), "\n")


def npm_archive_url(meta: Column) -> Column:
    return F.nullif(F.get_json_object(meta, "$.dist.tarball"), F.lit(""))


_PYPI_URLS = "array<struct<packagetype:string,url:string>>"


def pypi_archive_url(meta: Column) -> Column:
    """URL of the last sdist, else of the first wheel, in `urls` or the version's release list."""
    listed = F.from_json(F.get_json_object(meta, "$.urls"), _PYPI_URLS)
    by_version = F.element_at(
        F.from_json(F.get_json_object(meta, "$.releases"), f"map<string,{_PYPI_URLS}>"),
        F.coalesce(F.get_json_object(meta, "$.info.version"), F.lit("")),
    )
    urls = F.when(F.size(listed) > 0, listed).otherwise(by_version)
    sdists = F.filter(urls, lambda u: u["packagetype"] == "sdist")
    wheels = F.filter(urls, lambda u: u["packagetype"] == "bdist_wheel")
    last_sdist = F.try_element_at(sdists, F.lit(-1))["url"]
    return F.coalesce(
        F.nullif(last_sdist, F.lit("")), F.get(F.filter(wheels, lambda w: w["url"].isNotNull()), F.lit(0))["url"]
    )


def archive_format(url: Column) -> Column:
    return F.when(F.endswith(url, F.lit(".whl")) | F.endswith(url, F.lit(".zip")), "zip").otherwise("tar.gz")


