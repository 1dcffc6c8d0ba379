"""Predicates on relative file paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from concordat import constants as C
from concordat.functions.text import any_of

PACKAGE_ROOT_MAX_SLASHES = 2


def top_dir(path: Column) -> Column:
    return F.substring_index(path, "/", 1)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def is_licence_file(path: Column) -> Column:
    return F.rlike(path, F.lit(C.LICENCE_FILE_PATTERN))


def is_root_licence(path: Column) -> Column:
    """Licence base name at most three segments deep, so `pkg/sub/LICENSE` still counts."""
    known = F.lower(base_name(path)).isin(*C.ROOT_LICENCE_NAMES)
    slashes = F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))
    return known & (slashes <= PACKAGE_ROOT_MAX_SLASHES)


def is_source_file(path: Column) -> Column:
    return F.rlike(path, F.lit(rf"(?i)\.({'|'.join(C.SOURCE_EXTENSIONS)})$"))


def is_noise_dir(name: Column) -> Column:
    return any_of(F.startswith(name, F.lit(m)) | F.endswith(name, F.lit(m)) for m in C.NOISE_MARKS)


def strip_prefix(path: Column, prefix: Column) -> Column:
    return F.when(
        (prefix != "") & F.startswith(path, prefix), F.substring(path, F.length(prefix) + 1, F.length(path))
    ).otherwise(path)
