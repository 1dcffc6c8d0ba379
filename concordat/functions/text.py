"""Text predicates, redaction, encoding and small string helpers (all Catalyst expressions)."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark import SparkContext
from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column
from pyspark.sql import functions as F

from concordat import constants as C


LINE_BREAK = r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85\u2028\u2029]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and use it many times in `body`.

    Higher-order functions are not deduplicated by code generation, so a value repeated in
    nested conditions would be recomputed for each mention.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(col: Column) -> Column:
    return F.trim(col, F.lit(C.UNICODE_SPACE))


def or_default(col: Column, default: str) -> Column:
    """Null and '' both read as the default."""
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(default))


def any_of(tests: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def contains_any(col: Column, needles: Iterable[str]) -> Column:
    return any_of(F.contains(col, F.lit(n)) for n in needles)


def decode_utf8(blob: Column) -> Column:
    """Bytes to text; malformed sequences become U+FFFD instead of failing the task."""
    return F.make_valid_utf8(blob.cast("string"))


def is_plausible_licence(text: Column) -> Column:
    head = F.lower(F.left(text, F.lit(C.TEXT_HEAD_CHARS)))
    ok = (
        (F.length(text) >= C.MIN_TEXT_CHARS)
        & ~contains_any(head, C.HTML_MARKS)
        & contains_any(head, C.LICENCE_WORDS)
    )
    return F.coalesce(ok, F.lit(False))


def is_probe_content(blob: Column) -> Column:
    """Byte-length and markup test for a single fetched file."""
    head = F.lower(decode_utf8(F.substring(blob, 1, C.PROBE_HEAD_BYTES)))
    ok = (F.octet_length(blob) >= C.MIN_PROBE_BYTES) & ~contains_any(head, C.HTML_MARKS)
    return F.coalesce(ok, F.lit(False))


def usable_patterns(extra: Iterable[str]) -> list[str]:
    """User patterns in order; blank lines, # comments and those that Spark's regex engine rejects are left out."""
    kept = []
    engine = SparkContext._active_spark_context._jvm.java.util.regex.Pattern
    for line in extra:
        line = line.strip()
        if not line or line.startswith("#"):
            continue
        try:
            engine.compile(line)
        except IllegalArgumentException:
            continue
        kept.append(line)
    return kept


def redact_paths(col: Column, extra: Iterable[str] = ()) -> Column:
    patterns = [f"(?U){p}" for p in C.PATH_PATTERNS] + usable_patterns(extra)
    return reduce(lambda c, p: F.regexp_replace(c, F.lit(p), F.lit(C.REDACTED)), patterns, col)


def redact_all(cols: Column, extra: Iterable[str] = ()) -> Column:
    return F.transform(cols, lambda x: redact_paths(x, extra))


def encode_text(text: Column) -> Column:
    """Base64 of the UTF-8 bytes on one line."""
    return F.translate(F.base64(F.encode(text, "UTF-8")), "\r\n", "")


def decode_text(encoded: Column) -> Column:
    """Null when the input is not base64."""
    return decode_utf8(F.try_to_binary(encoded, F.lit("base64")))


def content_key(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *parts), 256)


def shorten(col: Column, limit: int = C.RATIONALE_CHARS) -> Column:
    return F.when(F.length(col) > limit, F.concat(F.left(col, F.lit(limit)), F.lit("..."))).otherwise(col)


def quoted(col: Column) -> Column:
    """Render a string the way reports quote it: single quotes unless it holds one."""
    plain = F.replace(col, F.lit("\\"), F.lit("\\\\"))
    single = F.contains(col, F.lit("'"))
    double = F.contains(col, F.lit('"'))
    return (
        F.when(single & ~double, F.concat(F.lit('"'), plain, F.lit('"')))
        .otherwise(F.concat(F.lit("'"), F.replace(plain, F.lit("'"), F.lit("\\'")), F.lit("'")))
    )


def head_lines(text: Column, n: int) -> Column:
    """First n lines; a line break at the very end opens no further line."""

    def cut(parts: Column) -> Column:
        ends_open = (F.size(parts) <= n) & (F.try_element_at(parts, F.lit(-1)) == "")
        return F.slice(parts, F.lit(1), F.when(ends_open, F.size(parts) - 1).otherwise(F.lit(n)))

    # The limit stops the split after the lines asked for, however long the text.
    return let(F.split(text, LINE_BREAK, n + 1), cut)


def partition_safe(name: Column) -> Column:
    return F.translate(name, "/ ", "__")
