r"""Quality rules that look at lines first, in column functions only.

Each line with a word is held against rules of three kinds, and lines that fail one are removed:

punctuation  a tenth of its characters or more are of #*$%&|<>; or "!!" follows every third word or more, three
             times at least; or it has one or two words and ends without a closing mark
navigation   two bars, guillemets or bullets or more between short pieces (one to every six words or more); or up to
             60 characters that begin with the words of a menu
boilerplate  up to 200 characters with a phrase of cookie banners, script notices, share buttons or filler text

A document is rejected if it loses more than max_lost of its characters in this way, or if it fails the base
rules: under 20 words, or over 30 % of its words in eight-word windows that occur twice or more in it.

Blank lines neither fail nor count as lost. Defined cases: null text is empty and fails the base rule; a text without
lines to judge loses nothing; documents are judged one by one, so repeated rows and null ids make no difference; an
empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.llm.common import SPACE, packed, words

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30
MAX_LOST = 0.5

# Fixed phrases of menus and of page furniture.
MENU = (
    "home", "menu", "log in", "login", "sign in", "sign up", "register", "subscribe", "next page", "previous page", "next",
    "previous", "read more", "click here", "skip to content", "back to top", "contact us", "about us", "site map", "search",
)
FURNITURE = (
    "cookie policy", "uses cookies", "use cookies", "accept all cookies", "enable javascript", "javascript is disabled",
    "privacy policy", "terms of use", "terms of service", "all rights reserved", "share on facebook", "share on twitter",
    "follow us on", "leave a comment", "lorem ipsum", "powered by",
)


def _phrases(phrases: tuple[str, ...]) -> str:
    return "(?:" + "|".join(p.replace(" ", r"\s+") for p in phrases) + ")"


_MENU = r"(?i)^[\x20\t]*" + _phrases(MENU) + r"(?![\p{L}\p{N}])(?:[^\p{L}]|" + _phrases(MENU) + r")*$"
_FURNITURE = r"(?i)\b" + _phrases(FURNITURE) + r"\b"
_CLOSED = r"[.!?…:;。！？][\"'”’»)\]]*[\x20\t\r]*$"


def _times(text: Column, pattern: str) -> Column:
    """Characters of a one-character pattern in a text."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def line_fails(line: Column) -> Column:
    size = F.length(line)
    count = F.size(F.split(F.btrim(line, F.lit(" \t\x0b\x0c\r")), SPACE))
    shouts = F.floor((size - F.length(F.replace(line, F.lit("!!"), F.lit("")))) / 2)
    bars = _times(line, "[|»›•·]")
    return (
        (_times(line, SYMBOLS) * 10 >= size)
        | ((shouts >= 3) & (shouts * 3 >= count))
        | ((count <= 2) & ~line.rlike(_CLOSED))
        | ((bars >= 2) & (bars * 6 >= count))
        | ((size <= 60) & line.rlike(_MENU))
        | ((size <= 200) & line.rlike(_FURNITURE))
    )


def assess(docs: DataFrame, text: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """_doc (the row) with _clean (its text without failing lines), counts, base_failed and kept.

    Columns beside _doc: _n_words, _word_chars, _n_symbols, _n_dup_lines, _n_repeat_words, _base_failed, _lost_chars,
    _judged_chars, _n_failed_lines, _clean, _kept. Work is row by row; nothing is shuffled.
    """
    t = F.coalesce(F.col("_doc").getField(text), F.lit(""))
    df = docs.select(packed(docs)).withColumn("_words", words(t)).withColumn("_lines", F.split(t, "\n"))
    df = df.withColumn("_full", F.filter("_lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = df.withColumn("_hash", F.transform("_words", lambda w: F.xxhash64(w)))
    windows = F.transform(
        F.sequence(F.lit(0), F.size("_hash") - WINDOW),
        lambda i: F.xxhash64(*[F.get("_hash", i + k) for k in range(WINDOW)]),
    )
    df = df.select(
        "_doc", "_lines",
        F.size("_words").cast("long").alias("_n_words"),
        F.length(F.regexp_replace(t, SPACE, "")).cast("long").alias("_word_chars"),
        _times(t, SYMBOLS).cast("long").alias("_n_symbols"),
        (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long").alias("_n_dup_lines"),
        F.when(F.size("_hash") > WINDOW, windows).alias("_at"),
    )
    # Texts in which no window comes back, nearly all of them, end here; the others sort their windows.
    df = df.withColumn("_at", F.when(F.size(F.array_distinct("_at")) < F.size("_at"), F.col("_at")))
    df = df.withColumn("_at", F.array_sort(F.transform("_at", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.withColumn("_at", F.array_sort(F.transform(
        F.filter("_at", lambda x, i: (x["h"] == F.get("_at", i - 1)["h"]) | (x["h"] == F.get("_at", i + 1)["h"])),
        lambda x: x["i"],
    )))
    step = F.transform("_at", lambda p, i: F.coalesce(F.least(F.get("_at", i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
    df = df.withColumn("_n_repeat_words", F.coalesce(F.aggregate(step, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long"))
    df = df.withColumn("_good", F.filter("_lines", lambda x: ~x.rlike(r"[^\x20\x09-\x0D]") | ~line_fails(x)))
    df = df.withColumn("_clean", F.array_join("_good", "\n"))
    lost = F.length(t) - F.length("_clean") - (F.size("_lines") - F.size("_good"))
    base = (F.col("_n_words") < MIN_WORDS) | (100 * F.col("_n_repeat_words") > MAX_REPEATED * F.col("_n_words"))
    judged = (F.length(t) - F.size("_lines") + 1).cast("long")
    found = {
        **{c: F.col(c) for c in ("_n_words", "_word_chars", "_n_symbols", "_n_dup_lines", "_n_repeat_words", "_clean")},
        "_base_failed": base, "_lost_chars": F.greatest(lost, F.lit(0)).cast("long"), "_judged_chars": judged,
        "_n_failed_lines": (F.size("_lines") - F.size("_good")).cast("long"),
        "_kept": ~base & (F.greatest(lost, F.lit(0)) <= F.lit(max_lost) * judged),
    }
    # One struct out of a generator: a filter on the verdict stays above it, and the rules are evaluated once.
    one = F.explode_outer(F.array(F.struct(*[v.alias(k) for k, v in found.items()]))).alias("_found")
    return df.select("_doc", one).select("_doc", "_found.*")


def clean(docs: DataFrame, max_lost: float = MAX_LOST) -> DataFrame:
    """The documents that are kept, without their failing lines; same columns, n_chars follows the text."""
    kept = assess(docs, max_lost=max_lost).where("_kept")
    doc = F.col("_doc").withField("text", F.col("_clean"))
    if "n_chars" in docs.columns:
        doc = doc.withField("n_chars", F.length("_clean").cast("long"))
    return kept.withColumn("_doc", doc).select("_doc.*")
