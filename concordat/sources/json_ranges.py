"""Large JSON documents read in byte ranges: the entries of one array member, wherever the ranges fall.

A range cannot know whether it begins inside a string, nor how deep. So a first job looks at every range under both assumptions and
reports, a few numbers each, how strings and depth change over it; running sums per file say which assumption held. A second job then cuts
the entries out. An entry belongs to the range that holds the bracket or comma before it and is read on past the range's end. Both jobs
see bytes only; nothing is parsed until an entry is one JSON text.

No task holds more than a range and one entry, and entries carry their place in the array.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import partial
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concordat.session import pin, ship_package

RANGE = 16 << 20
_FIRST, _STEP = 1 << 12, 1 << 20  # bytes by which an entry is read on, at first and at most
_BEFORE = 4096  # bytes looked at before a range: a member's name, backslashes
HEAD, TAIL = -1, (1 << 63) - 1  # places of what stands before and after the entries
_KIND = np.zeros(256, np.int8)
for _c, _k in ((b"{", 1), (b"[", 1), (b"}", -1), (b"]", -1), (b",", 2)):
    _KIND[_c[0]] = _k


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system that a path is on, of those that pyarrow knows, and the path there."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def opened(path: str):
    """A file for reading by offset."""
    place, inner = located(path)
    return place.open_input_file(inner)


def _read(stream, start: int, size: int) -> np.ndarray:
    stream.seek(start)
    return np.frombuffer(stream.read(size), np.uint8)


def _slashes(data: np.ndarray, end: int) -> int:
    """Backslashes in a row that end just before a position."""
    n = 0
    while n < end and data[end - 1 - n] == 92:
        n += 1
    return n


def quotes(data: np.ndarray, first: int = 0) -> np.ndarray:
    """Places, from first on, of quotation marks that no backslash escapes; data may begin earlier."""
    at = np.flatnonzero(data[first:] == 34) + first
    escaped = (at > 0) & (data[at - 1] == 92)
    # One backslash is the common case; places after two or more are counted one by one.
    for i in np.flatnonzero(escaped & (at > 1) & (data[at - 2] == 92)).tolist():
        escaped[i] = _slashes(data, int(at[i])) % 2
    return at[~escaped]


def structures(data: np.ndarray, first: int, marks: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and kinds (1 opens, -1 closes, 2 comma) of what is outside strings, if data[first] is in none and if it is in one."""
    at = np.flatnonzero(_KIND[data[first:]]) + first
    odd = np.searchsorted(marks, at) % 2 == 1
    return [(out, _KIND[data[out]]) for out in (at[~odd], at[odd])]


def structure(data: np.ndarray, first: int, inside: int, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return structures(data, first, marks)[inside]


_LOOK = (
    "flips int, seen array<struct<delta:int,low:int,commas:array<struct<depth:int,n:bigint>>,"
    "marks:array<struct<at:bigint,depth:int,low:int,commas:array<struct<depth:int,n:bigint>>>>>>"
)
_HISTOGRAM = pa.list_(pa.struct([("depth", pa.int32()), ("n", pa.int64())]))
_SEEN = pa.list_(pa.struct([
    ("delta", pa.int32()), ("low", pa.int32()), ("commas", _HISTOGRAM),
    ("marks", pa.list_(pa.struct([("at", pa.int64()), ("depth", pa.int32()), ("low", pa.int32()), ("commas", _HISTOGRAM)])))]))


def _counted(depths: np.ndarray) -> list[dict]:
    values, n = np.unique(depths, return_counts=True)
    return [{"depth": d, "n": k} for d, k in zip(values.tolist(), n.tolist(), strict=True)]


def _look(member: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    named = re.compile(rb'"' + re.escape(member.encode()) + rb'"[ \t\r\n]*:[ \t\r\n]*\[')
    for batch in batches:
        flips, seen = [], []
        for path, start, length in zip(*[batch.column(c).to_pylist() for c in ("path", "start", "length")], strict=True):
            with opened(path) as stream:
                first = min(start, _BEFORE)
                data = _read(stream, start - first, first + length)
            marks = quotes(data, first)
            whole = data.tobytes()
            spans = [m.span() for m in named.finditer(whole)]
            brackets = np.array([b - 1 for a, b in spans if b > first and whole[a - 1 : a] != b"\\"], np.int64)
            both = []
            for at, kind in structures(data, first, marks):
                depth = np.cumsum(np.where(kind == 2, 0, kind))
                comma = kind == 2
                there = np.flatnonzero(np.isin(at, brackets, assume_unique=True))  # not within a string
                # Entries may have members of that name too. The depth at which the range begins will pick one depth, and there the first counts.
                found = [{"at": start - first + int(at[i]), "depth": int(depth[i]) - 1, "low": int(depth[i:].min()),
                          "commas": _counted(depth[i:][comma[i:]])} for i in there[np.unique(depth[there], return_index=True)[1]].tolist()]
                both.append({"delta": int(depth[-1]) if len(depth) else 0, "low": int(min(0, depth.min())) if len(depth) else 0,
                             "commas": _counted(depth[comma]), "marks": found})
            flips.append(len(marks) % 2)
            seen.append(both)
        yield pa.record_batch([*batch.columns, pa.array(flips, pa.int32()), pa.array(seen, _SEEN)], [*batch.schema.names, "flips", "seen"])


def _states(looked: DataFrame) -> DataFrame:
    """Ranges that hold entries, each with how it begins: in a string or not, how deep, and how many entries come before."""
    known = [c for c in looked.columns if c not in ("no", "flips", "seen")]
    w = Window.partitionBy("file").orderBy("no")
    before, all_of = w.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("file")
    none = F.lit(0)
    rows = looked.withColumn("inside", (F.coalesce(F.sum("flips").over(before), none) % 2).cast("int"))
    rows = rows.withColumn("s", F.get("seen", F.col("inside"))).drop("seen")
    rows = rows.withColumn("depth", F.coalesce(F.sum("s.delta").over(before), none).cast("int"))
    top = F.filter("s.marks", lambda m: m["depth"] + F.col("depth") == 1)
    rows = rows.withColumn("mark", F.get(top, 0))
    rows = rows.withColumn("from", F.min("mark.at").over(all_of))
    holds = F.col("from").between(F.col("start"), F.col("start") + F.col("length") - 1)
    rows = rows.withColumn("opens", F.coalesce(holds, F.lit(False)))
    after = F.col("from") < F.col("start")
    low = F.when(F.col("opens"), F.col("mark.low")).when(after, F.col("s.low")) + F.col("depth")
    rows = rows.withColumn("closes", F.coalesce(low <= 1, F.lit(False)))
    rows = rows.withColumn("over", F.coalesce(F.max("closes").over(before), F.lit(False)))
    counts = F.when(F.col("opens"), F.col("mark.commas")).when(after, F.col("s.commas"))
    here = F.aggregate(
        F.filter(counts, lambda c: c["depth"] + F.col("depth") == 2), F.lit(0).cast("long"), lambda a, c: a + c["n"])
    rows = rows.withColumn("commas", F.coalesce(F.sum(F.coalesce(here, F.lit(0).cast("long"))).over(before), F.lit(0).cast("long")))
    part = (F.col("opens") | after) & ~F.col("over")
    whole = F.col("from").isNull() & (F.col("no") == 0)
    return rows.where(part | whole).select(
        *known, "inside", "depth", "from", "opens", "closes", (F.col("commas") + 1).alias("next"))


def _cut(kept: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, row in enumerate(batch.to_pylist()):
            with opened(row["path"]) as stream:
                found = list(_entries(stream, row))
            if not found:
                continue
            ords = pa.concat_arrays([o if isinstance(o, pa.Array) else pa.array(o, pa.int64()) for o, _ in found])
            values = pa.concat_arrays([v if isinstance(v, pa.Array) else pa.array(v, pa.string()) for _, v in found])
            yield pa.record_batch([*(pa.repeat(batch.column(c)[i], len(ords)) for c in kept), ords, values], [*kept, "ord", "value"])


def _text(raw: bytes) -> str:
    return raw.decode("utf-8", "replace")


def _between(data: bytes, cuts: np.ndarray) -> pa.Array:
    """What stands between each two cuts, without white space around it."""
    piece = data[cuts[0] + 1 : cuts[-1] + 1]
    try:
        piece.decode()
    except UnicodeDecodeError:
        return pa.array([_text(data[a + 1 : b].strip()) for a, b in pairwise(cuts.tolist())], pa.string())
    ends = pa.py_buffer((cuts - cuts[0]).astype(np.int32))
    # Each piece has the comma that ends it, which no JSON text begins or ends with.
    return pc.ascii_trim(pa.StringArray.from_buffers(len(cuts) - 1, ends, pa.py_buffer(piece)), characters=" \t\n\r\x0b\x0c,")


def _entries(stream, row: dict) -> Iterator[tuple[Sequence[int], Sequence[str] | pa.Array]]:
    """Places and texts of entries, some at a time."""
    start, length, size = row["start"], row["length"], row["size"]
    if row["from"] is None:  # no such member: all of the document is its head
        yield [HEAD], [_text(_read(stream, 0, size).tobytes())]
        return
    ahead = min(start, _BEFORE)
    data = _read(stream, start - ahead, ahead + length)
    at, kind = structure(data, ahead, row["inside"], quotes(data, ahead))
    depth = row["depth"] + np.cumsum(np.where(kind == 2, 0, kind))
    offset = start - ahead
    region = at + offset >= row["from"] if row["opens"] else np.ones(len(at), bool)
    closing = np.flatnonzero(region & (kind == -1) & (depth == 1))
    end = int(at[closing[0]]) if len(closing) else None
    cuts = at[region & (kind == 2) & (depth == 2)]
    if end is not None:
        cuts = cuts[cuts < end]
    ords = np.arange(row["next"], row["next"] + len(cuts))
    if row["opens"]:
        yield [HEAD], [_text(_read(stream, 0, row["from"] + 1).tobytes())]
        cuts, ords = np.insert(cuts, 0, row["from"] - offset), np.arange(len(cuts) + 1)
    whole = data.tobytes()
    if len(cuts) > 1:
        values = _between(whole, cuts)
        full = pc.greater(pc.binary_length(values), 0)
        yield pa.array(ords[:-1]).filter(full), values.filter(full)
    if len(cuts):
        last = whole[int(cuts[-1]) + 1 : end]
        if end is None:
            last += _rest(stream, data, at, kind, depth, row, offset)
        if last.strip():
            yield [int(ords[-1])], [_text(last.strip())]
    if end is not None:
        yield [TAIL], [_text(_read(stream, end + offset, size - end - offset).tobytes())]


def _rest(stream, data: np.ndarray, at: np.ndarray, kind: np.ndarray, depth: np.ndarray, row: dict, offset: int) -> bytes:
    """What follows the range up to the end of its last entry."""
    inside = (row["inside"] + len(quotes(data, row["start"] - offset))) % 2
    level = int(depth[-1]) if len(depth) else row["depth"]
    place, out, step = row["start"] + row["length"], [], _FIRST
    while place < row["size"]:
        ahead = min(place, _BEFORE)
        more = _read(stream, place - ahead, ahead + step)
        step = min(4 * step, _STEP)
        marks = quotes(more, ahead)
        at, kind = structure(more, ahead, inside, marks)
        depth = level + np.cumsum(np.where(kind == 2, 0, kind))
        stop = np.flatnonzero(((kind == 2) & (depth == 2)) | ((kind == -1) & (depth == 1)))
        if len(stop):
            out.append(more[ahead : at[stop[0]]].tobytes())
            break
        out.append(more[ahead:].tobytes())
        inside, level = (inside + len(marks)) % 2, int(depth[-1]) if len(depth) else level
        place += len(more) - ahead
    return b"".join(out)


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(file, path, size) of every file under a path. Files are listed by Spark; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "[!_.]*").load(path)
    return files.select(F.col("_metadata.file_path").alias("file"), "path", F.col("length").alias("size"))


def plan(files: DataFrame, size: int = RANGE) -> DataFrame:
    """files(file, path, size and more) cut into byte ranges: no, start and length beside their columns."""
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(size).cast("long"))
    return files.select("*", F.posexplode(starts).alias("no", "start")).withColumns(
        {"no": F.col("no").cast("long"), "length": F.least(F.lit(size).cast("long"), F.col("size") - F.col("start"))})


def read_array(spark: SparkSession, path: str, member: str, size: int = RANGE) -> DataFrame:
    """(file, ord, value): the entries of a top-level array member of each document, in place order, as JSON text.

    ord HEAD has the document up to the array's opening bracket, ord TAIL the rest from its closing bracket on, so that HEAD and
    TAIL together are the document without entries. A document without such an array has a HEAD that is all of it.
    """
    return read_files(listed(spark, path), ["file"], member, size)


def read_files(files: DataFrame, keep: list[str], member: str, size: int = RANGE) -> DataFrame:
    """As read_array, of files(file, path, size and more); each entry has those of their columns that are to be kept."""
    spark = files.sparkSession
    ship_package(spark)
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranges = plan(files, size)
    types = {f.name: f"`{f.name}` {f.dataType.simpleString()}" for f in ranges.schema}
    looked = pin(ranges.repartition(tasks, "file", "no").mapInArrow(partial(_look, member), ", ".join([*types.values(), _LOOK])))
    return _states(looked).repartition(tasks, "file", "start").mapInArrow(
        partial(_cut, keep), ", ".join([*(types[c] for c in keep), "ord long, value string"]))
