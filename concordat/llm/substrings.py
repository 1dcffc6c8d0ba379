r"""Substring dedup: words that a window of 20 equal words already covers elsewhere go, with a count-min sketch as prefilter.

First pass: each piece of the table hashes its windows and sends the cells of its own sketch, by bucket of the hash, to be merged
with those of all other pieces. Counters stop at two, which is all that is asked. A window's estimate is the least of its counters in
two rows, never below its true count, so no repeated window is lost.

Second pass: windows estimated to repeat are hashed to 128 bits and grouped exactly; each group has one first occurrence, by
doc_id, then place in the table, then position. The piece that holds it is told so. Third, pieces drop the words covered by
candidates other than first occurrences.

A piece sends a window once however often it has it, and its first occurrence with it, so a passage that a third of all
documents share is one entry a piece in either pass. The sketch grows with the text: buckets hold a fixed number of windows.

Words are compared by 128-bit hashes of windows; equal hashes of different windows are not expected in any corpus that exists.

Defined cases: null and empty texts have no words; a text shorter than the window loses none; a null doc_id counts as the least; rows
of equal doc_id are ordered by their place in the table; equal rows keep a row each; an empty table gives an empty one; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.llm import packets
from concordat.session import pin

WINDOW = 20
SEGMENT_TEXT = 24 << 20  # bytes of text whose windows share a bucket of the sketch: about four million windows
CELL_BITS = 24  # cells in each of the sketch's two rows
BUCKET = 1 << 21  # candidate entries that are grouped together
_PACKET = "bucket int, part int, seq int, n int, data binary"
_KINDS = {"bucket": pa.int32(), "part": pa.int32(), "seq": pa.int32(), "n": pa.int32(), "data": pa.binary()}
_ANSWER = "part int, seq int, bucket int, found long, data binary"
_ANSWER_KINDS = {"part": pa.int32(), "seq": pa.int32(), "bucket": pa.int32(), "found": pa.int64(), "data": pa.binary()}
_LEAST = np.iinfo(np.int64).min
_U = np.uint64
_BASES = (_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F))


def rolling(h: np.ndarray, n: int, base: np.uint64) -> np.ndarray:
    """A hash of each run of n values: powers of the base, by doubling, then stirred."""
    run, size, power, out, have = h, 1, base, None, 0
    while True:
        if n & size:
            if out is None:
                out, have = run, size
            else:
                k = len(h) - have - size + 1
                out, have = out[:k] * power + run[have : have + k], have + size
        if size * 2 > n:
            break
        run = run[:-size] * power + run[size:]
        power, size = power * power, size * 2
    out = (out ^ (out >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    out = (out ^ (out >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return out ^ (out >> _U(33))


class Windows:
    """Words of a piece and the places at which its windows start."""

    def __init__(self, texts: pa.Array, window: int):
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = split.flatten().dictionary_encode()
        self.words = coded.dictionary
        index = coded.indices.to_numpy(zero_copy_only=False)
        # splitting leaves an empty word where a text begins or ends with white space
        blank = pc.index(self.words, pa.scalar("", pa.large_string())).as_py()
        if blank >= 0:
            full = index != blank
            total = np.zeros(len(full) + 1, np.int64)
            np.cumsum(full, out=total[1:])
            edges = np.concatenate([[0], np.cumsum(sizes)])
            sizes = total[edges[1:]] - total[edges[:-1]]
            index = index[full]
        self.window, self.index, self.counts = window, index, sizes
        self.first = np.cumsum(sizes) - sizes
        many = np.maximum(sizes - window + 1, 0)
        self.starts = np.arange(many.sum()) + np.repeat(self.first - (np.cumsum(many) - many), many)
        self.doc = np.repeat(np.arange(len(sizes)), many)

    def hashes(self, both: bool) -> list[np.ndarray]:
        """One or two 64-bit hashes of each window."""
        if not len(self.starts):
            return [np.zeros(0, np.uint64) for _ in range(1 + both)]
        raw = b"".join([xxhash.xxh3_128_digest(w) for w in self.words.to_pylist()])
        table = np.frombuffer(raw, "<u8").reshape(-1, 2)
        return [rolling(table[self.index, k], self.window, _BASES[k])[self.starts] for k in range(1 + both)]

    def covered(self, places: np.ndarray) -> np.ndarray:
        """Words that a window which starts at one of the places covers."""
        step = np.zeros(len(self.index) + self.window + 1, np.int64)
        np.add.at(step, places, 1)
        np.add.at(step, places + self.window, -1)
        return np.cumsum(step)[: len(self.index)] > 0


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> _U(32)) * _U(buckets)) >> _U(32)


def _keys(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and, in the low half, what its sketch sees of the hash."""
    return (_bucket(h, buckets) << _U(32)) | (h & _U(0xFFFFFFFF))


def _ranges(sorted_buckets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """bucket, start and end of each run."""
    cuts = [0, *(np.flatnonzero(np.diff(sorted_buckets)) + 1).tolist(), len(sorted_buckets)]
    for start, end in zip(cuts, cuts[1:], strict=False):
        if end > start:
            yield int(sorted_buckets[start]), start, end


def _send_cells(window: int, buckets: int, row: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    part, seq = packets.value(row, "part"), packets.value(row, "seq")
    (h,) = Windows(packets.listed(row, "texts"), window).hashes(False)
    keys, times = np.unique(_keys(h, buckets), return_counts=True)
    out = {k: [] for k in _KINDS}
    for bucket, start, end in _ranges(keys >> _U(32)):
        x = (keys[start:end] & _U(0xFFFFFFFF)).astype("<u4")
        twice = packets.bits(times[start:end] > 1)
        data = packets.squeezed(np.diff(x, prepend=np.uint32(0)))
        for name, v in zip(_KINDS, (bucket, part, seq, end - start, len(twice).to_bytes(4, "little") + twice + data), strict=True):
            out[name].append(v)
    yield packets.rows(out, _KINDS)


def cells(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The counter of each value in either row."""
    stirred = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    stirred = (stirred ^ (stirred >> np.uint32(12))) * np.uint32(0x297A2D39)
    return x >> np.uint32(32 - CELL_BITS), stirred >> np.uint32(32 - CELL_BITS)


def merge(sketch: np.ndarray, x: np.ndarray, twice: np.ndarray) -> None:
    """Adds a piece's distinct values to the sketch; counters stop at two."""
    for line, at in zip(sketch, cells(x), strict=True):
        line[at] = np.minimum(line[at] + 1, 2)
        line[at[twice]] = 2


def estimate(sketch: np.ndarray, x: np.ndarray) -> np.ndarray:
    a, b = cells(x)
    return np.minimum(sketch[0][a], sketch[1][b])


def _estimates(table: pa.Table) -> pa.Table:
    """All packets of a bucket: their sketches are merged, then each entry is told whether it may repeat."""
    sketch = np.zeros((2, 1 << CELL_BITS), np.uint8)
    sent = []
    for n, data in zip(table["n"].to_pylist(), table["data"].to_pylist(), strict=True):
        size = int.from_bytes(data[:4], "little")
        twice = packets.flags(data[4 : 4 + size], n)
        (gaps,) = packets.spread(data[4 + size :], n, "<u4")
        sent.append(np.cumsum(gaps, dtype=np.uint32))
        merge(sketch, sent[-1], twice)
    repeated = [estimate(sketch, x) > 1 for x in sent]
    return pa.table(
        [table["part"], table["seq"], table["bucket"], pa.array([int(r.sum()) for r in repeated], pa.int64()),
         pa.array([packets.bits(r) for r in repeated], pa.binary())], names=list(_ANSWER_KINDS))


class Candidates:
    """Windows of a piece that may repeat: distinct ones in order of their hash, each with its first occurrence."""

    def __init__(self, row: pa.RecordBatch, window: int, buckets: int, mail: packets.Mail):
        self.windows = w = Windows(packets.listed(row, "texts"), window)
        answers = mail.to(packets.value(row, "part"), packets.value(row, "seq"))
        h1, h2 = w.hashes(True)
        keys, inverse = np.unique(_keys(h1, buckets), return_inverse=True)
        told = [packets.flags(answers[b], end - start) for b, start, end in _ranges(keys >> _U(32))]
        self.at = np.flatnonzero(np.concatenate([*told, np.zeros(0, bool)])[inverse])
        h1, h2 = h1[self.at], h2[self.at]
        order = np.lexsort((h2, h1))  # stable, so the first of equal hashes is the first in the piece
        s1, s2 = h1[order], h2[order]
        new = np.ones(len(order), bool)
        new[1:] = (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])
        self.h1, self.h2, self.first = s1[new], s2[new], order[new]
        self.ids = packets.listed(row, "ids").fill_null(_LEAST).to_numpy(zero_copy_only=False)


def _send_candidates(window: int, buckets: int, flagged: str, groups: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    mail = packets.Mail(flagged)

    def send(row):
        c = Candidates(row, window, buckets, mail)
        doc = c.ids[c.windows.doc[c.at[c.first]]]
        out = {k: [] for k in _KINDS}
        for bucket, start, end in _ranges(_bucket(c.h1, groups)):
            data = packets.squeezed(np.diff(c.h1[start:end], prepend=_U(0)), c.h2[start:end], doc[start:end])
            for name, v in zip(_KINDS, (bucket, packets.value(row, "part"), packets.value(row, "seq"), end - start, data), strict=True):
                out[name].append(v)
        yield packets.rows(out, _KINDS)

    return packets.mapped(send, batches)


def _firsts(table: pa.Table) -> pa.Table:
    """All candidates of a bucket, grouped exactly: each entry is told whether it is the first of its group."""
    table = table.sort_by([("part", "ascending"), ("seq", "ascending")])
    sizes = table["n"].to_pylist()
    parts = [packets.spread(data, n, "<u8", "<u8", "<i8") for data, n in zip(table["data"].to_pylist(), sizes, strict=True)]
    h1 = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
    h2, doc = (np.concatenate([p[k] for p in parts]) for k in (1, 2))
    order = np.lexsort((doc, h2, h1))  # stable: equal documents stay in order of part, seq
    s1, s2 = h1[order], h2[order]
    new = np.ones(len(order), bool)
    new[1:] = (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])
    first = np.zeros(len(order), bool)
    first[order[new]] = True
    edges = np.cumsum([0, *sizes])
    told = [first[a:b] for a, b in zip(edges, edges[1:], strict=False)]
    return pa.table(
        [table["part"], table["seq"], table["bucket"], pa.array([int(t.sum()) for t in told], pa.int64()),
         pa.array([packets.bits(t) for t in told], pa.binary())], names=list(_ANSWER_KINDS))


_RESULT = "doc_id long, text string, n_words long, n_removed long, removed array<struct<start:int,end:int>>"
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def _cut(window: int, buckets: int, flagged: str, groups: int, firsts: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    may, is_first = packets.Mail(flagged), packets.Mail(firsts)

    def cut(row):
        c = Candidates(row, window, buckets, may)
        w = c.windows
        answers = is_first.to(packets.value(row, "part"), packets.value(row, "seq"))
        told = [packets.flags(answers[b], end - start) for b, start, end in _ranges(_bucket(c.h1, groups))]
        later = np.ones(len(c.at), bool)
        later[c.first[np.concatenate([*told, np.zeros(0, bool)])]] = False
        gone = w.covered(w.starts[c.at[later]])
        total = np.zeros(len(gone) + 1, np.int64)
        np.cumsum(gone, out=total[1:])
        ends = w.first + w.counts
        removed = total[ends] - total[w.first]
        left = np.concatenate([[0], np.cumsum(w.counts - removed)])
        kept = pa.LargeListArray.from_arrays(pa.array(left), w.words.take(pa.array(w.index[~gone])))
        # a run of removed words begins where the word before stays or is another document's
        doc = np.repeat(np.arange(len(w.counts)), w.counts)
        border = np.zeros(len(gone), bool)
        border[w.first[w.counts > 0]] = True
        begin = np.flatnonzero(gone & (border | ~np.concatenate([[False], gone[:-1]])[: len(gone)]))
        closing = np.concatenate([border[1:], [True]])[: len(gone)]
        finish = np.flatnonzero(gone & (closing | ~np.concatenate([gone[1:], [False]])[: len(gone)])) + 1
        owner = doc[begin]
        spans = pa.StructArray.from_arrays(
            [pa.array((begin - w.first[owner]).astype(np.int32)), pa.array((finish - w.first[owner]).astype(np.int32))], fields=list(_SPAN))
        offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(w.counts)))]).astype(np.int32)
        yield pa.record_batch(
            [packets.listed(row, "ids"), pc.binary_join(kept, pa.scalar(" ", pa.large_string())).cast(pa.string()), pa.array(w.counts), pa.array(removed),
             pa.ListArray.from_arrays(pa.array(offsets), spans)], ["doc_id", "text", "n_words", "n_removed", "removed"])

    return packets.mapped(cut, batches)


def without_repeats(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text", size: int = packets.PIECE,
                    segment_text: int = SEGMENT_TEXT, bucket: int = BUCKET) -> DataFrame:
    """doc_id, text (kept words, one space between), n_words, n_removed and removed (runs of words, end exclusive) of every row."""
    table = packets.pieces(docs, key, text, size)
    weight = table.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    buckets = 1 + weight // segment_text
    cell_packets = table.select("part", "seq", "texts").mapInArrow(partial(packets.mapped, partial(_send_cells, window, buckets)), _PACKET)
    repeated = pin(cell_packets.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_estimates, _ANSWER))
    flagged = packets.deliver(repeated, "repeated")
    groups = 1 + repeated.agg(F.coalesce(F.sum("found"), F.lit(0))).first()[0] // bucket
    found = table.select("part", "seq", "ids", "texts").mapInArrow(partial(_send_candidates, window, buckets, flagged, groups), _PACKET)
    firsts = packets.deliver(found.repartition(groups, "bucket").groupBy("bucket").applyInArrow(_firsts, _ANSWER), "firsts")
    return table.select("part", "seq", "ids", "texts").mapInArrow(partial(_cut, window, buckets, flagged, groups, firsts), _RESULT)
