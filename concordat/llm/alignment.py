"""Cross-tokenizer alignment: which ids of one tokenizer say the same bytes as which ids of another.

The cumulative byte ends of either side's tokens are put into dictionaries from end to index. The ends both have, sorted, slice the
two id lists into groups; inside a slice every two tokens whose bytes overlap are linked.

The first tokenizer is a byte-level one whose merges are numbered like its ids (its file is looked at first), for which tiktoken, given
the file's own vocabulary, makes the same ids in a fraction of the time; any other goes through the tokenizers library.

Counts of linked id pairs are corpus-wide. Pieces send their distinct pairs with counts by bucket of the pair, are answered the sums
(packets.py), and the highest sum per id of the second tokenizer comes from the buckets' own maxima: at most one row per vocabulary
entry, which is the bound on what the driver sees.

Defined cases: null and empty texts, and texts that the tokens of either side do not spell byte for byte, have no tokens: zeros and
an empty digest; null doc_ids and equal rows keep a row each; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import partial
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.llm import packets
from concordat.llm.bpe import byte_symbols
from concordat.session import pin, ship_package

PIECE = 2 << 20
BUCKET = 1 << 20  # entries of pairs that are summed together
_AT_ONCE = 1 << 18  # bytes of text that are encoded together
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
_SPACE = "▁"
# Fixed value: how byte-level tokenizers cut a text before they merge.
_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LONG_BLANK = re.compile(r"\s{1000}")


def sliced(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int]]:
    """Where the groups of two token lists end: ends that both have, looked up in either side's dictionary from end to index."""
    at_a = dict(zip(ends_a, range(1, len(ends_a) + 1), strict=True))
    at_b = dict(zip(ends_b, range(1, len(ends_b) + 1), strict=True))
    common = list(compress(at_a, map(at_b.__contains__, at_a)))  # in the order of the ends, which rise
    return list(map(at_a.__getitem__, common)), list(map(at_b.__getitem__, common))


def linked(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of linked tokens. Inside a slice every end of either side closes the overlap of one pair, so each end is one link."""
    every = np.union1d(ends_a, ends_b)
    return np.searchsorted(ends_a, every), np.searchsorted(ends_b, every)


def align(ids_a: list[int], ids_b: list[int], sizes_a: list[int], sizes_b: list[int]) -> tuple[list[tuple[list[int], list[int]]], list[tuple[int, int]]]:
    """Groups of ids, and linked ids, of two token lists over the same bytes; sizes are bytes per token, at least one."""
    ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    cut_a, cut_b = sliced(ends_a.tolist(), ends_b.tolist())
    i, j = linked(ends_a, ends_b)
    groups = [(ids_a[p:q], ids_b[r:t]) for p, q, r, t in zip([0, *cut_a], cut_a, [0, *cut_b], cut_b, strict=False)]
    return groups, list(zip(np.array(ids_a)[i].tolist(), np.array(ids_b)[j].tolist(), strict=True))


class Pair:
    """Two tokenizers and the bytes of their ids."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        self.path_a, self.library = path_a, None
        real = {c: i for i, c in enumerate(byte_symbols())}
        names = dict(sorted((i, t) for t, i in spec["model"]["vocab"].items()) + [(t["id"], t["content"]) for t in spec["added_tokens"]])
        spelt = {i: bytes(real[c] for c in t) if t and all(c in real for c in t) else t.encode() for i, t in names.items()}
        self.bytes_a = [spelt.get(i, b"") for i in range(max(names) + 1)]
        self.fast = self._ranked(spec, {t["id"] for t in spec["added_tokens"] if t["special"]})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = _BYTE.fullmatch(piece)
            self.bytes_b.append(bytes([int(byte[1], 16)]) if byte else piece.replace(_SPACE, " ").encode())
        self.size_a, self.size_b = (np.array(list(map(len, x))) for x in (self.bytes_a, self.bytes_b))
        # how an id is written before another of its group, as the first side's last, and as the second side's last
        self.shown = [f"{i}{mark}" for i in range(max(len(self.bytes_a), len(self.bytes_b))) for mark in ",|;"]

    def _ranked(self, spec: dict, special: set[int]):
        """tiktoken's encoder over the file's vocabulary, if ids of merged tokens are in the order of their merges."""
        import tiktoken

        model, cutter = spec["model"], spec["pre_tokenizer"] or {}
        vocab, joined = model["vocab"], ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        ranks = [vocab.get(j) for j in joined]
        plain = (
            model["type"] == "BPE" and not spec["normalizer"] and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
            and cutter.get("type") == "ByteLevel" and cutter.get("use_regex") and not cutter.get("add_prefix_space")
            and None not in ranks and ranks == sorted(ranks) and len(set(ranks)) == len(ranks) and {c for c in byte_symbols()} <= vocab.keys()
            and min(ranks, default=256) >= 256 and len(vocab) - len(special & set(vocab.values())) == 256 + len(ranks)
        )
        if not plain:
            return None
        words = {self.bytes_a[i]: i for i in vocab.values() if i not in special}
        return tiktoken.Encoding("aligned", pat_str=_PATTERN, mergeable_ranks=words, special_tokens={})

    def first(self, text: str) -> list[int]:
        # A very long run of white space would exhaust the pattern matcher's steps.
        if self.fast is not None and not (len(text) > 100_000 and _LONG_BLANK.search(text)):
            return self.fast.encode_ordinary(text)
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path_a)
            self.library.encode_special_tokens = True
        return self.library.encode(text, add_special_tokens=False).ids

    def written(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> str:
        """a1,a2|b1;a3|b2,b3"""
        out = np.empty(len(a) + len(b), np.int64)
        start_a, start_b = np.concatenate([[0], cut_a[:-1]]), np.concatenate([[0], cut_b[:-1]])
        for ids, cuts, start, before, last in ((a, cut_a, start_a, start_b, 1), (b, cut_b, start_b, cut_a, 2)):
            code = ids * 3
            code[cuts - 1] += last
            # a token comes after its own side's earlier ones and the other side's up to its group
            out[np.arange(len(ids)) + np.repeat(before, cuts - start)] = code
        return "".join(map(self.shown.__getitem__, out.tolist()))[:-1]

    def encoded(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None]:
        """Ids and cumulative byte ends on either side per text; None without tokens."""
        for text, b in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            a, want = self.first(" " + text) if text else [], (" " + text).encode()
            x, y = np.array(a, np.int64), np.array(b, np.int64)
            ends_a, ends_b = np.cumsum(self.size_a[x]), np.cumsum(self.size_b[y])
            spelt = text and ends_a[-1] == ends_b[-1] == len(want) and b"".join(map(self.bytes_b.__getitem__, b)) == want
            if spelt and b"".join(map(self.bytes_a.__getitem__, a)) == want:
                yield x, y, ends_a, ends_b
            else:
                yield None


_pairs: dict[tuple[str, str], Pair] = {}


def _pair(path_a: str, path_b: str) -> Pair:
    return _pairs.get((path_a, path_b)) or _pairs.setdefault((path_a, path_b), Pair(path_a, path_b))


def _each(pair: Pair, texts: pa.Array):
    """encoded() for a few texts at a time."""
    for _, few in packets.gathered(iter([pa.record_batch([pa.nulls(len(texts), pa.int64()), texts], ["doc_id", "text"])]), _AT_ONCE):
        yield from pair.encoded(few.to_pylist())


def _groups(path_a: str, path_b: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pair = _pair(path_a, path_b)
    kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
    for batch in batches:
        for ids, texts in packets.gathered(iter([batch]), PIECE):
            out = []
            for found in _each(pair, texts):
                if found is None:
                    out.append([])
                    continue
                a, b, ends_a, ends_b = found
                cut_a, cut_b = sliced(ends_a.tolist(), ends_b.tolist())
                a, b = a.tolist(), b.tolist()
                out.append([{"a": a[p:q], "b": b[r:t]} for p, q, r, t in zip([0, *cut_a], cut_a, [0, *cut_b], cut_b, strict=False)])
            yield pa.record_batch([ids, pa.array(out, kind)], ["doc_id", "groups"])


def groups(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and groups: the ids of the first (a) and of the second tokenizer (b) that cover the same bytes, in order."""
    ship_package(docs.sparkSession)
    return packets.text_rows(docs, key, text).mapInArrow(
        partial(_groups, path_a, path_b), "doc_id long, groups array<struct<a:array<int>,b:array<int>>>")


_INT, _LONG = pa.int32(), pa.int64()
_TABLE = {
    "part": _INT, "seq": _INT, "entries": _LONG,
    "ids": pa.list_(_LONG), "n_a": pa.list_(_INT), "n_b": pa.list_(_INT), "n_groups": pa.list_(_INT), "n_links": pa.list_(_INT), "digest": pa.list_(pa.string()),
    # links of all documents as places in the distinct pairs of the piece, which come with their counts
    "links": pa.binary(), "pairs": pa.binary(),
}
_TABLE_DDL = (
    "part int, seq int, entries long, ids array<bigint>, n_a array<int>, n_b array<int>, n_groups array<int>, n_links array<int>, digest array<string>, "
    "links binary, pairs binary"
)


def _aligned(path_a: str, path_b: str, size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, pair = TaskContext.get().partitionId(), _pair(path_a, path_b)
    for seq, (ids, texts) in enumerate(packets.gathered(batches, size)):
        figures, codes = [], [np.zeros(0, np.int64)]
        for found in _each(pair, texts):
            if found is None:
                figures.append((0, 0, 0, 0, ""))
                continue
            a, b, ends_a, ends_b = found
            cut_a, cut_b = sliced(ends_a.tolist(), ends_b.tolist())
            text = pair.written(a, b, np.array(cut_a), np.array(cut_b))
            i, j = linked(ends_a, ends_b)
            codes.append(a[i] << 32 | b[j])
            figures.append((len(a), len(b), len(cut_a), len(i), hashlib.sha256(text.encode()).hexdigest()))
        place, distinct = pd.factorize(np.concatenate(codes))
        n = np.bincount(place, minlength=len(distinct))
        a, b, g, many, digests = zip(*figures, strict=True)
        columns = {
            "part": part, "seq": seq, "entries": len(distinct), "ids": ids, "n_a": a, "n_b": b, "n_groups": g, "n_links": many, "digest": digests,
            "links": packets.squeezed(place.astype("<u4")),
            "pairs": packets.squeezed((distinct >> 32).astype("<u4"), (distinct & 0xFFFFFFFF).astype("<u4"), n.astype("<u8")),
        }
        yield pa.record_batch(
            [pa.array([v], t) if not pa.types.is_list(t) else packets.one(v if isinstance(v, pa.Array) else pa.array(v, t.value_type))
             for v, t in ((columns[k], t) for k, t in _TABLE.items())], list(_TABLE))


_PACKET = "bucket int, part int, seq int, n int, data binary"
_KINDS = {"bucket": _INT, "part": _INT, "seq": _INT, "n": _INT, "data": pa.binary()}


def _numbers(row: pa.RecordBatch, name: str) -> np.ndarray:
    return packets.listed(row, name).to_numpy(zero_copy_only=False).astype(np.int64)


def _dealt(row: pa.RecordBatch, buckets: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """Pairs that occur, sorted by bucket, their ids, and each bucket's run."""
    kinds = ("<u4", "<u4", "<u8")
    a, b, n = (x.astype(np.int64) for x in packets.spread(packets.value(row, "pairs"), packets.value(row, "entries"), *kinds))
    h = (a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    bucket = (((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
    live = np.flatnonzero(n > 0)
    order = live[np.argsort(bucket[live], kind="stable")]
    cuts = [0, *(np.flatnonzero(np.diff(bucket[order])) + 1).tolist(), len(order)]
    runs = [(int(bucket[order[s]]), s, e) for s, e in zip(cuts, cuts[1:], strict=False) if e > s]
    return order, np.stack([a, b, n]), runs


def _send(buckets: int, row: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    order, (a, b, n), runs = _dealt(row, buckets)
    part, seq = packets.value(row, "part"), packets.value(row, "seq")
    out = {k: [] for k in _KINDS}
    for bucket, start, end in runs:
        at = order[start:end]
        data = packets.squeezed(a[at].astype("<u4"), b[at].astype("<u4"), n[at].astype("<u8"))
        for name, v in zip(_KINDS, (bucket, part, seq, end - start, data), strict=True):
            out[name].append(v)
    yield packets.rows(out, _KINDS)


_SUMS = "part int, seq int, bucket int, data binary, sums array<struct<a:int,b:int,n:bigint>>"
_SUM = pa.list_(pa.struct([("a", _INT), ("b", _INT), ("n", _LONG)]))


def _sums(table: pa.Table) -> pa.Table:
    """All packets of a bucket: each entry is told its pair's sum. The first row has the sums themselves."""
    sizes = table["n"].to_pylist()
    parts = [packets.spread(d, n, "<u4", "<u4", "<u8") for d, n in zip(table["data"].to_pylist(), sizes, strict=True)]
    a, b, n = (np.concatenate([p[k] for p in parts]).astype(np.int64) for k in range(3))
    distinct, place = np.unique(a << 32 | b, return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, place, n)
    edges = np.cumsum([0, *sizes])
    told = [packets.squeezed(total[place[s:e]].astype("<u8")) for s, e in zip(edges, edges[1:], strict=False)]
    sums = pa.StructArray.from_arrays([pa.array(distinct >> 32, _INT), pa.array(distinct & 0xFFFFFFFF, _INT), pa.array(total)], fields=list(_SUM.value_type))
    offsets = np.full(len(sizes) + 1, len(distinct), np.int32)
    offsets[0] = 0
    return pa.table(
        [table["part"], table["seq"], table["bucket"], pa.array(told, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), sums)],
        names=["part", "seq", "bucket", "data", "sums"])


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _runs(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of the given sizes."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def _scored(buckets: int, folder: str, tops: tuple[np.ndarray, np.ndarray], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    _pairs.clear()  # a worker that has aligned before needs its tokenizers no more
    mail = packets.Mail(folder)

    def score(row):
        order, (a, b, _), runs = _dealt(row, buckets)
        answers = mail.to(packets.value(row, "part"), packets.value(row, "seq"))
        count, best = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        for bucket, start, end in runs:
            (got,) = packets.spread(answers[bucket], end - start, "<u8")
            count[order[start:end]] = got
        live = count > 0
        best[live] = count[live] == tops[1][np.searchsorted(tops[0], b[live])]
        many = _numbers(row, "n_links")
        (of,) = packets.spread(packets.value(row, "links"), int(many.sum()), "<u4")
        per_doc = [pa.array(_runs(v[of], many)) for v in (best, count)]
        plain = [packets.listed(row, k).cast(_LONG) for k in ("n_a", "n_b", "n_groups", "n_links")]
        yield pa.record_batch(
            [packets.listed(row, "ids"), *plain, *per_doc, packets.listed(row, "digest")],
            ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return packets.mapped(score, batches)


def links(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", size: int = PIECE, bucket: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """Two tables.

    Documents: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256. Pairs: a, b, n (links corpus-wide) and
    best (n is the highest of its b), from which ids of one tokenizer can be translated to the other's.
    """
    spark = docs.sparkSession
    ship_package(spark)
    table = pin(packets.text_rows(docs, key, text).mapInArrow(partial(_aligned, path_a, path_b, size), _TABLE_DDL))
    buckets = 1 + table.agg(F.coalesce(F.sum("entries"), F.lit(0))).first()[0] // bucket
    sent = table.select("part", "seq", "entries", "pairs").mapInArrow(partial(packets.mapped, partial(_send, buckets)), _PACKET)
    answers = pin(sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_sums, _SUMS))
    folder = packets.deliver(answers, "sums")
    sums = answers.select(F.inline("sums"))
    highest = sums.groupBy("b").agg(F.max("n").alias("top"))  # no more rows than the second vocabulary has
    top = np.array([tuple(r) for r in highest.collect()], np.int64).reshape(-1, 2)
    top = top[np.argsort(top[:, 0])]
    per_doc = table.mapInArrow(partial(_scored, buckets, folder, (top[:, 0], top[:, 1])), _RESULT)
    pairs = sums.join(F.broadcast(highest), "b").select("a", "b", "n", (F.col("n") == F.col("top")).alias("best"))
    return per_doc, pairs
