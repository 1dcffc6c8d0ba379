"""Token ids of documents in compressed files, in ascending doc_id order.

Documents are dealt by ranges of doc_id; each task sorts its range, encodes it with the tokenizer's library and writes
one file, a group of blocks at a time (see rangecoder), so a task holds one batch of texts and one group of ids. A file
appears under its name when it is whole; a task that runs again writes the same bytes to the same name. The manifest
is the table of what the tasks report, and offsets over all files come from it.

File: "IDF1"; groups, each after its length; a zero length; the index (doc_id, null flag, ids per document), its length
and "1FDI". Read from the end, the index says which ids belong to which document.

Defined cases: null text is empty, so its document has the end id only; null doc_ids come first; rows of equal doc_id
are ordered by their texts; an empty table makes no rows; other columns are not read.
"""

from __future__ import annotations

import contextlib
import re
import struct
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concordat.llm import packets, rangecoder, storage
from concordat.llm.bpe import CACHE, Pieces, distinct_words
from concordat.session import pin, ship_package

END_ID = 2
FILE_TEXT = 32 << 20  # bytes of text that a file is meant to hold
AT_ONCE = 4 << 20  # bytes of text that are encoded together
BATCH = 1000  # rows that a worker is given together
_LENGTH = "<Q"


# Printing ASCII without the sign that opens added tokens, and composed Latin letters that lower-case one by one.
_PLAIN = re.compile("[!-;=-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]*")


class _Remembered(dict):
    """What make gives for each key that was asked for; bounded, then it forgets them all."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        made = self.make(key)
        if len(self) >= CACHE:
            self.clear()
        self[key] = made
        return made


class Encoder:
    """Ids of words by the tokenizers library. Plain words skip its normaliser, which they would leave as they are."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.cutter = Pieces(path)
        del self.cutter.model  # the library has its own
        self.known = _Remembered(self._piece)

    def _piece(self, piece: str) -> bytes:
        # printing ASCII stands for itself
        tokens = self.library.model.tokenize(piece if piece.isascii() else self.cutter.mapped(piece))
        return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])

    def word(self, word: str) -> bytes:
        """The word's ids as unsigned 32-bit numbers."""
        known, lower = self.known, word.lower()
        # Most words are letters, or letters and one mark; the pattern would cut them just so.
        letters = lower.isalpha()
        if letters and word.isascii():
            return known[lower]
        if not _PLAIN.fullmatch(word):
            return np.array(self.library.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if letters:
            return known[lower]
        if lower[:-1].isalpha() and lower[-1] in ".,!?;:":
            return known[lower[:-1]] + known[lower[-1]]
        return b"".join([known[piece] for piece in self.cutter.cut.findall(lower)])

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a batch in order, and the number of ids of each text."""
        words, index, bounds = distinct_words(texts)
        if not len(index):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        lists = list(map(self.word, words))
        sizes = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
        flat = np.frombuffer(b"".join(lists), "<u4")
        del lists, words
        first = np.cumsum(sizes) - sizes
        per_word = sizes[index]
        ends = np.cumsum(per_word)
        kind = np.int32 if ends[-1] < 1 << 31 else np.int64
        take = np.repeat((first[index] - (ends - per_word)).astype(kind), per_word)
        take += np.arange(int(ends[-1]), dtype=kind)
        edges = np.concatenate([[0], ends])
        return flat[take], edges[bounds[1:]] - edges[bounds[:-1]]


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> np.ndarray:
    """The ids with the end id after those of each document."""
    return np.insert(ids, np.cumsum(counts), np.uint32(end))


_encoders: dict[str, Encoder] = {}
_MANIFEST = "part int, file string, documents long, ids long, bytes long, crc long"
_MANIFEST_NAMES = ["part", "file", "documents", "ids", "bytes", "crc"]


class _File:
    """Puts groups and the index to a stream and keeps count."""

    def __init__(self, out, group: int):
        self.out, self.group = out, group
        self.held: list[np.ndarray] = []
        self.waiting = self.ids = self.size = self.crc = 0
        self.index: list[np.ndarray] = []
        self.put(b"IDF1")

    def put(self, data: bytes):
        self.out.write(data)
        self.size += len(data)
        self.crc = zlib.crc32(data, self.crc)

    def add(self, docs: pa.Array, counts: np.ndarray, ids: np.ndarray):
        missing = docs.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
        self.index.append(np.stack([docs.fill_null(0).to_numpy(zero_copy_only=False), missing, counts]))
        self.held.append(ids)
        self.waiting += len(ids)
        self.ids += len(ids)
        self.flush(self.group)

    def flush(self, least: int):
        while self.waiting >= least:
            ids = np.concatenate(self.held)
            coded = rangecoder.encode_group(ids[: self.group])
            self.put(struct.pack(_LENGTH, len(coded)))
            self.put(coded)
            self.held, self.waiting = [ids[self.group :]], max(0, len(ids) - self.group)

    def end(self) -> int:
        self.flush(1)
        table = np.concatenate(self.index, axis=1).astype("<i8")
        packed = zlib.compress(table.tobytes(), 6)
        self.put(struct.pack(_LENGTH, 0))
        self.put(packed)
        self.put(struct.pack(_LENGTH, len(packed)) + b"1FDI")
        return table.shape[1]


def _write(path: str, folder: str, end: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batches = (b for b in batches if b.num_rows)
    batch = next(batches, None)
    if batch is None:
        return
    encoder = _encoders.get(path) or _encoders.setdefault(path, Encoder(path))
    task = TaskContext.get()
    part = task.partitionId()
    uri = f"{folder}/ids-{part:06d}.idf"
    with storage.writing(uri, str(task.taskAttemptId())) as out:
        file = _File(out, rangecoder.LANES * rangecoder.BLOCK)
        while batch is not None:
            for docs, texts in packets.gathered(iter([batch]), AT_ONCE):
                ids, counts = encoder.texts(texts)
                file.add(docs, counts + 1, with_end(ids, counts, end))
            del docs, texts, ids, counts
            batch = next(batches, None)
        documents = file.end()
    row = [[part], [uri], [documents], [file.ids], [file.size], [file.crc]]
    kinds = [pa.int32(), pa.string(), *[pa.int64()] * 4]
    yield pa.record_batch([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], _MANIFEST_NAMES)


@contextlib.contextmanager
def _small_batches(spark: SparkSession):
    """Texts go to the workers by BATCH rows; Spark's 10,000 are a whole file's texts, held twice beside the encoder."""
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(limit)
    spark.conf.set(limit, str(BATCH))
    try:
        yield
    finally:
        spark.conf.set(limit, before)


def write_ids(docs: DataFrame, tokenizer: str, folder: str | None = None, end: int = END_ID, file_text: int = FILE_TEXT) -> DataFrame:
    """Writes the files and returns the manifest, a table with start: the ids of all files before."""
    ship_package(docs.sparkSession)
    folder = folder or storage.new_folder(docs.sparkSession, "ids")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    ranged = rows.repartitionByRange(max(1, -(-size // file_text)), F.col("doc_id"), F.xxhash64("text"))
    # Where equal doc_ids meet a border between files, the hash comes first; within a file likewise, so order is one.
    ordered = ranged.sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    with _small_batches(docs.sparkSession):
        manifest = pin(ordered.mapInArrow(partial(_write, tokenizer, folder, end), _MANIFEST))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)).cast("long"))


def read_file(uri: str) -> tuple[np.ndarray, Iterator[np.ndarray]]:
    """The index and the ids, group by group, of one file."""
    stream = storage.reading(uri)
    size = stream.size()
    stream.seek(size - 12)
    tail = stream.read(12)
    if tail[8:] != b"1FDI":
        raise ValueError(f"{uri} is not whole")
    (packed,) = struct.unpack(_LENGTH, tail[:8])
    stream.seek(size - 12 - packed)
    index = np.frombuffer(zlib.decompress(stream.read(packed)), "<i8").reshape(3, -1)

    def groups():
        stream.seek(4)
        while True:
            (n,) = struct.unpack(_LENGTH, stream.read(8))
            if not n:
                return
            yield rangecoder.decode_group(stream.read(n))

    return index, groups()


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
            index, groups = read_file(uri)
            counts = index[2]
            first = np.cumsum(counts) - counts
            crcs = np.zeros(len(counts), np.int64)
            doc, left, crc = 0, int(counts[0]), 0
            for ids in groups:
                data, at, n = memoryview(ids.astype("<u4").tobytes()), 0, len(ids)
                while at < n:
                    step = min(left, n - at)
                    crc = zlib.crc32(data[4 * at : 4 * (at + step)], crc)
                    at, left = at + step, left - step
                    if not left:
                        crcs[doc], crc, doc = crc, 0, doc + 1
                        left = int(counts[doc]) if doc < len(counts) else -1
            if doc != len(counts):
                raise ValueError(f"{uri} lacks ids")
            yield pa.record_batch(
                [pa.array(index[0], pa.int64(), mask=index[1] > 0), pa.array(first + start), pa.array(counts), pa.array(crcs)],
                ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_ids(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    ship_package(manifest.sparkSession)
    files = manifest.select("file", "start").repartition(manifest.sparkSession.sparkContext.defaultParallelism * 4, "file")
    return files.mapInArrow(_reader, "doc_id long, start long, n_tokens long, ids_crc32 long")
