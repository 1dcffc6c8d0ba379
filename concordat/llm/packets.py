"""Pieces of a table, and letters between them and the tasks that answer.

A piece is a row with some megabytes of documents, written once, so that every job sees the same piece however Spark splits the
files. It sends one packet per bucket of a hash; whoever has the bucket sees the packets of all pieces and answers each. Answers
are a bit or a number per entry of the packet. They are sorted by the piece's part (the task that wrote it) and put into one file a
part in the shared folder, so that texts are not shuffled to meet them.

Packets hold distinct entries only: a value that a third of all documents have is one entry a piece.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.llm import storage
from concordat.session import pin, ship_package

PIECE = 3 << 20  # bytes of text a piece is meant to hold; a longer document is a piece of its own
LETTER = "part int, seq int, bucket int, data binary"


def gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Array, pa.Array]]:
    """The columns doc_id and text, cut anew so that texts come to the size or, for a single long one, more."""
    held: list[tuple[pa.Array, pa.Array]] = []
    weight = 0

    def whole():
        return tuple(pa.concat_arrays([h[k] for h in held]) for k in (0, 1))

    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text")
        start = 0
        for i, n in enumerate(pc.binary_length(texts).to_pylist()):
            if weight and weight + n > size:
                held.append((ids.slice(start, i - start), texts.slice(start, i - start)))
                yield whole()
                held, weight, start = [], 0, i
            weight += n
        held.append((ids.slice(start), texts.slice(start)))
    if weight or any(len(h[0]) for h in held):
        yield whole()


def one(values: pa.Array) -> pa.Array:
    """A column of one row that holds all the values as a list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _gather(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    for seq, (ids, texts) in enumerate(gathered(batches, size)):
        # null is the least id; rows of one id stay in the order of the table
        order = np.lexsort((ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_valid().to_numpy(zero_copy_only=False)))
        ids, texts = ids.take(pa.array(order)), texts.take(pa.array(order))
        weight = pc.sum(pc.binary_length(texts)).as_py() or 0
        yield pa.record_batch(
            [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([weight], pa.int64()), one(ids), one(texts)],
            ["part", "seq", "bytes", "ids", "texts"])


def text_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = PIECE) -> DataFrame:
    """part, seq, bytes, ids and texts: the documents in pieces, each sorted by id, as a written table."""
    ship_package(docs.sparkSession)
    return pin(text_rows(docs, key, text).mapInArrow(
        partial(_gather, size), "part int, seq int, bytes long, ids array<bigint>, texts array<string>"))


def squeezed(*columns: np.ndarray) -> bytes:
    """Arrays of one length, each as planes of bytes, compressed."""
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.dtype.itemsize).T.tobytes() for c in columns]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def spread(data: bytes, n: int, *kinds: str) -> list[np.ndarray]:
    """What squeezed() was given: n values of each kind."""
    if not n:
        return [np.zeros(0, k) for k in kinds]
    widths = [np.dtype(k).itemsize for k in kinds]
    raw = np.frombuffer(pa.decompress(data, decompressed_size=n * sum(widths), codec="zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for kind, width in zip(kinds, widths, strict=True):
        out.append(np.ascontiguousarray(raw[at : at + n * width].reshape(width, n).T).view(kind).reshape(n))
        at += n * width
    return out


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def flags(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def rows(columns: dict[str, list], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(columns[k], t) for k, t in kinds.items()], list(kinds))


def mapped(fn: Callable[..., Iterator[pa.RecordBatch]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Calls fn with each row, given as a batch of one."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield from fn(batch.slice(i, 1))


def value(row: pa.RecordBatch, name: str):
    return row.column(name)[0].as_py()


def listed(row: pa.RecordBatch, name: str) -> pa.Array:
    return row.column(name)[0].values


def _post(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    attempt = str(TaskContext.get().taskAttemptId())
    open_part, stream, writer, count = None, None, None, 0

    def closed():
        writer.close()
        stream.__exit__(None, None, None)
        return rows({"part": [open_part], "letters": [count]}, {"part": pa.int32(), "letters": pa.int64()})

    for batch in batches:
        parts = batch.column("part").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if start == end:
                continue
            if parts[start] != open_part:
                if writer is not None:
                    yield closed()
                open_part, count = int(parts[start]), 0
                stream = storage.writing(f"{folder}/{open_part}.arrow", attempt)
                writer = pa.ipc.new_stream(stream.__enter__(), batch.schema)
            writer.write_batch(batch.slice(start, end - start))
            count += end - start
    if writer is not None:
        yield closed()


def deliver(answers: DataFrame, name: str) -> str:
    """Writes answers (the columns of LETTER) to one file a part and returns their folder."""
    folder = storage.new_folder(answers.sparkSession, name)
    letters = answers.select("part", "seq", "bucket", "data").repartition("part").sortWithinPartitions("part", "seq", "bucket")
    pin(letters.mapInArrow(partial(_post, folder), "part int, letters long"))
    return folder


class Mail:
    """Reads the answers to a piece; remembers one part's file."""

    def __init__(self, folder: str):
        self.folder = folder
        self.part: int | None = None
        self.found: dict[int, dict[int, bytes]] = {}

    def to(self, part: int, seq: int) -> dict[int, bytes]:
        """Bucket to answer."""
        if part != self.part:
            self.found = {}
            try:
                with storage.reading(f"{self.folder}/{part}.arrow") as f:
                    for batch in pa.ipc.open_stream(f):
                        for s, b, d in zip(batch.column("seq").to_pylist(), batch.column("bucket").to_pylist(), batch.column("data").to_pylist(), strict=True):
                            self.found.setdefault(s, {})[b] = d
            except FileNotFoundError:  # nothing was sent from there; a missing answer is an error where it is looked for
                pass
            self.part = part
        return self.found.get(seq, {})
