"""Token counts by byte-pair merging that keeps no identifiers.

A piece is a linked list of symbols and a heap of its adjacent pairs. The pair of lowest rank (the leftmost of
equals) is popped and merged, its two new neighbours are pushed, and so on until no pair has a rank. The count is
the number of first symbols less the number of merges.

Each text is counted where it lies, batch by batch, so work is row by row and nothing is shuffled. Distinct words of a
batch are counted once. Defined cases: null text is empty and has no tokens; repeated rows and null ids keep
a row each; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.llm.bpe import CACHE, Pieces, distinct_words, per_text
from concordat.session import ship_package

LIMIT = 2048


class Merger:
    """Counts the tokens of words for one tokenizer file."""

    def __init__(self, path: str):
        self.cutter = Pieces(path)
        self.ranks = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(self.cutter.model["merges"])}
        vocab, suffix = self.cutter.model["vocab"], self.cutter.suffix
        if any(s not in vocab or s + suffix not in vocab for s in self.cutter.table.values()):
            raise ValueError("the vocabulary lacks a byte")
        self.known: dict[str, int] = {}

    def merged(self, piece: str) -> int:
        symbols = list(self.cutter.mapped(piece))
        n = len(symbols)
        symbols[-1] += self.cutter.suffix
        if n == 1:
            return 1
        rank = self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := rank((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue  # one of the two has been merged since
            merges += 1
            symbols[i], symbols[j] = a + b, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank((symbols[i], symbols[k]))) is not None:
                    heapq.heappush(heap, (r, i, symbols[i], symbols[k]))
            h = before[i]
            if h >= 0 and (r := rank((symbols[h], symbols[i]))) is not None:
                heapq.heappush(heap, (r, h, symbols[h], symbols[i]))
        return n - merges

    def count(self, word: str) -> int:
        total, known = 0, self.known
        for added, piece in self.cutter.parts(word):
            if added is not None:
                total += 1
                continue
            n = known.get(piece)
            if n is None:
                if len(known) >= CACHE:
                    known.clear()
                n = known[piece] = self.merged(piece)
            total += n
        return total


_mergers: dict[str, Merger] = {}


def _count(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    merger = _mergers.get(path) or _mergers.setdefault(path, Merger(path))
    for batch in batches:
        texts = batch.column("text")
        words, index, bounds = distinct_words(texts)
        each = np.fromiter(map(merger.count, words), np.int64, len(words))
        tokens = per_text(each[index], bounds) if len(words) else np.zeros(len(texts), np.int64)
        size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
        yield pa.record_batch([batch.column("doc_id"), size, pa.array(tokens)], ["doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row; tokenizer is the path of a json file on every machine."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(partial(_count, tokenizer), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
