"""What the token operators share: word pieces of a byte-pair tokenizer's json file, found per distinct word.

Runs inside tasks. Texts are cut at ASCII white space, which no piece crosses; each distinct word of a batch is
then looked at once, and pieces are kept in a cache of bounded size.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

CACHE = 1 << 19  # pieces that a worker remembers; then it forgets them all


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if it prints, else the next one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + rest.index(b)) for b in range(256)]


class Pieces:
    """Reads a tokenizer file and cuts words into normalised, byte-level pieces."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = spec["normalizer"]["normalizers"]
        kinds = [s["type"] for s in steps]
        cuts = spec["pre_tokenizer"]["pretokenizers"]
        if kinds != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cuts] != ["Split", "ByteLevel"]:
            raise ValueError(f"{path}: a tokenizer with other steps than NFC, spaces, lower case, split, bytes")
        self.model = spec["model"]
        self.suffix = self.model["end_of_word_suffix"] or ""
        self.cut = regex.compile(cuts[0]["pattern"]["Regex"])
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added_ids = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None
        self.table = dict(enumerate(byte_symbols()))

    def pieces(self, plain: str) -> list[str]:
        """Pieces of text without added tokens, before bytes are mapped."""
        if not plain.isascii():
            plain = unicodedata.normalize("NFC", plain).replace("Σ", "σ")  # no final sigma: characters one by one
        return self.cut.findall(plain.lower())

    def parts(self, word: str):
        """Yields (added token, None) and (None, piece) in order."""
        if self.added is None or "<" not in word:
            for p in self.pieces(word):
                yield None, p
            return
        for part in self.added.split(word):
            if part in self.added_ids:
                yield part, None
            elif part:
                for p in self.pieces(part):
                    yield None, p

    def mapped(self, piece: str) -> str:
        return piece.encode("utf-8").decode("latin-1").translate(self.table)


def distinct_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, the number of each word of the batch, and where each text's words begin (with the end)."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    flat = split.flatten()
    lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    bounds = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=bounds[1:])
    whole = flat.dictionary_encode()
    words, index = whole.dictionary.to_numpy(zero_copy_only=False).tolist(), whole.indices.to_numpy(zero_copy_only=False)
    # Splitting gives an empty first or last word where a text begins or ends with white space.
    return words, index, bounds


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
