"""Adaptive context-mixing range coder for token ids, many blocks abreast.

A group of blocks is coded together: each block is a lane of numpy vectors, so a step codes one id of every block.
Blocks never look at each other. Each starts from a fresh model, has its own words and CRC, and can be decoded alone.

The model of a block guesses ids from its last two (order 2), its last one (order 1) and from none (order 0).
Orders 2 and 1 guess what followed the same context before, with a confidence that rises when the guess comes true.
Order 0 counts the block's frequent ids: a table whose entries are replaced in turn unless they have come back since. Its share is
divided by these counts. What is left is a fixed curve over the vocabulary, lower ids being more common, for ids not in the table.
The weights of all three are learned while the block is read. A 64-bit range coder turns the intervals into 32-bit words; carries
run back through words already put out.

Group: head (symbols, symbols per block, symbols an id, bound of symbols, bytes of words, CRC of what follows in the head), words and CRC
per block, then the words.
"""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache

import numpy as np

BLOCK = 2048
LANES = 2048
BOUND = 1 << 18  # larger ids, below 2^30, go as two symbols each
_SLOTS = 2048
_FREQUENT = 16  # entries of the order-0 table
_HALVE = 64  # steps after which counts are halved
_HEAD = struct.Struct("<4sIIIIII")
_HALF = 15  # bits of the lower symbol of an id that goes as two
_NONE = np.uint32(0xFFFFFFFC)  # no id, no confidence
_EMPTY = np.uint32(0xFFFFFFFF)
_ONE, _TWO, _THREE = np.uint32(1), np.uint32(2), np.uint32(3)
_Q_LOW, _Q2_HIGH, _Q1_HIGH = 64, 63488, 57344  # of 65536
_Q0_LOW, _Q0_HIGH = 2048, 61440
_BYTE, _LAST = np.uint8(1), np.uint8(_FREQUENT - 1)
_ENTRY = np.arange(1, _FREQUENT + 1, dtype=np.uint8)[:, None]
_U = np.uint64
_S32, _LIMIT = _U(32), _U(1 << 32)


@lru_cache(maxsize=4)
def curve(bound: int) -> tuple[np.ndarray, int]:
    """Where each id's share of the fixed curve begins, with the end, and the logarithm of the whole."""
    bits = max(bound.bit_length() + 1, 8)
    weight = (1 << 32) // (np.arange(bound, dtype=np.int64) + 256)
    share = 1 + weight * ((1 << bits) - bound) // int(weight.sum())
    share[0] += (1 << bits) - int(share.sum())
    return np.concatenate([[0], np.cumsum(share)]), bits


@lru_cache(maxsize=4)
def _owner(bound: int) -> np.ndarray:
    edge, _ = curve(bound)
    return np.repeat(np.arange(bound, dtype=np.uint32), np.diff(edge))


class _Model:
    """Guesses and their weights for all lanes. A table entry is an id and, in its last two bits, a confidence."""

    def __init__(self, lanes: int, bits: int):
        self.base = np.arange(lanes, dtype=np.int64) * _SLOTS
        self.bin = np.arange(lanes, dtype=np.int64) * 4
        self.lane = np.arange(lanes)
        self.guess = [np.full(lanes * _SLOTS, _NONE, np.uint32) for _ in range(2)]
        self.weight = [np.full(lanes * 4, 8192, np.int64) for _ in range(2)]
        self.last = np.zeros(lanes, np.uint32)
        self.mark = np.zeros(lanes, np.uint32)
        # The table's entries are rows 1 to _FREQUENT; row 0 stands for no entry. Counts of a lane never add up to more than 144
        # (they grow by one a step and are halved every 64), so bytes hold them and their sums.
        self.lanes = lanes
        self.ids = np.full((_FREQUENT, lanes), _EMPTY, np.uint32)
        self.count = np.zeros((_FREQUENT + 1, lanes), np.uint8)
        self.below = np.zeros((_FREQUENT + 2, lanes), np.uint8)  # of an entry in its row, and the sum of all in the last
        self.sums = list(zip(self.below[1:], self.count[1:], self.below[2:], strict=False))
        self.same = np.empty((_FREQUENT, lanes), bool)
        self.named = np.empty((_FREQUENT, lanes), np.uint8)
        self.q0 = np.full(lanes, 16384, np.int64)
        self.step = 0
        # order 2 may take 31/32, order 1 7/8 of the rest, order 0 15/16 of that; the curve still has its 2^bits
        self.unit = bits + 13
        self.total = 1 << self.unit

    def look(self):
        """Guesses of order 2 and order 1, the ends of their shares, the end of the table's, and the share of the curve."""
        before, self.mark = self.mark, self.last * np.uint32(2654435761)
        self.at2 = self.base + ((self.mark ^ (before >> np.uint32(7))) >> np.uint32(21)).astype(np.int64)
        self.at1 = self.base + (self.mark >> np.uint32(21)).astype(np.int64)
        self.g2, self.g1 = self.guess[0].take(self.at2), self.guess[1].take(self.at1)
        self.i2, self.i1 = self.bin + (self.g2 & _THREE).astype(np.int64), self.bin + (self.g1 & _THREE).astype(np.int64)
        self.w2, self.w1 = self.weight[0].take(self.i2), self.weight[1].take(self.i1)
        m2 = self.w2 << (self.unit - 16)
        left = self.total - m2
        both = m2 + ((left * self.w1) >> 16)
        rest = self.total - both
        for below, count, more in self.sums:
            np.add(below, count, out=more)
        share = (rest * self.q0) >> 16
        # shares are below 2^30, so floating point divides them exactly
        self.each = (share.astype(np.float64) / np.maximum(self.below[-1], _BYTE).astype(np.float64)).astype(np.int64)
        return self.g2 >> _TWO, self.g1 >> _TWO, m2, both, both + share, rest - share

    def interval(self, ids, hit2, hit1, m2, both, table, rest, edge, above, bits):
        """Start and end of each id's interval. hit2, hit1: whether order 2 guessed the id, or else order 1."""
        np.equal(self.ids, ids, out=self.same)
        entry = np.multiply(self.same.view(np.uint8), _ENTRY, out=self.named)
        for half in (8, 4, 2, 1):
            entry = np.maximum(entry[:half], entry[half : 2 * half], out=entry[:half])
        self.held = entry[0] > 0
        self.sure2, self.sure1, self.sure0 = _mask(hit2), _mask(hit1), _mask(self.held)
        place = entry[0].astype(np.int64) * self.lanes + self.lane
        first = both + self.below.take(place).astype(np.int64) * self.each
        last = first + self.count.take(place).astype(np.int64) * self.each
        at = ids.astype(np.int64)
        start = _either(self.sure0, first, table + ((edge.take(at) * rest) >> bits))
        end = _either(self.sure0, last, table + ((above.take(at) * rest) >> bits))
        start = _either(self.sure1, m2, start) & ~self.sure2
        return start, _either(self.sure2, m2, _either(self.sure1, both, end))

    def learn(self, ids, hit2, right1):
        """After interval; right1: whether order 1 guessed the id, order 2 or not."""
        q2, q1 = self.w2, self.w1
        self.weight[0][self.i2] = q2 + (((self.sure2 & (_Q2_HIGH - _Q_LOW)) + _Q_LOW - q2) >> 5)
        self.weight[1][self.i1] = q1 + ((((self.sure1 & (_Q1_HIGH - _Q_LOW)) + _Q_LOW - q1) >> 5) & ~self.sure2)
        fresh = ids << _TWO
        for table, at, g, right in ((self.guess[0], self.at2, self.g2, hit2), (self.guess[1], self.at1, self.g1, right1)):
            wrong = _either(np.negative((g >> _ONE) & _ONE), g - _TWO, fresh)
            table[at] = _either(np.negative(right.astype(np.uint32)), np.minimum(g + _ONE, g | _THREE), wrong)
        self.last = ids
        # only ids that came to order 0 say what it is worth
        self.q0 += (((self.sure0 & (_Q0_HIGH - _Q0_LOW)) + _Q0_LOW - self.q0) >> 5) & ~(self.sure2 | self.sure1)
        counts = self.count[1:]
        counts += self.same.view(np.uint8)
        turn = self.step % _FREQUENT
        old, entry = counts[turn], self.ids[turn]
        weak = old <= 1
        entry ^= (entry ^ ids) & np.negative((weak > self.held).astype(np.uint32))
        fewer = _either(np.negative(weak.view(np.uint8)), _BYTE, old >> _BYTE)
        old[:] = _either(np.negative(self.held.view(np.uint8)), old, fewer)
        self.step += 1
        if self.step % _HALVE == 0:
            counts += _BYTE
            counts >>= _BYTE


def _mask(true: np.ndarray) -> np.ndarray:
    """All bits of a 64-bit number where true."""
    return np.negative(true.astype(np.int64))


def _either(mask, yes, no):
    """yes where the mask has all bits, no where it has none: what np.where gives, without its branches."""
    return no ^ ((no ^ yes) & mask)


def encode_group(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """Ids (below 2^30, any number from 1 on) as one group of blocks."""
    each = 1
    if int(ids.max()) >= BOUND:
        if int(ids.max()) >= 1 << 30:
            raise ValueError("the coder takes ids below 2^30")
        ids, each, block = np.stack([ids >> _HALF, ids & ((1 << _HALF) - 1)], 1).astype(np.uint32).reshape(-1), 2, 2 * block
    n = len(ids)
    lanes, bound = -(-n // block), int(ids.max()) + 1
    edge, bits = curve(bound)
    above = edge[1:]
    size = min(block, n)
    padded = np.full(lanes * size, ids[-1], np.uint32)
    padded[:n] = ids
    checks = np.fromiter((zlib.crc32(ids[i : i + size].astype("<u4").tobytes()) for i in range(0, n, size)), np.uint32, lanes)
    rows = np.ascontiguousarray(padded.reshape(lanes, size).T)
    del padded
    model = _Model(lanes, bits)
    low, span = np.zeros(lanes, _U), np.full(lanes, 0xFFFFFFFFFFFFFFFF, _U)
    out = np.zeros((lanes, size + 3), np.uint32)
    flat, row = out.reshape(-1), np.arange(lanes) * (size + 3)
    used = np.zeros(lanes, np.int64)
    unit = _U(model.unit)
    for x in rows:
        e2, e1, m2, both, table, rest = model.look()
        hit2, same1 = e2 == x, e1 == x
        start, end = model.interval(x, hit2, same1 > hit2, m2, both, table, rest, edge, above, bits)
        step = span >> unit
        moved = low + start.astype(_U) * step
        carry = np.flatnonzero(moved < low)
        if len(carry):
            _carry(out, used, carry)
        low, span = moved, (end - start).astype(_U) * step
        full = span < _LIMIT
        some = np.flatnonzero(full)
        if len(some):
            flat[row.take(some) + used.take(some)] = low.take(some) >> _S32
            used += full.astype(np.int64)
            shift = full.astype(_U) << _U(5)
            low <<= shift
            span <<= shift
        model.learn(x, hit2, same1)
    for _ in range(2):
        out[np.arange(lanes), used] = low >> _S32
        used += 1
        low = low << _S32
    words = b"".join(out[i, : used[i]].astype("<u4").tobytes() for i in range(lanes))
    places = used.astype("<u4").tobytes() + checks.astype("<u4").tobytes()
    return _HEAD.pack(b"CMR2", n, size, each, bound, len(words), zlib.crc32(places)) + places + words


def _carry(out: np.ndarray, used: np.ndarray, lanes: np.ndarray) -> None:
    place = used[lanes] - 1
    while len(lanes):
        out[lanes, place] += np.uint32(1)
        more = out[lanes, place] == 0
        lanes, place = lanes[more], place[more] - 1


def group_size(head: bytes) -> int:
    """Bytes of the group after its first HEAD bytes."""
    magic, n, size, _, _, words, _ = _HEAD.unpack(head)
    if magic != b"CMR2":
        raise ValueError("not a group of coded ids")
    return 8 * -(-n // size) + words


HEAD = _HEAD.size


def decode_group(data: bytes, blocks: list[int] | None = None) -> np.ndarray:
    """The ids of a group, or of some of its blocks; raises ValueError if the checksum of one that is read is wrong."""
    _, n, size, each, bound, _, check = _HEAD.unpack_from(data)
    lanes, at = -(-n // size), HEAD
    if zlib.crc32(data[at : at + 8 * lanes]) != check:
        raise ValueError("the group's head is damaged")
    used = np.frombuffer(data, "<u4", lanes, at).astype(np.int64)
    checks = np.frombuffer(data, "<u4", lanes, at + 4 * lanes)
    wanted = np.arange(lanes) if blocks is None else np.array(blocks, np.int64)
    lengths = np.minimum(size, n - wanted * size)
    edge, bits = curve(bound)
    above, owner = edge[1:], _owner(bound)
    words = np.concatenate([np.frombuffer(data, "<u4", offset=at + 8 * lanes), np.zeros(2, np.uint32)]).astype(_U)
    place = (np.cumsum(used) - used)[wanted]
    lanes = len(wanted)
    code = (words[place] << _S32) | words[place + 1]
    place += 2
    model = _Model(lanes, bits)
    span = np.full(lanes, 0xFFFFFFFFFFFFFFFF, _U)
    unit, top = _U(model.unit), np.int64(model.total - 1)
    rows = np.empty((size, lanes), np.uint32)
    for t in range(size):
        e2, e1, m2, both, table, rest = model.look()
        step = span >> unit
        v = np.minimum((code // step).astype(np.int64), top)
        # both sides are below 2^53 and the quotient far from the next whole number, so floating point is exact
        slot = ((((v - table + 1) << bits) - 1) / rest).astype(np.int64)
        x = owner.take(slot, mode="clip")
        within = ((v - both).astype(np.float64) / np.maximum(model.each, 1).astype(np.float64))
        within = np.minimum(np.maximum(within, 0.0), 255.0).astype(np.uint8)
        ended = np.less_equal(model.below[2:], within, out=model.same).view(np.uint8)
        for half in (8, 4, 2, 1):
            ended = np.add(ended[:half], ended[half : 2 * half], out=model.named[:half])
        entry = np.minimum(ended[0], _LAST).astype(np.int64) * lanes + model.lane
        x = _either(np.negative((v < table).astype(np.uint32)), model.ids.take(entry), x)
        hit2, guessed = v < m2, v < both
        x = _either(np.negative(guessed.astype(np.uint32)), e1, x)
        x = _either(np.negative(hit2.astype(np.uint32)), e2, x)
        np.minimum(x, np.uint32(bound - 1), out=x)  # damaged data may name ids that are none
        start, end = model.interval(x, hit2, guessed > hit2, m2, both, table, rest, edge, above, bits)
        code = code - start.astype(_U) * step
        span = np.maximum((end - start).astype(_U) * step, _U(1))
        full = span < _LIMIT
        some = np.flatnonzero(full)
        if len(some):
            code[some] = (code.take(some) << _S32) | words.take(place.take(some), mode="clip")  # damaged data may run over
            place += full.astype(np.int64)
            span <<= full.astype(_U) << _U(5)
        model.learn(x, hit2, e1 == x)
        rows[t] = x
    parts = np.ascontiguousarray(rows.T)
    for i, block in enumerate(wanted.tolist()):
        if zlib.crc32(parts[i, : lengths[i]].astype("<u4").tobytes()) != checks[block]:
            raise ValueError(f"block {block} is damaged")
    ids = parts[np.arange(size) < lengths[:, None]]
    return ids if each == 1 else (ids[::2] << np.uint32(_HALF)) | ids[1::2]
