"""Byte ranges in NumPy: vectorised hashes, exact comparison and an open-addressed table of distinct ranges."""

from __future__ import annotations

import zlib

import numpy as np
import xxhash

from starloom.llm.common import ALNUM_WORDS, LOWER

# The five primes of xxhash64.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
_LANES = [((1 << 64) + v) % (1 << 64) for v in (int(_P1) + int(_P2), int(_P2), 0, -int(_P1))]


# Fixed value: the reflected polynomial of crc32. Table k advances a byte's remainder over k further bytes.
_CRC_POLYNOMIAL = np.uint32(0xEDB88320)


def _crc_tables() -> np.ndarray:
    out = np.zeros((8, 256), np.uint32)
    out[0] = np.arange(256)
    for _ in range(8):
        out[0] = np.where(out[0] & 1, (out[0] >> 1) ^ _CRC_POLYNOMIAL, out[0] >> 1)
    for k in range(1, 8):
        out[k] = (out[k - 1] >> 8) ^ out[0][out[k - 1] & 255]
    return out


_CRC = _crc_tables()


def _crc_step(tables: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The remainder of the four bytes of ``number``, of which ``tables`` holds the tables in byte order."""
    return (tables[0][number & 255] ^ tables[1][(number >> 8) & 255]
            ^ tables[2][(number >> 16) & 255] ^ tables[3][number >> 24])


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc: np.ndarray | np.uint64, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * _P2, 31) * _P1


class Bytes:
    """A byte buffer that can be read as little-endian numbers at any position."""

    def __init__(self, data: np.ndarray):
        padded = np.zeros(len(data) + 8, np.uint8)
        padded[: len(data)] = data
        self.data = padded
        self.u64 = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
        self.u32 = np.ndarray((len(data) + 1,), "<u4", padded, strides=(1,))

    def _by_length(self, start: np.ndarray, length: np.ndarray, vector, single, kind) -> np.ndarray:
        """``vector`` of the ranges of each length; ranges of rare, great lengths one by one by ``single``."""
        out = np.empty(len(start), kind)
        narrow = length.astype(np.uint16) if length.max(initial=0) < 1 << 16 else length  # sorted by radix
        order = np.argsort(narrow, kind="stable")
        edges = np.flatnonzero(np.diff(length[order], prepend=-1, append=-1))
        for lo, hi in zip(edges[:-1], edges[1:]):
            rows, size = order[lo:hi], int(length[order[lo]])
            if size > 64 * (hi - lo):
                out[rows] = [single(self.data[s: s + size]) for s in start[rows]]
            else:
                out[rows] = vector(start[rows], size)
        return out

    def xxhash64(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """xxhash64 (seed 0) of every range."""
        return self._by_length(start, length, self._xxhash64, lambda x: xxhash.xxh64_intdigest(x.tobytes()), np.uint64)

    def crc32(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Unsigned crc32 of every range."""
        return self._by_length(start, length, self._crc32, zlib.crc32, np.uint32)

    def _crc32(self, at: np.ndarray, size: int) -> np.ndarray:
        crc = np.full(len(at), 0xFFFFFFFF, np.uint32)
        left = size
        while left >= 8:
            crc = _crc_step(_CRC[7:3:-1], self.u32[at] ^ crc) ^ _crc_step(_CRC[3::-1], self.u32[at + 4])
            at, left = at + 8, left - 8
        if left >= 4:
            crc = _crc_step(_CRC[3::-1], self.u32[at] ^ crc)
            at, left = at + 4, left - 4
        for i in range(left):
            crc = _CRC[0][(crc ^ self.data[at + i]) & 255] ^ (crc >> 8)
        return ~crc

    def _xxhash64(self, at: np.ndarray, size: int) -> np.ndarray:
        left = size
        if size >= 32:
            lanes = [np.full(len(at), v, np.uint64) for v in _LANES]
            while left >= 32:
                for i in range(4):
                    lanes[i] = _round(lanes[i], self.u64[at + 8 * i])
                at, left = at + 32, left - 32
            h = _rotl(lanes[0], 1) + _rotl(lanes[1], 7) + _rotl(lanes[2], 12) + _rotl(lanes[3], 18)
            for lane in lanes:
                h = (h ^ _round(np.uint64(0), lane)) * _P1 + _P4
        else:
            h = np.full(len(at), _P5, np.uint64)
        h += np.uint64(size)
        while left >= 8:
            h = _rotl(h ^ _round(np.uint64(0), self.u64[at]), 27) * _P1 + _P4
            at, left = at + 8, left - 8
        if left >= 4:
            h = _rotl(h ^ (self.u32[at].astype(np.uint64) * _P1), 23) * _P2 + _P3
            at, left = at + 4, left - 4
        for i in range(left):
            h = _rotl(h ^ (self.data[at + i].astype(np.uint64) * _P5), 11) * _P1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        return h ^ (h >> np.uint64(32))

    def __len__(self) -> int:
        return len(self.data) - 8

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray, other: Bytes | None = None) -> np.ndarray:
        """Whether the ranges of ``length`` bytes at ``a`` and at ``b`` (of ``other``) hold the same bytes."""
        theirs = (self if other is None else other).u64
        same = np.ones(len(a), bool)
        live, done = np.arange(len(a)), 0
        while len(live):
            rest = np.minimum(length[live] - done, 8)
            shift = (8 * (8 - rest)).astype(np.uint64)
            differs = ((self.u64[a[live] + done] ^ theirs[b[live] + done]) << shift) != 0
            same[live[differs]] = False
            done += 8
            live = live[~differs & (length[live] > done)]
        return same


class GramTable:
    """Open-addressed table of the distinct byte ranges among the given ones.

    Keys are xxhash64 values, equal slots are resolved by linear probing, and
    bytes are compared before an occurrence joins a slot. ``slot`` is the slot
    id of every occurrence; ``used`` lists the slots in use, ``first`` one
    occurrence of each, and ``count`` the occurrences by slot.
    """

    def __init__(self, text: Bytes, start: np.ndarray, length: np.ndarray, keys: np.ndarray | None = None):
        n = len(start)
        keys = text.xxhash64(start, length) if keys is None else keys
        self.size = 1 << max(4, (2 * n).bit_length())
        mask = self.size - 1
        owner = np.full(self.size, -1, np.int32)
        self.slot = np.empty(n, np.int64)
        at = (keys & np.uint64(mask)).astype(np.int64)
        todo = np.arange(n)
        while len(todo):
            here = at[todo]
            free = owner[here] < 0
            owner[here[free]] = todo[free]
            held = owner[here]
            same = (keys[held] == keys[todo]) & (length[held] == length[todo])
            maybe = np.flatnonzero(same & (held != todo))
            same[maybe] = text.equal(start[held[maybe]], start[todo[maybe]], length[todo[maybe]])
            self.slot[todo[same]] = here[same]
            todo = todo[~same]
            at[todo] = (at[todo] + 1) & mask
        self.used = np.flatnonzero(owner >= 0)
        self.first = owner[self.used]
        self.count = np.bincount(self.slot, minlength=self.size)


def joined_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(text, starts, ends, row)``: all words of the rows, lower-cased, one blank after each word.

    Each row's bytes must end with a byte that belongs to no word.
    """
    data = LOWER[data]
    inside = ALNUM_WORDS[data]
    last = np.zeros(len(data), bool)
    last[1:] = inside[:-1] & ~inside[1:]
    ends_at = np.flatnonzero(last)
    row = np.searchsorted(offsets, ends_at, side="right") - 1
    keep = inside | last
    data[last] = 0x20
    text = data[keep]
    ends = np.flatnonzero(text == 0x20)
    starts = np.empty_like(ends)
    starts[:1], starts[1:] = 0, ends[:-1] + 1
    return text, starts, ends, row
