"""A wavelet matrix over token ids: one compressed file holds the bit-planes, their rank directory and the documents.

File: MAGIC; length of the header (uint32); header as JSON (counts, bits, zeros of each plane, sizes of the parts);
then the parts, each compressed by zstandard on its own: document ids (int64), null flags (uint8), document ends
(int64), the distinct ids by falling frequency (uint32), and for each plane its packed bits and the ones before every 4096th bit (uint32). Numbers are little-endian.
"""

from __future__ import annotations

import json

import numpy as np
import zstandard

MAGIC = b"PLWM0001"
SUPER = 4096  # bits between two entries of the rank directory
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class WaveletMatrix:
    """n values as numbers of `bits` bits: the place of each in `symbols`, the distinct values by falling frequency (so
    the high planes are nearly empty and compress well). planes[0] has the highest bit, ordered as the values are; each
    next plane is ordered by the one before it, zeros first and stable."""

    def __init__(self, n: int, symbols: np.ndarray, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray]):
        self.n, self.symbols, self.planes, self.zeros, self.ranks = n, symbols, planes, zeros, ranks
        self.bits = len(planes)
        self._code = None

    @classmethod
    def build(cls, values: np.ndarray) -> "WaveletMatrix":
        often = np.bincount(values)
        symbols = np.argsort(-often, kind="stable")[: np.count_nonzero(often)]
        bits = max(1, (len(symbols) - 1).bit_length()) if len(symbols) else 1
        code = np.zeros(len(often) or 1, np.uint16 if bits <= 16 else np.uint32)
        code[symbols] = np.arange(len(symbols))
        v = code[values]
        planes, zeros, ranks = [], [], []
        for k in range(bits - 1, -1, -1):
            one = (v & v.dtype.type(1 << k)).astype(bool)
            packed = np.packbits(one)
            whole = np.zeros(-(-len(packed) // (SUPER // 8)) * (SUPER // 8), np.uint8)
            whole[: len(packed)] = packed
            ones = np.bitwise_count(whole.view(np.uint64)).reshape(-1, SUPER // 64).sum(axis=1, dtype=np.int64)
            ranks.append(np.concatenate(([0], np.cumsum(ones))).astype(np.uint32))
            planes.append(packed)
            zeros.append(int(len(v) - ranks[-1][-1]))
            if k:
                v = np.concatenate((v.take(np.flatnonzero(~one)), v.take(np.flatnonzero(one))))
        return cls(len(v), symbols.astype(np.uint32), planes, zeros, ranks)

    def code(self, value: int) -> int:
        """The place of a value in symbols; -1 if it never occurs."""
        if self._code is None:
            self._code = {int(x): i for i, x in enumerate(self.symbols)}
        return self._code.get(int(value), -1)

    def _bit(self, k: int, i: int) -> int:
        return (int(self.planes[k][i >> 3]) >> (7 - (i & 7))) & 1

    def _ones(self, k: int, i: int) -> int:
        """Ones of plane k before place i."""
        s = i // SUPER
        p, a, b = self.planes[k], s * (SUPER // 8), i >> 3
        out = int(self.ranks[k][s]) + int(_ONES[p[a:b]].sum())
        return out + (int(_ONES[int(p[b]) >> (8 - (i & 7))]) if i & 7 else 0)

    def access(self, i: int) -> int:
        """The value at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for k in range(self.bits):
            bit = self._bit(k, i)
            out = out << 1 | bit
            ones = self._ones(k, i)
            i = self.zeros[k] + ones if bit else i - ones
        return int(self.symbols[out])

    def _range(self, value: int, i: int) -> tuple[int, int]:
        a, b = 0, i
        for k in range(self.bits):
            x, y = self._ones(k, a), self._ones(k, b)
            if value >> (self.bits - 1 - k) & 1:
                a, b = self.zeros[k] + x, self.zeros[k] + y
            else:
                a, b = a - x, b - y
        return a, b

    def rank(self, value: int, i: int) -> int:
        """How often value occurs before place i."""
        value = self.code(value)
        if value < 0:
            return 0
        a, b = self._range(value, min(max(i, 0), self.n))
        return b - a

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def _select_bit(self, k: int, bit: int, j: int) -> int:
        """The place of the j-th (from 0) one or zero of plane k."""
        have = self.ranks[k].astype(np.int64)
        if not bit:
            have = np.minimum(np.arange(len(have), dtype=np.int64) * SUPER, self.n) - have
        s = int(np.searchsorted(have, j, side="right")) - 1
        part = np.unpackbits(self.planes[k][s * (SUPER // 8) : (s + 1) * (SUPER // 8)])
        part = part[: self.n - s * SUPER]
        return s * SUPER + int(np.flatnonzero(part == bit)[j - int(have[s])])

    def select(self, value: int, j: int) -> int:
        """The place of the j-th (from 0) occurrence of value; -1 if there are fewer."""
        value = self.code(value)
        if value < 0:
            return -1
        a, b = self._range(value, self.n)
        if not 0 <= j < b - a:
            return -1
        i = a + j
        for k in range(self.bits - 1, -1, -1):
            bit = value >> (self.bits - 1 - k) & 1
            i = self._select_bit(k, bit, i - self.zeros[k] if bit else i)
        return i

    def values(self) -> np.ndarray:
        """All values in order."""
        v = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for k in range(self.bits - 1, -1, -1):
            one = np.unpackbits(self.planes[k], count=self.n).view(bool)
            out = np.empty_like(v)
            z = self.zeros[k]
            out[np.flatnonzero(one)] = v[z:] | v.dtype.type(1 << (self.bits - 1 - k))
            out[np.flatnonzero(~one)] = v[:z]
            v = out
        return self.symbols[v] if self.n else np.zeros(0, np.uint32)


def dump(values: np.ndarray, ids: list, ends: np.ndarray) -> bytes:
    """A shard's file: the values of all its documents, their ids (None: null) and where each ends."""
    w = WaveletMatrix.build(values)
    z = zstandard.ZstdCompressor(level=1)
    parts = [np.array([0 if x is None else x for x in ids], "<i8"), np.array([x is None for x in ids], np.uint8), np.asarray(ends, "<i8"), w.symbols.astype("<u4")]
    for p, r in zip(w.planes, w.ranks):
        parts += [p, r.astype("<u4")]
    packed = [z.compress(np.ascontiguousarray(p).tobytes()) for p in parts]
    head = json.dumps({"n": w.n, "docs": len(ids), "zeros": w.zeros, "sizes": [len(p) for p in packed]}).encode()
    return b"".join([MAGIC, len(head).to_bytes(4, "little"), head, *packed])


def load(data: bytes) -> tuple[WaveletMatrix, list, np.ndarray]:
    """The matrix, the document ids and the document ends of a file."""
    if data[:8] != MAGIC:
        raise ValueError("not a token shard")
    h = int.from_bytes(data[8:12], "little")
    head = json.loads(data[12 : 12 + h])
    z, at, parts = zstandard.ZstdDecompressor(), 12 + h, []
    for s in head["sizes"]:
        parts.append(z.decompress(data[at : at + s], max_output_size=1 << 34) if s else b"")
        at += s
    ids = np.frombuffer(parts[0], "<i8").tolist()
    ids = [None if null else x for x, null in zip(ids, np.frombuffer(parts[1], np.uint8))]
    planes = [np.frombuffer(p, np.uint8) for p in parts[4::2]]
    ranks = [np.frombuffer(p, "<u4") for p in parts[5::2]]
    return WaveletMatrix(head["n"], np.frombuffer(parts[3], "<u4"), planes, head["zeros"], ranks), ids, np.frombuffer(parts[2], "<i8")
