"""Vectorised scanning of text columns inside Spark tasks.

Texts reach the tasks as Arrow string columns; the helpers here look at
their UTF-8 buffers directly, so words, word hashes and substring hashes
come out of a few numpy passes per block instead of per-word Python.
A block holds whole documents and about ``BLOCK_BYTES`` of text (one longer
document is a block of its own), which bounds the memory of the passes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: byte classes: True where the byte belongs to a word
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, dtype=bool)            # anything but ASCII other than letters and digits
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_rng = np.random.default_rng(20240607)
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INV = np.uint64(pow(int(BASE), -1, 2**64))
#: longer strings get a cryptographic hash: modulo 2**64 a polynomial gives some regular
#: strings of 256 bytes and more (Thue-Morse words and their complements) one value
LONG_BYTES = 128
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (avalanche), so any bit range is usable."""
    h = h ^ (h >> np.uint64(30))
    h = h * _M1
    h ^= h >> np.uint64(27)
    h = h * _M2
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i (mod 2**64) for i < n, grown on demand."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(BLOCK_BYTES + 1, 1 << int(n - 1).bit_length())
        for name, base in (("up", BASE), ("down", BASE_INV)):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            _powers[name] = np.cumprod(x, dtype=np.uint64)
    return _powers["up"], _powers["down"]


class Block:
    """Some documents' bytes back to back: ``data``, ``starts`` (n+1 offsets)."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, first: int):
        self.data, self.starts, self.first = data, starts, first
        self._prefix = None

    def __len__(self) -> int:
        return len(self.starts) - 1

    def lower(self) -> "Block":
        """ASCII letters lower-cased."""
        return Block(_LOWER[self.data], self.starts, self.first)

    def prefix(self) -> np.ndarray:
        """Prefix sums of the position-weighted byte codes (for substring hashes)."""
        if self._prefix is None:
            up, _ = powers(len(self.data) + 1)
            out = np.zeros(len(self.data) + 1, dtype=np.uint64)
            np.cumsum(BYTE_CODE[self.data] * up[:len(self.data)], out=out[1:])
            self._prefix = out
        return self._prefix

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of data[begin:end], equal for equal bytes wherever they lie."""
        s = self.prefix()
        _, down = powers(len(self.data) + 1)
        out = mix((s[end] - s[begin]) * down[begin] + (end - begin).astype(np.uint64) * _M2)
        far = np.flatnonzero(end - begin > LONG_BYTES)
        if len(far):
            data = memoryview(np.ascontiguousarray(self.data))
            codes = b"".join(hashlib.blake2b(data[a:z], digest_size=8).digest() for a, z in zip(begin[far].tolist(), end[far].tolist()))
            out[far] = np.frombuffer(codes, np.uint64)
        return out

    def words(self, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of word bytes, never across documents: (begin, end, n+1
        offsets of each document's words)."""
        n = len(self.data)
        is_word = word_bytes[self.data]
        cut = np.zeros(n + 1, dtype=bool)
        cut[self.starts] = True
        before = np.zeros(n, dtype=bool)
        before[1:] = is_word[:-1]
        begin = np.flatnonzero(is_word & (~before | cut[:n]))
        after = np.zeros(n, dtype=bool)
        after[:-1] = is_word[1:]
        end = np.flatnonzero(is_word & (~after | cut[1:])) + 1
        return begin, end, np.searchsorted(begin, self.starts)


def binary_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, n+1 offsets) of an Arrow string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = column.type
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(kind) or pa.types.is_large_string(kind) else b"")
    wide = pa.types.is_large_string(kind) or pa.types.is_large_binary(kind)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[
        column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES):
    """Cut a column into ``Block`` s of whole documents."""
    data, offsets = binary_parts(column)
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + block_bytes, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield Block(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], i)
        i = j


def runs_of(hashes: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order-dependent hashes of ``width`` consecutive items that stay within
    one document: (index of the first item, hash)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        h = h * BASE + hashes[k:k + n]
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.flatnonzero(doc[:n] == doc[width - 1:width - 1 + n])
    return at, mix(h[at])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values (length len(x)-width+1)."""
    n = len(x)
    if n < width:
        return x[:0]
    pad = -n % width
    full = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, dtype=x.dtype)]).reshape(-1, width)
    left = np.minimum.accumulate(full, axis=1).ravel()
    right = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n - width + 1], left[width - 1:n])
