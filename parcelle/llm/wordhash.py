"""Words and shingles of many texts at once, as numpy arrays over Arrow buffers.

Words are maximal runs of bytes other than space and \\t..\\r, so they need no decoding. A word's
64-bit code is a polynomial over its bytes, mixed; a sequence's code is a polynomial over word codes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
PIECE = 1 << 20
CHUNK = 4 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U)
    out[0] = 1
    return np.cumprod(out, dtype=U)


BASE = 0x9E3779B97F4A7C15 | 1
_POWER = _powers(BASE, PIECE + 1)
_INVERSE = _powers(pow(BASE, -1, 1 << 64), PIECE + 1)
_CODE = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=U)
_LOWER = _CODE.copy()
_LOWER[65:91] = _CODE[97:123]
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit codes."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values and the offsets of each; nulls are empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def chunks(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes together; a longer text stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        yield i, min(j, n)
        i = j


class Words:
    """Words of texts ``lo..hi``: byte ``start`` and ``end`` (in the chunk), ``code`` and first word of each text."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = raw[offsets[0] : offsets[-1]]
        self.cuts = offsets - offsets[0]
        solid = ~_BLANK[self.data]
        begins, stops = solid.copy(), solid.copy()
        begins[1:] &= ~solid[:-1]
        stops[:-1] &= ~solid[1:]
        inner = self.cuts[1:-1]
        inner = inner[(inner > 0) & (inner < len(solid))]
        begins[inner] |= solid[inner]
        stops[inner - 1] |= solid[inner - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.start, self.cuts)
        self.code = self._codes(_LOWER if lower else _CODE)

    def _codes(self, letters: np.ndarray) -> np.ndarray:
        code = np.zeros(len(self.start), dtype=U)
        i = 0
        while i < len(self.start):
            at = self.start[i]
            j = int(np.searchsorted(self.end, at + PIECE, side="right"))
            if j <= i:  # a word longer than a piece: fold its pieces one after the other
                folded = U(0)
                for k in range(at, self.end[i], PIECE):
                    part = letters[self.data[k : min(k + PIECE, self.end[i])]]
                    folded = mix(np.array([folded + np.sum(part * _POWER[: len(part)], dtype=U)], dtype=U))[0]
                code[i] = folded
                i += 1
                continue
            part = self.data[at : self.end[j - 1]]
            total = np.zeros(len(part) + 1, dtype=U)
            np.cumsum(letters[part] * _POWER[: len(part)], dtype=U, out=total[1:])
            s, e = self.start[i:j] - at, self.end[i:j] - at
            code[i:j] = (total[e] - total[s]) * _INVERSE[s] + (e - s).astype(U) * U(0xD6E8FEB86659FD93)
            i = j
        return mix(code)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def ngrams(code: np.ndarray, n: int) -> np.ndarray:
    """A code for each run of ``n`` neighbouring words, across text borders too."""
    m = len(code) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=U)
    out = np.zeros(m, dtype=U)
    for k in range(n):
        out = out * U(BASE) + code[k : k + m]
    return mix(out)


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``n``-word shingles of each text, sorted in it, and the first of each text.

    A text of fewer words has its whole sequence as one shingle, one without words none.
    """
    counts = np.diff(words.first)
    grams = ngrams(words.code, n)
    owner = words.owner()
    place = np.arange(len(owner)) - words.first[owner]
    whole = place[: len(grams)] + n <= counts[owner[: len(grams)]]
    codes, texts = [grams[whole]], [owner[: len(grams)][whole]]
    for length in range(1, n):
        short = words.first[:-1][counts == length]
        if len(short):
            out = np.full(len(short), length, dtype=U)
            for k in range(length):
                out = out * U(BASE) + words.code[short + k]
            codes.append(mix(out ^ U(0x5851F42D4C957F2D)))
            texts.append(np.flatnonzero(counts == length))
    code, text = np.concatenate(codes), np.concatenate(texts)
    order = np.argsort(text, kind="stable")
    code, text = code[order], text[order]
    bounds = np.searchsorted(text, np.arange(len(counts) + 1))
    for i in range(len(counts)):
        code[bounds[i] : bounds[i + 1]].sort()
    fresh = np.ones(len(code), dtype=bool)
    fresh[1:] = (code[1:] != code[:-1]) | (text[1:] != text[:-1])
    code, text = code[fresh], text[fresh]
    return code, np.searchsorted(text, np.arange(len(counts) + 1))
