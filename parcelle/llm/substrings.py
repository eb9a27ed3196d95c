"""Substring dedup over words: matches of 50-word windows found by FM-indexes of shards.

The words of a window's segment (see ``segments``) go to the shard of its anchor. Each shard builds a
compressed FM-index: the suffix array to the window's depth by prefix doubling, its Burrows-Wheeler
transform and a wavelet tree over it. Segments are streamed through backward search, one word a step for all
segments together: a step maps both ends of each match interval through the tree's ranks, and once a match is a
window long, its interval is widened to all suffixes that share the window, so the next step extends the window
one word to the left. The interval's least document tells whether the window starts in an earlier one.

Nulls: a null text has no words; a null id comes after all others. Rows that share an id do not
dedupe each other. Texts shorter than a window are left whole. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.segments import covered
from parcelle.llm.wordhash import Words, buffers, chunks

WIDTH = 50
GRAM = 10


def shifted(rank: np.ndarray, hop: int) -> np.ndarray:
    """The value ``hop`` positions further, 0 beyond the end."""
    out = np.zeros(len(rank), dtype=np.int64)
    if hop < len(rank):
        out[: len(rank) - hop] = rank[hop:]
    return out


def refine(rank: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order and dense ranks (from 1) of positions by ``(rank, after)``, ties in the order of positions."""
    n = len(rank)
    bits = max(1, int(n + 1).bit_length())
    if 3 * bits <= 64:
        key = (rank.astype(np.uint64) << np.uint64(2 * bits)) | (after.astype(np.uint64) << np.uint64(bits))
        key |= np.arange(n, dtype=np.uint64)
        key.sort()
        order = (key & np.uint64((1 << bits) - 1)).astype(np.int64)
        head = key >> np.uint64(bits)
        fresh = head[1:] != head[:-1]
    else:
        order = np.lexsort((after, rank))
        fresh = (rank[order][1:] != rank[order][:-1]) | (after[order][1:] != after[order][:-1])
    out = np.empty(n, dtype=np.int64)
    out[order] = np.concatenate(([1], 1 + np.cumsum(fresh)))
    return order, out


def suffix_ranks(symbol: np.ndarray, step: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order to ``depth`` symbols, where the symbol after position p is that at p + ``step``.

    Prefix doubling over dense symbols; positions with equal prefixes share a rank.
    """
    order, rank = refine(symbol, np.zeros_like(symbol))
    reach = 1
    while reach < depth:
        more = min(reach, depth - reach)
        order, rank = refine(rank, shifted(rank, more * step))
        reach += more
    return order, rank


class Wavelet:
    """A wavelet tree over ``values`` below ``size``, level by level, each a bit vector with its prefix sums."""

    def __init__(self, values: np.ndarray, size: int):
        self.levels = max(1, int(size - 1).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        current = values.astype(np.int32)
        for level in range(self.levels - 1, -1, -1):
            bit = (current >> level) & 1
            count = np.zeros(len(bit) + 1, dtype=np.int32)
            np.cumsum(bit, out=count[1:])
            self.ones.append(count)
            self.zeros.append(len(bit) - int(count[-1]))
            current = np.concatenate((current[bit == 0], current[bit == 1]))
        total = np.bincount(values, minlength=size)
        # rows that start with a smaller symbol, less the place where the tree puts the symbol's first
        self.base = np.concatenate(([0], np.cumsum(total)[:-1])) - self._walk(np.arange(size), np.zeros(size, np.int64))

    def _walk(self, value: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k in range(self.levels):
            one = self.ones[k][at].astype(np.int64)
            at = np.where((value >> (self.levels - 1 - k)) & 1, self.zeros[k] + one, at - one)
        return at

    def step(self, value: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the rows before ``at`` lead when ``value`` is put in front of them."""
        return self.base[value] + self._walk(value, at)


def matching(units: np.ndarray, cuts: np.ndarray, width: int, weight: np.ndarray, least: np.ndarray):
    """For each window of each segment: weight (two for more) and least place over all equal windows of the shard."""
    lengths = np.diff(cuts)
    n = len(units) + len(lengths)
    begin = cuts[:-1] + np.arange(len(lengths))
    symbol = np.zeros(n, dtype=np.int64)
    inner = np.ones(n, dtype=bool)
    inner[begin + lengths] = False  # a segment's end
    words, dense = np.unique(units, return_inverse=True)
    symbol[inner] = dense + 1
    owner = np.repeat(np.arange(len(lengths)), lengths + 1)
    _, shorter = suffix_ranks(symbol, 1, width - 1)
    order, rank = refine(shorter, shifted(symbol, width - 1))
    # blocks of suffixes that share width - 1 symbols, and those that share a window
    head = np.flatnonzero(np.concatenate(([True], shorter[order][1:] != shorter[order][:-1])))
    tail = np.concatenate((head[1:], [n]))
    block = np.cumsum(np.concatenate(([False], shorter[order][1:] != shorter[order][:-1])))
    cut = np.flatnonzero(np.concatenate(([True], rank[order][1:] != rank[order][:-1])))
    row_owner = owner[order]
    lowest = np.minimum.reduceat(least[row_owner], cut)
    sums = np.minimum(np.add.reduceat(weight[row_owner], cut), 2)
    tree = Wavelet(symbol[order - 1], len(words) + 1)  # the transform; the first position follows the last end
    windows = lengths - width + 1
    out_at = np.concatenate(([0], np.cumsum(windows)))
    out_weight = np.zeros(out_at[-1], dtype=np.int64)
    out_least = np.zeros(out_at[-1], dtype=np.int64)
    lo, hi = np.zeros(len(lengths), dtype=np.int64), np.full(len(lengths), n, dtype=np.int64)
    active = np.argsort(-lengths, kind="stable")
    for k in range(int(lengths.max(initial=0))):
        active = active[: int(np.searchsorted(-lengths[active], -k, side="left"))]
        at = lengths[active] - 1 - k
        if k >= width:
            own = block[lo[active]]
            lo[active], hi[active] = head[own], tail[own]
        value = symbol[begin[active] + at]
        lo[active], hi[active] = tree.step(value, lo[active]), tree.step(value, hi[active])
        if k >= width - 1:
            found = rank[order[lo[active]]] - 1
            spot = out_at[active] + at
            out_weight[spot], out_least[spot] = sums[found], lowest[found]
    return out_weight, out_least


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Applies word spans: counts, merged spans and the kept words joined by a space."""
    for batch in batches:
        raw, offsets = buffers(batch.column("text"))
        spans = batch.column("spans").to_pylist()
        for lo, hi in chunks(offsets):
            words = Words(raw, offsets[lo : hi + 1])
            data = words.data.tobytes()
            counts, removed, merged, kept = [], [], [], []
            for i in range(hi - lo):
                first, last = int(words.first[i]), int(words.first[i + 1])
                start, end = words.start[first:last], words.end[first:last]
                gone = merge_spans(spans[lo + i])
                left = np.ones(last - first, dtype=bool)
                for a, b in gone:
                    left[a:b] = False
                counts.append(last - first)
                removed.append(last - first - int(left.sum()))
                merged.append([{"a": a, "b": b} for a, b in gone])
                kept.append(b" ".join([data[a:b] for a, b in zip(start[left].tolist(), end[left].tolist(), strict=True)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(merged, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "spans", "kept_text"],
            )


def merge_spans(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Sorted union of half-open ranges; touching ranges become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def substring_dedup(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, gram: int = GRAM,
) -> DataFrame:
    """``(doc_id, n_words, n_removed, spans, kept_text)`` for each document.

    Removed are the words covered by a window of ``width`` words that also starts in a document with a
    smaller id; ``spans`` are word ranges, and the kept words are joined by one space.
    """
    texts, spans = covered(docs, id_column, text_column, "word", width, gram, matching, F.col("least") < F.col("place"))
    return texts.join(spans, "key", "left").select("doc_id", "text", "spans").mapInArrow(
        _cut, "doc_id long, n_words long, n_removed long, spans array<struct<a:long,b:long>>, kept_text string"
    )
