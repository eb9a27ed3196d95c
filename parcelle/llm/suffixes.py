"""Suffix-array dedup over bytes: repeated 200-byte strings found by merging Burrows-Wheeler transforms.

A window's segment (see ``segments``) goes to the shard of its anchor. A shard's texts are two collections,
each sorted on its own into a suffix array and its transform. The two are merged by refining the interleave:
after h rounds each suffix of one side knows the range of the other side's suffixes that share its first h
symbols; a round maps both ends of the range through the other side's transform, and suffixes whose range has
become empty rest. No suffix is sorted again. Ranges left after the window's depth, together with the ranks
inside each side, are the repeated intervals, and ranks that differ bound the common prefixes.

A symbol is ``SYMBOL`` bytes wide, and the symbol after position p starts ``SYMBOL`` bytes further: the text is
read in as many phases as a symbol has bytes, so that every byte starts a suffix and 200 bytes are few rounds.

Nulls are empty texts. Repeated rows are copies of each other, as are rows that share an id. Texts shorter than
a window are left whole. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.segments import TABLE, TABLES, Codes, covered
from parcelle.llm.substrings import merge_spans, suffix_ranks
from parcelle.llm.wordhash import _CODE, U, buffers, chunks

WIDTH = 200
GRAM = 32
SYMBOL = 50


def run_codes(units: np.ndarray, n: int) -> np.ndarray:
    """A code for each run of ``n`` bytes."""
    step = TABLE - n
    parts = [Codes(_CODE[units[i : i + step + n - 1]], TABLES) for i in range(0, max(1, len(units) - n + 1), step)]
    return np.concatenate([p.of(np.arange(len(p.total) - n), np.arange(n, len(p.total))) for p in parts])


class Side:
    """One collection: suffix order, ranks to the window's depth and the transform's (symbol, row) keys."""

    def __init__(self, symbol: np.ndarray, wide: int, depth: int, weight: np.ndarray, least: np.ndarray):
        self.symbol = symbol
        self.order, rank = suffix_ranks(symbol, wide, depth)
        self.rank = rank - 1
        row = np.empty(len(symbol), dtype=np.int64)
        row[self.order] = np.arange(len(symbol))
        full = np.flatnonzero(symbol > 0)
        self.keys = (symbol[full] << 32) | row[full + wide]
        self.keys.sort()
        self.ends = len(symbol) - len(full)
        self.weight = np.bincount(self.rank, weight).astype(np.int64)
        self.least = np.full(len(self.weight), np.iinfo(np.int64).max)
        cut = np.flatnonzero(np.diff(self.rank[self.order], prepend=-1))
        if len(cut):
            self.least = np.minimum.reduceat(least[self.order], cut)

    def map(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Rows before which the suffixes lie that put ``symbol`` in front of the first ``row`` ones."""
        return self.ends + np.searchsorted(self.keys, (symbol << 32) | row)


def interleave(a: Side, b: Side, wide: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each position of ``a`` the range of rows of ``b`` that share ``depth`` symbols with it."""
    n = len(a.symbol)
    lo, hi = np.zeros(n, dtype=np.int64), np.full(n, len(b.symbol), dtype=np.int64)
    walk = a.order[a.symbol[a.order] > 0]  # in suffix order, so that lookups run through b once
    for _ in range(depth):
        walk = walk[hi[walk + wide] > lo[walk + wide]]
        symbol = a.symbol[walk]
        new_lo, new_hi = b.map(symbol, lo[walk + wide]), b.map(symbol, hi[walk + wide])
        lo[:], hi[:] = 0, 0
        lo[walk], hi[walk] = new_lo, new_hi
        # positions at an end share no further symbol
    return lo, hi


def merged(units: np.ndarray, cuts: np.ndarray, width: int, weight: np.ndarray, least: np.ndarray):
    """For each window of each segment: weight (two for more) and least place over all equal windows of the shard."""
    wide = max(k for k in range(1, min(SYMBOL, width) + 1) if width % k == 0)
    depth = width // wide
    lengths = np.diff(cuts)
    begin = cuts[:-1] + np.arange(len(lengths))
    n = len(units) + len(lengths)
    owner = np.repeat(np.arange(len(lengths)), lengths + 1)
    place = np.arange(n) - begin[owner]
    full = place + wide <= lengths[owner]
    symbol = np.zeros(n, dtype=np.int64)
    codes = run_codes(units, wide)
    _, dense = np.unique(codes[(np.arange(n) - owner)[full]], return_inverse=True)
    symbol[full] = dense + 1
    middle = int(begin[max(1, np.searchsorted(cuts, cuts[-1] // 2)) if len(lengths) > 1 else 0]) if len(lengths) > 1 else n
    w, p = weight[owner], least[owner]
    a = Side(symbol[:middle], wide, depth, w[:middle], p[:middle])
    total_weight, total_least = a.weight[a.rank], a.least[a.rank]
    if middle < n:
        b = Side(symbol[middle:], wide, depth, w[middle:], p[middle:])
        lo, hi = interleave(a, b, wide, depth)
        met = np.flatnonzero(hi > lo)
        group = b.rank[b.order[lo[met]]]
        mine = a.rank[met]
        weight_b, least_b = b.weight.copy(), b.least.copy()
        _, first = np.unique(mine, return_index=True)
        np.add.at(weight_b, group[first], a.weight[mine[first]])
        np.minimum.at(least_b, group[first], a.least[mine[first]])
        total_weight[met] += b.weight[group]
        total_least[met] = np.minimum(total_least[met], b.least[group])
        total_weight = np.concatenate((total_weight, weight_b[b.rank]))
        total_least = np.concatenate((total_least, least_b[b.rank]))
    starts = place + width <= lengths[owner]
    return np.minimum(total_weight[starts], 2), total_least[starts]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Applies byte spans: counts, merged spans and the kept bytes."""
    for batch in batches:
        raw, offsets = buffers(batch.column("text"))
        spans = batch.column("spans").to_pylist()
        for lo, hi in chunks(offsets):
            gone = [merge_spans(s) for s in spans[lo:hi]]
            kept = []
            for i, cut in enumerate(gone, lo):
                text = raw[offsets[i] : offsets[i + 1]].tobytes()
                at, parts = 0, []
                for a, b in cut:
                    parts.append(text[at:a])
                    at = b
                kept.append(b"".join([*parts, text[at:]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(offsets[lo : hi + 1])),
                 pa.array([sum(b - a for a, b in cut) for cut in gone], pa.int64()),
                 pa.array([[{"a": a, "b": b} for a, b in cut] for cut in gone],
                          pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                 pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "spans", "kept"],
            )


def suffix_dedup(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, gram: int = GRAM,
) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, spans, kept)`` for each document, over its UTF-8 bytes.

    Removed is each byte covered by a string of ``width`` bytes that also starts anywhere else.
    """
    texts, spans = covered(docs, id_column, text_column, "byte", width, gram, merged, F.col("weight") > 1)
    return texts.join(spans, "key", "left").select("doc_id", "text", "spans").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, spans array<struct<a:long,b:long>>, kept binary"
    )
