"""Near-duplicate documents by SimHash fingerprints and an inverted index over byte positions.

A fingerprint holds 64 bits; bit i is set if it is set in over half of the hashes of the text's shingles. Two
fingerprints within ``DISTANCE`` = 3 bits differ in at most 3 of their 8 bytes, so they share at least 5 positional bytes
(position and value). Of 5 shared positions, 3 or more lie in one half of the fingerprint, so the index holds the 8
combinations of three positional bytes from one half: a pair that can be linked meets in at least one posting. In a posting
the shared positional bytes of each pair are tallied, pairs below the guaranteed 5 are dropped, the rest verified bit by bit.

Only distinct fingerprints are indexed; their documents are members of a class. A posting of more than ``LONGEST`` fingerprints
is intersected with further positions: pairs that may be linked share two more of the other five bytes, so ten combinations
follow; then three of the six half-bytes of the remaining three bytes, twenty combinations. After that at most 12 bits are
free, so a posting holds at most 4 096 fingerprints, whatever the input: no task gets an unbounded one, and none is
cut. Short postings yield their links, long ones a row for each member of a connected part, since only connectivity is asked for.

Nulls and texts without words: fingerprint zero, linked like any other. Rows that share an id are one document, so their
fingerprints are linked; a row without an id takes the component of its fingerprint but names none (null if nobody in it has an
id). Repeated rows give a row each. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import components, kept_table, picked
from parcelle.llm.hot import with_summary
from parcelle.llm.wordhash import U, Words, buffers, chunks

SHINGLE_WORDS, SEED, DISTANCE = 3, 42, 3
SHARED = 8 - DISTANCE
LONGEST = 4096
# Lists up to this length are compared at once with all lists of their length.
SHORT = 16
HASHES = 1 << 15
HALVES = [t for half in (range(4), range(4, 8)) for t in combinations(half, 3)]


class _Bounds(Words):
    """Words without codes."""

    def _codes(self, letters: np.ndarray) -> np.ndarray:
        return np.zeros(0, dtype=U)


def _spaced(words: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by single spaces, with the bounds of each."""
    size = words.end - words.start
    start = np.cumsum(size + 1) - size - 1
    out = np.full(int(size.sum()) + len(size), 32, dtype=np.uint8)
    lengths_before = np.cumsum(size) - size
    inside = np.arange(int(size.sum()))
    shift = np.repeat(start - lengths_before, size)
    source = np.repeat(words.start - lengths_before, size)
    letters = words.data[inside + source]
    upper = (letters >= 65) & (letters <= 90)
    out[inside + shift] = letters + (upper * np.uint8(32))
    return out.tobytes(), start, start + size


def fingerprints(words: Words) -> np.ndarray:
    """The 64-bit fingerprint of each text."""
    raw, start, end = _spaced(words)
    counts = np.diff(words.first)
    out = np.zeros(len(counts), dtype=U)
    for i in np.flatnonzero(counts):
        a, n = int(words.first[i]), int(counts[i])
        width = min(n, SHINGLE_WORDS)
        shingles = n - width + 1
        ones = np.zeros(64, dtype=np.int64)
        for at in range(0, shingles, HASHES):
            some = min(HASHES, shingles - at)
            begins = start[a + at : a + at + some].tolist()
            stops = end[a + at + width - 1 : a + at + width - 1 + some].tolist()
            digest = b"".join([xxhash.xxh64_digest(raw[s:e], SEED) for s, e in zip(begins, stops, strict=True)])
            bits = np.unpackbits(np.frombuffer(digest, dtype=np.uint8).reshape(-1, 8), axis=1)
            ones += bits.sum(0, dtype=np.int64)
        out[i] = np.packbits(2 * ones > shingles).view(">u8")[0]
    return out


def _printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = buffers(batch.column(1))
        for lo, hi in chunks(offsets):
            found = fingerprints(_Bounds(raw, offsets[lo : hi + 1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(found.view(np.int64))], names=["doc_id", "print"]
            )


def _byte(prints: np.ndarray, position: int) -> np.ndarray:
    return (prints >> U(56 - 8 * position)) & U(255)


def _nibble(prints: np.ndarray, position: int) -> np.ndarray:
    return (prints >> U(60 - 4 * position)) & U(15)


def first_keys(prints: np.ndarray) -> np.ndarray:
    """(prints, 8) keys: a combination of three positions of one half (3 bits) and their bytes (24 bits)."""
    out = np.empty((len(prints), len(HALVES)), dtype=U)
    for c, positions in enumerate(HALVES):
        key = np.full(len(prints), c, dtype=U)
        for p in positions:
            key = (key << U(8)) | _byte(prints, p)
        out[:, c] = key
    return out


def second_keys(prints: np.ndarray, known: np.ndarray) -> np.ndarray:
    """(prints, 10) keys: two more of the five other bytes; 4 bits name the combination, 16 hold the bytes."""
    out = np.empty((len(prints), 10), dtype=U)
    for c, positions in enumerate(HALVES):
        mine = np.flatnonzero((known >> U(24)) == c)
        others = [p for p in range(8) if p not in positions]
        for k, pair in enumerate(combinations(others, 2)):
            key = (known[mine] << U(4)) | U(k)
            for p in pair:
                key = (key << U(8)) | _byte(prints[mine], p)
            out[mine, k] = key
    return out


def third_keys(prints: np.ndarray, known: np.ndarray) -> np.ndarray:
    """(prints, 20) keys: three of the six half-bytes still free; 5 bits name the combination, 12 hold the half-bytes."""
    out = np.empty((len(prints), 20), dtype=U)
    names = known >> U(16)
    for name in np.unique(names):
        mine = np.flatnonzero(names == name)
        positions = HALVES[int(name) >> 28]
        others = [p for p in range(8) if p not in positions]
        pair = list(combinations(others, 2))[(int(name)) & 15]
        free = [n for p in others if p not in pair for n in (2 * p, 2 * p + 1)]
        for k, triple in enumerate(combinations(free, 3)):
            key = (known[mine] << U(5)) | U(k)
            for n in triple:
                key = (key << U(4)) | _nibble(prints[mine], n)
            out[mine, k] = key
    return out


def _posted(level):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("print").to_numpy().view(U)
            keys = first_keys(prints) if level is None else level(prints, batch.column("key").to_numpy().view(U))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64).ravel()), pa.array(np.repeat(prints, keys.shape[1]).view(np.int64))], names=["key", "print"]
            )

    return run


def linked(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether prints share the guaranteed number of positional bytes and, if so, differ in few enough bits."""
    apart = np.ascontiguousarray(x ^ y)
    shared = (apart.view(np.uint8).reshape(*apart.shape, 8) == 0).sum(-1)
    return (shared >= SHARED) & (np.bitwise_count(apart) <= DISTANCE)


def forest(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each print of one posting that is connected with a lesser one by links, with the least print of its part."""
    name = np.arange(len(prints))
    for at in range(0, len(prints), 256):
        i, j = np.nonzero(linked(prints[at : at + 256, None], prints[None, :]))
        pairs = np.unique(np.stack((name[i + at], name[j]), axis=1), axis=0)
        pairs = pairs[pairs[:, 0] < pairs[:, 1]]
        if not len(pairs):
            continue
        parent = np.arange(len(prints))

        def root(k: int, parent=parent) -> int:
            while parent[k] != k:
                parent[k] = parent[parent[k]]
                k = int(parent[k])
            return k

        for a, b in pairs.tolist():
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
        name = parent[name]
    moved = np.flatnonzero(name != np.arange(len(prints)))
    return prints[name[moved]], prints[moved]


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(0)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        prints = lists.values.to_numpy().view(U)
        size = np.diff(offsets)
        left, right = [], []
        for n in range(2, SHORT + 1):
            of_size = np.flatnonzero(size == n)
            if len(of_size):
                rows = prints[offsets[of_size][:, None] + np.arange(n)]
                i, j = np.triu_indices(n, 1)
                x, y = rows[:, i].ravel(), rows[:, j].ravel()
                good = linked(x, y)
                left.append(x[good])
                right.append(y[good])
        for k in np.flatnonzero(size > SHORT):
            x, y = forest(np.sort(prints[offsets[k] : offsets[k + 1]]))
            left.append(x)
            right.append(y)
        if left:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c).view(np.int64)) for c in (left, right)], names=["a", "b"]
            )


def links(prints: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``(a, b)`` of the distinct ``prints(print)`` whose components are those of all links."""
    posted, found = prints, None
    for level in (None, second_keys, third_keys):
        posted = kept_table(posted.mapInArrow(_posted(level), "key long, print long"), "postings")
        sizes = posted.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        sized = posted.join(sizes, "key")
        bounded = sized if level is third_keys else sized.where(F.col("n") <= longest)
        lists = bounded.groupBy("key").agg(F.collect_list("print").alias("prints")).select("prints")
        some = lists.mapInArrow(_tallied, "a long, b long")
        found = some if found is None else found.unionByName(some)
        posted = kept_table(sized.where(F.col("n") > longest).select("key", "print"), "long-postings")
        if not posted.limit(1).count():
            break
    return found


def near_by_simhash(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for each row: the fingerprint in 16 hexadecimal digits and the least id of
    its component."""
    printed = kept_table(
        picked(docs, id_column, text_column).mapInArrow(_printed, "doc_id long, print long"), "prints"
    )
    classes = kept_table(
        printed.groupBy("print").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "classes"
    )
    by_id = printed.where("doc_id is not null").groupBy("doc_id").agg(F.min("print").alias("a"), F.max("print").alias("z"))
    same_id = printed.join(by_id.where("a <> z"), "doc_id").select("a", F.col("print").alias("b"))
    parts = components(links(classes.select("print")).unionByName(same_id))
    placed = classes.join(parts.withColumnRenamed("node", "print"), "print", "left").withColumn(
        "component", F.coalesce("component", "print")
    )
    placed = kept_table(placed, "placed")
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.join(least, "component").select("print", "n", "component_id")
    return with_summary(printed, named, "print", "n", printed.count()).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
