"""Vector code compression: product codes by Lloyd rounds over partition-local cover trees.

Vectors are turned into whole numbers ``floor(1024 * x)`` and cut into equal parts. Blocks of up to ``POINTS`` vectors of a
partition get one cover tree for each part position: a node covers all its points within its radius, and its children are
centres more than half of that radius apart, each point going to the nearest. Points lie in tree order, so that a subtree is a
slice and its sum a difference of two cumulative sums. The trees are written once.

A round compares a node's centre with the codebook. If the second nearest entry is farther than the nearest one by more than
twice the radius, the triangle inequality gives the whole subtree to the nearest entry, and its sum is added at once. Other
nodes hand over to their children; small or last ambiguous nodes are compared point by point. Sums of at most parts x entries
rows for each partition are added up by the cluster, so the driver sees one codebook a round, whatever the input.

Distances are whole numbers, computed exactly: by floating products while all components stay below ``EXACT``, by 64-bit
integer products above.

Rows whose vector is null, empty or holds null or non-finite components are dropped, as are those with a component beyond
``LARGEST`` (squares would leave 64 bits) and those of another length than the first kept vector's. That length must be a
multiple of the number of parts. Rows that share an id count each; the codebook starts from the first rows by (id, vector),
null ids last. With fewer rows than entries the codebook is that much smaller. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import kept_table
from parcelle.llm.hot import with_summary

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
POINTS, LEAF = 1024, 4
EXACT = 1 << 22
LARGEST = float(1 << 17)
NODE = np.dtype([("centre", "<i4"), ("low", "<i4"), ("high", "<i4"), ("first", "<i4"), ("last", "<i4"), ("radius", "<f8")])
BLOCKS = "ids array<long>, labels array<string>, width int, points binary, orders array<binary>, nodes array<binary>"


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of two integer matrices."""
    largest = max(int(np.abs(x).max(initial=0)), int(np.abs(y).max(initial=0)))
    kind = np.float64 if largest < EXACT else np.int64
    x, y = x.astype(kind), y.astype(kind)
    return (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)


def grow(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tree order of the points and the nodes, children side by side."""
    far = np.sqrt(squared(points, points).astype(np.float64))
    order = np.arange(len(points), dtype=np.int32)
    nodes = [[0, 0, len(points), 0, 0, 0.0]]
    k = 0
    while k < len(nodes):
        node = nodes[k]
        members = order[node[1] : node[2]]
        own = far[node[0], members]
        reach = float(own.max())
        node[5] = reach
        if reach > 0 and len(members) > LEAF:
            half = reach / 2
            centres, rest = [node[0]], members[own > half]
            while len(rest):
                centres.append(int(rest[0]))
                rest = rest[far[rest[0], rest] > half]
            nearest = far[np.ix_(members, centres)].argmin(1)
            place = np.argsort(nearest, kind="stable")
            order[node[1] : node[2]] = members[place]
            cuts = node[1] + np.searchsorted(nearest[place], np.arange(len(centres) + 1))
            node[3], node[4] = len(nodes), len(nodes) + len(centres)
            nodes += [[c, int(a), int(b), 0, 0, 0.0] for c, a, b in zip(centres, cuts[:-1], cuts[1:], strict=True)]
        k += 1
    return order, np.array([tuple(n) for n in nodes], dtype=NODE)


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers of the ranges low[i]..high[i], one after the other."""
    size = high - low
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - size), size)


def assign(points: np.ndarray, order: np.ndarray, nodes: np.ndarray, book: np.ndarray):
    """Nearest entry of each point, and the sums and counts that the entries gain."""
    sorted_points = points[order]
    total = np.zeros((len(points) + 1, points.shape[1]), dtype=np.int64)
    np.cumsum(sorted_points, axis=0, out=total[1:])
    chosen = np.zeros(len(points), dtype=np.int64)
    sums, counts = np.zeros(book.shape, dtype=np.int64), np.zeros(len(book), dtype=np.int64)
    open_nodes, single = np.array([0]), []
    while len(open_nodes):
        asked = nodes[open_nodes]
        exact = squared(points[asked["centre"]], book)
        best, d = exact.argmin(1), exact.astype(np.float64)
        rows = np.arange(len(d))
        near = np.sqrt(d[rows, best])
        d[rows, best] = np.inf
        # a node of equal points is settled by its centre, with ties to the lower entry
        sure = (np.sqrt(d.min(1)) - near > 2 * asked["radius"] * (1 + 1e-9) + 1e-5) | (asked["radius"] == 0)
        sure_slices = asked[sure]
        np.add.at(sums, best[sure], total[sure_slices["high"]] - total[sure_slices["low"]])
        np.add.at(counts, best[sure], sure_slices["high"] - sure_slices["low"])
        size = sure_slices["high"] - sure_slices["low"]
        chosen[_ranges(sure_slices["low"], sure_slices["high"])] = np.repeat(best[sure], size)
        unsure = asked[~sure]
        inner = unsure["last"] > unsure["first"]
        single.append(_ranges(unsure["low"][~inner], unsure["high"][~inner]))
        open_nodes = _ranges(unsure["first"][inner], unsure["last"][inner])
    left = np.concatenate(single)
    if len(left):
        chosen[left] = squared(sorted_points[left], book).argmin(1)
        np.add.at(sums, chosen[left], sorted_points[left].astype(np.int64))
        np.add.at(counts, chosen[left], 1)
    out = np.empty(len(points), dtype=np.int64)
    out[order] = chosen
    return out, sums, counts


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype("<i2") if np.abs(x).max(initial=0) < 1 << 15 else x.astype("<i4")


def _plant(width: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, POINTS):
                piece = batch.slice(at, POINTS)
                flat = piece.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                points = np.floor(flat * SCALE).astype(np.int64).reshape(-1, width)
                trees = [grow(p) for p in np.split(points, parts, axis=1)]
                stored = _narrow(points)
                yield pa.RecordBatch.from_pydict({
                    "ids": pa.array([piece.column(0).to_pylist()], pa.list_(pa.int64())),
                    "labels": pa.array([piece.column(1).to_pylist()], pa.list_(pa.string())),
                    "width": pa.array([stored.dtype.itemsize], pa.int32()),
                    "points": pa.array([stored.tobytes()], pa.binary()),
                    "orders": pa.array([[o.astype("<i4").tobytes() for o, _ in trees]], pa.list_(pa.binary())),
                    "nodes": pa.array([[n.tobytes() for _, n in trees]], pa.list_(pa.binary())),
                })

    return run


def _blocks(batch: pa.RecordBatch, width: int, parts: int):
    """Points of each part with their tree, block by block."""
    for k in range(batch.num_rows):
        row = {c: batch.column(c)[k] for c in ("width", "points", "orders", "nodes")}
        points = np.frombuffer(row["points"].as_py(), dtype=f"<i{row['width'].as_py()}").reshape(-1, width).astype(np.int64)
        orders = [np.frombuffer(o, dtype="<i4") for o in row["orders"].as_py()]
        nodes = [np.frombuffer(n, dtype=NODE) for n in row["nodes"].as_py()]
        yield k, list(zip(np.split(points, parts, axis=1), orders, nodes, strict=True))


def _gains(books: list[np.ndarray], width: int):
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = [np.zeros(b.shape, np.int64) for b in books], [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for _, trees in _blocks(batch, width, parts):
                for j, (points, order, nodes) in enumerate(trees):
                    _, more, n = assign(points, order, nodes, books[j])
                    sums[j] += more
                    counts[j] += n
        hit = [(j, e) for j in range(parts) for e in np.flatnonzero(counts[j])]
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([j for j, _ in hit], pa.int32()),
            "entry": pa.array([int(e) for _, e in hit], pa.int32()),
            "n": pa.array([int(counts[j][e]) for j, e in hit], pa.int64()),
            "sums": pa.array([sums[j][e].tolist() for j, e in hit], pa.list_(pa.int64())),
        })

    return run


def _coded(books: list[np.ndarray], width: int):
    parts = len(books)
    digits = np.array([f"{e:02x}" for e in range(ENTRIES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, trees in _blocks(batch, width, parts):
                code, error = np.array([""] * len(trees[0][0])), np.zeros(len(trees[0][0]), dtype=np.int64)
                for j, (points, order, nodes) in enumerate(trees):
                    chosen, _, _ = assign(points, order, nodes, books[j])
                    code = np.char.add(code, digits[chosen])
                    error += ((points - books[j][chosen]) ** 2).sum(1)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": batch.column("ids")[k].values,
                    "label": batch.column("labels")[k].values,
                    "code": pa.array(code.tolist(), pa.string()),
                    "error": pa.array(error, pa.int64()),
                })

    return run


def usable_vectors(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    x = F.col(f"`{vector_column}`")
    # NaN is above all numbers in comparisons
    fine = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < LARGEST))
    return vectors.where(F.coalesce(fine, F.lit(False))).select(
        F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{label_column}`").cast("string").alias("label"),
        x.cast("array<double>").alias("x"),
    )


def compress_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    parts: int = PARTS, rounds: int = ROUNDS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """``(vec_id, label, code, error)`` for each kept row, and the codebook of each part.

    ``code`` holds two hexadecimal digits for each part, ``error`` the squared distance from the coded vector.
    """
    rows = usable_vectors(vectors, id_column, vector_column, label_column)
    seeds = [r.x for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(ENTRIES).collect()]
    schema = "vec_id long, label string, code string, error long"
    if not seeds:
        return rows.sparkSession.createDataFrame([], schema), []
    width = len(seeds[0])
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    whole = rows.where(F.size("x") == width)
    if any(len(s) != width for s in seeds):
        seeds = [r.x for r in whole.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(ENTRIES).collect()]
    first = np.floor(np.array(seeds) * SCALE).astype(np.int64)
    books = [b.copy() for b in np.split(first, parts, axis=1)]
    blocks = kept_table(whole.mapInArrow(_plant(width, parts), BLOCKS), "trees")
    for _ in range(rounds):
        gained = blocks.mapInArrow(_gains(books, width), "part int, entry int, n long, sums array<long>")
        added = gained.groupBy("part", "entry").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(width // parts)]).alias("sums")
        )
        for r in added.collect():
            books[r.part][r.entry] = np.array(r.sums, dtype=np.int64) // r.n
    return blocks.mapInArrow(_coded(books, width), schema), books


def codebooks_sha256(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def coded_vectors(vectors: DataFrame) -> DataFrame:
    """Codes and errors with the error of each label's rows together and a digest of the codebooks."""
    coded, books = compress_vectors(vectors)
    coded = kept_table(coded, "codes")
    labels = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    return with_summary(coded, labels, "label", "n", coded.count()).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256")
    )
