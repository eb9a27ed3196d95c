"""Near-duplicate documents by SetSketch registers.

A set's register i is ``floor(1 - log_b(min x_i))`` over its shingles, where x_i is exponential and
derived from the shingle's code, cut to 16 bits: registers of two sets merge by their maximum and
agree with a probability close to the Jaccard similarity. Bands of registers bring candidates together,
a likelihood estimate from the numbers of larger, smaller and equal registers sorts out distant ones,
and the rest is confirmed on the full shingle sets.

Documents with equal sets form one class; only class representatives are compared. In a bucket of at most
``SMALL`` members all pairs are compared, a bounded number for each member. In a larger one the member that meets most
others is the hub, and all members are compared with it only. Any text may serve as a hub, so buckets take the hub that
most of their members know (``_hubs``): a group that meets in many buckets is compared with one hub. Let d be the exact
distance (one less similarity) and a link d <= t. Then for members x, y:

* if both are linked with the hub, they are connected already;
* if x is not linked with the hub, a link of x and y forces them to share differences from the hub, that is
  shingles both lack of it or both have beyond it, and more of them the more y has. So for members up to 2t it is enough to
  join differences, for y only the rarest ones, as in prefix filtering (``_by_differences`` has the bound). Copies with
  unrelated edits share none, so a group of near copies does not yield its pairs;
* if x is beyond 2t, y is not linked with the hub either. All that are not linked go on to the next round, where the rest of
  the bucket has a hub of its own; a rest without any x beyond 2t is settled by differences. Rests of at most ``SMALL`` members are compared in pairs. What is left after ``ROUNDS``
  rounds are texts that met by chance; those beyond 2t of their first hub are joined with all left on their rarest
  shingles, which is the same bound with an empty hub.

Nulls and empty texts: no shingles, linked with nothing. A row without an id takes the component of
its text but names none. Repeated rows: each gives a row; equal texts are linked. Empty tables give
empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import components, kept_table, picked
from parcelle.llm.wordhash import U, Words, buffers, chunks, mix, shingle_sets

REGISTERS = 128
# 4 registers a band: a pair at 0.8 shares none of 32 bands with probability 5e-8.
BAND = 4
BASE = 1.001
# Sets of up to 1e9 shingles stay inside 16 bits: the least minimum is about 1e-11.
LIMIT = (1 << 16) - 2
_SEEDS = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 63, REGISTERS, dtype=U) | U(1)
_ADDED = np.random.Generator(np.random.PCG64(12)).integers(1, 1 << 63, REGISTERS, dtype=U)
_LOG_BASE = float(np.log(BASE))
# Shifts registers into 0..LIMIT; x beyond this spacing is cut.
_SHIFT = 10_000
# Standard deviations of the estimate allowed below the threshold before a pair is dropped.
SLACK = 6.0
# Members of a bucket whose pairs are all compared; rounds of hubs.
SMALL = 8
ROUNDS = 3
# Counters of coarse frequencies: a power of two up to this many (16 MB), sent by tasks in so many slices.
MOST_COUNTERS = 1 << 22
SLICES = 16


def registers(code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(texts, REGISTERS) of 16-bit registers of the shingle sets ``code[first[i]:first[i + 1]]``.

    Minima of the 64-bit hashes are taken first: the exponential variable grows with the hash, so
    cutting the minimum equals the maximum of the cut values.
    """
    n = len(first) - 1
    out = np.zeros((n, REGISTERS), dtype=np.uint16)
    full = np.flatnonzero(np.diff(first) > 0)
    if not len(full):
        return out
    cuts = first[:-1][full]
    for i in range(REGISTERS):
        h = code ^ _ADDED[i]
        h *= _SEEDS[i]
        least = np.minimum.reduceat(h, cuts)
        x = -np.log1p(-np.clip((least.astype(np.float64) + 0.5) / 2.0**64, 1e-20, 1 - 1e-16))
        k = np.floor(1 - np.log(x) / _LOG_BASE) + _SHIFT
        out[full, i] = np.clip(k, 0, LIMIT).astype(np.uint16)
    return out


def estimate(mine: np.ndarray, other: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of register rows of sets of sizes ``n`` and ``m``.

    With u = n/(n+m), v = m/(n+m) and similarity J, a register of the first set is larger with
    probability u - v J, of the second with v - u J, and both are equal with J (the base is close
    to 1). The logarithm is concave in J, so its slope is bisected.
    """
    plus, minus = (mine > other).sum(1), (mine < other).sum(1)
    same = mine.shape[1] - plus - minus
    u, v = n / (n + m), m / (n + m)
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(25):
        j = (low + high) / 2
        slope = (
            same / np.maximum(j, 1e-9)
            - plus * v / np.maximum(u - v * j, 1e-9)
            - minus * u / np.maximum(v - u * j, 1e-9)
        )
        low, high = np.where(slope > 0, j, low), np.where(slope > 0, high, j)
    return (low + high) / 2


def _sketch(shingle_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = buffers(batch.column(1))
            for lo, hi in chunks(offsets):
                code, first = shingle_sets(Words(raw, offsets[lo : hi + 1], lower=True), shingle_words)
                rows = registers(code, first)
                sizes = np.diff(first)
                keys = [hashlib.blake2b(code[first[i] : first[i + 1]].tobytes(), digest_size=16).digest()
                        for i in range(hi - lo)]
                bands = rows.reshape(len(rows), -1, BAND).astype(U)
                band = np.broadcast_to(np.arange(bands.shape[1], dtype=U), bands.shape[:2]).copy()
                for k in range(BAND):
                    band = mix(band * U(1 << 17) + bands[:, :, k] + (band >> U(47)))
                flat = pa.array(band.view(np.int64).ravel())
                ends = pa.array(np.arange(0, flat.__len__() + 1, bands.shape[1], dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(keys, pa.binary()),
                        pa.array([r.tobytes() for r in rows], pa.binary()),
                        pa.ListArray.from_arrays(ends, flat),
                    ],
                    names=["doc_id", "n_shingles", "set_key", "sketch", "bands"],
                )

    return run


def _likely(at_least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
                for c in ("sketch_a", "sketch_b")
            )
            n, m = (batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
            fit = pa.array(estimate(x, y, n, m) >= at_least)
            yield batch.select(["a", "b"]).filter(fit)

    return run


def _shared(shingle_words: int, within: float | None = None):
    """Sizes of intersection and union; of pairs up to the distance ``within`` also the differences of a from b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = buffers(batch.column("text_a"))
            raw_b, offsets_b = buffers(batch.column("text_b"))
            for lo, hi in chunks(offsets + offsets_b):
                code, first = shingle_sets(Words(raw, offsets[lo : hi + 1], lower=True), shingle_words)
                other, second = shingle_sets(Words(raw_b, offsets_b[lo : hi + 1], lower=True), shingle_words)
                both, total, more, less = [], [], [], []
                for i in range(hi - lo):
                    x, y = code[first[i] : first[i + 1]], other[second[i] : second[i + 1]]
                    merged = np.concatenate((x, y))
                    merged.sort(kind="stable")
                    shared = int((merged[1:] == merged[:-1]).sum())
                    both.append(shared)
                    total.append(len(merged) - shared)
                    if within is not None:
                        close = total[-1] - shared <= within * total[-1]
                        more.append(np.setdiff1d(x, y, assume_unique=True).view(np.int64) if close else None)
                        less.append(np.setdiff1d(y, x, assume_unique=True).view(np.int64) if close else None)
                columns = [batch.column("a").slice(lo, hi - lo), batch.column("b").slice(lo, hi - lo),
                           pa.array(both, pa.int64()), pa.array(total, pa.int64())]
                names = ["a", "b", "shared", "total"]
                if within is not None:
                    columns += [pa.array(np.diff(first)), pa.array(np.diff(second)),
                                pa.array(more, pa.list_(pa.int64())), pa.array(less, pa.list_(pa.int64()))]
                    names += ["n_a", "n_b", "more", "less"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _full(shingle_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = buffers(batch.column("text"))
            for lo, hi in chunks(offsets):
                code, first = shingle_sets(Words(raw, offsets[lo : hi + 1], lower=True), shingle_words)
                lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(code.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(lo, hi - lo), pa.array(np.diff(first)), lists], names=["a", "n_a", "more"]
                )

    return run


def _slots(hub: np.ndarray, side: np.ndarray, x: np.ndarray, counters: int) -> np.ndarray:
    """The counter of each difference ``x`` of a hub; ``side`` 1 is beyond it, 0 lacking."""
    return (mix(x.view(U) ^ mix(hub.view(U) * U(2) + side.astype(U))) & U(counters - 1)).astype(np.int64)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, side and code of all differences of a batch."""
    rows, sides, codes = [], [], []
    for side, name in ((1, "more"), (0, "less")):
        column = batch.column(name)
        values = column.flatten().to_numpy()
        rows.append(np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy())))
        sides.append(np.full(len(values), side, dtype=np.int32))
        codes.append(values)
    return np.concatenate(rows), np.concatenate(sides), np.concatenate(codes)


def _tally(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(counters, dtype=np.int32)
        for batch in batches:
            row, side, x = _flat(batch)
            hub = batch.column("hub").to_numpy()
            counts += np.bincount(_slots(hub[row], side, x, counters), minlength=counters).astype(np.int32)
        if counts.any():
            parts = [part.tobytes() for part in np.split(counts, SLICES)]
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())], names=["slice", "counts"])

    return run


def _added(table: pa.Table) -> pa.Table:
    """One slice of counters from those of all tasks."""
    total = sum(np.frombuffer(part.as_py(), dtype=np.int32).astype(np.int64) for part in table.column("counts"))
    capped = np.minimum(total, np.iinfo(np.int32).max).astype(np.int32)
    return pa.table({"slice": table.column("slice").slice(0, 1), "counts": pa.array([capped.tobytes()], pa.binary())})


def _prefixes(own: list[str], frequencies: Broadcast):
    """The first ``reach`` differences of each row, rarest first by the coarse frequencies, with their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.frombuffer(frequencies.value, dtype=np.int32)
        for batch in batches:
            row, side, x = _flat(batch)
            often = counts[_slots(batch.column("hub").to_numpy()[row], side, x, len(counts))]
            order = np.lexsort((x, side, often, row))
            sizes = np.bincount(row, minlength=batch.num_rows)
            place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            first = place < batch.column("reach").to_numpy()[row[order]]
            order, place = order[first], place[first]
            whose = pa.array(row[order])
            columns = [batch.column(c).take(whose) for c in own]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(side[order]), pa.array(x[order]), pa.array(place)], names=[*own, "side", "x", "r"]
            )

    return run


class _Tests:
    """Comparisons of representatives by their sketches and full texts."""

    def __init__(self, sketches: DataFrame, texts: DataFrame, shingle_words: int, percent: int):
        self.sketches, self.texts, self.shingle_words, self.percent = sketches, texts, shingle_words, percent

    def _with_texts(self, pairs: DataFrame, steady: bool) -> DataFrame:
        # the large joins are planned alike at every size; small rounds are left to the planner
        texts = self.texts.hint("merge") if steady else self.texts
        half = lambda c: texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}"))
        return pairs.join(half("a"), "a").join(half("b"), "b").select("a", "b", "text_a", "text_b")

    def confirmed(self, pairs: DataFrame, steady: bool = False) -> DataFrame:
        """Those of ``pairs(a, b)`` that are linked: likely by the sketches, then confirmed on the full sets."""
        threshold = self.percent / 100
        at_least = threshold - SLACK * (threshold * (1 - threshold) / REGISTERS) ** 0.5
        side = lambda c: self.sketches.select(
            F.col("node").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}")
        )
        sized = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * self.percent
        likely = kept_table(
            pairs.join(side("a"), "a").join(side("b"), "b").where(sized).mapInArrow(_likely(at_least), "a long, b long"),
            "likely",
        )
        sizes = self._with_texts(likely, steady).mapInArrow(
            _shared(self.shingle_words), "a long, b long, shared long, total long"
        )
        return kept_table(sizes.where(F.col("shared") * 100 >= F.col("total") * self.percent).select("a", "b"), "linked")

    def sets(self, nodes: DataFrame) -> DataFrame:
        """The full sets of ``nodes(node, far)``, as differences from an empty hub."""
        own = nodes.join(self.texts.withColumnRenamed("doc_id", "node"), "node").select("node", "text")
        sets = own.mapInArrow(_full(self.shingle_words), "a long, n_a long, more array<long>")
        return sets.join(nodes.select(F.col("node").alias("a"), "far"), "a").select(
            "far", F.lit(True).alias("any"),
            "a", F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("shared"), "n_a",
            F.lit(0).cast("long").alias("n_b"), "more", F.array().cast("array<long>").alias("less"),
        )

    def measured(self, pairs: DataFrame, steady: bool) -> DataFrame:
        """Exact sizes of members ``a`` and hubs ``b``, with the differences where they may matter."""
        within = 2 * (1 - self.percent / 100) + 1e-9
        return kept_table(
            self._with_texts(pairs, steady).mapInArrow(
                _shared(self.shingle_words, within),
                "a long, b long, shared long, total long, n_a long, n_b long, more array<long>, less array<long>",
            ),
            "measured",
        )


def _small_pairs(members: DataFrame) -> DataFrame:
    """Pairs of each bucket of ``members(bucket, node, far)`` with at least one that is ``far``."""
    left, right = members.alias("l"), members.alias("r")
    meet = (F.col("l.bucket") == F.col("r.bucket")) & (F.col("l.node") < F.col("r.node"))
    return left.join(right, meet & (F.col("l.far") | F.col("r.far"))).select(
        F.col("l.node").alias("a"), F.col("r.node").alias("b")
    )


def _hubs(active: DataFrame) -> DataFrame:
    """A hub for each bucket: of its members' best hubs, each the strongest of their buckets, the one named most."""
    first = active.groupBy("bucket").agg(F.max(F.struct("degree", (-F.col("node")).alias("less"))).alias("hub"))
    best = active.join(first, "bucket").groupBy("node").agg(F.max("hub").alias("hub"))
    votes = active.select("bucket", "node").join(best, "node").groupBy("bucket", "hub").agg(F.count("*").alias("votes"))
    return votes.groupBy("bucket").agg((-F.max_by("hub.less", F.struct("votes", "hub"))).alias("hub"))


def _hub_rounds(members: DataFrame, tests: _Tests) -> tuple[list[DataFrame], list[DataFrame], DataFrame]:
    """Measured (member, hub) pairs of each round, the pairs of rests that are small, and the nodes left."""
    degrees = members.groupBy("node").agg(F.sum("n").alias("degree"))
    active = kept_table(members.select("bucket", "node").join(degrees, "node").withColumn("far", F.lit(False)), "active")
    measured, direct = [], []
    for k in range(ROUNDS):
        asked = kept_table(active.join(_hubs(active), "bucket").where("node <> hub"), "asked")
        pairs = kept_table(asked.select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct(), "hub-pairs")
        # a hub of one bucket can be a later hub of another one, so a pair may come again; it is measured once, as a second
        # row would count its differences twice and halve the prefix of ``_by_differences``
        again = None
        for earlier in measured:
            known = earlier.select("a", "b", "shared", "total").join(pairs, ["a", "b"])
            again = known if again is None else again.unionByName(known)
        new = pairs if again is None else pairs.join(again.select("a", "b"), ["a", "b"], "left_anti")
        found = tests.measured(new, steady=k == 0)
        # two members that are both not linked are joined for their first hub only; later ones see them again as ``far``
        measured.append(found.withColumn("any", F.lit(k == 0)))
        apart = F.col("shared") * 100 < F.col("total") * tests.percent
        # without differences measured, a member is beyond two links of its hub
        beyond = F.col("more").isNull() if k == 0 else F.lit(False)
        judged = found if again is None else found.select("a", "b", "shared", "total").unionByName(again)
        rest = asked.join(
            judged.where(apart).select(F.col("a").alias("node"), F.col("b").alias("hub"), beyond.alias("beyond")), ["node", "hub"]
        ).select("bucket", "node", "degree", (F.col("far") | F.col("beyond")).alias("far"))
        # members within two links of their first hub meet there; only those beyond it need another
        open_rests = rest.groupBy("bucket").agg(F.count("*").alias("n"), F.max("far").alias("open")).where("n > 1 and open")
        sized = kept_table(rest.join(open_rests.drop("open"), "bucket"), "rest")
        direct.append(_small_pairs(sized.where(F.col("n") <= SMALL).select("bucket", "node", "far")))
        active = sized.where(F.col("n") > SMALL).select("bucket", "node", "degree", "far")
        if not active.limit(1).count():
            break
    return measured, direct, active.groupBy("node").agg(F.max("far").alias("far"))


def _by_differences(measured: DataFrame, component: DataFrame, percent: int) -> DataFrame:
    """Pairs of members x, y of one hub h that may be linked, where x is not linked with h, or h is empty and x is ``far``.

    With m the shingles of h that a member lacks, u those it has beyond h, and c = percent / (100 + percent), x and y are
    linked iff |x & y| >= c (|x| + |y|), that is iff they share at least
    ``s(x) + c |u(y)| + (1 - c) |m(y)|`` differences, where ``s(x) = c (|x| + |h|) - |x & h|`` is above 0 unless x is linked with h.
    So at least one of the shared ones is among y's first ``(1 - c) |u(y)| + c |m(y)| - s(x)`` and one more in any order;
    rarest first leaves the fewest pairs. The first shared one is also so far from x's end that the rest of x's differences
    can hold the others, and sizes of linked sets differ by ``percent`` at most. All terms are multiplied by 100 + percent to
    stay whole. Only differences within these places, for the least other side a row can meet, become rows; as any order will do,
    they are sorted by coarse frequencies, counted beforehand in a fixed number of counters.
    """
    p = percent
    short = (F.col("n_a") + F.col("n_b")) * p - F.col("shared") * (100 + p)
    known = measured.where("more is not null").select(
        F.col("a").alias("node"), F.col("b").alias("hub"), short.alias("short"),
        (F.size("more") * 100 + F.size("less") * p).cast("long").alias("bound"),
        (F.size("more") * p + F.size("less") * 100).cast("long").alias("cost"),
        F.col("n_a").alias("n"), F.col("n_b").alias("n_hub"), "far", "any", "more", "less",
    ).join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # only hubs with several components, and members whose first differences reach the least open one of their hub, take part
    open_hubs = known.groupBy("hub").agg(
        F.min(F.when(F.expr("short > 0 and far"), F.col("short"))).alias("least"), F.min("component").alias("low"), F.max("component").alias("high")
    ).where("least is not null and low < high").select("hub", "least")
    # a node linked with x costs at least p % of its bound, which reaches s(x); with an empty hub s(x) is p |x|, and |x| at least p % of |y|
    as_x = F.floor((F.col("bound") + F.col("cost") - F.col("short") * (100 + p) / 100) / (100 + p)) + 1
    least = F.when(F.col("n_hub") == 0, F.greatest("least", F.col("n") * p * p / 100)).otherwise(F.col("least"))
    as_y = F.floor((F.col("bound") - least) / (100 + p)) + 1
    reach = F.greatest(F.when(F.expr("short > 0 and far"), as_x).otherwise(0), F.when(F.expr("short <= 0 or `any`"), as_y).otherwise(0))
    own = ["hub", "node", "component", "short", "bound", "cost", "n", "far", "any"]
    taking = kept_table(
        known.join(open_hubs, "hub").where("bound >= least").select(*own, reach.cast("long").alias("reach"), "more", "less"), "taking"
    )
    total = taking.agg(F.sum(F.size("more") + F.size("less")).cast("long")).first()[0] or 0
    counters = min(MOST_COUNTERS, 1 << max(12, total.bit_length() - 2))
    tallied = taking.select("hub", "more", "less").mapInArrow(_tally(counters), "slice int, counts binary")
    slices = {r["slice"]: bytes(r.counts) for r in tallied.groupBy("slice").applyInArrow(_added, "slice int, counts binary").collect()}
    frequencies = taking.sparkSession.sparkContext.broadcast(
        b"".join(slices[k] for k in range(SLICES)) if slices else bytes(4 * counters)
    )
    types = dict(taking.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in own) + ", side int, x long, r long"
    marks = kept_table(taking.where("reach > 0").mapInArrow(_prefixes(own, frequencies), schema), "differences")
    x = marks.where("short > 0 and far").alias("p")
    y = marks.where("short <= 0 or `any`").where(F.col("r") * (100 + p) <= F.col("bound")).alias("q")
    same = [F.col(f"p.{c}") == F.col(f"q.{c}") for c in ("hub", "side", "x")]
    sized = F.least("p.n", "q.n") * 100 >= F.greatest("p.n", "q.n") * p
    # bound and cost of a member add up to all its differences
    enough = (F.col("q.r") * (100 + p) + F.col("p.short") <= F.col("q.bound")) & (
        F.col("p.r") * (100 + p) + F.col("p.short") + F.col("q.cost") <= F.col("p.bound") + F.col("p.cost")
    )
    meet = same[0] & same[1] & same[2] & (F.col("p.component") != F.col("q.component")) & sized & enough
    return x.join(y, meet).select(F.least("p.node", "q.node").alias("a"), F.greatest("p.node", "q.node").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle_words: int = 5, percent: int = 80,
) -> DataFrame:
    """A row ``(doc_id, n_shingles, component_id, kept)`` for each document.

    ``component_id`` is the least id reachable over links of at least ``percent`` percent shared
    shingles; ``kept`` marks the document that carries it. Rows that share an id are one document.
    """
    texts = picked(docs, id_column, text_column)
    sketched = kept_table(
        texts.mapInArrow(
            _sketch(shingle_words),
            "doc_id long, n_shingles long, set_key binary, sketch binary, bands array<long>",
        ),
        "sketched",
    )
    usable = sketched.where("n_shingles > 0 and doc_id is not null")
    classes = kept_table(
        usable.groupBy("set_key").agg(
            F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"),
            F.first("sketch").alias("sketch"), F.first("bands").alias("bands"),
        ),
        "classes",
    )
    spread = classes.select(F.explode("bands").alias("bucket"), "node")
    sizes = spread.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = kept_table(spread.join(sizes, "bucket"), "members")
    sketches = classes.select("node", "n_shingles", "sketch").dropDuplicates(["node"])
    nodes = members.select(F.col("node").alias("doc_id")).distinct()
    needed = kept_table(
        texts.join(nodes.hint("merge"), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")), "texts"
    )
    tests = _Tests(sketches, needed, shingle_words, percent)
    measured, direct, left = _hub_rounds(members.where(F.col("n") > SMALL), tests)
    small = _small_pairs(members.where(F.col("n") <= SMALL).select("bucket", "node", F.lit(True).alias("far")))
    for pairs in direct:
        small = small.union(pairs)
    links = tests.confirmed(small.distinct(), steady=True)
    with_hubs = measured[0]
    for found in measured[1:]:
        with_hubs = with_hubs.unionByName(found)
    hub_links = with_hubs.where(F.col("shared") * 100 >= F.col("total") * percent).select("a", "b")
    first = kept_table(components(links.union(hub_links)), "components")
    maybe = _by_differences(with_hubs.drop("total").withColumn("far", F.lit(True)).unionByName(tests.sets(left)), first, percent)
    second = tests.confirmed(maybe)
    named = first.select(F.col("node"), "component")
    bridges = (
        second.join(named.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left")
        .join(named.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
        .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    )
    merged = components(bridges).select(F.col("node").alias("component"), F.col("component").alias("joined"))
    # rows that share an id belong together, as do rows of equal sets
    owned = classes.select("set_key", "node").join(first, "node", "left").select(
        "set_key", F.coalesce("component", "node").alias("component")
    )
    final = owned.join(merged, "component", "left").select(
        "set_key", F.coalesce("joined", "component").alias("component_id")
    )
    out = sketched.drop("sketch", "bands").join(final, "set_key", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
