"""Windows of many texts grouped by the anchor they share, for exact repeat search at scale.

A window is ``width`` neighbouring units (bytes or words) of one text. Its anchor is the ``gram``-unit
run in it with the least code (the leftmost of equal ones), so equal windows have equal anchors at equal
places. Neighbouring windows with the same anchor occurrence form a segment; segments cover each
window exactly once. Equal windows can only lie in segments of equal anchor code, so only segments whose
anchor occurs twice are looked at further.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import keyed, kept_table
from parcelle.llm.wordhash import _CODE, BASE, U, Words, buffers, chunks, mix
def power_table(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, base, dtype=U), np.full(n, pow(base, -1, 1 << 64), dtype=U)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U), np.cumprod(down, dtype=U)


class Codes:
    """Codes of any run of units from prefix sums of a polynomial."""

    def __init__(self, units: np.ndarray, tables: tuple[np.ndarray, np.ndarray]):
        up, self.down = tables
        self.total = np.zeros(len(units) + 1, dtype=U)
        np.cumsum(units * up[: len(units)], dtype=U, out=self.total[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.down[start])

    def grams(self, n: int) -> np.ndarray:
        out = self.total[n:] - self.total[:-n]
        out *= self.down[: len(out)]
        out ^= out >> U(32)
        out *= U(0xD6E8FEB86659FD93)
        return out


TABLE = 1 << 21
TABLES = power_table(BASE, TABLE + 1)


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    reach, out = 1, x
    while reach * 2 <= width:
        out = np.minimum(out[: len(out) - reach], out[reach:])
        reach *= 2
    if reach < width:
        out = np.minimum(out[: len(out) - (width - reach)], out[width - reach :])
    return out


def segments(units: np.ndarray, cuts: np.ndarray, width: int, gram: int):
    """Segments of the texts ``units[cuts[i]:cuts[i + 1]]``.

    Gives arrays: the text, the first window's place in it, the number of windows, the code of the
    anchor and the code of the whole segment. ``units`` are 64-bit codes, at most 2**21 of them.
    """
    n = len(units)
    if n < width:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none.astype(U), none.astype(U)
    codes = Codes(units, TABLES)
    grams = codes.grams(gram)
    packed = (grams & ~U(TABLE * 2 - 1)) | np.arange(len(grams), dtype=U)
    anchor = (sliding_least(packed, width - gram + 1) & U(TABLE * 2 - 1)).astype(np.int64)
    # windows inside one text
    lengths = np.diff(cuts)
    inside = np.zeros(len(anchor) + 1, dtype=np.int32)
    whole = lengths >= width
    np.add.at(inside, cuts[:-1][whole], 1)
    np.add.at(inside, cuts[1:][whole] - width + 1, -1)
    valid = np.cumsum(inside[:-1]) > 0
    text_start = np.zeros(len(anchor), dtype=bool)
    text_start[cuts[:-1][whole]] = True
    fresh = valid.copy()
    fresh[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1]) | text_start[1:]
    start = np.flatnonzero(fresh)
    label = np.cumsum(fresh)[valid]
    count = np.bincount(label, minlength=len(start) + 1)[1:]
    text = np.searchsorted(cuts, start, side="right") - 1
    whole_code = codes.of(start, start + count + width - 1)
    return text, start - cuts[text], count, grams[anchor[start]], whole_code


# Units handled at once; texts beyond it are taken in blocks that overlap by a window.
BLOCK = {"byte": 1 << 18, "word": 1 << 18}
# Distinct segments of one anchor in a shard; an anchor with more is dealt over several.
SHARE = 4000
SHARD_UNITS = {"byte": 1_000_000, "word": 300_000}


def blocks(units: np.ndarray, cuts: np.ndarray, width: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """``(units, cuts, first text, place of the first unit in it)`` of at most about ``size`` units."""
    for lo, hi in chunks(cuts, size):
        if hi - lo == 1 and cuts[hi] - cuts[lo] > size:
            for at in range(int(cuts[lo]), int(cuts[hi]) - width + 1, size):
                part = units[at : min(at + size + width - 1, int(cuts[hi]))]
                yield part, np.array([0, len(part)]), lo, at - int(cuts[lo])
        else:
            yield units[cuts[lo] : cuts[hi]], cuts[lo : hi + 1] - cuts[lo], lo, 0


def _units(kind: str, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first text, unit codes, cuts)`` of runs of texts."""
    raw, offsets = buffers(column)
    for lo, hi in chunks(offsets):
        if kind == "byte":
            yield lo, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        else:
            words = Words(raw, offsets[lo : hi + 1])
            yield lo, words.code, words.first


def _scan(kind: str, width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            order = batch.column("place").to_numpy(zero_copy_only=False)
            for first, units, cuts in _units(kind, batch.column("text")):
                for part, own, lo, at in blocks(units, cuts, width, BLOCK[kind]):
                    codes = _CODE[part] if kind == "byte" else part
                    text, start, count, anchor, whole = segments(codes, own, width, gram)
                    text = text + first + lo
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[text]), pa.array(order[text]), pa.array((start + at).astype(np.int64)),
                         pa.array(count.astype(np.int32)), pa.array(anchor.view(np.int64)), pa.array(whole.view(np.int64))],
                        names=["key", "place", "start", "windows", "anchor", "seg"],
                    )

    return run


def _contents(kind: str, width: int):
    """The units of each wanted segment, as bytes: the text's own bytes or 8-byte word codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("wanted").to_pylist()
            for first, units, cuts in _units(kind, batch.column("text")):
                rows = []
                for i in range(len(cuts) - 1):
                    own = units[cuts[i] : cuts[i + 1]]
                    for w in wanted[first + i]:
                        at = w["start"]
                        rows.append((w["shard"], w["anchor"], w["seg"], w["weight"], w["least"],
                                     own[at : at + w["windows"] + width - 1].tobytes()))
                if rows:
                    columns = zip(("shard", "anchor", "seg", "weight", "least", "units"), zip(*rows, strict=True), strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, pa.binary() if n == "units" else pa.int64()) for n, v in columns],
                        names=["shard", "anchor", "seg", "weight", "least", "units"],
                    )

    return run


RUNS = "array<struct<lo:int,hi:int,weight:long,least:long>>"


def runs_of(weight: np.ndarray, least: np.ndarray) -> list[dict]:
    """Equal neighbours of the per-window values as runs."""
    cut = np.flatnonzero((weight[1:] != weight[:-1]) | (least[1:] != least[:-1])) + 1
    lo, hi = np.concatenate(([0], cut)), np.concatenate((cut, [len(weight)]))
    return [
        {"lo": int(a), "hi": int(b), "weight": int(weight[a]), "least": int(least[a])} for a, b in zip(lo, hi, strict=True)
    ]


def _shard(kind: str, width: int, engine: Callable):
    """Runs of equal (weight, least place) over each segment's windows, found by ``engine`` in one shard.

    The code of each window comes along, with which anchors dealt over several shards are added up.
    """

    def run(shard: pa.Table) -> pa.Table:
        shard = shard.combine_chunks()
        units, offsets = buffers(shard.column("units").combine_chunks() if shard.num_rows else shard.column("units"))
        if kind == "word":
            units, offsets = units.view(U) if len(units) % 8 == 0 else units[: len(units) // 8 * 8].view(U), offsets // 8
        offsets = np.asarray(offsets)
        weight, least = engine(
            units[offsets[0] : offsets[-1]], offsets - offsets[0], width,
            shard.column("weight").to_numpy(), shard.column("least").to_numpy(),
        )
        ends = np.cumsum(np.diff(offsets) - width + 1)
        starts = np.concatenate(([0], ends[:-1]))
        out = [runs_of(weight[a:b], least[a:b]) for a, b in zip(starts, ends, strict=True)]
        kind_of = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32()), ("weight", pa.int64()), ("least", pa.int64())]))
        return pa.table({"anchor": shard.column("anchor"), "seg": shard.column("seg"), "runs": pa.array(out, kind_of)})

    return run


def covered(
    docs: DataFrame, id_column: str, text_column: str, kind: str, width: int, gram: int, engine: Callable,
    removed: Column,
) -> tuple[DataFrame, DataFrame]:
    """The keyed texts and ``(key, spans)``: unit ranges covered by windows that ``removed`` holds for.

    ``removed`` is a condition over weight (occurrences of the window, two standing for more), least
    (least place of a text with it) and place (this text's own).
    """
    texts = keyed(docs, id_column, text_column)
    scanned = kept_table(
        texts.select("key", "place", "text").mapInArrow(
            _scan(kind, width, gram), "key long, place long, start long, windows int, anchor long, seg long"
        ),
        "scanned",
    )
    twice = scanned.groupBy("anchor").count().where("count > 1").select("anchor")
    shared = kept_table(scanned.join(twice, "anchor"), "shared")
    classes = kept_table(
        shared.groupBy("anchor", "seg").agg(
            F.least(F.count("*"), F.lit(2)).alias("weight"),
            F.min(F.struct("place", "key", "start")).alias("owner"), F.first("windows").alias("windows"),
        ),
        "classes",
    )
    sized = classes.groupBy("anchor").agg(F.count("*").alias("kinds"))
    ranked = kept_table(classes.join(sized, "anchor"), "ranked")
    total = ranked.where("kinds > 1").agg(F.sum(F.col("windows") + width)).first()[0] or 0
    shards = int(total // SHARD_UNITS[kind]) + 1
    salt = F.pmod(F.xxhash64("seg"), F.ceil(F.col("kinds") / SHARE))
    wanted = (
        ranked.where("kinds > 1")
        .withColumn("shard", F.pmod(F.xxhash64("anchor", salt), F.lit(shards)).cast("long"))
        .groupBy(F.col("owner.key").alias("key"))
        .agg(F.collect_list(F.struct(
            "shard", "anchor", "seg", "weight", F.col("owner.place").alias("least"),
            F.col("owner.start").alias("start"), "windows")).alias("wanted"))
    )
    contents = kept_table(
        texts.join(wanted, "key").select("text", "wanted").mapInArrow(
            _contents(kind, width), "shard long, anchor long, seg long, weight long, least long, units binary"
        ),
        "contents",
    )
    found = kept_table(
        contents.groupBy("shard").applyInArrow(_shard(kind, width, engine), f"anchor long, seg long, runs {RUNS}"),
        "found",
    )
    settled = _across_shards(found, ranked, contents, kind, width)
    alone = ranked.where("kinds = 1").select(
        "anchor", "seg",
        F.array(F.struct(F.lit(0).alias("lo"), F.col("windows").alias("hi"), F.col("weight").cast("long").alias("weight"),
                         F.col("owner.place").alias("least"))).alias("runs"),
    )
    spans = (
        shared.join(settled.unionByName(alone), ["anchor", "seg"])
        .select("key", "place", "start", F.explode("runs").alias("run"))
        .select("key", "place", "start", "run.*")
        .where(removed)
        .groupBy("key")
        .agg(F.collect_list(F.struct(
            (F.col("start") + F.col("lo")).alias("a"), (F.col("start") + F.col("hi") + (width - 1)).alias("b"))).alias("spans"))
    )
    return texts, spans


def _window_codes(kind: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for anchor, seg, runs, units in zip(*(batch.column(c).to_pylist() for c in ("anchor", "seg", "runs", "units")), strict=True):
                own = _CODE[np.frombuffer(units, np.uint8)] if kind == "byte" else np.frombuffer(units, U)
                code = Codes(own, TABLES).of(np.arange(len(own) - width + 1), np.arange(width, len(own) + 1)).view(np.int64)
                out += [(anchor, seg, i, int(code[i]), r["weight"], r["least"]) for r in runs for i in range(r["lo"], r["hi"])]
            if out:
                names = ["anchor", "seg", "at", "code", "weight", "least"]
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*out, strict=True)], names=names)

    return run


def _across_shards(found: DataFrame, ranked: DataFrame, contents: DataFrame, kind: str, width: int) -> DataFrame:
    """``found``, with the windows of anchors dealt over several shards added up over them."""
    dealt = ranked.where(F.col("kinds") > SHARE).select("anchor", "seg")
    if not dealt.limit(1).count():
        return found
    each = kept_table(
        found.join(dealt, ["anchor", "seg"]).join(contents.select("anchor", "seg", "units"), ["anchor", "seg"])
        .mapInArrow(_window_codes(kind, width), "anchor long, seg long, at long, code long, weight long, least long"),
        "dealt",
    )
    summed = each.groupBy("anchor", "code").agg(
        F.least(F.sum("weight"), F.lit(2)).alias("weight"), F.min("least").alias("least")
    )
    again = (
        each.select("anchor", "seg", "at", "code").join(summed, ["anchor", "code"]).groupBy("anchor", "seg")
        .agg(F.collect_list(F.struct(F.col("at").cast("int").alias("lo"), (F.col("at") + 1).cast("int").alias("hi"),
                                     F.col("weight").cast("long").alias("weight"), "least")).alias("runs"))
    )
    return found.join(dealt, ["anchor", "seg"], "left_anti").unionByName(again)
