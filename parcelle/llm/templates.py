"""Benchmark decontamination by templates: re-parameterised questions are found like verbatim ones.

Words are lower-cased and stripped of outer punctuation; words with a digit become a number slot, units after a
number a unit slot and capitalised words inside a sentence a name slot. Windows of ``WINDOW`` such words that
hold at least ``LITERALS`` plain words are hashed and joined with the benchmark's windows. Windows of a document and an
item that lie on one diagonal (same distance of places) form a run; a run counts if its slots are consistent: each slot
value of the item stands for one value in the document and the other way round. A document is contaminated by an item
when the runs hold at least ``SHARE`` of the item's distinct windows. Items of fewer words than a window are one window;
items with fewer than ``LITERALS`` plain words say too little and match nothing.

With ``any_case`` an item also counts by its literal windows, words as they are but lower-cased and no slots: capitals
make name slots, so a copy in capitals has no template windows, and one in small letters has other ones. Full windows
need no plain words then; shorter items need ``LITERALS`` words that are neither numbers nor units.

Nulls are empty texts and match nothing; repeated items count once for each item id, repeated documents by id.
Empty tables give no contamination.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import kept_table, picked
from parcelle.llm.wordhash import U, Words, buffers, chunks, ngrams

WINDOW = 8
LITERALS = 4
SHARE = 0.5
# Window codes of the benchmark shipped to the tasks at once (16 MB); a larger benchmark takes more passes.
BLOCK = 2_000_000
# fixed values: units of measure
UNITS = (
    "mm cm m km in ft yd mi mg g kg lb oz t ml cl l gal ms s sec min h hr hrs day days week weeks month months year years "
    "km/h mph kmh hz khz mhz ghz w kw kwh v a j kj cal kcal pa bar °c °f c f € $ £ usd eur gbp percent % kb mb gb tb "
    "meter meters metre metres kilometer kilometers mile miles inch inches foot feet pound pounds gram grams kilogram "
    "kilograms liter liters litre litres second seconds minute minutes hour hours dollar dollars euro euros cent cents"
).split()
_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[[ord(c) for c in "!\"#&'()*,-./:;<=>?@[\\]^_`{|}~"]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?:"]] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_NUMBER, _NAME, _UNIT = U(0xA0761D6478BD642F), U(0xE7037ED1A0B428DB), U(0x8EBC6AF09C88C6E3)
_LITERAL = U(0x589965CC75374CC3)


class Templates(Words):
    """Words without outer punctuation; ``token`` has slots in place of numbers, names and units."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        super().__init__(raw, offsets, lower=True)
        body = np.flatnonzero(~_PUNCTUATION[self.data])
        last = self.data[self.end - 1] if len(self.end) else np.zeros(0, np.uint8)
        line = np.concatenate(([0], np.cumsum(self.data == 10)))
        opens = np.ones(len(self.start), dtype=bool)
        opens[1:] = _STOP[last[:-1]] | (line[self.start[1:]] > line[self.end[:-1]])
        opens[self.first[:-1][np.diff(self.first) > 0]] = True
        lo, hi = np.searchsorted(body, self.start), np.searchsorted(body, self.end)
        kept = np.flatnonzero(hi > lo)
        self.start, self.end, opens = body[lo[kept]], body[hi[kept] - 1] + 1, opens[kept]
        self.first = np.searchsorted(kept, self.first)
        self.code = self._codes(_lower_table())
        number = np.concatenate(([0], np.cumsum(_DIGIT[self.data])))
        number = number[self.end] > number[self.start]
        head = self.data[self.start]
        following = self.data[np.minimum(self.start + 1, max(len(self.data) - 1, 0))] if len(self.data) else head
        capital = ((head >= 65) & (head <= 90)) | ((head == 0xC3) & (following >= 0x80) & (following <= 0x9E))
        unit = np.zeros(len(self.start), dtype=bool)
        unit[1:] = number[:-1] & np.isin(self.code[1:], _unit_codes())
        first_words = self.first[:-1][np.diff(self.first) > 0]
        unit[first_words] = False
        name = capital & ~opens & ~number & ~unit
        self.slot = number | name | unit
        self.value = number | unit
        self.token = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, self.code)))

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and codes of all windows inside one text with enough plain words."""
        owner = self.owner()
        codes = ngrams(self.token, length)
        plain = np.concatenate(([0], np.cumsum(~self.slot)))
        at = np.arange(len(codes))
        good = (owner[at] == owner[at + length - 1]) & (plain[at + length] - plain[at] >= LITERALS) if len(codes) else at > 0
        return at[good], codes[good] ^ U(length)

    def literal_windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and codes of all case-blind windows inside one text; short ones need enough plain words."""
        owner = self.owner()
        codes = ngrams(self.code, length)
        at = np.arange(len(codes))
        good = owner[at] == owner[at + length - 1] if len(codes) else at > 0
        if length < WINDOW and len(codes):
            plain = np.concatenate(([0], np.cumsum(~self.value)))
            good &= plain[at + length] - plain[at] >= LITERALS
        return at[good], codes[good] ^ U(length) ^ _LITERAL

    def slots(self, at: int, length: int) -> list[str]:
        """Values of the slots of a window, each with its distance from the window's start."""
        return [
            self.data[self.start[k] : self.end[k]].tobytes().decode("utf-8", "replace").lower()
            for k in range(at, at + length) if self.slot[k]
        ]


def _lower_table() -> np.ndarray:
    from parcelle.llm import wordhash

    return wordhash._LOWER


_UNITS: list[np.ndarray] = []


def _unit_codes() -> np.ndarray:
    if not _UNITS:
        raw, offsets = buffers(pa.array(UNITS))
        _UNITS.append(np.sort(Words(raw, offsets, lower=True).code))
    return _UNITS[0]


def _item_windows(any_case: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = buffers(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            out = []
            for i in range(batch.num_rows):
                item = Templates(raw, offsets[i : i + 2])
                length = min(WINDOW, len(item.token))
                if not length:
                    continue
                out += [(ids[i], False, int(a), length, int(c.view(np.int64)), item.slots(a, length))
                        for a, c in zip(*item.windows(length), strict=True)]
                if any_case:
                    out += [(ids[i], True, int(a), length, int(c.view(np.int64)), [])
                            for a, c in zip(*item.literal_windows(length), strict=True)]
            if out:
                kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, k) for v, k in zip(zip(*out, strict=True), kinds, strict=True)],
                    names=["item_id", "literal", "at", "length", "code", "slots"],
                )

    return run


def _doc_windows(wanted: np.ndarray, lengths: list[int], any_case: bool):
    """Windows of documents whose code is among the sorted ``wanted``."""
    shift = U(64 - 22)
    marked = np.zeros(1 << 22, dtype=bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked[(wanted >> shift).astype(np.int64)] = True
        for batch in batches:
            raw, offsets = buffers(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for lo, hi in chunks(offsets, 1 << 20):
                words = Templates(raw, offsets[lo : hi + 1])
                owner = words.owner()
                for length, literal in ((n, k) for n in lengths for k in ((False, True) if any_case else (False,))):
                    at, codes = words.literal_windows(length) if literal else words.windows(length)
                    likely = marked[(codes >> shift).astype(np.int64)]
                    at, codes = at[likely], codes[likely]
                    spot = np.searchsorted(wanted, codes)
                    hit = wanted[np.minimum(spot, len(wanted) - 1)] == codes
                    at, codes = at[hit], codes[hit]
                    if len(at):
                        text = owner[at]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids[lo + text]), pa.array((at - words.first[text]).astype(np.int64)),
                             pa.array(codes.view(np.int64)),
                             pa.array([[] if literal else words.slots(int(a), length) for a in at], pa.list_(pa.string()))],
                            names=["doc_id", "place", "code", "values"],
                        )

    return run


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text: str = "text", share: float = SHARE, block: int = BLOCK,
    any_case: bool = False,
) -> DataFrame:
    """``(doc_id, item_id, share)`` for each document and item it is contaminated by; documents without an id are left out.

    With ``any_case`` copies that differ in capitals are found too; the share is the greater one of both kinds of windows.
    """
    items = kept_table(
        picked(benchmark, item_column, item_text)
        .mapInArrow(_item_windows(any_case), "item_id long, literal boolean, at long, length int, code long, slots array<string>")
        .groupBy("item_id", "literal", "code").agg(F.min_by(F.struct("at", "length", "slots"), "at").alias("w"))
        .select("item_id", "literal", "code", "w.*"),
        "items",
    )
    sizes = items.groupBy("item_id", "literal").agg(F.count("*").alias("windows"))
    texts = picked(docs, id_column, text_column).where("doc_id is not null")
    codes = items.select("code").distinct()
    passes = -(-codes.count() // block)
    lengths = sorted(r.length for r in items.select("length").distinct().collect())  # at most WINDOW rows
    hits = None
    for k in range(max(1, passes)):
        part = codes.where(F.pmod(F.xxhash64("code"), F.lit(max(1, passes))) == k)
        wanted = np.sort(np.array([r.code for r in part.collect()], dtype=np.int64).view(U))  # about ``block`` at most
        if not len(wanted) and k:
            continue
        wanted = wanted if len(wanted) else np.array([0], dtype=U)
        found = texts.mapInArrow(
            _doc_windows(wanted, lengths, any_case), "doc_id long, place long, code long, values array<string>"
        )
        hits = found if hits is None else hits.unionByName(found)
    paired = hits.join(items, "code").select(
        "doc_id", "item_id", "literal", "code", (F.col("place") - F.col("at")).alias("diagonal"),
        F.arrays_zip(F.col("slots").alias("mine"), F.col("values").alias("theirs")).alias("pairs"),
    )
    runs = paired.groupBy("doc_id", "item_id", "literal", "diagonal").agg(
        F.collect_set("code").alias("codes"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs")
    )
    whole = F.size("pairs")
    consistent = (F.size(F.array_distinct(F.col("pairs.mine"))) == whole) & (
        F.size(F.array_distinct(F.col("pairs.theirs"))) == whole
    )
    counted = runs.where(consistent).groupBy("doc_id", "item_id", "literal").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("codes")))).alias("matched")
    )
    return (
        counted.join(sizes, ["item_id", "literal"])
        .groupBy("doc_id", "item_id").agg(F.max(F.col("matched") / F.col("windows")).alias("share"))
        .where(F.col("share") >= share)
    )
