"""Conversation structure repair: turns are aligned with the alternating grammar at least cost.

A legal conversation's role initials are ``(s?(ua)+)?``. Keeping a turn costs 0, giving it the role user or assistant 1, deleting
it 2 (blank turns and repeats must go), inserting an empty turn 5, and a truncated turn that stays adds 5. For each length the
grammar has one string, so the turns are aligned with each feasible length by Wagner and Fischer's table. The strings share
their ends, so one table over "turns left, symbols left" serves all lengths. A repair that leaves turns in place gives the incumbent
cost; with the unavoidable costs it bounds inserts and deletions, and only Ukkonen's band of cells within that bound is filled.
Each length (and place of the ``s``) that reaches the least cost is backtraced to its audit, and the ASCII-least audit wins.

Scale: turns are range-partitioned by (conversation, turn, role, text) and numbered, so a conversation of any length is spread
over partitions. Blocks of up to ``ROWS`` turns are aligned with every part of the string that may fall to them, from each state
before to each state after. Costs to go stream backwards through each conversation's blocks, which then know what each exit
costs and align once more for the audits, in any task; last the audits and turns stream forwards. Both streams hold one block
at a time. Cutting changes no result: the audit of a block ends in a turn's letter, so no least audit is a prefix of another.

Turns are ordered by (turn, role, text), null turns first; null roles and texts are one space. A null conversation id is a
conversation of its own. Roles count by their initial; other initials than s, u and a are illegal. Repeated rows are repeated turns.
Empty texts are blank. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelle.llm.common import kept_table

ROWS = 1024
RELABEL, DELETE, INSERT, TRUNCATED, FAR = 1, 2, 5, 5, 1 << 28
# States: no symbol yet, then the last symbol.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
# What it costs to end a conversation in each state, and how.
END, TAIL = (0, 2 * INSERT, INSERT, 0), ("", "II", "I", "")
SOLID = r"[^\x20\x09-\x0D]"
# A turn's symbol is a letter: initial s, u, a or other, times fine, must go, truncated.
FINE, GONE, CUT = range(3)


def symbol(initial: int, fault: int) -> str:
    return chr(65 + 3 * initial + fault)


def after(state: int) -> int:
    """The symbol that follows a state, apart from a leading system turn."""
    return ASSISTANT if state == USER else USER


class Block:
    """Alignment of up to some thousand turns, given as a string of symbols."""

    def __init__(self, pattern: str):
        code = np.frombuffer(pattern.encode(), dtype=np.uint8).astype(np.int64) - 65
        self.n, fault = len(code), code % 3
        self.initial = code // 3 + 1  # as states: SYSTEM, USER, ASSISTANT, or 4
        self.must_go, self.extra = fault == GONE, np.where(fault == CUT, TRUNCATED, 0)
        self.tables = {t: self._table(t) for t in (USER, ASSISTANT)}

    def _incumbent(self, leave: int) -> int:
        """Cost of a repair that ends in ``leave``, from whatever state: from the end on, turns that fit stay, one that doesn't goes
        if the turn before it fits, or changes its role; an insert in front covers the state before."""
        fine = self.initial[~self.must_go & (self.extra == 0)].tolist()
        cost, wanted = DELETE * (self.n - len(fine)), leave
        for k in range(len(fine) - 1, -1, -1):
            if fine[k] != wanted and k and fine[k - 1] == wanted:
                cost += DELETE
                continue
            cost += RELABEL * (fine[k] != wanted)
            wanted = after(wanted)
        return min(cost + INSERT, DELETE * self.n + 2 * INSERT) if fine else DELETE * self.n + 2 * INSERT

    def _table(self, leave: int) -> np.ndarray:
        """cost[i, r] of aligning the turns from i on with the last r symbols of a string that ends in ``leave``."""
        n, fine = self.n, ~self.must_go & (self.extra == 0)
        keepable = np.append(np.cumsum((~self.must_go)[::-1])[::-1], 0)
        surely = np.append(np.cumsum(fine[::-1])[::-1], 0)
        spare = max(self._incumbent(leave) - DELETE * (n - int(surely[0])), 0)
        low, high = np.maximum(surely - spare // DELETE, 0), keepable + spare // INSERT
        width = int(high.max()) + 1
        cost = np.full((n + 1, width), FAR, dtype=np.int64)
        cost[n, 0] = 0
        count = np.arange(width)
        wanted = np.where((count % 2 == 1) == (leave == USER), USER, ASSISTANT)
        rise = INSERT * count
        for i in range(n - 1, -1, -1):
            a, b = int(low[i]), int(high[i]) + 1
            best = cost[i + 1, a:b] + DELETE
            if not self.must_go[i]:
                stay = np.full(b - a, FAR, dtype=np.int64)
                c = max(a, 1)
                stay[c - a :] = cost[i + 1, c - 1 : b - 1] + RELABEL * (wanted[c:b] != self.initial[i]) + self.extra[i]
                best = np.minimum(best, stay)
            best = np.minimum.accumulate(best - rise[a:b]) + rise[a:b]
            cost[i, a:b] = np.minimum(best, FAR)
        return cost

    def _strings(self, entry: int, leave: int) -> np.ndarray:
        """Numbers of symbols of the strings from one state to another."""
        r = np.arange(self.tables[leave].shape[1])
        # the first of r symbols is ``leave`` itself if r is odd
        fits = ((r % 2 == 1) == (after(entry) == leave)) & (r > 0)
        if entry == leave:
            fits[0] = True
        return r[fits]

    def _leading(self) -> np.ndarray:
        """Turns that may be the leading system turn."""
        return np.flatnonzero((self.initial == SYSTEM) & ~self.must_go)

    def _with_system(self, leave: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cost by leading turn and string of all repairs with a leading system turn, those turns, and the string lengths."""
        at, r = self._leading(), self._strings(SYSTEM, leave)
        cost = (DELETE * at + self.extra[at])[:, None] + self.tables[leave][at + 1][:, r]
        return cost, at, r

    def costs(self) -> np.ndarray:
        """Least cost from each state to each state."""
        out = np.full((4, 4), FAR, dtype=np.int64)
        gone = DELETE * self.n
        out[START, START] = out[SYSTEM, SYSTEM] = gone
        at = self._leading()
        if len(at):
            out[START, SYSTEM] = gone - DELETE + self.extra[at].min()
        for leave in (USER, ASSISTANT):
            for entry in range(4):
                r = self._strings(entry, leave)
                out[entry, leave] = self.tables[leave][0, r].min(initial=FAR)
            if len(at):
                out[START, leave] = min(out[START, leave], self._with_system(leave)[0].min(initial=FAR))
        return np.minimum(out, FAR)

    def _trace(self, i: int, r: int, leave: int) -> str:
        """The ASCII-least audit of least cost from a cell on."""
        cost, out = self.tables[leave], []
        while i < self.n:
            now = cost[i, r]
            wanted = leave if r % 2 == 1 else after(leave)
            if cost[i + 1, r] + DELETE == now:
                out.append("D")
                i += 1
            elif r and cost[i, r - 1] + INSERT == now:
                out.append("I")
                r -= 1
            else:
                out.append("K" if self.initial[i] == wanted else "R")
                i, r = i + 1, r - 1
        return "".join(out)

    def audit(self, entry: int, to_go: tuple[int, ...]) -> tuple[str, int, int]:
        """Least audit of least cost, its exit and cost, given what each exit costs from there on."""
        costs = self.costs()[entry] + np.array(to_go)
        least = int(costs.min())
        found = []
        if entry in (START, SYSTEM) and costs[entry] == least:
            found.append(("D" * self.n, entry))
        if entry == START and costs[SYSTEM] == least:
            at = self._leading()
            k = int(at[self.extra[at] == self.extra[at].min()][-1])
            found.append(("D" * k + "K" + "D" * (self.n - k - 1), SYSTEM))
        for leave in (USER, ASSISTANT):
            if costs[leave] != least:
                continue
            own = least - to_go[leave]
            found += [
                (self._trace(0, int(r), leave), leave) for r in self._strings(entry, leave) if self.tables[leave][0, r] == own
            ]
            if entry == START and len(self._leading()):
                cost, at, lengths = self._with_system(leave)
                for k in np.flatnonzero((cost == own).any(0)):
                    # a later leading turn has a deletion where an earlier one is kept
                    i = int(at[np.flatnonzero(cost[:, k] == own)[-1]])
                    found.append(("D" * i + "K" + self._trace(i + 1, int(lengths[k]), leave), leave))
        text, leave = min(found)
        return text, leave, least


@lru_cache(maxsize=1 << 14)
def _costs(pattern: str) -> tuple[tuple[int, ...], ...]:
    return tuple(tuple(r) for r in Block(pattern).costs().tolist())


@lru_cache(maxsize=1 << 14)
def _audit(pattern: str, entry: int, to_go: tuple[int, ...]) -> tuple[str, int, int]:
    return Block(pattern).audit(entry, to_go)


def _illegal(pattern: str) -> int:
    return sum(not legal(a, b) for a, b in zip(pattern[:-1], pattern[1:], strict=True))


def legal(a: str, b: str) -> bool:
    return ((ord(a) - 65) // 3, (ord(b) - 65) // 3) in ((0, 1), (1, 2), (2, 1))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        patterns = batch.column("pattern").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([_illegal(p) for p in patterns], pa.int64()),
             pa.array([[c for r in _costs(p) for c in r] for p in patterns], pa.list_(pa.int64()))],
            names=[*batch.schema.names, "illegal", "costs"],
        )


BLOCK = "conv_id long, block long, pattern string, blank long, duplicate long, truncated long, low long, high long, turns long"


def _backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of each conversation from last to first: costs to go from each exit, and what lies between neighbours."""
    held, to_go, total = None, list(END), 0

    def finished(row: dict, first: bool) -> dict:
        return {**{k: row[k] for k in ("conv_id", "block", "pattern", "blank", "duplicate", "truncated", "low", "high")},
                "turns": row["turns"] - row["again"], "illegal": row["illegal"], "to_go": row["to_go"],
                "cost": row["total"][START] if first else 0, "first": first}

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            row["again"] = 0
            if held is not None:
                same = held["conv_id"] == row["conv_id"]
                if same:
                    row["illegal"] += not legal(row["pattern"][-1], held["pattern"][0])
                    row["again"] = int(row["high"] is not None and row["high"] == held["low"])
                out.append(finished(held, not same))
                to_go = total if same else list(END)
            row["to_go"] = to_go
            costs = row["costs"]
            total = [min(min(costs[4 * s + t] + to_go[t] for t in range(4)), FAR) for s in range(4)]
            row["total"] = total
            held = row
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_AFTER)
    if held is not None:
        yield pa.RecordBatch.from_pylist([finished(held, True)], schema=_AFTER)


_AFTER = pa.schema([
    ("conv_id", pa.int64()), ("block", pa.int64()), ("pattern", pa.string()), ("blank", pa.int64()), ("duplicate", pa.int64()),
    ("truncated", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()), ("illegal", pa.int64()),
    ("to_go", pa.list_(pa.int64())), ("cost", pa.int64()), ("first", pa.bool_()),
])
AFTER = BLOCK + ", illegal long, to_go array<long>, cost long, first boolean"


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        audits, exits = [], []
        for pattern, to_go, first in zip(*[batch.column(c).to_pylist() for c in ("pattern", "to_go", "first")], strict=True):
            known = {e: _audit(pattern, e, tuple(to_go)) for e in ((START,) if first else range(4))}
            audits.append([known[e][0] if e in known else "" for e in range(4)])
            exits.append([known[e][1] if e in known else 0 for e in range(4)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("block"), pa.array(audits, pa.list_(pa.string())),
             pa.array(exits, pa.list_(pa.int32())), batch.column("pattern")],
            names=["conv_id", "block", "audits", "exits", "pattern"],
        )


_ROWS = pa.schema([
    ("conv_id", pa.int64()), ("action", pa.string()), ("role", pa.string()), ("text", pa.string()), ("last", pa.bool_()),
])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each edit in order; audits come before the turns of their block."""
    conv, state, actions, at, begun = None, START, "", 0, False
    out: list[tuple] = []

    def flush(final: bool):
        if begun and final:
            for letter in TAIL[state]:
                insert(letter)
            out.append((conv, None, None, None, True))

    def insert(letter: str):
        nonlocal state
        state = after(state)
        out.append((conv, letter, ROLES[state], "", False))

    for batch in batches:
        for c, audits, exits, role, text in zip(
            *[batch.column(k).to_pylist() for k in ("conv_id", "audits", "exits", "role", "text")], strict=True
        ):
            if not begun or c != conv:
                flush(True)
                conv, state, begun = c, START, True
            if audits is not None:
                actions, at = audits[state], 0
                continue
            while actions[at] == "I":
                insert("I")
                at += 1
            letter = actions[at]
            at += 1
            if letter == "D":
                out.append((conv, letter, role, text, False))
                continue
            if letter == "K" and state == START and role[:1] == "s":
                state = SYSTEM
            else:
                state = after(state)
            out.append((conv, letter, role if letter == "K" else ROLES[state], text, False))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), _ROWS, strict=True)], schema=_ROWS)
            out.clear()
    flush(True)
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), _ROWS, strict=True)], schema=_ROWS)


def repaired_structure(turns: DataFrame, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """Repaired conversations and their faults, of ``turns(conv_id, turn, role, text)``.

    The first table holds ``(conv_id, action, role, text, last)``: the edits K, R, D and I of each conversation in order
    (deleted turns with their own role and text), closed by a row with ``last`` set and all else null. Each conversation lies in
    one partition in this order. The second holds ``(conv_id, gaps, blank, duplicate, truncated, illegal, cost)``.
    """
    spark = turns.sparkSession
    whole = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        # parts equal rows of a hot conversation
        F.monotonically_increasing_id().alias("tie"),
    )
    order = ["conv_id", "turn", "role", "text", "tie"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    number = F.monotonically_increasing_id()
    placed = kept_table(
        whole.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("tie")
        .withColumn("part", F.shiftright(number, 33)).withColumn("place", number.bitwiseAND(F.lit((1 << 33) - 1))),
        "placed-turns",
    )
    # a row for each partition, so the window is as small as their number
    starts = placed.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start")
    )
    numbered = placed.join(F.broadcast(starts), "part").withColumn("place", F.col("start") + F.col("place")).drop("part", "start")
    initial = F.position(F.substring("role", 1, 1), F.lit("sua"))
    solid_end = F.regexp_extract("text", SOLID + r"(?=[\x20\x09-\x0D]*\z)", 0)
    light = kept_table(
        numbered.select(
            "conv_id", "turn", "place", F.when((F.length("role") > 0) & (initial > 0), initial - 1).otherwise(3).alias("initial"),
            (~F.col("text").rlike(SOLID)).alias("blank"), (~solid_end.isin(".", "!", "?")).alias("cut"),
            F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")).alias("same"),
        ),
        "turn-marks",
    )
    firsts = light.groupBy("conv_id", "same").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("new"))
    again = F.col("new").isNull() & ~F.col("blank")
    fault = F.when(F.col("blank") | F.col("again"), GONE).when(F.col("cut"), CUT).otherwise(FINE)
    marked = light.join(firsts, "place", "left").withColumn("again", again).withColumn(
        "symbol", F.chr(65 + 3 * F.col("initial") + fault)
    )
    counted = lambda c: F.sum(c.cast("long"))
    blocks = marked.groupBy("conv_id", F.floor(F.col("place") / rows).alias("block")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "symbol"))), lambda x: x.symbol), "").alias("pattern"),
        counted(F.col("blank")).alias("blank"), counted(F.col("again")).alias("duplicate"),
        counted(~F.col("blank") & ~F.col("again") & F.col("cut")).alias("truncated"),
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.size(F.collect_set("turn")).cast("long").alias("turns"),
    )
    measured = blocks.mapInArrow(_measured, BLOCK + ", illegal long, costs array<long>")
    known = kept_table(
        measured.repartition(parts, "conv_id").sortWithinPartitions("conv_id", F.desc("block")).mapInArrow(_backwards, AFTER),
        "blocks",
    )
    audited = known.repartition(parts, "conv_id", "block").mapInArrow(
        _audited, "conv_id long, block long, audits array<string>, exits array<int>, pattern string"
    )
    nothing = lambda kind: F.lit(None).cast(kind)
    lines = audited.select(
        "conv_id", "block", F.lit(-1).cast("long").alias("place"), "audits", "exits", nothing("string").alias("role"), nothing("string").alias("text"),
    ).unionByName(numbered.select(
        "conv_id", F.floor(F.col("place") / rows).alias("block"), "place", nothing("array<string>").alias("audits"),
        nothing("array<int>").alias("exits"), "role", "text",
    ))
    edits = lines.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "block", "place").select(
        "conv_id", "audits", "exits", "role", "text"
    ).mapInArrow(_repaired, "conv_id long, action string, role string, text string, last boolean")
    # in decimals, as the span of two turns may exceed 64 bits; null then
    span = F.max("high").cast("decimal(20,0)") - F.min("low").cast("decimal(20,0)") + 1 - F.sum("turns")
    faults = known.groupBy("conv_id").agg(
        F.coalesce(F.when(F.max("high").isNotNull(), span), F.lit(0)).try_cast("long").alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
    )
    return edits, faults


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation from its edits in order: the audit and the digest of what stays."""
    audit, sha, empty = [], hashlib.sha256(), True
    for batch in batches:
        ids, audits, digests = [], [], []
        for c, action, role, text, last in zip(*[col.to_pylist() for col in batch.columns], strict=True):
            if last:
                ids.append(c)
                audits.append("".join(audit))
                digests.append(sha.hexdigest())
                audit, sha, empty = [], hashlib.sha256(), True
                continue
            audit.append(action)
            if action != "D":
                sha.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                empty = False
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(audits, pa.string()), pa.array(digests, pa.string())], names=["conv_id", "audit", "repaired_sha256"]
        )


def digests(edits: DataFrame) -> DataFrame:
    """``(conv_id, audit, repaired_sha256)`` of the edits of ``repaired_structure``, whose order in partitions it reads."""
    return edits.mapInArrow(_digested, "conv_id long, audit string, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with turns dropped, emptied, unpunctuated, repeated or given to the user, by a checksum of their key."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    pick = F.crc32(F.concat_ws(":", space("conv_id"), space("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), pick.alias("pick"))
    text = F.when(F.col("pick") == 1, "").when(F.col("pick") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("pick") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.where("pick <> 0").select(
        "conv_id", "turn", F.when(F.col("pick") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy")
    ).drop("copy")


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """A row for each conversation: faults after the damage, cost and audit of the repair and a digest of its result."""
    edits, faults = repaired_structure(damaged(conversations))
    name = F.col("conv_id").cast("long").alias("conv_id")
    told = kept_table(digests(edits), "audits")
    found = faults.withColumnRenamed("conv_id", "f").join(told, F.col("f").eqNullSafe(F.col("conv_id"))).drop("f").withColumnRenamed("conv_id", "c")
    whole = conversations.select(name).distinct().join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    return whole.select(
        "conv_id", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
