"""Chat formatting: conversations are repaired at least cost into legal turns, then rendered.

Legal is an optional system turn, then user and assistant by turns, ending with the assistant. Each turn may keep
its role, take another (``RELABEL``), be merged with the turn before (``MERGE``), or have one empty turn put in front
(``INSERT``); a missing last answer is an empty turn too. A dynamic program over the automaton's states finds the least cost.

Turns are ordered by (turn, role, text). They are range-partitioned by (conversation, turn, role, text) into a written
table, so a conversation of any length is spread over partitions. A partition sums up the conversations it shares with others as a
least-cost matrix from each entry state to each exit state; the matrices of one conversation (a row for each partition) are
chained, and each partition then walks its turns from the entry to the exit state found. Costs add the same
way for any split; among repairs of equal cost the choice may depend on it.

Nulls: a null turn comes first, a null text is empty, a null or unknown role is relabelled; a null conversation id is a
conversation of its own. Rows equal in all four columns count once. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import kept_table

ROLES = ("system", "user", "assistant")
# States: nothing yet, then the role of the last message.
START, SYSTEM, USER, ASSISTANT = range(4)
MERGE, INSERT, RELABEL, FAR = 1, 2, 3, 1 << 30
ROWS_PER_PART = 20_000
OPEN, CLOSE = "<|im_start|>{role}\n", "<|im_end|>\n"


def _moves() -> dict[str, np.ndarray]:
    """Cost of going from each state to each state by a turn of a given role."""
    legal = {(START, SYSTEM), (START, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
    base = np.full((4, 4), FAR, dtype=np.int64)
    for s in range(4):
        for t in (SYSTEM, USER, ASSISTANT):
            if (s, t) in legal:
                base[s, t] = 0
            elif s == t:
                base[s, t] = MERGE
            elif any((s, m) in legal and (m, t) in legal for m in (USER, ASSISTANT)):
                base[s, t] = INSERT
    out = {}
    for role in (*ROLES, ""):
        change = np.array([FAR, *(0 if r == role else RELABEL for r in ROLES)])
        out[role] = np.minimum(base + change[None, :], FAR)
    return out


MOVES = _moves()
END = np.array([0, 2 * INSERT, INSERT, 0])


def _cost(role: str) -> np.ndarray:
    return MOVES.get(role, MOVES[""])


def chain(roles: list[str]) -> np.ndarray:
    """Least cost from each state to each state over ``roles``."""
    total = np.where(np.eye(4, dtype=bool), 0, FAR).astype(np.int64)
    for role in roles:
        total = np.minimum((total[:, :, None] + _cost(role)[None, :, :]).min(1), FAR)
    return total


def walk(roles: list[str], entry: int, leave: int) -> list[int]:
    """States after each turn on a least-cost way from ``entry`` to ``leave``."""
    best = [np.where(np.arange(4) == entry, 0, FAR).astype(np.int64)]
    for role in roles:
        best.append(np.minimum((best[-1][:, None] + _cost(role)).min(0), FAR))
    states = [leave]
    for k in range(len(roles) - 1, 0, -1):
        states.append(int((best[k] + _cost(roles[k])[:, states[-1]]).argmin()))
    return states[::-1]


def _sorted(part: pd.DataFrame) -> pd.DataFrame:
    # nulls first, as Spark's ranges have them
    return part.sort_values(["conv_id", "turn", "role", "text"], na_position="first", kind="stable", ignore_index=True)


def _groups(part: pd.DataFrame):
    """Runs of one conversation in a sorted partition."""
    ids = part["conv_id"]
    fresh = (ids != ids.shift()) & ~(ids.isna() & ids.shift().isna())
    fresh.iloc[0] = True
    cuts = [*np.flatnonzero(fresh.to_numpy()), len(part)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield part.iloc[a:b]


def _roles(run: pd.DataFrame) -> list[str]:
    return [r if r in ROLES else "" for r in run["role"].fillna("")]


def _ends(part: pd.DataFrame) -> pd.DataFrame:
    """Matrices of the first and the last conversation of a partition, which others may share."""
    runs = list(_groups(_sorted(part)))
    rows = [(r["conv_id"].iloc[0], part["part"].iloc[0], chain(_roles(r)).ravel().tolist()) for r in ([runs[0], runs[-1]] if len(runs) > 1 else runs)]
    return pd.DataFrame(rows, columns=["conv_id", "part", "matrix"]).astype({"conv_id": "Int64", "part": "int32"})


def _chained(ends: pd.DataFrame) -> pd.DataFrame:
    """Entry and exit states of each partition's share of one conversation."""
    ends = ends.sort_values("part")
    matrices = [np.array(m, dtype=np.int64).reshape(4, 4) for m in ends["matrix"]]
    best = [np.array([0, FAR, FAR, FAR], dtype=np.int64)]
    for m in matrices:
        best.append(np.minimum((best[-1][:, None] + m).min(0), FAR))
    states = [int((best[-1] + END).argmin())]
    for k in range(len(matrices) - 1, -1, -1):
        states.append(int((best[k] + matrices[k][:, states[-1]]).argmin()))
    states = states[::-1]
    return pd.DataFrame({
        "conv_id": ends["conv_id"].to_numpy(), "part": ends["part"].to_numpy(), "entry": states[:-1], "leave": states[1:],
        "last": [False] * (len(matrices) - 1) + [True],
    }).astype({"conv_id": "Int64"})


def _way(state: int, role: int) -> int | None:
    """The empty turn to put between, if the step isn't legal and no merge."""
    for middle in (USER, ASSISTANT):
        if MOVES[ROLES[role - 1]][state, role] == INSERT and (
            MOVES[ROLES[middle - 1]][state, middle] == 0 and MOVES[ROLES[role - 1]][middle, role] == 0
        ):
            return middle
    return None


def _empty(state: int) -> str:
    return OPEN.format(role=ROLES[state - 1]) + CLOSE


def render(roles: list[str], texts: list[str], entry: int, states: list[int], last: bool):
    """``(action, role, cost, piece)`` of each turn; the pieces of a conversation in order are its rendering."""
    out, state = [], entry
    for role, text, to in zip(roles, texts, states, strict=True):
        given = to > 0 and ROLES[to - 1] == role
        merge = state == to
        middle = None if merge else _way(state, to)
        action = "merge" if merge else "insert" if middle else "keep"
        piece = "\n" if merge else (CLOSE if state != START else "") + (_empty(middle) if middle else "") + OPEN.format(role=ROLES[to - 1])
        out.append([action + ("" if given else "+relabel"), ROLES[to - 1], int(_cost(role)[state, to]), piece + text])
        state = to
    if last and out:
        tail = CLOSE + {SYSTEM: _empty(USER) + _empty(ASSISTANT), USER: _empty(ASSISTANT)}.get(state, "")
        out[-1][2] += int(END[state])
        out[-1][3] += tail
    return out


def _repair(part: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
    known = {None if pd.isna(r.conv_id) else int(r.conv_id): r for r in shared.itertuples()}
    frames = []
    for run in _groups(_sorted(part)) if len(part) else ():
        roles, conv = _roles(run), run["conv_id"].iloc[0]
        end = known.get(None if pd.isna(conv) else int(conv))
        if end is None:
            entry, last = START, True
            leave = int((chain(roles)[START] + END).argmin())
        else:
            entry, leave, last = int(end.entry), int(end.leave), bool(end.last)
        rows = render(roles, run["text"].fillna("").tolist(), entry, walk(roles, entry, leave), last)
        out = pd.DataFrame(rows, columns=["action", "role_out", "cost", "piece"], index=run.index)
        frames.append(pd.concat([run[["conv_id", "turn", "role"]], out], axis=1))
    columns = ["conv_id", "turn", "role", "action", "role_out", "cost", "piece"]
    return pd.concat(frames)[columns] if frames else pd.DataFrame(columns=columns)


def format_chats(turns: DataFrame, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """``(conv_id, turn, role, action, role_out, cost, piece)`` for each turn of ``turns(conv_id, turn, role, text)``.

    A conversation's pieces in the order of (turn, role, text) make up its rendering; its costs add up to the least cost.
    """
    spark = turns.sparkSession
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")).distinct()
    rows = kept_table(rows, "turns")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // rows_per_part + 1)
    placed = kept_table(
        rows.repartitionByRange(parts, "conv_id", "turn", "role", "text").withColumn("part", F.spark_partition_id()), "placed"
    )
    ends = kept_table(
        placed.groupBy("part").applyInPandas(_ends, "conv_id long, part int, matrix array<long>"), "ends"
    )
    several = ends.groupBy("conv_id").count().where("count > 1").select(F.col("conv_id").alias("c"))
    shared = ends.join(several, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c").groupBy("conv_id").applyInPandas(
        _chained, "conv_id long, part int, entry int, leave int, last boolean"
    )
    return placed.groupBy("part").cogroup(shared.groupBy("part")).applyInPandas(
        _repair, "conv_id long, turn long, role string, action string, role_out string, cost long, piece string"
    )
