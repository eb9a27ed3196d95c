import hashlib
import random
import re

import pytest

from parcelle.llm.queries import OP11_SQL
from parcelle.llm.structure import Block, damaged_and_repaired, digests, repaired_structure
from tests.oracle import compare

LEGAL = re.compile(r"(s?(ua)+)?$")
SCHEMA = "conv_id long, turn long, role string, text string, block int"


def least(turns):
    """(cost, audit, lines) of the cheapest repair of [(role, text)], by a search over edits that tries every prefix."""
    best = {"": (0, "", ())}

    def inserted(states):
        out = dict(states)
        for seq, (cost, audit, lines) in states.items():
            for x in "ua":
                grown = (cost + 5, audit + "I", (*lines, {"u": "user", "a": "assistant"}[x] + ":"))
                key = seq + x
                if re.fullmatch(r"s?(ua)*u?", key) and (key not in out or grown < out[key]):
                    out[key] = grown
        return out

    seen = []
    for role, text in turns:
        states = inserted(inserted(best))
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        gone = not solid or (role, text) in seen
        more = 5 * bool(solid and solid[-1] not in ".!?")
        seen.append((role, text))
        after = {}
        for seq, (cost, audit, lines) in states.items():
            options = [(seq, (cost + 2, audit + "D", lines))]
            if not gone:
                # a role without an initial is never legal
                options.append((seq + (role[:1] or "?"), (cost + more, audit + "K", (*lines, f"{role}:{text}"))))
                options += [(seq + x[0], (cost + more + 1, audit + "R", (*lines, f"{x}:{text}"))) for x in ("user", "assistant")]
            for key, value in options:
                if re.fullmatch(r"(s?(ua)*u?)?", key) and len(key) <= len(turns) + 3 and (key not in after or value < after[key]):
                    after[key] = value
        best = after
    ends = [v for k, v in inserted(inserted(best)).items() if LEGAL.fullmatch(k)]
    return min(ends)


def conversations(seed, count, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Cut off", " ", "Why?", "A\tb. ", "Again.", "Open"]
    roles = ["user", "assistant", "system", "tool", "user", "assistant", ""]
    return {i: [(rng.choice(roles), rng.choice(texts) + str(rng.randint(0, 3)) * rng.randint(0, 1) + rng.choice([".", "", "!"]))
                for _ in range(rng.randint(1, longest))] for i in range(count)}


def check(spark, convs, rows):
    table = [(i, k, r, t, 9) for i, turns in convs.items() for k, (r, t) in enumerate(turns)]
    edits, faults = repaired_structure(spark.createDataFrame(table, SCHEMA).repartition(3), rows)
    costs = {r.conv_id: r.cost for r in faults.collect()}
    got = {r.conv_id: (r.audit, r.repaired_sha256) for r in digests(edits).collect()}
    for i, turns in convs.items():
        cost, audit, lines = least(turns)
        assert (costs[i], got[i][0]) == (cost, audit), turns
        assert got[i][1] == hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.mark.parametrize("rows", [1024, 3, 1])
def test_least_audit_for_any_block_length(spark, rows):
    check(spark, conversations(3, 60, 8), rows)


def test_long_conversation_by_blocks_equals_one_block(spark):
    turns = conversations(5, 1, 1)[0] * 0 + [t for c in conversations(6, 60, 10).values() for t in c]
    table = [(7, k, r, f"{t} {k % 50}.", 1) for k, (r, t) in enumerate(turns)]
    results = []
    for rows in (1024, 16):
        edits, faults = repaired_structure(spark.createDataFrame(table, SCHEMA), rows)
        results.append((faults.collect(), digests(edits).collect()))
    assert results[0] == results[1] and len(results[0][1][0].audit) >= len(turns)


def test_band_is_narrower_than_the_table():
    pattern = "".join("D" if k % 2 == 0 else "G" for k in range(400))  # user, assistant by turns, all fine
    table = Block(pattern).tables[2]
    assert (table < 1 << 28).sum() < 400 * 20


def test_edges(spark):
    assert [t.collect() for t in repaired_structure(spark.createDataFrame([], SCHEMA))] == [[], []]
    assert damaged_and_repaired(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(None, None, None, None, 1), (None, 3, "user", "Hi.", 1), (None, 3, "user", "Hi.", 1), (4, -(1 << 62), "user", "A.", 1),
            (4, 1 << 62, "assistant", "x" * 200_000 + ".", 1), (5, None, "system", "Only.", 1)]
    edits, faults = repaired_structure(spark.createDataFrame(rows, SCHEMA))
    found = {r.conv_id: r for r in faults.collect()}
    audits = {r.conv_id: r.audit for r in digests(edits).collect()}
    assert audits == {None: "DDD", 4: "KK", 5: "D"}
    assert (found[None].blank, found[None].duplicate, found[None].gaps) == (1, 1, 0)
    assert found[4].gaps == (1 << 63) - 1 and found[5].cost == 2


def test_query_equals_sql_with_nulls_and_ties(spark, tmp_path):
    import duckdb

    rng = random.Random(8)
    rows = [(rng.choice([None, 1, 2, 3, 40, 41]), rng.choice([None, *range(12)]), rng.choice(["user", "assistant", "system", None]),
             rng.choice(["Yes.", "No", None, "", "What?"])) for _ in range(120)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table.write.parquet(f"{tmp_path}/conversations.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    run = lambda s, folder: damaged_and_repaired(s.read.parquet(f"{folder}/conversations.parquet"))
    assert compare(spark, db, str(tmp_path), run, OP11_SQL) == ""
