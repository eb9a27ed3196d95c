import itertools
import random
import re

import pytest

from parcelle.llm.chat import INSERT, MERGE, RELABEL, ROLES, format_chats

LEGAL = re.compile(r"s?(ua)+$|^$")


def least(roles):
    """Least cost by trying all labels, with the best split into messages for each."""
    best = None
    for labels in itertools.product("sua", repeat=len(roles)):
        cost = sum(RELABEL for r, x in zip(roles, labels, strict=True) if r[:1] != x or r not in ROLES)
        states = {"": cost}
        for x in labels:
            after = {}
            for seq, c in states.items():
                options = [(seq + x, c)] + [(seq + m + x, c + INSERT) for m in "ua"]
                if seq.endswith(x):
                    options.append((seq, c + MERGE))
                for s, v in options:
                    if re.fullmatch(r"s?(ua)*u?", s) and v < after.get(s, 99):
                        after[s] = v
            states = after
        for seq, c in states.items():
            for tail, extra in (("", 0), ("a", INSERT), ("ua", 2 * INSERT)):
                if LEGAL.fullmatch(seq + tail) and (best is None or c + extra < best):
                    best = c + extra
    return best


def check(spark, convs, size):
    rows = [(i, k, r, f"t{k}", 7) for i, roles in convs.items() for k, r in enumerate(roles)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part int")
    got = format_chats(df, rows_per_part=size).collect()
    assert len(got) == len(rows)
    for i, roles in convs.items():
        mine = sorted((r for r in got if r.conv_id == i), key=lambda r: r.turn)
        assert sum(r.cost for r in mine) == least([r or "" for r in roles]), roles
        text = "".join(r.piece for r in mine)
        messages = re.findall(r"<\|im_start\|>(\w+)\n((?:(?!<\|im).)*)<\|im_end\|>\n", text, re.S)
        assert "".join(f"<|im_start|>{a}\n{b}<|im_end|>\n" for a, b in messages) == text
        assert LEGAL.fullmatch("".join(a[0] for a, _ in messages)) and re.findall(r"t\d+", text) == [f"t{k}" for k in range(len(roles))]


@pytest.mark.parametrize("size", [20_000, 3])
def test_least_cost_and_legal(spark, size):
    rng = random.Random(6)
    convs = {i: [rng.choice([*ROLES, "tool", None]) for _ in range(rng.randint(1, 6))] for i in range(60)}
    convs |= {100: ["user", "assistant"], 101: ["assistant"], 102: ["system"], 103: ["user", "user", "assistant", "assistant"]}
    check(spark, convs, size)


def test_one_conversation_over_many_partitions(spark):
    roles = [ROLES[1 + k % 2] for k in range(400)]
    df = spark.createDataFrame([(1, k, r, f"t{k}") for k, r in enumerate(roles)], "conv_id long, turn long, role string, text string")
    got = sorted(format_chats(df, rows_per_part=25).collect(), key=lambda r: r.turn)
    assert sum(r.cost for r in got) == 0 and {r.action for r in got} == {"keep"}
    assert "".join(r.piece for r in got).count("<|im_start|>") == 400


def test_edges(spark):
    schema = "conv_id long, turn long, role string, text string, entry int"
    assert format_chats(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, 0, "user", None, 1), (None, 0, "user", None, 1), (None, None, None, "x", 2), (5, 1, "user", "a", 1), (5, 1, "user", "b", 1)]
    got = format_chats(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 4 and sum(r.action.startswith("merge") for r in got) == 1
