import random

import pytest

from parcelle.llm.lines import line_dedup
from tests.llm.brute import WORD


def brute(rows, n, words=50):
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        lines = (text or "").split("\n")
        worded = [k for k, line in enumerate(lines) if line.strip(" \t\n\x0b\x0c\r")]
        gone = set()
        for size in range(1, n + 1):
            for j in range(len(worded) - size + 1):
                run = tuple(lines[k] for k in worded[j : j + size])
                if size < n and sum(len(WORD.findall(x)) for x in run) < words:
                    continue
                if run in seen:
                    gone.update(worded[j : j + size])
                seen.add(run)
        out.append((i, len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone)))
    return out


@pytest.mark.parametrize(("n", "words"), [(1, 50), (2, 3), (3, 50), (3, 2), (5, 4)])
def test_equals_scan(spark, n, words):
    rng = random.Random(n)
    rows = [(i * 13 % 97, "\n".join(rng.choice(["a", "b b", "c", "", " \t", "dé"]) for _ in range(rng.randint(0, 12))))
            for i in range(60)]
    rows += [(200, None), (201, ""), (202, "x\n" * 50), (203, "one line")]
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, key string, at int")
    got = [(r.doc_id, r.n_lines, r.n_removed, r.kept_text) for r in line_dedup(df, min_lines=n, min_words=words).collect()]
    assert sorted(got) == sorted(brute(rows, n, words))


def test_edges(spark):
    schema = "doc_id long, text string, place int"
    assert line_dedup(spark.createDataFrame([], schema)).collect() == []
    text = "a\nb\nc\nd"
    df = spark.createDataFrame([(None, text, 1), (4, text, 2), (4, text, 2)], schema)
    got = line_dedup(df).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 4), (4, 0), (4, 4)]


def test_long_single_lines_are_passages(spark):
    passage, short = " ".join(f"word{i}" for i in range(60)), " ".join(f"word{i}" for i in range(49))
    rows = [(1, f"a\n{passage}\nb"), (2, passage), (3, f"c\n{passage}\nd\n{passage}"), (4, f"{short}\nlast"), (5, f"{short}\nother"),
            (6, f"{short}\nlast")]
    got = {r.doc_id: (r.n_removed, r.kept_text) for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (0, rows[0][1]), 2: (1, ""), 3: (2, "c\nd"), 4: (0, rows[3][1]), 5: (0, rows[4][1]), 6: (2, "")}
