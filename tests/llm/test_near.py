import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelle.llm import near
from parcelle.llm.near import REGISTERS, estimate, near_duplicates, registers
from tests.llm import brute

SCHEMA = "doc_id long, text string, bucket string, node int"


def check(spark, rows, n):
    df = spark.createDataFrame([(i, t, "x", None) for i, t in rows], SCHEMA)
    got = {r.doc_id: r for r in near_duplicates(df, shingle_words=n).collect()}
    want = brute.near(rows, n)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


@pytest.mark.parametrize("n", [2, 5])
def test_equals_all_pairs(spark, n):
    rng = random.Random(n)
    vocabulary = [f"W{i}" for i in range(400)]
    rows, bases = [], [[rng.choice(vocabulary) for _ in range(rng.randint(20, 120))] for _ in range(12)]
    for i in range(300):
        words = list(rng.choice(bases))
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i * 7 % 1009, " ".join(words)))
    rows += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "one"), (2004, "ONE"), (2005, "a b"), (2006, "a\nB")]
    check(spark, rows, n)


@pytest.mark.parametrize(("small", "rounds"), [(1, 1), (1, 3), (3, 2)])
def test_large_buckets(spark, monkeypatch, small, rounds):
    monkeypatch.setattr(near, "SMALL", small)
    monkeypatch.setattr(near, "ROUNDS", rounds)
    rng = random.Random(rounds)
    vocabulary = [f"w{i}" for i in range(900)]
    bases = [[rng.choice(vocabulary) for _ in range(60)] for _ in range(3)]
    bases.append(bases[0][:50] + bases[1][:10])
    rows = []
    for i in range(160):
        words = list(rng.choice(bases))
        for _ in range(rng.randint(0, 6)):
            k = rng.randrange(len(words))
            words[k : k + rng.randint(0, 1)] = rng.choice([[], [rng.choice(vocabulary)], [rng.choice(vocabulary[:9])]])
        rows.append((i, " ".join(words)))
    check(spark, rows, 2)


def test_whole_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(spark, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 2)


def test_edges(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(None, "a b c d e f", "x", 1), (1, "a b c d e f", "x", 1), (1, "a b c d e f", "y", 2), (2, "zz", None, None)]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).orderBy(F.col("doc_id").asc_nulls_first()).collect()
    assert [(r.doc_id, r.component_id, r.kept) for r in got] == [(None, 1, True), (1, 1, True), (1, 1, True), (2, 2, True)]


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    code = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b, union = code[:2000], code[500:], code
    rows = registers(np.concatenate((a, b, union)), np.array([0, 2000, 4500, 7500]))
    assert (np.maximum(rows[0], rows[1]) == rows[2]).all() and rows.shape[1] == REGISTERS
    fit = estimate(rows[:1], rows[1:2], np.array([2000.0]), np.array([2500.0]))[0]
    assert abs(fit - 0.5) < 0.2


def test_hub_measured_once_over_rounds(spark, monkeypatch):
    """1 is the first hub of bucket 1 and, after 9, the second of bucket 2; 2 and 3 are linked by differences from it alone."""
    monkeypatch.setattr(near, "SMALL", 1)
    base = [f"w{i}" for i in range(100)]
    both, own, lone = [[f"{c}{i}" for i in range(n)] for c, n in (("s", 6), ("x", 6), ("y", 4))]
    words = {1: base, 2: base[13:] + both + own, 3: base[5:] + both + lone, 9: [f"g{i}" for i in range(50)]}
    texts = spark.createDataFrame([(i, " ".join(w)) for i, w in words.items()], "doc_id long, text string")
    members = [(1, 1, 3), (1, 2, 3), (1, 3, 3), (2, 1, 4), (2, 2, 4), (2, 3, 4), (2, 9, 99)]
    tests = near._Tests(None, texts, 1, 80)
    measured, _, left = near._hub_rounds(spark.createDataFrame(members, "bucket long, node long, n long"), tests)
    rows = measured[0]
    for found in measured[1:]:
        rows = rows.unionByName(found)
    pairs = [(r.a, r.b) for r in rows.collect()]
    assert {(2, 1), (3, 1)} <= set(pairs) and len(pairs) == len(set(pairs))
    component = spark.createDataFrame([(1, 1), (3, 1)], "node long, component long")
    known = rows.drop("total").withColumn("far", F.lit(True)).unionByName(tests.sets(left))
    assert (2, 3) in {(r.a, r.b) for r in near._by_differences(known, component, 80).collect()}


def test_group_of_near_copies_has_one_hub(spark, monkeypatch):
    """Copies meet in 32 bands with several strongest members; each is measured against few hubs, and few pairs come of it."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(70)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(rng.randint(1, 6)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10_000)}"
        rows.append((i, " ".join(words)))
    counts = {"hub-pairs": [], "maybe": []}
    keep, meet = near.kept_table, near._by_differences

    def counted(df, name):
        out = keep(df, name)
        if name in counts:
            counts[name].append(out.count())
        return out

    monkeypatch.setattr(near, "kept_table", counted)
    monkeypatch.setattr(near, "_by_differences", lambda *a: counted(meet(*a), "maybe"))
    check(spark, rows, 2)
    assert counts["hub-pairs"][0] < 1.5 * len(rows) and counts["maybe"][0] < 5 * len(rows), counts


def test_only_prefixes_of_differences_become_rows(spark, monkeypatch):
    """Sets met by chance write a fifth of their shingles, and a link among them is found on any of these."""
    rng = random.Random(6)
    sets = {i: rng.sample(range(10**6), 100) for i in range(60)}
    sets[60] = sets[7][:92] + rng.sample(range(10**6, 2 * 10**6), 8)
    rows = [(True, True, i, -1, 0, len(s), 0, s, []) for i, s in sets.items()]
    known = spark.createDataFrame(rows, "far boolean, `any` boolean, a long, b long, shared long, n_a long, n_b long, more array<long>, less array<long>")
    written, keep = [], near.kept_table

    def counted(df, name):
        out = keep(df, name)
        written.extend([out.count()] if name == "differences" else [])
        return out

    monkeypatch.setattr(near, "kept_table", counted)
    component = spark.createDataFrame([], "node long, component long")
    assert (7, 60) in {(r.a, r.b) for r in near._by_differences(known, component, 80).collect()}
    assert written[0] <= 25 * len(sets), written
