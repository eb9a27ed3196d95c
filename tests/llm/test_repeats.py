import random

import numpy as np
import pytest

from parcelle.llm import segments
from parcelle.llm.segments import segments as cut_segments
from parcelle.llm.substrings import matching, merge_spans, substring_dedup
from parcelle.llm.suffixes import merged, suffix_dedup
from tests.llm.brute import WORD

SCHEMA = "doc_id long, text string, key string, place int"


def words_kept(rows, width):
    first = {}
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, ws in split:
        for k in range(len(ws) - width + 1):
            w = tuple(ws[k : k + width])
            first[w] = min(first.get(w, i), i)
    out = []
    for i, ws in split:
        gone = set()
        for k in range(len(ws) - width + 1):
            if first[tuple(ws[k : k + width])] < i:
                gone.update(range(k, k + width))
        out.append((i, len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)))
    return sorted(out)


def bytes_kept(rows, width):
    count = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, t in texts:
        for k in range(len(t) - width + 1):
            count[t[k : k + width]] = count.get(t[k : k + width], 0) + 1
    out = []
    for i, t in texts:
        gone = merge_spans([{"a": k, "b": k + width} for k in range(len(t) - width + 1) if count[t[k : k + width]] > 1])
        mask = np.ones(len(t), dtype=bool)
        for a, b in gone:
            mask[a:b] = False
        out.append((i, len(t), int((~mask).sum()), len(gone), bytes(np.frombuffer(t, np.uint8)[mask])))
    return sorted(out)


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = [f"{rng.choice('abcdeé')}{i % 37}" for i in range(90)]
    shared = [" ".join(rng.choice(words) for _ in range(rng.randint(20, 90))) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts.append(" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))))
            if rng.random() < 0.6:
                parts.append(rng.choice(shared))
        rows.append((i * 17 % 101, "\n".join(parts)))
    rows += [(500, None), (501, ""), (502, rows[3][1]), (503, rows[3][1] + "x"), (504, "aaaa " * 60), (505, "z" * 700)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1) for i, t in rows], SCHEMA)


@pytest.mark.parametrize("share", [4000, 2])
def test_words(spark, monkeypatch, share):
    monkeypatch.setattr(segments, "SHARE", share)
    rows = corpus(1)
    got = substring_dedup(frame(spark, rows), width=12, gram=4).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == words_kept(rows, 12)


@pytest.mark.parametrize("share", [4000, 2])
def test_bytes(spark, monkeypatch, share):
    monkeypatch.setattr(segments, "SHARE", share)
    monkeypatch.setitem(segments.BLOCK, "byte", 300)
    rows = corpus(2)
    got = suffix_dedup(frame(spark, rows), width=60, gram=9).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got) == bytes_kept(rows, 60)


def test_whole_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = suffix_dedup(docs).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got) == bytes_kept(rows, 200)


def test_edges(spark):
    empty = frame(spark, []).limit(0)
    assert suffix_dedup(empty).collect() == [] and substring_dedup(empty).collect() == []
    text = " ".join(f"w{i}" for i in range(70))
    rows = frame(spark, [(1, text), (1, text), (None, text), (None, None)])
    assert sorted((r.doc_id or 0, r.n_removed) for r in substring_dedup(rows).collect()) == [(0, 0), (0, 70), (1, 0), (1, 0)]
    assert {r.n_removed for r in suffix_dedup(rows).collect()} == {0, len(text)}


@pytest.mark.parametrize("engine", [matching, merged])
def test_engines_against_dictionary(engine):
    rng = np.random.default_rng(5)
    parts = [rng.integers(0, 2, rng.integers(12, 40)).astype(np.uint8) for _ in range(40)]
    cuts = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    weight, least = rng.integers(1, 3, 40), rng.permutation(40).astype(np.int64)
    units = np.concatenate(parts)
    got = engine(units if engine is merged else units.astype(np.uint64), cuts, 12, weight, least)
    seen = {}
    for p, w, v in zip(parts, weight, least, strict=True):
        for k in range(len(p) - 11):
            a, b = seen.get(bytes(p[k : k + 12]), (0, 99))
            seen[bytes(p[k : k + 12])] = (a + w, min(b, v))
    want = [seen[bytes(p[k : k + 12])] for p in parts for k in range(len(p) - 11)]
    assert [(int(a), int(b)) for a, b in zip(*got, strict=True)] == [(min(a, 2), int(b)) for a, b in want]


def test_segments_cover_each_window_once():
    rng = np.random.default_rng(3)
    units = rng.integers(0, 50, 3000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    cuts = np.array([0, 0, 5, 700, 701, 2000, 3000])
    text, start, count, *_ = cut_segments(units, cuts, 40, 8)
    got = sorted((t, s + k) for t, s, c in zip(text, start, count, strict=True) for k in range(c))
    assert got == [(t, s) for t in range(6) for s in range(cuts[t + 1] - cuts[t] - 39)]
