import math
import random

import numpy as np
import pytest

from parcelle.llm.codes import EXACT, POINTS, assign, codebooks_sha256, coded_vectors, compress_vectors, grow

SCHEMA = "vec_id long, embedding array<float>, label int, code int"


def brute(rows, parts=4, rounds=4, entries=256):
    """{row: (code, error)}, error by label and codebooks by plain loops."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows
            if v is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    piece = lambda v, j: v[j * width : (j + 1) * width]
    books = [[piece(v, j) for _, v, _ in kept[:entries]] for j in range(parts)]

    def nearest(v, j):
        return min((sum((a - b) ** 2 for a, b in zip(piece(v, j), c, strict=True)), e) for e, c in enumerate(books[j]))

    for _ in range(rounds):
        for j in range(parts):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(nearest(v, j)[1], []).append(piece(v, j))
            for e, members in groups.items():
                books[j][e] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    out, by_label = [], {}
    for i, v, label in kept:
        best = [nearest(v, j) for j in range(parts)]
        error = sum(d for d, _ in best)
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, "".join(f"{e:02x}" for _, e in best), error, label))
    sha = codebooks_sha256([np.array(b) for b in books])
    return sorted((repr(i), c, e, by_label[label], sha) for i, c, e, label in out)


def answer(spark, rows):
    got = coded_vectors(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(2)).collect()
    return sorted((repr(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in got)


def vectors(seed, n, width, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, spread) for _ in range(width)] for _ in range(12)]
    as_float = lambda x: float(np.float32(x))
    return [(k, [as_float(x + rng.gauss(0, 0.05)) for x in rng.choice(centres)], rng.choice([0, 1, None])) for k in range(n)]


def test_equals_plain_lloyd(spark):
    rows = vectors(1, 420, 8)
    rows += [(k, rows[3][1], 2) for k in range(1000, 1080)]  # a frequent vector
    rows += [(5, None, 1), (6, [None] * 8, 1), (7, [math.nan] * 8, 1), (8, [math.inf] + [0.0] * 7, 1), (None, rows[9][1], None), (9, rows[8][1], 0)]
    assert answer(spark, rows) == brute(rows)


def test_fewer_rows_than_entries_and_large_components(spark):
    rows = vectors(2, 40, 4, spread=20_000.0)
    assert answer(spark, rows) == brute(rows)


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert coded_vectors(empty).collect() == []
    assert answer(spark, [(1, None, 3), (2, [], 3)]) == []
    assert len(answer(spark, [(1, [0.5] * 4, 3), (2, [0.5] * 8, 3), (3, [3e38] * 4, 3)])) == 1
    with pytest.raises(ValueError):
        compress_vectors(spark.createDataFrame([(1, [0.5] * 3, 3, 1)], SCHEMA))


@pytest.mark.parametrize("scale", [300, EXACT * 8])
def test_subtrees_give_the_exact_assignment(scale):
    rng = np.random.default_rng(3)
    centres = rng.integers(-scale, scale, (9, 4))
    points = centres[rng.integers(0, 9, POINTS)] + rng.integers(-scale // 100, scale // 100 + 1, (POINTS, 4))
    points[::3] = points[0]
    book = np.concatenate((centres, centres[:2], points[:5]))
    order, nodes = grow(points)
    assert sorted(order) == list(range(POINTS)) and len(nodes) < 2 * POINTS
    for k, node in enumerate(nodes):
        members = points[order[node["low"] : node["high"]]]
        apart = np.sqrt(((members - points[node["centre"]]).astype(float) ** 2).sum(1))
        assert apart.max() <= node["radius"] + 1e-6
        inner = nodes[node["first"] : node["last"]]
        assert k == 0 or not len(inner) or inner["high"][-1] == node["high"]
    chosen, sums, counts = assign(points, order, nodes, book)
    exact = ((points[:, None, :].astype(object) - book[None]) ** 2).sum(2)
    assert chosen.tolist() == [int(r.argmin()) for r in exact]
    for e in range(len(book)):
        assert counts[e] == (chosen == e).sum() and (sums[e] == points[chosen == e].sum(0)).all()
