import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from parcelle.llm.simhash import DISTANCE, first_keys, linked, links, near_by_simhash, second_keys, third_keys
from tests.llm.brute import WORD, lower

SCHEMA = "doc_id long, text string, print int"


def fingerprint(text):
    words = WORD.findall(lower(text))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else ([" ".join(words)] if words else [])
    ones = Counter(b for g in grams for h in [xxhash.xxh64_intdigest(g.encode(), 42)] for b in range(64) if h >> b & 1)
    return sum(1 << b for b, n in ones.items() if 2 * n > len(grams))


def brute(rows):
    """{doc_id: (fingerprint, component)} by comparing all pairs."""
    prints = [fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= DISTANCE or (rows[a][0] == rows[b][0] and rows[a][0] is not None):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted((repr(i), f"{p:016x}", repr(least.get(root(k)))) for k, ((i, _), p) in enumerate(zip(rows, prints, strict=True)))


def texts():
    rng = random.Random(4)
    names = ["Ab", "c", "DE", "été", "x1", "…", "zz", "go", "On"]
    out = []
    for _ in range(25):
        base = [rng.choice(names) + str(rng.randint(0, 9)) for _ in range(rng.choice([1, 2, 3, 60, 300]))]
        for _ in range(4):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = "new"
            out.append(rng.choice(["  ", " \n", "\t"]).join(copy))
    return out


def test_all_pairs(spark):
    rows = list(enumerate(texts()))
    rows += [(None, rows[0][1]), (200, ""), (201, None), (202, " \n "), (5, rows[40][1]), (5, rows[40][1]), (None, "alone here now")]
    rows += [(300, "w " * 60_000), (301, "w " * 60_001), (302, "short"), (303, "two Words"), (304, "TWO words")]
    random.Random(1).shuffle(rows)
    got = near_by_simhash(spark.createDataFrame([(i, t, 3) for i, t in rows], SCHEMA).repartition(3)).collect()
    assert sorted((repr(r.doc_id), r.fingerprint, repr(r.component_id)) for r in got) == brute(rows)


def test_empty(spark):
    assert near_by_simhash(spark.createDataFrame([], SCHEMA)).collect() == []


def prints_of(seed):
    """Fingerprints in clouds around a few centres, so that postings are long on every level."""
    rng = np.random.default_rng(seed)
    out = []
    for width in (6, 14, 24):
        centre = rng.integers(0, 1 << 63, dtype=np.uint64)
        for _ in range(150):
            x = int(centre)
            for bit in rng.choice(width, rng.integers(0, 6)):
                x ^= 1 << int(bit) * 2
            out.append(x)
    return np.unique(np.array(out, dtype=np.uint64))


@pytest.mark.parametrize("longest", [2, 20, 4096])
def test_postings_keep_all_components(spark, longest):
    prints = prints_of(longest)
    found = links(spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "print long"), longest).collect()
    at = {int(p): k for k, p in enumerate(prints.view(np.int64))}
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= DISTANCE
    assert parts(len(prints), [(at[r.a], at[r.b]) for r in found]) == parts(len(prints), zip(*np.nonzero(near), strict=True))


def parts(n, pairs):
    name = list(range(n))

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    for a, b in pairs:
        a, b = root(a), root(b)
        name[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def test_linked_prints_share_a_key_on_every_level():
    rng = random.Random(2)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), DISTANCE):
            b ^= 1 << bit
        prints = np.array([a, b], dtype=np.uint64)
        assert linked(prints[:1], prints[1:])[0]
        keys = first_keys(prints)
        met = [k for k in range(8) if keys[0, k] == keys[1, k]]
        assert met
        for k in met:
            second = second_keys(prints, keys[:, k])
            again = [m for m in range(10) if second[0, m] == second[1, m]]
            assert again
            for m in again:
                third = third_keys(prints, second[:, m])
                assert (third[0] == third[1]).any()
