import collections
import random

from parcelle.llm.common import components, small_or_shuffled
from parcelle.llm.quality import quality_rules
from tests.llm.brute import WORD

SCHEMA = "doc_id long, text string, source string, n long"


def measures(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = collections.Counter(windows)
    repeated = {k for i, w in enumerate(windows) if count[w] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), len(lines)


def verdicts(rows, max_rate=0.9):
    """Kept flags of ``(text, host)`` rows."""
    judged = []
    for text, host in rows:
        n, _, symbols, dup, repeated, lines = measures(text)
        judged.append((host or "", n < 50 or 100 * repeated > 50 * n, symbols * 10 > n or dup * 100 > lines * 30))
    total, fails = collections.Counter(h for h, *_ in judged), collections.Counter(h for h, a, b in judged if a or b)
    if not judged:
        return []
    mu, rates = sum(fails.values()) / len(judged), [fails[h] / total[h] for h in total]
    v = sum((r - sum(rates) / len(rates)) ** 2 for r in rates) / len(rates)
    weight = mu * (1 - mu) / v - 1 if 0 < v < mu * (1 - mu) else len(judged) / len(total)
    rate = {h: (fails[h] + mu * weight) / (total[h] + weight) for h in total}
    return [not failed and rate[h] <= max_rate and not (doubt and rate[h] > mu * (1 + 1e-9)) for h, failed, doubt in judged]


def test_measures_and_base_rules(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(["a ", "bé ", "c\n", "# ", "  ", "\t", "a b c "]) for _ in range(rng.randint(0, 90))) for _ in range(200)]
    texts += [None, "", " \n\t", "x", "a b", "a b c", "a b c a b c", "w " * 5000]
    df = spark.createDataFrame([(i, t, "h", 1) for i, t in enumerate(texts)], SCHEMA)
    for r in quality_rules(df, carry=["doc_id"], max_rate=1.0).collect():
        m = measures(texts[r.doc_id])
        assert tuple(r["__m"]) == m, texts[r.doc_id]
        assert r["__failed"] == (m[0] < 50 or 100 * m[4] > 50 * m[0]) and r["__kept"] == (not r["__failed"])


def test_hosts(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, "bad", "junk.example", 0) for i in range(200)] + [(300, good, "junk.example", 0)]
    rows += [(1000 + i, good if i % 10 else "bad", f"h{i % 20}", 0) for i in range(400)]
    rows += [(5000, good, None, 0), (5000, good, None, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    for bound in (10_000, 0):
        got = quality_rules(df, carry=["doc_id"], broadcast_hosts=bound).collect()
        kept = {r.doc_id for r in got if r["__kept"]}
        assert len(got) == len(rows) and 300 not in kept and 5000 in kept
        assert {1000 + i for i in range(400) if i % 10} <= kept
    assert quality_rules(df.limit(0), carry=["doc_id"]).collect() == []


def test_doubtful_documents_go_with_worse_hosts(spark):
    rng = random.Random(8)
    good = " ".join(f"w{i}" for i in range(60))
    odd, again = good + " |" * 30, "\n".join(["same line of words"] * 8) + "\n" + good.replace(" ", "\n")
    rows = []
    for i in range(900):
        host = rng.choice(["a", "b", "c", "d", None])
        share = {"a": 0.4, "b": 0.05, "c": 0.2, "d": 0.01, None: 0.3}[host]
        text = rng.choice([odd, "\n".join([good] * 2), again, "short", None]) if rng.random() < share else good + f" v{i}"
        rows.append((i, text, host, 0))
    got = {r.doc_id: r["__kept"] for r in quality_rules(spark.createDataFrame(rows, SCHEMA), carry=["doc_id"]).collect()}
    want = verdicts([(t, h) for _, t, h, _ in rows])
    assert [got[i] for i in range(900)] == want
    odd_kept = {h: {k for (_, t, g, _), k in zip(rows, want, strict=True) if t == odd and g == h} for h in ("a", "b", "d")}
    assert odd_kept["a"] == {False} and odd_kept["b"] == {True}


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 200), (200, 150), (7, 7), (300, 300), (500, 400)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {100: 100, 150: 100, 200: 100, 400: 400, 500: 400}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
    assert small_or_shuffled(spark.range(3), 2).count() == 3
