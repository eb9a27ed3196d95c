import re

from parcelle.llm.templates import LITERALS, SHARE, UNITS, WINDOW, contaminated

ITEM = "If Anna buys 12 pencils for 3 dollars each and Bob buys 5 more pencils how much does Anna pay in total?"
SCHEMA = "doc_id long, text string, code int, item_id string"


def tokens(text):
    """(token, value) pairs, slots as single letters."""
    out, opens, last = [], True, False
    for gap, raw in re.findall(r"([\x20\x09-\x0D]*)([^\x20\x09-\x0D]+)", text or ""):
        opens = opens or "\n" in gap
        word = raw.strip("!\"#&'()*,-./:;<=>?@[\\]^_`{|}~")
        if word:
            number = any(c in "0123456789" for c in word)
            unit = last and word.lower() in UNITS and not number
            name = not number and not unit and not opens and word[0] != word[0].lower() and ord(word[0]) < 0xDF
            value = word.lower()
            out.append(("#" if number else "U" if unit else "N" if name else value, value))
            last = number
        opens = raw[-1] in ".!?:"
    return out


def windows(text, length):
    ts = tokens(text)
    for k in range(len(ts) - length + 1):
        part = ts[k : k + length]
        if sum(t not in "#UN" for t, _ in part) >= LITERALS:
            yield k, tuple(t for t, _ in part), [v for t, v in part if t in "#UN"]


def brute(docs, items):
    out = set()
    for i, text in items:
        length = min(WINDOW, len(tokens(text)))
        mine = {}
        for k, w, slots in windows(text, length):
            mine.setdefault(w, (k, slots))
        for d, body in docs:
            runs = {}
            for k, w, values in windows(body, length):
                if w in mine:
                    run = runs.setdefault(k - mine[w][0], (set(), set()))
                    run[0].add(w)
                    run[1].update(zip(mine[w][1], values, strict=True))
            good = set()
            for ws, pairs in runs.values():
                if len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs}):
                    good |= ws
            if mine and len(good) >= SHARE * len(mine):
                out.add((d, i))
    return out


def run(spark, docs, items, **more):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], SCHEMA)
    bench = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, doc_id string")
    return {(r.doc_id, r.item_id) for r in contaminated(df, bench, **more).collect()}


def test_reparameterised(spark):
    other = ITEM.replace("Anna", "Carl").replace("Bob", "Dana").replace("12", "40").replace("3 ", "7 ").replace("5 ", "9 ")
    mixed = ITEM.replace("Anna", "Carl", 1)  # one name stands for two
    docs = [(1, "Some words before it. " + other + " And some after."), (2, mixed), (3, ITEM.upper()), (4, ITEM.lower()),
            (5, "pencils are cheap and Bob knows"), (6, None), (7, ""), (None, ITEM)]
    items = [(1, ITEM), (2, "too short"), (3, None), (4, "four plain words here")]
    got = run(spark, docs, items)
    assert {(1, 1)} <= got and not any(d in (2, 5, 6, 7) for d, _ in got)
    assert got == brute([d for d in docs if d[0] is not None], items)
    assert got == run(spark, docs, items, block=3)
    assert run(spark, docs[:0] or [(9, "")], items) == set() and run(spark, docs, [(1, "")]) == set()


def test_whole_small_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    want = brute(docs, items)
    assert want and run(spark, docs, items) == want


def test_any_case(spark):
    other = "what is the weight of a stone that falls from a tower of some height"
    docs = [(1, ITEM.upper()), (2, ITEM.lower()), (3, "x " + other.upper() + " Y"), (4, other.title()), (5, "IF ANNA BUYS NOTHING"), (6, ITEM)]
    docs += [(7, "FOUR PLAIN WORDS HERE"), (8, "PAGE 7 OF 9")]
    items = [(1, ITEM), (2, other), (3, "four plain words here"), (4, "page 7 of 9")]
    want = {(1, 1), (2, 1), (6, 1), (3, 2), (4, 2), (7, 3)}
    assert run(spark, docs, items, any_case=True) == want == run(spark, docs, items, any_case=True, block=3)
    assert run(spark, [(1, ITEM)], [(1, ITEM.upper())], any_case=True) == {(1, 1)}


def test_query_finds_copies_in_capitals(spark, tmp_path):
    from parcelle.llm.queries import QUERIES

    docs = [(1, ITEM.upper(), 1, "x"), (2, ITEM.lower(), 1, "x"), (3, "none of it", 1, "x")]
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(5, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = QUERIES["op7_decontamination"](spark, str(tmp_path)).collect()
    assert {r.doc_id: r["items"] for r in got} == {1: "5", 2: "5", 3: ""}
