import random

from pyspark.sql import functions as F

from parcelle.llm.warc import UPDATED, canonical_url, captures, resolve_revisits

SCHEMA = "record_id long, kind string, url string, time long, status int, headers map<string,string>, payload string, key string, part int"


def brute(rows):
    first = {}
    for r in sorted(rows, key=lambda r: (r[3] is not None, r[3] or 0, r[1], r[2] or "")):
        if r[0] is not None:
            first.setdefault(r[0], r)
    out = {}
    for i, kind, url, time, _, headers, payload, *_ in first.values():
        own = headers or {}
        if kind != "revisit":
            out[i] = (None, i, own, payload)
            continue
        base = max(
            (r for r in first.values() if r[1] == "response" and r[4] == 200 and r[6] is not None and None not in (url, time, r[2], r[3])
             and r[2] == url and (r[3], r[0]) < (time, i)),
            key=lambda r: (r[3], r[0]), default=None,
        )
        old = (base[5] or {}) if base else {}
        name = next((n for n in ("etag", "last-modified", "warc-payload-digest") if n in own), None)
        bare = lambda v, n=name: v[2:] if n == "etag" and v and v.startswith("W/") else v
        if base is None:
            found = "no-response"
        elif name is None:
            found = "unvalidated"
        else:
            found = "resolved" if name in old and bare(own[name]) == bare(old[name]) else "mismatch"
        if found == "resolved":
            out[i] = (found, base[0], old | {k: v for k, v in own.items() if k in UPDATED}, base[6])
        else:
            out[i] = (found, None, own, None)
    return out


def test_equals_scan(spark):
    rng = random.Random(9)
    rows = []
    for i in range(400):
        kind = rng.choice(["response", "revisit", "revisit"])
        names = rng.sample(["etag", "last-modified", "warc-payload-digest", "date", "content-type"], rng.randint(0, 4))
        headers = {n: rng.choice(["1", "2", "W/1"]) for n in names} or rng.choice([None, {}])
        url = rng.choice(["a.b/1", "a.b/2", "a.b/2", "a.b/2", None])
        payload = f"body{i}" if kind == "response" and rng.random() < 0.9 else None
        rows.append((i, kind, url, rng.choice([None, *range(60)]), rng.choice([200, 200, 404]), headers, payload, "x", 1))
    rows += [rows[5], (None, "revisit", "a.b/1", 3, 304, None, None, "x", 1)]
    for size in (200_000, 20):
        got = resolve_revisits(spark.createDataFrame(rows, SCHEMA), rows_per_part=size).collect()
        told = {r.record_id: (r.resolution, r.base_id, r.headers, r.payload) for r in got}
        assert told.pop(None) == ("no-response", None, {}, None)
        assert told == brute(rows) and len(got) == 401
    assert resolve_revisits(spark.createDataFrame([], SCHEMA)).collect() == []


def test_canonical(spark):
    urls = ["HTTP://www.A.com:80/x/?b=2&utm_source=f&a=1#top", "https://a.com/x?a=1&b=2", "a.com/x/index.html?ref=q&b=2&a=1", None, ""]
    got = [r.u for r in spark.createDataFrame([(u,) for u in urls], "u string").select(canonical_url(F.col("u")).alias("u")).collect()]
    assert got == ["a.com/x?a=1&b=2"] * 3 + [None, ""]


def test_round_trip(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}") for i in range(8)] + [(9, None, None)], "page_id long, url string, html string")
    got = {r.record_id: r for r in resolve_revisits(captures(pages)).collect()}
    assert [got[2 * i + 1].payload for i in (0, 1, 4, 5)] == [f"<p>{i}" for i in (0, 1, 4, 5)]
    assert got[19].resolution == "no-response" and got[5].resolution == "mismatch" and got[7].resolution == "unvalidated"


def test_records_without_id_have_rows(spark):
    pages = spark.createDataFrame([(None, "http://a/x", "h"), (4, "http://a/x", "h")], "page_id long, url string, html string")
    got = resolve_revisits(captures(pages)).collect()
    assert sorted((r.record_id or 0, r.resolution, r.payload) for r in got if r.record_id) == [(8, None, "h"), (9, "resolved", "h")]
    assert sorted((r.kind, r.resolution, r.base_id, r.payload) for r in got if not r.record_id) == [
        ("response", None, None, "h"), ("revisit", "no-response", None, None)
    ]


def test_repeated_records_keep_their_own_payload(spark):
    rows = [(1, "response", u, 5, 200, {"etag": u}, f"body {u}", "x", 1) for u in ("a/b", "a/a", "a/c")]
    rows += [(1, None, "a/z", 9, None, None, "late", "x", 1)]
    rows += [(2, "revisit", "a/a", 8, 304, {"etag": "a/a"}, None, "x", 1), (3, "revisit", "a/b", 8, 304, {"etag": "a/b"}, None, "x", 1)]
    for k in range(3):
        df = spark.createDataFrame(rows[k:] + rows[:k], SCHEMA)
        got = {r.record_id: (r.resolution, r.headers["etag"], r.payload) for r in resolve_revisits(df).collect()}
        assert got == {1: (None, "a/a", "body a/a"), 2: ("resolved", "a/a", "body a/a"), 3: ("no-response", "a/b", None)}
