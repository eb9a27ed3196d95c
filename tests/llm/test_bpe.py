import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from parcelle.llm import bpe
from parcelle.llm.bpe import bpe_decode, bpe_encode
from parcelle.llm.queries import op1

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_equals_library(spark, reference):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab Zé'\n\t0127.,!=漢😀thein") for _ in range(rng.randint(0, 90))) for _ in range(300)]
    texts += [None, "", " " * 3000, "=" * 1500, "aaaa" * 400 + " x", "don't we'll <|endoftext|>", "é" * 700]
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    coded = bpe_decode(bpe_encode(df, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN).collect()
    got = {r.doc_id: (list(r.ids), bytes(r.decoded)) for r in coded}
    assert got == {i: (reference.encode_ordinary(t or ""), (t or "").encode()) for i, t in enumerate(texts)}
    assert bpe_encode(df.limit(0), PATH, public_tokenizers.PATTERN).collect() == []


def test_long_rows_are_decoded_in_parts(spark):
    rows = [(1, list(range(50))), (2, []), (3, None), (4, [256, 256]), (5, list(range(20)))]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    code = bpe.coder(bpe._packed(PATH), public_tokenizers.PATTERN)
    back = {r: t for t, r in code.ranks.items()}
    got = {r.doc_id: bytes(r.decoded) for r in bpe_decode(df, PATH, public_tokenizers.PATTERN, token_batch=7).collect()}
    assert got == {i: b"".join(back[x] for x in ids or []) for i, ids in rows}


def test_heap_equals_rounds():
    code = bpe.coder(bpe._packed(PATH), public_tokenizers.PATTERN)
    rng = random.Random(2)
    pieces = ["".join(rng.choice(a) for _ in range(rng.randint(2, 60))) for a in ("ab", "theinr", "=-", "aé1") for _ in range(50)]
    pieces = sorted(set(pieces))
    code._contract(pieces)
    assert all(list(np.frombuffer(code.known[p], np.int32)) == code._heaped(p) for p in pieces)


def test_unknown_id(spark):
    df = spark.createDataFrame([(1, [10_000_000])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe_decode(df, PATH, public_tokenizers.PATTERN).collect()


def test_query_on_whole_small_table(spark, reference):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in op1(spark, folder).collect():
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_round_trip_in_one_worker(spark):
    """The same rows as both operators in a row, from one Python step, so that a task has one worker."""
    df = spark.createDataFrame([(1, "un deux 123  trois\n"), (2, None), (3, "a" * 600 + " été")], "doc_id long, text string")
    both = bpe_decode(bpe_encode(df, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN)
    once = bpe.bpe_round_trip(df, PATH, public_tokenizers.PATTERN)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, both.collect()))
    assert once._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_frequent_pieces_stay_remembered(monkeypatch, reference):
    """A full memory forgets pieces of one batch and keeps those met again; ids stay the same."""
    monkeypatch.setattr(bpe, "REMEMBERED", 8)
    code, contracted = bpe.Coder(bpe._packed(PATH), public_tokenizers.PATTERN), []
    contract = code._contract
    monkeypatch.setattr(code, "_contract", lambda pieces: contracted.extend(pieces) or contract(pieces))
    for i in range(12):
        text = f"zqzqxk vvkkqj{'abcdefghijkl'[i] * 3}xq" + " ".join(f"qq{c}xz{'mnopqrstuvwx'[i]}q" for c in "abc")
        split = code.encode([text])[0]
        ids = [int(x) for p in split for x in np.frombuffer(code.known[p], np.int32)]
        assert ids == reference.encode_ordinary(text) and len(code.known) <= 16
    assert contracted.count("zqzqxk") == 1 and len(contracted) > 30


def test_query_has_one_worker_for_each_task(spark):
    plan = op1(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
