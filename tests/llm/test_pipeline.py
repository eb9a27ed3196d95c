import base64
import hashlib

import public_tokenizers
import tiktoken

import corpus_pipeline
from tests.llm import brute, test_lines, test_quality, test_templates

FOLDER = "/root/testdata/sf0.001"


def expected(rows, items):
    kept = test_quality.verdicts([(t, h) for _, t, h in rows])
    rows = [(i, t) for (i, t, _), k in zip(rows, kept, strict=True) if k]
    cut = [(i, t) for i, _, gone, t in test_lines.brute(rows, 3) if not gone or brute.WORD.search(t)]
    groups = brute.near(cut, 5)
    cut = [(i, t) for i, t in cut if groups[i][1] == i]
    bad = {d for d, _ in test_templates.brute(cut, items)}
    return {i: t for i, t in cut if i not in bad}


def test_whole_pipeline_against_brute_force(spark):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {i: (coder.encode_ordinary(t), hashlib.sha256(t.encode()).hexdigest()) for i, t in expected(rows, items).items()}
    got = {r.doc_id: (list(r.ids), r.decoded_sha256) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert got == want and 0 < len(want) < len(rows)


def test_stages_keep_columns_and_bear_nulls(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    long_text = " ".join(f"word{i}" for i in range(80))
    rows = [(1, long_text, "en", None, None), (2, None, None, None, None), (None, long_text + " more", "en", "a", 3), (4, long_text, None, "b", 9)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    assert sorted(r.doc_id or 0 for r in docs.collect()) == [0, 1]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], schema), FOLDER).collect() == []
