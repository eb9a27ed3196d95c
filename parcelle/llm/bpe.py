"""Byte-level BPE encoding and decoding by recursive DuckDB queries inside each partition.

Encoding splits a text by the tokenizer's pattern and encodes each distinct piece once. A recursive query spreads each
piece into rows of (piece, position, token), joins neighbours with the merge table and contracts the piece's leftmost pair
of least rank, round by round, until no pair of the piece is in the table. Decoding joins
token rows with the vocabulary and adds their bytes up in order.

The vocabulary is read on the driver (its size is fixed) and sent along; pieces seen before are kept in a bounded
memory of the Python worker, which forgets those of a single batch first. Pieces above ``LONG`` bytes, where a round for each merge would grow with the square of
the length, are contracted with a heap of pairs instead, with the same result.

Nulls are empty texts (or no tokens); repeated rows give equal rows; empty tables give empty results. Ids
outside the vocabulary are an error when decoding.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator
from functools import cache, cached_property

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import picked

LONG = 512
# Pieces in one recursive query, bytes of text and tokens handled at once, pieces remembered by a worker.
BATCH = 15_000
TEXT_BATCH = 1 << 20
TOKEN_BATCH = 300_000
REMEMBERED = 300_000

ROUNDS = """
WITH RECURSIVE t(w, tok, done) AS (
  SELECT w, tok, false FROM start
  UNION ALL
  SELECT t.w,
         CASE WHEN b.best IS NULL THEN t.tok
              ELSE t.tok[:(b.best % 1048576) - 1] || [CAST(b.best // 1048576 AS INTEGER)] || t.tok[(b.best % 1048576) + 2:] END,
         b.best IS NULL
  FROM t LEFT JOIN (
    SELECT w, min(m.rank::BIGINT * 1048576 + p) AS best
    FROM (SELECT w, unnest(tok[:-2]) AS l, unnest(tok[2:]) AS r, unnest(range(1, len(tok))) AS p FROM t WHERE NOT done) x
    JOIN merges m ON m.l = x.l AND m.r = x.r
    GROUP BY w
  ) b ON b.w = t.w
  WHERE NOT t.done
)
SELECT w, tok FROM t WHERE done
"""


class Coder:
    """A vocabulary with its merge table in an in-memory database of this process."""

    def __init__(self, packed: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, packed.splitlines())}
        self.pattern = regex.compile(pattern)
        self.known: dict[str, bytes] = {}  # ids as 32-bit integers
        self.again: set[str] = set()  # pieces of known that a later batch met
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "200MB", "temp_directory": ""})
        vocabulary = pa.table(
            [pa.array(list(self.ranks.values()), pa.int32()), pa.array([t.decode("latin-1") for t in self.ranks])],
            names=["id", "piece"],
        )
        self.db.register("given", vocabulary)
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM given")
        self.db.unregister("given")
        self.merging = False

    def _pairs(self) -> Iterator[tuple[int, int, int]]:
        """(left, right, token) of each way to put a token together from two."""
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                left, right = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if left is not None and right is not None:
                    yield left, right, rank

    def _merges(self) -> None:
        """The merge table, made when it is first needed: decoding has no use for it."""
        if not self.merging:
            rows = list(self._pairs())
            given = pa.table([pa.array(c, pa.int32()) for c in zip(*rows, strict=True)], names=["l", "r", "rank"])
            self.db.register("given", given)
            self.db.execute("CREATE TABLE merges AS SELECT * FROM given")
            self.db.unregister("given")
            self.merging = True

    @cached_property
    def pairs(self) -> dict[tuple[int, int], int]:
        return {(a, b): r for a, b, r in self._pairs()}

    def _contract(self, pieces: list[str]) -> None:
        self._merges()
        coded = [p.encode() for p in pieces]
        lengths = np.array([len(b) for b in coded])
        ends = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
        tokens = self.byte[np.frombuffer(b"".join(coded), np.uint8)]
        start = pa.table({
            "w": pa.array(np.arange(len(coded), dtype=np.int32)),
            "tok": pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens)),
        })
        self.db.register("start", start)
        found = self.db.sql(ROUNDS).to_arrow_table().combine_chunks()
        self.db.unregister("start")
        lists = found.column("tok").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        raw, cuts = lists.values.to_numpy().astype(np.int32).tobytes(), (lists.offsets.to_numpy() * 4).tolist()
        for k, i in enumerate(found.column("w").to_pylist()):
            self.known[pieces[i]] = raw[cuts[k] : cuts[k + 1]]

    def _heaped(self, piece: str) -> list[int]:
        """The same contraction with a heap of pairs, for a long piece."""
        tokens = [int(t) for t in self.byte[np.frombuffer(piece.encode(), np.uint8)]]
        n = len(tokens)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, tokens[i], tokens[i + 1]) for i in range(n - 1)
                if (r := self.pairs.get((tokens[i], tokens[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or tokens[i] != left or tokens[j] != right:
                continue
            tokens[i], alive[j], after[i] = rank, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < n:
                    pair = (tokens[a], tokens[after[a]])
                    if (r := self.pairs.get(pair)) is not None:
                        heapq.heappush(heap, (r, a, *pair))
        return [t for t, on in zip(tokens, alive, strict=True) if on]

    def encode(self, texts: list[str]) -> list[list[str]]:
        """Pieces of each text, all of them known afterwards."""
        split = [self.pattern.findall(t) for t in texts]
        if len(self.known) > REMEMBERED:
            # pieces that only one batch held make room; the others stay
            kept = self.again if len(self.again) <= REMEMBERED // 2 else ()
            self.known = {p: self.known[p] for p in kept}
            self.again = set()
        met = set().union(*split)
        fresh = met.difference(self.known)
        self.again |= met - fresh
        rest = []
        for piece in fresh:
            coded = piece.encode()
            whole = self.ranks.get(coded)
            if whole is not None:
                self.known[piece] = np.int32(whole).tobytes()
            elif len(coded) > LONG:
                self.known[piece] = np.array(self._heaped(piece), dtype=np.int32).tobytes()
            else:
                rest.append(piece)
        for i in range(0, len(rest), BATCH):
            self._contract(rest[i : i + BATCH])
        return split

    def decode(self, text: np.ndarray, token: np.ndarray) -> list[tuple[int, bytes]]:
        """Bytes of each text from token rows in order."""
        rows = pa.table({"w": text.astype(np.int32), "p": np.arange(len(token), dtype=np.int32), "id": token.astype(np.int32)})
        self.db.register("tokens", rows)
        found = self.db.sql(
            "SELECT w, string_agg(piece, '' ORDER BY p) AS piece, count(piece) AS n FROM tokens LEFT JOIN vocabulary USING (id) GROUP BY w"
        ).to_arrow_table()
        self.db.unregister("tokens")
        if sum(found.column("n").to_pylist()) != len(token):
            raise ValueError("an id is not in the vocabulary")
        return [
            (w, piece.encode("latin-1"))
            for w, piece in zip(found.column("w").to_pylist(), found.column("piece").to_pylist(), strict=True)
        ]


@cache
def coder(packed: bytes, pattern: str) -> Coder:
    return Coder(packed, pattern)


def _packed(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _encoder(packed: bytes, pattern: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(packed, pattern)
        for batch in batches:
            sizes = np.asarray(pa.compute.binary_length(batch.column("text")))
            at = 0
            while at < batch.num_rows:
                end = max(at + 1, at + int(np.searchsorted(np.cumsum(sizes[at:]), TEXT_BATCH, side="right")))
                split = code.encode(batch.column("text").slice(at, end - at).to_pylist())
                coded = [b"".join(map(code.known.__getitem__, pieces)) for pieces in split]
                ends = np.concatenate(([0], np.cumsum([len(c) // 4 for c in coded]))).astype(np.int32)
                ids = np.frombuffer(b"".join(coded), dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, end - at),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))],
                    names=["doc_id", "ids"],
                )
                at = end

    return run


def _decoder(packed: bytes, pattern: str, token_batch: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(packed, pattern)
        for batch in batches:
            lists = batch.column("ids")
            ends, token = lists.offsets.to_numpy(), lists.values.to_numpy()
            at = 0
            while at < batch.num_rows:
                # rows of about token_batch tokens together; a longer row stands alone and is decoded in parts
                end = max(at + 1, int(np.searchsorted(ends, ends[at] + token_batch, side="right")) - 1)
                decoded: list[list[bytes]] = [[] for _ in range(at, end)]
                owner = np.repeat(np.arange(end - at, dtype=np.int32), np.diff(ends[at : end + 1]))
                for a in range(0, len(owner), token_batch):
                    part = token[ends[at] + a : min(ends[at] + a + token_batch, ends[end])]
                    for w, piece in code.decode(owner[a : a + token_batch], part):
                        decoded[w].append(piece)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, end - at), lists.slice(at, end - at),
                     pa.array([b"".join(d) for d in decoded], pa.binary())],
                    names=["doc_id", "ids", "decoded"],
                )
                at = end

    return run


def bpe_encode(
    docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``(doc_id, ids)``: token ids of each whole text, without special tokens."""
    return picked(docs, id_column, text_column).mapInArrow(_encoder(_packed(path), pattern), "doc_id long, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str, pattern: str, token_batch: int = TOKEN_BATCH) -> DataFrame:
    """``(doc_id, ids, decoded)``: the bytes that the ids of each row stand for."""
    rows = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(_decoder(_packed(path), pattern, token_batch), "doc_id long, ids array<int>, decoded binary")


def bpe_round_trip(
    docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text", token_batch: int = TOKEN_BATCH,
) -> DataFrame:
    """``bpe_decode`` of ``bpe_encode`` in one Python worker for each task, so that it holds one vocabulary and database."""
    packed = _packed(path)
    encode, decode = _encoder(packed, pattern), _decoder(packed, pattern, token_batch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from decode(encode(batches))
        # what Arrow keeps for later would stay with the idle worker
        pa.default_memory_pool().release_unused()

    return picked(docs, id_column, text_column).mapInArrow(run, "doc_id long, ids array<int>, decoded binary")
