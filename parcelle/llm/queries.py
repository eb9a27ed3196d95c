"""Registered queries of the subpackage, each a thin digest of its operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.llm.bpe import bpe_round_trip
from parcelle.llm.chat import format_chats
from parcelle.llm.codes import ROUNDS, coded_vectors
from parcelle.llm.common import table
from parcelle.llm.lines import MIN_LINES, MIN_WORDS, line_dedup
from parcelle.llm.near import near_duplicates
from parcelle.llm.pii import KINDS, personal_data
from parcelle.llm.quality import MAX_RATE, quality_rules
from parcelle.llm.simhash import near_by_simhash
from parcelle.llm.structure import damaged_and_repaired
from parcelle.llm.substrings import substring_dedup
from parcelle.llm.suffixes import suffix_dedup
from parcelle.llm.templates import contaminated
from parcelle.llm.warc import captures, resolve_revisits

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def keep(run):
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return keep


SQL_MEASURES = r"""
d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT k, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, text FROM d),
u AS (SELECT k, unnest(ws) AS a, unnest(range(len(ws))) AS i FROM w),
v AS (SELECT k, i, a, lead(a) OVER o AS b, lead(a, 2) OVER o AS c FROM u WINDOW o AS (PARTITION BY k ORDER BY i)),
t AS (SELECT k, i, count(*) OVER (PARTITION BY k, a, b, c) AS c FROM v WHERE c IS NOT NULL),
r AS (SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS p FROM t WHERE c > 1) GROUP BY k),
m AS (SELECT k, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
          - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
        len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) AS n_lines,
        coalesce(r.n, 0) AS n_repeat_words FROM w LEFT JOIN r USING (k)),
j AS (SELECT d.doc_id, d.host, m.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS failed,
        n_symbols * 10 > n_words OR n_dup_lines * 100 > n_lines * 30 AS doubtful
      FROM m JOIN d USING (k)),
h AS (SELECT host, count(*) AS n, sum((failed OR doubtful)::INT) AS f FROM j GROUP BY host),
p AS (SELECT sum(f) / sum(n) AS mu, var_pop(f / n) AS v, avg(n) AS size FROM h),
q AS (SELECT mu, CASE WHEN v > 0 AND v < mu * (1 - mu) THEN mu * (1 - mu) / v - 1 ELSE size END AS wt FROM p),
y AS (SELECT host, mu, (f + mu * wt) / (n + wt) AS rate FROM h, q),
x AS (SELECT host, rate > {rate} AS banned FROM y WHERE rate > least(mu * (1 + 1e-9), {rate}))
"""

OP3_SQL = (
    "WITH " + SQL_MEASURES.replace("{rate}", str(MAX_RATE)) + """
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(n_lines AS BIGINT) AS n_lines, failed AS base_failed, doubtful,
  NOT failed AND (banned IS NULL OR NOT (banned OR doubtful)) AS kept FROM j LEFT JOIN x USING (host)"""
)


@query("op3_quality_rules", OP3_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules(table(spark, folder, "documents"), carry=["doc_id"])
    return judged.select("doc_id", "__m.*", F.col("__failed").alias("base_failed"), F.col("__doubtful").alias("doubtful"), F.col("__kept").alias("kept"))


@query("op2_near_duplicates")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), shingle_words=2)


def sha256(column: str):
    return F.sha2(F.col(column).cast("binary"), 256)


OP9_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
u AS (SELECT k, doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM d),
g AS (SELECT k, doc_id, i, string_agg(w, ' ') OVER o AS win, count(*) OVER o AS n FROM u
      WINDOW o AS (PARTITION BY k ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)),
f AS (SELECT md5(win) AS win, k, doc_id, i FROM g WHERE n = 50),
l AS (SELECT k, i, min(doc_id) OVER (PARTITION BY win) < doc_id AS hit FROM f),
c AS (SELECT u.k, u.i, u.w, coalesce(max(l.hit::INT) OVER (PARTITION BY u.k ORDER BY u.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) AS gone
      FROM u LEFT JOIN l USING (k, i)),
r AS (SELECT k, sum(gone) AS n_removed, string_agg(w, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM c GROUP BY k)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN r USING (k)"""


@query("op9_substring_dedup", OP9_SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    found = substring_dedup(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", sha256("kept_text").alias("kept_sha256"))


@query("op4_suffix_dedup")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), sha256("kept").alias("kept_sha256")
    )


def of_kind(kind: str):
    return lambda span: span.kind == kind


@query("op6_personal_data")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_data(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s.base)
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    return found.select(
        "doc_id",
        *[F.size(F.filter(base, of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(told(base).cast("binary"), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", of_kind("secret"))).cast("long").alias("n_secret"),
        F.size("spans").cast("long").alias("n_spans"),
    )


@query("op7_decontamination")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = contaminated(docs, table(spark, folder, "benchmark"), any_case=True).groupBy("doc_id").agg(
        F.array_sort(F.collect_set("item_id")).alias("items")
    )
    return docs.select("doc_id").join(found, "doc_id", "left").select(
        "doc_id", F.col("items").isNotNull().alias("contaminated"),
        F.coalesce(F.array_join(F.transform("items", lambda x: x.cast("string")), ","), F.lit("")).alias("items"),
    )


OP5_SQL = rf"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id) AS k, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
u AS (SELECT k, unnest(ls) AS l, unnest(range(len(ls))) AS i FROM d),
w AS (SELECT k, i, row_number() OVER (PARTITION BY k ORDER BY i) AS j, l FROM u WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
x AS (SELECT k, i, j, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n_words FROM w),
g AS ({" UNION ALL ".join(f"""SELECT k, j, {n} AS n, string_agg(l, chr(10)) OVER o AS run, count(*) OVER o AS c, sum(n_words) OVER o AS n_words FROM x
      WINDOW o AS (PARTITION BY k ORDER BY j ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING)""" for n in range(1, MIN_LINES + 1))}),
f AS (SELECT k, j, n, row_number() OVER (PARTITION BY n, run ORDER BY k, j) > 1 AS later FROM g
      WHERE c = n AND (n = {MIN_LINES} OR n_words >= {MIN_WORDS})),
z AS (SELECT DISTINCT k, unnest(range(j, j + n)) AS j FROM f WHERE later),
c AS (SELECT w.k, w.i, (z.j IS NOT NULL)::INT AS gone FROM w LEFT JOIN z USING (k, j)),
r AS (SELECT u.k, sum(coalesce(gone, 0)) AS n, string_agg(l, chr(10) ORDER BY u.i) FILTER (coalesce(gone, 0) = 0) AS kept
      FROM u LEFT JOIN c USING (k, i) GROUP BY u.k)
SELECT doc_id, CAST(len(ls) AS BIGINT) AS n_lines, CAST(n AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d JOIN r USING (k)"""


@query("op5_line_dedup", OP5_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", sha256("kept_text").alias("kept_sha256"))


VOCABULARY = "byte_bpe_50k.tiktoken"


@query("op1_bpe")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    coded = bpe_round_trip(table(spark, folder, "documents"), path, pattern)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


OP10_SQL = r"""
WITH p AS (SELECT page_id AS i, coalesce(html, '') AS html, md5(coalesce(html, '')) AS tag,
  regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM pages),
q AS (SELECT *, regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^www\.|:(80|443)$', '', 'g') AS host,
  regexp_replace(bare, '^[^/?]*', '') AS rest FROM p),
k AS (SELECT i, html, tag, host || regexp_replace(regexp_extract(rest, '^([^?]*)', 1), '(/index\.html?|/)$', '') ||
  CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS url
  FROM (SELECT *, list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
    lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS kept FROM q)),
a AS (SELECT v.i, v.tag, arg_max(struct_pack(i := r.i, tag := r.tag, html := r.html), r.i) AS b
  FROM k v LEFT JOIN k r ON v.url = r.url AND (r.i * 60 < v.i * 60 + 43200 OR (r.i * 60 = v.i * 60 + 43200 AND r.i * 2 < v.i * 2 + 1))
  GROUP BY v.i, v.tag),
s AS (SELECT i, b, CASE WHEN b IS NULL THEN 'no-response' WHEN i % 4 = 3 THEN 'unvalidated' WHEN i % 4 = 2 THEN 'mismatch'
  WHEN i % 4 = 0 THEN CASE WHEN tag = b.tag THEN 'resolved' ELSE 'mismatch' END
  ELSE CASE WHEN i = b.i THEN 'resolved' ELSE 'mismatch' END END AS resolution FROM a)
SELECT i * 2 AS record_id, CAST(NULL AS VARCHAR) AS resolution, i * 2 AS base_id, 't' || i AS date, 4 AS n_headers, sha256(html) AS payload_sha256 FROM k
UNION ALL
SELECT i * 2 + 1, resolution, CASE WHEN resolution = 'resolved' THEN b.i * 2 END,
  CASE WHEN resolution = 'resolved' AND i % 4 = 1 THEN 't' || b.i WHEN i % 4 <> 1 THEN 'r' || i END,
  CASE WHEN resolution = 'resolved' THEN 4 WHEN i % 4 = 3 THEN 1 ELSE 2 END,
  CASE WHEN resolution = 'resolved' THEN sha256(b.html) END FROM s"""


@query("op10_warc_revisits", OP10_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    found = resolve_revisits(captures(table(spark, folder, "pages")))
    return found.select(
        "record_id", "resolution", "base_id", F.col("headers")["date"].alias("date"), F.size("headers").alias("n_headers"),
        sha256("payload").alias("payload_sha256"),
    )


@query("op8_chat_formatting")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = format_chats(table(spark, folder, "conversations"))
    return found.select(
        "conv_id", "turn", "action", "role_out", "cost", sha256("piece").alias("piece_sha256")
    )


# Initials may be kept where the grammar wants them; an empty turn may come before each turn. States: 0 none yet, 1 s, 2 u, 3 a.
OP11_SQL = r"""
WITH RECURSIVE b AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x::BIGINT, range(8)),
    lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS crc),
o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
p AS (SELECT o.*, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(name, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, k: xor(a >> 8, b.crc[(xor(a, k) & 255) + 1])), 4294967295) % 20 AS pick FROM o, b),
d AS (SELECT conv_id, turn, CASE pick WHEN 4 THEN 'user' ELSE role END AS role,
    CASE pick WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE pick WHEN 3 THEN [0, 1] ELSE [0] END) AS twice FROM p WHERE pick <> 0),
n AS (SELECT dense_rank() OVER (ORDER BY conv_id) AS c, *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
f AS (SELECT *, left(role, 1) AS ini, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') AS cut,
    lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) || left(role, 1) AS pair FROM n),
g AS (SELECT *, blank OR again AS gone, CASE WHEN cut THEN 5 ELSE 0 END AS more FROM f),
r AS (SELECT DISTINCT c, 0::BIGINT AS i, 0 AS st, struct_pack(cost := 0, audit := '', lines := []::VARCHAR[]) AS v FROM g
  UNION ALL
  SELECT c, i, st, min(v) AS v FROM (
    SELECT g.c, g.i, CASE act WHEN 'D' THEN s WHEN 'S' THEN 1 ELSE nx END AS st, struct_pack(
      cost := cost + CASE act WHEN 'D' THEN 2 WHEN 'R' THEN 1 + more ELSE more END,
      audit := audit || CASE act WHEN 'S' THEN 'K' ELSE act END,
      lines := CASE act WHEN 'D' THEN lines WHEN 'R' THEN list_append(lines, CASE nx WHEN 2 THEN 'user' ELSE 'assistant' END || ':' || text)
        ELSE list_append(lines, role || ':' || text) END) AS v
    FROM (SELECT c, i, s, CASE s WHEN 2 THEN 3 ELSE 2 END AS nx, cost, audit, lines FROM (
        SELECT c, i, st AS s, v.cost AS cost, v.audit AS audit, v.lines AS lines FROM r
        UNION ALL SELECT c, i, CASE st WHEN 2 THEN 3 ELSE 2 END, v.cost + 5, v.audit || 'I',
          list_append(v.lines, CASE st WHEN 2 THEN 'assistant:' ELSE 'user:' END) FROM r)) x
    JOIN g ON g.c = x.c AND g.i = x.i + 1, (SELECT unnest(['D', 'R', 'K', 'S']) AS act)
    WHERE act = 'D' OR (NOT gone AND (act = 'R' OR (act = 'K' AND ini = CASE nx WHEN 2 THEN 'u' ELSE 'a' END) OR (act = 'S' AND s = 0 AND ini = 's'))))
  GROUP BY c, i, st),
e AS (SELECT c, min(struct_pack(cost := v.cost + CASE st WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END,
    audit := v.audit || CASE st WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
    lines := v.lines || CASE st WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:'] ELSE []::VARCHAR[] END)) AS v
  FROM r JOIN (SELECT c, max(i) AS i FROM g GROUP BY c) USING (c, i) GROUP BY c),
h AS (SELECT conv_id, c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank::INT) AS blank,
    sum((again AND NOT blank)::INT) AS duplicate, sum((cut AND NOT gone)::INT) AS truncated,
    sum((pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au'))::INT) AS illegal FROM g GROUP BY conv_id, c)
SELECT q.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(v.cost, 0) AS BIGINT) AS cost, coalesce(v.audit, '') AS audit,
  sha256(coalesce(array_to_string(v.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) q LEFT JOIN h ON q.conv_id IS NOT DISTINCT FROM h.conv_id LEFT JOIN e ON e.c = h.c"""


@query("op11_structure_repair", OP11_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return damaged_and_repaired(table(spark, folder, "conversations"))


@query("op12_simhash")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return near_by_simhash(table(spark, folder, "documents"))


def _op13_sql() -> str:
    apart = "list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    parts = [
        """r AS MATERIALIZED (SELECT vec_id, label, v, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS k FROM (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * x::DOUBLE) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
p AS MATERIALIZED (SELECT k, j, v[j * (len(v) // 4) + 1 : (j + 1) * (len(v) // 4)] AS x FROM r, (SELECT unnest(range(4)) AS j)),
c0 AS MATERIALIZED (SELECT j, k - 1 AS e, x FROM p WHERE k <= 256)"""
    ]
    for t in range(ROUNDS + 1):
        parts.append(
            f"a{t} AS MATERIALIZED (SELECT p.k, p.j, p.x, min(struct_pack(d := {apart}, e := c.e)) AS best FROM p JOIN c{t} c USING (j) GROUP BY p.k, p.j, p.x)"
        )
        if t < ROUNDS:
            parts.append(
                f"""m{t} AS MATERIALIZED (SELECT j, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM (
  SELECT j, best.e AS e, i, sum(y)::BIGINT AS s, count(*) AS n FROM (SELECT j, best, unnest(x) AS y, unnest(range(len(x))) AS i FROM a{t}) GROUP BY j, best.e, i)
  GROUP BY j, e),
c{t + 1} AS MATERIALIZED (SELECT c.j, c.e, coalesce(m.x, c.x) AS x FROM c{t} c LEFT JOIN m{t} m ON c.j = m.j AND c.e = m.e)"""
            )
    return "WITH " + ",\n".join(parts) + f""",
w AS (SELECT k, string_agg(printf('%02x', best.e), '' ORDER BY j) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY k)
SELECT r.vec_id, w.code, w.error, CAST(sum(w.error) OVER (PARTITION BY r.label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY j, e)) FROM c{ROUNDS}) AS codebooks_sha256 FROM r JOIN w USING (k)"""


@query("op13_vector_codes", _op13_sql())
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return coded_vectors(table(spark, folder, "embeddings"))
