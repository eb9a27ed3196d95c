"""Quality rules with host verdicts, in DataFrame functions only.

A document fails the base rules when it has fewer than 50 words or when more than half of its
words lie in repeated 3-word windows. It fails the doubtful rules when it has more than a symbol for each ten words, or when more than
a third of its lines repeat an earlier one; this alone does not reject it, since tables, code and lyrics look alike.

Documents that fail any rule are added up by host, and each host's failure rate is shrunk towards the corpus by a beta
prior fitted to the hosts. The verdict joins back to the documents: where the shrunk rate is above the corpus' rate,
doubtful documents are rejected too; where it passes ``max_rate``, all are. Elsewhere doubtful documents stay.

Nulls: a null text has no words and fails; a null host is the host ``''``. Repeated rows are judged
and counted each for itself. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import BLANKS, kept_table, small_or_shuffled

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = r"[#*$%&|<>]"
MAX_SYMBOLS_PER_10_WORDS = 1
MAX_DUP_LINES_PERCENT = 30
# A host is rejected as a whole only when nearly all it publishes fails.
MAX_RATE = 0.9
# Hosts in a broadcast verdict table; about 50 bytes each.
BROADCAST_HOSTS = 200_000


def repeat_words(words: str) -> Column:
    """Words covered by 3-word windows found twice or more in the array column ``words``.

    Windows become (hash, position) pairs, sorted inside the row; equal neighbours are repeats and
    the covered words follow from the gaps between repeated positions. ``words`` must be a column
    of its own, not an expression, since the lambdas refer to it for each element.
    """
    windows = (
        f"transform(sequence(0, size({words}) - 3), i -> named_struct("
        f"'h', xxhash64({words}[i], {words}[i + 1], {words}[i + 2]), 'i', i))"
    )
    return F.expr(f"if(size({words}) < 4, array(), array_sort({windows}))")


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines (those with a word) in ``__m``."""
    raw = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    words = docs.withColumn("__text", raw).withColumn(
        "__words", F.expr(f"filter(split(__text, '{BLANKS}'), w -> w <> '')".replace("\\", "\\\\"))
    )
    lines = words.withColumn(
        "__lines", F.expr("filter(split(__text, '\\\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')")
    )
    sorted_windows = lines.withColumn("__win", repeat_words("__words"))
    at = sorted_windows.withColumn(
        "__at",
        F.expr(
            "array_sort(transform(filter(__win, (x, k) -> "
            "coalesce(get(__win, k - 1).h = x.h, false) or coalesce(get(__win, k + 1).h = x.h, false)), x -> x.i))"
        ),
    )
    covered = F.expr(
        "aggregate(__at, named_struct('n', 0L, 'p', -9), "
        "(s, i) -> named_struct('n', s.n + least(3, i - s.p), 'p', i), s -> s.n)"
    )
    return at.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.struct(
            F.size("__words").cast("long").alias("n_words"),
            F.expr("aggregate(__words, 0L, (n, w) -> n + char_length(w))").alias("word_chars"),
            (F.length("__text") - F.length(F.regexp_replace("__text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
            covered.alias("n_repeat_words"),
            F.size("__lines").cast("long").alias("n_lines"),
        ).alias("__m"),
    )


def base_failed() -> Column:
    m = F.col("__m")
    return (m.n_words < MIN_WORDS) | (m.n_repeat_words * 100 > m.n_words * MAX_REPEAT_PERCENT)


def doubtful() -> Column:
    m = F.col("__m")
    return (m.n_symbols * 10 > m.n_words * MAX_SYMBOLS_PER_10_WORDS) | (
        m.n_dup_lines * 100 > m.n_lines * MAX_DUP_LINES_PERCENT
    )


def host_verdicts(judged: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """``(__host, __banned)`` of hosts worse than the corpus from rows ``(__host, __failed, __doubtful)``; other hosts have no row.

    The beta prior comes from the first two moments of the hosts' failure rates; where these have
    no spread beyond chance the prior keeps the weight of the mean host.
    """
    hosts = judged.groupBy("__host").agg(
        F.count("*").alias("n"), F.sum((F.col("__failed") | F.col("__doubtful")).cast("long")).alias("f")
    )
    rate = F.col("f") / F.col("n")
    moments = hosts.agg(
        (F.sum("f") / F.sum("n")).alias("mu"), F.var_pop(rate).alias("v"), F.avg("n").alias("size")
    )
    spread = F.col("mu") * (1 - F.col("mu"))
    weight = F.when(
        (F.col("v") > 0) & (F.col("v") < spread), spread / F.col("v") - 1
    ).otherwise(F.col("size"))
    prior = moments.select("mu", weight.alias("w"))
    shrunk = (F.col("f") + F.col("mu") * F.col("w")) / (F.col("n") + F.col("w"))
    # ``prior`` is one aggregate row, a bounded broadcast; the margin is for floating noise
    judged_hosts = hosts.join(F.broadcast(prior)).select("__host", "mu", shrunk.alias("rate"))
    return judged_hosts.where(F.col("rate") > F.least(F.col("mu") * (1 + 1e-9), F.lit(max_rate))).select(
        "__host", (F.col("rate") > max_rate).alias("__banned")
    )


def quality_rules(
    docs: DataFrame, text: str = "text", host: str = "source", carry: list[str] | None = None,
    max_rate: float = MAX_RATE, broadcast_hosts: int = BROADCAST_HOSTS,
) -> DataFrame:
    """The columns ``carry`` (all, if not given) of ``docs`` with ``__m`` (measures), ``__failed`` (base
    rules), ``__doubtful`` and ``__kept`` (with the host's verdict), a row for each document.

    The texts are measured once into a written table, which both the host sums and the verdicts read.
    Hosts are summed with map-side combination, so a hot host costs one row per task. Verdicts
    come back by a broadcast of counted size, else by a join whose hot keys adaptive execution splits.
    """
    name = F.coalesce(F.col(f"`{host}`").cast("string"), F.lit("")) if host in docs.columns else F.lit("")
    judged = kept_table(
        measures(docs.withColumn("__host", name), text)
        .withColumn("__failed", base_failed()).withColumn("__doubtful", doubtful())
        .select(*[f"`{c}`" for c in (docs.columns if carry is None else carry)], "__host", "__m", "__failed", "__doubtful"),
        "judged",
    )
    worse = small_or_shuffled(host_verdicts(judged, max_rate), broadcast_hosts)
    verdict = judged.join(worse, "__host", "left")
    told = F.col("__banned").isNotNull() & (F.col("__banned") | F.col("__doubtful"))
    return verdict.withColumn("__kept", ~F.col("__failed") & ~told).drop("__banned", "__host")
