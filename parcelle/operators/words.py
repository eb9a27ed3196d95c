"""Listing texts per commune: sentiment by lexicon and word frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle import params as P
from parcelle.functions.scores import steady_round
from parcelle.functions.texts import tokens
from parcelle.operators.dedup import latest_snapshot, top_per_key
from parcelle.operators.joins import translate_codes


def listing_texts(
    listings: DataFrame,
    reviews: DataFrame | None = None,
    communes: DataFrame | None = None,
    latest_only: bool = True,
) -> DataFrame:
    """(code_commune, text): title and description joined, plus reviews.

    Repeated snapshots of a listing count once and postal codes are translated;
    ``latest_only=False`` and ``communes=None`` switch these off.
    """
    ties = [c for c in ("title", "description", "commune_code") if c in listings.columns]
    rows = latest_snapshot(listings, ties=ties) if latest_only else listings
    if communes is not None:
        rows = translate_codes(rows, communes)
    parts = [F.col(c) for c in ("title", "description") if c in listings.columns]
    out = rows.select(F.col("commune_code").alias("code_commune"), F.concat_ws(" ", *parts).alias("text"))
    if reviews is not None:
        out = out.unionByName(reviews.select("code_commune", "text"))
    return out.where(F.col("code_commune").isNotNull())


def word_counts(texts: DataFrame, stopwords: Sequence[str] = P.STOPWORDS) -> DataFrame:
    """(code_commune, word, n). The empty word counts the texts themselves.

    Counting is keyed by commune and word with map-side combine, so a commune that
    holds much of the text is spread over its vocabulary.
    """
    words = F.concat(F.array(F.lit("")), F.coalesce(tokens(F.col("text"), stopwords), F.array()))
    return (
        texts.select("code_commune", F.explode(words).alias("word"))
        .groupBy("code_commune", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def sentiment(
    counts: DataFrame,
    positive: Sequence[str] = P.POSITIVE_WORDS,
    negative: Sequence[str] = P.NEGATIVE_WORDS,
) -> DataFrame:
    """Texts, tokens, score in [-1, 1] and label per commune, from ``word_counts``."""
    word, n = F.col("word"), F.col("n")

    def total(condition):
        return F.sum(F.when(condition, n).otherwise(0))

    sums = counts.groupBy("code_commune").agg(
        total(word == "").alias("n_texts"),
        total(word != "").alias("n_tokens"),
        total(word.isin(*positive)).alias("_pos"),
        total(word.isin(*negative)).alias("_neg"),
    )
    raw = F.coalesce(F.try_divide(F.col("_pos") - F.col("_neg"), F.col("_pos") + F.col("_neg")), F.lit(0.0))
    edge = P.SENTIMENT_THRESHOLD
    return sums.withColumn("_raw", raw).select(
        "code_commune", "n_texts", "n_tokens",
        steady_round(F.col("_raw"), 3).alias("sentiment_score"),
        F.when(F.col("_raw") > edge, "positif").when(F.col("_raw") < -edge, "négatif")
        .otherwise("neutre").alias("sentiment_label"),
    )


def top_words(counts: DataFrame, top: int = P.TOP_WORDS) -> DataFrame:
    """The most frequent words per commune (alphabetical on ties)."""
    return top_per_key(
        counts.where(F.col("word") != ""), ["code_commune"], [F.col("n").desc(), F.col("word")], top
    )


def text_analysis(texts: DataFrame, top: int = P.TOP_WORDS, **lexicons) -> DataFrame:
    """The text mart: counts, sentiment and the top words as JSON."""
    counts = word_counts(texts)
    # At most ``top`` entries per commune reach the collection.
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), "word", "n")))
    best = top_words(counts, top).groupBy("code_commune").agg(
        F.to_json(
            F.map_from_entries(F.transform(ordered, lambda e: F.struct(e["word"], e["n"])))
        ).alias("top_words")
    )
    return (
        sentiment(counts, **lexicons)
        .join(best, "code_commune", "left")
        .withColumn("top_words", F.coalesce("top_words", F.lit("{}")))
    )
