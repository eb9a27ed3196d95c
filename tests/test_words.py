import json

from parcelle.operators import words


def test_sentiment_and_top_words(spark):
    rows = [("1", "Appartement lumineux et calme, très calme"), ("1", ""), ("1", None), ("2", "bruit bruit travaux calme"),
            ("3", "lumineux " * 23 + "bruit " * 17)]
    texts = spark.createDataFrame(rows, "code_commune string, text string")
    got = {r.code_commune: r for r in words.text_analysis(texts, top=2).collect()}
    assert (got["1"].n_texts, got["1"].n_tokens, got["1"].sentiment_score, got["1"].sentiment_label) == (3, 3, 1.0, "positif")
    assert json.loads(got["1"].top_words) == {"calme": 2, "lumineux": 1}
    assert got["2"].sentiment_score == -0.5 and got["2"].sentiment_label == "négatif"
    assert got["3"].sentiment_score == 0.15 and got["3"].sentiment_label == "neutre"  # exactly the threshold


def test_listing_texts_use_the_latest_snapshot(spark):
    listings = spark.createDataFrame(
        [("s", "1", "1", "old", None, "c"), ("s", "1", "2", "new", "text", "c"), ("s", "", "1", "free", None, "c")],
        "source string, listing_id string, scraped_at string, title string, description string, commune_code string",
    )
    reviews = spark.createDataFrame([("c", "avis")], "code_commune string, text string")
    assert sorted(r.text for r in words.listing_texts(listings, reviews).collect()) == ["avis", "free", "new text"]
    assert words.listing_texts(listings, latest_only=False).count() == 3
