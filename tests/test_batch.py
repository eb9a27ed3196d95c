from pyspark.sql import functions as F

from parcelle.plans.batch import References, run_all


def test_whole_batch(spark, tmp_path):
    paths = {}
    for year, price in ((2021, 2000), (2022, 3000)):
        lines = ["Date mutation|Valeur fonciere|surface_bati|code_insee|Commune"]
        lines += [f"{year}-0{m}-01|{price * 50 + m + i}|50|{i}|c{i}" for i in range(110) for m in (1, 2, 3)]
        lines += [f"{year}-05-01|{190 * 50}|50|{i}|c{i}" for i in range(7)]  # below the mart's price bound
        paths[year] = str(tmp_path / f"{year}.csv")
        (tmp_path / f"{year}.csv").write_text("\n".join(lines))
    code = F.lpad(F.col("id").cast("string"), 5, "0")
    communes = spark.range(110).select(
        code.alias("code_commune"), F.concat(F.lit("c"), "id").alias("nom_commune"), F.lit("01").alias("code_departement"),
        F.lit("84").alias("code_region"), (F.col("id") / 100 + 45).alias("latitude"), (F.col("id") / 100 + 5).alias("longitude"),
        (F.col("id") * 10 + 100).cast("int").alias("population"), code.alias("codes_postaux"),
    )
    references = References(
        communes, spark.createDataFrame([("01", "Ain", "84")], "code_departement string, nom_departement string, code_region string"),
        spark.createDataFrame([("84", "Rhône")], "code_region string, nom_region string"),
        incomes=communes.select("code_commune", F.col("population").cast("double").alias("median_income_raw")),
        texts=communes.select("code_commune", F.lit("Appartement calme").alias("text")),
    )
    root = str(tmp_path / "lake")
    counts = run_all(spark, paths, root, references, trees=3, depth=3)
    assert counts["gold_territory_scores"] == 110 and counts["price_predictions"] == 110 and counts["star/real_estate_transactions"] == 337
    assert counts["marts/mart_commune_real_estate"] == 220 and counts["marts/nlp_sentiment"] == 110 and counts["price_sketches"] == 110
    steps = {(r.dataset, r.year): r.row_counts for r in spark.read.parquet(f"{root}/lineage").collect()}
    assert steps[("gold", 2022)] == {"silver": 337, "removed": 7, "gold": 110}
    assert steps[("pipeline", 2022)]["gold_territory_scores"] == 110
    scores = spark.read.parquet(f"{root}/gold_territory_scores")
    assert scores.where("income_score is not null and annual_price_growth > 0.4").count() == 110
    again = run_all(spark, paths, root, references, trees=3, depth=3)
    assert again == counts
