import gzip
import json

import pytest
from pyspark.sql import functions as F

from parcelle.plans.batch import run_batch
from parcelle.plans.star import load_star, write_star
from parcelle.sources import files, tables


def test_flexible_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("Commune;Prix\nÉvry;1\nlong;2;3\nshort\n".encode("utf-8"))
    (tmp_path / "b.csv").write_bytes("Commune,Prix\nÉvry,1\n".encode("latin-1"))
    with gzip.open(tmp_path / "c.csv.gz", "wt", encoding="utf-8") as out:
        out.write('"Commune"\t"Prix"\n"É\tvry"\t"1"\n')
    got = [tuple(r)[:2] for r in files.read_csv_flexible(spark, str(tmp_path / "a.csv")).collect()]
    assert got == [("Évry", "1"), ("short", None)]
    assert files.read_csv_flexible(spark, str(tmp_path / "b.csv")).first()[0] == "Évry"
    assert files.read_csv_flexible(spark, str(tmp_path / "c.csv.gz")).first()[0] == "É\tvry"
    assert files.read_csv_strings(spark, str(tmp_path / "a.csv"), case="upper").columns == ["COMMUNE", "PRIX"]


def test_reference_json(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps([
        {"code": "1", "nom": "A", "codeDepartement": "01", "codeRegion": "1", "centre": {"coordinates": [5.0, 45.0]}, "population": 3, "codesPostaux": ["a", "b"]},
        {"code": "2", "nom": "B"},
    ]))
    rows = {r.code_commune: r for r in files.read_communes(spark, str(path)).collect()}
    assert (rows["1"].longitude, rows["1"].latitude, rows["1"].codes_postaux) == (5.0, 45.0, "a,b")
    assert rows["2"].latitude is None and rows["2"].codes_postaux == ""


def test_partitions_tables_and_history(spark, tmp_path):
    root = str(tmp_path)
    gold = spark.createDataFrame([("1", 2020), ("2", 2021)], "code_commune string, annee int")
    tables.write_partitioned(gold, f"{root}/gold_real_estate", ["annee"])
    tables.write_partitioned(gold.where("annee = 2021").withColumn("code_commune", F.lit("9")), f"{root}/gold_real_estate", ["annee"])
    tables.register_tables(spark, root, ["gold_real_estate"])
    assert sorted(tuple(r) for r in spark.table("gold_real_estate").select("code_commune", "annee").collect()) == [("1", 2020), ("9", 2021)]
    history = files.load_history(spark, f"{root}/gold_real_estate", ["code_commune"])
    assert sorted(tuple(r) for r in history.collect()) == [("1", 2020), ("9", 2021)]
    tables.lineage(spark, f"{root}/lineage", "s", "d", None, "t", {"rows": 3})
    assert spark.read.parquet(f"{root}/lineage").first().row_counts == {"rows": 3}


def test_batch_year_by_year(spark, tmp_path):
    for year, price in ((2021, 2000), (2022, 3000)):
        lines = ["Date mutation|Valeur fonciere|surface_bati|code_insee|Commune"]
        lines += [f"{year}-0{m}-01|{price * 50 + m}|50|{i}|c{i}" for i in range(110) for m in (1, 2, 3)]
        (tmp_path / f"{year}.csv").write_text("\n".join(lines))
    root = str(tmp_path / "lake")
    run_batch(spark, str(tmp_path / "2021.csv"), root, 2021)
    gold = run_batch(spark, str(tmp_path / "2022.csv"), root, 2022)
    assert gold.count() == 110 and abs(gold.first().price_m2_yoy_variation - 0.5) < 1e-4
    (tmp_path / "e.csv").write_text("a|b\n")
    with pytest.raises(ValueError):
        run_batch(spark, str(tmp_path / "e.csv"), root, 2023)


def test_star(spark, tmp_path):
    regions = spark.createDataFrame([("1", "R")], "code_region string, nom_region string")
    departments = spark.createDataFrame([("01", "D", "1"), ("02", "E", "9")], "code_departement string, nom_departement string, code_region string")
    communes = spark.createDataFrame([("1", "A", "01", 45.0, 5.0, 9, "a,b")], "code_commune string, nom_commune string, code_departement string, latitude double, longitude double, population int, codes_postaux string")
    sales = spark.sql("SELECT timestamp'2021-01-01' date_mutation, 10.005D valeur_fonciere, 1D surface_reelle_bati, 1 nombre_pieces, 'x' type_local, code_commune, 10D prix_m2, 'DVF' source FROM VALUES ('1'), ('8') t(code_commune)")
    scores = spark.createDataFrame([("1", 1.0, 2.0, 3.0, 4.0, 5.0)], "code_commune string, affordability_score double, network_score double, transport_score double, income_score double, score_famille double")
    write_star(load_star(regions, departments, communes, sales, scores, 2021), str(tmp_path))
    facts = spark.read.parquet(f"{tmp_path}/real_estate_transactions")
    assert facts.count() == 1 and str(facts.first().valeur_fonciere) == "10.01"
    assert {r.code_departement: r.code_region for r in spark.read.parquet(f"{tmp_path}/departements").collect()} == {"01": "1", "02": None}
    assert spark.read.parquet(f"{tmp_path}/territorial_scores").first().global_score == 5.0


def test_csv_by_name_and_with_quoted_breaks(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "a.csv").write_text("Prix;Commune\n1;Évry\n2;Lyon\n", encoding="utf-8")
    (folder / "b.csv").write_bytes("Commune,Prix,Note\nÉvry,3,x\n\nLyon,4,\"y,z\"\n".encode("latin-1"))
    with gzip.open(folder / "c.csv.gz", "wt", encoding="utf-8") as out:
        out.write('"Com""mune;\nune"\t"Prix"\n"deux\nlignes ""et"" É"\t5\n\nseul\t6\nlong\t7\t8\n')
    (folder / "d.csv").write_text('Commune,Prix\n5" tube,7\nfin,8\n')  # a stray quote
    rows = files.read_csv_flexible(spark, str(folder)).collect()
    assert list(rows[0].asDict()) == ["Prix", "Commune", "Note", 'Com"mune;\nune', "source_file"]
    assert sorted(tuple(str(x) for x in r[:4]) for r in rows if not r.source_file.endswith("d.csv")) == sorted([
        ("1", "Évry", "None", "None"), ("2", "Lyon", "None", "None"), ("3", "Évry", "x", "None"), ("4", "Lyon", "y,z", "None"),
        ("5", "None", "None", 'deux\nlignes "et" É'), ("6", "None", "None", "seul"),
    ])
    assert [r.Prix for r in rows if r.source_file.endswith("d.csv")][-1] == "8"


def test_records_across_splits(spark, tmp_path):
    """The same records whatever the size of the splits."""
    lines = ["id,text"]
    want = {}
    for k in range(400):
        text = "\n".join(f'{k} "line" {j}' for j in range(k % 5 + 1))
        want[str(k)] = text
        quoted = text.replace('"', '""')
        lines.append(f'{k},"{quoted}"')
    (tmp_path / "x.csv").write_text("\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("700b", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = files.read_csv_flexible(spark, str(tmp_path / "x.csv")).collect()
            assert {r.id: r.text for r in got} == want and len(got) == 400
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_headers_need_no_sorted_lines(spark, tmp_path):
    """Headers are found by numbers in hash aggregates; lines are not sorted by file in their task."""
    from parcelle.sources import records

    for i in range(3):
        (tmp_path / f"{i}.csv").write_text(f"a{i};b\n" + "1;2\n" * 50 + ('"x\ny";3\n' if i == 1 else ""))
    found = records.heads(records.raw_lines(spark, [str(tmp_path)]))
    assert sorted((r.head, r.broken) for r in found.collect()) == [("a0;b", False), ("a1;b", True), ("a2;b", False)]
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
