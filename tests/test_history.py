"""Reject channel, published history, repeated deliveries, field-level survivors and cell changes."""

import os

import pytest
from pyspark.sql import functions as F

from baobab.operators import cleaning, quality
from baobab.sources import publication, rejects
from baobab.streaming import clean_drops, run_clean_customer_job

SCHEMA = "id bigint, jour date, montant decimal(10,2), note string"


def test_csv_rejects(spark, tmp_dir):
    lines = [
        "id,jour,montant,note", "1,2025-01-31,10.50,ok", "2,2025-02-30,1,bad day", "x,2025-01-01,y,two types", ",2025-01-01,1,no id",
        "3,2025-01-01", "4,2025-01-01,1,a,b", '5,2025-01-01,2,"quoted, comma"', "6,,,", "", "   ", "id,jour,montant,note",
        "9999999999999999999999,2025-01-01,1,too large", '7,2025-01-01,1,"open quote', "8,2025-01-01,12345678901.5,digits",
    ]
    path = os.path.join(tmp_dir, "csv")
    os.makedirs(path)
    for k, part in enumerate((lines[:7], lines[7:])):
        with open(os.path.join(path, f"{k}.csv"), "w") as f:
            f.write("\n".join(part))
    checked = rejects.check_csv(spark, path, SCHEMA, required=("id",))
    good = {r.id: r for r in rejects.accepted(checked, SCHEMA).collect()}
    bad = {r.ligne: r.motifs for r in rejects.rejected(checked).collect()}
    assert set(good) - {7} == {1, 5, 6} and good[5].note == "quoted, comma" and str(good[1].montant) == "10.50"
    assert (good[6].jour, good[6].montant, good[6].note) == (None, None, None)
    assert bad["2,2025-02-30,1,bad day"] == "type:jour" and bad["x,2025-01-01,y,two types"] == "type:id type:montant"
    assert bad[",2025-01-01,1,no id"] == "missing:id" and bad["3,2025-01-01"] == bad["4,2025-01-01,1,a,b"] == "fields"
    assert bad["9999999999999999999999,2025-01-01,1,too large"] == "type:id" and bad["8,2025-01-01,12345678901.5,digits"] == "type:montant"
    assert len(good) + len(bad) == 11  # every line is on one side: neither lost nor doubled
    report = {r.motif: r.n for r in rejects.reject_report(checked).collect()}
    assert report["ok"] == len(good) and report["type:id"] == 2 and report["fields"] >= 2
    # one scan feeds the report
    plan = rejects.reject_report(checked)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1


def test_json_rejects(spark, tmp_dir):
    path = os.path.join(tmp_dir, "json")
    os.makedirs(path)
    with open(os.path.join(path, "a.json"), "w") as f:
        f.write('{"id": 1, "jour": "2025-01-01", "note": "a"}\n{"id": "x"}\n{"id": 2, \nnothing\n{"note": "no id"}\n{"id": 3, "more": [1]}\n')
    checked = rejects.check_json(spark, path, SCHEMA, required=("id",))
    assert sorted(r.id for r in rejects.accepted(checked, SCHEMA).collect()) == [1, 3]
    assert sorted(r.motifs for r in rejects.rejected(checked).collect()) == ["json", "json", "missing:id", "type:id"]


def test_published_days_keep_their_state(spark, tmp_dir):
    path = os.path.join(tmp_dir, "report")
    report = lambda *rows: spark.createDataFrame(list(rows), "statut string, n long")
    publication.publish(report(("a", 1), ("b", 2)), path, "2025-01-01")
    publication.publish(report(("a", 5)), path, "2025-01-03")
    publication.publish(report(("a", 2), ("c", 1)), path, "2025-01-01")  # again: the other day stays
    state = lambda day: sorted(tuple(r) for r in publication.published(spark, path, day).drop("jour").collect())
    assert state("2025-01-02") == [("a", 2), ("c", 1)] and state("2025-01-03") == [("a", 5)] and state("2024-12-31") == []
    back = publication.read_back(spark, path, {"2025-01-01": report(("c", 1), ("a", 2)), "2025-01-03": report(("a", 4)), "2025-01-09": report()})
    found = {r.jour: (r.n_publiees, r.n_lues, r.identiques) for r in back.collect()}
    assert found == {"2025-01-01": (2, 2, True), "2025-01-03": (1, 1, False), "2025-01-09": (0, 0, False)}
    moved = {r.statut: (r.avant, r.apres, r.ecart) for r in publication.evolution(spark, path, "2025-01-05", ["statut"], "n").collect()}
    assert moved == {"a": (2, 5, 3), "c": (1, 0, -1)}
    assert {r.apres for r in publication.evolution(spark, path, "2025-01-01", ["statut"], "n").collect()} == {2, 1}


def test_failed_publication_changes_nothing(spark, tmp_dir):
    path = os.path.join(tmp_dir, "report")
    publication.publish(spark.range(3), path, "2025-01-01")
    broken = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        publication.publish(broken, path, "2025-01-01")
    assert publication.published(spark, path).count() == 3
    publication.publish(spark.range(0), path, "2025-01-02")
    assert publication.published(spark, path).count() == 3
    with pytest.raises(ValueError):
        publication.publish(spark.range(1).withColumn("jour", F.lit(1)), path, "2025-01-01")
    # as-of reads prune the other days
    plan = publication.published(spark, path, "2025-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(jour" in plan


def test_deliveries_are_neither_lost_nor_repeated(spark, tmp_dir):
    schema = "customer_id string, email string, ville string, telephone string, date_naissance string, ts timestamp"
    row = lambda i, day: (str(i), f" A{i}@B.com ", "thiès", "771234567", "1990-01-01", day)
    frame = lambda rows: spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string").toDF(
        "customer_id", "email", "ville", "telephone", "date_naissance", "ts"
    ).withColumn("ts", F.to_timestamp("ts"))
    days = ("2025-01-01", "2025-01-02", "2025-01-02")
    drops = [frame([row(i, days[k]) for i in range(k * 40, k * 40 + 80)] + [row(0, days[k])] * 30) for k in range(3)]
    out = clean_drops(spark, drops, tmp_dir, "ts", "10 days", as_of="2025-06-30")
    ids = sorted(int(r.customer_id) for r in out.collect())
    assert ids == list(range(160))
    # once more on the same state without a delivery: nothing is added
    job = run_clean_customer_job(
        spark, f"{tmp_dir}/deliveries", schema, f"{tmp_dir}/clean", "ts", "10 days",
        checkpoint_dir=f"{tmp_dir}/state", source_format="parquet", as_of="2025-06-30",
    )
    job.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_dir}/clean").count() == 160


def test_best_fields(spark):
    rows = [
        ("1", "bad", False, "Dakar", "2024-01-03"), ("1", "a@b.com", True, None, "2024-01-01"), ("1", "c@d.com", True, "Thies", "2024-01-02"),
        ("2", None, None, None, None), ("2", "x", False, None, "2024-01-01"), ("3", None, None, None, None),
        (None, "n@n.com", True, "Dakar", "2024-01-01"), (None, None, None, "Dakar", None),
        *[("hot", f"e{k % 9}", False, f"v{k}", f"2024-02-{k % 28 + 1:02d}") for k in range(500)],
    ]
    df = spark.createDataFrame(rows, "customer_id string, email string, ok boolean, ville string, day string").repartition(4)
    out = [tuple(r) for r in cleaning.best_fields(df, valid={"email": "ok"}, latest="day").collect()]
    assert sorted(r for r in out if r[0] and r[0] != "hot") == [
        ("1", "c@d.com", True, "Dakar", "2024-01-03"), ("2", "x", False, None, "2024-01-01"), ("3", None, None, None, None),
    ]
    assert sum(r[0] is None for r in out) == 2
    (hot,) = [r for r in out if r[0] == "hot"]
    last = max(k % 28 for k in range(500))
    assert hot[3] == max(f"v{k}" for k in range(500) if k % 28 == last) and hot[4] == f"2024-02-{last + 1}"


def test_cell_changes(spark):
    a = spark.createDataFrame([(1, "x", "p"), (2, None, "q"), (None, "n", "r"), (4, "gone", None)], "k int, u string, v string")
    b = spark.createDataFrame([(1, "y", "p"), (2, "new", None), (None, None, "r"), (5, "more", None)], "k int, u string, v string")
    got = {(r.colonne, r.nature): r.n for r in quality.cell_changes(a, b, "k", ["u", "v"]).collect()}
    assert got == {
        ("u", "modifiee"): 1, ("u", "remplie"): 1, ("u", "videe"): 1, ("u", "ligne_absente"): 1, ("u", "ligne_ajoutee"): 1,
        ("v", "identique"): 2, ("v", "videe"): 1, ("v", "ligne_absente"): 1, ("v", "ligne_ajoutee"): 1,
    }
