import random

import pytest
from pyspark.sql import functions as F

from corvane.operators import classifiers, experiments, release as r
from corvane.plans import jobs
from corvane.sources import files, novel

BOOK = """Prince Vasili Kuragin met Hélène.
Pierre came late, and Count Ilya Rostov left.

Natasha and Pierre danced. Count Rostov watched Natasha.

Denisov was alone."""


def test_names_of_the_novel(spark):
    names = novel.dictionary(spark)
    assert names.count() == 50 and names.select("entity").distinct().count() == 49


def test_book_to_graph_to_influence(spark, tmp_path):
    path = tmp_path / "book.txt"
    path.write_text(BOOK, encoding="utf-8")
    nodes, edges = jobs.book_graph(spark, str(path), novel.dictionary(spark))
    assert {x.id for x in nodes.collect()} == {
        "vasili kuragin", "helene", "pierre", "count rostov", "natasha", "denisov",
    }
    weights = {(x.src, x.dst): x.weight for x in edges.collect()}
    # the last paragraph counts although no empty line follows, and both names of the count are one
    assert weights["count rostov", "pierre"] == 2 and weights["helene", "vasili kuragin"] == 1
    assert len(weights) == 8
    curve, sizes = jobs.influence_report(nodes, edges, 0.05, 1.0, 2, 50)
    assert {x.strategy for x in sizes.collect()} == {"random", "degree", "greedy"}
    assert curve.agg(F.max("mean_infected")).first()[0] >= 5
    agreement = jobs.book_embedding(spark, str(path), novel.dictionary(spark), size=4, window=2, epochs=1).first()
    assert agreement.n11 + agreement.n10 + agreement.n01 > 0


def people(spark, n=400):
    draw = random.Random(4)
    pick = draw.choice
    rows = [
        (
            f"Name {i}", f"{pick([1, 5])}/{pick([1960, 1970, 1980])}/3", str(pick([1000, 2500, 2600])), pick("fm"), pick("abc"),
            pick(["x", "y", "z"]), pick("ms"), pick("pq"), pick("hl"), pick([0, 1]), 1, pick([10.0, 20.0]),
            pick(["flu", "skin cancer", "bone cancer", "cold", "gout", "measles"]),
        )
        for i in range(n)
    ]
    return spark.createDataFrame(rows, jobs.PERSONS)


def test_release_of_a_csv_by_birth_and_place(spark, tmp_path):
    files.write_csv(people(spark), str(tmp_path / "in"))
    persons = files.read_csv(spark, str(tmp_path / "in"), jobs.PERSONS)
    kept, loss = jobs.release_by_birth_and_place(persons, ("a", "b"))
    files.write_csv(kept, str(tmp_path / "out"))
    back = files.read_csv(spark, str(tmp_path / "out"), kept.schema)
    assert back.columns == ["id", "dob", "zipcode", "disease"] and 0 < back.count() <= 400
    assert {x.dob for x in back.select("dob").collect()} <= {1950, 1975}
    assert r.class_sizes(back, ["dob", "zipcode"]).first().n >= 10
    assert loss.first().loss > 0


def test_release_by_household(spark):
    kept, _ = jobs.release_by_household(people(spark), ("a", "b"), t_max=0.4)
    assert 0 < kept.count() <= 400
    assert "cancer" in {x.disease for x in kept.select("disease").distinct().collect()}
    assert {x.education for x in kept.filter("employment <> 2").select("education").collect()} == {5}


def test_comments_to_model_scores(spark, tmp_path):
    paths = {}
    words = {0: "cats dogs horses pets running", 1: "votes taxes senate laws election"}
    draw = random.Random(1)
    for split, n in (("train", 30), ("test", 10)):
        for label in (0, 1):
            rows = [(i, " ".join(draw.choices(words[label].split(), k=12)) + " The!") for i in range(n)]
            paths[split, label] = str(tmp_path / f"{split}{label}")
            files.write_csv(spark.createDataFrame(rows, jobs.COMMENTS), paths[split, label])
    comments = jobs.read_comments(spark, paths)
    assert comments.count() == 80 and comments.select("key").distinct().count() == 80
    got = jobs.classify_comments(comments, ["the"], {"logistic": classifiers.logistic(maxIter=30)}, size=8, epochs=5, k=3)
    scores = {(x.model, x.split): x.accuracy for x in got.collect()}
    assert set(scores) == {(m, s) for m in ("logistic", "neighbours") for s in ("train", "test")}
    assert scores["neighbours", "train"] == 1.0 and scores["neighbours", "test"] > 0.8


def test_measurements_to_experiment(spark, tmp_path):
    draw = random.Random(2)
    lines = ["id,diagnosis,a,b,Unnamed: 32"]
    lines += [f"{i},{'M' if i % 2 else 'B'},{draw.gauss(9 * (i % 2), 1):.3f},{draw.gauss(0, 1):.3f}," for i in range(40)]
    path = tmp_path / "data.csv"
    path.write_text("\n".join(lines))
    table = jobs.read_measurements(spark, str(path), ["a", "b"])
    assert table.count() == 40 and table.filter("truth = 0").count() == 20
    got = experiments.majority_experiment(table, "id", "v", "truth", runs=1, votes=5, restarts=1).collect()
    assert {(x.split, x.metric): x.value for x in got}["test", "accuracy"] == pytest.approx(1.0)
