"""Repeated hold-outs keep each vector once."""

import numpy as np
from pyspark.sql import functions as F

from corvane.operators import classifiers as c, cooccurrence as co, experiments as e
from corvane.plans import tables


def _rows(spark, n=90, seed=3):
    draw = np.random.default_rng(seed)
    at = [[float(x) for x in draw.normal(0, 1, 3)] for _ in range(n)]
    at[1], at[2], at[7] = at[0], at[0], at[5]  # exact copies
    return spark.createDataFrame([(i, v, i % 2) for i, v in enumerate(at)], "id int, v array<float>, y int")


def test_neighbours_of_all_runs_equal_a_search_run_by_run(spark):
    rows = _rows(spark)
    labels = F.array(*[F.when(F.col("id") % 5 != r, (F.col("id") + r) % 3) for r in range(3)])
    table = rows.withColumn("clusters", labels).localCheckpoint()
    for first in (5, 90):  # too few at first, and all rows at once
        got = {(r.run, r.id): r.predicted for r in c.knn_classify_runs(table, "id", "v", "clusters", 5, first).collect()}
        want = {}
        for r in range(3):
            one = table.withColumn("label", F.get("clusters", F.lit(r)))
            found = c.knn_classify(one.filter("label is not null"), one, "id", "v", "label", 5)
            want |= {(r + 1, x.id): x.predicted for x in found.collect()}
        assert len(got) == 270 and got == want


def test_fewer_training_rows_than_neighbours(spark):
    table = _rows(spark, 12).withColumn("clusters", F.array(F.when(F.col("id") < 3, F.col("id")), F.lit(1)))
    got = c.knn_classify_runs(table, "id", "v", "clusters", 5, 6).collect()
    assert len(got) == 24 and {r.predicted for r in got if r.run == 2} == {1}


def test_hold_outs_keep_a_row_once_with_the_splits_of_the_long_form(spark):
    rows = _rows(spark)
    long = e.repeated_holdout(rows, "id", "y", 4, 0.2, 1).filter("split = 'test'")
    want = {(r.run, r.id) for r in long.collect()}
    kept = e.holdout_runs(rows, "id", "y", 4, 0.2, 1).collect()
    assert len(kept) == 90 and {(t, r.id) for r in kept for t in r.tests} == want


def test_pairs_are_formed_in_tasks_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(co, "TASK_PAIRS", 10)
    rows = spark.createDataFrame([(g, (g + i) % 40) for g in range(60) for i in range(4)], "g int, i int")
    assert co._small_pairs(rows, 360).rdd.getNumPartitions() >= 36
    got = {(r.src, r.dst): r.weight for r in co.cooccurrence_edges(rows, "g", "i").collect()}
    want = {}
    for g in range(60):
        items = sorted((g + i) % 40 for i in range(4))
        for a in range(4):
            for b in range(a):
                want[(items[b], items[a])] = want.get((items[b], items[a]), 0) + 1
    assert got == want


def test_graphs_are_written_once(spark):
    folder = "/root/testdata/sf0.001"
    for graph in (tables.mention_graph, tables.part_graph):
        for table in graph(spark, folder):
            read = {p.split("/")[-2].split("-")[1] for p in table.inputFiles()}
            assert read and read <= {"nodes", "edges"}, graph.__name__
