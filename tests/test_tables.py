import math
import random

import pytest
from pyspark.sql import functions as F

from corvane.operators import features as f, scores as s
from corvane.operators.ranking import hash_rank, running_totals


def test_running_totals_over_ranges(spark):
    draw = random.Random(1)
    rows = [(i, draw.randrange(100), 1) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, v int, one long")
    got = {r.id: (r.v_total, r.one_total) for r in running_totals(df, [F.col("v").desc(), F.col("id")], ["v", "one"]).collect()}
    total = 0
    for n, (i, v, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), 1):
        total += v
        assert got[i] == (total, n)


def test_hash_rank_is_a_permutation_per_class_and_repeatable(spark):
    df = spark.range(1000).withColumn("c", F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.col("id") % 2))
    ranked = hash_rank(df, ["id"], 3, by=["c"], slices=16)
    for c, rows in _by(ranked, "c").items():
        assert sorted(r["rank"] for r in rows) == list(range(1, len(rows) + 1)), c
    again = {r.id: r["rank"] for r in hash_rank(df.repartition(7), ["id"], 3, by=["c"], slices=64).collect()}
    assert again == {r.id: r["rank"] for r in ranked.collect()}


def _by(df, column):
    out = {}
    for r in df.collect():
        out.setdefault(r[column], []).append(r)
    return out


def labelled(spark, zeros=7, ones=20):
    return spark.createDataFrame([(i, int(i >= zeros)) for i in range(zeros + ones)], "id int, y int")


def test_holdout_takes_a_share_of_every_class(spark):
    marked = _by(f.stratified_holdout(labelled(spark), ["id"], "y", 0.2, 1), "split")
    assert sorted(r.y for r in marked["test"]) == [0, 1, 1, 1, 1]
    assert len(marked["train"]) == 22


def test_both_ways_to_sample_take_the_same_rows(spark):
    df = spark.range(300)
    few = {r.id for r in f.sample_rows(df, ["id"], 40, 9).collect()}
    assert few == {r.id for r in f.sample_rows(df, ["id"], 40, 9, few=0).collect()} and len(few) == 40


def test_folds_partition_the_rows(spark):
    folds = _by(f.assign_folds(labelled(spark), ["id"], 10, 1), "fold")
    assert sorted(len(r) for r in folds.values()) == [2] * 3 + [3] * 7


def test_oversampling_balances_and_is_clamped(spark):
    got = _by(f.oversample(labelled(spark, 7, 10), ["id"], "y", 0, 1, 1), "y")
    assert len(got[0]) == 10 and len(got[1]) == 10
    assert len({(r.id, r.copy) for r in got[0]}) == 10
    clamped = _by(f.oversample(labelled(spark, 3, 10), ["id"], "y", 0, 1, 1), "y")
    assert len(clamped[0]) == 6


def test_oversampling_by_run(spark):
    df = labelled(spark, 2, 3).withColumn("run", F.explode(F.array(F.lit(1), F.lit(2))))
    got = _by(f.oversample(df, ["id"], "y", 0, 1, 1, by=["run"]), "run")
    assert {k: len(v) for k, v in got.items()} == {1: 6, 2: 6}


def test_scaling_uses_the_training_range(spark):
    df = spark.createDataFrame([(0.0, 5.0, True), (10.0, 5.0, True), (20.0, 5.0, False)], "x double, c double, train boolean")
    got = f.scaled_columns(df, ["x", "c"], F.col("train")).orderBy("x").collect()
    assert [(r.x, r.c) for r in got] == [(0.0, 0.0), (1.0, 0.0), (2.0, 0.0)]
    wide = f.assemble(df, f.feature_columns(df, "train"))
    model = f.fit_minmax(wide.filter("train"))
    held = f.clipped(model.transform(wide), "scaled").orderBy("x").collect()
    assert [list(r.scaled)[0] for r in held] == [0.0, 1.0, 1.0]


def test_union_and_split_again(spark):
    train, test = labelled(spark, 2, 2), labelled(spark, 1, 1)
    both = f.union_splits(train, test)
    assert f.only_split(both, "train").count() == 4 and f.only_split(both, "test").count() == 2


def pair(spark, a, b):
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(zip(a, b))], "id int, a int, b int")


def test_jaccard_of_the_worked_example(spark):
    df = pair(spark, [1, 2, 2, 3], [3, 4, 4, 4])
    got = s.pair_jaccard(s.contingency(df, "a", "b")).first()
    assert (got.n11, got.n10, got.n01) == (1, 0, 2) and got.jaccard == pytest.approx(1 / 3)


def test_adjusted_rand(spark):
    df = pair(spark, [0, 0, 1, 1, 2], [5, 5, 9, 9, 7])
    assert s.adjusted_rand(s.contingency(df, "a", "b")).first().ari == 1.0
    df = pair(spark, [0, 0, 0, 1, 1, 1], [0, 0, 1, 1, 2, 2])
    assert s.adjusted_rand(s.contingency(df, "a", "b")).first().ari == pytest.approx(0.2424242)
    matrix = {(r.left, r.right): r.ari for r in s.rand_matrix(df, ["a", "b"]).collect()}
    assert matrix["a", "b"] == matrix["b", "a"] == pytest.approx(0.2424242) and matrix["a", "a"] == 1.0


def test_confusion_and_flip(spark):
    df = pair(spark, [0, 0, 1, 1], [1, 1, 0, 0])
    assert s.classification_metrics(df, "a", "b").first().accuracy == 0.0
    assert s.classification_metrics(df, "a", "b", flip=True).first().accuracy == 1.0
    empty = s.classification_metrics(pair(spark, [0, 0], [0, 0]), "a", "b").first()
    assert (empty.accuracy, empty.precision, empty.recall, empty.bcr) == (1.0, 0.0, 0.0, 0.5)


def test_area_under_the_curve(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.8, 1), (0.4, 1), (0.1, 0)], "score double, y int")
    points = s.roc_points(df, "y", "score")
    # of the six (positive, negative) pairs 4 are ordered right and one is tied
    assert s.auc(points).first().auc == pytest.approx(4.5 / 6)
    curve = [(r.fpr, r.tpr) for r in points.orderBy(F.col("threshold").desc()).collect()]
    assert curve[0] == (0.0, pytest.approx(1 / 3)) and curve[-1] == (1.0, 1.0)


def test_keys_must_match(spark):
    a, b = spark.range(5), spark.range(3, 6)
    assert tuple(s.unmatched_keys(a, b, "id").first()) == (3, 1)
    with pytest.raises(ValueError):
        s.require_same_keys(a, b, "id")
    s.require_same_keys(a, a, "id")


def test_majority_ties_go_to_the_smaller_label(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (2, 1), (2, 0)], "c int, y int")
    got = {r.c: (r.majority, r.votes) for r in s.majority_label(df, ["c"], "y").collect()}
    assert got == {1: (0, 1), 2: (1, 2)}


def test_means_over_folds(spark):
    df = pair(spark, [0, 1, 0, 1], [0, 1, 1, 1]).withColumn("fold", F.col("id") % 2)
    wide = s.classification_metrics(df, "a", "b", ["fold"])
    means = {r.metric: r.value for r in s.mean_scores(s.long_scores(wide, ["fold"]), []).collect()}
    assert means["accuracy"] == 0.75 and math.isclose(means["recall"], 0.5)
