import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from corvane.functions import person
from corvane.operators import release as r


def people(spark, rows):
    return spark.createDataFrame(rows, "id int, a int, b string, s string")


ROWS = (
    [(1, 1, "x", "p")]
    + [(2, 2, "x", "p"), (3, 2, "x", "q")]
    + [(4, 3, None, "p"), (5, 3, None, "p"), (6, 3, None, "q")]
)


def ids(df):
    return sorted(x.id for x in df.collect())


def test_small_classes_go_and_nulls_form_a_class(spark):
    assert ids(r.k_anonymous(people(spark, ROWS), ["a", "b"], 2)) == [2, 3, 4, 5, 6]
    assert ids(r.k_anonymous(people(spark, ROWS), ["a", "b"], 3)) == [4, 5, 6]


def test_l_diversity(spark):
    rows = [(1, 1, "x", "p"), (2, 1, "x", "p"), (3, 2, "x", "p"), (4, 2, "x", "q")]
    assert ids(r.l_diverse(people(spark, rows), ["a", "b"], "s", 2)) == [3, 4]


def test_divergence_of_a_pure_class_is_ln_2(spark):
    rows = [(1, 1, "x", "p"), (2, 2, "x", "q")]
    stats = r.class_stats(people(spark, rows), ["a"], "s").collect()
    assert [x.kl for x in stats] == pytest.approx([math.log(2)] * 2)


def test_value_outside_the_baseline_is_infinitely_far(spark):
    baseline = spark.createDataFrame([("p", 1.0)], "s string, share double")
    stats = {x.a: x.kl for x in r.class_stats(people(spark, ROWS), ["a"], "s", baseline).collect()}
    assert stats[1] == pytest.approx(0) and stats[2] == math.inf
    assert ids(r.t_close(people(spark, ROWS), ["a"], "s", 0.5, baseline)) == [1]


def test_presence_weighting_ignores_counts(spark):
    rows = [(i, 1, "x", "p") for i in range(9)] + [(9, 1, "x", "q")]
    baseline = spark.createDataFrame([("p", 0.5), ("q", 0.5)], "s string, share double")
    assert r.class_stats(people(spark, rows), ["a"], "s", baseline, "presence").first().kl == pytest.approx(0)
    assert r.class_stats(people(spark, rows), ["a"], "s", baseline).first().kl > 0.3


def test_release_passes_its_own_tests(spark):
    draw = random.Random(2)
    rows = [(i, int(draw.expovariate(0.3)), draw.choice("xxy"), draw.choice("ppppqqrst")) for i in range(300)]
    df, qi = people(spark, rows), ["a", "b"]
    base = r.distribution(df, "s")
    kept = r.release(df, qi, "s", 14, 3, 0.2, base)
    again = r.class_stats(kept, qi, "s", base)
    assert 0 < kept.count() < 300
    assert again.filter((F.col("n") < 14) | (F.col("n_distinct") < 3) | (F.col("kl") > 0.2)).count() == 0
    step = r.t_close(r.l_diverse(r.k_anonymous(df, qi, 14), qi, "s", 3), qi, "s", 0.2, base)
    assert ids(step) == ids(kept)


def test_entropy_of_two_equal_classes(spark):
    df = people(spark, [(1, 1, "x", "p"), (2, 2, "x", "p")])
    assert r.entropy(df, ["a"]).first().entropy == pytest.approx(math.log(2))
    loss = r.entropy_loss(df, df.filter("a = 1"), ["a"]).first()
    assert loss.loss == pytest.approx(math.log(2))


def test_grid_agrees_with_filtering(spark):
    df = people(spark, [(i, i % 5, "x", "pqr"[i % 3]) for i in range(0, 60, 2)] + [(99, 77, "z", "p")])
    grid = {(x.k, x.l): x.rows_left for x in r.privacy_grid(df, ["a", "b"], "s", 8, 4).collect()}
    assert len(grid) == 32
    for k in (1, 2, 6, 8):
        for l in (1, 3, 4):
            assert grid[k, l] == r.l_diverse(r.k_anonymous(df, ["a", "b"], k), ["a", "b"], "s", l).count()


def test_extremes(spark):
    stats = r.class_stats(people(spark, ROWS), ["a"], "s")
    ends = {x.side: x.a for x in r.kl_extremes(stats, ["a"]).collect()}
    assert ends == {"near": 3, "far": 1}


def test_codes_follow_the_sorted_values(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c"), (4, "b")], "id int, v string")
    assert {x.id: x.v for x in r.label_encode(df, ["v"]).collect()} == {1: 1, 2: 0, 3: 2, 4: 1}


def test_row_level_steps(spark):
    df = spark.createDataFrame([("Ann Lee", -7.0, "01/1983/x", "skin cancer", 3)], "n string, x double, d string, s string, e int")
    row = df.select(
        person.pseudonym(F.col("n"), "a", "z").alias("p"),
        person.floor_bucket(F.col("x"), 2).alias("b"),
        person.floor_bucket(person.date_part(F.col("d")), 25).alias("y"),
        person.merge_on_token(F.col("s"), "cancer").alias("m"),
        person.override_unless(F.col("e") == 2, F.lit(1), 5).alias("o"),
        person.recode_binary(F.lit("M"), "M").alias("r"),
    ).first()
    assert row.p == hashlib.sha1(b"aAnnLeez").hexdigest()
    assert (row.b, row.y, row.m, row.o, row.r) == (-8, 1975, "cancer", 5, 0)
