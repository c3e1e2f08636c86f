"""Answers that must not depend on sizes, column orders, nulls or repeats."""

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from corvane.operators import clusters, cooccurrence, features, mentions, neighbours, vectors
from corvane.sources import files


@pytest.mark.parametrize("inline_limit", [1, 500])
def test_repeated_lines_count_each_time(spark, inline_limit):
    lines = spark.createDataFrame(
        [(1, "anna met boris"), (1, "anna again"), (2, "boris"), (2, "boris"), (3, None), (4, "")], "k int, line string"
    )
    names = spark.createDataFrame([("anna", "anna"), ("boris", "boris"), ("bo", "boris")], "alias string, entity string")
    found = mentions.match_entities(lines, "line", names, inline_limit=inline_limit)
    assert {(r.entity, r.n_lines) for r in mentions.mention_counts(found).collect()} == {("anna", 2), ("boris", 3)}
    assert found.columns == ["k", "entity"]


def test_the_larger_class_is_not_repeated(spark):
    df = spark.range(40).select("id", (F.col("id") >= 30).cast("int").alias("c"))
    counts = lambda x: {r.c: r["count"] for r in x.groupBy("c").count().collect()}
    assert counts(features.oversample(df, ["id"], "c", 0, 1, 1)) == {0: 30, 1: 10}
    assert counts(features.oversample(df, ["id"], "c", 1, 0, 1)) == {0: 30, 1: 20}


@pytest.mark.parametrize("light", [2, 256])
def test_no_group_links_nothing(spark, light):
    rows = [(None, 1), (None, 2), (None, 3), (7, 1), (7, 3), (7, 4), (8, None), (8, 1)]
    df = spark.createDataFrame(rows, "g int, i int")
    edges = cooccurrence.cooccurrence_edges(df, "g", "i", light=light)
    assert {tuple(r) for r in edges.collect()} == {(1, 3, 1), (1, 4, 1), (3, 4, 1)}


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "p.csv").write_text("id,zipcode,dob\n1,1234,1/1990\n")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "dob", "zipcode")])
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "p.csv"), schema).collect()] == [("1", "1/1990", "1234")]
    with pytest.raises(ValueError, match="gender"):
        files.read_csv(spark, str(tmp_path / "p.csv"), schema.add("gender", T.StringType()))


def test_values_that_do_not_fit_fail(spark, tmp_path):
    (tmp_path / "p.csv").write_text("id,body\nx,text\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("body", T.StringType())])
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv(spark, str(tmp_path / "p.csv"), schema).collect()


def test_line_breaks_and_blanks_survive(spark, tmp_path):
    rows = [(1, 'one\ntwo "quoted", three'), (2, "  blanks "), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "id long, body string")
    files.write_csv(df, str(tmp_path / "out"))
    back = files.read_csv(spark, str(tmp_path / "out"), df.schema, multi_line=True)
    assert sorted(tuple(r) for r in back.collect()) == [*rows[:3], (4, None)]


def test_groups_of_neighbours_can_be_texts(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "ab"[i % 2] if i < 40 else None, rng.normal(size=3).tolist()) for i in range(42)]
    df = spark.createDataFrame(rows, "id int, run string, v array<double>")
    found = neighbours.nearest_neighbours(df, df, 3, "id", "id", "v", by="run", pivots=2, block=7)
    points = {i: np.array(v) for i, _, v in rows}
    groups = {i: g for i, g, _ in rows}
    want = set()
    for i in range(40):
        near = sorted((float(np.linalg.norm(points[i] - points[j])), j) for j in points if groups[j] == groups[i])
        want |= {(groups[i], i, j, r + 1) for r, (_, j) in enumerate(near[:3])}
    assert {(r.run, r["query"], r.point, r["rank"]) for r in found.collect()} == want


def test_rows_without_a_vector_stay(spark):
    df = spark.createDataFrame([(1,), (2,)], "id long")
    known = spark.createDataFrame([(1, [1.0])], "vec long, v array<double>")
    assert {(r.id, r.v and tuple(r.v)) for r in vectors.attach_vectors(df, "id", known, "vec").collect()} == {(1, (1.0,)), (2, None)}


@pytest.mark.parametrize("threshold", [0.0, 0.7, 100.0])
def test_no_cell_is_wider_than_the_threshold(spark, threshold):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=2).round(1).tolist()) for i in range(60)] + [(60 + i, [1.0, 1.0]) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    cells = clusters.narrow_cells(clusters.with_features(df, "v").select("id", "features"), "id", threshold)
    placed = {r.id: r.cell for r in cells.collect()}
    assert sorted(placed) == list(range(80))
    for cell in set(placed.values()):
        inside = np.array([v for i, v in rows if placed[i] == cell])
        assert np.sqrt(((inside - inside.mean(axis=0)) ** 2).sum(axis=1).mean()) <= threshold + 1e-9
