"""Splits, sampling and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions.keyed_random import uniform_sql
from corvane.operators import features, scores
from corvane.plans.registry import query
from corvane.plans.tables import labelled_documents, table

SEED = 23
_D = "d AS (SELECT d.doc_id, d.n_chars, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"
_U = uniform_sql(SEED, "doc_id")


def rows(spark, folder):
    return labelled_documents(spark, folder).select("doc_id", "n_chars", "quality", "toxic")


@query("shuffle_rows", f"WITH {_D} SELECT doc_id, row_number() OVER (ORDER BY {_U}, doc_id) AS position FROM d")
def shuffle_rows(spark, folder):
    return features.shuffled(rows(spark, folder).select("doc_id"), ["doc_id"], SEED).orderBy("position")


@query("sample_rows", f"WITH {_D} SELECT doc_id, quality FROM d ORDER BY {_U}, doc_id LIMIT 40")
def sample_rows(spark, folder):
    return features.sample_rows(rows(spark, folder).select("doc_id", "quality"), ["doc_id"], 40, SEED)


_RANKED = f"""r AS (SELECT *, row_number() OVER (PARTITION BY toxic ORDER BY {_U}, doc_id) AS rk,
                           count(*) OVER (PARTITION BY toxic) AS cn FROM d)"""


@query(
    "stratified_holdout",
    f"""WITH {_D}, {_RANKED}
        SELECT doc_id, toxic, CASE WHEN rk <= round_even(cn * 0.2, 0) THEN 'test' ELSE 'train' END AS split FROM r""",
)
def stratified_holdout(spark, folder):
    return features.stratified_holdout(rows(spark, folder).select("doc_id", "toxic"), ["doc_id"], "toxic", 0.2, SEED)


@query(
    "stratified_halves",
    f"""WITH {_D}, {_RANKED}
        SELECT doc_id, toxic, CASE WHEN rk <= ceil(cn * 0.5) THEN 'test' ELSE 'train' END AS split FROM r""",
)
def stratified_halves(spark, folder):
    return features.stratified_holdout(
        rows(spark, folder).select("doc_id", "toxic"), ["doc_id"], "toxic", 0.5, SEED, rounding="up"
    )


@query(
    "holdout_complement",
    f"WITH {_D}, {_RANKED} SELECT doc_id, n_chars FROM r WHERE rk > round_even(cn * 0.2, 0)",
)
def holdout_complement(spark, folder):
    """All rows but the hold-out, by key."""
    base = rows(spark, folder)
    test = features.stratified_holdout(base.select("doc_id", "toxic"), ["doc_id"], "toxic", 0.2, SEED).filter("split = 'test'")
    return base.join(test, "doc_id", "left_anti").select("doc_id", "n_chars")


@query(
    "kfold_assign",
    f"""WITH {_D} SELECT doc_id, CAST((row_number() OVER (ORDER BY {_U}, doc_id) - 1) % 10 AS INTEGER) AS fold FROM d""",
)
def kfold_assign(spark, folder):
    return features.assign_folds(rows(spark, folder).select("doc_id"), ["doc_id"], 10, SEED)


@query(
    "oversample",
    f"""WITH {_D}, n AS (SELECT count(*) FILTER (WHERE toxic = 1) AS n0, count(*) FILTER (WHERE toxic = 0) AS n1 FROM d),
             r AS (SELECT doc_id, toxic, row_number() OVER (ORDER BY {_U}, doc_id) AS rk FROM d WHERE toxic = 1)
        SELECT doc_id, toxic, 0 AS copy FROM d
        UNION ALL SELECT doc_id, toxic, 1 AS copy FROM r, n WHERE rk <= least(greatest(n1 - n0, 0), n0)""",
)
def oversample(spark, folder):
    return features.oversample(rows(spark, folder).select("doc_id", "toxic"), ["doc_id"], "toxic", 1, 0, SEED)


@query(
    "oversample_larger",
    f"""WITH {_D}, n AS (SELECT count(*) FILTER (WHERE toxic = 0) AS n0, count(*) FILTER (WHERE toxic = 1) AS n1 FROM d),
             r AS (SELECT doc_id, toxic, row_number() OVER (ORDER BY {_U}, doc_id) AS rk FROM d WHERE toxic = 0)
        SELECT doc_id, toxic, 0 AS copy FROM d
        UNION ALL SELECT doc_id, toxic, 1 AS copy FROM r, n WHERE rk <= least(greatest(n1 - n0, 0), n0)""",
)
def oversample_larger(spark, folder):
    """The class named is the larger one: nothing is repeated."""
    return features.oversample(rows(spark, folder).select("doc_id", "toxic"), ["doc_id"], "toxic", 0, 1, SEED)


@query(
    "union_split",
    f"""WITH {_D}, {_RANKED} SELECT doc_id, n_chars FROM r WHERE rk <= round_even(cn * 0.2, 0)""",
)
def union_split(spark, folder):
    """Train and test in one table and apart again, by a column instead of by position."""
    marked = features.stratified_holdout(rows(spark, folder), ["doc_id"], "toxic", 0.2, SEED)
    train, test = features.only_split(marked, "train"), features.only_split(marked, "test")
    both = features.union_splits(train, test)
    return features.only_split(both, "test").select("doc_id", "n_chars")


_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "minmax_scale",
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 6) AS {c}" for c in _NUMERIC)
    + " FROM lineitem",
)
def minmax_scale(spark, folder):
    scaled = features.scaled_columns(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *_NUMERIC), _NUMERIC)
    return scaled.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in _NUMERIC])


def predictions(spark, folder):
    """A rule on length predicts quality."""
    return rows(spark, folder).withColumn("predicted", (F.col("n_chars") >= 1000).cast("int"))


_PRED = f"{_D}, p AS (SELECT *, CAST(n_chars >= 1000 AS INTEGER) AS predicted FROM d)"
_COUNT = """CAST(count(*) FILTER (WHERE {t} = 1 AND {p} = 1) AS DOUBLE) AS tp,
            CAST(count(*) FILTER (WHERE {t} <> 1 AND {p} = 1) AS DOUBLE) AS fp,
            CAST(count(*) FILTER (WHERE {t} = 1 AND {p} <> 1) AS DOUBLE) AS fn,
            CAST(count(*) FILTER (WHERE {t} <> 1 AND {p} <> 1) AS DOUBLE) AS tn"""
_R = "(CASE WHEN ({b}) = 0 THEN 0.0 ELSE ({a}) / ({b}) END)"
_TPR, _TNR = _R.format(a="tp", b="tp + fn"), _R.format(a="tn", b="tn + fp")
_VALUES = {
    "accuracy": _R.format(a="tp + tn", b="tp + fp + fn + tn"),
    "precision": _R.format(a="tp", b="tp + fp"),
    "recall": _TPR,
    "fscore": _R.format(a="2 * tp", b="2 * tp + fp + fn"),
    "bcr": f"({_TPR} + {_TNR}) / 2",
    "auc": f"({_TPR} + {_TNR}) / 2",
}
_METRICS = ", ".join(f"round({v}, 6) AS {k}" for k, v in _VALUES.items())


def _rounded(df, by=()):
    return df.select(*by, *[F.round(m, 6).alias(m) for m in scores.METRICS])


@query(
    "confusion_counts",
    f"WITH {_PRED} SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, "
    f"CAST(tn AS BIGINT) AS tn FROM (SELECT {_COUNT.format(t='quality', p='predicted')} FROM p)",
)
def confusion_counts(spark, folder):
    return scores.confusion(predictions(spark, folder), "quality", "predicted")


@query(
    "confusion_metrics",
    f"WITH {_PRED}, c AS (SELECT {_COUNT.format(t='quality', p='predicted')} FROM p) SELECT {_METRICS} FROM c",
)
def confusion_metrics(spark, folder):
    return _rounded(scores.classification_metrics(predictions(spark, folder), "quality", "predicted"))


@query(
    "flip_metrics",
    f"""WITH {_D}, c0 AS (SELECT {_COUNT.format(t='toxic', p='quality')} FROM d),
             c AS (SELECT CASE WHEN tp + tn < fp + fn THEN fn ELSE tp END AS tp,
                          CASE WHEN tp + tn < fp + fn THEN tp ELSE fn END AS fn,
                          CASE WHEN tp + tn < fp + fn THEN tn ELSE fp END AS fp,
                          CASE WHEN tp + tn < fp + fn THEN fp ELSE tn END AS tn FROM c0)
        SELECT {_METRICS} FROM c""",
)
def flip_metrics(spark, folder):
    """Quality read as a prediction of toxicity is mostly wrong, so it counts inverted."""
    return _rounded(scores.classification_metrics(rows(spark, folder), "toxic", "quality", flip=True))


_ROC = f"""{_D}, s AS (SELECT round(n_chars / 100.0, 0) AS threshold, count(*) FILTER (WHERE quality = 1) AS tp,
                              count(*) FILTER (WHERE quality <> 1) AS fp FROM d GROUP BY 1),
           c AS (SELECT *, sum(tp) OVER (ORDER BY threshold DESC) / CAST(sum(tp) OVER () AS DOUBLE) AS tpr,
                           sum(fp) OVER (ORDER BY threshold DESC) / CAST(sum(fp) OVER () AS DOUBLE) AS fpr FROM s)"""


def _points(spark, folder):
    scored = rows(spark, folder).withColumn("score", F.round(F.col("n_chars") / 100.0, 0))
    return scores.roc_points(scored, "quality", "score")


@query("roc_curve", f"WITH {_ROC} SELECT threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM c")
def roc_curve(spark, folder):
    return _points(spark, folder).select("threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@query(
    "roc_auc",
    f"""WITH {_ROC} SELECT round(sum((fpr - pf) * (tpr + pt) / 2), 6) AS auc FROM
          (SELECT fpr, tpr, lag(fpr, 1, 0) OVER (ORDER BY threshold DESC) AS pf,
                  lag(tpr, 1, 0) OVER (ORDER BY threshold DESC) AS pt FROM c)""",
)
def roc_auc(spark, folder):
    return scores.auc(_points(spark, folder)).select(F.round("auc", 6).alias("auc"))


@query("class_distribution", f"WITH {_D} SELECT toxic, count(*) AS n FROM d GROUP BY toxic")
def class_distribution(spark, folder):
    return scores.class_distribution(rows(spark, folder), "toxic")


@query(
    "score_means",
    f"""WITH {_PRED}, f AS (SELECT *, (row_number() OVER (ORDER BY {_U}, doc_id) - 1) % 10 AS fold FROM p),
             c AS (SELECT fold, {_COUNT.format(t='quality', p='predicted')} FROM f GROUP BY fold),
             w AS (SELECT fold, {', '.join(f'{v} AS {k}' for k, v in _VALUES.items())} FROM c)
        SELECT metric, round(avg(value), 6) AS value FROM
          (UNPIVOT w ON {', '.join(_VALUES)} INTO NAME metric VALUE value) GROUP BY metric""",
)
def score_means(spark, folder):
    folds = features.assign_folds(predictions(spark, folder), ["doc_id"], 10, SEED)
    wide = scores.classification_metrics(folds, "quality", "predicted", ["fold"])
    means = scores.mean_scores(scores.long_scores(wide, ["fold"]), [])
    return means.select("metric", F.round("value", 6).alias("value"))


def _pairs_sql(table_sql: str, by: str = "") -> str:
    """Pair counts of a contingency table c(by.., a, b, n)."""
    g = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    return f"""c AS ({table_sql}),
        k AS (SELECT {g} sum(n * (n - 1) / 2.0) AS nij, sum(n) * (sum(n) - 1) / 2.0 AS al FROM c {grp}),
        ka AS (SELECT {g} sum(n * (n - 1) / 2.0) AS na FROM (SELECT {g} a, sum(n) AS n FROM c GROUP BY {g} a) {grp}),
        kb AS (SELECT {g} sum(n * (n - 1) / 2.0) AS nb FROM (SELECT {g} b, sum(n) AS n FROM c GROUP BY {g} b) {grp})"""


_ARI = """CASE WHEN (na + nb) / 2 = na * nb / al THEN 1.0
               ELSE (nij - na * nb / al) / ((na + nb) / 2 - na * nb / al) END"""
_BRAND_TYPE = "SELECT p_brand AS a, p_type AS b, CAST(count(*) AS DOUBLE) AS n FROM part GROUP BY 1, 2"


@query(
    "adjusted_rand",
    f"WITH {_pairs_sql(_BRAND_TYPE)} SELECT round({_ARI}, 6) AS ari FROM k, ka, kb",
)
def adjusted_rand(spark, folder):
    found = scores.adjusted_rand(scores.contingency(table(spark, folder, "part"), "p_brand", "p_type"))
    return found.select(F.round("ari", 6).alias("ari"))


@query(
    "pair_jaccard",
    f"""WITH {_pairs_sql(_BRAND_TYPE)}
        SELECT CAST(nij AS BIGINT) AS n11, CAST(na - nij AS BIGINT) AS n10, CAST(nb - nij AS BIGINT) AS n01,
               round(nij / (na + nb - nij), 6) AS jaccard FROM k, ka, kb""",
)
def pair_jaccard(spark, folder):
    found = scores.pair_jaccard(scores.contingency(table(spark, folder, "part"), "p_brand", "p_type"))
    return found.withColumn("jaccard", F.round("jaccard", 6))


_LABELINGS = {"brand": "p_brand", "kind": "p_type", "size": "CAST(CAST(floor(p_size / 10.0) AS BIGINT) AS VARCHAR)"}
_MATRIX = " UNION ALL ".join(
    f"""SELECT '{x}' AS lft, '{y}' AS rgt, {_LABELINGS[x]} AS a, {_LABELINGS[y]} AS b, CAST(count(*) AS DOUBLE) AS n
        FROM part GROUP BY 3, 4"""
    for x in _LABELINGS
    for y in _LABELINGS
)


@query(
    "rand_matrix",
    f"""WITH {_pairs_sql(_MATRIX, 'lft, rgt')}
        SELECT lft AS "left", rgt AS "right", round({_ARI}, 6) AS ari
        FROM k JOIN ka USING (lft, rgt) JOIN kb USING (lft, rgt)""",
)
def rand_matrix(spark, folder):
    """Labelings kept apart are first joined by key, then compared pairwise."""
    part = table(spark, folder, "part")
    of = lambda c: part.select("p_partkey", c.alias("label"))
    joined = scores.join_labelings(
        {"brand": of(F.col("p_brand")), "kind": of(F.col("p_type")), "size": of(F.floor(F.col("p_size") / 10).cast("string"))},
        "p_partkey",
    )
    return scores.rand_matrix(joined, ["brand", "kind", "size"]).withColumn("ari", F.round("ari", 6))


@query(
    "unmatched_keys",
    """SELECT count(*) FILTER (WHERE l.doc_id IS NULL) AS left_only, count(*) FILTER (WHERE d.doc_id IS NULL) AS right_only
       FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id""",
)
def unmatched_keys(spark, folder):
    return scores.unmatched_keys(table(spark, folder, "documents"), table(spark, folder, "labels"), "doc_id")
