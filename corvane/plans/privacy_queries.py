"""Release of a person table.

Quasi-identifiers are the nation and a bucket of the balance, the sensitive value is the segment.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import person
from corvane.operators import release as r
from corvane.plans.registry import query
from corvane.plans.tables import persons, table

QI = ["c_nationkey", "bal"]
SENSITIVE = "c_mktsegment"
WIDTH = 2500
K, L, T = 10, 5, 0.1

_P = f"""p AS (SELECT c_custkey, c_nationkey, CAST(floor(c_acctbal / {WIDTH}.0) * {WIDTH} AS BIGINT) AS bal,
                      c_mktsegment, c_acctbal FROM customer)"""
_H = "h AS (SELECT c_nationkey, bal, c_mktsegment, count(*) AS n FROM p GROUP BY ALL)"
_BASE = """base AS (SELECT c_mktsegment, count(*) / CAST((SELECT count(*) FROM p) AS DOUBLE) AS share
                    FROM p GROUP BY c_mktsegment)"""
_STATS = """stats AS (SELECT h.c_nationkey, h.bal, CAST(sum(h.n) AS BIGINT) AS n, count(*) AS n_distinct,
                             sum(CAST(h.n AS DOUBLE) / c.cn * ln(CAST(h.n AS DOUBLE) / c.cn / b.share)) AS kl
                      FROM h JOIN base b USING (c_mktsegment)
                      JOIN (SELECT c_nationkey, bal, sum(n) AS cn FROM h GROUP BY ALL) c
                        ON c.c_nationkey IS NOT DISTINCT FROM h.c_nationkey AND c.bal IS NOT DISTINCT FROM h.bal
                      GROUP BY h.c_nationkey, h.bal)"""
_ALL = f"WITH {_P}, {_H}, {_BASE}, {_STATS}"
_ROWS = "SELECT p.c_custkey, p.c_nationkey, p.bal, p.c_mktsegment FROM p JOIN stats s USING (c_nationkey, bal)"


def generalised(spark, folder):
    return persons(spark, folder).select(
        "c_custkey",
        "c_nationkey",
        person.floor_bucket(F.col("c_acctbal"), WIDTH).alias("bal"),
        "c_mktsegment",
    )


@query(
    "pseudonymize",
    """SELECT sha1('north' || replace(c_name, ' ', '') || 'south') AS pseudonym, c_nationkey, c_mktsegment
       FROM customer""",
)
def pseudonymize(spark, folder):
    return persons(spark, folder).select(
        person.pseudonym(F.col("c_name"), "north", "south").alias("pseudonym"), "c_nationkey", "c_mktsegment"
    )


@query(
    "generalize",
    """SELECT c_custkey, CAST(floor(c_acctbal / 2000.0) * 2000 AS BIGINT) AS balance,
              CAST(floor(c_nationkey / 5.0) * 5 AS BIGINT) AS nation FROM customer""",
)
def generalize(spark, folder):
    return persons(spark, folder).select(
        "c_custkey",
        person.floor_bucket(F.col("c_acctbal"), 2000).alias("balance"),
        person.floor_bucket(F.col("c_nationkey"), 5).alias("nation"),
    )


@query(
    "generalize_dates",
    """SELECT o_orderkey, CAST(floor(CAST(split_part(strftime(o_orderdate, '%m/%Y'), '/', 2) AS INTEGER) / 25.0)
              * 25 AS BIGINT) AS years FROM orders""",
)
def generalize_dates(spark, folder):
    text = F.date_format("o_orderdate", "MM/yyyy")
    return table(spark, folder, "orders").select(
        "o_orderkey", person.floor_bucket(person.date_part(text), 25).alias("years")
    )


@query(
    "merge_category",
    """SELECT p_partkey, CASE WHEN list_contains(string_split(p_name, ' '), 'ring') THEN 'ring' ELSE p_name END
              AS category FROM part""",
)
def merge_category(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", person.merge_on_token(F.col("p_name"), "ring").alias("category")
    )


@query(
    "conditional_override",
    "SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN p_size ELSE 5 END AS p_size FROM part",
)
def conditional_override(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", person.override_unless(F.col("p_type") == "SMALL", F.col("p_size"), 5).alias("p_size")
    )


@query(
    "label_encode",
    """SELECT p_partkey, dense_rank() OVER (ORDER BY p_brand) - 1 AS p_brand,
              dense_rank() OVER (ORDER BY p_type) - 1 AS p_type FROM part""",
)
def label_encode(spark, folder):
    return r.label_encode(table(spark, folder, "part").select("p_partkey", "p_brand", "p_type"), ["p_brand", "p_type"])


@query("class_sizes", f"WITH {_P} SELECT c_nationkey, bal, count(*) AS n FROM p GROUP BY ALL")
def class_sizes(spark, folder):
    return r.class_sizes(generalised(spark, folder), QI)


@query("row_class_size", f"WITH {_P} SELECT c_custkey, count(*) OVER (PARTITION BY c_nationkey, bal) AS class_size FROM p")
def row_class_size(spark, folder):
    return r.attach_class_size(generalised(spark, folder), QI).select("c_custkey", "class_size")


@query("class_histogram", f"WITH {_P}, {_H} SELECT * FROM h")
def class_histogram(spark, folder):
    return r.class_histogram(generalised(spark, folder), QI, SENSITIVE)


@query("sensitive_distribution", f"WITH {_P}, {_BASE} SELECT c_mktsegment, round(share, 6) AS share FROM base")
def sensitive_distribution(spark, folder):
    return r.distribution(generalised(spark, folder), SENSITIVE).select(SENSITIVE, F.round("share", 6).alias("share"))


@query("k_anonymous", f"{_ALL} {_ROWS} WHERE s.n >= {K}")
def k_anonymous(spark, folder):
    return r.k_anonymous(generalised(spark, folder), QI, K)


@query("l_diverse", f"{_ALL} {_ROWS} WHERE s.n_distinct >= {L}")
def l_diverse(spark, folder):
    return r.l_diverse(generalised(spark, folder), QI, SENSITIVE, L)


@query("class_kl", f"{_ALL} SELECT c_nationkey, bal, n, n_distinct, round(kl, 6) AS kl FROM stats")
def class_kl(spark, folder):
    return r.class_stats(generalised(spark, folder), QI, SENSITIVE).withColumn("kl", F.round("kl", 6))


@query(
    "class_kl_presence",
    f"""{_ALL} SELECT h.c_nationkey, h.bal,
                      round(sum(1.0 / c.d * ln(1.0 / c.d / b.share)), 6) AS kl
               FROM h JOIN base b USING (c_mktsegment)
               JOIN (SELECT c_nationkey, bal, CAST(count(*) AS DOUBLE) AS d FROM h GROUP BY ALL) c USING (c_nationkey, bal)
               GROUP BY h.c_nationkey, h.bal""",
)
def class_kl_presence(spark, folder):
    """Divergence when every value present in a class counts once."""
    stats = r.class_stats(generalised(spark, folder), QI, SENSITIVE, weighting="presence")
    return stats.select(*QI, F.round("kl", 6).alias("kl"))


@query(
    "kl_extremes",
    f"""{_ALL}, q AS (SELECT c_nationkey, bal, round(kl, 9) AS kl FROM stats)
        SELECT 'near' AS side, c_nationkey, bal, round(kl, 6) AS kl FROM
          (SELECT * FROM q ORDER BY kl, c_nationkey, bal LIMIT 1)
        UNION ALL
        SELECT 'far' AS side, c_nationkey, bal, round(kl, 6) AS kl FROM
          (SELECT * FROM q ORDER BY kl DESC, c_nationkey, bal LIMIT 1)""",
)
def kl_extremes(spark, folder):
    stats = r.class_stats(generalised(spark, folder), QI, SENSITIVE).withColumn("kl", F.round("kl", 9))
    return r.kl_extremes(stats, QI).withColumn("kl", F.round("kl", 6))


@query("t_close", f"{_ALL} {_ROWS} WHERE s.kl <= {T}")
def t_close(spark, folder):
    return r.t_close(generalised(spark, folder), QI, SENSITIVE, T)


@query("release_table", f"{_ALL} {_ROWS} WHERE s.n >= {K} AND s.n_distinct >= {L} AND s.kl <= {T}")
def release_table(spark, folder):
    return r.release(generalised(spark, folder), QI, SENSITIVE, K, L, T)


_WIDE = """q AS (SELECT p_partkey, p_brand, p_type, CAST(floor(p_size / 25.0) * 25 AS BIGINT) AS size,
                    CAST(floor(p_retailprice / 1000.0) * 1000 AS BIGINT) AS price,
                    CASE WHEN list_contains(string_split(p_name, ' '), 'ring') THEN 'ring' ELSE p_name END AS name
             FROM part),
     h AS (SELECT p_brand, p_type, size, price, name, count(*) AS n FROM q GROUP BY ALL),
     base AS (SELECT name, count(*) / CAST((SELECT count(*) FROM q) AS DOUBLE) AS share FROM q GROUP BY name),
     cls AS (SELECT p_brand, p_type, size, price, CAST(count(*) AS DOUBLE) AS d, sum(n) AS n FROM h GROUP BY ALL),
     kl AS (SELECT p_brand, p_type, size, price, sum(1.0 / d * ln(1.0 / d / share)) AS kl
            FROM h JOIN base USING (name) JOIN cls c USING (p_brand, p_type, size, price) GROUP BY ALL)"""


@query(
    "release_many_identifiers",
    f"""WITH {_WIDE} SELECT q.p_partkey, q.name FROM q JOIN cls USING (p_brand, p_type, size, price)
        JOIN kl USING (p_brand, p_type, size, price) WHERE cls.n >= 6 AND cls.d >= 4 AND kl.kl <= 1.5""",
)
def release_many_identifiers(spark, folder):
    """Four quasi-identifiers, merged categories, and every value present in a class counted once."""
    rows = table(spark, folder, "part").select(
        "p_partkey",
        "p_brand",
        "p_type",
        person.floor_bucket(F.col("p_size"), 25).alias("size"),
        person.floor_bucket(F.col("p_retailprice"), 1000).alias("price"),
        person.merge_on_token(F.col("p_name"), "ring").alias("name"),
    )
    qi = ["p_brand", "p_type", "size", "price"]
    return r.release(rows, qi, "name", 6, 4, 1.5, weighting="presence").select("p_partkey", "name")


_KEPT = f"kept AS ({_ROWS} WHERE s.n >= {K} AND s.n_distinct >= {L} AND s.kl <= {T})"


@query(
    "release_kl",
    f"""{_ALL}, {_KEPT}, f AS (SELECT c_mktsegment, count(*) AS n FROM kept GROUP BY 1)
        SELECT round(sum(CAST(f.n AS DOUBLE) / t.cn * ln(CAST(f.n AS DOUBLE) / t.cn / b.share)), 6) AS kl
        FROM f JOIN base b USING (c_mktsegment), (SELECT sum(n) AS cn FROM f) t""",
)
def release_kl(spark, folder):
    rows = generalised(spark, folder)
    base = r.distribution(rows, SENSITIVE)
    kept = r.release(rows, QI, SENSITIVE, K, L, T, base)
    return r.table_divergence(kept, SENSITIVE, base).select(F.round("kl", 6).alias("kl"))


_ENTROPY = """(SELECT ln(sum(n)) - sum(n * ln(n)) / sum(n) FROM (SELECT CAST(count(*) AS DOUBLE) AS n FROM {t} GROUP BY {q}))"""


@query(
    "entropy_loss",
    f"""{_ALL}, {_KEPT}, e AS (SELECT {_ENTROPY.format(t='p', q='c_nationkey, c_acctbal')} AS b,
                                      {_ENTROPY.format(t='kept', q='c_nationkey, bal')} AS a)
        SELECT round(b, 6) AS entropy_before, round(a, 6) AS entropy_after, round(b - a, 6) AS loss FROM e""",
)
def entropy_loss(spark, folder):
    kept = r.release(generalised(spark, folder), QI, SENSITIVE, K, L, T)
    loss = r.entropy_loss(persons(spark, folder), kept, ["c_nationkey", "c_acctbal"], QI)
    return loss.select(*[F.round(c, 6).alias(c) for c in loss.columns])


@query(
    "privacy_grid",
    f"""{_ALL} SELECT k, l, CAST(coalesce(sum(n) FILTER (WHERE n >= k AND n_distinct >= l), 0) AS BIGINT) AS rows_left
        FROM stats, range(1, 12) a(k), range(1, 12) b(l) GROUP BY k, l""",
)
def privacy_grid(spark, folder):
    return r.privacy_grid(generalised(spark, folder), QI, SENSITIVE)


def release_summary(spark, folder, k=K, l=L, t=T):
    """Rows and classes kept, and the entropy they lose, for a pseudonymised release."""
    rows = persons(spark, folder).select(
        person.pseudonym(F.col("c_name"), "north", "south").alias("pseudonym"),
        "c_nationkey",
        person.floor_bucket(F.col("c_acctbal"), WIDTH).alias("bal"),
        "c_mktsegment",
    )
    stats = r.class_stats(rows, QI, SENSITIVE)
    keep = (F.col("n") >= k) & (F.col("n_distinct") >= l) & (F.col("kl") <= t)
    size = lambda when: F.sum(F.when(when, F.col("n")).otherwise(0))
    weighted = lambda when: F.sum(F.when(when, F.col("n") * F.ln("n")).otherwise(0.0))
    spread = lambda when: F.when(size(when) > 0, F.ln(size(when)) - weighted(when) / size(when)).otherwise(0.0)
    return stats.agg(
        size(F.lit(True)).alias("rows_before"),
        size(keep).alias("rows_kept"),
        F.count("*").alias("classes_before"),
        F.count_if(keep).alias("classes_kept"),
        F.round(spread(F.lit(True)) - spread(keep), 6).alias("entropy_loss"),
    )


@query(
    "release_summary",
    f"""{_ALL}, m AS (SELECT *, n >= {K} AND n_distinct >= {L} AND kl <= {T} AS keep FROM stats)
        SELECT CAST(sum(n) AS BIGINT) AS rows_before, CAST(coalesce(sum(n) FILTER (WHERE keep), 0) AS BIGINT) AS rows_kept,
               count(*) AS classes_before, count(*) FILTER (WHERE keep) AS classes_kept,
               round(ln(sum(n)) - sum(n * ln(n)) / sum(n)
                     - coalesce(ln(sum(n) FILTER (WHERE keep)) - sum(n * ln(n)) FILTER (WHERE keep)
                                / sum(n) FILTER (WHERE keep), 0), 6) AS entropy_loss
        FROM m""",
)
def release_summary_query(spark, folder):
    return release_summary(spark, folder)
