"""Hard negatives by slot-decomposed selection.

A row's score is its exact integer inner product with the anchor.  An anchor's positives are its best rows of the same
label; each positive admits negatives of other labels whose score lies between two shares of its own.  The upper limits
of an anchor's positives cut the scores into disjoint slots, so a window is a run of slots, cut off below.  Every
team of anchors meets every bucket of rows in one task, which keeps the first ``keep`` rows of each slot, and a
second step keeps the first ``keep`` of all buckets.  Merging the slots from the lowest up gives, for every slot, the
first rows of all scores up to its limit: that answers the window of each positive whose limit it is.

The rows are scored twice, once for the positives and once for the negatives.  A task holds a team of at most
``TEAM_BYTES`` of anchors and a bucket of bounded size, block by block; what it returns does not grow with the bucket.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take no part; of rows
with the same id the one that sorts first by (vector, label) stands for all; vectors of unequal length are compared
over the components that both have; numbers too large for exact products in 64 bits are multiplied as Python integers,
and a score beyond 64 bits (36 digits while they are compared) becomes the nearest such number; anchors without positives, and positives without
negatives, have no rows; an empty table gives an empty table; other columns play no part.
"""

from __future__ import annotations

import math
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from corvane.lineage import cut

TEAM_BYTES = 4 << 20  # of the anchors of a team, as doubles
BUCKET_BYTES = 32 << 20  # of the vectors of a bucket, on average
CELLS = 1 << 21  # scores computed at once
BEST = "anchor_id long, slot int, vec_id long, score decimal(38,0)"
EXACT = 1 << 52  # sums of doubles below it are exact
DIGITS = pa.decimal128(38, 0)


def components(column: pa.Array, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, as a matrix of doubles, or of Python integers where some are too large."""
    lengths = np.diff(column.offsets.to_numpy())
    width = int(lengths.max(initial=0))
    values = np.zeros((len(column), width))
    values[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)
    if np.abs(scaled).max(initial=0) < EXACT:
        return scaled
    # a double of that size is whole
    whole = lambda x: math.floor(x * scale) if abs(x) < EXACT else int(x) * scale
    return np.array([[whole(x) for x in row] for row in values.tolist()], dtype=object).reshape(values.shape)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products over the common components: int64 with room for a factor of 100, or Python integers."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if not width:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    if int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * width < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m.tolist()], dtype=object).reshape(m.shape)
    return whole(a) @ whole(b).T


def first_of(anchor: np.ndarray, slot: np.ndarray, score: np.ndarray, vec_id: np.ndarray, keep: int) -> tuple[np.ndarray, ...]:
    """Per (anchor, slot) the ``keep`` rows of highest score, smaller id first among equals."""
    if score.dtype == object:
        order = np.array(sorted(range(len(score)), key=lambda i: (anchor[i], slot[i], -score[i], vec_id[i])), dtype=np.int64)
    else:
        order = np.lexsort((vec_id, -score, slot, anchor))
    anchor, slot, score, vec_id = anchor[order], slot[order], score[order], vec_id[order]
    at = np.arange(len(anchor))
    starts = np.ones(len(anchor), dtype=bool)
    starts[1:] = (anchor[1:] != anchor[:-1]) | (slot[1:] != slot[:-1])
    kept = at - np.maximum.accumulate(np.where(starts, at, 0)) < keep
    return anchor[kept], slot[kept], score[kept], vec_id[kept]


class Team:
    """The anchors of one team and what they have found so far in one bucket.

    ``marks`` has the slots' upper limits, in hundredths and falling, ``low`` the least score worth keeping, both None
    where every row of the anchor's own label counts.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray, marks: list | None, low: list | None, keep: int) -> None:
        self.ids, self.labels, self.matrix, self.keep = ids, labels, matrix, keep
        self.slots = max((len(x) for x in marks), default=0) if marks is not None else 1
        if marks is not None:
            least = min((x[-1] for x in marks), default=0)
            padded = [[*x, *[min(least, b) - 1] * (self.slots - len(x))] for x, b in zip(marks, low, strict=True)]
            small = max((abs(v) for x in [*padded, low] for v in x), default=0) < 1 << 62
            self.marks = np.array(padded, dtype=np.int64 if small else object).reshape(len(ids), self.slots)
            self.low = np.array(low, dtype=np.int64 if small else object)
        else:
            self.marks = self.low = None
        self.found = tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
        self.full = np.zeros((len(ids), self.slots), dtype=bool)  # slots that hold ``keep`` rows
        self.last = np.zeros((len(ids), self.slots), dtype=object)  # and the least score of these

    def meet(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray) -> None:
        new = []
        step = max(1, CELLS // max(len(ids), 1))
        for first in range(0, len(self.ids), step):
            part = slice(first, first + step)
            scores = products(self.matrix[part], matrix)
            same = self.labels[part, None] == labels
            if self.marks is None:
                same &= self.ids[part, None] != ids
                if self.full[part].any() and scores.dtype != object:
                    bar = np.where(self.full[part, 0], self.last[part, 0], -(1 << 62)).astype(np.int64)
                    same &= scores >= bar[:, None]
                anchor, row = np.nonzero(same)
                score = scores[anchor, row]
                slot = np.zeros(len(anchor), dtype=np.int64)
            else:
                hundred = scores * 100
                anchor, row = np.nonzero(~same & (hundred <= self.marks[part, :1]) & (hundred >= self.low[part, None]))
                score = scores[anchor, row]
                slot = (self.marks[part][anchor] >= hundred[anchor, row][:, None]).sum(axis=1) - 1
            new.append(first_of(anchor + first, slot, score, ids[row], self.keep))
        self.found = first_of(*(np.concatenate(x) for x in zip(self.found, *new, strict=True)), self.keep)
        anchor, slot, score, _ = self.found
        count = np.zeros(self.full.shape, dtype=np.int64)
        np.add.at(count, (anchor, slot), 1)
        self.full = count >= self.keep
        self.last[anchor, slot] = score  # rows come best first, so the last one stays


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | None = None,
    scale: int = 256,
    positives: int = 5,
    keep: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """Per anchor and positive the first ``keep`` rows of other labels that score between ``low`` and ``high`` percent of it.

    ``label`` is the column ``label`` unless given.
    """
    spark = vectors.sparkSession
    usable = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"),
        (F.col("label") if label is None else label).cast("string").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(
        F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    one = usable.groupBy("vec_id").agg(F.min(F.struct("vector", "label", "is_anchor")).alias("r")).select("vec_id", "r.*")
    rows = cut(one, "vectors")
    n_rows, n_anchors, width = rows.agg(F.count("*"), F.count_if("is_anchor"), F.max(F.size("vector"))).first()
    row_bytes = 8 * max(width or 1, 1)
    # a few buckets a core on small tables, buckets of bounded size on all
    n_buckets = max(-(-n_rows * row_bytes // BUCKET_BYTES), min(2 * spark.sparkContext.defaultParallelism, n_rows // 2048), 1)
    n_teams = max(-(-n_anchors * row_bytes // TEAM_BYTES), 1)
    on = lambda c, n, salt: F.pmod(F.xxhash64(c, F.lit(salt)), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # every team meets every bucket: a stated set of anchors against all rows, in blocks
    dealt = rows.select("vec_id", "vector", "label", on("vec_id", n_buckets, 1).alias("bucket"), each(n_teams).alias("team"))

    def met(asked: DataFrame, kept: int) -> DataFrame:
        """The first ``kept`` rows of each (anchor, slot)."""

        def run(ours: pa.Table, theirs: pa.Table) -> pa.Table:
            labels = pd.factorize(np.array([*ours["anchor_label"].to_pylist(), *theirs["label"].to_pylist()], dtype=object))[0]
            marks, least = ours["marks"].to_pylist(), ours["least"].to_pylist()
            limited = ours.num_rows and marks[0] is not None
            team = Team(
                ours["anchor_vec_id"].to_numpy(), labels[: ours.num_rows], matrix_of(ours["anchor_vector"]),
                [[int(x) for x in m] for m in marks] if limited else None, [int(x) for x in least] if limited else None, kept,
            )
            ids = theirs["vec_id"].to_numpy()
            for first in range(0, theirs.num_rows if ours.num_rows else 0, 4096):
                part = slice(first, first + 4096)
                team.meet(ids[part], labels[ours.num_rows :][part], matrix_of(theirs["vector"].slice(first, 4096)))
            anchor, slot, score, vec_id = team.found
            most = 10**36 - 1  # a hundred of them still fit into the column
            digits = [Decimal(min(max(int(x), -most), most)) for x in score.tolist()]
            columns = [pa.array(team.ids[anchor], pa.int64()), pa.array(slot, pa.int32()), pa.array(vec_id, pa.int64()), pa.array(digits, DIGITS)]
            return pa.Table.from_arrays(columns, names=["anchor_id", "slot", "vec_id", "score"])

        def matrix_of(column: pa.ChunkedArray) -> np.ndarray:
            whole = column.combine_chunks()
            whole = whole if isinstance(whole, pa.Array) else pa.concat_arrays(whole.chunks)
            return components(whole, scale)

        renamed = [F.col(c).alias(f"anchor_{c}") for c in ("vec_id", "vector", "label")]
        sides = asked.select(*renamed, "marks", "least", on("vec_id", n_teams, 2).alias("team"), each(n_buckets).alias("bucket"))
        found = sides.groupBy("team", "bucket").cogroup(dealt.groupBy("team", "bucket")).applyInArrow(run, BEST)
        order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= kept).drop("place")

    digits = lambda c, percent: (c * F.lit(percent)).cast("decimal(38,0)")
    anchors = rows.where("is_anchor").select("vec_id", "vector", "label")
    free = anchors.withColumns({"marks": F.lit(None).cast("array<decimal(38,0)>"), "least": F.lit(None).cast("decimal(38,0)")})
    by_anchor = Window.partitionBy("anchor_id").orderBy(F.desc("score"))
    paired = cut(
        met(free, positives).select(
            "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
            (F.dense_rank().over(by_anchor) - 1).alias("slot"),
        ), "positives",
    )
    limits = paired.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.sort_array(F.collect_set(digits(F.col("positive_score"), high)), asc=False).alias("marks"),
        F.min(digits(F.col("positive_score"), low)).alias("least"),
    )
    slots = met(anchors.join(limits, "vec_id"), keep)
    # the slots of an anchor hold at most positives x keep rows
    entry = F.struct((-F.col("score")).alias("below"), "vec_id", "slot")
    tops = slots.groupBy("anchor_id").agg(F.collect_list(entry).alias("found"))
    empty = F.expr("CAST(array() AS array<struct<below: decimal(38,0), vec_id: bigint, slot: int>>)")
    merged = F.aggregate(
        F.sequence(F.lit(positives - 1), F.lit(0), F.lit(-1)),
        F.expr("CAST(array() AS array<array<struct<below: decimal(38,0), vec_id: bigint, slot: int>>>)"),
        lambda done, j: F.concat(F.array(
            F.slice(F.array_sort(F.concat(F.filter("found", lambda x: x["slot"] == j), F.coalesce(F.get(done, F.lit(0)), empty))), 1, keep)
        ), done),
    )
    answered = paired.join(tops.select("anchor_id", merged.alias("merged")), "anchor_id").select(
        "anchor_id", "positive_id", "positive_score", F.posexplode(F.get("merged", F.col("slot"))).alias("place", "row")
    )
    score = -F.col("row.below")
    long = lambda c: F.least(F.greatest(c, F.lit(-(1 << 63)).cast("decimal(38,0)")), F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("long")
    return answered.where(digits(score, 100) >= digits(F.col("positive_score"), low)).select(
        "anchor_id", "positive_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("row.vec_id").alias("negative_id"),
        long(F.col("positive_score")).alias("positive_score"), long(score).alias("negative_score"),
    )


#: The same in SQL, for vectors whose products fit into 64 bits and whose ids are distinct.
SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_inner_product(CAST(a.c AS DOUBLE[]), CAST(b.c AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
