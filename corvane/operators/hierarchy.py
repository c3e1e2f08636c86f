"""Ward's hierarchical clustering of all rows, merging many pairs a round.

Two clusters that are each other's nearest merge whatever else happens (Ward's cost is reducible), so every round merges
all such pairs at once, and a cluster looks for its nearest one anew only when it has changed or lost it.  Clusters
are summaries (size and mean) named by their smallest row number.  Searches run block against block in tasks of bounded
size; once at most ``finish`` clusters are left, one task of that bounded size builds the rest of the tree.

The first search compares all pairs of rows, block by block, as the method asks; for more rows than that suits, merge
summaries of narrow cells instead (``clusters.birch``).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corvane.lineage import GrowingTable, cut

BLOCK = 2048  # clusters that one task merges to the end
SEARCH_BYTES = 32 << 20  # of the means on either side of a search task
QUERY_CHUNK, ROW_CHUNK, PAIR_SLAB, PENDING = 256, 4096, 16_384, 1_000_000
FEW = 256  # clusters of a size, fewer of which are searched with those of other sizes
TREE = "low long, high long, cost double, n long"
NEAREST = "id long, cost double, near long"


def costs(n: np.ndarray, means: np.ndarray, other_n: np.ndarray, other_means: np.ndarray) -> np.ndarray:
    """By how much the sum of squares grows if two clusters merge, for all pairs."""
    gaps = (means * means).sum(axis=1)[:, None] + (other_means * other_means).sum(axis=1) - 2 * means @ other_means.T
    return np.maximum(gaps, 0) * (n[:, None] * other_n / (n[:, None] + other_n))


def columns_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    table = table.combine_chunks()
    means = table["mean"].chunk(0).flatten().to_numpy() if table.num_rows else np.zeros(0)
    return table["id"].to_numpy(), table["n"].to_numpy().astype(np.float64), means.reshape(table.num_rows, -1)


def merge_all(ids: np.ndarray, n: np.ndarray, means: np.ndarray) -> list[tuple[int, int, float, int]]:
    """All merges of a few clusters, by chains of nearest neighbours."""
    alive = np.ones(len(ids), dtype=bool)
    out, chain = [], []
    for _ in range(len(ids) - 1):
        while True:
            if not chain:
                chain = [int(np.flatnonzero(alive)[0])]
            last = chain[-1]
            cost = costs(n[last : last + 1], means[last : last + 1], n, means)[0]
            cost[~alive] = np.inf
            cost[last] = np.inf
            best = int(cost.argmin())
            if len(chain) > 1 and cost[chain[-2]] <= cost[best]:
                break
            chain.append(best)
        a, b = chain.pop(), chain.pop()
        a, b = (a, b) if ids[a] < ids[b] else (b, a)
        grown = costs(n[a : a + 1], means[a : a + 1], n[b : b + 1], means[b : b + 1])[0, 0]
        out.append((int(ids[a]), int(ids[b]), float(grown), int(n[a] + n[b])))
        means[a] = (n[a] * means[a] + n[b] * means[b]) / (n[a] + n[b])
        n[a] += n[b]
        alive[b] = False
    return out


def grid(asking: int, clusters: int, width: int, tasks: int) -> tuple[int, int]:
    """Blocks of asking clusters and of all: enough for ``tasks``, none over ``SEARCH_BYTES``, few bytes sent."""
    most = max(1, SEARCH_BYTES // (8 * max(width, 1)))
    even = min(-(-clusters // QUERY_CHUNK), math.ceil(math.sqrt(tasks * clusters / max(asking, 1))))
    theirs = max(1, -(-clusters // most), min(even, tasks))
    return max(1, -(-asking // most), min(-(-tasks // theirs), asking // QUERY_CHUNK)), theirs


def _runs(n: np.ndarray) -> list[tuple[int, int, bool]]:
    """Runs of ascending sizes ``n``, at most ``ROW_CHUNK`` long: (first, end, whether all are of one size). Few of a size share a run."""
    ends = [*(np.flatnonzero(n[1:] != n[:-1]) + 1).tolist(), len(n)] if len(n) else []
    out, first, open_from = [], 0, None
    for end in ends:
        if end - first < FEW:
            open_from = first if open_from is None else open_from
        else:
            if open_from is not None:
                out.append((open_from, first, False))
                open_from = None
            out.append((first, end, True))
        first = end
    if open_from is not None:
        out.append((open_from, len(n), False))
    return [(i, min(i + ROW_CHUNK, end), even) for first, end, even in out for i in range(first, end, ROW_CHUNK)]


def _cheapest(
    id_a: np.ndarray, n_a: np.ndarray, mean_a: np.ndarray, id_b: np.ndarray, n_b: np.ndarray, mean_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(cost, name) of the other cluster that each of ``a`` merges with at least cost, the smaller name among equals.

    The clusters ``b`` ascend by size. They are measured in single precision with a bound on its rounding, and all that it leaves
    is measured exactly, the same from either side. In a run of one size the costs of a cluster follow the gaps: the product of
    the vectors, lengthened by their squares, is all there is to do for a pair.
    """
    best, near = np.full(len(id_a), np.inf), np.zeros(len(id_a), dtype=np.int64)
    if not len(id_a) or not len(id_b):
        return best, near
    fine_a, fine_b = (np.isfinite(x).all(axis=1) for x in (mean_a, mean_b))
    if not (fine_a.all() and fine_b.all()):
        # rows without finite numbers are nobody's nearest and have none
        a, b = ([x[fine] for x in side] for side, fine in (((id_a, n_a, mean_a), fine_a), ((id_b, n_b, mean_b), fine_b)))
        best[fine_a], near[fine_a] = _cheapest(*a, *b)
        return best, near
    width = mean_a.shape[1]
    centre = mean_b.mean(axis=0)
    moved_a, moved_b = mean_a - centre, mean_b - centre
    own, squares = ((x * x).sum(axis=1) for x in (moved_a, moved_b))
    top = max(own.max(), squares.max())
    kind = np.float32 if 1e-25 < top < 1e25 else np.float64
    one = lambda x: np.ones((len(x), 1), kind)
    a = np.concatenate([(-2 * moved_a).astype(kind), one(own), own[:, None].astype(kind)], axis=1)
    b = np.concatenate([moved_b.astype(kind), squares[:, None].astype(kind), one(squares)], axis=1)
    del moved_a, moved_b
    slack = 4 * (width + 16) * float(np.finfo(kind).eps) * (own + top)  # of a gap
    order = np.argsort(id_b)
    place = np.minimum(np.searchsorted(id_b, id_a, sorter=order), len(id_b) - 1)
    itself = np.where(id_b[order[place]] == id_a, order[place], -1)
    room, runs = np.empty(QUERY_CHUNK * ROW_CHUNK, dtype=kind), _runs(n_b)
    more = 1 + 8 * float(np.finfo(kind).eps)
    for first in range(0, len(id_a), QUERY_CHUNK):
        at = np.arange(first, min(first + QUERY_CHUNK, len(id_a)))
        limit = np.full(len(at), np.inf)  # no cluster dearer than this is the cheapest
        pending: list[tuple[np.ndarray, np.ndarray]] = []

        def settle() -> None:
            q, r = (np.concatenate(x) for x in zip(*pending))
            pending.clear()
            cost = np.empty(len(q))
            for i in range(0, len(q), PAIR_SLAB):
                x, y = at[q[i : i + PAIR_SLAB]], r[i : i + PAIR_SLAB]
                gap = mean_a[x] - mean_b[y]
                cost[i : i + PAIR_SLAB] = (gap * gap).sum(axis=1) * (n_a[x] * n_b[y] / (n_a[x] + n_b[y]))
            q, cost, name = np.concatenate([q, np.arange(len(at))]), np.concatenate([cost, best[at]]), np.concatenate([id_b[r], near[at]])
            by = np.lexsort((name, cost, q))
            lead = by[np.searchsorted(q[by], np.arange(len(at)))]
            best[at], near[at] = cost[lead], name[lead]
            np.minimum(limit, best[at], out=limit)

        for start, end, even in runs:
            value = np.matmul(a[at], b[start:end].T, out=room[: len(at) * (end - start)].reshape(len(at), end - start))
            mine = np.flatnonzero((itself[at] >= start) & (itself[at] < end))
            value[mine, itself[at[mine]] - start] = np.inf
            factor = n_a[at] * n_b[end - 1] / (n_a[at] + n_b[end - 1])  # the largest of the run
            if even:
                least = value.min(axis=1).astype(float)
                np.minimum(limit, (np.maximum(least, 0) + slack[at]) * factor * more, out=limit)
                bound = limit / factor * more + slack[at]
            else:
                value /= (1 / n_a[at]).astype(kind)[:, None] + (1 / n_b[start:end]).astype(kind)
                least = value.min(axis=1).astype(float)
                np.minimum(limit, (np.maximum(least, 0) + slack[at] * factor) * more, out=limit)
                bound = limit * more + slack[at] * factor
            near_enough = np.flatnonzero((least <= bound) & np.isfinite(least))
            if len(near_enough):
                q, r = np.nonzero(value[near_enough] <= bound[near_enough, None])
                pending.append((near_enough[q], r + start))
                if sum(len(x[0]) for x in pending) > PENDING:
                    settle()
        if pending:
            settle()
    return best, near


def nearest(asking: DataFrame, clusters: DataFrame, blocks: tuple[int, int]) -> DataFrame:
    """The nearest other cluster of each asking one, the smaller name among equals."""

    def run(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        id_a, n_a, mean_a = columns_of(ours.rename_columns([c.removeprefix("asking_") for c in ours.column_names]))
        id_b, n_b, mean_b = columns_of(theirs.sort_by([("n", "ascending"), ("id", "ascending")]))
        best, near = _cheapest(id_a, n_a, mean_a, id_b, n_b, mean_b)
        kept = np.isfinite(best)
        return pa.table({"id": id_a[kept], "cost": best[kept], "near": near[kept]})

    block = lambda c, side: F.pmod(F.xxhash64(c, F.lit(side + 1)), F.lit(blocks[side])).cast("int")
    every = lambda side: F.explode(F.sequence(F.lit(0), F.lit(blocks[side] - 1)))
    renamed = [F.col(c).alias(f"asking_{c}") for c in ("id", "n", "mean")]
    ours = asking.select(*renamed, block("id", 0).alias("a"), every(1).alias("b")).groupBy("a", "b")
    theirs = clusters.select("id", "n", "mean", block("id", 1).alias("b"), every(0).alias("a")).groupBy("a", "b")
    found = ours.cogroup(theirs).applyInArrow(run, NEAREST)
    best = F.min(F.struct("cost", "near")).alias("best")
    return found.groupBy("id").agg(best).select("id", "best.cost", "best.near")


def ward_tree(df: DataFrame, key: str, vector: str, finish: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(the merges, (key, id) of every row): a merge takes the cluster ``high`` into ``low``, both named by a row number.

    Equal rows are one cluster from the start: their merges cost 0 and have 0 for the size ``n``.
    """
    spark = df.sparkSession
    rows = cut(df.select(key, F.col(vector).cast("array<double>").alias("mean")), "rows")
    rows = cut(rows.withColumn("id", F.monotonically_increasing_id()), "rows")
    tree = GrowingTable(spark, "ward", TREE)
    clusters = cut(rows.groupBy("mean").agg(F.min("id").alias("id"), F.count("*").alias("n")).select("id", "n", "mean"), "clusters")
    others = rows.join(clusters.select("mean", F.col("id").alias("low"), F.col("n").alias("of")).where("of > 1"), "mean").where("id <> low")
    tree.append(others.select("low", F.col("id").alias("high"), F.lit(0.0).alias("cost"), F.lit(0).cast("long").alias("n")))
    left, known = clusters.count(), None
    width, tasks = (clusters.select(F.size("mean")).first() or [1])[0], 3 * spark.sparkContext.defaultParallelism
    while left > finish:
        if known is None:
            found = nearest(clusters, clusters, grid(left, left, width, tasks))
        else:
            stale = cut(clusters.join(known.select("id"), "id", "left_anti"), "stale")
            found = known.unionByName(nearest(stale, clusters, grid(stale.count(), left, width, tasks)))
        found = cut(found, "nearest")
        # a pair that names each other is there twice
        pair = found.select(F.least("id", "near").alias("low"), F.greatest("id", "near").alias("high"), "cost")
        mutual = pair.groupBy("low", "high").agg(F.count("*").alias("twice"), F.min("cost").alias("cost")).where("twice = 2")
        ends = [clusters.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("mean").alias(f"mean_{c}")) for c in ("low", "high")]
        merged = cut(mutual.select("low", "high", "cost").join(ends[0], "low").join(ends[1], "high"), "merged")
        total = F.col("n_low") + F.col("n_high")
        tree.append(merged.select("low", "high", "cost", total.alias("n")))
        mean = F.zip_with("mean_low", "mean_high", lambda a, b: (a * F.col("n_low") + b * F.col("n_high")) / total)
        gone = cut(merged.select(F.explode(F.array("low", "high")).alias("id")), "gone")
        new = merged.select(F.col("low").alias("id"), total.alias("n"), mean.alias("mean"))
        clusters = cut(clusters.join(gone, "id", "left_anti").unionByName(new), "clusters")
        known = found.join(gone, "id", "left_anti").join(gone.select(F.col("id").alias("near")), "near", "left_anti").select("id", "cost", "near")
        left = clusters.count()

    def rest(table: pa.Table) -> pa.Table:
        merges = merge_all(*(x.copy() for x in columns_of(table.sort_by("id"))))
        low, high, cost, n = zip(*merges, strict=True) if merges else ([], [], [], [])
        return pa.table({"low": pa.array(low, pa.int64()), "high": pa.array(high, pa.int64()), "cost": pa.array(cost, pa.float64()), "n": pa.array(n, pa.int64())})

    # at most ``finish`` summaries
    tree.append(clusters.groupBy(F.lit(0).alias("all")).applyInArrow(lambda t: rest(t.drop_columns(["all"]) if "all" in t.column_names else t), TREE))
    return tree.read(), rows.select(key, "id")


def ward_labels(df: DataFrame, key: str, vector: str, k: int = 2, finish: int = BLOCK) -> DataFrame:
    """(key, label): the ``k`` clusters that are left when the dearest ``k - 1`` merges are undone."""
    tree, rows = ward_tree(df, key, vector, finish)
    # a merge never costs less than those below it; of equal ones the larger lies above
    undone = tree.orderBy(F.desc("cost"), F.desc("n")).limit(k - 1)
    into = cut(tree.join(undone.select("high"), "high", "left_anti").select(F.col("high").alias("id"), F.col("low").alias("root")), "into")
    while True:  # each round halves the way to the root
        further = into.join(into.select(F.col("id").alias("root"), F.col("root").alias("next")), "root", "left")
        jumped = cut(further.select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "into")
        into = jumped.select("id", "root")
        if jumped.where("moved").isEmpty():
            break
    placed = cut(rows.join(into, "id", "left").select(key, F.coalesce("root", "id").alias("root")), "placed")
    roots = sorted(r.root for r in placed.select("root").distinct().collect())  # k of them
    numbers = df.sparkSession.createDataFrame(list(enumerate(roots)), "label int, root long")
    return placed.join(F.broadcast(numbers), "root").select(key, "label")
