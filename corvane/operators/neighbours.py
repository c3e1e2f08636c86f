"""Distances to centres, and exact nearest neighbours.

The neighbour join follows the pivot scheme of Lu et al. (2012): points are copied only to the
pivot cells whose queries they can matter to, by the triangle inequality, and cells are cut into
blocks, so that a task sees two blocks of bounded size whatever the skew. It holds for every
Minkowski metric and drops no candidate. Where the bound prunes little, there is one cell.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from corvane.functions.keyed_random import uniform
from corvane.functions.vectors import distance
from corvane.lineage import cut

CENTRE_BLOCK = 2_000
FEWEST, MOST, PER_PIVOT = 16, 512, 20_000
BLOCK_BYTES = 64 << 20  # of the points of a task, in double precision; a quarter as many queries
QUERY_CHUNK, ROW_CHUNK, PAIR_SLAB, PENDING = 256, 8192, 16_384, 1_000_000
LEVEL_TILE = 16  # queries whose gaps to a run of rows stay in a core's cache
COARSE = 0.03  # of the usual distance, at most left open by levels


def centroids(df: DataFrame, label: str, vector: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean vector and size per label."""
    return (
        df.groupBy(*by, label)
        .agg(Summarizer.mean(array_to_vector(F.col(vector))).alias("m"), F.count("*").alias("n"))
        .select(*by, label, vector_to_array("m").alias("centre"), "n")
    )


def centre_distances(points: DataFrame, vector: str, centres: DataFrame, label: str) -> DataFrame:
    """Every point with its distance to every centre ``centres(label, centre)``.

    The result has a row for each pair by its nature. Centres travel as arrays of about ``CENTRE_BLOCK``.
    """
    return _with_blocks(points, centres, label).withColumn("__c", F.explode("__centres")).select(
        *points.columns, F.col("__c.id").alias("centre_id"), distance(F.col(vector), F.col("__c.at")).alias("dist")
    )


def _with_blocks(points: DataFrame, centres: DataFrame, label: str) -> DataFrame:
    """Every point with ``__centres``, an array of (id, at): all of them where they fit a block, else a row for each block."""
    one = F.struct(F.col(label).alias("id"), F.col("centre").alias("at"))
    blocks = -(-centres.count() // CENTRE_BLOCK)
    if blocks <= 1:
        return points.withColumn("__centres", centres.agg(F.collect_list(one)).scalar())
    dealt = centres.groupBy(F.pmod(F.xxhash64(label), F.lit(blocks)).alias("__block")).agg(F.collect_list(one).alias("__centres"))
    numbered = points.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    return numbered.join(cut(dealt, "centres"), "__block").drop("__block")


def nearest_of(vector: Column, centres: Column) -> Column:
    """(dist, centre_id) of the nearest of an array of centres (id, at); ties go to the lowest id."""
    return F.array_min(F.transform(centres, lambda c: F.struct(distance(vector, c["at"]).alias("dist"), c["id"].alias("centre_id"))))


def assign_centre(points: DataFrame, key: str, vector: str, centres: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, key, centre_id, dist): the centre nearest to every point; ties go to the lowest centre.

    The choice is made inside each row, so points are not shuffled; only beyond ``CENTRE_BLOCK`` centres do the best
    of the blocks meet, one row a point and block.
    """
    blocked = _with_blocks(points, centres, label)
    best = blocked.select(*by, key, nearest_of(F.col(vector), F.col("__centres")).alias("best"))
    if centres.count() > CENTRE_BLOCK:
        best = best.groupBy(*by, key).agg(F.min("best").alias("best"))
    return best.select(*by, key, F.col("best.centre_id").alias("centre_id"), F.col("best.dist").alias("dist"))


def nearest_to_centres(distances: DataFrame, key: str, k: int, by: Sequence[str] = ()) -> DataFrame:
    """The k points nearest to every centre; Spark cuts to k per task before the shuffle."""
    order = Window.partitionBy(*by, "centre_id").orderBy("dist", key)
    return distances.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest_centre(distances: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """The centre nearest to every point; ties go to the lowest centre."""
    return distances.groupBy(*by, key).agg(
        F.min(F.struct("dist", "centre_id")).alias("best")
    ).select(*by, key, F.col("best.centre_id").alias("centre_id"), F.col("best.dist").alias("dist"))


def cluster_radius(members: DataFrame, label: str, vector: str, centres: DataFrame, dims: int | None = None) -> DataFrame:
    """Largest distance of a member to the centre of its cluster, on the first ``dims`` features."""
    part = (lambda c: F.slice(c, 1, dims)) if dims else (lambda c: c)
    joined = members.join(centres.select(label, "centre"), label)
    return joined.groupBy(label).agg(F.max(distance(part(F.col(vector)), part(F.col("centre")))).alias("radius"))


def vector_widths(df: DataFrame, vector: str) -> DataFrame:
    """Number of rows per vector length; one row means that all agree."""
    return df.groupBy(F.size(vector).alias("width")).agg(F.count("*").alias("n"))


def _norms(rows: np.ndarray, at: np.ndarray, p: float) -> np.ndarray:
    gaps = np.abs(rows - at)
    if p == 2:
        return np.sqrt((gaps * gaps).sum(axis=1))
    if np.isinf(p):
        return gaps.max(axis=1)
    return (gaps**p).sum(axis=1) ** (1.0 / p)


def _to_pivots(vectors: pd.Series, pivots: np.ndarray, p: float) -> np.ndarray:
    rows = np.stack(vectors.to_numpy()).astype(float)
    return np.stack([_norms(rows, c, p) for c in pivots], axis=1)


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """The vectors as rows, in their own number type; a null component is not a number."""
    if vectors.null_count:
        raise ValueError("a vector is null")
    flat = pa.concat_arrays([c.flatten() for c in vectors.chunks])
    return flat.to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def _pair_distances(rows: np.ndarray, asked: np.ndarray, r: np.ndarray, q: np.ndarray, p: float) -> np.ndarray:
    """Distance of row ``r`` to query ``q`` for every pair, in double precision."""
    slabs = [slice(i, i + PAIR_SLAB) for i in range(0, len(r), PAIR_SLAB)]
    parts = [_norms(rows[r[x]].astype(float), asked[q[x]].astype(float), p) for x in slabs]
    return np.concatenate(parts) if parts else np.zeros(0)


def _rough(asked: np.ndarray, rows: np.ndarray, p: float):
    """(measure, absolute, relative): a quick measure of some queries against a run of rows, which orders rows as their
    distance does but for the two bounds on its rounding, the absolute one for each query."""
    width = rows.shape[1]
    largest = float(max(np.abs(rows).max(initial=0), np.abs(asked).max(initial=0)))
    if not np.isfinite(largest) or largest > 1e100:
        # a row without finite numbers has no order: leave the choice to the exact distances
        return (lambda at, run: np.zeros((len(at), len(rows[run])))), np.zeros(len(asked)), 0.0
    if p == 2:
        # distances do not depend on the origin, and their rounding is least around the mean
        mean = rows.mean(axis=0, dtype=float)
        own, squares = np.empty(len(asked)), np.empty(len(rows))
        for source, target in ((asked, own), (rows, squares)):
            for i in range(0, len(source), PAIR_SLAB):
                part = source[i : i + PAIR_SLAB] - mean
                target[i : i + PAIR_SLAB] = (part * part).sum(axis=1)
        top = max(own.max(initial=0), squares.max(initial=0))
        kind = np.float32 if 1e-25 < top < 1e25 else np.float64
        # a row's square is one more component, met by a one: the product is the measure
        a, b = (_moved(x, mean, kind) for x in (asked, rows))
        a[:, :width] *= kind(-2)
        a[:, width], b[:, width] = 1, squares
        room = np.empty(QUERY_CHUNK * ROW_CHUNK, dtype=kind)

        def by_product(at: np.ndarray, run: slice) -> np.ndarray:
            theirs = b[run]
            return np.matmul(a[at], theirs.T, out=room[: len(at) * len(theirs)].reshape(len(at), len(theirs)))

        return by_product, 4 * (width + 16) * float(np.finfo(kind).eps) * (own + top), 0.0
    if (p == 1 or np.isinf(p)) and (levels := _levels(asked, rows, p)):
        low, step = levels
        c, d = (_in_levels(x, low, step) for x in (asked, rows))

        def by_level(at: np.ndarray, run: slice) -> np.ndarray:
            theirs = d[:, run]
            found = np.empty((len(at), theirs.shape[1]), dtype=np.float32)
            for i in range(0, len(at), LEVEL_TILE):
                ours = c[:, at[i : i + LEVEL_TILE]]
                total = np.zeros((ours.shape[1], theirs.shape[1]), dtype=np.uint16)
                gap = np.empty(total.shape, dtype=np.int16)
                for x, y in zip(ours, theirs):
                    np.subtract(x[:, None], y[None, :], out=gap)
                    np.abs(gap, out=gap)
                    (np.add if p == 1 else np.maximum)(total, gap.view(np.uint16), out=total)
                found[i : i + LEVEL_TILE] = total
            return found

        # two components are off by half a level each, and so are those of the k-th nearest row
        return by_level, np.full(len(asked), 2.02 * (width if p == 1 else 1)), 0.0
    kind = np.float32 if asked.dtype == rows.dtype == np.float32 and (p == 1 or np.isinf(p)) and largest < 1e30 else np.float64
    a, b = np.ascontiguousarray(asked.T, dtype=kind), np.ascontiguousarray(rows.T, dtype=kind)

    def by_sum(at: np.ndarray, run: slice) -> np.ndarray:
        theirs = b[:, run]
        found = np.zeros((len(at), theirs.shape[1]), dtype=kind)
        for i in range(0, len(at), 32):  # tiles that stay in a core's cache
            ours = a[:, at[i : i + 32]]
            for j in range(0, theirs.shape[1], 2048):
                total = found[i : i + 32, j : j + 2048]
                gap = np.empty(total.shape, dtype=kind)
                for x, y in zip(ours, theirs[:, j : j + 2048]):
                    np.subtract(x[:, None], y[None, :], out=gap)
                    np.abs(gap, out=gap)
                    if np.isinf(p):
                        np.maximum(total, gap, out=total)
                    else:
                        total += gap if p == 1 else gap**p
        return found

    return by_sum, np.zeros(len(asked)), 4 * (width + 16) * (1 if np.isinf(p) else max(p, 1)) * float(np.finfo(kind).eps)


def _levels(asked: np.ndarray, rows: np.ndarray, p: float) -> tuple[float, float] | None:
    """(lowest component, width of a level) to measure in whole numbers of 16 bits; None where levels would be too coarse.

    A sum over all components must fit; the bound on what levels leave open must be small beside the usual distances.
    """
    width, filled = rows.shape[1], [x for x in (asked, rows) if x.size]
    most = 32_767 if np.isinf(p) else min(32_767, 65_535 // max(width, 1))
    if len(filled) < 2 or not most:
        return None
    low, high = float(min(x.min() for x in filled)), float(max(x.max() for x in filled))
    step = (high - low) / most
    some, others = (x[:: -(-len(x) // 64)].astype(float) for x in (asked, rows))
    usual = float(np.median(np.concatenate([_norms(others, q, p) for q in some])))
    coarse = 2.02 * step * (width if p == 1 else 1)
    return (low, step) if 1e-100 < coarse <= usual * COARSE else None


def _in_levels(x: np.ndarray, low: float, step: float) -> np.ndarray:
    """The components, a row each, as numbers of levels."""
    out = np.empty((x.shape[1], len(x)), dtype=np.int16)
    for i in range(0, len(x), PAIR_SLAB):
        out[:, i : i + PAIR_SLAB] = np.rint((x[i : i + PAIR_SLAB].astype(float) - low) / step).T
    return out


def _moved(x: np.ndarray, mean: np.ndarray, kind) -> np.ndarray:
    """The vectors moved by ``mean``, with room for one more component."""
    out = np.empty((len(x), x.shape[1] + 1), dtype=kind)
    for i in range(0, len(x), PAIR_SLAB):
        out[i : i + PAIR_SLAB, :-1] = x[i : i + PAIR_SLAB] - mean
    return out


def _first(q: np.ndarray, r: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The first ``k`` pairs of every query by distance, ties by row, and their ranks from 1."""
    order = np.lexsort((r, d, q))
    q, r, d = q[order], r[order], d[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    kept = rank < k
    return q[kept], r[kept], d[kept], rank[kept] + 1


def _nearest(
    asked: np.ndarray, rows: np.ndarray, k: int, p: float, asked_part: np.ndarray | None = None, part: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, ...]]:
    """(query, row, distance, rank) of the k nearest rows of each query, ties to the lower row; parts never meet themselves.

    Runs of rows are measured quickly, and whatever the rounding leaves among the k nearest is measured exactly. Memory is
    bounded by the chunks, also where all rows are equally near.
    """
    rough, absolute, relative = _rough(asked, rows, p)
    most = np.finfo(float).max
    groups = [np.arange(len(asked))] if part is None else [np.flatnonzero(asked_part == x) for x in np.unique(asked_part)]
    for at in (g[i : i + QUERY_CHUNK] for g in groups for i in range(0, len(g), QUERY_CHUNK)):
        limit = np.full(len(at), most)
        best = np.full((len(at), k), np.inf)
        settled = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)]
        pending: list[tuple[np.ndarray, ...]] = []

        def near(pending: list) -> tuple[np.ndarray, ...]:
            q, r, value = (np.concatenate(x) for x in zip(*pending))
            kept = value <= limit[q]
            return q[kept], r[kept], value[kept]

        def settle(pending: list) -> list[np.ndarray]:
            q, r, _ = near(pending)
            d = _pair_distances(rows, asked, r, at[q], p)
            return list(_first(*(np.concatenate(x) for x in zip(settled, (q, r, d))), k)[:3])

        for start in range(0, len(rows), ROW_CHUNK):
            run = slice(start, start + ROW_CHUNK)
            value = rough(at, run)
            if part is not None:
                value[:, part[run] == asked_part[at[0]]] = np.inf
            wide = value.shape[1]
            if not start and wide > k:
                best = np.partition(value, k - 1, axis=1)[:, :k].astype(float)
                limit = np.minimum(best[:, k - 1] * (1 + relative) + absolute[at], most)
            bound = _up(limit) if value.dtype == np.float32 else limit
            hits = np.flatnonzero((value <= bound[:, None]).ravel())
            q, value = hits // wide, value.ravel()[hits].astype(float)
            if len(hits) and (start or wide <= k):
                place = np.arange(len(hits)) - np.searchsorted(q, q)
                more = np.full((len(at), place.max() + 1), np.inf)
                more[q, place] = value
                best = np.partition(np.concatenate([best, more], axis=1), k - 1, axis=1)[:, :k]
                limit = np.minimum(best[:, k - 1] * (1 + relative) + absolute[at], most)
            pending.append((q, hits % wide + start, value))
            if sum(len(x[0]) for x in pending) > PENDING:
                pending = [near(pending)]
                if len(pending[0][0]) > PENDING // 2:
                    settled, pending = settle(pending), []
        if pending:
            settled = settle(pending)
        q, r, d, rank = _first(*settled, k)
        yield at[q], r, d, rank


def _up(limit: np.ndarray) -> np.ndarray:
    """Limits in single precision, none below its own; infinity stays out."""
    top = np.finfo(np.float32).max
    return np.minimum(np.nextafter(np.minimum(limit, top).astype(np.float32), np.float32(np.inf)), top)


def nearest_neighbours(
    queries: DataFrame,
    points: DataFrame,
    k: int,
    query_key: str,
    point_key: str,
    vector: str,
    carry: Sequence[str] = (),
    by: str | None = None,
    p: float = 2,
    pivots: int | None = None,
    block: int | None = None,
    seed: int = 11,
    apart: str | None = None,
) -> DataFrame:
    """The exact k nearest points of every query: (by, query, point, dist, rank, carried columns).

    With ``by``, a query sees only the points with its value of that column, as in runs; with ``apart``, only those with
    another value of that column, as in folds, whose points then travel once and not once a fold. Rows without a value of
    these columns take no part.

    By default there is a pivot per ``PER_PIVOT`` points, within ``FEWEST`` and ``MOST`` pivots. Where their bounds would
    not halve the pairs, as in many dimensions, and with ``apart``, points are not copied to cells. A task
    meets two blocks, by default of at most ``BLOCK_BYTES`` of vectors, so a row is copied to few tasks.
    """
    spark = queries.sparkSession
    for c in (by, apart):
        if c:
            queries, points = queries.filter(F.col(c).isNotNull()), points.filter(F.col(c).isNotNull())
    by_col, part_col = (F.col(c) if c else F.lit(0) for c in (by, apart))
    q = queries.select(by_col.alias("by"), F.col(query_key).alias("query"), F.col(vector).alias("v"), part_col.alias("part"))
    s = points.select(
        by_col.alias("by"), F.col(point_key).alias("point"), F.col(vector).alias("v"), part_col.alias("part"),
        F.struct(F.lit(0).alias("none"), *carry).alias("carried"),
    )
    n_points = {r.by: r.n for r in s.groupBy("by").agg(F.count("*").alias("n")).collect()}
    if not n_points:
        raise ValueError("no points to search")
    n_queries = {r.by: r.n for r in q.groupBy("by").agg(F.count("*").alias("n")).collect()}
    width = s.select(F.size("v")).first()[0]
    cells = None if apart else _cells(q, s, k, p, pivots or min(MOST, max(FEWEST, sum(n_points.values()) // PER_PIVOT)), seed)
    if cells and sum(nq * ns for _, _, nq, ns in cells[2]) * 2 <= sum(n * n_points.get(g, 0) for g, n in n_queries.items()):
        home, copies, sizes = cells
        q, s = home(q), copies(s)
    else:
        q, s = (d.withColumn("cell", F.lit(0)) for d in (q, s))
        sizes = [(g, 0, n, n_points[g]) for g, n in n_queries.items() if g in n_points]
    most_points = block or max(1, BLOCK_BYTES // (8 * max(width, 1)))
    most_queries = block or max(1, min(most_points // 4, BLOCK_BYTES // (32 * k)))
    pairs = max(1, sum(nq * ns for _, _, nq, ns in sizes))
    tasks, row, found = 3 * spark.sparkContext.defaultParallelism, 8 * width + 50, 80 * k  # bytes of a row and of what it finds
    dealt, first, sent = [], 0, 0
    for g, cell, nq, ns in sizes:
        # enough blocks for all cores, in the shape that sends the fewest bytes, but none of a few rows only
        share = max(1, tasks * nq * ns // pairs)
        even = int((share * ns * row / (max(nq, 1) * (row + found))) ** 0.5)
        pbs = max(1, -(-ns // most_points), min(even, ns // 500))
        qbs = max(1, -(-nq // most_queries), min(-(-share // pbs), nq // 500))
        dealt.append((g, cell, qbs, pbs, first))
        first, sent = first + qbs * pbs, sent + (nq * pbs + ns * qbs) * row
    by_type = q.schema["by"].dataType
    sizes = spark.createDataFrame(dealt, f"by {by_type.simpleString()}, cell int, qbs int, pbs int, first bigint")
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    block_pair = (F.col("first") + F.col("qb").cast("bigint") * F.col("pbs") + F.col("pb")).alias("pair")
    left = (
        q.join(F.broadcast(sizes), ["by", "cell"])
        .withColumn("qb", F.pmod(F.xxhash64("query"), F.col("qbs")).cast("int"))
        .select("*", upto("pbs").alias("pb"))
        .select(block_pair, "by", "query", "v", "part")
    )
    right = (
        s.join(F.broadcast(sizes), ["by", "cell"])
        .withColumn("pb", F.pmod(F.xxhash64("point"), F.col("pbs")).cast("int"))
        .select("*", upto("qbs").alias("qb"))
        .select(block_pair, "point", "v", "part", "carried")
    )
    out = T.StructType(
        [
            T.StructField("by", by_type),
            T.StructField("query", q.schema["query"].dataType),
            T.StructField("point", s.schema["point"].dataType),
            T.StructField("dist", T.DoubleType()),
            T.StructField("rank", T.IntegerType()),
            s.schema["carried"],
        ]
    )

    def best_of_block(a: pa.Table, b: pa.Table) -> pa.Table:
        names = [f.name for f in out]
        if not a.num_rows or not b.num_rows:
            both = {**{c: a[c] for c in ("by", "query")}, **{c: b[c] for c in ("point", "carried")}}
            both |= {"dist": pa.array([], pa.float64()), "rank": pa.array([], pa.int32())}
            return pa.table({c: both[c].slice(0, 0) for c in names})
        order = pc.sort_indices(b["point"])
        rows = _matrix(b["v"])[order.to_numpy()]
        kept = b.select(["point", "carried"]).take(order).combine_chunks()
        parts = (a["part"].to_numpy(), b["part"].to_numpy()[order.to_numpy()]) if apart else (None, None)
        asked = a.select(["by", "query"]).combine_chunks()
        found = [np.concatenate(x) for x in zip(*_nearest(_matrix(a["v"]), rows, k, p, *parts))]
        mine, theirs = asked.take(pa.array(found[0])), kept.take(pa.array(found[1]))
        both = {**{c: mine[c] for c in ("by", "query")}, **{c: theirs[c] for c in ("point", "carried")}}
        both |= {"dist": pa.array(found[2], pa.float64()), "rank": pa.array(found[3], pa.int32())}
        return pa.table({c: both[c] for c in names})

    # the work of two blocks is their pairs and not their bytes, by which Spark would put many into one task
    parts = max(1, min(4 * first, 4 * tasks), sent // BLOCK_BYTES)
    left, right = (d.repartition(parts, "pair").groupBy("pair") for d in (left, right))
    ranked = left.cogroup(right).applyInArrow(best_of_block, out)
    if any(pbs > 1 for *_, pbs, _ in dealt):
        order = Window.partitionBy("by", "query").orderBy("dist", "point")
        ranked = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(
        *([F.col("by").alias(by)] if by else []), "query", "point", "dist", "rank", *[f"carried.{c}" for c in carry]
    )


def _cells(q: DataFrame, s: DataFrame, k: int, p: float, pivots: int, seed: int):
    """(queries with their cell, points with a copy for every cell they matter to, (by, cell, queries, copies) of all cells)."""
    chosen = s.select("point").distinct().orderBy(uniform(seed, "point"), "point").limit(pivots)
    # bounded: one vector a pivot
    found = s.join(F.broadcast(chosen), "point").groupBy("point").agg(F.first("v").alias("v")).collect()
    at = np.array([r.v for r in found], dtype=float)
    by_name = q.schema["by"].dataType.simpleString()

    @F.pandas_udf("struct<cell:int,gap:double>")
    def home(v: pd.Series) -> pd.DataFrame:
        d = _to_pivots(v, at, p)
        cell = d.argmin(axis=1)
        return pd.DataFrame({"cell": cell.astype("int32"), "gap": d[np.arange(len(d)), cell]})

    at_home = lambda d: d.withColumn("h", home("v")).select(*d.columns, "h.cell", "h.gap")

    def smallest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # the k smallest distances of this task to every pivot
        best: dict[int, np.ndarray] = {}
        for batch in batches:
            d = _to_pivots(batch["v"], at, p)
            for g in batch["by"].unique():
                mine = d[(batch["by"] == g).to_numpy()]
                seen = np.concatenate([best[g], mine]) if g in best else mine
                best[g] = np.sort(seen, axis=0)[:k]
        for g, rows in best.items():
            n = len(rows)
            yield pd.DataFrame(
                {"by": g, "cell": np.tile(np.arange(len(at)), n).astype("int32"), "gap": rows.reshape(-1)}
            )

    near = s.select("by", "v").mapInPandas(smallest, f"by {by_name}, cell int, gap double")
    order = Window.partitionBy("by", "cell").orderBy("gap")
    reach = (
        near.withColumn("r", F.row_number().over(order))
        .filter(F.col("r") <= k)
        .groupBy("by", "cell")
        .agg(F.max("gap").alias("kth"), F.count("*").alias("found"))
    )
    radius = at_home(q.select("by", "v")).groupBy("by", "cell").agg(F.max("gap").alias("radius"), F.count("*").alias("nq"))
    # bounded: pivots x groups. A query of the cell has its k-th neighbour within radius + kth of
    # itself, so only points within 2 radius + kth of the pivot can matter.
    limits = [
        (r.by, r.cell, r.nq, (2 * r.radius + r.kth) * (1 + 1e-9) if r.found >= k else float("inf"))
        for r in radius.join(reach, ["by", "cell"]).collect()
    ]
    needed: dict[int, list[tuple[int, float]]] = {}
    for g, cell, _, limit in limits:
        needed.setdefault(g, []).append((cell, limit))

    def copies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            d = _to_pivots(batch["v"], at, p)
            for g in batch["by"].unique():
                mine = (batch["by"] == g).to_numpy()
                for cell, limit in needed.get(g, ()):
                    rows = batch[mine & ~(d[:, cell] > limit)]
                    if len(rows):
                        yield rows.assign(cell=cell)

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            d = _to_pivots(batch["v"], at, p)
            for g in batch["by"].unique():
                mine = (batch["by"] == g).to_numpy()
                counts = [(g, cell, int((mine & ~(d[:, cell] > limit)).sum())) for cell, limit in needed.get(g, ())]
                yield pd.DataFrame(counts, columns=["by", "cell", "n"])

    counted = s.select("by", "v").mapInPandas(tally, f"by {by_name}, cell int, n long").groupBy("by", "cell").agg(F.sum("n").alias("n"))
    counts = {(r.by, r.cell): r.n for r in counted.collect()}
    spread = lambda d: d.mapInPandas(copies, T.StructType([*d.schema.fields, T.StructField("cell", T.IntegerType())]))
    return at_home, spread, [(g, c, nq, counts.get((g, c), 0)) for g, c, nq, _ in limits]


def vote(neighbours: DataFrame, label: str, by: Sequence[str] = (), weights: str = "distance") -> DataFrame:
    """Label per query by its neighbours, weighted by 1/distance; exact hits take the whole vote.

    A query has at most k neighbours. Ties go to the smallest label.
    """
    w = F.when(F.col("dist") == 0, F.lit(1.0)).otherwise(1.0 / F.col("dist"))
    if weights == "uniform":
        w = F.lit(1.0)
    votes = neighbours.groupBy(*by, "query", label).agg(
        F.count_if(F.col("dist") == 0).alias("hits"), F.sum(w).alias("weight")
    )
    hits = F.lit(0) if weights == "uniform" else F.col("hits")
    return votes.groupBy(*by, "query").agg(
        F.max_by(label, F.struct(hits.alias("hits"), F.round("weight", 9).alias("w"), (-F.col(label)).alias("tie"))).alias(
            "predicted"
        )
    )
