"""Nearest vectors by a permutation index.

A vector is represented by its nearest pivots in order.  Every block of vectors posts its members in the inverted
files of these pivots, with the rank.  A query walks the files of its own nearest pivots and adds up, for
each member met, how far the two orders agree: the footrule distance of the orders, less a constant.  The best share of
a block, with all that tie with the last of them, is ranked again by cosine in double precision, and the best of all
blocks are the answer.  Equal vectors of a block are one member, which stands for its smallest ids; the sum of a cosine
does not depend on the place of a row, so that copies in several blocks tie.

Queries and blocks meet as a stated set of queries against all rows, in blocks of bounded size: each task holds one
block of vectors and one of queries, whatever the data.  Pivots are different vectors of a sample of rows chosen by a hash.

Defined cases: vectors that are null, zero, or hold a null or non-finite component take no part; neither do pairs of
different width; rows with the query's own id are not its candidates, and rows that repeat another id are candidates
each; ties go to the smaller id; fewer candidates than asked for are all returned; a vector without an id takes no
part; other columns play no part; empty tables give an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from corvane.lineage import cut

FOUND = "query_id long, vec_id long, score double"


def usable(vector: str) -> Column:
    return F.expr(
        f"{vector} is not null and not exists({vector}, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists({vector}, x -> x <> 0)"
    )


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.combine_chunks()
    return rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def permutations(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest pivots of each vector, nearest first."""
    near = _unit(vectors) @ pivots.T
    some = np.argpartition(-near, prefix - 1, axis=1)[:, :prefix]
    order = np.argsort(-np.take_along_axis(near, some, axis=1), axis=1, kind="stable")
    return np.take_along_axis(some, order, axis=1)


def equal_vectors(ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row of each distinct vector, offsets, and the ids by offset: enough for the k smallest besides any one id."""
    rows = np.ascontiguousarray(vectors + 0.0)  # no negative zeros
    _, first, own = np.unique(rows.view(np.dtype((np.void, rows.itemsize * rows.shape[1]))).ravel(), return_index=True, return_inverse=True)

    def counted(own: np.ndarray, ids: np.ndarray | None) -> np.ndarray:
        new = np.ones(len(own), dtype=bool)
        new[1:] = own[1:] != own[:-1]
        if ids is not None:
            new[1:] |= ids[1:] != ids[:-1]
        return np.arange(len(own)) - np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))

    order = np.lexsort((ids, own))
    own, ids = own[order], ids[order]
    few = counted(own, ids) < k
    own, ids = own[few], ids[few]
    least = counted(own, None) < 2 * k
    return first, np.searchsorted(own[least], np.arange(len(first) + 1)), ids[least]


def search_block(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, pivots: np.ndarray, prefix: int, share: float, k: int
) -> list[tuple[int, int, float]]:
    """(query, vector, cosine) of the k nearest candidates that each query finds in a block."""
    first, begin_class, class_ids = equal_vectors(ids, vectors, k)
    vectors = vectors[first]
    prefix = min(prefix, len(pivots))
    order = permutations(vectors, pivots, prefix).ravel()
    posted = np.argsort(order, kind="stable")
    begin = np.searchsorted(order[posted], np.arange(len(pivots) + 1))
    member, rank = posted // prefix, posted % prefix
    most = min(len(vectors), max(16 * k, math.ceil(share * len(ids))))
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    out = []
    for query, vector, own in zip(query_ids, queries, permutations(queries, pivots, prefix), strict=True):
        agreed = np.zeros(len(vectors))
        for r, pivot in enumerate(own):
            file = slice(begin[pivot], begin[pivot + 1])
            agreed[member[file]] += prefix - np.maximum(rank[file], r)
        at = np.flatnonzero(agreed >= np.partition(agreed, -most)[-most])
        cosine = (vectors[at] * vector).sum(axis=1) / (norms[at] * math.sqrt((vector * vector).sum()))
        some = np.argsort(-cosine, kind="stable")
        # the k+1 best members hold k candidates besides the query's own; more only where others tie with the last
        some = some[: k + 1] if len(some) <= k + 1 else some[cosine[some] >= cosine[some[k]]]
        named = [class_ids[begin_class[c] : begin_class[c + 1]] for c in at[some]]
        near, score = np.concatenate(named), np.repeat(cosine[some], [len(x) for x in named])
        near, score = near[near != query], score[near != query]
        out += [(int(query), int(near[i]), float(score[i])) for i in np.lexsort((near, -score))[:k]]
    return out


def nearest(
    vectors: DataFrame,
    is_query: Column,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    pivots: int = 256,
    prefix: int = 128,
    share: float = 0.12,
    block: int = 8192,
    query_block: int = 1024,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of each row that ``is_query``, a condition on ``vec_id``."""
    rows = cut(
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
        .where(usable("v") & F.col("vec_id").isNotNull()).withColumn("width", F.size("v")),
        "vectors",
    )
    def search_with(anchors: np.ndarray):
        def search(left: pa.Table, right: pa.Table) -> pa.Table:
            hits = []
            if len(left) and len(right):
                sides = [x for t in (left, right) for x in (t["vec_id"].to_numpy(), _matrix(t["v"]))]
                hits = search_block(*sides, anchors, prefix, share, k)
            columns = list(zip(*hits, strict=True)) if hits else [(), (), ()]
            types = [pa.int64(), pa.int64(), pa.float64()]
            return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["query_id", "vec_id", "score"])

        return search

    found = None
    for width, n, n_queries in rows.groupBy("width").agg(F.count(F.lit(1)), F.count_if(is_query)).orderBy("width").collect():
        own = rows.where(F.col("width") == width)
        chosen = own.orderBy(F.xxhash64("vec_id"), "vec_id").limit(4 * pivots).collect()
        distinct = list(dict.fromkeys(tuple(r.v) for r in chosen))[:pivots]
        anchors = _unit(np.array(distinct, dtype=np.float64))
        blocks, teams = math.ceil(n / block), max(1, math.ceil(n_queries / query_block))

        dealt = lambda m: F.pmod(F.xxhash64("vec_id"), F.lit(m)).cast("int")
        every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
        left = own.select("vec_id", "v", dealt(blocks).alias("block"), every(teams).alias("team"))
        right = own.where(is_query).select("vec_id", "v", dealt(teams).alias("team"), every(blocks).alias("block")).select("vec_id", "v", "block", "team")
        hits = left.groupBy("block", "team").cogroup(right.groupBy("block", "team")).applyInArrow(search_with(anchors), FOUND)
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
