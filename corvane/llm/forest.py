"""Near-duplicate documents by an LSH forest over MinHash signatures, confirmed on the full shingle sets.

A document is the set of its five-word shingles.  Equal sets are one class.  Each class has 64 minimum hashes; a
tree of the forest is one order of the classes by eight of them.  In every order a class is compared, on its whole
signature, with the classes before it that share the first two hashes, nearest first, so up to ``reach`` longest
common prefixes: where a region is dense these are deeper ones.  Estimates above a mark 4.5 standard errors below the
threshold become candidates, and candidates become links only on the full sets of both texts.

In a dense region each class proposes its ``best`` candidates of each order.  Once these are confirmed and joined into
components, the orders of such regions are run once more for all pairs across components, so the proposals left out
the first time lose nothing.  Sets that share a long passage but are no near duplicates crowd there too, so this pass
compares signatures of 1,536 hashes, whose mark lies five times as near to the threshold, and proposes and moves texts for fewer pairs.

Orders are range-partitioned by their full keys, so a region with a third of all rows is spread over tasks, and the
ends of neighbouring partitions are compared in a second step.

Defined cases: a null text, or one without words, has an empty set and no links; fewer words than a shingle are one
shingle; rows that repeat an id share its component, as if linked; a row without an id has no component and is kept;
other columns play no part; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from corvane.lineage import cut
from corvane.llm.components import across, extend, follow
from corvane.llm.memory import lean
from corvane.llm.wordhash import LOWER, mix, text_slices, windows, word_bounds, word_hashes

HASHES = 64
LONG_HASHES, FIRST_HASHES = 1536, 384  # of the sets in dense regions; those compared before the others
TREES = 16
ARITY = 4  # hashes a tree moves on from its predecessor
DEPTH = 8
SEEDS = mix(np.arange(1, LONG_HASHES + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
FACTORS = mix(SEEDS, 0x165667B1) | np.uint64(1)
SIGNED = "doc_id long, n_shingles long, low long, high long, keys binary, signature binary"
KEY = f"substring(keys, {2 * ARITY} * tree + 1, {2 * DEPTH})"
PROPOSED = "a long, b long, alike int, crowded boolean, tree int, region binary, edge int, row binary"


def shingle_sets(column: pa.Array, words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, distinct shingles, row offsets into them), sorted within each row."""
    for first, last, data, offsets in text_slices(column):
        data = LOWER[data]
        starts, ends, first_word = word_bounds(data, offsets)
        hashes = word_hashes(data, starts, ends)
        per_row = np.diff(first_word)
        values, rows = [windows(hashes, words)], [np.repeat(np.arange(last - first), per_row)[: max(len(hashes) - words + 1, 0)]]
        inside = np.arange(len(values[0])) + words <= first_word[1:][rows[0]]
        values[0], rows[0] = values[0][inside], rows[0][inside]
        for n in range(1, words):
            short = np.flatnonzero(per_row == n)
            if len(short):
                values.append(windows(hashes, n)[first_word[short]])
                rows.append(short)
        value, row = np.concatenate(values), np.concatenate(rows)
        order = np.lexsort((value, row))
        value, row = value[order], row[order]
        new = np.ones(len(value), dtype=bool)
        new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
        value, row = value[new], row[new]
        yield first, last, value, np.searchsorted(row, np.arange(last - first + 1))


def least_hashes(value: np.ndarray, at: np.ndarray, hashes: int) -> np.ndarray:
    """The 16-bit minimum hashes of each set of ``value`` that starts at ``at``."""
    least = np.zeros((len(at), hashes), dtype=np.uint64)
    if len(at):
        for k in range(hashes):
            least[:, k] = np.minimum.reduceat((value ^ SEEDS[k]) * FACTORS[k], at)
    return (mix(least) >> np.uint64(48)).astype(">u2")


def sign_long(batch: pa.RecordBatch, words: int) -> pa.RecordBatch:
    """(cls, signature) of ``LONG_HASHES`` hashes for texts (cls, text) with words."""
    signatures = []
    for _, _, value, offsets in shingle_sets(batch.column(1), words):
        signatures += [x.tobytes() for x in (least_hashes(value, offsets[:-1], LONG_HASHES) & 255).astype(np.uint8)]
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(signatures, pa.binary())], names=["cls", "signature"])


def mark(hashes: int, similar: float) -> int:
    """The equal hashes that a pair at the threshold falls short of with a probability of 3e-6."""
    return int(hashes * (similar - 4.5 * (similar * (1 - similar) / hashes) ** 0.5))


def sign(batch: pa.RecordBatch, words: int) -> pa.RecordBatch:
    sizes, low, high, keys, signatures = [], [], [], [], []
    for _, _, value, offsets in shingle_sets(batch.column(1), words):
        n = np.diff(offsets)
        full = n > 0
        at = offsets[:-1][full]
        totals = np.zeros((2, len(n)), dtype=np.uint64)
        if len(at):
            for k in range(2):
                totals[k, full] = np.add.reduceat(mix(value, 0x9E37 + k), at)
        short = least_hashes(value, at, HASHES)
        wide = np.concatenate([short, short[:, : DEPTH * 2]], axis=1)
        sizes.append(n)
        low.append(totals[0].view(np.int64))
        high.append(totals[1].view(np.int64))
        for out, rows in ((keys, wide), (signatures, (short & 255).astype(np.uint8))):
            found = iter(rows)
            out += [next(found).tobytes() if x else None for x in full]
    join = lambda x: np.concatenate(x) if x else np.zeros(0, dtype=np.int64)
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0), *[pa.array(join(x), pa.int64()) for x in (sizes, low, high)],
            pa.array(keys, pa.binary()), pa.array(signatures, pa.binary()),
        ],
        names=["doc_id", "n_shingles", "low", "high", "keys", "signature"],
    )


class Order:
    """Rows of an order: tree, key, class, size, signature, component."""

    def __init__(self, table: pa.Table | pa.RecordBatch) -> None:
        n = table.num_rows
        fixed = lambda c, w: np.frombuffer(b"".join(table[c].to_pylist()), np.uint8).reshape(n, w)
        number = lambda c: np.asarray(table[c])
        self.tree, self.keys = number("tree"), fixed("key", 2 * DEPTH)
        self.cls, self.size, self.component = number("cls"), number("n_shingles"), number("component")
        self.signature = fixed("signature", len(table["signature"][0].as_py()) if n else HASHES)

    def pairs(self, *, reach: int, best: int, similar: float, by_component: bool, old: int = 0):
        """Candidates (later row, earlier row, equal hashes, whether its row has more), for later rows from ``old`` on."""
        region = np.zeros(len(self.tree), dtype=bool)
        region[1:] = (self.tree[1:] == self.tree[:-1]) & (self.keys[1:, :4] == self.keys[:-1, :4]).all(axis=1)
        begin = np.maximum.accumulate(np.where(region, 0, np.arange(len(region))))
        depth = np.arange(len(region)) - begin
        rows, others, alike = [], [], []
        for lag in range(1, reach + 1):
            at = np.flatnonzero(depth >= lag)
            at = at[at >= old]
            if not len(at):
                break
            at = at[self.component[at] != self.component[at - lag]]
            small, large = np.minimum(self.size[at], self.size[at - lag]), np.maximum(self.size[at], self.size[at - lag])
            at = at[small >= similar * large]
            same = np.zeros(len(at), dtype=np.int64)
            for start in range(0, self.signature.shape[1], FIRST_HASHES):
                part = slice(start, start + FIRST_HASHES)
                same += (self.signature[at, part] == self.signature[at - lag, part]).sum(axis=1)
                keep = same >= mark(min(part.stop, self.signature.shape[1]), similar)
                at, same = at[keep], same[keep]
            rows.append(at)
            others.append(at - lag)
            alike.append(same)
        if not rows:
            none = np.zeros(0, dtype=np.int64)
            return none, none, none, none.astype(bool)
        row, other, same = np.concatenate(rows), np.concatenate(others), np.concatenate(alike)
        group = self.component[other] if by_component else np.zeros(len(row), dtype=np.int64)
        order = np.lexsort((other, -same, group, row))
        row, other, same, group = row[order], other[order], same[order], group[order]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (group[1:] != group[:-1])
        rank = np.arange(len(row)) - np.maximum.accumulate(np.where(new, np.arange(len(row)), 0))
        crowded = np.isin(row, row[rank >= best])
        keep = rank < best
        return row[keep], other[keep], same[keep], crowded[keep]


ROWS = ["tree", "key", "cls", "n_shingles", "signature", "component"]


def _proposals(order: Order, found: tuple) -> dict:
    row, other, same, crowded = found
    n = len(row)
    return {
        "a": pa.array(np.minimum(order.cls[row], order.cls[other]), pa.int64()),
        "b": pa.array(np.maximum(order.cls[row], order.cls[other]), pa.int64()),
        "alike": pa.array(same, pa.int32()),
        "crowded": pa.array(crowded, pa.bool_()),
        "tree": pa.array(order.tree[row], pa.int32()),
        "region": pa.array([x.tobytes() for x in order.keys[row, :4]], pa.binary()),
        "edge": pa.nulls(n, pa.int32()),
        "row": pa.nulls(n, pa.binary()),
    }


def _packed(rows: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema) as writer:
        writer.write_table(rows)
    return out.getvalue().to_pybytes()


def every_tree():
    return F.explode(F.array(*[F.lit(t) for t in range(TREES)]))


def propose(classes: DataFrame, rows: int, how: dict) -> DataFrame:
    """Distinct candidate pairs (a, b, alike) with the regions that were crowded; ``classes`` has a row per set."""
    reach = how["reach"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, tail, head = TaskContext.get().partitionId(), None, None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if head is None or len(head) < reach:
                head = rows.slice(0, reach) if head is None else pa.concat_tables([head, rows.slice(0, reach - len(head))])
            old = 0 if tail is None else len(tail)
            rows = rows if tail is None else pa.concat_tables([tail, rows]).combine_chunks()
            order = Order(rows)
            yield pa.RecordBatch.from_pydict(_proposals(order, order.pairs(old=old, **how)))
            tail = rows.slice(max(0, len(rows) - reach))
        if tail is not None:
            none = lambda t: pa.nulls(2, t)
            edges = {"edge": pa.array([number, number + 1], pa.int32()), "row": pa.array([_packed(head), _packed(tail)], pa.binary())}
            kinds = [("a", pa.int64()), ("b", pa.int64()), ("alike", pa.int32()), ("crowded", pa.bool_()), ("tree", pa.int32()), ("region", pa.binary())]
            yield pa.RecordBatch.from_pydict({k: none(t) for k, t in kinds} | edges)

    def stitch(table: pa.Table) -> pa.Table:
        ends = [pa.ipc.open_stream(x.as_buffer()).read_all() for x in table["row"]]
        ends.sort(key=lambda t: (t["tree"][0].as_py(), t["key"][0].as_py(), t["cls"][0].as_py()))
        rows = pa.concat_tables(ends).combine_chunks()
        order = Order(rows)
        found = order.pairs(old=len(ends[0]), **how) if len(ends) == 2 else tuple(np.zeros(0, t) for t in (int, int, int, bool))
        if len(ends) == 2:
            across = found[1] < len(ends[0])
            found = tuple(x[across] for x in found)
        return pa.table(_proposals(order, found))

    order = classes.select("cls", "n_shingles", "signature", "component", "keys", every_tree().alias("tree")).select(
        "tree", F.expr(KEY).alias("key"), *ROWS[2:]
    )
    parts = max(1, TREES * rows // 20_000)
    dealt = order.repartitionByRange(parts, "tree", "key", "cls").sortWithinPartitions("tree", "key", "cls")
    scanned = cut(dealt.mapInArrow(lean(scan), PROPOSED), "proposals")
    stitched = scanned.where("edge is not null").groupBy("edge").applyInArrow(stitch, PROPOSED)
    return scanned.where("edge is null").unionByName(stitched).drop("edge", "row")


def confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; ``texts`` has a text for each class."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for column in (batch.column(2), batch.column(3)):
                sides.append([v[o[i] : o[i + 1]] for _, _, v, o in shingle_sets(column, words) for i in range(len(o) - 1)])
            keep = []
            for one, two in zip(*sides, strict=True):
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= percent * (len(one) + len(two) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda c: texts.select(F.col("cls").alias(c), F.col("text").alias(f"text_{c}"))
    full = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")
    return cut(full.mapInArrow(lean(check), "a long, b long"), "links")


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 75,
    reach: int = 128,
    best: int = 4,
    most_broadcast: int = 500_000,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    The ids of candidates choose the texts to confirm, by a broadcast up to ``most_broadcast`` ids and by a shuffle
    beyond; the result is the same.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = cut(texts.mapInArrow(lean(lambda batches: (sign(b, words) for b in batches)), SIGNED), "signed")
    real = signed.where("n_shingles > 0 and doc_id is not null")
    classes = cut(
        real.groupBy(F.col("low").alias("cls"), "high", "n_shingles")
        .agg(F.min("doc_id").alias("rep"), F.first("keys").alias("keys"), F.first("signature").alias("signature"))
        .withColumn("component", F.col("cls")),
        "classes",
    )
    similar = percent / 100
    how = {"reach": reach, "best": best, "similar": similar, "by_component": False}
    proposed = cut(propose(classes, classes.count(), how), "proposed")
    pairs = cut(proposed.groupBy("a", "b").agg(F.max("alike").alias("alike")), "pairs")

    def ends_of(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()

    def texts_for(wanted: DataFrame) -> DataFrame:
        needed = cut(classes.join(wanted, "cls", "left_semi").select("cls", F.col("rep").alias("doc_id")), "needed")
        ids = needed.select("doc_id")
        side = F.broadcast(ids) if needed.count() <= most_broadcast else ids
        chosen = texts.join(side, "doc_id", "left_semi").select("doc_id", "text")
        # an id may stand at several texts: each goes to the class that its own set names
        named = chosen.mapInArrow(lean(lambda batches: map(name_classes, batches)), "cls long, text string")
        return cut(named.join(needed.select("cls"), "cls", "left_semi").groupBy("cls").agg(F.first("text").alias("text")), "texts")

    def name_classes(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([sign_low(batch.column(1), words), batch.column(1)], names=["cls", "text"])

    same_id = real.groupBy("doc_id").agg(F.min("low").alias("a"), F.max("low").alias("b")).where("a <> b").select("a", "doc_id")
    repeated = same_id.join(real, "doc_id").select("a", F.col("low").alias("b"))

    found = texts_for(ends_of(pairs))
    first = pairs.groupBy("b").agg(F.max_by("a", F.struct("alike", "a")).alias("a")).select("a", "b")
    labels = follow(confirm(first, found, words, percent))
    links = confirm(cut(across(pairs, labels).select("a", "b"), "open"), found, words, percent)
    labels = extend(labels, links.unionByName(repeated))

    regions = cut(proposed.where("crowded").select("tree", "region").distinct(), "regions")
    if not regions.isEmpty():
        member = classes.select("cls", "keys", every_tree().alias("tree")).select("cls", "tree", F.expr(f"substring({KEY}, 1, 4)").alias("region"))
        dense = member.join(regions, ["tree", "region"], "left_semi").select("cls").distinct()
        dense_texts = texts_for(dense)
        longer = dense_texts.mapInArrow(lean(lambda batches: (sign_long(b, words) for b in batches)), "cls long, signature binary")
        rows = cut(
            classes.drop("component", "signature").join(longer, "cls")
            .join(labels.select(F.col("node").alias("cls"), "component"), "cls", "left")
            .withColumn("component", F.coalesce("component", "cls")),
            "dense",
        )
        again = propose(rows, rows.count(), how | {"best": reach, "by_component": True})
        more = cut(again.select("a", "b").distinct().join(pairs, ["a", "b"], "left_anti"), "more")
        if not more.isEmpty():
            labels = extend(labels, confirm(more, dense_texts, words, percent))

    joined = labels.select(F.col("node").alias("cls"), "component")
    root = classes.select("cls", "rep").join(joined, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    smallest = root.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = cut(root.join(smallest, "component").select(F.col("cls").alias("low"), "component_id"), "components")
    linked = signed.select("doc_id", "n_shingles", F.when(F.expr("n_shingles > 0 and doc_id is not null"), F.col("low")).alias("low"))
    return linked.join(of_class, "low", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def sign_low(column: pa.Array, words: int) -> pa.Array:
    """The first half of the sum that names the set of each text."""
    out = []
    for _, _, value, offsets in shingle_sets(column, words):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(value, 0x9E37), dtype=np.uint64)])
        out.append((total[offsets[1:]] - total[offsets[:-1]]).view(np.int64))
    return pa.array(np.concatenate(out) if out else np.zeros(0, dtype=np.int64), pa.int64())


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", most_broadcast: int = 500_000, **options) -> DataFrame:
    """The rows of ``docs`` that are the first of their component, unchanged."""
    found = near_duplicates(docs, id_col=id_col, most_broadcast=most_broadcast, **options)
    gone = cut(found.where("not kept").select("doc_id").distinct(), "gone")
    side = F.broadcast(gone) if gone.count() <= most_broadcast else gone
    return docs.join(side, docs[id_col] == gone["doc_id"], "left_anti")
