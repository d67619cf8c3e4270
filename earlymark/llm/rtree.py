"""Hard negatives from embeddings, by best-first searches over R-trees that are packed by sort-tile-recursive."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, table

#: Rows of one tree, rows of a leaf, and children of a node.
TILE, LEAF, FAN = 16_384, 128, 16
#: Anchors that travel as one row, and rows of anchors that meet a tree in one task.
BLOCK, BLOCKS = 128, 16

PACKED = "ids binary, labels binary, v binary, d int, more binary"


class Tree:
    """An R-tree over the rows of one tile, in arrays: level 0 are the leaves, each of one label.

    A node has the bounds of each coordinate, the smallest id and the first and last label below it.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray):
        order, sizes = [], []
        for label in np.unique(labels):
            for leaf in packed_leaves(v, np.flatnonzero(labels == label)):
                order.append(leaf)
                sizes.append(len(leaf))
        order = np.concatenate(order)
        self.ids, self.v = ids[order], np.ascontiguousarray(v[order])
        self.ends = np.cumsum(sizes)
        first = self.ends - sizes
        level = {"low": np.minimum.reduceat(self.v, first), "high": np.maximum.reduceat(self.v, first), "least": np.minimum.reduceat(self.ids, first), "from": labels[order][first], "to": labels[order][first]}
        self.levels = [level]
        while len(level["least"]) > 1:
            at = np.arange(0, len(level["least"]), FAN)
            level = {"low": np.minimum.reduceat(level["low"], at), "high": np.maximum.reduceat(level["high"], at), "least": np.minimum.reduceat(level["least"], at), "from": np.minimum.reduceat(level["from"], at), "to": np.maximum.reduceat(level["to"], at)}
            self.levels.append(level)

    def leaf(self, k: int) -> slice:
        return slice(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


def packed_leaves(v: np.ndarray, rows: np.ndarray) -> Iterator[np.ndarray]:
    """rows in leaves of at most LEAF, by sort-tile-recursive: sorted by one coordinate, cut into slices, each slice by the next one; the widest first."""
    spread = np.argsort(-(v[rows].max(axis=0) - v[rows].min(axis=0)), kind="stable") if v.shape[1] else np.zeros(0, np.int64)
    todo = [(rows, 0)]
    while todo:
        own, k = todo.pop()
        leaves = -(-len(own) // LEAF)
        if leaves == 1:
            yield own
            continue
        if k >= len(spread):
            yield from np.array_split(own, leaves)
            continue
        slices = max(2, int(np.ceil(leaves ** (1 / (len(spread) - k)))))
        own = own[np.argsort(v[own, spread[k]], kind="stable")]
        step = -(-leaves // slices) * LEAF
        todo += [(own[low : low + step], k + 1) for low in range(0, len(own), step)]


class Search:
    """Searches of one anchor in one tree; scores of a leaf are computed once."""

    def __init__(self, tree: Tree, anchor: int, label: int, q: np.ndarray):
        self.tree, self.anchor, self.label, self.q = tree, anchor, label, q
        self.plus, self.minus = np.maximum(q, 0), np.minimum(q, 0)
        self.scores: dict[int, np.ndarray] = {}
        self.bounds: dict[tuple[int, int], tuple] = {}

    def children(self, level: int, k: int) -> tuple:
        """first, smallest and largest inner product of each child with the anchor, their smallest ids and labels."""
        if (level, k) not in self.bounds:
            t, own = self.tree.levels[level - 1], slice(k * FAN, (k + 1) * FAN)
            low, high = t["low"][own], t["high"][own]
            self.bounds[level, k] = (k * FAN, low @ self.plus + high @ self.minus, high @ self.plus + low @ self.minus, t["least"][own], t["from"][own], t["to"][own])
        return self.bounds[level, k]

    def best(self, count: int, same: bool, least=None, most=None) -> list[tuple]:
        """The first count (-score, id) of the rows with the anchor's label (or with others), scores within least and most.

        The queue has the boxes by the largest score that they may hold. Boxes with no score in the window are left out, and the search ends at a
        box whose largest score, with its smallest id, comes after the last row found.
        """
        root = len(self.tree.levels) - 1
        queue, found = [(0, 0, root, 0)], []
        while queue:
            bound, smallest, level, k = heapq.heappop(queue)
            if len(found) == count and (bound, smallest) > found[-1] and (level, k) != (root, 0):
                break
            if level == 0:
                own = self.tree.leaf(k)
                if k not in self.scores:
                    self.scores[k] = self.tree.v[own] @ self.q
                if (int(self.tree.levels[0]["from"][k]) == self.label) != same:
                    continue
                score, floor = self.scores[k], -found[-1][0] if len(found) == count else least
                if least is not None:
                    ok = np.flatnonzero((score >= floor) & (score <= most))
                else:
                    ok = np.flatnonzero(score >= floor) if floor is not None else np.arange(len(score))
                ok = ok[self.tree.ids[own][ok] != self.anchor]
                if len(ok):
                    score, ids = score[ok], self.tree.ids[own][ok]
                    if len(ok) > 4 * count and score.dtype != object:
                        first = np.lexsort((ids, -score))[:count]
                        score, ids = score[first], ids[first]
                    found = sorted(found + [(-int(s), i) for s, i in zip(score.tolist(), ids.tolist())])[:count]
                continue
            first, low, high, ids, from_, to = self.children(level, k)
            ok = ((from_ <= self.label) & (self.label <= to)) if same else ((from_ != self.label) | (to != self.label))
            if least is not None:
                ok = ok & (high >= least) & (low <= most)
                high = np.minimum(high, most)
            for j in np.flatnonzero(ok).tolist():
                item = (-int(high[j]), int(ids[j]), level - 1, first + j)
                if len(found) < count or item[:2] <= found[-1]:
                    heapq.heappush(queue, item)
        return found


def usable(embeddings: DataFrame, step: int = 256) -> DataFrame:
    """id, label, v: rows with an id, a label and a vector of finite components, each component x as floor(step * x); equal rows once."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    own = embeddings.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), x.alias("x"))
    finite = F.forall("x", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    return own.where("id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL").where(finite).select("id", "label", F.transform("x", lambda c: F.floor(c * step)).alias("v")).distinct()


def _pack(part: int, batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, label, v, more) as packed rows of at most so many: part, ids, labels, v (shorter vectors end in zeros), d, more."""

    def flush(held: list) -> pa.RecordBatch:
        ids, labels, v, more = ([x for b in held for x in b[k]] for k in range(4))
        d = max(map(len, v))
        full = np.zeros((len(v), d), np.int64)
        for row, x in zip(full, v):
            row[: len(x)] = x
        small = next(t for t in (np.int16, np.int32, np.int64) if not full.size or np.abs(full).max() <= np.iinfo(t).max)
        told = np.array([(k, *p) for k, x in enumerate(more) for p in x or ()], np.int64)
        columns = [[part], *([np.array(x, np.int64).tobytes()] for x in (ids, labels)), [np.dtype(small).char.encode() + full.astype(small).tobytes()], [d], [told.tobytes()]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.binary()))], names=["part", "ids", "labels", "v", "d", "more"])

    held, size = [], 0
    for batch in batches:
        low = 0
        while low < batch.num_rows:
            own = batch.slice(low, min(rows - size, batch.num_rows - low))
            held.append([own.column(k).to_pylist() for k in range(4)])
            size, low = size + own.num_rows, low + own.num_rows
            if size == rows:
                yield flush(held)
                held, size = [], 0
    if held:
        yield flush(held)


def packed(df: DataFrame, rows: int, more: str = "CAST(NULL AS array<array<bigint>>)") -> DataFrame:
    """part (the number of the partition) and its rows id, label, v, packed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        yield from _pack(TaskContext.get().partitionId(), batches, rows)

    return df.selectExpr("id", "label", "v", f"{more} AS more").mapInArrow(pack, f"part int, {PACKED}")


def unpacked(ids: bytes, labels: bytes, v: bytes, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, np.int64)
    return own, np.frombuffer(labels, np.int64), np.frombuffer(v[1:], np.dtype(v[:1].decode())).reshape(len(own), d)


def exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays in a type in which their inner products are exact: doubles below 2 ** 53, else integers of any size."""
    high = [int(np.abs(a.astype(object)).max()) if a.dtype == np.int64 and a.size else int(np.abs(a.astype(np.int64)).max()) if a.size else 0 for a in arrays]
    small = max(1, *(a.shape[-1] for a in arrays)) * max(high) ** 2 < 1 << 52
    return [a.astype(np.float64 if small else object) for a in arrays]


def tiles(rows: DataFrame) -> DataFrame:
    """rows in packed tiles of at most TILE: slices by the coordinate that varies most, each slice sorted and cut by the next one."""
    spark = rows.sparkSession
    total = rows.count()
    parts = max(1, -(-total // TILE))
    widest = [r.pos for r in rows.select(F.posexplode("v")).groupBy("pos").agg(F.var_pop("col").alias("s")).orderBy(F.desc("s"), "pos").limit(2).collect()]
    at = lambda k: F.coalesce(F.get("v", F.lit(widest[k])), F.lit(0)) if k < len(widest) else F.lit(0)
    slices = int(np.ceil(np.sqrt(parts)))
    cuts = rows.select(at(0).cast("double").alias("x")).approxQuantile("x", [k / slices for k in range(1, slices)], 0.01) if slices > 1 and total else []
    slice_ = F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<double>"), lambda c: c < at(0).cast("double"))) if cuts else F.lit(0)
    placed = rows.withColumns({"_s": slice_, "_y": at(1)}).repartitionByRange(parts, "_s", "_y", "id").sortWithinPartitions("_s", "_y", "id")
    return stored(packed(placed.select("id", "label", "v"), TILE))


def searched(trees: DataFrame, anchors: DataFrame, count: int, percents: tuple[int, int] | None) -> DataFrame:
    """no, place, id, score: of each tree the first count rows of the anchor's label, or (with percents) of other labels in the windows of its positives.

    Both sides are packed; more holds (no,) of an anchor or (no, place, id, score) of its positives. Every block of anchors meets every tile, in tasks of one tile
    and about BLOCKS blocks.
    """
    last = trees.agg(F.max("part")).first()[0]
    groups = max(1, -(-anchors.count() // BLOCKS))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n)))
    blocks = anchors.where(F.lit(last is not None)).withColumn("g", F.pmod(F.xxhash64("ids", "more"), F.lit(groups)).cast("int")).withColumn("tile", every(last or 0))
    sides = [df.selectExpr("tile", "g", f"{kind} AS kind", "ids", "labels", "v", "d", "more") for kind, df in enumerate((trees.withColumn("g", every(groups - 1)).withColumnRenamed("part", "tile"), blocks))]

    def one(tree: Tree, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, told: np.ndarray) -> Iterator[tuple]:
        for own in np.split(told, np.flatnonzero(np.diff(told[:, 0])) + 1):
            k, no = own[0, :2].tolist()
            s = Search(tree, int(ids[k]), int(labels[k]), v[k])
            if percents is None:
                yield from ((no, 0, i, -x) for x, i in s.best(count, True))
                continue
            known: dict[int, list] = {}
            for place, score in own[:, (2, 4)].tolist():
                if score not in known:
                    low, high = -(-percents[0] * score // 100), percents[1] * score // 100
                    known[score] = s.best(count, False, low, high) if low <= high else []
                yield from ((no, place, i, -x) for x, i in known[score])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, here = [], None
        for r in (r for batch in batches for r in batch.to_pylist()):
            if (r["tile"], r["g"]) != here:
                own, here = [], (r["tile"], r["g"])
            ids, labels, v = unpacked(r["ids"], r["labels"], r["v"], r["d"])
            if r["kind"] == 0:
                own.append((ids, labels, v, {}))
                continue
            told = np.frombuffer(r["more"], np.int64).reshape(-1, 2 if percents is None else 5)
            for t_ids, t_labels, t_v, made in own:
                wide = max(t_v.shape[1], v.shape[1])
                tv, av = exact(*(np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (t_v, v)))
                if (wide, tv.dtype) not in made:
                    made[wide, tv.dtype] = Tree(t_ids, t_labels, tv)
                out = list(one(made[wide, tv.dtype], ids, labels, av, told))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["no", "place", "id", "score"])

    met = sides[0].unionByName(sides[1]).repartition("tile", "g").sortWithinPartitions("tile", "g", "kind")
    return met.mapInArrow(search, "no long, place long, id long, score long")


def _first(found: DataFrame, group: list[str], count: int, name: str) -> DataFrame:
    return found.withColumn(name, F.row_number().over(W.partitionBy(*group).orderBy(F.desc("score"), "id"))).where(F.col(name) <= count)


def hard_negatives(rows: DataFrame, anchor: str, positives: int = 5, negatives: int = 5, percents: tuple[int, int] = (80, 100)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. rows: id, label, v (whole numbers); anchor: the condition of anchors.

    An anchor's positives are its first other rows of the same label by inner product (ties by id). For each, the first rows of other labels whose
    score is within percents of the positive's are returned; a positive with a score below 0 has none. Rows with the anchor's id are never its partners. Equal rows count once; rows that share an id with another
    vector are rows of their own. Shorter vectors are as if they ended in zeros. Scores must fit in 64 bits, else the job fails. An empty table gives an empty one.

    Of equal vectors of a label only the first ids can be partners, so the others aren't put in trees, however many there are.
    """
    same = W.partitionBy("label", "v").orderBy("id")
    trees = tiles(rows.withColumn("_r", F.row_number().over(same)).where(F.col("_r") <= max(positives, negatives) + 1).drop("_r"))
    anchors = stored(rows.where(anchor).withColumn("no", F.monotonically_increasing_id()))
    near = searched(trees, stored(packed(anchors, BLOCK, "array(array(no))")), positives, None)
    near = stored(_first(near.drop("place"), ["no"], positives, "place"))
    told = near.groupBy("no").agg(F.collect_list(F.array("no", "place", "id", "score")).alias("told"))  # a few for each anchor
    windows = anchors.join(told.withColumnRenamed("no", "_no"), F.col("no") == F.col("_no"))
    hard = _first(searched(trees, stored(packed(windows, BLOCK, "told")), negatives, percents), ["no", "place"], negatives, "rank")
    pairs = near.select(F.col("no").alias("_no"), F.col("place").alias("_place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = hard.join(pairs, (F.col("no") == F.col("_no")) & (F.col("place") == F.col("_place"))).withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
    of = anchors.select(F.col("no").alias("_of"), F.col("id").alias("anchor_id"))
    return out.join(of, F.col("no") == F.col("_of")).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_rtree_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    label = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label).distinct(), "id % 100 = 0")


QUERIES = {"op13_rtree_hard_negatives": op13_rtree_hard_negatives}
ORACLES: dict[str, str] = {
    "op13_rtree_hard_negatives": """
        WITH e AS (
            SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (SELECT a.id AS anchor_id, a.label, r.id, r.label AS other, list_inner_product(a.v, r.v)::BIGINT AS score FROM e a JOIN e r ON a.id % 100 = 0 AND a.id <> r.id),
        p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS k FROM s WHERE label = other) WHERE k <= 5)
        SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM (
            SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS rank
            FROM p JOIN s n ON n.anchor_id = p.anchor_id AND n.label <> n.other AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
        WHERE rank <= 5
    """,
}
