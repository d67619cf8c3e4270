"""Documents with much in common, by a T-occurrence search over inverted lists (DivideSkip)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BATCH, batches_of, stored, table
from .ctw import mixed
from .graphs import connected_components
from .minhash import BLOCK, BLOCK_SHINGLES, Forest, _edges, _in_blocks, _texts, by_row, shingle_sets, whole_groups
from .phrases import TABLE_BITS, has

#: Cells of the table that tells about how often a shingle occurs. It orders the shingles of a set, rarest first; any order gives right
#: results, a good one short lists. Its size is fixed, so it may be broadcast.
CELLS_BITS, CHUNK = 20, 1 << 16
#: Inverted lists of at most so many sets are merged pair by pair; the sets of a longer one are searched as one group.
SHORT = 24
#: Shingles that by their cells stand in short lists of at least so many sets (of 64 kinds) come behind all others: the more text, the less do cells tell
#: of these, and texts that share nothing else would be groups.
COMMON = 8
#: They are counted in 2^11 parts by their first bits, and within a part by the next 32.
PARTS_BITS = 11
#: Bytes of text whose lists a task combines before they are shuffled, and how many sets it remembers as seen.
FLUSH, SEEN = 8 << 20, 1 << 20
#: Weight of probes against merging: the longest T / (MU * log2(longest list) + 1) lists of a query are probed.
MU = 0.01
ALWAYS = 1 << 40  # occurrences of a pair that is searched whatever its count
STEP = np.uint64(64 - CELLS_BITS)


def least_overlap(n, m, percent: int):
    """Shingles that sets of n and m must share for the similarity."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_lists(n: int, percent: int) -> int:
    """Lists of a set of n that are merged if all but one of the needed occurrences may lie in the others: n - T + 1."""
    return n + percent * n // -100 + 1


def counted(docs: DataFrame) -> DataFrame:
    """A row for each of docs: doc_id, doc, hash, n, high, low (digest of the set), node (64 bits of it); and rows chunk, cells: counts of shingles by cell."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELLS_BITS, np.uint32)
        for part, texts in _texts(batches, 3):
            sets = shingle_sets(texts)
            if any(len(s) for s in sets):
                np.add.at(cells, (np.concatenate(sets) >> STEP).astype(np.int64), np.uint32(1))
            digest = np.array([digest_of(s) for s in sets], np.uint64).reshape(-1, 2)
            none = pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())
            numbers = [pa.array(np.array([len(s) for s in sets], np.int64)), *(pa.array(x.view(np.int64)) for x in (digest[:, 0].copy(), digest[:, 1].copy(), node_of(digest)))]
            yield pa.RecordBatch.from_arrays([*part.columns[:3], *numbers, *none], names=NAMES)
        at = np.flatnonzero(cells.reshape(-1, CHUNK).any(axis=1))
        if len(at):
            empty = [pa.nulls(len(at), pa.int64())] * 7
            yield pa.RecordBatch.from_arrays([*empty, pa.array(at, pa.int32()), pa.array([cells[k * CHUNK : (k + 1) * CHUNK].tobytes() for k in at], pa.binary())], names=NAMES)

    return by_row(docs).select("doc_id", "doc", "hash", "text").mapInArrow(count, ", ".join(f"{n} long" for n in NAMES[:7]) + ", chunk int, cells binary")


NAMES = ["doc_id", "doc", "hash", "n", "high", "low", "node", "chunk", "cells"]


def digest_of(s: np.ndarray) -> tuple[int, int]:
    return (int(np.bitwise_xor.reduce(s)), int(np.add.reduce(mixed(s + np.uint64(1))))) if len(s) else (0, 0)


def node_of(digest: np.ndarray) -> np.ndarray:
    return mixed(digest[:, 0] ^ mixed(digest[:, 1]))


def frequencies(rows: DataFrame) -> np.ndarray:
    """The summed cells of all tasks: 4 MB, whatever the size of the corpus."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, data in zip(*(c.to_pylist() for c in batch.columns)):
                sums[k] = sums.get(k, 0) + np.frombuffer(data, np.uint32).astype(np.uint64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["chunk", "cells"])

    out = np.zeros(1 << CELLS_BITS, np.uint64)
    for r in rows.select("chunk", "cells").repartition("chunk").mapInArrow(add, "chunk int, cells binary").collect():  # at most 16 rows of 512 kB
        out[r.chunk * CHUNK : (r.chunk + 1) * CHUNK] = np.frombuffer(r.cells, np.uint64)
    return out


def rarest_first(s: np.ndarray, cells: np.ndarray, often: np.ndarray | None = None) -> np.ndarray:
    """The shingles of a sorted set by the count of their cell, those of the bit table often last, then by hash: an order that all sets share."""
    rank = cells[(s >> STEP).astype(np.int64)]
    if often is not None:
        rank = rank + (has(often, s).astype(np.uint64) << np.uint64(60))
    return s[np.argsort(rank, kind="stable")]


def common_shingles(docs: DataFrame, cells: np.ndarray, percent: int) -> np.ndarray:
    """A bit table (of 16 MB at any size) of the shingles that would stand in the short lists of COMMON sets, were the order by cells alone.

    Lists are taken a quarter longer here, as what comes in for a common shingle shouldn't be another one. Equal sets are of one kind, so copies don't
    make a shingle common.
    """
    told = docs.sparkSession.sparkContext.broadcast(cells)
    names, piece = ["part", "key", "kind"], 1 << (TABLE_BITS - PARTS_BITS - 3)

    def flush(tokens: list, kinds: list) -> Iterator[pa.RecordBatch]:
        if not tokens:
            return
        kind = np.repeat(np.array(kinds, np.uint64), [len(t) for t in tokens])
        token = np.unique(np.concatenate(tokens) & ~np.uint64(63) | kind)  # the last bits aren't looked at
        part, key, kind = token >> np.uint64(64 - PARTS_BITS), (token >> np.uint64(32 - PARTS_BITS)).astype(np.uint32), (token & np.uint64(63)).astype(np.uint8)
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        offsets = np.append(first, len(part)).astype(np.int32)
        column = [pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets * np.int32(c.itemsize)), pa.py_buffer(c)]) for c in (key, kind)]
        yield pa.RecordBatch.from_arrays([pa.array(part[first].astype(np.int32)), *column], names=names)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, kinds, held = [], [], 0
        for _, texts in _texts(batches, 0):
            for s, t in zip(shingle_sets(texts), texts):
                held += len(t)
                if len(s):
                    tokens.append(rarest_first(s, told.value)[: prefix_lists(len(s), percent) * 5 // 4 + 1])
                    kinds.append(int(np.bitwise_xor.reduce(s)) & 63)
            if held >= FLUSH:
                yield from flush(tokens, kinds)
                tokens, kinds, held = [], [], 0
        yield from flush(tokens, kinds)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, cut in whole_groups(batches, 1):
            for a, b in zip(cut, cut[1:]):
                key, kind = (np.frombuffer(b"".join(t.column(k).slice(a, b - a).to_pylist()), d) for k, d in ((1, np.uint32), (2, np.uint8)))
                order = np.argsort(key)
                key, kind = key[order], np.uint64(1) << kind[order].astype(np.uint64)
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                slot = key[first[np.bitwise_count(np.bitwise_or.reduceat(kind, first)) >= COMMON]] >> np.uint32(32 + PARTS_BITS - TABLE_BITS)
                if len(slot):
                    bits = np.zeros(piece, np.uint8)
                    np.bitwise_or.at(bits, slot >> np.uint32(3), np.uint8(1) << (slot & np.uint32(7)).astype(np.uint8))
                    yield pa.RecordBatch.from_arrays([pa.array([t.column(0)[a].as_py()], pa.int32()), pa.array([bits.tobytes()], pa.binary())], names=["part", "bits"])

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(emit, "part int, key binary, kind binary")
    out = np.zeros(piece << PARTS_BITS, np.uint8)
    with batches_of(docs.sparkSession, BATCH):
        for r in rows.repartition("part").sortWithinPartitions("part").mapInArrow(count, "part int, bits binary").collect():  # at most 2^11 rows of 8 kB
            out[r.part * piece : (r.part + 1) * piece] = np.frombuffer(r.bits, np.uint8)
    return out


def postings(docs: DataFrame, cells: np.ndarray, often: np.ndarray, percent: int) -> DataFrame:
    """token, node, n, w, other: the short lists' entries. A list that is long in one task already is combined there: the first set of each band of
    sizes stands for the others (w of them) and each other one comes as a pair (node, other) of its own, with w = 0."""
    spark = docs.sparkSession
    told = spark.sparkContext.broadcast((cells, often))
    names = ["token", "node", "n", "w", "other"]

    def flush(tokens: list, nodes: list, sizes: list) -> Iterator[pa.RecordBatch]:
        if not nodes:
            return
        many = np.array([len(t) for t in tokens])
        token, node, n = np.concatenate(tokens).view(np.int64), np.repeat(np.array(nodes, np.int64), many), np.repeat(np.array(sizes, np.int64), many)
        order = np.lexsort((node, n, token))
        token, node, n = token[order], node[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        long_ = np.repeat(np.diff(np.append(first, len(token))) > SHORT, np.diff(np.append(first, len(token))))
        band = np.floor(np.log(n) / np.log(100 / percent)).astype(np.int64) if percent < 100 else n
        head = np.concatenate([[True], (token[1:] != token[:-1]) | (band[1:] != band[:-1])]) | ~long_
        at = np.flatnonzero(head)
        w = np.diff(np.append(at, len(token)))
        pair = np.flatnonzero(~head)
        lead = at[np.searchsorted(at, pair, "right") - 1]
        own = np.unique(np.stack([node[pair], node[lead]], axis=1), axis=0) if len(pair) else np.zeros((0, 2), np.int64)
        columns = [np.concatenate([token[at], own[:, 0]]), np.concatenate([node[at], own[:, 0]]), np.concatenate([n[at], np.zeros(len(own), np.int64)]), np.concatenate([w, np.zeros(len(own), np.int64)]), np.concatenate([node[at], own[:, 1]])]
        for low in range(0, len(columns[0]), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[low : low + 100_000], t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()))], names=names)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (order, last), seen = told.value, set()
        tokens, nodes, sizes, held = [], [], [], 0
        for _, texts in _texts(batches, 0):
            for s, t in zip(shingle_sets(texts), texts):
                held += len(t)
                if not len(s):
                    continue
                node = int(node_of(np.array([digest_of(s)], np.uint64)).view(np.int64)[0])
                if node in seen:  # an equal set of this task; those of others meet in the lists
                    continue
                seen.add(node)
                tokens.append(rarest_first(s, order, last)[: prefix_lists(len(s), percent)])
                nodes.append(node)
                sizes.append(len(s))
            if held >= FLUSH:
                yield from flush(tokens, nodes, sizes)
                tokens, nodes, sizes, held = [], [], [], 0
                if len(seen) > SEEN:
                    seen = set()
        yield from flush(tokens, nodes, sizes)

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(emit, "token long, node long, n int, w int, other long")


def _pairs(node: np.ndarray, n: np.ndarray, first: np.ndarray, size: np.ndarray, percent: int) -> Iterator[tuple]:
    """a, b, na, nb, times of all pairs of short lists (rows are sorted by n in each list); equal lists are taken once with their number."""
    sums = np.add.reduceat(mixed(node.view(np.uint64)), first) if len(first) else np.zeros(0, np.uint64)
    for g in range(2, SHORT + 1):
        at = np.flatnonzero(size == g)
        if not len(at):
            continue
        _, one, times = np.unique(sums[at], return_index=True, return_counts=True)
        rows = first[at[one]][:, None] + np.arange(g)
        i, j = np.triu_indices(g, 1)
        a, b = rows[:, i].ravel(), rows[:, j].ravel()
        times = np.repeat(times, len(i))
        ok = 100 * n[a] >= percent * n[b]
        yield node[a[ok]], node[b[ok]], n[a[ok]], n[b[ok]], times[ok]


def candidate_edges(lists: DataFrame, percent: int) -> DataFrame:
    """a, b: pairs that occur together in enough short lists, and pairs that connect the sets of each longer list.

    Sets of n and m that share T shingles share at least T - L of the lists that are merged, where L, the number of the larger set's other lists, is as
    many as may be missed. All rows of a list pass one task as a stream; it holds SHORT of them at most.
    """
    names = ["a", "b", "na", "nb", "times"]

    def out(a, b, na, nb, times) -> pa.RecordBatch:
        swap = (na > nb) | ((na == nb) & (a > b))
        a, b, na, nb = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, nb, na), np.where(swap, na, nb)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a, b, na, nb, times)], names=names)

    def stars(node: np.ndarray, list_of: np.ndarray) -> pa.RecordBatch:
        """Each set of a long list with the one before it."""
        i = np.flatnonzero(list_of[1:] == list_of[:-1])
        i = i[node[i] != node[i + 1]]
        both = np.unique(np.stack([node[i], node[i + 1]], axis=1), axis=0)
        zero = np.zeros(len(both), np.int64)
        return out(both[:, 0], both[:, 1], zero, zero, np.full(len(both), ALWAYS))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, going = None, None  # rows of a list that may go on; the last row of a long one that does
        for batch in batches:
            if not batch.num_rows:
                continue
            token, node, n, w, other = (batch.column(k).to_numpy().astype(np.int64) for k in range(5))
            own = w == 0
            if own.any():
                yield out(node[own], other[own], np.zeros(own.sum(), np.int64), np.zeros(own.sum(), np.int64), np.full(own.sum(), ALWAYS))
            rows = [c[~own] for c in (token, node, n, w)]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows)]
            held = None
            token, node, n, w = rows
            if not len(token):
                continue
            again = np.concatenate([[False], (token[1:] == token[:-1]) & (node[1:] == node[:-1])])  # equal sets of several tasks
            raw, w = w, w - again  # what a repeated one stands for counts still
            first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            size = np.add.reduceat(w, first)
            is_long = (size > SHORT) | (token[first] == going[0] if going else False)
            last = len(first) - 1
            if not is_long[last]:
                keep = first[last] + np.flatnonzero((~again | (raw > 1))[first[last] :])
                held = [c[keep] for c in (token, node, n, raw)]
            of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(token))))
            in_long = is_long[of]
            if in_long.any():
                t, v = token[in_long], node[in_long]
                if going and t[0] == going[0]:
                    t, v = np.concatenate([[going[0]], t]), np.concatenate([[going[1]], v])
                yield stars(v, t)
            going = (token[-1], node[-1]) if is_long[last] else None
            use = ~again & ~in_long & (of < (len(first) if held is None else last))
            if use.any():
                node, n, of = node[use], n[use], of[use]
                starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
                for found in _pairs(node, n, starts, np.diff(np.append(starts, len(of))), percent):
                    yield out(*found)
        if held is not None:
            for found in _pairs(held[1], held[2], np.zeros(1, np.int64), np.array([len(held[1])]), percent):
                yield out(*found)

    rows = lists.repartition("token").sortWithinPartitions("token", "n", "node").mapInArrow(merge, ", ".join(f"{c} long" for c in names))
    total = rows.groupBy("a", "b", "na", "nb").agg(F.sum("times").alias("times"))
    return total.where(F.col("times") >= occurrences_needed(F.col("na"), F.col("nb"), percent)).select("a", "b").distinct()


def occurrences_needed(na: Column, nb: Column, percent: int) -> Column:
    """T - L of a pair with na <= nb: the occurrences among the merged lists without which the others can't make up the overlap."""
    overlap = F.ceil(F.lit(percent) * (na + nb) / F.lit(100 + percent))
    return overlap - (F.ceil(F.lit(percent) * nb / F.lit(100)) - 1)


class Index:
    """Inverted lists of some sets, and the T-occurrence search over them."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        self.sizes = np.array([len(s) for s in sets], np.int64)
        values, self.token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])
        order = np.argsort(self.token, kind="stable")
        self.set_of = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.starts, self.times = np.cumsum(times) - times, times
        self.keys = self.token[order].astype(np.int64) * len(sets) + self.set_of  # sorted: a list after the other

    def entries(self, tokens: np.ndarray) -> np.ndarray:
        """All entries of some lists."""
        many = self.times[tokens]
        return self.set_of[np.repeat(self.starts[tokens] - (np.cumsum(many) - many), many) + np.arange(many.sum())]

    def search(self, q: int, forest: Forest) -> None:
        """Joins set q with the later, not smaller ones that reach the similarity, until it is joined with all of those.

        Sets are in ascending order of size. The short lists are merged and counted; sets with T - L occurrences in them go on, and are looked up in the L longest
        lists by binary search. Sets that are joined with q already aren't probed.
        """
        n = int(self.sizes[q])
        high = int(np.searchsorted(self.sizes, n * 100 // self.percent, "right"))
        tokens = self.token[self.offsets[q] : self.offsets[q + 1]]
        tokens = tokens[self.times[tokens] > 1]
        need = least_overlap(n, n, self.percent)
        if high - q < 2 or len(tokens) < need:
            return
        roots = forest.roots()
        if (roots[q + 1 : high] == roots[q]).all():
            return
        tokens = tokens[np.argsort(self.times[tokens], kind="stable")]
        long_ = min(need - 1, int(need / (MU * np.log2(self.times[tokens[-1]]) + 1)))
        short, long_lists = tokens[: len(tokens) - long_], tokens[len(tokens) - long_ :]
        found = self.entries(short)
        found = found[(found > q) & (found < high)]
        counts = np.bincount(found - q, minlength=high - q)
        c = np.flatnonzero(counts) + q
        needed = least_overlap(n, self.sizes[c], self.percent)
        c = c[(counts[c - q] + long_ >= needed) & (roots[c] != roots[q])]
        c = c[np.argsort(-counts[c - q], kind="stable")]
        low, step = 0, 16
        while low < len(c):
            part = c[low : low + step]
            roots = forest.roots()
            part = part[roots[part] != roots[q]]
            if len(part):
                probes = long_lists[:, None].astype(np.int64) * len(self.sizes) + part
                at = np.minimum(np.searchsorted(self.keys, probes), len(self.keys) - 1)
                overlap = counts[part - q] + (self.keys[at] == probes).sum(axis=0)
                ok = part[overlap >= least_overlap(n, self.sizes[part], self.percent)]
                forest.join(np.full(len(ok), q), ok)
            low, step = low + step, min(1024, 2 * step)


def linked(sets: list[np.ndarray], percent: int) -> Forest:
    """Components of the links among some sets, none of them empty."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    index, own = Index([sets[k] for k in order], percent), Forest(len(sets))
    for q in range(len(sets)):
        index.search(q, own)
    out = Forest(len(sets))
    out.join(order, order[own.roots()])
    return out


def exact_edges(docs: DataFrame, reps: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """a, b: links that connect all linked classes of each group (node, component). reps: rep, doc, hash, n, node."""
    members = groups.withColumnRenamed("node", "_node").join(reps, F.col("_node") == F.col("node")).select("doc", "hash", "rep", "component", "n")
    sizes = members.groupBy("component").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    members = members.join(sizes, "component")
    rows = by_row(docs).select("doc", "hash", "text").join(members, ["doc", "hash"]).dropDuplicates(["doc", "hash"])
    rows = _in_blocks(rows, "component", "blocks").select("component", "bi", "bj", "rep", "text")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, cut in whole_groups(batches, 3):
            ids = t.column(3).to_numpy()
            for a, b in zip(cut, cut[1:]):
                if b - a < 2:
                    continue
                sets = []
                for low in range(a, b, 500):
                    sets += shingle_sets([x.encode() for x in t.column(4).slice(low, min(500, b - low)).to_pylist()])
                roots = linked(sets, percent).roots()
                out = np.flatnonzero(roots != np.arange(b - a))
                if len(out):
                    yield _edges(ids[a + out], ids[a + roots[out]])

    return rows.repartition("component", "bi", "bj").sortWithinPartitions("component", "bi", "bj").mapInArrow(search, "a long, b long")


def jaccard_components(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of docs: the smallest doc_id that links of at least percent % of the union reach.

    Rows with equal sets are one class from the start. Texts without words (null and empty ones too) are linked with nothing and have themselves as
    component. A row with a null doc_id has the component of what it is linked with (null if no linked row has an id); rows that repeat a doc_id are
    documents of their own. Other columns are ignored, whatever their names; an empty table gives an empty one.
    """
    rows = stored(counted(docs))
    known = rows.where("chunk IS NULL").drop("chunk", "cells")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc", "hash")).alias("first")
    classes = stored(known.where("n > 0").groupBy("high", "low", "n").agg(first, F.min("node").alias("node")).withColumn("rep", F.monotonically_increasing_id()))
    reps = classes.select("rep", "first.doc", "first.hash", "n", "node")
    cells = frequencies(rows.where("chunk IS NOT NULL"))
    lists = postings(docs, cells, common_shingles(docs, cells, percent), percent)
    groups = connected_components(candidate_edges(lists, percent))
    final = connected_components(exact_edges(docs, reps, groups, percent)).withColumnRenamed("node", "_rep")
    of_class = classes.join(final, F.col("rep") == F.col("_rep"), "left").select(*[F.col(c).alias(f"_{c}") for c in ("high", "low", "n")], F.coalesce("component", "rep").alias("root"))
    same = (known["high"] == of_class["_high"]) & (known["low"] == of_class["_low"]) & (known["n"] == of_class["_n"])
    out = stored(known.join(of_class, same, "left").select("doc_id", "n", "root"))
    least = out.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("_component")).withColumnRenamed("root", "_root")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("_component"))
    return out.join(least, F.col("root") == F.col("_root"), "left").select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def op12_divide_skip_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


QUERIES = {"op12_divide_skip_jaccard": op12_divide_skip_jaccard}
ORACLES: dict[str, str] = {
    "op12_divide_skip_jaccard": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS words FROM documents),
        s AS (
            SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                ELSE [array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)] END) AS shingles FROM w),
        e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
        reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
        SELECT doc_id, len(shingles)::BIGINT AS n_shingles, c.component_id
        FROM s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = s.doc_id
    """,
}
