"""Near-duplicate documents by MinHash signatures and a multi-index Hamming join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_slices, stored, table
from .ctw import Texts, mixed
from .graphs import connected_components

SHINGLE = 5
NO_ID = -(1 << 63)  # stands for a null doc_id
#: Symbols of a signature, each of 16 bits, and the chunks that they are split into.
SYMBOLS, CHUNKS = 32, 8
PER_CHUNK = SYMBOLS // CHUNKS
#: Each chunk is looked up with one error, so pairs that differ in up to 2 * CHUNKS - 1 symbols meet in some
#: chunk. Of pairs at the similarity of 0.85, three in a million differ in more; at 0.8, one in seven thousand.
RADIUS = 2 * CHUNKS - 1
#: Signatures and shingles that one task compares with as many others at once, at most.
BLOCK, BLOCK_SHINGLES = 4096, 2_000_000
#: Bytes of text that are worked on at once.
AT_ONCE = 1 << 18

_RNG = np.random.default_rng(20_240_917)
_XOR = _RNG.integers(0, 2**64, SYMBOLS, np.uint64)
_ODD = _RNG.integers(0, 2**64, SYMBOLS, np.uint64) | np.uint64(1)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """For each text the sorted 64-bit hashes of its distinct shingles of five words; fewer words are one shingle."""
    hashes, of = Texts(texts).words()
    hashes, step = mixed(hashes), np.uint64(0x2545F4914F6CDD1D)
    ends = np.searchsorted(of, np.arange(len(texts)), "right")
    starts = np.concatenate([[0], ends[:-1]])
    n = len(hashes) - SHINGLE + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for k in range(SHINGLE if n > 0 else 0):
        rolled = rolled * step + hashes[k : k + n]
    rolled, out = mixed(rolled), []
    for a, b in zip(starts.tolist(), ends.tolist()):
        if b - a >= SHINGLE:
            out.append(np.unique(rolled[a : b - SHINGLE + 1]))
        elif b > a:
            value = np.full(1, b - a, np.uint64)
            for h in hashes[a:b]:
                value = value * step + h
            out.append(mixed(value))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of SYMBOLS 16-bit symbols for each set; zeros for an empty one."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out, full = np.zeros((len(sets), SYMBOLS), np.uint16), np.flatnonzero(sizes)
    if len(full):
        values = np.concatenate([sets[i] for i in full])
        first = np.cumsum(sizes[full]) - sizes[full]
        for k in range(SYMBOLS):
            h = (values ^ _XOR[k]) * _ODD[k]
            h ^= h >> np.uint64(29)
            out[full, k] = (mixed(np.minimum.reduceat(h, first)) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def chunk_keys(symbols: np.ndarray) -> np.ndarray:
    """The CHUNKS * PER_CHUNK keys of each signature: a chunk without one of its symbols, for each such symbol.

    Two chunks that differ in at most one symbol share the key that leaves that symbol out.
    """
    parts = symbols.reshape(-1, CHUNKS, PER_CHUNK).astype(np.int64)
    out = []
    for c in range(CHUNKS):
        for gap in range(PER_CHUNK):
            key = np.full(len(parts), c * PER_CHUNK + gap, np.int64)
            for i in range(PER_CHUNK):
                if i != gap:
                    key = key << 16 | parts[:, c, i]
            out.append(key)
    return np.stack(out, axis=1)


class Forest:
    """Union of sets of numbers below n."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        while not np.array_equal(p := self.parent[self.parent], self.parent):
            self.parent = p
        return self.parent

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        parent = self.parent
        for i, j in zip(a.tolist(), b.tolist()):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            while parent[j] != j:
                parent[j] = parent[parent[j]]
                j = parent[j]
            if i != j:
                parent[max(i, j)] = min(i, j)


def close_pairs(symbols: np.ndarray, sizes: np.ndarray, percent: int, forest: Forest, step: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) whose signatures are within RADIUS, whose sizes allow the similarity, and that the
    forest has not joined yet, in portions; the caller joins those that it wants between portions."""
    n = len(symbols)
    order = np.argsort(sizes, kind="stable")
    symbols, sizes = np.ascontiguousarray(symbols[order]), sizes[order]
    for low in range(0, n, step):
        own = symbols[low : low + step]
        high = int(np.searchsorted(sizes, sizes[low + len(own) - 1] * 100 // percent, "right"))
        if high - low < 2:
            continue
        equal = np.zeros((len(own), high - low), np.uint8)
        for k in range(SYMBOLS):
            equal += own[:, k, None] == symbols[None, low:high, k]
        i, j = np.nonzero(equal >= SYMBOLS - RADIUS)
        keep = (j > i) & (100 * sizes[low + i] >= percent * sizes[low + j])
        i, j = order[low + i[keep]], order[low + j[keep]]
        roots = forest.roots()
        keep = roots[i] != roots[j]
        if keep.any():
            yield i[keep], j[keep]


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups (equal in the first keys columns, by which the rows are sorted) and their borders."""
    held: list[pa.RecordBatch] = []

    def borders(t: pa.Table) -> np.ndarray:
        new = np.zeros(max(t.num_rows - 1, 0), bool)
        for k in range(keys):
            v = t.column(k).to_numpy()
            new |= v[1:] != v[:-1]
        return np.concatenate([[0], np.flatnonzero(new) + 1, [t.num_rows]])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        t = pa.Table.from_batches(held)
        cut = borders(t)
        if len(cut) > 2:
            yield t.slice(0, cut[-2]), cut[:-1]
            held = t.slice(cut[-2]).combine_chunks().to_batches()
    if held:
        t = pa.Table.from_batches(held)
        yield t, borders(t)


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with at most AT_ONCE bytes of text, or one row."""
    for batch in batches:
        for part in in_slices(batch, column, batch.num_rows, AT_ONCE):
            yield part, [(t.as_py() or "").encode() for t in part.column(column)]


def by_row(docs: DataFrame) -> DataFrame:
    """doc_id, text, and doc and hash, which tell rows with different ids or texts apart: doc_id (NO_ID for null) and a hash of the text."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.select("doc_id", "text", F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("hash"))


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, doc, hash, n, high, low, symbols: the size of the shingle set, a 128-bit digest of it and the signature."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _texts(batches, 3):
            sets = shingle_sets(texts)
            symbols = signatures(sets)
            digest = [(int(np.bitwise_xor.reduce(s)), int(np.add.reduce(mixed(s + np.uint64(1))))) if len(s) else (0, 0) for s in sets]
            columns = [*part.columns[:3], pa.array([len(s) for s in sets], pa.int64()), *(pa.array(np.array([d[k] for d in digest], np.uint64).view(np.int64)) for k in (0, 1)), pa.array([x.tobytes() for x in symbols], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "doc", "hash", "n", "high", "low", "symbols"])

    return by_row(docs).select("doc_id", "doc", "hash", "text").mapInArrow(sketch, "doc_id long, doc long, hash long, n long, high long, low long, symbols binary")


def _in_blocks(rows: DataFrame, group: str, size: str) -> DataFrame:
    """rows, once for each pair of blocks (bi <= bj) of their group that they are compared in.

    size is the number of blocks of the group. With one block a row comes once; with more, every two rows of
    the group still meet in a pair of blocks, and the work on one group is spread over many tasks.
    """
    own = F.pmod(F.xxhash64("rep"), F.col(size)).cast("int")
    pairs = F.when(F.col(size) == 1, F.array(F.struct(F.lit(0).alias("bi"), F.lit(0).alias("bj")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col(size).cast("int") - 1), lambda x: F.struct(F.least(x, own).alias("bi"), F.greatest(x, own).alias("bj"))))
    return rows.withColumn("_p", F.explode(pairs)).select("*", F.col("_p.bi").alias("bi"), F.col("_p.bj").alias("bj")).drop("_p")


def candidate_edges(reps: DataFrame, percent: int) -> DataFrame:
    """a, b: edges that connect all documents that pairs within RADIUS connect. reps: rep, n, symbols."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, SYMBOLS)
            if len(symbols):
                found = chunk_keys(symbols)
                yield pa.RecordBatch.from_arrays([pa.array(found.ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), found.shape[1]))], names=["key", "rep"])

    found = reps.select("rep", "symbols").mapInArrow(keys, "key long, rep long")
    shared = found.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    rows = found.join(shared, "key").join(reps, "rep").withColumn("blocks", F.ceil(F.col("members") / BLOCK))
    rows = _in_blocks(rows, "key", "blocks").select("key", "bi", "bj", "rep", "n", "symbols")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, cut in whole_groups(batches, 3):
            ids, sizes = t.column(3).to_numpy(), t.column(4).to_numpy()
            symbols = np.frombuffer(b"".join(t.column(5).to_pylist()), np.uint16).reshape(-1, SYMBOLS)
            forest = Forest(len(ids))
            few = np.flatnonzero(np.diff(cut) == 2)
            if len(few):  # most buckets have two members
                i = cut[few]
                j = i + 1
                ok = (symbols[i] == symbols[j]).sum(axis=1) >= SYMBOLS - RADIUS
                ok &= 100 * np.minimum(sizes[i], sizes[j]) >= percent * np.maximum(sizes[i], sizes[j])
                forest.join(i[ok], j[ok])
            for k in np.flatnonzero(np.diff(cut) > 2):
                a, b = cut[k], cut[k + 1]
                own = Forest(b - a)
                for i, j in close_pairs(symbols[a:b], sizes[a:b], percent, own):
                    own.join(i, j)
                forest.parent[a:b] = own.roots() + a
            roots = forest.roots()
            out = np.flatnonzero(roots != np.arange(len(ids)))
            if len(out):
                pair = np.unique(np.stack([ids[out], ids[roots[out]]], axis=1), axis=0)
                yield _edges(pair[:, 0], pair[:, 1])

    return rows.repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj").mapInArrow(compare, "a long, b long")


def exact_edges(docs: DataFrame, reps: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """a, b: links, confirmed on full sets, that connect all linked classes of each group (node, component). reps: rep, doc, hash, n, symbols."""
    members = groups.join(reps, groups["node"] == reps["rep"]).select("doc", "hash", "rep", "component", "n", "symbols")
    sizes = members.groupBy("component").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    members = members.join(sizes, "component")
    # one row of those that repeat a document; they are together already
    rows = by_row(docs).select("doc", "hash", "text").join(members, ["doc", "hash"]).dropDuplicates(["doc", "hash"])
    rows = _in_blocks(rows, "component", "blocks").select("component", "bi", "bj", "rep", "n", "symbols", "text")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, cut in whole_groups(batches, 3):
            ids = t.column(3).to_numpy()
            for a, b in zip(cut, cut[1:]):
                part = t.slice(a, b - a)
                symbols = np.frombuffer(b"".join(part.column(5).to_pylist()), np.uint16).reshape(-1, SYMBOLS)
                sets = []
                for low in range(0, b - a, 500):
                    sets += shingle_sets([x.encode() for x in part.column(6).slice(low, 500).to_pylist()])
                forest = linked(sets, symbols, percent)
                roots = forest.roots()
                out = np.flatnonzero(roots != np.arange(b - a))
                if len(out):
                    yield _edges(ids[a + out], ids[a + roots[out]])

    return rows.repartition("component", "bi", "bj").sortWithinPartitions("component", "bi", "bj").mapInArrow(verify, "a long, b long")


def linked(sets: list[np.ndarray], symbols: np.ndarray, percent: int) -> Forest:
    """Components of the links among the sets: pairs within RADIUS, checked on the sets until joined."""
    sizes = np.array([len(s) for s in sets], np.int64)
    forest = Forest(len(sets))
    values, inverse, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    of = np.repeat(np.arange(len(sets)), sizes)
    shared = times[inverse] > 1  # only these can lie in an intersection
    column = np.cumsum(times > 1) - 1
    width = int((times > 1).sum())
    bits = np.zeros((len(sets), -(-max(width, 1) // 64) * 8), np.uint8) if len(sets) * width <= 1 << 31 else None
    if bits is not None:
        c = column[inverse[shared]]
        np.bitwise_or.at(bits, (of[shared], c >> 3), (1 << (c & 7)).astype(np.uint8))
        bits = bits.view(np.uint64)
    for i, j in close_pairs(symbols, sizes, percent, forest):
        agree = (symbols[i] == symbols[j]).sum(axis=1)
        best = np.argsort(-agree, kind="stable")  # the likely links first, so that the rest may be joined already
        i, j = i[best], j[best]
        low, step = 0, 64
        while low < len(i):
            roots = forest.roots()
            a, b = i[low : low + step], j[low : low + step]
            open_ = roots[a] != roots[b]
            a, b = a[open_], b[open_]
            if len(a):
                if bits is not None:
                    common = np.bitwise_count(bits[a] & bits[b]).sum(axis=1, dtype=np.int64)
                else:
                    common = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a, b)])
                ok = 100 * common >= percent * (sizes[a] + sizes[b] - common)
                forest.join(a[ok], b[ok])
            low, step = low + step, min(4096, 2 * step)
    return forest


def classified(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, doc, hash, n and root for each row of docs: rows with the same root are linked; it is null without words.

    Rows with equal sets are one class from the start, however many they are. A class is known by a number of its own, so
    null ids, ids that repeat with another text and repeated rows are linked like any other.
    """
    known = stored(sketched(docs))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc", "hash")).alias("first")
    classes = stored(known.where("n > 0").groupBy("high", "low", "n").agg(first, F.first("symbols").alias("symbols")).withColumn("rep", F.monotonically_increasing_id()))
    reps = classes.select("rep", "first.doc", "first.hash", "n", "symbols")
    groups = connected_components(candidate_edges(reps, percent))
    final = connected_components(exact_edges(docs, reps, groups, percent))
    of_class = classes.join(final, classes["rep"] == final["node"], "left").select(*[F.col(c).alias(f"_{c}") for c in ("high", "low", "n")], F.coalesce("component", "rep").alias("root"))
    return known.join(of_class, (known["high"] == of_class["_high"]) & (known["low"] == of_class["_low"]) & (known["n"] == of_class["_n"]), "left").select("doc_id", "doc", "hash", "n", "root")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs.

    Documents whose shingle sets have at least percent % of their union in common are linked; component_id is the
    smallest doc_id that links reach. Texts without words (null and empty ones too) are linked with nothing.
    Rows with a null doc_id get the component of what they are linked with (null, and kept, if no linked row has an id). Rows that
    repeat a doc_id are documents of their own, each in its component. Other columns are ignored, whatever their names; an
    empty table gives an empty one.
    """
    rows = stored(classified(docs, percent))
    least = rows.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("_component")).withColumnRenamed("root", "_root")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("_component"))
    out = rows.join(least, rows["root"] == least["_root"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def one_of_each(docs: DataFrame, percent: int = 85) -> DataFrame:
    """docs with one row of each component: that with the smallest doc_id (null ids last, then by a hash of the text).

    Rows without words all stay. Other columns are kept, whatever their names.
    """
    rows = stored(classified(docs, percent))
    first = rows.where("root IS NOT NULL").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc", "hash")).alias("first")).select(F.col("first.doc").alias("_doc"), F.col("first.hash").alias("_hash"))
    own = docs.toDF(*[f"_c{k}" for k in range(len(docs.columns))])
    at = {c.lower(): F.col(f"_c{k}") for k, c in enumerate(docs.columns)}
    text = at["text"].cast("string")
    key = [F.coalesce(at["doc_id"].cast("long"), F.lit(NO_ID)).alias("_doc"), F.xxhash64(text).alias("_hash")]
    wordless = ~F.coalesce(text, F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = own.select("*", *key).where(~wordless).join(first, ["_doc", "_hash"]).dropDuplicates(["_doc", "_hash"])
    return kept.select(*own.columns).unionByName(own.where(wordless)).toDF(*docs.columns)


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op1_minhash_near_dedup": op1_minhash_near_dedup}
ORACLES: dict[str, str] = {
    "op1_minhash_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS words FROM documents),
        s AS (
            SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                ELSE [array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)] END) AS shingles FROM w),
        e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
        reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
        SELECT doc_id, len(shingles)::BIGINT AS n_shingles, c.component_id, doc_id = c.component_id AS kept
        FROM s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = s.doc_id
    """,
}
