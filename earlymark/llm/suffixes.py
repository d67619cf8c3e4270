"""Removal of long repeats by a logarithmic family of suffix arrays."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_slices, in_groups, stored, table

#: Bytes of a repeat, and bytes of the piece in it whose hash decides where it is compared.
LENGTH, PIECE = 100, 32
_WINDOW = LENGTH - PIECE + 1  # pieces in a repeat
#: Bytes of text that are worked on at once, and runs in a batch of the index family.
AT_ONCE, BATCH = 1 << 18, 1024
#: Runs that a task holds at once to drop repeats among them.
HELD_RUNS = 200_000
#: OPEN runs of an anchor that one index family takes; those of a more common anchor are dealt out by window.
FAMILY_RUNS = 4096
#: doc_ids with several texts that are sent to every task; with more, the same join shuffles.
BROADCAST_ROWS = 1_000_000
#: Windows of a task (about LENGTH bytes each), and the index families that it builds for them, one after the other.
TASK_WINDOWS, FAMILIES = 400_000, 4
_PLACE = np.uint64((1 << 28) - 1)
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
NEW, REPEATED, OPEN = 0, 1, 2
NO_ID = -(1 << 63)  # stands for a null doc_id
RESULTS = ("n_bytes", "n_removed", "n_spans", "kept")


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * _C[0]
    return x ^ (x >> np.uint64(32))


def _doubled(x: np.ndarray, n: int) -> np.ndarray:
    """Hashes of 2n bytes from each place, from those of n bytes."""
    g = _mix(x)
    return g[:-n] * _C[1] + g[n:]


def runs(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Runs of windows of LENGTH bytes that share their anchor, the piece of PIECE bytes with the least hash in them.

    Every window belongs to one run, and equal windows have equal anchors at equal distances, wherever
    they stand. Returns for each run the number of the text, its first window's start, its windows, the
    anchor's distance from that start, the anchor's hash and the hash of all bytes that the run covers.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    raw = b"".join(texts) + bytes(2 * LENGTH)
    offsets = np.cumsum(sizes) - sizes
    total = len(raw) - 2 * LENGTH
    eight = np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,)).astype(np.uint64)
    h32 = _doubled(_doubled(eight, 8), 16)
    h64 = _doubled(h32, 32)
    low = (_mix(h32) & ~_PLACE)[: total + _WINDOW] | np.arange(total + _WINDOW, dtype=np.uint64)
    n, least = 1, low
    while 2 * n <= _WINDOW:
        least = np.minimum(least[:-n], least[n:])
        n *= 2
    least = np.minimum(least[: total], least[_WINDOW - n : _WINDOW - n + total])
    anchor = (least & _PLACE).astype(np.int64)
    whole = np.zeros(total + 1, np.int32)
    fit = sizes >= LENGTH
    np.add.at(whole, offsets[fit], 1)
    np.add.at(whole, (offsets + sizes - LENGTH + 1)[fit], -1)
    starts = np.flatnonzero(np.cumsum(whole[:-1]))
    if not len(starts):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, empty, empty
    a = anchor[starts]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (np.diff(starts) != 1)])
    first = np.flatnonzero(new)
    windows = np.diff(np.append(first, len(starts)))
    s, a = starts[first], a[first]
    e = s + windows - 1
    mid = LENGTH - 64
    covered = _mix(_mix(h64[s]) * _C[1] + h64[s + mid]) * _C[2] + _mix(_mix(h64[e]) * _C[3] + h64[e + mid])
    covered = _mix(covered + (windows * 128 + a - s).astype(np.uint64))
    text = np.searchsorted(offsets + sizes, s, "right")
    return text, s - offsets[text], windows, a - s, _mix(h32[a]).view(np.int64), covered.view(np.int64)


def packed(start: np.ndarray, windows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    return start << 14 | (windows - 1) << 7 | anchor


def unpacked(p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return p >> 14, (p >> 7 & 127) + 1, p & 127


def portions(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of a batch (doc, copy, text) with at most AT_ONCE bytes of text, or one row."""
    low, size = 0, 0
    texts: list[bytes] = []
    for k, t in enumerate(batch.column(2)):
        data = (t.as_py() or "").encode()
        if texts and size + len(data) > AT_ONCE:
            yield batch.slice(low, k - low), texts
            low, size, texts = k, 0, []
        size += len(data)
        texts.append(data)
    if texts:
        yield batch.slice(low), texts


def _rows(kind, anchor, covered, doc, copy, place) -> pa.RecordBatch:
    """kind, key, anchor, covered, doc, copy, place; key deals repeated runs out by document."""
    kind = np.asarray(kind, np.int32)
    key = np.where(kind == REPEATED, _mix(doc.view(np.uint64)).view(np.int64), anchor)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (kind, key, anchor, covered, doc, copy, place)], names=["kind", "key", "anchor", "covered", "doc", "copy", "place"])


ROWS = "kind int, key long, anchor long, covered long, doc long, copy long, place long"


def _columns(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
    parts = [[c.to_numpy() for c in b.columns] for b in batches]
    return [np.concatenate(c) for c in zip(*parts)] if parts else []


def _first_of_equal(anchor, covered, doc, copy, place) -> tuple[np.ndarray, np.ndarray]:
    """Order by anchor, covered, document, place, without repeated rows, and whether a row is the first with its anchor and covered."""
    order = np.lexsort((place, copy, doc, covered, anchor) if copy.any() else (place, doc, covered, anchor))
    a, c, d, e, p = anchor[order], covered[order], doc[order], copy[order], place[order]
    once = np.concatenate([[True], (a[1:] != a[:-1]) | (c[1:] != c[:-1]) | (d[1:] != d[:-1]) | (e[1:] != e[:-1]) | (p[1:] != p[:-1])])
    order, a, c = order[once], a[once], c[once]
    return order, np.concatenate([[True], (a[1:] != a[:-1]) | (c[1:] != c[:-1])])


def surveyed(docs: DataFrame) -> DataFrame:
    """Runs of all texts: those that repeat an earlier run as a whole (REPEATED) and those whose
    anchor also stands elsewhere in other surroundings (OPEN), which share some windows at most.

    Each task that reads texts first drops the repeats within its own rows to one, so a run that many
    documents share reaches the next stage once from each task.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(c) for c in zip(*held)]
            held.clear()
            order, first = _first_of_equal(*columns)
            kind = np.where(first, NEW, REPEATED)
            for low in range(0, len(order), 50_000):
                o = order[low : low + 50_000]
                yield _rows(kind[low : low + 50_000], *(c[o] for c in columns))

        for batch in batches:
            for rows, texts in portions(batch):
                text, start, windows, distance, anchor, covered = runs(texts)
                if len(text):
                    doc, copy = (rows.column(k).to_numpy()[text] for k in (0, 1))
                    held.append((anchor, covered, doc, copy, packed(start, windows, distance)))
                if sum(len(h[0]) for h in held) > HELD_RUNS:
                    yield from flush()
        if held:
            yield from flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # sorted by key (a REPEATED run's document, another's anchor) and covered
        last, company = None, False  # the last run that differs from those before it, and whether one of those has its anchor
        for t in in_groups(batches, ["key", "covered"], HELD_RUNS // 2):
            kind, _, *rest = (c.to_numpy() for c in t.columns)
            known = kind == REPEATED
            if known.any():
                yield _rows(kind[known], *(c[known] for c in rest))
            rest = [c[~known] for c in rest]
            if not len(rest[0]):
                continue
            order, first = _first_of_equal(*rest)
            rest = [c[order] for c in rest]
            yield _rows(np.full((~first).sum(), REPEATED), *(c[~first] for c in rest))
            rest = [np.append(x, c[first]) for x, c in zip(last, rest)] if last else [c[first] for c in rest]
            a = rest[0]
            same = np.concatenate([[company], a[1:] == a[:-1]])
            open_ = (same | np.append(same[1:], False))[:-1]
            yield _rows(np.full(open_.sum(), OPEN), *(c[:-1][open_] for c in rest))
            last, company = [c[-1:] for c in rest], bool(same[-1])
        if company:
            yield _rows([OPEN], *last)

    rows = docs.select("doc", "copy", "text").mapInArrow(read, ROWS)
    return stored(rows.repartition("key").sortWithinPartitions("key", "covered").mapInArrow(meet, ROWS).drop("key", "covered"))


class IndexFamily:
    """Sorted arrays of the suffixes seen so far, as far as LENGTH bytes, in levels of geometric sizes.

    A batch's suffixes are sorted into an array of their own and scanned against each level in that order (each search goes on from
    where the one before ended); those that are new become a level, and levels of like size merge into one.
    """

    def __init__(self):
        self.levels: list[np.ndarray] = []

    def repeated(self, suffixes: np.ndarray) -> np.ndarray:
        """Whether each suffix (in document order) was seen before, in this batch or an earlier one; keeps the new ones."""
        array = np.argsort(suffixes, kind="stable")  # equal ones stay in document order
        ordered = suffixes[array]
        old = np.concatenate([[False], ordered[1:] == ordered[:-1]])
        fresh = np.flatnonzero(~old)
        known = np.zeros(len(fresh), bool)
        for level in self.levels:
            at = np.minimum(np.searchsorted(level, ordered[fresh]), len(level) - 1)
            known |= level[at] == ordered[fresh]
        # all copies of a suffix that an earlier batch has are repeats; else the first in this batch is not
        old[fresh[known]] = True
        out = np.zeros(len(suffixes), bool)
        out[array] = old
        if not known.all():
            self.levels.append(ordered[fresh[~known]])
            while len(self.levels) > 1 and 2 * len(self.levels[-1]) >= len(self.levels[-2]):
                self.levels.append(np.concatenate([self.levels.pop(), self.levels.pop()]))
                self.levels[-1].sort(kind="stable")  # in place
        return out


def _slices(batch: pa.RecordBatch, column: int, rows: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most so many rows that have one value in a column, by which the rows are sorted."""
    values = batch.column(column).to_numpy()
    ends = [*(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    for low, high in zip([0, *ends], ends):
        for k in range(low, high, rows):
            yield batch.slice(k, min(rows, high - k))


def open_parts(docs: DataFrame, found: DataFrame) -> DataFrame:
    """doc, copy, start, anchor, family, bytes: the bytes of the OPEN runs and the index family that compares them.

    Runs of one anchor meet in one index family. Where an anchor has more than FAMILY_RUNS of them, each window goes to one of several
    families by the hash of its own bytes: equal windows still meet, and no family or task has all windows of the anchor.
    """
    open_ = found.where(F.col("kind") == OPEN)
    many = open_.groupBy("anchor").agg(F.ceil(F.count(F.lit(1)) / FAMILY_RUNS).cast("int").alias("families")).where("families > 1")
    many = stored(many.withColumn("families", F.col("families") * _WINDOW))  # at most one row for FAMILY_RUNS runs
    many = F.broadcast(many) if many.count() <= BROADCAST_ROWS else many
    wanted = open_.join(many, "anchor", "left").groupBy("doc", "copy").agg(F.collect_list(F.struct("anchor", "place", F.coalesce("families", F.lit(1)).alias("families"))).alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names=["doc", "copy", "start", "anchor", "family", "bytes"])

        for batch in batches:
            for doc, copy, text, runs_ in zip(*(c.to_pylist() for c in batch.columns[:2]), batch.column(2), batch.column(3)):
                data, own = text.as_py().encode(), runs_.values
                start, windows, _ = unpacked(own.field(1).to_numpy())
                for s, w, a, n in zip(start.tolist(), windows.tolist(), own.field(0).to_pylist(), own.field(2).to_pylist()):
                    if n == 1:
                        rows.append((doc, copy, s, a, 0, data[s : s + w + LENGTH - 1]))
                        size += w + LENGTH
                    else:
                        rows.extend((doc, copy, i, a, zlib.crc32(data[i : i + LENGTH]) % n, data[i : i + LENGTH]) for i in range(s, s + w))
                        size += w * LENGTH
                    if size > 1 << 20:
                        yield flush()
                        size = 0
        if rows:
            yield flush()

    texts = docs.select("doc", "copy", "text").join(wanted, ["doc", "copy"])
    return texts.select("doc", "copy", "text", "wanted").mapInArrow(cut, "doc long, copy long, start long, anchor long, family int, bytes binary")


def marked(docs: DataFrame, found: DataFrame) -> DataFrame:
    """doc, copy, starts: where the windows of OPEN runs begin that repeat an earlier window, as runs (start << 7 | more windows)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, last = None, (None, None, None)
        for batch in batches:
            for part in _slices(batch, 4, BATCH):
                if own != (own := part.column(4)[0].as_py()):
                    family = IndexFamily()
                doc, copy, start = (c.to_numpy() for c in part.columns[:3])
                new = np.concatenate([[(doc[0], copy[0], start[0]) != last], (doc[1:] != doc[:-1]) | (copy[1:] != copy[:-1]) | (start[1:] != start[:-1])])
                last = doc[-1], copy[-1], start[-1]  # rows that repeat a document come twice, one after the other
                part, doc, copy, start = part.filter(pa.array(new)), doc[new], copy[new], start[new]
                data = part.column(3).to_pylist()
                if not data:
                    continue
                sizes = np.array([len(x) for x in data], np.int64)
                raw = np.frombuffer(b"".join(data), np.uint8)
                windows = sizes - LENGTH + 1
                of = np.repeat(np.arange(len(data)), windows)
                inside = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
                at = (np.cumsum(sizes) - sizes)[of] + inside
                suffixes = np.lib.stride_tricks.sliding_window_view(raw, LENGTH)[at].view(f"S{LENGTH}").ravel()
                hit = np.flatnonzero(family.repeated(suffixes))
                if len(hit):
                    o, i = of[hit], inside[hit]
                    first = np.flatnonzero(np.concatenate([[True], (o[1:] != o[:-1]) | (np.diff(i) != 1)]))
                    more = np.diff(np.append(first, len(hit))) - 1
                    yield pa.RecordBatch.from_arrays([pa.array(doc[o[first]]), pa.array(copy[o[first]]), pa.array((start[o[first]] + i[first]) << 7 | more)], names=["doc", "copy", "starts"])

    windows = found.where(F.col("kind") == OPEN).agg(F.sum(F.shiftright("place", 7).bitwiseAND(127) + 1)).first()[0] or 0
    parts = open_parts(docs, found).withColumn("turn", F.pmod(F.xxhash64("anchor", "family"), F.lit(FAMILIES)).cast("int"))
    parts = parts.repartition(max(1, -(-windows // TASK_WINDOWS)), "anchor", "family").sortWithinPartitions("turn", "doc", "copy", "start").select("doc", "copy", "start", "bytes", "turn")
    return parts.mapInArrow(scan, "doc long, copy long, starts long")


def spans_of(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches of bytes (start, end) that repeated windows cover."""
    begin = np.sort(starts)
    end = (begin >> 7) + (begin & 127) + LENGTH
    begin >>= 7
    reach = np.maximum.accumulate(end)
    first = np.flatnonzero(np.concatenate([[True], begin[1:] > reach[:-1]]))
    return begin[first], reach[np.append(first[1:], len(begin)) - 1]


def numbered(docs: DataFrame) -> DataFrame:
    """docs with doc (doc_id, or NO_ID for null) and copy, which tells rows with one doc_id and different texts apart (0 elsewhere).

    Most tables have no such doc_id; then, and where they are few enough to be broadcast, the texts aren't shuffled for it.
    """
    own = docs.withColumn("doc", F.coalesce(F.col("doc_id"), F.lit(NO_ID)))
    hashed = own.select(F.col("doc").alias("_doc"), F.xxhash64("text").alias("_hash"))
    several = stored(hashed.groupBy("_doc").agg(F.min("_hash").alias("_a"), F.max("_hash").alias("_b")).where("_a <> _b").select("_doc"))
    n = several.count()
    if not n:
        return own.withColumn("copy", F.lit(0).cast("long"))
    joined = own.join(F.broadcast(several) if n <= BROADCAST_ROWS else several, own["doc"] == several["_doc"], "left")
    return joined.withColumn("copy", F.when(F.col("_doc").isNotNull(), F.xxhash64("text")).otherwise(F.lit(0))).drop("_doc")


def without_repeats(docs: DataFrame, as_text: bool = False, nulls_first: bool = False) -> DataFrame:
    """docs with n_bytes, n_removed, n_spans and kept (binary): the UTF-8 bytes that no earlier repeat covers.

    With as_text kept is a string, without the bytes of characters that a cut goes through, and null for a null text.

    A byte goes if a string of LENGTH bytes over it also starts earlier: in a smaller doc_id, or before in the same
    document. All strings are judged on the text as given. A null text is empty. A row with a null doc_id has no place in the order: it stays
    whole and nothing repeats it, unless nulls_first puts such rows before all others. Rows with one doc_id (or none) and different texts
    are documents of their own, in the order of a hash of the text; rows that repeat both get the same result. Columns of docs named like the results are replaced, others are kept, whatever their names. An empty table gives an empty one.
    """
    names = [c for c in docs.columns if c not in ("doc_id", "text", *RESULTS)]
    extra = [F.col(f"`{c}`").alias(f"_x{k}") for k, c in enumerate(names)]
    own = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *extra))
    ordered = own if nulls_first else own.where("doc_id IS NOT NULL")
    found = surveyed(ordered)
    start, windows = F.shiftright("place", 14), F.shiftright("place", 7).bitwiseAND(127)
    whole = found.where(F.col("kind") == REPEATED).select("doc", "copy", (F.shiftleft(start, 7) + windows).alias("starts"))
    marks = whole.unionByName(stored(marked(ordered, found))).groupBy("doc", "copy").agg(F.collect_list("starts").alias("_repeats"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_slices(batch, "text"):
                rows = []
                for text, starts in zip(part.column("text"), part.column("_repeats")):
                    data = (text.as_py() or "").encode()
                    begin, end = spans_of(starts.values.to_numpy()) if starts.is_valid else (np.zeros(0, np.int64),) * 2
                    kept = b"".join(data[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(data)]))
                    out = kept if not as_text else kept.decode("utf-8", "ignore") if text.is_valid else None
                    rows.append((len(data), len(data) - len(kept), len(begin), out))
                n, removed, spans, kept = zip(*rows)
                columns = [c for name, c in zip(part.schema.names, part.columns) if name != "_repeats"]
                names = [c for c in part.schema.names if c != "_repeats"]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.string() if as_text else pa.binary())], names=[*names, *RESULTS])

    joined = own.join(marks, ["doc", "copy"], "left").select("doc_id", "text", *[f"_x{k}" for k in range(len(names))], "_repeats")
    schema = T.StructType([f for f in joined.schema.fields if f.name != "_repeats"])
    for name in RESULTS[:3]:
        schema = schema.add(name, "long")
    out = joined.mapInArrow(cut, schema.add(RESULTS[3], "string" if as_text else "binary"))
    return out.select("doc_id", "text", *[F.col(f"_x{k}").alias(c) for k, c in enumerate(names)], *RESULTS)


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op9_suffix_array_dedup": op9_suffix_array_dedup}
ORACLES: dict[str, str] = {}
