"""Language-model scoring by context-tree weighting over bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_groups, stored, table

#: Bytes of context. A gram is a context and the byte after it, so keys have 8 * (DEPTH + 1) bits.
DEPTH = 5
EDGE = 0xFF  # stands before and after each text; UTF-8 has no such byte
#: Depths up to this one meet on the driver (at most 2 ** 24 nodes, however large the input); deeper ones are split by their last context bytes.
TOP = 2
#: Bytes of text that are worked on at once, and that are scored with one table of their own grams.
AT_ONCE, PART = 1 << 20, 16 << 20
#: Rows of grams that a task works on at once; a group of one three-byte context is never cut.
ROWS_AT_ONCE = 200_000
GRAM, WORD = 0, 1

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IN_WORD = np.ones(256, bool)
_IN_WORD[[0x20, *range(0x09, 0x0E), EDGE]] = False
_MASK = [np.uint64((1 << 8 * d) - 1) for d in range(DEPTH + 1)]


def mixed(keys: np.ndarray) -> np.ndarray:
    """A one-to-one shuffle of 64-bit keys."""
    k = keys * np.uint64(0x9E3779B97F4A7C15)
    k ^= k >> np.uint64(32)
    k *= np.uint64(0xD6E8FEB86659FD93)
    return k ^ (k >> np.uint64(32))


class Lookup:
    """Values by 64-bit key: keys sorted by their mix, with a directory of its first bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        m = mixed(keys.view(np.uint64))
        order = np.argsort(m)
        self.keys, self.values = m[order], values[order]
        bits = max(1, int(np.ceil(np.log2(len(keys) + 1))))
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.keys >> self.shift, np.arange(2**bits + 1, dtype=np.uint64)).astype(np.int32)

    def get(self, keys: np.ndarray, default: float) -> np.ndarray:
        out = np.full(len(keys), default, self.values.dtype)
        if not len(self.keys) or not len(keys):
            return out
        m = mixed(keys.view(np.uint64))
        part = (m >> self.shift).astype(np.int64)
        at, end = self.first[part], self.first[part + 1]
        todo = np.flatnonzero(at < end)
        at, end, m = at[todo], end[todo], m[todo]
        while len(todo):
            hit = self.keys[at] == m
            out[todo[hit]] = self.values[at[hit]]
            go = ~hit
            at = at + 1
            go &= at < end
            todo, at, end, m = todo[go], at[go], end[go], m[go]
        return out


class Texts:
    """Some texts as one array of bytes, A-Z folded, with an edge of DEPTH bytes before and one byte after each."""

    def __init__(self, texts: list[bytes]):
        lead = bytes([EDGE]) * DEPTH
        raw = b"".join(x for t in texts for x in (lead, t, lead[:1]))
        self.data = _FOLD[np.frombuffer(raw, np.uint8)]
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes + DEPTH + 1)[:-1]])

    def grams(self) -> np.ndarray:
        """Key of each byte and of each text's end, text by text (sizes + 1 of each)."""
        padded = np.concatenate([np.zeros(7 - DEPTH, np.uint8), self.data])
        key = np.ndarray((len(padded) - 7,), ">u8", padded, 0, (1,)).astype(np.uint64) & np.uint64((1 << 8 * (DEPTH + 1)) - 1)
        keep = np.ones(len(self.data), bool)
        keep[(self.offsets[:, None] + np.arange(DEPTH)).ravel()] = False
        return key[keep[DEPTH:]]

    def sums(self, table: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The sum over each text's grams of their values, by a sorted table of grams that holds them all. At most 65,536 texts."""
        of = np.repeat(np.arange(len(self.sizes), dtype=np.uint64), self.sizes + 1)
        both = np.sort(self.grams() << np.uint64(16) | of)
        key = both >> np.uint64(16)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        own = values[np.searchsorted(table, key[first])]
        return np.bincount((both & np.uint64(0xFFFF)).astype(np.int64), np.repeat(own, np.diff(np.append(first, len(key)))), len(self.sizes))

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each word and the number of the text that it is in."""
        inside = _IN_WORD[self.data]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, ends = edge[::2], edge[1::2]
        if not len(starts):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        lengths = ends - starts
        first = np.cumsum(lengths) - lengths
        power = np.cumprod(np.full(lengths.max(), 0x9FB21C651E98DF25, np.uint64))
        letters = self.data[inside].astype(np.uint64) + np.uint64(1)
        place = np.arange(len(letters)) - np.repeat(first, lengths)
        return np.add.reduceat(letters * power[place], first), np.searchsorted(self.offsets, starts, "right") - 1


def _runs(ids: list, held: list, texts: list) -> Iterator[tuple[list, list, Texts]]:
    """(ids, held-out flags, texts) of at most AT_ONCE bytes and 65,536 texts, or one text."""
    low, size = 0, 0
    own: list[bytes] = []
    for k, t in enumerate(texts):
        data = (t or "").encode()
        if own and (size + len(data) > AT_ONCE or len(own) == 1 << 16):
            yield ids[low:k], held[low:k], Texts(own)
            low, size, own = k, 0, []
        own.append(data)
        size += len(data)
    if own:
        yield ids[low:], held[low:], Texts(own)


def parted(docs: DataFrame) -> DataFrame:
    """part, rows: docs (doc_id, held_out, text) as compressed blocks of rows, in parts of at most PART bytes of text or one text.

    A part is what is scored with one table of grams. The blocks are written once, so a row stays in its part.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("text", pa.string())])

    def block(part: int, rows: pa.RecordBatch) -> pa.RecordBatch:
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_batch(rows)
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([out.getvalue().to_pybytes()], pa.binary())], names=["part", "rows"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, filled = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            own = pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, schema)], schema=schema)
            sizes = pc.fill_null(pc.binary_length(own.column(2)), 0).to_numpy(zero_copy_only=False)
            low, size = 0, 0
            for k, n in enumerate(sizes.tolist()):
                if k > low and (size + n > AT_ONCE or filled + n > PART):
                    yield block(part, own.slice(low, k - low))
                    low, size = k, 0
                if filled and filled + n > PART:
                    part, filled = part + 1, 0
                size, filled = size + n, filled + n
            if low < len(sizes):
                yield block(part, own.slice(low))

    return stored(docs.mapInArrow(deal, "part long, rows binary"))


def _unblocked(rows: pa.Array) -> Iterator[tuple[list, list, Texts]]:
    for data in rows:
        table = pa.ipc.open_stream(data.as_buffer()).read_all()
        yield from _runs(*(c.to_pylist() for c in table.columns))


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def gathered(parts: DataFrame) -> DataFrame:
    """kind, key, n, parts: how often each gram and each word stands in the texts to learn from, and the parts (64-bit numbers) that it is in.

    Grams of held-out texts come too, with n 0 for those alone, so that they get a score. Parts send their keys in buckets, about
    twice as many as there are parts, so that neither a row nor a bucket holds more keys for a larger input.
    """
    shift = np.uint64(64 - max(4, (2 * parts.select("part").distinct().count() - 1).bit_length()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {GRAM: [], WORD: []}
        at = None

        def put(kind: int, keys: np.ndarray, counts: np.ndarray) -> None:
            held[kind].append((keys, counts))
            if len(held[kind]) > 1 and sum(len(k) for k, _ in held[kind][1:]) > max(1_000_000, len(held[kind][0][0])):
                merge(kind)

        def merge(kind: int) -> None:
            held[kind] = [_summed(np.concatenate([k for k, _ in held[kind]]), np.concatenate([c for _, c in held[kind]]))]

        def flush() -> Iterator[pa.RecordBatch]:
            for kind in held:
                if held[kind]:
                    merge(kind)
                    keys, counts = held[kind].pop()
                    bucket = (mixed(keys) >> shift).astype(np.int64)
                    order = np.argsort(bucket.astype(np.uint16) if shift >= 48 else bucket, kind="stable")
                    bucket, keys, counts = bucket[order], keys[order], counts[order].astype(np.int64)
                    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
                    cells = list(zip(first.tolist(), np.append(first[1:], len(keys)).tolist()))
                    for low in range(0, len(cells), 200):
                        own = cells[low : low + 200]
                        columns = [bucket[first[low : low + 200]], np.full(len(own), kind), np.full(len(own), at), [b - a for a, b in own], pa.array([_planes(keys[a:b]) for a, b in own], pa.binary()), pa.array([_planes(counts[a:b]) for a, b in own], pa.binary())]
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns[:4]] + columns[4:], names=["bucket", "kind", "part", "n", "keys", "counts"])

        for batch in batches:
            for k, part in enumerate(batch.column(0).to_pylist()):
                if part != at:
                    yield from flush()
                    at = part
                for _, flags, texts in _unblocked(batch.column(1).slice(k, 1)):
                    train = ~np.array(flags, bool)
                    words, of = texts.words()
                    for kind, keys, learn in ((GRAM, texts.grams(), np.repeat(train, texts.sizes + 1)), (WORD, words, train[of])):
                        for own, used in ((keys[learn], 1), (keys[~learn], 0)):
                            if len(own):
                                u, n = np.unique(own, return_counts=True)
                                put(kind, u, n * used)
        yield from flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in in_groups(batches, ["bucket"], 1):  # sorted by bucket and kind
            bucket, kinds = t["bucket"].to_numpy(), t["kind"].to_numpy()
            first = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (kinds[1:] != kinds[:-1])]))
            for low, high in zip(first.tolist(), np.append(first[1:], len(bucket)).tolist()):
                _, kind, part, n, keys, counts = (c.to_pylist() for c in t.slice(low, high - low).columns)
                key = np.concatenate([_unplaned(x, k, "<i8") for x, k in zip(keys, n)])
                count = np.concatenate([_unplaned(x, k, "<i8") for x, k in zip(counts, n)])
                order = np.argsort(key)
                key, count, part = key[order], count[order], np.repeat(np.array(part, np.int64), n)[order]
                new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                offsets = pa.array(8 * np.append(new, len(key)), pa.int64())
                lists = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(new), [None, offsets.buffers()[1], pa.py_buffer(part)])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(new), kind[0], np.int32)), pa.array(key[new]), pa.array(np.add.reduceat(count, new)), lists.cast(pa.binary())], names=["kind", "key", "n", "parts"])

    rows = parts.mapInArrow(count, "bucket long, kind long, part long, n long, keys binary, counts binary")
    return stored(rows.repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(meet, "kind int, key long, n long, parts binary"))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log gamma for x >= 0.5, by Stirling's series eight further on."""
    product = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6) * (x + 7)
    z = x + 8
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - np.log(product)


def _log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov estimate of any one order of a zeros and b ones."""
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - np.log(np.pi) - _log_gamma(a + b + 1)


class Level:
    """The nodes of one depth: ids (context << 8 | place in the byte's binary tree), counts, weighted log probability.

    below: the sum of the weighted log probabilities of a node's children, None at the full depth.
    """

    def __init__(self, ids: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None):
        self.ids, self.zeros, self.ones = ids, zeros, ones
        kt = _log_kt(zeros, ones)
        self.weighted = kt if below is None else np.logaddexp(kt, below) - np.log(2)
        self.stop = np.ones(len(ids)) if below is None else np.exp(kt - np.log(2) - self.weighted)
        self.seen = zeros + ones > 0
        self.one = (ones + 0.5) / (zeros + ones + 1)


def _bits(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte and each of its 8 bits, from the highest: the node in the binary tree, and the bit."""
    t = np.arange(8, dtype=np.uint64)
    return (np.uint64(1) << t) | (symbols[:, None] >> (np.uint64(8) - t)), (symbols[:, None] >> (np.uint64(7) - t)) & np.uint64(1)


def level_above(ids: np.ndarray, zeros: np.ndarray, ones: np.ndarray, weighted: np.ndarray, depth: int) -> Level:
    """The nodes of depth from the counts and the weighted log probabilities of those one deeper."""
    parent = ((ids >> np.uint64(8)) & _MASK[depth]) << np.uint64(8) | (ids & np.uint64(255))
    own, place = np.unique(parent, return_inverse=True)
    return Level(own, *(np.bincount(place.ravel(), x, len(own)) for x in (zeros, ones, weighted)))


def lower_levels(keys: np.ndarray, counts: np.ndarray) -> tuple[dict[int, Level], dict[int, np.ndarray], np.ndarray]:
    """Levels DEPTH to TOP + 1 of all grams whose last TOP + 1 context bytes are among those of keys, the place of each
    gram's 8 bits in each level, and the bits."""
    node, bit = _bits(keys & np.uint64(255))
    levels: dict[int, Level] = {}
    places: dict[int, np.ndarray] = {}
    ones = bit.ravel() == 1
    full = (((keys >> np.uint64(8)) & _MASK[DEPTH])[:, None] << np.uint64(8) | node).ravel()
    ids, place = np.unique(full, return_inverse=True)
    place, n = place.ravel(), np.repeat(counts.astype(float), 8)
    levels[DEPTH], places[DEPTH] = Level(ids, np.bincount(place[~ones], n[~ones], len(ids)), np.bincount(place[ones], n[ones], len(ids)), None), place
    for d in range(DEPTH - 1, TOP, -1):
        up = levels[d + 1]
        levels[d] = level_above(up.ids, up.zeros, up.ones, up.weighted, d)
        parent = ((up.ids >> np.uint64(8)) & _MASK[d]) << np.uint64(8) | (up.ids & np.uint64(255))
        places[d] = np.searchsorted(levels[d].ids, parent)[places[d + 1]]
    return levels, places, ones.reshape(-1, 8)


class Top:
    """Depths 0 to TOP."""

    def __init__(self, ids: np.ndarray, zeros: np.ndarray, ones: np.ndarray, weighted: np.ndarray):
        """The nodes of depth TOP with their counts and the weighted log probabilities of all their children."""
        order = np.argsort(ids)
        self.levels = [Level(ids[order], zeros[order], ones[order], weighted[order])]
        for d in range(TOP - 1, -1, -1):
            x = self.levels[0]
            self.levels.insert(0, level_above(x.ids, x.zeros, x.ones, x.weighted, d))

    def mix(self, ids: np.ndarray, deeper: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """Probability of a one at nodes of depth TOP (all of them known), given that from the next depth on and whether that was ever seen."""
        p = deeper
        for d in range(TOP, -1, -1):
            x = self.levels[d]
            at = np.searchsorted(x.ids, ((ids >> np.uint64(8)) & _MASK[d]) << np.uint64(8) | (ids & np.uint64(255)))
            p = np.where(seen, x.stop[at] * x.one[at] + (1 - x.stop[at]) * p, x.one[at])
            seen = x.seen[at]
        return p


def gram_scores(grams: DataFrame) -> DataFrame:
    """key, score: log10 of the weighted probability of each gram's byte after its context. grams: key, n.

    A node mixes its own estimate with its children's in proportion to how well each coded the texts to learn
    from. A context that was never seen there leaves the choice to the shorter one. Contexts are split by their
    last three bytes, and tasks work through them a few at a time: at most 2 ** 24 grams share those, whatever the input.
    Only the nodes of two bytes of context and fewer meet in one place.
    """
    context = F.shiftright("key", 8).bitwiseAND(0xFFFFFF)
    grams = grams.select(context.alias("context"), "key", "n").repartition("context").sortWithinPartitions("context")

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in in_groups(batches, ["context"], ROWS_AT_ONCE):
            x = lower_levels(t["key"].to_numpy().view(np.uint64), t["n"].to_numpy())[0][TOP + 1]
            parent = ((x.ids >> np.uint64(8)) & _MASK[TOP]) << np.uint64(8) | (x.ids & np.uint64(255))
            ids, place = np.unique(parent, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64)), *(pa.array(np.bincount(place.ravel(), v, len(ids))) for v in (x.zeros, x.ones, x.weighted))], names=["id", "zeros", "ones", "weighted"])

    sums = grams.mapInArrow(second, "id long, zeros double, ones double, weighted double").groupBy("id").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("weighted"))
    found = sums.toArrow()
    top = grams.sparkSession.sparkContext.broadcast(Top(found["id"].to_numpy().view(np.uint64), *(found[c].to_numpy() for c in ("zeros", "ones", "weighted"))))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in in_groups(batches, ["context"], ROWS_AT_ONCE):
            keys, counts = t["key"].to_numpy().view(np.uint64), t["n"].to_numpy()
            levels, places, ones = lower_levels(keys, counts)
            p, seen = levels[DEPTH].one[places[DEPTH]], levels[DEPTH].seen[places[DEPTH]]
            for d in range(DEPTH - 1, TOP, -1):
                x, at = levels[d], places[d]
                p = np.where(seen, x.stop[at] * x.one[at] + (1 - x.stop[at]) * p, x.one[at])
                seen = x.seen[at]
            last = levels[TOP + 1].ids
            nodes, place = np.unique(((last >> np.uint64(8)) & _MASK[TOP]) << np.uint64(8) | (last & np.uint64(255)), return_inverse=True)
            p = top.value.mix(nodes[place.ravel()][places[TOP + 1]], p, seen).reshape(-1, 8)
            total = np.log10(np.where(ones, p, 1 - p)).sum(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(total)], names=["key", "score"])

    return stored(grams.mapInArrow(score, "key long, score double"))


def _planes(x: np.ndarray) -> bytes:
    """64-bit numbers as compressed planes: all first bytes, all second ones and so on."""
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T), codec="zstd", asbytes=True)


def _unplaned(data: bytes, n: int, kind: str) -> np.ndarray:
    raw = pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view(kind).ravel()


def sent_back(values: DataFrame) -> DataFrame:
    """part, kind, n, keys, values: for each part the values of the keys that it holds, many in a row. values: kind, key, parts, value.

    Values keep 36 of their 52 binary digits (an error of 1e-11 of a score; counts of words are exact up to 2 ** 37).
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            kind, key, part, value = (np.concatenate(c) for c in zip(*held))
            held.clear()
            own = np.unique(part)
            cell = 2 * np.searchsorted(own, part) + kind
            order = np.lexsort((key, cell.astype(np.uint16) if len(own) < 1 << 15 else cell))
            kind, key, part, value = kind[order], key[order], part[order], value[order]
            first = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (kind[1:] != kind[:-1])]))
            ends = np.append(first[1:], len(key))
            cells = list(zip(first.tolist(), ends.tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[first]), pa.array(kind[first]), pa.array(ends - first), pa.array([_planes(key[a:b]) for a, b in cells], pa.binary()), pa.array([_planes(value[a:b]) for a, b in cells], pa.binary())],
                names=["part", "kind", "n", "keys", "values"])

        for batch in batches:
            for low in range(0, batch.num_rows, 10_000):
                kind, key, parts, value = batch.slice(low, 10_000).columns
                times = pc.binary_length(parts).to_numpy() // 8
                rounded = ((value.to_numpy().view(np.int64) + (1 << 15)) >> 16) << 16
                held.append((np.repeat(kind.to_numpy(), times), np.repeat(key.to_numpy(), times), np.frombuffer(b"".join(parts.to_pylist()), np.int64), np.repeat(rounded, times)))
                if sum(len(h[0]) for h in held) > 1_000_000:
                    yield from flush()
        if held:
            yield from flush()

    return values.mapInArrow(spread, "part long, kind int, n long, keys binary, values binary")


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, bits_per_byte double"


def scored(docs: DataFrame, held_out=None) -> DataFrame:
    """Every text's log10 probability under context-tree weighting and under an add-one word model, and its code length in bits per byte.

    Both learn from the rows where held_out (a Column; by default crc32 of doc_id mod 7 is 2) does not hold. A null
    text is empty and is scored as its end alone; a null doc_id counts as an empty id and repeated rows
    each count. bits_per_byte shares the code length out over the text's bytes and its end. Without a row to learn from, each bit has
    probability one half. Other columns of docs are ignored, whatever their names; an empty table gives an empty one.

    Texts are dealt into parts of PART bytes; each part is told the scores of its own grams, so nothing
    that grows with the corpus is sent to every task.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    held = held_out if held_out is not None else F.crc32(key.cast("binary")) % 7 == 2
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.col("text").cast("string").alias("text"))
    parts = parted(rows)
    found = gathered(parts)
    words = found.where(F.col("kind") == WORD)
    total = words.where("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    ends = rows.where(~F.col("held_out")).count()
    tokens, kinds = total[0] + ends, total[1] + (ends > 0)
    grams = found.where(F.col("kind") == GRAM)
    values = grams.join(gram_scores(grams.select("key", "n")), "key").select("kind", "key", "parts", F.col("score").alias("value"))
    told = sent_back(values.unionByName(words.select("kind", "key", "parts", F.col("n").cast("double").alias("value"))))

    def score(own: pa.Table, told: pa.Table) -> pa.Table:
        def told_of(kind: int) -> tuple[np.ndarray, np.ndarray]:
            cells = [(n, k, v) for w, n, k, v in zip(*(told[c].to_pylist() for c in ("kind", "n", "keys", "values"))) if w == kind]
            keys = np.concatenate([np.zeros(0, np.uint64), *(_unplaned(k, n, "<u8") for n, k, _ in cells)])
            values = np.concatenate([np.zeros(0), *(_unplaned(v, n, "<f8") for n, _, v in cells)])
            order = np.argsort(keys)
            return keys[order], values[order]

        grams, by_word, out = told_of(GRAM), Lookup(*told_of(WORD)), []
        for ids, held, texts in _unblocked(own["rows"]):
            score = texts.sums(*grams)
            hashes, of = texts.words()
            c = by_word.get(hashes, 0.0)
            n = len(ids)
            base = np.bincount(of, np.log10((c + 1) / (tokens + kinds + 1)), n) + np.log10((ends + 1) / (tokens + kinds + 1))
            columns = [pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), np.bincount(of, minlength=n) + 1, np.bincount(of[c > 0], minlength=n) + int(ends > 0), base, score, -score * np.log2(10) / (texts.sizes + 1)]
            out.append(pa.Table.from_arrays(list(map(pa.array, columns)), names=[x.split()[0] for x in SCORED.split(", ")]))
        return pa.concat_tables(out)

    out = parts.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(score, SCORED)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score", "bits_per_byte")


def op5_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"))


QUERIES = {"op5_context_tree_weighting": op5_context_tree_weighting}
ORACLES: dict[str, str] = {}
