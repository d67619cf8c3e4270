"""Best-fit packing of token sequences by linear grouping."""

from __future__ import annotations

import re
import string
import struct
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import spread_rank, stored, table

CAPACITY = 1024
END_ID = 2
#: A worker keeps the ids of at most twice so many different words.
CACHED_WORDS = 500_000
#: Bytes of ids that a worker gives back at once.
HELD = 1 << 20

SPACES_MEET = re.compile(r"\s\s")
UNUSUAL = re.compile(r"[\t\r\x0b\x0c\x1c-\x1f]")

PIECES = "doc_id long, piece int, start long, length long, ids binary"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Words(dict):
    """Ids by word; a word that isn't there is asked of the encoder once."""

    def __init__(self, encoder: WordEncoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, w: str) -> bytes:
        ids = self[w] = self.encoder.new(w)
        return ids


class WordEncoder:
    """Ids of texts as little-endian uint32 bytes, by the tokenizer, which sees each different word once.

    In a text where no two white-space characters meet, this byte-level BPE merges nothing across them, nor between
    a letter or digit and the punctuation after it. So such a text is put together from its words, each with the
    space or line end before it; other texts, and those with a special token's string, go to the tokenizer whole. Two generations of
    words are kept: the older one is dropped when the newer one is full.
    """

    def __init__(self, path: str, limit: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer, self.limit, self.cache, self.old, self.tails = Tokenizer.from_file(path), limit, Words(self), {}, {}
        self.whole = ["  ", "\n\n", " \n", "\n ", *(x.content for x in self.tokenizer.get_added_tokens_decoder().values())]

        # the byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        samples = [" word", "\nNext", " \u00e9t\u00e9"]
        self.by_model = [self.word(x[1:] if x[0] == " " else x) for x in samples] == self.direct(samples)

    def word(self, core: str) -> bytes:
        """Ids of letters alone, with the space or the line end before them, from the model without its pre-tokenizer."""
        first, rest = core[:1] == "\n", core.removeprefix("\n")
        shown = rest if rest.isascii() else rest.encode().decode("latin-1").translate(self.letters)
        ids = [k.id for k in self.tokenizer.model.tokenize(shown if first else self.letters[32] + shown)]
        if first:
            ids = [k.id for k in self.tokenizer.model.tokenize(self.letters[10])] + ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def direct(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def new(self, w: str) -> bytes:
        """Ids of a word that the newer generation lacks: those of its letters and digits, then those of the punctuation after them."""
        if (ids := self.old.get(w)) is not None:
            return ids
        core = w.rstrip(string.punctuation)
        if len(core) == len(w) or not core[-1:].isalnum():
            return self.word(w) if self.by_model and w.removeprefix("\n").isalpha() else self.direct([w if w[:1] == "\n" else " " + w])[0]
        tail = w[len(core) :]
        if tail not in self.tails:
            if len(self.tails) > 10_000:
                self.tails = {}
            self.tails[tail] = self.direct([tail])[0]
        return self.cache[core] + self.tails[tail]

    def encode(self, text: str) -> bytes:
        if any(x in text for x in self.whole) or (not text.isascii() or UNUSUAL.search(text)) and SPACES_MEET.search(text):
            return self.direct([text])[0]
        first, *rest = text.replace("\n", " \n").split(" ")
        if len(self.cache) > self.limit:
            self.old, self.cache = self.cache, Words(self)
        cache = self.cache
        return (self.direct([first])[0] if first else b"") + b"".join([cache[w] for w in rest])


_encoders: dict[str, WordEncoder] = {}


def _cut(batches: Iterator[pa.RecordBatch], encode: Callable[[str], bytes], capacity: int) -> Iterator[pa.RecordBatch]:
    """The pieces of doc_id and text, in batches of about HELD bytes of ids (more only where one text has more)."""
    end, schema = np.array([END_ID], "<u4").tobytes(), pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])
    rows, held = [], 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            ids = encode(text.as_py() or "") + end
            total, start, piece = len(ids) // 4, 0, 0
            size = (total - 1) % capacity + 1 if total > capacity else total
            while start < total:
                rows.append((doc_id.as_py(), piece, start, size, ids[4 * start : 4 * (start + size)]))
                start, piece, size = start + size, piece + 1, capacity
            held += len(ids)
            if held > HELD:
                yield flush()
                rows, held = [], 0
    if rows:
        yield flush()


def _encoded(batches: Iterator[pa.RecordBatch], path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    """The pieces by the worker's encoder of that tokenizer; at the end of a task it forgets its older words, as the worker may go on to other work."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    encoder = _encoders.get(path) or _encoders.setdefault(path, WordEncoder(path))
    yield from _cut(batches, encoder.encode, capacity)
    encoder.old = {}


def tokenized_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Every document's ids and the end id, cut into pieces of at most capacity tokens.

    Returns doc_id, piece, start, length and ids (little-endian uint32). Only documents of more than
    capacity tokens are cut; all their pieces but the first have capacity tokens. A null or empty text has
    the end id alone. Rows that repeat a doc_id are documents of their own; extra columns are ignored.
    """
    path = tokenizer or default_tokenizer()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _encoded(batches, path, capacity)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


def _patterns(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """Configurations of the rounded sizes (descending) and how often each is used, until none is left.

    Each one starts with the largest size that is left and fills the rest of the sequence as far as the
    remaining counts allow; it is used as often as they last, so each uses up a size or nearly so.
    """
    left, out = list(counts), []
    while (top := next((i for i, c in enumerate(left) if c), None)) is not None:
        room = capacity - sizes[top]
        by = np.full(room + 1, -1, np.int32)  # the size that was added last to reach a sum
        by[0] = top
        for i, s in enumerate(sizes):
            if s > room:
                continue
            for _ in range(min(left[i] - (i == top), room // s)):
                fresh = np.flatnonzero((by[:-s] >= 0) & (by[s:] < 0)) + s
                if not len(fresh):
                    break
                by[fresh] = i
            if by[room] >= 0:
                break
        at, used = int(np.flatnonzero(by >= 0)[-1]), [top]
        while at > 0:
            used.append(int(by[at]))
            at -= sizes[used[-1]]
        need = {i: used.count(i) for i in set(used)}
        if any(k > left[i] for i, k in need.items()):  # the walk back took a size more often than there is
            used, need = [top], {top: 1}
        times = min(left[i] // k for i, k in need.items())
        for i, k in need.items():
            left[i] -= times * k
        out.append((used, times))
    return out


def packing_plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = 256, small: int = 128) -> tuple[np.ndarray, int]:
    """Where the pieces of each length go, from the number of pieces of each length alone.

    Linear grouping: lengths above small are put in descending order and cut into groups of equal
    cardinality, each rounded up to its largest length; configurations of those few sizes are filled
    one after the other; then the actual lengths take the places of the rounded ones, longest first. Lengths
    up to small go by best fit, in descending order, to the sequence with the least room that is enough.
    Returns runs (length, first rank, sequence, pieces per sequence, offset), sorted by length and rank, and
    the number of sequences. The size of the plan depends on capacity and groups, not on the documents.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    used_rank: dict[int, int] = defaultdict(int)
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> (first sequence, sequences)
    sequences = 0

    def put(length: int, n: int, sequence: int, each: int, offset: int) -> None:
        runs.append((length, used_rank[length], sequence, each, offset))
        used_rank[length] += n

    if full := histogram.get(capacity, 0):
        put(capacity, full, 0, 1, 0)
        sequences = full
    large = sorted(((n, c) for n, c in histogram.items() if small < n < capacity and c), reverse=True)
    total = sum(c for _, c in large)
    if total:
        # group g takes the ranks from g*total/groups; the same rounded size is one size
        edges = sorted({g * total // groups for g in range(groups)} | {total})
        rounded: dict[int, list[list[int]]] = {}
        at, i, inside = 0, 0, 0
        for low, high in zip(edges, edges[1:]):
            size = large[i][0]
            queue = rounded.setdefault(size, [])
            while at < high:
                take = min(high - at, large[i][1] - inside)
                if queue and queue[-1][0] == large[i][0]:
                    queue[-1][1] += take
                else:
                    queue.append([large[i][0], take])
                at, inside = at + take, inside + take
                if inside == large[i][1]:
                    i, inside = i + 1, 0
        sizes = sorted(rounded, reverse=True)
        for used, times in _patterns(sizes, [sum(c for _, c in rounded[s]) for s in sizes], capacity):
            slots = []  # for each place in the configuration: (end in sequences, length)
            for i in used:
                queue, got, parts = rounded[sizes[i]], 0, []
                while got < times:
                    take = min(times - got, queue[0][1])
                    got += take
                    parts.append((got, queue[0][0]))
                    queue[0][1] -= take
                    if not queue[0][1]:
                        queue.pop(0)
                slots.append(parts)
            low = 0
            for high in sorted({e for parts in slots for e, _ in parts}):
                offset = 0
                for parts in slots:
                    length = next(n for e, n in parts if e >= high)
                    put(length, high - low, sequences + low, 1, offset)
                    offset += length
                room[capacity - offset].append((sequences + low, high - low))
                low = high
            sequences += times
    for length in sorted((n for n, c in histogram.items() if n <= small and n < capacity and c), reverse=True):
        left = histogram[length]
        for free in [f for f in sorted(room) if f >= length and room[f]]:
            each, keep = free // length, []
            for first, n in room.pop(free):
                filled = min(n, left // each)
                if filled:
                    put(length, filled * each, first, each, capacity - free)
                    room[free - each * length].append((first, filled))
                    left -= filled * each
                    first, n = first + filled, n - filled
                if n and left and left < each:
                    put(length, left, first, left, capacity - free)
                    room[free - left * length].append((first, 1))
                    first, n, left = first + 1, n - 1, 0
                if n:
                    keep.append((first, n))
            if keep:
                room[free].extend(keep)
            if not left:
                break
        if left:
            each = capacity // length
            filled, rest = divmod(left, each)
            if filled:
                put(length, filled * each, sequences, each, 0)
                room[capacity - each * length].append((sequences, filled))
            if rest:
                put(length, rest, sequences + filled, rest, 0)
                room[capacity - rest * length].append((sequences + filled, 1))
            sequences += filled + (rest > 0)
    return np.array(sorted(runs), np.int64).reshape(-1, 5), sequences


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = 256) -> DataFrame:
    """pieces (doc_id, piece, length, any other columns) with sequence_id and offset.

    The driver sees the number of pieces of each length (capacity rows at most) and makes the plan; a
    piece finds its place by its rank among the pieces of its length. Every piece is placed, pieces of
    repeated rows too, each in a place of its own. An empty table gives an empty table.
    """
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs, _ = packing_plan(histogram, capacity, groups)
    keys = runs[:, 0] << 44 | runs[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        run = runs[np.searchsorted(keys, n << 44 | r, "right") - 1]
        at = r - run[:, 1]
        return pd.DataFrame({"sequence_id": run[:, 2] + at // run[:, 3], "offset": run[:, 4] + at % run[:, 3] * n})

    ranked = spread_rank(pieces, ["length"], [F.col("doc_id"), F.col("piece")], F.xxhash64("doc_id", "piece"), "_rank")
    return ranked.withColumn("_place", place("length", "_rank")).select(*pieces.columns, "_place.sequence_id", "_place.offset")


def packed_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with their checksums and places; the ids themselves are not kept."""
    pieces = tokenized_pieces(docs, tokenizer, capacity)
    return pack(stored(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))), capacity)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op8_best_fit_packing": op8_best_fit_packing}
ORACLES: dict[str, str] = {}
