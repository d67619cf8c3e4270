"""Collocations: phrases of two and three words mined by Toivonen's sampling."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, table
from .ctw import mixed

#: Phrases that occur less often are no candidates, and each language's best so many are returned.
LEAST, BEST = 10, 2000
#: One text in so many (by a hash of the text) is in the sample, and phrases that occur there so often are proposed. The sample
#: only proposes; all counts are of all texts.
SAMPLED, PROPOSED = 8, 2
#: Bits of the table that tells the passes which words and pairs are thought frequent. Two keys that share a bit make a pass count a phrase too
#: many, never too few. Its size is fixed (16 MB), so it may be broadcast.
TABLE_BITS, CHUNK = 27, 1 << 16
#: Slots in which a task remembers the keys that it told (8 bytes each).
TOLD_BITS = 21
#: Bytes of text that are counted at once.
AT_ONCE = 1 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
# What parts words, and what parts pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
_TWO, _THREE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Words:
    """The words of some texts: place, language (as a hash), key, and whether the next one follows in the same piece."""

    def __init__(self, texts: list[bytes], langs: np.ndarray):
        self.data = _FOLD[np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)]
        kind = _KIND[self.data]
        edge = np.flatnonzero((kind[1:] == 0) != (kind[:-1] == 0)) + 1
        self.starts, self.ends = edge[::2], edge[1::2]
        offsets = np.cumsum([1, *(len(t) + 1 for t in texts)])[:-1]
        of = np.searchsorted(offsets, self.starts, "right") - 1
        breaks = np.cumsum(kind == 2)[self.starts] if len(self.starts) else self.starts
        self.goes_on = breaks[1:] == breaks[:-1]
        self.lang = langs[of] if len(self.starts) else np.zeros(0, np.uint64)
        self.own = self._hashes()
        self.word = mixed(self.own + self.lang)

    def _hashes(self) -> np.ndarray:
        lengths = self.ends - self.starts
        if not len(lengths):
            return np.zeros(0, np.uint64)
        first = np.cumsum(lengths) - lengths
        power = np.cumprod(np.full(lengths.max(), 0x9FB21C651E98DF25, np.uint64))
        total = lengths.sum()
        place = np.arange(total) - np.repeat(first, lengths)
        letters = self.data[np.repeat(self.starts, lengths) + place].astype(np.uint64) + np.uint64(1)
        return mixed(np.add.reduceat(letters * power[place], first))

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """First word and key of each pair of neighbours."""
        i = np.flatnonzero(self.goes_on)
        return i, mixed(self.own[i] * _TWO + self.own[i + 1] + self.lang[i])

    def triples(self) -> tuple[np.ndarray, np.ndarray]:
        i = np.flatnonzero(self.goes_on[1:] & self.goes_on[:-1]) if len(self.goes_on) > 1 else np.zeros(0, np.int64)
        return i, mixed(self.own[i] * _THREE + self.own[i + 1] * _TWO + self.own[i + 2] + self.lang[i] + np.uint64(1))

    def phrase(self, i: int, words: int) -> bytes:
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(self.starts[i : i + words].tolist(), self.ends[i : i + words].tolist()))


def lang_hash(lang: bytes) -> int:
    out = 0
    for b in lang:
        out = (out * 0x100000001B3 + b + 1) & (1 << 64) - 1
    return int(mixed(np.array([out], np.uint64))[0])


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, dict[int, str]]]:
    """Words of at most AT_ONCE bytes of texts (or of one text), and the languages by hash."""
    known: dict[str, int] = {}
    for batch in batches:
        own, langs, names, size = [], [], {}, 0
        for text, lang in zip(batch.column(0), batch.column(1)):
            data, lang = (text.as_py() or "").encode(), lang.as_py()
            if own and size + len(data) > AT_ONCE:
                yield Words(own, np.array(langs, np.uint64)), names
                own, langs, names, size = [], [], {}, 0
            if lang not in known:
                if len(known) > 10_000:
                    known = {}
                known[lang] = lang_hash(lang.encode())
            own.append(data)
            langs.append(known[lang])
            names[known[lang]] = lang
            size += len(data)
        if own:
            yield Words(own, np.array(langs, np.uint64)), names


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))


def _rows(columns: list[np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    for low in range(0, len(columns[0]), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[low : low + 100_000].view(np.int64) if c.dtype == np.uint64 else c[low : low + 100_000].astype(np.int64)) for c in columns], names=names)


def has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys >> np.uint64(64 - TABLE_BITS)
    return (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def bit_table(keys: DataFrame) -> np.ndarray:
    """A table with the bits of all keys set, made in pieces of 64 kB by Spark; the driver gets 16 MB at most."""

    def piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            slot = batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - TABLE_BITS)
            at = slot // np.uint64(8 * CHUNK)
            for k in np.unique(at).tolist():
                own = slot[at == k] % np.uint64(8 * CHUNK)
                np.bitwise_or.at(found.setdefault(k, np.zeros(CHUNK, np.uint8)), (own >> np.uint64(3)).astype(np.int64), np.uint8(1) << (own & np.uint64(7)).astype(np.uint8))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([x.tobytes() for x in found.values()], pa.binary())], names=["k", "bits"])

    out = np.zeros((1 << TABLE_BITS) // 8, np.uint8)
    spread = F.shiftrightunsigned("key", 64 - TABLE_BITS + 3 + CHUNK.bit_length() - 1)
    for r in keys.select("key").repartition(spread).mapInArrow(piece, "k int, bits binary").collect():  # each of the 256 pieces is made by one task
        out[r.k * CHUNK : (r.k + 1) * CHUNK] |= np.frombuffer(r.bits, np.uint8)
    return out


def _wanted(w: Words, bits: np.ndarray | None, done: np.ndarray | None) -> Iterator[tuple[int, np.ndarray]]:
    """size, keys of the occurrences to count: words, pairs of words in bits and triples of pairs in bits, less those that were so by done.

    Without bits, words and all pairs.
    """
    if done is None:
        yield 1, w.word
    i, pair = w.pairs()
    if bits is None:
        yield 2, pair
        return
    j, triple = w.triples()

    def opened(table: np.ndarray) -> Iterator[np.ndarray]:
        word = has(table, w.word)
        yield word[i] & word[i + 1]
        both = np.zeros(len(w.word), bool)
        both[i[has(table, pair)]] = True
        yield both[j] & both[j + 1]

    ok = list(opened(bits))
    if done is not None:
        ok = [a & ~b for a, b in zip(ok, opened(done))]
    yield 2, pair[ok[0]]
    yield 3, triple[ok[1]]


def counts(docs: DataFrame, bits: np.ndarray | None, done: np.ndarray | None = None) -> DataFrame:
    """key, size, a: how often each phrase occurs whose parts are in the table (all words, too), without those that an earlier table had."""
    sc = docs.sparkSession.sparkContext
    told, before = sc.broadcast(bits), sc.broadcast(done)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w, _ in _batches(batches):
            for size, key in _wanted(w, told.value, before.value):
                keys, times = np.unique(key, return_counts=True)
                yield from _rows([keys, np.full(len(keys), size), times], ["key", "size", "a"])

    return _texts(docs).mapInArrow(count, "key long, size long, a long").groupBy("key", "size").agg(F.sum("a").alias("a"))


def frequent(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """key, size, a: all words, pairs and triples that occur at least so often, with exact counts.

    The sample proposes words and pairs. A full pass counts what it proposes and its negative border: all words, all pairs of proposed words, all triples of two
    proposed pairs. Words and pairs of the border that turn out frequent are proposed too, and another pass counts what they open, until
    nothing new is frequent. A phrase is counted in one pass in full or not in it at all.
    """
    sample = docs.where(F.pmod(F.xxhash64(F.col("text").cast("string")), F.lit(SAMPLED)) == 0)
    seen = counts(sample, None).where(F.col("a") >= PROPOSED)
    bits, done, found = bit_table(seen), None, None
    while True:
        new = stored(counts(docs, bits, done).where(F.col("a") >= least))
        found = new if found is None else found.unionByName(new)
        done, bits = bits, bits | bit_table(new.where("size < 3"))
        if np.array_equal(bits, done):
            return found


def parts(docs: DataFrame, found: DataFrame) -> DataFrame:
    """key, size, a, x, y of what is in found (key, size, a): of a pair the keys of its words, of a triple those of its two pairs, of a word its language (a hash) and 0.

    Found in the texts; a bit table tells where to look. A task tells a key once (or again, where others took its slot in between), so texts are read in fewer, longer tasks
    than elsewhere.
    """
    docs = docs.coalesce(max(8, docs.rdd.getNumPartitions() // 4))
    told = docs.sparkSession.sparkContext.broadcast(bit_table(found))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told_last = np.zeros(1 << TOLD_BITS, np.uint64)  # of the keys of each slot the one that this task told last
        for w, _ in _batches(batches):
            (i, pair), (j, triple) = w.pairs(), w.triples()
            at = np.zeros(len(w.word), np.uint64)
            at[i] = pair
            for size, place, key in ((1, np.arange(len(w.word)), w.word), (2, i, pair), (3, j, triple)):
                ok = np.flatnonzero(has(told.value, key))
                slot = (key[ok] >> np.uint64(64 - TOLD_BITS)).astype(np.int64)
                ok, slot = (c[told_last[slot] != key[ok]] for c in (ok, slot))
                new, first = np.unique(key[ok], return_index=True)
                told_last[slot[first]] = new
                p = place[ok[first]]
                own = w.word if size < 3 else at
                if len(new):
                    yield from _rows([new, w.lang[p] if size == 1 else own[p], np.zeros(len(p), np.uint64) if size == 1 else own[p + 1]], ["key", "x", "y"])

    rows = _texts(docs).mapInArrow(look, "key long, x long, y long").distinct()
    return rows.join(found.withColumnRenamed("key", "_key"), F.col("key") == F.col("_key")).select("key", "size", "a", "x", "y")


def phrase_texts(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """_key, phrase: the words of some phrases."""
    told = docs.sparkSession.sparkContext.broadcast(bit_table(keys))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for w, _ in _batches(batches):
            for size, (place, key) in ((2, w.pairs()), (3, w.triples())):
                ok = np.flatnonzero(has(told.value, key))
                new, first = np.unique(key[ok], return_index=True)
                rows = [(k, w.phrase(p, size)) for k, p in zip(new.view(np.int64).tolist(), place[ok[first]].tolist()) if k not in seen]
                if len(seen) > 1 << 18:
                    seen = set()
                seen.update(k for k, _ in rows)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int64()), pa.array([p.decode() for _, p in rows], pa.string())], names=["_key", "phrase"])

    return _texts(docs).mapInArrow(look, "_key long, phrase string").join(keys.select(F.col("key").alias("_k")), F.col("_key") == F.col("_k"), "left_semi").distinct()


def languages(docs: DataFrame) -> DataFrame:
    """lang, _lang (its hash), n: all word occurrences of each language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w, names in _batches(batches):
            hashes, times = np.unique(w.lang, return_counts=True)
            if len(hashes):
                yield pa.RecordBatch.from_arrays([pa.array([names[h] for h in hashes.tolist()]), pa.array(hashes.view(np.int64)), pa.array(times.astype(np.int64))], names=["lang", "_lang", "n"])

    return _texts(docs).mapInArrow(count, "lang string, _lang long, n long").groupBy("lang", "_lang").agg(F.sum("n").alias("n"))


def floor_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), in decimals of 38 digits."""
    big = lambda c: c.cast("decimal(15,0)")
    top, bottom = (F.lit(1_000_000).cast("decimal(7,0)") * (big(a) * big(a))).cast("decimal(38,0)"), (big(left) * big(right)).cast("decimal(38,0)")
    return ((top - F.pmod(top, bottom)) / bottom).cast("long")


def collocations(docs: DataFrame, least: int = LEAST, best: int = BEST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of two or three words.

    A-Z are lower-cased, a null text is empty and a null lang is und. A phrase occurs a times in pieces of text, overlaps included; it is a candidate with a >= least. Its score is the
    smaller of floor(1000000 a a / (l r)) over its cuts (of equal ones the first cut), where l and r count the parts. Candidates are dropped if they lie in a longer candidate that
    occurs at least half as often. Ties of score go to larger a, then to the smaller phrase in the order of bytes. Repeated rows count each time. Other columns are ignored; an empty table, and one without
    frequent phrases, give an empty one. Phrases are counted by 64-bit keys of their bytes and language.
    """
    rows = stored(parts(docs, stored(frequent(docs, least))))
    own = {n: rows.where(F.col("size") == n) for n in (1, 2, 3)}
    word = lambda side: own[1].select(F.col("key").alias(f"_{side}"), F.col("a").alias(side), F.col("x").alias(f"{side}_lang"))
    pairs = own[2].join(word("l"), F.col("x") == F.col("_l")).join(word("r"), F.col("y") == F.col("_r"))
    pairs = stored(pairs.select("key", F.col("l_lang").alias("lang"), "a", "l", "r", floor_score(F.col("a"), F.col("l"), F.col("r")).alias("score")))
    half = lambda side: pairs.select(*[F.col(c).alias(f"{side}_{c}") for c in ("key", "lang", "a", "l", "r")])
    triples = own[3].join(half("h"), F.col("x") == F.col("h_key")).join(half("t"), F.col("y") == F.col("t_key"))
    one, two = floor_score(F.col("a"), F.col("h_l"), F.col("t_a")), floor_score(F.col("a"), F.col("h_a"), F.col("t_r"))
    pick = lambda x, y: F.when(two < one, y).otherwise(x)
    triples = triples.select("key", F.col("h_lang").alias("lang"), "a", pick(F.col("h_l"), F.col("h_a")).alias("l"), pick(F.col("t_a"), F.col("t_r")).alias("r"), pick(one, two).alias("score"))
    holders = own[3].select(F.explode(F.array("x", "y")).alias("_in"), F.col("a").alias("_a")).groupBy("_in").agg(F.max("_a").alias("_a"))
    kept = pairs.join(holders, F.col("key") == F.col("_in"), "left").where("_a IS NULL OR 100 * _a < 50 * a").select(*pairs.columns).unionByName(triples)
    kept = stored(kept)
    # the text decides among ties only, so it is fetched for the best and those that tie with the last of them
    order = [F.desc("score"), F.desc("a")]
    first = kept.withColumn("_r", F.row_number().over(W.partitionBy("lang").orderBy(*order, "key"))).where(F.col("_r") <= best)
    edge = first.groupBy("lang").agg(F.min(F.struct("score", "a")).alias("_edge")).withColumnRenamed("lang", "_l")
    won = stored(kept.join(F.broadcast(edge), F.col("lang") == F.col("_l")).where(F.struct("score", "a") >= F.col("_edge")).drop("_l", "_edge"))  # a row for each language
    named = won.join(phrase_texts(docs, won.select("key")), F.col("key") == F.col("_key")).withColumnRenamed("lang", "_of")
    ranked = named.withColumn("rank", F.row_number().over(W.partitionBy("_of").orderBy(*order, "phrase")).cast("long")).where(F.col("rank") <= best)
    return ranked.join(F.broadcast(languages(docs)), F.col("_of") == F.col("_lang")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_toivonen_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable] = {"op11_toivonen_collocations": op11_toivonen_collocations}
ORACLES: dict[str, str] = {
    "op11_toivonen_collocations": r"""
        WITH p AS (
            SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        q AS (SELECT lang, [x FOR x IN string_split_regex(piece, '[\x20\x09]+') IF x <> ''] AS w FROM p),
        u AS (SELECT lang, unnest(w) AS phrase FROM q),
        f1 AS (SELECT lang, phrase, count(*) AS f FROM u GROUP BY ALL),
        f2 AS (SELECT lang, a, b, count(*) AS f FROM (SELECT lang, unnest([{'a': w[i], 'b': w[i + 1]} FOR i IN range(1, len(w))], recursive := true) FROM q) GROUP BY ALL),
        f3 AS (SELECT lang, a, b, c, count(*) AS f FROM (SELECT lang, unnest([{'a': w[i], 'b': w[i + 1], 'c': w[i + 2]} FOR i IN range(1, len(w) - 1)], recursive := true) FROM q) GROUP BY ALL HAVING count(*) >= 10),
        n AS (SELECT lang, count(*) AS n FROM u GROUP BY ALL),
        held AS (SELECT lang, a, b, max(f) AS f FROM (SELECT lang, a, b, f FROM f3 UNION ALL SELECT lang, b, c, f FROM f3) GROUP BY ALL),
        c2 AS (
            SELECT f2.lang, f2.a || ' ' || f2.b AS phrase, f2.f AS a, x.f AS l, y.f AS r, 1000000::HUGEINT * f2.f::HUGEINT * f2.f::HUGEINT // (x.f::HUGEINT * y.f::HUGEINT) AS score
            FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.phrase = f2.a JOIN f1 y ON y.lang = f2.lang AND y.phrase = f2.b
            LEFT JOIN held h ON h.lang = f2.lang AND h.a = f2.a AND h.b = f2.b WHERE f2.f >= 10 AND (h.f IS NULL OR 100 * h.f < 50 * f2.f)),
        c3 AS (
            SELECT f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c AS phrase, f3.f AS a, x.f AS l1, bc.f AS r1, ab.f AS l2, z.f AS r2,
                1000000::HUGEINT * f3.f::HUGEINT * f3.f::HUGEINT // (x.f::HUGEINT * bc.f::HUGEINT) AS s1, 1000000::HUGEINT * f3.f::HUGEINT * f3.f::HUGEINT // (ab.f::HUGEINT * z.f::HUGEINT) AS s2
            FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.phrase = f3.a JOIN f1 z ON z.lang = f3.lang AND z.phrase = f3.c
            JOIN f2 ab ON ab.lang = f3.lang AND ab.a = f3.a AND ab.b = f3.b JOIN f2 bc ON bc.lang = f3.lang AND bc.a = f3.b AND bc.b = f3.c),
        c AS (SELECT * FROM c2 UNION ALL SELECT lang, phrase, a, CASE WHEN s2 < s1 THEN l2 ELSE l1 END, CASE WHEN s2 < s1 THEN r2 ELSE r1 END, least(s1, s2) FROM c3)
        SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
        FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM c) JOIN n USING (lang) WHERE rank <= 2000
    """,
}
