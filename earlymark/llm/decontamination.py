"""Benchmark passages in documents: SimHash windows, multi-index Hamming blocks, exact weighted similarity.

DataFrame functions only: no Python runs on the executors.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, table, words

SHINGLE = 5
NO_ID = -(1 << 63)  # stands for a null doc_id
#: 128-bit fingerprints in 16 blocks of 8 bits. Each block is looked up with up to two errors, so all pairs
#: within 16 * 3 - 1 bits meet. At a weighted similarity of 0.8 the expected distance is 19.4 bits, with a deviation of 4.1.
BLOCKS, RADIUS = 16, 44
#: A fingerprint counts each bit in 16 bits; items with more shingles go to the exact check without one.
COUNTED = 60_000
#: Rows of a benchmark's tables, or ids of documents with something in common with it, that are sent to every task;
#: with more, the same joins shuffle.
BROADCAST_ROWS = 1_000_000
_LANES = 0x0001000100010001
_MASKS = [0, *(1 << i for i in range(8)), *(1 << i | 1 << j for i, j in combinations(range(8), 2))]


def _sent(df: DataFrame) -> DataFrame:
    """df to be broadcast if it has at most BROADCAST_ROWS rows, else left to a shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def shingle_hashes(column: str, k: int) -> Column:
    """Hashes of all runs of k words, in order; the column holds the words."""
    w = F.col(column)
    return F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))).otherwise(F.array().cast("array<long>"))


def fingerprints(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, shingles (how many), f0 and f1 (the two halves of the SimHash) from rows of keys and h, one for each shingle.

    A bit is set if more than half of the shingles' hashes have it. 32 sums count all bits, four in each.
    """
    halves = [F.xxhash64("h", F.lit(seed)) for seed in (1, 2)]
    sums = [F.sum(F.shiftrightunsigned(half, j).bitwiseAND(F.lit(_LANES))).alias(f"s{i}_{j}") for i, half in enumerate(halves) for j in range(16)]
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("shingles"), *sums)

    def half(i: int) -> Column:
        bits = [F.when(2 * F.shiftrightunsigned(F.col(f"s{i}_{j}"), 16 * m).bitwiseAND(0xFFFF) > F.col("shingles"), F.lit(1 << (j + 16 * m) if j + 16 * m < 63 else -(1 << 63))).otherwise(F.lit(0)) for j in range(16) for m in range(4)]
        return reduce(Column.bitwiseOR, bits)

    return counted.select(*keys, "shingles", half(0).cast("long").alias("f0"), half(1).cast("long").alias("f1"))


def blocks(near: bool) -> Column:
    """Keys of the 16 blocks of f0 and f1, one number each of width, block and value, with all values up to two errors away if near."""
    masks = _MASKS if near else [0]

    def block(b: int) -> Column:
        value = F.shiftrightunsigned(F.col(f"f{b // 8}"), 8 * (b % 8)).bitwiseAND(0xFF)
        return F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: F.col("width").cast("long") * 4096 + 256 * b + value.bitwiseXOR(m))

    return F.explode(F.flatten(F.array(*map(block, range(BLOCKS)))))


def benchmark_shingles(benchmark: DataFrame) -> DataFrame:
    """item_id, width (words), k, h: a row for each shingle of each item. Items of fewer than SHINGLE words are one shingle.

    Items without words or id have none; an item_id that repeats counts with its longest text.
    """
    rows = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = rows.groupBy("item_id").agg(F.max_by("text", F.struct(F.length("text"), F.col("text"))).alias("text"))
    rows = stored(rows.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0))
    parts = [rows.where(F.least(F.size("w"), F.lit(SHINGLE)) == k).select("item_id", F.size("w").alias("width"), F.lit(k).alias("k"), F.explode(shingle_hashes("w", k)).alias("h")) for k in range(1, SHINGLE + 1)]
    return stored(reduce(DataFrame.unionByName, parts))


def promising_windows(texts: DataFrame, shingles: DataFrame, items: DataFrame, lengths: list[int], similarity: float) -> DataFrame:
    """doc, hash, k, width, start: the windows of the items' sizes that have enough shingles which also stand in some item of their size.

    A window of m shingles with a weighted similarity of s to an item of t shingles has at least s * (m + t) / (1 + s) of them in
    common with it, so no other window can be similar. Which item it is, if any, is left to the fingerprints.
    """
    marks = _sent(stored(shingles.select("k", "h", "width").distinct()))

    # the places where a document has a shingle of an item, with the item's size
    def places(k: int) -> DataFrame:
        return texts.select("doc", "hash", F.size("w").alias("n"), F.posexplode(shingle_hashes("w", k)).alias("at", "h")).join(marks.where(F.col("k") == k), "h").select("doc", "hash", "n", "k", "width", "at")

    empty = texts.sparkSession.createDataFrame([], "doc long, hash long, n int, k int, width int, at int")
    found = reduce(DataFrame.unionByName, [places(k) for k in lengths], empty)
    found = found.groupBy("doc", "hash", "n", "k", "width").agg(F.array_sort(F.collect_set("at")).alias("at"))
    size = F.least("width", "n") - F.col("k") + 1
    need = F.ceil(F.lit(similarity) * (size + F.col("width") - F.col("k") + 1) / (1 + similarity) - 1e-9).cast("int")
    found = found.withColumn("size", size).withColumn("need", need).where((F.size("at") >= F.col("need")) & (F.col("need") <= F.col("size")))
    last = F.col("n") - F.least("width", "n")
    spans = F.transform(F.sequence(F.lit(0), F.size("at") - F.col("need")), lambda j: F.struct(F.greatest(F.lit(0), F.get("at", j + F.col("need") - 1) - F.col("size") + 1).alias("low"), F.least(F.get("at", j), last).alias("high")))
    starts = found.select("doc", "hash", "k", "width", F.explode(F.filter(spans, lambda x: x.low <= x.high)).alias("s"))
    return starts.select("doc", "hash", "k", "width", F.explode(F.sequence("s.low", "s.high")).alias("start")).distinct()


def all_windows(texts: DataFrame, items: DataFrame) -> DataFrame:
    """doc, hash, k, width, start of every window of every item's size: what promising_windows leaves out too."""
    sizes = items.select("k", "width").distinct()
    rows = texts.select("doc", "hash", F.size("w").alias("n")).join(F.broadcast(sizes), F.col("n") >= F.col("k"))  # a row for each size of an item
    return rows.select("doc", "hash", "k", "width", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.col("n") - F.col("width")))).alias("start")).distinct()


def fingerprint_pairs(starts: DataFrame, own: DataFrame, shingles: DataFrame, items: DataFrame) -> DataFrame:
    """doc, hash, k, start, width, item_id: windows and items of the same size whose fingerprints are within the radius.

    own: doc, hash, k and the hashes of the document's shingles. Items of COUNTED shingles and more pair with all windows of their size.
    """
    inside = starts.join(own, ["doc", "hash", "k"]).select("doc", "hash", "width", "k", "start", F.explode(_window()).alias("h"))
    prints = fingerprints(inside.where(F.col("width") - F.col("k") < COUNTED), ["doc", "hash", "width", "k", "start"])
    item_prints = fingerprints(shingles.where(F.col("width") - F.col("k") < COUNTED), ["item_id", "width"])
    ball = item_prints.select("item_id", F.col("f0").alias("i0"), F.col("f1").alias("i1"), blocks(True).alias("key"))
    met = prints.select("doc", "hash", "width", "k", "start", "f0", "f1", blocks(False).alias("key")).join(_sent(stored(ball)), "key")
    near = met.where(F.bit_count(F.col("f0").bitwiseXOR(F.col("i0"))) + F.bit_count(F.col("f1").bitwiseXOR(F.col("i1"))) <= RADIUS).select("doc", "hash", "k", "start", "width", "item_id").distinct()
    large = starts.join(items.where(F.col("width") - F.col("k") >= COUNTED).select("item_id", "width"), "width").select(*near.columns)
    return near.unionByName(large)


def _window() -> Column:
    return F.slice("hashes", F.col("start") + 1, F.col("width") - F.col("k") + 1)


def held_items(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, every_window: bool = False) -> DataFrame:
    """doc, hash, doc_id, item_id, start, words, similarity: contaminated() for all rows, those without doc_id too.

    doc (NO_ID for null) and hash (of the text) tell rows apart. With every_window nothing but the fingerprints chooses windows (for small
    tables: documents x sizes of items x words).
    """
    shingles = benchmark_shingles(benchmark)
    items = shingles.groupBy("item_id", "width", "k").agg(F.count(F.lit(1)).alias("total"))
    lengths = sorted(r["k"] for r in shingles.select("k").distinct().collect())  # at most SHINGLE numbers
    text = F.col("text").cast("string")
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("hash"), words(text).alias("w"))
    starts = stored(all_windows(texts, items) if every_window else promising_windows(texts, shingles, items, lengths, similarity))
    ids = _sent(stored(starts.select("doc", "hash").distinct()))
    empty = docs.sparkSession.createDataFrame([], "doc long, hash long, k int, hashes array<long>")
    own = stored(reduce(DataFrame.unionByName, [texts.join(ids, ["doc", "hash"]).select("doc", "hash", F.lit(k).alias("k"), shingle_hashes("w", k).alias("hashes")).dropDuplicates(["doc", "hash"]) for k in lengths], empty))
    near = stored(fingerprint_pairs(starts, own, shingles, items))

    # the exact check
    counts = near.join(own, ["doc", "hash", "k"]).select("doc", "hash", "item_id", "start", F.size(_window()).alias("size"), F.explode(_window()).alias("h"))
    counts = counts.groupBy("doc", "hash", "item_id", "start", "size", "h").agg(F.count(F.lit(1)).alias("c"))
    weights = shingles.groupBy("item_id", "h").agg(F.count(F.lit(1)).alias("ci"))
    common = counts.join(_sent(stored(weights)), ["item_id", "h"]).groupBy("doc", "hash", "item_id", "start", "size").agg(F.sum(F.least("c", "ci")).alias("common"))
    scored = common.join(_sent(stored(items)), "item_id").withColumn("similarity", F.col("common") / (F.col("size") + F.col("total") - F.col("common")))
    best = W.partitionBy("doc", "hash", "item_id").orderBy(F.desc("similarity"), F.asc("start"))
    scored = scored.where(F.col("similarity") >= F.lit(similarity)).withColumn("rank", F.row_number().over(best)).where("rank = 1")
    return scored.select("doc", "hash", F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "item_id", F.col("start").cast("long").alias("start"), F.col("width").cast("long").alias("words"), F.round("similarity", 6).alias("similarity"))


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, every_window: bool = False) -> DataFrame:
    """doc_id, item_id, start, words, similarity: the benchmark items that a document holds, where it holds them best.

    A document holds an item if a window of as many words as the item has (the whole document if it has fewer)
    has a weighted similarity of at least similarity to it: the shingles of five words with the times they occur, the sum of the
    smaller ones over the sum of the larger ones. start counts words from 0; of equally similar windows the first
    counts. Windows and items meet by their fingerprints; windows are made where enough shingles stand in items of their size
    (promising_windows), or everywhere with every_window. Null texts, texts and items without words hold nothing; rows with a null doc_id
    are left out; rows that repeat a doc_id with its text count once, with another text each on its own. Other columns are ignored.
    """
    found = held_items(docs.where("doc_id IS NOT NULL"), benchmark, similarity, every_window)
    return found.select("doc_id", "item_id", "start", "words", "similarity")


def without_benchmark(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8) -> DataFrame:
    """The rows of docs that hold no item of the benchmark, with or without doc_id, with all their columns, whatever those are called."""
    own = docs.toDF(*[f"_c{k}" for k in range(len(docs.columns))])
    at = {c.lower(): F.col(f"_c{k}") for k, c in enumerate(docs.columns)}
    held = held_items(docs.select("doc_id", "text"), benchmark, similarity).select(F.col("doc").alias("_doc"), F.col("hash").alias("_hash")).distinct()
    own = own.withColumn("_doc", F.coalesce(at["doc_id"].cast("long"), F.lit(NO_ID))).withColumn("_hash", F.xxhash64(at["text"].cast("string")))
    return own.join(held, ["_doc", "_hash"], "left_anti").drop("_doc", "_hash").toDF(*docs.columns)


def op3_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op3_simhash_decontamination": op3_simhash_decontamination}
ORACLES: dict[str, str] = {
    "op3_simhash_decontamination": r"""
        WITH dw AS (SELECT doc_id AS id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents),
        bw AS (SELECT item_id AS id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM benchmark),
        d AS (SELECT id AS doc_id, len(w) AS n, unnest(range(0, len(w) - 4)) AS at, unnest([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) AS sh FROM dw WHERE len(w) >= 5),
        b AS (SELECT id AS item_id, len(w) AS width, unnest([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) AS sh FROM bw WHERE len(w) >= 5),
        bc AS (SELECT item_id, width, sh, count(*) AS ci FROM b GROUP BY ALL),
        bt AS (SELECT item_id, width, count(*) AS total FROM b GROUP BY ALL),
        pairs AS (SELECT DISTINCT d.doc_id, d.n, bc.item_id, bc.width FROM d JOIN bc USING (sh)),
        wins AS (SELECT *, unnest(range(0, greatest(n - width, 0) + 1)) AS start FROM pairs),
        c AS (SELECT wins.doc_id, wins.item_id, wins.width, wins.start, d.sh, count(*) AS c FROM wins JOIN d ON d.doc_id = wins.doc_id AND d.at >= wins.start AND d.at <= wins.start + wins.width - 5 GROUP BY ALL),
        s AS (SELECT c.doc_id, c.item_id, c.width, c.start, sum(c.c) AS size, sum(least(c.c, coalesce(bc.ci, 0))) AS common FROM c LEFT JOIN bc ON bc.item_id = c.item_id AND bc.sh = c.sh GROUP BY ALL),
        r AS (SELECT s.*, common / (size + total - common) AS similarity FROM s JOIN bt USING (item_id)),
        best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) AS k FROM r WHERE similarity >= 0.8)
        SELECT doc_id, item_id, start::BIGINT AS start, width::BIGINT AS words, round(similarity, 6)::DOUBLE AS similarity FROM best WHERE k = 1
    """,
}
