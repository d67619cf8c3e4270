"""Resharding by minimum-cost flow: the fewest bytes move from old shards to new capacities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import shared_dir, stored, table

#: Bytes that a row takes beside its text.
ROW_BYTES = 16
OLD_SHARDS, NEW_SHARDS = 32, 40
#: A shard has at least FILES files per class of sizes with that share of its bytes, and more where they would exceed FILE_BYTES.
FILES, FILE_BYTES = 8, 128 << 20
#: Rows of the table of files that are sent to every task; with more, the same joins shuffle.
BROADCAST_ROWS = 1_000_000


def min_cost_flow(sizes: list[int], capacities: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Bytes from each old shard to each new one, all moved at the least total cost.

    Successive cheapest paths on a graph with a node for each shard, so its size depends on the number of shards
    alone. sum(sizes) must not exceed sum(capacities).
    """
    n, m = len(sizes), len(capacities)
    flow, left, room = [[0] * m for _ in range(n)], list(sizes), list(capacities)
    while any(left):
        # cheapest way from any shard with bytes left to each new shard (Bellman-Ford on the residual graph)
        far = float("inf")
        at_old = [0 if x else far for x in left]
        at_new, from_old, from_new = [far] * m, [-1] * m, [-1] * n
        changed = True
        while changed:
            changed = False
            for i in range(n):
                if at_old[i] < far:
                    for j in range(m):
                        if at_old[i] + cost[i][j] < at_new[j]:
                            at_new[j], from_old[j], changed = at_old[i] + cost[i][j], i, True
            for j in range(m):
                if at_new[j] < far:
                    for i in range(n):
                        if flow[i][j] and at_new[j] - cost[i][j] < at_old[i]:
                            at_old[i], from_new[i], changed = at_new[j] - cost[i][j], j, True
        end = min((j for j in range(m) if room[j]), key=lambda j: at_new[j])
        path, j = [], end
        while True:
            i = from_old[j]
            path.append((i, j, 1))
            if from_new[i] < 0:
                break
            j = from_new[i]
            path.append((i, j, -1))
        amount = min([left[i], room[end], *(flow[a][b] for a, b, sign in path if sign < 0)])
        for a, b, sign in path:
            flow[a][b] += sign * amount
        left[i] -= amount
        room[end] -= amount
    return flow


def transfers(sizes: dict[int, int], shards: int) -> list[tuple[int, int, int, int]]:
    """(from, low, high, to): the stretch of each old shard's bytes that goes to each new shard."""
    old, total = sorted(sizes), sum(sizes.values())
    capacities = [total // shards + (j < total % shards) for j in range(shards)]
    flow = min_cost_flow([sizes[i] for i in old], capacities, [[int(i != j) for j in range(shards)] for i in old])
    out = []
    for i, row in zip(old, flow):
        low = 0
        for j in sorted(range(shards), key=lambda j: (j != i, j)):  # what stays comes first
            if row[j]:
                out.append((i, low, low + row[j], j))
                low += row[j]
    return out


def source_layout(shards: int = OLD_SHARDS) -> Column:
    """The layout before: each source in up to eight shards, by checksum, so shards are as uneven as sources."""
    source = F.crc32(F.coalesce(F.col("source").cast("string"), F.lit("")))
    return F.pmod(source + 4 * F.pmod(F.xxhash64("doc_id"), F.lit(8)), F.lit(shards)).cast("int")


def _sent(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def laid_out(docs: DataFrame, old_shard: Column, path: str) -> DataFrame:
    """Writes docs below path, the files of each old shard in folders of their own, and reads them back.

    Columns: docs' as _c0, _c1 and so on, size, old_shard, file (a shard's files in order) and pos (from 0 in its file). Files hold rows of like
    size, large ones first, so that what is cut off at the end of a shard are small rows. The driver sees one number for each shard and
    class of sizes (a few hundred).
    """
    text = next(F.col(f"_c{k}") for k, c in enumerate(docs.columns) if c.lower() == "text")
    own = docs.select("*", old_shard).toDF(*[f"_c{k}" for k in range(len(docs.columns))], "old_shard")
    own = own.withColumn("size", (F.coalesce(F.octet_length(text.cast("string")), F.lit(0)) + ROW_BYTES).cast("long"))
    own = own.withColumn("_class", F.floor(F.log2("size") / 2).cast("int")).withColumn("_row", F.monotonically_increasing_id())
    found = sorted(tuple(r) for r in own.groupBy("old_shard", "_class").agg(F.sum("size")).collect())
    target = max(1, min(FILE_BYTES, sum(b for *_, b in found) // (OLD_SHARDS * FILES)))
    plan, first = [], {}
    for shard, size_class, held in sorted(found, key=lambda r: (r[0], -r[1])):
        n = -(-held // target)
        plan.append((shard, size_class, first.get(shard, 0), n))
        first[shard] = first.get(shard, 0) + n
    plan = docs.sparkSession.createDataFrame(plan, "old_shard int, _class int, _first int, _n int")
    own = own.join(F.broadcast(plan), ["old_shard", "_class"]).withColumn("file", F.col("_first") + F.pmod(F.xxhash64("_row"), F.col("_n")).cast("int"))
    inside = W.partitionBy("old_shard", "file").orderBy(F.desc("size"), "_row")  # a file each: about target bytes
    own = own.withColumn("pos", (F.row_number().over(inside) - 1).cast("long")).drop("_class", "_row", "_first", "_n")
    own = own.select(*[c for c in own.columns if c not in ("old_shard", "file")], "old_shard", "file")
    own.write.mode("overwrite").partitionBy("old_shard", "file").parquet(path)
    return docs.sparkSession.read.schema(own.schema).parquet(path)


def moves(layout: DataFrame, shards: int) -> DataFrame:
    """old_shard, file, low, high, shard, slot, rewritten: where the rows low <= pos < high of each file go, and the first one's slot there.

    A stretch of each old shard's bytes goes to each new one as the flow says; a row goes where its middle byte lies, so a shard is off
    by half a row at each end of a stretch. Only rows of files that are cut are looked at one by one, by their sizes alone. A file that stays
    whole in its shard isn't rewritten.
    """
    files = layout.groupBy("old_shard", "file").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    before = W.partitionBy("old_shard").orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    files = stored(files.withColumn("base", F.coalesce(F.sum("bytes").over(before), F.lit(0))))
    sizes = {r[0]: r[1] for r in files.groupBy("old_shard").agg(F.sum("bytes")).collect()}
    # at most one stretch for each path of the flow: fewer than old + new shards
    plan = F.broadcast(files.sparkSession.createDataFrame(transfers(sizes, shards), "_from int, _low long, _high long, shard int"))
    met = files.join(plan, (F.col("old_shard") == F.col("_from")) & (F.col("base") < F.col("_high")) & (F.col("base") + F.col("bytes") > F.col("_low")))
    met = met.withColumn("_n", F.count(F.lit(1)).over(W.partitionBy("old_shard", "file")))
    whole = met.where("_n = 1").select("old_shard", "file", F.lit(0).cast("long").alias("low"), F.col("rows").alias("high"), "shard")
    cut = _sent(stored(met.where("_n > 1").select("old_shard", "file", "base").distinct()))
    upto = W.partitionBy("old_shard", "file").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = layout.select("old_shard", "file", "pos", "size").join(cut, ["old_shard", "file"])
    rows = rows.withColumn("_mid", F.col("base") + F.sum("size").over(upto) - F.floor((F.col("size") + 1) / 2))
    rows = rows.join(plan, (F.col("old_shard") == F.col("_from")) & (F.col("_low") <= F.col("_mid")) & (F.col("_mid") < F.col("_high")))
    parts = rows.groupBy("old_shard", "file", "shard").agg(F.min("pos").alias("low"), (F.max("pos") + 1).alias("high"))
    parts = whole.unionByName(parts)
    parts = parts.withColumn("rewritten", (F.col("old_shard") != F.col("shard")) | (F.count(F.lit(1)).over(W.partitionBy("old_shard", "file")) > 1))
    ahead = W.partitionBy("shard").orderBy("rewritten", "old_shard", "file", "low").rowsBetween(W.unboundedPreceding, -1)
    return stored(parts.withColumn("slot", F.coalesce(F.sum(F.col("high") - F.col("low")).over(ahead), F.lit(0))))


def resharded(docs: DataFrame, old_shard: Column, path: str, shards: int = NEW_SHARDS) -> DataFrame:
    """docs' rows from their new shards: docs' columns as _c0, _c1 and so on, size, old_shard, file, shard, slot and rewritten.

    size counts UTF-8 bytes (a null text has none) and 16 more. The old shards are files below path/old. Files whose rows all stay are
    left as they are; the rows of all others are written to path/new, a folder for each new shard. Rows are placed by their bytes alone:
    null and repeated doc_ids are rows like others, and of rows of equal size the order of the input decides. slot runs without gaps in each new
    shard. Any column names may occur; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    layout = laid_out(docs, old_shard, f"{path}/old")
    parts = moves(layout, shards)

    def placed(own: DataFrame) -> DataFrame:
        there = _sent(own.select("old_shard", "file", "low", "high", "shard", F.col("slot").alias("_first"), "rewritten"))
        rows = layout.join(there, ["old_shard", "file"]).where((F.col("pos") >= F.col("low")) & (F.col("pos") < F.col("high")))
        return rows.withColumn("slot", F.col("_first") + F.col("pos") - F.col("low")).select(*layout.columns, "rewritten", "slot", "shard").drop("pos")

    new = placed(parts.where("rewritten"))
    new.write.mode("overwrite").partitionBy("shard").parquet(f"{path}/new")
    return placed(parts.where("NOT rewritten")).unionByName(spark.read.schema(new.schema).parquet(f"{path}/new"))


def op4_flow_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resharded(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), source_layout(), shared_dir(spark))
    text = F.coalesce(F.col("_c1"), F.lit(""))
    return rows.select(
        F.col("_c0").cast("long").alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard", "rewritten",
    )


QUERIES = {"op4_flow_resharding": op4_flow_resharding}
ORACLES: dict[str, str] = {}
