"""WARC archives with a two-level capture index."""

from __future__ import annotations

import bisect
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, stored, table

#: Payloads of fewer bytes are stored again rather than referred to.
REVISIT_BYTES = 1000
#: Index lines in a block, at least; more for a larger index, so that the directory has at most DIRECTORY rows.
BLOCK_LINES, DIRECTORY = 512, 1_000_000
GZIP_LEVEL = 3
#: A payload of more pages than this is common; the most common payloads that are sent to every task (with more, the same join shuffles).
COMMON, COMMON_ROWS = 1000, 1_000_000

INDEX = "key string, page_id long, file string, start long, length long"
BLOCKS = "first_key string, last_key string, block_file string, block_start long, block_length long"
PLACES = "key string, file string, start long, length long"
CAPTURES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, key string"


def url_key(url: str | None) -> str:
    """The URL with its host reversed: com,example,www)/path?query, without scheme, port and fragment.

    A URL that can't be parsed, has no host or is null is its own key.
    """
    try:
        parts = urlsplit(url or "")
        host = parts.hostname
    except ValueError:
        return url or ""
    if not host:
        return url or ""
    return ",".join(reversed(host.lower().removeprefix("www.").split("."))) + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def line_key(url: str | None, page_id: int | None) -> str:
    """Key of a capture: pages with ids of their own don't share it, so a URL that many pages have spreads over many blocks.

    Rows that repeat a (url, page_id) share it, and so do null and -1: look_up gives all of them.
    """
    return f"{url_key(url)} {-1 if page_id is None else page_id:020d}"


def filesystem(root: str):
    """The file system of a folder that executors share, and the folder's path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)


def member(data: bytes) -> bytes:
    """data as one gzip member, the same bytes each time."""
    z = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response or revisit record; both hold the HTTP head, only a response the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + (payload if refers_to is None else b"")
    uri = (url or "").translate({10: "%0A", 13: "%0D"})
    fields = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Target-URI: {uri}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        fields += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[int | None, int, str, str, int | None]:
    """page_id, payload bytes, payload digest, type and target of a record; a response's digest is computed anew."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    number = lambda name: int(x) if (x := fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")) else None
    kind = fields["WARC-Type"]
    if kind == "response":
        if len(payload) != size:
            raise ValueError(f"record {fields['WARC-Record-ID']}: {len(payload)} payload bytes, {size} announced")
        return number("WARC-Record-ID"), size, hashlib.sha1(payload).hexdigest(), kind, None
    return number("WARC-Record-ID"), size, fields["WARC-Payload-Digest"].removeprefix("sha1:"), kind, number("WARC-Refers-To")


class Appender:
    """A file of a task attempt: its name is its own, so another attempt leaves it alone."""

    def __init__(self, root: str, suffix: str):
        self.fs, path = filesystem(root)
        self.fs.create_dir(path, recursive=True)
        self.name, self.at = f"{uuid.uuid4().hex}{suffix}", 0
        self.out = self.fs.open_output_stream(f"{path}/{self.name}", compression=None)

    def add(self, data: bytes) -> int:
        self.out.write(data)
        self.at += len(data)
        return self.at - len(data)


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64()}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in ddl.split(", ")])
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)


def revisits(pages: DataFrame) -> DataFrame:
    """digest, bytes and refers_to of the payloads that several records share: the largest page_id keeps it."""
    payload = F.coalesce(pages["html"].cast("string"), F.lit(""))
    seen = pages.select(pages["page_id"].cast("long").alias("page_id"), F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).alias("bytes"))
    shared = seen.where(F.col("bytes") >= REVISIT_BYTES).groupBy("digest", "bytes").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("refers_to"))
    return shared.where("n > 1").select(F.col("digest").alias("_digest"), F.col("bytes").alias("_bytes"), "refers_to", "n")


def write_archives(pages: DataFrame, root: str) -> DataFrame:
    """Writes a WARC file for each task below root, one gzip member for each page, and returns their index lines.

    A null html is an empty payload, a null url an empty one. Of the pages with equal payloads of at least REVISIT_BYTES, the one
    with the largest page_id (each of them, if it repeats) holds the payload; the others are revisit records.
    A null page_id counts as the smallest. Other columns are ignored.
    """
    payload = F.coalesce(pages["html"].cast("string"), F.lit(""))
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), payload.alias("html"), F.sha1(payload.cast("binary")).alias("digest"))
    # payloads of very many pages are told by broadcast, so that those pages don't meet in one task; there is at most one for COMMON pages
    shared = stored(revisits(pages))
    common = shared.where(F.col("n") > COMMON).select(F.col("_digest").alias("_d"), F.col("_bytes").alias("_b"), F.col("refers_to").alias("_common"))
    common = F.broadcast(common) if common.count() <= COMMON_ROWS else common
    rows = rows.join(common, (rows["digest"] == common["_d"]) & (F.octet_length("html") == common["_b"]), "left")
    rows = rows.withColumn("_key", F.when(F.col("_common").isNull(), F.col("digest")).otherwise(F.concat_ws("/", "digest", "page_id", "url")))
    few = shared.where(F.col("n") <= COMMON).drop("n")
    rows = rows.join(few, (F.col("_key") == F.col("_digest")) & (F.octet_length("html") == F.col("_bytes")), "left").withColumn("refers_to", F.coalesce("_common", "refers_to"))
    target = F.when(F.coalesce(F.col("page_id") != F.col("refers_to"), F.col("refers_to").isNotNull()), F.col("refers_to"))
    rows = rows.select("page_id", "url", "html", "digest", target.alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = None
        for batch in batches:
            ids, urls, _, digests, targets = (c.to_pylist() if i != 2 else None for i, c in enumerate(batch.columns))
            lines = []
            for k, html in enumerate(batch.column(2)):
                file = file or Appender(f"{root}/archive", ".warc.gz")
                data = member(record(ids[k], urls[k], html.as_py().encode(), digests[k], targets[k]))
                lines.append((line_key(urls[k], ids[k]), ids[k], file.name, file.add(data), len(data)))
            if lines:
                yield _batch(lines, INDEX)
        if file:
            file.out.close()

    return rows.mapInArrow(write, INDEX)


def write_index(lines: DataFrame, root: str, total: int) -> DataFrame:
    """Sorts index lines by key (lines with the same key by their place) into compressed blocks below root and returns the directory of the blocks."""
    per_block = max(BLOCK_LINES, -(-total // DIRECTORY))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        file = None

        def block() -> tuple:
            data = zlib.compress("\n".join(held).encode(), GZIP_LEVEL)
            return held[0].split("\t")[0], held[-1].split("\t")[0], file.name, file.add(data), len(data)

        for batch in batches:
            rows = []
            for line in zip(*(c.to_pylist() for c in batch.columns)):
                file = file or Appender(f"{root}/index", ".cdx.z")
                held.append("\t".join(map(str, line)).replace("\n", "%0A"))
                if len(held) == per_block:
                    rows.append(block())
                    held = []
            if rows:
                yield _batch(rows, BLOCKS)
        if held:
            yield _batch([block()], BLOCKS)
        if file:
            file.out.close()

    clean = F.regexp_replace("key", "[\\t\\n]", "_").alias("key")
    parts = max(1, min(4096, -(-total // (16 * per_block))))
    return lines.select(clean, "file", "start", "length").repartitionByRange(parts, "key", "file", "start").sortWithinPartitions("key", "file", "start").mapInArrow(write, BLOCKS)


def look_up(keys: DataFrame, directory: DataFrame, root: str) -> DataFrame:
    """file, start and length of all records of each key: binary search in the directory, then in the blocks.

    The directory has at most DIRECTORY rows by construction (write_index), so each task may hold it.
    A key that many lines share is looked up in each of its blocks, which are dealt out over the tasks. Keys and blocks
    come sorted, so a task reads each block once. A key that the index lacks gives no row.
    """
    blocks = sorted(tuple(r) for r in directory.collect())  # of blocks with the same first key, all but the last end with it
    held = keys.sparkSession.sparkContext.broadcast(blocks)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last = [b[0] for b in held.value], [b[1] for b in held.value]
        for batch in batches:
            rows = []
            for key in batch.column(0).to_pylist():
                for k in range(bisect.bisect_left(last, key), bisect.bisect_right(first, key)):
                    rows.append((key, k))
                    if len(rows) == 10_000:
                        yield _batch(rows, "key string, block long")
                        rows = []
            if rows:
                yield _batch(rows, "key string, block long")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        fs, path = filesystem(f"{root}/index")
        at, lines, names = -1, [], []
        for batch in batches:
            rows = []
            for key, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != at:
                    _, _, name, start, length = own[k]
                    with fs.open_input_file(f"{path}/{name}") as f:
                        lines = zlib.decompress(f.read_at(length, start)).decode().split("\n")
                    at, names = k, [x.split("\t", 1)[0] for x in lines]
                for line in lines[bisect.bisect_left(names, key) : bisect.bisect_right(names, key)]:
                    _, file, start, length = line.split("\t")
                    rows.append((key, file, int(start), int(length)))
                if len(rows) >= 10_000:
                    yield _batch(rows, PLACES)
                    rows = []
            if rows:
                yield _batch(rows, PLACES)

    parts = max(1, min(4096, 4 * keys.sparkSession.sparkContext.defaultParallelism))
    found = keys.select("key").mapInArrow(locate, "key string, block long")
    return found.repartitionByRange(parts, "key", "block").sortWithinPartitions("key", "block").mapInArrow(find, PLACES)


def read_records(places: DataFrame, root: str) -> DataFrame:
    """Range-reads the records at (file, start, length), in the order of the files, and parses them."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(f"{root}/archive")
        name, file = None, None
        for batch in batches:
            rows = []
            for key, own, start, length in zip(*(c.to_pylist() for c in batch.columns)):
                if own != name:
                    if file:
                        file.close()
                    name, file = own, fs.open_input_file(f"{path}/{own}")
                rows.append((*parsed(zlib.decompress(file.read_at(length, start), 31)), key))
            if rows:
                yield _batch(rows, CAPTURES)
        if file:
            file.close()

    parts = max(1, min(65536, 4 * places.sparkSession.sparkContext.defaultParallelism))
    return places.select("key", "file", "start", "length").repartitionByRange(parts, "file", "start").sortWithinPartitions("file", "start").mapInArrow(read, CAPTURES)


def archived(pages: DataFrame, root: str) -> DataFrame:
    """Archives pages below root, indexes them, and reads every page back through the index.

    Rows that repeat a (url, page_id) share one key, which is looked up once and gives all their records: a row for each page.
    """
    lines = stored(write_archives(pages, root))
    directory = stored(write_index(lines, root, lines.count()))
    return read_records(look_up(lines.select(F.regexp_replace("key", "[\\t\\n]", "_").alias("key")).distinct(), directory, root), root)


def op7_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"), shared_dir(spark))


QUERIES = {"op7_warc_capture_index": op7_warc_capture_index}
ORACLES: dict[str, str] = {
    "op7_warc_capture_index": r"""
        WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
        d AS (SELECT *, sha1(html) AS payload_digest, max(page_id) OVER (PARTITION BY html) AS keeper FROM p),
        u AS (SELECT *, regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)', 1) AS host, regexp_replace(regexp_replace(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+', ''), '#.*$', '') AS rest FROM d)
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 1000 AND keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 1000 AND keeper <> page_id THEN keeper END AS refers_to,
            array_to_string(list_reverse(string_split(regexp_replace(lower(host), '^www\.', ''), '.')), ',') || ')'
                || CASE WHEN rest = '' OR rest[1] = '?' THEN '/' ELSE '' END || rest || ' ' || lpad(page_id::VARCHAR, 20, '0') AS key
        FROM u
    """,
}
