"""Quality by co-training: a text view and a metadata view teach each other."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, table
from .ctw import Texts, mixed

#: Labelled rows to learn from, at most (those whose doc_id has the smallest hashes).
LABELLED = 12_000
#: Rounds of exchange; how many rows of each group of sources and each class a view may teach the other in a round, and how sure it
#: must be. All rows without labels are candidates in every round.
ROUNDS, TAUGHT, SURE = 3, 20, 0.9
SOURCES = 32
#: Bytes of text that are worked on at once.
AT_ONCE = 1 << 18

# Kinds of bytes: other, lower case, upper case, digit, space, line end, sentence mark, other punctuation (9 kinds), beyond ASCII
_KIND = np.zeros(256, np.int64)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[32], _KIND[10], _KIND[128:] = 1, 2, 3, 4, 5, 15
for _kind, _marks in enumerate((b".,;:?'\"-", b"!", b"%", b"&", b"$", b"#", b"*", b"|", b"()[]{}<>@/\\+=_~^`"), 6):
    _KIND[list(_marks)] = _kind
KINDS = 16
TEXT_FEATURES, META_FEATURES = KINDS * KINDS + 5, 5 + 16 + SOURCES


def text_view(texts: list[bytes]) -> np.ndarray:
    """Square roots of the shares of pairs of byte kinds, and how much words, word pairs and lines repeat."""
    n = len(texts)
    out = np.zeros((n, TEXT_FEATURES), np.float32)
    own = Texts(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    if len(raw):
        kind, of = _KIND[raw], np.repeat(np.arange(n), sizes)
        pair = of[:-1] == of[1:]
        code = (of[:-1] * KINDS + kind[:-1]) * KINDS + kind[1:]
        count = np.bincount(code[pair], minlength=n * KINDS * KINDS).reshape(n, -1)
        out[:, : KINDS * KINDS] = np.sqrt(count / np.maximum(sizes - 1, 1)[:, None])
    words, of = own.words()
    ends = np.searchsorted(of, np.arange(n), "right")
    for k, (a, b) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
        if b > a:
            w = words[a:b]
            _, times = np.unique(w, return_counts=True)
            out[k, -5] = len(times) / len(w)
            out[k, -4] = (w[1:] == w[:-1]).mean() if len(w) > 1 else 0
            out[k, -3] = times.max() / len(w)
            out[k, -2] = len(np.unique(mixed(w[:-1]) + w[1:])) / max(len(w) - 1, 1)
            lines = texts[k].split(b"\n")
            out[k, -1] = len(set(lines)) / len(lines)
    return out


def meta_view(langs: list, sources: list, chars: list, texts: list[bytes]) -> np.ndarray:
    """What a page's record says without its words: language, source, length, and lines and their lengths."""
    out = np.zeros((len(texts), META_FEATURES), np.float32)
    for k, (lang, source, n, text) in enumerate(zip(langs, sources, chars, texts)):
        lines = text.count(b"\n") + 1
        out[k, :5] = np.log1p(max(n or 0, 0)), np.log1p(len(text)), np.log(lines), np.log1p(len(text) / lines), (len(text) - (n or 0)) / max(len(text), 1)
        out[k, 5 + zlib.crc32((lang or "").encode()) % 16] = 1
        out[k, 21 + zlib.crc32((source or "").encode()) % SOURCES] = 1
    return out


class Logistic:
    """Ridge logistic regression on standardised features, by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 2.0):
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
        z = self._scaled(x)
        self.w = np.zeros(z.shape[1])
        penalty = np.full(z.shape[1], ridge)
        penalty[-1] = 1e-3
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
            hessian = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(hessian, z.T @ (y - p) - penalty * self.w)
            self.w += step
            if np.abs(step).max() < 1e-6:
                break

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.clip((x - self.mean) / self.scale, -8, 8), np.ones(len(x))])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._scaled(x) @ self.w, -12, 12)


class Views:
    """The two views' labelled examples, what each was taught by the other, and the classifiers fitted on both.

    A third of the labelled rows is set aside to calibrate each view and to weigh the calibrated ones against each other.
    """

    def __init__(self, text: np.ndarray, meta: np.ndarray, y: np.ndarray):
        aside = np.arange(len(y)) % 3 == 0
        if min(y[aside].sum(), (~aside & (y == 1)).sum(), (1 - y)[aside].sum(), (~aside & (y == 0)).sum()) == 0:
            aside[:] = False
        self.learn, self.check = ~aside, aside if aside.any() else ~aside
        self.x, self.y = (text, meta), y
        self.taught: list[dict[int, tuple[np.ndarray, int]]] = [{}, {}]  # row -> its features and label
        self.fit()

    def fit(self) -> None:
        self.fitted = []
        for x, taught in zip(self.x, self.taught):
            more = [taught[row] for row in sorted(taught)]
            own = np.array([v for v, _ in more], np.float32).reshape(-1, x.shape[1])
            self.fitted.append(Logistic(np.concatenate([x[self.learn], own]), np.concatenate([self.y[self.learn], np.array([label for _, label in more], float)])))

    def teach(self, view: int, row: int, features: np.ndarray, label: int) -> None:
        """View is taught a row's label by the other one; the first label that it is taught stays."""
        self.taught[view].setdefault(row, (features, label))

    def model(self) -> Model:
        y = self.y[self.check].astype(float)
        scales = [Logistic(f.logit(x[self.check])[:, None], y) for f, x in zip(self.fitted, self.x)]
        both = np.column_stack([g.logit(f.logit(x[self.check])[:, None]) for f, g, x in zip(self.fitted, scales, self.x)])
        return Model(self.fitted, scales, Logistic(both, y))


class Model:
    """The views' classifiers, their calibrations, and the weights of the calibrated views."""

    def __init__(self, fitted: list[Logistic], scales: list[Logistic], both: Logistic):
        self.fitted, self.scales, self.both = fitted, scales, both

    def scores(self, text: np.ndarray, meta: np.ndarray) -> list[np.ndarray]:
        """Calibrated probabilities by text, by metadata and by both."""
        a, b = (g.logit(f.logit(x)[:, None]) for f, g, x in zip(self.fitted, self.scales, (text, meta)))
        return [1 / (1 + np.exp(-v)) for v in (a, b, self.both.logit(np.column_stack([a, b])))]


VIEWS = "x array<float>, z array<float>"


def _views(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    texts = [(t or "").encode() for t in part.column("text").to_pylist()]
    return text_view(texts), meta_view(part.column("lang").to_pylist(), part.column("source").to_pylist(), part.column("n_chars").to_pylist(), texts)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = np.array([len(t.as_py() or "") for t in batch.column("text")], np.int64)
        low = 0
        while low < len(sizes):
            high = low + max(1, int(np.searchsorted(np.cumsum(sizes[low:]), AT_ONCE, "right")))
            yield batch.slice(low, high - low)
            low = high


def _matrix(t: pa.Table, column: str, width: int) -> np.ndarray:
    return t[column].combine_chunks().flatten().to_numpy().reshape(-1, width)


def learned(docs: DataFrame, labels: DataFrame, held: Column, rounds: int = ROUNDS, labelled: int = LABELLED, taught: int = TAUGHT) -> Model | None:
    """The co-trained model of docs' labelled rows, or None without both kinds of labels.

    Both views of all rows that aren't held out are written once. In each round each view scores every row without a label, and of
    each group of sources (by checksum, SOURCES groups) and each class the taught surest rows join the other view's examples.
    Labelled rows beyond the limit count as rows without a label. The driver sees labelled rows and rounds * 2 views * 2 classes * SOURCES * taught others at most.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality").cast("int")).alias("quality"))
    rows = _inputs(docs, held).where("NOT held_out")
    picked = rows.where("doc_id IS NOT NULL").select("doc_id").distinct().join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    picked = stored(picked)  # labelled rows at most
    if {r[0] for r in picked.select("quality").distinct().collect()} != {0, 1}:
        return None

    def view(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            x, z = _views(part)
            group = pa.array([zlib.crc32((s or "").encode()) % SOURCES for s in part.column("source").to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality"), part.column("hash"), group, pa.array(list(x), pa.list_(pa.float32())), pa.array(list(z), pa.list_(pa.float32()))], names=["doc_id", "quality", "hash", "group", "x", "z"])

    # a row's hash orders rows whatever files they are in; row tells those apart that repeat each other
    marked = rows.join(F.broadcast(picked), "doc_id", "left").withColumn("hash", F.xxhash64("text", "doc_id", "lang", "source", "n_chars"))
    views = marked.select("doc_id", "quality", "text", "lang", "source", "n_chars", "hash").mapInArrow(view, f"doc_id long, quality int, hash long, group int, {VIEWS}")
    views = stored(views.withColumn("row", F.monotonically_increasing_id()))
    sample = views.where("quality IS NOT NULL")
    first = sample.groupBy("doc_id").agg(F.min(F.struct("hash", "row")).alias("first")).select("first.row")  # one for each labelled id
    sample = sample.join(F.broadcast(first), "row").toArrow().sort_by("doc_id")
    both = Views(_matrix(sample, "x", TEXT_FEATURES), _matrix(sample, "z", META_FEATURES), sample["quality"].to_numpy().astype(float))
    rest = views.where("quality IS NULL")
    for _ in range(rounds):
        fitted = both.fitted

        def sure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                t = pa.Table.from_batches([batch])
                if not t.num_rows:
                    continue
                row, own_hash, group = t["row"].to_numpy(), t["hash"].to_numpy(), t["group"].to_numpy()
                for k, (name, width) in enumerate((("x", TEXT_FEATURES), ("z", META_FEATURES))):
                    p = 1 / (1 + np.exp(-fitted[k].logit(_matrix(t, name, width))))
                    for label, own in ((1, p), (0, 1 - p)):
                        best = np.flatnonzero(own >= SURE)
                        best = best[np.lexsort((row[best], own_hash[best], -own[best], group[best]))]
                        first = np.searchsorted(group[best], group[best])
                        best = best[np.arange(len(best)) - first < taught]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(best), k, np.int32)), pa.array(np.full(len(best), label, np.int32)), pa.array(group[best]), pa.array(own[best]), pa.array(own_hash[best]), pa.array(row[best])], names=["view", "label", "group", "sure", "hash", "row"])

        said = rest.select("row", "hash", "group", "x", "z").mapInArrow(sure, "view int, label int, group int, sure double, hash long, row long")
        best = W.partitionBy("view", "label", "group").orderBy(F.desc("sure"), "hash", "row")
        said = stored(said.withColumn("k", F.row_number().over(best)).where(F.col("k") <= taught).select("view", "label", "row"))  # 4 * SOURCES * taught rows at most
        told = views.join(F.broadcast(said), "row").select("view", "label", "hash", "row", "x", "z").toArrow().sort_by([("view", "ascending"), ("hash", "ascending"), ("row", "ascending"), ("label", "descending")])
        if told.num_rows:
            x, z = _matrix(told, "x", TEXT_FEATURES), _matrix(told, "z", META_FEATURES)
            for k, (view_, label, row) in enumerate(zip(*(told[c].to_pylist() for c in ("view", "label", "row")))):
                both.teach(1 - view_, row, (x, z)[1 - view_][k], label)
        both.fit()
    return both.model()


def _inputs(docs: DataFrame, held: Column, *more: Column) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.col("n_chars").cast("long").alias("n_chars"), *more)


def _judged(docs: DataFrame, labels: DataFrame, carry: list[str], held_out=None, **limits: int) -> DataFrame:
    """_c0, _c1 and so on (the columns in carry), held_out, text_score, meta_score, score and predicted for every row of docs."""
    held = held_out if held_out is not None else F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    model = learned(docs, labels, held, **limits)
    own = _inputs(docs, held, *[F.col(f"`{c}`").alias(f"_c{k}") for k, c in enumerate(carry)])
    names = ["held_out", "text_score", "meta_score", "score", "predicted"]
    schema = T.StructType([T.StructField(f"_c{k}", own.schema[f"_c{k}"].dataType) for k in range(len(carry))])
    for name, kind in zip(names, ("boolean", "double", "double", "double", "integer")):
        schema = schema.add(name, kind)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            scores = model.scores(*_views(part)) if model else [np.ones(part.num_rows)] * 3
            columns = [*part.columns[6:], part.column("held_out"), *map(pa.array, scores), pa.array((scores[2] >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return own.mapInArrow(score, schema)


def quality(docs: DataFrame, labels: DataFrame, held_out=None, carry: list[str] | None = None, **limits: int) -> DataFrame:
    """carry (columns of docs, by default doc_id), held_out, text_score, meta_score, score, predicted for every row of docs.

    score is the probability of labels.quality = 1, from both calibrated views, and predicted is 1 where it is at least 0.5. Learns from at
    most LABELLED rows with labels and from all rows without, none of them held out (crc32 of doc_id mod 5 is 0 by default); a doc_id
    with several labels counts as good if one says so, and counts once where rows repeat it: with the smallest hash of its row. Nulls count as empty texts, names and lengths of 0; a
    null doc_id has no label. Equally sure rows are taught in the order of a hash of theirs, so the layout of files doesn't matter. Without both kinds of labels all scores are 1: nothing is
    rejected. Columns that aren't carried are ignored; an empty table gives an empty one. limits: rounds, labelled, taught.
    """
    carry = carry or ["doc_id"]
    out = _judged(docs, labels, carry, held_out, **limits)
    return out.select(*[F.col(f"_c{k}").alias(c) for k, c in enumerate(carry)], "held_out", "text_score", "meta_score", "score", "predicted")


def accepted(docs: DataFrame, labels: DataFrame, **limits: int) -> DataFrame:
    """The rows of docs that quality() predicts to be good, with all their columns, whatever those are called."""
    out = _judged(docs, labels, docs.columns, **limits)
    return out.where("predicted = 1").select(*[F.col(f"_c{k}").alias(c) for k, c in enumerate(docs.columns)])


def op2_co_training_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op2_co_training_quality": op2_co_training_quality}
ORACLES: dict[str, str] = {}
