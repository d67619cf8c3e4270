"""Toxicity by a support vector machine on a subsequence string kernel with Nystroem landmarks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_slices, stored, table

#: Labelled rows to learn from, at most (those whose doc_id has the smallest hashes).
SAMPLE = 20_000
LANDMARKS, CANDIDATES = 128, 2_000
#: Letters of a subsequence, what each step of its length costs, and the least kernel value that counts.
ORDER, DECAY, LEAST = 3, 0.6, 0.45
#: Share of a landmark's pairs of neighbouring letters that a word must have for its kernel to be computed.
NEEDED = 0.7
#: Longer words are cut into windows of so many letters, each half over the one before, to look for landmarks in.
WINDOW = 24
#: Windows whose kernels are computed at once.
WINDOWS_AT_ONCE = 50_000
#: Different words whose answers a worker remembers, at most twice.
REMEMBERED = 400_000


def subsequence_kernel(s: np.ndarray, t: np.ndarray, order: int = ORDER, decay: float = DECAY) -> np.ndarray:
    """Gap-weighted subsequence kernel of each row of s with the same row of t.

    Rows are code points; places after a word's end hold numbers that never match (-1 in s, -2 in t).
    The value sums decay ** (length spanned in s + length spanned in t) over the common subsequences of order letters.
    """
    rows, n, m = len(s), s.shape[1], t.shape[1]
    square = np.float32(decay * decay)
    before = [np.ones((m + 1, rows), np.float32)] + [np.zeros((m + 1, rows), np.float32) for _ in range(order - 1)]
    total = np.zeros(rows, np.float32)
    for i in range(n):
        same = (t == s[:, i : i + 1]).T
        if not same.any():
            for k in range(1, order):
                before[k] *= np.float32(decay)
            continue
        new = [before[0]]
        for k in range(1, order):
            run, out = np.zeros(rows, np.float32), before[k] * np.float32(decay)
            for j in range(m):
                run = run * np.float32(decay) + same[j] * (square * before[k - 1][j])
                out[j + 1] += run
            new.append(out)
        for j in range(m):
            total += same[j] * (square * before[order - 1][j])
        before = new
    return total


_PART = re.compile(r"[^\W_]+")


def parts(word: str) -> list[str]:
    """A word with its punctuation removed, and what stands between its punctuation marks; those of at least ORDER letters."""
    if word.isalnum():
        return [word] if len(word) >= ORDER else []
    own = _PART.findall(word)
    return [x for x in dict.fromkeys(["".join(own), *own]) if len(x) >= ORDER]


def windows_for(word: str, length: int) -> Iterator[str]:
    """Windows of twice a landmark's length: any stretch of one and a half times its length stands in one of them."""
    step = max(1, length // 2)
    for i in range(0, max(1, len(word) - 2 * length + step), step):
        yield word[i : i + 2 * length]


def windows(word: str) -> list[str]:
    return [word] if len(word) <= WINDOW else [word[i : i + WINDOW] for i in range(0, len(word) - WINDOW // 2, WINDOW // 2)]


def coded(words: list[str], empty: int) -> np.ndarray:
    width = max(map(len, words), default=1) or 1
    codes = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le"), np.int32).reshape(-1, width).copy()
    codes[codes == 0] = empty
    return codes


def _sketches(codes: np.ndarray, gaps: int) -> np.ndarray:
    """Four 64-bit sets of each word's pairs of letters at distances up to gaps + 1."""
    out, rows = np.zeros((4, len(codes)), np.uint64), np.arange(len(codes))
    for gap in range(1, gaps + 2):
        for i in range(codes.shape[1] - gap):
            there = rows[codes[:, i + gap] >= 0]
            if len(there):
                a, b = codes[there, i].astype(np.uint64), codes[there, i + gap].astype(np.uint64)
                h = (a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(56)
                out[h >> np.uint64(6), there] |= np.uint64(1) << (h & np.uint64(63))
    return out


class Kernel:
    """Thresholded, normalised kernel of words with the landmarks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        self.codes = coded(landmarks, -2)
        self.norm = np.sqrt(subsequence_kernel(np.where(self.codes < 0, -1, self.codes), self.codes))
        self.lengths = np.array([len(w) for w in landmarks], np.int64)
        self.sets = _sketches(np.where(self.codes < 0, -1, self.codes), 0)
        self.need = np.ceil(NEEDED * sum(np.bitwise_count(x) for x in self.sets))

    def candidates(self, words: list[str], codes: np.ndarray, marks: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(word, landmark) whose kernel is worth computing; marks are the landmarks to compare with (all by default).

        A word counts for a landmark only if at least NEEDED of the landmark's neighbouring letters stand in it
        in this order, with at most two letters between, and it has 0.6 to 3 times its length.
        """
        sets, length = _sketches(codes, 2), np.array([len(w) for w in words])
        found = []
        for j in range(len(self.landmarks)) if marks is None else marks:
            shared = sum(np.bitwise_count(mine & theirs) for mine, theirs in zip(sets, self.sets[:, j]))
            i = np.flatnonzero((shared >= self.need[j]) & (length >= 0.6 * self.lengths[j]) & (length <= 3 * self.lengths[j]))
            found.append(np.stack([i, np.full(len(i), j)]))
        word, mark = np.concatenate(found, axis=1)
        return word, mark

    def __call__(self, words: list[str], marks: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, landmark, value) of candidates whose value is over 0."""
        codes = coded(words, -1)
        word, mark = self.candidates(words, codes, marks)
        value = np.zeros(len(word), np.float32)
        for low in range(0, len(word), 20_000):
            w, m = word[low : low + 20_000], mark[low : low + 20_000]
            s, t = codes[w], self.codes[m]
            own, back = np.unique(w, return_inverse=True)
            norm = np.sqrt(subsequence_kernel(codes[own], np.where(codes[own] < 0, -2, codes[own])))[back]
            value[low : low + 20_000] = subsequence_kernel(s, t) / np.maximum(norm * self.norm[m], 1e-12)
        value = (value - LEAST) / (1 - LEAST)
        keep = value > 0
        return word[keep], mark[keep], np.minimum(value[keep], 1)


def spelled(tokens: list[str]) -> list[str]:
    """Words spelled letter by letter: runs of at least ORDER tokens with one letter or digit."""
    sizes = list(map(len, tokens))
    if sizes.count(1) < ORDER or bytes(ORDER * [1]) not in bytes([n if n < 255 else 255 for n in sizes]):
        return []
    out, run = [], []
    for w in [*tokens, ""]:
        if len(w) == 1 and w.isalnum():
            run.append(w)
            continue
        if len(run) >= ORDER:
            out.append("".join(run))
        run = []
    return out


class Features:
    """For each text: per landmark the log of the summed and the largest kernel value over its words, in the
    space of the landmarks' kernel matrix to the power -1/2; the log of the number of words."""

    def __init__(self, landmarks: list[str]):
        self.kernel, self.m = Kernel(landmarks), len(landmarks)
        gram = np.zeros((self.m, self.m))
        if landmarks:
            i, j, v = self.kernel(landmarks)
            gram[i, j] = v
        values, vectors = np.linalg.eigh((gram + gram.T) / 2 + 1e-3 * np.eye(self.m)) if self.m else (np.zeros(0), gram)
        self.white = vectors @ np.diag(np.maximum(values, 0.05) ** -0.5) @ vectors.T
        self.hot: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self.cold: set[str] = set()
        self.older: set[str] = set()

    def seen(self, whole: list[tuple[str, str]]) -> Iterator[tuple[str, int, float]]:
        """(word, landmark, value) for each (word, letters of it).

        A landmark is compared with letters of at most three times its length (and WINDOW) as a whole. Longer ones are seen
        through windows of twice its length and, in the candidates among those, through each stretch that is one letter longer than it.
        """
        short = [(w, x) for w, x in whole if len(x) <= WINDOW]
        if short:
            yield from ((short[i][0], j, v) for i, j, v in zip(*(c.tolist() for c in self.kernel([x for _, x in short]))))
        for n in sorted(set(self.kernel.lengths.tolist())):
            marks = np.flatnonzero(self.kernel.lengths == n).tolist()
            pieces = ((w, y) for w, x in whole if len(x) > min(3 * n, WINDOW) for y in windows_for(x, n))
            while held := list(islice(pieces, WINDOWS_AT_ONCE)):
                near = [y for _, y in held]
                near = [held[i] for i in np.unique(self.kernel.candidates(near, coded(near, -1), marks)[0]).tolist()]
                near += [(w, y[i : i + n + 1]) for w, y in near for i in range(len(y) - n)]
                if near:
                    yield from ((near[i][0], j, v) for i, j, v in zip(*(c.tolist() for c in self.kernel([y for _, y in near], marks))))

    def learn(self, new: set[str], batch: set[str]) -> None:
        """Looks at new words of a batch; of the others only those of the batch are kept where too many are remembered."""
        if len(self.cold) > REMEMBERED:
            self.older, self.cold = self.cold, set()
        if len(self.hot) > REMEMBERED:
            self.hot = {w: self.hot[w] for w in batch & self.hot.keys()}
        known = new & self.older
        self.cold |= known
        whole = [(w, x) for w in new - known for x in parts(w)]
        if whole and self.m:
            answers: dict[str, dict[int, float]] = {}
            for w, j, v in self.seen(whole):
                own = answers.setdefault(w, {})
                own[j] = max(own.get(j, 0.0), v)
            self.hot.update((w, (np.array(list(own), np.int64), np.array(list(own.values()), np.float32))) for w, own in answers.items())
            new = new - answers.keys()
        self.cold |= new

    def __call__(self, texts: list[str]) -> np.ndarray:
        tokens = []
        for t in texts:
            own = t.lower().split()
            tokens.append(own + spelled(own))
        batch = set().union(*tokens)
        if new := batch - self.cold - self.hot.keys():
            self.learn(new, batch)
        hot = self.hot
        out = np.zeros((len(texts), 2 * self.m + 1), np.float32)
        for k, own in enumerate(tokens):
            out[k, -1] = np.log1p(len(own))
            for w in filter(hot.__contains__, own):
                j, v = hot[w]
                out[k, j] += v
                out[k, self.m + j] = np.maximum(out[k, self.m + j], v)
        if self.m:
            out[:, : self.m] = np.log1p(out[:, : self.m]) @ self.white
            out[:, self.m : 2 * self.m] = out[:, self.m : 2 * self.m] @ self.white
        return out


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights (and bias, last) of a linear machine with squared hinge loss, by Newton steps on its support vectors."""
    x = np.column_stack([x, np.ones(len(x))]).astype(np.float64)
    sign, w = 2.0 * y - 1, np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(rounds):
        active = sign * (x @ w) < 1
        own = x[active]
        new = np.linalg.solve(ridge + 2 * cost * own.T @ own, 2 * cost * own.T @ sign[active])
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w


def fit_scale(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve that turns margins into probabilities (Platt)."""
    positive, negative = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    x, w = np.column_stack([margin, np.ones(len(margin))]), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, x.T @ (target - p) - 1e-6 * w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def chosen_landmarks(sample: DataFrame, landmarks: int, candidates: int) -> list[str]:
    """Words that mark toxic texts: the most telling ones (log-likelihood ratio), none too like another."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                word, toxic = [], []
                for text, label in zip(batch.column(0)[low : low + 500].to_pylist(), batch.column(1)[low : low + 500].to_pylist()):
                    own = (text or "").lower().split()
                    found = {x for w in {*own, *spelled(own)} for y in parts(w) for x in windows(y)}
                    word.extend(found)
                    toxic.extend([label] * len(found))
                yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(toxic, pa.int32())], names=["word", "toxic"])

    totals = sample.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))).first()
    toxic, clean = float(totals[0]), float(totals[1] - totals[0])
    if not toxic or not clean:
        return []
    seen = sample.select("text", "toxic").mapInArrow(spread, "word string, toxic int").groupBy("word").agg(F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("n"))
    b, rate = F.col("n") - F.col("a"), F.col("n") / (toxic + clean)
    gain = F.col("a") * F.log(F.col("a") / (toxic * rate)) + F.when(b > 0, b * F.log(b / (clean * rate))).otherwise(0.0)
    told = seen.where((F.col("a") >= 3) & (F.col("a") / toxic > b / clean)).orderBy(gain.desc(), "word").limit(candidates).collect()
    kept: list[str] = []
    for r in told:
        if len(kept) == landmarks:
            break
        if not kept or max(Kernel(kept)([r["word"]])[2], default=0) < 0.7:
            kept.append(r["word"])
    return kept


def toxicity(docs: DataFrame, labels: DataFrame, held_out=None, sample: int = SAMPLE, landmarks: int = LANDMARKS) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of docs.

    Learns from labels.toxic of rows that aren't held out (crc32 of doc_id mod 5 is 0 by default), from at most sample of
    them; a doc_id with several labels counts as toxic if one says so, and one with several texts teaches that with the smallest hash. The
    score is made from the text alone, so equal texts have equal scores, and neither the order nor the files of the rows change it. A
    null text is empty; a null doc_id has no label. Without both kinds of labels every score is the share of
    toxic ones (0 without labels). Other columns are ignored, whatever their names; an empty table gives an empty one.

    A text's kernel with a landmark is the sum (and, as a second feature, the largest) of its words' kernels with it: a convolution
    kernel over the words of a sentence, so that a worker computes each different word once.
    """
    held = held_out if held_out is not None else F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.col("text").cast("string").alias("text"))
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    there = rows.where(~F.col("held_out")).select("doc_id").distinct()
    known = known.join(there, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # so many rows at most
    known = stored(known)
    learn = rows.where(~F.col("held_out")).join(F.broadcast(known), "doc_id").groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"))
    learn = stored(learn.repartition(max(1, 2 * rows.sparkSession.sparkContext.defaultParallelism), "doc_id"))  # sample rows at most, whatever repeats
    marks = chosen_landmarks(learn, landmarks, CANDIDATES)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features(marks)
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                x = make([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(x), pa.list_(pa.float32())), part.column(2)], names=["doc_id", "x", "toxic"])

    fitted = None
    if marks:
        got = learn.select("doc_id", "text", "toxic").mapInArrow(features, "doc_id long, x array<float>, toxic int").toArrow().sort_by("doc_id")
        x, y = got["x"].combine_chunks().flatten().to_numpy().reshape(len(got), -1), got["toxic"].to_numpy()
        third = np.arange(len(x)) % 3 == 0
        middle = fit_svm(x[~third], y[~third])
        scale = fit_scale(np.column_stack([x[third], np.ones(third.sum())]) @ middle, y[third])
        fitted = fit_svm(x, y), scale
    share = learn.agg(F.coalesce(F.avg("toxic"), F.lit(0.0))).first()[0]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features(marks)
        for batch in batches:
            for part in in_slices(batch, 2):
                p = np.full(part.num_rows, float(share))
                if fitted:
                    x = make([t or "" for t in part.column(2).to_pylist()])
                    w, (slope, shift) = fitted
                    p = 1 / (1 + np.exp(-np.clip(slope * (x @ w[:-1] + w[-1]) + shift, -30, 30)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")


def op10_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op10_string_kernel_toxicity": op10_string_kernel_toxicity}
ORACLES: dict[str, str] = {}
