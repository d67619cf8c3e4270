"""Media columns: texts stored as WAV sound and known by their spectral peaks."""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

RATE = 8000
FRAME, HOP = 256, 128
BANDS = ((1, 9), (9, 25), (25, 57), (57, 129))
#: Peaks that each peak is paired with, and the most frames between the two.
FAN, SPAN = 3, 63
#: Frames that are transformed at once.
AT_ONCE = 4096
_WINDOW = np.hanning(FRAME).astype(np.float32)

SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, peak_time array<int>, peak_pair array<int>"


def padded(data: bytes, unit: int = 64) -> bytes:
    """data and zero bytes up to a positive multiple of unit."""
    return data + bytes(max(unit, -(-len(data) // unit) * unit) - len(data))


def to_wav(payload: bytes) -> bytes:
    """One 8-bit sample for each byte, one channel."""
    with io.BytesIO() as out:
        with wave.open(out, "wb") as w:
            w.setnchannels(1)
            w.setsampwidth(1)
            w.setframerate(RATE)
            w.writeframes(payload)
        return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as r:
        return r.readframes(r.getnframes())


def band_peaks(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The strongest frequency and its magnitude, for each frame of the short-time transform and each band."""
    if len(samples) < FRAME:
        samples = np.concatenate([samples, np.zeros(FRAME - len(samples), np.float32)])
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME)[::HOP]
    bins, size = [], []
    for low in range(0, len(frames), AT_ONCE):
        magnitude = np.abs(np.fft.rfft(frames[low : low + AT_ONCE] * _WINDOW, axis=1))
        own = np.stack([a + magnitude[:, a:b].argmax(axis=1) for a, b in BANDS], axis=1)
        bins.append(own)
        size.append(np.take_along_axis(magnitude, own, axis=1))
    return np.concatenate(bins), np.concatenate(size)


def fingerprint(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Times (frames) and codes of the pairs of spectral peaks.

    A peak is a band's strongest frequency in a frame that is not weaker than in the frames beside it and
    above the band's mean. Each peak is paired with the next FAN peaks within SPAN frames; the code holds both
    frequencies (1 to 128; the second less one, in seven bits) and the frames between them (six bits). Silence has no peaks.
    """
    bins, size = band_peaks(samples)
    around = np.pad(size, ((1, 1), (0, 0)), constant_values=-1)
    peak = (size >= around[:-2]) & (size > around[2:]) & (size > size.mean(axis=0) + 1e-3)
    time, band = np.nonzero(peak)
    freq = bins[time, band]
    times, codes = [], []
    for k in range(1, FAN + 1):
        gap = time[k:] - time[:-k]
        ok = gap <= SPAN
        times.append(time[:-k][ok])
        codes.append((freq[:-k][ok] << 13) | ((freq[k:][ok] - 1) << 6) | gap[ok])
    time, code = np.concatenate(times), np.concatenate(codes)
    order = np.lexsort((code, time))
    return time[order].astype(np.int32), code[order].astype(np.int32)


def media_columns(docs: DataFrame) -> DataFrame:
    """Each text as a WAV file, read back, with its digests and its fingerprint.

    A null text counts as empty and becomes 64 zero samples, which have no peaks. One row comes out for each row in, whatever its
    doc_id; other columns are ignored. feature digests the time-coded arrays peak_time and peak_pair.
    """

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        kinds = [pa.int64()] * 3 + [pa.string()] + [pa.int64()] * 2 + [pa.string()] * 2 + [pa.list_(pa.int32())] * 2
        schema = pa.schema(list(zip(names, kinds)))
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part, rows = batch.slice(low, 500), []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1)):
                    data = (text.as_py() or "").encode()
                    media = to_wav(padded(data))
                    payload = from_wav(media)
                    time, code = fingerprint(np.frombuffer(payload, np.uint8).astype(np.float32) - np.float32(128))
                    digest = hashlib.sha1(time.tobytes() + code.tobytes()).hexdigest()[:16]
                    rows.append((doc_id, len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), f"pairs={len(code)};code={digest}", time, code))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(convert, SCHEMA)


def op6_wav_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(table(spark, sf_dir, "documents"))


QUERIES = {"op6_wav_fingerprints": op6_wav_fingerprints}
ORACLES: dict[str, str] = {}
