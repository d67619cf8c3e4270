import hashlib
import zlib

import numpy as np

from earlymark.llm import media


def test_wav_round_trip():
    for data in (b"", b"x", bytes(range(256)), b"a" * 64, b"a" * 65):
        payload = media.padded(data)
        assert len(payload) % 64 == 0 and len(payload) >= 64 and payload.startswith(data) and not payload[len(data) :].strip(b"\0")
        assert media.from_wav(media.to_wav(payload)) == payload


def test_tone_has_its_frequency_in_the_code():
    t = np.arange(8192)
    samples = (100 * np.sin(2 * np.pi * 20 / media.FRAME * t) * (1 + 0.5 * np.sin(2 * np.pi * t / 1024))).astype(np.float32)
    bins, size = media.band_peaks(samples)
    assert (bins[:, 1] == 20).all()
    _, code = media.fingerprint(samples)
    assert len(code) and np.isin(20, code >> 13)


def test_blocks_of_frames_do_not_change_the_result(monkeypatch):
    samples = np.random.default_rng(0).normal(size=50_000).astype(np.float32)
    whole = media.fingerprint(samples)
    monkeypatch.setattr(media, "AT_ONCE", 7)
    assert all(np.array_equal(a, b) for a, b in zip(whole, media.fingerprint(samples)))


def plain_fingerprint(samples):
    """Peaks by sums over sines and cosines, one frame, band and pair after the other."""
    n = media.FRAME
    samples = np.pad(samples.astype(float), (0, max(0, n - len(samples))))
    turn = 2 * np.pi * np.outer(np.arange(n), np.arange(n // 2 + 1)) / n
    hann = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / (n - 1))
    best = []
    for start in range(0, len(samples) - n + 1, media.HOP):
        x = samples[start : start + n] * hann
        size = np.hypot(x @ np.cos(turn), x @ np.sin(turn))
        best.append([max((size[f], -f) for f in range(a, b)) for a, b in media.BANDS])
    peaks = []
    for t, frame in enumerate(best):
        for b, (size, f) in enumerate(frame):
            mean = sum(x[b][0] for x in best) / len(best)
            before, after = best[t - 1][b][0] if t else -1, best[t + 1][b][0] if t + 1 < len(best) else -1
            if size >= before and size > after and size > mean + 1e-3:
                peaks.append((t, -f))
    pairs = [(t, f * 8192 + (g - 1) * 64 + u - t) for i, (t, f) in enumerate(peaks) for u, g in peaks[i + 1 : i + 1 + media.FAN] if u - t <= media.SPAN]
    return sorted(pairs)


def test_fingerprint_is_the_plain_one(spark):
    rng = np.random.default_rng(1)
    for n in (64, 256, 300, 5000):
        samples = rng.normal(size=n).astype(np.float32) * 40
        assert list(zip(*(x.tolist() for x in media.fingerprint(samples)))) == plain_fingerprint(samples), n
    rows = [(k, "".join(chr(c) for c in rng.integers(32, 400, n))) for k, n in enumerate((0, 10, 400, 3000))]
    for r in media.media_columns(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        payload = np.frombuffer(media.padded(rows[r.doc_id][1].encode()), np.uint8)
        assert list(zip(r.peak_time, r.peak_pair)) == plain_fingerprint(payload - 128.0), r.doc_id


def test_documents(spark):
    rows = [(1, "hello " * 500, 0), (2, "hello " * 500, 1), (3, None, 2), (4, "", 3), (None, "é" * 40_000, 4)]
    out = media.media_columns(spark.createDataFrame(rows, "doc_id long, text string, feature int")).toPandas()
    assert len(out) == 5
    for (doc_id, text, _), r in zip(rows, out.itertuples()):
        payload = media.padded((text or "").encode())
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len((text or "").encode()), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    assert out.feature[0] == out.feature[1] and out.media_sha256[0] == out.media_sha256[1]
    assert out.feature[2] == out.feature[3] and len(out.peak_time[2]) == 0
    assert media.media_columns(spark.createDataFrame([], "doc_id long, text string")).count() == 0
