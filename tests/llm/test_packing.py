import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from earlymark.llm import packing

ENCODER = packing.WordEncoder(packing.default_tokenizer(), limit=40)


def plain(text):
    return np.array(ENCODER.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab é1.,'#!_\n\t\r ́Ω", max_size=40))
def test_word_by_word_is_the_tokenizer(text):
    assert ENCODER.encode(text) == plain(text)


def test_words_of_letters_come_from_the_model():
    assert ENCODER.by_model
    for w in ("word", "\nWord", "é", "ñandú", "\n漢字", "x" * 300):
        assert ENCODER.word(w) == plain(w if w[0] == "\n" else " " + w)


@pytest.mark.parametrize("text", ["it's a dog's. life\nThe \n end", "x" * 5000, "a  b   c", "<|endoftext|> a<|endoftext|>", "word%%% word### WORD!!\nNext."])
def test_words_of_interest(text):
    assert ENCODER.encode(text) == plain(text)


def test_a_new_word_is_made_once():
    encoder, made = packing.WordEncoder(packing.default_tokenizer()), []
    new, encoder.new = encoder.new, lambda w: made.append(w) or new(w)
    for text in ("a bcd, bcd e bcd,", "a bcd, fgh\nIj"):
        assert encoder.encode(text) == plain(text)
    assert made == ["bcd,", "bcd", "e", "fgh", "\nIj"]


def check_plan(histogram, capacity=1024, **options):
    runs, sequences = packing.packing_plan(histogram, capacity, **options)
    fill, places, seen = {}, {}, {}
    ends = {n: c for n, c in histogram.items() if c}
    for i, (length, rank, seq, each, offset) in enumerate(runs.tolist()):
        assert seen.get(length, 0) == rank
        last = runs[i + 1][1] if i + 1 < len(runs) and runs[i + 1][0] == length else ends[length]
        for r in range(last - rank):
            places.setdefault(seq + r // each, []).append((offset + r % each * length, length))
        seen[length] = last
    assert {n: c for n, c in seen.items() if c} == ends
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sequences == len(places)
    return sequences


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 30), max_size=40))
def test_every_piece_has_a_gapless_place(histogram):
    check_plan(histogram, 64)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 30), max_size=40), st.integers(1, 6))
def test_grouped_lengths_have_gapless_places(histogram, groups):
    check_plan(histogram, 64, groups=groups, small=8)


def fewest(lengths, capacity):
    """The fewest sequences, by trying every place for each length."""
    lengths, best = sorted(lengths, reverse=True), [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for room in {r for r in rooms if r >= lengths[i]}:
            rest = list(rooms)
            rest.remove(room)
            place(i + 1, [*rest, room - lengths[i]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=9), st.sampled_from([2, 8, 32]))
def test_at_most_one_sequence_above_the_fewest(lengths, small):
    histogram = {n: lengths.count(n) for n in set(lengths)}
    least = fewest(lengths, 32)
    assert least <= check_plan(histogram, 32, small=small) <= least + 1


def test_few_sequences():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 1025, 20_000)
    histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    assert check_plan(histogram) <= 1.01 * -(-int(lengths.sum()) // 1024)


def test_pieces_come_in_small_batches():
    batch = pa.RecordBatch.from_arrays([pa.array(range(400), pa.int64()), pa.array(["x"] * 400)], names=["doc_id", "text"])
    out = list(packing._cut(iter([batch]), lambda text: bytes(4 * 3000), 1024))
    assert sum(b.num_rows for b in out) == 1200 and max(b.nbytes for b in out) < 1.2 * (1 << 20)


def test_older_words_go_with_the_task(monkeypatch):
    path, texts = packing.default_tokenizer(), [" ".join(f"w{i * 7 + k}" for k in range(7)) for i in range(30)]
    encoder = packing.WordEncoder(path, limit=40)
    monkeypatch.setitem(packing._encoders, path, encoder)
    batch = pa.RecordBatch.from_arrays([pa.array(range(30), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    for _ in range(2):
        out = pa.Table.from_batches(packing._encoded(iter([batch]), path, 1024))
        assert encoder.cache and not encoder.old and out["ids"].to_pylist() == [plain(t) + b"\2\0\0\0" for t in texts]


def test_a_worker_gets_small_batches_of_texts(spark, monkeypatch):
    encoded, seen, large = packing._encoded, spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def watched(batches, path, capacity):
        for b in batches:
            seen.add(1)
            large.add(b.nbytes > 2 * (4 << 20))
            yield from encoded(iter([b]), path, capacity)

    monkeypatch.setattr(packing, "_encoded", watched)
    docs = spark.range(6000).coalesce(1).selectExpr("id AS doc_id", "repeat('word ', 400) AS text")
    assert packing.packed_documents(docs).count() == 6000 and seen.value > 1 and large.value == 0


def test_documents(spark):
    long = "word " * 3000
    rows = [(1, "Hello there. Hello", 0), (2, None, 0), (3, "", 1), (4, long, 1), (4, long, 1), (None, "x", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    out = packing.packed_documents(docs).toPandas()
    assert sorted(out.columns) == ["doc_id", "ids_crc32", "length", "offset", "piece", "sequence_id", "start"]
    ids = np.append(np.frombuffer(plain(long), "<u4"), 2).astype("<u4")
    own = out[out.doc_id == 4].sort_values(["piece", "sequence_id"])
    assert own.length.sum() == 2 * len(ids) and (own[own.piece > 0].length == 1024).all()
    for r in own.itertuples():
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    assert list(out[out.doc_id.isin([2, 3])].length) == [1, 1]
    assert packing.packed_documents(docs.limit(0)).count() == 0
