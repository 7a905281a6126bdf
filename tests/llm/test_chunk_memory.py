"""Tables of a task stay small beside its chunk of text, and cutting them changes nothing."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from sievework.llm import buffers, line_quality, simhash, suffix_dedup


def documents(n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    data = np.random.default_rng(3).integers(97, 123, n * size).astype(np.uint8)
    data[::7] = 32
    if n > 1:
        data[size : 2 * size] = data[:size]
    return data, np.arange(n + 1, dtype=np.int64) * size


def peak_mb(work) -> float:
    work()  # tables that are kept are made
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 2**20
    finally:
        tracemalloc.stop()


def test_anchors_of_a_chunk():
    data, offsets = documents(500, 4_000)
    assert peak_mb(lambda: suffix_dedup.Anchors(data, offsets, 50, 16)) < 45


def test_ragged():
    data, _ = documents(500, 4_000)
    starts = np.arange(0, len(data) - 80, 40)
    lengths = np.full(len(starts), 80)
    assert peak_mb(lambda: buffers.ragged(data, starts, lengths)) < 15


def test_tokens():
    data, _ = documents(500, 4_000)
    starts = np.arange(0, len(data) - 50, 8)
    assert peak_mb(lambda: suffix_dedup.tokens(data, starts, np.full(len(starts), 50), 1)) < 10


def test_fingerprints_of_a_chunk():
    data, offsets = documents(125, 4_000)
    assert peak_mb(lambda: simhash.chunk_fingerprints(data, offsets, 4)) < 40


def test_links_of_a_bucket():
    fps = np.random.default_rng(1).integers(0, 2**64, 30_000, np.uint64) & np.uint64(0xFFFFFFFFF)
    fps = fps[np.argsort(simhash.gray_rank(fps))]
    one = np.zeros(len(fps), np.int64)
    assert peak_mb(lambda: [None for _ in simhash.GrayIndex(one, fps).links(4)]) < 150


@pytest.mark.parametrize("size", [1, 64, 700, 1 << 30])
def test_anchors_are_those_of_each_document(monkeypatch, size):
    texts = [b"", b"short", b"a" * 300, *(bytes(documents(1, n)[0]) for n in (49, 50, 51, 333, 900)), b"", bytes(documents(1, 900)[0][5:])]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    monkeypatch.setattr(suffix_dedup, "SMALL_CHUNK_BYTES", size)
    a = suffix_dedup.Anchors(data, offsets, 50, 16)
    found = [(int(d), int(n), int(i), data[f:e].tobytes(), int(t - f)) for d, n, i, f, e, t in zip(a.doc, a.number, a.inside, a.first, a.end, a.at)]
    expected = []
    for d, text in enumerate(texts):
        b = suffix_dedup.Anchors(np.frombuffer(text, np.uint8), np.array([0, len(text)]), 50, 16)
        expected += [(d, n, int(f), text[f:e], int(t - f)) for n, (f, e, t) in enumerate(zip(b.first, b.end, b.at))]
    assert found == expected
    prefix = buffers.PrefixHash(data)
    assert (a.content == prefix.ranges(a.first, a.end)).all() and (a.hash == prefix.ranges(a.at, a.at + 16)).all()


def test_ragged_in_pieces(monkeypatch):
    data, _ = documents(5, 100)
    starts, lengths = np.array([3, 0, 100, 7, 499, 0]), np.array([0, 90, 5, 300, 1, 0])
    expected = b"".join(data[a : a + n].tobytes() for a, n in zip(starts, lengths))
    for size in (1, 4, 95, 1 << 20):
        monkeypatch.setattr(buffers, "GATHERED", size)
        assert buffers.ragged(data, starts, lengths).tobytes() == expected


def test_tokens_in_pieces(monkeypatch):
    data, _ = documents(1, 40)
    starts, lengths = np.array([0, 5, 39, 40, 20]), np.array([16, 3, 1, 0, 20])
    expected = [[int.from_bytes(data[a : a + n].tobytes().ljust(24, b"\0")[8 * i : 8 * i + 8]) for a, n in zip(starts, lengths)] for i in range(3)]
    for size in (1, 2, 100):
        monkeypatch.setattr(suffix_dedup, "READ", size)
        assert suffix_dedup.tokens(data, starts, lengths, 3).tolist() == expected
    assert suffix_dedup.tokens(data[:0], np.zeros(2, np.int64), np.zeros(2, np.int64), 2).tolist() == [[0, 0], [0, 0]]


def test_passing_gives_a_batch_for_each_chunk(monkeypatch):
    """Rows that stay are not gathered over a whole batch."""
    monkeypatch.setattr(line_quality, "SMALL_CHUNK_BYTES", 100)
    taken = {}

    class Frame:
        columns, schema = ["doc_id", "text"], None

        def mapInArrow(self, run, schema):
            taken["run"] = run

    line_quality.passing(Frame(), line_quality.LineModel(line_quality.PLAIN_WEIGHTS, line_quality.PLAIN_TRANSITIONS))
    words = "the river runs under an old stone bridge near our small green house."
    texts = [words, None, words + " Home.", "", words * 3, "few words"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], names=["doc_id", "text"])
    out = list(taken["run"]([batch.slice(0, 0), batch]))
    model = line_quality.LineModel(line_quality.PLAIN_WEIGHTS, line_quality.PLAIN_TRANSITIONS)
    kept = line_quality.judged(*buffers.text_buffer(batch.column(1)), model)[6]
    assert [i for b in out for i in b.column(0).to_pylist()] == np.flatnonzero(kept).tolist()
    assert kept.any() and max(b.get_total_buffer_size() and len(b) for b in out) < 3
