"""What a worker holds at a time in the pipeline's stages, whose workers live through all of them."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from carelens.llm import bpe, simhash, suffixes
from carelens.llm.queries import tokenizer_file


def _peak(run) -> int:
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_the_table_of_classes_is_built_in_blocks():
    assert _peak(bpe.classes.__wrapped__) < 16 << 20


def test_texts_are_encoded_in_bounded_pieces():
    data = tokenizer_file("byte_bpe_50k.tiktoken")
    text = "the patient was seen, and discharged again on day 12 " * 400
    batch = pa.RecordBatch.from_arrays([pa.array(range(200), pa.int64()), pa.array([text] * 200)], ["doc_id", "text"])
    bpe.ranks_of(data), bpe.classes()
    peak = _peak(lambda: [b.num_rows for b in bpe._short(data, True)([batch])])
    assert peak < 200 * bpe.ENCODE_BYTES
    sizes = [b.num_rows for b in bpe._short(data, True)([batch])]
    assert sum(sizes) == 200 and max(sizes) * len(text) <= bpe.ENCODE_BYTES


def _texts(n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz      ", np.uint8)
    return letters[np.random.default_rng(3).integers(0, len(letters), n * size)], np.arange(n + 1) * size


def test_anchors_are_found_in_bounded_pieces(monkeypatch):
    buf, offs = _texts(1000, 4000)
    whole = suffixes.anchor_runs(buf, offs, 50, 20)
    assert _peak(lambda: suffixes.anchor_runs(buf, offs, 50, 20)) < 48 << 20
    monkeypatch.setattr(suffixes, "STEP", 1 << 20)
    for a, b in zip(whole, suffixes.anchor_runs(buf, offs, 50, 20), strict=True):
        assert (a == b).all()


class _Frame:
    """Gives back the function that tasks would run."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_fingerprints_are_taken_in_bounded_pieces(spark, monkeypatch):
    buf, offs = _texts(500, 4000)
    whole = simhash.fingerprints(buf, offs, 4).view(np.int64).tolist()
    sizes, take = [], simhash.fingerprints
    monkeypatch.setattr(simhash, "fingerprints", lambda b, o, k: sizes.append(len(b)) or take(b, o, k))
    texts = [buf[a:b].tobytes().decode() for a, b in zip(offs[:-1], offs[1:], strict=True)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(500), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    out = list(simhash.fingerprint_table(_Frame(), "doc_id", "text", 4)([batch]))
    assert [x for b in out for x in b.column(1).to_pylist()] == whole
    assert sum(sizes) == len(buf) and max(sizes) <= 1 << 19
