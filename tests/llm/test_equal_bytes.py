"""Words, lines and pre-tokens that collide under polynomial hashes are still told apart."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from carelens.llm.automaton import score_texts
from carelens.llm.bpe import encode_documents
from carelens.llm.queries import tokenizer_file
from carelens.llm.repetition import repetition_rules
from carelens.llm.transducer import token_counts
from tests.llm.test_clusters_runs_leaks import thue_morse


@pytest.fixture(scope="module")
def colliding(spark):
    a, b = thue_morse(11)  # 2,048 letters each, equal under any such hash modulo 2**64
    c, d = thue_morse(12)
    lines = f"{a}\n{b}\n{a}\n{c}\n{d}\n"
    rows = [(1, a), (2, b), (3, f"{a} {b} {a}"), (4, f"{c} {d}"), (5, lines), (6, f"{b} {a} x " * 20), (7, f"{a} {a} {b} {b} " * 15)]
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), rows


def test_bpe(colliding):
    docs, rows = colliding
    import base64

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encode_documents(docs, tokenizer_file("byte_bpe_50k.tiktoken")).collect()}
    for i, text in rows:
        ids = enc.encode_ordinary(text)
        assert got[i] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_token_counts(colliding):
    docs, rows = colliding
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: r.n_tokens for r in token_counts(docs, tokenizer_file("byte_bpe_50k.json")).collect()}
    assert got == {i: len(t.encode(text, add_special_tokens=False).ids) for i, text in rows}


def test_repetition(colliding):
    docs, rows = colliding
    got = {r.doc_id: (r.n_dup_lines, r.n_repeat_words) for r in repetition_rules(docs).collect()}
    for i, text in rows:
        full = [x for x in text.split("\n") if x.strip()]
        w = text.split()
        windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        inside = {k + j for k, x in enumerate(windows) if windows.count(x) > 1 for j in range(3)}
        assert got[i] == (len(full) - len(set(full)), len(inside))


def test_language_model(colliding):
    docs, rows = colliding
    got = {r.doc_id: (r.n_known, r.train_tokens, r.base_score) for r in score_texts(docs, F.col("doc_id") != 2).collect()}
    train = [w for i, text in rows if i != 2 for w in [*text.split(), None]]
    n, v = len(train), len(set(train))
    for i, text in rows:
        tokens = [*text.split(), None]
        base = sum(math.log10((train.count(w) + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        assert got[i][:2] == (sum(w in train for w in tokens), n) and got[i][2] == pytest.approx(base, abs=1e-9)
