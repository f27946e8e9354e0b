"""The operators on texts against plain brute-force versions."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from carelens.llm.automaton import score_texts
from carelens.llm.bpe import Chunk, decode_documents, encode_documents, ranks_of, stitch
from carelens.llm.queries import tokenizer_file
from carelens.llm.repetition import repeat_heights, repetition_rules
from carelens.llm.simhash import components, near_duplicates
from carelens.llm.suffixes import dedup_documents, dedup_report
from carelens.llm.transducer import token_counts
from tests.llm.conftest import sentence, with_clashes

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def sorted_rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def words(text):
    return WORD.findall((text or "").encode())


def lower(text):
    return (text or "").encode().lower()


# --- language-model scoring ---------------------------------------------------------------


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_a_plain_backoff_model(spark, docs, rows, order):
    train = [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 != 1]
    counts: Counter = Counter()
    sequence = lambda text: ["<s>"] * (order - 1) + WORD.findall(lower(text)) + ["</s>"]
    for r in train:
        s = sequence(r[1])
        for i in range(order - 1, len(s)):
            for k in range(1, order + 1):
                counts[tuple(s[i - k + 1 : i + 1])] += 1
        for k in range(1, order):
            counts[("<s>",) * k] += 1
    tokens = {g: c for g, c in counts.items() if len(g) == 1 and g != ("<s>",)}
    n, v, mass = sum(tokens.values()), len(tokens), 7.0

    def prob(gram):
        if len(gram) == 1:
            return (tokens.get(gram, 0) + 0.5) / (n + 0.5 * (v + 1))
        return (counts[gram] + mass * prob(gram[1:])) / (counts[gram[:-1]] + mass)

    want = []
    for r in rows:
        s = sequence(r[1])
        at = range(order - 1, len(s))
        base = sum(math.log10(prob((s[i],))) for i in at)
        score = sum(math.log10(prob(tuple(s[i - order + 1 : i + 1]))) for i in at)
        want.append((r[0], len(at), sum((s[i],) in tokens for i in at), n, round(base, 6), round(score, 6)))
    condition = F.crc32(F.col("doc_id").cast("string")) % 5 != 1
    got = score_texts(with_clashes(docs), condition, order=order, mass=mass, block_bytes=5000)
    got = got.select("doc_id", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6), F.round("score", 6))
    for a, b in zip(sorted_rows(got, "*"), sorted(want, key=repr), strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], abs=2e-6)


def test_scores_without_rows_or_training(spark, docs, empty):
    assert score_texts(empty, F.lit(True)).count() == 0
    got = score_texts(docs, F.lit(False)).agg(F.max("n_known"), F.max("train_tokens")).first()
    assert tuple(got) == (0, 0)


def test_probabilities_of_a_state_sum_to_one(spark):
    texts = ["a b a c", "b b a", "c a b d d"]
    train = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    probe = spark.createDataFrame([(100 + i, w) for i, w in enumerate(["a", "b", "c", "d", "zz", ""])], "doc_id long, text string")
    got = {r["doc_id"]: r for r in score_texts(train.unionAll(probe), F.col("doc_id") < 100, mass=3.0).collect()}
    # first tokens: P(text) / P(end | last word); the end's share is read off the one-word texts
    tokens = Counter(w for t in texts for w in [*t.split(), "</s>"])
    n, v = sum(tokens.values()), len(tokens)
    bigrams = Counter(p for t in texts for p in zip(["<s>", *t.split()], [*t.split(), "</s>"], strict=True))
    context = Counter({**tokens, "<s>": 3})
    end = lambda w: (bigrams[(w, "</s>")] + 3 * (tokens["</s>"] + 0.5) / (n + 0.5 * (v + 1))) / (context[w] + 3)
    total = sum(10 ** got[100 + i]["score"] / (end(w) if w != "" else 1) for i, w in enumerate(["a", "b", "c", "d", "zz", ""]))
    assert total == pytest.approx(1)


# --- byte-level BPE ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def ranks():
    return tokenizer_file("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding(ranks):
    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def digest(ids, text):
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("chunk,overlap", [(32768, 256), (300, 24), (64, 8)])
def test_bpe_equals_the_library(docs, rows, ranks, encoding, chunk, overlap):
    want = sorted(((r[0], *digest(encoding.encode_ordinary(r[1] or ""), r[1] or "")) for r in rows), key=repr)
    got = encode_documents(with_clashes(docs), ranks, chunk=chunk, overlap=overlap)
    assert sorted_rows(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want


def test_bpe_round_trip_and_no_rows(docs, rows, empty, ranks):
    encoded = encode_documents(docs, ranks, chunk=500, with_ids=True)
    got = sorted(((i, bytes(b)) for i, b in decode_documents(encoded, ranks).collect()), key=repr)
    assert got == sorted(((r[0], (r[1] or "").encode()) for r in rows), key=repr)
    assert encode_documents(empty, ranks).count() == 0


def test_bpe_on_every_code_point(ranks, encoding):
    text = "".join(f"{chr(c)}x{chr(c)} 1{chr(c)}" for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    whole = Chunk(ranks_of(ranks), 0, text.encode(), True)
    assert whole.ids.tolist() == encoding.encode_ordinary(text)


def test_stitching_joins_chunks_without_a_common_boundary(ranks, encoding):
    table = ranks_of(ranks)
    for text in ("a" * 500, "é" * 300, " " * 300 + "x", "ab" * 100 + " " * 90 + "cd" * 99, "it's we'll 'tis " * 40):
        raw = np.frombuffer(text.encode(), np.uint8)
        lead = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
        for chunk, overlap in ((40, 8), (17, 6)):
            n = len(lead) - 1
            parts = [Chunk(table, s, raw[lead[s] : lead[min(s + chunk + overlap, n)]].tobytes(), s + chunk + overlap >= n) for s in range(0, n, chunk)]
            assert stitch(table, parts).tolist() == encoding.encode_ordinary(text)


# --- token counts --------------------------------------------------------------------------


def test_token_counts_equal_the_library(docs, rows, empty):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for r in rows:
        n = len(library.encode(r[1] or "", add_special_tokens=False).ids)
        want.append((r[0], len((r[1] or "").encode()), n, n > 512))
    got = token_counts(with_clashes(docs), tokenizer_file("byte_bpe_50k.json"))
    assert sorted_rows(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)
    assert token_counts(empty, tokenizer_file("byte_bpe_50k.json")).count() == 0


def test_counter_states_are_only_a_cache(monkeypatch):
    import carelens.llm.transducer as t

    data = tokenizer_file("byte_bpe_50k.json")
    counter, _ = t.compiled(data)
    pieces = [f" {w}".encode() for w in sentence(__import__("random").Random(3), 400).split()]
    want = [len(counter.encode(p)) for p in pieces]
    assert counter.counts(pieces) == want
    monkeypatch.setattr(t, "MOST_STATES", 50)
    assert [counter.counts([p])[0] for p in pieces] == want


# --- SimHash -------------------------------------------------------------------------------


def plain_simhash(text, shingle=4):
    w = WORD.findall(lower(text))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + shingle]), 42) for i in range(max(1, len(w) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("distance", [4, 3, 6])
def test_near_duplicates_equal_all_pairs(docs, rows, distance):
    fps = [plain_simhash(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    least: dict = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    want = sorted(((r[0], f"{fps[i]:016x}", least.get(find(i))) for i, r in enumerate(rows)), key=repr)
    got = near_duplicates(with_clashes(docs), distance=distance)
    assert sorted_rows(got, "doc_id", "fingerprint", "component_id") == want


def test_near_duplicates_of_nothing(empty):
    assert near_duplicates(empty).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(i, 200) for i in range(201, 230)] + [(300, 301)]
    nodes = sorted({x for e in edges for x in e} | {999})
    got = dict(components(spark.createDataFrame([(n,) for n in nodes], "fp long"), spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {n: 0 if n <= 40 else 100 if n < 200 else 200 if n < 300 else 300 if n < 999 else 999 for n in nodes}


@pytest.mark.parametrize("distance", [3, 4])
def test_links_of_a_hot_prefix_in_rounds(distance, monkeypatch):
    import random
    import tracemalloc

    import carelens.llm.simhash as s

    rng = random.Random(distance)
    fps = np.unique(np.array([0xABCDEF0123 << 24 | rng.getrandbits(24) for _ in range(1500)], np.uint64))
    near = np.argwhere(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance, 1))
    want = s.links_in(fps, 0, 0, distance)  # at once
    monkeypatch.setattr(s, "HELD_VARIANTS", 60_000, raising=False)
    s.flips.cache_clear()
    tracemalloc.start()
    got = s.links_in(fps, 0, 0, distance)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) and got.tolist() == want.tolist()
    assert (np.bitwise_count(got[:, 0] ^ got[:, 1]) <= distance).all()
    root = {int(f): int(f) for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in got.tolist():
        root[max(find(a), find(b))] = min(find(a), find(b))
    assert len(near) > 100 and all(find(int(fps[a])) == find(int(fps[b])) for a, b in near)
    assert peak < 20 << 20, peak


# --- suffix-array dedup --------------------------------------------------------------------


def plain_dedup(rows, depth=50):
    ids = [float("inf") if r[0] is None else r[0] for r in rows]
    texts = [(r[1] or "").encode() for r in rows]
    least: dict = {}
    for i, t in zip(ids, texts, strict=True):
        for k in range(len(t) - depth + 1):
            w = t[k : k + depth]
            least[w] = min(i, least.get(w, i))
    gone = []
    for i, t in zip(ids, texts, strict=True):
        mark = np.zeros(len(t), bool)
        for k in range(len(t) - depth + 1):
            if least[t[k : k + depth]] < i:
                mark[k : k + depth] = True
        gone.append(mark)
    return texts, gone


@pytest.mark.parametrize("block_bytes", [3000, 1 << 22])
def test_dedup_equals_all_windows(docs, rows, block_bytes):
    texts, gone = plain_dedup(rows)
    want = []
    for r, t, g in zip(rows, texts, gone, strict=True):
        kept = bytes(b for b, x in zip(t, g, strict=True) if not x)
        want.append((r[0], len(t), int(g.sum()), int((g & ~np.append(False, g[:-1])).sum()), hashlib.sha256(kept).hexdigest()))
    got = dedup_report(with_clashes(docs), block_bytes=block_bytes)
    assert sorted_rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want, key=repr)
    assert got.agg(F.sum("n_removed")).first()[0] > 2000


@pytest.mark.parametrize("block_bytes", [3000, 1 << 22])
def test_dedup_deals_a_hot_anchor_by_windows(spark, docs, rows, block_bytes, monkeypatch, tmp_path):
    import random
    import uuid

    import carelens.llm.suffixes as s

    rng = random.Random(8)
    passage = sentence(rng, 30)
    rows = rows + [(5000 + i, f"{rng.random()}{rng.random()}{passage}{rng.random()}{rng.random()}", "en", "a", 1) for i in range(300)]
    plain, folder = s.repeated_windows, str(tmp_path)

    def counted(depth):
        run = plain(depth)

        def count(group):
            if group["bucket"].iloc[0] >= 0:
                with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                    f.write(str(sum(len(s.unsqueeze(d)[0]) for d in group["data"])))
            return run(group)

        return count

    monkeypatch.setattr(s, "repeated_windows", counted)
    monkeypatch.setattr(s, "HOT_RUNS", 40, raising=False)
    monkeypatch.setattr(s, "PACKED", 7, raising=False)
    monkeypatch.setattr(s, "BUCKET_BYTES", 2000)
    texts, gone = plain_dedup(rows)
    want = [(r[0], len(t), int(g.sum()), hashlib.sha256(t if not g.any() else bytes(b for b, x in zip(t, g, strict=True) if not x)).hexdigest()) for r, t, g in zip(rows, texts, gone, strict=True)]
    got = dedup_report(spark.createDataFrame(rows, docs.schema).repartition(4), block_bytes=block_bytes)
    assert sorted_rows(got, "doc_id", "n_bytes", "n_removed", "kept_sha256") == sorted(want, key=repr)
    # every passage's anchors have 300 runs
    assert max(int(f.read_text()) for f in tmp_path.iterdir()) < 200


def test_dedup_in_rounds(docs, rows, monkeypatch):
    import random

    import carelens.llm.suffixes as s

    monkeypatch.setattr(s, "SORTED", 97)
    rng = random.Random(1)
    data = np.frombuffer("".join(rng.choice("ab") for _ in range(900)).encode() * 2, np.uint8)
    at = np.arange(len(data) - 20)
    least = np.array([rng.randint(0, 50) for _ in at], np.int64)
    want: dict = {}
    for p, x in zip(at, least, strict=True):
        w = data[p : p + 20].tobytes()
        want[w] = min(x, want.get(w, x))
    s.sort_windows(data, at, least, 20)
    assert least.tolist() == [want[data[p : p + 20].tobytes()] for p in at]


def test_dedup_tasks_work_piece_by_piece():
    """A task's arrays are a few bytes per byte of text, not one or several numbers of eight bytes."""
    import tracemalloc

    import carelens.llm.suffixes as s

    n = 4 << 20
    spans = [s.squeeze(s.deltas(np.arange(0, n - 60, 100).astype(np.uint32)), np.full(len(range(0, n - 60, 100)), 60, np.uint32))]
    digit = np.random.default_rng(1).integers(97, 123, n, dtype=np.uint8)
    at, least = np.arange(n - 50), np.arange(n - 50)
    peaks = []
    tracemalloc.start()
    try:
        for work in (lambda: s.covered_bytes(n, spans), lambda: s.sort_windows(digit, at, least, 50)):
            tracemalloc.reset_peak()
            before = tracemalloc.get_traced_memory()[0]
            out = work()
            peaks.append((tracemalloc.get_traced_memory()[1] - before) / n)
            if out is not None:
                assert out.sum() == 60 * len(range(0, n - 60, 100))
    finally:
        tracemalloc.stop()
    assert peaks[0] < 8 and peaks[1] < 40, peaks


def test_deduplicated_texts_keep_whole_characters(docs, rows, empty):
    texts, gone = plain_dedup(rows)
    want = []
    for r, t, g in zip(rows, texts, gone, strict=True):
        out, at = [], 0
        for ch in t.decode():
            n = len(ch.encode())
            if not g[at : at + n].all():
                out.append(ch)
            at += n
        want.append((r[0], None if r[1] is None else "".join(out), r[2], r[3], r[4]))
    got = dedup_documents(docs, block_bytes=9000)
    assert got.columns == docs.columns and sorted_rows(got, "*") == sorted(want, key=repr)
    clash = with_clashes(docs)
    assert dedup_documents(clash).columns == clash.columns
    assert dedup_report(empty).count() == 0 and dedup_documents(empty).count() == 0


# --- repetition rules ----------------------------------------------------------------------


def plain_rules(text):
    w = words(text)
    text = text or ""
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        again += bool(words(line)) and line in seen
        seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), again, len(covered), failed


def test_repetition_rules_equal_plain_counts(spark, docs, rows, empty):
    extra = [(2000, "a b c d\n" * 30 + "tail", None, None, 0), (2001, "line one\nline one\n\n \n \nline two\nline one", None, None, 0), (2002, "x # * <y> $|% &\n", None, None, 0)]
    more = docs.unionAll(spark.createDataFrame(extra, docs.schema))
    got = repetition_rules(with_clashes(more))
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted_rows(got, *columns) == sorted(((r[0], *plain_rules(r[1])) for r in [*rows, *extra]), key=repr)
    assert got.where("base_failed AND kept").count() == 0
    assert repetition_rules(empty).count() == 0


def test_repeat_heights_equal_all_pairs():
    rng = np.random.default_rng(2)
    sizes = [0, 1, 30, 80, 2, 50]
    ids = rng.integers(0, 3, sum(sizes))
    row = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.repeat(np.cumsum(sizes), sizes)
    got = repeat_heights(ids, row, ends, least=1)
    for i in range(len(ids)):
        best = 0
        for j in range(len(ids)):
            k = 0
            while j != i and row[i] == row[j] and i + k < ends[i] and j + k < ends[j] and ids[i + k] == ids[j + k]:
                k += 1
            best = max(best, k)
        assert got[i] == best


def test_the_method_rejects_what_the_plain_rules_pass(spark):
    import random

    rng = random.Random(4)
    passage, rest = sentence(rng, 45), sentence(rng, 101)
    texts = [(1, f"{passage} {rest} {passage}"), (2, sentence(rng, 200))]
    got = {r["doc_id"]: r for r in repetition_rules(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert not got[1]["base_failed"] and not got[1]["kept"] and got[1]["longest_repeat"] == 45 and got[1]["covered_words"] == 90
    assert got[2]["kept"]


def plain_method(words, min_words=10, max_covered=0.1, max_repeat=50):
    """(covered_words, longest_repeat, the method's verdict) by comparing all pairs of places."""
    n = len(words)
    height = [0] * n
    for i in range(n):
        for j in range(n):
            k = 0
            while j != i and max(i, j) + k < n and words[i + k] == words[j + k]:
                k += 1
            height[i] = max(height[i], k)
    covered = {p for i in range(n) if height[i] >= min_words for p in range(i, i + height[i])}
    longest = max(height, default=0)
    return len(covered), longest if longest >= 3 else 0, len(covered) <= max_covered * n and longest <= max_repeat


def test_method_columns_equal_brute_force(spark, rows):
    import random

    rng = random.Random(12)
    texts = [(i, text) for i, text, *_ in rows if text and len(text) < 2500][:25]
    for i in range(60):
        w = sentence(rng, rng.randint(40, 110)).split()
        part = w[: rng.choice([5, 9, 10, 11, 14, 60])]
        at = rng.randint(0, len(w))
        texts.append((5000 + i, " ".join(w[:at] + part * rng.choice([1, 1, 2]) + w[at:])))
    got = {r.doc_id: r for r in repetition_rules(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    verdicts = set()
    for i, text in texts:
        r, (covered, longest, fine) = got[i], plain_method(words(text))
        assert (r.covered_words, r.longest_repeat, r.kept) == (covered, longest, fine and not r.base_failed)
        verdicts.add((r.base_failed, r.kept))
    assert verdicts >= {(False, True), (False, False)}


def test_the_limits_reject_rows_of_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    kept = repetition_rules(docs).groupBy("base_failed", "kept").count().collect()
    n = {(r.base_failed, r.kept): r["count"] for r in kept}
    assert 0 < n[False, False] < 0.01 * n[False, True] and (True, True) not in n
