"""Centroid clustering, periodic runs and decontamination against plain brute-force versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from carelens.llm import common, contamination, periods, queries
from carelens.llm.centroids import cluster
from carelens.llm.contamination import Automaton
from carelens.llm.periods import find_runs, periodic_runs
from tests.llm.conftest import sentence, with_clashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def thue_morse(doublings: int) -> tuple[str, str]:
    """Two different words that collide under any polynomial hash modulo 2**64."""
    a, b = "a", "b"
    for _ in range(doublings):
        a, b = a + b, b + a
    return a, b


# --- segments -----------------------------------------------------------------------------


@pytest.mark.parametrize("hashes", [common.hash_segments, lambda buf, s, e: np.zeros(len(s), np.uint64)])
def test_segments_are_equal_only_if_their_bytes_are(monkeypatch, hashes):
    monkeypatch.setattr(common, "hash_segments", hashes)
    a, b = thue_morse(11)
    listed = [a, b, "x", "xy", a, "", b, "x", a + "z", "abcdefgh", "abcdefghi", "abcdefgh", "\0", "\0\0"]
    data = "".join(listed).encode()
    at = np.append(0, np.cumsum([len(x) for x in listed]))
    first, which = common.distinct_segments(np.frombuffer(data, np.uint8), at[:-1], at[1:])
    assert [listed[first[k]] for k in which] == listed
    assert len(first) == len(set(listed))


# --- centroid clustering ------------------------------------------------------------------


def plain_clusters(rows, k, rounds, dims, scale=1024):
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == dims and all(c is not None and math.isfinite(c) for c in x):
            kept.append((vec_id, [max(min(math.floor(scale * float(np.float32(c))), 1 << 27), -(1 << 27)) for c in x]))
    key = lambda v: (v[0] is None, "" if v[0] is None else hashlib.sha256(f"3:{v[0]}".encode()).hexdigest(), v[1])
    centroids = [q for _, q in sorted(kept, key=key)[:k]]
    nearest = lambda q: min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), i) for i, c in enumerate(centroids))
    for _ in range(rounds):
        own = [nearest(q)[1] for _, q in kept]
        for i in set(own):
            members = [q for (_, q), j in zip(kept, own, strict=True) if j == i]
            centroids = [[sum(c) // len(members) for c in zip(*members, strict=True)] if j == i else c for j, c in enumerate(centroids)]
    best = [nearest(q) for _, q in kept]
    inertia = {i: sum(d for d, j in best if j == i) for i in range(len(centroids))}
    return sorted([(v, j, d, inertia[j], sum(inertia.values()), centroids[j]) for (v, _), (d, j) in zip(kept, best, strict=True)], key=repr)


def vectors(seed=3, n=90, dims=4):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(i % 3, 0.4) for _ in range(dims)]) for i in range(n)]
    rows += [(5, rows[7][1]), (5, rows[7][1]), (None, [0.5] * dims), (None, None), (700, None), (701, [1.0] * (dims - 1)), (702, [None, 1.0, 2.0, 3.0])]
    rows += [(703, [float("nan"), 1.0, 2.0, 3.0]), (704, [float("inf"), 1.0, 2.0, 3.0]), (705, [3e38, -3e38, 0.0, 0.0]), (706, []), (707, [-0.0001, 0.0, -0.0, 1e-30])]
    return rows


@pytest.mark.parametrize(("k", "rounds"), [(1, 2), (3, 10), (8, 10)])
def test_clusters_equal_a_plain_version(spark, k, rounds):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = cluster(with_clashes(df).selectExpr("*", "1 cluster", "2 distance", "3 q"), k=k, rounds=rounds, dims=4)
    assert sorted([(r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, list(r.centroid)) for r in got.collect()], key=repr) == plain_clusters(rows, k, rounds, 4)


def test_fewer_vectors_than_centroids_and_equal_starts(spark):
    rows = [(1, [1.0, 2.0, 0.0, 0.0]), (1, [1.0, 2.0, 0.0, 0.0]), (2, [1.0, 2.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = cluster(df, dims=4).collect()
    assert [(r.cluster, r.distance, r.inertia) for r in got] == [(0, 0, 0)] * 3
    none = cluster(df.where("vec_id > 5"), dims=4)
    assert none.count() == 0
    assert dict(none.dtypes) == {"vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint", "centroid": "array<bigint>"}


def test_clusters_use_jvm_expressions_only(spark):
    df = spark.createDataFrame(vectors(), "vec_id long, embedding array<float>")
    plan = cluster(df, dims=4)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- periodic runs ------------------------------------------------------------------------


def plain_runs(w, times=4, least=6):
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def plain_digest(doc_id, text):
    w = planted(doc_id, WORD.findall(text or ""))
    found = plain_runs(w)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(found, key=lambda r: (r[0], r[2])))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *top, sha(lines), sha(" ".join(x for i, x in enumerate(w) if i not in dropped)))


@pytest.mark.parametrize(("times", "least"), [(4, 6), (3, 5), (5, 2)])
def test_runs_of_random_words_equal_brute_force(times, least):
    rng = random.Random(times)
    for _ in range(400):
        rows = []
        for _ in range(rng.randint(1, 4)):
            k = rng.choice([1, 2, 2, 3, 5])
            w = [rng.randrange(k) for _ in range(rng.randint(0, 50))]
            block = [rng.randrange(k) for _ in range(rng.randint(1, 6))]
            at = rng.randint(0, len(w))
            w[at:at] = (block * 12)[: rng.randint(0, 60)]
            rows.append(w)
        bounds = np.append(0, np.cumsum([len(w) for w in rows]))
        got = find_runs(np.array([x for w in rows for x in w], np.int64), bounds, times, least)
        assert list(map(tuple, got.tolist())) == [(s + b, n, q) for w, b in zip(rows, bounds.tolist(), strict=False) for s, n, q in plain_runs(w, times, least)]


def test_long_runs_are_found():
    assert find_runs(np.zeros(60000, np.int64), np.array([0, 60000])).tolist() == [[0, 60000, 1]]
    block = np.random.default_rng(1).integers(0, 50, 997)
    assert find_runs(np.tile(block, 60), np.array([0, 997 * 60])).tolist() == [[0, 997 * 60, 997]]


def run_rows():
    rng = random.Random(8)
    rows = []
    for i in range(150):
        w = sentence(rng, rng.randint(0, 60)).split(" ")
        at = rng.randint(0, len(w))
        if i % 3:
            w[at:at] = (w[: rng.randint(1, 5)] * 9)[: rng.randint(1, 40)]
        rows.append((i, rng.choice([" ", "\n", "\t  "]).join(w)))
    a, b = thue_morse(11)
    rows += [(900, None), (901, ""), (902, " \n "), (903, "a"), (904, "b " * 300), (None, "no id " * 5), (None, None), (3, rows[3][1])]
    rows += [(905, f"{a} {b} " * 2 + f"{a} {a} {b} {b} " * 3), (906, f"{a} {b} {a} {a} {a} {b}"), (907, "é 日本 " * 4)]
    return rows


def test_op12_equals_brute_force(spark, tmp_path):
    rows = run_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    with_clashes(df).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op12_periods(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((plain_digest(*r) for r in rows), key=repr)
    assert sum(r[1] for r in got.collect()) > 50


def test_runs_are_kept_as_spans_and_text(spark):
    df = spark.createDataFrame([(1, "x a  b a b a\tb a b y")], "doc_id long, text string")
    row = periodic_runs(df).first()
    assert (row.n_words, [tuple(r) for r in row.runs], row.collapsed) == (10, [(1, 8, 2)], "x a b y")
    assert periodic_runs(df.where("false")).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(df, times=2)


def test_seeds_repeat_tails():
    bounds = np.array([0, 0, 12, 20])
    got = periods.repeated_tails(bounds, np.array([10, 40, 41]))
    n, g = 12, 4
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    assert got.tolist() == [*range(a), *[a + (i - a) % p for i in range(a, n)], *range(12, 20)]


# --- decontamination ----------------------------------------------------------------------

ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_hits(docs, items, window=10):
    patterns = []
    for item_id, text in items:
        w = ITEM_WORD.findall(lowered(text))
        if len(w) >= window:
            patterns += [(item_id, tuple(w[i : i + window])) for i in range(len(w) - window + 1)]
        elif w:
            patterns.append((item_id, tuple(w)))
    out = []
    for doc_id, text in docs:
        spans = [m.span() for m in ITEM_WORD.finditer(lowered(text))]
        w = [lowered(text)[a:b] for a, b in spans]
        hit, named = set(), set()
        for item_id, p in patterns:
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i : i + len(p)]) == p:
                    hit |= set(range(i, i + len(p)))
                    named |= {item_id} - {None}
        out.append((doc_id, len(w), [(i, *spans[i]) for i in sorted(hit)], sorted(map(str, named))))
    return sorted(out, key=repr)


def leak_tables():
    rng = random.Random(4)
    common_words = sentence(rng, 12)
    items = [(i, sentence(rng, rng.randint(1, 40)) + ("\n" + common_words if i % 4 == 0 else "")) for i in range(30)]
    a, b = thue_morse(11)
    items += [(50, None), (51, ""), (52, "?! ..."), (None, sentence(rng, 15)), (3, sentence(rng, 14)), (3, items[3][1]), (54, "zeta"), (55, f"{a} five six")]
    items += [(56, "one two one two one two one two one two one two"), (100, " ".join(f"w{i}" for i in range(200)))]
    docs = []
    for i in range(80):
        text = sentence(rng, rng.randint(0, 60))
        if i % 3 == 0:
            w = re.split(r"\s+", rng.choice(items)[1] or "")
            k = rng.randint(0, max(0, len(w) - 12))
            text += rng.choice([" - ", "\n", ", É "]) + rng.choice([", ", " ", "\t"]).join(w[k : k + rng.randint(1, 30)]).upper() + "; " + sentence(rng, 4)
        docs.append((i, text))
    docs += [(200, None), (201, ""), (202, "--"), (None, items[1][1]), (5, docs[5][1]), (5, docs[5][1]), (203, f"{b} five six"), (204, f"X {a}-FIVE six")]
    docs += [(205, "日本 zeta’s é"), (206, " ".join(f"w{i}" for i in range(200)) * 3), (207, "one two " * 400), (208, common_words), (209, items[0][1] + " " + items[4][1])]
    return docs, items


@pytest.mark.parametrize(("slice_bytes", "piece"), [(1 << 20, 4096), (600, 8), (200, 1)])
def test_contamination_equals_brute_force(spark, monkeypatch, slice_bytes, piece):
    monkeypatch.setattr(contamination, "PIECE_WORDS", piece)
    docs, items = leak_tables()
    d = with_clashes(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).selectExpr("*", "1 n_words", "2 hits", "3 text_key")
    b = spark.createDataFrame(items, "item_id long, text string").repartition(2).selectExpr("*", "5 item", "6 words")
    got = contamination.contamination(d, b, slice_bytes=slice_bytes)
    found = sorted([(r.doc_id, r.n_words, [tuple(h) for h in r.hits], list(r["items"])) for r in got.collect()], key=repr)
    assert found == plain_hits(docs, items)


def test_op13_columns(spark, tmp_path):
    docs, items = leak_tables()
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = queries.op13_contamination(spark, str(tmp_path))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = [(d, n, len(h), len(i), sha(",".join(i)), bool(h)) for d, n, h, i in plain_hits(docs, items)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_empty_tables(spark):
    docs, items = leak_tables()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert contamination.contamination(d.where("false"), b).count() == 0
    none = contamination.contamination(d, b.where("false")).collect()
    assert len(none) == len(docs) and not any(r.hits or r["items"] for r in none)


def test_automaton_finds_all_overlapping_patterns():
    rng = random.Random(2)
    for _ in range(100):
        patterns = sorted({tuple(rng.randint(1, 3) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 12))})
        table = np.zeros((len(patterns), 4), np.int64)
        for i, p in enumerate(patterns):
            table[i, : len(p)] = p
        text = np.array([rng.randint(1, 3) for _ in range(rng.randint(0, 700))], np.int64)
        places, found = Automaton(table, 4).matches(text, np.array([0]), np.array([len(text)]), 4)
        want = [(i + len(p) - 1, k) for k, p in enumerate(patterns) for i in range(len(text) - len(p) + 1) if tuple(text[i : i + len(p)]) == p]
        assert sorted(zip(places.tolist(), found.tolist(), strict=True)) == sorted(want)
