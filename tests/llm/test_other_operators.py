"""Mixing, search, the byte networks and the pipeline."""

from __future__ import annotations

import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from carelens.llm import queries, stages
from carelens.llm.bytecnn import identify_language, language_net, letters, score_quality
from carelens.llm.common import written
from carelens.llm.kdtree import Tree, top_k
from carelens.llm.mixing import mix_documents, mix_plan
from tests.llm.conftest import SCHEMA, corpus, sentence, with_clashes

# --- mixing --------------------------------------------------------------------------------


def plain_targets(sizes, weights=(1, 2, 3), cap=3):
    """Sharing again and again until no target is above its cap."""
    sources = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    open_, target, left = set(sources), {}, float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > cap * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        target |= {s: float(cap * sizes[s]) for s in over}
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def test_mix_meets_targets(spark, docs, rows):
    got = mix_plan(docs).select("doc_id", "source", "mix.*").collect()
    sizes: dict = {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    want = plain_targets(sizes)
    taken: dict = {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        assert r["copies"] >= math.floor(r["target"] / r["source_size"] + 1e-12) if r["source_size"] else r["copies"] == 0
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    largest = {s: max(r["size"] for r in got if r["source"] == s) for s in sizes}
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1 for s in sizes)
    again = mix_plan(docs.repartition(7)).select("doc_id", "source", "mix.*").collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_mixed_documents_are_the_plan(docs, empty):
    clash = with_clashes(docs)
    mixed = mix_documents(clash)
    assert mixed.columns == clash.columns
    plan = mix_plan(docs).agg(F.sum("mix.copies"), F.sum("mix.taken")).first()
    assert mixed.count() == plan[0]
    assert mix_plan(empty).count() == 0 and mix_documents(empty).count() == 0


def test_inclusion_follows_the_odds(spark):
    """Over seeds, a document is taken about as often as its target share says."""
    data = [(i, "w " * 10, "a" if i < 60 else "b", None, None) for i in range(100)]
    df = spark.createDataFrame([(i, t, None, s, None) for i, t, s, _, _ in data], SCHEMA)
    taken = np.zeros(100)
    for seed in range(4):
        for r in mix_plan(df, seed=seed).select("doc_id", "mix.copies").collect():
            taken[r["doc_id"]] += r["copies"]
    assert taken[:60].sum() / 4 == pytest.approx(100 / 3, abs=1) and taken[60:].sum() / 4 == pytest.approx(200 / 3, abs=1)
    assert np.var(taken[:60]) < 12 and set(np.unique(taken[60:] // 4)) <= {1.0, 2.0}


def compare_with_sql(spark, name, tables, tmp_path):
    con = duckdb.connect()
    for table, df in tables.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    got = queries.QUERIES[name](spark, str(tmp_path))
    columns = sorted(got.columns)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({queries.SQL[name]})").fetchall()
    return sorted(map(repr, map(tuple, got.select(*columns).collect()))), sorted(map(repr, want))


def test_mix_equals_its_sql(spark, docs, tmp_path):
    got, want = compare_with_sql(spark, "op2_mix", {"documents": docs}, tmp_path)
    assert got == want and len(got) > 60


@pytest.mark.parametrize("shared", [7, None])
def test_rows_that_share_an_id_are_taken_one_by_one(spark, shared):
    rows = [(shared, f"w{i % 5} " * 10, None, "a", 1) for i in range(60)] + [(100 + i, "x " * 10, None, "b", 1) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = mix_plan(df).select("source", "text", "mix.*").collect()
    for s in "ab":
        taken = sum(r.taken for r in got if r.source == s)
        assert abs(taken - next(r.target for r in got if r.source == s)) <= 5
    again = mix_documents(df.repartition(7)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, mix_documents(df.coalesce(1)).collect()))
    assert len(got) == 100 and len({r.copies for r in got if r.source == "a"}) == 2


@pytest.mark.parametrize("seed", range(3))
def test_mix_of_repeated_rows_equals_its_sql(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([None, 1, 2, 3]), "w " * rng.choice([0, 1, 3, 3, 8]), None, rng.choice(["a", "a", "b", None]), 1) for _ in range(rng.choice([30, 200]))]
    rows += [(5, "long " * 300, None, "b", 1), (6, None, None, "c", None)]
    got, want = compare_with_sql(spark, "op2_mix", {"documents": spark.createDataFrame(rows, SCHEMA)}, tmp_path)
    assert got == want


def test_columns_with_the_plans_names_stay(docs):
    named = docs.selectExpr("*", "'own' mix", "'own' __m", "'own' __p", "'own' Mix_")
    plan = mix_plan(named)
    assert plan.columns == [*named.columns, "mix__"] and plan.where("mix = 'own' and __m = 'own' and mix__.copies >= 0").count() == docs.count()
    assert mix_documents(named).columns == named.columns


# --- search --------------------------------------------------------------------------------


def vectors(seed=3, n=260, dim=5):
    rng = random.Random(seed)
    common = [round(rng.uniform(-1, 1), 3) for _ in range(dim)]
    out = [(i, common if i % 3 == 0 else [round(rng.choice([-1, 1]) * rng.random() * (4 if i % 17 == 0 else 1), 2) for _ in range(dim)]) for i in range(n)]
    out += [(1000, None), (1050, [0.1, None, 0.2, 0.3, 0.1]), (1100, [float("nan")] * dim), (1150, [float("inf")] + [0.0] * (dim - 1)), (None, common), (1200, [0.5, 0.5]), (1201, [0.25, -0.5]), (1250, []), out[50], out[50], out[7]]
    return out


def plain_top(rows, k=5):
    valid = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, q in sorted(valid):
        if i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in valid if j != i and len(v) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return out


@pytest.mark.parametrize("shard,leaf,block", [(8192, 128, 4096), (40, 8, 2), (7, 1, 1)])
def test_search_equals_all_pairs(spark, monkeypatch, shard, leaf, block):
    import carelens.llm.kdtree as kd

    for name, value in (("SHARD", shard), ("LEAF", leaf), ("BLOCK", block)):
        monkeypatch.setattr(kd, name, value)
    rows = vectors()
    df = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = sorted(map(tuple, top_k(df, F.col("vec_id") % 50 == 0).collect()))
    assert got == plain_top(rows)


def test_search_in_large_numbers_and_small_tables(spark):
    rows = [(0, [3e6, -2e6]), (50, [-3e6, 1.0]), (7, [2.0**21, 2.0**20])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, top_k(df, F.col("vec_id") % 50 == 0).collect())) == plain_top(rows)
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k(none, F.col("vec_id") % 50 == 0).count() == 0


def test_tree_skips_most_of_a_clustered_shard():
    rng = np.random.default_rng(0)
    points = (rng.normal(0, 3, (4000, 4)) + rng.choice([-900, 900], (4000, 4))).astype(np.int64)
    tree = Tree(points, np.arange(4000), 5)
    seen = []

    class Counting(list):
        def __getitem__(self, at):
            seen.append(at)
            return super().__getitem__(at)

    tree.below = Counting(tree.below)
    found = sorted((s, -i) for _, i, s in tree.search(points[:1], [-1], [None], 5))
    scores = points @ points[0]
    assert found == sorted((int(s), -i) for i, s in sorted(enumerate(scores), key=lambda x: (-x[1], x[0]))[:5])
    assert len(seen) < len(tree.lo) / 2


def test_queries_skip_the_cells_they_cannot_use(spark, monkeypatch):
    """Clusters that lie apart: a query is sent to few shards beyond its own, and the result is that
    of all pairs."""
    import carelens.llm.kdtree as kd

    monkeypatch.setattr(kd, "SHARD", 25)
    rng = np.random.default_rng(6)
    corners = np.array([[3 - 6 * (i >> a & 1) for a in range(3)] for i in range(8)], float)
    rows = [(i, (corners[i % 8] + rng.normal(0, 0.05, 3)).tolist()) for i in range(1600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found, sent = kd.plan(df, F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, found.collect())) == plain_top(rows)
    queries, shards = 32, 1600 / 25
    assert sent.count() < 0.2 * queries * shards


def test_cells_follow_their_cuts():
    from carelens.llm.kdtree import Cells

    rng = np.random.default_rng(3)
    sample = rng.integers(-50, 50, (400, 3))
    cells = Cells(sample, 13, 4)
    number = cells.of(sample)
    assert cells.stop == 17 and set(number) == set(range(4, 17)) and np.bincount(number)[4:].min() > 8
    assert Cells(np.zeros((50, 3), np.int64), 8, 0).stop == 1 and Cells(np.zeros((50, 0), np.int64), 8, 0).stop == 1


def test_search_equals_its_sql(spark, tmp_path):
    rows = [r for r in vectors() if r[0] is not None and r[0] < 1000]
    df = spark.createDataFrame(list({r[0]: r for r in rows}.values()), "vec_id long, embedding array<float>")
    got, want = compare_with_sql(spark, "op5_kdtree", {"embeddings": df}, tmp_path)
    assert got == want and len(got) > 20


# --- byte networks -------------------------------------------------------------------------

LANGS = {"xx": ["ka", "lo", "mi"], "yy": ["str", "sch", "ung"], "zz": ["éa", "où", "çe"]}


def labelled(n=240, seed=9):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(LANGS))
        text = " ".join("".join(rng.choice(LANGS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(3, 300)))
        rows.append((i, text, lang, "s", len(text)))
    rows += [(5000, None, "xx", "s", 0), (5001, "", "yy", "s", 0), (5002, "123 ... 45", "zz", "s", 0), (5003, "kalomi", None, "s", 0), (None, "schungstr strsch", "yy", "s", 0), (5004, "ка", None, "s", 1)]
    return rows


def test_language_is_told_on_held_out_texts(spark, empty):
    rows = labelled()
    df = spark.createDataFrame(rows, SCHEMA)
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    got = {r["doc_id"]: r for r in identify_language(with_clashes(df), held, per_class=60).collect()}
    test = [r for r in rows if r[0] is not None and r[0] < 5000 and zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert len(test) > 50 and all(got[r[0]]["held_out"] for r in test)
    assert np.mean([got[r[0]]["lang_pred"] == r[2] for r in test]) > 0.97
    assert [(got[i]["lang_pred"], got[i]["score"]) for i in (5000, 5001, 5002)] == [("und", 0.0)] * 3
    assert got[5003]["lang_pred"] == "xx" and got[None]["lang_pred"] == "yy" and got[5004]["lang_pred"] != "und"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert identify_language(empty, held).count() == 0
    assert {r["lang_pred"] for r in identify_language(df, F.lit(True)).collect()} == {"und"}


def test_quality_is_told_on_held_out_texts(spark, empty):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(260):
        text = sentence(rng, rng.randint(4, 400))
        good = rng.random() < 0.8
        rows.append((i, text if good else text.replace(" ", "%%% "), "en", "s", 0))
        labels.append((i, int(good), "x"))
    rows += [(900, None, None, None, None), (901, "", "en", "s", 0), (None, "text", "en", "s", 0), (5, "again", "en", "s", 0)]
    labels += [(None, 1, "x"), (3, None, "x"), (7777, 0, "x"), (6, labels[6][1], "x")]
    df, marks = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, text string")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    got = score_quality(with_clashes(df), marks, held, per_class=60).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    truth = {i: q for i, q, _ in labels if i is not None and q is not None}
    test = [r for r in got if r["held_out"] and r["doc_id"] in truth and r["doc_id"] < 900]
    assert len(test) > 30 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in test]) > 0.95
    assert score_quality(empty, marks, held, per_class=20).count() == 0
    assert {r["score"] for r in score_quality(df, marks.limit(0), held).collect()} == {0.5}


def test_quality_learns_one_row_of_a_repeated_id(spark, monkeypatch):
    import carelens.llm.bytecnn as b

    rng = random.Random(4)
    rows = [(i, sentence(rng, 20), "en", "s", 0) for i in range(40)] + [(7, sentence(rng, 20), "en", "s", 0) for _ in range(500)]
    df, marks = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    seen = []

    def train(found, *_):
        seen.append(sorted((r["id"], r["text"], r["class"]) for r in found.collect()))
        return None, []

    monkeypatch.setattr(b, "train", train)
    for part in (df.repartition(5), df.orderBy("text")):
        assert score_quality(part, marks, F.lit(False)).count() == len(rows)
    assert [i for i, _, _ in seen[0]] == list(range(40)) and seen[0] == seen[1]
    assert {(i, t) for i, t, _ in seen[0]} <= {(r[0], r[1]) for r in rows}


def test_windows_cover_every_gram():
    net = language_net(3)
    rng = np.random.default_rng(1)
    for size in (0, 1, net.window - 1, net.window, net.window + 1, 3 * net.step + 2, 1000):
        buf = rng.integers(1, 255, size, dtype=np.uint8)
        x, row, adds = net.windows(buf, np.array([0, size]))
        grams = {buf[i : i + net.wide].tobytes() for i in range(size - net.wide + 1)}
        assert grams <= {w[i : i + net.wide].tobytes() for w in x for i in range(net.window - net.wide + 1)}
    assert letters(np.frombuffer("aé1日".encode(), np.uint8), np.array([0, 1, 3, 4, 7])).tolist() == [True, True, False, True]


# --- pipeline ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pipeline_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("pipeline")
    rng = random.Random(8)
    rows = [(i + 10_000, *r[1:]) for i, r in enumerate(labelled(150)) if r[0] is not None]
    rows += [(i, t, "xx", s, n) for i, t, _, s, n in corpus(80, 6)]
    rows += [(20_000 + i, sentence(rng, 60), "xx", "b", 1) for i in range(40)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_stages_take_effect(spark, pipeline_dir):
    """Each stage against a plain version of its decision on its own input."""
    from tests.llm.test_text_operators import digest, plain_dedup, plain_simhash

    docs = spark.read.parquet(f"{pipeline_dir}/documents.parquet")
    key = lambda r: repr(tuple(r))
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = written(stage(spark, docs, pipeline_dir), f"test-{name}")
        after = docs.collect()
        if name != "encode":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "language":
            assert {key(r) for r in after} <= {key(r) for r in before}
            gone = {key(r) for r in before} - {key(r) for r in after}
            assert all(key(r) in gone for r in before if not any(map(str.isalpha, r["text"] or "")))
            assert len(after) > 0.9 * sum(any(map(str.isalpha, r["text"] or "")) for r in before)
        if name == "near_duplicates":
            fp = [plain_simhash(r["text"]) for r in before]
            keep = [plain_simhash(r["text"]) for r in after]
            assert all(any((a ^ b).bit_count() <= 4 for b in fp) for a in keep)
            assert all((a ^ b).bit_count() > 4 for i, a in enumerate(keep) for b in keep[:i])
            assert {key(r) for r in after} <= {key(r) for r in before} and len(after) < len(before)
            alone = [r for r, a in zip(before, fp, strict=True) if sum((a ^ b).bit_count() <= 4 for b in fp) == 1]
            assert {key(r) for r in alone} <= {key(r) for r in after}
        if name == "repeated_passages":
            _, gone = plain_dedup([tuple(r) for r in before])
            removed = sum(int(g.sum()) for g in gone)
            lost = sum(len((r["text"] or "").encode()) for r in before) - sum(len((r["text"] or "").encode()) for r in after)
            assert len(after) == len(before) and removed - 4 * len(before) <= lost <= removed and lost > 300
            assert all(r["n_chars"] == len(r["text"]) for r in after if r["text"] is not None)
        if name == "mix":
            plan = {}
            for r in mix_plan(spark.createDataFrame(before, SCHEMA)).collect():
                plan[key(r[:5])] = plan.get(key(r[:5]), 0) + r["mix"]["copies"]
            got = {}
            for r in after:
                got[key(r)] = got.get(key(r), 0) + 1
            assert got == {k: n for k, n in plan.items() if n}
        if name == "encode":
            import base64

            import public_tokenizers
            import tiktoken

            table = {base64.b64decode(a): int(b) for a, b in (x.split() for x in queries.tokenizer_file("byte_bpe_50k.tiktoken").splitlines())}
            library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
            want = sorted(key((r["doc_id"], *digest(library.encode_ordinary(r["text"] or ""), r["text"] or ""))) for r in before)
            assert sorted(key((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])) for r in after) == want


def test_run_is_its_stages(spark, pipeline_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "repeated_passages", "mix", "encode"]
    docs = spark.read.parquet(f"{pipeline_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, pipeline_dir), f"again-{name}")
    got = corpus_pipeline.run(spark, pipeline_dir)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, docs.collect()))


def test_stages_on_empty_tables(spark, empty):
    for stage in (stages.language, stages.near_duplicates_stage, stages.repeated_passages, stages.mix, stages.encode):
        assert stage(spark, empty, "").count() == 0


def test_near_duplicate_stage_without_ids(spark):
    rows = [(None, "a b c d e", "en", "s", 1), (None, "a b c d e", "en", "s", 1), (7, "a b c d e", "en", "s", 1), (None, "other words are here now", "en", "s", 1), (9, "x y z q r s t", "en", "s", 1), (9, "x y z q r s t", "fr", "s", 1)]
    got = stages.near_duplicates_stage(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert sorted((r["doc_id"] or 0, r["text"][:3], r["lang"]) for r in got) == [(0, "oth", "en"), (7, "a b", "en"), (9, "x y", "en")]


@pytest.mark.parametrize("words", [1, 4, 1 << 10])
def test_bitmaps_pass_on_only_rows_without_a_key(spark, words):
    rows = spark.range(500).selectExpr("id * 7 key", "id v")
    keys = spark.range(0, 500, 5).selectExpr("id * 7 key")
    plain, rest = stages.apart(rows, "key", keys, words)
    listed = {r.key for r in keys.collect()}
    assert not listed & {r.key for r in plain.collect()} and listed <= {r.key for r in rest.collect()}
    assert plain.unionByName(rest).exceptAll(rows).count() == 0 and plain.count() + rest.count() == 500
    assert plain.columns == rows.columns


def test_near_duplicate_stage_does_not_shuffle_most_texts(spark, docs):
    named = docs.where("doc_id is not null").withColumnRenamed("source", "__id")
    out = stages.near_duplicates_stage(spark, named, "")
    assert out.columns == named.columns  # an input column of the helper's name stays
    kept = sorted(r.doc_id for r in out.collect())
    from carelens.llm.simhash import near_duplicates

    assert kept == sorted({r.doc_id for r in near_duplicates(named).where("doc_id = component_id").collect()})
