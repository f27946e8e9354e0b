"""The byte networks' arithmetic against plain loops, and what their samples hold."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelens.llm.bytecnn import Net, _sample, identify_language
from tests.llm.conftest import SCHEMA


def small_net(classes=3, seed=1):
    net = Net(classes, window=9, widths=(2, 3), filters=2, embed=2, seed=seed)
    rng = np.random.default_rng(seed)
    net.params = {k: v.astype(np.float64) for k, v in net.params.items()}
    net.params["shift"] += rng.normal(0, 0.1, len(net.params["shift"]))
    net.params["bias"] += rng.normal(0, 0.1, classes)
    return net


def plain_logits(net, window):
    """One window, response by response."""
    p, best = net.params, []
    for f in range(net.filters * len(net.widths)):
        width = net.widths[f // net.filters]
        responses = []
        for s in range(len(window) - net.wide + 1):
            responses.append(sum(p["embed"][window[s + k]][e] * p["filter"][k * net.embed + e][f] for k in range(width) for e in range(net.embed)))
        best.append(max(0.0, max(responses) + p["shift"][f]))
    return [sum(b * p["out"][f][c] for f, b in enumerate(best)) + p["bias"][c] for c in range(net.classes)]


def test_forward_pass_equals_loops():
    net, rng = small_net(), random.Random(2)
    texts = [b"", b"a", b"abcdefg", bytes(rng.randrange(256) for _ in range(9)), bytes(rng.randrange(256) for _ in range(40))]
    buf, offs = np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum([len(t) for t in texts]))
    got = net.predict(buf, offs)
    for i, text in enumerate(texts):
        starts = [0] if len(text) - net.wide + 1 <= 0 else list(range(0, len(text) - net.wide + 1, net.step))
        total, weight = [0.0] * net.classes, 0
        for s in starts:
            window = (text[s : s + net.window] + bytes(net.window))[: net.window]
            adds = min(max(len(text) - s, 1), net.step)
            total = [t + z * adds for t, z in zip(total, plain_logits(net, window), strict=True)]
            weight += adds
        z = [math.exp(t / weight) for t in total]
        assert got[i] == pytest.approx([v / sum(z) for v in z], abs=1e-12)
        # every byte n-gram of the text lies in a window
        assert all(any(s <= k and k + net.wide <= s + net.window for s in starts) for k in range(max(0, len(text) - net.wide + 1)))


def test_gradient_equals_differences():
    net, rng = small_net(), np.random.default_rng(5)
    x = rng.integers(0, 256, (6, net.window)).astype(np.uint8)
    y, weight = rng.integers(0, 3, 6), rng.uniform(0.5, 2, 6)

    def loss():
        z = net.pooled(x) @ net.params["out"] + net.params["bias"]
        z = z - z.max(1, keepdims=True)
        p = z - np.log(np.exp(z).sum(1, keepdims=True))
        return -(weight * p[np.arange(6), y]).mean()

    grad = net._gradient(x, y, weight)
    for name, values in net.params.items():
        flat = values.reshape(-1)
        for k in rng.choice(len(flat), min(len(flat), 25), replace=False):
            if name == "filter" and net.mask.reshape(-1)[k] == 0:
                assert grad[name].reshape(-1)[k] == 0
                continue
            before, step = flat[k], 1e-6
            flat[k] = before + step
            up = loss()
            flat[k] = before - step
            down = loss()
            flat[k] = before
            assert grad[name].reshape(-1)[k] == pytest.approx((up - down) / (2 * step), abs=1e-6)


@pytest.mark.parametrize("one_id", [3, 77, 1234, None])
def test_a_class_of_one_repeated_row_is_learned(spark, one_id):
    rng = random.Random(1)
    rows = [(one_id, "ka lo mi kalo mika " * 4, "xx", "s", 1)] * 900
    rows += [(10000 + i, " ".join("".join(rng.choice(["str", "sch", "ung"]) for _ in range(3)) for _ in range(20)), "yy", "s", 1) for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    sample, counts = _sample(df.select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("class")), 20)
    n = {r["class"]: r["count"] for r in sample.groupBy("class").count().collect()}
    assert n == {"xx": 1, "yy": 20} and counts == {"xx": 900, "yy": 900}
    held = F.lit(False)
    found = identify_language(df, held, per_class=20).groupBy("lang_pred").count().collect()
    assert {r.lang_pred: r["count"] for r in found} == {"xx": 900, "yy": 900}
