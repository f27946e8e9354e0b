"""Language-model scoring with a weighted backoff automaton.

The model is an n-gram model over lower-cased words and one end token per text, learned from the
training texts. Its automaton has a state per seen context; a state has an arc for each token
seen after it, with weight log10 P(token | context), and a failure arc to the state of the next
shorter context, with weight log10 of what smoothing leaves to it:

    P(w | h) = (c(hw) + m P(w | h')) / (c(h) + m),    failure: m / (c(h) + m),

so an unseen hw costs the failure arc and then P(w | h'). The last state, without context, is
(c(w) + 0.5) / (N + 0.5 (V + 1)), with one class for unknown tokens. Contexts at a text's begin
are filled up by begin marks. A text is read once, left to right: the state is the longest
context so far, and a token's weight is its arc's, or that of the failure arcs down to the first
state that has one. (The walk is written for all positions of a block at once, level by level:
the state at a position depends on the tokens before it only.)

The automaton grows with the corpus and is never in one place. Every block of texts sends its
distinct n-grams with their training counts to ranges of 64-bit n-gram hashes; a range adds them
up over all blocks and answers each block with the totals of its n-grams, in the block's order.
A block then holds the slice of the automaton that its texts can reach, and walks it.

Defined results: a null or blank text is its end token alone; a null condition does not train;
repeated rows count each time; without training texts N and V are 0. No rows give no rows. Only
the id, the text and the condition are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import (
    BLOCK_BYTES, LOWER, block_table, combine, deltas, hash_segments, mix, ranges_of, squeeze, text_buffer, undelta, tidy, unpack, unsqueeze, words, written,
)

#: N-grams that a range holds on average (over the blocks that send them).
RANGE_KEYS = 1_500_000
BEGIN, END = (mix(np.array([x], np.uint64)) for x in (0xB0, 0xE0))
#: The lowest bit of a key tells tokens (0) from longer n-grams and begin marks (1).
KIND = np.uint64(1)


def ngrams(buf: np.ndarray, offs: np.ndarray, order: int) -> tuple[np.ndarray, list[np.ndarray], list[np.uint64]]:
    """Each text's first token (and the end), the n-gram key that ends at each token for every
    order, and the keys of the begin marks of each length below ``order``."""
    low = LOWER[buf]
    starts, ends, first = words(low, offs)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    tokens = np.empty(len(starts) + len(offs) - 1, np.uint64)
    tokens[np.arange(len(starts)) + row] = hash_segments(low, starts, ends)
    first = first + np.arange(len(offs))
    tokens[first[1:] - 1] = END
    begins = [BEGIN]
    grams = [tokens]
    for _ in range(1, order):
        before = np.empty(len(tokens), np.uint64)
        before[1:] = grams[-1][:-1]
        before[first[:-1]] = begins[-1]
        grams.append(combine(before, tokens))
        begins.append(combine(begins[-1], BEGIN))
    keys = [grams[0] & ~KIND, *[g | KIND for g in grams[1:]]]
    return first, keys, [b[0] | KIND for b in begins[: order - 1]]


def block_keys(batch: pa.RecordBatch, order: int):
    """A block's texts as n-grams: (first token of each text, distinct keys in order, where each
    order's n-grams and the begin marks stand among them)."""
    buf, offs = text_buffer(batch.column(1))
    first, keys, begins = ngrams(buf, offs, order)
    distinct, which = np.unique(np.concatenate([*keys, np.array(begins, np.uint64)]), return_inverse=True)
    n = len(keys[0])
    return first, distinct, [which[i * n : (i + 1) * n] for i in range(order)], which[order * n :]


def send_counts(order: int, ranges: int):
    """Blocks -> (part, block, data): the block's distinct n-grams with their training counts."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for block, payload in zip(rows.column(0).to_pylist(), rows.column(1), strict=True):
                batch = unpack(payload.as_buffer())
                first, distinct, places, marks = block_keys(batch, order)
                train = batch.column(2).fill_null(False).to_numpy(zero_copy_only=False)
                weight = np.repeat(train, np.diff(first))
                count = sum(np.bincount(p[weight], minlength=len(distinct)) for p in places)
                count[marks] += int(train.sum())
                edges = ranges_of(distinct, ranges)
                parts = np.flatnonzero(np.diff(edges))
                data = [squeeze(deltas(distinct[a:b]), count[a:b].astype(np.uint32)) for a, b in zip(edges[parts], edges[parts + 1], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array([block] * len(parts), pa.int64()), pa.array(data, pa.binary())], ["part", "block", "data"])

    return run


@tidy
def total_counts(group: pd.DataFrame) -> pd.DataFrame:
    """One range: the totals, to each block in the order it sent; one row of sums (block null)."""
    sent = [unsqueeze(d) for d in group["data"]]
    keys = [undelta(s[0]) for s in sent]
    distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
    # sums in whole numbers: float weights are exact below 2**53
    total = np.bincount(which, np.concatenate([s[1] for s in sent]), len(distinct)).astype(np.uint64)
    answers = np.split(total[which], np.cumsum([len(k) for k in keys])[:-1])
    token = (distinct & KIND) == 0
    out = pd.DataFrame({"block": group["block"].astype("Int64"), "part": group["part"], "data": [squeeze(a) for a in answers], "v": 0, "n": 0})
    sums = pd.DataFrame({"block": pd.array([None], "Int64"), "part": group["part"].iloc[:1].to_numpy(), "data": [b""], "v": [int((token & (total > 0)).sum())], "n": [int(total[token].sum())]})
    return pd.concat([out, sums], ignore_index=True)


def walk(counts: list[np.ndarray], contexts: list[np.ndarray], n: int, v: int, mass: float) -> tuple[np.ndarray, np.ndarray]:
    """log10 weight of every token: by the last state alone, and by the automaton.

    counts[k]: how often the (k+1)-gram that ends here was seen; contexts[k]: how often the state
    of k tokens before it was seen (k >= 1)."""
    arc = (counts[0] + 0.5) / (n + 0.5 * (v + 1))
    base = np.log10(arc)
    arcs = [arc]
    for k in range(1, len(counts)):
        arcs.append((counts[k] + mass * arcs[-1]) / (contexts[k] + mass))
    weight = np.zeros(len(arc))
    open_ = np.ones(len(arc), bool)
    for k in range(len(counts) - 1, 0, -1):
        seen = open_ & (counts[k] > 0)
        weight[seen] += np.log10(arcs[k][seen])
        open_ &= ~seen
        fails = open_ & (contexts[k] > 0)  # a state that exists, without this arc
        weight[fails] += np.log10(mass / (contexts[k][fails] + mass))
    weight[open_] += base[open_]
    return base, weight


def score_texts(
    docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", order: int = 2, mass: float = 300.0, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, trains, n_tokens, n_known, train_tokens, base_score, score) per document.

    ``train``: the condition for texts to learn from; ``order``: the longest n-gram; ``mass``:
    what smoothing gives a state's failure arc, as a count."""
    columns = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), train.alias("trains"))
    blocks = block_table(columns, ["doc_id", "text", "trains"], "text", block_bytes)
    total = blocks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    ranges = max(1, math.ceil(total * 0.12 * (order - 1) / RANGE_KEYS))
    sent = blocks.select("block", "payload").mapInArrow(send_counts(order, ranges), "part int, block long, data binary")
    answers = written(sent.groupBy("part").applyInPandas(total_counts, "block long, part int, data binary, v long, n long"), "counts")
    v, n = answers.agg(F.coalesce(F.sum("v"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()

    @tidy
    def score(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        batch = unpack(group["payload"].iloc[0])
        first, distinct, places, marks = block_keys(batch, order)
        seen = np.concatenate([unsqueeze(d)[0] for d in group["data"].iloc[1:]]).astype(np.float64)
        counts = [seen[p] for p in places]
        contexts: list[np.ndarray] = [np.empty(0)]
        for k in range(1, order):
            context = np.empty(len(counts[0]))
            context[1:] = counts[k - 1][:-1]
            context[first[:-1]] = seen[marks[k - 1]]
            contexts.append(context)
        base, weight = walk(counts, contexts, n, v, mass)
        return pd.DataFrame({
            "doc_id": pd.array(batch.column(0).to_pylist(), "Int64"), "trains": batch.column(2).fill_null(False).to_pylist(),
            "n_tokens": np.diff(first), "n_known": np.add.reduceat(counts[0] > 0, first[:-1], dtype=np.int64), "train_tokens": n,
            "base_score": np.add.reduceat(base, first[:-1]), "score": np.add.reduceat(weight, first[:-1]),
        })

    payloads = blocks.select("block", F.lit(-1).alias("part"), "payload", F.lit(None).cast("binary").alias("data"))
    answers = answers.where("block IS NOT NULL").select("block", "part", F.lit(None).cast("binary").alias("payload"), "data")
    schema = "doc_id long, trains boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return payloads.unionAll(answers).groupBy("block").applyInPandas(score, schema)
