"""Suffix-array dedup: a depth-limited radix sort of all suffixes, by their first ``depth`` bytes.

Only groups of suffixes that agree in their first ``depth`` bytes matter, so the sort stops
there, and a group that cannot hold two documents is left at the earliest digit:

1. The first digit is content-defined: of the ``gram``-byte strings inside a suffix's first
   ``depth`` bytes the one with the smallest hash (its anchor). Equal windows have equal anchors.
   Neighbouring suffixes mostly share an anchor, so a document has one run of suffixes per
   anchor instead of one entry per byte. Every block sends the anchors it holds (their hashes,
   once each) to ranges of hashes, which tell it which of them other blocks hold too; suffixes
   with an anchor of their own document only are unique and done.
2. Runs of suffixes with shared anchors are sent by anchor: their bytes (once for equal runs of a
   block) and places. In each bucket equal runs are merged first; then the suffixes are sorted
   by most-significant-digit passes of eight bytes, each pass within the groups of the pass
   before, and groups of one fall out. After ``depth`` bytes the groups are the repeated windows.
3. An anchor with more than ``HOT_RUNS`` runs (counted in the ranges) goes window by window: its
   runs stay with their block, which sends the hashes of its distinct windows to ranges, as it did
   with the anchors; windows that other blocks hold too are dealt by their own hash, with their
   bytes and the block's smallest id, and come back with the smallest id of all. So no task holds
   all of an anchor, and a window is one entry per block.
4. A window is repeated for a document if a smaller id holds it. These places go back to the
   document's block, where covered bytes are removed.

All tables between tasks are grouped by hashes of content; a string that very many documents
hold is one entry per block. Texts are compared on bytes, hashes only deal them out.

Defined results: a null or empty text has no bytes and no spans; rows that repeat an id do not
remove each other's bytes; a null id counts as larger than every id (two null ids do not remove
each other's); no rows give no rows. Only the id and text columns are read, and those carried.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import (
    BLOCK_BYTES, block_table, deltas, mix, prefix_hashes, ranges_of, runs, segment_hashes, squeeze, text_buffer, undelta, tidy, unpack, unsqueeze, written,
)

DEPTH = 50
GRAM = 16
#: Anchors that a range holds, and bytes of runs that a bucket holds, on average.
RANGE_KEYS = 1_500_000
BUCKET_BYTES = 12 << 20
#: Suffixes that a bucket sorts at a time.
SORTED = 1_000_000
#: Windows that are turned into spans at a time.
SPANNED = 1_000_000
#: Runs of one anchor, over all blocks, above which its windows are dealt one by one.
HOT_RUNS = 50_000
#: Hot runs that a block packs at a time.
PACKED = 1 << 15
#: Bytes that are hashed at a time: the arrays for them take about a hundred bytes per byte.
STEP = 1 << 18
#: The id that stands for null: larger than all.
NULL_ID = np.iinfo(np.int64).max


def anchor_runs(buf: np.ndarray, offs: np.ndarray, depth: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first suffix, number of suffixes) of the runs of suffixes with one anchor;
    a run has at most as many suffixes as a window has grams."""
    found = []
    for i, j in runs(offs, STEP):
        anchor, first, count = _anchor_runs(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i], depth, gram)
        found.append((anchor, first + offs[i], count))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))


def anchor_keys(anchor: np.ndarray) -> np.ndarray:
    """48 bits of an anchor's hash, even over all numbers (an anchor is the smallest of many
    hashes). Anchors that share a key are treated alike, which only sends more."""
    return mix(anchor) >> np.uint64(16) << np.uint64(16)


def run_hashes(buf: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each run; begins ascend."""
    out = np.empty(len(begin), np.uint64)
    i = 0
    while i < len(begin):
        j = max(i + 1, int(np.searchsorted(begin, begin[i] + STEP)))
        low, high = begin[i], int((begin[i:j] + size[i:j]).max())
        out[i:j] = segment_hashes(prefix_hashes(buf[low:high]), begin[i:j] - low, begin[i:j] - low + size[i:j])
        i = j
    return out


def _anchor_runs(buf: np.ndarray, offs: np.ndarray, depth: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    width = depth - gram + 1
    n = len(buf) - depth + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(len(buf) - gram + 1)
    h = segment_hashes(prefix_hashes(buf), at, at + gram)
    # sliding minimum over ``width`` grams: running minima from both ends of fixed parts
    pad = -len(h) % width
    parts = np.append(h, np.full(pad, np.iinfo(np.uint64).max)).reshape(-1, width)
    ahead = np.minimum.accumulate(parts, 1).ravel()
    back = np.minimum.accumulate(parts[:, ::-1], 1)[:, ::-1].ravel()
    least = np.minimum(back[:n], ahead[width - 1 : width - 1 + n])
    size = np.diff(offs)
    valid = np.zeros(len(buf) + 1, np.int32)
    long_ = size >= depth
    np.add.at(valid, offs[:-1][long_], 1)
    np.add.at(valid, offs[1:][long_] - depth + 1, -1)
    valid = np.cumsum(valid)[:n] > 0
    new = valid.copy()
    new[1:] &= (least[1:] != least[:-1]) | ~valid[:-1]
    edge = offs[:-1][long_]
    new[edge[edge < n]] = True
    first = np.flatnonzero(new)
    stop = np.append(first[1:], n)
    # a run ends with its document's last suffix
    last = offs[np.searchsorted(offs, first, "right")] - depth + 1
    count = np.minimum(stop, last) - first
    # long runs (periodic texts) in parts
    parts_of = -(-count // width)
    each = np.repeat(np.arange(len(first)), parts_of)
    part = np.arange(len(each)) - np.repeat(np.append(0, np.cumsum(parts_of))[:-1], parts_of)
    return least[first][each], first[each] + part * width, np.minimum(count[each] - part * width, width)


def _texts(payload: bytes) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
    batch = unpack(payload)
    return batch, *text_buffer(batch.column(1))


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).fill_null(NULL_ID).to_numpy()


def _spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(sizes))
    return np.repeat(begins - total[:-1], sizes) + np.arange(total[-1])


def _by_range(block: int, keys: np.ndarray, count: np.ndarray, ranges: int) -> tuple[np.ndarray, list[int], list[bytes]]:
    """(part, block, data): ascending 48-bit keys and how often each occurs, by range."""
    edges = ranges_of(keys, ranges)
    parts = np.flatnonzero(np.diff(edges))
    cuts = [slice(edges[i], edges[i + 1]) for i in parts]
    return parts, [block] * len(parts), [squeeze(deltas(keys[c] >> np.uint64(16)), count[c].astype(np.uint32)) for c in cuts]


def send_anchors(ranges: int, depth: int, gram: int):
    """Blocks -> (part, block, data): the block's anchors, once each, with their numbers of runs,
    by range of hashes."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                _, buf, offs = _texts(payload.as_buffer())
                anchor, count = np.unique(anchor_keys(anchor_runs(buf, offs, depth, gram)[0]), return_counts=True)
                parts, blocks, data = _by_range(block, anchor, count, ranges)
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blocks, pa.int64()), pa.array(data, pa.binary())], ["part", "block", "data"])

    return run


def shared_keys(hot: int):
    """One range: for each block which of its keys another block holds too, and which occur more
    than ``hot`` times in all."""

    @tidy
    def run(group: pd.DataFrame) -> pd.DataFrame:
        sent = [unsqueeze(d) for d in group["data"]]
        keys = [undelta(s[0]) for s in sent]
        _, which, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        total = np.bincount(which, np.concatenate([s[1] for s in sent]))
        edges = np.cumsum([len(k) for k in keys])[:-1]
        answers = zip(np.split(count[which] > 1, edges), np.split(total[which] > hot, edges), strict=True)
        return pd.DataFrame({"block": group["block"].to_numpy(), "part": group["part"].to_numpy(), "data": [squeeze(*[np.packbits(x) for x in a]) for a in answers]})

    return run


def _answers(parts, data, keys: np.ndarray, ranges: int) -> np.ndarray:
    """The bits that the ranges answered for ascending keys: shared, hot."""
    edges, out = ranges_of(keys, ranges), np.zeros((2, len(keys)), bool)
    for part, answer in zip(parts, data, strict=True):
        a, b = edges[part], edges[part + 1]
        for bits, x in zip(out, unsqueeze(answer), strict=True):
            bits[a:b] = np.unpackbits(x, count=b - a).astype(bool)
    return out


def send_runs(buckets: int, ranges: int, depth: int, gram: int):
    """One block with its answers -> (bucket, block, data): the runs with shared anchors; those
    with hot anchors in a negative bucket of the block's own."""

    @tidy
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        batch, buf, offs = _texts(group["payload"].iloc[0])
        ids = _ids(batch)
        anchor, first, count = anchor_runs(buf, offs, depth, gram)
        key = anchor_keys(anchor)
        distinct, which = np.unique(key, return_inverse=True)
        shared, hot = _answers(group["part"].iloc[1:], group["data"].iloc[1:], distinct, ranges)
        # or another document of this block
        doc = np.searchsorted(offs, first, "right") - 1
        low, high = np.full(len(distinct), len(ids)), np.full(len(distinct), -1)
        np.minimum.at(low, which, doc)
        np.maximum.at(high, which, doc)
        keep = (shared | (low != high))[which]
        hot = hot[which][keep]
        anchor, first, count, doc = anchor[keep], first[keep], count[keep], doc[keep]
        if not len(first):
            return pd.DataFrame({"bucket": pd.Series(dtype="int64"), "block": pd.Series(dtype="int64"), "data": pd.Series(dtype=object)})
        block = int(group["block"].iloc[0])
        bucket = np.where(hot, -1 - block, (mix(anchor_keys(anchor)) % np.uint64(buckets)).astype(np.int64))
        text = run_hashes(buf, first, count + depth - 1)
        by = np.lexsort((first, bucket))
        bucket, first, count, doc, text = bucket[by], first[by], count[by], doc[by], text[by]
        new = np.append(True, bucket[1:] != bucket[:-1])
        new[: np.count_nonzero(hot) : PACKED] = True
        starts = np.flatnonzero(new)
        out = []
        for a, b in zip(starts, np.append(starts[1:], len(bucket)), strict=True):
            out.append(pack_runs(buf, ids, first[a:b], count[a:b], doc[a:b], text[a:b], depth))
        return pd.DataFrame({"bucket": bucket[starts], "block": block, "data": out})

    return run


def pack_runs(buf, ids, first, count, doc, text, depth) -> bytes:
    """Runs of one bucket and block: equal runs' bytes are held once (after a comparison)."""
    by = np.lexsort((np.arange(len(text)), count, text))
    same = np.append(False, (text[by][1:] == text[by][:-1]) & (count[by][1:] == count[by][:-1]))
    cand = np.flatnonzero(same)
    if len(cand):  # bytes decide, not hashes
        a, b = first[by][cand - 1], first[by][cand]
        size = count[by][cand] + depth - 1
        unlike = buf[_spread(a, size)] != buf[_spread(b, size)]
        same[cand[np.unique(np.repeat(np.arange(len(cand)), size)[unlike])]] = False
    head = by[np.flatnonzero(~same)][np.cumsum(~same) - 1]  # the first run of each run's class
    first_of = np.empty(len(by), np.int64)
    first_of[by] = head
    new = first_of == np.arange(len(by))
    number = np.cumsum(new) - 1
    refer = np.where(new, 0, number[first_of] + 1).astype(np.uint32)
    size = count[new] + depth - 1
    docs, where = np.unique(doc, return_inverse=True)
    held = np.bincount(where).astype(np.uint32)
    return squeeze(
        deltas(first.astype(np.uint32)), refer, count[new].astype(np.uint8), ids[docs].astype("<i8").view("<u8"), held,
        buf[_spread(first[new], size)],
    )


def unpack_runs(messages, depth: int):
    """(message, first, id, kind) of all runs of all messages; ``kind`` numbers their bytes: for
    each kind the number of its windows and where its bytes begin; the bytes."""
    parts = [unsqueeze(d) for d in messages]
    first = np.concatenate([undelta(p[0]).astype(np.int64) for p in parts])
    message = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    ids = np.concatenate([np.repeat(p[3].view("<i8"), p[4]) for p in parts])
    kinds = np.append(0, np.cumsum([len(p[2]) for p in parts]))
    kind = np.concatenate([np.where(p[1] > 0, p[1].astype(np.int64) - 1, np.cumsum(p[1] == 0) - 1) + k for p, k in zip(parts, kinds, strict=False)])
    count = np.concatenate([p[2] for p in parts]).astype(np.int64)
    begin = np.append(0, np.cumsum(count + depth - 1))[:-1]
    return message, first, ids, kind, count, begin, np.concatenate([p[5] for p in parts])


def repeated_spans(first, size, ids, window_first, window_min, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run, start, length): the bytes of each run's windows that a smaller id holds."""
    parts = []
    for i, j in runs(np.append(0, np.cumsum(size)), SPANNED):
        where, start, length = _repeated_spans(first[i:j], size[i:j], ids[i:j], window_first[i:j], window_min, depth)
        parts.append((where + i, start, length))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 3


def _repeated_spans(first, size, ids, window_first, window_min, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    flag = window_min[_spread(window_first, size)] < np.repeat(ids, size)
    where = np.repeat(np.arange(len(first)), size)[flag]
    byte = _spread(first, size)[flag]
    if not len(byte):
        return where, byte, byte
    joint = (byte[1:] == byte[:-1] + 1) & (where[1:] == where[:-1])
    head = np.flatnonzero(np.append(True, ~joint))
    tail = np.append(head[1:], len(byte)) - 1
    return where[head], byte[head], byte[tail] - byte[head] + depth


def repeated_windows(depth: int):
    """One bucket: (block, hot, data) with the spans of bytes that a smaller id holds (hot is 0).
    Runs of hot anchors are handed on as they are; hot is then the number of their windows."""

    @tidy
    def run(group: pd.DataFrame) -> pd.DataFrame:
        if group["bucket"].iloc[0] < 0:
            return pd.DataFrame({"block": group["block"], "hot": [int(unsqueeze(d)[2].sum(dtype=np.int64)) for d in group["data"]], "data": group["data"]})
        # all runs of all blocks
        block, first, ids, kind, count, begin, buf = unpack_runs(group["data"], depth)
        # equal runs of different blocks
        least = np.full(len(count), NULL_ID)
        np.minimum.at(least, kind, ids)
        merged = merge_runs(buf, begin, count, depth)
        least_of = np.full(len(count), NULL_ID)
        np.minimum.at(least_of, merged, least)
        own = np.unique(merged)
        window_at = np.append(0, np.cumsum(count[own]))
        window_min = np.repeat(least_of[own], count[own])
        sort_windows(buf, _spread(begin[own], count[own]), window_min, depth)
        place = np.full(len(count), -1)
        place[own] = window_at[:-1]
        window_first = place[merged][kind]
        size = count[kind]
        smallest = np.minimum.reduceat(window_min, window_at[:-1])
        at_own = np.zeros(len(count), np.int64)
        at_own[own] = np.arange(len(own))
        hit = np.flatnonzero(smallest[at_own[merged[kind]]] < ids)
        out_block, out_data = [], []
        if len(hit):
            where, start, length = repeated_spans(first[hit], size[hit], ids[hit], window_first[hit], window_min, depth)
            b = block[hit[where]]
            cut = np.flatnonzero(np.append(True, b[1:] != b[:-1]))
            for i, j in zip(cut, np.append(cut[1:], len(b)), strict=True):
                out_block.append(int(group["block"].iloc[b[i]]))
                out_data.append(squeeze(deltas(start[i:j].astype(np.uint32)), length[i:j].astype(np.uint32)))
        return pd.DataFrame({"block": pd.Series(out_block, dtype="int64"), "hot": pd.Series(0, range(len(out_block)), "int64"), "data": pd.Series(out_data, dtype=object)})

    return run


class HotWindows:
    """The distinct windows of a block's hot runs, by ascending hash (of bytes that only share a
    hash some may occur twice; the buckets compare bytes again)."""

    def __init__(self, messages, depth: int):
        messages = sorted(messages, key=lambda m: int(unsqueeze(m)[0][0]))
        _, self.first, self.ids, kind, count, begin, self.buf = unpack_runs(messages, depth)
        self.size, self.depth = count[kind], depth
        least = np.full(len(count), NULL_ID)
        np.minimum.at(least, kind, self.ids)
        at = _spread(begin, count)
        sums = prefix_hashes(self.buf)
        h = segment_hashes(sums, at, at + depth)
        del sums
        by = np.argsort(h, kind="stable")
        h, at, least = h[by], at[by], np.repeat(least, count)[by]
        digits = np.ndarray((len(self.buf) - 7,), ">u8", self.buf.tobytes(), strides=(1,))
        new = np.append(True, h[1:] != h[:-1])
        for step in range(0, depth, 8):
            digit = digits[at + min(step, depth - 8)]
            new[1:] |= digit[1:] != digit[:-1]
        head = np.flatnonzero(new)
        self.hash, self.at, self.least = h[head], at[head], np.minimum.reduceat(least, head)
        number = np.empty(len(by), np.int64)
        number[by] = np.cumsum(new) - 1
        self.window_first = np.append(0, np.cumsum(count))[:-1][kind]
        self.number = number  # of each window of each kind of run
        self.keys, self.key, self.held = np.unique(anchor_keys(self.hash), return_inverse=True, return_counts=True)

    def dealt(self, parts, answers, ranges: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """The windows that are held elsewhere too, by bucket, and their buckets."""
        shared = _answers(parts, answers, self.keys, ranges)[0] | (self.held > 1)
        some = np.flatnonzero(shared[self.key])
        bucket = (mix(self.keys[self.key[some]]) % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        return some[by], bucket[by]


def send_windows(ranges: int, depth: int):
    """A block's hot runs -> (part, block, data): the hashes of its distinct windows, by range."""

    @tidy
    def run(group: pd.DataFrame) -> pd.DataFrame:
        windows = HotWindows(group["data"], depth)
        parts, block, data = _by_range(int(group["block"].iloc[0]), windows.keys, windows.held, ranges)
        return pd.DataFrame({"part": parts.astype(np.int32), "block": block, "data": data})

    return run


def deal_windows(buckets: int, ranges: int, depth: int):
    """A block's hot runs with the answers (kind 1) -> (bucket, block, data): bytes and smallest
    id of the windows that are held elsewhere too, by their own hash."""

    @tidy
    def run(group: pd.DataFrame) -> pd.DataFrame:
        known = group[group["kind"] == 1]
        windows = HotWindows(group.loc[group["kind"] == 0, "data"], depth)
        some, bucket = windows.dealt(known["part"], known["data"], ranges, buckets)
        starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
        out = []
        for a, b in zip(starts, np.append(starts[1:], len(bucket)), strict=True):
            data = windows.buf[_spread(windows.at[some[a:b]], np.full(b - a, depth))]
            out.append(squeeze(data, windows.least[some[a:b]].view(np.uint64)))
        return pd.DataFrame({"bucket": bucket[starts].astype(np.int32), "block": pd.Series(int(group["block"].iloc[0]), range(len(out)), "int64"), "data": pd.Series(out, dtype=object)})

    return run


def least_ids(depth: int):
    """One bucket of windows: to each block the smallest ids, in the order it sent."""

    @tidy
    def run(group: pd.DataFrame) -> pd.DataFrame:
        parts = [unsqueeze(d) for d in group["data"]]
        least = np.concatenate([p[1].view(np.int64) for p in parts])
        sort_windows(np.concatenate([p[0] for p in parts]), np.arange(len(least)) * depth, least, depth)
        answers = np.split(least.view(np.uint64), np.cumsum([len(p[1]) for p in parts])[:-1])
        return pd.DataFrame({"block": group["block"].to_numpy(), "part": group["bucket"].to_numpy(), "data": [squeeze(a) for a in answers]})

    return run


def hot_spans(buckets: int, ranges: int, depth: int):
    """A block's hot runs with the answers (kind 1) and the smallest ids (kind 2) -> (block, data):
    the spans of bytes that a smaller id holds."""

    @tidy
    def run(group: pd.DataFrame) -> pd.DataFrame:
        known, ids = group[group["kind"] == 1], group[group["kind"] == 2].sort_values("part")
        windows = HotWindows(group.loc[group["kind"] == 0, "data"], depth)
        some, _ = windows.dealt(known["part"], known["data"], ranges, buckets)
        least = windows.least.copy()
        if len(ids):
            least[some] = np.concatenate([unsqueeze(d)[0] for d in ids["data"]]).view(np.int64)
        _, start, length = repeated_spans(windows.first, windows.size, windows.ids, windows.window_first, least[windows.number], depth)
        data = [squeeze(deltas(start.astype(np.uint32)), length.astype(np.uint32))] if len(start) else []
        return pd.DataFrame({"block": pd.Series(int(group["block"].iloc[0]), range(len(data)), "int64"), "data": pd.Series(data, dtype=object)})

    return run


def spans_of_hot(hot: DataFrame, windows: int, depth: int) -> DataFrame:
    """(block, data): the spans of the hot runs (block, data) with so many windows."""
    ranges = max(1, math.ceil(windows / RANGE_KEYS))
    buckets = max(1, math.ceil(windows * depth / BUCKET_BYTES))
    sent = hot.groupBy("block").applyInPandas(send_windows(ranges, depth), "part int, block long, data binary")
    known = written(sent.groupBy("part").applyInPandas(shared_keys(0), "block long, part int, data binary"), "windows")
    rows = hot.select("block", F.lit(0).alias("kind"), F.lit(-1).alias("part"), "data").unionAll(known.select("block", F.lit(1).alias("kind"), "part", "data"))
    dealt = rows.groupBy("block").applyInPandas(deal_windows(buckets, ranges, depth), "bucket int, block long, data binary")
    least = dealt.groupBy("bucket").applyInPandas(least_ids(depth), "block long, part int, data binary")
    rows = rows.unionAll(least.select("block", F.lit(2).alias("kind"), "part", "data"))
    return written(rows.groupBy("block").applyInPandas(hot_spans(buckets, ranges, depth), "block long, data binary"), "hot-spans")


def merge_runs(buf: np.ndarray, begin: np.ndarray, count: np.ndarray, depth: int) -> np.ndarray:
    """For each run the number of a run with the same bytes (hashes propose, bytes decide)."""
    size = count + depth - 1
    h = run_hashes(buf, begin, size)
    by = np.lexsort((count, h))
    same = np.append(False, (h[by][1:] == h[by][:-1]) & (count[by][1:] == count[by][:-1]))
    cand = np.flatnonzero(same)
    if len(cand):
        a, b, s = begin[by][cand - 1], begin[by][cand], size[by][cand]
        unlike = buf[_spread(a, s)] != buf[_spread(b, s)]
        same[cand[np.unique(np.repeat(np.arange(len(cand)), s)[unlike])]] = False
    out = np.empty(len(by), np.int64)
    out[by] = by[np.flatnonzero(~same)][np.cumsum(~same) - 1]
    return out


def sort_windows(buf: np.ndarray, at: np.ndarray, least: np.ndarray, depth: int) -> None:
    """Lowers ``least`` of every window (its first byte ``at``) to the minimum over all windows
    with the same ``depth`` bytes, by most-significant-digit passes of eight bytes. Large inputs
    are dealt into rounds by the first digit, which bounds what is sorted at a time."""
    digits = np.ndarray((max(0, len(buf) - 7),), ">u8", buf.tobytes(), strides=(1,))
    rounds = -(-len(at) // SORTED)
    deal = None
    if rounds > 1:
        deal = np.empty(len(at), np.uint16)
        for i in range(0, len(at), SORTED):
            deal[i : i + SORTED] = mix(digits[at[i : i + SORTED]].astype(np.uint64)) % np.uint64(rounds)
    for r in range(max(1, rounds)):
        live = np.arange(len(at)) if deal is None else np.flatnonzero(deal == r)
        group = np.zeros(len(live), np.int64)
        for step in range(0, depth, 8):
            digit = digits[at[live] + min(step, depth - 8)].astype(np.uint64)
            by = np.argsort(digit) if step == 0 else np.lexsort((digit, group))
            live, digit, group = live[by], digit[by], group[by]
            new = np.append(True, (digit[1:] != digit[:-1]) | (group[1:] != group[:-1]))[: len(live)]
            group = np.cumsum(new) - 1
            keep = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
            live, group = live[keep], group[keep]
            if not len(live):
                break
        if len(live):
            head = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            low = np.minimum.reduceat(least[live], head)
            least[live] = np.repeat(low, np.diff(np.append(head, len(live))))


def covered_bytes(n: int, spans: list[bytes]) -> np.ndarray:
    change = np.zeros(n + 1, np.int32)
    for data in spans:
        start, length = unsqueeze(data)
        start = undelta(start).astype(np.int64)
        np.add.at(change, start, 1)
        np.add.at(change, start + length, -1)
    return np.cumsum(change[:n], out=change[:n]) > 0


def removed_spans(docs: DataFrame, depth: int, gram: int, columns: list[str], text: str, block_bytes: int) -> DataFrame:
    """Rows (block, part, payload, data): every block's texts (part -1) and its removed spans."""
    blocks = block_table(docs, columns, text, block_bytes)
    total = blocks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    ranges = max(1, math.ceil(total / ((depth - gram + 2) / 2) / RANGE_KEYS))
    buckets = max(1, math.ceil(total * 3.7 / BUCKET_BYTES))
    rows = blocks.select("block", F.lit(-1).alias("part"), "payload", F.lit(None).cast("binary").alias("data"))
    sent = blocks.select("block", "payload").mapInArrow(send_anchors(ranges, depth, gram), "part int, block long, data binary")
    known = written(sent.groupBy("part").applyInPandas(shared_keys(HOT_RUNS), "block long, part int, data binary"), "anchors")
    known = known.select("block", "part", F.lit(None).cast("binary").alias("payload"), "data")
    by_anchor = rows.unionAll(known).groupBy("block").applyInPandas(send_runs(buckets, ranges, depth, gram), "bucket long, block long, data binary")
    found = written(by_anchor.groupBy("bucket").applyInPandas(repeated_windows(depth), "block long, hot long, data binary"), "spans")
    spans, hot = found.where("hot = 0").select("block", "data"), found.where("hot > 0").select("block", "data")
    windows = found.agg(F.coalesce(F.sum("hot"), F.lit(0))).first()[0]
    if windows:
        spans = spans.unionAll(spans_of_hot(hot, windows, depth))
    return rows.unionAll(spans.select("block", F.lit(0).alias("part"), F.lit(None).cast("binary").alias("payload"), "data"))


def dedup_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH, gram: int = GRAM, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per document."""
    columns = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))

    @tidy
    def report(group: pd.DataFrame) -> pd.DataFrame:
        batch, buf, offs = _texts(group.loc[group["part"] < 0, "payload"].iloc[0])
        gone = covered_bytes(len(buf), group.loc[group["part"] >= 0, "data"].tolist())
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        edge = offs[:-1][offs[:-1] < len(buf)]
        begins[edge] = gone[edge]
        docs = list(zip(offs[:-1], offs[1:], strict=True))
        removed, spans = ([np.count_nonzero(x[a:b]) for a, b in docs] for x in (gone, begins))
        kept = [hashlib.sha256(buf[a:b][~gone[a:b]].tobytes()).hexdigest() for a, b in docs]
        out = pd.DataFrame({"n_bytes": np.diff(offs), "n_removed": np.array(removed, np.int64), "n_spans": np.array(spans, np.int64), "kept_sha256": kept})
        out.insert(0, "doc_id", pd.array(batch.column(0).to_pylist(), "Int64"))
        return out

    rows = removed_spans(columns, depth, gram, ["doc_id", "text"], "text", block_bytes)
    return rows.groupBy("block").applyInPandas(report, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def dedup_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH, gram: int = GRAM, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents with repeated passages cut out of the text, all columns kept. A character
    goes only if all its bytes go, so texts stay UTF-8; null texts stay null."""
    others = [c for c in docs.columns if c not in (doc_id, text)]
    named = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)])

    @tidy
    def cut(group: pd.DataFrame) -> pd.DataFrame:
        batch, buf, offs = _texts(group.loc[group["part"] < 0, "payload"].iloc[0])
        gone = covered_bytes(len(buf), group.loc[group["part"] >= 0, "data"].tolist())
        for i, j in runs(offs, STEP):
            piece = slice(offs[i], offs[j])
            lead = np.flatnonzero((buf[piece] & 0xC0) != 0x80)
            if len(lead):
                gone[piece] = np.repeat(np.logical_and.reduceat(gone[piece], lead), np.diff(np.append(lead, piece.stop - piece.start)))
        texts = [buf[a:b][~gone[a:b]].tobytes().decode("utf-8", "replace") for a, b in zip(offs[:-1], offs[1:], strict=True)]
        null = batch.column(1).is_null().to_numpy(zero_copy_only=False)
        out = batch.to_pandas(types_mapper=lambda t: pd.ArrowDtype(t))
        out["text"] = pd.array([None if x else t for t, x in zip(texts, null, strict=True)], dtype=out["text"].dtype)
        return out

    rows = removed_spans(named, depth, gram, named.columns, "text", block_bytes)
    result = rows.groupBy("block").applyInPandas(cut, named.schema)
    back = {doc_id: "doc_id", text: "text"} | {c: f"c{i}" for i, c in enumerate(others)}
    return result.select(*[F.col(back[c]).alias(c) for c in docs.columns])
