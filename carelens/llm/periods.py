"""Periodic runs of words by enumerating maximal pairs.

A run is a stretch of words with smallest period q, of ``max(least, times * q)`` words or more,
that no neighbouring word extends. Its two copies, q words apart, are a maximal pair: equal for
length - q words, with different words before them and behind them. The other way round, a maximal
pair (i, i + d) of h equal words spans a stretch of d + h words with period d that cannot be
extended, so the pairs with d + h >= max(least, times * d) are exactly the runs, and nothing has to
be extended: the words behind differ as h is an exact longest common prefix, those before by class.

Per document the suffixes are ordered by their words, and the LCP-interval tree is walked bottom up
over the neighbours that share enough words. A node holds the positions below it in text order, and
which left-word classes (the word before a position; the first position has a class of its own)
occur there. Joining two nodes puts the smaller list into the larger: only there two positions have
the node's height as their common prefix. A position meets its two text neighbours in the other
list, and only if the nodes do not share one and the same class. No farther one is needed: if an
occurrence lay between two that are at most a third of the height apart, the words between them had
a shorter period dividing d (Fine and Wilf), so d would not be the smallest. Multiples of a period
end in the same stretch, where the smallest stays.

Words are equal if their bytes are. Everything is one pass of map tasks without a shuffle; a task
holds one run of rows (``common.PIECE_BYTES`` of text, or one longer text with about 16 bytes a word
for every doubling of its longest repeat). Joins cost a binary search per position moved, and each
position moves at most log2(n) times.

Defined results: a null, empty or blank text has no words, no runs and an empty collapsed text;
rows are judged on their own, so repeated rows get equal results; no rows give no rows. Only the id,
the text and the seed are read; other columns may have any name.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import distinct_segments, runs, spread, text_buffer, tidy, words
from carelens.llm.repetition import suffix_array

SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"

#: One more than any class of a left word: what stands before a document's first word.
NO_WORD = -1


def neighbours(order: np.ndarray, levels: list[np.ndarray], ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places k with order[k], order[k + 1] sharing ``least`` words or more, and how many they share."""
    deep = int(least).bit_length() - 1
    if len(levels) <= deep:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rank = levels[deep]
    at = np.flatnonzero(rank[order[1:]] == rank[order[:-1]])
    a, b = order[at], order[at + 1]
    common = np.zeros(len(at), np.int64)
    last = len(ends) - 1
    for k in range(len(levels) - 1, -1, -1):
        i, j = a + common, b + common
        equal = (i < ends[a]) & (j < ends[b])
        equal &= levels[k][np.minimum(i, last)] == levels[k][np.minimum(j, last)]
        common[equal] += 1 << k
    held = common >= least
    return at[held], common[held]


class Node:
    """A node of the LCP-interval tree: its positions in text order, and their left-word classes."""

    __slots__ = ("classes", "height", "places")

    def __init__(self, height: int, place: int, left: int):
        self.height, self.places, self.classes = height, [place], {left}


def join(a: Node, b: Node, height: int, left: list[int], pairs: list, times: int, least: int) -> Node:
    """One node of both, whose positions share ``height`` words across; appends their maximal pairs."""
    small, large = (a, b) if len(a.places) <= len(b.places) else (b, a)
    into, reach = large.places, height // (times - 1)
    mixed = len(large.classes) > 1 or small.classes != large.classes
    cuts = [bisect_left(into, p) for p in small.places]
    if mixed:
        for p, cut in zip(small.places, cuts, strict=True):
            for q in into[max(cut - 1, 0) : cut + 1]:
                d = q - p if q > p else p - q
                if d <= reach and d + height >= least and left[p] != left[q]:
                    pairs.append((min(p, q), height + d, d))
    if len(small.places) == 1:
        into.insert(cuts[0], small.places[0])
    else:
        into.extend(small.places)
        into.sort()
    large.classes |= small.classes
    large.height = height
    return large


def maximal_pairs(places: list[int], heights: list[int], left: list[int], times: int, least: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the maximal pairs below one root: suffixes in order, the words that
    neighbours share, and each position's left-word class."""
    pairs: list[tuple[int, int, int]] = []
    stack: list[Node] = []
    done = Node(0, places[0], left[places[0]])
    for p, h in zip(places[1:], heights, strict=True):
        while stack and stack[-1].height > h:
            done = join(stack[-1], done, stack.pop().height, left, pairs, times, least)
        if stack and stack[-1].height == h:
            stack[-1] = join(stack[-1], done, h, left, pairs, times, least)
        else:
            done.height = h
            stack.append(done)
        done = Node(0, p, left[p])
    while stack:
        done = join(stack[-1], done, stack.pop().height, left, pairs, times, least)
    return pairs


def find_runs(ids: np.ndarray, row_words: np.ndarray, times: int = 4, least: int = 6) -> np.ndarray:
    """The runs (start, length, period) of all rows, by start and period; starts number the words of
    the whole array, ``row_words`` has each row's first word and the end."""
    n = np.diff(row_words)
    row, ends = np.repeat(np.arange(len(n)), n), np.repeat(row_words[1:], n)
    order, levels = suffix_array(ids, row, ends)
    # the fewest equal words of a pair: over all distances d, max(least - d, (times - 1) * d)
    fewest = min(max(least - d, (times - 1) * d) for d in range(1, least + 1))
    at, common = neighbours(order, levels, ends, fewest)
    if not len(at):
        return np.zeros((0, 3), np.int64)
    before = np.append(NO_WORD, ids[:-1])
    before[row_words[:-1][n > 0]] = NO_WORD
    cuts = np.flatnonzero(np.diff(at) > 1) + 1
    found: list[tuple[int, int, int]] = []
    for group, heights in zip(np.split(at, cuts), np.split(common, cuts), strict=True):
        places = order[group[0] : group[-1] + 2]
        lo = int(places.min())
        if len(places) == 2:  # the commonest: a pair alone
            p, q, h = lo, int(places.max()), int(heights[0])
            if q - p <= h // (times - 1) and q - p + h >= least and before[p] != before[q]:
                found.append((p, q - p + h, q - p))
            continue
        left = dict(zip(places.tolist(), before[places].tolist(), strict=True))
        found += maximal_pairs(places.tolist(), heights.tolist(), left, times, least)
    smallest: dict[tuple[int, int], int] = {}
    for start, length, period in found:
        smallest[start, length] = min(period, smallest.get((start, length), period))
    return np.array(sorted((s, n, q) for (s, n), q in smallest.items()), np.int64).reshape(-1, 3)


def by_start_and_period(found: np.ndarray) -> np.ndarray:
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def repeated_tails(row_words: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Which original word stands at each place once the tails of the seeded rows are repeated.

    A row whose seed is a multiple of 10 repeats, from word a on, its words a to a + p; seeds under
    zero stand for none."""
    place = np.arange(row_words[-1])
    n = np.diff(row_words)
    for r in np.flatnonzero((seeds >= 0) & (seeds % 10 == 0) & (n > 0)).tolist():
        g, size = int(seeds[r]) // 10, int(n[r])
        a = g % size
        p = 1 + (size - a) // (3 + g % 8)
        begin = int(row_words[r]) + a
        place[begin : row_words[r + 1]] = begin + np.arange(size - a) % p
    return place


def judge(buf: np.ndarray, offs: np.ndarray, seeds: np.ndarray, times: int, least: int) -> list[pa.Array]:
    """The columns of ``SCHEMA`` but the id, for the rows of one piece."""
    starts, ends, row_words = words(buf, offs)
    _, ids = distinct_segments(buf, starts, ends)
    place = repeated_tails(row_words, seeds)
    found = by_start_and_period(find_runs(ids[place], row_words, times, least))
    row = np.searchsorted(row_words, found[:, 0], "right") - 1
    first, n = found[:, 0] + found[:, 2], found[:, 1] - found[:, 2]
    change = np.bincount(first, minlength=len(place) + 1) - np.bincount(first + n, minlength=len(place) + 1)
    kept = np.flatnonzero(np.cumsum(change[: len(place)]) == 0)
    begins, size = starts[place[kept]], ends[place[kept]] - starts[place[kept]]
    joined = np.append(buf, np.uint8(32))[spread(begins, size + 1)]
    total = np.append(0, np.cumsum(size + 1))
    joined[total[1:] - 1] = 32
    at = total[np.searchsorted(kept, row_words)]
    texts = [joined[a : max(a, b - 1)].tobytes().decode("utf-8", "replace") for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    fields = [pa.array(found[:, 0] - row_words[row]), pa.array(found[:, 1]), pa.array(found[:, 2])]
    lists = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(row, np.arange(len(offs))), pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"])
    )
    return [pa.array(np.diff(row_words)), lists, pa.array(texts, pa.string())]


def periodic_runs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", times: int = 4, least: int = 6, seed: Column | None = None,
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) per document: the runs of ``max(least, times * period)``
    words or more by start and period (``times`` 3 or more), and the words joined by single spaces
    without what runs repeat (words that a run holds after its first period).

    seed: optional, a number per row; rows with a multiple of 10 get a repeated tail first
    (``repeated_tails``), a load for tests that brings long runs into any corpus."""
    if times < 3:
        raise ValueError("times must be 3 or more: with fewer, a run need not show in neighbouring occurrences")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = text_buffer(batch.column(1))
            seeds = batch.column(2).fill_null(-1).to_numpy(zero_copy_only=False)
            for i, j in runs(offs):
                out = judge(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i], seeds[i:j], times, least)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *out], ["doc_id", "n_words", "runs", "collapsed"])

    seeds = (F.lit(None) if seed is None else seed).cast("long")
    columns = docs.select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`").cast("string"), seeds)
    return columns.mapInArrow(run, SCHEMA)
