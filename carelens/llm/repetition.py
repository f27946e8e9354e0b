"""Quality rules with suffix-array repetition.

Per document, over its words: the suffix array (prefix doubling, all documents of a run of rows
at once; only suffixes that still tie are sorted again), the longest common prefixes of
neighbours, and from the LCP intervals the maximal repeated word sequences. A suffix belongs to
an interval of height h when a neighbour shares h words with it, so each position's largest
height spans the longest repeat that begins there; the union of these spans is the covered part.
A document fails the method when repeats of at least ``min_words`` words cover more than
``max_covered`` of its words, or one repeat is longer than ``max_repeat`` words. The plain
rules (word count, repeated 3-word windows) come first.

Everything is one pass of map tasks: no shuffle, memory bounded by a run of rows.

Defined results: a null, empty or blank text has no words and fails the word-count rule; a row
is judged on its own text, so repeated rows get equal results; no rows give no rows. Only the id
and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import SPACE, distinct_segments, runs, text_buffer, tidy, words

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "covered_words long, longest_repeat long, base_failed boolean, kept boolean"
)


def suffix_array(ids: np.ndarray, row: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix order of all rows at once, by (row, words), and the ranks of each doubling.

    ids: word numbers; row: each position's row; ends: the end of that row. ``levels[k]`` gives
    two suffixes one rank if they begin with the same 2**k words of the same row. A suffix alone
    in its group has its place; only groups of two or more are sorted further."""
    n = len(ids)
    keys = row.astype(np.int64) * (int(ids.max(initial=0)) + 1) + ids
    live = np.argsort(keys, kind="stable")
    rank = np.empty(n, np.int64)
    rank[live], size = _places(keys[live], np.zeros(n, np.int64))
    live, levels, depth = live[size > 1], [rank], 1
    while len(live):
        after = live + depth
        follow = np.where(after < ends[live], rank[np.minimum(after, n - 1)] + 1, 0)
        keys = rank[live] * (n + 1) + follow
        by = np.argsort(keys, kind="stable")
        live = live[by]
        refined = rank.copy()
        group = rank[live]
        at = np.arange(len(live))
        begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        base = np.repeat(begin, np.diff(np.append(begin, len(live))))
        place, size = _places(keys[by], base - group)
        refined[live] = place
        live, depth = live[size > 1], depth * 2
        rank = refined
        levels.append(rank)
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order, levels


def _places(keys: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys the place of each one's group, less ``shift``, and the group's size."""
    head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    size = np.diff(np.append(head, len(keys)))
    return np.repeat(head, size) - shift, np.repeat(size, size)


def repeat_heights(ids: np.ndarray, row: np.ndarray, ends: np.ndarray, least: int = 2) -> np.ndarray:
    """For each position the length of the longest word sequence from there on that its row
    holds twice or more: the larger common prefix with its two neighbours in suffix order.
    Lengths under ``least`` (2 at most) may come out as 0."""
    n = len(ids)
    height = np.zeros(n, np.int64)
    if n < 2:
        return height
    order, levels = suffix_array(ids, row, ends)
    start = levels[min(len(levels) - 1, least - 1)]
    pairs = np.flatnonzero(start[order[1:]] == start[order[:-1]]) if len(levels) >= least else np.zeros(0, np.int64)
    a, b = order[pairs], order[pairs + 1]
    common = np.zeros(len(pairs), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        i, j = a + common, b + common
        ok = (i < ends[a]) & (j < ends[b])
        ok &= levels[k][np.minimum(i, n - 1)] == levels[k][np.minimum(j, n - 1)]
        common[ok] += 1 << k
    np.maximum.at(height, a, common)
    np.maximum.at(height, b, common)
    return height


def covered(height: np.ndarray, least: int) -> np.ndarray:
    """Which positions the spans [i, i + height) of at least ``least`` cover."""
    at = np.flatnonzero(height >= least)
    change = np.bincount(at, minlength=len(height) + 1) - np.bincount(at + height[at], minlength=len(height) + 1)
    return np.cumsum(change[: len(height)]) > 0


def _sums(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(flags, dtype=np.int64))
    return total[offs[1:]] - total[offs[:-1]]


def duplicate_lines(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Per row the lines with a word that equal an earlier line."""
    brk = np.flatnonzero(buf == 10)
    starts = np.unique(np.concatenate([offs[:-1], brk + 1]))
    starts = starts[starts < len(buf)]
    stops = np.append(starts[1:], len(buf))
    closes = stops - (buf[stops - 1] == 10)
    # a row that ends in a line break ends that line; the break belongs to no line
    solid = np.append(0, np.cumsum(~SPACE[buf], dtype=np.int64))
    full = solid[closes] > solid[starts]
    starts, closes = starts[full], closes[full]
    row = np.searchsorted(offs, starts, "right") - 1
    h = distinct_segments(buf, starts, closes)[1]
    by = np.lexsort((h, row))
    again = np.zeros(len(by), bool)
    again[1:] = (h[by][1:] == h[by][:-1]) & (row[by][1:] == row[by][:-1])
    return np.bincount(row[by][again], minlength=len(offs) - 1)


def judge(buf: np.ndarray, offs: np.ndarray, min_words: int, max_covered: float, max_repeat: int) -> dict[str, np.ndarray]:
    """All columns of ``SCHEMA`` but the id, for the rows of one run."""
    starts, ends, row_words = words(buf, offs)
    n_words = np.diff(row_words)
    row = np.repeat(np.arange(len(n_words)), n_words)
    ids = distinct_segments(buf, starts, ends)[1]
    height = repeat_heights(ids, row, np.repeat(row_words[1:], n_words))
    n_repeat = _sums(covered(np.where(height >= 3, 3, 0), 3), row_words)
    n_covered = _sums(covered(height, min_words), row_words)
    longest = np.zeros(len(n_words), np.int64)
    np.maximum.at(longest, row, height)
    failed = (n_words < 50) | (100 * n_repeat > 50 * n_words)
    bad = (n_covered > max_covered * n_words) | (longest > max_repeat)
    return {
        "n_words": n_words, "word_chars": _sums(~SPACE[buf] & ((buf & 0xC0) != 0x80), offs), "n_symbols": _sums(SYMBOL[buf], offs),
        "n_dup_lines": duplicate_lines(buf, offs), "n_repeat_words": n_repeat, "covered_words": n_covered,
        "longest_repeat": np.where(longest >= 3, longest, 0), "base_failed": failed, "kept": ~failed & ~bad,
    }


def repetition_rules(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    min_words: int = 10, max_covered: float = 0.1, max_repeat: int = 50,
) -> DataFrame:
    """One row per document: the counts, the covered words, the longest repeat and the verdict.

    The default limits are published ones for web text: at most a tenth of a document inside repeats
    of ten words (Rae et al. 2021), none of more than 50 (the length from which Lee et al. 2022 cut
    exact repeats)."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = text_buffer(batch.column(1))
            for i, j in runs(offs):
                out = judge(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i], min_words, max_covered, max_repeat)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *map(pa.array, out.values())], ["doc_id", *out])

    columns = docs.select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`").cast("string"))
    return columns.mapInArrow(run, SCHEMA)
