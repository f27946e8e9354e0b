"""Benchmark decontamination with one Aho-Corasick automaton.

Texts are normalised to words: ASCII letters in lower case, a word is a run of letters, digits and
characters beyond ASCII. Every ``window`` consecutive words of a benchmark item, or the whole of a
shorter item, is a pattern. All patterns form one automaton over word numbers: a trie whose edges
are sorted (node, word) pairs, a failure link from each node to its longest proper suffix in the
trie, and an output link to the nearest suffix that is a pattern. A task reads each text once: words
that no item holds lead to the root, so only stretches of known words are walked, many side by side
in numpy; a stretch is cut where it is long, and the walk begins ``window`` - 1 words before the cut,
after which its state no longer depends on what was before. Matches are word numbers, and each word
has its character offsets in the original text.

The patterns are read by every task, so their size is checked: the benchmark is cut into pieces and,
if its words take more than ``slice_bytes``, dealt into slices of about that size by a hash. Each
slice is an automaton of its own with its own pass over the texts, and what the passes found in one
text is united; with one slice (any usual benchmark) nothing is shuffled.

Defined results: a null text has no words; items of no words match nothing; rows that repeat an item
id are one item; an item without an id marks words but has no name in ``items``; every document row
gets a row, so repeated rows get equal results; without items no word is hit; no documents give no
rows. Words are equal if their bytes are. Only ids and texts are read, other columns may have any
name. A task holds one run of rows (``common.PIECE_BYTES`` of text, or one longer text).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import (
    LOWER, distinct_segments, hash_segments, pack, runs, same_bytes, spread, text_buffer, tidy, unpack, words, written,
)

#: All bytes but digits, letters and those of characters beyond ASCII stand between words.
BETWEEN = np.ones(256, bool)
BETWEEN[48:58] = BETWEEN[65:91] = BETWEEN[97:123] = BETWEEN[128:] = False

#: Bytes of benchmark words in one automaton; it takes some 300 bytes for each of their words.
SLICE_BYTES = 2 << 20
#: Words of an item in one piece, with the ``window`` - 1 words that follow besides.
PIECE_WORDS = 4096
#: Words that one walk goes at most.
LANE = 256

SCHEMA = "doc_id long, n_words long, hits array<struct<word: long, start: long, end: long>>, items array<string>"


class Automaton:
    """Aho-Corasick over sequences of numbers from 1 to ``letters`` - 1.

    patterns: one row per distinct pattern, filled up with zeros. Nodes are numbered breadth first
    from the root, 0; ``keys`` holds (node, letter) of each edge, in the order of the nodes below."""

    def __init__(self, patterns: np.ndarray, letters: int):
        self.letters = letters
        length = (patterns > 0).sum(1)
        at = np.zeros(len(patterns), np.int64)
        levels, keys = [0, 1], []
        for d in range(patterns.shape[1]):
            live = np.flatnonzero(length > d)
            edge, which = np.unique(at[live] * letters + patterns[live, d], return_inverse=True)
            at[live] = levels[-1] + which
            keys.append(edge)
            levels.append(levels[-1] + len(edge))
        self.keys = np.concatenate([*keys, np.zeros(0, np.int64)])
        nodes = levels[-1]
        self.pattern = np.full(nodes, -1, np.int64)
        self.pattern[at] = np.arange(len(patterns))
        self.fail, self.output = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        for a, b in zip(levels[1:-1], levels[2:], strict=True):
            node = np.arange(a, b)
            parent, letter = self.keys[node - 1] // letters, self.keys[node - 1] % letters
            if a > 1:
                self.fail[node] = self.step(self.fail[parent], letter)
            suffix = self.fail[node]
            self.output[node] = np.where(self.pattern[suffix] >= 0, suffix, self.output[suffix])

    def step(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The states after one letter each: along failure links to the first that has the edge."""
        out, live, state = np.zeros(len(state), np.int64), np.arange(len(state)), state.copy()
        while len(live):
            key = state * self.letters + letter[live]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[at] == key
            out[live[found]] = at[found] + 1
            on = ~found & (state > 0)
            live, state = live[on], self.fail[state[on]]
        return out

    def matches(self, letters: np.ndarray, begins: np.ndarray, ends: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """(last place, pattern) of all occurrences inside the stretches [begin, end)."""
        pieces = np.maximum(1, -(-(ends - begins) // LANE))
        cut = np.repeat(begins, pieces) + LANE * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        stop = np.minimum(cut + LANE, np.repeat(ends, pieces))
        start = np.maximum(np.repeat(begins, pieces), cut - (longest - 1))
        by = np.argsort(start - stop, kind="stable")
        cut, stop, start = cut[by], stop[by], start[by]
        size, state = stop - start, np.zeros(len(by), np.int64)
        places, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for t in range(int(size[0]) if len(size) else 0):
            n = int(np.searchsorted(-size, -t, "left"))  # the stretches of more than t words
            at = start[:n] + t
            state = self.step(state[:n], letters[at])
            node = np.where(self.pattern[state] >= 0, state, self.output[state])
            live = np.flatnonzero((node > 0) & (at >= cut[:n]))
            while len(live):
                places.append(at[live])
                found.append(self.pattern[node[live]])
                node[live] = self.output[node[live]]
                live = live[node[live] > 0]
        return np.concatenate(places), np.concatenate(found)


class Patterns:
    """The automaton of one slice, its words and which items each pattern comes from."""

    def __init__(self, rows: pa.RecordBatch, window: int):
        names = rows.column(0).to_pylist()
        buf, offs = text_buffer(rows.column(1))
        starts, ends, row_words = words(buf, offs, BETWEEN)
        first, which = distinct_segments(buf, starts, ends)
        # the words in the order of their hashes; several of one hash stand together
        hashes = hash_segments(buf, starts[first], ends[first])
        by = np.argsort(hashes, kind="stable")
        number = np.empty(len(by), np.int64)
        number[by] = np.arange(1, len(by) + 1)
        self.hashes, self.buf, self.starts, self.ends = hashes[by], buf, starts[first][by], ends[first][by]
        same = np.diff(np.append(np.flatnonzero(np.append(True, np.diff(self.hashes) > 0)[: len(by)]), len(by)))
        self.most = int(same.max(initial=0))

        n = np.diff(row_words)
        count = np.where(n >= window, n - window + 1, n > 0)
        item = np.repeat(np.arange(len(n)), count)
        begin = spread(row_words[:-1], count)
        size = np.minimum(n, window)[item]
        table = np.zeros((len(begin), window), np.int64)
        ids = number[which] if len(which) else which
        for k in range(window):
            live = np.flatnonzero(size > k)
            table[live, k] = ids[begin[live] + k]
        patterns, of = np.unique(table, axis=0, return_inverse=True)
        self.size = (patterns > 0).sum(1)
        self.shortest, self.longest = int(self.size.min(initial=window)), int(self.size.max(initial=0))
        self.automaton = Automaton(patterns, len(by) + 1)
        known = np.array([x is not None for x in names], bool)
        self.names, name = np.unique(np.array([x or "" for x in names], object).astype(str), return_inverse=True)
        held = known[item]
        pairs = np.unique(of.reshape(-1)[held] * (len(self.names) + 1) + name[item[held]])
        self.items = pairs % (len(self.names) + 1)
        self.items_at = np.searchsorted(pairs // (len(self.names) + 1), np.arange(len(patterns) + 1))

    def numbers(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Each word's number, 0 if no item holds it."""
        out = np.zeros(len(starts), np.int64)
        if not len(self.hashes) or not len(starts):
            return out
        h = hash_segments(buf, starts, ends)
        at = np.searchsorted(self.hashes, h)
        both = np.append(buf, self.buf)
        for k in range(self.most):
            place = np.minimum(at + k, len(self.hashes) - 1)
            live = np.flatnonzero((out == 0) & (self.hashes[place] == h) & (ends - starts == (self.ends - self.starts)[place]))
            equal = same_bytes(both, starts[live], len(buf) + self.starts[place[live]], (ends - starts)[live])
            out[live[equal]] = place[live[equal]] + 1
        return out

    def find(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Starts, ends and row bounds of the words, which are hit, and per matching row the items."""
        starts, ends, row_words = words(buf, offs, BETWEEN)
        numbers = self.numbers(LOWER[buf], starts, ends)
        solid = np.concatenate([[0], (numbers > 0).astype(np.int8), [0]])
        edges = row_words[1:-1][(row_words[1:-1] > 0) & (row_words[1:-1] < len(numbers))]
        begins = np.union1d(np.flatnonzero(np.diff(solid) == 1), edges[numbers[edges] > 0] if len(edges) else edges).astype(np.int64)
        stops = np.union1d(np.flatnonzero(np.diff(solid) == -1), edges[numbers[edges - 1] > 0] if len(edges) else edges).astype(np.int64)
        long = stops - begins >= self.shortest
        place, pattern = self.automaton.matches(numbers, begins[long], stops[long], self.longest)
        change = np.bincount(place - self.size[pattern] + 1, minlength=len(numbers) + 1) - np.bincount(place + 1, minlength=len(numbers) + 1)
        hit = np.cumsum(change[: len(numbers)]) > 0
        row = np.searchsorted(row_words, place, "right") - 1
        pairs = np.unique(row * (len(self.size) + 1) + pattern)
        row, pattern = pairs // (len(self.size) + 1), pairs % (len(self.size) + 1)
        matched = np.unique(row)
        cuts = np.append(np.searchsorted(row, matched), len(row))
        items = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            of = pattern[a:b]
            items.append(np.unique(self.items[spread(self.items_at[of], self.items_at[of + 1] - self.items_at[of])]))
        return starts, ends, row_words, hit, matched, items


@lru_cache(maxsize=1)
def patterns_of(data: bytes, window: int) -> Patterns:
    return Patterns(unpack(data), window)


def _pieces(window: int):
    """(item, text) -> (item, normalised words joined by spaces), long items in overlapping pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = text_buffer(batch.column(1))
            for i in range(batch.num_rows):
                text = LOWER[buf[offs[i] : offs[i + 1]]]
                starts, ends, _ = words(text, np.array([0, len(text)]), BETWEEN)
                for k in range(0, max(1, len(starts) - window + 1) if len(starts) else 0, PIECE_WORDS):
                    last = min(k + PIECE_WORDS + window - 1, len(starts)) - 1
                    part = text[starts[k] : ends[last]].copy()
                    part[BETWEEN[part]] = 32
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([b" ".join(part.tobytes().split())], pa.binary())], ["item", "words"])

    return run


def _scan(data: bytes, window: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = patterns_of(data, window)
        for batch in batches:
            whole, bounds = text_buffer(batch.column(1))
            for i, j in runs(bounds):
                buf, offs = whole[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]
                starts, ends, row_words, hit, matched, items = patterns.find(buf, offs)
                at = np.flatnonzero(hit)
                row = np.searchsorted(row_words, at, "right") - 1
                chars = np.append(0, np.cumsum((buf & 0xC0) != 0x80))
                base = chars[offs[row]]
                fields = [at - row_words[row], chars[starts[at]] - base, chars[ends[at]] - base]
                hits = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(row, np.arange(j - i + 1)), pa.int32()),
                    pa.StructArray.from_arrays([pa.array(f, pa.int64()) for f in fields], ["word", "start", "end"]),
                )
                size = np.zeros(j - i, np.int64)
                size[matched] = [len(x) for x in items]
                names = patterns.names[np.concatenate([*items, np.zeros(0, np.int64)])] if items else []
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(list(names), pa.string()))
                out = [batch.column(0).slice(i, j - i), pa.array(np.diff(row_words)), hits, lists, batch.column(2).slice(i, j - i)]
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "n_words", "hits", "items", "text_key"])

    return run


def contamination(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = 10, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """(doc_id, n_words, hits, items) per document: the hit words with their number and character
    offsets in the text, in order, and the ids (as strings) of the items with occurring windows."""
    tests = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("item"), F.col(f"`{item_text}`").cast("string").alias("words"))
    pieces = written(tests.mapInArrow(_pieces(window), "item string, words binary").distinct(), "benchmark")
    size = pieces.agg(F.sum(F.octet_length("words") + 16)).first()[0] or 0
    slices = max(1, math.ceil(size / slice_bytes))
    key = F.lit(None).cast("string") if slices == 1 else F.sha2(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), 256)
    columns = docs.select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`").cast("string"), key.alias("text_key"))
    passes = []
    for s in range(slices):
        own = pieces.where(F.pmod(F.xxhash64("item", "words"), F.lit(slices)) == s).collect()
        batch = pa.RecordBatch.from_arrays([pa.array([r["item"] for r in own], pa.string()), pa.array([bytes(r["words"]) for r in own], pa.binary())], ["item", "words"])
        found = columns.mapInArrow(_scan(pack(batch), window), f"{SCHEMA}, text_key string")
        if slices == 1:
            return found.drop("text_key")
        passes.append(written(found if s == 0 else found.where(F.size("hits") > 0), "contamination"))
    every = passes[0].where(F.size("hits") > 0)
    for found in passes[1:]:
        every = every.unionByName(found)
    # what the passes found in one text, whichever rows hold it
    joined = every.groupBy("doc_id", "text_key").agg(F.flatten(F.collect_set("hits")).alias("h"), F.flatten(F.collect_set("items")).alias("i"))
    joined = joined.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), F.array_sort(F.array_distinct("h")).alias("hits"), F.array_sort(F.array_distinct("i")).alias("items"))
    rows = passes[0].select("doc_id", "n_words", "text_key")
    found = rows.join(joined, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left")
    blank = dict(passes[0].select("hits", "items").dtypes)
    return found.select("doc_id", "n_words", *[F.coalesce(c, F.array().cast(blank[c])).alias(c) for c in ("hits", "items")])
