"""Token counts by finite-state tokenizer compilation.

Two deterministic transducers are compiled from a byte-level BPE tokenizer file.

* The *splitter* reads characters' classes and emits pre-token boundaries. A stream of texts is
  cut into chunks; the chunk's state map (where each state leads) is found for all chunks at
  once, the maps are composed by a parallel prefix scan, and from the then known entry states
  all chunks emit their boundaries at once.
* The *counter* reads the bytes of one pre-token; each transition carries the number of tokens
  that the encoding of the text read so far gains by the byte (it may be negative: a merge). Its
  states are determinised on demand: a state is the tail of the text that may still become part
  of a token, with the last token and the relative count at each place in the tail. This is
  enough, since a BPE encoding is the one sequence of tokens whose neighbours all are compatible
  (two tokens are if encoding their joint bytes gives the two back): the encoding up to a place
  ends in the one token that is compatible with the encoding up to its beginning. States are a
  cache: beyond ``MOST_STATES`` it is emptied and built anew, with the same counts.

Strings of added special tokens count one each and end the text before them, as the library's
default. One pass of map tasks, no shuffle.

Defined results: a null text is empty (0 bytes, 0 tokens, within any limit); repeated rows each
get their row; no rows give no rows. Only the id and text columns are read. Bytes that are not
UTF-8 are replaced by U+FFFD first (``n_bytes`` counts the replaced text).
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.bpe import BLANK, LETTER, NUMBER, OTHER, classes, clean_utf8, code_points
from carelens.llm.common import distinct_segments, runs, tidy

MOST_STATES = 400_000
#: Characters of a chunk of the splitter.
CHUNK = 256

# symbols of the splitter: the classes, with what contractions need told apart
S_LETTER, S_NUMBER, S_OTHER, S_BLANK, S_SPACE, S_QUOTE, S_ST, S_R, S_V, S_E, S_L, S_END = range(12)
# its states
(START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ONE_BLANK, MORE_BLANK, ONE_SPACE, MORE_SPACE, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L) = range(12)
HERE, BEFORE = 1, 2  # a pre-token begins at this character, or at the one before


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and emitted boundaries, by (symbol, state)."""
    letters = (S_LETTER, S_ST, S_R, S_V, S_E, S_L)
    run_of = dict.fromkeys(letters, IN_LETTERS) | {S_NUMBER: IN_NUMBERS, S_OTHER: IN_OTHERS, S_QUOTE: IN_OTHERS}
    nxt, out = np.zeros((12, 12), np.uint8), np.zeros((12, 12), np.uint8)
    for state in range(12):
        for symbol in range(12):
            if symbol == S_END:
                nxt[symbol, state], out[symbol, state] = START, BEFORE if state in (QUOTE_R, QUOTE_V, QUOTE_L) else 0
                continue
            pending = BEFORE if state in (QUOTE_R, QUOTE_V, QUOTE_L) else 0  # the letter began a run after all
            run = IN_LETTERS if pending else IN_OTHERS if state == QUOTE else state
            if symbol in (S_BLANK, S_SPACE):
                more = state in (ONE_BLANK, MORE_BLANK, ONE_SPACE, MORE_SPACE)
                nxt[symbol, state] = (MORE_BLANK if more else ONE_BLANK) if symbol == S_BLANK else (MORE_SPACE if more else ONE_SPACE)
                out[symbol, state] = pending | (0 if more else HERE)
            elif state == QUOTE and symbol in (S_ST, S_R, S_V, S_L):
                nxt[symbol, state] = {S_ST: START, S_R: QUOTE_R, S_V: QUOTE_V, S_L: QUOTE_L}[symbol]
            elif (state, symbol) in ((QUOTE_R, S_E), (QUOTE_V, S_E), (QUOTE_L, S_L)):
                nxt[symbol, state] = START
            else:
                goal = run_of[symbol]
                if state in (ONE_BLANK, MORE_BLANK):
                    emit = BEFORE if state == MORE_BLANK else 0  # the last blank joins what follows
                elif state in (ONE_SPACE, MORE_SPACE):
                    emit = HERE | (BEFORE if state == MORE_SPACE else 0)
                else:
                    emit = pending | (0 if run == goal else HERE)
                fresh = symbol == S_QUOTE and emit & HERE
                nxt[symbol, state], out[symbol, state] = QUOTE if fresh else goal, emit
    return nxt, out


NEXT, EMIT = _splitter()


@lru_cache(maxsize=1)
def symbols() -> np.ndarray:
    """The splitter's symbol of every code point; one more for the end of a text."""
    kind = classes()
    out = np.full(len(kind) + 1, S_SPACE, np.uint8)
    for a, b in ((LETTER, S_LETTER), (NUMBER, S_NUMBER), (OTHER, S_OTHER), (BLANK, S_BLANK)):
        out[:-1][kind == a] = b
    for chars, s in (("'", S_QUOTE), ("stmd", S_ST), ("r", S_R), ("v", S_V), ("e", S_E), ("l", S_L)):
        out[[ord(c) for c in chars]] = s
    out[-1] = S_END
    return out


def boundaries(stream: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Which places of a stream of symbols begin a pre-token."""
    n = len(stream)
    lanes = -(-n // chunk)
    grid = np.full(lanes * chunk, S_END, np.uint8)
    grid[:n] = stream
    grid = np.ascontiguousarray(grid.reshape(lanes, chunk).T)  # one row per step
    maps = np.tile(np.arange(12, dtype=np.uint8), (lanes, 1))
    for step in grid:
        maps = NEXT[step[:, None], maps]
    # inclusive prefix scan: after it, maps[i] leads through chunks 0..i
    width = 1
    while width < lanes:
        maps[width:] = np.take_along_axis(maps[width:], maps[:-width].copy(), 1)
        width *= 2
    state = np.append(np.uint8(START), maps[:-1, START])
    emitted = np.empty_like(grid)
    for at, step in enumerate(grid):
        emitted[at] = EMIT[step, state]
        state = NEXT[step, state]
    emitted = emitted.T.ravel()
    begins = (emitted & HERE) > 0
    begins[:-1] |= (emitted[1:] & BEFORE) > 0
    return begins[:n]


class Counter:
    """The counting transducer of a BPE model, determinised on demand."""

    def __init__(self, model: dict, byte_of: dict[str, int]):
        to_bytes = lambda token: bytes(byte_of[c] for c in token)
        self.ids = {to_bytes(t): i for t, i in model["vocab"].items() if all(c in byte_of for c in t)}
        self.tokens = {i: t for t, i in self.ids.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = model["vocab"]
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.prefixes = {t[:k] for t in self.ids for k in range(1, len(t))}
        self.compatible_pairs: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        #: a state's key: its tail and, for each place in the tail from which a token may still
        #: begin, (bytes back from the end, last token there, tokens there less tokens here)
        self.states: list[bytes] = [self._key(b"", [(0, -1, 0)])]
        self.numbers = {self.states[0]: 0}
        #: state << 8 | byte -> next state << 8 | tokens gained + 128
        self.arcs: dict[int, int] = {}

    @staticmethod
    def _key(tail: bytes, places: list[tuple[int, int, int]]) -> bytes:
        return bytes([len(tail) >> 8, len(tail) & 255]) + tail + array("i", [x for p in places for x in p]).tobytes()

    @staticmethod
    def _open(key: bytes) -> tuple[bytes, list[tuple[int, int, int]]]:
        size = key[0] << 8 | key[1]
        flat = iter(array("i", key[2 + size :]))
        return key[2 : 2 + size], list(zip(flat, flat, flat, strict=True))

    def encode(self, data: bytes) -> list[int]:
        ids = [self.ids[data[i : i + 1]] for i in range(len(data))]
        while len(ids) > 1:
            best = min((self.merges.get(p, (1 << 40, -1)) for p in zip(ids, ids[1:], strict=False)))
            if best[1] < 0:
                break
            out, i = [], 0
            while i < len(ids):
                if i + 1 < len(ids) and self.merges.get((ids[i], ids[i + 1])) == best:
                    out.append(best[1])
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def compatible(self, a: int, b: int) -> bool:
        key = (a + 1) << 32 | b
        if (known := self.compatible_pairs.get(key)) is None:
            if len(self.compatible_pairs) > MOST_STATES:
                self.compatible_pairs.clear()
            want = [b] if a < 0 else [a, b]
            known = self.compatible_pairs[key] = self.encode(b"".join(self.tokens[x] for x in want)) == want
        return known

    def arc(self, state: int, byte: int) -> int:
        """Builds the transition of a state on a byte."""
        tail, places = self._open(self.states[state])
        text = tail + bytes([byte])
        for back, last, count in places:
            token = self.ids.get(text[len(tail) - back :])
            if token is not None and self.compatible(last, token):
                gained = count + 1
                break
        else:
            raise ValueError("the vocabulary does not cover every byte")
        kept = [(back + 1, last, count - gained) for back, last, count in places if text[len(tail) - back :] in self.prefixes]
        cut = kept[0][0] if kept else 0
        new = self._key(text[len(text) - cut :], [*kept, (0, token, 0)])
        number = self.numbers.get(new)
        if number is None:
            number = self.numbers[new] = len(self.states)
            self.states.append(new)
        value = self.arcs[state << 8 | byte] = number << 8 | gained + 128
        return value

    def counts(self, pieces: list[bytes]) -> list[int]:
        """The number of tokens of each piece."""
        if len(self.states) > MOST_STATES:
            self.reset()
        get, out = self.arcs.get, []
        for piece in pieces:
            state = total = 0
            for byte in piece:
                value = get(state << 8 | byte)
                if value is None:
                    value = self.arc(state, byte)
                state = value >> 8
                total += (value & 255) - 128
            out.append(total)
        return out


def byte_letters() -> dict[str, int]:
    """The character that a byte-level vocabulary file writes for each byte: printable Latin-1
    as it is, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    return out | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}


@lru_cache(maxsize=2)
def compiled(data: bytes) -> tuple[Counter, list[bytes]]:
    """The counter and the added special tokens of a tokenizer file."""
    spec = json.loads(data)
    pre = spec["pre_tokenizer"]
    if spec["model"]["type"] != "BPE" or not pre or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]:
        raise ValueError("a byte-level BPE tokenizer without normalizer is needed")
    return Counter(spec["model"], byte_letters()), [t["content"].encode() for t in spec["added_tokens"] if t["special"]]


def count_tokens(data: bytes, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The number of tokens of each text."""
    counter, special = compiled(data)
    raw = buf.tobytes()
    n = len(offs) - 1
    lead = np.flatnonzero((buf & 0xC0) != 0x80)
    char_offs = np.searchsorted(lead, offs)
    # the stream: each text's characters, then one end
    place = np.arange(len(lead)) + np.repeat(np.arange(n), np.diff(char_offs))
    stream = np.full(len(lead) + n, S_END, np.uint8)
    stream[place] = symbols()[code_points(raw)]
    total = np.zeros(n, np.int64)
    for name in special:
        at = raw.find(name)
        while at >= 0:
            row = int(np.searchsorted(offs, at, "right")) - 1
            if at + len(name) <= offs[row + 1]:
                total[row] += 1
                a, b = np.searchsorted(lead, [at, at + len(name)])
                stream[place[a:b]] = S_END
                at = raw.find(name, at + len(name))
            else:
                at = raw.find(name, at + 1)
    begins = boundaries(stream)
    solid = stream != S_END
    ends = solid & np.append(begins[1:] | ~solid[1:], True)[: len(solid)]
    byte_at = np.zeros(len(stream) + 1, np.int64)
    byte_at[place] = lead
    width = np.zeros(len(stream), np.int64)
    width[place] = np.diff(np.append(lead, len(buf)))
    starts, last = np.flatnonzero(begins & solid), np.flatnonzero(ends)
    a, b = byte_at[starts], byte_at[last] + width[last]
    if len(a):
        first, which = distinct_segments(buf, a, b)
        each = counter.counts([raw[i:j] for i, j in zip(a[first].tolist(), b[first].tolist(), strict=True)])
        row = np.searchsorted(offs, a, "right") - 1
        total += np.bincount(row, np.array(each)[which], n).astype(np.int64)
    return total


def token_counts(docs: DataFrame, tokenizer: bytes, doc_id: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per document; ``tokenizer``: a tokenizer file's content."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = clean_utf8(batch.column(1))
            for i, j in runs(offs):
                count = count_tokens(tokenizer, buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.diff(offs[i : j + 1])), pa.array(count), pa.array(count > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    columns = docs.select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`").cast("string"))
    return columns.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
