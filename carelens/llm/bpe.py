"""Byte-level BPE: overlapping chunk encoding, and decoding.

A text is cut into chunks of ``CHUNK`` characters that overlap by ``OVERLAP``. Every chunk is
split into pre-tokens on its own, from its first character, as if a text began there, and its
pre-tokens are encoded. Neighbours are stitched at the first position of their overlap where
both have a pre-token boundary: the pattern looks ahead only, so from a common boundary on both
splits agree. Where an overlap has no common boundary (a run longer than the overlap) the
chunks are joined and split again. Short texts are one chunk and are encoded where they are;
chunks of long texts are dealt out over tasks, and only their results meet per document.

The pre-tokens of the byte-level pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

depend on neighbouring characters' classes only, so numpy finds all boundaries of a run of texts
at once. Each distinct pre-token is encoded once per run: repeatedly the leftmost adjacent pair
of lowest rank is merged. Decoding concatenates the tokens' raw bytes.

Defined results: a null text is an empty text, with no ids and the digests of nothing; repeated
rows each get their row; no rows give no rows. Only the id and text columns are read. Bytes that
are not UTF-8 are replaced by U+FFFD first.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import distinct_segments, runs, text_buffer, tidy

CHUNK = 32768
OVERLAP = 256
#: Characters that a boundary may depend on beyond itself (a contraction is three long).
LOOK = 4
#: Text bytes that are encoded at a time: the arrays for them take some hundred bytes per byte.
ENCODE_BYTES = 1 << 19
#: Pieces longer than this are merged with a heap, one by one.
SHORT = 48
LETTER, NUMBER, OTHER, BLANK, SPACE = range(5)
NONE = np.int64(1) << 40


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point, as the regex library sees it."""
    out = np.full(0x110000, OTHER, np.uint8)
    for begin in range(0, 0x110000, 2048):  # a block of characters in memory at a time
        if 0xD800 <= begin < 0xE000:
            continue
        text = "".join(map(chr, range(begin, begin + 2048)))
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for m in regex.finditer(pattern, text):
                out[begin + m.start() : begin + m.end()] = kind
    out[32] = BLANK
    return out


def code_points(data: bytes) -> np.ndarray:
    return np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)


def pretoken_starts(cp: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Which characters begin a pre-token; texts begin at ``offs`` (the last is the end)."""
    n = len(cp)
    kind = classes()[cp]
    gap = kind >= BLANK
    new = np.zeros(n + 1, bool)
    new[offs] = True
    begins = new[:n].copy()
    prev, prev_gap = np.empty(n, np.uint8), np.zeros(n, bool)
    prev[1:], prev_gap[1:] = kind[:-1], gap[:-1]
    prev[begins] = 255
    prev_gap[begins] = False
    next_solid = np.zeros(n, bool)
    next_solid[:-1] = ~gap[1:]
    next_solid &= ~new[1:]
    start = np.where(gap, ~prev_gap | next_solid, (prev != BLANK) & (prev != kind))
    start |= begins
    quote = np.flatnonzero((cp == 39) & (prev != OTHER) & (prev != BLANK))
    if len(quote):
        end_of = offs[np.searchsorted(offs, quote, "right")]
        one = cp[np.minimum(quote + 1, n - 1)]
        two = cp[np.minimum(quote + 2, n - 1)]
        fits1, fits2 = quote + 1 < end_of, quote + 2 < end_of
        single = fits1 & np.isin(one, [ord(c) for c in "stmd"])
        double = fits2 & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
        size = np.where(single, 2, np.where(double, 3, 0))
        quote, size, end_of = quote[size > 0], size[size > 0], end_of[size > 0]
        start[quote + 1] = False
        after = quote + size
        start[after[after < end_of]] = True
    return start


class Ranks:
    """A rank file: tokens by id, and what each pair of adjacent tokens merges into."""

    def __init__(self, data: bytes):
        lines = (line.split() for line in data.splitlines() if line)
        self.rank = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.tokens: dict[int, bytes] = {r: t for t, r in self.rank.items()}
        size = max(self.tokens) + 1
        self.byte_ids = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        get = self.rank.get
        pairs = array("q")  # (pair, what it merges into), flat
        for t, r in self.rank.items():
            for k in range(1, len(t)):
                if (a := get(t[:k])) is not None and (b := get(t[k:])) is not None:
                    pairs.extend(((a << 32) | b, r))
        flat = np.array(pairs, np.int64).reshape(-1, 2)
        flat = flat[np.lexsort((flat[:, 1], flat[:, 0]))]
        keys, self.merged = flat[:, 0], flat[:, 1].copy()
        self.slots = 1 << (4 * len(keys) - 1).bit_length()
        self.table_key = np.full(self.slots + 64, -1, np.int64)
        self.table_value = np.full(self.slots + 64, NONE, np.int64)
        for i in range(0, len(keys), 1 << 14):
            here = keys[i : i + (1 << 14)]
            for key, value, slot in zip(here.tolist(), self.merged[i : i + (1 << 14)].tolist(), self._slot(here).tolist(), strict=True):
                while self.table_key[slot] != -1:
                    slot += 1
                self.table_key[slot], self.table_value[slot] = key, value
        self.lengths = np.zeros(size, np.int64)
        for r, t in self.tokens.items():
            self.lengths[r] = len(t)
        self.begins = np.append(0, np.cumsum(self.lengths))
        self.bytes = np.frombuffer(b"".join(self.tokens.get(r, b"") for r in range(size)), np.uint8)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.slots.bit_length() + 1)).astype(np.int64)

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token of each adjacent pair, NONE where there is none."""
        keys = (a << 32) | b
        slot = self._slot(keys)
        found = self.table_key[slot]
        out = np.where(found == keys, self.table_value[slot], NONE)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while len(open_):
            slot[open_] += 1
            found = self.table_key[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.table_value[slot[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out

    def encode_long(self, piece: bytes) -> list[int]:
        """One piece, by a heap of pairs (rank, place) over a linked list of tokens."""
        if (whole := self.rank.get(piece)) is not None:
            return [whole]
        size = len(piece)
        token = [self.rank[piece[i : i + 1]] for i in range(size)]
        width = [1] * size  # 0: merged into a token to its left
        before = list(range(-1, size - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            j = i + width[i]
            if j < size and (r := self.rank.get(piece[i : j + width[j]])) is not None:
                heapq.heappush(heap, (r, i, j + width[j]))

        for i in range(size - 1):
            offer(i)
        while heap:
            r, i, stop = heapq.heappop(heap)
            j = i + width[i]
            if not width[i] or j >= size or j + width[j] != stop:
                continue  # one of the two has been merged meanwhile
            width[i], width[j], token[i] = stop - i, 0, r
            if stop < size:
                before[stop] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [token[i] for i in range(size) if width[i]]

    def encode_pieces(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces buf[start:end], and how many each has."""
        size = ends - starts
        counts = np.zeros(len(size), np.int64)
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # (piece of each row, its ids, how many)
        by = np.argsort(size, kind="stable")
        edges = np.flatnonzero(np.append(True, np.diff(size[by]) > 0))
        for at, stop in zip(edges, np.append(edges[1:], len(by)), strict=True):
            n, rows = int(size[by[at]]) if len(by) else 0, by[at:stop]
            if n == 0:
                continue
            if n > SHORT:
                for p in rows.tolist():
                    ids = np.array(self.encode_long(buf[starts[p] : ends[p]].tobytes()), np.int64)
                    done.append((np.array([p]), ids[None, :], np.array([len(ids)])))
                continue
            for i in range(0, len(rows), 1 << 15):
                done += self._encode_equal(buf, starts, rows[i : i + (1 << 15)], n)
        for rows, _, k in done:
            counts[rows] = k
        offs = np.append(0, np.cumsum(counts))
        out = np.zeros(offs[-1], np.int64)
        for rows, ids, k in done:
            inside = np.arange(ids.shape[1])[None, :] < k[:, None]
            out[(offs[rows][:, None] + np.arange(ids.shape[1])[None, :])[inside]] = ids[inside]
        return out, counts

    def _encode_equal(self, buf: np.ndarray, starts: np.ndarray, rows: np.ndarray, n: int) -> list:
        """Pieces of ``n`` bytes each: one merge per piece and round."""
        token = self.byte_ids[buf[starts[rows][:, None] + np.arange(n)[None, :]]]
        if n == 1:
            return [(rows, token, np.ones(len(rows), np.int64))]
        rank = self.merge(token[:, :-1].ravel(), token[:, 1:].ravel()).reshape(len(rows), n - 1)
        done = []
        for width in range(n, 0, -1):
            place = rank.argmin(1) if width > 1 else np.zeros(len(rows), np.int64)
            best = rank[np.arange(len(rows)), place] if width > 1 else np.full(len(rows), NONE)
            over = best == NONE
            if over.any():
                done.append((rows[over], token[over], np.full(int(over.sum()), width)))
                rows, token, rank, place, best = rows[~over], token[~over], rank[~over], place[~over], best[~over]
            if not len(rows):
                break
            every = np.arange(len(rows))
            token[every, place] = best
            shift = np.arange(width - 1)[None, :]
            token = np.take_along_axis(token, shift + (shift > place[:, None]), 1)
            rank = np.take_along_axis(rank, shift[:, : width - 2] + (shift[:, : width - 2] >= place[:, None]), 1)
            left = place > 0
            rank[every[left], place[left] - 1] = self.merge(token[every[left], place[left] - 1], token[every[left], place[left]])
            right = place < width - 2
            rank[every[right], place[right]] = self.merge(token[every[right], place[right]], token[every[right], place[right] + 1])
        return done

    def encode(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode_pieces``, each distinct piece once."""
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        first, which = distinct_segments(buf, starts, ends)
        ids, counts = self.encode_pieces(buf, starts[first], ends[first])
        offs = np.append(0, np.cumsum(counts))
        n = counts[which]
        return ids[_spread(offs[which], n)], n

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[_spread(self.begins[ids], self.lengths[ids])]


def _spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... (size of them) for each pair, in one array."""
    total = np.append(0, np.cumsum(sizes))
    return np.repeat(begins - total[:-1], sizes) + np.arange(total[-1])


@lru_cache(maxsize=4)
def ranks_of(data: bytes) -> Ranks:
    return Ranks(data)


def split_and_encode(ranks: Ranks, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts -> (first byte of each pre-token, each text's first pre-token, all ids, ids of each pre-token)."""
    lead = np.flatnonzero((buf & 0xC0) != 0x80)
    char_offs = np.searchsorted(lead, offs)
    starts = lead[pretoken_starts(code_points(buf.tobytes()), char_offs)] if len(buf) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(buf))[: len(starts)]
    ids, counts = ranks.encode(buf, starts, ends)
    return starts, np.searchsorted(starts, offs), ids, counts


def clean_utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``text_buffer`` with bytes that are not UTF-8 replaced by U+FFFD."""
    buf, offs = text_buffer(column)
    try:
        for i, j in runs(offs):  # decoded by pieces: a character may take four bytes in memory
            buf[offs[i] : offs[j]].tobytes().decode("utf-8")
    except UnicodeDecodeError:
        texts = [buf[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offs[:-1], offs[1:], strict=True)]
        return text_buffer(pa.array(texts))
    return buf, offs


def digests(ranks: Ranks, ids: np.ndarray) -> tuple[int, str, str]:
    """How many ids, the SHA-256 of the ids (little-endian, 32 bits) and of the decoded bytes."""
    return len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(ranks.decode(ids).tobytes()).hexdigest()


SCHEMA = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def _short(data: bytes, with_ids: bool):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of(data)
        for batch in batches:
            buf, offs = clean_utf8(batch.column(1))
            for i, j in runs(offs, ENCODE_BYTES):
                here = offs[i : j + 1] - offs[i]
                _, first, ids, counts = split_and_encode(ranks, buf[offs[i] : offs[j]], here)
                at = np.append(0, np.cumsum(counts))[first]
                rows = [digests(ranks, ids[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
                out = [batch.column(0).slice(i, j - i), *[pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string()), strict=True)]]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    return run


def _chunks(chunk: int, overlap: int):
    """(doc_id, text) -> one row per chunk, with a key that tells the texts apart."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = clean_utf8(batch.column(1))
            for i in range(batch.num_rows):
                text = buf[offs[i] : offs[i + 1]]
                lead = np.append(np.flatnonzero((text & 0xC0) != 0x80), len(text))
                key = hashlib.sha256(text.tobytes()).hexdigest()
                for k, s in enumerate(range(0, len(lead) - 1, chunk)):
                    stop = min(s + chunk + overlap, len(lead) - 1)
                    part = text[lead[s] : lead[stop]].tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(i, 1), pa.array([key]), pa.array([k], pa.int32()), pa.array([stop == len(lead) - 1]), pa.array([part], pa.binary())],
                        ["doc_id", "text_key", "chunk_no", "closes", "part"],
                    )

    return run


class Chunk:
    """One chunk's pre-token boundaries (character numbers in the text) and ids."""

    def __init__(self, ranks: Ranks, begin: int, part: bytes, closes: bool):
        buf = np.frombuffer(part, np.uint8)
        starts, _, self.ids, counts = split_and_encode(ranks, buf, np.array([0, len(buf)]))
        lead = np.flatnonzero((buf & 0xC0) != 0x80)
        self.begin, self.part, self.closes = begin, part, closes
        self.chars = len(lead)
        self.bounds = begin + np.searchsorted(lead, starts)
        self.at = np.append(0, np.cumsum(counts))

    def sure(self) -> np.ndarray:
        """Boundaries that what follows the chunk cannot change."""
        return self.bounds if self.closes else self.bounds[self.bounds < self.begin + self.chars - LOOK]


def stitch(ranks: Ranks, parts: list[Chunk]) -> np.ndarray:
    """The ids of a text from its chunks, in order."""
    out: list[np.ndarray] = []
    current, begin = parts[0], parts[0].begin
    for nxt in parts[1:]:
        common = np.intersect1d(current.sure()[current.sure() >= max(begin, nxt.begin)], nxt.sure())
        if len(common):
            p = common[0]
            out.append(current.ids[current.at[np.searchsorted(current.bounds, begin)] : current.at[np.searchsorted(current.bounds, p)]])
            current, begin = nxt, p
        else:  # no common boundary: both in one, from the last sure boundary of the first
            lead = np.flatnonzero((np.frombuffer(current.part, np.uint8) & 0xC0) != 0x80)
            known = current.sure()[current.sure() >= begin]
            last = int(known[-1]) if len(known) else begin
            out.append(current.ids[current.at[np.searchsorted(current.bounds, begin)] : current.at[np.searchsorted(current.bounds, last)]])
            joined = current.part[lead[last - current.begin] : lead[nxt.begin - current.begin]] if nxt.begin > last else b""
            rest = nxt.part if nxt.begin >= last else nxt.part[np.flatnonzero((np.frombuffer(nxt.part, np.uint8) & 0xC0) != 0x80)[last - nxt.begin] :]
            current, begin = Chunk(ranks, last, joined + rest, nxt.closes), last
    out.append(current.ids[current.at[np.searchsorted(current.bounds, begin)] :])
    return np.concatenate(out)


def encode_documents(
    docs: DataFrame, rank_file: bytes, doc_id: str = "doc_id", text: str = "text",
    chunk: int = CHUNK, overlap: int = OVERLAP, with_ids: bool = False,
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) per document.

    ``rank_file`` is the content of a rank file (under a megabyte, it travels with the tasks)."""
    columns = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    schema = f"doc_id long, {SCHEMA}" + ", ids array<int>" * with_ids
    short = columns.where(F.octet_length("text") <= chunk).mapInArrow(_short(rank_file, with_ids), schema)
    chunks = columns.where(F.octet_length("text") > chunk).mapInArrow(_chunks(chunk, overlap), "doc_id long, text_key string, chunk_no int, closes boolean, part binary")

    @tidy
    def encode_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of(rank_file)
        for batch in (whole.slice(i, j - i) for whole in batches for i, j in runs(text_buffer(whole.column(4))[1], ENCODE_BYTES)):
            no, closes = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            found = [Chunk(ranks, n * chunk, p.as_buffer().to_pybytes(), c) for n, p, c in zip(no, batch.column(4), closes, strict=True)]
            as_bytes = [pa.array([x.astype(kind).tobytes() for x in data], pa.binary()) for data, kind in (([f.ids for f in found], "<u4"), ([f.at for f in found], "<u4"), ([f.bounds - f.begin for f in found], "<u4"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *as_bytes], [*batch.schema.names, "ids", "at", "bounds"])

    dealt = chunks.repartition(F.col("doc_id"), F.col("text_key"), F.col("chunk_no"))
    encoded = dealt.mapInArrow(encode_chunks, "doc_id long, text_key string, chunk_no int, closes boolean, part binary, ids binary, at binary, bounds binary")

    @tidy
    def join(group: pd.DataFrame) -> pd.DataFrame:
        ranks = ranks_of(rank_file)
        copies = int((group["chunk_no"] == 0).sum())  # rows with one id and text
        parts = []
        for r in group.sort_values("chunk_no").drop_duplicates("chunk_no").itertuples():
            c = Chunk.__new__(Chunk)
            c.begin, c.part, c.closes = r.chunk_no * chunk, r.part, r.closes
            c.ids, c.at, c.bounds = (np.frombuffer(x, "<u4").astype(np.int64) for x in (r.ids, r.at, r.bounds))
            c.bounds = c.bounds + c.begin
            c.chars = int(((np.frombuffer(r.part, np.uint8) & 0xC0) != 0x80).sum())
            parts.append(c)
        ids = stitch(ranks, parts)
        n, a, b = digests(ranks, ids)
        out = pd.DataFrame({"doc_id": group["doc_id"].iloc[:copies], "n_tokens": n, "ids_sha256": a, "decoded_sha256": b})
        if with_ids:
            out["ids"] = [ids.astype(np.int32)] * copies
        return out

    return short.unionByName(encoded.groupBy("doc_id", "text_key").applyInPandas(join, schema))


def decode_documents(encoded: DataFrame, rank_file: bytes, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, bytes binary) from rows with an array of ids; a null array gives no bytes."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of(rank_file)
        for batch in batches:
            data = [ranks.decode(np.array(x or [], np.int64)).tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "bytes"])

    return encoded.select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{ids}`")).mapInArrow(run, "doc_id long, bytes binary")
