"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprint: lower-cased words, shingles of ``shingle`` words (repeats included), XXH64 (seed 42)
of each; a bit is 1 if it is set in over half the hashes. Two fingerprints within ``distance``
bits have a middle: some value within half of it, rounded up, from both. So every distinct
fingerprint emits all values in that ball, and those that meet on a value are close.

The variants are shuffled by their leading bits and only there written out in full: a
fingerprint goes to each prefix that its ball reaches (the prefix with up to r bits flipped),
and inside the prefix the remaining flips are applied to the low bits; a prefix far above the mean
is worked through in rounds by further bits of the variants. A fingerprint is so sent
a few dozen times, not 2,081 times, and no variant is left out. All that meet on one value are
linked to the smallest of them, never pair by pair; each such link is verified by its bit
distance, and links are deduplicated before they leave the task. With an odd ``distance``, or
where verification refuses the link to the smallest, the members are verified one with another.

Components are found over distinct fingerprints, by rounds of joins (large star, small star)
whose tables are written to the shared folder; copies never multiply links.

Defined results: null and blank texts have fingerprint zero and are linked like any other;
repeated rows and ids share a component; a component without a non-null id has a null id; no
rows give no rows. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import LOWER, runs, text_buffer, tidy, words, written

#: Variants that a task holds at a time (they are sorted in memory), as a mean over prefixes.
TASK_VARIANTS = 2_000_000
#: Text bytes whose shingles are hashed at a time.
STEP = 1 << 19
#: Variants that a task writes out at a time, whatever its prefix holds.
HELD_VARIANTS = 4_000_000
#: Shingle hashes whose bits are counted at a time.
HASHES = 1 << 17


def fingerprints(buf: np.ndarray, offs: np.ndarray, shingle: int, seed: int = 42) -> np.ndarray:
    """One unsigned 64-bit fingerprint per row."""
    buf = LOWER[buf]
    starts, ends, first = words(buf, offs)
    sizes = ends - starts
    # all words once more, each followed by one space: a shingle is then one slice
    place = np.append(0, np.cumsum(sizes + 1))
    joined = np.full(place[-1], 32, np.uint8)
    take = np.arange(int(sizes.sum())) - np.repeat(np.append(0, np.cumsum(sizes))[:-1], sizes)
    joined[np.repeat(place[:-1], sizes) + take] = buf[np.repeat(starts, sizes) + take]
    data, n = joined.tobytes(), np.diff(first)
    per_row = np.where(n == 0, 0, np.maximum(n - shingle + 1, 1))
    at = np.append(0, np.cumsum(per_row))
    begin = np.repeat(first[:-1], per_row) + np.arange(at[-1]) - np.repeat(at[:-1], per_row)
    end = np.minimum(begin + shingle, np.repeat(first[1:], per_row))
    digest = xxhash.xxh64_intdigest
    spans = zip(place[begin].tolist(), (place[end] - 1).tolist(), strict=True)
    h = np.fromiter((digest(data[a:b], seed) for a, b in spans), np.uint64, at[-1])
    counts = np.zeros((len(n), 64), np.int64)
    row = np.repeat(np.arange(len(n)), per_row)
    for i in range(0, len(h), HASHES):
        bits = np.unpackbits(h[i : i + HASHES].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        r = row[i : i + HASHES]
        head = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
        counts[r[head]] += np.add.reduceat(bits, head, axis=0, dtype=np.int32)
    over = (2 * counts > per_row[:, None]).astype(np.uint8)
    return np.packbits(over, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprint_table(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's bits as a signed long."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = text_buffer(batch.column(1))
            parts = [fingerprints(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i], shingle) for i, j in runs(offs, STEP)]
            fp = np.concatenate([*parts, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], ["doc_id", "fp"])

    columns = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string"))
    return columns.mapInArrow(run, "doc_id long, fp long")


@lru_cache(maxsize=256)
def flips(bits: range, most: int) -> np.ndarray:
    """All masks with up to ``most`` of these bits."""
    return np.array([sum(1 << b for b in c) for k in range(most + 1) for c in combinations(bits, k)], np.uint64)


def links_in(fps: np.ndarray, prefix: int, prefix_bits: int, distance: int) -> np.ndarray:
    """Distinct links (a, b), b < a, of fingerprints whose balls meet under one prefix. With more
    than ``HELD_VARIANTS`` variants the prefix is halved by its next bit until they fit; a value
    has one prefix of each length, so fingerprints that meet on it stay together."""
    radius, low = (distance + 1) // 2, 64 - prefix_bits
    spent = np.bitwise_count((fps >> np.uint64(low)) ^ np.uint64(prefix)) if prefix_bits else np.zeros(len(fps), np.uint8)
    fps, spent = fps[spent <= radius], spent[spent <= radius]
    if not len(fps):
        return np.zeros((0, 2), np.uint64)
    each = [sum(comb(low, k) for k in range(radius - used + 1)) for used in range(radius + 1)]
    if low and np.bincount(spent, minlength=radius + 1) @ each > HELD_VARIANTS:
        halves = [links_in(fps, 2 * prefix + bit, prefix_bits + 1, distance) for bit in (0, 1)]
        return np.unique(np.concatenate(halves), axis=0) if all(map(len, halves)) else max(halves, key=len)
    values, owners = [], []
    tail = fps & np.uint64((1 << low) - 1)
    for used in range(radius + 1):
        mine = np.flatnonzero(spent == used)
        if len(mine):
            masks = flips(range(low), radius - used)
            values.append((tail[mine][:, None] ^ masks[None, :]).ravel())
            owners.append(np.repeat(mine.astype(np.int32), len(masks)))
    value, owner = np.concatenate(values), np.concatenate(owners)
    del values, owners
    by = np.argsort(value)
    value, owner = value[by], owner[by]
    head = np.append(True, value[1:] != value[:-1])
    group = np.cumsum(head) - 1
    many = np.bincount(group)[group] > 1
    group, owner = group[many], owner[many]
    if not len(group):
        return np.zeros((0, 2), np.uint64)
    fp = fps[owner]
    begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    least = np.repeat(np.minimum.reduceat(fp, begin), np.diff(np.append(begin, len(group))))
    pairs = np.stack([fp, least], 1)[fp != least]
    near = np.bitwise_count(pairs[:, 0] ^ pairs[:, 1]) <= distance
    refused = ~near
    found = [pairs[near]]
    if refused.any():  # only with an odd distance: members may stand one bit too far apart
        keep = np.isin(group, np.unique(group[fp != least][refused]))
        for members in np.split(fp[keep], np.flatnonzero(np.diff(group[keep])) + 1):
            for k, x in enumerate(members):
                rest = members[k + 1 :]
                y = rest[np.bitwise_count(rest ^ x) <= distance]
                found.append(np.stack([np.maximum(x, y), np.minimum(x, y)], 1))
    return np.unique(np.concatenate(found), axis=0)


def links(distinct: DataFrame, distance: int) -> DataFrame:
    """(a, b) over a table of distinct fingerprints (fp): enough links for all components."""
    n = distinct.count()
    radius = (distance + 1) // 2
    bits = 0
    while n * len(flips(range(64), min(radius, 2))) >> bits > TASK_VARIANTS and bits < 40:
        bits += 1
    masks = F.array(*[F.lit(int(m)) for m in flips(range(bits), radius)])
    prefix = F.shiftrightunsigned("fp", 64 - bits) if bits else F.lit(0).cast("long")
    sent = distinct.select("fp", prefix.alias("own"), F.explode(masks).alias("mask")).select("fp", F.col("own").bitwiseXOR(F.col("mask")).alias("prefix"))

    @tidy
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        found = links_in(np.unique(group["fp"].to_numpy().view(np.uint64)), int(key[0]), bits, distance)
        return pd.DataFrame({"a": found[:, 0].view(np.int64), "b": found[:, 1].view(np.int64)})

    return sent.groupBy("prefix").applyInPandas(run, "a long, b long").distinct()


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(fp, root) for every node; edges (a, b). Rounds of large star and small star until no
    link changes; each node then hangs on its component's smallest member. A star's centre may
    be linked to very many nodes, so all steps are groupings and joins, none collects a
    neighbourhood."""
    current = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "links")
    mark = None
    while True:
        # large star: larger neighbours of every node go to the smallest node next to it
        both = current.unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: smaller neighbours of every node, and the node, go to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        current = written(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        seen = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    return nodes.join(current.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) per document."""
    rows = written(fingerprint_table(docs, doc_id, text, shingle), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(nodes.select("fp"), links(nodes.select("fp"), distance))
    roots = written(roots.join(nodes, "fp"), "roots")
    ids = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = roots.join(ids, "root").select("fp", "component_id")
    return rows.join(labels, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
