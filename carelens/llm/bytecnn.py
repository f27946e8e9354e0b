"""Byte convolutional networks in numpy: language ID and a quality classifier.

A text is a row of fixed-length windows of bytes that overlap by the widest filter less one, so
every byte n-gram of the text lies in a window. Bytes are embedded, filters of several widths
slide over the window, each filter's largest response is kept (max pooling), and a linear layer
with softmax (or, for two classes, one probability) reads them. A text's logits are the mean of
its windows' logits, weighted by the bytes that a window adds.

Training is plain Adam on the driver over a bounded sample: ``per_class`` labelled documents of
each class (by hash order, so reruns agree) and ``windows`` windows of each, evenly spread. The
bound is a parameter; the sample is chosen by Spark, and prediction covers whole texts of all
rows in one pass of map tasks, without a shuffle.

Defined results: see ``identify_language`` and ``score_quality``. No rows give no rows. Only the
named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelens.llm.common import runs, text_buffer, tidy, written

#: Windows that the network reads at a time.
BATCH = 512


@dataclass
class Net:
    """Embedding, filters of ``widths`` bytes (``filters`` of each), max pooling, linear layer."""

    classes: int
    window: int = 256
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    embed: int = 8
    seed: int = 7
    params: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self) -> None:
        rng = np.random.default_rng(self.seed)
        wide, n = max(self.widths), self.filters * len(self.widths)
        self.wide = wide
        # narrower filters are wide ones whose last rows stay zero
        self.mask = np.concatenate([np.repeat((np.arange(wide) < w).astype(np.float32), self.embed)[:, None].repeat(self.filters, 1) for w in self.widths], 1)
        if not self.params:
            self.params = {
                "embed": rng.normal(0, 0.3, (256, self.embed)).astype(np.float32),
                "filter": rng.normal(0, 0.3, (wide * self.embed, n)).astype(np.float32) * self.mask,
                "shift": np.zeros(n, np.float32),
                "out": rng.normal(0, 0.1, (n, self.classes)).astype(np.float32),
                "bias": np.zeros(self.classes, np.float32),
            }

    @property
    def step(self) -> int:
        return self.window - self.wide + 1

    def windows(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All windows of all texts (padded by zeros), the row of each, and the bytes it adds."""
        size = np.diff(offs)
        count = np.maximum(1, -(-np.maximum(size - self.wide + 1, 0) // self.step))
        first = np.append(0, np.cumsum(count))
        row = np.repeat(np.arange(len(size)), count)
        begin = (np.arange(first[-1]) - first[row]) * self.step
        left = size[row] - begin
        padded = np.append(buf, np.zeros(self.window, np.uint8))
        x = padded[(offs[:-1][row] + begin)[:, None] + np.arange(self.window)[None, :]]
        x[np.arange(self.window)[None, :] >= left[:, None]] = 0
        return x, row, np.clip(left, 1, self.step)

    def _patches(self, x: np.ndarray) -> np.ndarray:
        e = self.params["embed"][x]
        return np.lib.stride_tricks.sliding_window_view(e.reshape(len(x), -1), self.wide * self.embed, 1)[:, :: self.embed]

    def pooled(self, x: np.ndarray, places: bool = False):
        p = self._patches(x)
        n, steps, size = p.shape
        response = (np.ascontiguousarray(p).reshape(-1, size) @ self.params["filter"]).reshape(n, steps, -1)
        if places:
            at = response.argmax(1)
            return np.maximum(np.take_along_axis(response, at[:, None], 1)[:, 0] + self.params["shift"], 0), at
        return np.maximum(response.max(1) + self.params["shift"], 0)

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = [self.pooled(x[i : i + BATCH]) @ self.params["out"] + self.params["bias"] for i in range(0, len(x), BATCH)]
        return np.concatenate([*out, np.zeros((0, self.classes), np.float32)])

    def predict(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Class probabilities of each text."""
        n = len(offs) - 1
        total, weight = np.zeros((n, self.classes)), np.zeros(n)
        for i, j in runs(offs, BATCH * self.window):
            x, row, adds = self.windows(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
            z = self.logits(x)
            np.add.at(total, row + i, z * adds[:, None])
            np.add.at(weight, row + i, adds)
        z = total / np.maximum(weight, 1)[:, None]
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01) -> Net:
        """Adam on the cross-entropy of single windows; only the pooled places carry gradient."""
        rng = np.random.default_rng(self.seed)
        m = {k: np.zeros_like(v) for k, v in self.params.items()}
        v = {k: np.zeros_like(p) for k, p in self.params.items()}
        t = 0
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(order), batch):
                at = order[i : i + batch]
                grad = self._gradient(x[at], y[at], weight[at])
                t += 1
                speed = rate * (1 - epoch / epochs)
                for k, g in grad.items():
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.001 * (g * g - v[k])
                    self.params[k] -= (speed * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
                self.params["filter"] *= self.mask
        return self

    def _gradient(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        n = len(x)
        pooled, at = self.pooled(x, places=True)
        z = pooled @ self.params["out"] + self.params["bias"]
        z = np.exp(z - z.max(1, keepdims=True))
        z /= z.sum(1, keepdims=True)
        z[np.arange(n), y] -= 1
        z *= (weight / n)[:, None]
        back = (z @ self.params["out"].T) * (pooled > 0)
        bytes_ = x[np.arange(n)[:, None, None], at[:, :, None] + np.arange(self.wide)]  # n, filters, wide
        patch = self.params["embed"][bytes_].reshape(n, at.shape[1], -1)
        grad_filter = np.einsum("nfe,nf->ef", patch, back) * self.mask
        to_embed = back[:, :, None] * (self.params["filter"] * self.mask).T[None]
        grad_embed = np.zeros_like(self.params["embed"])
        np.add.at(grad_embed, bytes_.ravel(), to_embed.reshape(-1, self.embed))
        return {"embed": grad_embed, "filter": grad_filter, "shift": back.sum(0), "out": pooled.T @ z, "bias": z.sum(0)}


def _sample(rows: DataFrame, per_class: int) -> tuple[DataFrame, dict[str, int]]:
    """The sizes of the classes, and up to ``per_class`` rows of each class, in the order of a hash of
    all their columns; rows that repeat another in all columns teach once. rows: id, class and others.

    The classes are the network's last layer, so their table is small enough for the driver. A cut
    by hash keeps about twice what is wanted before any class is put in order; it is set by the
    number of different rows, so a class whose rows repeat is not cut away."""
    others = [c for c in rows.columns if c != "class"]
    rows = rows.withColumn("order", F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in others], F.lit(11)))
    sizes = rows.groupBy("class").agg(F.count("*").alias("n"), F.approx_count_distinct("order", 0.02).alias("d")).collect()
    counts = {r["class"]: r["n"] for r in sizes}
    if not counts:
        return rows.limit(0), counts
    part = {r["class"]: min(1.0, (2 * per_class + 100) / r["d"]) for r in sizes}
    wanted = F.map_from_arrays(F.array(*map(F.lit, part)), F.array(*map(F.lit, part.values())))
    rows = rows.where(F.pmod(F.col("order"), F.lit(1 << 20)) / float(1 << 20) <= wanted[F.col("class")])
    rows = rows.groupBy("class", "order").agg(F.min(F.struct(*others)).alias("row")).select("class", "order", "row.*")
    nth = F.row_number().over(Window.partitionBy("class").orderBy("order"))
    return rows.withColumn("nth", nth).where(F.col("nth") <= per_class).drop("nth"), counts


def training_windows(rows: DataFrame, net: Net, windows: int) -> tuple[np.ndarray, list[str]]:
    """Up to ``windows`` windows of each sampled row, brought to the driver, with their classes."""
    size = net.window

    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = text_buffer(batch.column(1))
            x, row, _ = net.windows(buf, offs)
            first = np.searchsorted(row, np.arange(len(offs)))
            for i in range(batch.num_rows):
                n = first[i + 1] - first[i]
                take = first[i] + np.unique(np.linspace(0, n - 1, min(n, windows)).astype(int))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[i].as_py()] * len(take), pa.string()), pa.array([batch.column(2)[i].as_py()] * len(take), pa.int64()), pa.array([x[k].tobytes() for k in take], pa.binary())],
                    ["class", "order", "window"],
                )

    found = rows.select("class", "text", "order").mapInArrow(cut, "class string, order long, window binary").toPandas()
    found = found.sort_values(["class", "order", "window"])
    x = np.frombuffer(b"".join(found["window"]), np.uint8).reshape(-1, size)
    return x, found["class"].tolist()


def train(rows: DataFrame, net_of, windows: int, prior: dict[str, int] | None = None) -> tuple[Net | None, list[str]]:
    """A network for the classes found in rows (text, class, order), and the classes in order.
    Every window is read twice, the second time cut to a random length: texts may be short.
    Classes weigh alike in training; ``prior``, their true sizes, then moves the last layer."""
    x, labels = training_windows(rows, net_of(2), windows)
    names = sorted(set(labels))
    if not names:
        return None, names
    y = np.tile([names.index(c) for c in labels], 2)
    size = np.exp(np.random.default_rng(len(x)).uniform(np.log(4), np.log(x.shape[1]), len(x)))
    x = np.concatenate([x, np.where(np.arange(x.shape[1]) < size[:, None], x, 0).astype(np.uint8)])
    share = np.bincount(y, minlength=len(names))
    net = net_of(max(2, len(names))).fit(x, y, (len(y) / (len(names) * share))[y].astype(np.float32))
    if prior:
        net.params["bias"][: len(names)] += np.log([prior[c] for c in names]).astype(np.float32)
    return net, names


def has_letter(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode("utf-8", "replace")))


_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def letters(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Which texts hold a letter of any script."""
    out = np.zeros(len(offs) - 1, bool)
    for i, j in runs(offs):
        total = np.append(0, np.cumsum(_ASCII_LETTER[buf[offs[i] : offs[j]]]))
        at = offs[i : j + 1] - offs[i]
        out[i:j] = total[at[1:]] > total[at[:-1]]
    for i in np.flatnonzero(~out):
        out[i] = has_letter(buf[offs[i] : offs[i + 1]].tobytes())
    return out


def language_net(classes: int) -> Net:
    return Net(classes, window=256, widths=(2, 3, 4), filters=12, embed=6)


def identify_language(
    docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    per_class: int = 500, windows: int = 4, carry: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, besides the ``carry`` columns under their names with
    the prefix carry_) per document.

    ``held_out``: a condition; rows where it is true, or null, teach nothing. A text that is null
    or has no letter is ``und`` with score 0, and so is every text if nothing could be learned.
    The label is read for training only."""
    known = docs.where(~held_out & F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull())
    known = known.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("class"))
    net, names = train(_sample(known, per_class)[0], language_net, windows)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = text_buffer(batch.column("__text"))
            if net is None:
                pred, score = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            else:
                p = net.predict(buf, offs)[:, : len(names)]
                known = letters(buf, offs)
                pred = [names[k] if ok else "und" for k, ok in zip(p.argmax(1), known, strict=True)]
                score = np.where(known, p.max(1, initial=0), 0.0)
            found = [batch.column(0), batch.column(1), pa.array(pred, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays([*found, *[batch.column(c) for c in sent]], ["doc_id", "held_out", "lang_pred", "score", *kept])

    # the text is sent once, also where it is carried
    kept = [f"carry_{c}" for c in carry]
    sent = ["__text" if c == text else f"carry_{c}" for c in carry]
    others = [F.col(f"`{c}`").alias(f"carry_{c}") for c in carry if c != text]
    columns = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(f"`{text}`").cast("string").alias("__text"), *others)
    types = {f.name: f.dataType.simpleString() for f in columns.schema}
    schema = "doc_id long, held_out boolean, lang_pred string, score double" + "".join(f", `{k}` {types[c]}" for k, c in zip(kept, sent, strict=True))
    return columns.mapInArrow(run, schema)


def quality_net(classes: int) -> Net:
    return Net(classes, window=512, widths=(3, 5, 8), filters=12, embed=6)


def score_quality(
    docs: DataFrame, labels: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    per_class: int = 1200, windows: int = 6, threshold: float = 0.7,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) per document; score: the probability of label 1.

    ``labels`` has an id under the same name and the label; ids with several labels count by the
    largest, null labels do not count. ``held_out`` is a condition on the id alone. Of rows that
    repeat an id one teaches, the text with the smallest hash. Null and empty
    texts are scored as empty texts; without labels of both classes every score is 0.5."""
    marks = labels.where(~held_out & F.col(f"`{label}`").isNotNull()).groupBy(F.col(f"`{doc_id}`").alias("id")).agg(F.max(F.col(f"`{label}`")).cast("string").alias("class"))
    chosen, counts = _sample(marks.where(F.col("class").isin("0", "1")), per_class)
    chosen = written(chosen.select("id", "class"), "labels")  # chosen before any text is looked up
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    texts = texts.join(chosen, "id").groupBy("id", "class").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))["text"].alias("text"))
    net, names = train(texts.withColumn("order", F.xxhash64("id")), quality_net, windows, counts)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = text_buffer(batch.column(2))
            if net is None or names != ["0", "1"]:
                score = np.full(batch.num_rows, 0.5)
            else:
                score = net.predict(buf, offs)[:, 1]
            out = [batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "held_out", "score", "predicted"])

    columns = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(f"`{text}`").cast("string").alias("text"))
    return columns.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
