"""Quality classifier: a byte-level convolutional network in numpy.

Learned filters run over every byte of a text. Their responses are max-pooled over overlapping
chunks that cover the whole document (CHUNK bytes, half of it shared with the next); mean,
highest and lowest chunk response of each filter, and the text's length, go through one hidden
layer into one probability. Convolutions are sums of table rows, one table for each two filter positions.

The network is fitted on about PER_LABEL labelled rows of each class, of at most LONGEST bytes
(stated bounds of the fit; all rows and whole texts are scored).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .kernels import chunks, ragged, text_buffer
from .shared import crc_mod, id_array, long_ids, quoted, ship

FOLDS, HELD_OUT = 3, 1
FILTERS, SPAN, EMBED, HIDDEN, CHUNK = 24, 6, 8, 24, 256  # SPAN is even, CHUNK a power of two
PER_LABEL, LONGEST, EPOCHS, BATCH, RATE = 700, 16_384, 10, 32, 0.01
HALF = CHUNK // 2
ROWS = "doc_id long, held_out boolean, score double, predicted int"
#: Training texts of both classes also serve as crops of this many bytes, so that short texts are known and length tells no class.
CROPS = (12, 160)
#: Places that are convolved at a time, and bytes of documents that share a pass.
PART, PASS = 1 << 15, 1 << 19
NOTHING = np.float32(-1e30)


def layout(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts on a grid of half chunks, filled up with zero bytes; the filter places that hold no text, which half chunks count, and each document's first.

    A text has a place for each byte (an empty one has one place), and zeros for its last filters to read.
    """
    size = np.diff(offsets)
    places = np.maximum(size, 1)
    held, own = -(-(places + SPAN - 1) // HALF), -(-places // HALF)
    first = np.append(0, np.cumsum(held)) * HALF
    data = np.zeros(int(first[-1]) + SPAN, np.uint8)
    data[ragged(first[:-1], size)] = buf
    blank = ragged(first[:-1] + places, held * HALF - places)
    counts = np.ones(int(first[-1]) // HALF, bool)
    counts[(first[1:] // HALF - 1)[held > own]] = False
    return data, blank, counts, np.append(0, np.cumsum(own))


def responses(pairs: np.ndarray, data: np.ndarray, blank: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Every filter at places lo..hi, as sums of rows of one table for each two bytes."""
    two = (data[lo : hi + SPAN - 1].astype(np.uint16) << np.uint16(8)) | data[lo + 1 : hi + SPAN]
    out = np.take(pairs[0], two[: hi - lo], axis=0)
    row = np.empty_like(out)
    for k in range(1, SPAN // 2):
        np.take(pairs[k], two[2 * k : 2 * k + hi - lo], axis=0, out=row, mode="clip")
        out += row
    out[blank - lo] = NOTHING
    return out


def pooled(pairs: np.ndarray, bias: np.ndarray, data: np.ndarray, blank: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Highest response of every filter in each half chunk that counts."""
    out = np.empty((len(counts), len(bias)), np.float32)
    step = PART // HALF
    for a in range(0, len(counts), step):
        b = min(a + step, len(counts))
        low, high = np.searchsorted(blank, [a * HALF, b * HALF])
        x = responses(pairs, data, blank[low:high], a * HALF, b * HALF).reshape(b - a, HALF, -1)
        while x.shape[1] > 1:
            x = np.maximum(x[:, : x.shape[1] // 2], x[:, x.shape[1] // 2 :])
        out[a:b] = x[:, 0]
    return out[counts] + bias


def summary(half: np.ndarray, edge: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document features from half chunks: mean, highest, lowest chunk response and length; also the chunks and their documents."""
    n = np.diff(edge)
    count = np.maximum(n - 1, 1)
    first = np.append(0, np.cumsum(count))
    left = ragged(edge[:-1], count)
    right = np.minimum(left + 1, np.repeat(edge[1:] - 1, count))
    chunk = np.maximum(np.maximum(half[left], half[right]), 0)
    mean = np.add.reduceat(chunk, first[:-1], axis=0) / count[:, None]
    high, low = np.maximum.reduceat(chunk, first[:-1], axis=0), np.minimum.reduceat(chunk, first[:-1], axis=0)
    length = np.stack([np.log1p(size) / 8, np.minimum(size, CHUNK) / CHUNK], 1)
    return np.concatenate([mean, high, low, length], 1).astype(np.float32), left, right, first


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters, scores and gradient steps."""

    def __init__(self, rng: np.random.Generator):
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        features = 3 * FILTERS + 2
        self.p = {"embed": draw(256, EMBED, scale=1.0), "filter": draw(SPAN, EMBED, FILTERS, scale=(SPAN * EMBED) ** -0.5), "bias": np.zeros(FILTERS, np.float32), "w1": draw(features, HIDDEN, scale=features**-0.5), "b1": np.zeros(HIDDEN, np.float32), "w2": draw(HIDDEN, scale=HIDDEN**-0.5), "b2": np.zeros(1, np.float32)}
        self.m, self.v, self.t = {k: np.zeros_like(x) for k, x in self.p.items()}, {k: np.zeros_like(x) for k, x in self.p.items()}, 0

    def pairs(self) -> np.ndarray:
        """For each two filter positions, the response to each two bytes."""
        one = np.einsum("be,kef->kbf", self.p["embed"], self.p["filter"])
        return (one[0::2, :, None] + one[1::2, None]).reshape(SPAN // 2, 65536, FILTERS)

    def head(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.maximum(x @ self.p["w1"] + self.p["b1"], 0)
        return hidden, hidden @ self.p["w2"] + self.p["b2"][0]

    def scores(self, buf: np.ndarray, offsets: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        data, blank, counts, edge = layout(buf, offsets)
        half = pooled(pairs, self.p["bias"], data, blank, counts)
        return sigmoid(self.head(summary(half, edge, np.diff(offsets))[0])[1].astype(np.float64))

    def step(self, buf, offsets, label, weight, rate) -> float:
        p = self.p
        data, blank, counts, edge = layout(buf, offsets)
        grid = responses(self.pairs(), data, blank, 0, len(counts) * HALF).reshape(len(counts), HALF, FILTERS)[counts]
        best = grid.argmax(axis=1)
        half = np.take_along_axis(grid, best[:, None], 1)[:, 0] + p["bias"]
        x, left, right, cfirst = summary(half, edge, np.diff(offsets))
        hidden, logit = self.head(x)
        prob = sigmoid(logit)
        error = (weight * (prob - label) / len(label)).astype(np.float32)
        g = {"w2": hidden.T @ error, "b2": error.sum(keepdims=True)}
        back = error[:, None] * p["w2"] * (hidden > 0)
        g["w1"], g["b1"] = x.T @ back, back.sum(axis=0)
        dx = back @ p["w1"].T
        count = np.diff(cfirst)
        doc = np.repeat(np.arange(len(count)), count)
        chunk = np.maximum(np.maximum(half[left], half[right]), 0)
        F_ = FILTERS
        dchunk = dx[doc, :F_] / count[doc][:, None]
        for k in (1, 2):  # neighbours often tie, as they share a half: each gets its share
            tied = (chunk == x[doc, k * F_ : (k + 1) * F_]).astype(np.float32)
            dchunk += dx[doc, k * F_ : (k + 1) * F_] * tied / np.add.reduceat(tied, cfirst[:-1], axis=0)[doc]
        dchunk = np.where(chunk > 0, dchunk, 0)
        dhalf = np.zeros_like(half)
        takes = half[left] >= half[right]
        np.add.at(dhalf, left, np.where(takes, dchunk, 0))
        np.add.at(dhalf, right, np.where(takes, 0, dchunk))
        g["bias"] = dhalf.sum(axis=0)
        place = (np.flatnonzero(counts) * HALF)[:, None] + best
        f = np.broadcast_to(np.arange(F_), place.shape)
        dtables = np.stack([np.bincount((data[place + k].astype(np.int64) * F_ + f).ravel(), weights=dhalf.ravel(), minlength=256 * F_).reshape(256, F_) for k in range(SPAN)]).astype(np.float32)
        g["embed"] = np.einsum("kbf,kef->be", dtables, p["filter"])
        g["filter"] = np.einsum("be,kbf->kef", p["embed"], dtables)
        self.t += 1
        for k, x_ in g.items():
            self.m[k] = 0.9 * self.m[k] + 0.1 * x_
            self.v[k] = 0.999 * self.v[k] + 0.001 * x_ * x_
            p[k] -= (rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)).astype(np.float32)
        return float(-(np.log(np.where(label > 0, prob, 1 - prob) + 1e-9) * weight).mean())


def train(texts: list[bytes], label: np.ndarray, seed: int = 3, epochs: int = EPOCHS) -> Network | float:
    """A network; or, where there are not two classes, the constant share of label 1 (with one of each assumed besides)."""
    if len(set(label.tolist())) < 2:
        return float((label.sum() + 1) / (len(label) + 2))
    rng = np.random.default_rng(seed)
    net = Network(rng)
    texts, label = list(texts), list(label)
    for t, y in list(zip(texts, label, strict=True)):
        texts.append(t[: int(rng.integers(*CROPS))] if rng.random() < 0.5 else t[-int(rng.integers(*CROPS)) :])
        label.append(y)
    label = np.array(label, np.float32)
    share = label.mean()
    weight = np.where(label > 0, 0.5 / share, 0.5 / (1 - share))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs) + RATE / 50
        for rows in np.array_split(rng.permutation(len(label)), max(1, len(label) // BATCH)):
            sizes = [len(texts[r]) for r in rows]
            net.step(np.frombuffer(b"".join(texts[r] for r in rows), np.uint8), np.append(0, np.cumsum(sizes)), label[rows], weight[rows], rate)
    return net


def fit(docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality", folds: int = FOLDS, held_out: int = HELD_OUT, per_label: int = PER_LABEL, longest: int = LONGEST) -> Network | float:
    """Learns label 1 against 0 from rows whose crc32(id) modulo folds is not held_out; other and null labels are left out."""
    known = labels.where(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull() & (crc_mod(id_column, folds) != held_out)).select(F.col(id_column).alias("_id"), F.col(label_column).cast("int").alias("_label"))
    counts = known.groupBy("_label").agg(F.count("*").alias("_n"))
    draw = F.pmod(F.xxhash64("_id", F.lit(5)), F.lit(1 << 30)) / (1 << 30)
    drawn = known.join(F.broadcast(counts), "_label").where(draw * F.col("_n") < per_label).select("_id", "_label")  # two rows
    text = F.encode(F.col(text_column), "UTF-8")
    picked = docs.select(F.col(id_column).alias("_id"), text.alias("_text")).where(F.length("_text") <= longest)
    rows = picked.join(F.broadcast(drawn), "_id").orderBy("_id", "_label").collect()  # about 2 * per_label ids
    return train([bytes(r["_text"]) for r in rows], np.array([r["_label"] for r in rows], np.float32))


def quality_scores(docs: DataFrame, model: Network | float, *, id_column: str = "doc_id", text_column: str = "text", folds: int = FOLDS, held_out: int = HELD_OUT, carry: tuple[str, ...] = ()) -> DataFrame:
    """The id, held_out, score, predicted and the carried columns of every row.

    A null text is scored as an empty one; a null id is not held out; repeated rows are scored each.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)  # some tens of kB
    kinds = (T.LongType(), T.BooleanType(), T.DoubleType(), T.IntegerType())
    names = [id_column, "held_out", "score", "predicted", *carry]
    schema = T.StructType([T.StructField(c, kind) for c, kind in zip(names, (*kinds, *(docs.schema[c].dataType for c in carry)), strict=True)])

    def run(batches):
        net = sent.value
        pairs = None if isinstance(net, float) else net.pairs()
        for batch in batches:
            buf, offsets = text_buffer(batch.column(1))
            ids, null = long_ids(batch.column(0))
            score = np.full(len(ids), net if pairs is None else 0.0)
            for a, b in chunks(offsets, PASS) if pairs is not None else ():
                score[a:b] = net.scores(buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], pairs)
            yield pa.RecordBatch.from_arrays([id_array(ids, null), batch.column(2), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), *batch.columns[3:]], names=names)

    return docs.select(id_column, text_column, (crc_mod(id_column, folds) == held_out).alias("_held"), *[quoted(c) for c in carry]).mapInArrow(run, schema)
