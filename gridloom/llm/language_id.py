"""Language identification: averaged hashed subword embeddings and a linear softmax.

Subwords are the 1- to 4-byte grams of the lower-case text with non-letters of ASCII as
blanks, hashed into BUCKETS embeddings. A document is the average of its embeddings over the
whole text. Embeddings and softmax are trained by stochastic gradient descent in numpy on a
sample of about PER_LANGUAGE documents of each language (a stated bound of the fit; all rows
are predicted). A temperature and a rejection threshold are fitted on held-back rows of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import LOWER, chunks, text_buffer
from .shared import crc_mod, id_array, long_ids, ship

FOLDS, HELD_OUT = 4, 2
BUCKETS, WIDTH, GRAMS = 1 << 15, 16, (1, 2, 3, 4)
PER_LANGUAGE, EPOCHS, BATCH, RATE = 500, 8, 32, 0.5
#: Labels up to which their counts, and the ids drawn for them, are broadcast.
MANY_LABELS = 2000
#: Share of accepted rows that may be wrong where the rejection threshold is fitted.
WRONG = 0.01
ROWS = "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean"
BLANKED = LOWER.copy()
BLANKED[[i for i in range(128) if not chr(i).isalpha()]] = 32
IS_LETTER = np.array([chr(i).isalpha() for i in range(128)] + [False] * 128)


def subwords(buf: np.ndarray, offsets: np.ndarray):
    """For each gram size, the bucket of every gram of every document and each document's first gram."""
    text = BLANKED[buf]
    n = np.diff(offsets)
    code = np.zeros(len(text), np.uint64)
    for size in range(1, max(GRAMS) + 1):
        code = (code[: len(text) - size + 1] << np.uint64(8)) | text[size - 1 :]
        if size not in GRAMS:
            continue
        bucket = (((code + np.uint64(size << 40)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)).astype(np.int32)
        count = np.maximum(n - size + 1, 0)
        if size > 1:
            inside = np.ones(len(bucket), bool)
            # grams that would run into the next document
            for k in range(1, size):
                at = offsets[1:-1] - k
                inside[at[(at >= 0) & (at < len(inside))]] = False
            bucket = bucket[inside]
        yield bucket, np.append(0, np.cumsum(count))


def has_letter(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(IS_LETTER[buf]))
    out = total[offsets[1:]] > total[offsets[:-1]]
    for d in np.flatnonzero(~out & (np.diff(offsets) > 0)).tolist():
        text = buf[offsets[d] : offsets[d + 1]].tobytes()
        out[d] = not text.isascii() and any(c.isalpha() for c in text.decode("utf-8", "replace"))
    return out


def averages(table: np.ndarray, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean of table's rows over all subwords of each document; zero without any."""
    out = np.zeros((len(offsets) - 1, table.shape[1]))
    total = np.zeros(len(offsets) - 1)
    for bucket, first in subwords(buf, offsets):
        full = np.flatnonzero(np.diff(first))
        if len(full):
            out[full] += np.add.reduceat(table[bucket], first[full], axis=0)
        total += np.diff(first)
    return out / np.maximum(total, 1)[:, None]


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def train(names: list[str], labels: np.ndarray, grams: list[np.ndarray], weights: list[np.ndarray], seed: int = 7) -> dict:
    """Fit on documents given as subword buckets and their shares; returns scores by bucket, bias, temperature and threshold."""
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    out, bias = rng.normal(0, 0.1, (WIDTH, len(names))).astype(np.float32), np.zeros(len(names), np.float32)
    order = rng.permutation(len(labels))
    kept, back = order[len(order) // 5 :], order[: len(order) // 5]
    if not len(kept):
        kept = back = order

    def mean(rows):
        idx, w = np.concatenate([grams[r] for r in rows]), np.concatenate([weights[r] for r in rows])
        size = np.array([len(grams[r]) for r in rows])
        return idx, w, size, np.add.reduceat(embed[idx] * w[:, None], np.cumsum(size) - size, axis=0)

    for epoch in range(EPOCHS):
        rate = np.float32(RATE * 10 * (1 - epoch / EPOCHS))
        for rows in np.array_split(rng.permutation(kept), max(1, len(kept) // BATCH)):
            idx, w, size, hidden = mean(rows)
            error = softmax(hidden @ out + bias).astype(np.float32)
            error[np.arange(len(rows)), labels[rows]] -= 1
            error /= len(rows)
            back_hidden = error @ out.T
            out -= rate * hidden.T @ error
            bias -= rate * error.sum(axis=0)
            # a subword's gradient is its share of each document; rates are per document
            np.subtract.at(embed, idx, rate * 20 * w[:, None] * np.repeat(back_hidden, size, axis=0))
    logits = mean(back)[3] @ out + bias
    truth = labels[back]
    heat = min(2.0 ** np.arange(-4, 5, 0.5), key=lambda t: -np.log(softmax(logits / t)[np.arange(len(back)), truth] + 1e-12).mean())
    p = softmax(logits / heat)
    score, right = p.max(axis=1), p.argmax(axis=1) == truth
    by_score = np.argsort(-score)
    wrong = np.cumsum(~right[by_score]) / np.arange(1, len(back) + 1)
    fine = np.flatnonzero(wrong <= WRONG)
    return {"names": names, "table": embed @ out, "bias": bias, "heat": float(heat), "least": float(score[by_score[fine[-1]]]) if len(fine) else 1.0}


def _sample(docs: DataFrame, id_column: str, text_column: str, label_column: str, per_label: int, train_rows) -> list:
    """About per_label rows of each label, as subword shares of the whole text."""
    fit = docs.where(train_rows & F.col(label_column).isNotNull()).select(id_column, text_column, label_column)
    ids = fit.select(id_column, label_column)  # the texts stay where they are
    counts = ids.groupBy(label_column).agg(F.count("*").alias("_n"))
    few = counts.count() <= MANY_LABELS
    small = F.broadcast if few else lambda df: df
    draw = F.pmod(F.xxhash64(F.col(id_column), F.lit(11)), F.lit(1 << 30)) / (1 << 30)
    chosen = ids.join(small(counts), label_column).where(draw * F.col("_n") < per_label).select(id_column).distinct()
    drawn = fit.where(F.col(text_column).isNotNull()).join(small(chosen), id_column, "left_semi").select(id_column, text_column, label_column)

    def run(batches):
        for batch in batches:
            buf, offsets = text_buffer(batch.column(1))
            letters = has_letter(buf, offsets)
            for d in np.flatnonzero(letters).tolist():
                own = buf[offsets[d] : offsets[d + 1]]
                idx, n = np.unique(np.concatenate([b for b, _ in subwords(own, np.array([0, len(own)]))]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([batch.column(0)[d].as_py()], pa.int64()), pa.array([batch.column(2)[d].as_py()], pa.string()), pa.array([idx.astype(np.int32).tobytes()]), pa.array([(n / n.sum()).astype(np.float32).tobytes()])], names=["id", "label", "grams", "shares"])

    return drawn.mapInArrow(run, "id long, label string, grams binary, shares binary").orderBy("id", "label").collect()


def fit(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang", folds: int = FOLDS, held_out: int = HELD_OUT, per_language: int = PER_LANGUAGE) -> dict | None:
    """The model, learnt from rows whose crc32(id) modulo folds is not held_out and whose label is not null; None without any."""
    ship(docs.sparkSession)
    rows = _sample(docs, id_column, text_column, label_column, per_language, F.col(id_column).isNotNull() & (crc_mod(id_column, folds) != held_out))
    if not rows:
        return None
    names = sorted({r["label"] for r in rows})
    return train(names, np.array([names.index(r["label"]) for r in rows]), [np.frombuffer(r["grams"], np.int32) for r in rows], [np.frombuffer(r["shares"], np.float32) for r in rows])


def identify(docs: DataFrame, model: dict | None, *, id_column: str = "doc_id", text_column: str = "text", folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """doc_id, held_out, lang_pred, score and accepted of every row.

    A null text, one without a letter, and any text without a model are ``und`` with score 0
    and not accepted; rows with a null id are not held out. accepted is false where the
    calibrated score is below the threshold fitted for at most WRONG errors.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)  # BUCKETS rows of one float a language

    def run(batches):
        m = sent.value
        for batch in batches:
            buf, offsets = text_buffer(batch.column(1))
            ids, null = long_ids(batch.column(0))
            names = np.array([*(m["names"] if m else []), "und"], object)
            label, score = np.full(len(ids), len(names) - 1), np.zeros(len(ids))
            for a, b in chunks(offsets, 1 << 19):
                part, own = buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                good = np.flatnonzero(has_letter(part, own))
                if m and len(good):
                    p = softmax((averages(m["table"], part, own)[good] + m["bias"]) / m["heat"])
                    label[a + good], score[a + good] = p.argmax(axis=1), p.max(axis=1)
            held = batch.column(2)
            yield pa.RecordBatch.from_arrays([id_array(ids, null), held, pa.array(names[label], pa.string()), pa.array(score), pa.array((score >= m["least"]) & (score > 0) if m else np.zeros(len(ids), bool))], names=[c.split()[0] for c in ROWS.split(", ")])

    return docs.select(id_column, text_column, (crc_mod(id_column, folds) == held_out).alias("held_out")).mapInArrow(run, ROWS)
