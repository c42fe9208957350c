"""Token exchange: every distinct pre-token of the corpus is looked at once.

Documents are read in blocks of bounded bytes. A block keeps its documents in one packed row
and sends each of its distinct pre-tokens once, in packed cells by hash bucket. A bucket sees
all of the corpus's copies of its pre-tokens, handles each distinct one once, and answers
every cell; a block then joins its answers to its documents. A row of the shuffle is a cell,
not a token, so a frequent token costs one entry a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .kernels import bucket_of, chunks, distinct, ragged, span_hashes, text_buffer
from .pretoken import pieces
from .shared import id_array, labels, long_ids, pack, ship, unpack

CELLS = "block long, bucket int, payload binary"
CELL_ARROW = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("payload", pa.binary())])
#: Bytes of text that are hashed at a time.
KERNEL_BYTES = 1 << 20


def cells(block: int, buckets, payloads) -> pa.RecordBatch:
    """A block's cells; buckets are labels, or negative for what stays with the block."""
    return pa.RecordBatch.from_arrays([pa.array([block] * len(payloads), pa.int64()), pa.array(buckets, pa.int32()), pa.array(payloads, pa.binary())], schema=CELL_ARROW)


def narrow(values: np.ndarray) -> np.ndarray:
    """Non-negative values in the smallest unsigned type that holds them."""
    most = int(values.max()) if len(values) else 0
    return values.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64)


def block_ids() -> Iterator[int]:
    """Ids that no other task of the same written table uses."""
    at = TaskContext.get().partitionId() << 32
    while True:
        yield at
        at += 1


def stage(docs: DataFrame, id_column: str, text_column: str, path: str, buckets: int, block_bytes: int, payload: Callable) -> DataFrame:
    """Blocks of documents as cells: bucket -1 holds what ``payload`` makes of the documents, the others distinct pre-tokens in order of their hashes."""
    ship(docs.sparkSession)
    label = labels(buckets).tolist()

    def run(batches):
        ids = block_ids()
        for batch in batches:
            buf, offsets = text_buffer(batch.column(1))
            doc_ids, null = long_ids(batch.column(0))
            for a, b in chunks(offsets, block_bytes):
                yield block(next(ids), buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], doc_ids[a:b], null[a:b])

    def block(block_id, buf, offsets, doc_ids, null):
        cutter = pieces(path)
        hashed, spans, firsts, at = [], [], [], 0
        for a, b in chunks(offsets, KERNEL_BYTES):
            part, starts, ends, first = cutter.cut(buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            h = span_hashes(part, starts, ends)
            hashed.append(h)
            u, where, _ = distinct(h)
            size = ends[where] - starts[where]
            spans.append((u, size, part[ragged(starts[where], size)]))
            firsts.append(first[:-1] + at)
            at += len(h)
        first = np.append(np.concatenate(firsts), at) if firsts else np.zeros(1, np.int64)
        u, _, index = distinct(np.concatenate(hashed) if hashed else np.zeros(0, np.uint64))
        seen = np.concatenate([s[0] for s in spans]) if spans else u
        sizes = np.concatenate([s[1] for s in spans]) if spans else np.zeros(0, np.int64)
        data = np.concatenate([s[2] for s in spans]) if spans else np.zeros(0, np.uint8)
        _, where, _ = distinct(seen)
        starts = np.cumsum(sizes) - sizes
        starts, sizes = starts[where], sizes[where]
        bounds = np.searchsorted(bucket_of(u, buckets), np.arange(buckets + 1))
        payloads, used = [payload(doc_ids, null, np.diff(offsets), first, index)], [-1]
        for k in range(buckets):
            a, b = bounds[k], bounds[k + 1]
            if a < b:
                payloads.append(pack(narrow(sizes[a:b]), data[ragged(starts[a:b], sizes[a:b])], squeeze=True))
                used.append(label[k])
        return cells(block_id, used, payloads)

    return docs.select(id_column, text_column).mapInArrow(run, CELLS)


def answer(staged: DataFrame, path: str, value: Callable) -> DataFrame:
    """One cell for each cell: what ``value(tokenizer, tokens)`` gives of the bucket's distinct pre-tokens, in the cell's order.

    value returns arrays (sizes, values): sizes[i] of the values belong to token i.
    """

    def run(table: pa.Table) -> pa.Table:
        parts = [unpack(x, squeezed=True) for x in table.column("payload").to_pylist()]
        counts = [len(p[0]) for p in parts]
        sizes = np.concatenate([p[0] for p in parts]).astype(np.int64)
        data = np.concatenate([p[1] for p in parts])
        del parts
        ends = np.cumsum(sizes)
        starts = ends - sizes
        # hash a bounded part of the bucket at a time
        h = np.concatenate([span_hashes(data[starts[a] : ends[b - 1]], starts[a:b] - starts[a], ends[a:b] - starts[a]) for a, b in chunks(np.append(0, ends), KERNEL_BYTES)])
        _, where, index = distinct(h)
        raw = data.tobytes()
        tokens = [raw[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)]
        lengths, values = value(pieces(path), tokens)
        begin = np.cumsum(lengths, dtype=np.int64) - lengths
        out, at = [], 0
        for n in counts:
            own = index[at : at + n]
            out.append(pack(narrow(lengths[own]), narrow(values[ragged(begin[own], lengths[own].astype(np.int64))]), squeeze=True))
            at += n
        return pa.Table.from_arrays([table.column("block"), table.column("bucket"), pa.array(out, pa.binary())], schema=CELL_ARROW)

    return staged.where("bucket >= 0").groupBy("bucket").applyInArrow(run, CELLS)


def replies(staged: DataFrame, reply: Callable) -> DataFrame:
    """One cell for each cell: ``reply`` makes the payloads of a bucket's answers from all of its unpacked cells."""

    def run(table: pa.Table) -> pa.Table:
        out = reply([unpack(x, squeezed=True) for x in table.column("payload").to_pylist()])
        return pa.Table.from_arrays([table.column("block"), table.column("bucket"), pa.array(out, pa.binary())], schema=CELL_ARROW)

    return staged.where("bucket >= 0").groupBy("bucket").applyInArrow(run, CELLS)


def in_order(found: pa.Table) -> list[list[np.ndarray]]:
    """A block's answers in the order of its buckets."""
    payloads = found.column("payload").to_pylist()
    return [unpack(payloads[i], squeezed=True) for i in np.argsort(found.column("bucket").to_numpy()).tolist()]


def settle(staged: DataFrame, answers: DataFrame, finish: Callable, schema: str, arrow: pa.Schema) -> DataFrame:
    """Each block's documents with its answers: ``finish(payload, sizes, values)`` gives arrays of rows."""

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        order = np.argsort(found.column("bucket").to_numpy())
        cells_ = found.column("payload").to_pylist()
        parts = [unpack(cells_[i], squeezed=True) for i in order.tolist()]
        sizes = np.concatenate([p[0].astype(np.uint32) for p in parts]) if parts else np.zeros(0, np.uint32)
        values = np.concatenate([p[1].astype(np.uint32) for p in parts]) if parts else np.zeros(0, np.uint32)
        made = [finish(x, sizes, values) for x in docs.column("payload").to_pylist()]
        return pa.concat_tables([pa.Table.from_arrays(x, schema=arrow) for x in made]) if made else arrow.empty_table()

    return staged.where("bucket = -1").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


__all__ = ["answer", "cells", "id_array", "in_order", "replies", "settle", "stage"]
