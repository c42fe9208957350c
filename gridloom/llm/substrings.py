"""Substring dedup by relative Lempel-Ziv parsing against an index of every document.

The reference of a document is all documents with smaller ids. Its index has every phrase of
``window`` words at its first place: the smallest id that has it, and the first position there.
So a phrase has one place where a match can begin, and the longest match from there is found by
following that place: it goes on while the document's next phrase is indexed at the next
position of the same document. A document is factored greedily into such matches. A phrase
that lies across the end of a factor is looked up too, and begins the next factor with what it
has beyond that end. So factors of ``window`` words or more, and the rests of phrases at their
boundaries, are the duplicate spans, each with its source's id and position.

The index lies in reference blocks, shards by the phrase's hash, and every block of documents
meets every shard. Only phrases that can be shared get there: equal phrases have equal
minimizers (the least hash of their ``anchor``-word parts), and round one finds the minimizers
that at least two documents have. In round two a block of documents sends each remaining
phrase once, at its first place in the block, and its shard answers with the place in the index.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .exchange import CELL_ARROW, CELLS, KERNEL_BYTES, block_ids, cells, in_order, replies
from .kernels import bucket_of, chunks, distinct, mix, powers, span_hashes, text_buffer, word_spans
from .shared import Scope, labels, long_ids, pack, quoted, session_scope, ship, shuffle_partitions, unpack

WINDOW, ANCHOR = 13, 5
SPAN = ("first", "after", "source_id", "source_first")
U64 = np.uint64
NO_ID = np.iinfo(np.int64).max  # a null id comes after all others


def rolling(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words."""
    n = len(words)
    if n < size:
        return np.zeros(0, U64)
    up, down = powers(n + 1)
    total = np.concatenate([[U64(0)], np.cumsum(words * up[:-1])])
    return mix((total[size:] - total[:-size]) * down[: n - size + 1] + U64(size))


def phrases(words: np.ndarray, first: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all phrases that lie within one document, their documents and their minimizers (48 bits)."""
    n = np.diff(first)
    count = np.maximum(n - window + 1, 0)
    doc = np.repeat(np.arange(len(n)), count)
    start = np.arange(len(doc)) + np.repeat(first[:-1] - (np.cumsum(count) - count), count)
    if not len(start):
        return start, doc, np.zeros(0, U64)
    low, width, span = rolling(words, anchor), 1, window - anchor + 1
    while width < span:
        step = min(width, span - width)
        low = np.minimum(low[: len(low) - step], low[step:])
        width += step
    return start, doc, low[start] >> U64(16)


def word_hashes(buf: np.ndarray, offsets: np.ndarray):
    """Hashes and spans of all words of the documents, and each document's first word."""
    hashed, begin, stop, firsts, at = [np.zeros(0, U64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], 0
    for a, b in chunks(offsets, KERNEL_BYTES):
        part = buf[offsets[a] : offsets[b]]
        starts, ends, first = word_spans(part, offsets[a : b + 1] - offsets[a])
        hashed.append(span_hashes(part, starts, ends))
        begin.append(starts + offsets[a])
        stop.append(ends + offsets[a])
        firsts.append(first[:-1] + at)
        at += len(starts)
    return np.concatenate(hashed), np.concatenate(begin), np.concatenate(stop), np.append(np.concatenate(firsts) if firsts else np.zeros(0, np.int64), at)


def _by_bucket(keys: np.ndarray, shift: int, buckets: int, extra: np.ndarray):
    """Cells of sorted keys with a value each; buckets rise with the keys."""
    bounds = np.searchsorted(bucket_of(keys << U64(shift), buckets), np.arange(buckets + 1))
    for k in range(buckets):
        own = slice(bounds[k], bounds[k + 1])
        if own.stop > own.start:
            yield k, pack(np.diff(keys[own], prepend=U64(0)), extra[own], squeeze=True)


def _steps(values: np.ndarray) -> np.ndarray:
    """Differences, which pack well where values go on by ones."""
    return np.diff(values.astype(np.int64), prepend=0)


def _ipc(batch: pa.RecordBatch) -> np.ndarray:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as f:
        f.write_batch(batch)
    return np.frombuffer(sink.getvalue(), np.uint8)


def _anchors(words, first, window, anchor):
    """Sorted distinct minimizers of a block and which of them several of its documents have."""
    _, doc, low = phrases(words, first, window, anchor)
    new = np.append(True, (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])) if len(low) else np.zeros(0, bool)
    low, doc = low[new], doc[new]
    order = np.argsort(low)
    low, doc = low[order], doc[order]
    edge = np.flatnonzero(np.append(True, low[1:] != low[:-1])) if len(low) else np.zeros(0, np.int64)
    if not len(edge):
        return low, np.zeros(0, bool)
    return low[edge], np.minimum.reduceat(doc, edge) != np.maximum.reduceat(doc, edge)


def _stage(docs: DataFrame, window: int, anchor: int, buckets: int, block_bytes: int) -> DataFrame:
    """docs has the id, the text and then the columns to carry."""
    label = labels(buckets).tolist()

    def run(batches):
        ids = block_ids()
        for batch in batches:
            buf, offsets = text_buffer(batch.column(1))
            doc_ids, null = long_ids(batch.column(0))
            lost = batch.column(1).is_null().to_numpy(zero_copy_only=False)
            carried = pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:]], names=[str(i) for i in range(batch.num_columns - 1)])
            for a, b in chunks(offsets, block_bytes):
                part, own = buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                block = next(ids)
                words, _, _, first = word_hashes(part, own)
                keys, several = _anchors(words, first, window, anchor)
                made = list(_by_bucket(keys, 16, buckets, several))
                docs_ = pack(np.where(null[a:b], NO_ID, doc_ids[a:b]), lost[a:b], own, part, _ipc(carried.slice(a, b - a)), squeeze=True)
                yield cells(block, [-1, *[label[k] for k, _ in made]], [docs_, *[x for _, x in made]])

    return docs.mapInArrow(run, CELLS)


def _shared(parts) -> list[bytes]:
    """A bit for each minimizer of each cell: whether two documents have it."""
    _, _, index = distinct(np.concatenate([np.cumsum(p[0]) for p in parts]))
    several = np.concatenate([p[1] for p in parts])
    bits = ((np.bincount(index) > 1) | (np.bincount(index, weights=several) > 0))[index]
    ends = np.cumsum([len(p[0]) for p in parts])
    return [pack(np.array([len(p[0])], np.int64), np.packbits(bits[e - len(p[0]) : e]), squeeze=True) for p, e in zip(parts, ends.tolist(), strict=True)]


def _places(parts) -> list[bytes]:
    """For each phrase of each cell, whether the index has it at a smaller id than the cell, and where."""
    _, _, index = distinct(np.concatenate([p[0] for p in parts]))
    doc = np.concatenate([np.cumsum(p[1]) for p in parts])
    at = np.concatenate([np.cumsum(p[2]) for p in parts])
    n = int(index.max()) + 1 if len(index) else 0
    low, first = np.full(n, NO_ID), np.full(n, NO_ID)
    np.minimum.at(low, index, doc)
    least = doc == low[index]
    np.minimum.at(first, index[least], at[least])
    known = low[index] < doc
    out, e = [], 0
    for p in parts:
        own = slice(e, e + len(p[0]))
        k = known[own]
        which = index[own][k]
        out.append(pack(np.array([len(k)], np.int64), np.packbits(k), _steps(low[which]), _steps(first[which] - at[own][k]), squeeze=True))
        e = own.stop
    return out


def _look_up(staged: DataFrame, answers: DataFrame, window: int, anchor: int, buckets: int) -> DataFrame:
    """Round two: bucket -2 holds documents without shared phrases, -1 those with some, the others phrases at their first place in the block."""
    label = labels(buckets).tolist()

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        bits = [np.unpackbits(p[1], count=int(p[0][0])).astype(bool) for p in in_order(found)]
        bits = np.concatenate(bits) if bits else np.zeros(0, bool)
        out = []
        for block, payload in zip(docs.column("block").to_pylist(), docs.column("payload").to_pylist(), strict=True):
            ids, lost, offsets, buf, carried = unpack(payload, squeezed=True)
            words, _, _, first = word_hashes(buf, offsets)
            keys, _ = _anchors(words, first, window, anchor)
            start, doc, low = phrases(words, first, window, anchor)
            run_start = np.flatnonzero(np.append(True, low[1:] != low[:-1])) if len(low) else np.zeros(0, np.int64)
            shared = np.repeat(bits[np.searchsorted(keys, low[run_start])], np.diff(np.append(run_start, len(low))))
            start, doc = start[shared], doc[shared]
            at, names = start - first[doc], rolling(words, window)[start]
            order = np.lexsort((at, ids[doc], names))
            head = np.zeros(len(names), bool)  # a phrase's first place in the block
            head[order] = np.append(True, names[order][1:] != names[order][:-1])[: len(order)]
            place = np.flatnonzero(head)
            bucket = bucket_of(names[place], buckets)
            by_bucket = np.argsort(bucket, kind="stable")
            place, bounds = place[by_bucket], np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
            entry = np.empty(len(names), np.int64)  # of each phrase, its place among what is sent
            rank = np.empty(len(names), np.int64)
            rank[place] = np.arange(len(place))
            entry[order] = rank[order[head[order]]][np.cumsum(head[order]) - 1]
            touched = np.zeros(len(ids), bool)
            touched[doc] = True
            batch = pa.ipc.open_stream(pa.py_buffer(carried)).read_all()
            used, payloads = [], []
            for kind, chosen in ((-2, np.flatnonzero(~touched)), (-1, np.flatnonzero(touched))):
                if not len(chosen):
                    continue
                used.append(kind)
                sizes = np.diff(offsets)[chosen]
                text = b"".join(buf[offsets[d] : offsets[d + 1]].tobytes() for d in chosen.tolist())
                rows = _ipc(batch.take(pa.array(chosen)).combine_chunks().to_batches()[0])
                arrays = [ids[chosen], lost[chosen], np.append(0, np.cumsum(sizes)), np.frombuffer(text, np.uint8), rows]
                if kind == -1:
                    arrays += [(np.cumsum(touched) - 1)[doc].astype(np.uint32), _steps(at).astype(np.int32), entry.astype(np.uint32), np.packbits(head)]
                payloads.append(pack(*arrays, squeeze=True))
            for k in range(buckets):
                own = place[bounds[k] : bounds[k + 1]]
                if len(own):
                    used.append(label[k])
                    payloads.append(pack(names[own], _steps(ids[doc[own]]), _steps(at[own]), squeeze=True))
            out.append(cells(block, used, payloads))
        return pa.Table.from_batches(out, schema=CELL_ARROW)

    return staged.where("bucket = -1").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, CELLS)


def factors(start: np.ndarray, doc: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """Greedy factors (first word, after the last, source id, source position) from a document's known phrases in order and their places in the index.

    Of a phrase across the end of a factor, the next one has what lies beyond that end.
    """
    if not len(start):
        return np.zeros((0, 4), np.int64)
    follows = (np.diff(start) == 1) & (doc[1:] == doc[:-1]) & (np.diff(at) == 1)
    head = np.append(0, np.flatnonzero(~follows) + 1)
    after = start[np.append(head[1:], len(start)) - 1] + window
    first = np.maximum(start[head], np.append(0, after[:-1]))
    return np.stack([first, after, doc[head], at[head] + first - start[head]], 1)


def _index_places(found: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each phrase that a block sent: whether the index has it at a smaller id, that id (else 0) and position less the block's."""
    known, doc, shift = [np.zeros(0, bool)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n, bits, ids, moved in in_order(found):
        k = np.unpackbits(bits, count=int(n[0])).astype(bool)
        d, s = np.zeros(len(k), np.int64), np.zeros(len(k), np.int64)
        d[k], s[k] = np.cumsum(ids), np.cumsum(moved)
        known.append(k)
        doc.append(d)
        shift.append(s)
    return np.concatenate(known), np.concatenate(doc), np.concatenate(shift)


def _emit(payload, found, schema: pa.Schema, window: int, texts: bool) -> pa.Table:
    """Rows of documents; found says where the index has the block's phrases."""
    ids, lost, offsets, buf, carried, *rest = unpack(payload, squeezed=True)
    batch = pa.ipc.open_stream(pa.py_buffer(carried)).read_all()
    n = np.diff(word_spans(buf, offsets)[2])
    spans: dict[int, np.ndarray] = {}
    if rest:
        place, start, entry, head = rest[0], np.cumsum(rest[1], dtype=np.int64), rest[2], np.unpackbits(rest[3], count=len(rest[0])).astype(bool)
        known, doc, shift = found
        own_doc, own_at = np.empty(len(known), np.int64), np.empty(len(known), np.int64)
        own_doc[entry[head]], own_at[entry[head]] = ids[place[head]], start[head]
        source, at = np.where(known, doc, own_doc)[entry], (own_at + shift)[entry]
        gone = source < ids[place]
        place, start, source, at = place[gone], start[gone], source[gone], at[gone]
        edge = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else np.zeros(0, np.int64)
        for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(place)][: len(edge)], strict=True):
            spans[int(place[a])] = factors(start[a:b], source[a:b], at[a:b], window)
    raw, text, digest, removed, ranges = buf.tobytes(), [], [], [], []
    for d in range(len(ids)):
        whole = raw[offsets[d] : offsets[d + 1]]
        cut = spans.get(d)
        words = whole.split()
        if cut is not None:
            keep, at = [], 0
            for a, b, _, _ in cut.tolist():
                keep += words[at:a]
                at = b
            words = keep + words[at:]
        kept = b" ".join(words)
        digest.append(hashlib.sha256(kept).hexdigest())
        removed.append(0 if cut is None else int((cut[:, 1] - cut[:, 0]).sum()))
        ranges.append([] if cut is None else [dict(zip(SPAN, x, strict=True)) for x in cut.tolist()])
        text.append(None if lost[d] or not texts else (whole if cut is None else kept).decode("utf-8", "replace"))
    return pa.Table.from_arrays([*batch.columns, pa.array(text, schema.field("text").type), pa.array(n), pa.array(removed, pa.int64()), pa.array(digest), pa.array(ranges, schema.field("removed_spans").type)], schema=schema)


def without_repeats(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", carry: tuple[str, ...] = (), window: int = WINDOW, anchor: int = ANCHOR, buckets: int | None = None, block_bytes: int = 4 << 20, texts: bool = True, scope: Scope | None = None) -> DataFrame:
    """The id, the carried columns, text, n_words, n_removed, kept_sha256 and removed_spans of every row.

    Every word goes that lies in ``window`` consecutive words which also start in a document
    with a smaller id; all is judged on the input. text is the input where no word goes, else
    the kept words joined by one blank (null for a null text, or without ``texts``);
    removed_spans are the factors' word ranges, each with the id and the first word of its
    source. A null id is larger than all others; rows with equal ids do not affect each other.
    Texts shorter than the window keep all. Phrases are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    ship(spark)
    own = scope or session_scope(spark)
    buckets = buckets or shuffle_partitions(spark)
    source = docs.select(F.col(id_column).cast("long").alias(id_column), text_column, *[quoted(c) for c in carry])
    fields = [T.StructField(id_column, T.LongType()), *[docs.schema[c] for c in carry], T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType()), T.StructField("removed_spans", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in SPAN])))]
    rows = T.StructType(fields)
    arrow = to_arrow_schema(rows)
    round_one = Scope(spark)
    first = round_one.write(_stage(source, window, anchor, buckets, block_bytes), "minimizers")
    second = own.write(_look_up(first, replies(first, _shared), window, anchor, buckets), "phrases")
    del first
    round_one.drop()

    def plain(batches):
        for batch in batches:
            for payload in batch.column(2).to_pylist():
                yield from _emit(payload, None, arrow, window, texts).to_batches()

    def parsed(docs_: pa.Table, found: pa.Table) -> pa.Table:
        places = _index_places(found)
        made = [_emit(x, places, arrow, window, texts) for x in docs_.column("payload").to_pylist()]
        return pa.concat_tables(made) if made else arrow.empty_table()

    affected = second.where("bucket = -1").groupBy("block").cogroup(replies(second, _places).groupBy("block")).applyInArrow(parsed, rows)
    return second.where("bucket = -2").mapInArrow(plain, rows).unionByName(affected)
