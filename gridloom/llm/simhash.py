"""SimHash near-duplicates: pigeonhole blocks, a join on blocks, and a check of Hamming distance.

A fingerprint is cut into ``b`` blocks. Two fingerprints that differ in at most d bits agree on
at least b - d blocks, so they share one of the C(b, d) keys made of b - d blocks. b is the
smallest number whose keys have more bits than there are distinct fingerprints; any b is exact,
and a larger one only keeps unrelated fingerprints apart. Members of a key are verified and
give a spanning forest of their links rather than all pairs; a key with more members than one
task should hold is cut into chunks, and every pair of chunks is verified.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import free
from .components import components
from .exchange import CELLS, block_ids, cells, in_order, narrow, replies
from .kernels import LOWER, bucket_of, chunks, distinct, ragged, text_buffer, word_spans, xxh64
from .shared import Scope, id_array, join_to_unique, labels, long_ids, pack, session_scope, ship, shuffle_partitions, unpack, unused

WORDS, SEED, DISTANCE = 4, 42, 4
#: Members of a key that one step verifies.
MEMBERS = 16_384
PRINTS = "doc_id long, fingerprint long"


def shingle_spans(buf: np.ndarray, offsets: np.ndarray, words: int):
    """Space-joined copy of the words, the spans of all shingles in it, and the first shingle of each document."""
    starts, ends, first = word_spans(buf, offsets)
    sizes = ends - starts
    stop = np.cumsum(sizes + 1) - 1
    begin = stop - sizes
    joined = np.empty(int(stop[-1]) + 1 if len(stop) else 0, np.uint8)
    joined[ragged(begin, sizes)] = buf[ragged(starts, sizes)]
    joined[stop] = 32
    n = np.diff(first)
    count = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    at = ragged(first[:-1], count)
    last = np.minimum(at + words, np.repeat(first[1:], count)) - 1
    return joined, begin[at], stop[last], np.append(0, np.cumsum(count))


def fingerprint(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A bit is 1 if over half of a document's hashes have it; 0 for a document without any."""
    out = np.zeros(len(first) - 1, np.uint64)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes = np.add.reduceat(bits, first[full], axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * votes > np.diff(first)[full][:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, seed: int = SEED) -> DataFrame:
    """doc_id and fingerprint (the 64 bits as a signed long) of every whole text; a null text has no words."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            buf, offsets = text_buffer(batch.column(1))
            ids, null = long_ids(batch.column(0))
            made = [np.zeros(0, np.uint64)]
            for a, b in chunks(offsets, 1 << 20):
                joined, begin, stop, first = shingle_spans(LOWER[buf[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a], words)
                made.append(fingerprint(xxh64(joined, begin, stop, seed), first))
            yield pa.RecordBatch.from_arrays([id_array(ids, null), pa.array(np.concatenate(made).view(np.int64))], names=["doc_id", "fingerprint"])

    return docs.select(id_column, text_column).mapInArrow(run, PRINTS)


def key_masks(n: int, distance: int) -> list[int]:
    """Masks of the keys for n distinct fingerprints."""
    need = math.log2(max(n, 2)) + 2
    blocks = distance + 1
    while 64 * (blocks - distance) // blocks < min(need, 40):
        blocks += 1
    edge = [64 * i // blocks for i in range(blocks + 1)]
    part = [((1 << edge[i + 1]) - 1) ^ ((1 << edge[i]) - 1) for i in range(blocks)]
    return [sum(part[i] for i in c) for c in itertools.combinations(range(blocks), blocks - distance)]


def spanning(bits: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of links that join all rows of 64-bit words within ``distance`` bits of each other into one tree per component."""
    left, right, rest = [], [], np.arange(len(bits))
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            x = front.pop()
            near = np.bitwise_count(bits[rest] ^ bits[x]).sum(axis=1, dtype=np.int64) <= distance
            if near.any():
                found = rest[near]
                rest = rest[~near]
                left.append(np.full(len(found), x))
                right.append(found)
                front += found.tolist()
    empty = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (empty, empty)


def _verify(distance: int):
    """Links among equal keys of a partition that is sorted by key; a key's rows may lie in several batches."""

    def links(key, node, bits):
        edge = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        start = np.append(0, edge)
        size = np.diff(np.append(start, len(key)))
        pair = start[size == 2]
        near = pair[np.bitwise_count(bits[pair] ^ bits[pair + 1]).sum(axis=1, dtype=np.int64) <= distance]
        left, right = [near], [near + 1]
        for s, n in zip(start[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            a, b = spanning(bits[s : s + n], distance)
            left.append(s + a)
            right.append(s + b)
        return node[np.concatenate(left)], node[np.concatenate(right)]

    def run(batches):
        held = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                if not batch.num_rows:
                    continue
                key = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], 1)
                node = batch.column(4).to_numpy(zero_copy_only=False)
                bits = node.view(np.uint64)[:, None] if batch.num_columns == 5 else text_buffer(batch.column(5))[0].view(np.uint64).reshape(len(node), -1)
                held = (key, node, bits) if held is None else tuple(np.concatenate(x) for x in zip(held, (key, node, bits), strict=True))
                same = (held[0] == held[0][-1]).all(axis=1)
                cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            else:
                cut = len(held[0]) if held else 0
            if cut:
                u, v = links(*(x[:cut] for x in held))
                held = tuple(x[cut:] for x in held)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return run


def verified(keyed: DataFrame, distance: int, members: int = MEMBERS) -> DataFrame:
    """Links (u, v) that connect all nodes that share a key and differ in at most ``distance`` bits.

    keyed has mask, part (the key), node and, unless the node is its own 64 bits, a binary column
    bits. A key with more than ``members`` nodes is cut into chunks; all pairs of chunks are verified.
    """
    rest = keyed.columns[2:]
    large = keyed.groupBy("mask", "part").agg(F.count("*").alias("n")).where(F.col("n") > members)
    if large.isEmpty():
        dealt = keyed.select("mask", "part", F.lit(0).alias("i"), F.lit(0).alias("j"), *rest)
    else:
        large = large.select("mask", "part", F.ceil(F.col("n") / members).cast("int").alias("cut"))
        dealt = keyed.join(large, ["mask", "part"], "left").withColumn("cut", F.coalesce("cut", F.lit(1)))
        dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.col("cut")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
        dealt = dealt.select("mask", "part", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), *rest)
    return dealt.repartition("mask", "part", "i", "j").sortWithinPartitions("mask", "part", "i", "j").mapInArrow(_verify(distance), "u long, v long")


def near_links(prints: DataFrame, n: int, *, distance: int = DISTANCE, members: int = MEMBERS) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints within ``distance`` bits; prints has a column fingerprint without repeats."""
    signed = [m - (1 << 64) if m >> 63 else m for m in key_masks(n, distance)]
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fingerprint").bitwiseAND(F.lit(m).cast("long")).alias("part")) for i, m in enumerate(signed)]))
    keyed = prints.select("fingerprint", keys.alias("k")).select(F.col("k.mask").alias("mask"), F.col("k.part").alias("part"), F.col("fingerprint").alias("node"))
    return verified(keyed, distance, members)


def _lowest(rooted: DataFrame, total: int) -> DataFrame:
    """Adds component_id, the least low of the root's rows; rooted has ``total`` rows."""
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("n"))
    return join_to_unique(rooted, least, "root", total)


def near_duplicates(docs: DataFrame, *, scope: Scope | None = None, distance: int = DISTANCE, words: int = WORDS, seed: int = SEED, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest id linked to it, of every row.

    Texts without words have fingerprint zero and are linked like any others. Repeated rows
    are rows of their own; a null id takes part, and a component of null ids only has a null
    component_id. An empty table gives no rows.
    """
    own = scope or session_scope(docs.sparkSession)
    prints = own.write(fingerprints(docs, id_column=id_column, text_column=text_column, words=words, seed=seed), "fingerprints")
    unique = own.write(prints.groupBy("fingerprint").agg(F.count("*").alias("n"), F.min("doc_id").alias("low")), "distinct-fingerprints")
    n, total = unique.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    links = own.write(near_links(unique.select("fingerprint"), n, distance=distance), "near-links")
    roots = components(links, own)
    rooted = unique.join(roots.select(F.col("u").alias("fingerprint"), F.col("v").alias("root")), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    named = _lowest(rooted.withColumnRenamed("n", "rows"), n).select("fingerprint", F.col("rows").alias("n"), "component_id")
    out = join_to_unique(prints, named, "fingerprint", total)
    out = out.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
    return out


# ---- similarity of word shingles ----
SHINGLE, SIMILARITY = 5, 0.8
#: Ids (8 bytes each) that are broadcast rather than joined by a shuffle of the texts.
FEW = 2_000_000
#: Bits of a shingle's hash by which documents that have it are counted; the counts only order shingles.
KEY_BITS = 44
#: Rows of a key that one task compares with each other; a key with more is cut into chunks, and all pairs of chunks are compared.
TOGETHER = 4096
#: Rounds that compare each key's nodes with one of them only, before all pairs that are still apart.
STARS = 2
#: Pairs that a task makes at a time.
PAIRS = 1 << 20
#: Pairs whose counts are compared at a time.
ROOM = 1 << 14
#: Classes of hashes whose counts (a byte each; none for a set that has one over 255) bound what two sets can share.
CLASSES = 256
SUMMARY = "doc_id long, place long, node long, fingerprint long, size int, counts binary, skip int, prefix array<long>"
SUMMARY_NAMES = [x.split()[0] for x in SUMMARY.split(", ")]


def _once(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes without repeats inside a document, in ascending order."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.append(True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])) if len(h) else np.zeros(0, bool)
    return h[new], np.append(0, np.cumsum(np.bincount(d[new], minlength=len(first) - 1)))


def _sets(buf: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Each document's distinct shingle hashes, ascending, and its first one."""
    hashed, firsts, at = [np.zeros(0, np.uint64)], [], 0
    for a, b in chunks(offsets, 1 << 20):
        joined, begin, stop, first = shingle_spans(LOWER[buf[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a], shingle)
        h, first = _once(xxh64(joined, begin, stop, SEED), first)
        hashed.append(h)
        firsts.append(first[:-1] + at)
        at += len(h)
    return np.concatenate(hashed), np.append(np.concatenate(firsts) if firsts else np.zeros(0, np.int64), at)


def _node(h: np.ndarray, first: np.ndarray) -> pa.Array:
    """A hash of each set."""
    return pa.array(xxh64(h.view(np.uint8), first[:-1] * 8, first[1:] * 8, SEED).view(np.int64))


def shingle_sets(docs: DataFrame, *, shingle: int = SHINGLE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """node (a hash of the set) and hashes (of its distinct shingles)."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            buf, offsets = text_buffer(batch.column(0))
            for a, b in chunks(offsets, 1 << 20):
                h, first = _sets(buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], shingle)
                yield pa.RecordBatch.from_arrays([_node(h, first), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(h.view(np.int64)))], names=["node", "hashes"])

    return docs.select(text_column).mapInArrow(run, "node long, hashes array<long>")


def _stage(docs: DataFrame, shingle: int, buckets: int, block_bytes: int) -> DataFrame:
    """Blocks of documents (their id and text) as cells: bucket -1 holds the documents, the others distinct shingles and how many documents have them."""
    label = labels(buckets).tolist()

    def run(batches):
        ids = block_ids()
        for batch in batches:
            buf, offsets = text_buffer(batch.column(1))
            doc_ids, null = long_ids(batch.column(0))
            for a, b in chunks(offsets, block_bytes):
                part, own = buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                keys = np.sort(_sets(part, own, shingle)[0] >> np.uint64(64 - KEY_BITS))
                edge = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))[: len(keys)]
                n, keys = narrow(np.diff(np.append(edge, len(keys)))), keys[edge]
                bounds = np.searchsorted(bucket_of(keys << np.uint64(64 - KEY_BITS), buckets), np.arange(buckets + 1))
                used, payloads = [-1], [pack(doc_ids[a:b], null[a:b], own, part, squeeze=True)]
                for k in range(buckets):
                    of = slice(bounds[k], bounds[k + 1])
                    if of.stop > of.start:
                        used.append(label[k])
                        payloads.append(pack(narrow(np.diff(keys[of], prepend=keys[of.start])), keys[of.start : of.start + 1], n[of], squeeze=True))
                yield cells(next(ids), used, payloads)

    return docs.mapInArrow(run, CELLS)


def _rarity(parts) -> list[bytes]:
    """For each shingle of each cell a class that rises with the documents that have it; 0: one document."""
    _, _, index = distinct(np.concatenate([np.cumsum(p[0], dtype=np.uint64) + p[1][0] for p in parts]))
    n = np.bincount(index, weights=np.concatenate([p[2] for p in parts]))
    kind = np.minimum(8 * np.log2(np.maximum(n, 1)), 255).astype(np.uint8)[index]
    ends = np.cumsum([len(p[0]) for p in parts]).tolist()
    return [pack(kind[e - len(p[0]) : e], squeeze=True) for p, e in zip(parts, ends, strict=True)]


def summaries(docs: DataFrame, scope: Scope, similarity: float, *, shingle: int = SHINGLE, id_column: str = "doc_id", text_column: str = "text", buckets: int | None = None, block_bytes: int = 1 << 20) -> DataFrame:
    """doc_id, place (a number of its own for each row), node, fingerprint, size, counts (of hashes by class), skip and prefix of each set.

    The prefix is the rarest shingles of the set, the rarest first: two sets that are
    ``similarity`` alike share one of these. Only those that another document has are in the
    column prefix; ``skip`` others come before them.
    """
    ship(docs.sparkSession)
    source = docs.select(F.col(id_column).cast("long"), text_column)
    staged = scope.write(_stage(source, shingle, buckets or shuffle_partitions(docs.sparkSession), block_bytes), "shingle-cells")

    def run(held: pa.Table, found: pa.Table) -> pa.Table:
        kinds = np.concatenate([p[0] for p in in_order(found)] or [np.zeros(0, np.uint8)])
        made = []
        for block, payload in zip(held.column("block").to_pylist(), held.column("payload").to_pylist(), strict=True):
            ids, null, offsets, buf = unpack(payload, squeezed=True)
            h, first = _sets(buf, offsets, shingle)
            size, signed = np.diff(first), h.view(np.int64)
            doc = np.repeat(np.arange(len(size)), size)
            keys = h >> np.uint64(64 - KEY_BITS)
            kind = kinds[distinct(keys)[2]]
            ordered = signed[np.argsort(doc * 256 + kind, kind="stable")]
            count = np.where(size > 0, size - np.ceil(similarity * size - 1e-9).astype(np.int64) + 1, 0)
            skip = np.minimum(np.bincount(doc, weights=kind == 0, minlength=len(size)).astype(np.int64), count)
            prefix = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(count - skip)).astype(np.int32)), pa.array(ordered[ragged(first[:-1] + skip, count - skip)]))
            classes = np.bincount(doc * CLASSES + (h >> np.uint64(56)).astype(np.int64), minlength=len(size) * CLASSES).reshape(-1, CLASSES)
            small = (classes.max(axis=1, initial=0) <= 255).tolist()
            classes = classes.astype(np.uint8)
            place = ((block >> 32) << 44) + ((block & 0xFFFFFFFF) << 22) + np.arange(len(ids))
            made.append(pa.Table.from_arrays([id_array(ids, null), pa.array(place), _node(h, first), pa.array(fingerprint(h, first).view(np.int64)), pa.array(size.astype(np.int32)), pa.array([c.tobytes() if few else b"" for c, few in zip(classes, small, strict=True)], pa.binary()), pa.array(skip.astype(np.int32)), prefix], names=SUMMARY_NAMES))
        return pa.concat_tables(made)

    answers = replies(staged, _rarity)
    return staged.where("bucket = -1").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, SUMMARY)


def _whole_keys(batches, read=lambda c: c.to_numpy(zero_copy_only=False)):
    """Columns of a partition that is sorted by its first one, with all rows of a key together."""
    held = None
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            if not batch.num_rows:
                continue
            now = [read(c) for c in batch.columns]
            held = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
            cut = int(np.searchsorted(held[0], held[0][-1]))
        else:
            cut = len(held[0]) if held else 0
        if cut:
            yield [x[:cut] for x in held]
            held = [x[cut:] for x in held]


def _shared(batches):
    """Rows whose key another row has."""
    for columns in _whole_keys(batches):
        same = columns[0][1:] == columns[0][:-1]
        keep = np.append(False, same) | np.append(same, False)
        yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], names=["key", "node", "size", "place"])


def _counts(column: pa.Array) -> np.ndarray:
    """Counts by class of each row; a row without them has counts that leave all room."""
    buf, offsets = text_buffer(column)
    out = np.full((len(column), CLASSES), 255, np.uint8)
    out[np.diff(offsets) > 0] = buf.reshape(-1, CLASSES)
    return out


def _room(mine: np.ndarray, its: np.ndarray, size: np.ndarray, other: np.ndarray, similarity: float) -> np.ndarray:
    """Whether pairs of sets can be that similar: what they share is at most the sum of the lesser counts. Sets without counts can."""
    most = np.minimum(mine, its).sum(axis=1, dtype=np.int64)
    return (most >= similarity / (1 + similarity) * (size + other) - 1e-9) | (mine.min(axis=1) == 255) | (its.min(axis=1) == 255)


def _possible(pairs: DataFrame, once: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) whose sizes and counts by class leave room for that similarity."""
    of = lambda name: once.select(F.col("node").alias(name), F.struct("size", "counts").alias(f"{name}_"))
    both = pairs.join(of("u"), "u").join(of("v"), "v").select("u", "v", "u_.*", F.col("v_.size").alias("size_v"), F.col("v_.counts").alias("counts_v"))

    def run(batches):
        for batch in batches:
            size, other = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 4))
            may = pa.array(_room(_counts(batch.column(3)), _counts(batch.column(5)), size, other, similarity))
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(may) for i in (0, 1)], names=["u", "v"])

    return both.mapInArrow(run, "u long, v long")


def _pairs(similarity: float):
    """Pairs of a group's nodes of different roots that may be similar by their sizes and the key's places in them.

    Rows are sorted by group and root: group, root, node, size, place, chunk and counts. Of a
    group of two chunks only pairs across them are made; pairs without room are not.
    """
    read = lambda c: _counts(c) if pa.types.is_binary(c.type) else c.to_numpy(zero_copy_only=False)

    def run(batches):
        for group, root, node, size, place, chunk, counts in _whole_keys(batches, read):
            size, place = size.astype(np.int64), place.astype(np.int64)
            new = np.append(True, group[1:] != group[:-1])
            start = np.flatnonzero(new)
            own = np.cumsum(new) - 1
            two = np.maximum.reduceat(chunk, start) != np.minimum.reduceat(chunk, start)
            runs = np.flatnonzero(new | np.append(True, root[1:] != root[:-1]))
            begin = np.repeat(np.append(runs[1:], len(group)), np.diff(np.append(runs, len(group))))
            count = np.append(start[1:], len(group))[own] - begin
            total = np.append(0, np.cumsum(count))
            at = 0
            while at < len(group):
                end = max(at + 1, int(np.searchsorted(total, total[at] + PAIRS, side="right")) - 1)
                a, b = np.repeat(np.arange(at, end), count[at:end]), ragged(begin[at:end], count[at:end])
                need = similarity / (1 + similarity) * (size[a] + size[b]) - 1e-9
                may = (np.minimum(size[a] - place[a], size[b] - place[b]) >= need) & (~two[own[a]] | (chunk[a] != chunk[b]))
                a, b = a[may], b[may]
                may = np.concatenate([np.zeros(0, bool)] + [_room(counts[x], counts[y], size[x], size[y], similarity) for x, y in zip(*(np.array_split(z, len(a) // ROOM + 1) for z in (a, b)), strict=True)])
                u, v = np.minimum(node[a[may]], node[b[may]]), np.maximum(node[a[may]], node[b[may]])
                order = np.lexsort((v, u))
                u, v = u[order], v[order]
                once = np.append(True, (u[1:] != u[:-1]) | (v[1:] != v[:-1]))[: len(u)]
                yield pa.RecordBatch.from_arrays([pa.array(u[once]), pa.array(v[once])], names=["u", "v"])
                at = end

    return run


def _starred(shared: DataFrame, similarity: float, turn: int) -> DataFrame:
    """Distinct pairs (u, v) of each key's nodes with one of them, of different roots and similar enough by size and place.

    Keys and turns draw their centres anew, so a node meets as many others as it has keys.
    """
    centre = F.min(F.struct(F.xxhash64("node", "key", F.lit(turn)), "root", "node", "size", "place")).alias("c")
    both = join_to_unique(shared, shared.groupBy("key").agg(centre, F.count("*").alias("n")).where("n > 1"), "key", shared.count())
    need = similarity / (1 + similarity) * (F.col("size") + F.col("c.size")) - 1e-9
    may = (F.col("root") != F.col("c.root")) & (F.least(F.col("size") - F.col("place"), F.col("c.size") - F.col("c.place")) >= need)
    return both.where(may).select(F.least("node", "c.node").alias("u"), F.greatest("node", "c.node").alias("v")).distinct()


def _all_pairs(shared: DataFrame, once: DataFrame, similarity: float, together: int | None = None) -> DataFrame:
    """Distinct pairs (u, v) of nodes of different roots that share a key and are similar enough by size, place and counts.

    A task makes them a part at a time and emits those that remain.
    """
    together = together or TOGETHER
    shared = shared.join(once.select("node", "counts"), "node")
    rows = shared.select(F.col("key").alias("group"), "root", "node", "size", "place", F.lit(0).alias("chunk"), "counts")
    large = shared.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > together)
    if not large.isEmpty():
        cut = large.select("key", F.ceil(F.col("n") / together).cast("int").alias("cut"))
        dealt = shared.join(cut, "key", "left").withColumn("cut", F.coalesce("cut", F.lit(1)))
        dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("cut")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
        group = F.when(F.col("cut") == 1, F.col("key")).otherwise(F.xxhash64("key", F.least("chunk", "other"), F.greatest("chunk", "other")))
        rows = dealt.select(group.alias("group"), "root", "node", "size", "place", "chunk", "counts")
    rows = rows.repartition("group").sortWithinPartitions("group", "root")
    return rows.mapInArrow(_pairs(similarity), "u long, v long").distinct()


def _alike(pairs: DataFrame, once: DataFrame, sets_of, scope: Scope, similarity: float) -> DataFrame:
    """The pairs (u, v) whose sets have at least that Jaccard similarity; sets_of(ids) gives the sets of documents with these ids, and maybe others."""
    used = scope.write(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct(), "used")
    few = used.count() <= FEW
    small = F.broadcast if few else lambda rows: rows
    ids = scope.write(once.join(small(used), "node", "left_semi").select("doc_id").distinct(), "used-ids")
    sets = sets_of(small(ids)).join(small(used), "node", "left_semi")
    sets = scope.write(sets.groupBy("node").agg(F.first("hashes").alias("hashes")), "sets")
    of = lambda name, to: sets.select(F.col("node").alias(name), F.col("hashes").alias(to))
    both = F.size(F.array_intersect("a", "b"))
    return pairs.join(of("u", "a"), "u").join(of("v", "b"), "v").where(both / (F.size("a") + F.size("b") - both) >= similarity).select("u", "v")


def _fingerprint_pairs(once: DataFrame, scope: Scope, distance: int) -> DataFrame:
    """Pairs (u, v) of nodes whose fingerprints are equal or linked by pigeonhole blocks, each node with one other of its fingerprint."""
    nodes = once.select("node", "fingerprint")
    unique = scope.write(nodes.groupBy("fingerprint").agg(F.count("*").alias("n"), F.min("node").alias("first")), "distinct-fingerprints")
    n, total = unique.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    same = join_to_unique(nodes, unique.where("n > 1"), "fingerprint", total).where("node <> first").select("first", "node")
    links = near_links(unique.select("fingerprint"), n, distance=distance)
    node_of = lambda name, to: unique.select(F.col("fingerprint").alias(name), F.col("first").alias(to))
    near = links.join(node_of("u", "a"), "u").join(node_of("v", "b"), "v").select("a", "b")
    return same.union(near).select(F.least(*same.columns).alias("u"), F.greatest(*same.columns).alias("v")).distinct()


def similar_links(once: DataFrame, sets_of, scope: Scope, similarity: float = SIMILARITY, distance: int = DISTANCE) -> DataFrame:
    """Roots (u, v) of the nodes linked by sets at least ``similarity`` alike; once has the summary of each node once.

    Candidates come from the pigeonhole blocks of fingerprints first. Fingerprints of sets that
    are just ``similarity`` alike share no block often enough, so pairs that share one of the
    rarest shingles of both (prefixes) follow; those miss no pair. What counts by class cannot
    rule out is verified by the exact Jaccard similarity of the sets (sets_of, made from the
    texts anew), and nodes that are connected already are not compared again.
    """
    keyed = once.select("node", "size", "skip", F.posexplode("prefix").alias("place", "key")).select("key", "node", "size", (F.col("place") + F.col("skip")).alias("place"))
    keyed = keyed.repartition("key").sortWithinPartitions("key")
    shared = scope.write(keyed.mapInArrow(_shared, keyed.schema), "shared-keys")
    total = shared.count()
    links = roots = None
    for turn in range(STARS + 2):
        if turn == 0:
            pairs = _fingerprint_pairs(once, scope, distance)
        else:
            rows = shared.join(roots.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").withColumn("root", F.coalesce("root", "node"))
            apart = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n")).where("low < high").select("key", "n")
            rows = scope.write(join_to_unique(rows, apart, "key", total).select("key", "root", "node", "size", "place"), "keys-apart")
            pairs = _starred(rows, similarity, turn) if turn <= STARS else _all_pairs(rows, once, similarity)
        pairs = scope.write(pairs if turn > STARS else _possible(pairs, once, similarity), "pairs")
        found = scope.write(_alike(pairs, once, sets_of, scope, similarity), "similar-links")
        if roots is not None and found.isEmpty():
            continue
        links = found if roots is None else roots.union(found)
        roots = components(links, scope)
        free(scope.spark)
    return roots


def similar_groups(docs: DataFrame, *, scope: Scope, similarity: float = SIMILARITY, shingle: int = SHINGLE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and component_id of every row: documents linked by sets of word shingles at least ``similarity`` alike (Jaccard).

    Texts shorter than a shingle are one shingle; those without words are alike.
    """
    columns = {"shingle": shingle, "id_column": id_column, "text_column": text_column}
    inner = Scope(docs.sparkSession)
    made = scope.write(summaries(docs, inner, similarity, **columns), "summaries")
    inner.drop()
    nodes = scope.write(made.groupBy("node").agg(F.count("*").alias("n"), F.min("doc_id").alias("low"), F.min("place").alias("place")), "nodes")
    n, total = nodes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    again = scope.write(made.select("place").join(nodes.select("place"), "place", "left_anti"), "copies")
    once = made.join(F.broadcast(again) if again.count() <= FEW else again, "place", "left_anti")

    def sets_of(ids):
        own = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
        return shingle_sets(own.join(ids, own["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi"), shingle=shingle)

    roots = similar_links(once, sets_of, scope, similarity)
    rooted = nodes.select("node", F.col("n").alias("rows"), "low").join(roots.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = _lowest(rooted, n).select("node", F.col("rows").alias("n"), "component_id")
    return join_to_unique(made.select("doc_id", "node"), named, "node", total).select("doc_id", "component_id")


def one_of_each(docs: DataFrame, *, scope: Scope, id_column: str = "doc_id", **options) -> DataFrame:
    """The rows of docs without those similar to a smaller id.

    A document is its id: rows that repeat an id stay or go together, and rows with a null id stay.
    """
    inner = Scope(docs.sparkSession)
    groups = scope.write(similar_groups(docs, scope=inner, id_column=id_column, **options), "groups")
    inner.drop()
    gone = groups.where(F.col("component_id") < F.col("doc_id")).select("doc_id").distinct()
    staying = groups.where(F.col("component_id") == F.col("doc_id")).select("doc_id")
    key = unused("gone", docs)
    gone = scope.write(gone.join(staying, "doc_id", "left_anti").withColumnRenamed("doc_id", key), "gone")
    if gone.count() <= FEW:
        gone = F.broadcast(gone)
    return docs.join(gone, docs[f"`{id_column}`"] == gone[key], "left_anti")
