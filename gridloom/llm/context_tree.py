"""Language-model scores by context-tree weighting over byte contexts.

A byte is eight binary decisions. A decision has one Krichevsky-Trofimov estimator for each
depth, 0 to DEPTH preceding bytes; weights of one half at every node of the tree, settled by
the training texts, mix the estimates of all depths that training has seen. Texts are taken
as their words in lower case, joined by one blank, and an end symbol.

The model is never in one place. Blocks of documents send their distinct contexts and counts
in packed cells, sharded by the two nearest bytes; a shard holds all of the tree below those
bytes. Only depths 0 and 1, at most 256 * 255 nodes, are put together on the driver. Shards
answer each cell with the code lengths of its contexts, and a block scores its documents. What
is gathered grows with the corpus; each task holds one block or one shard. The same cells
carry words and their counts for the base score.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import CELL_ARROW, CELLS, block_ids, cells
from .kernels import LOWER, bucket_of, chunks, crc32_mod, distinct, mix, ragged, span_hashes, text_buffer, word_spans
from .shared import Scope, id_array, labels, long_ids, pack, session_scope, ship, shuffle_partitions, unpack

DEPTH = 5
END = 0xFF  # in no UTF-8 text
FOLDS, HELD_OUT = 7, 2
CHUNK = 1 << 20
BLOCK = 16 << 20
END_WORD = np.uint64(0x5EED0FE9D1A1B2C3)
U64 = np.uint64
TOP = "node int, a double, b double, s double"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, code_bits double, bits_per_byte double"


def joined_words(buf: np.ndarray, offsets: np.ndarray):
    """Lower-case words joined by one blank, the joined texts' offsets, the words' spans in them, and each text's first word."""
    buf = LOWER[buf]
    starts, ends, first = word_spans(buf, offsets)
    sizes = ends - starts
    stop = np.cumsum(sizes + 1) - 1
    begin = stop - sizes
    out = np.full(int(stop[-1]) + 1 if len(stop) else 0, 32, np.uint8)
    out[ragged(begin, sizes)] = buf[ragged(starts, sizes)]
    bounds = np.append(begin, len(out))[first]  # a text's last blank is dropped by `symbols`
    return out, bounds, begin, stop, first


def symbols(joined: np.ndarray, bounds: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all symbols (nearest context byte first, the symbol last) and each text's first symbol.

    A text's blank after its last word becomes its end symbol; a text without words is an end symbol only.
    """
    sizes = np.maximum(np.diff(bounds), 1)
    first = np.append(0, np.cumsum(sizes))
    n = len(sizes)
    stream = np.full(int(first[-1]) + depth * n + depth, END, np.uint8)
    place = first[:-1] + depth * (np.arange(n) + 1)
    full = np.diff(bounds)
    stream[ragged(place, np.maximum(full - 1, 0))] = joined[ragged(bounds[:-1], np.maximum(full - 1, 0))]
    at = ragged(place, sizes)
    codes = stream[at].astype(U64)
    for k in range(1, depth + 1):
        codes |= stream[at - k].astype(U64) << U64(8 * (depth - k + 1))
    return codes, first


def counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    u, _, index = distinct(keys)
    return u, np.bincount(index, weights=counts, minlength=len(u)).astype(np.int64)


def squeeze_keys(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=U64(0))


def shard_of(codes: np.ndarray, buckets: int, depth: int = DEPTH) -> np.ndarray:
    """Bucket by the two nearest bytes."""
    return bucket_of(mix(codes >> U64(8 * (depth - 1))), buckets).astype(np.int64)


def stage(docs: DataFrame, id_column: str, text_column: str, buckets: int, block_bytes: int, folds: int, held_out: int) -> DataFrame:
    ship(docs.sparkSession)
    label = labels(buckets).tolist()

    def run(batches):
        ids, held, size = block_ids(), [], 0
        for batch in batches:
            buf, offsets = text_buffer(batch.column(1))
            doc_ids, null = long_ids(batch.column(0))
            for a, b in chunks(offsets, block_bytes):
                part = (buf[offsets[a] : offsets[b]], np.diff(offsets[a : b + 1]), doc_ids[a:b], null[a:b])
                if held and size + len(part[0]) > block_bytes:
                    yield block(next(ids), held)
                    held, size = [], 0
                held.append(part)
                size += len(part[0])
        if held:
            yield block(next(ids), held)

    def block(block_id, parts):
        doc_ids, null = np.concatenate([p[2] for p in parts]), np.concatenate([p[3] for p in parts])
        train = (crc32_mod(doc_ids, folds) != held_out) & ~null
        texts, sizes = [], []
        for buf, lengths, _, _ in parts:
            offsets = np.append(0, np.cumsum(lengths))
            for a, b in chunks(offsets, CHUNK):
                joined, bounds, _, _, _ = joined_words(buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                texts.append(joined)
                sizes.append(np.diff(bounds))
        parts.clear()
        sizes, text = np.concatenate(sizes), np.concatenate(texts)
        del texts
        codes, n, edge, names, c, word_edge = contents(sizes, text, train, buckets)
        payloads, used = [pack(doc_ids, null, train, sizes, text, squeeze=True)], [-1]
        for k in range(buckets):
            own, w = slice(edge[k], edge[k + 1]), slice(word_edge[k], word_edge[k + 1])
            if own.stop > own.start or w.stop > w.start:
                payloads.append(pack(squeeze_keys(codes[own]), n[own].astype(np.uint32), squeeze_keys(names[w]), c[w].astype(np.uint32), squeeze=True))
                used.append(label[k])
        return cells(block_id, used, payloads)

    return docs.select(id_column, text_column).mapInArrow(run, CELLS)


def contents(sizes: np.ndarray, text: np.ndarray, train: np.ndarray, buckets: int):
    """A block's distinct codes and words by bucket, how often training texts have them, and the buckets' edges."""
    grams, words, bounds = [], [], np.append(0, np.cumsum(sizes))
    for a, b in chunks(bounds, CHUNK):
        joined, own = text[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
        codes, at = symbols(joined, own)
        grams.append(_flagged(np.sort((codes << U64(1)) | np.repeat(train[a:b], np.diff(at)).astype(U64))))
        starts, ends, first = word_spans(joined, own)
        u, _, index = distinct(span_hashes(joined, starts, ends))
        words.append((u, np.bincount(index, weights=np.repeat(train[a:b], np.diff(first)), minlength=len(u)).astype(np.int64)))
    words.append((np.array([END_WORD]), np.array([int(train.sum())])))
    codes, n = counted(np.concatenate([g[0] for g in grams]), np.concatenate([g[1] for g in grams]))
    names, c = counted(np.concatenate([w[0] for w in words]), np.concatenate([w[1] for w in words]))
    shard = shard_of(codes, buckets)
    order = np.argsort(shard, kind="stable")
    return codes[order], n[order], np.searchsorted(shard[order], np.arange(buckets + 1)), names, c, np.searchsorted(bucket_of(names, buckets).astype(np.int64), np.arange(buckets + 1))


def _flagged(keys):
    """Distinct codes of sorted (code, flag) keys, and how many have the flag."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    edge = np.append(0, np.flatnonzero(keys[1:] != keys[:-1]) + 1)
    size = np.diff(np.append(edge, len(keys)))
    code, flag = keys[edge] >> U64(1), (keys[edge] & U64(1)).astype(bool)
    first = np.append(0, np.flatnonzero(code[1:] != code[:-1]) + 1)
    return code[first], np.add.reduceat(np.where(flag, size, 0), first)


# ---- the tree ----
_HALF = np.array([math.lgamma(i + 0.5) for i in range(4096)])
_WHOLE = np.array([math.lgamma(i + 1.0) for i in range(4096)])


def _lgamma(table: np.ndarray, n: np.ndarray, shift: float) -> np.ndarray:
    out = table[np.minimum(n, len(table) - 1)]
    big = np.flatnonzero(n >= len(table))
    if len(big):
        x = n[big] + shift
        out[big] = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return out


def log_estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log probability that the Krichevsky-Trofimov estimator gives a zeros and b ones."""
    a, b = a.astype(np.int64), b.astype(np.int64)
    return _lgamma(_HALF, a, 0.5) + _lgamma(_HALF, b, 0.5) - _lgamma(_WHOLE, a + b, 1.0) - math.log(math.pi)


class Level:
    """All nodes of one depth: for each of a byte's eight decisions, the nodes that (context, byte) pairs pass."""

    def __init__(self, pairs: np.ndarray, n: np.ndarray):
        self.node, self.key, self.a, self.b = [], [], [], []
        y = (pairs & U64(255)).astype(np.int64)
        for k in range(8):
            prefix = (1 << k) | (y >> (8 - k))
            key = (pairs & ~U64(255)) | prefix.astype(U64)
            new = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, bool)
            edge = np.flatnonzero(new)
            ones = n * ((y >> (7 - k)) & 1)
            total = np.add.reduceat(n, edge) if len(edge) else n[:0]
            b = np.add.reduceat(ones, edge) if len(edge) else n[:0]
            self.node.append(np.cumsum(new) - 1)
            self.key.append(key[edge])
            self.a.append(total - b)
            self.b.append(b)

    def settle(self, below: list[np.ndarray]) -> None:
        """Weights from the children's log probabilities (none: a leaf)."""
        self.log, self.stop, self.one, self.seen = [], [], [], []
        for k in range(8):
            own = log_estimate(self.a[k], self.b[k])
            log = np.logaddexp(own, below[k]) - math.log(2) if below else own
            self.log.append(log)
            self.stop.append(np.exp(own - math.log(2) - log) if below else np.ones(len(own)))
            total = self.a[k] + self.b[k]
            self.one.append((self.b[k] + 0.5) / (total + 1))
            self.seen.append(total > 0)

    def to_parents(self, parents: list[np.ndarray]) -> list[np.ndarray]:
        """Sums of the children's log probabilities for each parent key."""
        out = []
        for k in range(8):
            parent = ((self.key[k] >> U64(16)) << U64(8)) | (self.key[k] & U64(255))
            out.append(np.bincount(np.searchsorted(parents[k], parent), weights=self.log[k], minlength=len(parents[k])))
        return out


def grow(codes: np.ndarray, n: np.ndarray, lowest: int, depth: int = DEPTH) -> tuple[dict[int, Level], dict[int, np.ndarray]]:
    """Settled levels depth..lowest for sorted distinct codes, and each code's pair at each level; the level above ``lowest`` is counted only."""
    levels, index = {}, {}
    for d in range(depth, lowest - 2, -1):
        pairs = ((codes >> U64(8 * (depth - d + 1))) << U64(8)) | (codes & U64(255))
        u, _, index[d] = distinct(pairs)
        levels[d] = Level(u, np.bincount(index[d], weights=n, minlength=len(u)).astype(np.int64))
    for d in range(depth, lowest - 1, -1):
        levels[d].settle(levels[d + 1].to_parents(levels[d].key) if d < depth else [])
    return levels, index


class Top:
    """Depths 0 and 1 of the tree, dense: at most 256 * 255 nodes, the same on every shard."""

    def __init__(self, node: np.ndarray, a: np.ndarray, b: np.ndarray, s: np.ndarray):
        self.stop, self.one, self.seen = [], [], []
        below, a0, b0 = np.zeros(256), np.zeros(256), np.zeros(256)
        prefix = node & 255
        np.add.at(a0, prefix, a)
        np.add.at(b0, prefix, b)
        own = log_estimate(a, b)
        log = np.logaddexp(own, s) - math.log(2)
        np.add.at(below, prefix, log)
        own0 = log_estimate(a0, b0)
        log0 = np.logaddexp(own0, below) - math.log(2)
        for size, at, x, y, mine, all_ in ((256, np.arange(256), a0, b0, own0, log0), (65536, node, a, b, own, log)):
            stop, one, seen = np.ones(size), np.full(size, 0.5), np.zeros(size, bool)
            stop[at], one[at], seen[at] = np.exp(mine - math.log(2) - all_), (y + 0.5) / (x + y + 1), x + y > 0
            self.stop.append(stop)
            self.one.append(one)
            self.seen.append(seen)


def log_probabilities(codes: np.ndarray, n: np.ndarray, top: Top, depth: int = DEPTH) -> np.ndarray:
    """Natural log of every code's symbol given its context, codes sorted and distinct."""
    levels, index = grow(codes, n, 2, depth)
    total = np.zeros(len(codes))
    y = (codes & U64(255)).astype(np.int64)
    nearest = (codes >> U64(8 * depth)).astype(np.int64)
    for k in range(8):
        prefix = (1 << k) | (y >> (8 - k))
        one, deeper = np.full(len(codes), 0.5), np.zeros(len(codes), bool)
        for d in range(depth, -1, -1):
            if d >= 2:
                at, x = levels[d].node[k][index[d]], levels[d]
                stop, own, seen = x.stop[k][at], x.one[k][at], x.seen[k][at]
            else:
                at = (nearest << 8 | prefix) if d else prefix
                stop, own, seen = top.stop[d][at], top.one[d][at], top.seen[d][at]
            one = np.where(deeper, stop * own + (1 - stop) * one, own)
            deeper = seen
        total += np.log(np.where((y >> (7 - k)) & 1, one, 1 - one))
    return total


def _gather(payloads: list) -> tuple[list[list[np.ndarray]], np.ndarray, np.ndarray, np.ndarray]:
    """Cells of a shard, its sorted distinct codes with their counts, and each cell entry's code."""
    parts = [unpack(x, squeezed=True) for x in payloads]
    codes = np.concatenate([np.cumsum(p[0]) for p in parts]) if parts else np.zeros(0, U64)
    u, _, index = distinct(codes)
    n = np.bincount(index, weights=np.concatenate([p[1] for p in parts]) if parts else None, minlength=len(u)).astype(np.int64) if len(u) else np.zeros(0, np.int64)
    return parts, u, n, index


def _words(parts) -> tuple[np.ndarray, np.ndarray]:
    names = np.concatenate([np.cumsum(p[2]) for p in parts])
    u, _, index = distinct(names)
    return np.bincount(index, weights=np.concatenate([p[3] for p in parts]), minlength=len(u)).astype(np.int64), index


def tops(staged: DataFrame) -> DataFrame:
    """Depth-1 nodes of every shard with the log probabilities below them; node -1 has training tokens and distinct ones."""

    def run(table: pa.Table) -> pa.Table:
        parts, codes, n, _ = _gather(table.column("payload").to_pylist())
        c, _ = _words(parts)
        rows = [(np.array([-1]), np.array([c.sum()]), np.array([(c > 0).sum()]), np.zeros(1))]
        if len(codes):
            levels, _ = grow(codes, n, 2)
            below = levels[2].to_parents(levels[1].key)
            rows += [(levels[1].key[k].astype(np.int64), levels[1].a[k], levels[1].b[k], below[k]) for k in range(8)]
        made = [np.concatenate(x) for x in zip(*rows, strict=True)]
        return pa.table([pa.array(made[0], pa.int32()), *[pa.array(x, pa.float64()) for x in made[1:]]], names=["node", "a", "b", "s"])

    found = staged.where("bucket >= 0").groupBy("bucket").applyInArrow(run, TOP)
    return found.groupBy("node").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("s").alias("s"))


def answers(staged: DataFrame, top: Top) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        parts, codes, n, index = _gather(table.column("payload").to_pylist())
        log = log_probabilities(codes, n, top).astype(np.float32) if len(codes) else np.zeros(0, np.float32)
        c, word = _words(parts)
        out, a, b = [], 0, 0
        for p in parts:
            out.append(pack(log[index[a : a + len(p[0])]], c[word[b : b + len(p[2])]].astype(np.uint32), squeeze=True))
            a += len(p[0])
            b += len(p[2])
        return pa.Table.from_arrays([table.column("block"), table.column("bucket"), pa.array(out, pa.binary())], schema=CELL_ARROW)

    return staged.where("bucket >= 0").groupBy("bucket").applyInArrow(run, CELLS)


class Lookup:
    """Places of 64-bit keys by open addressing, all needles in lockstep; every needle must be a key."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = keys
        self.table = np.zeros(1 << self.bits, np.int32)
        taken = np.zeros(1 << self.bits, bool)
        left, slot = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        while len(left):
            free = ~taken[slot]
            self.table[slot[free]] = left[free]  # the last of several wins
            won = free & (self.table[slot] == left)
            taken[slot[won]] = True
            left, slot = left[~won], (slot[~won] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys):
        return ((keys * U64(0x9E3779B97F4A7C15)) >> U64(64 - self.bits)).astype(np.int64)

    def find(self, needles: np.ndarray) -> np.ndarray:
        slot = self._slot(needles)
        out = self.table[slot]
        left = np.flatnonzero(self.keys[out] != needles)
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            got = self.table[slot]
            out[left] = got
            wrong = self.keys[got] != needles[left]
            left, slot = left[wrong], slot[wrong]
        return out


def scores(staged: DataFrame, answered: DataFrame, tokens: int, vocabulary: int, buckets: int) -> DataFrame:
    floor = math.log10(tokens + vocabulary + 1)
    kinds = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("code_bits", pa.float64()), ("bits_per_byte", pa.float64())]

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        order = np.argsort(found.column("bucket").to_numpy())
        payloads = found.column("payload").to_pylist()
        parts = [unpack(payloads[i], squeezed=True) for i in order.tolist()]
        log = np.concatenate([p[0] for p in parts] or [np.zeros(0, np.float32)])
        c = np.concatenate([p[1] for p in parts] or [np.zeros(0, np.uint32)]).astype(np.int64)
        del parts
        gain = np.log10(c + 1)
        out = []
        for payload in docs.column("payload").to_pylist():
            doc_ids, null, train, sizes, text = unpack(payload, squeezed=True)
            codes, _, _, names, _, _ = contents(sizes, text, train, buckets)
            code_at, name_at = Lookup(codes), Lookup(names)
            end = int(name_at.find(np.array([END_WORD]))[0])
            bounds = np.append(0, np.cumsum(sizes))
            for a, b in chunks(bounds, CHUNK):
                joined, own = text[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
                grams, at = symbols(joined, own)
                score = np.add.reduceat(log[code_at.find(grams)].astype(np.float64), at[:-1])
                starts, ends, first = word_spans(joined, own)
                word = name_at.find(span_hashes(joined, starts, ends))
                base = np.append(0, np.cumsum(gain[word]))
                known = np.append(0, np.cumsum(c[word] > 0))
                n = np.diff(first) + 1
                out.append(pa.table([id_array(doc_ids[a:b], null[a:b]), pa.array(~train[a:b].astype(bool) & ~null[a:b].astype(bool)), pa.array(n), pa.array(known[first[1:]] - known[first[:-1]] + int(c[end] > 0)), pa.array(np.full(b - a, tokens)), pa.array(base[first[1:]] - base[first[:-1]] + gain[end] - n * floor), pa.array(score / math.log(10)), pa.array(-score / math.log(2)), pa.array(-score / math.log(2) / np.diff(at))], schema=pa.schema(kinds)))
        return pa.concat_tables(out) if out else pa.schema(kinds).empty_table()

    return staged.where("bucket = -1").groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(run, SCORES)


def text_scores(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", folds: int = FOLDS, held_out: int = HELD_OUT, buckets: int | None = None, block_bytes: int = BLOCK, scope: Scope | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10), code_bits and bits_per_byte of every row.

    code_bits is the length of the text's code; its bytes are those of its words joined by one
    blank, and the end symbol.

    Rows whose crc32(id) modulo folds is not held_out train; rows with a null id neither train
    nor are held out. A null text is empty: its end alone is scored. Repeated rows count and
    are scored as often as they occur. Without any training text every decision has
    probability one half. An empty table gives no rows.
    """
    spark = docs.sparkSession
    own = scope or session_scope(spark)
    buckets = buckets or shuffle_partitions(spark)
    staged = own.write(stage(docs, id_column, text_column, buckets, block_bytes, folds, held_out), "context-cells")
    rows = tops(staged).collect()  # at most 256 * 255 + 1 rows
    tokens, vocabulary = next(((int(r["a"]), int(r["b"])) for r in rows if r["node"] < 0), (0, 0))
    nodes = sorted((r["node"], r["a"], r["b"], r["s"]) for r in rows if r["node"] >= 0)
    node, a, b, s = np.array(nodes).reshape(-1, 4).T
    return scores(staged, answers(staged, Top(node.astype(np.int64), a, b, s)), tokens, vocabulary, buckets)
