"""Packing: shortest-pack-first over the length histogram, patterns joined back by rank.

Documents become pieces (whole sequences of ``size`` ids, then the rest cut at descending
powers of two down to ``cut_above``); only the histogram of piece lengths, at most ``size``
entries, reaches the driver. Lengths are placed longest first, each into the shortest pack
that takes it, by counts of equal packs. Every slot of a packing pattern then owns a range of
ranks among the pieces of its length, and a piece finds its slot by its rank.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import exchange
from .kernels import ragged
from .shared import Scope, pack, session_scope, ship, shuffle_partitions, unpack

TOKENIZER = "word_bpe_49k.json"
SIZE = 2048
END_ID = 1
CUT_ABOVE = 512
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PIECE_ARROW = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")])
PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cuts(length: int, size: int, cut_above: int) -> list[int]:
    """Piece lengths of a document: whole sequences, then powers of two while the rest is over cut_above, then the rest."""
    out = [size] * (length // size)
    rest = length % size
    part = size // 2
    while rest > cut_above:
        if rest >= part:
            out.append(part)
            rest -= part
        part //= 2
    return out + [rest] * (rest > 0)


def spread(histogram: dict[int, int], size: int) -> list[tuple[int, list[int]]]:
    """Packing patterns (number of sequences, lengths in order) for counts of lengths.

    Longest lengths first; each goes to the shortest pack with room, and opens packs, filled
    with as many of that length as they hold, only when none has room. The number of patterns
    is bounded by the histogram, not by the documents.
    """
    packs: dict[int, list[list]] = {}  # room -> [count, lengths]
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r in packs if r >= length), default=None)
            if room is None:
                each = size // length
                whole, rest = divmod(left, each)
                for n, k in ((whole, each), (1, rest)):
                    if n and k:
                        packs.setdefault(size - k * length, []).append([n, [length] * k])
                break
            group = packs[room][-1]
            n = min(left, group[0])
            packs.setdefault(room - length, []).append([n, group[1] + [length]])
            group[0] -= n
            left -= n
            if not group[0]:
                packs[room] = [g for g in packs[room] if g[0]]
                if not packs[room]:
                    del packs[room]
    return [(n, lengths) for room in sorted(packs) for n, lengths in packs[room]]


def slots(patterns: list[tuple[int, list[int]]], size: int) -> dict[str, np.ndarray]:
    """Ranges of ranks by length: key length*2**40+first rank, with the sequence and offset of that rank."""
    rank, rows, sequence = Counter(), [], 0
    for n, lengths in patterns:
        offset = 0
        for length in lengths:
            rows.append(((length << 40) + rank[length], sequence, offset))
            rank[length] += n
            offset += length
        sequence += n
    rows.sort()
    made = np.array(rows, np.int64).reshape(-1, 3)
    return {"key": made[:, 0], "sequence": made[:, 1], "offset": made[:, 2]}


def _sequence(doc_ids, null, n_bytes, first, index) -> bytes:
    return pack(doc_ids, null, first, index, squeeze=True)


def _ids(tokenizer, tokens):
    made = [tokenizer.ids(t) for t in tokens]
    sizes = np.fromiter(map(len, made), np.uint32, len(made))
    flat = np.fromiter((i for x in made for i in x), np.uint16 if tokenizer.size <= 1 << 16 else np.uint32, int(sizes.sum()))
    return sizes, flat


def _pieces(size: int, cut_above: int, end_id: int):
    def finish(payload, sizes, values):
        doc_ids, null, first, index = unpack(payload, squeezed=True)
        begin = np.cumsum(sizes, dtype=np.int64) - sizes
        out = []
        step = 1 << 19  # tokens at a time
        a, n = 0, len(first) - 1
        while a < n:
            b = max(a + 1, int(np.searchsorted(first, first[a] + step, "right")) - 1)
            own = index[first[a] : first[b]]
            lengths = sizes[own].astype(np.int64)
            ids = values[ragged(begin[own], lengths)].astype("<u4")
            ends = np.concatenate([[0], np.cumsum(lengths)])[first[a : b + 1] - first[a]].tolist()
            for d in range(a, b):
                lo, hi = ends[d - a], ends[d - a + 1]
                raw = memoryview(np.append(ids[lo:hi], np.uint32(end_id)).astype("<u4").tobytes())
                start, total = 0, hi - lo + 1
                doc = None if null[d] else int(doc_ids[d])
                for length in cuts(total, size, cut_above):
                    out.append((doc, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)]), total))
                    start += length
            a = b
        return [pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 5)]

    return finish


def token_pieces(docs: DataFrame, *, scope: Scope, id_column: str = "doc_id", text_column: str = "text", path: str | None = None, size: int = SIZE, cut_above: int = CUT_ABOVE, end_id: int = END_ID, buckets: int | None = None, block_bytes: int = 8 << 20) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens) of every document's ids and its end id."""
    path = path or public_tokenizers.path(TOKENIZER)
    buckets = buckets or shuffle_partitions(docs.sparkSession)
    staged = scope.write(exchange.stage(docs, id_column, text_column, path, buckets, block_bytes, _sequence), "sequence-cells")
    return exchange.settle(staged, exchange.answer(staged, path, _ids), _pieces(size, cut_above, end_id), PIECES, PIECE_ARROW)


def place(pieces: DataFrame, *, size: int = SIZE, per_bucket: int = 4000) -> DataFrame:
    """Adds sequence_id and offset to pieces (a written table, read several times).

    Ranks among pieces of one length are counted in buckets of about per_bucket pieces, so a
    length that a third of all pieces has is ranked by many tasks.
    """
    spark = pieces.sparkSession
    ship(spark)
    counts = pieces.groupBy("length").count().collect()  # at most `size` rows
    histogram = {r["length"]: r["count"] for r in counts}
    plan = slots(spread(histogram, size), size)
    n_buckets = max(1, -(-sum(histogram.values()) // per_bucket))
    dealt = pieces.withColumn("deal", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(n_buckets)))
    sizes = dealt.groupBy("length", "deal").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("deal").rowsBetween(Window.unboundedPreceding, -1)
    begin = sizes.select("length", "deal", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("length", "deal").orderBy("doc_id", "start", "ids_crc32")
    ranked = dealt.withColumn("at", F.row_number().over(inside) - 1).join(begin, ["length", "deal"])
    ranked = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("begin") + F.col("at")).cast("long").alias("rank"))

    def run(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            key = (t.column("length").to_numpy() << 40) + t.column("rank").to_numpy()
            slot = np.searchsorted(plan["key"], key, "right") - 1
            sequence = plan["sequence"][slot] + (key - plan["key"][slot])
            made = t.drop_columns(["rank"]).append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(plan["offset"][slot], pa.int64()))
            yield from made.to_batches()

    return ranked.mapInArrow(run, PLACED)


def packed(docs: DataFrame, *, scope: Scope | None = None, size: int = SIZE, **options) -> DataFrame:
    """Pieces of all docs with their places in sequences of at most ``size`` ids.

    A null or empty text is a document of one id, the end id. Repeated rows are packed as rows
    of their own; a null id stays null. An empty table gives no rows.
    """
    own = scope or session_scope(docs.sparkSession)
    pieces = own.write(token_pieces(docs, scope=own, size=size, **options), "pieces")
    return place(pieces, size=size)
