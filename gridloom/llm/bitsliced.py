"""Exact top-k inner products over a bit-sliced index.

Every attribute is quantised to floor(scale * x) and shifted by its block's minimum; slice s of
an attribute is the bitmap of the rows whose shifted value has bit s. A query's scores are a
sum of weighted attributes: for every signed binary digit of a weight the slices, or their
complements, are added by carry-save bitmap arithmetic into score slices. The top rows are chosen
from the most significant score slice downward; rows that tie at the boundary are resolved by
id. Rows and queries meet block by block, and a cell yields at most k rows a query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import ship

SCALE, K, EVERY = 256, 5, 50
ROWS, QUERIES = 8192, 512
TOP = "query_id long, vec_id long, score long"
TOP_ARROW = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
U64 = np.uint64


def slices(values: np.ndarray) -> np.ndarray:
    """Bitmaps [attribute, slice, word] of non-negative integers [row, attribute]."""
    n, attributes = values.shape
    width = max(1, int(values.max(initial=0)).bit_length())
    words = -(-n // 64)
    padded = np.zeros((words * 64, attributes), np.int64)
    padded[:n] = values
    out = np.empty((attributes, width, words), U64)
    for s in range(width):
        bits = ((padded >> s) & 1).astype(np.uint8)
        out[:, s] = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(U64)
    return out


def add_up(columns: dict[int, list[np.ndarray]]) -> list[np.ndarray]:
    """Slices of the sum of bitmaps, given by power of two as stacks; three maps of a power become one, and one of the next."""
    out, power = [], 0
    while columns and power <= max(columns):
        stacks = columns.pop(power, [])
        maps = np.concatenate(stacks) if stacks else None
        while maps is not None and len(maps) > 1:
            n = len(maps) // 3
            if n:
                a, b, c = maps[:n], maps[n : 2 * n], maps[2 * n : 3 * n]
                half = a ^ b
                carry = c & half
                carry |= a & b
                half ^= c
                maps = np.concatenate([half, maps[3 * n :]]) if len(maps) % 3 else half
            else:
                a, b = maps[:1], maps[1:2]
                carry = a & b
                maps = a ^ b
            columns.setdefault(power + 1, []).append(carry)
        out.append(maps[0] if maps is not None else None)
        power += 1
    return out


def score_slices(index: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    """Slices of one query's scores, less a constant; index[s] holds slice s of all attributes, then of their complements.

    Weights are written in digits 1, 0 and -1, no two of them in a row other than 0; a digit -1 adds the complement.
    """
    columns: dict[int, list[np.ndarray]] = {}
    left, power, place = weights.copy(), 0, np.arange(len(weights))
    while left.any():
        digit = np.where(left & 1, 2 - (left & 3), 0)
        chosen = np.concatenate([place[digit == 1], place[digit == -1] + len(weights)])
        if len(chosen):
            for s in range(len(index)):
                columns.setdefault(power + s, []).append(index[s][chosen])
        left = (left - digit) >> 1
        power += 1
    return add_up(columns)


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def top_rows(score: list[np.ndarray], among: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of the rows surely among the top k and of those tied at the boundary."""
    sure, open_ = np.zeros_like(among), among
    for part in reversed(score):
        if part is None:
            continue
        high = open_ & part
        n = _count(sure | high)
        if n > k:
            open_ = high
        else:
            sure = sure | high
            open_ = open_ & ~part
            if n == k:
                return sure, np.zeros_like(sure)
    return sure, open_


def rows_of(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def search(ids: np.ndarray, values: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Top k rows of this block for every query: query ids, row ids, scores."""
    order = np.argsort(ids, kind="stable")
    ids, values = ids[order], values[order]
    low = values.min(axis=0)
    index = slices(values - low).transpose(1, 0, 2)
    index = np.concatenate([index, ~index], axis=1)
    everyone = np.zeros(index.shape[2] * 64, np.uint8)
    everyone[: len(ids)] = 1
    everyone = np.packbits(everyone, bitorder="little").view(U64)
    out = []
    for q, weights in zip(query_ids.tolist(), queries, strict=True):
        among = everyone
        a, b = np.searchsorted(ids, [q, q + 1])
        if a < b:
            among = everyone.copy()
            for r in range(a, b):
                among[r >> 6] &= ~(U64(1) << U64(r & 63))
        sure, tied = top_rows(score_slices(index, weights), among, k)
        found = rows_of(sure)
        found = np.concatenate([found, rows_of(tied)[: k - len(found)]])  # rows are in order of id
        out.append((np.full(len(found), q), ids[found], values[found] @ weights))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (ids[:0],) * 3


def quantised(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id and floor(scale * x) of each component, as long; rows with a null id, a null vector, or a null or non-finite component are left out.

    A vector so long that an inner product could leave 63 bits is an error.
    """
    x = F.col(vector_column)
    most = F.sqrt(F.lit(float(1 << 62)) / F.greatest(F.size(x), F.lit(1)))
    long = F.raise_error(F.lit("a component is too large for exact 64-bit inner products")).cast("long")
    whole = lambda v: F.when(F.abs(v) < most, F.floor(v).cast("long")).otherwise(long)
    fine = F.col(id_column).isNotNull() & x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    return rows.where(F.coalesce(fine, F.lit(False))).select(F.col(id_column).cast("long").alias("vec_id"), F.transform(x, lambda v: whole(v.cast("double") * scale)).alias("q"))


def top_k(rows: DataFrame, *, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = SCALE, every: int = EVERY, k: int = K, block_rows: int = ROWS, block_queries: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by ``every``, its k highest integer inner products with the other rows, ties to smaller ids.

    Rows of the query's own id are no candidates of it; other repeated rows are candidates
    each. Vectors of different lengths meet only those of their own length. Rows meet queries
    in cells of about block_rows by block_queries, each at most k rows a query.
    """
    spark = rows.sparkSession
    ship(spark)
    vectors = quantised(rows, id_column, vector_column, scale)
    asked = vectors.where(F.col("vec_id") % every == 0)
    n, m = vectors.count(), asked.count()
    row_blocks, query_blocks = max(1, -(-n // block_rows)), max(1, -(-m // block_queries))
    spread = lambda df, blocks: F.pmod(F.xxhash64("vec_id", "q"), F.lit(blocks)).cast("int")
    cell_rows = vectors.withColumn("rb", spread(vectors, row_blocks)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    cell_asked = asked.withColumn("qb", spread(asked, query_blocks)).withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))

    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q = table.column("q").combine_chunks()
        q = q.chunk(0) if isinstance(q, pa.ChunkedArray) else q
        return table.column("vec_id").to_numpy(), np.diff(q.offsets.to_numpy()), q.flatten().to_numpy()

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return TOP_ARROW.empty_table()
        ids, sizes, flat = matrix(left)
        query_ids, query_sizes, query_flat = matrix(right)
        starts, query_starts, out = np.cumsum(sizes) - sizes, np.cumsum(query_sizes) - query_sizes, []
        for d in np.unique(query_sizes).tolist():
            a, b = np.flatnonzero(sizes == d), np.flatnonzero(query_sizes == d)
            if len(a):
                found = search(ids[a], flat[starts[a][:, None] + np.arange(d)], query_ids[b], query_flat[query_starts[b][:, None] + np.arange(d)], k)
                out.append(pa.Table.from_arrays([pa.array(c, pa.int64()) for c in found], schema=TOP_ARROW))
        return pa.concat_tables(out) if out else TOP_ARROW.empty_table()

    found = cell_rows.groupBy("rb", "qb").cogroup(cell_asked.groupBy("rb", "qb")).applyInArrow(cell, TOP)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
