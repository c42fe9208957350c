"""What the operators share: reading tables, the shared folder, packed cells, workers' imports."""

from __future__ import annotations

import os
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import Scope, session_scope, shared_dir
from .kernels import lean

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
ZSTD = pa.Codec("zstd", compression_level=3)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows, of some tens of bytes, that are broadcast whole.
FEW_ROWS = 200_000
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where it lies, and bound a batch's bytes where the session does not."""
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, str(8 << 20))
    env = spark.sparkContext.environment
    parts = env.get("PYTHONPATH", "").split(":")
    if ROOT not in parts:
        env["PYTHONPATH"] = ":".join([ROOT, *[p for p in parts if p]])


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def _spark_hash(x: np.ndarray) -> np.ndarray:
    """Spark's hash of an int column: 32-bit Murmur3 of four bytes with seed 42 (public algorithm; its constants are fixed values)."""
    u = np.uint32
    turn = lambda v, r: (v << u(r)) | (v >> u(32 - r))
    h = turn(u(42) ^ (turn(x.astype(u) * u(0xCC9E2D51), 15) * u(0x1B873593)), 13) * u(5) + u(0xE6546B64)
    h = (h ^ u(4)) ^ ((h ^ u(4)) >> u(16))
    h = h * u(0x85EBCA6B)
    h = (h ^ (h >> u(13))) * u(0xC2B2AE35)
    return (h ^ (h >> u(16))).view(np.int32).astype(np.int64)


def labels(n: int) -> np.ndarray:
    """n ascending non-negative ints that Spark's hash deals to n partitions, one to each."""
    found, at = np.full(n, -1), 0
    while (found < 0).any():
        x = np.arange(at, at + 4 * n + 64, dtype=np.int64)
        part = _spark_hash(x) % n
        new = np.flatnonzero(found[part] < 0)[::-1]
        found[part[new]] = x[new]
        at += len(x)
    return np.sort(found)


def pack(*arrays: np.ndarray, squeeze: bool = False) -> bytes:
    """Arrays as one binary value: count, then type, length and bytes of each."""
    parts = [struct.pack("<I", len(arrays))]
    for a in arrays:
        a = np.ascontiguousarray(a)
        parts += [struct.pack("<4sQ", a.dtype.str.encode().ljust(4), a.nbytes), a.tobytes()]
    out = b"".join(parts)
    return struct.pack("<Q", len(out)) + ZSTD.compress(out, asbytes=True) if squeeze else out


def unpack(data, squeezed: bool = False) -> list[np.ndarray]:
    lean()
    if squeezed:
        size = struct.unpack_from("<Q", data)[0]
        data = ZSTD.decompress(memoryview(data)[8:], size, asbytes=True)
    (n,), at, out = struct.unpack_from("<I", data), 4, []
    for _ in range(n):
        kind, size = struct.unpack_from("<4sQ", data, at)
        kind = np.dtype(kind.decode().strip())
        out.append(np.frombuffer(data, kind, size // kind.itemsize, at + 12))
        at += 12 + size
    return out


def long_ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids as int64 and which of them are null."""
    null = column.is_null().to_numpy(zero_copy_only=False)
    return column.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False), null


def id_array(ids: np.ndarray, null: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=null.astype(bool))


def quoted(name: str) -> str:
    """A column's name as an expression, whatever is in it."""
    return "`" + name.replace("`", "``") + "`"


def unused(name: str, rows: DataFrame) -> str:
    """A column name that rows, whatever the case of its names, does not have."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_mod(column: str, modulus: int):
    """crc32 of the id's text, modulo; a null id counts as remainder -1."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus, F.lit(-1))


def join_to_unique(rows: DataFrame, unique: DataFrame, key: str, total: int, share: int = 1000) -> DataFrame:
    """Inner join of rows with a table that has each key once, with the number ``n`` of rows that have it.

    Of few rows, all keys are broadcast. Else keys with over total/share of the rows, at most
    ``share`` of them, are; so no task gets a hot key's rows.
    """
    if total <= FEW_ROWS:
        return rows.join(F.broadcast(unique.drop("n")), key)
    hot = F.col("n") * share > total
    values = [c for c in unique.columns if c not in (key, "n")]
    few = F.broadcast(unique.where(hot).select(key, *values))
    marks = F.broadcast(unique.where(hot).select(key))
    rest = rows.join(marks, key, "left_anti").join(unique.where(~hot).select(key, *values), key)
    return rows.join(few, key).unionByName(rest)
