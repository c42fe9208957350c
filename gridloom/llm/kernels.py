"""NumPy kernels over whole texts: word spans, 64-bit span hashes, XXH64, ragged gathers.

All of them take a byte buffer and the offsets of its documents, work on every byte, and
hold a bounded number of copies of the buffer. Callers cut their input into buffers with
``chunks``; a buffer is larger than the bound only where one text alone is.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Odd multiplier of the span hash and its inverse modulo 2**64.
PRIME = 0x9E3779B97F4A7C15
INVERSE = pow(PRIME, -1, 2**64)
BYTE_TABLE = np.random.Generator(np.random.PCG64(20240117)).integers(0, 2**64, 256, dtype=U64, endpoint=False)
#: The contract's white space: 0x20 and 0x09-0x0D.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


_lean = False


def lean() -> None:
    """Make this worker return freed memory at once: large arrays get mappings of their own, Arrow uses malloc."""
    global _lean
    if not _lean:
        _lean = True
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            libc = ctypes.CDLL(None)
            libc.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD
            libc.mallopt(-1, 4 << 20)  # M_TRIM_THRESHOLD
        except (OSError, AttributeError):
            return  # another C library: memory is bounded all the same


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; a null is an empty text."""
    lean()
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int):
    """Ranges of documents whose texts make up at most ``limit`` bytes, or one longer text."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, end
        at = end


def word_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` and the first word of each document."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = IS_SPACE[buf]
    before, after = np.empty_like(space), np.empty_like(space)
    before[1:], after[:-1] = space[:-1], space[1:]
    full = offsets[:-1] < offsets[1:]
    before[offsets[:-1][full]] = True
    after[offsets[1:][full] - 1] = True
    starts = np.flatnonzero(~space & before)
    return starts, np.flatnonzero(~space & after) + 1, np.searchsorted(starts, offsets)


_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of PRIME and of its inverse; kept up to 2**21 of them."""
    if not _powers or len(_powers[0]) < n:
        m = max(n, 1 << 16)
        made = []
        for base in (PRIME, INVERSE):
            x = np.full(m, base, U64)
            x[0] = 1
            made.append(np.cumprod(x))
        if m > 1 << 21:
            return made[0][:n], made[1][:n]
        _powers[:] = made
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    h = h ^ (h >> U64(32))
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    h *= U64(0xD6E8FEB86659FD93)
    return h ^ (h >> U64(32))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes and length, the same wherever the span lies."""
    if not len(starts):
        return np.zeros(0, U64)
    up, down = powers(len(buf) + 1)
    total = np.empty(len(buf) + 1, U64)
    total[0] = 0
    np.cumsum(BYTE_TABLE[buf] * up[:-1], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix(h + (ends - starts).astype(U64) * U64(0xA24BAED4963EE407))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[0], starts[0]+1, ... of all ranges, one after another."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts.astype(np.int64) - (ends - lengths), lengths)


def distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, the place of one occurrence of each, and each element's index among them."""
    if not len(h):
        return h, np.zeros(0, np.int64), np.zeros(0, np.uint32)
    order = np.argsort(h)
    ordered = h[order]
    new = np.empty(len(h), bool)
    new[0] = True
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    index = np.empty(len(h), np.uint32)
    index[order] = np.cumsum(new, dtype=np.uint32) - np.uint32(1)
    return ordered[new], order[new], index


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each hash; rises with the hash."""
    return ((h >> U64(32)) * U64(buckets)) >> U64(32)


def crc32_mod(ids: np.ndarray, modulus: int) -> np.ndarray:
    """crc32 of each id's decimal text, modulo ``modulus``."""
    import zlib

    return np.fromiter((zlib.crc32(b"%d" % i) % modulus for i in ids.tolist()), np.int64, len(ids))


# ---- XXH64 of many spans at once (public algorithm; its five primes are fixed values) ----
X1, X2, X3, X4, X5 = (U64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U64(r)) | (x >> U64(64 - r))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * X2, 31) * X1


def xxh64(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of every span, lanes in lockstep: spans are handled in order of length."""
    n = len(starts)
    out = np.empty(n, U64)
    if not n:
        return out
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[: len(buf)] = buf
    lengths = ends - starts
    order = np.argsort(lengths, kind="stable")
    p, left = starts[order].astype(np.int64), lengths[order].astype(np.int64)
    size = left.astype(U64)
    words = np.lib.stride_tricks.as_strided(padded, (len(buf) + 1, 8), (1, 1))

    def u64(at):
        return np.ascontiguousarray(words[at]).view(U64).ravel()

    s = U64(seed)
    with np.errstate(over="ignore"):
        h = np.full(n, s + X5, U64)
        big = int(np.searchsorted(left, 32))
        if big < n:
            v = [np.full(n - big, x, U64) for x in (s + X1 + X2, s + X2, s, s - X1)]
            stripes = left[big:] // 32
            for k in range(int(stripes[-1])):
                a = int(np.searchsorted(stripes, k + 1))  # lanes with fewer stripes come first
                at = p[big + a :]
                for i in range(4):
                    v[i][a:] = _round(v[i][a:], u64(at + 8 * i))
                p[big + a :] += 32
            acc = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
            zero = np.zeros_like(acc)
            for x in v:
                acc = (acc ^ _round(zero, x)) * X1 + X4
            h[big:] = acc
            left[big:] %= 32
        h += size
        for k in range(3):
            m = np.flatnonzero(left >= 8)
            if not len(m):
                break
            lane = _round(np.zeros(len(m), U64), u64(p[m]))
            h[m] = _rotl(h[m] ^ lane, 27) * X1 + X4
            p[m] += 8
            left[m] -= 8
        m = np.flatnonzero(left >= 4)
        if len(m):
            h[m] = _rotl(h[m] ^ ((u64(p[m]) & U64(0xFFFFFFFF)) * X1), 23) * X2 + X3
            p[m] += 4
            left[m] -= 4
        for k in range(3):
            m = np.flatnonzero(left > 0)
            if not len(m):
                break
            h[m] = _rotl(h[m] ^ (padded[p[m]].astype(U64) * X5), 11) * X1
            p[m] += 1
            left[m] -= 1
        h ^= h >> U64(33)
        h *= X2
        h ^= h >> U64(29)
        h *= X3
        h ^= h >> U64(32)
    out[order] = h
    return out
