"""Token counts: pieces are counted once per distinct pre-token and joined to per-document frequencies.

Token ids are never materialised for a text: a document is a list of (pre-token, frequency),
a pre-token has a number of pieces, and a document's count is the sum of their products.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange
from .shared import Scope, id_array, pack, session_scope, shuffle_partitions, unpack

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
ROWS = "doc_id long, n_bytes long, n_tokens long"
ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def _frequencies(doc_ids, null, n_bytes, first, index) -> bytes:
    per_doc = np.diff(first)
    key = (np.repeat(np.arange(len(per_doc), dtype=np.uint64), per_doc) << np.uint64(32)) | index
    key.sort()
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    pairs = key[new]
    frequency = np.diff(np.append(new, len(key))).astype(np.uint32)
    n_pairs = np.bincount((pairs >> np.uint64(32)).astype(np.int64), minlength=len(per_doc)).astype(np.uint32)
    return pack(doc_ids, null, n_bytes, n_pairs, pairs.astype(np.uint32), frequency, squeeze=True)


def _count(tokenizer, tokens):
    return np.ones(len(tokens), np.uint32), np.fromiter((len(tokenizer.ids(t)) for t in tokens), np.uint32, len(tokens))


def _sum(payload, sizes, values):
    doc_ids, null, n_bytes, n_pairs, token, frequency = unpack(payload, squeezed=True)
    total = np.concatenate([[0], np.cumsum(frequency.astype(np.int64) * values[token])])
    ends = np.cumsum(n_pairs.astype(np.int64))
    return [id_array(doc_ids, null), pa.array(n_bytes), pa.array(total[ends] - total[ends - n_pairs])]


def token_counts(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", path: str | None = None, buckets: int | None = None, block_bytes: int = 8 << 20, scope: Scope | None = None) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row of docs.

    A null text counts as empty (0 tokens); a null id and repeated rows stay rows of their own;
    special strings inside a text are the tokens that the library makes of them. Memory is
    bounded by block_bytes (or one text) and by a bucket's cells; raise ``buckets`` (default:
    the session's shuffle partitions) with the corpus.
    """
    own = scope or session_scope(docs.sparkSession)
    path = path or public_tokenizers.path(TOKENIZER)
    staged = own.write(exchange.stage(docs, id_column, text_column, path, buckets or shuffle_partitions(docs.sparkSession), block_bytes, _frequencies), "token-cells")
    out = exchange.settle(staged, exchange.answer(staged, path, _count), _sum, ROWS, ARROW)
    return out


def with_limit(counts: DataFrame, limit: int = LIMIT) -> DataFrame:
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)


__all__ = ["token_counts", "with_limit"]
