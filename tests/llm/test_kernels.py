import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash

from gridloom.llm import bitsliced, context_tree, kernels, media, packing
from gridloom.llm.pretoken import pieces

LATIN = ["a", "s", "t", "'", " ", "  ", "\n", "\t", "é", "Ü", "²", "1", "9", "!", "%", "'re", "'ll", "'ve", "'s", "\xa0", "\x85", "ß", "µ", "_", "A", "×", "\x1c"]
WILD = [*LATIN, "œ", "語", "Σ", "İ", "<|endoftext|>", "<|startoftext|>", "<|", "́", "😀"]


def joined(raw):
    return np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw]))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pretokens_give_the_librarys_ids(name):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(LATIN if i % 4 else WILD) for _ in range(rnd.randint(0, 40))) for i in range(4000)]
    p = pieces(public_tokenizers.path(name))
    buf, offsets = joined([t.encode() for t in texts])
    data, starts, ends, first = p.cut(buf, offsets)
    raw = data.tobytes()
    for i, e in enumerate(p.tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert [x for k in range(first[i], first[i + 1]) for x in p.ids(raw[starts[k] : ends[k]])] == e.ids, texts[i]


def test_xxh64():
    rnd = random.Random(1)
    raw = [bytes(rnd.randrange(256) for _ in range(n)) for n in [*range(140), 1000]]
    buf, offsets = joined(raw)
    assert kernels.xxh64(buf, offsets[:-1], offsets[1:]).tolist() == [xxhash.xxh64_intdigest(r, 42) for r in raw]


def test_word_spans_and_hashes():
    raw = [b"", b" a\tbb \n", b"a", b"\x0b", b"bb a bb"]
    buf, offsets = joined(raw)
    starts, ends, first = kernels.word_spans(buf, offsets)
    assert [bytes(buf[a:b]) for a, b in zip(starts, ends, strict=True)] == [b"a", b"bb", b"a", b"bb", b"a", b"bb"]
    assert first.tolist() == [0, 0, 2, 3, 3, 6]
    h = kernels.span_hashes(buf, starts, ends)
    assert len(set(h.tolist())) == 2
    assert h[0] == h[2] == h[4]


def test_spread_places_every_length():
    rnd = random.Random(2)
    for _ in range(50):
        histogram = {rnd.randint(1, 64): rnd.randint(1, 30) for _ in range(rnd.randint(0, 20))}
        patterns = packing.spread(histogram, 64)
        placed = {}
        for n, lengths in patterns:
            assert sum(lengths) <= 64
            for x in lengths:
                placed[x] = placed.get(x, 0) + n
        assert placed == histogram
        plan = packing.slots(patterns, 64)
        assert len(plan["key"]) == sum(len(x) for _, x in patterns)


def test_cuts():
    for n in range(1, 5000, 7):
        c = packing.cuts(n, 2048, 512)
        assert sum(c) == n
        assert all(0 < x <= 2048 for x in c)
        assert c[-1] <= 512 or c[-1] in (1024, 2048)


def test_bitsliced_equals_products():
    rng = np.random.default_rng(1)
    v = np.floor(256 * rng.normal(0, 0.2, (300, 7))).astype(np.int64)
    v[50:60] = v[40]  # ties
    ids = np.arange(300) * 5
    a, b, c = bitsliced.search(ids, v, ids[:20], v[:20], 5)
    s = v @ v[:20].T
    for i in range(20):
        own = s[:, i].copy()
        own[i] = -(10**15)
        order = np.lexsort((ids, -own))[:5]
        m = a == ids[i]
        assert sorted(zip((-c[m]).tolist(), b[m].tolist(), strict=True)) == [(-int(s[j, i]), int(ids[j])) for j in order]


def test_media_round_trip():
    payload = bytes(range(192)) * 7
    stored = media.wave_bytes(payload)
    back, rate = media.read_wave(stored)
    assert (back, rate) == (payload, media.RATE)
    got, mels, tensors, spans, digest = media.features(stored)
    assert got == payload
    assert digest == media.features(stored)[4]
    table = media.read_tensors(tensors)
    assert table.schema.field("log_mel").type == media.TENSOR
    made = np.concatenate([x for x in table.column("log_mel").chunk(0).to_numpy_ndarray()])[: len(mels)]
    assert (made == mels).all()
    assert (spans[:, 0] < spans[:, 1]).all()


def test_resample_equals_direct_sum():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 256, 600).astype(np.uint8)
    got = media.resample(x)
    signal = (x.astype(np.float64) - 128) / 128
    padded = np.concatenate([np.zeros(media.TAPS // 2), signal, np.zeros(media.TAPS + 3)])
    for i in range(0, len(got), 13):
        at, phase = divmod(i * media.DOWN, media.UP)
        assert got[i] == pytest.approx(float(padded[at : at + media.TAPS] @ media.FILTERS[phase].astype(np.float64)), abs=1e-5)


def test_lookup():
    keys = np.unique(np.random.default_rng(0).integers(0, 2**62, 5000).astype(np.uint64))
    table = context_tree.Lookup(keys)
    needles = np.concatenate([keys[::-1], keys[::3]])
    assert (keys[table.find(needles)] == needles).all()


def test_crc_of_ids():
    assert kernels.crc32_mod(np.array([0, -7, 123456789]), 7).tolist() == [zlib.crc32(str(i).encode()) % 7 for i in (0, -7, 123456789)]
