"""Models and features against plain loops, and gradients against differences of the loss."""

import math
import random

import numpy as np
import pytest

from gridloom.llm import language_id, media, quality

TEXTS = ["", "a", "Ab1 c", "é zwölf", "x" * 130, "the quick brown fox " * 40, "12 !?", "\x00 nul\n"]


def joined(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw])).astype(np.int64)


def mean_row(table, text):
    """Mean of the table's rows over all grams of one to four bytes, other ASCII than letters being blanks."""
    raw = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in text.encode())
    rows = []
    for size in language_id.GRAMS:
        for i in range(len(raw) - size + 1):
            code = (int.from_bytes(raw[i : i + size], "big") + (size << 40)) * 0x9E3779B97F4A7C15 % (1 << 64)
            rows.append(table[code >> 49])
    return np.mean(rows, axis=0) if rows else np.zeros(table.shape[1])


def test_averages_equal_plain_means():
    table = np.random.default_rng(1).normal(size=(language_id.BUCKETS, 3))
    expected = np.stack([mean_row(table, t) for t in TEXTS])
    np.testing.assert_allclose(language_id.averages(table, *joined(TEXTS)), expected, atol=1e-12)


def test_identify_equals_plain_softmax(spark):
    rng = np.random.default_rng(2)
    model = {"names": ["aa", "bb", "cc"], "table": rng.normal(size=(language_id.BUCKETS, 3)), "bias": rng.normal(size=3), "heat": 0.5, "least": 0.6}
    rows = list(enumerate([*TEXTS, None, *TEXTS]))
    got = {r["doc_id"]: r for r in language_id.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        if not any(c.isalpha() for c in text or ""):
            assert (got[i]["lang_pred"], got[i]["score"], got[i]["accepted"]) == ("und", 0.0, False)
            continue
        x = (mean_row(model["table"], text) + model["bias"]) / model["heat"]
        p = np.exp(x) / np.exp(x).sum()
        assert got[i]["lang_pred"] == model["names"][p.argmax()]
        assert got[i]["score"] == pytest.approx(p.max())
        assert got[i]["accepted"] == (p.max() >= model["least"])


def plain_score(net, text):
    """Probability of one text by loops over chunks, places and filter positions."""
    p, raw = net.p, text.encode()
    places = max(len(raw), 1)
    data = raw + b"\x00" * (quality.SPAN + places - len(raw))
    at = np.array([sum(p["embed"][data[i + k]] @ p["filter"][k] for k in range(quality.SPAN)) for i in range(places)])
    half = quality.CHUNK // 2
    starts = range(0, max(places - half, 1), half)
    chunks = np.array([np.maximum(at[a : a + quality.CHUNK].max(axis=0) + p["bias"], 0) for a in starts])
    x = np.concatenate([chunks.mean(axis=0), chunks.max(axis=0), chunks.min(axis=0), [math.log1p(len(raw)) / 8, min(len(raw), quality.CHUNK) / quality.CHUNK]])
    hidden = np.maximum(x @ p["w1"] + p["b1"], 0)
    return 1 / (1 + math.exp(-(hidden @ p["w2"] + p["b2"][0])))


def drawn_network(seed):
    rng = np.random.default_rng(seed)
    net = quality.Network(rng)
    for name in ("bias", "b1", "b2"):
        net.p[name] = rng.normal(0, 0.3, net.p[name].shape).astype(np.float32)
    return net


def test_scores_equal_plain_network():
    rnd, net = random.Random(4), drawn_network(4)
    sizes = [0, 1, 5, 127, 128, 129, 255, 256, 257, 384, 700]
    texts = [*TEXTS, *("".join(rnd.choice("abc de\nfgé") for _ in range(n)) for n in sizes)]
    np.testing.assert_allclose(net.scores(*joined(texts), net.pairs()), [plain_score(net, t) for t in texts], atol=2e-5)


@pytest.mark.parametrize("seed", [5, 6, 7])
def test_gradients_equal_differences(seed):
    rnd, net = random.Random(seed), drawn_network(seed)
    texts = ["".join(rnd.choice("abcdefg hij") for _ in range(rnd.randint(0, 900))) for _ in range(6)]
    buf, offsets = joined(texts)
    label, weight = np.array([0, 1, 1, 0, 1, 0], np.float32), np.array([1, 2, 1, 1, 0.5, 3], np.float32)
    before = {k: x.copy() for k, x in net.p.items()}

    def loss():
        prob = net.scores(buf, offsets, net.pairs())
        return -(np.log(np.where(label > 0, prob, 1 - prob)) * weight).mean()

    assert net.step(buf, offsets, label, weight, 0.0) == pytest.approx(loss(), rel=1e-4)
    gradients = {k: m / 0.1 for k, m in net.m.items()}  # the first step's running mean is a tenth of the gradient
    for name, g in gradients.items():
        length = float(np.sqrt((g * g).sum()))
        assert length > 1e-3
        sides = []
        for sign in (1, -1):
            net.p[name] = (before[name] + sign * 5e-4 * g / length).astype(np.float32)
            sides.append(loss())
        net.p[name] = before[name]
        assert (sides[0] - sides[1]) / 1e-3 == pytest.approx(length, rel=0.02), name


@pytest.mark.parametrize("n", [1, 255, 256, 257, 1000])
def test_log_mel_equals_direct_transform(n):
    audio = np.random.default_rng(n).uniform(-1, 1, n).astype(np.float32)
    rate = media.RATE * media.UP / media.DOWN
    top = 2595 * math.log10(1 + rate / 2 / 700)
    edges = [700 * (10 ** (top * i / (media.MELS + 1) / 2595) - 1) for i in range(media.MELS + 2)]
    expected, start = [], 0
    while True:
        frame = np.zeros(media.FRAME)
        part = audio[start : start + media.FRAME]
        frame[: len(part)] = part
        i = np.arange(media.FRAME)
        frame *= 0.5 - 0.5 * np.cos(2 * np.pi * i / media.FRAME)
        power = [abs((frame * np.exp(-2j * np.pi * k * i / media.FFT)).sum()) ** 2 for k in range(media.FFT // 2 + 1)]
        row = []
        for lo, mid, hi in zip(edges, edges[1:], edges[2:], strict=False):
            f = [k * rate / media.FFT for k in range(media.FFT // 2 + 1)]
            row.append(math.log10(sum(e * max(0.0, min((x - lo) / (mid - lo), (hi - x) / (hi - mid))) for e, x in zip(power, f, strict=True)) + 1e-6))
        expected.append(row)
        start += media.HOP
        if start + media.FRAME - media.HOP >= n:
            break
    np.testing.assert_allclose(media.log_mel(audio), expected, atol=2e-3)


@pytest.mark.parametrize("seed", range(5))
def test_segments_equal_a_walk(seed):
    energy = np.random.default_rng(seed).integers(0, 9, 60).astype(float)
    low, high = np.quantile(energy, [media.LOW, media.HIGH])
    expected, first, reached = [], None, False
    for i, e in enumerate([*energy, -1.0]):
        if e > low:
            first, reached = i if first is None else first, reached or e >= high
        else:
            if reached:
                expected.append([first, i])
            first, reached = None, False
    assert media.segments(energy).tolist() == expected
    assert media.segments(np.ones(8)).tolist() == []


def test_tensors_and_spans_come_back():
    mels = np.random.default_rng(3).normal(size=(media.FRAMES * 2 + 5, media.MELS)).astype(np.float32)
    spans, frames = media.read_frames(media.tensor_bytes(mels))
    step = media.HOP * media.DOWN / (media.UP * media.RATE)
    assert spans.tolist() == [[i * media.FRAMES * step, min((i + 1) * media.FRAMES, len(mels)) * step] for i in range(3)]
    assert (frames[: len(mels)] == mels).all()
    assert (frames[len(mels) :] == -6).all()
