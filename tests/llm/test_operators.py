"""Every operator against a brute-force version on a small table with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridloom.llm import bitsliced, context_tree, language_id, media, mixing, packing, quality, queries, shared, simhash, substrings, token_counts
from gridloom.llm.shared import labels

from ..compare import connect, same

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, block long, node long, label string, rank int, cell string, n long"
LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))


def lower_words(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(LOWER))


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(11)
    words = ["".join(rnd.choice(["al", "be", "co", "de", "én", "fo", "gi"]) for _ in range(rnd.randint(1, 3))) for _ in range(300)]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passage = say(40)
    out = [(i, say(rnd.choice([0, 1, 3, 12, 13, 14, 60, 200]))) for i in range(40)]
    out += [(40 + i, say(30) + "\n" + passage + "\t" + say(20)) for i in range(6)]
    base = say(150).split(" ")
    for i in range(8):
        own = list(base)
        own[rnd.randrange(150)] = "changed"
        out.append((50 + i, " ".join(own)))
    out += [(60, None), (61, ""), (62, " \n\t "), (63, say(4000)), (64, out[7][1]), (65, out[7][1]), (66, "Don't <|endoftext|> 語 Σ'S  A1²"), (67, "é" * 50), (None, say(30)), (None, passage)]
    out += [out[41], out[41]]  # repeated rows
    out += [(-3, passage)]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, [None, "en", "fr"][k % 3], ["hot", "hot", None, f"s{k % 5}"][k % 4], None, 0.5, 1, 2, "x", 3, "c", 4) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture
def empty(docs):
    return docs.where("false")


def keyed(rows):
    """Rows by id as sorted lists, since ids repeat."""
    out = defaultdict(list)
    for k, v in rows:
        out[k].append(v)
    return {k: sorted(v, key=repr) for k, v in out.items()}


def test_token_counts(docs, texts, empty):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = token_counts.with_limit(token_counts.token_counts(docs, block_bytes=4000, buckets=3)).collect()
    expected = [(i, (len((x or "").encode()), n := len(t.encode(x or "", add_special_tokens=False).ids), n > 512)) for i, x in texts]
    assert keyed((r["doc_id"], (r["n_bytes"], r["n_tokens"], r["over_limit"])) for r in got) == keyed(expected)
    assert token_counts.token_counts(empty).count() == 0


def test_packing(docs, texts, empty):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = packing.packed(docs, block_bytes=4000, buckets=3).collect()
    expected = []
    for i, x in texts:
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4")
        start = 0
        for n in packing.cuts(len(ids), 2048, 512):
            expected.append((i, (start, n, zlib.crc32(ids[start : start + n].tobytes()), len(ids))))
            start += n
    assert keyed((r["doc_id"], (r["start"], r["length"], r["ids_crc32"], r["doc_tokens"])) for r in got) == keyed(expected)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.packed(empty).count() == 0


def brute_context_tree(train, codes):
    """Log probabilities by a tree of dictionaries, one node a (context, bit prefix)."""
    depth = context_tree.DEPTH
    counts = defaultdict(lambda: [0, 0])
    for ctx, y in train:
        for d in range(depth + 1):
            for k in range(8):
                counts[ctx[:d], (1 << k) | (y >> (8 - k))][(y >> (7 - k)) & 1] += 1
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    children = defaultdict(list)
    for ctx, p in counts:
        if ctx:
            children[ctx[:-1], p].append((ctx, p))
    memo = {}

    def weighted(node):
        if node not in memo:
            own = kt(*counts[node])
            memo[node] = own if len(node[0]) == depth else np.logaddexp(own, sum(weighted(c) for c in children[node])) - math.log(2)
        return memo[node]

    out = []
    for ctx, y in codes:
        total = 0.0
        for k in range(8):
            p, bit, one, deeper = (1 << k) | (y >> (8 - k)), (y >> (7 - k)) & 1, 0.5, False
            for d in range(depth, -1, -1):
                node = (ctx[:d], p)
                a, b = counts[node] if node in counts else (0, 0)
                own = (b + 0.5) / (a + b + 1)
                stop = 1.0 if d == depth or not a + b else math.exp(kt(a, b) - math.log(2) - weighted(node))
                one = stop * own + (1 - stop) * one if deeper else own
                deeper = a + b > 0
            total += math.log(one if bit else 1 - one)
        out.append(total)
    return out


def test_context_tree(spark, docs, texts, empty):
    got = context_tree.text_scores(docs, block_bytes=3000, buckets=3).collect()
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in texts}
    train = [(i, x) for i, x in texts if i is not None and not held[i]]
    counts = Counter()
    for _, x in train:
        counts.update([*lower_words(x), None])
    n, v = sum(counts.values()), len(counts)
    base = lambda x: sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*lower_words(x), None])
    expected = keyed((i, (bool(i is not None and held[i]), len(lower_words(x)) + 1, sum(counts[w] > 0 for w in [*lower_words(x), None]), n)) for i, x in texts)
    assert keyed((r["doc_id"], (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"])) for r in got) == expected
    bases = keyed((i, base(x)) for i, x in texts)
    for i, rows in keyed((r["doc_id"], r["base_score"]) for r in got).items():
        assert rows == pytest.approx(bases[i], abs=1e-6)

    def symbols(x):
        s = bytes([255] * 5) + b" ".join(lower_words(x)) + bytes([255])
        return [(bytes(s[i - k] for k in range(1, 6)), s[i]) for i in range(5, len(s))]

    few = [(i, x) for i, x in texts if x and len(x) < 400][:25]
    small = spark.createDataFrame(few, "doc_id long, text string")
    own = [s for i, x in few if i is not None and not held[i] for s in symbols(x)]
    model = {r["doc_id"]: r["score"] for r in context_tree.text_scores(small, block_bytes=500, buckets=4).collect()}
    for i, x in few[::4]:
        assert model[i] == pytest.approx(sum(brute_context_tree(own, symbols(x))) / math.log(10), abs=1e-4)
    assert context_tree.text_scores(empty).count() == 0
    lone = spark.createDataFrame([(9, "a", )], "doc_id long, text string") if zlib.crc32(b"9") % 7 == 2 else spark.createDataFrame([(None, "a")], "doc_id long, text string")
    assert context_tree.text_scores(lone).first()["score"] == pytest.approx(16 * math.log10(0.5))
    assert context_tree.text_scores(lone).first()["bits_per_byte"] == pytest.approx(8)
    for r in got:
        assert r["code_bits"] == pytest.approx(-r["score"] * math.log2(10))
    sizes = keyed((i, len(symbols(x or ""))) for i, x in texts)
    assert keyed((r["doc_id"], round(r["code_bits"] / r["bits_per_byte"])) for r in got) == sizes


def test_mixing(docs, texts, empty):
    rows = mixing.mixed(docs, share=0.5).collect()
    assert len(rows) == len(texts)
    cells = defaultdict(float)
    for r in rows:
        cells[r["source"], r["lang"], r["topic"]] += r["estimated_tokens"]
    total = sum(cells.values())
    factor = {(r["source"], r["lang"], r["topic"]): r["factor"] for r in rows}
    probability = {(r["source"], r["lang"], r["topic"]): r["probability"] for r in rows}
    assert sum(t * probability[c] for c, t in cells.items()) == pytest.approx(0.5 * total)
    for r in rows:
        u = int(hashlib.md5(str("" if r["doc_id"] is None else r["doc_id"]).encode()).hexdigest()[:8], 16) / 2**32
        assert r["selected"] == (u < r["probability"])
    assert mixing.mixed(empty).count() == 0
    given = mixing.mixed(docs, targets={"lang": {"en": 0.5, "fr": 0.5, "~": 0.0}}).collect()
    assert all(r["probability"] == 0 for r in given if r["lang"] == "~")


def brute_fingerprint(text):
    w = lower_words(text)
    s = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


@pytest.mark.parametrize("few", [shared.FEW_ROWS, 0])
def test_near_duplicates(docs, texts, empty, few, monkeypatch):
    monkeypatch.setattr(shared, "FEW_ROWS", few)
    prints = [brute_fingerprint(x) for _, x in texts]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[find(i)] = find(j)
    low = defaultdict(list)
    for k, (i, _) in enumerate(texts):
        if i is not None:
            low[find(k)].append(i)
    expected = keyed((i, (f"{prints[k]:016x}", min(low[find(k)], default=None))) for k, (i, _) in enumerate(texts))
    got = simhash.near_duplicates(docs).collect()
    assert keyed((r["doc_id"], (r["fingerprint"], r["component_id"])) for r in got) == expected
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("members", [2, 3, 7])
def test_links_of_hot_keys_are_complete(spark, members):
    rnd = random.Random(members)
    values = {rnd.getrandbits(64) for _ in range(20)}
    for v in list(values):
        for _ in range(6):
            for _ in range(rnd.randint(1, 5)):
                v ^= 1 << rnd.randrange(64)
            values.add(v)
    values = np.array(sorted(values), np.uint64)
    df = spark.createDataFrame([(int(x),) for x in values.view(np.int64)], "fingerprint long")
    links = {(r["u"], r["v"]) for r in simhash.near_links(df, 2**30, members=members).collect()}
    parent = {int(x): int(x) for x in values.view(np.int64)}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in links:
        assert (u ^ v & (2**64 - 1)).bit_count() or u != v
        parent[find(u)] = find(v)
    signed = values.view(np.int64)
    for i in range(len(values)):
        for j in range(i):
            if int(values[i] ^ values[j]).bit_count() <= 4:
                assert find(int(signed[i])) == find(int(signed[j]))


def test_one_of_each(spark, docs, texts):
    from gridloom.tables import Scope

    scope = Scope(spark)
    kept = {r["doc_id"] for r in simhash.one_of_each(docs, scope=scope).collect()}
    assert {50 + i for i in range(8)} & kept == {50}
    assert not {64, 65} & kept or 7 not in kept
    assert {i for i, _ in texts if i is not None and i < 40 and len(lower_words(dict(texts)[i])) >= 12} <= kept


def test_media(docs, texts, empty):
    got = media.decode(media.encode(docs)).collect()
    expected = []
    for i, x in texts:
        raw = (x or "").encode()
        payload = raw.ljust(max(192, -(-len(raw) // 192) * 192), b" ")
        stored = media.wave_bytes(payload)
        expected.append((i, (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), media.features(stored)[4])))
    fields = ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
    assert keyed((r["doc_id"], tuple(r[f] for f in fields)) for r in got) == keyed(expected)
    assert media.decode(media.encode(empty)).count() == 0
    payload = bytes(random.Random(8).randrange(256) for _ in range(9600))
    mels, tensors = media.features(media.wave_bytes(payload))[1:3]
    spans, frames = media.read_frames(tensors)
    assert (frames[: len(mels)] == mels).all()
    assert len(spans) == -(-len(mels) // media.FRAMES)
    assert (spans[1:, 0] == spans[:-1, 1]).all()


def test_top_k_edges(spark):
    rows = [(0, [1.0, 0.5], "x"), (50, [0.1, 0.2], "x"), (3, [1.0, 0.5], "x"), (2, [1.0, 0.5], "x"), (None, [9.0, 9.0], "x"), (4, None, "x"), (5, [1.0, None], "x"), (6, [float("nan"), 1.0], "x"), (7, [-0.004, 3.0], "x"), (8, [1.0], "x"), (9, [float("inf"), 0.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")
    got = sorted(map(tuple, bitsliced.top_k(df, k=3, block_rows=2, block_queries=1).collect()))
    fine = {0: (256, 128), 50: (25, 51), 3: (256, 128), 2: (256, 128), 7: (-2, 768)}
    expected = []
    for q in (0, 50):
        best = sorted((-sum(a * b for a, b in zip(fine[q], v, strict=True)), i) for i, v in fine.items() if i != q)[:3]
        expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert got == sorted(expected)
    assert bitsliced.top_k(df.where("false")).count() == 0
    wide = [(i, [random.Random(i).uniform(-4e6, 4e6) for _ in range(3)]) for i in range(60)]
    q = {i: [math.floor(256 * v) for v in x] for i, x in wide}
    best = lambda a: sorted((-sum(x * y for x, y in zip(q[a], q[i], strict=True)), i) for i in q if i != a)[:5]
    large = spark.createDataFrame(wide, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, bitsliced.top_k(large).collect())) == [(a, n + 1, i, -s) for a in (0, 50) for n, (s, i) in enumerate(best(a))]
    with pytest.raises(Exception, match="too large"):
        bitsliced.top_k(spark.createDataFrame([(0, [1e30, 1.0]), (1, [1e30, 1.0])], "vec_id long, embedding array<double>")).collect()


def test_language_id(spark, docs, empty):
    rnd = random.Random(3)
    parts = {"en": ["the", "ing", "th", "er"], "fr": ["eau", "eux", "é", "ou"], "de": ["sch", "ung", "ü", "ß"]}
    rows = [(i, " ".join("".join(rnd.choice(parts[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(5, 60))), lang, 0.0) for i in range(400) for lang in [rnd.choice(list(parts))]]
    rows += [(900, None, "en", 0.0), (901, "12 !!", "en", 0.0), (902, "", None, 0.0), (None, "the thing", None, 0.0), (903, "語", None, 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = language_id.identify(df, language_id.fit(df)).collect()
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in got if r["held_out"] and r["doc_id"] < 900]
    assert len(held) > 50
    assert np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in held]) > 0.97
    assert {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got if r["doc_id"] in (900, 901, 902)} == {i: ("und", 0.0) for i in (900, 901, 902)}
    assert next(r for r in got if r["doc_id"] == 903)["lang_pred"] in parts
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    assert language_id.identify(empty, language_id.fit(empty)).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(docs, None).collect()} == {"und"}


def test_quality(spark, docs, empty):
    rnd = random.Random(4)
    say = lambda n: " ".join("".join(rnd.choice(["an", "er", "is", "on"]) for _ in range(3)) for _ in range(n))
    rows = [(i, say(rnd.randint(3, 80)) if i % 2 else " | ".join(say(rnd.randint(3, 80)).split(" "))) for i in range(300)]
    rows += [(900, None), (901, ""), (None, "x"), (902, say(30_000))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(300)] + [(1, None, 0), (None, 1, 0), (2, 7, 0)], "doc_id long, quality int, toxic int")
    got = quality.quality_scores(df, quality.fit(df, labels)).collect()
    held = [r for r in got if r["held_out"] and r["doc_id"] < 300]
    assert np.mean([r["predicted"] == r["doc_id"] % 2 for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert next(r for r in got if r["doc_id"] == 902)["predicted"] == 1
    assert quality.quality_scores(empty, 0.5).count() == 0
    assert isinstance(quality.fit(df, labels.where("quality = 1")), float)
    assert quality.quality_scores(docs, 0.25, carry=("n", "label")).count() == docs.count()


def test_quality_scores_do_not_depend_on_neighbours():
    rng = np.random.default_rng(0)
    net = quality.Network(rng)
    raw = [rng.integers(32, 120, n).astype(np.uint8).tobytes() for n in (0, 1, 5, 127, 128, 129, 255, 256, 257, 1000, 40_000)]
    pairs = net.pairs()
    alone = [net.scores(np.frombuffer(r, np.uint8), np.array([0, len(r)]), pairs)[0] for r in raw]
    offsets = np.append(0, np.cumsum([len(r) for r in raw]))
    together = net.scores(np.frombuffer(b"".join(raw), np.uint8), offsets, pairs)
    assert together == pytest.approx(alone, abs=1e-6)
    # direct convolution of one text
    r = np.frombuffer(raw[5] + bytes(quality.SPAN), np.uint8)
    one = np.einsum("be,kef->kbf", net.p["embed"], net.p["filter"])
    direct = np.stack([sum(one[k][r[i + k]] for k in range(quality.SPAN)) for i in range(129)]) + net.p["bias"]
    data, blank, counts, _ = quality.layout(np.frombuffer(raw[5], np.uint8), np.array([0, 129]))
    half = quality.pooled(pairs, net.p["bias"], data, blank, counts)
    assert half == pytest.approx(np.stack([direct[:128].max(0), direct[128:].max(0)]), abs=1e-4)


def first_places(texts, words):
    """The index: each 13-word phrase at its smallest id and first position there."""
    index = {}
    for (i, _), w in zip(texts, words, strict=True):
        for s in range(len(w) - 12):
            here = (NULL_ID if i is None else i, s)
            key = tuple(w[s : s + 13])
            index[key] = min(index.get(key, here), here)
    return index


NULL_ID = 2**63 - 1


def greedy_factors(i, w, index):
    """Word by word: the next phrase that reaches beyond the last factor's end and is in a smaller id begins a factor, which follows its place."""
    own, out, end, s = NULL_ID if i is None else i, [], 0, 0
    while s + 13 <= len(w):
        source, at = index[tuple(w[s : s + 13])]
        if source >= own:
            s += 1
            continue
        n = 13
        while s + n < len(w) and index[tuple(w[s + n - 12 : s + n + 1])] == (source, at + n - 12):
            n += 1
        first = max(s, end)
        out.append((first, s + n, source, at + first - s))
        s, end = s + n - 12, s + n
    return out


def test_labels_spread(spark):
    for n in (1, 2, 7, 50, 211):
        label = labels(n)
        assert (np.diff(label) > 0).all()
        df = spark.createDataFrame([(int(x),) for x in label], "bucket int")
        assert sorted(r[0] for r in df.select(F.pmod(F.hash("bucket"), F.lit(n))).collect()) == list(range(n))


def test_substring_dedup(docs, texts, empty):
    words = [re.findall(r"[^\x20\x09-\x0d]+", x or "") for _, x in texts]
    least = {}
    for (i, _), w in zip(texts, words, strict=True):
        for s in range(len(w) - 12):
            key = tuple(w[s : s + 13])
            least[key] = min(least.get(key, math.inf), math.inf if i is None else i)
    expected = []
    for (i, x), w in zip(texts, words, strict=True):
        gone = [False] * len(w)
        for s in range(len(w) - 12):
            if least[tuple(w[s : s + 13])] < (math.inf if i is None else i):
                gone[s : s + 13] = [True] * 13
        kept = " ".join(a for a, g in zip(w, gone, strict=True) if not g)
        expected.append((i, (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), x if not any(gone) else kept)))
    assert any(e[1][1] for e in expected)
    got = substrings.without_repeats(docs, carry=("score", "block", "n"), block_bytes=3000, buckets=3).collect()
    assert keyed((r["doc_id"], (r["n_words"], r["n_removed"], r["kept_sha256"], r["text"])) for r in got) == keyed(expected)
    assert {(r["score"], r["block"], r["n"]) for r in got} == {(0.5, 1, 4)}
    assert sum(s["after"] - s["first"] for r in got for s in r["removed_spans"]) == sum(r["n_removed"] for r in got)
    assert keyed((r["doc_id"], [tuple(s) for s in r["removed_spans"]]) for r in got) == keyed((i, greedy_factors(i, w, first_places(texts, words))) for (i, _), w in zip(texts, words, strict=True))
    assert substrings.without_repeats(empty).count() == 0


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_equals_sql(spark, name):
    same(spark, connect(SF), queries.QUERIES[name], queries.ORACLE[name], SF)
