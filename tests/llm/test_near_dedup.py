"""The near-dedup stage against brute-force Jaccard similarities of five-word shingles."""

import random
import re

import pytest

import corpus_pipeline
from gridloom.llm import simhash
from gridloom.tables import Scope

SCHEMA = "doc_id long, text string"


def shingles(text):
    w = re.findall(r"\S+", text.lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    words = ["".join(rnd.choice("bcdfglmnprst") + rnd.choice("aeiou") for _ in range(rnd.randint(1, 3))) for _ in range(800)]
    say = lambda n: [rnd.choice(words) for _ in range(n)]
    out = []
    for n in [30, 60, 120, 300, 900] * 12:
        base = say(n)
        out.append(base)
        out.append(base[: round(n * rnd.uniform(0.81, 0.88))])  # truncated
        out.append(base + say(round(n * rnd.uniform(0.13, 0.22))))  # extended
        for share in (0.01, 0.02, 0.025, 0.03):  # substituted, on both sides of the bound
            copy = list(base)
            for i in rnd.sample(range(n), max(1, round(n * share))):
                copy[i] = "changed" + str(rnd.random())
            out.append(copy)
        out.append(base[: round(n * 0.78)])  # just under
    passage = say(40)
    out += [passage + say(rnd.randint(5, 60)) for _ in range(60)]  # a common passage
    near = say(200)
    for _ in range(80):  # one large group
        copy = list(near)
        for i in rnd.sample(range(200), rnd.randint(1, 4)):
            copy[i] = rnd.choice(words)
        out.append(copy)
    out += [[], [], ["one"], ["one"], ["a", "b", "c"], near]
    rnd.shuffle(out)
    return [(i, " ".join(w)) for i, w in enumerate(out)]


def brute(rows):
    """Smallest id of each row's component."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(rows))]


@pytest.mark.parametrize("together", [simhash.TOGETHER, 5])
def test_groups_equal_exact_similarities(spark, rows, together, monkeypatch):
    monkeypatch.setattr(simhash, "TOGETHER", together)
    scope = Scope(spark)
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_groups(spark.createDataFrame(rows, SCHEMA).repartition(3), scope=scope).collect()}
    assert got == dict(enumerate(brute(rows)))


def test_stage_keeps_the_first_of_each_group(spark, rows):
    kept = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    assert kept == set(brute(rows))
