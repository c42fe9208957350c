"""All marginals of raked cells against their targets."""

from collections import defaultdict

import pytest

from gridloom.llm import mixing


@pytest.mark.parametrize("one_task", [mixing.ONE_TASK, 0])
def test_all_marginals_meet_their_targets(spark, one_task, monkeypatch):
    monkeypatch.setattr(mixing, "ONE_TASK", one_task)
    monkeypatch.setattr(mixing, "SWEEPS", 8 if one_task else 2)
    monkeypatch.setattr(mixing, "MOST_SWEEPS", 800 if one_task else 4)
    kinds = ["x" * 40, "x" * 1500, "x\n" * 40]
    rows = [(0, kinds[t], f"l{b}", f"s{a}") for a in range(3) for b in range(3) for t in range(3) for _ in range((30 * (a + 1) if a == b else 1) * (8 if t == a else 1))]
    rows = mixing.mixed(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    cells, factor = defaultdict(float), {}
    for r in rows:
        c = r["source"], r["lang"], r["topic"]
        cells[c] += r["estimated_tokens"]
        factor[c] = r["factor"]
    total = sum(cells.values())
    assert len(cells) == 27
    for d in range(3):
        own, raked = defaultdict(float), defaultdict(float)
        for c, t in cells.items():
            own[c[d]] += t
            raked[c[d]] += t * factor[c]
        power = {k: (v / total) ** mixing.ALPHA for k, v in own.items()}
        for k in own:
            assert raked[k] == pytest.approx(total * power[k] / sum(power.values()), rel=1e-5 if one_task else 1e-2)
