import random

import pytest

from entityspark.llm import mixing


def poured(capacities, weights, whole):
    """Water-filling: full children leave, the rest share what is left by weight."""
    out, open_, left = [0.0] * len(capacities), [k for k, w in enumerate(weights) if w > 0], whole
    while open_:
        level = left / sum(weights[k] for k in open_)
        full = [k for k in open_ if capacities[k] <= weights[k] * level]
        if not full:
            for k in open_:
                out[k] = weights[k] * level
            break
        for k in full:
            out[k] = capacities[k]
            left -= capacities[k]
            open_.remove(k)
    return out


def brute(leaves, weights, target, epochs):
    """{leaf: budget} of a tree given as {(domain, language, source): tokens}."""
    w = lambda key: weights[len(key) - 1].get(key[-1], 1.0)
    capacity = {}
    for leaf, tokens in leaves.items():
        usable = all(w(leaf[:d]) > 0 for d in (1, 2, 3))
        for d in range(4):
            capacity[leaf[:d]] = capacity.get(leaf[:d], 0) + tokens * epochs * usable
    whole = {(): min(capacity[()], target if target > 1 else target * sum(leaves.values()))}
    for d in (1, 2, 3):
        for parent in {k[: d - 1] for k in leaves}:
            own = sorted({k[:d] for k in leaves if k[: d - 1] == parent})
            whole |= dict(zip(own, poured([capacity[k] for k in own], [w(k) for k in own], whole[parent]), strict=True))
    return {k: int(whole[k] + 1e-6) for k in leaves}


@pytest.mark.parametrize("seed", range(2))
def test_budgets_match_water_filling(spark, seed):
    rnd = random.Random(seed)
    leaves = {(rnd.choice("AB"), rnd.choice("xyz"), rnd.choice("pqr")): rnd.choice([0, 10, 100, 1000, 5000]) for _ in range(14)}
    weights = [{"A": rnd.choice([0, 1.0, 3.0]), "B": 2.0}, {"x": rnd.choice([0, 0.5]), "y": 4.0}, {"p": rnd.choice([0, 2.0]), "q": 0.25}]
    df = spark.createDataFrame([(*k, n) for k, n in leaves.items()], "domain string, lang string, source string, tokens long")
    for target, epochs in ((0.9, 3), (2500, 2)):
        found = {(r["domain"], r["lang"], r["source"]): r["budget"] for r in mixing.budgets(df, ["domain", "lang", "source"], weights, target, epochs).collect()}
        assert found == brute(leaves, weights, target, epochs)


def test_shortage_behind_a_weight_of_zero_goes_to_others(spark):
    df = spark.createDataFrame([("A", "x", 100), ("A", "y", 10), ("B", "z", 1000)], "domain string, lang string, tokens long")
    found = {r["lang"]: r["budget"] for r in mixing.budgets(df, ["domain", "lang"], [{}, {"x": 0}], 555, 1).collect()}
    assert found == {"x": 0, "y": 10, "z": 545}
