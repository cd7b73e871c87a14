import math
import random

import pytest

from entityspark.llm import hardneg

SCHEMA = "vec_id long, embedding array<float>, label int, vec int, rank string, near int"


def brute(data, every, positives, negatives, window):
    rows = {}
    for i, v, label in data:
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v):
            own = (label, [math.floor(256 * x) for x in v])
            rows[i] = min(rows.get(i, own), own)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    out = set()
    for a, (label, q) in rows.items():
        if a % every:
            continue
        fit = [(-dot(q, v), i, lab) for i, (lab, v) in rows.items() if len(v) == len(q) and i != a]
        for s, p, _ in sorted(f for f in fit if f[2] == label)[:positives]:
            own = sorted(f for f in fit if f[2] != label and window[0] * -s <= 100 * -f[0] <= window[1] * -s)[:negatives]
            out |= {(a, p, r, n, -s, -t) for r, (t, n, _) in enumerate(own, 1)}
    return out


def vectors(seed, n, width=6, labels=4, copies=True):
    rnd = random.Random(seed)
    base = [[rnd.uniform(-2, 2) for _ in range(width)] for _ in range(25)]
    data = [(i, [x + rnd.choice([0, 0, 0.25, rnd.gauss(0, 0.4)]) for x in rnd.choice(base)], rnd.randrange(labels)) for i in range(n)]
    if copies:  # a third of all rows are one vector, with ties in ids and scores
        data += [(n + k, [0.5] * width, k % labels) for k in range(n // 2)]
    return data


@pytest.mark.parametrize("seed,n", [(1, 300), (2, 900), (3, 40)])
def test_matches_brute_force(spark, monkeypatch, seed, n):
    monkeypatch.setattr(hardneg, "LEAF", 16)
    monkeypatch.setattr(hardneg, "FEW_ROWS", 150)
    monkeypatch.setattr(hardneg, "BATCH", 7)
    data = vectors(seed, n)
    odd = [(None, [1.0] * 6, 1), (20000, None, 1), (20100, [1.0] * 6, None), (20200, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (20300, [math.nan] * 6, 1), (20400, [math.inf] * 6, 2), (20500, [1.0, 2.0], 1), (20501, [1.5, 2.0], 1),
           (20502, [1.0, 1.0], 2), (20600, [], 3), (20601, [], 3), (20602, [], 1), (0, data[0][1], 3), data[1], data[1], (-100, [1.0] * 6, -7)]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in data + odd], SCHEMA).repartition(3)
    found = {tuple(r) for r in hardneg.mine(hardneg.usable(df), 10, 5, 10, (30, 90)).collect()}
    # floats of the table, not of the test
    told = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    assert found == brute(told, 10, 5, 10, (30, 90))
    assert found


def test_large_components_stay_exact(spark):
    rnd = random.Random(4)
    data = [(i, [float(rnd.randrange(-200000, 200000)) for _ in range(5)], i % 3) for i in range(200)]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in data], SCHEMA)
    told = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    assert {tuple(r) for r in hardneg.mine(hardneg.usable(df), 10).collect()} == brute(told, 10, 5, 10, (30, 90))


def test_bounds_hold_for_every_ball():
    import numpy as np

    rng = np.random.default_rng(5)
    x = rng.integers(-300, 300, (700, 8)).astype(float)
    tree = hardneg.BallTree(x, rng.permutation(700), rng.integers(0, 3, 700))
    q = rng.integers(-300, 300, 8)
    for lo, hi, _, _, center, radius, least, first, last in tree.nodes:
        own = tree.x[lo:hi] @ q
        assert own.max() <= q @ center + np.linalg.norm(q) * radius + 1e-6 and own.min() >= q @ center - np.linalg.norm(q) * radius - 1e-6
        assert least == tree.ids[lo:hi].min() and (first, last) == (tree.labels[lo:hi].min(), tree.labels[lo:hi].max())


def test_empty_table(spark):
    assert hardneg.mine(hardneg.usable(spark.createDataFrame([], SCHEMA))).collect() == []
