import itertools
import re

import numpy as np
import xxhash
from helpers import documents, empty, rows

from entityspark.llm import simhash


def brute_fp(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    root = list(range(len(fps)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(range(len(fps)), 2):
        if bin(fps[a] ^ fps[b]).count("1") <= 3:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(fps))]


def test_fingerprints_match_brute_force(spark):
    texts = [None, "", " \t", "One", "ONE two", "a b c d a b c d a b c", "Straße ÄÖ x y z\n\n q É", "word " * 3000]
    found = rows(simhash.near_duplicates(documents(spark, texts)), "doc_id", "fingerprint", "component_id")
    assert [r[1] for r in found] == [f"{brute_fp(t):016x}" for t in texts]
    assert [r[2] for r in found][:3] == [0, 0, 0]


def test_links_connect_what_brute_force_connects(spark):
    rnd = np.random.RandomState(3)
    fps = {0, 2**64 - 1, 1 << 63, 7, 15}
    for _ in range(25):
        base = int(rnd.randint(0, 2**63, dtype=np.int64)) * 2 + int(rnd.randint(2))
        fps.add(base)
        for _ in range(8):
            other = base
            for b in rnd.choice(64, rnd.randint(1, 6), replace=False):
                other ^= 1 << int(b)
            fps.add(other)
    # three differing bits within one half, and spread over both
    fps |= {0b111 << 40, 0b1011 << 50 | 1 << 20, 0x123456789ABCDEF0, 0x123456789ABCDEF0 ^ 0x80018000, 0x123456789ABCDEF0 ^ 0x8000000000000003}
    fps = sorted(fps)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(df), "fp", "to").collect()}
    found = {}
    for s in signed:
        found.setdefault(roots.get(s, s), set()).add(s)
    expected = {}
    for s, c in zip(signed, brute_components(fps), strict=True):
        expected.setdefault(c, set()).add(s)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, expected.values()))


def test_chain_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    found = {r["node"]: r["root"] for r in simhash.components(edges, "a", "b").collect()}
    assert found == {k: 0 for k in range(1, 61)} | {101: 100} | {k: 0 for k in ()}


def test_nulls_ties_and_empty_table(spark):
    assert simhash.near_duplicates(empty(spark)).collect() == []
    found = rows(simhash.near_duplicates(documents(spark, ["a b c"] * 3 + ["zz"], [None, 4, 4, None])), "doc_id", "component_id")
    assert found == [(None, None), (None, 4), (4, 4), (4, 4)]
