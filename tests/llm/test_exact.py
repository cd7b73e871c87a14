import hashlib
import re

import numpy as np
from helpers import documents, empty, rows

from entityspark.llm import exact


def normal(t):
    return re.sub("[\x20\x09-\x0d]+", " ", t or "")


def brute(texts, ids):
    groups = {}
    for k, t in enumerate(texts):
        groups.setdefault(normal(t), []).append(((ids[k] is None, ids[k] or 0), k))
    return [(ids[k], ids[min(groups[normal(t)])[1]], len(groups[normal(t)]), hashlib.sha256(normal(t).encode()).hexdigest()) for k, t in enumerate(texts)]


def test_groups_match_brute_force(spark):
    long = " ".join(f"wörd{k * k}" for k in range(9000))
    texts = [None, "", " ", "\t\n", "a b", "a  b", "a b", long, long.replace(" ", "\n"), long + "!", "!" + long, "x" * 50000, "x" * 50000, "x" * 50001, "a b"]
    ids = [5, 4, 3, None, 9, 9, 2, 20, 19, 18, 17, 30, 31, 32, None]
    found = exact.exact_groups(documents(spark, texts, ids).repartition(3))
    assert rows(found, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(brute(texts, ids), key=lambda r: [(v is not None, v) for v in r])
    assert found.filter("kept").count() == len({normal(t) for t in texts})


def test_empty_table(spark):
    assert exact.exact_groups(empty(spark)).collect() == []


def test_clashing_hashes_get_different_identifiers(spark):
    one = spark.createDataFrame([(1, [(7, b"a"), (8, b"c")]), (2, [(7, b"b"), (8, b"c")]), (3, [(7, b"a"), (8, b"c")])], "row_id long, chunks array<struct<h: long, digest: binary>>")
    found = {r["row_id"]: r["recipe"] for r in exact.verified(one).collect()}
    assert found[1] == found[3] != found[2]


def test_cuts_follow_content():
    data = np.random.RandomState(1).randint(97, 123, 60000).astype(np.uint8)
    shifted = np.concatenate([data[:100][::-1], data])
    ends = next(exact.cuts(data, np.array([0, len(data)]), 256, 2048, 16384))
    later = next(exact.cuts(shifted, np.array([0, len(shifted)]), 256, 2048, 16384))
    assert len({e + 100 for e in ends} & set(later)) > len(ends) // 2
