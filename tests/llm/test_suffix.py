import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import documents, empty, rows

from entityspark.llm import suffix


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for k, d in enumerate(data):
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(x for x, g in zip(d, gone[:-1], strict=True) if not g)
        out.append((k, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rnd = random.Random(seed)
    words = ["".join(rnd.choices("abcdeéü", k=rnd.randint(1, 8))) for _ in range(300)]
    text = lambda n: " ".join(rnd.choices(words, k=n))
    passages = [text(n) for n in (30, 45, 60, 120)]
    texts = [None, "", "short", "a" * 700, "ab" * 300, "a" * 199, "x" + "a" * 199]
    for _ in range(45):
        parts = [text(rnd.randint(5, 120))]
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passages)
            cut = rnd.randint(0, len(p) // 4)
            parts += [p[cut : len(p) - rnd.randint(0, cut + 1)], text(rnd.randint(1, 60))]
        texts.append(rnd.choice(["", " ", "\n"]).join(parts))
    texts += texts[10:14]
    near = list(texts[20])
    for _ in range(3):
        near[rnd.randrange(len(near))] = "#"
    texts.append("".join(near))
    return texts


@pytest.mark.parametrize("seed,shard_bytes,most_blocks", [(1, 1 << 20, 4096), (2, 3000, 4096), (3, 1 << 20, 2)])
def test_matches_brute_force(spark, seed, shard_bytes, most_blocks):
    texts = corpus(seed)
    found = suffix.remove_repeats(documents(spark, texts).repartition(3), 200, shard_bytes=shard_bytes, most_blocks=most_blocks)
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in found.collect())
    assert got == brute(texts, 200)


def test_index_is_a_run_length_transform():
    blocks = [b"banana", b"bananas", b"anna", b"", b"banana"]
    data = np.frombuffer(b"\0".join([*blocks, b""]), np.uint8)
    stop = np.cumsum([len(b) + 1 for b in blocks]) - 1
    index = suffix.RunLengthIndex(data, stop)
    assert index.lengths.sum() == len(data) and len(index.lengths) < len(data)
    match = index.matches()
    for i in range(len(data)):
        own = bytes(data[i : stop[np.searchsorted(stop, i)]])
        longest = 0
        for j in range(len(data)):
            other = bytes(data[j : stop[np.searchsorted(stop, j)]])
            if i != j:
                n = next((k for k in range(min(len(own), len(other))) if own[k] != other[k]), min(len(own), len(other)))
                longest = max(longest, n)
        assert match[i] == longest


def test_nulls_and_empty_table(spark):
    assert suffix.remove_repeats(empty(spark)).collect() == []
    found = rows(suffix.remove_repeats(documents(spark, [None, "q" * 300, "q" * 300], [None, 3, 3])), "doc_id", "n_bytes", "n_removed", "n_spans")
    assert found == [(None, 0, 0, 0), (3, 300, 300, 1), (3, 300, 300, 1)]
