import hashlib
import heapq
import random
import re
import zlib

import pytest
from helpers import rows

from entityspark.llm import turns

SCHEMA = "conv_id long, turn long, role string, text string, n long, id long, block string, fault string"


def damage(found):
    out = []
    for conv, turn, role, text in found:
        role, text = (" " if v is None else v for v in (role, text))
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return out


def cheapest(found):
    """Shortest path over (rows done, state); an insertion may stand anywhere."""
    to = {("0", "s"): "1", **{(s, "u"): "2" for s in "013"}, ("2", "a"): "3"}
    heap, done = [(0, "", 0, "0", ())], set()
    while heap:
        cost, audit, k, state, out = heapq.heappop(heap)
        if k == len(found) and state in "03":
            return cost, audit, out
        if (k, state) in done:
            continue
        done.add((k, state))
        for role in ("user", "assistant"):
            if (state, role[0]) in to:
                heapq.heappush(heap, (cost + 5, audit + "I", k, to[state, role[0]], (*out, (role, ""))))
        if k < len(found):
            role, text, fault = found[k]
            heapq.heappush(heap, (cost + 2, audit + "D", k + 1, state, out))
            if fault not in ("blank", "duplicate"):
                for name, own, edit in ((role, 0, "K"), ("user", 1, "R"), ("assistant", 1, "R")):
                    if (state, name[:1]) in to:
                        heapq.heappush(heap, (cost + own + 5 * (fault == "truncated"), audit + edit, k + 1, to[state, name[:1]], (*out, (name, text))))


def brute(found):
    groups = {}
    for conv, turn, role, text in found:
        groups.setdefault(conv, []).append((turn, role or "", text or ""))
    for conv, own in groups.items():
        own.sort(key=lambda r: ((r[0] is not None, r[0] or 0), r[1].encode(), r[2].encode()))
        seen, faulty = set(), []
        for _, role, text in own:
            words = re.findall("[^\x20\x09-\x0d]", text)
            faulty.append((role, text, "blank" if not words else "duplicate" if (role, text) in seen else "" if words[-1] in ".!?" else "truncated"))
            seen.add((role, text))
        cost, audit, out = cheapest(faulty)
        known = [r[0] for r in own if r[0] is not None]
        count = lambda f: sum(x[2] == f for x in faulty)  # noqa: B023, E731
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(faulty, faulty[1:], strict=False))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest() if out else None
        yield conv, max(known) - min(known) + 1 - len(set(known)) if known else 0, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, digest


def found(spark, data):
    df = spark.createDataFrame([(*r, 7, 7, "x", "y") for r in data], SCHEMA).repartition(3)
    report, repaired = turns.repair(df)
    hashes = {r["conv_id"]: r["repaired_sha256"] for r in turns.digests(repaired).collect()}
    return {(*r, hashes.get(r[0])) for r in report.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit").collect()}


def conversations(seed, sizes):
    rnd = random.Random(seed)
    texts = ["a.", "b!", "c?", "d", "e. \n", "", " \t", "f\x1f", "é.", None, "long " * 3000 + "."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    return [(conv or None, rnd.choice([None, *range(k, k + 3)]), rnd.choice(roles), rnd.choice(texts) if rnd.random() < 0.4 else f"t{rnd.randrange(10**6)}" + rnd.choice([".", ".", ""])) for conv, size in enumerate(sizes) for k in range(size)]


@pytest.mark.parametrize("seed,bits", [(1, 8), (2, 1), (3, 2)])
def test_matches_shortest_paths(spark, monkeypatch, seed, bits):
    monkeypatch.setattr(turns, "BLOCK_BITS", bits)
    data = conversations(seed, [9, *(random.Random(seed).randrange(1, 12) for _ in range(60)), 150])
    data += data[:9] * 2
    assert found(spark, data) == set(brute(data))


def test_long_conversation_of_blocks_and_copies(spark):
    data = conversations(5, [0, 1500]) + [(1, 3, "user", "again.")] * 700 + [(2, None, None, None)] * 3
    assert found(spark, data) == set(brute(data))


def test_damage(spark):
    data = conversations(7, [40] * 12)
    df = spark.createDataFrame([(*r, 7, 7, "x", "y") for r in data], SCHEMA)
    order = lambda r: [(v is not None, v) for v in r]
    assert rows(turns.damaged(df), "conv_id", "turn", "role", "text") == sorted(damage(data), key=order)


def test_empty_table(spark):
    report, repaired = turns.repair(spark.createDataFrame([], SCHEMA))
    assert report.collect() == repaired.collect() == turns.digests(repaired).collect() == []
