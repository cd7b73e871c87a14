import random

import pytest
from helpers import documents, empty
from pyspark.sql import functions as F

from entityspark.llm import linedup, queries


def brute(texts, ids, threshold):
    order = sorted(range(len(texts)), key=lambda k: (ids[k] is None, ids[k] or 0, k))
    seen, out = [], {}
    for k in order:
        if texts[k] is None:
            out[k] = (None, 0, 0)
            continue
        kept, all_lines = [], texts[k].split("\n")
        for line in all_lines:
            s = {w for w in line.lower().replace("\t", " ").replace("\r", " ").split(" ") if w}
            if not s or not any(s == t or len(s & t) >= threshold * len(s | t) - 1e-9 for t in seen):
                kept.append(line)
            if s:
                seen.append(s)
        out[k] = ("\n".join(kept), len(all_lines), len(all_lines) - len(kept))
    return [out[k] for k in range(len(texts))]


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)] + ["The", "of", "ÄRGER"]
    base = [[rnd.choice(vocabulary) for _ in range(rnd.randint(1, 25))] for _ in range(12)]
    texts = [None, "", "\n\n", " \t ", "one\n\none\nOne  ONE"]
    for _ in range(40):
        some = []
        for _ in range(rnd.randint(1, 5)):
            line = list(rnd.choice(base))
            for _ in range(rnd.randint(0, 4)):
                line[rnd.randrange(len(line))] = rnd.choice(vocabulary)
            some.append(rnd.choice([" ", "  "]).join(line))
        texts.append("\n".join(some))
    texts.append(" ".join(f"long{k}" for k in range(3000)) + "\n" + " ".join(f"long{k}" for k in range(2800)))
    return texts + texts[6:9]


@pytest.mark.parametrize("seed,threshold", [(1, 0.8), (2, 0.8), (3, 0.6), (4, 1.0)])
def test_matches_brute_force(spark, seed, threshold):
    texts = corpus(seed)
    ids = list(range(len(texts)))
    random.Random(seed).shuffle(ids)
    found = linedup.dedup_lines(documents(spark, texts, ids).coalesce(1), threshold)
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in found.collect()}
    assert [got[i] for i in ids] == brute(texts, ids, threshold)


def test_many_versions_of_a_line(spark):
    rnd = random.Random(5)
    base = [f"rare{k}" for k in range(30)]
    texts = []
    for _ in range(300):
        line = list(base)
        for _ in range(rnd.randint(0, 3)):
            line[rnd.randrange(30)] = f"x{rnd.randrange(10**6)}"
        texts.append(" ".join(line))
    found = linedup.dedup_lines(documents(spark, texts)).collect()
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in found}
    assert [got[k] for k in range(300)] == brute(texts, list(range(300)), 0.8)


def test_nulls_ties_clashing_names_and_empty_table(spark):
    assert linedup.dedup_lines(empty(spark)).collect() == []
    df = documents(spark, ["a b", "a b", "c", None], [None, None, 2, 2]).coalesce(1).withColumnRenamed("fp", "n_lines").withColumnRenamed("h", "line_no")
    found = linedup.dedup_lines(df)
    assert sorted(found.columns) == sorted([*df.columns, "n_removed"])
    assert sorted((r["text"] or "-") + str(r["n_removed"]) for r in found.collect()) == ["-0", "-1", "a b0", "c0"]


def test_rows_are_numbered_once(spark, monkeypatch, tmp_path):
    def otherwise_each_time(batches):
        held = [b for batch in batches for b in map(batch.slice, range(batch.num_rows), [1] * batch.num_rows)]
        n = len(list(tmp_path.iterdir()))
        (tmp_path / f"read-{n}").touch()
        yield from held[n:] + held[:n]

    texts = [f"a{k} b{k} c{k}\n\nd{k}" for k in range(9)]
    df = documents(spark, texts).coalesce(1)
    monkeypatch.setattr(queries, "table", lambda *_: df.mapInArrow(otherwise_each_time, df.schema))
    assert {r["doc_id"]: r["text"] for r in queries.op10_lines(spark, "").collect()} == dict(enumerate(texts))


def test_near_copies_are_not_all_compared(spark, monkeypatch):
    """The earliest line has the rare words of all versions but resembles none, so it settles none of them."""
    base, compared = [f"rare{k}" for k in range(30)], []
    often = [f"often{k}" for k in range(12)]
    texts = [" ".join(base[:24] + often)]
    texts += [" ".join([*base[:29], f"own{k}"]) for k in range(150)]
    texts += [" ".join(base[24:] + often + [f"filler{k}-{j}" for j in range(10)]) for k in range(300)]

    def counted(met, *rest, of=linedup.verified):
        compared.append(sum(m.count() for m in (met if isinstance(met, list) else [met])))
        return of(met, *rest)

    monkeypatch.setattr(linedup, "verified", counted)
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in linedup.dedup_lines(documents(spark, texts)).collect()}
    assert [got[k] for k in range(len(texts))] == brute(texts, list(range(len(texts))), 0.8)
    assert sum(compared) < 3 * len(texts)


@pytest.mark.parametrize("threshold", [0.5, 0.6, 0.8, 1.0])
def test_sets_meet_within_bands_of_sizes(spark, threshold):
    """Of sets that share a word only those of near sizes meet, and all of them."""
    own, largest = linedup.bands(F.col("id"), threshold)
    found = spark.range(1, 300).select("id", own.alias("own"), largest.alias("largest")).collect()
    meet = {(x["id"], y["id"]) for x in found for y in found if x["id"] <= y["id"] and y["own"] in (x["own"], x["largest"])}
    assert meet >= {(x, y) for x in range(1, 300) for y in range(x, 300) if x >= threshold * y - 1e-9}
    assert threshold < 0.8 or len(meet) < 299 * 300 / 4


def test_words_of_lines_with_any_white_space(spark):
    texts = ["a  B\tc\x0bd\x0ce\rf  a ", " a b ", "", " \t", "a\u00a0b \u2003 C", "\x1c a"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, line string")
    words = F.array_remove(F.split(F.lower("line"), f"{linedup.SPACE}+"), "")
    hashed = F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))
    assert rows.filter(linedup.codes(F.col("line")) != hashed).count() == 0
    assert [len(r[0]) for r in rows.orderBy("id").select(linedup.codes(F.col("line"))).collect()] == [6, 2, 0, 0, 3, 2]


def test_rare_words_come_first_among_many(spark):
    """200,000 words that occur once are told from 12,000 that occur 50 times."""
    own = F.transform(F.sequence(F.lit(1), F.lit(10)), lambda j: F.xxhash64(F.lit("own"), "id", j))
    often = F.transform(F.sequence(F.lit(0), F.lit(29)), lambda j: F.xxhash64(F.lit("often"), (F.col("id") * 30 + j) % 12000))
    sets = spark.range(20000).select(F.col("id").alias("set_no"), F.col("id").alias("doc_id"), F.concat(own, often).alias("codes"), own.alias("own_codes"))
    found = linedup.prefixes(sets, linedup.rarity(sets), 0.8).join(sets.select("set_no", "own_codes"), "set_no")
    low = F.lit((1 << linedup.BITS) - 1)
    first, once = (F.transform(c, lambda w: w.bitwiseAND(low)) for c in ("prefix", "own_codes"))
    x = found.agg(F.sum(F.size(F.array_intersect(first, once))).alias("once"), F.sum(F.size("prefix")).alias("all")).first()
    assert x["all"] == 9 * 20000 and x["once"] > 0.9 * x["all"]
