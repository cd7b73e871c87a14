import itertools
import random

import numpy as np
import pytest
from helpers import documents, empty, rows

from entityspark.llm import toxicity as tox

WORDS = "the of and house river stone garden window idiot stupid loser morning paper simple letter orange mother forest".split()


@pytest.fixture(scope="module")
def costs(spark):
    rnd = random.Random(1)
    return tox.letter_costs(tox.trigrams(documents(spark, [" ".join(rnd.choices(WORDS, k=200)) for _ in range(20)])))


def test_trigrams_match_brute_force(spark):
    texts = ["Ab bé!", None, "", "straße", "日本 ab"]
    counts = np.zeros((27, 27, 27), int)
    for t in texts:
        letters = [0, 0, *(ord(x) - 96 if (x := tox.base_letter(c)) else 0 for c in (t or "").lower() + " ")]
        for a, b, c in zip(letters, letters[1:], letters[2:]):
            counts[a if b else 0, b, c] += 1
    found = tox.trigrams(documents(spark, texts)).astype(int)
    counts[0, 0, 0] = found[0, 0, 0]  # how many edges follow each other is of no interest
    assert (found == counts).all()


@pytest.mark.parametrize("token", ["1d10t", "id!ot", "i.d.i.o.t", "i d i o t", "idiooooot", "IDI0T", "1.d.1.0.t", "iiidiot", "îdïöt"])
def test_disguised_words_are_restored(costs, token):
    assert tox.restored(token, costs) == "idiot"


@pytest.mark.parametrize("token,word", [("river,", "river"), ("House.", "house"), ("st*pid", "stupid"), ("l0$er", "loser"), ("###", ""), ("2024", ""), ("", ""), ("letter$$$", "letter")])
def test_ordinary_words_stay(costs, token, word):
    assert tox.restored(token, costs) == word


def test_few_letters_are_enough(costs):
    assert tox.restored("1d10t", costs) == tox.restored("1d!07", costs) == "idiot" and tox.restored("1d!0+", costs) == "idiot"
    assert [tox.restored(t, costs) for t in ("2024-10-01", "12+3", "50%", "(1999)", "#5")] == [""] * 5


@pytest.mark.parametrize("token", ["stuupid", "sttupid", "STuUpid", "stupiidd"])
def test_doubled_letters_are_decoded(costs, token):
    assert tox.restored(token, costs) == "stupid" and "stupid" in tox.readings(token, costs)
    assert tox.readings("letter", costs) == {"letter"}


def test_long_runs_are_decoded(costs):
    said = "the stupid river and the idiot of the garden window".split()
    one = " ".join("".join(said))
    wide = "   ".join(map(" ".join, said))
    for run in (one, wide, one + " " + one):
        assert len(run) > 48 and run in tox.tokens(f"{run}\nmore text")
        assert {"stupid", "idiot", "garden"} <= tox.readings(run, costs)
    assert {"stupid", "idiot"} <= tox.readings("the-stup1d-river-and-the-1d10t-of-the-garden-window-and-house", costs)
    assert tox.decode("stupid" * 2000, costs) == "stupid" * 2000


def test_viterbi_finds_the_cheapest_path(costs):
    for token in ["l0s3r", "i.d1o.t", "stttup1d", "a!b|c"]:
        def price(path):
            total, x, y = sum(p[1] for p in path), 0, 0
            for letter in "".join(p[0] for p in path):
                total, x, y = total + costs[x, y, ord(letter) - 96], y, ord(letter) - 96
            return total + costs[x, y, 0]

        best = min(itertools.product(*tox.arcs(token)), key=price)
        assert tox.decode(token, costs) == "".join(p[0] for p in best)


def test_held_out_documents_are_told_apart(spark):
    rnd = random.Random(2)
    texts, labels = [], []
    for k in range(900):
        words = rnd.choices([w for w in WORDS if w not in ("idiot", "stupid", "loser")], k=60)
        bad = k % 5 == 0
        if bad:
            words[rnd.randrange(60)] = rnd.choice(["idiot", "stupid", "loser", "1d10t", "s t u p i d", "loooser"])
        texts.append(" ".join(words))
        labels.append((k, int(bad)))
    docs = documents(spark, texts)
    found = tox.scored(docs, tox.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))).collect()
    out = [r for r in found if r["held_out"]]
    right = sum(r["predicted"] == dict(labels)[r["doc_id"]] for r in out)
    assert len(out) > 200 and right / len(out) > 0.97


def test_nulls_empty_tables_and_clashing_names(spark):
    docs = documents(spark, [None, "", "idiot " * 20000, "a"], [None, 1, 2, 2]).withColumnRenamed("h", "score").withColumnRenamed("digest", "body")
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 0), (2, 1)], "doc_id long, toxic int")
    found = tox.scored(docs, tox.fit(docs, labels))
    assert found.columns == ["doc_id", "held_out", "score", "predicted"] and found.count() == 4
    none = tox.fit(empty(spark), labels.limit(0))
    assert tox.scored(empty(spark), none).collect() == []
    assert {r[0] for r in rows(tox.scored(docs, none), "score")} == {0.5}
    kept = tox.clean(docs, none, threshold=0.6)
    assert kept.columns == docs.columns and kept.count() == 4
    assert [r["restored"] for r in tox.restore(docs.limit(2), none.costs).collect()] == ["", ""]


def test_workers_need_not_have_the_package(tmp_path):
    import os
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).parents[2]
    code = f"""
import sys
sys.path[:0] = [{str(root)!r}, {str(root / "tests" / "llm")!r}]
from pyspark.sql import SparkSession
from helpers import documents
from entityspark.llm import toxicity
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
docs = documents(spark, ["you 1d10t", "stone garden", "îdiot b\\u00f6se", "a morning"] * 9)
labels = spark.createDataFrame([(k, int(k % 4 in (0, 2))) for k in range(36)], "doc_id long, toxic int")
assert toxicity.scored(docs, toxicity.fit(docs, labels)).count() == 36
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]


def test_counts_of_many_words_take_little_of_the_drivers_memory(spark):
    import tracemalloc

    docs = spark.range(300).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 700), k -> translate(md5(concat(id, ':', k)), '0123456789', 'ghijklmnop'))) AS text")
    tracemalloc.start()
    model = tox.fit(docs, spark.range(300).selectExpr("id AS doc_id", "int(id % 3 = 0) AS toxic"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(np.unique(model.weights)) > 1 and peak < 100e6
