import random
from collections import defaultdict

import test_linedup
import test_simhash
from helpers import documents

import corpus_pipeline
from entityspark.llm import mixing, simhash


def make(tmp_path, spark):
    rnd = random.Random(9)
    vocabulary = [f"word{''.join(rnd.choices('abcdefgh', k=5))}" for _ in range(400)]
    texts, labels = [], []
    for k in range(160):
        words = rnd.choices(vocabulary, k=rnd.randint(20, 90))
        if k % 8 == 0:
            words.insert(3, "idiot")
        labels.append((k, 1, int(k % 8 == 0)))
        texts.append(" ".join(words[:15]) + "\n" + " ".join(words[15:]))
    texts += [texts[1], texts[2].replace("word", "Word", 1), texts[3] + "\n" + texts[5], None, "", ""]
    documents(spark, texts).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return spark.read.parquet(f"{tmp_path}/documents.parquet")


def test_stages_against_brute_force(spark, tmp_path):
    docs = make(tmp_path, spark)
    columns = docs.columns
    (_, clean), (_, lines), (_, near), (_, mixture), (_, pack) = corpus_pipeline.STAGES
    kept = clean(spark, docs, str(tmp_path)).cache()
    assert kept.columns == columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect() if "idiot" not in (r["text"] or "")}

    fewer = lines(spark, kept, str(tmp_path)).cache()
    order = sorted(kept.collect(), key=lambda r: r["doc_id"])
    brute = test_linedup.brute([r["text"] for r in order], [r["doc_id"] for r in order], 0.8)
    assert fewer.columns == columns and {r["doc_id"]: r["text"] for r in fewer.collect()} == {r["doc_id"]: b[0] for r, b in zip(order, brute, strict=True)}

    single = near(spark, fewer, str(tmp_path)).cache()
    order = sorted(fewer.collect(), key=lambda r: r["doc_id"])
    roots = test_simhash.brute_components([test_simhash.brute_fp(r["text"]) for r in order])
    assert single.columns == columns and sorted(r["doc_id"] for r in single.collect()) == sorted({order[k]["doc_id"] for k in roots})

    some = mixture(spark, single, str(tmp_path)).cache()
    n = {r["doc_id"]: len((r["text"] or "").split()) for r in single.collect()}
    taken = [r["doc_id"] for r in some.collect()]
    assert some.columns == columns and len(taken) == len(set(taken)) and sum(n[k] for k in taken) <= 0.8 * sum(n.values()) + 1
    assert sum(n[k] for k in taken) > 0.8 * sum(n.values()) - max(n.values())

    packed = pack(spark, some, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == set(taken)
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    key = lambda r: (r["doc_id"], r["piece"], r["length"], r["ids_crc32"])
    assert sorted(map(key, whole)) == sorted(map(key, packed))


def test_representatives_keep_one_row_of_each_group(spark):
    docs = documents(spark, ["a b c d", "a b c d", "e f g h", "e f g h", None, ""], [None, 7, 5, 5, 9, 8])
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [5, 7, 8]


def test_mixture_prefixes_against_brute_force(spark):
    rnd = random.Random(4)
    texts = [" ".join("w" * rnd.randint(1, 3) for _ in range(rnd.randint(0, 30))) for _ in range(300)]
    docs = documents(spark, texts).selectExpr("doc_id", "text", "CASE WHEN doc_id % 3 = 0 THEN 'de' END AS lang", "concat('src', doc_id % 5) AS source", "'extra' AS n_tokens2")
    domain = mixing.F.when(mixing.F.col("source") == "src0", "a").otherwise("b")
    weights, share, epochs, seed = [{"a": 9.0}, {"de": 3.0}, {"src2": 2.0}], 0.7, 2, 3
    found = defaultdict(int)
    for r in mixing.mix(docs, domain, weights, share, epochs, seed).collect():
        found[r["doc_id"]] += 1
    assert found == brute_mixture([r.asDict() for r in docs.collect()], weights, share, epochs, seed)


def brute_mixture(rows, weights, share, epochs, seed):
    import hashlib

    leaves = defaultdict(list)
    for r in rows:
        leaves["a" if r["source"] == "src0" else "b", r["lang"] or "", r["source"]].append((r["doc_id"], len((r["text"] or "").split())))
    total = {k: sum(n for _, n in v) for k, v in leaves.items()}

    def deal(prefix, budget):
        depth = len(prefix)
        if depth == 3:
            return {prefix: budget}
        children = sorted({k[: depth + 1] for k in leaves if k[:depth] == prefix})
        cap = {c: epochs * sum(n for k, n in total.items() if k[: depth + 1] == c) for c in children}
        got, open_ = dict.fromkeys(children, 0.0), set(children)
        while open_ and budget > 1e-9:
            w = sum(weights[depth].get(c[-1], 1.0) for c in open_)
            give = {c: budget * weights[depth].get(c[-1], 1.0) / w for c in open_}
            budget = 0.0
            for c in list(open_):
                room = cap[c] - got[c]
                got[c] += min(room, give[c])
                if give[c] >= room - 1e-12:
                    budget += give[c] - room
                    open_.discard(c)
        return {k: v for c in children for k, v in deal(c, got[c]).items()}

    out = defaultdict(int)
    for leaf, budget in deal((), min(share * sum(total.values()), epochs * sum(total.values()))).items():
        budget = int(budget + 1e-6)
        full, rest = divmod(budget, total[leaf]) if total[leaf] else (0, 0)
        for d, _ in leaves[leaf]:
            out[d] += full
        for d, n in sorted(leaves[leaf], key=lambda x: hashlib.md5(f"{seed}:{full}:{x[0]}".encode()).hexdigest()):
            if n and rest - n < 0:
                break
            rest -= n
            out[d] += bool(n) and budget % (total[leaf] or 1) > 0
    return {d: n for d, n in out.items() if n}


def test_stages_keep_columns_of_any_name(spark):
    from pyspark.sql import functions as F

    from entityspark.llm import mixing, simhash

    rows = [(k, f"word{k} " * (k + 1), "en", "src3", *range(6)) for k in range(6)]
    names = ["full", "cut", "times", "epoch", "__row", "row"]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` int" for n in names))
    mixed = mixing.mixed_rows(df, F.lit("web"), [{}, {}, {}], 1.0)
    assert mixed.columns == df.columns and sorted(map(tuple, mixed.collect())) == sorted(map(tuple, df.collect()))
    alone = simhash.representatives(df)
    assert alone.columns == df.columns and {tuple(r) for r in alone.collect()} <= {tuple(r) for r in df.collect()}
    none = df.limit(0)
    assert mixing.mixed_rows(none, F.lit("web"), [{}, {}, {}], 1.0).collect() == [] and simhash.representatives(none).collect() == []


def test_pipeline_on_an_empty_table_and_with_further_columns(spark, tmp_path):
    import corpus_pipeline

    names = ["full", "cut", "n_lines", "row_id", "stay", "fp"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` int" for n in names)
    rows = [(k, t, "en", "src3", None, *range(6)) for k, t in enumerate(["one two three four five\nsix", "one two three four five", None, "", "seven eight nine"])]
    for name, some in (("empty", []), ("some", rows)):
        spark.createDataFrame(some, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(0, 0, 1), (1, 1, 0)], "doc_id long, quality int, toxic int").limit(len(some)).write.parquet(f"{tmp_path}/{name}/labels.parquet")
        docs = spark.read.parquet(f"{tmp_path}/{name}/documents.parquet")
        for stage, of in corpus_pipeline.STAGES[:-1]:
            docs = of(spark, docs, f"{tmp_path}/{name}")
            assert docs.columns == [f.split()[0].strip("`") for f in schema.split(", ")], stage
        out = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert bool(out) == bool(some) and {r["doc_id"] for r in out} <= {r[0] for r in some}
