"""The operators applied to the tables with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityspark.llm import exact, hardneg, linedup, media, mixing, packing, pii, secrets, simhash, suffix, toxicity, turns, warc
from entityspark.llm.common import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages and read the archives back."""
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path, payload="html")
    found = warc.read_archives(spark, path)
    return found.select(F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


#: The weights of domains, languages and sources.
def domain():
    return F.when(F.col("source") == "src0", "web").when(F.col("source").isin([f"src{k}" for k in range(1, 8)]), "forum").otherwise("press")


WEIGHTS: list[dict[str, float]] = [{"web": 3.0, "forum": 4.0, "press": 3.0}, {"en": 6.0, "de": 2.0, "fr": 2.0, "es": 1.0}, {"src3": 2.0, "src12": 2.0}]
SHARE, EPOCHS, SEED = 0.4, 2, 17


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mixture of 40 % of the corpus's tokens, with up to two epochs of scarce leaves."""
    return mixing.mix(table(spark, sf_dir, "documents"), domain(), WEIGHTS, SHARE, EPOCHS, SEED)


def op3_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of all documents without repeated passages of 200 bytes."""
    found = suffix.remove_repeats(table(spark, sf_dir, "documents"), length=200)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: Draws the surrogates; a production run reads its own from a safe place.
SECRET = "surrogates of the test tables"


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with surrogates for personal data."""
    return pii.replace(table(spark, sf_dir, "documents"), SECRET)


def tokenizer_files() -> dict[str, str]:
    """Where the public tokenizer's ranks are, and its pattern."""
    import public_tokenizers

    return {"ranks_path": public_tokenizers.path("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"), **tokenizer_files())


def op6_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal normalised texts."""
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as telephony sound, stored and read back."""
    return media.archived(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of SimHash fingerprints within 3 bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model that is fitted outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines that resemble an earlier one."""
    found = linedup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_removed").cast("long").alias("n_removed"), "text")


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents; a source is an owner, its texts of one language are a repository."""
    found = secrets.secrets(table(spark, sf_dir, "documents"), F.col("source"), F.col("lang"))
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("found", lambda s: s["kind"] < secrets.BASE)
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(secrets.written(base), 256).alias("base_sha256"), secrets.written(F.col("found")).alias("spans"), "n_live", "n_example"
    )


def op12_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations repaired at the least cost; those that lose all rows stand with zeros."""
    rows = table(spark, sf_dir, "conversations")
    report, repaired = turns.repair(turns.damaged(rows))
    everyone, hashes = rows.select(F.col("conv_id").alias("original")).distinct(), turns.digests(repaired).withColumnRenamed("conv_id", "hashed")
    found = everyone.join(report, F.col("original").eqNullSafe(F.col("conv_id")), "left").join(hashes, F.col("original").eqNullSafe(F.col("hashed")), "left")
    numbers = [F.coalesce(F.col(n), F.lit(0).cast("long")).alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(F.col("original").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_hardneg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh one's label is off by one."""
    vectors = table(spark, sf_dir, "embeddings")
    off = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hardneg.mine(hardneg.usable(off))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_warc, op2_mixing, op3_suffix, op4_surrogates, op5_packing, op6_exact, op7_media, op8_simhash, op9_toxicity, op10_lines, op11_secrets, op12_turns, op13_hardneg)}


OP1 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM m
"""

OP6 = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t)
"""


# Lines as sets of words. Sets of 4 words or more are paired by the rarest words, the others are equal or not alike.
OP10 = r"""
WITH l AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id) AS one, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents),
s AS (SELECT doc_id, line_no, line, list_sort(list_filter(list_distinct(regexp_split_to_array(lower(line), '[\x20\x09-\x0D]+')), lambda w: w <> '')) AS words FROM l),
sets AS (SELECT words, min({'d': doc_id, 'l': line_no}) AS spot FROM s WHERE len(words) > 0 GROUP BY words),
often AS (SELECT w, count(*) AS n FROM (SELECT unnest(words) AS w FROM sets) GROUP BY w),
ranked AS (SELECT spot, w, size, row_number() OVER (PARTITION BY spot ORDER BY n, w) AS r FROM (SELECT spot, unnest(words) AS w, len(words) AS size FROM sets) JOIN often USING (w)),
prefix AS (SELECT * FROM ranked WHERE size >= 4 AND r <= size - ceil(0.8 * size - 1e-9) + 1),
pairs AS (SELECT DISTINCT y.spot AS y, x.spot AS x FROM prefix y JOIN prefix x USING (w)
  WHERE x.spot < y.spot AND least(x.size, y.size) >= 0.8 * greatest(x.size, y.size) - 1e-9),
gone AS (SELECT DISTINCT y FROM pairs JOIN sets a ON a.spot = y JOIN sets b ON b.spot = x
  WHERE len(list_intersect(a.words, b.words)) >= 0.8 * (len(a.words) + len(b.words) - len(list_intersect(a.words, b.words))) - 1e-9),
stay AS (SELECT spot.d AS doc_id, spot.l AS line_no FROM sets WHERE spot NOT IN (SELECT y FROM gone)),
kept AS (SELECT doc_id, line_no, line FROM s WHERE len(words) = 0 OR (doc_id, line_no) IN (SELECT (doc_id, line_no) FROM stay))
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines,
  (coalesce(len(string_split(d.text, chr(10))), 0) - coalesce(k.n, 0))::BIGINT AS n_removed, CASE WHEN d.text IS NOT NULL THEN coalesce(k.t, '') END AS text
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY line_no) AS t FROM kept GROUP BY doc_id) k USING (doc_id)
"""


def case(name: str, weights: dict[str, float]) -> str:
    return "CASE " + " ".join(f"WHEN {name} = '{k}' THEN {w!r}::DOUBLE" for k, w in weights.items()) + " ELSE 1.0::DOUBLE END"


def mixing_sql() -> str:
    levels, ctes, above = ["domain", "lang", "source"], [], "root"
    for depth, name in enumerate(levels):
        keys, parent = ", ".join(levels[: depth + 1]), levels[:depth]
        on = " AND ".join(f"c.{k} = a.{k}" for k in parent) or "true"
        by = ", ".join(parent) or "1"
        way = f"PARTITION BY {by} ORDER BY capacity / w, {name}"
        ctes.append(f"""n{depth} AS (
  SELECT c.*, {case(f"c.{name}", WEIGHTS[depth])} AS w, a.whole
  FROM (SELECT {keys}, sum(tokens * {EPOCHS})::BIGINT AS capacity, sum(tokens)::BIGINT AS tokens FROM leaves GROUP BY {keys}) c JOIN {above} a ON {on}),
l{depth} AS (SELECT *, (whole - coalesce(sum(capacity) OVER ({way} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / sum(w) OVER ({way} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM n{depth}),
b{depth} AS (SELECT {keys}, tokens, least(capacity::DOUBLE, w * max(level) OVER (PARTITION BY {by})) AS whole FROM l{depth})""")
        above = f"b{depth}"
    return rf"""
WITH docs AS (
  SELECT doc_id, CASE WHEN source = 'src0' THEN 'web' WHEN source IN ({", ".join(f"'src{k}'" for k in range(1, 8))}) THEN 'forum' ELSE 'press' END AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens
  FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens FROM docs GROUP BY ALL),
root AS (SELECT least((sum(tokens) * {EPOCHS})::DOUBLE, sum(tokens)::DOUBLE * {SHARE}::DOUBLE) AS whole FROM leaves),
{", ".join(ctes)},
plan AS (SELECT domain, lang, source, tokens, floor(whole + 1e-6)::BIGINT AS budget FROM b2),
parts AS (SELECT *, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS full_epochs FROM plan),
placed AS (SELECT d.*, p.full_epochs, p.budget - p.full_epochs * p.tokens AS rest, md5('{SEED}:' || p.full_epochs || ':' || d.doc_id) AS ord
  FROM docs d JOIN parts p USING (domain, lang, source)),
run AS (SELECT *, sum(CASE WHEN rest > 0 THEN n_tokens ELSE 0 END) OVER (PARTITION BY domain, lang, source ORDER BY ord) AS up_to FROM placed),
taken AS (SELECT *, full_epochs + CASE WHEN rest > 0 AND n_tokens > 0 AND up_to <= rest THEN 1 ELSE 0 END AS times FROM run)
SELECT doc_id, domain, lang, source, n_tokens, e::INTEGER AS epoch FROM (SELECT *, unnest(range(times)) AS e FROM taken)
"""


def secrets_sql() -> str:
    quote = lambda p: "'" + p.replace("\\\"", '"').replace("'", "''") + "'"
    ctes = []
    for k, (name, pattern, group) in enumerate(secrets.KINDS):
        good = {"assign": f"length(value) >= {secrets.SHORTEST_ASSIGNED}", "owned": "regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[0-9]')"}.get(name, "true")
        ctes.append(f"""k{k} AS (SELECT r, {k} AS kind, '{name}' AS name, value, {good} AS good, "end" - size AS "start", "end" FROM (
  SELECT r, value, length(m) AS size, sum(length(g) + length(m)) OVER (PARTITION BY r ORDER BY pos) AS "end" FROM (
    SELECT r, unnest(range(len(ms))) AS pos, unnest(ms) AS m, unnest(vs) AS value, unnest(gs[1:len(ms)]) AS g FROM (
      SELECT r, regexp_extract_all(t, {quote(pattern)}) AS ms, regexp_extract_all(t, {quote(pattern)}, {group}) AS vs, regexp_split_to_array(t, {quote(pattern)}) AS gs FROM d))))""")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS owner, coalesce(lang, '') AS repository, coalesce(text, '') AS t FROM documents),
{", ".join(ctes)},
m AS (SELECT * FROM ({" UNION ALL ".join(f"SELECT * FROM k{k}" for k in range(len(secrets.KINDS)))}) WHERE good),
v AS (SELECT value, count(DISTINCT owner) AS owners, bool_or(regexp_matches(value, '[A-Za-z]') AND regexp_matches(value, '[0-9]') AND len(list_distinct(string_split(value, ''))) >= {secrets.DISTINCT} AND NOT regexp_matches(lower(value), '{secrets.EXAMPLES}')) AS live
  FROM m JOIN d USING (r) GROUP BY value),
s AS (SELECT m.*, name || ':' || "start" || ':' || "end" AS span, CASE WHEN owners > 2 THEN 'example' WHEN owners = 1 AND live THEN 'live' ELSE 'unclear' END AS verdict FROM m JOIN v USING (value)),
g AS (SELECT r, count_if(kind = 0) AS n_assign, count_if(kind = 1) AS n_access, count_if(kind = 2) AS n_hex, string_agg(span, ',' ORDER BY "start", kind) FILTER (kind < 3) AS base, string_agg(span, ',' ORDER BY "start", kind) AS spans,
    count_if(verdict = 'live') AS n_live, count_if(verdict = 'example') AS n_example FROM s WHERE name <> 'owned' OR verdict = 'live' GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_example, 0)::BIGINT AS n_example FROM d LEFT JOIN g USING (r)
"""


def repair_sql() -> str:
    """The repair row by row: four states as structs of the cost (12 digits) and audit, and the text so far."""
    add = lambda s, cost, op, role: f"{{'v': lpad(CAST(CAST({s}.v[1:12] AS BIGINT) + {cost} AS VARCHAR), 12, '0') || {s}.v[13:] || '{op}', 't': {s}.t || {role}}}"
    line = lambda role: f"chr(10) || {role} || ':' || n.text"
    insert = {"u": "chr(10) || 'user:'", "a": "chr(10) || 'assistant:'"}
    never = "{'v': '900000000000', 't': ''}"
    gone = lambda s: add(s, 2, "D", "''")
    as_s = f"CASE WHEN n.stays AND n.initial = 's' THEN {add('w.e', 'n.more', 'K', line('n.role'))} ELSE {never} END"

    def stay(s: str, to: str, name: str, before: str = "") -> str:
        other = {"u": "a", "a": "u"}[to]
        text, cost = (insert[other] + " || ", "5 + ") if before else ("", "")
        return f"CASE WHEN NOT n.stays THEN {never} WHEN n.initial = '{to}' THEN {add(s, cost + 'n.more', before + 'K', text + line('n.role'))} ELSE {add(s, cost + '1 + n.more', before + 'R', text + line(name))} END"

    user, assistant = "'user'", "'assistant'"
    new_u = ", ".join([gone("w.u"), *(stay(s, "u", user) for s in ("w.e", "w.s", "w.a")), stay("w.u", "u", user, "I")])
    new_a = ", ".join([gone("w.a"), stay("w.u", "a", assistant), *(stay(s, "a", assistant, "I") for s in ("w.e", "w.s", "w.a"))])
    return rf"""
WITH RECURSIVE bits AS (SELECT i, list_reduce([i] || range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) AS v FROM (SELECT unnest(range(256)) AS i)),
tbl AS (SELECT list(v ORDER BY i) AS t FROM bits),
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
h AS (SELECT c.*, xor(list_reduce([4294967295] || list_transform(string_split(name, ''), lambda x: ascii(x)::BIGINT), lambda a, b: xor(tbl.t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 20 AS fate FROM c, tbl),
d AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy FROM h WHERE fate <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again FROM d),
f AS (SELECT *, role[1:1] AS initial, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank' WHEN again THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 'truncated' ELSE '' END AS fault FROM o),
n AS (SELECT *, fault NOT IN ('blank', 'duplicate') AS stays, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more, lag(initial) OVER (PARTITION BY conv_id ORDER BY k) || initial AS pair FROM f),
w AS (
  SELECT conv_id, 0::BIGINT AS k, {{'v': '000000000000', 't': ''}} AS e, {never} AS s, {never} AS u, {never} AS a FROM (SELECT DISTINCT conv_id FROM n)
  UNION ALL
  SELECT w.conv_id, n.k, {gone("w.e")}, least({gone("w.s")}, {as_s}), least({new_u}), least({new_a})
  FROM w JOIN n ON n.k = w.k + 1 AND n.conv_id IS NOT DISTINCT FROM w.conv_id),
ends AS (SELECT conv_id, arg_max(least(e, a, {add("u", 5, "I", insert["a"])}), k) AS z FROM w GROUP BY conv_id),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count_if(fault = 'blank')::BIGINT AS blank, count_if(fault = 'duplicate')::BIGINT AS duplicate,
    count_if(fault = 'truncated')::BIGINT AS truncated, count_if(pair NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal FROM n GROUP BY conv_id)
SELECT q.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  coalesce(z.v[1:12]::BIGINT, 0) AS cost, coalesce(z.v[13:], '') AS audit, sha256(coalesce(z.t[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) q LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM q.conv_id LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM q.conv_id
"""


OP13 = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT vec_id AS anchor_id, label AS own, v AS q FROM r WHERE vec_id % 100 = 0),
p AS (SELECT a.*, vec_id AS positive_id, list_dot_product(q, v)::BIGINT AS positive_score FROM a JOIN r ON label = own AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY list_dot_product(q, v) DESC, vec_id) <= 5),
n AS (SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, list_dot_product(q, v)::BIGINT AS negative_score FROM p JOIN r ON label <> own
  WHERE 30 * positive_score <= 100 * list_dot_product(q, v) AND 100 * list_dot_product(q, v) <= 90 * positive_score)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id))::INTEGER AS rank, negative_id, positive_score, negative_score
FROM n QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": OP1, "op2_mixing": mixing_sql(), "op6_exact": OP6, "op10_lines": OP10, "op11_secrets": secrets_sql(), "op12_turns": repair_sql(), "op13_hardneg": OP13}
