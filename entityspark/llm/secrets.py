"""Secrets in texts, told apart by who owns the places where they stand. DataFrame operations only.

Patterns find candidates. A candidate's value is known by its hash; occurrences are counted by hash, owner and repository
(partial sums before the shuffle), then distinct repositories and owners by hash. A value that more owners have than copies
of one project would explain is an example that people paste; one that a single owner has and that looks drawn at random is
a live credential; the rest stays unclear. Long tokens without any context (kind "owned") become spans only where they are
live, so a key that stands bare in a text is found by its rarity.

Spark has no function for the places of all matches. A text split at a pattern gives the gaps between its matches; matches
and gaps are exploded and running sums of their lengths, in code points, are the places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from entityspark.llm.common import materialize, text_or_empty


def either_case(words: str) -> str:
    """A pattern for ASCII letters of either case, and no others that fold to them."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


VALUE = "[A-Za-z0-9+/_.=-]"
#: Kind, pattern, and the group that holds the value. The first three are the base; those of 0 are their own value.
KINDS = [
    ("assign", rf"(?:{either_case('password|passwd|secret|token|api_?key')})[\"']?\x20*[:=]\x20*[\"']?({VALUE}+)", 1),
    ("access", "AKIA[A-Z0-9]{16,}", 0),
    ("hex", "[0-9a-f]{24,}", 0),
    ("vendor", "(?:gh[oprsu]_|github_pat_|glpat-|xox[abprs]-|sk_live_|rk_live_|npm_|hf_)[A-Za-z0-9_-]{16,}", 0),
    ("pem", "-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----", 0),
    ("owned", VALUE + "{20,}", 0),
]
BASE, SHORTEST_ASSIGNED = 3, 6
#: More distinct characters than a word has, both letters and digits, nothing that examples are made of.
DISTINCT, EXAMPLES = 8, "example|sample|dummy|test|change_?me|placeholder|your|xxxx|0000|1234|abcd"


def looks_live(value: Column) -> Column:
    return value.rlike("[A-Za-z]") & value.rlike("[0-9]") & (F.size(F.array_distinct(F.split(value, ""))) >= DISTINCT) & ~F.lower(value).rlike(EXAMPLES)


def counts(kind: Column, value: Column) -> Column:
    """Whether a match is a candidate: assigned values need their length, bare tokens letters of both cases and digits."""
    mixed = value.rlike("[A-Z]") & value.rlike("[a-z]") & value.rlike("[0-9]")
    return F.when(kind == 0, F.length(value) >= SHORTEST_ASSIGNED).when(kind == len(KINDS) - 1, mixed).otherwise(True)


def pieces(docs: DataFrame, owner: Column, repository: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each match: (doc_id, digest of the text, owner, repository, kind, pos, gap before it, size, value's hash,
    live-looking). Matches that don't count have no hash; they only hold their place."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), owner.alias("owner"), repository.alias("repository"), text_or_empty(text).alias("body"))
    rows = rows.select("*", F.sha2("body", 256).alias("digest"), *[F.regexp_extract_all("body", F.lit(p), F.lit(0)).alias(f"m{k}") for k, (_, p, _) in enumerate(KINDS)])

    def found(k: int) -> Column:
        _, pattern, group = KINDS[k]
        values = F.regexp_extract_all("body", F.lit(pattern), F.lit(group)) if group else F.col(f"m{k}")
        zipped = F.arrays_zip(F.col(f"m{k}").alias("m"), values.alias("v"), F.split("body", pattern, -1).alias("g"))
        piece = lambda x, pos: F.struct(F.lit(k).alias("kind"), pos.alias("pos"), F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("size"), x["v"].alias("value"))
        return F.when(F.size(f"m{k}") > 0, F.transform(F.slice(zipped, F.lit(1), F.size(f"m{k}")), piece)).otherwise(F.array().cast("array<struct<kind:int,pos:int,gap:int,size:int,value:string>>"))

    rows = rows.select("doc_id", "digest", "owner", "repository", F.inline(F.concat(*[found(k) for k in range(len(KINDS))])))
    good = counts(F.col("kind"), F.col("value"))
    return rows.select("doc_id", "digest", "owner", "repository", "kind", "pos", "gap", "size", F.when(good, F.sha2("value", 256)).alias("hash"), (good & looks_live(F.col("value"))).alias("looks_live"))


def ownership(found: DataFrame, most_owners: int = 2) -> DataFrame:
    """(hash, occurrences, repositories, owners, verdict) of each candidate. A null owner or repository counts as one."""
    known = lambda n: F.coalesce(F.col(n).cast("string"), F.lit("")).alias(n)
    each = found.filter("hash IS NOT NULL").select("hash", known("owner"), known("repository"), "looks_live").groupBy("hash", "owner", "repository").agg(F.count("*").alias("n"), F.max("looks_live").alias("live"))
    each = each.groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("repositories"), F.max("live").alias("live"))
    total = each.groupBy("hash").agg(F.sum("n").alias("occurrences"), F.sum("repositories").alias("repositories"), F.count("*").alias("owners"), F.max("live").alias("live"))
    return total.withColumn("verdict", F.when(F.col("owners") > most_owners, "example").when((F.col("owners") == 1) & F.col("live"), "live").otherwise("unclear")).drop("live")


def places(found: DataFrame) -> DataFrame:
    """(doc_id, digest, kind, start, end, hash) of the candidates; rows that repeat a document give its places once."""
    once = found.groupBy("doc_id", "digest", "kind", "pos").agg(F.min("gap").alias("gap"), F.min("size").alias("size"), F.min("hash").alias("hash"))
    way = W.partitionBy("doc_id", "digest", "kind").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(way)
    return once.select("doc_id", "digest", "kind", (end - F.col("size")).alias("start"), end.alias("end"), "hash").filter("hash IS NOT NULL")


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    name = F.array(*[F.lit(n) for n, _, _ in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets(docs: DataFrame, owner: Column, repository: Column, doc_id: str = "doc_id", text: str = "text", most_owners: int = 2) -> DataFrame:
    """Each document's secrets: doc_id, ``found`` (array of kind, start, end and verdict, by start and then kind), n_live and
    n_example. ``owner`` and ``repository`` say whose a document is.

    Nulls count as empty texts. Rows that repeat a document (doc_id and text) get the same result each; a value's occurrences
    count them all. A null doc_id is one like any other. An empty table gives an empty result; other columns are left out.
    Kinds may overlap, as an assigned value may be hexadecimal.
    """
    found = materialize(pieces(docs, owner, repository, doc_id, text), "secrets")
    spans = places(found).join(ownership(found, most_owners), "hash")
    spans = spans.filter((F.col("kind") < len(KINDS) - 1) | (F.col("verdict") == "live"))
    held = spans.groupBy(F.col("doc_id").alias("of"), "digest").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "verdict"))).alias("found"))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.sha2(text_or_empty(text), 256).alias("digest"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,verdict:string>>")
    rows = rows.join(held, (rows["digest"] == held["digest"]) & rows["doc_id"].eqNullSafe(held["of"]), "left").select("doc_id", F.coalesce("found", none).alias("found"))
    tally = lambda v: F.size(F.filter("found", lambda s: s["verdict"] == v)).cast("long")
    return rows.select("doc_id", "found", tally("live").alias("n_live"), tally("example").alias("n_example"))
