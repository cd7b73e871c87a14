"""Toxicity by noisy-channel deobfuscation: disguised words are restored, then the restored text is scored.

The channel writes letters as look-alikes (leetspeak), puts separators between them and repeats them. A token that
shows such marks becomes a lattice of letters; Viterbi decoding finds the path that a trigram model of characters,
counted over the whole corpus, and the channel's costs make most likely. Ordinary tokens need no decoding.

Scores come from words and their beginnings: how much more often documents with one are labelled toxic, held back
where there is little evidence. The classifier is fitted on a bounded sample of the labelled rows (``most_labelled``).
"""

from __future__ import annotations

import math
import re
import sys
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from entityspark.llm.common import columns, materialize, slices, text_or_empty, utf8

#: The letters that a look-alike can stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¢": "c", "#": "h",
}
#: Separators; the asterisk may also hide any vowel.
SEPARATORS = ".-_*~,'`^:/\\"
VOWELS = "aeiou"
#: Costs in nats: a look-alike, a dropped separator, a hidden vowel, a dropped symbol, a repeated letter taken once.
LOOKALIKE, SEPARATOR, HIDDEN, SYMBOL, SQUEEZED = 0.3, 0.1, 1.0, 4.0, 0.5
BUCKETS = 1 << 20
#: So many tokens are cached, up to this length; others are decoded each time.
MOST_CACHED, CACHED_LENGTH = 400_000, 64
#: Evidence counts from this weight on.
LEAST_WEIGHT = 2.0
#: How many least hashes tell whether labelled documents share passages.
SKETCH = 4
#: Documents of the average toxicity that stand beside those in which a word occurs.
HELD_BACK = 5.0


#: Letters seen so far. A plain table, as workers get this module's functions by value and need not have the package.
LETTERS: dict[str, str] = {}


def base_letter(c: str) -> str:
    """a-z for a letter with or without marks, else ''."""
    found = LETTERS.get(c)
    if found is None:
        base = unicodedata.normalize("NFKD", {"ß": "s", "ø": "o", "æ": "a", "œ": "o", "ð": "d", "þ": "t"}.get(c, c))[:1]
        found = LETTERS[c] = base if "a" <= base <= "z" else ""
    return found


def byte_classes() -> tuple[np.ndarray, np.ndarray]:
    """0 for no letter, else 1-26: of a byte that stands alone, and of one that follows the lead byte C3."""
    alone, after = np.zeros(256, np.uint8), np.zeros(256, np.uint8)
    for k in range(26):
        alone[[65 + k, 97 + k]] = k + 1
    for b in range(0x80, 0xC0):
        if letter := base_letter(chr(0xC0 + b - 0x80).lower()):
            after[b] = ord(letter) - 96
    return alone, after


def trigrams(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of letter trigrams, 0 standing for the edge of a word, over all documents; 27 x 27 x 27 in any corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone, after = byte_classes()
        total = np.zeros(27**3, np.int64)
        for batch in slices(batches, "body", 1 << 22):
            data, _ = utf8(batch.column("body"))
            own = alone[data]
            lead = np.flatnonzero(data[:-1] == 0xC3)
            own[lead + 1] = after[data[lead + 1]]
            keep = np.ones(len(data), bool)
            keep[lead] = False
            own = np.concatenate(([0, 0], own[keep], [0])).astype(np.int32)
            # behind an edge nothing of the word before is remembered
            total += np.bincount(own[:-2] * (own[1:-1] > 0) * 729 + own[1:-1] * 27 + own[2:], minlength=27**3)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["trigram", "n"])

    rows = columns(docs, text).select(F.concat(text_or_empty(text), F.lit(" ")).alias("body")).mapInArrow(count, "trigram int, n long")
    counts = np.zeros(27**3)
    for r in rows.groupBy("trigram").agg(F.sum("n").alias("n")).collect():  # 19683 rows at most
        counts[r["trigram"]] = r["n"]
    return counts.reshape(27, 27, 27)


def letter_costs(counts: np.ndarray) -> np.ndarray:
    """-log P(third | first two): trigrams, backed by bigrams, backed by single letters."""
    one = (counts.sum((0, 1)) + 1) / (counts.sum() + 27)
    two = (counts.sum(0) + 5 * one) / (counts.sum((0, 2))[:, None] + 5)
    three = (counts + 5 * two[None]) / (counts.sum(2)[:, :, None] + 5)
    return -np.log(three)


#: Ordinary tokens: letters between marks that aren't look-alikes, no letter twice in a row.
PLAIN = re.compile(r"[^\w@$|+(€£¢#]*([^\W\d_]+)[^\w@$|+(€£¢]*\Z")
DOUBLED = re.compile(r"(.)\1")
EDGES = re.compile(r"^[^\w@$|+(€£¢]+|[^\w@$|+(€£¢]+$|^([@$|+(#*&%!])\1{2,}|([@$|+(#*&%!])\2{2,}\W*$")
#: At least three single characters with separators between them.
SPACED = re.compile(r"(?<!\S)[^\W_](?:[ .\-_*]{1,3}(?:[^\W_]|[@$!])){2,}(?!\S)")
MAYBE_SPACED = re.compile(r"(?:^|\s)\S\s{1,3}\S\s{1,3}\S(?:\s|$)").search
#: Between letters or words of one token; the asterisk may be a letter.
GAP = re.compile(r"[\s.\-_~,'`^:/\\]+")


def arcs(token: str, edges: bool = False) -> list[tuple[list[tuple[str, float]], ...]]:
    """The lattice: for each position what may be written, as (letters, cost). With ``edges`` words may end at separators."""
    found, k, low = [], 0, token.lower()
    while k < len(low):
        c, end = low[k], k + 1
        if letter := base_letter(c):
            while end < len(low) and base_letter(low[end]) == letter:
                end += 1
            n = end - k
            found.append([(letter, 0.0)] if n == 1 else [(letter * 2, 0.0 if n == 2 else SQUEEZED), (letter, SQUEEZED)])
        elif c in LOOKALIKES:
            while end < len(low) and low[end] == c:
                end += 1
            n = min(end - k, 2)
            found.append([(x * m, LOOKALIKE * m + (SQUEEZED if m < end - k else 0)) for x in LOOKALIKES[c] for m in range(1, n + 1)] + ([("", SYMBOL)] if not c.isdigit() else []))
        elif c in SEPARATORS or c.isspace():
            found.append([("", SEPARATOR)] + ([(" ", SEPARATOR)] if edges else []) + ([(v, HIDDEN) for v in VOWELS] if c == "*" else []))
        else:
            found.append([("", SYMBOL)])
        k = end
    return found


def decode(token: str, costs: np.ndarray, edges: bool = False) -> str:
    """The most likely letters behind a token: Viterbi over states of the last two letters; blanks are the edges of words."""
    # A path is (path before, letters), so that long tokens take time by their length.
    best: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    for options in arcs(token, edges):
        after: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (cost, path) in best.items():
            for letters, extra in options:
                total, x, y = cost + extra, a, b
                for letter in letters:
                    z = ord(letter) - 96 if letter != " " else 0
                    total += costs[x, y, z]
                    x, y = (y, z) if z else (0, 0)  # behind an edge nothing of the word before is remembered
                if (x, y) not in after or total < after[x, y][0]:
                    after[x, y] = (total, (path, letters) if letters else path)
        best = after
    _, path = min(((cost + costs[a, b, 0], path) for (a, b), (cost, path) in best.items()), key=lambda x: x[0])
    parts = []
    while path:
        path, letters = path
        parts.append(letters)
    return "".join(reversed(parts))


def bare(token: str) -> str:
    core, before = token, None
    while core != before:
        before, core = core, EDGES.sub("", core)
    return core


def folded(token: str) -> str:
    return "".join(map(base_letter, token.lower()))


def restored(token: str, costs: np.ndarray) -> str:
    """A token's letters a-z: plain ones folded, disguised ones decoded, '' where there is no word."""
    plain = PLAIN.match(token)
    if plain and not DOUBLED.search(folded(plain[1])):
        return folded(plain[1])
    core = bare(token)
    # Numbers with their marks are numbers; a letter, or two symbols that look like letters, may make a word of them.
    if len(core) < 2 or not (any(map(str.isalpha, core)) or sum(c in LOOKALIKES and not c.isdigit() for c in core) > 1):
        return folded(core)
    return decode(core, costs)


def parted(token: str, costs: np.ndarray) -> list[str]:
    """The words of a token that separators run through: apart at gaps wider than the least, else where it is most likely."""
    core = bare(token)
    gaps = {len(g) for g in GAP.findall(core)}
    parts = re.split(rf"{GAP.pattern[:-1]}{{{min(gaps) + 1},}}", core) if len(gaps) > 1 else [core]
    return [w for p in parts for w in decode(p, costs, edges=True).split()]


def readings(token: str, costs: np.ndarray) -> set[str]:
    """The words that a token may stand for: as one word, a plain one also as it is written, and as words between separators."""
    found = {restored(token, costs)}
    if plain := PLAIN.match(token):
        found.add(folded(plain[1]))
    elif GAP.search(core := bare(token)) and sum(c.isalpha() for c in core) > 1:
        found.update(parted(token, costs))
    return found


class Words(dict):
    """What ``of`` makes of a token, kept for a bounded number of tokens."""

    def __init__(self, of):
        super().__init__()
        self.of = of

    def __missing__(self, token):
        value = self.of(token)
        if len(self) < MOST_CACHED and len(token) <= CACHED_LENGTH:
            self[token] = value
        return value


def kept_words(name: str, of) -> Words:
    """The words of a model, kept by a worker process for its later tasks; those of another model make room."""
    kept = vars(sys).setdefault("_entityspark_words", {})
    if name not in kept:
        kept.clear()
        kept[name] = Words(of)
    return kept[name]


def tokens(text: str) -> set[str]:
    """Distinct tokens, with every run of single characters also as one."""
    found = set(text.split())
    if MAYBE_SPACED(text):
        found.update(m[0] for m in SPACED.finditer(text))
    return found


def features(word: str) -> tuple[int, ...]:
    """Buckets of a restored word: itself and its first 4, 5 and 6 letters."""
    if len(word) < 3:
        return ()
    own = [zlib.crc32(b"w" + word.encode()) % BUCKETS]
    return (*own, *(zlib.crc32(b"p" + word[:n].encode()) % BUCKETS for n in (4, 5, 6) if len(word) >= n))


@dataclass
class Model:
    costs: np.ndarray
    weights: np.ndarray
    base: float
    slope: float = 1.0
    #: Tells models apart.
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def evidence(self, token: str) -> tuple[tuple[str, float], ...]:
        weighed = ((word, max((float(self.weights[b]) for b in features(word)), default=0.0)) for word in readings(token, self.costs))
        return tuple((word, weight) for word, weight in weighed if weight >= LEAST_WEIGHT)

    def score(self, text: str, words: Words) -> float:
        found = {x for t in tokens(text) for x in words[t]}
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.base + self.slope * sum(w for _, w in found)))))


def sketch(text: str) -> list[int]:
    """The least hashes of a text's five-word shingles, under SKETCH orders."""
    import xxhash

    words = text.lower().split()
    shingles = {" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    hashes = np.array([xxhash.xxh3_64_intdigest(x) for x in shingles], np.uint64)
    return [int((hashes * np.uint64(2 * k + 0x9E3779B97F4A7C15)).min() >> np.uint64(1)) for k in range(SKETCH)]


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, most_labelled: int = 20_000, text: str = "text", doc_id: str = "doc_id", label: str = "toxic") -> Model:
    """Fit on labelled rows outside the held-out fold, at most ``most_labelled``: those whose hashes of doc_id are smallest.

    Rows without a label or doc_id are left out; a document that any row marks as toxic is toxic. Without labels every
    document gets the score 0.5.
    """
    costs = letter_costs(trigrams(docs, text))
    rows = columns(labels, doc_id, label).select(F.col(f"`{doc_id}`").alias("labelled_id"), F.col(f"`{label}`").cast("int").alias("label")).dropna()
    rows = rows.filter(~held_out("labelled_id")).groupBy("labelled_id").agg(F.max("label").alias("label"))
    sample = rows.orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(most_labelled)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(lambda t: tuple(filter(None, map(features, readings(t, costs)))))
        for batch in slices(batches, "body", 1 << 22):
            bodies = batch.column(1).to_pylist()
            own = [sorted({x for t in tokens(body) for x in words[t]}) for body in bodies]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(sketch, bodies), pa.list_(pa.int64())), pa.array(own, pa.list_(pa.list_(pa.int32())))], names=["label", "sketch", "own"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS + 1))
        for batch in batches:
            for label, copies, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                total[int(label > 0), np.unique(own.values.flatten().to_numpy())] += 1 / copies
                total[int(label > 0), BUCKETS] += 1 / copies
        some = np.flatnonzero(total.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[0, some]), pa.array(total[1, some])], names=["bucket", "clean", "toxic"])

    # The sample is small by its bound, so it goes to the texts.
    texts = columns(docs, doc_id, text).join(F.broadcast(sample), F.col(f"`{doc_id}`") == F.col("labelled_id")).select("label", text_or_empty(text).alias("body"))
    known = materialize(texts.mapInArrow(read, "label int, sketch array<bigint>, own array<array<int>>"), "labelled")
    # Documents that share a passage speak with one voice: otherwise the words of a text with many copies are evidence.
    copies = F.greatest(*[F.count("*").over(W.partitionBy(F.get("sketch", F.lit(k)))) for k in range(SKETCH)])
    voices = materialize(known.select("label", copies.alias("copies"), "own"), "voices")
    counts = voices.mapInArrow(count, "bucket int, clean double, toxic double").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # BUCKETS + 1 rows at most; as columns, for rows of Python objects would fill the driver's memory.
    table = counts.toArrow()
    clean, toxic = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    at = table["bucket"].to_numpy()
    clean[at], toxic[at] = table["clean"].to_numpy(), table["toxic"].to_numpy()
    del table, at
    n, bad = clean[-1] + toxic[-1], toxic[-1]
    if not n or not bad or bad == n:
        return Model(costs, np.zeros(BUCKETS, np.float32), 0.0 if not n else 4.0 if bad else -4.0)
    base = math.log(bad / (n - bad))

    def weighed(clean: np.ndarray, toxic: np.ndarray) -> np.ndarray:
        share = (toxic + HELD_BACK * bad / n) / (clean + toxic + HELD_BACK)
        return np.log(share / (1 - share)) - base

    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The evidence in each document, by the counts of all others."""
        for batch in batches:
            sums = []
            for label, copies, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                ends, flat = own.values.offsets.to_numpy(), own.values.flatten().to_numpy()
                ends = ends - ends[0]
                weights = weighed(clean[flat] - (label <= 0) / copies, toxic[flat] - (label > 0) / copies)
                most = np.maximum.reduceat(weights, ends[:-1]) if len(flat) else np.zeros(0)
                sums.append(float(most[most >= LEAST_WEIGHT].sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums, pa.float64())], names=["label", "evidence"])

    # Words that chance put into toxic documents are strong evidence in these alone. What evidence is worth in documents
    # that didn't give it is learned from the sample, each document being left out of its own counts.
    sums = voices.mapInArrow(without, "label int, evidence double").toArrow()  # most_labelled rows at most
    slope, base_score = calibrated(sums["evidence"].to_numpy(), (sums["label"].to_numpy() > 0).astype(float))
    return Model(costs, weighed(clean, toxic)[:-1].astype(np.float32), base_score, slope)


def calibrated(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the logistic regression of y on x, by Newton's method with a small ridge."""
    at, rows = np.zeros(2), np.stack([x, np.ones_like(x)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ at, -30, 30)))
        slope = rows.T @ (y - p) - 1e-3 * at
        step = np.linalg.solve(rows.T @ (rows * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), slope)
        at = at + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(0.0, float(at[0])), float(at[1])


def scored(docs: DataFrame, model: Model, threshold: float = 0.7, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, held_out, score, predicted for each row. Null texts count as empty; they get the share of toxic documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept_words(model.name, model.evidence)
        for batch in slices(batches, "body", 1 << 23):
            scores = [model.score(body, words) for body in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "score"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = columns(docs, doc_id, text).select(F.col(f"`{doc_id}`").alias("doc_id"), held_out(doc_id).alias("held_out"), text_or_empty(text).alias("body"))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def clean(docs: DataFrame, model: Model, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """The rows, all their columns as they were, whose text scores below the threshold."""
    whole = [f.name for f in docs.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept_words(model.name, model.evidence)
        for batch in batches:
            bodies = batch.column(whole.index(text))
            yield batch.filter(pa.array([model.score(x.as_py() or "", words) < threshold for x in bodies], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def restore(docs: DataFrame, costs: np.ndarray, text: str = "text") -> DataFrame:
    """Add the column restored: the text's words, lower-case and folded, with disguised ones decoded."""
    whole, at = [f.name for f in docs.schema.fields], docs.schema.names.index(text)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(lambda t: restored(t, costs))
        for batch in batches:
            out = []
            for x in batch.column(at):
                joined = SPACED.sub(lambda m: " ".join(parted(m[0], costs)), x.as_py() or "")
                out.append(" ".join(filter(None, map(words.__getitem__, joined.split()))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*whole, "restored"])

    return docs.mapInArrow(run, f"{schema}, restored string")
