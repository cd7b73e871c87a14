"""Hard negatives by branch-and-bound over ball trees.

Rows are dealt to shards by a hash of their id. The task that holds a shard builds one ball tree over it (numpy, balls of
at most 128 rows, split between labels first and then across the widest dimension) and lets the anchors stream past in
batches. A ball with centre c and radius r bounds all its inner products with an anchor q: q.c - |q| r from below, q.c +
|q| r from above. A ball is left out when its bounds miss the score window, when its labels can't count, or when it lies
strictly beneath the current kth (at the kth, when its least id does not come before it). Bounds have room for rounding;
scores are exact. Two searches are made, each merged over the shards: the best of the same label, then the best of other
labels within the window of each of those. A task holds one shard of at most 262,144 rows and one batch of anchors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from entityspark.llm.common import materialize

LEAF, BATCH, SHARD_ROWS, FEW_ROWS = 128, 1024, 1 << 18, 1024
#: Scaled components of this size take no part, so that scores stay exact.
TOO_LARGE = 1 << 26
NOTHING, LAST = np.iinfo(np.int64).min + 1, np.iinfo(np.int64).max


class BallTree:
    """Balls over integer vectors; rows lie in the order of the leaves, within one by id."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        order = np.lexsort((ids, labels))
        self.x, self.ids, self.labels = vectors[order], ids[order], labels[order]
        self.nodes: list[tuple] = []
        if len(ids):
            self._ball(0, len(ids))

    def _sorted(self, lo: int, hi: int, order: np.ndarray) -> None:
        for name in ("x", "ids", "labels"):
            own = getattr(self, name)
            own[lo:hi] = own[lo:hi][order]

    def _ball(self, lo: int, hi: int) -> int:
        at, x, labels = len(self.nodes), self.x[lo:hi], self.labels[lo:hi]
        first, last = int(labels.min()), int(labels.max())
        spread = x.max(0) - x.min(0) if x.shape[1] else np.zeros(1)
        same = not spread.any()
        center = x[0].copy() if same else x.mean(0)
        radius = 0.0 if same else float(np.sqrt(((x - center) ** 2).sum(1).max()))
        self.nodes.append(())
        left = right = -1
        if hi - lo <= LEAF:
            self._sorted(lo, hi, np.argsort(self.ids[lo:hi], kind="stable"))
        else:
            middle = (hi - lo) // 2
            if first != last:  # rows of several labels still lie in the order of labels
                edges = np.flatnonzero(np.diff(labels)) + 1
                middle = int(edges[np.abs(edges - middle).argmin()])
            elif same:
                self._sorted(lo, hi, np.argsort(self.ids[lo:hi], kind="stable"))
            else:
                self._sorted(lo, hi, np.argpartition(x[:, int(spread.argmax())], middle))
            left, right = self._ball(lo, lo + middle), self._ball(lo + middle, hi)
        self.nodes[at] = (lo, hi, left, right, center, radius, int(self.ids[lo:hi].min()), first, last)
        return at


class Search:
    """The k best rows for each query: an anchor, a window of scores, and whether rows must have its label or another one."""

    def __init__(self, tree: BallTree, anchors: np.ndarray, anchor_ids: np.ndarray, anchor_labels: np.ndarray, of: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, k: int):
        self.tree, self.a, self.ids, self.labels, self.of, self.low, self.high, self.same, self.k = tree, anchors, anchor_ids, anchor_labels, of, low, high, same, k
        self.scores, self.found = np.full((len(of), k), NOTHING), np.full((len(of), k), LAST)
        self.norms = np.sqrt((anchors * anchors).sum(1))
        largest = lambda m: float(np.abs(m).max()) if m.size else 0.0
        self.exact = largest(anchors) * largest(tree.x) * max(1, anchors.shape[1]) < 2**53
        if tree.nodes and len(of):
            self._visit(0, np.arange(len(of)))

    def _bounds(self, node: int, active: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        center, radius = self.tree.nodes[node][4:6]
        each, back = np.unique(self.of[active], return_inverse=True)
        dot = self.a[each] @ center
        room = self.norms[each] * radius
        if radius or not self.exact:
            room = room * (1 + 1e-9) + 1e-9 * self.norms[each] * (np.sqrt(center @ center) + 1) + 1e-6
        return (dot - room)[back], (dot + room)[back]

    def _visit(self, node: int, active: np.ndarray, bounds: tuple[np.ndarray, np.ndarray] | None = None) -> None:
        lo, hi, left, right, _, _, least, first, last = self.tree.nodes[node]
        below, above = bounds or self._bounds(node, active)
        label, kth = self.labels[self.of[active]], self.scores[active, -1]
        keep = (above >= self.low[active]) & (below <= self.high[active]) & ((above > kth) | ((above == kth) & (least < self.found[active, -1])))
        keep &= (first <= label) & (label <= last) if self.same else ~((first == label) & (label == last))
        active = active[keep]
        if not len(active):
            return
        if left < 0:
            self._leaf(lo, hi, active)
            return
        sides = [(n, self._bounds(n, active)) for n in (left, right)]
        for n, b in sorted(sides, key=lambda s: (-float(s[1][1].mean()), self.tree.nodes[s[0]][6])):
            self._visit(n, active, b)

    def _leaf(self, lo: int, hi: int, active: np.ndarray) -> None:
        ids, labels = self.tree.ids[lo:hi], self.tree.labels[lo:hi]
        each, back = np.unique(self.of[active], return_inverse=True)
        if self.exact:
            scores = (self.a[each] @ self.tree.x[lo:hi].T).astype(np.int64)
        else:
            scores = self.a[each].astype(np.int64) @ self.tree.x[lo:hi].T.astype(np.int64)
        scores, of = scores[back], self.of[active]
        alike = labels[None, :] == self.labels[of][:, None]
        good = alike & (ids[None, :] != self.ids[of][:, None]) if self.same else ~alike
        good &= (scores >= self.low[active][:, None]) & (scores <= self.high[active][:, None]) & (scores >= self.scores[active, -1][:, None])
        hit = good.any(1)
        if not hit.any():
            return
        active, scores = active[hit], np.where(good[hit], scores[hit], NOTHING)
        top = np.argsort(-scores, axis=1, kind="stable")[:, : self.k]  # rows lie by id
        new = np.take_along_axis(scores, top, 1)
        scores = np.concatenate([self.scores[active], new], 1)
        found = np.concatenate([self.found[active], np.where(new == NOTHING, LAST, ids[top])], 1)
        by_id = np.argsort(found, axis=1, kind="stable")
        scores, found = np.take_along_axis(scores, by_id, 1), np.take_along_axis(found, by_id, 1)
        best = np.argsort(-scores, axis=1, kind="stable")[:, : self.k]
        self.scores[active], self.found[active] = np.take_along_axis(scores, best, 1), np.take_along_axis(found, best, 1)


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", scale: int = 256) -> DataFrame:
    """(vec_id, label, vec): components scaled and floored. Rows with nulls or components that are not finite are left out."""
    named = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("long").alias("label"), F.col(f"`{embedding}`").cast("array<double>").alias("x"))
    named = named.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).filter(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < TOO_LARGE / scale)))
    rows = named.select("vec_id", "label", F.transform("x", lambda v: F.floor(v * scale).cast("int")).alias("vec"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("r")).select("vec_id", "r.label", "r.vec")


def matrix(column: pa.Array, rows: np.ndarray, width: int) -> np.ndarray:
    flat = column.take(pa.array(rows)).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), width)


def search(rows: DataFrame, anchors: DataFrame, shards: int, same: bool, k: int, window: tuple[int, int] | None = None) -> DataFrame:
    """(anchor_id, positive_id, positive_score, found_id, score): the k best of each shard. Anchors have ``near``, an array of
    (id, score) of their positives, when there is a window of percents of the positives' scores."""
    near = "array<struct<id: bigint, score: bigint>>"
    index = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"), "vec_id", "label", "vec", F.lit(None).cast(near).alias("near"))
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "vec_id", "label", "vec", (F.col("near") if window else F.lit(None).cast(near)).alias("near"))
    names = ["anchor_id", "positive_id", "positive_score", "found_id", "score"]

    def trees(held: list[pa.RecordBatch]) -> dict[int, BallTree]:
        """One tree for each length of vectors."""
        parts: dict[int, list] = {}
        for batch in held:
            vec, widths = batch.column("vec"), np.asarray(batch.column("vec").value_lengths())
            for width in np.unique(widths).tolist():
                own = np.flatnonzero(widths == width)
                parts.setdefault(width, []).append((matrix(vec, own, width), np.asarray(batch.column("vec_id"))[own], np.asarray(batch.column("label"))[own]))
        return {w: BallTree(*(np.concatenate(c) for c in zip(*p, strict=True))) for w, p in parts.items()}

    def answers(known: dict[int, BallTree], batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vec, widths, ids, labels = batch.column("vec"), np.asarray(batch.column("vec").value_lengths()), np.asarray(batch.column("vec_id")), np.asarray(batch.column("label"))
        for width in np.unique(widths).tolist():
            if width not in known:
                continue
            own = np.flatnonzero(widths == width)
            if window:
                given = batch.column("near").take(pa.array(own))
                of, flat = np.repeat(np.arange(len(own)), np.asarray(given.value_lengths())), given.flatten()
                positive, points = np.asarray(flat.field("id")), np.asarray(flat.field("score"))
                low, high = -((-window[0] * points) // 100), (window[1] * points) // 100  # rounded inwards
            else:
                of = np.arange(len(own))
                positive = points = np.zeros(len(of), np.int64)
                low, high = np.full(len(of), NOTHING), np.full(len(of), LAST)
            done = Search(known[width], matrix(vec, own, width), ids[own], labels[own], of, low, high, same, k)
            q, j = np.nonzero(done.scores != NOTHING)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (ids[own][of[q]], positive[q], points[q], done.found[q, j], done.scores[q, j])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, known = None, [], None
        for batch in batches:
            keys = np.stack([np.asarray(batch.column("shard")), np.asarray(batch.column("kind"))])
            cuts = [0, *(np.flatnonzero(np.diff(keys).any(0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if keys[0, a] != shard:
                    shard, held, known = keys[0, a], [], None
                if keys[1, a] == 0:
                    held.append(batch.slice(a, b - a))
                    continue
                if known is None:
                    known, held = trees(held), []
                for at in range(a, b, BATCH):
                    yield from answers(known, batch.slice(at, min(BATCH, b - at)))

    both = index.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "kind")
    return both.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def first(found: DataFrame, k: int, *keys: str) -> DataFrame:
    """The k best over all shards, with their rank from 1."""
    way = W.partitionBy(*keys).orderBy(F.col("score").desc(), "found_id")
    return found.withColumn("rank", F.row_number().over(way)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90)) -> DataFrame:
    """For each anchor (vec_id divisible by ``every``) and each of its best rows of the same label, the best rows of other
    labels whose score lies within the window of percents of the positive's.

    ``rows``: vec_id, label, vec (see ``usable``). Scores are inner products, ties go to the smaller id. Vectors of different
    lengths never meet. Of rows with one vec_id, ``usable`` keeps the least label and vector. Anchors without positives, or
    positives with nothing in their window, give no rows, and neither does an empty table.
    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    rows = materialize(rows.select("vec_id", "label", "vec"), "vectors")
    n = rows.count()
    shards = max(1, -(-n // SHARD_ROWS), min(rows.sparkSession.sparkContext.defaultParallelism, n // FEW_ROWS))
    anchors = rows.filter(F.col("vec_id") % every == 0)
    near = first(search(rows, anchors, shards, True, positives), positives, "anchor_id")
    near = near.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct(F.col("found_id").alias("id"), "score"))).alias("near"))
    asked = anchors.join(near, F.col("vec_id") == F.col("anchor_id")).select("vec_id", "label", "vec", "near")
    found = first(search(rows, asked, shards, False, negatives, window), negatives, "anchor_id", "positive_id")
    return found.select("anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
