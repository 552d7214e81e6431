"""Hard negatives by cover trees: covering radii bound inner products, leaves are verified exactly.

Vectors get one more component that makes all of a share equally long. Then the inner product with
a query falls with the distance from it, and a node's covering radius bounds the products of all
points below it from above and below.
"""

from __future__ import annotations

import heapq
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import LEAST, buckets_for, longs, stage

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
# A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 50, 95
# Numbers in the vectors of a share; anchors of a block.
ENTRIES = 1 << 19
ANCHORS = 4096
# A level's radius as a part of the level above; points of a leaf; points tried as centres at once.
SHRINK, LEAF, TRIED = 0.5, 32, 128
# Leaves verified at a time, room for the rounding of bounds, largest sum that doubles hold exactly.
BUNDLE = 128
MARGIN = 1e-9
EXACT = 2.0**52


def labelled_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, vector (floor(scale * x)), kind (its size as a power of two) of the rows that take part.

    Rows with a null label or vector, or a null or non-finite component, do not. A null vec_id
    counts as the smallest long. Where vec_id is divisible by 7 the label is the next of ten.
    """
    x = lambda v: F.floor(v.cast("double") * scale).cast("long")
    good = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    kept = embeddings.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(good, F.lit(False)))
    vec_id, label = F.coalesce(F.col("vec_id").cast("long"), F.lit(LEAST)), F.col("label").cast("long")
    return kept.select(
        vec_id.alias("vec_id"),
        F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.transform("embedding", x).alias("vector"),
        F.ceil(F.log2(F.greatest(F.size("embedding"), F.lit(1)))).cast("int").alias("kind"),
    )


def matrix(column, width: int = 0) -> np.ndarray:
    """Vectors as rows, shorter ones ending in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]] if len(column) else np.empty(0)
    size = np.diff(ends)
    out = np.zeros((len(size), max(width, int(size.max(initial=1)))), np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(values)) - np.repeat(ends[:-1] - ends[0], size)] = values
    return out


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0))


def _net(points: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Centres farther apart than `radius` so that each point is within it of one; each point's nearest centre."""
    far = np.full(len(points), np.inf)
    near = np.zeros(len(points), np.int64)
    centres: list[int] = []
    while True:
        open_ = np.flatnonzero(far > radius)
        if not len(open_):
            return np.array(centres), near
        tried = open_[:TRIED]
        apart = _distances(points[tried], points[tried])
        np.fill_diagonal(apart, 0)
        taken: list[int] = []
        for i in range(len(tried)):
            if not taken or apart[i, taken].min() > radius:
                taken.append(i)
        fresh = tried[taken]
        gap = _distances(points[fresh], points)
        gap[np.arange(len(fresh)), fresh] = 0
        best = gap.argmin(axis=0)
        least = gap[best, np.arange(len(points))]
        near = np.where(least < far, len(centres) + best, near)
        far = np.minimum(far, least)
        centres += fresh.tolist()


class CoverTree:
    """A cover tree over one share of vectors, as arrays: nodes by level, points in leaf order.

    Each level's centres are a net of the node above at half its covering radius, so centres are
    apart by more than the radius that covers their points. The radius kept is the greatest
    distance that occurs. A child holds the points nearest to its centre.
    """

    FIELDS = ("vectors", "vec_id", "uid", "label", "centre", "radius", "low", "high", "child", "past")

    def __init__(self, **arrays):
        for name in self.FIELDS:
            setattr(self, name, arrays[name])
        x = self.vectors.astype(np.float64)
        self.squares = (x * x).sum(axis=1)
        self.reach = float(self.squares.max(initial=0))
        self.doubles = x
        self.centres = x[self.centre]

    @classmethod
    def build(cls, vectors, vec_id, uid, label) -> CoverTree:
        x = vectors.astype(np.float64)
        squares = (x * x).sum(axis=1)
        points = np.concatenate([x, np.sqrt(np.maximum(squares.max() - squares, 0))[:, None]], axis=1)
        order = np.arange(len(points))
        first = int(squares.argmax())
        rows = [[first, float(_distances(points[[first]], points).max()), 0, len(points), 0, 0]]
        at = 0
        while at < len(rows):
            centre, radius, low, high = rows[at][:4]
            if high - low > LEAF and radius > 0:
                here = order[low:high].copy()
                net, near = _net(points[here], radius * SHRINK)
                if len(net) > 1:
                    sorted_ = np.argsort(near, kind="stable")
                    order[low:high] = here[sorted_]
                    cuts = low + np.searchsorted(near[sorted_], np.arange(len(net) + 1))
                    gap = points[here] - points[here[net[near]]]
                    gap = np.sqrt((gap * gap).sum(axis=1))
                    wide = np.zeros(len(net))
                    np.maximum.at(wide, near, gap)
                    rows[at][4:] = len(rows), len(rows) + len(net)
                    rows += [[int(here[c]), float(r), int(a), int(b), 0, 0] for c, r, a, b in zip(net, wide, cuts, cuts[1:])]
            at += 1
        where = np.empty(len(order), np.int64)
        where[order] = np.arange(len(order))
        centre, radius, low, high, child, past = (np.array(c) for c in zip(*rows))
        arrays = dict(centre=where[centre], radius=radius, low=low, high=high, child=child, past=past)
        return cls(vectors=vectors[order], vec_id=vec_id[order], uid=uid[order], label=label[order], **arrays)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{name: getattr(self, name) for name in self.FIELDS})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> CoverTree:
        with np.load(io.BytesIO(data)) as arrays:
            return cls(**{name: arrays[name] for name in cls.FIELDS})

    def bounds(self, query: np.ndarray, square: float, nodes: slice) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product that points of these nodes can have with the query."""
        both = square + self.reach
        distance = np.sqrt(np.maximum(both - 2 * (self.centres[nodes] @ query), 0))
        radius = self.radius[nodes]
        room = MARGIN * both + MARGIN
        low = (both - (distance + radius) ** 2) / 2 - room
        return low, (both - np.maximum(distance - radius, 0) ** 2) / 2 + room

    def search(self, query: np.ndarray, uid: int, label: int, same: bool, windows: list[tuple], k: int):
        """(point, score) lists: the k best of each window (least, greatest score) among points whose label is the same or not.

        Best-first: nodes come by the greatest product they may hold for a window that is not
        settled. Nodes outside all of these are skipped; leaves are scored in whole numbers.
        """
        wide = min(len(query), self.vectors.shape[1])
        q = np.zeros(self.vectors.shape[1])
        q[:wide] = query[:wide]
        square = float((query.astype(np.float64) ** 2).sum())
        least = np.array([float(w[0]) for w in windows])
        most = np.array([float(w[1]) for w in windows])
        exact = np.sqrt(square * self.reach) < EXACT
        found: list[list[tuple]] = [[] for _ in windows]

        def wanted(low, high):
            return (high[:, None] >= least) & (low[:, None] <= most)

        def verify(nodes):
            size = self.high[nodes] - self.low[nodes]
            at = np.arange(size.sum()) + np.repeat(self.low[nodes] - (np.cumsum(size) - size), size)
            at = at[((self.label[at] == label) == same) & (self.uid[at] != uid)]
            if exact:
                score = (self.doubles[at] @ q).astype(np.int64)
            else:
                score = (self.vectors[at][:, :wide] * query[:wide]).sum(axis=1)
            for w, (low, high) in enumerate(windows):
                hit = (score >= low) & (score <= high)
                if not hit.any():
                    continue
                own = at[hit]
                rows = zip((-score[hit]).tolist(), self.vec_id[own].tolist(), self.uid[own].tolist(), own.tolist())
                found[w] = heapq.nsmallest(k, [*found[w], *rows])
                if len(found[w]) == k:
                    least[w] = max(least[w], -found[w][-1][0])

        heap: list[tuple] = []

        def push(first: int, past: int):
            """Nodes of a level by what they may hold: leaves in bundles, inner nodes alone."""
            low, high = self.bounds(q, square, slice(first, past))
            worth = np.where(wanted(low, high), np.minimum(high[:, None], most), -np.inf).max(axis=1)
            order = np.argsort(-worth, kind="stable")[: np.count_nonzero(worth > -np.inf)]
            leaf = self.past[first + order] == 0
            for part, step in ((order[leaf], BUNDLE), (order[~leaf], 1)):
                for i in range(0, len(part), step):
                    some = part[i : i + step]
                    heapq.heappush(heap, (-worth[some[0]], int(first + some[0]), first + some, low[some], high[some]))

        push(0, 1)
        while heap:
            _, _, nodes, low, high = heapq.heappop(heap)
            # A window may have been settled since these were put here.
            nodes = nodes[wanted(low, high).any(axis=1)]
            if len(nodes) and self.past[nodes[0]]:
                push(int(self.child[nodes[0]]), int(self.past[nodes[0]]))
            elif len(nodes):
                verify(nodes)
        return [[(row[3], -row[0]) for row in rows] for rows in found]


def _found(rows: list[tuple], names: list[str]) -> pa.Table:
    kinds = {"place": pa.int32()}
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.table([pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(names, columns)], names=names)


_FOUND = "anchor long, anchor_id long, place int, positive_id long, positive_score long, vec_id long, uid long, score long"
_FOUND_NAMES = [c.split()[0] for c in _FOUND.split(", ")]
_ANY = (-(2**63), 2**63 - 1)


def _search(left: pa.Table, right: pa.Table, k: int, same: bool) -> pa.Table:
    """A block of anchors on one tree: the best of the same label, or those of others in each positive's window."""
    rows: list[tuple] = []
    if left.num_rows and right.num_rows:
        tree = CoverTree.load(right.column("tree")[0].as_py())
        queries = matrix(left.column("vector"))
        for i, (anchor, vec_id, label, positives) in enumerate(zip(*(left.column(c).to_pylist() for c in ("uid", "vec_id", "label", "positives")))):
            known = [(p["place"], p["vec_id"], p["score"], window(p["score"])) for p in positives] if not same else [(0, None, None, _ANY)]
            known = [p for p in known if p[3][0] <= p[3][1]]
            if not known:
                continue
            results = tree.search(queries[i], anchor, label, same, [p[3] for p in known], k)
            for (place, positive_id, positive_score, _), best in zip(known, results):
                rows += [(anchor, vec_id, place, positive_id, positive_score, int(tree.vec_id[at]), int(tree.uid[at]), score) for at, score in best]
    return _found(rows, _FOUND_NAMES)


def window(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """Least and greatest whole n with low * score <= 100 * n <= high * score; empty for negative scores."""
    return -((-low * score) // 100), (high * score) // 100


def cover_trees(vectors: DataFrame, entries: int = ENTRIES) -> tuple[DataFrame, dict[int, int]]:
    """kind, share, tree of every share, staged, and the number of shares of each kind.

    Rows go to shares by a hash of `uid`. Vectors of about the same size share a tree, so a few
    long ones do not widen the others; a share holds about `entries` numbers.
    """
    counts = {r.kind: r["count"] for r in vectors.groupBy("kind").count().collect()}
    shares = {kind: buckets_for(n, max(64, entries >> kind), least=1) for kind, n in counts.items()}

    def build(rows: pa.Table) -> pa.Table:
        own = [longs(rows.column(c).combine_chunks()) for c in ("vec_id", "uid", "label")]
        tree = CoverTree.build(matrix(rows.column("vector")), *own)
        first = rows.slice(0, 1)
        return pa.table([first.column("kind").cast(pa.int32()), first.column("share").cast(pa.int32()), pa.array([tree.dump()], pa.binary())], names=["kind", "share", "tree"])

    of_kind = F.coalesce(*[F.when(F.col("kind") == kind, n) for kind, n in shares.items()], F.lit(1))
    dealt = vectors.withColumn("share", F.pmod(F.xxhash64("uid"), of_kind).cast("int"))
    trees = dealt.groupBy("kind", "share").applyInArrow(build, "kind int, share int, tree binary")
    return stage(trees, "cover-trees"), shares


def hard_negatives(embeddings: DataFrame, every: int = 50, entries: int = ENTRIES, scale: int = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id is divisible by `every`, positives an anchor's first
    POSITIVES other rows of its label, negatives the first NEGATIVES rows of other labels in the
    positive's window of scores; a pair without any gives no row. See `labelled_vectors` for the
    rows that take part. Higher scores come first, then smaller vec_ids; rows that share a vec_id are rows of
    their own. Shorter vectors count as ending in zeros. Scores must fit a long. An empty table
    gives an empty result.

    Each block of anchors searches each share's tree twice, for positives and then for the windows
    they open; the shares' best are merged.
    """
    every_row = labelled_vectors(embeddings, scale).withColumn("uid", F.monotonically_increasing_id())
    vectors = stage(every_row, "negatives-vectors")
    trees, shares = cover_trees(vectors, entries)
    anchors = vectors.filter(F.col("vec_id") % every == 0).select("uid", "vec_id", "label", "vector")
    blocks = buckets_for(anchors.count(), ANCHORS, least=1)

    def found(queries: DataFrame, k: int, same: bool) -> DataFrame:
        block = F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int").alias("block")
        of_kind = [F.arrays_zip(F.array_repeat(F.lit(kind), n).alias("kind"), F.sequence(F.lit(0), F.lit(n - 1)).alias("share")) for kind, n in shares.items()]
        left = queries.select("*", block, F.inline(F.concat(*of_kind)).alias("kind", "share"))
        right = trees.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
        names = ("block", "kind", "share")
        run = lambda a, b: _search(a, b, k, same)
        rows = left.groupBy(*names).cogroup(right.groupBy(*names)).applyInArrow(run, _FOUND)
        order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id", "uid")
        return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    if not shares:
        return embeddings.sparkSession.createDataFrame([], _RESULT)
    none = F.array().cast("array<struct<place int, vec_id long, score long>>").alias("positives")
    positive = F.struct(F.col("rank").alias("place"), "vec_id", "score")
    positives = found(anchors.select("*", none), POSITIVES, True).groupBy("anchor").agg(F.collect_list(positive).alias("positives"))
    asked = stage(anchors.join(positives.withColumnRenamed("anchor", "uid"), "uid"), "negatives-positives")
    return found(asked, NEGATIVES, False).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
