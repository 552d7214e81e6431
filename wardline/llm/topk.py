"""Exact top-k inner products: descending lengths, rotated partial sums, Cauchy-Schwarz bounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import LEAST, buckets_for, longs, stage

K = 10
SCALE = 1024
# Vectors of a candidate share and of a query block; a task holds one of each.
SHARE = 50_000
QUERIES = 4096
# Candidates between two updates of the queries' thresholds.
STEP = 512
# Leading rotated components of the partial sums, as a part of all.
LEAD = 0.25
# Partial Gram matrices are added up in so many tasks before the driver adds the rest.
GRAM_TASKS = 16
# Room for the rounding of bounds that are computed in doubles.
MARGIN = 1e-9


def whole_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, row, vector: floor(scale * x) of each component, for vectors that are all finite.

    `row` numbers rows that share a vec_id. A null vec_id counts as the smallest long.
    """
    x = lambda v: F.floor(v.cast("double") * scale).cast("long")
    good = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    kept = embeddings.filter(F.col("embedding").isNotNull() & F.coalesce(good, F.lit(False)))
    kept = kept.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(LEAST)).alias("vec_id"), F.transform("embedding", x).alias("vector"))
    return kept.withColumn("row", F.row_number().over(Window.partitionBy("vec_id").orderBy("vector")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
    size = np.diff(ends)
    out = np.zeros((len(size), width), np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(values)) - np.repeat(ends[:-1] - ends[0], size)] = values
    return out


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all vectors, from their Gram matrix: strongest directions first.

    The matrix has width * width entries however many vectors there are; partial ones are added
    up in tasks, GRAM_TASKS sums reach the driver.
    """

    def partial(batches):
        for number, batch in enumerate(batches):
            x = _matrix(batch.column(0), width).astype(np.float64)
            gram = pa.array([(x.T @ x).ravel().tolist()], pa.list_(pa.float64()))
            yield pa.record_batch([pa.array([number % GRAM_TASKS], pa.int32()), gram], names=["part", "gram"])

    def added(table):
        rows = np.array(table.column("gram").to_pylist())
        return pa.table({"gram": pa.array([rows.sum(axis=0).tolist()], pa.list_(pa.float64()))})

    parts = vectors.select("vector").mapInArrow(partial, "part int, gram array<double>")
    sums = parts.groupBy("part").applyInArrow(added, "gram array<double>").collect()
    gram = np.sum([r.gram for r in sums], axis=0).reshape(width, width) if sums else np.eye(width)
    return np.linalg.svd(gram)[0]


def search(queries, query_keys, vectors, keys, turn: np.ndarray, k: int = K, step: int = STEP):
    """(query number, candidate number, score) of each query's best candidates.

    Candidates come by descending length. A block is looked at by the queries whose length times
    the block's greatest length reaches their k-th score so far; of its pairs, those are computed
    whose sum over the leading rotated components, plus the product of the remaining lengths,
    reaches it too. Scores are whole numbers. `keys`: rows of (vec_id, row); ties go to smaller
    ones, and a query's own row is no candidate.
    """
    length = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    order = np.lexsort((keys[:, 1], keys[:, 0], -length))
    vectors, keys, length = vectors[order], keys[order], length[order]
    lead = max(1, int(turn.shape[1] * LEAD))
    q, x = queries.astype(np.float64) @ turn, vectors.astype(np.float64) @ turn
    q_len = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
    q_rest, x_rest = (np.sqrt((m[:, lead:] ** 2).sum(axis=1)) for m in (q, x))
    slack = 1 + MARGIN
    best = [np.empty((0, 2), np.int64) for _ in queries]
    floor = np.full(len(queries), -np.inf)
    for at in range(0, len(vectors), step):
        block = slice(at, min(at + step, len(vectors)))
        room = MARGIN * q_len * length[at] + MARGIN
        alive = np.flatnonzero(q_len * length[at] * slack + room >= floor)
        if not len(alive):
            break
        bound = q[alive, :lead] @ x[block, :lead].T + np.outer(q_rest[alive], x_rest[block])
        own = (query_keys[alive, None, :] == keys[None, block, :]).all(axis=2)
        hit = (bound + room[alive, None] >= floor[alive, None]) & ~own
        row, col = np.nonzero(hit)
        for part in range(0, len(row), 1 << 18):
            r, c = row[part : part + (1 << 18)], col[part : part + (1 << 18)]
            score = np.einsum("ij,ij->i", queries[alive[r]], vectors[at + c])
            cuts = np.searchsorted(r, np.arange(len(alive) + 1))
            for i in np.flatnonzero(np.diff(cuts)).tolist():
                a, b = cuts[i], cuts[i + 1]
                who = alive[i]
                found = np.concatenate([best[who], np.stack([score[a:b], at + c[a:b]], axis=1)])
                ids = keys[found[:, 1]]
                best[who] = found[np.lexsort((ids[:, 1], ids[:, 0], -found[:, 0]))[:k]]
                if len(best[who]) == k:
                    floor[who] = best[who][-1, 0]
    number = np.repeat(np.arange(len(best)), [len(b) for b in best])
    found = np.concatenate(best) if best else np.empty((0, 2), np.int64)
    return number, order[found[:, 1]], found[:, 0]


def top_products(embeddings: DataFrame, every: int = 100, k: int = K, scale: int = SCALE, share: int = SHARE) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of each query.

    Queries are the rows whose vec_id is divisible by `every`, candidates all other rows; see
    `whole_vectors` for the vectors and which take no part. Candidates are dealt to shares by their
    id, so each share has its part of the long ones; a task searches one share for one block of
    queries (`search`), and the shares' best are merged. Shorter vectors count as ending in zeros.
    Rows that share a vec_id are rows of their own. Scores must fit a long. An empty table gives an
    empty result.
    """
    vectors = stage(whole_vectors(embeddings, scale), "top-vectors")
    many, width = vectors.agg(F.count("*"), F.max(F.size("vector"))).first()
    width = max(width or 1, 1)
    sent = vectors.sparkSession.sparkContext.broadcast(rotation(vectors, width))
    queries = vectors.filter(F.col("vec_id") % every == 0)
    shares = buckets_for(many, share, least=1)
    blocks = buckets_for(queries.count(), QUERIES, least=1)

    def dealt(frame, own, others, own_name, other_name):
        own = F.pmod(F.xxhash64("vec_id", "row"), F.lit(own)).cast("int").alias(own_name)
        other = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other_name)
        return frame.select("vec_id", "row", "vector", own, other)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = {"query_id": pa.int64(), "query_row": pa.int64(), "vec_id": pa.int64(), "row": pa.int64(), "score": pa.int64()}
        if not left.num_rows or not right.num_rows:
            return pa.schema(names.items()).empty_table()
        q, x = (_matrix(t.column("vector"), width) for t in (left, right))
        q_keys, x_keys = (np.stack([longs(t.column(c).combine_chunks()) for c in ("vec_id", "row")], axis=1) for t in (left, right))
        i, j, score = search(q, q_keys, x, x_keys, sent.value, k)
        return pa.table([pa.array(v) for v in (q_keys[i, 0], q_keys[i, 1], x_keys[j, 0], x_keys[j, 1], score)], names=list(names))

    left = dealt(queries, blocks, shares, "block", "share").groupBy("block", "share")
    right = dealt(vectors, shares, blocks, "share", "block").groupBy("block", "share")
    found = left.cogroup(right).applyInArrow(run, "query_id long, query_row long, vec_id long, row long, score long")
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
