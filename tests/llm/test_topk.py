import math
import random

import numpy as np

from tests.llm import fixtures
from wardline.llm import queries, topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, k=10):
    """(query_id, rank, vec_id, score), rows being (vec_id, embedding)."""
    whole = []
    for vec_id, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((vec_id, [math.floor(1024 * float(np.float32(x))) for x in v]))
    out = []
    for i, (query, q) in enumerate(whole):
        if query is None or query % every:
            continue
        scores = [(-sum(a * b for a, b in zip(q, v)), other) for j, (other, v) in enumerate(whole) if j != i]
        scores = sorted((s, -(2**63) if o is None else o) for s, o in scores)[:k]
        out += [(query, rank, o, -s) for rank, (s, o) in enumerate(scores, 1)]
    return sorted(out)


def result(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def test_small_table_with_ties_and_bad_rows(spark):
    draw = random.Random(1)
    rows = [(i, [draw.choice([-0.5, 0.0, 0.001, 0.7]) for _ in range(6)]) for i in range(420)]
    rows += [(500, None), (600, [1.0, None] * 3), (700, [float("nan")] * 6), (800, [float("inf")] * 6), (None, [9.0] * 6)]
    rows += [(100, [0.7] * 6), (101, [0.7] * 6), (900, [0.1, 0.2]), (901, []), (-100, [-1e3] * 6)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).withColumnsRenamed({"label": "row"})
    assert result(topk.top_products(df)) == brute(rows)
    assert result(topk.top_products(df, share=60)) == brute(rows)


def test_whole_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert result(queries.op2_top_products(spark, sf_dir)) == brute(rows)


def test_few_and_none(spark):
    assert topk.top_products(fixtures.empty(spark, SCHEMA)).count() == 0
    two = spark.createDataFrame([(0, [1.0, 0.5], 1), (1, [0.5, 1.0], 1)], SCHEMA)
    assert result(topk.top_products(two)) == [(0, 1, 1, 1024 * 512 * 2)]


def test_pruning_skips_short_vectors():
    draw = np.random.default_rng(2)
    x = (draw.normal(size=(4000, 16)) * draw.exponential(size=(4000, 1)) * 500).astype(np.int64)
    keys = np.stack([np.arange(4000), np.ones(4000, np.int64)], axis=1)
    turn = np.linalg.svd(x.T.astype(float) @ x)[0]
    q, j, score = topk.search(x[:40], keys[:40], x, keys, turn)
    for i in range(40):
        full = x @ x[i]
        full[i] = -(2**62)
        assert sorted(score[q == i], reverse=True) == sorted(full, reverse=True)[:10]
