import math
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm import fixtures
from wardline.llm import hard_negatives as hn
from wardline.llm import queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=50):
    """Counted result rows without the ids that ties leave open; rows being (vec_id, embedding, label)."""
    whole = []
    for vec_id, v, label in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            vec_id = -(2**63) if vec_id is None else vec_id
            whole.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in v], (label + 1) % 10 if vec_id % 7 == 0 else label))
    out = []
    for i, (anchor, a, own) in enumerate(whole):
        if anchor % every:
            continue
        scores = [(-sum(x * y for x, y in zip(a, v)), vec_id, label) for j, (vec_id, v, label) in enumerate(whole) if j != i]
        scores.sort()
        for p, positive, _ in [s for s in scores if s[2] == own][:5]:
            hits = [s for s in scores if s[2] != own and 50 * -p <= 100 * -s[0] <= 95 * -p][:3]
            out += [(anchor, positive, rank, n, -p, -s) for rank, (s, n, _) in enumerate(hits, 1)]
    return Counter(out)


def result(df):
    return Counter(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in df.collect())


@pytest.mark.parametrize("entries", [1 << 19, 1 << 10])
def test_ties_bad_rows_and_sizes(spark, entries):
    draw = random.Random(1)
    rows = [(i, [draw.choice([-0.5, 0.0, 0.002, 0.7]) for _ in range(6)], draw.randrange(4)) for i in range(420)]
    rows += [(500, None, 1), (600, [1.0, None] * 3, 1), (700, [float("nan")] * 6, 1), (800, [float("inf")] * 6, 2)]
    rows += [(None, [0.9] * 6, 1), (850, [0.9] * 6, None), (900, [0.1, 0.2], 3), (950, [], 1), (-100, [-1e3] * 6, 2), (-50, [0.7] * 300, 0)]
    rows += [(1000, [0.7] * 6, 1)] * 3 + [(2000 + i, [0.7] * 6, i % 3) for i in range(80)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS uid", "2 AS kind", "3 AS share", "4 AS rank", "5 AS score")
    assert result(hn.hard_negatives(df, entries=entries)) == brute(rows)


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert result(queries.op13_hard_negatives(spark, sf_dir)) == brute(rows)


def test_few_and_none(spark):
    assert hn.hard_negatives(fixtures.empty(spark, SCHEMA)).count() == 0
    alone = spark.createDataFrame([(50, [1.0], 1)], SCHEMA)
    assert hn.hard_negatives(alone).count() == 0
    no_anchor = spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 2)], SCHEMA)
    assert hn.hard_negatives(no_anchor).count() == 0


def test_window():
    for score in (-7, 0, 1, 3, 100, 12345, 10**18):
        low, high = hn.window(score)
        good = [n for n in (low - 1, low, high, high + 1) if 50 * score <= 100 * n <= 95 * score]
        assert set(good) == ({low, high} if low <= high else set())


@pytest.fixture(scope="module")
def clusters():
    draw = np.random.default_rng(4)
    x = np.repeat(draw.normal(size=(60, 12)), 60, axis=0) * 300 + draw.normal(size=(3600, 12)) * 8
    return np.floor(np.concatenate([x, x[:200], draw.normal(size=(300, 12)) * 100])).astype(np.int64)


def test_tree_covers_its_points(clusters):
    ids = np.arange(len(clusters))
    tree = hn.CoverTree.build(clusters, ids, ids, ids % 3)
    squares = (clusters.astype(float) ** 2).sum(axis=1)
    points = np.concatenate([tree.vectors, np.sqrt(squares.max() - tree.squares)[:, None]], axis=1)
    assert sorted(tree.vec_id) == ids.tolist()
    for node in range(len(tree.radius)):
        own = points[tree.low[node] : tree.high[node]]
        gap = np.sqrt(((own - points[tree.centre[node]]) ** 2).sum(axis=1))
        assert gap.max() <= tree.radius[node] * (1 + 1e-9) + 1e-6
        if tree.past[node]:
            inside = slice(tree.child[node], tree.past[node])
            assert tree.low[inside].min() == tree.low[node] and tree.high[inside].max() == tree.high[node]
            assert (tree.radius[inside] <= tree.radius[node] * hn.SHRINK + 1e-6).all()


def test_search_is_exact_and_skips_nodes(clusters, monkeypatch):
    ids = np.arange(len(clusters))
    tree = hn.CoverTree.load(hn.CoverTree.build(clusters, ids, ids, ids % 3).dump())
    seen = []
    plain = hn.CoverTree.bounds
    monkeypatch.setattr(hn.CoverTree, "bounds", lambda self, q, s, nodes: seen.append(nodes.stop - nodes.start) or plain(self, q, s, nodes))
    for q in range(0, len(ids), 97):
        score = clusters @ clusters[q]
        for same, k, windows in ((True, 5, [(-(2**63), 2**63 - 1)]), (False, 3, [hn.window(int(score[q])), (0, 5000), (10, 3)])):
            fits = ((ids % 3 == q % 3) == same) & (ids != q)
            got = tree.search(clusters[q], q, q % 3, same, windows, k)
            for (low, high), best in zip(windows, got):
                want = sorted((-s, i) for s, i in zip(score[fits].tolist(), ids[fits].tolist()) if low <= s <= high)[:k]
                assert [(-s, int(tree.vec_id[at])) for at, s in best] == want
    searches = 2 * len(range(0, len(ids), 97))
    assert sum(seen) < 0.5 * searches * len(tree.radius)
