import random

import numpy as np
import pytest

from tests.llm import brute, fixtures
from wardline.llm import components, jaccard_join, queries


def result(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in df.collect())


def near_copies(seed, n=160):
    """Templates, copies of them with more and less edits, short texts and shared passages."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdefg", k=draw.randrange(1, 12)))
    templates = [[word() for _ in range(size)] for size in (1, 3, 5, 6, 9, 40, 60, 100, 300)]
    passage = [word() for _ in range(30)]
    rows = []
    for i in range(n):
        text = list(draw.choice(templates))
        for _ in range(draw.choice([0, 0, 1, 1, 2, 3, 6])):
            text[draw.randrange(len(text))] = word()
        if draw.random() < 0.3:
            text += passage
        if draw.random() < 0.2:
            text = [word() for _ in range(draw.randrange(30))] + passage
        rows.append((i, draw.choice([" ", "\n"]).join(w.upper() if draw.random() < 0.1 else w for w in text), None, None))
    return rows


@pytest.mark.parametrize("frequent, block", [(32, 512), (3, 5), (2, 40)])
def test_links_equal_all_pairs(spark, frequent, block):
    rows = near_copies(frequent)
    docs = fixtures.documents(spark, rows).repartition(4)
    got = result(jaccard_join.link_documents(docs, frequent=frequent, block=block))
    assert got == brute.linked([r[:2] for r in rows])


def test_long_lists_are_taken_whole(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LONGEST", 3)
    rows = near_copies(7, 90)
    got = result(jaccard_join.link_documents(fixtures.documents(spark, rows), frequent=2, block=16))
    assert got == brute.linked([r[:2] for r in rows])


def test_odd_rows(spark):
    rows = fixtures.odd_rows() + [(20, "one two three", None, None), (21, "ONE  two\nthree", None, None)]
    docs = fixtures.documents(spark, rows)
    assert result(jaccard_join.link_documents(docs)) == brute.linked([r[:2] for r in rows])


def test_one_document_with_two_texts(spark):
    rows = [(5, "a b c d e f", None, None), (5, "u v w x y z", None, None), (7, "a b c d e f", None, None), (8, "u v w x y z", None, None)]
    got = result(jaccard_join.link_documents(fixtures.documents(spark, rows)))
    assert [r[2] for r in got] == [5, 5, 5, 5]


def test_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert result(queries.op7_jaccard_join(spark, sf_dir)) == brute.linked(rows)


def test_empty(spark):
    assert jaccard_join.link_documents(fixtures.empty(spark)).count() == 0


def test_linked_sets_share_a_signature():
    draw = np.random.default_rng(3)
    pool = np.sort(draw.integers(0, 2**64, 4000, dtype=np.uint64))
    common = pool[::2].copy()
    for size in (1, 2, 5, 9, 31, 33, 40, 64, 130, 700):
        for share in (0.0, 0.5, 1.0):
            for _ in range(8):
                frequent, rare = common, np.setdiff1d(pool, common)
                many = int(size * share)
                a = np.union1d(draw.choice(frequent, min(many, 1900), False), draw.choice(rare, min(size - many, 1900), False))
                cut = len(a) - draw.integers(0, len(a) // 5 + 1)
                b = np.sort(draw.choice(a, cut, False))
                if 100 * len(b) < 80 * len(a):
                    continue
                found = [set(np.concatenate(jaccard_join.signatures(s, common)).tolist()) for s in (a, b)]
                assert found[0] & found[1]


def test_components(spark):
    draw = random.Random(4)
    pairs = [(draw.randrange(400), draw.randrange(400)) for _ in range(230)] + [(500, i) for i in range(501, 900)] + [(900 + i, 901 + i) for i in range(60)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        p, q = sorted((find(a), find(b)))
        root[q] = p
    got = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: find(i) for a, b in pairs if a != b for i in (a, b)}


def test_bounds_never_exclude_a_link():
    draw = np.random.default_rng(8)
    pool = draw.integers(0, 2**64, 6000, dtype=np.uint64)
    sets = []
    for size in (1, 2, 100, 128, 129, 140, 500, 520, 2000, 2100, 2500):
        base = draw.choice(pool, size, False)
        for gone in (0, 0.02, 0.1, 0.3):
            kept = draw.choice(base, max(1, int(size * (1 - gone))), False)
            sets.append(np.unique(np.concatenate([kept, draw.choice(pool, int(size * gone / 2))])))
    size = np.array([len(s) for s in sets])
    bounds = jaccard_join.Bounds(size, [jaccard_join.set_bits(s) for s in sets], 80)
    may = bounds.may_link(np.arange(len(sets)), np.arange(len(sets)))
    linked = np.array([[100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)) for b in sets] for a in sets])
    assert (may | ~linked).all()
    assert may.sum() < 3 * linked.sum()
