import itertools
import zlib

import numpy as np
import pytest

from tests.llm import fixtures
from wardline.llm import language_id, queries


def test_marginals_equal_the_sum_over_all_labellings():
    draw = np.random.default_rng(1)
    moves, sizes = draw.normal(size=(3, 3)), [1, 4, 0, 2]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    scores = draw.normal(size=(offsets[-1], 3))
    got = language_id.marginals(scores, moves, offsets)
    for a, b in zip(offsets[:-1], offsets[1:]):
        want = np.zeros((b - a, 3))
        for path in itertools.product(range(3), repeat=b - a):
            weight = np.exp(sum(scores[a + t, s] for t, s in enumerate(path)) + sum(moves[p, s] for p, s in zip(path, path[1:])))
            for t, s in enumerate(path):
                want[t, s] += weight
        assert got[a:b] == pytest.approx(want / want.sum(axis=1, keepdims=True) if b > a else want)


def test_gradient_of_the_likelihood():
    draw = np.random.default_rng(2)
    score, moves, gold = draw.normal(size=(2, 4, 3)), draw.normal(size=(3, 3)), draw.integers(0, 3, (2, 4))

    def loss(score, moves):
        total = 0.0
        for b in range(2):
            weight = lambda path: sum(score[b, t, s] for t, s in enumerate(path)) + sum(moves[p, s] for p, s in zip(path, path[1:]))  # noqa: B023, E731
            total += np.log(sum(np.exp(weight(p)) for p in itertools.product(range(3), repeat=4))) - weight(tuple(gold[b]))
        return total

    by_word, moved = language_id._step(score, gold, moves)
    for at in [(0, 0, 1), (1, 3, 2), (0, 2, 0)]:
        near = score.copy()
        near[at] += 1e-5
        assert by_word[at] == pytest.approx((loss(near, moves) - loss(score, moves)) / 1e-5, abs=1e-3)
    for at in [(0, 1), (2, 2)]:
        near = moves.copy()
        near[at] += 1e-5
        assert moved[at] == pytest.approx((loss(score, near) - loss(score, moves)) / 1e-5, abs=1e-3)


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op4_language_id(spark, sf_dir).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    right = sum(r.lang_pred == truth[r.doc_id].lang for r in held if truth[r.doc_id].lang)
    assert right >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_words_of_mixed_texts_are_told_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(language_id.sample(docs))
    by_lang = {r.lang: r.text for r in docs.filter("n_chars > 800").collect()}
    first, second = by_lang["de"][:400].lower(), by_lang["es"][:400].lower()
    data = f"{first} {second}".encode()
    share = language_id.language_shares(data, np.array([0, len(data)]), model)[0]
    found = dict(zip(model.names, share))
    assert found["de"] > 0.3 and found["es"] > 0.3


def test_runs_of_words_in_code_switched_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(language_id.sample(docs))
    by_lang = {r.lang: " ".join(r.text.split()[:60]) for r in docs.filter("n_chars > 800").collect()}
    order = ["de", "es", "en", "de"]
    mixed = " ".join(by_lang[g] for g in order)
    rows = [(1, mixed, None, None), (2, by_lang["fr"], None, None), (3, None, None, None), (4, "12 !?", None, None)]
    found = language_id.language_runs(fixtures.documents(spark, rows), model).orderBy("doc_id", "run").collect()
    runs = [r for r in found if r.doc_id == 1]
    assert {r.doc_id for r in found} == {1, 2} and [r.run for r in runs] == list(range(len(runs)))
    assert all(b.first_word == a.first_word + a.words and a.lang != b.lang for a, b in zip(runs, runs[1:]))
    labels = [r.lang for r in runs for _ in range(r.words)]
    sizes = [len(by_lang[g].split()) for g in order]
    assert len(labels) == sum(sizes)
    gold = [g for g, n in zip(order, sizes) for _ in range(n)]
    assert sum(a == b for a, b in zip(labels, gold)) > 0.8 * len(gold)
    assert all(0 < r.score <= 1 for r in runs)
    assert language_id.language_runs(fixtures.empty(spark)).count() == 0


def test_odd_rows_and_no_labels(spark):
    rows = fixtures.odd_rows() + [(30, "123 !? 😀", "en", "s"), (None, "das ist gut", "de", "s")]
    docs = fixtures.documents(spark, rows)
    got = {r.doc_id: r for r in language_id.identify(docs).collect()}
    assert len(got) == len(rows)
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3, 11, 30))
    assert got[4].lang_pred in {"en", "fr", "de"}
    blind = language_id.identify(docs.withColumn("lang", docs["lang"].substr(99, 0)).filter("lang = 'x'"))
    assert blind.count() == 0
    assert language_id.identify(fixtures.empty(spark)).count() == 0


def test_prediction_does_not_use_lang_or_source(spark):
    rows = [(i, "the thing and that", "en", "a") if i % 2 else (i, "der und das ist", "de", "b") for i in range(60)]
    model = language_id.fit(language_id.sample(fixtures.documents(spark, rows)))
    swapped = fixtures.documents(spark, [(i, t, "xx", "zz") for i, t, _, _ in rows])
    got = {r.doc_id: r.lang_pred for r in language_id.identify(swapped, model).collect()}
    assert all(got[i] == ("en" if i % 2 else "de") for i in range(60))


def test_rejects_only_texts_without_language(spark):
    rows = [(i, "the thing and that", "en", "a") if i % 2 else (i, "der und das ist", "de", "b") for i in range(60)]
    docs = fixtures.documents(spark, rows + [(100, "12 34", None, None), (101, None, None, None)])
    kept = language_id.drop_unidentified(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(60))
