import math

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute, fixtures
from wardline.llm import language_model as lm
from wardline.llm import queries


def small_model(seed=3):
    model = lm.Model(np.arange(1, 10).astype(float), classes=3, hidden=4, seed=seed)
    draw = np.random.default_rng(seed)
    model.to_class += draw.normal(size=model.to_class.shape).astype(np.float32)
    model.to_word += draw.normal(size=model.to_word.shape).astype(np.float32)
    return model


def as_double(model):
    for name in model.NAMES:
        setattr(model, name, getattr(model, name).astype(np.float64))
    return model


def test_gradients():
    model, draw = as_double(small_model()), np.random.default_rng(4)
    ids, goal = draw.integers(0, 9, (5, 3)), draw.integers(0, 9, (5, 3))
    live = np.ones((5, 3), bool)
    live[3:, 2] = False
    state = draw.normal(size=(3, 4))

    def loss():
        states, _ = lm.run_cell(model, model.embed @ model.enter + model.bias, ids, state)
        found = lm.log_probabilities(model, np.stack(states).reshape(-1, 4), goal.ravel())
        return -(found * live.ravel()).sum() / live.sum()

    d, _, count = lm.gradients(model, ids, goal, live, state)
    assert count == live.sum()
    for name in model.NAMES:
        part = getattr(model, name)
        for at in [tuple(draw.integers(0, s) for s in part.shape) for _ in range(6)]:
            held, before = part[at], loss()
            part[at] += 1e-6
            assert d[name][at] == pytest.approx((loss() - before) / 1e-6, abs=1e-4), name
            part[at] = held


def test_probabilities_add_up_and_state_is_carried():
    model = small_model()
    states = np.random.default_rng(5).normal(size=(7, 4)).astype(np.float32)
    total = sum(np.exp(lm.log_probabilities(model, states, np.full(7, w))) for w in range(9))
    assert total == pytest.approx(np.ones(7), rel=1e-5)
    draw = np.random.default_rng(6)
    texts = [draw.integers(0, 9, n).astype(np.int32) for n in (1, 200, 33, 64, 0, 65)]
    got = lm.text_scores(model, texts)
    table = model.embed @ model.enter + model.bias
    for text, score in zip(texts, got):
        state, want = np.zeros((1, 4), np.float32), 0.0
        for before, word in zip([lm.END, *text[:-1]], text):
            (state,), _ = lm.run_cell(model, table, np.array([[before]]), state)
            want += float(lm.log_probabilities(model, state, np.array([word]))[0]) / math.log(10)
        assert score == pytest.approx(want, rel=1e-4, abs=1e-4)


def test_training_learns_a_pattern():
    model = lm.Model(np.ones(9), classes=3, hidden=8)
    texts = [np.array([2, 3, 4, 5, 6, 7, 8] * 20 + [0], np.int32) for _ in range(40)]
    before = lm.text_scores(model, texts).mean()
    trainer = lm.Trainer(model)
    for _ in range(30):
        trainer.texts(texts)
    assert lm.text_scores(model, texts).mean() > 0.4 * before  # both are negative


class Sent:
    def __init__(self, value):
        self.value = value


def small_vocabulary():
    words, counts = np.array([0, 37, 69], np.uint64), np.array([10, 50, 20], np.int64)
    totals = np.bincount(lm.kinds_of(words), counts, lm.KINDS).astype(np.int64)
    return lm.Counts(totals, np.bincount(lm.kinds_of(words), minlength=lm.KINDS), words, counts).vocabulary(lm.CLASSES**2)


def test_rounds_train_on_every_training_text_once(spark):
    rows = [(i, f"text {i} of {i % 7} some words " * (1 + i % 5), None, None) for i in range(200)]
    docs, vocabulary = lm.texts(fixtures.documents(spark, rows)), small_vocabulary()
    context = spark.sparkContext
    sent = context.broadcast(lm.Model(vocabulary.weights)), context.broadcast(vocabulary)
    copies = [r for k in range(lm.ROUNDS) for r in lm.copies_of(docs, *sent, 5, k).collect()]
    assert len(copies) == 5 * lm.ROUNDS
    assert sum(r.seen for r in copies) == sum(len(t.split()) + 1 for i, t, *_ in rows if not lm.held_out(i))


def test_sums_of_copies_do_not_depend_on_how_they_are_added(spark, monkeypatch):
    rows = [(i, f"text {i} of {i % 7} some words " * (1 + i % 5), None, None) for i in range(200)]
    docs, vocabulary = lm.texts(fixtures.documents(spark, rows)), small_vocabulary()
    monkeypatch.setattr(lm, "SHARD_BYTES", 1500)
    flat = []
    for groups, fan in ((1000, 64), (2, 3)):
        monkeypatch.setattr(lm, "GROUPS", groups)
        monkeypatch.setattr(lm, "FAN", fan)
        flat.append(lm.train(docs, vocabulary, lm.text_bytes(docs)).flat())
    assert flat[0] == pytest.approx(flat[1], rel=1e-5, abs=1e-6)


def test_partitions_change_nothing(spark, monkeypatch):
    """The same texts in any number of partitions give the same model, and it learns."""
    monkeypatch.setattr(lm, "SHARD_BYTES", 1 << 18)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = []
    for many in (1, 16, 64):
        got = lm.score_documents(docs.repartition(many)).collect()
        found.append({r.doc_id: (r.base_score, r.score) for r in got})
        held = [r for r in got if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)
    for other in found[1:]:
        assert other.keys() == found[0].keys()
        for i, pair in found[0].items():
            assert other[i] == pytest.approx(pair, rel=1e-6, abs=1e-6)


def check(rows, want):
    for r in rows:
        held, size, known, total, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, size, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9, abs=1e-6)
        assert r.score < 0


def test_whole_table_and_better_than_the_base(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = queries.op3_language_model(spark, sf_dir).collect()
    assert len(got) == len(rows)
    check(got, {i: v for (i, _), v in brute.base_scores(rows).items()})
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_odd_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 10)
    rows = fixtures.odd_rows() + [(14, "some words, again some words", None, None)] * 3
    got = lm.score_documents(fixtures.documents(spark, rows)).collect()
    assert len(got) == len(rows)
    check(got, {i: v for (i, _), v in brute.base_scores([r[:2] for r in rows]).items()})
    assert len({r.score for r in got if r.doc_id == 14}) == 1


def test_words_outside_the_vocabulary_share_their_kind():
    words = np.array([0, 37, 69, 70], np.uint64)
    totals, distincts = np.zeros(lm.KINDS, np.int64), np.zeros(lm.KINDS, np.int64)
    totals[[0, 5, 6]], distincts[[0, 5, 6]] = [10, 80, 12], [1, 4, 3]
    counts = lm.Counts(totals, distincts, words, np.array([10, 50, 20, 12], np.int64))
    vocabulary = counts.vocabulary(1 + lm.KINDS + 1)
    assert vocabulary.words.tolist() == [37] and vocabulary.weights[[0, 1, 6, 7, 33]].tolist() == [11, 1, 31, 13, 51]
    # Kind 5: 30 places and 3 words outside the vocabulary, and one for the unseen.
    assert vocabulary.outside[[0, 5, 6]].tolist() == [1, 34, 16]
    assert vocabulary.lookup(words).tolist() == [lm.END, 33, lm.UNKNOWN + 5, lm.UNKNOWN + 6]


def test_words_do_not_depend_on_what_stands_around():
    texts = [b"a B ab", b"xa\tb\nAB", b"", b"b"]
    tokens, ends = lm.tokens_of(b"".join(texts), np.cumsum([0, *map(len, texts)]))
    a, b, ab, end, xa, b2, ab2, end2, end3, b3, end4 = tokens.tolist()
    assert (b, ab) == (b2, ab2) and b == b3 and len({a, b, ab, xa}) == 4
    assert end == end2 == end3 == end4 == 0 and ends.tolist() == [0, 4, 8, 9, 11]


def test_places_of_words():
    draw = np.random.default_rng(7)
    words = np.unique(draw.integers(0, 2**63, 3000).astype(np.uint64) * np.uint64(2))
    words = np.concatenate([np.array([0, 37, 69], np.uint64), words[words > 69]])  # three share their high bits
    tokens = np.concatenate([draw.permutation(words), words[:9] + np.uint64(1), words[:3], ~np.zeros(1, np.uint64)])
    by_word = {w: i for i, w in enumerate(words.tolist())}
    assert lm._places(words, tokens).tolist() == [by_word.get(t, -1) for t in tokens.tolist()]
    assert lm._places(words[:0], tokens[:5]).tolist() == [-1] * 5 and len(lm._places(words, tokens[:0])) == 0


def test_a_group_hashes_small_pieces_and_looks_up_each_word_once(monkeypatch):
    """Whole blocks and one look-up a token cost a third of the time of a run."""
    vocabulary, hashed, asked = small_vocabulary(), [], []
    tokens_of, lookup = lm.tokens_of, lm.Vocabulary.lookup
    monkeypatch.setattr(lm, "tokens_of", lambda data, where: hashed.append(len(data)) or tokens_of(data, where))
    monkeypatch.setattr(lm.Vocabulary, "lookup", lambda self, tokens: asked.append(tokens) or lookup(self, tokens))
    ids, text = np.arange(200, dtype=np.int64), b"some words of a text, again and again some words " * 60
    rows = [pa.array([0], pa.int32()), *(pa.array([lm._blob(x)], pa.binary()) for x in (ids, np.arange(201) * len(text), np.frombuffer(text * 200, np.uint8)))]
    left = pa.table(rows, names=["part", "ids", "ends", "texts"])
    block = pa.record_batch([pa.array(ids), pa.array([text.decode()] * 200)], names=["doc_id", "text"])
    train = sum(not lm.held_out(i) for i in ids.tolist())
    (words, counts), = [(lm._unpacked(w, np.uint64), lm._unpacked(c, np.int64)) for b in lm._counts(1)([block]) for w, c in zip(*(b.column(k).to_pylist() for k in (1, 2)))]
    assert counts.sum() == train * (len(text.split()) + 1)
    totals, distincts = (np.bincount(lm.kinds_of(words), x, lm.KINDS).astype(np.int64) for x in (counts, None))
    known = lm.Counts(totals, distincts, words[:3], counts[:3])
    rest = pa.table([pa.array([0], pa.int32()), pa.array([0], pa.int32()), pa.array([lm._blob(counts[3:])], pa.binary())], names=["part", "bucket", "counts"])
    got = lm._scored(Sent(lm.Model(vocabulary.weights)), Sent(vocabulary), Sent(known), 1)(left, rest)
    assert got.column("n_known").to_pylist() == [len(text.split()) + 1] * 200
    assert max(hashed) <= lm.SLICE_BYTES and sum(hashed) == 2 * 200 * len(text)
    assert [len(t) for t in asked] == [len(words)]


def test_empty_and_nothing_to_learn_from(spark):
    assert lm.score_documents(fixtures.empty(spark)).count() == 0
    held = next(i for i in range(50) if lm.held_out(i))
    row = lm.score_documents(fixtures.documents(spark, [(held, "a b", None, None)])).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)
