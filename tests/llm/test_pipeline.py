import hashlib
from collections import Counter

from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers
from tests.llm import brute, fixtures
from wardline.llm import language_id, mixing


def keep_by_hand(rows, language):
    """Documents left before the mix; `language`: {doc_id: (lang, score)}."""
    rows = [(i, t) for i, t in rows if language[i][0] != "und" and language[i][1] >= language_id.LEAST_SCORE]
    exact = brute.exact(rows)
    rows = [(i, t) for i, t in rows if exact[i][2]]
    near = {i: c for i, _, c, _ in brute.linked(rows)}
    return [(i, t) for i, t in rows if near[i] == i]


def test_run_equals_the_stages_by_hand(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = {r.doc_id: r for r in docs.collect()}
    language = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs).collect()}
    left = keep_by_hand([(i, r.text) for i, r in held.items()], language)
    mixed = docs.filter(docs.doc_id.isin([i for i, _ in left]))
    times = Counter(r.doc_id for r in mixing.mixed_documents(mixed).collect())
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want = []
    for doc_id, copies in times.items():
        ids = library.encode(held[doc_id].text, add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want += [(doc_id, len(ids), tuple(ids), hashlib.sha256(text.encode()).hexdigest())] * copies
    got = [(r.doc_id, r.n_tokens, tuple(r.ids), r.decoded_sha256) for r in corpus_pipeline.run(spark, sf_dir).collect()]
    assert sorted(got) == sorted(want)


def test_copies_come_near_the_words_taken(spark):
    rows = [(i, "w " * (20 + i % 50), None, f"s{i % 6}") for i in range(900)]
    docs = fixtures.documents(spark, rows)
    goal = brute.mix_targets({f"s{k}": sum(20 + i % 50 for i in range(900) if i % 6 == k) for k in range(6)})
    words, copies = Counter(), Counter()
    for r in mixing.mixed_documents(docs).collect():
        words[r.source] += len(r.text) // 2
        copies[r.doc_id] += 1
    assert max(copies.values()) <= 3
    assert all(abs(words[s] - goal[s]) < 0.3 * goal[s] for s in goal)


def test_stages_keep_columns_and_take_odd_and_no_rows(spark, sf_dir):
    rows = fixtures.odd_rows() + [(i, f"the word and number {i}", "en", "s") for i in range(20, 40)]
    for docs in (fixtures.documents(spark, rows), fixtures.empty(spark)):
        for name, step in corpus_pipeline.STAGES[:-1]:
            out = step(spark, docs, sf_dir)
            assert out.columns == docs.columns, name
            out.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()
