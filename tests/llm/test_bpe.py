import hashlib
import random

import pytest
from tokenizers import Tokenizer

import public_tokenizers
from tests.llm import fixtures
from wardline.llm import bpe, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "Hello wörld 123 it's I'LL 'tis!! \x1f\x85 x", "ΑΣ Σ İstanbul <|endoftext|>foo<|startoftext|><|ENDOFTEXT|>",
    "école ﬁ Ⅷ ½ ٣ 日本語 Çeau😀👩‍👩‍👧 ́ ﻿ ​", "x" * 5000, "ab" * 4000 + "é" * 999, "", " \n\t", "." * 3000, "7" * 300,
    "thethethetheth" * 300, "\x00a\x00", "don't we'd y'all'd've 's's",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as file:
        return bpe.Vocabulary(file.read())


def test_encodes_and_decodes_like_the_library(library, vocabulary):
    words, draw = bpe.Words(vocabulary), random.Random(5)
    pool = "aeinorst '.,-éßñΣ\n12日<|>" + "".join(TEXTS[:3])
    texts = TEXTS + ["".join(draw.choices(pool, k=draw.randrange(200))) for _ in range(300)]
    texts += ["".join(draw.choices("aeinorst", k=3000)), "".join(draw.choices("ab", k=3000))]
    for text in texts:
        ids = bpe.encode(text, words).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, text[:50]
        assert bpe._decoded(bpe.encode(text, words), vocabulary) == library.decode(ids, skip_special_tokens=False)


def test_stable_tokens_never_change(vocabulary):
    draw = random.Random(6)
    for _ in range(300):
        word = bytes(draw.choices(b"aeinorsthld", k=draw.randrange(1, 1200)))
        whole = bpe.merged([*(vocabulary.plain[b] for b in word[:-1]), vocabulary.last[word[-1]]], vocabulary.pairs)
        encoder, out, at = bpe.WordEncoder(vocabulary), [], 0
        while at < len(word):
            n = draw.randrange(1, 90)
            out += encoder.feed(word[at : at + n])
            assert len(encoder.held) <= vocabulary.lookahead + 3 * bpe.STEP
            at += n
        assert out + encoder.finish() == whole


def test_lookahead_of_small_lists():
    assert bpe.sufficient_lookahead([], "") == 1
    assert bpe.sufficient_lookahead([("b", "c"), ("a", "b")], "") == 2
    assert bpe.sufficient_lookahead([("a", "b"), ("b", "c")], "") == 1
    with pytest.raises(ValueError):
        bpe.sufficient_lookahead([("ab", "c"), ("a", "b")], "")


def test_text_comes_back_byte_by_byte(vocabulary):
    words, decoder = bpe.Words(vocabulary), bpe.Decoder(vocabulary)
    ids = bpe.encode("naïve 日本語 😀 ok", words).tolist()
    out = "".join(decoder.text([i]) for i in ids) + decoder.text([], final=True)
    assert out == "naïve 日本語 😀 ok "


def test_query(spark, sf_dir, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op5_bpe(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows(spark, library):
    rows = fixtures.odd_rows() + [(4, "again", None, None), (None, "no key", None, None)]
    docs = fixtures.documents(spark, rows).withColumnRenamed("digest", "ids")
    got = bpe.encode_texts(docs, PATH).collect()
    want = sorted(library.encode(r[1] or "", add_special_tokens=False).ids for r in rows)
    assert sorted(r.ids for r in got) == want
    coded = bpe.code_texts(docs, PATH).collect()
    apart = bpe.decode_ids(bpe.encode_texts(docs, PATH), PATH).collect()
    assert sorted((r.ids, r.decoded) for r in coded) == sorted((r.ids, r.decoded) for r in apart)
    assert bpe.encode_texts(fixtures.empty(spark), PATH).count() == 0


def test_words_seen_lately_keep_their_numbers_and_others_go(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 4)
    monkeypatch.setattr(bpe, "SHORT_WORD", 12)
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as file:
        vocabulary = bpe.Vocabulary(file.read())
    words, encoded = bpe.Words(vocabulary), []
    inner = words._encoded
    words._encoded = lambda some: encoded.extend(some) or inner(some)
    texts = ["alpha beta gamma", "alpha delta epsilon zeta", "alpha eta theta iota kappa", "alpha iota kappa", "x" * 40 + " alpha", ""]
    for text in texts:
        assert bpe.encode(text, words).tolist() == bpe.encode(text, bpe.Words(vocabulary)).tolist()
        assert len(words.slots) <= 8 and all(len(w) <= 12 for w in words.slots)
    assert encoded.count("alpha") == 1 and encoded.count("x" * 40) == 1
    with pytest.raises(KeyError):
        words._encoded = lambda some: {}
        words.ids(["fresh"], [0, 1])
    words._encoded = inner
    assert bpe.encode("fresh alpha", words).tolist() == bpe.encode("fresh alpha", bpe.Words(vocabulary)).tolist()
