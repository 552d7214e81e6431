import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm import fixtures
from wardline.llm import fingerprints as fp
from wardline.llm import queries

MASK = 2**64 - 1


def brute_fingerprint(data):
    """Sums over paragraphs, window by window, in plain integers."""
    whole, parts = [0] * fp.WHOLE, [0] * fp.PARTS
    for paragraph in data.split(b"\n"):
        digest = hashlib.blake2b(paragraph).digest()
        for i in range(fp.WHOLE):
            whole[i] = (whole[i] + int.from_bytes(digest[8 * i : 8 * i + 8], "little")) & MASK
        wide = 16 if len(paragraph) >= 24 else max(1, min(4, len(paragraph)))
        for i in range(len(paragraph) - wide + 1):
            window = paragraph[i : i + wide]
            first = int.from_bytes(window[:8], "little")
            second = int.from_bytes(window[8:], "little") if wide == 16 else wide
            first, second = first * int(fp.MIX[0]) & MASK, second * int(fp.MIX[1]) & MASK
            h = first ^ (second >> 31) ^ (second << 7 & MASK)
            h ^= h >> 29
            h = h * int(fp.MIX[2]) & MASK
            h ^= h >> 32
            h = h * int(fp.MIX[0]) & MASK
            parts[h >> 57] += 1 if h >> 40 & 1 else -1
    return fp.encode(np.array([whole], np.uint64), np.array([parts]).astype(np.uint32))[0]


def brute_edits(rows):
    """Sorted (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint) of rows in order (doc_id, text)."""
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        m = len(text) // 4
        edited = (text[: len(text) - m] + after[:m]).encode()
        sha = hashlib.sha256(edited).hexdigest()
        out.append((doc_id, len(text), sha, brute_fingerprint(text.encode()), brute_fingerprint(edited)))
    return sorted(out)


def result(df):
    return sorted((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in df.collect())


@pytest.fixture
def texts():
    draw = random.Random(1)
    made = ["".join(draw.choice("abc \né") for _ in range(draw.randint(0, 300))) for _ in range(60)]
    return ["", "\n", "a", "ab\n\ncd", "é" * 30, "x" * 100, "one paragraph of some length\nshort\n", *made]


@pytest.mark.parametrize("chunk", [1 << 19, 64, 7])
def test_window_sums(texts, chunk, monkeypatch):
    monkeypatch.setattr(fp, "CHUNK", chunk)
    data, where = fp._joined([t.encode()] for t in texts)
    assert fp.encode(*fp.fingerprints_of(data, where)) == [brute_fingerprint(t.encode()) for t in texts]


def test_order_insertion_and_deletion(texts):
    text = "\n".join(texts)
    paragraphs = text.split("\n")
    random.Random(2).shuffle(paragraphs)
    whole = fp.fingerprint(text)
    assert fp.fingerprint("\n".join(paragraphs)) == whole
    grown = fp.insert(whole, "one more\nand another")
    assert grown == fp.fingerprint(text + "\none more\nand another") != whole
    assert fp.delete(fp.delete(grown, "and another"), "one more") == whole


def test_likeness():
    made = fp.decode([fp.fingerprint("the same text of many words " * 3), fp.fingerprint("quite another one, not alike in any window")])
    one, two = ((m[:1], m[1:]) for m in made)
    assert fp.likeness((one[0], two[0]), (one[0], two[0])) == 1
    assert fp.likeness((one[0], two[0]), (one[1], two[1])) < 0.3


@pytest.mark.parametrize("range_bytes", [1 << 25, 20_000, 300])
def test_odd_rows_over_several_ranges(spark, range_bytes):
    rows = [(i, None if t is None else t[:3000]) for i, t, *_ in fixtures.odd_rows()]
    rows += [(100 + i, f"text {i}\nof a few lines\n" * (i % 5)) for i in range(40)] + [(-5, "negative")]
    docs = fixtures.documents(spark, [(i, t, None, None) for i, t in rows]).repartition(7)
    assert result(fp.edited_fingerprints(docs, range_bytes)) == brute_edits(sorted(rows))


def test_long_texts(spark):
    rows = [(i, t) for i, t, *_ in fixtures.odd_rows()]
    docs = fixtures.documents(spark, fixtures.odd_rows())
    want = [(i, len(t or "")) for i, t in rows]
    assert [(r.doc_id, r.n_chars) for r in fp.edited_fingerprints(docs).orderBy("doc_id").collect()] == want


def test_rows_that_share_an_id(spark):
    rows = [(1, "same")] * 30 + [(1, "other")] * 2 + [(None, "none")] * 3 + [(2, "the last of all rows")]
    got = fp.edited_fingerprints(fixtures.documents(spark, [(i, t, None, None) for i, t in rows]).repartition(4), 10).collect()
    assert Counter(r.doc_id for r in got) == {1: 32, -(2**63): 3, 2: 1}
    same = [r for r in got if r.fingerprint == fp.fingerprint("same")]
    assert len(same) == 30 and sum(r.near_next == 1 for r in same) == 29


def test_one_and_none(spark):
    assert fp.edited_fingerprints(fixtures.empty(spark)).count() == 0
    assert fp.fingerprint_texts(fixtures.empty(spark)).count() == 0
    one = fp.edited_fingerprints(fixtures.documents(spark, [(7, "abcdefgh", None, None)])).first()
    assert (one.edited_sha256, one.near_next) == (hashlib.sha256(b"abcdefab").hexdigest(), 1.0)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    frame = queries.op11_fingerprints(spark, sf_dir)
    got = frame.collect()
    small = [r for r in brute_edits(rows) if r[1] < 4000]
    assert set(small) <= set(result(frame))
    assert len(got) == len(rows)
    texts = dict(rows)
    ids = [i for i, _ in rows]
    after = dict(zip(ids, ids[1:] + ids[:1]))
    long = [r for r in got if r.n_chars >= 400]
    # Copies may stand beside each other.
    apart = [r for r in long if texts[r.doc_id][:50] not in (texts[after[r.doc_id]] or "")]
    assert sum(r.near_edited > 0.5 > r.near_next for r in apart) > 0.95 * len(apart)
    plain = {r.doc_id: r.fingerprint for r in fp.fingerprint_texts(docs).collect()}
    assert plain == {r.doc_id: r.fingerprint for r in got}
