"""Language of words and documents by a linear-chain conditional random field."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import crc_mod, documents_of, texts
from wardline.llm.jaccard_join import span_hashes
from wardline.llm.suffix_dedup import _mixed, words_at

# The fit: labelled documents of each language that are looked at, about, and characters of each.
SAMPLE_DOCS = 240
SAMPLE_CHARS = 3000
FOLDS, HELD_FOLD = 4, 2
# Feature table; sizes of the letter groups, in bytes, word edges counting as letters.
BUCKETS = 1 << 16
GRAMS = (2, 3, 4, 5)
# Words of a training sequence, and sequences of a step.
SEQUENCE, BATCH, STEPS, RATE, DECAY = 40, 96, 220, 0.25, 1e-4
# Words of a stretch in sequences that change language.
STRETCH = (5, 20)
# Documents whose best language has a smaller part of the words than this are rejected.
LEAST_SCORE = 0.3
FLOOR = 1e-12
BLOCK_BYTES = 2 << 20
UNKNOWN = "und"
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_LETTER = regex.compile(r"\p{L}")
_EDGE = 0x60
_WORD = np.zeros(256, bool)
_WORD[97:123] = _WORD[65:91] = _WORD[128:] = True


@dataclass
class Field:
    """Languages, feature weights (buckets x languages) and transition weights."""

    names: list[str]
    weights: np.ndarray
    moves: np.ndarray


def split_words(data: bytes, where: np.ndarray):
    """Words of lower-cased texts: runs of letters and of bytes beyond ASCII. (start, end, offsets)."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(where), np.int64)
    dark = _WORD[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[where] = True
    start, end = dark.copy(), dark.copy()
    start[1:] &= ~dark[:-1] | cut[1:-1]
    end[:-1] &= ~dark[1:] | cut[1:-1]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    return start, end, np.searchsorted(start, where, "left")


def word_features(words: list[bytes]):
    """(buckets, offsets): affixes, letter groups and the word itself, hashed.

    Words stand between edge marks, so the groups at an edge are prefixes and suffixes.
    """
    mark = bytes([_EDGE])
    flat = mark + mark.join(words) + mark
    size = np.array([len(w) for w in words], np.int64) + 2
    start = np.cumsum(size - 1) - (size - 1)
    eights = words_at(flat)
    parts, counts = [], np.zeros(len(words), np.int64)
    for n in GRAMS:
        many = np.maximum(size - n + 1, 0)
        at = np.repeat(start, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        part = eights[at] & np.uint64((1 << (8 * n)) - 1)
        parts.append((np.repeat(np.arange(len(words)), many), _mixed(part * _M1 + np.uint64(n))))
        counts += many
    whole = np.array([hash_word(w) for w in words], np.uint64)
    parts.append((np.arange(len(words)), whole))
    owner = np.concatenate([p[0] for p in parts])
    value = np.concatenate([p[1] for p in parts])
    order = np.argsort(owner, kind="stable")
    bucket = ((value[order] >> np.uint64(17)) % np.uint64(BUCKETS)).astype(np.int64)
    return bucket, np.concatenate([[0], np.cumsum(counts + 1)])


def hash_word(word: bytes) -> int:
    """The lexicon feature of a word."""
    h = 0x9E3779B97F4A7C15 ^ len(word)
    for at in range(0, min(len(word), 64), 8):
        h = (h ^ int.from_bytes(word[at : at + 8], "little")) * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF
        h ^= h >> 29
    return h


def emissions(words: list[bytes], weights: np.ndarray) -> np.ndarray:
    """Score of each language for each word: the sum of its features' weights."""
    if not words:
        return np.zeros((0, weights.shape[1]))
    bucket, ends = word_features(words)
    return np.add.reduceat(weights[bucket], ends[:-1], axis=0)


def marginals(scores: np.ndarray, moves: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Forward-backward over many chains at once: probability of each language at each word.

    `scores`: words x languages, chain after chain, `offsets` their ends. Chains are walked in
    step, longest first; messages are kept at sum 1. A word counts at most 1 / FLOOR times as much
    for one language as for another, so that messages of either precision never vanish.
    """
    emit = np.maximum(np.exp(scores - scores.max(axis=1, keepdims=True, initial=-np.inf)), FLOOR)
    move = np.exp(moves - moves.max()).astype(emit.dtype)
    size = np.diff(offsets)
    order = np.argsort(-size, kind="stable")
    first, size = offsets[:-1][order], size[order]
    forward, out = np.empty_like(emit), np.empty_like(emit)
    longest = int(size[0]) if len(size) else 0
    alive = np.searchsorted(-size, -np.arange(longest), "left")
    message = None
    for t in range(longest):
        at = first[: alive[t]] + t
        here = emit[at] if t == 0 else (message[: alive[t]] @ move) * emit[at]
        message = here / here.sum(axis=1, keepdims=True)
        forward[at] = message
    behind = np.ones((0, emit.shape[1]), emit.dtype)
    for t in range(longest - 1, -1, -1):
        at = first[: alive[t]] + t
        if alive[t] > len(behind):
            behind = np.concatenate([behind, np.ones((alive[t] - len(behind), emit.shape[1]), emit.dtype)])
        both = forward[at] * behind
        out[at] = both / both.sum(axis=1, keepdims=True)
        behind = (behind * emit[at]) @ move.T
        behind /= behind.sum(axis=1, keepdims=True)
    return out


def _step(score: np.ndarray, gold: np.ndarray, move: np.ndarray):
    """Gradient of the negative log-likelihood: by word and by transition. (B, T, S), (B, T)."""
    many, length, states = score.shape
    emit, trans = np.exp(score - score.max(axis=2, keepdims=True)), np.exp(move)
    forward, scale = np.empty_like(emit), np.empty((many, length, 1))
    for t in range(length):
        here = emit[:, t] if t == 0 else (forward[:, t - 1] @ trans) * emit[:, t]
        scale[:, t] = here.sum(axis=1, keepdims=True)
        forward[:, t] = here / scale[:, t]
    behind, moved = np.ones((many, states)), np.zeros_like(move)
    by_word = np.empty_like(emit)
    for t in range(length - 1, -1, -1):
        by_word[:, t] = forward[:, t] * behind
        if t:
            weighed = emit[:, t] * behind / scale[:, t]
            moved += trans * (forward[:, t - 1].T @ weighed)
            behind = weighed @ trans.T
    by_word /= by_word.sum(axis=2, keepdims=True)
    by_word[np.arange(many)[:, None], np.arange(length)[None, :], gold] -= 1
    np.add.at(moved, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), -1)
    return by_word, moved


def fit(rows: list[tuple[str, str]], seed: int = 7) -> Field:
    """The field of (text, language) rows, by Adagrad on batches of word sequences.

    Half of the sequences keep to one language, the others change after a stretch of words, so
    that transitions are learned from both. The same rows give the same field.
    """
    names = sorted({lang for _, lang in rows})
    states, draw = len(names), np.random.default_rng(seed)
    field = Field(names, np.zeros((BUCKETS, max(states, 1))), np.zeros((max(states, 1),) * 2))
    by_lang = [[] for _ in names]
    known: dict[bytes, int] = {}
    for text, lang in sorted(rows):
        data = text.lower().encode()
        start, end, _ = split_words(data, np.array([0, len(data)]))
        by_lang[names.index(lang)] += [known.setdefault(data[a:b], len(known)) for a, b in zip(start.tolist(), end.tolist())]
    with_words = [s for s in range(states) if by_lang[s]]
    if states < 2 or len(with_words) < 2:
        return field
    stock = [np.array(words, np.int64) for words in by_lang]
    bucket, ends = word_features(list(known))
    word_sum, move_sum = np.full(field.weights.shape, 1e-2), np.full(field.moves.shape, 1e-2)
    for _ in range(STEPS):
        ids, gold = _sequences(stock, with_words, draw)
        unique, back = np.unique(ids, return_inverse=True)
        many = ends[unique + 1] - ends[unique]
        at = np.repeat(ends[unique], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        used = bucket[at]
        score = np.add.reduceat(field.weights[used], np.cumsum(many) - many, axis=0)
        by_word, moved = _step(score[back.reshape(ids.shape)], gold, field.moves)
        flat = back.ravel()
        grad = np.stack([np.bincount(flat, by_word[:, :, s].ravel(), len(unique)) for s in range(states)], axis=1)
        each = np.repeat(grad, many, axis=0) / BATCH
        touched, place = np.unique(used, return_inverse=True)
        total = np.stack([np.bincount(place, each[:, s], len(touched)) for s in range(states)], axis=1)
        total += DECAY * field.weights[touched]
        word_sum[touched] += total**2
        field.weights[touched] -= RATE * total / np.sqrt(word_sum[touched])
        moved /= BATCH
        move_sum += moved**2
        field.moves -= RATE * moved / np.sqrt(move_sum)
    return field


def _sequences(stock, languages, draw):
    """A batch of word numbers and languages: runs of consecutive words of the sample."""
    ids, gold = np.empty((BATCH, SEQUENCE), np.int64), np.empty((BATCH, SEQUENCE), np.int64)
    for i in range(BATCH):
        at = 0
        while at < SEQUENCE:
            lang = languages[draw.integers(len(languages))]
            size = SEQUENCE if i % 2 else int(draw.integers(*STRETCH))
            size = min(size, SEQUENCE - at)
            begin = draw.integers(len(stock[lang]))
            ids[i, at : at + size] = np.take(stock[lang], range(begin, begin + size), mode="wrap")
            gold[i, at : at + size] = lang
            at += size
    return ids, gold


def sample(docs: DataFrame, per_language: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> list[tuple[str, str]]:
    """About `per_language` labelled training documents of each language, `chars` characters each.

    Documents are picked by a hash of their id, excerpts begin at a place that depends on it too.
    Only documents outside the held-out fold that have a letter are taken; the bound on rows and
    characters makes the collected sample small at any size of the input.
    """
    train = docs.filter(F.col("lang").isNotNull() & (crc_mod(F.col("doc_id"), FOLDS) != HELD_FOLD))
    train = train.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    many = {r.lang: r["count"] for r in train.groupBy("lang").count().collect()}
    if not many:
        return []
    spread = 1 << 30
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(spread))
    # One row per language.
    shares = train.sparkSession.createDataFrame([(k, min(spread, 1 + per_language * spread // n)) for k, n in many.items()], "lang string, _part long")
    picked = train.join(F.broadcast(shares), "lang").filter(hashed < F.col("_part"))
    begin = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(F.length("text") - chars, F.lit(0)) + 1) + 1
    rows = picked.select(F.substr("text", begin.cast("int"), F.lit(chars)).alias("text"), "lang").filter(F.col("text").rlike(r"\p{L}"))
    return [(r.text, r.lang) for r in rows.collect()]


def predictions(ids, data: bytes, where: np.ndarray, model: Field):
    """(languages, scores) of a block of texts."""
    low = [data[a:b].decode().lower() for a, b in zip(where.tolist(), where[1:].tolist())]
    known = np.array([bool(model.names and _LETTER.search(t)) for t in low])
    parts = [t.encode() for t in low]
    share = language_shares(b"".join(parts), np.cumsum([0, *map(len, parts)]), model)
    best = share.argmax(axis=1).tolist()
    names = [model.names[b] if ok else UNKNOWN for b, ok in zip(best, known.tolist())]
    return names, np.where(known, np.clip(share.max(axis=1), 0, 1), 0.0)


def _predict(field):
    def run(batches):
        for block in documents_of(batches, BLOCK_BYTES):
            names, score = predictions(*block, field.value)
            yield pa.record_batch([pa.array(block[0]), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return run


def _keep(field, text: str, least_score: float):
    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text)).fill_null("")
            rows = pa.record_batch([pa.array(np.arange(len(column))), column], names=["row", "text"])
            keep = np.zeros(len(column), bool)
            for block in documents_of([rows], BLOCK_BYTES):
                names, score = predictions(*block, field.value)
                keep[block[0]] = [n != UNKNOWN and s >= least_score for n, s in zip(names, score.tolist())]
            yield batch.filter(pa.array(keep))

    return run


def word_marginals(data: bytes, where: np.ndarray, model: Field):
    """(first byte, end, offsets, probabilities of the languages) of the words of texts in lower case."""
    start, end, offsets = split_words(data, where)
    if not len(start):
        return start, end, offsets, np.zeros((0, model.weights.shape[1]), np.float32)
    # Equal words have equal scores: features are made once for each.
    _, first, back = np.unique(span_hashes(data, start, end), return_index=True, return_inverse=True)
    words = [data[a:b] for a, b in zip(start[first].tolist(), end[first].tolist())]
    score = emissions(words, model.weights).astype(np.float32)[back]
    return start, end, offsets, marginals(score, model.moves.astype(np.float32), offsets)


def language_shares(data: bytes, where: np.ndarray, model: Field) -> np.ndarray:
    """Mean probability of each language over the words of each text (texts in lower case)."""
    _, _, offsets, found = word_marginals(data, where, model)
    out = np.zeros((len(where) - 1, model.weights.shape[1]))
    many = np.diff(offsets)
    some = many > 0
    if some.any():
        out[some] = np.add.reduceat(found, offsets[:-1][some], axis=0, dtype=np.float64) / many[some, None]
    return out


_RUNS = "doc_id long, run int, first_word int, words int, lang string, score double"


def _runs(field):
    def run(batches):
        for ids, data, where in documents_of(batches, BLOCK_BYTES):
            model, rows = field.value, []
            low = [data[a:b].decode().lower() for a, b in zip(where.tolist(), where[1:].tolist())]
            parts = [t.encode() if model.names and _LETTER.search(t) else b"" for t in low]
            _, _, offsets, found = word_marginals(b"".join(parts), np.cumsum([0, *map(len, parts)]), model)
            best = found.argmax(axis=1) if len(found) else np.empty(0, np.int64)
            sure = found.max(axis=1, initial=0)
            for doc_id, a, b in zip(ids.tolist(), offsets.tolist(), offsets[1:].tolist()):
                cuts = [a, *(a + 1 + np.flatnonzero(np.diff(best[a:b]))).tolist(), b] if b > a else []
                for k, (x, y) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((doc_id, k, x - a, y - x, model.names[best[x]], float(sure[x:y].mean(dtype=np.float64))))
            names = [c.split()[0] for c in _RUNS.split(", ")]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.float64())
            columns = zip(*rows) if rows else [[] for _ in names]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def language_runs(docs: DataFrame, model: Field | None = None) -> DataFrame:
    """doc_id, run, first_word, words, lang, score: the runs of words of one language in every whole text.

    Each word gets the language that forward-backward finds most likely for it; words in a row with
    the same one are a run, numbered from 0, and `score` is their mean probability. Texts that
    `identify` calls "und" have no run. Nulls, repeats and empty tables as there.
    """
    model = fit(sample(docs)) if model is None else model
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return texts(docs).mapInArrow(_runs(sent), _RUNS)


def identify(docs: DataFrame, model: Field | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every whole text.

    Words are labelled by forward-backward of the field that `fit` learns from `sample`, which only
    sees text and lang of documents outside the held-out fold (crc32 of the id modulo 4 is 2). The
    language with the greatest mean probability over all words of a document is predicted, `score`
    is that mean; equal means go to the earlier name. Null texts and texts without a letter, and
    all if no language was learned, are "und" with score 0. A null doc_id counts as the smallest
    long. Rows may repeat; an empty table gives an empty result.
    """
    model = fit(sample(docs)) if model is None else model
    # A table of BUCKETS rows per language and the transitions: no more, whatever the input.
    sent = docs.sparkSession.sparkContext.broadcast(model)
    found = texts(docs).mapInArrow(_predict(sent), "doc_id long, lang_pred string, score double")
    return found.select("doc_id", (crc_mod(F.col("doc_id"), FOLDS) == HELD_FOLD).alias("held_out"), "lang_pred", "score")


def drop_unidentified(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of `docs` whose language is known: not "und", and most likely for enough words.

    Each row is judged where it is read; nothing is shuffled. Null and empty texts, and texts without
    a letter, are "und" and go. Other columns may have any name and value. An empty table gives an
    empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(sample(docs)))
    return docs.mapInArrow(_keep(sent, "text", least_score), docs.schema)
