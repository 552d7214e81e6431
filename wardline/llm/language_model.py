"""Texts scored by a gated recurrent language model with a class-factored output."""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import buckets_for, crc_mod, documents_of, stage, text_bytes, texts
from wardline.llm.jaccard_join import _by_bucket, word_hashes
from wardline.llm.suffix_dedup import _TEXTS, _blob, _grouped, _mixed, _texts_of, _unpacked

FOLDS, HELD_FOLD = 7, 2
# Words of the model's vocabulary, with the end and the unknown word: CLASSES * CLASSES entries.
CLASSES = 32
HIDDEN = 16
# Words of a window of truncated backpropagation, words of a text that are scored at a time, and places whose
# outputs are worked out together.
WINDOW, SCORED, PLACES = 16, 32, 4096
# Streams of texts side by side: as many as leave UPDATES windows, within these bounds. The rate is that of
# the fewest and grows with the root of their number.
STREAMS, UPDATES = (16, 256), 200
RATE, CLIP = 0.05, 5.0
# Training rounds; each takes one in ROUNDS of the training texts, chosen by a hash of the text, so
# that together they take every text once.
ROUNDS = 2
# Text behind a training shard, whose texts train one copy of the model.
SHARD_BYTES = 16 << 20
# Words with at least one in FREQUENT of all places are looked up in a table sent to the tasks.
FREQUENT = 65_536
# Text behind a bucket of words, texts that are split into words at a time, and a group of documents.
BUCKET_BYTES = 48 << 20
BLOCK_BYTES, SCORED_BYTES = 4 << 20, 16 << 20
# Text that is hashed at a time, which a processor's cache holds.
SLICE_BYTES = 1 << 17
# Copies that are added up in one task, and sums that may reach the driver.
FAN, GROUPS = 64, 16
END, UNKNOWN = 0, 1
# Kinds of words by their ending; a word outside the vocabulary is known by its kind. Low bits of a
# word's hash hold it.
KINDS, KIND_BITS = 32, 5
_END_HASH = np.uint64(0)
_KIND = np.uint64(KINDS - 1)


def held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_FOLD


def tokens_of(data: bytes, where: np.ndarray):
    """Word hashes of the texts, each text closed by the end, and the texts' offsets.

    Words are told apart by 59 bits of a hash, the low bits are those of the last two bytes'
    kind. No word has the end's.
    """
    h, offsets, start, end = word_hashes(data, where, ends=True)
    raw = np.frombuffer(data.lower(), np.uint8)
    if len(h):
        before = np.where(end - start > 1, raw[np.maximum(end - 2, 0)], 0).astype(np.uint64)
        ending = raw[end - 1].astype(np.uint64) << np.uint64(8) | before
        kind = (_mixed(ending * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)) & _KIND
        h = np.where(h > _KIND, (h & ~_KIND) | kind, np.uint64(KINDS) | kind)
    ends = offsets + np.arange(len(offsets))
    out = np.full(ends[-1], _END_HASH, np.uint64)
    many = np.diff(offsets)
    at = np.arange(len(h)) + np.repeat(np.arange(len(many)), many)
    out[at] = h
    return out, ends


def kinds_of(tokens: np.ndarray) -> np.ndarray:
    return (tokens & _KIND).astype(np.int64)


# Counting


def _counts(buckets: int):
    """Per block and bucket the words of training texts and their counts."""

    def run(batches):
        for ids, data, where in documents_of(batches, BLOCK_BYTES * 2):
            train = [t for i, t in zip(ids.tolist(), _tokens(data, where)) if not held_out(i)]
            word, count = np.unique(np.concatenate([np.empty(0, np.uint64), *train]), return_counts=True)
            for b, at in _by_bucket(word, buckets):
                columns = [pa.array([_blob(x)], pa.binary()) for x in (word[at], count[at].astype(np.int64))]
                yield pa.record_batch([pa.array([b], pa.int32()), *columns], names=["bucket", "words", "counts"])

    return run


def _summed(table: pa.Table) -> pa.Table:
    words = np.concatenate([_unpacked(v, np.uint64) for v in table.column("words").to_pylist()])
    counts = np.concatenate([_unpacked(v, np.int64) for v in table.column("counts").to_pylist()])
    order = np.argsort(words, kind="stable")
    words, counts = words[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
    counts = np.add.reduceat(counts, first)
    return pa.table(
        {
            "bucket": pa.array(table.column("bucket").to_pylist()[:1], pa.int32()),
            "words": pa.array([_blob(words[first])], pa.binary()),
            "counts": pa.array([_blob(counts)], pa.binary()),
            "totals": _by_kind(words[first], counts),
            "distincts": _by_kind(words[first], np.ones(len(first), np.int64)),
        }
    )


def _by_kind(words: np.ndarray, counts: np.ndarray) -> pa.Array:
    sums = np.zeros(KINDS, np.int64)
    np.add.at(sums, kinds_of(words), counts)
    return pa.array([sums.tolist()], pa.list_(pa.int64()))


def _frequent(least: int):
    def run(batches):
        for batch in batches:
            for words, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words, counts = _unpacked(words, np.uint64), _unpacked(counts, np.int64)
                many = counts >= least
                yield pa.record_batch([pa.array(words[many].view(np.int64)), pa.array(counts[many])], names=["word", "count"])

    return run


@dataclass
class Counts:
    """Training tokens and their distinct number by kind (the end among kind 0), and words and
    counts of the frequent ones."""

    totals: np.ndarray
    distincts: np.ndarray
    words: np.ndarray
    counts: np.ndarray

    @property
    def total(self) -> int:
        return int(self.totals.sum())

    def vocabulary(self, size: int) -> "Vocabulary":
        order = np.lexsort((self.words, -self.counts))
        order = order[self.words[order] != _END_HASH][: size - 1 - KINDS]
        words, counts = self.words[order], self.counts[order]
        ends = int(self.counts[self.words == _END_HASH].sum())
        kinds = kinds_of(words)
        rest = self.totals - np.bincount(kinds, counts, KINDS).astype(np.int64)
        unseen = self.distincts - np.bincount(kinds, minlength=KINDS)
        rest[0] -= ends
        unseen[0] -= ends > 0
        weights = np.concatenate([[ends + 1], rest + 1, counts + 1]).astype(np.float64)
        by_word = np.argsort(words)
        return Vocabulary(words[by_word], (1 + KINDS + by_word).astype(np.int32), weights, rest + unseen + 1)


@dataclass
class Vocabulary:
    """Words in ascending order with their numbers, weights by number, and for words outside the
    mass of each kind: a word has one part in `outside` for each of its count + 1."""

    words: np.ndarray
    numbers: np.ndarray
    weights: np.ndarray
    outside: np.ndarray

    def lookup(self, tokens: np.ndarray) -> np.ndarray:
        at = _places(self.words, tokens)
        out = np.append(self.numbers, np.int32(0)).take(at)
        other = np.flatnonzero(at < 0)
        out[other] = UNKNOWN + kinds_of(tokens[other])
        out[tokens == _END_HASH] = END
        return out


def _places(words: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Place of each token in `words` (ascending, distinct), -1 where it is not among them.

    A table of the words' high bits, of which there are more than words, leaves a token one or two
    places to look at.
    """
    high = np.uint64(64 - min(max(len(words).bit_length() + 2, 8), 24))
    first = np.searchsorted(words >> high, np.arange((1 << (64 - int(high))) + 1, dtype=np.uint64)).astype(np.int32)
    slot, out = (tokens >> high).astype(np.int64), np.full(len(tokens), -1, np.int32)
    at, stop, left = first.take(slot), first.take(slot + 1), None
    while True:
        live = np.flatnonzero(at < stop)
        left = live if left is None else left.take(live)
        if not len(left):
            return out
        at, stop, own = at.take(live), stop.take(live), tokens.take(left)
        hit = words.take(at) == own
        out[left[hit]] = at[hit]
        miss = np.flatnonzero(~hit)
        left, at, stop = left.take(miss), at.take(miss) + 1, stop.take(miss)


def outside(numbers: np.ndarray) -> np.ndarray:
    return (numbers >= UNKNOWN) & (numbers < UNKNOWN + KINDS)


def count_words(docs: DataFrame, buckets: int) -> tuple[DataFrame, Counts]:
    """Staged counts by bucket, and what is sent to the tasks.

    A frequent word has at least one in FREQUENT of all places, so there are at most FREQUENT.
    """
    blobs = docs.mapInArrow(_counts(buckets), "bucket int, words binary, counts binary")
    sums = blobs.groupBy("bucket").applyInArrow(
        _summed, "bucket int, words binary, counts binary, totals array<long>, distincts array<long>"
    )
    sums = stage(sums, "lm-words")
    added = sums.agg(*[F.sum(F.col(c)[k]) for c in ("totals", "distincts") for k in range(KINDS)]).first()
    totals, distincts = np.array([x or 0 for x in added], np.int64).reshape(2, KINDS)
    least = max(1, math.ceil(int(totals.sum()) / FREQUENT))
    rows = sums.select("words", "counts").mapInArrow(_frequent(least), "word long, count long").collect()
    words = np.array([r.word for r in rows], np.int64).view(np.uint64)
    counts = np.array([r["count"] for r in rows], np.int64)
    order = np.argsort(words)
    return sums, Counts(totals, distincts, words[order], counts[order])


# The model


class Model:
    """Embedding, gated recurrent cell, and an output of classes and of words within a class.

    The entries of class c are the numbers from c * CLASSES on. Biases start at the logarithms of
    the counts, so that before training the model gives each word its share of all places.
    """

    NAMES = ("embed", "enter", "back", "bias", "to_class", "class_bias", "to_word", "word_bias")
    # The output's biases come from the counts of all training texts and stay.
    FIXED = ("class_bias", "word_bias")

    def __init__(self, weights: np.ndarray | None = None, classes: int = CLASSES, hidden: int = HIDDEN, seed: int = 5):
        if weights is None:
            return
        draw, size = np.random.default_rng(seed), classes * classes
        normal = lambda *shape: (draw.normal(size=shape) / math.sqrt(hidden)).astype(np.float32)
        self.embed, self.enter, self.back = normal(size, hidden), normal(hidden, 3 * hidden), normal(hidden, 3 * hidden)
        self.bias = np.zeros(3 * hidden, np.float32)
        shares = np.full(size, 1e-6)
        shares[: len(weights)] = weights / weights.sum()
        shares = shares.reshape(classes, classes)
        self.class_bias = np.log(shares.sum(axis=1)).astype(np.float32)
        self.word_bias = np.log(shares / shares.sum(axis=1, keepdims=True)).astype(np.float32)
        self.to_class = np.zeros((hidden, classes), np.float32)
        self.to_word = np.zeros((classes, hidden, classes), np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def filled(self, flat: np.ndarray) -> "Model":
        """A model of this one's shapes with other weights."""
        out, at = Model(), 0
        for name in self.NAMES:
            part = getattr(self, name)
            setattr(out, name, flat[at : at + part.size].reshape(part.shape).astype(np.float32))
            at += part.size
        return out

    def copied(self) -> "Model":
        return self.filled(self.flat())


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x = 0.5 * x
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def run_cell(model: Model, table: np.ndarray, ids: np.ndarray, state: np.ndarray, inside: bool = False):
    """States after each row of `ids` (steps x texts), and what the way back needs.

    The end as input begins a text, from a state of zeros. `inside`: no text begins here, and there is
    no way back.
    """
    n = state.shape[1]
    states = np.empty((*ids.shape, n), state.dtype)
    kept = None if inside else np.empty((5, *states.shape), state.dtype)
    for t, row in enumerate(ids):
        if not inside:
            state = np.multiply(state, (row != END)[:, None], out=kept[0, t])
        entered, turned = table.take(row, axis=0), state @ model.back
        gates = _sigmoid((entered + turned)[:, : 2 * n])
        update, reset = gates[:, :n], gates[:, n:]
        new = reset * turned[:, 2 * n :]
        new += entered[:, 2 * n :]
        np.tanh(new, out=new)
        if not inside:
            kept[1, t], kept[2, t], kept[3, t], kept[4, t] = update, reset, new, turned[:, 2 * n :]
        moved = np.subtract(state, new, out=states[t])
        moved *= update
        moved += new
        state = moved
    return states, kept


def _sums(x: np.ndarray) -> np.ndarray:
    """Sums of the columns: eight running sums, then pairs of them, as numpy adds up a row."""
    if len(x) % 8:
        return x.sum(axis=0)
    x = x.reshape(-1, 8, x.shape[1]).sum(axis=0)
    while len(x) > 1:
        x = x[::2] + x[1::2]
    return x[0]


def _softmax(x: np.ndarray) -> np.ndarray:
    """Softmax of each column; `x` is used up."""
    x -= x.max(axis=0)
    x -= np.log(_sums(np.exp(x)))
    return np.exp(x, out=x)


def _log_share(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Logarithm of the softmax of each column at one place; `x` is used up."""
    most = x.max(axis=0)
    own = x[at, np.arange(len(at))] - most
    x -= most
    return own - np.log(_sums(np.exp(x, out=x)))


def log_probabilities(model: Model, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log-probability of each target: its class, then the word within the class.

    States are taken PLACES at a time, which a processor's cache holds.
    """
    classes = len(model.class_bias)
    out = np.empty(len(targets), states.dtype)
    for start in range(0, len(targets), PLACES):
        some, goal = states[start : start + PLACES], targets[start : start + PLACES]
        group, word = goal // classes, goal % classes
        found = _log_share(np.ascontiguousarray((some @ model.to_class + model.class_bias).T), group)
        order = np.argsort(group.astype(np.int16), kind="stable")
        group, entry = group[order], some.take(order, axis=0)
        cuts = np.searchsorted(group, np.arange(classes + 1))
        inside = model.word_bias.take(group, axis=0)
        for c in np.flatnonzero(np.diff(cuts)).tolist():
            at = slice(cuts[c], cuts[c + 1])
            inside[at] += entry[at] @ model.to_word[c]
        found[order] += _log_share(np.ascontiguousarray(inside.T), word[order])
        out[start : start + PLACES] = found
    return out


def gradients(model: Model, ids, targets, live, state):
    """Gradients of the mean loss over a window's live places, and the state to carry on."""
    n, (steps, many) = state.shape[1], ids.shape
    table = model.embed @ model.enter + model.bias
    states, kept = run_cell(model, table, ids, state)
    flat, goal, ok = states.reshape(-1, n), targets.ravel(), live.ravel()
    count = max(1, int(ok.sum()))
    classes = len(model.class_bias)
    group, word = goal // classes, goal % classes
    d = {name: np.zeros_like(getattr(model, name)) for name in Model.NAMES}
    # Shares by entry and place, so that sums over the entries run along the places.
    error = _softmax(np.ascontiguousarray((flat @ model.to_class + model.class_bias).T))
    error[group, np.arange(len(goal))] -= 1
    error *= ok / np.float32(count)
    d["to_class"], d["class_bias"] = flat.T @ error.T, error.sum(axis=1)
    back = error.T @ model.to_class.T
    # Live places in the order of their classes.
    order = np.argsort(np.where(ok, group, classes).astype(np.int16), kind="stable")[: int(ok.sum())]
    cuts = np.searchsorted(group[order], np.arange(classes + 1)).tolist()
    some = [(c, slice(a, b)) for c, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
    entry = flat.take(order, axis=0)
    inside = model.word_bias.take(group[order], axis=0)
    for c, at in some:
        inside[at] += entry[at] @ model.to_word[c]
    inside = _softmax(np.ascontiguousarray(inside.T))
    inside[word[order], np.arange(len(order))] -= 1
    inside /= np.float32(count)
    returned = np.empty_like(entry)
    for c, at in some:
        part = inside[:, at]
        d["to_word"][c], d["word_bias"][c] = entry[at].T @ part.T, part.sum(axis=1)
        returned[at] = part.T @ model.to_word[c].T
    back[order] += returned
    back, later = back.reshape(steps, many, n), np.zeros_like(state)
    before, update, reset, new, turned = kept
    # What the error of a state is multiplied by, for all steps at once; only its way back is a loop.
    to_new, to_update = (1 - update) * (1 - new**2), (before - new) * update * (1 - update)
    to_reset = to_new * turned * reset * (1 - reset)
    to_gates = np.stack([to_update, to_reset, to_new * reset], axis=2)
    carried, transposed = (ids != END)[:, :, None], model.back.T
    for t in range(steps - 1, -1, -1):
        back[t] += later
        total = back[t]
        gates = (total[:, None] * to_gates[t]).reshape(many, 3 * n)
        later = (total * update[t] + gates @ transposed) * carried[t]
    gates = back[:, :, None] * to_gates
    d["back"] = before.reshape(-1, n).T @ gates.reshape(-1, 3 * n)
    gates[:, :, 2] = back * to_new
    order = np.argsort(ids.ravel().astype(np.int16), kind="stable")
    used, first = np.unique(ids.ravel()[order], return_index=True)
    entered = np.add.reduceat(gates.reshape(-1, 3 * n).take(order, axis=0), first, axis=0)
    d["enter"] = model.embed[used].T @ entered
    d["bias"] = entered.sum(axis=0)
    d["embed"][used] = entered @ model.enter.T
    return d, states[-1], count


class Trainer:
    """Adagrad over windows of texts, states carried from window to window."""

    def __init__(self, model: Model):
        self.model, self.seen, self.rate = model, 0, np.float32(RATE)
        self.sums = {name: np.full_like(getattr(model, name), 1e-3) for name in Model.NAMES}

    def texts(self, tokens: list[np.ndarray]) -> None:
        """Trains on texts as word numbers, the end last, laid end to end in streams."""
        flat = np.concatenate(tokens)
        many = int(np.clip(len(flat) // (WINDOW * UPDATES), *STREAMS))
        self.rate = np.float32(RATE * math.sqrt(many / STREAMS[0]))
        size = -(-len(flat) // many)
        goal = np.full(many * size, END, np.int32)
        goal[: len(flat)] = flat
        live = (np.arange(many * size) < len(flat)).reshape(many, size).T
        goal = goal.reshape(many, size).T
        ids = np.concatenate([np.full((1, many), END, np.int32), goal[:-1]])
        state = np.zeros((many, self.model.back.shape[0]), np.float32)
        for at in range(0, size, WINDOW):
            window = slice(at, at + WINDOW)
            d, state, count = gradients(self.model, ids[window], goal[window], live[window], state)
            self._apply(d)
            self.seen += count

    def _apply(self, d: dict) -> None:
        norm = math.sqrt(sum(float((g**2).sum()) for name, g in d.items() if name not in Model.FIXED))
        shrink = min(1.0, CLIP / (norm + 1e-9))
        for name, g in d.items():
            if name in Model.FIXED:
                continue
            g = g * np.float32(shrink)
            self.sums[name] += g**2
            getattr(self.model, name)[...] -= self.rate * g / np.sqrt(self.sums[name])


_COPY = "number long, weights binary, seen long"


def _copy_row(number: int, weights: np.ndarray, seen: int) -> pa.Table:
    columns = [pa.array([number], pa.int64()), pa.array([_blob(weights)], pa.binary()), pa.array([seen], pa.int64())]
    return pa.table(columns, names=[c.split()[0] for c in _COPY.split(", ")])


def _replica(model, vocabulary):
    """Trains a copy of the model on a shard's texts, in the order of their ids and contents."""

    def run(table: pa.Table) -> pa.Table:
        trainer, words = Trainer(model.value.copied()), vocabulary.value
        ids, data, where = _texts_of(table)
        bounds = list(zip(where.tolist(), where[1:].tolist()))
        order = sorted(range(len(ids)), key=lambda i: (ids[i], data[bounds[i][0] : bounds[i][1]]))
        tokens = _tokens(data, where)
        trainer.texts([words.lookup(np.concatenate([tokens[i] for i in order]))])
        flat = trainer.model.flat().astype(np.float64) * trainer.seen
        return _copy_row(table.column("part")[0].as_py(), flat, trainer.seen)

    return run


def _added(many: int):
    """The sum of some copies, always in the same order."""

    def run(table: pa.Table) -> pa.Table:
        numbers = table.column("number").to_pylist()
        order = np.argsort(numbers, kind="stable").tolist()
        weights, seen = table.column("weights").to_pylist(), table.column("seen").to_pylist()
        total = _unpacked(weights[order[0]], np.float64).copy()
        for i in order[1:]:
            total += _unpacked(weights[i], np.float64)
        return _copy_row(numbers[0] % many, total, sum(seen))

    return run


def copies_of(docs: DataFrame, model, vocabulary, shards: int, number: int, rounds: int = ROUNDS) -> DataFrame:
    """The copies that the shards' training texts of one round train: number, weights, seen.

    A text's shard follows from its id and content, its round from its content alone.
    """
    own = docs.filter((crc_mod(F.col("doc_id"), FOLDS) != HELD_FOLD) & (F.crc32(F.col("text").cast("binary")) % rounds == number))
    own = own.select(F.xxhash64("doc_id", "text").alias("doc_id"), "text")
    dealt = own.mapInArrow(_grouped(shards, BLOCK_BYTES), _TEXTS).groupBy("part")
    return dealt.applyInArrow(_replica(model, vocabulary), _COPY)


def train(docs: DataFrame, vocabulary: Vocabulary, size: int, rounds: int = ROUNDS) -> Model:
    """The model trained on every training text once, one in `rounds` of them per round.

    There are as many shards as `size` bytes of text ask for, and who is in which follows from the
    texts: so the same texts train the same copies however they are partitioned. In a round each
    shard's texts train a copy by truncated backpropagation; the copies are added up, weighted by
    their words, FAN at a time until the driver gets GROUPS of fixed size at most, and averaged.
    """
    context = docs.sparkSession.sparkContext
    model, sent = Model(vocabulary.weights), context.broadcast(vocabulary)
    shards = buckets_for(size, SHARD_BYTES, least=1)
    for number in range(rounds):
        copies, many = copies_of(docs, context.broadcast(model), sent, shards, number, rounds), shards
        while many > GROUPS:
            many = math.ceil(many / FAN)
            copies = copies.groupBy(F.pmod("number", F.lit(many))).applyInArrow(_added(many), _COPY)
        rows = sorted(copies.collect(), key=lambda r: r.number)
        if rows:
            total = sum(_unpacked(bytes(r.weights), np.float64) for r in rows)
            model = model.filled(total / sum(r.seen for r in rows))
    return model


def text_scores(model: Model, numbers: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each text (word numbers, the end last), state carried to its end."""
    table = model.embed @ model.enter + model.bias
    out = np.zeros(len(numbers))
    many = np.array([len(t) for t in numbers], np.int64)
    order = np.argsort(-many, kind="stable")
    ordered = many[order]
    flat = np.concatenate(numbers) if len(numbers) else np.empty(0, np.int32)
    first = (np.cumsum(many) - many)[order]
    # The input of a place is the place before, of the first one the end.
    state = np.zeros((len(order), model.back.shape[0]), np.float32)
    for start in range(0, int(ordered[0]) if len(ordered) else 0, SCORED):
        rows = int(np.searchsorted(-ordered, -start, "left"))
        state = state[:rows]
        size = min(SCORED, int(ordered[0]) - start)
        step = start + np.arange(size)
        live = step[:, None] < ordered[:rows]
        at = np.where(live, first[:rows] + step[:, None], 0)
        goal = flat.take(at)
        ids = np.where(step[:, None] > 0, flat.take(np.maximum(at - 1, 0)), END)
        states, _ = run_cell(model, table, ids, state, inside=not (live & (ids == END)).any())
        state = states[-1]
        place = np.flatnonzero(live)
        row = place % rows
        found = log_probabilities(model, states.reshape(-1, states.shape[2]).take(place, axis=0), goal.ravel().take(place))
        out[order[:rows]] += np.bincount(row, found, minlength=rows)
    return out / math.log(10)


# Scoring


def _slices(where: np.ndarray):
    start = 0
    while start < len(where) - 1:
        stop = int(np.searchsorted(where, where[start] + SLICE_BYTES, "right")) - 1
        stop = min(max(stop, start + 1), len(where) - 1)
        yield slice(start, stop)
        start = stop


def _tokens(data: bytes, where: np.ndarray) -> list[np.ndarray]:
    out = []
    for at in _slices(where):
        tokens, ends = tokens_of(data[where[at.start] : where[at.stop]], where[at.start : at.stop + 1] - where[at.start])
        out += [tokens[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]
    return out


def _distinct(tokens: np.ndarray) -> np.ndarray:
    """Ascending; plain sorting is far quicker here than numpy's hashing of values."""
    words = np.sort(tokens)
    return words[np.flatnonzero(np.concatenate([words[:1] == words[:1], words[1:] != words[:-1]]))]


def _rare(words: np.ndarray, known: Counts) -> np.ndarray:
    """Of distinct ascending words those that are not among the frequent ones."""
    if not len(known.words):
        return words
    at = np.minimum(np.searchsorted(known.words, words), len(known.words) - 1)
    return words[known.words[at] != words]


def _asked(counts, buckets: int):
    """The rare words of a group of documents, each once, by bucket."""

    def run(table: pa.Table) -> pa.Table:
        _, data, where = _texts_of(table)
        words = _rare(_distinct(np.concatenate(_tokens(data, where))), counts.value)
        dealt = [(b, _blob(words[at])) for b, at in _by_bucket(words, buckets)]
        part = table.column("part")[0].as_py()
        columns = [pa.array([b for b, _ in dealt], pa.int32()), pa.array([part] * len(dealt), pa.int32())]
        return pa.table([*columns, pa.array([w for _, w in dealt], pa.binary())], names=["bucket", "part", "words"])

    return run


def _answered(left: pa.Table, right: pa.Table) -> pa.Table:
    """Counts of the words that each group asked a bucket for, in the order asked."""
    words, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    if right.num_rows:
        words = _unpacked(right.column("words")[0].as_py(), np.uint64)
        counts = _unpacked(right.column("counts")[0].as_py(), np.int64)
    answers = []
    for value in left.column("words").to_pylist():
        asked = _unpacked(value, np.uint64)
        count = np.zeros(len(asked), np.int64)
        if len(words):
            at = np.minimum(np.searchsorted(words, asked), len(words) - 1)
            count = np.where(words[at] == asked, counts[at], 0)
        answers.append(_blob(count))
    return pa.table([left.column("part"), left.column("bucket"), pa.array(answers, pa.binary())], names=["part", "bucket", "counts"])


_SCORES = "doc_id long, n_tokens long, n_known long, base double, score double"


def _scored(model, vocabulary, counts, buckets: int):
    """Base sums and model scores of a group's documents."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        words, known = vocabulary.value, counts.value
        ids, data, where = _texts_of(left)
        texts_ = _tokens(data, where)
        size = np.array([len(t) for t in texts_], np.int64)
        tokens = np.concatenate(texts_)
        distinct = _distinct(tokens)
        rare = _rare(distinct, known)
        given = dict(zip(right.column("bucket").to_pylist(), right.column("counts").to_pylist()))
        found = np.zeros(len(rare), np.int64)
        for b, at in _by_bucket(rare, buckets):
            found[at] = _unpacked(given[b], np.int64)
        every, count = np.concatenate([known.words, rare]), np.concatenate([known.counts, found])
        # What is known of a word is worked out once for each distinct one.
        order = np.argsort(every)
        count = count[order][np.searchsorted(every[order], distinct)]
        number, value = words.lookup(distinct), np.log10(count + 1.0)
        part = (value - np.log10(words.outside)[kinds_of(distinct)]) * outside(number)
        at, text = _places(distinct, tokens), np.repeat(np.arange(len(ids)), size)
        count, value = count.take(at), value.take(at)
        score = text_scores(model.value, np.split(number.take(at), np.cumsum(size)[:-1]))
        score += np.bincount(text, part.take(at), len(ids))
        columns = [ids, size, np.bincount(text, count > 0, len(ids)).astype(np.int64), np.bincount(text, value, len(ids)), score]
        return pa.table([pa.array(c) for c in columns], names=[c.split()[0] for c in _SCORES.split(", ")])

    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every whole text.

    Words are counted over all training documents (crc32 of the id modulo 7 is not 2). The base
    adds up log10((c + 1) / (N + V + 1)). The model reads each whole text with its state carried
    across windows: it gives the probability of each vocabulary word, of the end and of an unknown
    word by its kind; an unknown word's part is its count + 1 among its kind's words outside the
    vocabulary. Counts of frequent words are sent to the tasks. Texts are scored by groups of
    documents: a group asks the buckets of words for its rare words once each, not once a document.

    Null and empty texts consist of the end. Rows may repeat and share a doc_id; a null doc_id
    counts as the smallest long. With no training document N is 0 and nothing is known. An empty
    table gives an empty result.
    """
    docs = texts(docs)
    size = text_bytes(docs)
    buckets, parts = buckets_for(size, BUCKET_BYTES, least=4), buckets_for(size, SCORED_BYTES)
    sums, counts = count_words(docs, buckets)
    vocabulary = counts.vocabulary(CLASSES * CLASSES)
    model = train(docs, vocabulary, size)
    context = docs.sparkSession.sparkContext
    sent = [context.broadcast(x) for x in (model, vocabulary, counts)]
    groups = [docs.mapInArrow(_grouped(parts, BLOCK_BYTES), _TEXTS).groupBy("part") for _ in range(2)]
    asked = groups[0].applyInArrow(_asked(sent[2], buckets), "bucket int, part int, words binary")
    held = sums.select("bucket", "words", "counts").groupBy("bucket")
    answers = asked.groupBy("bucket").cogroup(held).applyInArrow(_answered, "part int, bucket int, counts binary")
    whole = groups[1].cogroup(answers.groupBy("part")).applyInArrow(_scored(*sent, buckets), _SCORES)
    norm = math.log10(counts.total + int(counts.distincts.sum()) + 1)
    return whole.select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_FOLD).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(counts.total).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * norm).alias("base_score"),
        "score",
    )
