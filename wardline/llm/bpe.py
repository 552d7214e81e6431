"""Streaming byte-pair encoding with bounded lookahead, and incremental decoding."""

from __future__ import annotations

import heapq
import json
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from wardline.llm.common import documents_of, longs, texts

# Fixed values of the file format: white space, and the words that the word pattern tells apart.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WORDS = regex.compile(rf"\p{{L}}+|\p{{N}}|'(?:s|t|re|ve|m|ll|d)|[^{_SPACE}\p{{L}}\p{{N}}]+")
# Words whose ids are remembered; the words seen longest ago go when there are twice as many.
# So do words that stand behind so many ids, those of long words, which are not remembered, included.
REMEMBERED, MOST_IDS = 1 << 17, 1 << 22
# Words up to this many bytes are merged many at a time, and so many at once.
SHORT_WORD, TOGETHER = 64, 8192
# Characters of a piece of a text, and of the pieces that are encoded together.
PIECE, LOOKED_AT = 1 << 16, 1 << 20
# Symbols that a stream takes in beyond the lookahead before it looks for stable tokens.
STEP = 128
# Windows up to this length are merged by scanning, longer ones with a heap.
SCANNED = 24


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in vocabulary files."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Vocabulary:
    """Symbols, merges and special tokens of a tokenizer file (word-end BPE over bytes)."""

    def __init__(self, source: bytes):
        file = json.loads(source)
        model, self.end = file["model"], file["model"]["end_of_word_suffix"] or ""
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.tokens = {i: t for t, i in chain(ids.items(), self.special.items())}
        letters = byte_letters()
        self.plain = [ids[c] for c in letters]
        self.last = [ids[c + self.end] for c in letters]
        self.pairs = {}
        pieces = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        for rank, (left, right) in enumerate(pieces):
            self.pairs[ids[left] << 32 | ids[right]] = (rank, ids[left + right])
        self.lookahead = sufficient_lookahead([(u, v) for u, v in pieces], self.end)
        self.length = {i: self._symbols(t) for i, t in self.tokens.items()}
        held = "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
        self.split = regex.compile(f"({held})") if held else None

    def _symbols(self, token: str) -> int:
        return len(token.removesuffix(self.end)) if self.end else len(token)


def sufficient_lookahead(merges: list[tuple[str, str]], end: str) -> int:
    """Symbols after which a token can no longer change, whatever follows.

    Merges apply in the order of the list. Say two texts agree up to a place. What differs after
    it can only reach back when a merge (u, v) joins the u that ends at that place with a v behind
    it: then they agree up to the start of u only. From there the next merge to reach back comes
    later in the list and its v starts with u, as that is what stands there now. So the reach is
    the largest sum of the lengths of u along such a chain of merges. The list must be proper:
    a token's parts are made by earlier merges.
    """

    def symbols(token: str) -> tuple[str, ...]:
        plain = token.removesuffix(end) if end else token
        marked = plain != token
        return (*plain[:-1], plain[-1] + end) if marked else tuple(plain)

    made, reach, most = {}, {}, 1
    for rank, (left, right) in enumerate(merges):
        for part in (left, right):
            if len(symbols(part)) > 1 and made.get(part, rank) >= rank:
                raise ValueError(f"the merge list is not proper at {left} {right}")
        made.setdefault(left + right, rank)
        u, v = symbols(left), symbols(right)
        before = max((reach.get(v[:n], 0) for n in range(1, len(v) + 1)), default=0)
        reach[u] = max(reach.get(u, 0), len(u) + before)
        most = max(most, reach[u])
    return most


def merged(ids: list[int], pairs: dict) -> list[int]:
    """Ids after all merges, the earliest of the list first and from the left."""
    if len(ids) > SCANNED:
        return _merged_long(ids, pairs)
    get = pairs.get
    while len(ids) > 1:
        best, at, made = None, 0, 0
        for i in range(len(ids) - 1):
            found = get(ids[i] << 32 | ids[i + 1])
            if found is not None and (best is None or found[0] < best):
                best, made = found
                at = i
        if best is None:
            break
        ids[at : at + 2] = [made]
    return ids


def _merged_long(ids: list[int], pairs: dict) -> list[int]:
    n, get = len(ids), pairs.get
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [
        (found[0], i, ids[i], ids[i + 1]) for i in range(n - 1) if (found := get(ids[i] << 32 | ids[i + 1]))
    ]
    heapq.heapify(heap)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if ids[i] != left or j >= n or ids[j] != right:
            continue
        ids[i], ids[j] = pairs[left << 32 | right][1], -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for a in (before[i], i):
            if a >= 0 and after[a] < n and (found := get(ids[a] << 32 | ids[after[a]])):
                heapq.heappush(heap, (found[0], a, ids[a], ids[after[a]]))
    return [i for i in ids if i >= 0]


class WordEncoder:
    """Encodes one word from pieces of its bytes; holds the lookahead and STEP symbols at most."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.held = vocabulary, b""

    def feed(self, piece: bytes) -> list[int]:
        """Tokens that are stable now."""
        out, v = [], self.vocabulary
        self.held += piece
        room = v.lookahead + STEP
        while len(self.held) > room:
            window, done = self.held[:room], 0
            for token in merged([v.plain[b] for b in window], v.pairs):
                if done + v.length[token] > room - v.lookahead:
                    break
                out.append(token)
                done += v.length[token]
            if not done:
                # A token longer than the step: take in more before it can be stable.
                room += STEP
                continue
            self.held = self.held[done:]
            room = v.lookahead + STEP
        return out

    def finish(self) -> list[int]:
        """The rest, whose last symbol carries the end of the word."""
        held, self.held = self.held, b""
        if not held:
            return []
        v = self.vocabulary
        return merged([*(v.plain[b] for b in held[:-1]), v.last[held[-1]]], v.pairs)


class PairTable:
    """The merge list as an open-addressing table, to look up many pairs at once."""

    NONE = np.int32(2**31 - 1)
    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, pairs: dict):
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.key = np.full(1 << bits, -1, np.int64)
        self.rank = np.full(1 << bits, self.NONE, np.int32)
        self.made = np.full(1 << bits, -1, np.int32)
        for key, at in zip(pairs, self._home(np.fromiter(pairs, np.int64, len(pairs))).tolist()):
            while self.key[at] >= 0:
                at = (at + 1) & self.mask
            self.key[at] = key
            self.rank[at], self.made[at] = pairs[key]

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * self.FACTOR) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of each pair; NONE where there is no merge. Negative symbols are padding."""
        keys = np.where((left < 0) | (right < 0), np.int64(-2), left.astype(np.int64) << 32 | right)
        at = self._home(keys)
        todo = np.flatnonzero((self.key[at] != keys) & (self.key[at] >= 0) & (keys >= 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & self.mask
            held = self.key[at[todo]]
            todo = todo[(held != keys[todo]) & (held >= 0)]
        hit = self.key[at] == keys
        return np.where(hit, self.rank[at], self.NONE), np.where(hit, self.made[at], -1)


def merged_together(words: list[list[int]], table: PairTable) -> list[tuple[int, ...]]:
    """`merged` of many words: each round applies the earliest merge, from the left, in all of them."""
    size = max(map(len, words)) + 1
    symbols = np.full((len(words), size), -1, np.int32)
    for row, word in zip(symbols, words):
        row[: len(word)] = word
    rank, made = (x.reshape(len(words), -1) for x in table.find(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()))
    out = symbols.copy()
    who, columns = np.arange(len(words)), np.arange(size - 1)
    while len(who):
        at = rank.argmin(axis=1)
        rows = np.arange(len(who))
        going = rank[rows, at] != table.NONE
        if not going.all():
            out[who[~going]] = symbols[~going]
            who, symbols, rank, made, at = who[going], symbols[going], rank[going], made[going], at[going]
            rows = np.arange(len(who))
            if not len(who):
                break
        symbols[rows, at] = made[rows, at]
        later = columns > at[:, None]
        symbols[:, :-1] = np.where(later, symbols[:, 1:], symbols[:, :-1])
        symbols[:, -1] = -1
        for x, pad in ((rank, table.NONE), (made, -1)):
            x[:, :-1] = np.where(later[:, :-1], x[:, 1:], x[:, :-1])
            x[:, -1] = pad
        for place in (at, at - 1):
            own = rows[place >= 0]
            there = place[own]
            rank[own, there], made[own, there] = table.find(symbols[own, there], symbols[own, there + 1])
    many = (out >= 0).sum(axis=1).tolist()
    return [tuple(row[:n]) for row, n in zip(out.tolist(), many)]


class Slots(dict):
    """Number of each word; a word that is asked for the first time gets the next one."""

    def __init__(self):
        super().__init__()
        self.new: list = []
        self.count = 0

    def __missing__(self, word) -> int:
        self[word] = slot = self.count
        self.count += 1
        self.new.append(word)
        return slot


class Words:
    """Ids of words; those seen lately are remembered, at least REMEMBERED of them.

    Words are numbered, and the ids of all stand one after the other in one array: a word of a text
    costs one look-up, whether it is new or not.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.table = vocabulary, PairTable(vocabulary.pairs)
        self._clear()

    def _clear(self) -> None:
        self.slots, self.round = Slots(), 0
        self.size = self.first = self.seen = np.empty(0, np.int64)
        self.flat = np.empty(0, np.int32)

    def _long(self, data: bytes) -> tuple[int, ...]:
        """A long word through the transducer, a step at a time."""
        encoder, out = WordEncoder(self.vocabulary), []
        for at in range(0, len(data), STEP):
            out += encoder.feed(data[at : at + STEP])
        return tuple(out + encoder.finish())

    def _encoded(self, words: list) -> dict:
        found, short, v = {}, [], self.vocabulary
        for word in words:
            data = word.encode() if isinstance(word, str) else b""
            if not data:
                found[word] = (v.special[word[0]],)
            elif len(data) > SHORT_WORD:
                found[word] = self._long(data)
            else:
                short.append((len(data), word, data))
        short.sort(key=lambda w: w[0])
        for at in range(0, len(short), TOGETHER):
            some = short[at : at + TOGETHER]
            symbols = [[*map(v.plain.__getitem__, data[:-1]), v.last[data[-1]]] for _, _, data in some]
            found.update(zip((word for _, word, _ in some), merged_together(symbols, self.table)))
        return found

    def _add(self, words: list) -> None:
        """Ids of words that have just got their numbers, behind those of the others."""
        found = self._encoded(words)
        lists = [found[word] for word in words]
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(chain.from_iterable(lists), np.int32, int(size.sum()))
        self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.seen = np.concatenate([self.seen, np.full(len(size), self.round)])
        self.flat = np.concatenate([self.flat, flat])

    def _gathered(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words with these numbers, one after the other, and where each word's end."""
        many = self.size[which]
        ends = np.cumsum(many)
        return self.flat[np.arange(many.sum()) + np.repeat(self.first[which] - (ends - many), many)], ends

    def _forget(self) -> None:
        """Keeps the REMEMBERED words seen last, numbered anew."""
        words, numbers = list(self.slots), np.fromiter(self.slots.values(), np.int64, len(self.slots))
        last = np.argsort(-self.seen[numbers], kind="stable")[:REMEMBERED]
        kept = numbers[last]
        flat, ends = self._gathered(kept)
        self.slots = Slots()
        for i in last.tolist():
            self.slots[words[i]]
        self.slots.new = []
        self.size, self.seen = self.size[kept], self.seen[kept]
        self.first, self.flat = ends - self.size, flat

    def ids(self, words: list, cuts: list[int]) -> list[np.ndarray]:
        """Ids of the words between each two cuts; each word is looked up once."""
        try:
            which = np.fromiter(map(self.slots.__getitem__, words), np.int64, len(words))
            new, self.slots.new = self.slots.new, []
            self.round += 1
            if new:
                self._add(new)
        except BaseException:
            # Workers live on: no word may keep a number without ids.
            self._clear()
            raise
        self.seen[which] = self.round
        ids, ends = self._gathered(which)
        for word in new:
            if len(word) > SHORT_WORD:
                del self.slots[word]
        if self.slots.count > 2 * REMEMBERED or len(self.flat) > MOST_IDS:
            self._forget()
        bounds = np.concatenate([[0], ends])[cuts]
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]


def lowered(text: str) -> str:
    """NFC, then each character in lower case by itself."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def pieces(text: str, limit: int = PIECE):
    """A text in pieces of about `limit` characters that end before a space or line feed.

    No word, special token or composed character lies across such a place, so pieces may be encoded
    apart. A word without end is cut by none; the transducer takes it in steps.
    """
    start = 0
    while len(text) - start > limit:
        cut = max(text.rfind(" ", start + 1, start + limit), text.rfind("\n", start + 1, start + limit))
        if cut < 0:
            ends = [at for c in " \n" if (at := text.find(c, start + limit)) >= 0]
            if not ends:
                break
            cut = min(ends)
        yield text[start:cut]
        start = cut
    yield text[start:]


def words_of(piece: str, vocabulary: Vocabulary) -> list:
    """Words of a piece of text; a special token is a tuple of itself."""
    if vocabulary.split is None or not any(t in piece for t in vocabulary.special):
        return WORDS.findall(lowered(piece))
    out: list = []
    for part in vocabulary.split.split(piece):
        if part in vocabulary.special:
            out.append((part,))
        else:
            out += WORDS.findall(lowered(part))
    return out


def encode_all(texts_: list[str], words: Words) -> list[np.ndarray]:
    """Ids of each text as the tokenizers library gives them without special tokens added.

    Texts come piece by piece, and the pieces of about LOOKED_AT characters are encoded together: the
    words and ids of no more than these are held beside the results.
    """
    out: list[list[np.ndarray]] = [[] for _ in texts_]
    held, cuts, owners, size = [], [0], [], 0
    for number, text in enumerate(texts_):
        for piece in pieces(text):
            held += words_of(piece, words.vocabulary)
            cuts.append(len(held))
            owners.append(number)
            size += len(piece)
            if size >= LOOKED_AT or number == len(texts_) - 1:
                for owner, ids in zip(owners, words.ids(held, cuts)):
                    out[owner].append(ids)
                held, cuts, owners, size = [], [0], [], 0
    return [np.concatenate(x) if len(x) > 1 else x[0] for x in out]


def encode(text: str, words: Words) -> np.ndarray:
    return encode_all([text], words)[0]


class Decoder:
    """Ids to text, some at a time, as the library does for files without a decoder.

    Each token is written as its vocabulary entry and one space stands between tokens, also
    between those of different calls. `text` gives the bytes behind the entries instead: a UTF-8
    automaton holds back the bytes of an unfinished character, and word ends become spaces.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.begun, self.pending = vocabulary, False, b""
        self.byte = {c: b for b, c in enumerate(byte_letters())}

    def feed(self, ids: list[int]) -> str:
        if not ids:
            return ""
        lead, self.begun = " " if self.begun else "", True
        return lead + " ".join(map(self.vocabulary.tokens.__getitem__, ids))

    def text(self, ids: list[int], final: bool = False) -> str:
        out, end = [self.pending], self.vocabulary.end
        for token in map(self.vocabulary.tokens.__getitem__, ids):
            if token in self.vocabulary.special:
                out.append(token.encode())
                continue
            plain = token.removesuffix(end) if end else token
            out.append(bytes(map(self.byte.__getitem__, plain)) + (b" " if plain != token else b""))
        data = b"".join(out)
        cut = len(data) if final else _whole_characters(data)
        self.pending = data[cut:]
        return data[:cut].decode("utf-8", "replace")


def _whole_characters(data: bytes) -> int:
    """Bytes before an unfinished UTF-8 character at the end."""
    for back in range(1, min(3, len(data)) + 1):
        lead = data[-back]
        if lead >= 0xC0:
            need = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            return len(data) - back if back < need else len(data)
        if lead < 0x80:
            break
    return len(data)


_KNOWN: dict[int, Words] = {}


def _words(source: bytes) -> Words:
    """One cache per worker process and vocabulary."""
    key = hash(source)
    if key not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[key] = Words(Vocabulary(source))
    return _KNOWN[key]


def _file(df: DataFrame, path: str):
    """The vocabulary file, a few MB at any size of the input, read on the driver and sent once."""
    with open(path, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>) of every whole text, with the tokenizer file at `path` (driver's).

    Null text counts as empty, and an empty text has no ids. Rows may repeat; an empty table gives
    an empty result.
    """
    source = _file(docs, path)

    def run(batches):
        words = _words(source.value)
        for keys, data, where in documents_of(batches, 4 << 20):
            ids = encode_all([data[a:b].decode() for a, b in zip(where.tolist(), where[1:].tolist())], words)
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
            yield pa.record_batch([pa.array(keys), lists], names=["doc_id", "ids"])

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def code_texts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded): `encode_texts` and `decode_ids` of the ids, in one pass over the rows."""
    source = _file(docs, path)

    def run(batches):
        words = _words(source.value)
        for keys, data, where in documents_of(batches, 4 << 20):
            ids = encode_all([data[a:b].decode() for a, b in zip(where.tolist(), where[1:].tolist())], words)
            decoded = pa.array([_decoded(x, words.vocabulary) for x in ids], pa.string())
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
            yield pa.record_batch([pa.array(keys), lists, decoded], names=["doc_id", "ids", "decoded"])

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded) of a frame of doc_id and ids. Null ids count as none."""
    source = _file(encoded, path)

    def run(batches):
        vocabulary = _words(source.value).vocabulary
        for batch in batches:
            lists = batch.column(1).fill_null(pa.scalar([], batch.column(1).type))
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            decoded = [_decoded(values[a:b], vocabulary) for a, b in zip(ends, ends[1:])]
            columns = [pa.array(longs(batch.column(0))), lists, pa.array(decoded, pa.string())]
            yield pa.record_batch(columns, names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def _decoded(ids: np.ndarray, vocabulary: Vocabulary) -> str:
    decoder = Decoder(vocabulary)
    return "".join(decoder.feed(ids[at : at + 65_536].tolist()) for at in range(0, len(ids), 65_536))
