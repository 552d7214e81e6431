"""Jaccard join of documents on word shingles, by token-combination prefixes."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import LEAST, buckets_for, documents_of, longs, packed, stage, text_bytes, texts, unique_key_join
from wardline.llm.components import components
from wardline.llm.suffix_dedup import _blob, _mixed, _unpacked, words_at

WORDS = 5
# Documents link when 100 * intersection >= PERCENT * union.
PERCENT = 80
# A token is frequent if it has this many prefix places and one in FREQUENT_SHARE of all.
FREQUENT = 32
FREQUENT_SHARE = 65_536
# Powers of two of the bits that bound overlaps: about two bits a token, within these limits.
LEAST_BITS, MOST_BITS = 8, 14
# Text behind a bucket of signatures, and behind a task of verification.
BUCKET_BYTES = 24 << 20
BIN_BYTES = 4 << 20
BLOCK_BYTES = 4 << 20
# Sets that are compared with each other in one task; larger clusters are cut into blocks.
BLOCK = 512
# Lists up to this length are thinned in one task; longer ones are taken whole.
LONGEST = 1 << 16
# Sets of a token up to which their pairs are counted one by one, beyond it by matrix product.
SPARSE = 16
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(data: bytes, where: np.ndarray, ends: bool = False):
    """Hash of each word of the texts, A-Z lower-cased, and the words' offsets by text.

    With `ends` also where each word starts and ends.
    """
    data = data.lower()
    raw = np.frombuffer(data, np.uint8)
    n = len(raw)
    if not n:
        none = np.empty(0, np.uint64), np.zeros(len(where), np.int64)
        return (*none, *[np.empty(0, np.int64)] * 2) if ends else none
    dark = ~_SPACE[raw]
    cut = np.zeros(n + 1, bool)
    cut[where] = True
    start = dark.copy()
    start[1:] &= ~dark[:-1] | cut[1:n]
    end = dark.copy()
    end[:-1] &= ~dark[1:] | cut[1:n]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    h, by_text = span_hashes(data, start, end), np.searchsorted(start, where, "left")
    return (h, by_text, start, end) if ends else (h, by_text)


def span_hashes(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span (not empty)."""
    eights, length = words_at(data), end - start
    h = _mixed(length.astype(np.uint64) * _M1)
    left, at, live = length.copy(), start.copy(), np.arange(len(start))
    while len(live):
        size = np.minimum(left, 8).astype(np.uint64)
        part = eights[at] & (~np.uint64(0) >> ((np.uint64(8) - size) * np.uint64(8)))
        h[live] = _mixed(h[live] + part * _M3)
        more = left > 8
        live, left, at = live[more], left[more] - 8, at[more] + 8
    return h


def shingle_sets(data: bytes, where: np.ndarray, words: int = WORDS):
    """(tokens, offsets): the distinct shingle hashes of each text in ascending order.

    A text of fewer words has its whole sequence as one token, one without words has none.
    Shingles are told apart by 64-bit hashes of their words.
    """
    h, by_text = word_hashes(data, where)
    first, many = by_text[:-1], np.diff(by_text)
    count = np.where(many >= words, many - words + 1, (many > 0).astype(np.int64))
    ends = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(ends[-1]) - np.repeat(ends[:-1], count) + np.repeat(first, count)
    size = np.repeat(np.minimum(many, words), count)
    token = _mixed(size.astype(np.uint64) * _M2)
    for k in range(words):
        live = size > k
        if live.all():
            token = _mixed(token * _M1 + h[at + k])
        else:
            token[live] = _mixed(token[live] * _M1 + h[at[live] + k])
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        token[a:b].sort()
    new = np.ones(len(token), bool)
    new[1:] = token[1:] != token[:-1]
    new[ends[:-1][count > 0]] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    return token[new], kept[ends]


def set_digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def bit_level(n: int) -> int:
    """Power of two of the bits of a set of n."""
    return min(max((n - 1).bit_length() + 1, LEAST_BITS), MOST_BITS)


def set_bits(tokens: np.ndarray) -> bytes:
    """Parity of the number of tokens on each bit; a bit is the low end of the hash."""
    bits = 1 << bit_level(len(tokens))
    place = (tokens & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def allowed(n: int, percent: int = PERCENT) -> int:
    """Tokens of a set of n that a linked set may lack."""
    return n + (-percent * n // 100)


def signatures(tokens: np.ndarray, frequent: np.ndarray, percent: int = PERCENT):
    """(single, combined) signatures of a set; linked sets have at least one in common.

    Order: rare tokens by hash, then frequent ones by hash. A prefix of `allowed` + 1 rare tokens
    suffices, as a linked set lacks at most `allowed` of them. If there are too few, the prefix is
    extended by frequent tokens, which count in classes of about four by the top bits of their
    hash: c of a class count as c - 1, since that many must be missing before no two are left, and
    each two of a class in the prefix are one signature. Classes depend on the level (the power of
    two) of the set's size; a set signs for its own level and that of the smallest set it may link
    with. Small sets take frequent tokens singly.
    """
    n = len(tokens)
    need = allowed(n, percent) + 1
    if not len(frequent):
        return tokens[:need], tokens[:0]
    at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
    is_frequent = frequent[at] == tokens
    rare = tokens[~is_frequent]
    if len(rare) >= need:
        return rare[:need], tokens[:0]
    common, missing, combined = tokens[is_frequent], need - len(rare), []
    smallest = n - allowed(n, percent)
    for level in {n.bit_length() - 1, smallest.bit_length() - 1}:
        tag = _mixed(np.array([level + 1], np.uint64) * _M2)
        if level < 5:
            combined.append(_mixed(common[:missing] * _M3 + tag))
            continue
        part = (common >> np.uint64(64 - (level - 2))).astype(np.int64)
        new = np.ones(len(part), bool)
        new[1:] = part[1:] != part[:-1]
        # Units so far: tokens after the first of their class.
        units = np.cumsum(~new)
        size = int(np.searchsorted(units, missing, "left")) + 1
        prefix, group = common[:size], np.cumsum(new[:size])
        for step in range(1, size):
            same = group[step:] == group[:-step]
            if not same.any():
                break
            pair = _mixed(prefix[:-step][same] * _M1 + _mixed(prefix[step:][same]))
            combined.append(_mixed(pair * _M3 + tag))
    return rare, np.unique(np.concatenate(combined))


def _blocks(batches, words):
    """Per block of texts: ids, tokens, offsets, digests and the first text of each digest."""
    for ids, data, where in documents_of(batches, BLOCK_BYTES):
        tokens, ends = shingle_sets(data, where, words)
        first = {}
        digests = [set_digest(tokens[a:b]) for a, b in zip(ends.tolist(), ends[1:].tolist())]
        for i, d in enumerate(digests):
            first.setdefault(d, i)
        yield ids, tokens, ends, digests, sorted(i for i in first.values() if ends[i] < ends[i + 1])


def _members(words: int):
    def run(batches):
        for ids, tokens, ends, digests, first in _blocks(batches, words):
            bits = {digests[i]: set_bits(tokens[ends[i] : ends[i + 1]]) for i in first}
            arrays = [
                pa.array(ids),
                pa.array(np.diff(ends)),
                pa.array(digests, pa.binary()),
                pa.array([bits.pop(d, None) for d in digests], pa.binary()),
            ]
            yield pa.record_batch(arrays, names=["doc_id", "n", "digest", "bits"])

    return run


def _by_bucket(keys: np.ndarray, buckets: int):
    """(bucket, positions) of keys, by their middle bits."""
    bucket = ((keys >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        yield b, order[cuts[b] : cuts[b + 1]]


def _prefix_counts(words: int, percent: int, buckets: int):
    def run(batches):
        for _, tokens, ends, _, first in _blocks(batches, words):
            if not first:
                continue
            sets = [tokens[ends[i] : ends[i + 1]] for i in first]
            prefix = np.concatenate([s[: allowed(len(s), percent) + 1] for s in sets])
            token, count = np.unique(prefix, return_counts=True)
            for b, at in _by_bucket(token, buckets):
                arrays = [pa.array([b], pa.int32())]
                arrays += [pa.array([_blob(x)], pa.binary()) for x in (token[at], count[at].astype(np.int64))]
                yield pa.record_batch(arrays, names=["bucket", "tokens", "counts"])

    return run


def _summed(least: int):
    """Prefix places of a bucket's tokens: their number, and the tokens that may be frequent."""

    def run(table: pa.Table) -> pa.Table:
        return _sums(table, least)

    return run


def _sums(table: pa.Table, least: int) -> pa.Table:
    token = np.concatenate([_unpacked(v, np.uint64) for v in table.column("tokens").to_pylist()])
    count = np.concatenate([_unpacked(v, np.int64) for v in table.column("counts").to_pylist()])
    order = np.argsort(token, kind="stable")
    token, count = token[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    total = np.add.reduceat(count, first)
    many = total >= least
    return pa.table(
        {
            "token": pa.array(np.append(token[first][many], np.uint64(0)).view(np.int64)),
            "count": pa.array(np.append(total[many], -total.sum())),
        }
    )


def frequent_tokens(docs: DataFrame, words: int, percent: int, buckets: int, least: int) -> np.ndarray:
    """Tokens with at least `least` prefix places that hold one in FREQUENT_SHARE of all places.

    So there are at most FREQUENT_SHARE of them, whatever the input: they are collected and sent
    with the tasks. Places are counted per block of texts, then per token.
    """
    blobs = docs.mapInArrow(_prefix_counts(words, percent, buckets), "bucket int, tokens binary, counts binary")
    counts = stage(blobs.groupBy("bucket").applyInArrow(_summed(least), "token long, count long"), "jaccard-tokens")
    total = -(counts.filter("count < 0").agg(F.sum("count")).first()[0] or 0)
    bound = max(least, math.ceil(total / FREQUENT_SHARE))
    rows = counts.filter(F.col("count") >= bound).select("token").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))


def _signed(words: int, percent: int, buckets: int, frequent):
    def run(batches):
        common = frequent.value
        for _, tokens, ends, digests, first in _blocks(batches, words):
            signed = [signatures(tokens[ends[i] : ends[i + 1]], common, percent) for i in first]
            for kind in (0, 1):
                value = [s[kind] for s in signed]
                many = [len(v) for v in value]
                if not sum(many):
                    continue
                value, owner = np.concatenate(value), np.repeat(np.arange(len(first)), many)
                # Combined signatures only pass through: any bucket will do, so they stay together.
                dealt = _by_bucket(value, buckets) if not kind else [(int(value[0] % np.uint64(buckets)), np.arange(len(value)))]
                for b, at in dealt:
                    used, local = np.unique(owner[at], return_inverse=True)
                    names = b"".join(digests[first[i]] for i in used)
                    columns = [_blob(value[at]), _blob(local.astype(np.int32)), names]
                    arrays = [pa.array([b], pa.int32()), pa.array([kind], pa.int32()), *(pa.array([c], pa.binary()) for c in columns)]
                    yield pa.record_batch(arrays, names=["bucket", "kind", "signatures", "owners", "digests"])

    return run


_DIGEST = np.dtype("V16")


def _lists(table: pa.Table) -> pa.Table:
    """Sets with a common signature: (list, kind, digest). Lists with the same members are one."""
    kinds = np.array(table.column("kind").to_pylist())
    value = [_unpacked(v, np.uint64) for v in table.column("signatures").to_pylist()]
    owner = [_unpacked(v, np.int32) for v in table.column("owners").to_pylist()]
    names = [np.frombuffer(v, _DIGEST) for v in table.column("digests").to_pylist()]
    named = [n[o] for n, o in zip(names, owner)]
    out = []
    for kind in (0, 1):
        mine = np.flatnonzero(kinds == kind)
        if not len(mine):
            continue
        signature = np.concatenate([value[i] for i in mine])
        digest = np.concatenate([named[i] for i in mine])
        if kind == 0:
            order = np.argsort(signature, kind="stable")
            signature, digest = signature[order], digest[order]
            same = signature[1:] == signature[:-1]
            several = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            signature, digest = signature[several], digest[several]
            signature, digest = _membership(signature, digest)
        out.append((signature, np.full(len(signature), kind), digest))
    signature, kind, digest = (np.concatenate(x) for x in zip(*out))
    plain = pa.Array.from_buffers(pa.binary(16), len(digest), [None, pa.py_buffer(np.ascontiguousarray(digest))])
    return pa.table({"list": pa.array(signature.view(np.int64)), "kind": pa.array(kind.astype(np.int32)), "digest": plain.cast(pa.binary())})


def _membership(signature: np.ndarray, digest: np.ndarray):
    """(list, digest) with lists named by their members, each kept once, if they have two or more."""
    if not len(signature):
        return signature, digest
    halves = np.ascontiguousarray(digest).view(np.uint64).reshape(-1, 2)
    order = np.lexsort((halves[:, 1], halves[:, 0], signature))
    signature, halves, digest = signature[order], halves[order], digest[order]
    new = np.ones(len(signature), bool)
    new[1:] = (signature[1:] != signature[:-1]) | (halves[1:] != halves[:-1]).any(axis=1)
    signature, halves, digest = signature[new], halves[new], digest[new]
    first = np.flatnonzero(np.concatenate([[True], signature[1:] != signature[:-1]]))
    many = np.diff(np.append(first, len(signature)))
    name = _mixed(np.add.reduceat(_mixed(halves[:, 0] * _M1 + halves[:, 1]), first) + many.astype(np.uint64))
    _, once = np.unique(name, return_index=True)
    keep = np.zeros(len(first), bool)
    keep[once] = True
    keep &= many > 1
    rows = np.repeat(keep, many)
    return np.repeat(name, many)[rows], digest[rows]


class Bounds:
    """Whether sizes and bits of sets leave room for a link.

    Sets that differ in d tokens have parities that differ on at most d bits. The two halves of a
    set's bits, combined, are its bits on the level below; sizes that may link are at most one
    level apart.
    """

    def __init__(self, size: np.ndarray, bits: list[bytes], percent: int):
        self.size, self.percent = size, percent
        self.level = np.array([len(b).bit_length() + 2 for b in bits])
        self.at, self.rows = {}, {}
        for level in np.unique(self.level).tolist():
            own = np.flatnonzero(self.level == level)
            matrix = np.frombuffer(b"".join(bits[i] for i in own), np.uint64).reshape(len(own), -1)
            half = matrix.shape[1] // 2
            for place, rows in ((level, matrix), (level - 1, matrix[:, :half] ^ matrix[:, half:])):
                number = self.at.setdefault(place, np.full(len(size), -1))
                held = self.rows.setdefault(place, np.empty((0, rows.shape[1]), np.uint64))
                number[own] = len(held) + np.arange(len(own))
                self.rows[place] = np.concatenate([held, rows])

    def may_link(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        out = np.zeros((len(left), len(right)), bool)
        for one in np.unique(self.level[left]).tolist():
            i = np.flatnonzero(self.level[left] == one)
            for other in (one - 1, one, one + 1):
                j = np.flatnonzero(self.level[right] == other)
                if not len(j):
                    continue
                place = min(one, other)
                at, rows = self.at[place], self.rows[place]
                a, b = self.size[left[i]][:, None], self.size[right[j]][None, :]
                pair = rows[at[left[i]]][:, None, :] ^ rows[at[right[j]]][None, :, :]
                differ = np.bitwise_count(pair).sum(axis=2, dtype=np.int64)
                overlap = np.minimum((a + b - differ) // 2, np.minimum(a, b))
                out[np.ix_(i, j)] = 100 * overlap >= self.percent * (a + b - overlap)
        return out


def _forest(size: np.ndarray, bits: list[bytes], percent: int):
    """Edges that connect the sets of a list as all pairs that may link would."""
    bounds, left, edges = Bounds(size, bits, percent), np.arange(len(size)), []
    while len(left):
        ready, left = left[:1], left[1:]
        while len(ready) and len(left):
            near = np.zeros(len(left), bool)
            # So many rows that a matrix of pairs stays small.
            step = max(1, (1 << 16) // len(left))
            for at in range(0, len(ready), step):
                far = np.flatnonzero(~near)
                if not len(far):
                    break
                rows = ready[at : at + step]
                may = bounds.may_link(rows, left[far])
                hit = may.any(axis=0)
                edges += zip(rows[may.argmax(axis=0)[hit]].tolist(), left[far[hit]].tolist())
                near[far[hit]] = True
            ready, left = left[near], left[~near]
    return edges


def _candidates(percent: int):
    """Rows (list, id, n, bits) sorted by list, to edges (a, b) between ids."""

    def run(batches):
        held, before = [], None
        for batch in batches:
            held.append(batch)
            name = longs(batch.column(0))
            if before is not None and len(name) and name[-1] == before and (name == before).all():
                continue
            before = name[-1] if len(name) else before
            table = pa.Table.from_batches(held)
            names = longs(table.column(0).combine_chunks())
            whole = int(np.flatnonzero(names != names[-1])[-1]) + 1 if (names != names[-1]).any() else 0
            yield from edges(table.slice(0, whole))
            held = table.slice(whole).to_batches()
        if held:
            yield from edges(pa.Table.from_batches(held))

    def edges(table):
        if not table.num_rows:
            return
        table = table.combine_chunks()
        names, ids, size = (longs(table.column(i).combine_chunks()) for i in (0, 1, 2))
        bits = table.column(3).to_pylist()
        first = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
        a, b = [], []
        for s, e in zip(first.tolist(), [*first[1:].tolist(), len(names)]):
            for i, j in _forest(size[s:e], bits[s:e], percent):
                a.append(ids[s + i])
                b.append(ids[s + j])
        yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def overlaps(tokens: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Number of common tokens of each two sets."""
    many = len(ends) - 1
    owner = np.repeat(np.arange(many), np.diff(ends))
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else np.empty(0, np.int64)
    count = np.diff(np.append(first, len(tokens)))
    group = np.repeat(np.arange(len(first)), count)
    out = np.zeros((many, many))
    few = (count[group] <= SPARSE) & (count[group] > 1)
    g, o = group[few], owner[few]
    flat = np.zeros(many * many, np.int64)
    for step in range(1, SPARSE):
        if step >= len(g):
            break
        same = g[step:] == g[:-step]
        if not same.any():
            break
        flat += np.bincount(o[:-step][same] * many + o[step:][same], minlength=many * many)
    out += flat.reshape(many, many)
    out += out.T
    dense = np.flatnonzero(count > SPARSE)
    number = np.full(len(first), -1, np.int64)
    number[dense] = np.arange(len(dense))
    in_dense = number[group]
    for at in range(0, len(dense), 4096):
        rows = (in_dense >= at) & (in_dense < at + 4096)
        x = np.zeros((min(4096, len(dense) - at), many), np.float32)
        x[in_dense[rows] - at, owner[rows]] = 1
        out += x.T @ x
    return out.astype(np.int64)


def _verified(words: int, percent: int):
    """Exact links within each cluster (or between two of its blocks) of a task's texts."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        root, low, high, ids, block, copies = (longs(table.column(c).combine_chunks()) for c in ("root", "low", "high", "id", "block", "copies"))
        wanted = table.column("digest").to_pylist()
        parts = [t.encode() for t in table.column("text").to_pylist()]
        tokens, ends = shingle_sets(b"".join(parts), np.cumsum([0, *map(len, parts)]), words)
        groups = {}
        for i, key in enumerate(zip(root.tolist(), low.tolist(), high.tolist())):
            # A doc_id may come with other texts; rows of the same text count once.
            if set_digest(tokens[ends[i] : ends[i + 1]]) == wanted[i]:
                groups.setdefault(key, {}).setdefault(wanted[i], i)
        a, b, links = [], [], []
        for (_, first, second), found in groups.items():
            at = np.array(list(found.values()))
            if len(at) < 2:
                continue
            size = ends[at + 1] - ends[at]
            flat = np.concatenate([tokens[ends[i] : ends[i + 1]] for i in at])
            common = overlaps(flat, np.concatenate([[0], np.cumsum(size)]))
            linked = 100 * common >= percent * (size[:, None] + size[None, :] - common)
            np.fill_diagonal(linked, False)
            if first != second:
                linked &= block[at][:, None] != block[at][None, :]
            for i in np.flatnonzero(linked.any(axis=1)).tolist():
                row = np.flatnonzero(linked[i])
                a.append(ids[at[i]])
                b.append(min(ids[at[row]].min(), ids[at[i]]))
                links.append((wanted[at[i]], int(copies[at[row]].sum())))
            # Stars to the smallest neighbour need not connect: add a tree of each component.
            for i, j in _tree(linked):
                a.append(ids[at[i]])
                b.append(ids[at[j]])
                links.append((wanted[at[i]], 0))
        return pa.table(
            {
                "a": pa.array(a, pa.int64()),
                "b": pa.array(b, pa.int64()),
                "digest": pa.array([d for d, _ in links], pa.binary()),
                "links": pa.array([n for _, n in links], pa.int64()),
            }
        )

    return run


def _tree(linked: np.ndarray):
    left, edges = np.ones(len(linked), bool), []
    for s in range(len(linked)):
        if not left[s]:
            continue
        left[s] = False
        ready = [s]
        while ready:
            i = ready.pop()
            for j in np.flatnonzero(linked[i] & left).tolist():
                left[j] = False
                edges.append((i, j))
                ready.append(j)
    return edges


def link_documents(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, frequent: int = FREQUENT, block: int = BLOCK
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, n_links.

    Documents with equal sets are one entity, found by digest. Entities with a common signature
    (`signatures`) form lists, which are thinned to the pairs whose sizes and bits leave room for a
    link; only lists of more than LONGEST are taken whole. The clusters that these candidates
    connect are verified: the texts of a cluster meet in one task, or, beyond
    `block` entities, in a task per two blocks of it, and all their pairs are compared exactly. Links
    then give the components. No pair is written out: lists and tasks return trees.

    `component_id` is the smallest doc_id reachable by links, `n_links` the documents linked
    directly. Null and empty texts, and texts without words, have 0 shingles and no links. Rows
    that share a doc_id count as one document with several texts: each row has its own n_shingles
    and links, and its component covers all of them. A null doc_id counts as the smallest long.
    """
    docs = texts(docs)
    size = text_bytes(docs)
    buckets = buckets_for(size, BUCKET_BYTES, least=4)
    spark = docs.sparkSession
    members = stage(docs.mapInArrow(_members(words), "doc_id long, n long, digest binary, bits binary"), "jaccard-members")
    entities = members.filter("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.max("n").alias("n"), F.max("bits").alias("bits"), F.count("*").alias("copies")
    )
    entities = stage(entities, "jaccard-entities")
    total = members.count()

    common = spark.sparkContext.broadcast(frequent_tokens(docs, words, percent, buckets, frequent))
    signed = docs.mapInArrow(
        _signed(words, percent, buckets, common), "bucket int, kind int, signatures binary, owners binary, digests binary"
    )
    lists = signed.groupBy("bucket").applyInArrow(_lists, "list long, kind int, digest binary").distinct()
    known = entities.select("digest", "id", "n", "bits")
    lists = stage(lists.join(known, "digest").drop("digest"), "jaccard-lists")
    centres = lists.groupBy("list").agg(F.min("id").alias("b"), F.count("*").alias("many")).filter(F.col("many") > LONGEST)
    centres = stage(centres, "jaccard-centres")
    short = lists.join(centres.select("list"), "list", "left_anti").select("list", "id", "n", "bits")
    thinned = short.repartition("list").sortWithinPartitions("list").mapInArrow(_candidates(percent), "a long, b long")
    long_ = lists.select("list", "id").join(centres.select("list"), "list", "left_semi")
    entries = centres.agg(F.sum("many")).first()[0] or 0
    starred = unique_key_join(long_, centres, "list", "many", entries).select(F.col("id").alias("a"), "b")
    clusters = stage(components(thinned.unionByName(starred)), "jaccard-clusters")

    linked = stage(_verify(docs, entities, clusters, size, total, words, percent, block), "jaccard-links")
    # Entities that share a document are one component too.
    found = stage(components(linked.select("a", "b").unionByName(_shared_ids(members, entities))), "jaccard-components")
    counts = linked.groupBy("digest").agg(F.sum("links").alias("links"))
    named = entities.join(counts, "digest", "left").join(found.withColumnRenamed("node", "id"), "id", "left")
    named = named.select("digest", "copies", F.coalesce("root", "id").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    joined = unique_key_join(members.filter("n > 0").select("doc_id", "n", "digest"), stage(named, "jaccard-named"), "digest", "copies", total)
    empty = members.filter("n = 0").withColumns({"component_id": F.col("doc_id"), "n_links": F.lit(0).cast("long")})
    columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links"]
    return joined.select(*columns).unionByName(empty.select(*columns))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, of each component's smallest document.

    Texts without words are linked with nothing and stay, as do all rows of a doc_id that stays. A
    null doc_id counts as the smallest long. Other columns may have any name and value. An empty
    table gives an empty result.
    """
    kept = link_documents(docs).filter("doc_id = component_id").select("doc_id").distinct()
    rows = packed(docs, doc_id=F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)))
    return rows.join(kept, "doc_id", "left_semi").select("row.*")


def _shared_ids(members: DataFrame, entities: DataFrame) -> DataFrame:
    """Edges between the entities of a doc_id that has several texts."""
    several = members.filter("n > 0").groupBy("doc_id").agg(F.count_distinct("digest").alias("texts")).filter("texts > 1")
    rows = members.join(several, "doc_id").select("digest", "doc_id")
    return rows.join(entities, "digest").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))


def _verify(docs, entities, clusters, size: int, total: int, words: int, percent: int, block: int) -> DataFrame:
    """(a, b, digest, links) from the texts of the clusters' entities."""
    sizes = stage(clusters.groupBy("root").agg(F.count("*").alias("many")), "jaccard-sizes")
    nodes = sizes.agg(F.sum("many")).first()[0] or 0
    placed = unique_key_join(clusters, sizes, "root", "many", nodes).withColumn("blocks", F.ceil(F.col("many") / block).cast("int"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    chosen = entities.select("id", "digest", "copies").join(placed.withColumnRenamed("node", "id"), "id")
    # One text per entity: its smallest document's.
    found = docs.join(chosen, docs["doc_id"] == chosen["id"]).drop("doc_id")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    found = found.withColumn("_other", other)
    found = found.withColumns({"low": F.least("block", "_other"), "high": F.greatest("block", "_other")})
    bins = buckets_for(size * nodes / max(total, 1), BIN_BYTES, least=16)
    bin_ = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("root"), F.lit(bins))).otherwise(F.xxhash64("root", "low", "high"))
    found = found.select("id", "digest", "copies", "text", "root", "block", "low", "high", "blocks", bin_.alias("bin"))
    return found.groupBy("bin").applyInArrow(_verified(words, percent), "a long, b long, digest binary, links long")
