"""Removal of passages that an earlier document has: shared byte strings found by suffix order."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wardline.llm import collection_bwt
from wardline.llm.common import buckets_for, documents_of, text_bytes, texts

WINDOW = 50
# Bytes of an anchor: every window holds WINDOW - GRAM + 1 of them.
GRAM = 16
# Text behind a bucket of anchors or strings, and behind a group of documents.
BUCKET_BYTES = 8 << 20
BLOCK_BYTES = 4 << 20
# Text of a collection whose transform is built at a time.
COLLECTION_BYTES = 1 << 19
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_ANCHORS = "bucket int, anchors binary, groups binary"
_SHARED = "part int, anchors binary"
_TEXTS = "part int, ids binary, ends binary, texts binary"
_PIECES = "bucket int, strings binary, lengths binary, places binary, docs binary"
_SPANS = "part int, spans binary"
_CUT = "doc_id long, starts array<int>, ends array<int>, n_bytes long, kept binary"
_SPAN = np.dtype([("doc", "<i8"), ("key", "<i8"), ("start", "<i4"), ("end", "<i4")])
_NONE = np.iinfo(np.int64).max


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _M2
    return h ^ (h >> np.uint64(29))


def words_at(data: bytes) -> np.ndarray:
    """The 8 bytes at each place as a number, zeros behind the end."""
    padded, n = data + bytes(16), len(data)
    out = np.empty(n + 8, np.uint64)
    for k in range(8):
        part = np.frombuffer(padded, "<u8", (n + 15 - k) // 8, k)
        out[k::8] = part[: len(out[k::8])]
    return out[:n]


def text_key(text: bytes) -> int:
    """Tells rows apart that share a doc_id."""
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def gram_hashes(eights: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the `gram` bytes (8 at least) at each place."""
    n = len(eights) - gram + 1
    h = eights[:n] * _M1
    for at in (*range(8, gram - 8, 8), gram - 8):
        h = _mixed(h) + eights[at : at + n] * _M3
    return _mixed(h)


def anchors_of(eights: np.ndarray, window: int, gram: int) -> np.ndarray:
    """Smallest hash of the grams in the window that starts at each place."""
    h, width, span = gram_hashes(eights, gram), 1, window - gram + 1
    while width * 2 <= span:
        h, width = np.minimum(h[:-width], h[width:]), width * 2
    return np.minimum(h[: len(h) - span + width], h[span - width :]) if span > width else h


def anchors_by_string(data: np.ndarray, start: np.ndarray, length: np.ndarray, gram: int) -> np.ndarray:
    """Anchor of each string: the smallest hash of all its grams, as each is in some window."""
    h = gram_hashes(words_at(data.tobytes()), gram)
    cuts = np.stack([start, start + length - gram + 1], axis=1).ravel()
    return np.minimum.reduceat(np.append(h, np.full(gram, ~np.uint64(0))), cuts)[::2]


def pieces_of(data: bytes, where: np.ndarray, window: int, gram: int):
    """Strings that hold all windows of the texts: (start, windows, anchor, text number).

    A string is a run of consecutive windows with the same anchor, `window - gram + 1` of them at
    most; equal windows have equal anchors wherever they stand.
    """
    eights = words_at(data)
    empty = np.empty(0, np.int64)
    if len(data) < window:
        return eights, empty, empty, np.empty(0, np.uint64), empty
    anchor = anchors_of(eights, window, gram)
    edge = np.zeros(len(data) + 2, np.int8)
    long_enough = np.diff(where) >= window
    edge[where[:-1][long_enough]] += 1
    edge[where[1:][long_enough] - window + 1] -= 1
    inside = np.cumsum(edge[: len(anchor)], dtype=np.int8).astype(bool)
    change = np.ones(len(anchor) + 1, bool)
    change[1:-1] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])
    # Texts of exactly the window's length stand apart too, as between two of them windows cross.
    begin = np.flatnonzero(change[:-1] & inside)
    end = np.flatnonzero(change[1:] & inside) + 1
    most = window - gram + 1
    parts = -(-(end - begin) // most)
    number = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    start = np.repeat(begin, parts) + number * most
    size = np.minimum(np.repeat(end, parts) - start, most)
    return eights, start, size, anchor[start], np.searchsorted(where, start, "right") - 1


def _same(eights: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the strings at a and b, of equal length (8 at least), are equal."""
    equal = np.ones(len(a), bool)
    for at in range(0, int(length.max(initial=0)), 8):
        step = np.minimum(at, length - 8)
        equal &= eights[a + step] == eights[b + step]
    return equal


def _content(eights: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    h = length.astype(np.uint64) * _M1
    for at in range(0, int(length.max(initial=0)), 8):
        h = _mixed(h + eights[start + np.minimum(at, length - 8)] * _M3)
    return h


def first_of_equal(eights, start, length, rank):
    """For each string the index of the equal one with the smallest rank, by content."""
    content = _content(eights, start, length)
    order = np.lexsort((rank, length, content))
    new = np.ones(len(order), bool)
    a, b = order[:-1], order[1:]
    new[1:] = (content[a] != content[b]) | (length[a] != length[b])
    head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))] if len(order) else order
    # A string that only shares the hash stands for itself.
    equal = _same(eights, start[head], start[order], length[order])
    out = np.empty(len(order), np.int64)
    out[order] = np.where(equal, head, order)
    return out


def _gathered(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    total = int(length.sum())
    at = np.arange(total) - np.repeat(np.cumsum(length) - length, length)
    return data[np.repeat(start, length) + at]


def _runs(flags: np.ndarray):
    """(row, first, last) of the runs of true cells in each row."""
    edge = np.zeros((flags.shape[0], flags.shape[1] + 2), np.int8)
    edge[:, 1:-1] = flags
    step = np.diff(edge, axis=1)
    row, first = np.nonzero(step == 1)
    last = np.nonzero(step == -1)[1] - 1
    return row, first, last


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), "zstd", asbytes=True)


def _unpacked(value: bytes, kind) -> np.ndarray:
    size = int.from_bytes(value[:8], "little")
    return np.frombuffer(pa.decompress(value[8:], size, "zstd", asbytes=True), kind)


def _blob(values: np.ndarray) -> bytes:
    return values.nbytes.to_bytes(8, "little") + _packed(values)


def _part(ids: np.ndarray, parts: int) -> np.ndarray:
    """Group of documents that an id belongs to."""
    return (_mixed(ids.astype(np.uint64) * _M1) % np.uint64(parts)).astype(np.int64)


def _cuts(keys: np.ndarray, many: int):
    """(key, positions) of small whole keys, ascending."""
    order = np.argsort(keys, kind="stable")
    ends = np.searchsorted(keys[order], np.arange(many + 1))
    for k in np.flatnonzero(np.diff(ends)).tolist():
        yield k, order[ends[k] : ends[k + 1]]


def _bucket(anchors: np.ndarray, buckets: int) -> np.ndarray:
    return ((anchors >> np.uint64(8)) % np.uint64(buckets)).astype(np.int64)


def _anchors(buckets: int, parts: int, window: int, gram: int, block: int):
    """Per block of texts and bucket: the anchors, each with the groups of the documents it is in.

    An anchor that several documents of a group have is written twice for the group.
    """

    def run(batches):
        for ids, data, where in documents_of(batches, block):
            _, _, _, anchor, text = pieces_of(data, where, window, gram)
            # Once per document (texts are in order), then twice at most per group.
            order = np.argsort(anchor, kind="stable")
            anchor, text = anchor[order], text[order]
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
            anchor, group = anchor[new], _part(ids, parts)[text[new]].astype(np.int32)
            same = anchor[1:] == anchor[:-1]
            several = np.flatnonzero(np.concatenate([[False], same]) | np.concatenate([same, [False]]))
            group[several] = group[several][np.lexsort((group[several], anchor[several]))]
            third = np.zeros(len(anchor), bool)
            third[2:] = (anchor[2:] == anchor[:-2]) & (group[2:] == group[:-2])
            anchor, group = anchor[~third], group[~third]
            for b, at in _cuts(_bucket(anchor, buckets), buckets):
                columns = [pa.array([b], pa.int32()), *(pa.array([_blob(x[at])], pa.binary()) for x in (anchor, group))]
                yield pa.record_batch(columns, names=["bucket", "anchors", "groups"])

    return run


def _shared_anchors(parts: int):
    """Anchors that occur in more than one document, for each group that has them."""

    def run(table: pa.Table) -> pa.Table:
        anchor = np.concatenate([_unpacked(v, np.uint64) for v in table.column("anchors").to_pylist()])
        group = np.concatenate([_unpacked(v, np.int32) for v in table.column("groups").to_pylist()])
        order = np.argsort(anchor, kind="stable")
        anchor, group = anchor[order], group[order]
        same = anchor[1:] == anchor[:-1]
        several = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        anchor, group = anchor[several], group[several]
        found = [(p, _blob(np.unique(anchor[at]))) for p, at in _cuts(group, parts)]
        return pa.table({"part": pa.array([p for p, _ in found], pa.int32()), "anchors": pa.array([b for _, b in found], pa.binary())})

    return run


def _grouped(parts: int, block: int):
    """Texts of a block by group of documents, compressed."""

    def run(batches):
        for ids, data, where in documents_of(batches, block):
            size, raw = np.diff(where), np.frombuffer(data, np.uint8)
            for p, at in _cuts(_part(ids, parts), parts):
                columns = [_blob(ids[at]), _blob(np.concatenate([[0], np.cumsum(size[at])])), _blob(_gathered(raw, where[at], size[at]))]
                arrays = [pa.array([p], pa.int32()), *(pa.array([c], pa.binary()) for c in columns)]
                yield pa.record_batch(arrays, names=["part", "ids", "ends", "texts"])

    return run


def _texts_of(table: pa.Table):
    """(ids, bytes, offsets) of a group's documents."""
    columns = [[_unpacked(v, k) for v in table.column(n).to_pylist()] for n, k in (("ids", np.int64), ("ends", np.int64), ("texts", np.uint8))]
    sizes = np.concatenate([np.diff(e) for e in columns[1]])
    return np.concatenate(columns[0]), np.concatenate(columns[2]).tobytes(), np.concatenate([[0], np.cumsum(sizes)])


def _strings(buckets: int, window: int, gram: int):
    """Per group of documents and bucket: the distinct strings with shared anchors, with the places
    they have in the group's smallest document; in its other documents they are removed at once."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names, rows = [c.split()[0] for c in _PIECES.split(", ")], []
        ids, data, where = _texts_of(left)
        eights, start, size, anchor, text = pieces_of(data, where, window, gram)
        shared = np.concatenate([np.empty(0, np.uint64), *(_unpacked(v, np.uint64) for v in right.column("anchors").to_pylist())])
        shared.sort()
        if len(shared) and len(start):
            keep = shared[np.minimum(np.searchsorted(shared, anchor), len(shared) - 1)] == anchor
            start, size, anchor, text = start[keep], size[keep], anchor[keep], text[keep]
            length, raw = size + window - 1, np.frombuffer(data, np.uint8)
            doc = ids[text]
            head = first_of_equal(eights, start, length, doc)
            again = doc != doc[head]
            keys = np.array([text_key(data[a:b]) for a, b in zip(where.tolist(), where[1:].tolist())], np.int64)
            place = start - where[text]
            for b, at in _cuts(_bucket(anchor, buckets), buckets):
                heads = np.unique(head[at])
                number = np.searchsorted(heads, head[at])
                used, local = np.unique(text[at], return_inverse=True)
                places = np.stack([number, local, place[at], again[at]]).astype(np.int32)
                strings = _gathered(raw, start[heads], length[heads])
                columns = (strings, length[heads].astype(np.uint8), places, np.stack([ids[used], keys[used]]))
                rows.append((b, *map(_blob, columns)))
        kinds = [pa.int32(), *[pa.binary()] * 4]
        return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return run


def window_owners(data: np.ndarray, length: np.ndarray, owner: np.ndarray, window: int) -> np.ndarray:
    """Smallest owner of each window of each string, as a row per string and a column per window.

    A symbol of the collection is two bytes, so each string is in it twice: as it is, and without
    its last byte, for the windows at the other places. The transform and the common prefixes put
    equal windows next to each other: a run of entries that share a window's symbols with the one
    before is one window. `window` is an even number of bytes.
    """
    many, half = len(length), window // 2
    code = np.append(data[:-1].astype(np.uint16) << np.uint16(8) | data[1:], np.uint16(0))
    used = np.zeros(1 << 16, bool)
    used[code] = True
    symbol = np.cumsum(used).astype(np.uint16)[code]
    stop = np.concatenate([length, length - 1])
    skip, size = stop % 2, stop // 2
    begin = np.tile(np.cumsum(length) - length, 2) + skip
    starts = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(starts, size)
    symbols, common = collection_bwt.build(symbol[np.repeat(begin, size) + 2 * place], starts, size, cap=half)
    string, left = collection_bwt.entries(symbols, 2 * many, int(size.max()))
    whole = left >= half
    value = np.where(whole, owner[string % many], _NONE)
    new = common < half
    first = np.flatnonzero(new)
    least = np.minimum.reduceat(value, first)[np.cumsum(new) - 1]
    out = np.full((many, int(length.max()) - window + 1), _NONE, np.int64)
    at = string[whole]
    out[at % many, skip[at] + 2 * (size[at] - left[whole])] = least[whole]
    return out


def _shared(window: int, gram: int, parts: int):
    """Spans to remove, from all strings of a bucket, packed by group of documents."""

    def run(table: pa.Table) -> pa.Table:
        columns = {n: table.column(n).to_pylist() for n in ("strings", "lengths", "places", "docs")}
        data = np.concatenate([_unpacked(v, np.uint8) for v in columns["strings"]])
        lengths = [_unpacked(v, np.uint8) for v in columns["lengths"]]
        places = [_unpacked(v, np.int32).reshape(4, -1) for v in columns["places"]]
        docs = [_unpacked(v, np.int64).reshape(2, -1) for v in columns["docs"]]
        length = np.concatenate(lengths).astype(np.int64)
        number = np.concatenate([p[0] + s for p, s in zip(places, np.cumsum([0, *map(len, lengths)]))]).astype(np.int64)
        local = np.concatenate([p[1] + s for p, s in zip(places, np.cumsum([0, *(d.shape[1] for d in docs)]))])
        _, _, place, again = np.concatenate(places, axis=1)
        again = again > 0
        doc, key = np.concatenate(docs, axis=1)[:, local]
        owner = np.empty(len(length), np.int64)
        owner[number[~again]] = doc[~again]
        start = np.cumsum(length) - length
        anchor = anchors_by_string(data, start, length, gram)
        least = _owners_by_string(data, start, length, anchor, owner, window, gram)
        # Occurrences in documents whose group already has an earlier copy go as a whole.
        spans = [(doc[again], key[again], place[again], place[again] + length[number[again]])]
        if least is not None:
            rows, flags = least
            row, first, last = _runs(flags)
            by_string = np.argsort(number, kind="stable")
            by_string = by_string[~again[by_string]]
            low = np.searchsorted(number[by_string], rows[row], "left")
            high = np.searchsorted(number[by_string], rows[row], "right")
            n = high - low
            at = by_string[np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            spans.append((doc[at], key[at], place[at] + np.repeat(first, n), place[at] + np.repeat(last, n) + window))
        found = np.empty(sum(len(s[0]) for s in spans), _SPAN)
        for name, values in zip(_SPAN.names, zip(*spans)):
            found[name] = np.concatenate(values)
        cut = [(p, _blob(found[at])) for p, at in _cuts(_part(found["doc"], parts), parts)]
        return pa.table({"part": pa.array([p for p, _ in cut], pa.int32()), "spans": pa.array([b for _, b in cut], pa.binary())})

    return run


def near_anchor(data: np.ndarray, begin, length, anchor, owner, window: int, gram: int) -> np.ndarray:
    """Whether a string may share a window with one of another owner.

    A shared window holds the anchor and `window - gram` bytes more, at least half of them on one
    side of it: two such strings agree in that half before the anchor or behind it. So only strings
    whose half is found in strings of different owners can share any. Hashes may call more strings
    alike, never fewer. Where a string has its anchor more than once, all with that anchor may.
    """
    eights = words_at(data.tobytes())
    hashes = gram_hashes(eights, gram)
    many = length - gram + 1
    row = np.repeat(np.arange(len(begin)), many)
    at = np.arange(many.sum()) + np.repeat(begin - (np.cumsum(many) - many), many)
    hit = np.flatnonzero(hashes[at] == anchor[row])
    row, at = row[hit], at[hit]
    times = np.bincount(row, minlength=len(begin))
    place = np.zeros(len(begin), np.int64)
    place[row[::-1]] = at[::-1]
    out = np.isin(anchor, anchor[times != 1])
    once = ~out
    half = -(-(window - gram) // 2)
    if half < 8:
        return np.ones(len(begin), bool)
    steps = [*range(0, half - 7, 8), half - 8]
    for first, fits in ((place + gram, place + gram + half <= begin + length), (place - half, place - half >= begin)):
        # Those found alike on the other side too: they may be the only ones that others meet here.
        own = np.flatnonzero(fits & once)
        key = anchor[own]
        for step in steps:
            key = _mixed(key + eights[first[own] + step] * _M3)
        order = np.argsort(key, kind="stable")
        own, key = own[order], key[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        heads = np.flatnonzero(new)
        if len(heads):
            apart = np.minimum.reduceat(owner[own], heads) != np.maximum.reduceat(owner[own], heads)
            out[own[apart[np.cumsum(new) - 1]]] = True
    return out


def _owners_by_string(data, start, length, anchor, owner, window, gram):
    """(string numbers, which of their windows an earlier document has), for strings with some."""
    order = np.argsort(anchor, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = anchor[order[1:]] != anchor[order[:-1]]
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    apart = np.minimum.reduceat(owner[order], first) != np.maximum.reduceat(owner[order], first)
    shared = np.sort(order[apart[group]])
    if not len(shared):
        return None
    # Equal strings are one in the collection, owned by the smallest of their documents.
    flat = _gathered(data, start[shared], length[shared])
    size, who = length[shared], owner[shared]
    begin = np.cumsum(size) - size
    head = first_of_equal(words_at(flat.tobytes()), begin, size, who)
    heads, index = np.unique(head, return_inverse=True)
    # A string that shares no window with another stays out of the collection: its windows are its owner's.
    _, kind, many = np.unique(anchor[shared[heads]], return_inverse=True, return_counts=True)
    met = np.flatnonzero(many[kind] > 1)
    if len(met):
        own = heads[met]
        met = met[near_anchor(flat, begin[own], size[own], anchor[shared[own]], who[own], window, gram)]
    met = np.bincount(met, minlength=len(heads)) > 0
    least = np.full((len(heads), int(size.max()) - window + 1), _NONE, np.int64)
    inside = np.arange(least.shape[1]) < (size[heads] - window + 1)[:, None]
    least[~met] = np.where(inside[~met], who[heads[~met]][:, None], _NONE)
    # Collections of a size that a processor's cache holds, whole anchors in each.
    number = -(-int(size[heads][met].sum()) // COLLECTION_BYTES)
    for _, at in _cuts(np.where(met, kind % max(number, 1), number), number):
        joint = heads[at]
        found = window_owners(_gathered(flat, begin[joint], size[joint]), size[joint], who[joint], window)
        least[at, : found.shape[1]] = found
    flags = least[index] < who[:, None]
    some = flags.any(axis=1)
    return shared[some], flags[some]


def _merged(spans: np.ndarray):
    """(doc, key) and their spans with overlapping and touching ones merged: rows, ends, spans."""
    spans = spans[np.lexsort((spans["start"], spans["key"], spans["doc"]))]
    new = np.ones(len(spans), bool)
    new[1:] = (spans["doc"][1:] != spans["doc"][:-1]) | (spans["key"][1:] != spans["key"][:-1])
    # Ends grow along a document's spans; an offset per document keeps them apart.
    shift = (np.cumsum(new) - 1) << 32
    reach = np.maximum.accumulate(spans["end"] + shift)
    opens = np.ones(len(spans), bool)
    opens[1:] = spans["start"][1:] + shift[1:] > reach[:-1]
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(spans)) - 1
    start, end = spans["start"][first], (reach[last] - shift[last]).astype(np.int32)
    head = np.flatnonzero(new[first])
    tail = np.append(head[1:], len(first))
    keys = zip(spans["doc"][first[head]].tolist(), spans["key"][first[head]].tolist())
    return {k: (start[a:b], end[a:b]) for k, a, b in zip(keys, head.tolist(), tail.tolist())}


def _cut(left: pa.Table, right: pa.Table) -> pa.Table:
    """A group's documents without their spans."""
    ids, data, where = _texts_of(left)
    spans = [_unpacked(v, _SPAN) for v in right.column("spans").to_pylist()]
    merged = _merged(np.concatenate(spans)) if spans else {}
    none, starts, ends, kept = np.empty(0, np.int32), [], [], []
    for doc_id, a, b in zip(ids.tolist(), where.tolist(), where[1:].tolist()):
        text, parts, at = data[a:b], [], 0
        start, end = merged.get((doc_id, text_key(text)), (none, none)) if merged else (none, none)
        for s, e in zip(start.tolist(), end.tolist()):
            parts.append(text[at:s])
            at = e
        starts.append(start)
        ends.append(end)
        kept.append(b"".join([*parts, text[at:]]))
    offsets = pa.array(np.cumsum([0, *map(len, starts)]).astype(np.int32))
    columns = [
        pa.array(ids),
        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(starts).astype(np.int32))),
        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ends).astype(np.int32))),
        pa.array(np.diff(where)),
        pa.array(kept, pa.binary()),
    ]
    return pa.table(columns, names=[c.split()[0] for c in _CUT.split(", ")])


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, block: int = BLOCK_BYTES, bucket: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, starts, ends (bytes removed), n_bytes, kept (the other bytes), a row per document.

    Removed are the bytes covered by a string of `window` bytes that a document with a smaller
    doc_id has too. Texts are cut into overlapping strings by anchors (`pieces_of`), so that equal
    windows meet in one bucket, whatever documents they are in:

    1. Anchors are gathered by bucket; those of more than one document go back to the groups of
       documents that have them.
    2. A group sends the strings with such anchors, each once with the places it has in the
       group's smallest document. So a passage that is in a third of all documents reaches its
       bucket once per group.
    3. A bucket builds the Burrows-Wheeler transform of its strings column by column, with common
       prefixes, in external files (`collection_bwt`): equal windows are runs of entries. Their
       smallest document keeps them, spans in others go back to the groups and are merged.

    Null texts count as empty, texts shorter than `window` stay. Rows with the same doc_id keep
    their own texts and do not remove each other's; a null doc_id counts as the smallest long. An
    empty table gives an empty result.
    """
    docs = texts(docs)
    size = text_bytes(docs)
    buckets, parts = buckets_for(size, bucket), buckets_for(size, block)
    anchors = docs.mapInArrow(_anchors(buckets, parts, window, gram, block), _ANCHORS)
    shared = anchors.groupBy("bucket").applyInArrow(_shared_anchors(parts), _SHARED)
    grouped = docs.mapInArrow(_grouped(parts, block), _TEXTS)
    strings = grouped.groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(_strings(buckets, window, gram), _PIECES)
    spans = strings.groupBy("bucket").applyInArrow(_shared(window, gram, parts), _SPANS)
    again = docs.mapInArrow(_grouped(parts, block), _TEXTS)
    return again.groupBy("part").cogroup(spans.groupBy("part")).applyInArrow(_cut, _CUT)
