"""Document fingerprints: a homomorphic hash of the multiset of a text's paragraphs.

A paragraph is what lies between line feeds. Its vector has WHOLE lanes of 64 bits, the digest of
its bytes, and PARTS lanes of 32 bits, in which each window of its bytes counts +1 or -1 in one
lane. A fingerprint is the sum of its paragraphs' vectors modulo 2**64 and 2**32, so paragraphs may
come in any order, and inserting or deleting one adds or subtracts its vector.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import buckets_for, buffer, documents_of, longs, stage, texts

WHOLE = 8
PARTS = 128
# Bytes of a window, of one in a shorter paragraph, and from which length the long ones are used.
WINDOW, SHORT, LONG_FROM = 16, 4, 24
# Odd factors that mix window bytes.
MIX = tuple(np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
# Bytes of text a worker holds at a time, positions it hashes at a time, rows of a block.
BLOCK = 4 << 20
CHUNK = 1 << 19
BLOCK_ROWS = 4096
# Bytes of text of one range of documents.
RANGE_BYTES = 32 << 20


def _window_sums(data: bytes, start, end, owner, out: np.ndarray) -> None:
    """Adds the windows of all paragraphs to the lanes of their owners."""
    size = end - start
    wide = np.where(size >= LONG_FROM, WINDOW, np.clip(size, 1, SHORT))
    padded = data + bytes(2 * WINDOW)
    for low in range(0, len(data), CHUNK):
        high = min(low + CHUNK, len(data))
        a, b = np.searchsorted(end, low, "right"), np.searchsorted(start, high, "left")
        s, e = np.maximum(start[a:b], low), np.minimum(end[a:b] - wide[a:b] + 1, high)
        many = np.maximum(e - s, 0)
        at = np.arange(many.sum()) + np.repeat(s - low - (np.cumsum(many) - many), many)
        if not len(at):
            continue
        width = np.repeat(wide[a:b], many)
        words = np.empty((high - low + 16) // 8 * 8, np.uint64)
        for k in range(8):
            own = words[k::8]
            own[:] = np.frombuffer(padded, "<u8", len(own), low + k)
        first, second = words[at], words[at + 8]
        mask = (np.uint64(1) << (8 * np.minimum(width, 7)).astype(np.uint64)) - np.uint64(1)
        long = width == WINDOW
        first = np.where(long, first, first & mask) * MIX[0]
        second = np.where(long, second, width.astype(np.uint64)) * MIX[1]
        h = first ^ (second >> np.uint64(31)) ^ (second << np.uint64(7))
        h ^= h >> np.uint64(29)
        h *= MIX[2]
        h ^= h >> np.uint64(32)
        h *= MIX[0]
        sign = ((h >> np.uint64(40)) & np.uint64(1)).astype(np.float64) * 2 - 1
        base = int(owner[a])
        lane = (np.repeat(owner[a:b], many) - base) * PARTS + (h >> np.uint64(57)).astype(np.int64)
        rows = int(owner[b - 1]) - base + 1
        counted = np.bincount(lane, sign, rows * PARTS).astype(np.int64).reshape(rows, PARTS)
        out[base : base + rows] += counted.astype(np.uint32)


def fingerprints_of(data: bytes, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both parts of the fingerprints of the texts `data[where[i]:where[i + 1]]`, which lie end to end."""
    breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    inside = np.diff(np.searchsorted(breaks, where)) + 1
    owner = np.repeat(np.arange(len(where) - 1), inside)
    start = np.sort(np.concatenate([where[:-1], breaks + 1]))
    end = np.sort(np.concatenate([where[1:], breaks]))
    view, digest = memoryview(data), hashlib.blake2b
    digests = b"".join([digest(view[a:b]).digest() for a, b in zip(start.tolist(), end.tolist())])
    lanes = np.frombuffer(digests, "<u8").reshape(-1, WHOLE)
    firsts = np.cumsum(inside) - inside
    whole = np.add.reduceat(lanes, firsts, axis=0) if len(firsts) else lanes
    parts = np.zeros((len(where) - 1, PARTS), np.uint32)
    _window_sums(data, start, end, owner, parts)
    return whole, parts


def _joined(pieces) -> tuple[bytes, np.ndarray]:
    """Texts given as lists of byte strings, end to end, and where each begins."""
    whole = [b"".join(p) for p in pieces]
    return b"".join(whole), np.cumsum([0, *map(len, whole)])


def encode(whole: np.ndarray, parts: np.ndarray) -> list[str]:
    both = np.concatenate([whole.astype("<u8").view(np.uint8), parts.astype("<u4").view(np.uint8)], axis=1)
    return [base64.b64encode(row.tobytes()).decode() for row in both]


def decode(fingerprints: list[str]) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(b"".join(map(base64.b64decode, fingerprints)), np.uint8).reshape(len(fingerprints), -1)
    return rows[:, : 8 * WHOLE].copy().view("<u8"), rows[:, 8 * WHOLE :].copy().view("<u4")


def fingerprint(text: str) -> str:
    data = text.encode()
    return encode(*fingerprints_of(data, np.array([0, len(data)])))[0]


def _changed(fingerprint_: str, paragraph: str, sign: int) -> str:
    whole, parts = decode([fingerprint_])
    w, p = decode([fingerprint(paragraph)])
    return encode(whole + w, parts + p)[0] if sign > 0 else encode(whole - w, parts - p)[0]


def insert(fingerprint_: str, paragraph: str) -> str:
    """The fingerprint with one more paragraph, or with the paragraphs of a piece of text."""
    return _changed(fingerprint_, paragraph, 1)


def delete(fingerprint_: str, paragraph: str) -> str:
    return _changed(fingerprint_, paragraph, -1)


def likeness(a, b) -> np.ndarray:
    """0 to 1 for each pair of fingerprints: 1 for equal ones, else the cosine of their window counts.

    Lanes count as numbers around zero. Texts without a common window come out near 0, with an
    error of about PARTS ** -0.5.
    """
    same = (a[0] == b[0]).all(axis=1) & (a[1] == b[1]).all(axis=1)
    x, y = (v[1].astype(np.uint32).view(np.int32).astype(np.float64) for v in (a, b))
    size = np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
    cosine = (x * y).sum(axis=1) / np.where(size > 0, size, 1)
    return np.where(same, 1.0, np.clip(cosine, 0, 1))


def fingerprint_texts(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every whole text; null counts as empty, the one empty paragraph.

    Texts with the same paragraphs in another order have the same fingerprint. Rows that share a
    doc_id, or have none (the smallest long), are rows of their own; an empty table gives none.
    """

    def run(batches):
        for ids, data, where in documents_of(batches, BLOCK):
            rows = encode(*fingerprints_of(data, where))
            yield pa.record_batch([pa.array(ids), pa.array(rows, pa.string())], names=["doc_id", "fingerprint"])

    return texts(docs).mapInArrow(run, "doc_id long, fingerprint string")


def points(data: memoryview) -> int:
    """Code points of UTF-8 bytes, counted a chunk at a time."""
    view = np.frombuffer(data, np.uint8)
    return sum(int(np.count_nonzero((view[i : i + CHUNK] & 0xC0) != 0x80)) for i in range(0, len(view), CHUNK))


def byte_of(data: memoryview, point: int) -> int:
    """The byte at which a code point starts; the end if there are not so many."""
    view = np.frombuffer(data, np.uint8)
    for low in range(0, len(view), CHUNK):
        first = (view[low : low + CHUNK] & 0xC0) != 0x80
        many = int(np.count_nonzero(first))
        if point < many:
            return low + int(np.flatnonzero(first)[point])
        point -= many
    return len(view)


def _edited_rows(rows: list[tuple[int, bytes, int]], following: bytes) -> pa.RecordBatch:
    """Results of rows (doc_id, text, copies) in order; `following` is the text after the last.

    All but one of equal copies are followed by themselves. The edited fingerprint is the text's
    own, less the paragraphs from the cut on, plus those that take their place.
    """
    ids, data, times = [], [], []
    for doc_id, text, copies in rows:
        for n in ([copies - 1] if copies > 1 else []) + [1]:
            ids.append(doc_id)
            data.append(text)
            times.append(n)
    data.append(following)
    chars, shas, gone, come = [], [], [], []
    for text, after in zip(data, data[1:]):
        n = len(text) if text.isascii() else points(text)
        cut = byte_of(text, n - n // 4) if n // 4 else len(text)
        kept, head = text[:cut], after[: byte_of(after, n // 4)]
        at = kept.rfind(b"\n") + 1
        gone.append([text[at:]])
        come.append([kept[at:], head])
        sha = hashlib.sha256(kept)
        sha.update(head)
        shas.append(sha.hexdigest())
        chars.append(n)
    all_whole, all_parts = fingerprints_of(*_joined([t] for t in data))
    own, after = (all_whole[:-1], all_parts[:-1]), (all_whole[1:], all_parts[1:])
    less, more = fingerprints_of(*_joined(gone)), fingerprints_of(*_joined(come))
    edited = own[0] - less[0] + more[0], own[1] - less[1] + more[1]
    columns = [
        pa.array(ids, pa.int64()),
        pa.array(chars, pa.int64()),
        pa.array(shas, pa.string()),
        pa.array(encode(*own), pa.string()),
        pa.array(encode(*edited), pa.string()),
        pa.array(likeness(own, edited)),
        pa.array(likeness(own, after)),
    ]
    batch = pa.record_batch(columns, names=_EDITED_NAMES)
    if max(times) == 1:
        return batch
    return batch.take(pa.array(np.repeat(np.arange(len(times)), times)))


_EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_EDITED_NAMES = [c.split()[0] for c in _EDITED.split(", ")]
_DEALT = "part int, copied boolean, doc_id long, h long, n long, text binary"


def _deal(firsts: list[tuple[int, int]]):
    """Rows to the range of documents their key lies in; equal rows of a block as one.

    The first row of a range also goes to the range before it, as what follows that one's last row;
    the first of all follows the last of all.
    """

    def run(batches):
        names = [c.split()[0] for c in _DEALT.split(", ")]
        for batch in batches:
            ids, hashes = longs(batch.column(0)).tolist(), longs(batch.column(2)).tolist()
            data, where = buffer(batch.column(1))
            seen: dict = {}
            for i, (a, b) in enumerate(zip(where.tolist(), where[1:].tolist())):
                text = data[a:b].to_pybytes() if b > a else b""
                key = ids[i], hashes[i], text
                seen[key] = seen.get(key, 0) + 1
            rows = []
            for (doc_id, h, text), n in seen.items():
                part = bisect_right(firsts, (doc_id, h)) - 1
                rows.append((part, False, doc_id, h, n, text))
                if firsts[part] == (doc_id, h):
                    rows.append(((part - 1) % len(firsts), True, doc_id, h, 1, text))
            kinds = (pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return run


def _edit(batches):
    """Results of ranges of documents, each in order and ended by the first row of the next."""
    rows: list[tuple[int, bytes, int]] = []
    size, over = 0, None
    for batch in batches:
        parts, copied = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        ids, many = batch.column(2).to_pylist(), batch.column(4).to_pylist()
        data, where = buffer(batch.column(5))
        for i, (a, b) in enumerate(zip(where.tolist(), where[1:].tolist())):
            text = data[a:b].to_pybytes() if b > a else b""
            if copied[i]:
                if parts[i] != over:  # equal first rows of the next range are sent once for each block
                    over = parts[i]
                    yield _edited_rows(rows, text)
                    rows, size = [], 0
                continue
            if rows and rows[-1][0] == ids[i] and rows[-1][1] == text:
                rows[-1] = (*rows[-1][:2], rows[-1][2] + many[i])
                continue
            if size >= BLOCK or len(rows) >= BLOCK_ROWS:
                yield _edited_rows(rows, text)
                rows, size = [], 0
            rows.append((ids[i], text, many[i]))
            size += len(text)


def edited_fingerprints(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and how alike they are.

    Edited: the last quarter of the code points (rounded down) is replaced by as many, or all, of the
    next document by ascending doc_id; the first one follows the last. Rows that share a doc_id
    follow each other by the hash of their texts, and equal rows each other. A null text counts as empty, a
    null doc_id as the smallest long. An empty table gives an empty result; the only row follows
    itself.

    Documents are dealt to ranges of ascending doc_id by bounds taken from all keys, so each text
    is sent once; only the first text of a range is sent to the range before it as well. The bounds
    reach the driver: one key for `range_bytes` of text.
    """
    plain = texts(docs).withColumn("h", F.xxhash64("text"))
    keys = stage(plain.select("doc_id", "h", F.octet_length("text").cast("long").alias("size")), "fingerprint-keys")
    ranges = buckets_for(keys.agg(F.sum("size")).first()[0] or 0, range_bytes)
    dealt = keys.repartitionByRange(ranges, "doc_id", "h").groupBy(F.spark_partition_id().alias("part"))
    firsts = sorted((r.first.doc_id, r.first.h) for r in dealt.agg(F.min(F.struct("doc_id", "h")).alias("first")).collect())
    if not firsts:
        return docs.sparkSession.createDataFrame([], _EDITED)
    ranged = plain.mapInArrow(_deal(firsts), _DEALT).repartitionById(len(firsts), F.col("part"))
    return ranged.sortWithinPartitions("part", "copied", "doc_id", "h").mapInArrow(_edit, _EDITED)
