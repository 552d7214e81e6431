"""Exact duplicates: local, salted and global merging of equal texts."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import LEAST, documents_of, packed, stage, texts, unique_key_join

SALTS = 16
_LOCAL = "digest binary, salt int, norm binary, keep_id long, n long"
_MEMBERS = "doc_id long, digest binary, text_sha256 string"


def _schema(spark_schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in spark_schema.split(", ")])


def _local(size: int, salts: int):
    """One row per distinct text of a block of rows: texts are told apart by their content."""

    def merge(batches):
        for ids, data, where in documents_of(batches):
            data, best = data.lower(), {}
            for doc_id, a, b in zip(ids.tolist(), where.tolist(), where[1:].tolist()):
                text = data[a:b]
                keep, n = best.get(text, (doc_id, 0))
                best[text] = (max(keep, doc_id), n + 1)
            digests = [hashlib.sha256(text).digest()[:size] for text in best]
            kept = np.array([keep for keep, _ in best.values()], np.int64)
            columns = [
                pa.array(digests, pa.binary()),
                pa.array((kept % salts).astype(np.int32)),
                pa.array(list(best), pa.binary()),
                pa.array(kept),
                pa.array([n for _, n in best.values()], pa.int64()),
            ]
            yield pa.record_batch(columns, schema=_schema(_LOCAL))

    return merge


def _members(size: int):
    def digests(batches):
        for ids, data, where in documents_of(batches):
            data = data.lower()
            full = [hashlib.sha256(data[a:b]) for a, b in zip(where.tolist(), where[1:].tolist())]
            columns = [
                pa.array(ids),
                pa.array([h.digest()[:size] for h in full], pa.binary()),
                pa.array([h.hexdigest() for h in full], pa.string()),
            ]
            yield pa.record_batch(columns, schema=_schema(_MEMBERS))

    return digests


def exact_groups(docs: DataFrame, digest_bytes: int = 32, salts: int = SALTS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are, after lower-casing A-Z only; null counts as empty. The
    largest doc_id of equal texts stays. Merging has three stages, each comparing whole texts and
    not only digests: within a block of rows, within a salt of a digest, then over the salts. So a
    text copied without end reaches the last stage as at most `salts` rows. Members find their
    group by digest; digests that several texts share (`digest_bytes` below 32 in tests) are
    looked up again by text. An empty table gives an empty result; rows that share a doc_id are
    rows of their own, and a null doc_id counts as the smallest long.
    """
    docs = texts(docs)
    local = docs.mapInArrow(_local(digest_bytes, salts), _LOCAL)

    def merged(keys, frame):
        return frame.groupBy(*keys).agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"))

    salted = merged(["digest", "salt", "norm"], local)
    groups = merged(["digest", "norm"], salted)
    by_digest = stage(
        groups.groupBy("digest").agg(
            F.count("*").alias("texts"), F.max("keep_id").alias("keep_id"), F.sum("n").alias("n")
        ),
        "exact-groups",
    )
    members = stage(docs.mapInArrow(_members(digest_bytes), _MEMBERS), "exact-members")
    figures = by_digest.agg(F.sum("n"), F.max("texts")).first()
    total, shared = figures[0] or 0, (figures[1] or 0) > 1
    found = unique_key_join(members, by_digest.filter("texts = 1"), "digest", "n", total)
    if shared:
        # Different texts under one digest: by content, which for full digests never happens.
        several = by_digest.filter("texts > 1").select("digest")
        whole = docs.mapInArrow(_local_rows(digest_bytes), "doc_id long, digest binary, norm binary")
        whole = whole.join(several, "digest", "left_semi")
        again = whole.join(groups, ["digest", "norm"]).withColumn("texts", F.lit(1))
        again = again.withColumn("text_sha256", F.sha2("norm", 256))
        found = found.unionByName(again.select(*found.columns))
    return found.select(
        "doc_id",
        "keep_id",
        F.col("n").alias("group_size"),
        (F.col("doc_id") == F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def _local_rows(size: int):
    def rows(batches):
        schema = _schema("doc_id long, digest binary, norm binary")
        for ids, data, where in documents_of(batches):
            data = data.lower()
            norm = [data[a:b] for a, b in zip(where.tolist(), where[1:].tolist())]
            digests = [hashlib.sha256(text).digest()[:size] for text in norm]
            yield pa.record_batch(
                [pa.array(ids), pa.array(digests, pa.binary()), pa.array(norm, pa.binary())], schema=schema
            )

    return rows


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, all columns; of rows that are equal in id and text, one stays.

    A null text counts as empty, a null doc_id as the smallest long. Other columns may have any name
    and value. An empty table gives an empty result.
    """
    kept = exact_groups(docs).filter("kept").groupBy("doc_id", "text_sha256").agg(F.count("*").alias("rows"))
    kept = stage(kept, "exact-kept")
    norm = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    doc_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST))
    rows = packed(docs, doc_id=doc_id, text_sha256=F.sha2(norm.cast("binary"), 256))
    rows = rows.join(kept, ["doc_id", "text_sha256"], "left_semi")
    if kept.filter("rows > 1").limit(1).count():
        rows = rows.dropDuplicates(["doc_id", "text_sha256"])
    return rows.select("row.*")
