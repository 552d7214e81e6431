"""What the operators of this subpackage share: inputs, staging, text buffers and skew-safe joins."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.sources.store import stage

__all__ = ["stage", "table", "texts", "packed", "text_bytes", "buckets_for", "buffer", "unique_key_join"]

# Whitespace that separates words (space and the five controls from tab to carriage return).
SPACES = b" \t\n\x0b\x0c\r"
# A join key held by more than one row in HEAVY_KEYS is heavy, so there are fewer than this many.
HEAVY_KEYS = 4096
LEAST = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and whole text; a null text counts as empty, a null key as the smallest long."""
    return docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(LEAST)).alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )


def packed(docs: DataFrame, **more: Column) -> DataFrame:
    """Whole rows as one column `row`, beside columns of our own: names of other columns cannot clash.

    `select("row.*")` gives the rows back.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("row"), *[column.alias(name) for name, column in more.items()])


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts: one aggregate over the text column."""
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def buckets_for(size: float, per_bucket: float, least: int = 8) -> int:
    """Buckets so that each holds about `per_bucket`; their number grows with the input."""
    return max(least, math.ceil(size / per_bucket))


def buffer(column: pa.Array) -> tuple[pa.Buffer | None, np.ndarray]:
    """Bytes of an Arrow string or binary column, not copied, and the n + 1 offsets of its values."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    where = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return data, where if data is not None else np.zeros(len(column) + 1, np.int64)


def longs(column: pa.Array) -> np.ndarray:
    """A column of whole numbers; null becomes the smallest long."""
    return column.cast(pa.int64()).fill_null(LEAST).to_numpy(zero_copy_only=False)


def documents_of(batches, limit: int = 16 << 20):
    """(ids, bytes, offsets) of the rows of Arrow batches, at most about `limit` bytes at a time.

    A single longer text comes alone. Only the rows given out are copied, and memory that is free
    again goes back to the system, as workers live on between stages.
    """
    for batch in batches:
        ids = longs(batch.column(0))
        data, where = buffer(batch.column(1))
        start = 0
        while start < len(ids):
            stop = int(np.searchsorted(where, where[start] + limit, "right")) - 1
            stop = min(max(stop, start + 1), len(ids))
            first, last = int(where[start]), int(where[stop])
            block = data.slice(first, last - first).to_pybytes() if data is not None else b""
            yield ids[start:stop], block, where[start : stop + 1] - first
            start = stop
        del batch, data
        pa.default_memory_pool().release_unused()


def crc_mod(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def unique_key_join(facts: DataFrame, dim: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Inner join of `facts` with `dim`, whose `key` is unique and whose `weight` counts its facts.

    Keys with more than one in HEAVY_KEYS of all facts are fewer than HEAVY_KEYS, whatever the
    data: these rows of `dim` are broadcast, so their facts stay where they are. Of the other keys
    none is large, and both sides are shuffled. Give staged frames: each is read twice.
    """
    heavy = F.col(weight) * HEAVY_KEYS > total
    hot = F.broadcast(dim.filter(heavy))
    cold = facts.join(F.broadcast(dim.filter(heavy).select(key)), key, "left_anti")
    return facts.join(hot, key).unionByName(cold.join(dim.filter(~heavy), key))
