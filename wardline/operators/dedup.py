"""Deduplication and first observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in `order`; nulls last, ties settled by row content.

    One aggregate: each task reduces a key to one row before the shuffle, so a hot key
    costs no more than any other.
    """
    rest = [c for c in df.columns if c not in (*keys, *order)]
    ranks = [r for i, c in enumerate(order) for r in (F.col(c).isNull().alias(f"_n{i}"), c)]
    first = F.min(F.struct(*ranks, *rest)).alias("_first")
    rows = df.groupBy(*keys).agg(first)
    return rows.select(*[c if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def _digest(df: DataFrame) -> Column:
    return F.sha2(F.to_json(F.struct(*df.columns)), 256)


def identity_key(df: DataFrame, id_column: str = "id") -> Column:
    """The id as text, or a digest of the whole row where there is none."""
    return F.coalesce(F.col(id_column).cast("string"), _digest(df))


def dedup_events(events: DataFrame, id_column: str = "id", ts: str = "ts") -> DataFrame:
    """One row per event id, the earliest; rows without an id are compared as a whole.

    Ids are grouped in their own type; only rows without one are grouped by a digest.
    """
    known, nameless = F.col(id_column).isNotNull(), F.col(id_column).isNull()
    first = first_per_key(events.filter(known), [id_column], [ts])
    whole = events.filter(nameless).withColumn("_key", _digest(events))
    return first.unionByName(first_per_key(whole, ["_key"], [ts]).drop("_key"))


def first_seen(events: DataFrame, key: str = "ip", ts: str = "ts", id_column: str = "id"):
    """First observation of each key."""
    return first_per_key(events.filter(F.col(key).isNotNull()), [key], [ts, id_column])
