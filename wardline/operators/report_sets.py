"""Exact distinct counts of reports as mergeable sets of 64-bit words.

The set of the whole numbers seen for a key is kept as rows (word, bits): `word` is the number
without its six lowest bits, `bits` has a bit for each number of that word. Words merge by
`bit_or` in any order, so sets of days add up to that of a period, and a set's size is a sum of bit
counts. State is one long per row, which Spark aggregates by hash; its own bitmap aggregates hold 4 KB
for each group, however few numbers are in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Distinct counts of the reports of an ip: result column and counted column.
COUNTED = {"total_reports": "report_id", "distinct_users": "reporter_id", "category_count": "category"}
CATEGORY = list(COUNTED).index("category_count")


def word_of(value: Column) -> Column:
    return F.shiftright(value.cast("bigint"), 6)


def bit_of(value: Column) -> Column:
    low = value.cast("bigint").bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), low)


def report_words(reports: DataFrame, *by: str, key: str = "ip") -> DataFrame:
    """(key, *by, kind, word, bits, last_reported): the sets of each ip, `kind` numbering COUNTED.

    Ids must be whole numbers; a null one is in no set, but its report keeps its ip and time. Tasks
    combine the words of their reports before the shuffle. `key` may name another column than the ip.
    """
    listed = [F.struct(F.lit(i).alias("kind"), F.col(c).cast("bigint").alias("value")) for i, c in enumerate(COUNTED.values())]
    values = reports.select(key, *by, "reported_at", F.inline(F.array(*listed)))
    keys = (key, *by, "kind", word_of(F.col("value")).alias("word"))
    bits = F.coalesce(F.bit_or(bit_of(F.col("value"))), F.lit(0).cast("bigint"))
    # Each report is in the first kind of set, so its time travels there alone.
    newest = F.max(F.when(F.col("kind") == 0, F.col("reported_at")))
    return values.groupBy(*keys).agg(bits.alias("bits"), newest.alias("last_reported"))


def merge_words(words: DataFrame) -> DataFrame:
    """One row per (ip, kind, word) of sets that may have come in parts."""
    return words.groupBy("ip", "kind", "word").agg(F.bit_or("bits").alias("bits"), F.max("last_reported").alias("last_reported"))


def rollup_words(words: DataFrame, *more: Column, key: str = "ip") -> DataFrame:
    """Sizes of an ip's sets and its newest report; `more` aggregates are added."""
    size = lambda i: F.sum(F.when(F.col("kind") == i, F.bit_count("bits")).otherwise(0))
    first, *rest = [size(i).cast("bigint").alias(name) for i, name in enumerate(COUNTED)]
    counts = [first, *rest[:-1], F.max("last_reported").alias("last_reported"), *rest[-1:]]
    return words.groupBy(key).agg(*counts, *more)


def category_set(limit: int) -> Column:
    """Aggregate: the categories of an ip as the bits of one number, for codes below `limit` <= 64."""
    if not 0 < limit <= 64:
        raise ValueError("codes must lie below 64")
    own = (F.col("kind") == CATEGORY) & (F.col("word") == 0)
    return F.coalesce(F.bit_or(F.when(own, F.col("bits"))), F.lit(0).cast("bigint")).alias("codes")
