"""Key lookups that keep working when one key holds a large share of the rows."""

from __future__ import annotations

from collections import OrderedDict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of the mark table, a few MB: a key is only hot with HOT_ROWS rows, so this many hold 1e11.
MAX_HOT_KEYS = 100_000
# Rows of one key that may share a salt.
HOT_ROWS = 1_000_000
PROBE_FRACTION = 0.01
WIDENING = 8
# Estimated bytes of a fact in one task of a plain shuffled join. A session's partitions are merged up to 64 MB
# of packed shuffle data, and the aggregates behind a join need twenty times that in memory.
TASK_BYTES, MAX_TASKS = 1 << 20, 10_000
# Rows without a key match nothing, so any number of salts will do for them.
NULL_SALTS = 1 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes; negative when broadcasts are off."""
    return int(df._jdf.sparkSession().sessionState().conf().autoBroadcastJoinThreshold())


def hot_keys(
    fact: DataFrame,
    key: str,
    hot_rows: int = HOT_ROWS,
    fraction: float = PROBE_FRACTION,
    limit: int = MAX_HOT_KEYS,
) -> list[tuple]:
    """Keys with about `hot_rows` rows or more and the salts each needs, at most `limit` keys.

    A key gets a salt per `hot_rows` rows, so salted groups stay small however much the key
    holds. Only a guide: whichever keys it names, join results are the same. The sample reads
    one column, and its counts are combined before the shuffle.
    """
    sampled = fact.select(key).filter(F.col(key).isNotNull()).sample(fraction, seed=7)
    counts = sampled.groupBy(key).count().filter(F.col("count") >= hot_rows * fraction)
    top = counts.orderBy(F.desc("count")).limit(limit).collect()
    return [(row[0], int(row[1] / fraction / hot_rows) + 2) for row in top]


# Key columns whose hot keys are remembered; the one not asked for longest goes first.
PROBES = 32
_probes: OrderedDict[tuple, list[tuple]] = OrderedDict()


def known_hot_keys(fact: DataFrame, key: str, hot_rows: int, fraction: float) -> list[tuple]:
    """`hot_keys`, looked for once per session, plan of the key column and setting.

    Each batch of a stream is a plan of its own, so only the last PROBES plans are remembered.
    """
    column = fact.select(key)
    name = (fact.sparkSession.sparkContext.applicationId, column.semanticHash(), key, hot_rows, fraction)
    if name not in _probes:
        _probes[name] = hot_keys(column, key, hot_rows, fraction)
        while len(_probes) > PROBES:
            _probes.popitem(last=False)
    _probes.move_to_end(name)
    return _probes[name]


def spread(fact: DataFrame, key: str) -> DataFrame:
    """`fact` dealt by `key` to so many partitions that a task's share does not grow with the input.

    A small one is left to the session's settings.
    """
    tasks = min(estimated_bytes(fact) // TASK_BYTES, MAX_TASKS)
    return fact.repartition(tasks, key) if tasks > fact.sparkSession.sparkContext.defaultParallelism else fact


def _hashable(df: DataFrame) -> list[str]:
    unhashable = (T.MapType, T.VariantType, T.ArrayType, T.StructType)
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, unhashable)]


def salted_lookup(
    fact: DataFrame, dim: DataFrame, key: str, how: str, hot: list[tuple], tasks: int = 0
) -> DataFrame:
    """Join in which each hot key's fact rows are spread over its salts.

    Rows of `dim` are copied for the hot keys only. Fact rows without a key are spread too.
    The salt comes from row content and partition number: a task that runs again gives every
    row the same salt.
    """
    if not hot and how == "inner":
        return spread(fact.filter(F.col(key).isNotNull()), key).join(dim, key, how)
    if hot:
        # At most MAX_HOT_KEYS rows.
        schema = f"`{key}` {fact.schema[key].dataType.simpleString()}, _salts int"
        marks = F.broadcast(fact.sparkSession.createDataFrame(hot, schema))
        salts = F.coalesce(F.col("_salts"), F.lit(1))
        fact, dim = fact.join(marks, key, "left"), dim.join(marks, key, "left")
    else:
        salts = F.lit(1)
    row = F.xxhash64(F.spark_partition_id(), *_hashable(fact))
    share = F.when(F.col(key).isNull(), NULL_SALTS).otherwise(salts)
    salted = fact.withColumn("_salt", F.pmod(row, share).cast("int")).drop("_salts")
    copied = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    if tasks > 1:
        salted = salted.repartition(tasks, key, "_salt")
    return salted.join(copied, [key, "_salt"], how).drop("_salt")


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "left",
    bounded_by: DataFrame | None = None,
    probe: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    fraction: float = PROBE_FRACTION,
    tasks: int = 0,
) -> DataFrame:
    """Join `fact` to `dim`, which has at most one row per key.

    A dim whose size is bounded below the session's broadcast limit is broadcast, and asked to be:
    Catalyst's own estimate of a join or an aggregate is far too high. Otherwise both sides are
    shuffled, hot keys salted. A stream cannot be probed for hot keys: give streams a bounded dim,
    or join their batches.

    `bounded_by`: a scan with at least one row per row of `dim`, for dims whose own estimate
    is useless (joins and aggregates); its size counts WIDENING times. `probe`: a cheaper
    frame with the same keys as `fact`, to look for hot keys in. `tasks`: so many tasks get the facts of a
    left join, and not as few as their bytes ask for, where a row costs far more later.
    """
    limit = broadcast_limit(fact)
    size = estimated_bytes(dim) if bounded_by is None else WIDENING * estimated_bytes(bounded_by)
    if size <= limit:
        return (fact.repartition(tasks) if tasks > 1 else fact).join(F.broadcast(dim), key, how)
    if fact.isStreaming:
        raise ValueError("a stream needs a dim below the broadcast limit; join its batches instead")
    hot = known_hot_keys(fact if probe is None else probe, key, hot_rows, fraction)
    return salted_lookup(fact, dim, key, how, hot, tasks)
