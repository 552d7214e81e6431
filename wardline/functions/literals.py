"""Constant columns and rows from one expression text each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, float):
        return f"double('{value!r}')"
    if isinstance(value, (list, tuple)):
        return f"array({', '.join(sql_literal(v) for v in value)})"
    if isinstance(value, (bool, int)):
        return str(value)
    return sql_literal(str(value))


def literal_rows(spark: SparkSession, schema: str, rows) -> DataFrame:
    """A few constant rows as a local relation, whose size Catalyst knows exactly."""
    fields = T.StructType.fromDDL(schema).fields
    columns = ", ".join(
        f"CAST(c{i} AS {f.dataType.simpleString()}) AS `{f.name}`" for i, f in enumerate(fields)
    )
    if not rows:
        return spark.createDataFrame([], schema)
    values = ", ".join(f"({', '.join(sql_literal(v) for v in row)})" for row in rows)
    names = ", ".join(f"c{i}" for i in range(len(fields)))
    return spark.sql(f"SELECT {columns} FROM VALUES {values} AS t({names})")


def literal_map(values: dict) -> Column:
    """A constant map, from one expression text: cheaper to build than a literal per entry."""
    pairs = [f"{sql_literal(k)}, {sql_literal(v)}" for k, v in values.items()]
    return F.expr(f"map({', '.join(pairs)})")
