"""Readers of stored service payloads: one JSON text column in, typed columns out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline import schemas
from wardline.functions import fixed_values as fv
from wardline.functions.rules import lat_lon, no_nulls, or_default


def read_payload_files(spark, path: str, key: str) -> DataFrame:
    """Text files of JSON objects, one per line, as `(key, payload)` rows."""
    lines = spark.read.text(path).withColumnRenamed("value", "payload")
    return lines.select(F.get_json_object("payload", f"$.{key}").alias(key), "payload")


def reputation_data(payload: Column) -> Column:
    return F.from_json(payload, schemas.REPUTATION_PAYLOAD)["data"]


def breach_metrics(payload: Column) -> Column:
    """Breach counts by kind of leak; all zero when the payload has none."""
    metrics = F.from_json(payload, schemas.BREACH_METRICS_PAYLOAD)["BreachMetrics"]
    return F.struct(
        *[or_default(metrics[k], 0).alias(k) for k in ("passwords", "credit_cards", "ssn")]
    )


def breach_names(payload: Column) -> Column:
    """Breach names of one payload, whichever of the three envelopes holds them.

    An envelope that is empty or falsy gives way to the next one. A list of lists
    stands for its first inner list only.
    """
    document = F.try_parse_json(payload)
    empty_forms = ("{}", "null", "[]", '""', "0", "0.0", "false")

    def envelope(key: str) -> Column:
        found = F.try_variant_get(document, f"$.{key}", "variant")
        return F.when(~F.to_json(found).isin(*empty_forms), found)

    holder = F.coalesce(*[envelope(key) for key in fv.BREACH_ENVELOPES], document)
    inner = F.try_variant_get(holder, "$.breaches[0]", "array<string>")
    outer = F.try_variant_get(holder, "$.breaches", "array<string>")
    return no_nulls(F.coalesce(inner, outer))


# Rank of a geolocation candidate; the lowest rank wins.
PRIMARY, FALLBACK, NO_ANSWER = 0, 1, 2


def primary_geo(payloads: DataFrame, key: str = "ip", payload: str = "payload") -> DataFrame:
    """Candidates of the primary geolocation service; only a success is an answer.

    Failures are ranked, not filtered: a filter would be pushed below the parse and so
    parse every payload twice.
    """
    g = F.from_json(F.col(payload), schemas.GEO_PRIMARY_PAYLOAD)
    success = F.col("g.status") == "success"
    return payloads.select(key, g.alias("g")).select(
        key,
        F.when(success, PRIMARY).otherwise(NO_ANSWER).alias("rank"),
        *[F.col(f"g.{c}").alias(c) for c in schemas.GEO_COLUMNS],
    )


def fallback_geo(payloads: DataFrame, key: str = "ip", payload: str = "payload") -> DataFrame:
    """Candidates of the fallback service under the primary service's names.

    A payload whose location is not two numbers is no answer.
    """
    g = F.from_json(F.col(payload), schemas.GEO_FALLBACK_PAYLOAD)
    lat, lon = lat_lon(F.col("g.loc"))
    text = {
        "country": "country", "countryCode": "country", "city": "city", "regionName": "region",
        "timezone": "timezone", "isp": "org", "org": "org", "as": "org", "asname": "org",
    }
    columns = {name: or_default(F.col(f"g.{field}"), "") for name, field in text.items()}
    columns |= {"lat": lat, "lon": lon}
    columns |= {name: F.lit(False) for name in ("hosting", "proxy", "mobile")}
    valid = F.col("g").isNotNull() & lat.isNotNull() & lon.isNotNull()
    return payloads.select(key, g.alias("g")).select(
        key,
        F.when(valid, FALLBACK).otherwise(NO_ANSWER).alias("rank"),
        *[columns[c].alias(c) for c in schemas.GEO_COLUMNS],
    )
