"""IP geolocation and network risk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline import schemas
from wardline.functions import fixed_values as fv
from wardline.functions import rules
from wardline.functions.rules import or_default
from wardline.sources.payloads import NO_ANSWER, PRIMARY, fallback_geo, primary_geo


def best_geo(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """One candidate per ip, whole rows: the primary's if it answered, else the fallback's.

    Both services are stacked and reduced in one aggregate instead of joined in turn.
    """
    best = F.min(F.struct("rank", *schemas.GEO_COLUMNS)).alias("g")
    found = primary.unionByName(fallback).groupBy("ip").agg(best)
    return found.select("ip", F.when(F.col("g.rank") < NO_ANSWER, F.col("g")).alias("g"))


def geolocate(requests: DataFrame, primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """Risk-scored geolocation for each requested ip, from two tables of payloads."""
    asked = requests.select("ip").filter("ip is not null").distinct()
    found = best_geo(primary_geo(primary), fallback_geo(fallback))
    return enrich(asked.join(found, "ip", "left"))


def enrich(located: DataFrame) -> DataFrame:
    """Defaults, risk, flag and network columns for rows of (ip, g)."""
    g = F.col("g")
    code = or_default(g["countryCode"], "")
    risk = rules.geo_risk(code)
    suspicious = rules.asn_suspicious(g["isp"], g["asname"])
    return located.select(
        "ip",
        or_default(g["country"], "Unknown").alias("country"),
        code.alias("country_code"),
        rules.flag(code).alias("flag"),
        or_default(g["city"], "").alias("city"),
        or_default(g["regionName"], "").alias("region"),
        or_default(g["lat"], 0.0).alias("lat"),
        or_default(g["lon"], 0.0).alias("lon"),
        or_default(g["timezone"], "").alias("timezone"),
        or_default(g["isp"], "Unknown").alias("isp"),
        or_default(g["org"], "").alias("org"),
        or_default(g["as"], "").alias("asn"),
        or_default(g["asname"], "").alias("asn_name"),
        or_default(g["hosting"], False).alias("is_hosting"),
        or_default(g["proxy"], False).alias("is_proxy"),
        or_default(g["mobile"], False).alias("is_mobile"),
        suspicious.alias("asn_suspicious"),
        risk.alias("geo_risk"),
        rules.geo_risk_score(risk, suspicious).alias("geo_risk_score"),
        F.lit(fv.GEO_SOURCE).alias("source"),
        F.when(g.isNull(), "none")
        .when(g["rank"] == PRIMARY, "primary")
        .otherwise("fallback")
        .alias("geo_source"),
    )


def risk_summary(geo: DataFrame) -> DataFrame:
    return geo.groupBy("geo_risk", "asn_suspicious").agg(
        F.count(F.lit(1)).alias("n"), F.max("geo_risk_score").alias("max_score")
    )
