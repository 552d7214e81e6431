"""Scoring and text rules, Column in and Column out, all inside whole-stage codegen."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardline.functions import fixed_values as fv
from wardline.functions.literals import literal_map


def or_default(column: Column, default) -> Column:
    return F.coalesce(column, F.lit(default))


def no_nulls(array: Column, element: str = "string") -> Column:
    return F.coalesce(array, F.array().cast(f"array<{element}>"))


def score_to_level(score: Column) -> Column:
    bands = iter(fv.LEVEL_BANDS)
    level, least = next(bands)
    rule = F.when(score >= least, level)
    for level, least in bands:
        rule = rule.when(score >= least, level)
    return rule.otherwise(fv.DEFAULT_LEVEL)


def is_vpn(usage_type: Column) -> Column:
    return or_default(usage_type.isin(*fv.VPN_USAGE_TYPES), False)


def category_name(code: Column) -> Column:
    known = literal_map(fv.CATEGORY_NAMES)[code]
    return F.coalesce(known, F.concat(F.lit(fv.UNKNOWN_CATEGORY_PREFIX), code.cast("string")))


def recent_categories(codes: Column) -> Column:
    """Names of the lowest distinct category codes, at most six."""
    lowest = F.slice(F.sort_array(F.array_distinct(codes)), 1, fv.MAX_CATEGORIES)
    return F.transform(lowest, category_name)


def report_codes(reports: Column) -> Column:
    """Category codes of nested reports; a missing list counts as empty."""
    codes = F.flatten(F.array_compact(reports["categories"]))
    return no_nulls(F.array_compact(codes), "int")


def _has(categories: Column, *names: str) -> Column:
    return F.arrays_overlap(categories, F.array(*[F.lit(n) for n in names]))


def category_kind(categories: Column) -> Column:
    """The SIGNAL_TEXTS entry that report categories call for, null when they call for none."""
    cats = F.filter(no_nulls(categories), lambda c: c.isNotNull())
    brute = F.exists(cats, lambda c: c.contains("Brute-Force"))
    return (
        F.when(_has(cats, "DDoS Attack"), "ddos")
        .when(brute | _has(cats, "SSH"), "brute_force")
        .when(_has(cats, "Port Scan"), "port_scan")
        .when(_has(cats, "Web App Attack", "SQL Injection"), "web_exploit")
        .when(_has(cats, "Phishing"), "phishing")
    )


def signal_kind(by_category: Column, is_tor: Column, score: Column) -> Column:
    """Which SIGNAL_TEXTS entry describes a signal; categories come first."""
    return F.coalesce(
        by_category,
        F.when(is_tor, "tor")
        .when(score >= fv.CRITICAL_BEACON_SCORE, "critical")
        .otherwise("other"),
    )


def signal_source(kind: Column) -> Column:
    return literal_map({k: source for k, (source, _) in fv.SIGNAL_TEXTS.items()})[kind]


def signal_message(kind: Column, ip: Column) -> Column:
    template = literal_map({k: text for k, (_, text) in fv.SIGNAL_TEXTS.items()})[kind]
    return F.replace(template, F.lit("%s"), or_default(ip, ""))


def ip_event_message(ip: Column, score: Column) -> Column:
    return F.format_string(fv.IP_EVENT_MESSAGE, ip, score)


def email_event_message(email: Column, score: Column) -> Column:
    return F.format_string(fv.EMAIL_EVENT_MESSAGE, email, score)


def breach_score(count: Column) -> Column:
    points = F.least(count * fv.BREACH_POINTS, F.lit(fv.BREACH_CAP))
    floor = F.lit(0)
    for least, value in reversed(fv.BREACH_FLOORS):
        floor = F.when(count >= least, value).otherwise(floor)
    return F.greatest(points, floor).cast("int")


def model_country_weight(country: Column) -> Column:
    weights = fv.MODEL_COUNTRY_WEIGHTS
    return (
        F.when(country.isin(*fv.MODEL_HIGH_COUNTRIES), weights["high"])
        .when(country.isin(*fv.MODEL_MEDIUM_COUNTRIES), weights["medium"])
        .otherwise(weights["other"])
    )


def geo_risk(country: Column) -> Column:
    return (
        F.when(country.isin(*fv.GEO_HIGH_COUNTRIES), "high")
        .when(country.isin(*fv.GEO_MEDIUM_COUNTRIES), "medium")
        .otherwise("low")
    )


def asn_suspicious(isp: Column, asname: Column) -> Column:
    text = F.lower(F.concat_ws(" ", or_default(isp, ""), or_default(asname, "")))
    return reduce(or_, [text.contains(word) for word in fv.ASN_KEYWORDS])


def geo_risk_score(risk: Column, suspicious: Column) -> Column:
    base = literal_map(fv.GEO_RISK_SCORES)[risk]
    return F.when(suspicious, F.least(base + fv.ASN_UPLIFT, F.lit(100))).otherwise(base)


def flag(country: Column) -> Column:
    return F.coalesce(literal_map(fv.COUNTRY_FLAGS)[country], F.lit(fv.NO_FLAG))


def lat_lon(loc: Column) -> tuple[Column, Column]:
    """Both numbers of a "lat,lon" text; null where the text is not a number."""
    parts = F.split(or_default(loc, "0,0"), ",")
    return F.get(parts, 0).try_cast("double"), F.get(parts, 1).try_cast("double")


def adjusted_score(raw: Column, label: Column) -> Column:
    """Blend of the raw score and the weight of the predicted level, cut to 0..100."""
    weight = F.coalesce(literal_map(fv.LEVEL_WEIGHTS)[label], raw).cast("double")
    blend = F.lit(fv.RAW_SHARE) * raw.cast("double") + F.lit(fv.LEVEL_SHARE) * weight
    return F.greatest(F.lit(0), F.least(F.lit(100), blend.cast("int")))


def trend_word(slope: Column) -> Column:
    return (
        F.when(slope > fv.TREND_SLOPE, "rising")
        .when(slope < -fv.TREND_SLOPE, "falling")
        .otherwise("stable")
    )
