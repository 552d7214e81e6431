"""The eleven model features as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardline.functions import fixed_values as fv
from wardline.functions.rules import model_country_weight, no_nulls, or_default


def _flag(condition: Column) -> Column:
    return or_default(condition, False).cast("double")


def _clipped(count: Column, clip: int) -> Column:
    return F.least(or_default(count, 0), F.lit(clip)).cast("double") / F.lit(float(clip))


def _mentions(categories: Column, *words: str) -> Column:
    def hit(category: Column) -> Column:
        text = F.lower(category)
        found = text.contains(words[0])
        for word in words[1:]:
            found = found | text.contains(word)
        return found

    return _flag(F.exists(categories, hit))


def ip_features(
    score="threat_score",
    reports="total_reports",
    users="distinct_users",
    tor="is_tor",
    vpn="is_vpn",
    categories="recent_categories",
    country="country",
) -> list[Column]:
    cats = no_nulls(F.col(categories))
    values = (
        or_default(F.col(score), 0).cast("double") / F.lit(100.0),
        _clipped(F.col(reports), fv.REPORTS_CLIP),
        _clipped(F.col(users), fv.USERS_CLIP),
        _flag(F.col(tor)),
        _flag(F.col(vpn)),
        _clipped(F.size(cats), fv.CATEGORIES_CLIP),
        _mentions(cats, "brute", "ssh"),
        _mentions(cats, "ddos"),
        _mentions(cats, "scan"),
        _mentions(cats, "inject", "sqli"),
        model_country_weight(F.col(country)),
    )
    return [value.alias(name) for name, value in zip(fv.FEATURES, values)]


def email_features(
    score="threat_score",
    breaches="breach_count",
    passwords="analytics.passwords",
    cards="analytics.credit_cards",
    ssn="analytics.ssn",
) -> list[Column]:
    values = [
        or_default(F.col(score), 0).cast("double") / F.lit(100.0),
        _clipped(F.col(breaches), fv.BREACHES_CLIP),
        *[_flag(F.col(leak) > 0) for leak in (passwords, cards, ssn)],
    ]
    values += [F.lit(0.0)] * (len(fv.FEATURES) - len(values))
    return [value.alias(name) for name, value in zip(fv.FEATURES, values)]
