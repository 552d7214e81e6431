"""IP reputation: payload normalisation, report rollups, overrides, signal enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.functions import fixed_values as fv
from wardline.functions import rules
from wardline.functions.features import ip_features
from wardline.functions.literals import literal_rows
from wardline.functions.rules import or_default
from wardline.operators.dedup import first_per_key
from wardline.operators.joins import lookup_join
from wardline.operators.report_sets import report_words, rollup_words
from wardline.sources.payloads import reputation_data

COLUMNS = (
    "source", "ip", "threat_score", "threat_level", "country", "isp", "domain", "is_tor",
    "is_vpn", "total_reports", "distinct_users", "recent_categories", "last_reported",
)
# The address that was asked for: the key of a record, as a payload may name another one.
KEY = "requested_ip"


def normalise(payloads: DataFrame, ip: str = "ip", payload: str = "payload") -> DataFrame:
    """Reputation records of `(ip, payload)` rows; a missing payload gives the defaults."""
    d = F.col("d")
    score = or_default(d["abuseConfidenceScore"], 0)
    return payloads.select(F.col(ip).alias(KEY), reputation_data(F.col(payload)).alias("d")).select(
        KEY,
        F.lit(fv.REPUTATION_SOURCE).alias("source"),
        F.coalesce(d["ipAddress"], F.col(KEY)).alias("ip"),
        score.alias("threat_score"),
        rules.score_to_level(score).alias("threat_level"),
        d["countryCode"].alias("country"),
        d["isp"].alias("isp"),
        d["domain"].alias("domain"),
        or_default(d["isTor"], False).alias("is_tor"),
        rules.is_vpn(d["usageType"]).alias("is_vpn"),
        or_default(d["totalReports"], 0).alias("total_reports"),
        or_default(d["numDistinctUsers"], 0).alias("distinct_users"),
        rules.recent_categories(rules.report_codes(d["reports"])).alias("recent_categories"),
        d["lastReportedAt"].alias("last_reported"),
    )


def overrides(spark: SparkSession, now: Column | None = None) -> DataFrame:
    """The fixed records, three rows, reported "now"."""
    schema = (
        "ip string, threat_score int, threat_level string, country string, isp string, "
        "domain string, is_tor boolean, is_vpn boolean, total_reports bigint, "
        "distinct_users bigint, recent_categories array<string>"
    )
    rows = literal_rows(spark, schema, fv.OVERRIDES)
    rows = rows.withColumn("source", F.lit(fv.REPUTATION_SOURCE))
    return rows.withColumn("last_reported", now if now is not None else F.current_timestamp()).select(
        *COLUMNS
    )


def check_ips(requests: DataFrame, payloads: DataFrame, now: Column | None = None) -> DataFrame:
    """One reputation record per requested ip: the fixed one, else the looked-up one.

    Requests are distinct first, so both sides of the join have one row per ip. The first
    payload of an ip counts: by `fetched_at` where the payloads have it.
    """
    asked = requests.select("ip").filter("ip is not null").distinct()
    order = [c for c in ("fetched_at", "payload") if c in payloads.columns]
    first = first_per_key(payloads.select("ip", *order), ["ip"], order)
    looked_up = normalise(asked.join(first, "ip", "left"))
    fixed = overrides(asked.sparkSession, now)
    packed = fixed.select(F.col("ip").alias(KEY), F.struct(*COLUMNS).alias("_fixed"))
    return looked_up.join(F.broadcast(packed), KEY, "left").select(
        KEY,
        *[
            F.when(F.col("_fixed").isNotNull(), F.col(f"_fixed.{c}")).otherwise(F.col(c)).alias(c)
            for c in COLUMNS
        ],
    )


def recent_reports(
    reports: DataFrame, max_age_days: int = fv.REPORT_MAX_AGE_DAYS, asof=None
) -> DataFrame:
    """Reports newer than `max_age_days` before `asof` (default: the newest report)."""
    end = reports.agg(F.max("reported_at")).scalar() if asof is None else F.lit(asof)
    return reports.filter(F.col("reported_at") > end - F.make_dt_interval(F.lit(max_age_days)))


def report_rollup(reports: DataFrame) -> DataFrame:
    """Summary per ip: distinct reports, reporters and categories, and the newest report.

    Distinct ids are kept as sets of words (`report_sets`): one hash aggregate by word, so the
    reports of one hot ip are spread by their ids, and one by ip over far fewer rows.
    """
    return rollup_words(report_words(reports))


def report_categories(reports: DataFrame) -> DataFrame:
    """Names of the lowest distinct category codes per ip, at most six.

    The window runs on distinct (ip, category) rows, and every task passes on at most six
    of them per ip, so no list ever holds more.
    """
    distinct = reports.select("ip", "category").filter("category is not null").distinct()
    rank = F.row_number().over(Window.partitionBy("ip").orderBy("category"))
    lowest = distinct.withColumn("_rank", rank).filter(F.col("_rank") <= fv.MAX_CATEGORIES)
    codes = F.sort_array(F.collect_list("category"))
    return lowest.groupBy("ip").agg(
        F.transform(codes, rules.category_name).alias("recent_categories")
    )


def enrich_signals(
    signals: DataFrame,
    reputation: DataFrame,
    bounded_by: DataFrame | None = None,
    probe: DataFrame | None = None,
    tasks: int = 0,
) -> DataFrame:
    """Signals with the reputation of their ip, their model features and `category_kind`.

    A signal keeps its own score. `reputation` has one row per requested ip, as `check_ips`
    gives it; whatever follows from it alone is worked out here, once per ip and not once
    per signal. `tasks`: see `lookup_join`, for signals that a model scores.
    """
    kept = ("country", "is_tor", "is_vpn", "total_reports", "distinct_users", "recent_categories")
    own, *of_ip = ip_features()
    looked_up = reputation.select(
        F.col(KEY).alias("ip"),
        F.col("threat_score").alias("reputation_score"),
        *kept,
        rules.category_kind(F.col("recent_categories")).alias("category_kind"),
        *of_ip,
    )
    joined = lookup_join(signals.drop(*kept), looked_up, "ip", "left", bounded_by, probe, tasks=tasks)
    absent = dict.fromkeys(fv.FEATURES[1:], 0.0) | {
        fv.FEATURES[-1]: fv.MODEL_COUNTRY_WEIGHTS["other"]
    }
    return joined.withColumns(
        {fv.FEATURES[0]: own, **{f: or_default(F.col(f), value) for f, value in absent.items()}}
    )
