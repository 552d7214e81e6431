"""E-mail breach checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions import fixed_values as fv
from wardline.functions import rules
from wardline.functions.rules import no_nulls, or_default
from wardline.operators.dedup import first_per_key
from wardline.sources.payloads import breach_metrics, breach_names


def check_emails(
    requests: DataFrame, payloads: DataFrame, analytics: DataFrame | None = None
) -> DataFrame:
    """One breach record per requested e-mail; an e-mail without payload is not breached.

    Every side is reduced to one row per e-mail, so all joins share one partitioning and
    none has a hot key.
    """
    asked = requests.select("email").filter("email is not null").distinct()
    found = first_per_key(payloads.select("email", "payload"), ["email"], ["payload"])
    joined = asked.join(
        found.select(
            "email", breach_names(F.col("payload")).alias("_names"), F.lit(True).alias("_found")
        ),
        "email",
        "left",
    )
    if analytics is None:
        joined = joined.withColumn("analytics", breach_metrics(F.lit(None).cast("string")))
    else:
        metrics = first_per_key(analytics.select("email", "payload"), ["email"], ["payload"])
        joined = joined.join(
            metrics.select("email", breach_metrics(F.col("payload")).alias("analytics")),
            "email",
            "left",
        )
        # A not-found e-mail gets the zero record: the analytics are not asked for.
        joined = joined.withColumn("analytics", F.when(F.col("_found"), F.col("analytics")))
    return breach_records(joined)


def breach_records(named: DataFrame) -> DataFrame:
    """Score rows of (email, _names, analytics)."""
    names = no_nulls(F.col("_names"))
    count = F.size(names)
    score = rules.breach_score(count)
    analytics = F.col("analytics")
    return named.select(
        F.lit(fv.BREACH_SOURCE).alias("source"),
        "email",
        (count > 0).alias("breached"),
        count.alias("breach_count"),
        F.transform(names, lambda n: F.struct(n.alias("Name"))).alias("breaches"),
        score.alias("threat_score"),
        rules.score_to_level(score).alias("threat_level"),
        F.struct(
            *[
                or_default(analytics[kind], 0).alias(kind)
                for kind in ("passwords", "credit_cards", "ssn")
            ]
        ).alias("analytics"),
    )


def unbreached(requests: DataFrame, breaches: DataFrame) -> DataFrame:
    """Requested e-mails without any breach. Breach rows are reduced per e-mail first."""
    hit = breaches.select("email").distinct()
    return requests.select("email").distinct().join(hit, "email", "left_anti")


def unbreached_by_kind(requests: DataFrame, leaks: DataFrame, kinds: list[str]) -> DataFrame:
    """(kind, email): requested e-mails that no breach leaked that kind of data of.

    `leaks` has (email, kind). Every e-mail is listed once per kind, and the pairs that leaked are
    taken out by an anti join on both columns, reduced before the shuffle.
    """
    asked = requests.select("email").distinct()
    every = asked.select(F.explode(F.array(*map(F.lit, kinds))).alias("kind"), "email")
    hit = leaks.select("kind", "email").distinct()
    return every.join(hit, ["kind", "email"], "left_anti")
