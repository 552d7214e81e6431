"""Every registered query against its SQL twin, and the shape of the plans."""

import re

import pytest

import __spark_entry__ as contract
import check
from wardline.operators import report_sets
from wardline.plans import oracles, queries
from wardline.sources import testdata as td

# Nodes that would run Python per row, pair everything with everything, or gather rows.
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct")
FITTED = {
    "rf_predictions", "kmeans_clusters", "risk_drivers", "email_scores", "ip_scores", "ml_report", "ml_report_recent", "cluster_breakdown",
    "rf_distribution", "anomaly_rate", "stream_scored", "stream_trend_model",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return check.connect(sf_dir)


def test_names():
    assert set(oracles.ORACLES) | FITTED == set(queries.REGISTRY)
    assert not set(oracles.ORACLES) & FITTED
    assert set(queries.REGISTRY) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_equals_its_sql_twin(spark, duck, sf_dir, name):
    assert check.compare(spark, duck, sf_dir, name, contract.oracle_sql()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 4


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", sorted(n for n in queries.REGISTRY if not n.startswith("stream"))
)
def test_plans_stay_in_the_jvm_and_partitioned(spark, sf_dir, name):
    plan = plan_of(contract.queries()[name](spark, sf_dir))
    assert not [node for node in FORBIDDEN if node in plan]
    assert "BroadcastNestedLoopJoin" not in plan
    windows = re.findall(r"Window \[.*?\]\n", plan)
    assert all("windowspecdefinition(ip" in w for w in windows)


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = plan_of(td.reports(spark, sf_dir))
    assert "l_linenumber" not in plan and "l_returnflag" not in plan
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan
    assert "o_orderpriority" not in plan_of(td.breaches(spark, sf_dir))
    recent = plan_of(td.table(spark, sf_dir, "events").filter("user_id = 5").select("ts"))
    assert "EqualTo(user_id,5)" in recent and "props" not in recent


def test_score_queries_read_no_owner_tables(spark, sf_dir):
    for name in ("stats_overview", "level_distribution", "events_per_minute", "score_trend"):
        plan = plan_of(queries.REGISTRY[name](spark, sf_dir))
        assert "events.parquet" in plan and "customer.parquet" not in plan


def test_newest_rows_are_a_top_k(spark, sf_dir):
    for name in ("replay_events", "score_trend", "recent_with_timestamp"):
        assert "TakeOrderedAndProject" in plan_of(queries.REGISTRY[name](spark, sf_dir))


def test_first_seen_reduces_before_the_shuffle(spark, sf_dir):
    plan = plan_of(queries.first_seen_ip(spark, sf_dir))
    assert plan.index("Exchange hashpartitioning(ip") < plan.index("partial_min")


def test_category_ranking_cuts_before_the_shuffle(spark, sf_dir):
    plan = plan_of(queries.ip_report_categories(spark, sf_dir))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_lines_of_few_asked_ips_are_not_shuffled(spark, sf_dir):
    """Their orders are few, however many orders there are."""
    asked = td.signals(spark, sf_dir).select("ip").distinct().orderBy("ip").limit(3)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        payloads = td.reputation_payloads(spark, sf_dir, asked)
        assert "hashpartitioning(report_id" not in plan_of(payloads)
        found = {r.ip: r.payload for r in payloads.collect()}
        every = {r.ip: r.payload for r in td.reputation_payloads(spark, sf_dir).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(found) == 3 and found.items() <= every.items()


def test_report_words_carry_the_time_of_a_report_once(spark, sf_dir):
    words = report_sets.report_words(td.reports(spark, sf_dir))
    assert words.filter("kind > 0 and last_reported is not null").count() == 0
    assert words.filter("kind = 0 and last_reported is null").count() == 0
