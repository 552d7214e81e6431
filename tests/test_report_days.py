from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wardline.operators import report_sets, reputation
from wardline.sources import report_days

SCHEMA = "ip string, report_id bigint, reporter_id bigint, category int, reported_at timestamp_ntz"
START = datetime(2024, 3, 1)


@pytest.fixture
def reports(spark):
    """Half a year of reports, a third of them of one ip, with nulls, repeats and negative ids."""
    made = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("ip"), F.col("id") % 40)).alias("ip"),
        F.when(F.col("id") % 50 != 0, (F.col("id") * 7919) % 900 - 100).alias("report_id"),
        ((F.col("id") * 31) % 333).alias("reporter_id"),
        F.when(F.col("id") % 11 != 0, (F.col("id") % 23 + 1).cast("int")).alias("category"),
        (F.lit(START) + F.make_dt_interval(F.col("id") % 180, F.floor(F.col("id") / 180) % 24)).alias("reported_at"),
    )
    return made.unionByName(made.limit(100))


def by_distinct(reports):
    return reports.groupBy("ip").agg(
        F.count_distinct("report_id"), F.count_distinct("reporter_id"), F.max("reported_at"), F.count_distinct("category")
    )


def test_sets_count_like_distinct(reports):
    assert rows(reputation.report_rollup(reports)) == rows(by_distinct(reports))


def test_category_set(spark, reports):
    words = report_sets.report_words(reports)
    codes = {r.ip: r.codes for r in report_sets.rollup_words(words, report_sets.category_set(24)).collect()}
    for row in reports.groupBy("ip").agg(F.collect_set("category").alias("seen")).collect():
        assert codes[row.ip] == sum(1 << c for c in row.seen)
    with pytest.raises(ValueError):
        report_sets.category_set(65)


@pytest.mark.parametrize("hour", [0, 13])
def test_window_merges_days_and_the_edge(spark, reports, tmp_path, hour):
    path, asof = str(tmp_path / "days"), START + timedelta(days=150, hours=hour)
    shown = reports.filter(F.col("reported_at") <= F.lit(asof))
    report_days.add_days(shown, path, START.date(), asof.date())
    # Repeating some days changes nothing.
    report_days.add_days(shown, path, date(2024, 5, 1), date(2024, 5, 20))
    assert len(report_days.stored_days(spark, path)) == 151
    for age in (90, 30, 1):
        after = asof - timedelta(days=age)
        got = report_days.rollup_window(spark, path, after, asof.date(), shown)
        assert rows(got) == rows(by_distinct(shown.filter(F.col("reported_at") > F.lit(after))))


def scanned(df):
    return {f.rsplit("/", 2)[1] for f in df.inputFiles()}


def test_adding_a_day_reads_that_day_only(spark, reports, tmp_path):
    source, path = str(tmp_path / "reports"), str(tmp_path / "days")
    dated = reports.withColumn("on", F.col("reported_at").cast("date"))
    dated.repartition("on").write.partitionBy("on").parquet(source)
    stored = spark.read.parquet(source).withColumn("day", F.col("on"))
    last = START.date() + timedelta(days=100)
    report_days.add_days(reports, path, START.date(), last)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "days").rglob("*.parquet")}
    day = last + timedelta(days=1)
    # Partitioned by day: the reports of other days are not scanned.
    one = report_days.of_days(stored.filter(F.col("on") == F.lit(day)), day, day)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(on" in plan and "PushedFilters: [IsNotNull(reported_at), GreaterThanOrEqual(reported_at" in plan
    report_days.add_days(one.drop("day", "on"), path, day, day)
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "days").rglob("*.parquet")}
    assert {f: after[f] for f in before} == before
    assert {f.parent.name for f in set(after) - set(before)} == {f"day={day}"}
    window = report_days.read_days(spark, path, day, day)
    assert "PartitionFilters: [isnotnull(day" in window._jdf.queryExecution().executedPlan().toString()


def test_no_reports(spark, reports, tmp_path):
    assert reputation.report_rollup(reports.limit(0)).count() == 0
    report_days.add_days(reports, str(tmp_path / "days"), date(1999, 1, 1), date(1999, 1, 5))
    assert report_days.stored_days(spark, str(tmp_path / "days")) == []
    assert report_days.stored_days(spark, str(tmp_path / "none")) == []
