import pytest
from conftest import rows
from pyspark.sql import functions as F

from wardline.functions import features, rules
from wardline.functions import fixed_values as fv

RECORD = (
    "ip string, threat_score int, threat_level string, country string, isp string, domain string,"
    "is_tor boolean, is_vpn boolean, total_reports bigint, distinct_users bigint,"
    "recent_categories array<string>"
)


def test_score_bands(spark):
    scores = [(s,) for s in (0, 34, 35, 59, 60, 84, 85, 100, None)]
    out = spark.createDataFrame(scores, "s int").select("s", rules.score_to_level(F.col("s")))
    expected = {
        0: "low", 34: "low", 35: "medium", 59: "medium", 60: "high", 84: "high",
        85: "critical", 100: "critical", None: "low",
    }
    assert dict(map(tuple, out.collect())) == expected


def test_vpn_usage_types(spark):
    types = ["VPN", "Hosting", "Data Center", "Commercial", None]
    out = spark.createDataFrame([(t,) for t in types], "u string").select(rules.is_vpn(F.col("u")))
    assert [r[0] for r in out.collect()] == [True, True, True, False, False]


def test_categories_are_distinct_named_and_cut(spark):
    df = spark.createDataFrame(
        [(1, [22, 3, 3, 99, 14]), (2, [23, 22, 21, 20, 19, 18, 17]), (3, [])],
        "id int, codes array<int>",
    )
    out = dict(map(tuple, df.select("id", rules.recent_categories(F.col("codes"))).collect()))
    assert out[1] == ["Fraud Orders", "Port Scan", "SSH", "Category 99"]
    assert out[2] == [
        "Spoofing", "Brute-Force", "Bad Web Bot", "Exploited Host", "Web App Attack", "SSH",
    ]
    assert out[3] == []


def test_nested_report_codes_allow_missing_lists(spark):
    df = spark.sql(
        "SELECT from_json(j, 'reports array<struct<categories:array<int>>>').reports r FROM VALUES "
        """('{"reports":[{"categories":[3,4]},{"categories":null},{}]}'), ('{}') t(j)"""
    )
    assert rows(df.select(rules.report_codes(F.col("r")))) == [([3, 4],), ([],)]


def test_signal_cascade(spark):
    cases = [
        (["Phishing", "DDoS Attack"], False, 0, "ddos-monitor"),
        (["FTP Brute-Force"], False, 0, "auth-logs"),
        (["SSH"], True, 99, "auth-logs"),
        (["ssh brute-force"], False, 20, "threat-intel-feed"),
        (["SSH Login Attempts"], False, 20, "threat-intel-feed"),
        (["Port Scan", "Web App Attack"], False, 0, "firewall-syslog"),
        (["SQL Injection"], False, 0, "waf-alerts"),
        (["Web App Attack"], False, 0, "waf-alerts"),
        (["Phishing"], True, 99, "phish-intel"),
        ([], True, 99, "tor-exit-watcher"),
        (None, False, 85, "botnet-feed"),
        ([None], None, 84, "threat-intel-feed"),
    ]
    df = spark.createDataFrame(cases, "c array<string>, tor boolean, score int, want string")
    kind = rules.signal_kind(rules.category_kind(F.col("c")), F.col("tor"), F.col("score"))
    out = df.select("want", rules.signal_source(kind), rules.signal_message(kind, F.lit("1.2.3.4")))
    for want, source, message in out.collect():
        assert source == want
        assert "1.2.3.4" in message and "%" not in message


def test_fixed_records_give_the_expected_features(spark):
    out = spark.createDataFrame(list(fv.OVERRIDES), RECORD).select("ip", *features.ip_features())
    vectors = {r[0]: list(r[1:]) for r in out.collect()}
    assert vectors["9.9.9.9"] == pytest.approx([1, 0.5, 1, 1, 0, 0.3, 0, 1, 1, 0, 1])
    assert vectors["8.8.8.8"] == pytest.approx([0.45, 0.0042, 0.01, 0, 1, 0.2, 0, 0, 1, 0, 0.1])
    assert vectors["7.7.7.7"] == pytest.approx([0.75, 0.085, 0.24, 0, 0, 0.2, 1, 0, 0, 0, 1])


def test_features_clip_and_default(spark):
    many = ("a", 250, None, "XX", "", "", None, None, 20000, 900, ["SQLi x"] * 12)
    none = ("b", None, None, None, None, None, None, None, None, None, None)
    out = spark.createDataFrame([many, none], RECORD).select("ip", *features.ip_features())
    vectors = {r[0]: list(r[1:]) for r in out.collect()}
    assert vectors["a"] == pytest.approx([2.5, 1, 1, 0, 0, 1, 0, 0, 0, 1, 0.1])
    assert vectors["b"] == pytest.approx([0] * 10 + [0.1])


def test_email_features(spark):
    schema = (
        "threat_score int, breach_count int, "
        "analytics struct<passwords:bigint,credit_cards:bigint,ssn:bigint>"
    )
    df = spark.createDataFrame([(60, 5, (3, 0, 1)), (0, 40, None)], schema)
    first, second = [list(r) for r in df.select(*features.email_features()).collect()]
    assert first == pytest.approx([0.6, 5 / 30, 1, 0, 1, 0, 0, 0, 0, 0, 0])
    assert second == pytest.approx([0, 1] + [0] * 9)


def test_the_two_country_tables_differ(spark):
    df = spark.createDataFrame([("UA",), ("AF",), ("CN",), (None,)], "c string")
    c = F.col("c")
    out = df.select("c", rules.model_country_weight(c), rules.geo_risk(c)).collect()
    assert {r[0]: (r[1], r[2]) for r in out} == {
        "UA": (1.0, "medium"), "AF": (0.1, "high"), "CN": (1.0, "high"), None: (0.1, "low"),
    }


def test_breach_scores(spark):
    expected = [0, 12, 35, 36, 48, 60, 72, 84, 96, 100, 100, 100]
    df = spark.range(len(expected)).select("id", rules.breach_score(F.col("id").cast("int")))
    assert [r[1] for r in df.orderBy("id").collect()] == expected


def test_adjusted_scores_truncate(spark):
    cases = [
        (100, "critical", 100), (45, "medium", 45), (75, "high", 73), (45, "high", 55),
        (0, "low", 4), (50, "nothing", 50), (50, None, 50),
    ]
    df = spark.createDataFrame(cases, "s int, l string, want int")
    out = df.select("want", rules.adjusted_score(F.col("s"), F.col("l")))
    assert all(a == b for a, b in out.collect())


def test_lat_lon(spark):
    texts = [("1.5,-2",), (None,), ("x,1",), ("7",), ("1,2,3",)]
    df = spark.createDataFrame(texts, "loc string")
    out = [tuple(r) for r in df.select(*rules.lat_lon(F.col("loc"))).collect()]
    assert out == [(1.5, -2.0), (0.0, 0.0), (None, 1.0), (7.0, None), (1.0, 2.0)]
