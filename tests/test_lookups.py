import json
from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from wardline.functions import fixed_values as fv
from wardline.operators import breach, events, geo, reputation

T0 = datetime(2024, 1, 1)


def payload_rows(spark, key, items):
    return spark.createDataFrame(
        [(k, v if isinstance(v, (str, type(None))) else json.dumps(v)) for k, v in items],
        f"{key} string, payload string",
    )


def test_reputation_payload_and_defaults(spark):
    full = {
        "data": {
            "ipAddress": "1.1.1.1", "abuseConfidenceScore": 90, "countryCode": "CN", "isp": "X",
            "domain": "x.net", "isTor": True, "usageType": "Hosting", "totalReports": 7,
            "numDistinctUsers": 3, "lastReportedAt": "2024-01-01T00:00:00+00:00",
            "reports": [{"categories": [18, 22]}, {"categories": [18, 1]}],
        }
    }
    payloads = payload_rows(
        spark, "ip", [("1.1.1.1", full), ("2.2.2.2", {"data": {}}), ("3.3.3.3", "not json")]
    )
    asked = spark.createDataFrame(
        [(ip,) for ip in ("1.1.1.1", "1.1.1.1", "2.2.2.2", "3.3.3.3", "4.4.4.4", "9.9.9.9")], "ip string"
    )
    out = {r["ip"]: r for r in reputation.check_ips(asked, payloads).collect()}
    assert len(out) == 5
    first = out["1.1.1.1"]
    assert (first["threat_score"], first["threat_level"], first["is_tor"]) == (90, "critical", True)
    assert (first["is_vpn"], first["total_reports"], first["distinct_users"]) == (True, 7, 3)
    assert first["recent_categories"] == ["Category 1", "Brute-Force", "SSH"]
    assert first["last_reported"] == T0
    for ip in ("2.2.2.2", "3.3.3.3", "4.4.4.4"):
        r = out[ip]
        assert (r["threat_score"], r["threat_level"], r["country"]) == (0, "low", None)
        assert (r["is_vpn"], r["total_reports"], r["recent_categories"]) == (False, 0, [])
    assert out["9.9.9.9"]["threat_score"] == 100 and out["9.9.9.9"]["country"] == "RU"


def test_override_beats_a_payload_and_first_payload_is_kept(spark):
    answers = [
        ("8.8.8.8", json.dumps({"data": {"abuseConfidenceScore": 1}}), 1),
        ("1.1.1.1", json.dumps({"data": {"abuseConfidenceScore": 9}}), 2),
        ("1.1.1.1", json.dumps({"data": {"abuseConfidenceScore": 50}}), 1),
    ]
    payloads = spark.createDataFrame(answers, "ip string, payload string, fetched_at int")
    out = reputation.check_ips(payloads.select("ip"), payloads)
    assert rows(out, "ip", "threat_score") == [("1.1.1.1", 50), ("8.8.8.8", 45)]


def test_a_payload_naming_another_ip_stays_with_the_requested_one(spark):
    payloads = payload_rows(
        spark, "ip", [(ip, {"data": {"ipAddress": "9.9.9.9"}}) for ip in ("1.1.1.1", "2.2.2.2")]
    )
    known = reputation.check_ips(payloads, payloads)
    assert rows(known, "requested_ip", "ip", "threat_score") == [
        ("1.1.1.1", "9.9.9.9", 0), ("2.2.2.2", "9.9.9.9", 0),
    ]
    signals = spark.createDataFrame([(1, "1.1.1.1", 5), (2, "9.9.9.9", 5)], "id int, ip string, threat_score int")
    assert reputation.enrich_signals(signals, known).count() == 2


def report_rows(spark, items):
    return spark.createDataFrame(
        items, "ip string, report_id bigint, reporter_id bigint, category int, reported_at timestamp_ntz"
    )


def test_rollup_and_window(spark):
    old, new = datetime(2024, 1, 1), datetime(2024, 6, 1)
    reports = report_rows(
        spark, [("a", 1, 1, 3, new), ("a", 1, 1, 4, new), ("a", 2, 1, 3, old), ("b", 3, 2, 99, new)]
    )
    assert rows(reputation.report_rollup(reports)) == [("a", 2, 1, new, 2), ("b", 1, 1, new, 1)]
    recent = reputation.report_rollup(reputation.recent_reports(reports, 90))
    assert rows(recent) == [("a", 1, 1, new, 2), ("b", 1, 1, new, 1)]


def test_flat_report_categories_match_the_payload_rule(spark):
    codes = [23, 22, 21, 20, 19, 18, 17, 17, None, 1]
    reports = report_rows(spark, [("a", i, i, c, T0) for i, c in enumerate(codes)])
    out = reputation.report_categories(reports).collect()
    assert out[0]["recent_categories"] == [
        "Category 1", "Spoofing", "Brute-Force", "Bad Web Bot", "Exploited Host", "Web App Attack",
    ]


def test_breach_payload_shapes(spark):
    shapes = {
        '{"breaches":[["A","B"],["C"]]}': ["A", "B"],
        '{"breaches":["A","B","C"]}': ["A", "B", "C"],
        '{"Exposure":{"breaches":[["Z"]]}}': ["Z"],
        '{"exposedBreaches":{"breaches":["Y"]}}': ["Y"],
        '{"x":1}': [],
        '{"Exposure":{},"exposedBreaches":{"breaches":["Y"]}}': ["Y"],
        '{"Exposure":null,"breaches":["Q"]}': ["Q"],
        '{"Exposure":"","exposedBreaches":[],"breaches":["Q"]}': ["Q"],
        '{"breaches":[[]]}': [],
        '{"breaches":[]}': [],
        "broken": [],
    }
    payloads = payload_rows(spark, "email", [(f"e{i}", text) for i, text in enumerate(shapes)])
    out = breach.check_emails(payloads, payloads).orderBy("email").collect()
    found = {r["email"]: [b["Name"] for b in r["breaches"]] for r in out}
    assert [found[f"e{i}"] for i in range(len(shapes))] == list(shapes.values())


def test_email_checks(spark):
    payloads = payload_rows(spark, "email", [("a", {"breaches": [list("ABCDE")]})])
    metrics = payload_rows(
        spark, "email", [("a", {"BreachMetrics": {"passwords": 3, "ssn": 1}}), ("b", {"BreachMetrics": {"ssn": 9}})]
    )
    asked = spark.createDataFrame([("a",), ("b",)], "email string")
    out = breach.check_emails(asked, payloads, metrics)
    fields = ("email", "breached", "breach_count", "threat_score", "threat_level", "source")
    assert rows(out, *fields) == [
        ("a", True, 5, 60, "high", "xposedornot"),
        ("b", False, 0, 0, "low", "xposedornot"),
    ]
    assert rows(out, "email", "analytics.*") == [("a", 3, 0, 1), ("b", 0, 0, 0)]
    hits = spark.createDataFrame([("a",), ("a",)], "email string")
    assert rows(breach.unbreached(asked, hits)) == [("b",)]


def geo_of(spark, primary, fallback=()):
    first = payload_rows(spark, "ip", primary)
    second = payload_rows(spark, "ip", list(fallback))
    asked = spark.createDataFrame(
        [(ip,) for ip in {k for k, _ in primary} | {k for k, _ in fallback} | {"none"}], "ip string"
    )
    return {r["ip"]: r for r in geo.geolocate(asked, first, second).collect()}


def test_geo_risk(spark):
    cases = [
        ("CN", "M247 Ltd", None, "high", True, 100),
        ("CN", "China Telecom", None, "high", False, 80),
        ("BR", None, "Vultr Holdings", "medium", True, 70),
        ("UA", "Kyivstar", None, "medium", False, 45),
        ("US", "AS-CHOOPA", None, "low", True, 35),
        ("ZW", "pqxhosting", None, "low", False, 10),
    ]
    primary = [
        (f"ip{i}", {"status": "success", "countryCode": cc, "isp": isp, "asname": asn})
        for i, (cc, isp, asn, *_) in enumerate(cases)
    ]
    out = geo_of(spark, primary)
    for i, (*_, risk, suspicious, score) in enumerate(cases):
        r = out[f"ip{i}"]
        assert (r["geo_risk"], r["asn_suspicious"], r["geo_risk_score"]) == (risk, suspicious, score)
    assert out["ip0"]["flag"] == "🇨🇳" and out["ip5"]["flag"] == "🌐"
    assert out["ip0"]["country"] == "Unknown" and out["ip2"]["isp"] == "Unknown"
    none = out["none"]
    assert (none["country"], none["isp"], none["geo_risk_score"]) == ("Unknown", "Unknown", 10)
    assert (none["source"], none["geo_source"], none["lat"]) == ("ip-api.com", "none", 0.0)


def test_geo_fallback(spark):
    primary = [
        ("both", {"status": "success", "countryCode": "DE"}),
        ("failed", {"status": "fail", "message": "private range"}),
    ]
    fallback = [
        ("both", {"country": "FR", "city": "Paris"}),
        ("failed", {"country": "RU", "region": "X", "loc": "1.5,2.5", "org": "Selectel"}),
        ("empty", {}),
        ("bad", {"country": "RU", "loc": "north"}),
    ]
    out = geo_of(spark, primary, fallback)
    assert (out["both"]["country_code"], out["both"]["city"]) == ("DE", "")
    r = out["failed"]
    assert (r["country"], r["region"], r["lat"], r["lon"]) == ("RU", "X", 1.5, 2.5)
    assert (r["asn"], r["asn_name"], r["geo_risk_score"], r["geo_source"]) == (
        "Selectel", "Selectel", 100, "fallback",
    )
    # The fallback leaves texts empty where the primary's absence gives "Unknown".
    assert (out["empty"]["country"], out["empty"]["isp"]) == ("", "")
    assert (out["bad"]["geo_source"], out["bad"]["country"]) == ("none", "Unknown")


def test_events_share_one_shape(spark):
    known = reputation.overrides(spark)
    scans = events.ip_scan_events(known, F.col("ip"), F.lit(T0))
    asked = spark.createDataFrame([("a",)], "email string")
    mails = events.email_events(breach.check_emails(asked, payload_rows(spark, "email", [])))
    both = scans.unionByName(mails)
    out = {r["event_type"]: r for r in both.filter("threat_level in ('critical', 'low')").collect()}
    scan, mail = out[fv.IP_EVENT_TYPE], out[fv.EMAIL_EVENT_TYPE]
    assert scan["payload"]["message"] == "IP scan: 9.9.9.9 — score 100"
    assert scan["payload"]["country"] == "RU" and scan["source"] == "abuseipdb"
    assert mail["payload"]["message"] == "Email scan: a — score 0"
    assert mail["payload"]["country"] is None and len(mail["id"]) == 36


def test_described_signals(spark):
    signals = spark.createDataFrame([(1, T0, "9.9.9.9", 10), (2, T0, None, 90)],
                                    "id bigint, ts timestamp_ntz, ip string, threat_score int")
    asked = signals.select("ip")
    known = reputation.check_ips(asked, payload_rows(spark, "ip", []))
    enriched = reputation.enrich_signals(signals, known)
    out = events.signal_events(events.describe_signals(enriched))
    assert rows(out, "id", "source", "threat_level", "payload.message", "payload.country") == [
        ("1", "ddos-monitor", "low", "DDoS origin node detected at 9.9.9.9", "RU"),
        ("2", "botnet-feed", "critical", "Critical threat beacon from ", None),
    ]
