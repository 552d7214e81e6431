"""Explicit schemas of every record that crosses the engine's border."""

from __future__ import annotations

# JSON event on the wire. `_corrupt_record` catches text that is not JSON.
SIGNAL_WIRE = (
    "id string, event_type string, source string, threat_level string, threat_score int, "
    "timestamp string, payload struct<message:string,country:string,ip:string>, "
    "_simulated boolean, _replay boolean, _corrupt_record string"
)

# Stored event.
SIGNAL = (
    "id string, event_type string, source string, threat_level string, threat_score int, "
    "ts timestamp, payload struct<message:string,country:string,ip:string>, "
    "_simulated boolean, _replay boolean"
)

REPUTATION_PAYLOAD = (
    "data struct<ipAddress:string,abuseConfidenceScore:int,countryCode:string,isp:string,"
    "domain:string,isTor:boolean,usageType:string,totalReports:bigint,numDistinctUsers:bigint,"
    "lastReportedAt:timestamp,reports:array<struct<categories:array<int>>>>"
)

REPUTATION = (
    "source string, ip string, threat_score int, threat_level string, country string, "
    "isp string, domain string, is_tor boolean, is_vpn boolean, total_reports bigint, "
    "distinct_users bigint, recent_categories array<string>, last_reported timestamp"
)

BREACH_METRICS_PAYLOAD = (
    "BreachMetrics struct<passwords:bigint,credit_cards:bigint,ssn:bigint>"
)

GEO_PRIMARY_PAYLOAD = (
    "status string, country string, countryCode string, regionName string, city string, "
    "lat double, lon double, timezone string, isp string, org string, `as` string, "
    "asname string, mobile boolean, proxy boolean, hosting boolean"
)

GEO_FALLBACK_PAYLOAD = (
    "loc string, country string, city string, region string, org string, timezone string"
)

# One geolocation candidate, whichever service gave it.
GEO_COLUMNS = (
    "country", "countryCode", "city", "regionName", "lat", "lon", "timezone", "isp", "org",
    "as", "asname", "hosting", "proxy", "mobile",
)
