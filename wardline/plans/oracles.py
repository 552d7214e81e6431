"""SQL twins of the registered queries, for DuckDB over the same tables.

The lists of codes, names, countries, texts and weights are fixed values, as in functions/fixed_values.py.
"""

from __future__ import annotations

BASE = """
WITH iso AS (SELECT * FROM (VALUES (0,'CN'),(1,'RU'),(2,'KP'),(3,'IR'),(4,'SY'),(5,'UA'),(6,'RO'),(7,'BR'),
    (8,'NG'),(9,'PK'),(10,'BD'),(11,'IN'),(12,'VN'),(13,'LY'),(14,'US'),(15,'DE'),(16,'FR'),(17,'GB'),(18,'NL'),
    (19,'JP'),(20,'KR'),(21,'AU'),(22,'AF'),(23,'CU'),(24,'ZW')) t(nk, cc)),
isps AS (SELECT * FROM (VALUES (0,'Cloudflare Inc'),(1,'AS-CHOOPA'),(2,'OVH SAS'),(3,'Amazon AWS'),
    (4,'DigitalOcean LLC')) t(ik, isp)),
catmap AS (SELECT * FROM (VALUES (3,'Fraud Orders'),(4,'DDoS Attack'),(5,'FTP Brute-Force'),(6,'Ping of Death'),
    (7,'Phishing'),(9,'Open Proxy'),(10,'Web Spam'),(11,'Email Spam'),(14,'Port Scan'),(15,'Hacking'),
    (16,'SQL Injection'),(17,'Spoofing'),(18,'Brute-Force'),(19,'Bad Web Bot'),(20,'Exploited Host'),
    (21,'Web App Attack'),(22,'SSH'),(23,'IoT Targeted')) t(code, cname)),
owners AS (SELECT c_custkey,
    '10.' || CAST(floor(c_custkey / 65536) AS BIGINT) || '.' ||
        CAST(floor(c_custkey / 256) AS BIGINT) % 256 || '.' || c_custkey % 256 AS ip,
    'user' || c_custkey || '@example.net' AS email,
    cc AS country, n_name AS country_name, isp,
    CAST((c_custkey * 37) % 101 AS INTEGER) AS rep_score,
    c_custkey % 5 = 0 AS is_tor,
    CASE c_custkey % 6 WHEN 0 THEN 'VPN' WHEN 1 THEN 'Hosting' WHEN 2 THEN 'Data Center'
         WHEN 3 THEN 'Fixed Line ISP' WHEN 4 THEN NULL ELSE 'Commercial' END AS usage_type
    FROM customer LEFT JOIN iso ON c_nationkey = nk LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN isps ON CAST(floor(c_custkey / 10) AS BIGINT) % 5 = ik),
signals AS (SELECT event_id AS id, ts, ip, email,
    CAST(least(100, floor(value)) AS INTEGER) AS threat_score,
    CASE WHEN floor(value) >= 85 THEN 'critical' WHEN floor(value) >= 60 THEN 'high'
         WHEN floor(value) >= 35 THEN 'medium' ELSE 'low' END AS threat_level
    FROM events LEFT JOIN owners ON user_id = c_custkey),
reports AS (SELECT ip, o_orderkey AS report_id, l_suppkey AS reporter_id,
    CAST(1 + l_partkey % 23 AS INTEGER) AS category, o_orderdate AS reported_at
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN owners ON o_custkey = c_custkey),
rollup AS (SELECT ip, count(DISTINCT report_id) AS total_reports,
    count(DISTINCT reporter_id) AS distinct_users, max(reported_at) AS last_reported,
    count(DISTINCT category) AS category_count FROM reports GROUP BY ip),
ranked_categories AS (SELECT ip, category, coalesce(cname, 'Category ' || category) AS name,
    row_number() OVER (PARTITION BY ip ORDER BY category) AS rk
    FROM (SELECT DISTINCT ip, category FROM reports) LEFT JOIN catmap ON category = code),
named AS (SELECT ip, list(name ORDER BY category) AS cats FROM ranked_categories WHERE rk <= 6 GROUP BY ip),
fixed_records AS (SELECT * FROM (VALUES
    ('9.9.9.9', 100, 'critical', 'RU', 'Test Malicious ISP', 'hacker-test.net', true, false, 5000, 1500,
     ['DDoS Attack', 'Port Scan', 'Hacking']),
    ('8.8.8.8', 45, 'medium', 'US', 'Test Medium ISP', 'scanner-test.com', false, true, 42, 5,
     ['Port Scan', 'Web Spam']),
    ('7.7.7.7', 75, 'high', 'CN', 'Test High ISP', 'botnet-test.cn', false, false, 850, 120,
     ['Brute-Force', 'SSH Login Attempts'])) t(ip, threat_score, threat_level, country, isp, domain,
     is_tor, is_vpn, total_reports, distinct_users, cats)),
reputation AS (SELECT ip, rep_score AS threat_score,
    CASE WHEN rep_score >= 85 THEN 'critical' WHEN rep_score >= 60 THEN 'high'
         WHEN rep_score >= 35 THEN 'medium' ELSE 'low' END AS threat_level,
    country, isp, 'example.net' AS domain, is_tor,
    coalesce(usage_type IN ('VPN', 'Hosting', 'Data Center'), false) AS is_vpn,
    coalesce(total_reports, 0) AS total_reports, coalesce(distinct_users, 0) AS distinct_users,
    coalesce(cats, []) AS cats
    FROM owners LEFT JOIN rollup USING (ip) LEFT JOIN named USING (ip)
    UNION ALL SELECT * FROM fixed_records),
enriched AS (SELECT id, ts, ip, s.threat_score, s.threat_level, r.country, r.is_tor, r.is_vpn,
    r.total_reports, r.distinct_users, coalesce(r.cats, []) AS cats
    FROM signals s LEFT JOIN reputation r USING (ip)),
features AS (SELECT id,
    threat_score / 100.0::DOUBLE AS f_score,
    least(coalesce(total_reports, 0), 10000) / 10000.0::DOUBLE AS f_vol,
    least(coalesce(distinct_users, 0), 500) / 500.0::DOUBLE AS f_dist,
    coalesce(is_tor, false)::INT::DOUBLE AS f_tor,
    coalesce(is_vpn, false)::INT::DOUBLE AS f_vpn,
    least(len(cats), 10) / 10.0::DOUBLE AS f_cat,
    (len(list_filter(cats, lambda c: contains(lower(c), 'brute') OR contains(lower(c), 'ssh'))) > 0)::INT::DOUBLE AS f_brute,
    (len(list_filter(cats, lambda c: contains(lower(c), 'ddos'))) > 0)::INT::DOUBLE AS f_ddos,
    (len(list_filter(cats, lambda c: contains(lower(c), 'scan'))) > 0)::INT::DOUBLE AS f_scan,
    (len(list_filter(cats, lambda c: contains(lower(c), 'inject') OR contains(lower(c), 'sqli'))) > 0)::INT::DOUBLE AS f_sqli,
    (CASE WHEN country IN ('CN','RU','KP','IR','UA','SY','LY','IQ') THEN 1.0
          WHEN country IN ('BR','IN','NG','RO','PK','BD') THEN 0.5 ELSE 0.1 END)::DOUBLE AS f_country
    FROM enriched),
breaches AS (SELECT email, o_orderkey AS breach_id, 'Breach-' || strftime(o_orderdate, '%Y-%m') AS breach_name,
    o_orderstatus AS leaked
    FROM owners JOIN orders ON o_custkey = c_custkey),
leaks AS (SELECT email, count(DISTINCT breach_name) AS n,
    string_agg(DISTINCT breach_name, ',' ORDER BY breach_name) AS names,
    count(*) FILTER (leaked = 'F') AS passwords, count(*) FILTER (leaked = 'O') AS credit_cards,
    count(*) FILTER (leaked = 'P') AS ssn FROM breaches GROUP BY email),
scored_leaks AS (SELECT email, coalesce(n, 0) AS n, coalesce(names, '') AS names,
    coalesce(passwords, 0) AS passwords, coalesce(credit_cards, 0) AS credit_cards, coalesce(ssn, 0) AS ssn,
    greatest(least(coalesce(n, 0) * 12, 100),
        CASE WHEN n >= 8 THEN 85 WHEN n >= 5 THEN 60 WHEN n >= 2 THEN 35 ELSE 0 END)::INTEGER AS threat_score
    FROM owners LEFT JOIN leaks USING (email)),
checks AS (SELECT *, CASE WHEN threat_score >= 85 THEN 'critical' WHEN threat_score >= 60 THEN 'high'
    WHEN threat_score >= 35 THEN 'medium' ELSE 'low' END AS threat_level FROM scored_leaks),
located AS (SELECT ip,
    CASE WHEN c_custkey % 10 > 1 THEN country_name WHEN c_custkey % 10 = 0 THEN country ELSE 'Unknown' END AS country,
    CASE WHEN c_custkey % 10 = 1 THEN '' ELSE country END AS country_code,
    CASE WHEN c_custkey % 10 = 1 THEN 0.0 ELSE c_custkey % 180 - 90 + 0.5 END::DOUBLE AS lat,
    CASE WHEN c_custkey % 10 = 1 THEN 0.0 ELSE c_custkey % 360 - 180 + 0.25 END::DOUBLE AS lon,
    CASE WHEN c_custkey % 10 = 1 THEN 'Unknown' ELSE isp END AS isp,
    CASE WHEN c_custkey % 10 = 0 THEN isp ELSE '' END AS org,
    CASE WHEN c_custkey % 10 = 0 THEN isp ELSE '' END AS asn,
    CASE WHEN c_custkey % 10 = 1 THEN '' ELSE isp END AS asn_name,
    c_custkey % 10 > 1 AND c_custkey % 4 = 0 AS is_hosting,
    c_custkey % 10 > 1 AND c_custkey % 7 = 0 AS is_proxy,
    c_custkey % 10 > 1 AND c_custkey % 9 = 0 AS is_mobile,
    CASE WHEN c_custkey % 10 > 1 THEN 'primary' WHEN c_custkey % 10 = 0 THEN 'fallback' ELSE 'none' END AS geo_source
    FROM owners),
risked AS (SELECT *, EXISTS (SELECT 1 FROM (VALUES ('choopa'),('vultr'),('frantech'),('hostkey'),('selectel'),
        ('serverius'),('qhoster'),('sharktech'),('ecatel'),('leaseweb'),('m247'),('combahton'),('pq.hosting'),
        ('alexhost'),('psychz'),('nexeon'),('inferno')) k(word)
        WHERE contains(lower(isp || ' ' || asn_name), word)) AS asn_suspicious,
    CASE WHEN country_code IN ('CN','RU','KP','IR','SY','LY','IQ','AF','SD','BY','VE','CU') THEN 'high'
         WHEN country_code IN ('UA','RO','BR','NG','PK','BD','IN','VN','ID','PH','MX','EG') THEN 'medium'
         ELSE 'low' END AS geo_risk FROM located),
geo AS (SELECT *, least(100, CASE geo_risk WHEN 'high' THEN 80 WHEN 'medium' THEN 45 ELSE 10 END
    + CASE WHEN asn_suspicious THEN 25 ELSE 0 END)::INTEGER AS geo_risk_score FROM risked)
"""

# Trend over a frame `kept(ts, y)`.
TREND = """,
origin AS (SELECT min(ts) AS t0, max(ts) AS t1 FROM kept),
points AS (SELECT (epoch_us(ts) - epoch_us(t0)) / 3.6e9::DOUBLE AS x, y::DOUBLE AS y,
    (epoch_us(t1) - epoch_us(t0)) / 3.6e9::DOUBLE + 1 AS x_next FROM kept, origin),
line AS (SELECT regr_slope(y, x) AS s, regr_intercept(y, x) AS i, max(x_next) AS xn, count(*) AS n FROM points)
SELECT round(s, 3) AS slope, round(i, 2) AS intercept,
    round(greatest(0, least(100, s * xn + i)), 1) AS next_predicted,
    CASE WHEN s > 2 THEN 'rising' WHEN s < -2 THEN 'falling' ELSE 'stable' END AS trend,
    n AS data_points FROM line
"""

FEATURES = (
    "f_score", "f_vol", "f_dist", "f_tor", "f_vpn", "f_cat",
    "f_brute", "f_ddos", "f_scan", "f_sqli", "f_country",
)


def _scaled() -> str:
    moments = ", ".join(f"avg({f}) AS m_{f}, stddev_samp({f}) AS s_{f}" for f in FEATURES)
    columns = ", ".join(
        f"round(CASE WHEN s_{f} = 0 THEN 0 ELSE ({f} - m_{f}) / s_{f} END, 6) + 0.0::DOUBLE AS {f}"
        for f in FEATURES
    )
    return f"{BASE}, moments AS (SELECT {moments} FROM features) SELECT id, {columns} FROM features, moments"


def _distances() -> str:
    centres = (
        (0.9, 0.5, 0.5, 1, 1, 0.6, 1, 1, 1, 1, 1),
        (0.6, 0.1, 0.1, 0, 1, 0.3, 1, 0, 1, 0, 0.5),
        (0.4, 0, 0, 0, 0, 0.2, 0, 0, 0, 1, 0.5),
        (0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0.1),
    )
    options = []
    for i, centre in enumerate(centres):
        squares = " + ".join(
            f"({f} - {c}::DOUBLE) * ({f} - {c}::DOUBLE)" for f, c in zip(FEATURES, centre)
        )
        options.append(f"SELECT id, {i} AS centre, sqrt({squares}) AS d FROM features")
    union = " UNION ALL ".join(options)
    return f"""{BASE}, options AS ({union}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, centre) AS rk FROM options)
SELECT id, centre::INTEGER AS centre, round(d, 6) AS distance, d > 2.0 AS anomaly FROM ranked WHERE rk = 1"""


def _fixed() -> str:
    """Frame `scored` of the fixed centres and bands."""
    return f"""{_distances().partition("SELECT id, centre::INTEGER")[0]},
scored AS (SELECT s.id, s.ts, d > 2.0 AS anomaly, 'centre ' || centre AS cluster_name, s.threat_level AS rf_prediction,
    greatest(0, least(100, trunc(0.6::DOUBLE * threat_score + 0.4::DOUBLE *
    CASE s.threat_level WHEN 'critical' THEN 100 WHEN 'high' THEN 70 WHEN 'medium' THEN 45 ELSE 10 END)))::INTEGER AS adjusted
    FROM ranked JOIN signals s USING (id) WHERE rk = 1)"""


def _split(rows: str) -> str:
    """Exact two-way split of the frame `rows`: the cut with the greatest gain by prefix sums."""
    return f"""{BASE}, kept AS (SELECT id, threat_score::DOUBLE AS score FROM {rows}),
bins AS (SELECT score, count(*)::DOUBLE AS n FROM kept GROUP BY score),
sums AS (SELECT score, sum(n) OVER w AS n1, sum(score * n) OVER w AS x1, sum(n) OVER () AS n, sum(score * n) OVER () AS x
    FROM bins WINDOW w AS (ORDER BY score)),
gains AS (SELECT score, (x1 * (n - n1) - (x - x1) * n1) * (x1 * (n - n1) - (x - x1) * n1) / (n1 * (n - n1)) AS gain
    FROM sums WHERE n > n1),
best AS (SELECT score AS cut FROM gains ORDER BY gain DESC, score LIMIT 1)
SELECT coalesce(score > (SELECT cut FROM best), false)::INTEGER AS cluster, id, score FROM kept
WHERE (SELECT count(*) FROM kept) >= 5"""


_RATE = """count(*) AS total_events_analyzed, count(*) FILTER (anomaly) AS anomaly_count,
    round(count(*) FILTER (anomaly) / greatest(count(*), 1) * 100, 1) AS anomaly_rate_pct"""
_RECORDS = "count(*) AS n, count(*) AS labelled, count(*) AS blended"
_MINUTES = """SELECT date_trunc('minute', ts) AS minute, count(*) AS n FROM events GROUP BY 1"""
_LEVEL_TOTALS = (
    BASE
    + """SELECT threat_level, count(*) AS n, CAST(sum(threat_score) AS BIGINT) AS score_sum
    FROM signals GROUP BY threat_level"""
)
_DEDUP = BASE + "SELECT DISTINCT id, ts, threat_score FROM signals"
_FIRST_SEEN = (
    BASE
    + """SELECT ip, id, ts, threat_score FROM (
    SELECT *, row_number() OVER (PARTITION BY ip ORDER BY ts, id) AS rk FROM signals WHERE ip IS NOT NULL)
    WHERE rk = 1"""
)
_PAGE = (
    BASE
    + """SELECT id, ts, threat_score, (SELECT count(*) FROM events) AS total
    FROM signals ORDER BY ts DESC, id DESC LIMIT 20"""
)
_CATEGORIES = BASE + "SELECT ip, array_to_string(cats, ', ') AS categories FROM named"

ORACLES = {
    "signal_levels": BASE + "SELECT id, threat_score, threat_level FROM signals",
    "stats_overview": BASE
    + """SELECT count(*) AS total_events, CAST(sum(threat_score) AS BIGINT) AS score_sum,
    round(avg(threat_score), 1) AS average_threat_score FROM signals""",
    "level_distribution": BASE
    + """SELECT threat_level, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT threat_level, 1 AS n FROM signals
    UNION ALL SELECT * FROM (VALUES ('critical', 0), ('high', 0), ('medium', 0), ('low', 0)) t(l, z))
    GROUP BY threat_level""",
    "level_totals": _LEVEL_TOTALS,
    "events_per_minute": _MINUTES,
    "last_closed_minute": f"""WITH m AS ({_MINUTES}), r AS (
    SELECT n, row_number() OVER (ORDER BY minute DESC) AS rk FROM m)
    SELECT coalesce(max(n) FILTER (rk = 2), 0) AS n FROM r""",
    "recent_events": _PAGE,
    "replay_events": BASE
    + """SELECT id, ts, threat_score, true AS replay FROM signals ORDER BY ts DESC, id DESC LIMIT 10""",
    "recent_with_timestamp": BASE
    + """SELECT count(ts) AS recent_event_count
    FROM (SELECT ts FROM signals ORDER BY ts DESC NULLS LAST, id DESC LIMIT 200)""",
    "sample_events": BASE
    + """, batch AS (SELECT id, ts, threat_score FROM signals ORDER BY ts DESC, id DESC LIMIT 200)
    SELECT * FROM batch ORDER BY ts, id LIMIT 5""",
    "dedup_signals": _DEDUP,
    "dedup_against_store": _DEDUP,
    "first_seen_ip": _FIRST_SEEN,
    "ip_report_rollup": BASE + "SELECT * FROM rollup",
    "ip_report_rollup_90d": BASE
    + """SELECT ip, count(DISTINCT report_id) AS total_reports,
    count(DISTINCT reporter_id) AS distinct_users, max(reported_at) AS last_reported,
    count(DISTINCT category) AS category_count FROM reports
    WHERE reported_at > (SELECT max(reported_at) FROM reports) - INTERVAL 90 DAY GROUP BY ip""",
    "ip_categories": BASE
    + "SELECT ip, array_to_string(cats, ', ') AS categories FROM reputation",
    "ip_report_categories": _CATEGORIES,
    "category_counts": BASE
    + """SELECT category, coalesce(any_value(cname), 'Category ' || category) AS category_name,
    count(*) AS n FROM reports LEFT JOIN catmap ON category = code GROUP BY category""",
    "ip_reputation": BASE
    + """SELECT 'abuseipdb' AS source, ip, threat_score, threat_level, country, isp, domain, is_tor, is_vpn,
    CAST(total_reports AS BIGINT) AS total_reports, CAST(distinct_users AS BIGINT) AS distinct_users
    FROM reputation""",
    "signal_messages": BASE
    + """, kinds AS (SELECT id, ip, CASE
        WHEN list_contains(cats, 'DDoS Attack') THEN 1
        WHEN len(list_filter(cats, lambda c: contains(c, 'Brute-Force'))) > 0 OR list_contains(cats, 'SSH') THEN 2
        WHEN list_contains(cats, 'Port Scan') THEN 3
        WHEN list_contains(cats, 'Web App Attack') OR list_contains(cats, 'SQL Injection') THEN 4
        WHEN list_contains(cats, 'Phishing') THEN 5
        WHEN is_tor THEN 6 WHEN threat_score >= 85 THEN 7 ELSE 8 END AS kind FROM enriched),
    texts AS (SELECT * FROM (VALUES
        (1, 'ddos-monitor', 'DDoS origin node detected at %'),
        (2, 'auth-logs', 'SSH brute-force attempt from %'),
        (3, 'firewall-syslog', 'Port scan sweep originating from %'),
        (4, 'waf-alerts', 'Web exploit payload detected from %'),
        (5, 'phish-intel', 'Phishing kit deployed at %'),
        (6, 'tor-exit-watcher', 'TOR exit node % flagged for suspicious traffic'),
        (7, 'botnet-feed', 'Critical threat beacon from %'),
        (8, 'threat-intel-feed', 'Suspicious activity reported from %')) t(kind, source, text))
    SELECT id, source, replace(text, '%', coalesce(ip, '')) AS message FROM kinds JOIN texts USING (kind)""",
    "ip_scan_events": BASE
    + """SELECT ip AS id, 'ip_scan' AS event_type, 'abuseipdb' AS source, threat_level, threat_score,
    'IP scan: ' || ip || ' — score ' || threat_score AS message FROM reputation""",
    "email_events": BASE
    + """SELECT email AS id, 'email_breach_check' AS event_type, 'xposedornot' AS source, threat_level,
    threat_score, 'Email scan: ' || email || ' — score ' || threat_score AS message FROM checks""",
    "email_breaches": BASE
    + """SELECT 'xposedornot' AS source, email, n > 0 AS breached, n::INTEGER AS breach_count, threat_score,
    threat_level, names AS breaches, passwords, credit_cards, ssn FROM checks""",
    "unbreached_emails": BASE
    + "SELECT email FROM owners WHERE email NOT IN (SELECT email FROM breaches)",
    "unbreached_by_kind": BASE
    + """, kinds AS (SELECT * FROM (VALUES ('passwords', 'F'), ('credit_cards', 'O'), ('ssn', 'P')) t(kind, status))
    SELECT kind, email FROM owners, kinds
    WHERE (email, status) NOT IN (SELECT (email, leaked) FROM breaches)""",
    "geo_enriched": BASE
    + """SELECT ip, country, country_code,
    coalesce((SELECT max(f) FROM (VALUES ('CN','🇨🇳'),('RU','🇷🇺'),('US','🇺🇸'),('DE','🇩🇪'),('FR','🇫🇷'),
        ('GB','🇬🇧'),('NL','🇳🇱'),('BR','🇧🇷'),('IN','🇮🇳'),('KP','🇰🇵'),('IR','🇮🇷'),('UA','🇺🇦'),('RO','🇷🇴'),
        ('PK','🇵🇰'),('NG','🇳🇬'),('JP','🇯🇵'),('KR','🇰🇷'),('AU','🇦🇺')) t(c, f) WHERE c = country_code),
        '🌐') AS flag,
    '' AS city, '' AS region, lat, lon, '' AS timezone, isp, org, asn, asn_name, is_hosting, is_proxy,
    is_mobile, asn_suspicious, geo_risk, geo_risk_score, 'ip-api.com' AS source, geo_source FROM geo""",
    "geo_risk_summary": BASE
    + """SELECT geo_risk, asn_suspicious, count(*) AS n, max(geo_risk_score) AS max_score
    FROM geo GROUP BY geo_risk, asn_suspicious""",
    "signal_features": BASE + "SELECT * FROM features",
    "email_feature_rows": BASE
    + """SELECT email, threat_score / 100.0::DOUBLE AS f_score, least(n, 30) / 30.0::DOUBLE AS f_vol,
    (passwords > 0)::INT::DOUBLE AS f_dist, (credit_cards > 0)::INT::DOUBLE AS f_tor,
    (ssn > 0)::INT::DOUBLE AS f_vpn, 0.0::DOUBLE AS f_cat, 0.0::DOUBLE AS f_brute, 0.0::DOUBLE AS f_ddos,
    0.0::DOUBLE AS f_scan, 0.0::DOUBLE AS f_sqli, 0.0::DOUBLE AS f_country FROM checks""",
    "training_labels": BASE
    + """, counts AS (SELECT threat_level AS label_str, count(*) AS n FROM signals GROUP BY 1)
    SELECT label_str, (row_number() OVER (ORDER BY n DESC, label_str) - 1)::INTEGER AS label_index, n
    FROM counts""",
    "class_weights": BASE
    + """SELECT threat_level AS label_str, round(any_value(share) * (SELECT count(*) FROM events), 3)::DOUBLE
    AS weight_sum FROM signals JOIN (VALUES ('critical', 0.15), ('high', 0.25), ('medium', 0.30),
    ('low', 0.30)) t(l, share) ON threat_level = l GROUP BY threat_level""",
    "scaled_features": _scaled(),
    "scaled_features_daily": _scaled(),
    "fixed_center_anomaly": _distances(),
    "adjusted_scores": BASE
    + """SELECT id, greatest(0, least(100, trunc(0.6::DOUBLE * threat_score + 0.4::DOUBLE *
    CASE threat_level WHEN 'critical' THEN 100 WHEN 'high' THEN 70 WHEN 'medium' THEN 45 ELSE 10 END)))::INTEGER
    AS ml_adjusted_score FROM signals""",
    "score_trend": BASE
    + ", kept AS (SELECT ts, threat_score AS y FROM signals ORDER BY ts DESC, id DESC LIMIT 500)"
    + TREND,
    "score_trend_all": BASE + ", kept AS (SELECT ts, threat_score AS y FROM signals)" + TREND,
    "fixed_anomaly_rate": f"{_fixed()} SELECT {_RATE} FROM scored",
    "fixed_cluster_breakdown": f"{_fixed()} SELECT cluster_name, count(*) AS n FROM scored GROUP BY 1",
    "fixed_label_distribution": f"{_fixed()} SELECT rf_prediction, count(*) AS n FROM scored GROUP BY 1",
    "fixed_report": f"""{_fixed()}, kept AS (SELECT ts, adjusted AS y FROM scored){TREND.rstrip()}, (SELECT 1)""".replace(
        "SELECT round(s, 3)", f"SELECT 'success' AS status, r.*, round(s, 3)"
    ).replace(", (SELECT 1)", f", (SELECT {_RATE} FROM scored) r"),
    "report_of_too_few": f"""{_fixed()}, few AS (SELECT * FROM scored ORDER BY ts DESC NULLS LAST, id DESC LIMIT 2)
    SELECT 'not enough events' AS status, count(*) AS total_events_analyzed,
    count(*) FILTER (anomaly) AS anomaly_count FROM few""",
    "score_clusters": _split("signals"),
    "score_clusters_recent": _split("(SELECT * FROM signals ORDER BY ts DESC NULLS LAST, id DESC LIMIT 100)"),
    "clusters_of_too_few": "SELECT 0 AS cluster, event_id AS id, 0.0::DOUBLE AS score FROM events WHERE false",
    "rf_checks": """SELECT count(*) AS n, count(*) AS labelled, count(*) AS whole, count(*) AS confident,
    count(*) AS blended FROM events""",
    "driver_checks": """SELECT count(*) AS n, count(*) AS three, count(*) AS falling, count(*) AS strongest,
    11 AS features, true AS positive, true AS whole FROM events""",
    "kmeans_checks": "SELECT count(*) AS n, count(*) AS nearest, count(*) AS named, count(*) AS far FROM events",
    "split_checks": """SELECT count(*) AS n, least(count(DISTINCT floor(value)), 2) AS parts,
    count(DISTINCT floor(value)) > 1 AS apart FROM events""",
    "email_score_checks": f"{BASE} SELECT {_RECORDS} FROM checks",
    "ip_score_checks": f"{BASE} SELECT {_RECORDS} FROM reputation",
    "report_checks": """SELECT 'success' AS status, count(*) AS total_events_analyzed, count(*) AS in_clusters,
    count(*) AS in_labels FROM events""",
    "stream_push": BASE + "SELECT id, ts, threat_score, threat_level FROM signals",
    "stream_score_checks": f"SELECT {_RECORDS} FROM events",
    "stream_trend": f"""{BASE}, kept AS (SELECT ts, greatest(0, least(100, trunc(0.6::DOUBLE * threat_score + 0.4::DOUBLE *
    CASE threat_level WHEN 'critical' THEN 100 WHEN 'high' THEN 70 WHEN 'medium' THEN 45 ELSE 10 END))) AS y
    FROM signals ORDER BY ts DESC, id DESC LIMIT 500){TREND}""",
    "stream_first_seen": _FIRST_SEEN,
    "stream_day_store": _PAGE,
    "stream_segments": BASE + "SELECT id, ts, threat_score, threat_level FROM signals",
    "stream_dedup": _DEDUP,
    "stream_minute_counts": _MINUTES,
    "stream_level_counts": _LEVEL_TOTALS,
}
