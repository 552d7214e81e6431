"""Fixed values. They must stay as they are: results depend on each of them."""

# Score bands, highest first; anything below the last one is DEFAULT_LEVEL.
LEVEL_BANDS = (("critical", 85), ("high", 60), ("medium", 35))
DEFAULT_LEVEL = "low"
LEVELS = ("critical", "high", "medium", "low")

# Report category codes of the reputation service.
CATEGORY_NAMES = {
    3: "Fraud Orders",
    4: "DDoS Attack",
    5: "FTP Brute-Force",
    6: "Ping of Death",
    7: "Phishing",
    9: "Open Proxy",
    10: "Web Spam",
    11: "Email Spam",
    14: "Port Scan",
    15: "Hacking",
    16: "SQL Injection",
    17: "Spoofing",
    18: "Brute-Force",
    19: "Bad Web Bot",
    20: "Exploited Host",
    21: "Web App Attack",
    22: "SSH",
    23: "IoT Targeted",
}
UNKNOWN_CATEGORY_PREFIX = "Category "
MAX_CATEGORIES = 6

VPN_USAGE_TYPES = ("VPN", "Hosting", "Data Center")

# Country weight used as a model feature.
MODEL_HIGH_COUNTRIES = ("CN", "RU", "KP", "IR", "UA", "SY", "LY", "IQ")
MODEL_MEDIUM_COUNTRIES = ("BR", "IN", "NG", "RO", "PK", "BD")
MODEL_COUNTRY_WEIGHTS = {"high": 1.0, "medium": 0.5, "other": 0.1}

# Country risk used for geolocation. It differs from the model table on purpose.
GEO_HIGH_COUNTRIES = ("CN", "RU", "KP", "IR", "SY", "LY", "IQ", "AF", "SD", "BY", "VE", "CU")
GEO_MEDIUM_COUNTRIES = ("UA", "RO", "BR", "NG", "PK", "BD", "IN", "VN", "ID", "PH", "MX", "EG")
GEO_RISK_SCORES = {"high": 80, "medium": 45, "low": 10}
ASN_UPLIFT = 25
ASN_KEYWORDS = (
    "choopa", "vultr", "frantech", "hostkey", "selectel", "serverius",
    "qhoster", "sharktech", "ecatel", "leaseweb", "m247", "combahton",
    "pq.hosting", "alexhost", "psychz", "nexeon", "inferno",
)

COUNTRY_FLAGS = {
    "CN": "🇨🇳", "RU": "🇷🇺", "US": "🇺🇸", "DE": "🇩🇪", "FR": "🇫🇷", "GB": "🇬🇧",
    "NL": "🇳🇱", "BR": "🇧🇷", "IN": "🇮🇳", "KP": "🇰🇵", "IR": "🇮🇷", "UA": "🇺🇦",
    "RO": "🇷🇴", "PK": "🇵🇰", "NG": "🇳🇬", "JP": "🇯🇵", "KR": "🇰🇷", "AU": "🇦🇺",
    "CA": "🇨🇦", "IT": "🇮🇹", "ES": "🇪🇸", "SE": "🇸🇪", "CH": "🇨🇭", "SG": "🇸🇬",
    "BY": "🇧🇾", "VE": "🇻🇪", "TR": "🇹🇷", "TH": "🇹🇭", "ID": "🇮🇩", "PH": "🇵🇭",
}
NO_FLAG = "🌐"

# Source names written into result rows.
REPUTATION_SOURCE = "abuseipdb"
BREACH_SOURCE = "xposedornot"
GEO_SOURCE = "ip-api.com"

# Addresses that always answer with a fixed reputation.
OVERRIDE_COLUMNS = (
    "ip", "threat_score", "threat_level", "country", "isp", "domain", "is_tor", "is_vpn",
    "total_reports", "distinct_users", "recent_categories",
)
OVERRIDES = (
    ("9.9.9.9", 100, "critical", "RU", "Test Malicious ISP", "hacker-test.net", True, False,
     5000, 1500, ["DDoS Attack", "Port Scan", "Hacking"]),
    ("8.8.8.8", 45, "medium", "US", "Test Medium ISP", "scanner-test.com", False, True,
     42, 5, ["Port Scan", "Web Spam"]),
    ("7.7.7.7", 75, "high", "CN", "Test High ISP", "botnet-test.cn", False, False,
     850, 120, ["Brute-Force", "SSH Login Attempts"]),
)

# Breach scoring: points per breach, cap, and (least count, floor) steps.
BREACH_POINTS = 12
BREACH_CAP = 100
BREACH_FLOORS = ((8, 85), (5, 60), (2, 35))
BREACH_ENVELOPES = ("Exposure", "exposedBreaches")

# Event texts.
IP_EVENT_TYPE = "ip_scan"
EMAIL_EVENT_TYPE = "email_breach_check"
IP_EVENT_MESSAGE = "IP scan: %s — score %d"
EMAIL_EVENT_MESSAGE = "Email scan: %s — score %d"
SIGNAL_TEXTS = {
    "ddos": ("ddos-monitor", "DDoS origin node detected at %s"),
    "brute_force": ("auth-logs", "SSH brute-force attempt from %s"),
    "port_scan": ("firewall-syslog", "Port scan sweep originating from %s"),
    "web_exploit": ("waf-alerts", "Web exploit payload detected from %s"),
    "phishing": ("phish-intel", "Phishing kit deployed at %s"),
    "tor": ("tor-exit-watcher", "TOR exit node %s flagged for suspicious traffic"),
    "critical": ("botnet-feed", "Critical threat beacon from %s"),
    "other": ("threat-intel-feed", "Suspicious activity reported from %s"),
}
CRITICAL_BEACON_SCORE = 85

# Model features, in vector order, with the clip of each count.
FEATURES = (
    "f_score", "f_vol", "f_dist", "f_tor", "f_vpn", "f_cat",
    "f_brute", "f_ddos", "f_scan", "f_sqli", "f_country",
)
REPORTS_CLIP = 10000
USERS_CLIP = 500
CATEGORIES_CLIP = 10
BREACHES_CLIP = 30

# Model settings and result texts.
FOREST_TREES = 20
FOREST_DEPTH = 4
CLUSTERS = 4
SEED = 42
CLUSTER_NAMES = ("Botnet Node", "Port Scanner", "Spammer", "Clean")
UNKNOWN_CLUSTER = "Unknown"
ANOMALY_DISTANCE = 3.5
TOP_DRIVERS = 3
LEVEL_WEIGHTS = {"critical": 100, "high": 70, "medium": 45, "low": 10}
RAW_SHARE, LEVEL_SHARE = 0.6, 0.4
TRAINING_MIX = {"critical": 0.15, "high": 0.25, "medium": 0.30, "low": 0.30}
DEFAULT_REPORT_COUNTRY = "US"

# Trend: a slope beyond +-2 points per hour is a direction.
TREND_SLOPE = 2.0
TREND_ROWS, TREND_MIN_ROWS = 500, 10
SPLIT_ROWS, SPLIT_MIN_ROWS = 100, 5
REPORT_ROWS, REPORT_MIN_ROWS, REPORT_SAMPLE = 200, 3, 5
PAGE_ROWS, REPLAY_ROWS, VELOCITY_ROWS = 20, 10, 200
REPORT_MAX_AGE_DAYS = 90

# Event topic.
TOPIC = "threat-signals"
CONSUMER_GROUP = "threat-ui-group"
BOOTSTRAP = "localhost:9092"
