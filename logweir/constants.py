"""Values that results depend on, stated once."""

# Cursor start, required columns and their defaults.
EPOCH_TEXT = "1970-01-01 00:00:00"
REQUIRED_COLUMNS = ["user_id", "user", "department", "action", "src_ip", "log_source"]
DEFAULTS = {
    "user_id": "Unknown_ID",
    "user": "Unknown_User",
    "department": "Unknown_Dept",
    "src_ip": "Internal",
    "action": "Unknown_Action",
}
UNKNOWN_PERSON = "Unknown_User"
UNKNOWN_DEPARTMENT = "Unknown"
UNKNOWN_SOURCE = "Unknown"

# Log line patterns per source, named groups in order.
LINE_PATTERNS = {
    "Auth_Logs": (
        r"^(?P<timestamp>\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) \| (?P<user_id>\S+) \| "
        r"(?P<action>\S+) \| (?P<src_ip>\S+) \| (?P<method>\S+)"
    ),
    "Web_Logs": (
        r"^(?P<timestamp>\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) \| (?P<src_ip>\S+) \| "
        r"(?P<request>[^|]+) \| (?P<status>\d+) \| (?P<user_agent>.*)"
    ),
    "Firewall_Logs": (
        r"^\[(?P<action>\S+)\] src=(?P<src_ip>\S+) dst=(?P<dst_ip>\S+) dst_port=(?P<dst_port>\d+) "
        r"proto=TCP service=(?P<app_name>\S+) bytes=(?P<bytes>\d+)"
    ),
    "Endpoint_Logs": (
        r"^(?P<timestamp>\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) \| (?P<machine_name>\S+) \| "
        r"(?P<user_id>\S+) \| (?P<action>\S+) \| (?P<process_name>\S+) \| (?P<pid>\d+)"
    ),
}
ANY_TIME_PATTERN = r"(\d{4}-\d{2}-\d{2}[T\s]\d{2}:\d{2}:\d{2})"

# File-name part -> source name, first hit wins.
FILE_NAME_SOURCES = [
    ("authentication", "Auth_Logs"),
    ("webserver", "Web_Logs"),
    ("endpoint", "Endpoint_Logs"),
    ("firewall", "Firewall_Logs"),
]

# Record key -> standard column, for mapping inference.
KEY_SYNONYMS = {
    "user": "user_id",
    "user_id": "user_id",
    "ip": "src_ip",
    "src_ip": "src_ip",
    "department": "department",
    "action": "action",
    "device_id": "device_id",
    "resource": "resource",
}
# The smaller synonym set of the stand-alone mapping builder.
KEY_SYNONYMS_BASIC = {
    "user": "user_id",
    "ip": "src_ip",
    "department": "department",
    "action": "action",
}
PERSON_RULE = ("emp_name", "mapped_name")

# Shipped mapping rules (target, source) per source, in order.
MAPPING_RULES = {
    "Auth_Logs": [
        ("user_id", "user_id"),
        ("user_id", "user"),
        ("department", "department"),
        ("action", "action"),
        ("src_ip", "ip"),
        ("emp_name", "mapped_name"),
    ],
    "Web_Logs": [
        ("user_id", "user_id"),
        ("user_id", "user"),
        ("department", "department"),
        ("action", "action"),
        ("resource", "resource"),
        ("src_ip", "ip"),
        ("emp_name", "mapped_name"),
    ],
    "Endpoint_Logs": [
        ("user_id", "user_id"),
        ("user_id", "user"),
        ("department", "department"),
        ("action", "action"),
        ("device_id", "device_id"),
        ("emp_name", "mapped_name"),
    ],
    "Firewall_Logs": [
        ("user_id", "user_id"),
        ("user_id", "user"),
        ("department", "department"),
        ("src_ip", "src_ip"),
        ("action", "action"),
        ("emp_name", "mapped_name"),
    ],
}

# Detection rules on `action` (value, risk score, message).
DEFAULT_RISK_SCORE = 10.0
DEFAULT_ALERT_MESSAGE = "Info: 정상 업무 활동"
DETECTION_RULES = [
    ("Reverse_Shell_C2", 99.0, "🚨 CRITICAL: 랜섬웨어/C2 서버 비인가 통신 감지!"),
    ("Massive_FTP_Exfiltration", 95.0, "🚨 HIGH: 내부자 대규모 기밀 유출 시도 (FTP)"),
    ("Unauthorized_DB_Dump", 90.0, "🚨 HIGH: 비인가 DB 덤프 및 데이터 추출 시도"),
    ("SSH_BruteForce", 85.0, "⚠️ WARN: 무차별 대입 공격 (SSH Brute Force) 도배"),
]
NOTIFY_SCORE = 90.0
# From this score on a day of a user stands out from the days before.
BEHAVIOUR_SCORE = 75.0
BEHAVIOUR_MESSAGE = "WARN: unusual for this user"

# Sink formats and keys.
NUMERIC_SINK_COLUMNS = [
    "duration", "src_port", "dst_port", "packets_total", "bytes_total", "risk_score",
]
LOG_ZONE = "Asia/Seoul"
SINK_UTC_OFFSET = "+09:00"
UNIQUE_KEY = ["final_ts", "emp_id", "src_ip", "log_source"]
HISTORY_PAGE = 30
ERROR_SAMPLE = 3
TRIGGER_INTERVAL = "30 seconds"

# Rows that are counted but not kept: their `load_status` and `error_reason`.
LATE, BLANK = "late", "blank"
