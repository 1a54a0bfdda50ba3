"""Fixed schemas. Nothing is inferred from data on the hot path."""

# Ports and status codes are read as text, so `80` and `"80"` compare alike and no
# comparison ever depends on a type guessed from the batch at hand. `_malformed` holds the
# text of a record that is no packet object.
PACKET = (
    "struct<"
    "`@timestamp`:string,"
    "source:struct<ip:string>,"
    "destination:struct<ip:string,port:string>,"
    "query:string,"
    "url:struct<query:string>,"
    "http:struct<response:struct<status_code:string>>,"
    "_malformed:string>"
)
PACKET_OPTIONS = {"columnNameOfCorruptRecord": "_malformed"}
PACKETS = f"array<{PACKET}>"
PACKET_FIELDS = ("@timestamp", "source", "destination", "query", "url", "http")

RULES = "array<struct<port:string,ip:string,error:string,url:string>>"
RULE_ATTRIBUTES = ("port", "ip", "error", "url")

# Verdict codes and the models whose rules decide them.
OUTSIDE_WHITELIST = "1"
LOGIN_FAILED = "3"
LOGIN_SUCCEEDED = "0"
WHITELIST_MODEL = 1
SERVICE_MODEL = 4

RESULT_COLUMNS = (
    "pid", "ip", "user", "subsystem", "requestTime", "area",
    "type", "level", "status", "update_time", "abnormal",
)
RESULT_DDL = (
    "pid bigint, ip string, user string, subsystem string, requestTime string, area string, "
    "type string, level int, status int, update_time bigint, abnormal int"
)
