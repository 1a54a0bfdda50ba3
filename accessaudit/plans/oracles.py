"""The registered queries in plain SQL for DuckDB, written from the operators' definitions."""

from __future__ import annotations

from accessaudit.plans.testbed import CLOCK_MS, MODEL_LEVELS, SERVICE_RULES, SINCE_MS

_LEVEL = dict(MODEL_LEVELS)
_RULES = ", ".join("('{port}', '{ip}', '{error}', '{url}')".format(**r) for r in SERVICE_RULES)

FLOW = """
flow AS (
  SELECT event_id, concat('10.0.0.', CAST(user_id AS VARCHAR)) AS ip,
    concat('192.168.0.', CAST(event_id % 5 AS VARCHAR)) AS "serviceIp",
    CAST(8080 + CAST(props->>'$.k' AS INT) % 10 AS VARCHAR) AS port,
    strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "requestTime",
    CASE WHEN event_type IN ('signup', 'error') THEN 'POST /cas/login'
      WHEN event_type = 'purchase' THEN 'POST /pay'
      WHEN event_type = 'view' THEN 'GET /view' ELSE 'GET /' END AS url,
    CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 50 = 1 THEN 'noequals'
      ELSE concat('service=app&username=u', CAST(user_id AS VARCHAR)) END AS query,
    CASE event_type WHEN 'error' THEN '401' WHEN 'signup' THEN '302'
      WHEN 'purchase' THEN NULL ELSE '200' END AS status_code
  FROM events)
"""

REFERENCES = f"""
area AS (
  SELECT concat('10.0.0.', CAST(c_custkey AS VARCHAR)) AS c_ip, n_name AS c_area
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal >= 0
  UNION ALL
  SELECT concat('10.0.0.', CAST(s_suppkey AS VARCHAR)), n_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
sys AS (
  SELECT CAST(r_regionkey AS VARCHAR) AS id, CAST(8080 + 2 * r_regionkey AS VARCHAR) AS port FROM region
  UNION ALL
  SELECT CAST(100 + n_nationkey AS VARCHAR), CAST(8080 + 3 * n_nationkey AS VARCHAR) FROM nation),
whitelist AS (
  SELECT concat('10.0.0.', CAST(c_custkey AS VARCHAR)) AS ip FROM customer WHERE c_mktsegment <> 'BUILDING'),
service AS (SELECT * FROM (VALUES {_RULES}) AS t(port, ip, error, url))
"""

VISITS = """
monitored AS (
  SELECT * FROM flow WHERE port IN (SELECT port FROM service) AND "serviceIp" IN (SELECT ip FROM service)),
visits AS (SELECT * FROM monitored WHERE status_code IS NOT NULL),
enriched AS (
  SELECT v.*, a.c_area, s.id AS sysid
  FROM visits v LEFT JOIN area a ON v.ip = a.c_ip LEFT JOIN sys s ON v.port = s.port),
inside AS (SELECT * FROM enriched WHERE ip IN (SELECT ip FROM whitelist)),
outside AS (SELECT * FROM enriched WHERE ip NOT IN (SELECT ip FROM whitelist)),
failed AS (
  SELECT * FROM inside
  WHERE status_code IN (SELECT error FROM service) AND url IN (SELECT url FROM service)),
succeeded AS (
  SELECT * FROM inside
  WHERE status_code NOT IN (SELECT error FROM service) AND url IN (SELECT url FROM service)),
success_users AS (
  SELECT event_id, ip, "requestTime", c_area, sysid, string_split(query, '=')[-1] AS "user" FROM succeeded)
"""

VERDICTS = f"""
verdicts AS (
  SELECT *, '1' AS type, {_LEVEL[1]} AS level, 1 AS status FROM outside
  UNION ALL SELECT *, '3', {_LEVEL[4]}, 1 FROM failed
  UNION ALL SELECT *, '0', 0, 0 FROM succeeded),
results AS (
  SELECT row_number() OVER (ORDER BY event_id, sysid NULLS FIRST, c_area NULLS FIRST) AS pid, event_id, ip,
    CASE WHEN type = '1' THEN ' ' ELSE string_split(query, '=')[-1] END AS "user",
    sysid AS subsystem, "requestTime", c_area AS area, type, level, status,
    CAST({CLOCK_MS} AS BIGINT) AS update_time, status AS abnormal
  FROM verdicts)
"""

RULES = """
models AS (SELECT c_custkey AS id, c_nationkey AS mleve FROM customer WHERE c_acctbal >= 0),
docs AS (
  SELECT o_orderkey AS id, o_custkey AS "modeId",
    CASE WHEN o_orderstatus = 'F' THEN '[{"ip":"10.0.0.' || CAST(o_custkey AS VARCHAR) || '"},{"port":"'
        || CAST(8080 + o_orderkey % 10 AS VARCHAR) || '","ip":"192.168.0.' || CAST(o_orderkey % 3 AS VARCHAR)
        || '","error":"401","url":"POST /cas/login"}]'
      WHEN o_orderstatus = 'O' THEN '{"ip":"10.0.0.' || CAST(o_custkey AS VARCHAR) || '"}'
      WHEN o_orderpriority LIKE '1%' THEN 'bad'
      WHEN o_orderpriority LIKE '2%' THEN '[]'
      WHEN o_orderpriority LIKE '3%' THEN ''
      WHEN o_orderpriority LIKE '4%' THEN '[{"port":' || CAST(8080 + o_orderkey % 10 AS VARCHAR) || '}]'
      END AS jsonstr
  FROM orders),
newest AS (
  SELECT m.id, m.mleve AS level, d.jsonstr
  FROM models m LEFT JOIN docs d ON m.id = d."modeId"
  QUALIFY row_number() OVER (PARTITION BY m.id ORDER BY d.id DESC NULLS LAST) = 1),
readable AS (SELECT * FROM newest WHERE json_valid(jsonstr) AND json_type(jsonstr) IN ('ARRAY', 'OBJECT')),
objects AS (
  SELECT id, level, unnest(CASE json_type(jsonstr) WHEN 'ARRAY' THEN json_extract(jsonstr, '$[*]')
    ELSE [CAST(jsonstr AS JSON)] END) AS o
  FROM readable),
rules AS (
  SELECT id, level, o->>'$.port' AS port, o->>'$.ip' AS ip, o->>'$.error' AS error, o->>'$.url' AS url
  FROM objects)
"""

USER_IP = """
user_ip AS (
  SELECT event_id AS pid, concat('10.0.0.', CAST(user_id AS VARCHAR)) AS ip,
    concat('u', CAST(user_id + event_id % 3 AS VARCHAR)) AS username
  FROM events WHERE event_type = 'signup'),
latest AS (SELECT * FROM user_ip WHERE pid IN (SELECT max(pid) FROM user_ip GROUP BY ip))
"""

_AUDIT = (FLOW, REFERENCES, VISITS, VERDICTS)


def _sql(body: str, *parts: str) -> str:
    return ("WITH " + ",".join(parts) if parts else "") + body


def oracles() -> dict[str, str]:
    flow = lambda body: _sql(body, FLOW)
    audit = lambda body: _sql(body, *_AUDIT)
    rules = lambda body: _sql(body, RULES)
    users = lambda body: _sql(body, *_AUDIT, USER_IP)
    identity = "ip, \"requestTime\", c_area, sysid, string_split(query, '=')[-1] AS \"user\""
    alarm = """pid, "user" AS username, level, concat('{"pid":', pid, CASE WHEN "user" IS NULL THEN '' ELSE
        concat(',"username":"', "user", '"') END, ',"level":', level, '}') AS message"""
    null_text = ", ".join(
        f"coalesce({c}, 'null') AS {c}" for c in ("ip", '"user"', "subsystem", '"requestTime"', "area")
    )
    plain = "event_id, ip, \"user\", subsystem, \"requestTime\", area, type, level, status, update_time, abnormal"
    user_map = """
        SELECT concat('ip_', ip) AS key, "user", "requestTime", event_id FROM success_users
        WHERE "user" IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY ip ORDER BY "requestTime" DESC, event_id DESC) = 1"""
    return {
        "packet_stream": flow("SELECT * FROM flow"),
        "resume_offsets": """
            WITH earliest AS (SELECT CAST(user_id AS INT) AS part, min(event_id) AS off
                FROM events WHERE event_type = 'click' AND value > 30 GROUP BY 1),
            stored AS (SELECT CAST(user_id AS INT) AS part, min(event_id) AS off
                FROM events WHERE event_type = 'purchase' AND value > 100 GROUP BY 1)
            SELECT e.part, CASE WHEN s.off >= e.off THEN s.off ELSE e.off END AS off
            FROM earliest e LEFT JOIN stored s ON e.part = s.part""",
        "resumed_flow": flow("""
            , earliest AS (SELECT user_id, min(event_id) AS off FROM events WHERE event_type = 'click' AND value > 30 GROUP BY 1),
            stored AS (SELECT user_id, min(event_id) AS off FROM events WHERE event_type = 'purchase' AND value > 100 GROUP BY 1)
            SELECT f.* FROM flow f JOIN events e USING (event_id) JOIN earliest a ON a.user_id = e.user_id
            LEFT JOIN stored s ON s.user_id = e.user_id WHERE event_id >= greatest(a.off, coalesce(s.off, a.off))"""),
        "table_scan": "SELECT * FROM customer",
        "parse_packets": flow("""
            SELECT event_id, CAST(0 AS INT) AS packet_no, "requestTime" AS stamp, ip AS source_ip,
              "serviceIp" AS destination_ip, port AS destination_port, url AS request, query AS url_query,
              status_code AS response_code FROM flow"""),
        "corrupt_packets": """
            SELECT 'conversations' AS origin, conv_id AS id, turn AS part, text AS value FROM conversations
            WHERE text IS NULL OR NOT json_valid(text) OR json_type(text) NOT IN ('ARRAY', 'OBJECT')""",
        "project_flow": flow("SELECT * FROM flow"),
        "column_gate": flow("""
            SELECT *, substr("requestTime", 1, 16) AS minute FROM flow
            WHERE substr("requestTime", 1, 16) IN (
              SELECT substr("requestTime", 1, 16) FROM flow GROUP BY 1
              HAVING bool_or(url IS NOT NULL) AND bool_or(status_code IS NOT NULL) AND bool_or("serviceIp" IS NOT NULL))"""),
        "inferred_fields": flow("""
            , held AS (SELECT substr("requestTime", 1, 10) AS day, unnest([
                {'path': '@timestamp', 'kind': 'STRING', 'n': "requestTime" IS NOT NULL},
                {'path': 'source', 'kind': 'OBJECT', 'n': true}, {'path': 'source.ip', 'kind': 'STRING', 'n': ip IS NOT NULL},
                {'path': 'destination', 'kind': 'OBJECT', 'n': true},
                {'path': 'destination.ip', 'kind': 'STRING', 'n': "serviceIp" IS NOT NULL},
                {'path': 'destination.port', 'kind': 'BIGINT', 'n': port IS NOT NULL},
                {'path': 'query', 'kind': 'STRING', 'n': url IS NOT NULL}, {'path': 'url', 'kind': 'OBJECT', 'n': true},
                {'path': 'url.query', 'kind': 'STRING', 'n': query IS NOT NULL},
                {'path': 'http', 'kind': 'OBJECT', 'n': status_code IS NOT NULL},
                {'path': 'http.response', 'kind': 'OBJECT', 'n': status_code IS NOT NULL},
                {'path': 'http.response.status_code', 'kind': 'BIGINT', 'n': status_code IS NOT NULL}]) AS f FROM flow)
            SELECT day, f.path AS path, f.kind AS kind, count(*) AS records, CAST(0 AS BIGINT) AS nulls
            FROM held WHERE f.n GROUP BY 1, 2, 3"""),
        "inferred_gate": flow("""
            SELECT event_id, substr("requestTime", 1, 16) AS minute FROM flow
            WHERE substr("requestTime", 1, 16) IN (
              SELECT substr("requestTime", 1, 16) FROM flow GROUP BY 1
              HAVING bool_or(url IS NOT NULL) AND bool_or(status_code IS NOT NULL) AND bool_or("serviceIp" IS NOT NULL))"""),
        "inferred_packets": flow("""
            SELECT * REPLACE (CAST(port AS BIGINT) AS port, CAST(status_code AS BIGINT) AS status_code) FROM flow"""),
        "monitored_service": audit("SELECT * FROM monitored"),
        "visit_flow": audit("SELECT * FROM visits"),
        "outside_whitelist": audit("SELECT * FROM outside"),
        "inside_whitelist": audit("SELECT * FROM inside"),
        "inside_long_list": flow("""
            SELECT * FROM flow WHERE ip IN (SELECT concat('10.0.0.', CAST(o_custkey AS VARCHAR)) FROM orders WHERE o_orderstatus = 'P')"""),
        "auth_failure": audit("SELECT * FROM failed"),
        "auth_success": audit("SELECT * FROM succeeded"),
        "auth_failure_users": audit(f"SELECT {identity} FROM failed"),
        "auth_success_users": audit(f"SELECT {identity} FROM succeeded"),
        "success_not_401": audit("SELECT * FROM inside WHERE status_code NOT IN ('401')"),
        "classify_flow": audit("SELECT * FROM verdicts"),
        "enrich_area": audit("SELECT f.*, a.c_area FROM flow f LEFT JOIN area a ON f.ip = a.c_ip"),
        "enrich_area_laid_out": audit("SELECT f.*, a.c_area FROM flow f LEFT JOIN area a ON f.ip = a.c_ip"),
        "enrich_system": audit("SELECT f.*, s.id AS sysid FROM flow f LEFT JOIN sys s ON f.port = s.port"),
        "model_rules": rules("SELECT * FROM newest"),
        "latest_user_semijoin": _sql("SELECT * FROM latest", USER_IP),
        "attach_known_user": users("SELECT n.*, u.username FROM success_users n LEFT JOIN latest u ON n.ip = u.ip"),
        "max_pid_per_ip": _sql("SELECT ip, max(pid) AS pid FROM user_ip GROUP BY ip", USER_IP),
        "max_pid_in_levels": _sql("SELECT ip, max(pid) AS pid FROM user_ip GROUP BY ip", USER_IP),
        "explode_rules": rules("SELECT * FROM rules"),
        "missing_rules": rules("""
            SELECT * FROM newest WHERE jsonstr IS NULL OR NOT json_valid(jsonstr)
              OR json_type(jsonstr) NOT IN ('ARRAY', 'OBJECT')"""),
        "rule_values": rules("""
            SELECT attribute, value, max(level) AS level FROM (
              SELECT level, 'port' AS attribute, port AS value FROM rules
              UNION ALL SELECT level, 'ip', ip FROM rules
              UNION ALL SELECT level, 'error', error FROM rules
              UNION ALL SELECT level, 'url', url FROM rules) GROUP BY attribute, value"""),
        "model_level": rules("""
            SELECT w.id, coalesce(m.level, 0) AS level FROM (SELECT DISTINCT "modeId" AS id FROM docs) w
            LEFT JOIN (SELECT id, max(mleve) AS level FROM models GROUP BY id) m ON w.id = m.id"""),
        "extract_user": flow("SELECT event_id, string_split(query, '=')[-1] AS \"user\" FROM flow"),
        "extract_user_pages": """
            SELECT page_id, CASE WHEN contains(url, '?')
              THEN string_split(string_split(url, '?')[-1], '=')[-1] END AS "user" FROM pages""",
        "request_date": flow('SELECT event_id, CAST(substr("requestTime", 1, 10) AS DATE) AS request_date FROM flow'),
        "request_day": flow('SELECT event_id, substr("requestTime", 1, 10) AS request_day FROM flow'),
        "dense_ids": audit("""
            SELECT row_number() OVER (ORDER BY event_id, sysid NULLS FIRST, c_area NULLS FIRST) AS pid,
              event_id, sysid, c_area, type FROM verdicts"""),
        "result_rows": audit("SELECT * FROM results"),
        "result_rows_null_text": audit(
            f"SELECT event_id, {null_text}, type, level, status, update_time, abnormal FROM results"
        ),
        "labelled_result_rows": audit(f"""
            SELECT event_id, ip, string_split(query, '=')[-1] AS "user", sysid AS subsystem, "requestTime",
              c_area AS area, '3' AS type, 2 AS level, 1 AS status, CAST({CLOCK_MS} AS BIGINT) AS update_time,
              1 AS abnormal FROM failed"""),
        "violation_rows": audit(f"SELECT {plain} FROM results WHERE type = '1'"),
        "alarm_messages": audit(f"SELECT {alarm} FROM results WHERE type = '3'"),
        "alarms_since": audit(f"""
            SELECT {alarm} FROM results
            WHERE status = 1 AND "user" <> 'null'
              AND epoch_ms(CAST(replace(replace("requestTime", 'T', ' '), 'Z', '') AS TIMESTAMP)) > {SINCE_MS}"""),
        "alarm_scans": audit(f"""
            SELECT {alarm} FROM results
            WHERE status = 1 AND "user" <> 'null'
              AND epoch_ms(CAST(replace(replace("requestTime", 'T', ' '), 'Z', '') AS TIMESTAMP)) > {SINCE_MS}"""),
        "ip_user_map": audit(user_map),
        "user_map_in_levels": audit(user_map),
        "short_user_pairs": audit("SELECT DISTINCT ip, \"user\" FROM success_users WHERE length(\"user\") < 8"),
        "user_ip_rows": audit(f"""
            SELECT ip, "user" AS username, CAST({CLOCK_MS} AS BIGINT) AS update_time
            FROM (SELECT DISTINCT ip, "user" FROM success_users WHERE length("user") < 8)"""),
        "verdict_summary": audit("""
            SELECT type, substr("requestTime", 1, 10) AS request_day, sysid AS subsystem, count(*) AS visits
            FROM verdicts GROUP BY 1, 2, 3"""),
        "dedup_replay": flow("SELECT * FROM flow"),
        "stream_classify": audit(f"SELECT {plain} FROM results"),
        "stream_pids": audit("""
            SELECT count(*) AS rows, CAST(1 AS BIGINT) AS first, count(*) AS last, count(*) AS ids FROM results"""),
        "stream_alarms": audit("""
            SELECT event_id, subsystem, area, "user" AS username, level FROM results WHERE type = '3'"""),
        "stream_user_map": audit(user_map),
        "two_phase_results": audit(f"SELECT {plain} FROM results"),
        "keyed_user_map": audit(user_map),
        "stream_summary": audit("""
            , timed AS (
              SELECT v.type, v.sysid AS subsystem, substr(v."requestTime", 1, 10) AS request_day,
                epoch(CAST(replace(replace(v."requestTime", 'T', ' '), 'Z', '') AS TIMESTAMP)) AS sec,
                CAST(floor((day(e.ts) - 1) / 7) AS INT) + CASE WHEN CAST(e.props->>'$.k' AS INT) % 7 = 0 THEN 1 ELSE 0 END AS delivery
              FROM verdicts v JOIN events e USING (event_id)),
            marks AS (SELECT d.delivery, (SELECT max(sec) FROM timed t WHERE t.delivery < d.delivery) - 86400 AS mark
              FROM (SELECT DISTINCT delivery FROM timed) d),
            marked AS (SELECT t.*, CASE WHEN (floor(sec / 86400) + 1) * 86400 <= mark THEN 'late' ELSE 'on time' END AS arrival
              FROM timed t JOIN marks USING (delivery))
            SELECT arrival, type, request_day, subsystem, count(*) AS visits FROM marked
            WHERE arrival = 'late' OR (floor(sec / 86400) + 1) * 86400 <= (SELECT max(sec) FROM timed) - 86400
            GROUP BY 1, 2, 3, 4"""),
        "classify_from_documents": audit("SELECT * FROM verdicts").replace(
            "SELECT concat('10.0.0.', CAST(c_custkey AS VARCHAR)) AS ip FROM customer WHERE c_mktsegment <> 'BUILDING'",
            "SELECT concat('10.0.0.', CAST(n_nationkey AS VARCHAR)) AS ip FROM nation",
        ),
    }
