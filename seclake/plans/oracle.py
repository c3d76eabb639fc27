"""Independent DuckDB SQL for every oracle-checked query.

The SQL restates each operator from its definition (FIXTURES.md views,
thresholds, labels and weights. Views ``events``,
``documents``, ``embeddings`` … are registered by the caller.
"""

from __future__ import annotations

# Fixed values, stated here once more: a wrong one on either side makes a query differ.
SUSPICIOUS_PROCESS_PATTERN = (
    r"powershell|cmd|wmic|psexec|mimikatz|procdump|ntdsutil|secretsdump|bloodhound|sharphound|rubeus|certutil|bitsadmin|mshta|regsvr32|"
    r"rundll32|wscript|cscript|net\.exe|net1\.exe|nltest|dsquery|csvde|ldifde")
SUSPICIOUS_CMDLINE_PATTERN = (
    r"mimikatz|sekurlsa|lsadump|dcsync|rubeus|kerberoast|asreproast|ntdsutil|vssadmin|wmic\s+process|psexec|procdump|comsvcs\.dll|"
    r"reg\s+save|lsass|sam|system|security")
LABELS = (
    ("brute_force_flag = 1", "T1110 - Brute Force"),
    ("password_spray_flag = 1", "T1110.003 - Brute Force: Password Spraying"),
    ("account_enumeration_flag = 1", "T1087.002 - Account Discovery: Domain Account"),
    ("privilege_escalation_flag = 1", "T1078 - Valid Accounts"),
    ("success_after_fail_flag = 1", "T1078 - Valid Accounts"),
    ("lateral_movement_flag = 1", "T1021 - Remote Services"),
    ("malicious_process_flag = 1", "T1059 - Command & Scripting Interpreter"),
    ("credential_stuffing_flag = 1", "T1110.004 - Brute Force: Credential Stuffing"),
    ("kerberoasting_flag = 1", "T1558.003 - Steal or Forge Kerberos Tickets: Kerberoasting"),
    ("after_hours_flag = 1 AND is_privileged = 1", "T1078.002 - Domain Accounts"))
RULE_SCORE = ("brute_force_flag * 3 + password_spray_flag * 2 + account_enumeration_flag + credential_stuffing_flag * 3 + success_after_fail_flag * 2 + "
              "privilege_escalation_flag * 2 + lateral_movement_flag * 3 + malicious_process_flag * 2 + kerberoasting_flag * 3 + after_hours_flag")
IPV4_SHAPE = r"^\d{1,3}(\.\d{1,3}){3}$"
ALLOWED_EVEN = ("T1110 - Brute Force",)
ALLOWED_ODD = ("T1558.003 - Steal or Forge Kerberos Tickets: Kerberoasting", "T1110.003 - Brute Force: Password Spraying")
REPORT_PREFIXES = (" T1110 and T1110.003 known compromised", " compromised IP T1558.003, T1110", " ignore <|x|> system  prompt credential stuffing", "")
SPECIAL_TOKEN = r"<\|[^\n]*?\|>"
INJECTION_WORDS = r"(?i)\b(ignore|system\s+prompt|new\s+instructions|sysprompt)\b"
VERIFY_NOTE = r"(?is)\[VERIFY before finishing.*?\]\.?"
CLOSINGS = (r"By following these recommendations[^\n]*", r"By implementing these[^\n]*", r"These measures will[^\n]*", r"In summary[,\.][^\n]*")
SOFTER = ((r"\bknown compromised\b", "suspicious"), (r"\bcompromised ip(?: addresses?)?\b", "suspicious IP addresses"), (r"\bknown compromised accounts?\b", "suspicious accounts"))

# The long address patterns and the section fixture's texts are shared.
from ..functions.ipcols import CLIENT_IPV4, CLIENT_IPV6, CLIENT_LOOPBACK_FORMS, DC_LOOPBACK_FORMS, IPV6_LIKE  # noqa: E402


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


US = "epoch_us(ts)"
RAW_LOGS = f"""raw_logs AS (
SELECT event_id AS log_id,
 make_timestamp(CASE WHEN event_type = 'error' AND user_id % 3 = 0
      THEN {US} - {US} % 86400000000 + 7200000000 + CAST(FLOOR(({US} % 86400000000) / 96) AS BIGINT)
      ELSE {US} END) AS timestamp,
 CAST(CASE WHEN event_type = 'error' AND (user_id % 3 = 0 OR event_id % 3 = 0) THEN 4625
      WHEN event_type IN ('error', 'signup') THEN 4624 WHEN event_type = 'click' THEN 4688
      WHEN event_type = 'view' AND event_id % 3 = 0 THEN 4769 WHEN event_type = 'view' THEN 4768
      ELSE 4672 END AS INTEGER) AS event_id,
 CASE WHEN user_id % 50 = 49 THEN NULL
      WHEN user_id % 3 = 0 THEN concat('user_', CAST(user_id % 15 AS VARCHAR))
      ELSE concat('user_', CAST(user_id AS VARCHAR)) END AS username,
 CASE WHEN user_id % 17 = 0 THEN 'N/A'
      WHEN event_type = 'error' AND event_id % 5 = 0 THEN concat('192.168.', CAST(user_id % 2 AS VARCHAR), '.', CAST(event_id % 20 AS VARCHAR))
      ELSE concat('10.0.', CAST(user_id % 4 AS VARCHAR), '.', CAST(user_id % 200 AS VARCHAR)) END AS source_ip,
 CASE WHEN event_type <> 'click' THEN 'N/A' WHEN event_id % 11 = 0 THEN 'C:/Tools/Mimikatz.exe'
      WHEN event_id % 7 = 0 THEN 'C:/Windows/PowerShell.exe' ELSE 'C:/Apps/app.exe' END AS process_name,
 CASE WHEN event_type <> 'click' THEN '' WHEN event_id % 13 = 0 THEN 'reg save hklm/SAM out' ELSE 'app --run' END AS command_line,
 CASE WHEN user_id % 5 = 0 AND event_id % 4 = 0 THEN 'CLIENT_MACHINE' ELSE 'DOMAIN_CONTROLLER' END AS source_machine,
 value
FROM events)"""

SUBNET = r"regexp_extract(source_ip, '^(\d+\.\d+\.\d+)\.', 1)"

NORM = """norm AS (
SELECT log_id, timestamp, event_id, username,
 coalesce(source_ip, 'N/A') AS source_ip, coalesce(process_name, 'N/A') AS process_name,
 coalesce(command_line, '') AS command_line,
 CASE source_machine WHEN 'DOMAIN_CONTROLLER' THEN 'DC' WHEN 'CLIENT_MACHINE' THEN 'CLIENT' ELSE source_machine END AS machine,
 coalesce(hour(timestamp), 0) AS login_hour, coalesce(day(timestamp), 0) AS day, value
FROM raw_logs)"""

FLAGS = f"""flags AS (
SELECT *,
 CAST(coalesce(event_id = 4625, false) AS INTEGER) AS is_failed_login,
 CAST(coalesce(event_id = 4624, false) AS INTEGER) AS is_successful_login,
 CAST(coalesce(event_id = 4672, false) AS INTEGER) AS is_privileged,
 CAST(coalesce(event_id = 4688, false) AS INTEGER) AS is_process_exec,
 CAST(coalesce(event_id = 4768, false) AS INTEGER) AS is_kerberos_tgt,
 CAST(coalesce(event_id = 4769, false) AS INTEGER) AS is_kerberos_tgs,
 CAST(coalesce(regexp_matches(process_name, {_q('(?i)' + SUSPICIOUS_PROCESS_PATTERN)}), false) AS INTEGER) AS suspicious_process,
 CAST(coalesce(regexp_matches(command_line, {_q('(?i)' + SUSPICIOUS_CMDLINE_PATTERN)}), false) AS INTEGER) AS suspicious_commandline,
 CAST(login_hour < 6 OR login_hour >= 20 AS INTEGER) AS after_hours_flag,
 CAST(coalesce(isodow(timestamp) IN (6, 7), false) AS INTEGER) AS is_weekend,
 CASE WHEN {SUBNET} = '' THEN 'N/A' ELSE {SUBNET} END AS ip_subnet
FROM norm)"""

AGGS = """users AS (
SELECT username, count(event_id) AS user_event_count,
 CAST(sum(is_failed_login) AS BIGINT) AS user_failed_count,
 CAST(sum(is_successful_login) AS BIGINT) AS user_success_count,
 count(DISTINCT machine) AS user_unique_machines, count(DISTINCT source_ip) AS user_unique_ips,
 avg(login_hour) AS user_avg_hour, CAST(sum(is_kerberos_tgs) AS BIGINT) AS user_tgs_count
FROM flags WHERE username IS NOT NULL GROUP BY username),
ips AS (
SELECT source_ip, count(event_id) AS ip_event_count,
 count(DISTINCT CASE WHEN is_failed_login = 1 THEN username END) AS ip_unique_failed_users
FROM flags GROUP BY source_ip),
subnets AS (
SELECT ip_subnet, CAST(row_number() OVER (ORDER BY ip_subnet) - 1 AS INTEGER) AS ip_subnet_enc
FROM (SELECT DISTINCT ip_subnet FROM flags) d),
win AS (
SELECT log_id, CAST(CASE WHEN username IS NULL OR timestamp IS NULL THEN 0 ELSE
 sum(is_failed_login) OVER (PARTITION BY username ORDER BY epoch_us(timestamp)
   RANGE BETWEEN 599999999 PRECEDING AND CURRENT ROW) END AS BIGINT) AS failed_last_10min
FROM flags)"""

FEATS = """feats AS (
SELECT f.*, w.failed_last_10min,
 coalesce(u.user_event_count, 0) AS user_event_count, coalesce(u.user_failed_count, 0) AS user_failed_count,
 coalesce(u.user_success_count, 0) AS user_success_count,
 coalesce(u.user_unique_machines, 0) AS user_unique_machines, coalesce(u.user_unique_ips, 0) AS user_unique_ips,
 coalesce(u.user_tgs_count, 0) AS user_tgs_count,
 coalesce(i.ip_event_count, 0) AS ip_event_count, coalesce(i.ip_unique_failed_users, 0) AS ip_unique_failed_users,
 coalesce(abs(f.login_hour - u.user_avg_hour), 0.0) AS hour_deviation,
 coalesce(s.ip_subnet_enc, 0) AS ip_subnet_enc
FROM flags f
 JOIN win w ON f.log_id = w.log_id
 LEFT JOIN users u ON f.username = u.username
 LEFT JOIN ips i ON f.source_ip = i.source_ip
 LEFT JOIN subnets s ON f.ip_subnet = s.ip_subnet)"""


RULES = """ruled AS (
SELECT *,
 CAST((user_failed_count > 10 OR failed_last_10min >= 5) AND user_unique_ips > 1 AS INTEGER) AS brute_force_flag,
 CAST(is_successful_login = 1 AND is_privileged = 1 AND user_failed_count > 0 AS INTEGER) AS privilege_escalation_flag,
 CAST(user_unique_machines > 1 AS INTEGER) AS lateral_movement_flag,
 CAST(suspicious_process = 1 OR suspicious_commandline = 1 AS INTEGER) AS malicious_process_flag,
 CAST(is_successful_login = 1 AND user_failed_count > 5 AS INTEGER) AS credential_stuffing_flag,
 CAST(ip_unique_failed_users >= 6 AND is_failed_login = 1 AS INTEGER) AS password_spray_flag,
 CAST(ip_unique_failed_users >= 12 AND is_failed_login = 1 AS INTEGER) AS account_enumeration_flag,
 CAST(user_failed_count >= 5 AND user_success_count >= 1 AND is_successful_login = 1 AS INTEGER) AS success_after_fail_flag,
 CAST(user_tgs_count >= 6 AND is_kerberos_tgs = 1 AS INTEGER) AS kerberoasting_flag
FROM feats)"""

SCORED = f"""modeled AS (
SELECT *, value - (SELECT quantile_cont(value, 0.03) FROM raw_logs) AS anomaly_score_raw FROM ruled),
flagged AS (SELECT *, CAST(coalesce(anomaly_score_raw < 0, false) AS INTEGER) AS is_anomaly FROM modeled),
techs AS (
SELECT *, concat_ws(', ', {", ".join(f"CASE WHEN {c} THEN {_q(label)} END" for c, label in LABELS)}) AS mitre_techniques,
 CAST({RULE_SCORE} AS INTEGER) AS rule_score, CASE WHEN is_anomaly = 1 THEN 3 ELSE 0 END AS ml_score
FROM flagged),
analyzed AS (
SELECT *, rule_score + ml_score AS total_threat_score, CASE WHEN rule_score + ml_score >= 9 THEN 'CRITICAL'
 WHEN rule_score + ml_score >= 6 THEN 'HIGH' WHEN rule_score + ml_score >= 3 THEN 'MEDIUM' ELSE 'LOW' END AS final_risk_level FROM techs)"""


def chain(upto: str = "analyzed") -> str:
    parts = [RAW_LOGS, NORM, FLAGS, AGGS, FEATS, RULES, SCORED]
    order = ["raw_logs", "norm", "flags", "aggs", "feats", "ruled", "analyzed"]
    return "WITH " + ",\n".join(parts[: order.index(upto) + 1]) + "\n"


def round2(num: str, den: str) -> str:
    """round(num/den, 2) half-up on non-negative integers, exact."""
    return f"CASE WHEN {den} > 0 THEN ((200 * ({num}) + ({den})) // (2 * ({den}))) / 100.0 ELSE 0.0 END"


IP_PROBE = """probe AS (
SELECT log_id, CASE log_id % 10
 WHEN 0 THEN source_ip WHEN 1 THEN concat('::ffff:', source_ip) WHEN 2 THEN '::1'
 WHEN 3 THEN concat('fe80::', CAST(log_id % 97 AS VARCHAR)) WHEN 4 THEN ' - '
 WHEN 5 THEN concat('host', CAST(log_id % 13 AS VARCHAR)) WHEN 6 THEN concat(' ', source_ip, ' ')
 WHEN 7 THEN concat('2001:db8::', CAST(log_id % 50 AS VARCHAR)) WHEN 8 THEN ''
 ELSE concat('::', CAST(log_id % 7 AS VARCHAR)) END AS candidate
FROM raw_logs),
trimmed AS (SELECT log_id, candidate, regexp_replace(candidate, '^\\s+|\\s+$', '', 'g') AS s FROM probe)"""

REPORTS = f"""reports AS (
SELECT doc_id AS id, concat(CASE doc_id % 4 WHEN 0 THEN {_q(REPORT_PREFIXES[0])} WHEN 1 THEN {_q(REPORT_PREFIXES[1])}
   WHEN 2 THEN {_q(REPORT_PREFIXES[2])} ELSE {_q(REPORT_PREFIXES[3])} END, ' ', coalesce(text, '')) AS text,
 CASE WHEN doc_id % 2 = 0 THEN [{", ".join(_q(x) for x in ALLOWED_EVEN)}]
      ELSE [{", ".join(_q(x) for x in ALLOWED_ODD)}] END AS allowed
FROM documents)"""

TID = r"\bT\d{4,5}(?:\.\d{3})?\b"


# ---------------------------------------------------------------- guardrail expressions

WS = r"'^\s+|\s+$'"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, {WS}, '', 'g')"


def scrub_sql(x: str, max_chars: int | None = 200) -> str:
    s1 = f"regexp_replace(CAST({x} AS VARCHAR), {_q(SPECIAL_TOKEN)}, '', 'g')"
    s2 = f"regexp_replace({s1}, {_q(INJECTION_WORDS)}, '[REDACTED]', 'g')"
    s3 = s2 if max_chars is None else f"CASE WHEN length({s2}) > {max_chars} THEN concat(substr({s2}, 1, {max_chars - 3}), '...') ELSE {s2} END"
    return f"CASE WHEN {x} IS NULL THEN 'N/A' ELSE {strip_sql(f'translate({s3}, chr(10) || chr(13), chr(32) || chr(32))')} END"


def split_sql(x: str) -> str:
    parts = (f"list_filter(list_transform(string_split(translate(coalesce({x}, ''), chr(10) || '|', ';;'), ';'), "
             f"lambda p: {strip_sql('p')}), lambda p: p <> '')")
    return (f"flatten(list_transform({parts}, lambda p: CASE WHEN contains(p, ',') AND contains(p, 'T') THEN "
            f"list_filter(list_transform(string_split(p, ','), lambda y: {strip_sql('y')}), lambda y: y <> '') "
            f"ELSE [p] END))")


def ids_sql(x: str) -> str:
    all_ids = f"regexp_extract_all(coalesce({x}, ''), {_q(TID)})"
    return f"list_filter({all_ids}, lambda v, i: list_position({all_ids}, v) = i)"


def allowed_ids_sql(a: str) -> str:
    return f"list_distinct(flatten(list_transform(coalesce({a}, []), lambda z: regexp_extract_all(z, {_q(TID)}))))"


def soften_sql(t: str, a: str) -> str:
    x = f"regexp_replace(coalesce({t}, ''), {_q(VERIFY_NOTE)}, '', 'g')"
    for pat in CLOSINGS:
        x = f"regexp_replace({x}, {_q('(?i)' + pat)}, '', 'g')"
    for pat, repl in SOFTER:
        x = f"regexp_replace({x}, {_q('(?i)' + pat)}, {_q(repl)}, 'g')"
    return (f"CASE WHEN contains(lower(array_to_string(coalesce({a}, []), ' ')), 'credential stuffing') THEN {x} "
            f"ELSE regexp_replace({x}, {_q(r'(?i)\bcredential stuffing\b')}, 'brute force', 'g') END")


def squeeze_sql(t: str) -> str:
    x = f"regexp_replace(coalesce({t}, ''), '[ \\t]+', ' ', 'g')"
    x = f"regexp_replace({x}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    x = f"regexp_replace({x}, '\\(\\s*\\)', '', 'g')"
    return f"concat({strip_sql(x)}, chr(10))"


# ---------------------------------------------------------------- collector projection

def looks_like_sql(x: str) -> str:
    s = strip_sql(x)
    return (f"coalesce({s} <> '' AND (regexp_matches(CASE WHEN starts_with(lower({s}), '::ffff:') THEN substr({s}, 8) "
            f"ELSE {s} END, {_q(IPV4_SHAPE)}) OR regexp_matches({s}, {_q(IPV6_LIKE)})), false)")


def dc_sanitize_sql(x: str) -> str:
    s = strip_sql(x)
    return (f"CASE WHEN {x} IS NULL THEN '127.0.0.1' WHEN {s} IN {_in(DC_LOOPBACK_FORMS)} THEN '127.0.0.1' "
            f"WHEN starts_with(lower({s}), '::ffff:') THEN substr({s}, 8) "
            f"WHEN regexp_matches({s}, {_q(IPV4_SHAPE)}) THEN {s} "
            f"WHEN starts_with({s}, '::') OR {s} = '0:0:0:0:0:0:0:1' THEN '127.0.0.1' "
            f"WHEN length({s}) > 1 THEN {s} ELSE '127.0.0.1' END")


def client_sanitize_sql(x: str) -> str:
    s = strip_sql(x)
    return (f"CASE WHEN {x} IS NULL THEN '127.0.0.1' WHEN {s} IN {_in(CLIENT_LOOPBACK_FORMS)} THEN '127.0.0.1' "
            f"WHEN regexp_matches({s}, {_q(CLIENT_IPV4)}) THEN {s} "
            f"WHEN regexp_matches({s}, {_q(CLIENT_IPV6)}) AND starts_with({s}, 'fe80') THEN '127.0.0.1' "
            f"WHEN regexp_matches({s}, {_q(CLIENT_IPV6)}) THEN {s} ELSE '127.0.0.1' END")


def safe_get_sql(arr: str, i: int, default: str = "N/A") -> str:
    v = strip_sql(f"{arr}[{i + 1}]")
    return f"CASE WHEN {v} IS NULL OR {v} = '' OR {v} = '-' THEN {_q(default)} ELSE {v} END"


def raw_get_sql(arr: str, i: int, default: str) -> str:
    return f"CASE WHEN len({arr}) > {i} THEN {arr}[{i + 1}] ELSE {_q(default)} END"



from ..sources.fixtures import PRIORITY_LINE, SECTION_BODIES  # noqa: E402


def _sql_text(v: str) -> str:
    """A SQL string expression with real newlines (chr(10))."""
    parts = v.split("\n")
    return " || chr(10) || ".join(_q(p) for p in parts)


SECTIONED = f"""sectioned AS (
SELECT doc_id AS id, concat('### EXECUTIVE THREAT SUMMARY' || chr(10), coalesce(text, ''),
  chr(10) || chr(10) || '### MITRE ATT&CK OBSERVATIONS' || chr(10),
  CASE doc_id % 3 WHEN 0 THEN {_sql_text(SECTION_BODIES[0])} WHEN 1 THEN {_sql_text(SECTION_BODIES[1])}
   ELSE {_sql_text(SECTION_BODIES[2])} END,
  CASE WHEN doc_id % 2 = 0 THEN chr(10) || '### PRIORITY RESPONSE ACTIONS' || chr(10) || {_q(PRIORITY_LINE)}
   ELSE '' END) AS text,
 CASE WHEN doc_id % 2 = 0 THEN [{", ".join(_q(x) for x in ALLOWED_EVEN)}]
      ELSE [{", ".join(_q(x) for x in ALLOWED_ODD)}] END AS allowed
FROM documents)"""


def list_filter_sql(t: str, a: str) -> str:
    ok = allowed_ids_sql(a)
    lead = "regexp_replace(l, '^\\s+', '')"
    is_list = (f"(starts_with({lead}, '-') OR starts_with({lead}, '*') OR starts_with({lead}, '•') "
               f"OR regexp_matches({lead}, '^\\d+[.)]'))")
    ids = ids_sql("l")
    only_bad = f"(len({ids}) > 0 AND len(list_filter({ids}, lambda i: list_contains({ok}, i))) = 0)"
    return (f"array_to_string(list_filter(string_split(coalesce({t}, ''), chr(10)), "
            f"lambda l: NOT ({is_list} AND {only_bad})), chr(10))")


def mitre_rewrite_sql(t: str, a: str) -> str:
    head = f"regexp_extract(coalesce({t}, ''), {_q(r'(?is)^(.*?###\s+MITRE ATT&CK OBSERVATIONS\s*\n)')}, 1)"
    rest = f"substr(coalesce({t}, ''), length({head}) + 1)"
    tail = f"regexp_extract({rest}, {_q(r'(?s)^.*?(\n###\s+.*)$')}, 1)"
    ok = allowed_ids_sql(a)
    al = f"coalesce({a}, [])"
    keep = (f"list_filter({al}, lambda item: len(list_filter({ids_sql('item')}, lambda i: list_contains({ok}, i))) > 0 "
            f"OR len({ids_sql('item')}) = 0)")
    lines = f"list_transform({keep}, lambda item: concat('- **', item, '** — observed in incident data.'))"
    block = (f"CASE WHEN len({al}) > 0 THEN concat(array_to_string({lines}, chr(10)), chr(10)) "
             f"ELSE 'No MITRE techniques observed in evidence.' || chr(10) END")
    return f"CASE WHEN {head} = '' THEN coalesce({t}, '') ELSE concat({head}, {block}, {tail}) END"
