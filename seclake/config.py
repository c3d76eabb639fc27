"""Detection thresholds, weights and pattern lists in one frozen object.

Every operator takes a ``DetectionConfig`` (default ``DEFAULT``); nothing
reads module globals, so a job can run two configurations side by side.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# These must equal the behaviour being reproduced, so they are
# stated here verbatim, in their natural order, in one place.
# ---------------------------------------------------------------------------

# Windows Security event ids.
EV_LOGON_SUCCESS = 4624
EV_LOGON_FAILED = 4625
EV_PRIVILEGED = 4672
EV_PROCESS = 4688
EV_KERBEROS_TGT = 4768
EV_KERBEROS_TGS = 4769

# Event ids each collector profile keeps.
DC_EVENT_IDS = (4624, 4625, 4672, 4768, 4769, 4688)
CLIENT_EVENT_IDS = (4624, 4625, 4688)

LOOPBACK = "127.0.0.1"
UNKNOWN_SUBNET = "N/A"

# Suspicious process names (case-insensitive, unanchored substring match).
SUSPICIOUS_PROCESS_PATTERN = (
    r"powershell|cmd|wmic|psexec|mimikatz|procdump|ntdsutil|secretsdump|"
    r"bloodhound|sharphound|rubeus|certutil|bitsadmin|mshta|regsvr32|"
    r"rundll32|wscript|cscript|net\.exe|net1\.exe|nltest|dsquery|csvde|ldifde"
)

# Suspicious command lines (case-insensitive, unanchored substring match).
SUSPICIOUS_CMDLINE_PATTERN = (
    r"mimikatz|sekurlsa|lsadump|dcsync|rubeus|kerberoast|asreproast|"
    r"ntdsutil|vssadmin|wmic\s+process|psexec|procdump|comsvcs\.dll|"
    r"reg\s+save|lsass|sam|system|security"
)

# MITRE ATT&CK labels, in the order they are joined into ``mitre_techniques``.
TECHNIQUE_LABELS = (
    ("brute_force_flag", "T1110 - Brute Force"),
    ("password_spray_flag", "T1110.003 - Brute Force: Password Spraying"),
    ("account_enumeration_flag", "T1087.002 - Account Discovery: Domain Account"),
    ("privilege_escalation_flag", "T1078 - Valid Accounts"),
    ("success_after_fail_flag", "T1078 - Valid Accounts"),
    ("lateral_movement_flag", "T1021 - Remote Services"),
    ("malicious_process_flag", "T1059 - Command & Scripting Interpreter"),
    ("credential_stuffing_flag", "T1110.004 - Brute Force: Credential Stuffing"),
    ("kerberoasting_flag", "T1558.003 - Steal or Forge Kerberos Tickets: Kerberoasting"),
    ("after_hours_privileged", "T1078.002 - Domain Accounts"),
)

# Rule weights of the rule score.
RULE_WEIGHTS = (
    ("brute_force_flag", 3),
    ("password_spray_flag", 2),
    ("account_enumeration_flag", 1),
    ("credential_stuffing_flag", 3),
    ("success_after_fail_flag", 2),
    ("privilege_escalation_flag", 2),
    ("lateral_movement_flag", 3),
    ("malicious_process_flag", 2),
    ("kerberoasting_flag", 3),
    ("after_hours_flag", 1),
)

# Risk levels from the total score: (minimum score, level), highest first.
RISK_LEVELS = ((9, "CRITICAL"), (6, "HIGH"), (3, "MEDIUM"))
RISK_DEFAULT = "LOW"
RISK_ORDER = ("CRITICAL", "HIGH", "MEDIUM", "LOW")

# The 21 model features, in model order.
MODEL_FEATURES = (
    "login_hour", "day", "is_failed_login", "is_privileged", "is_process_exec",
    "suspicious_process", "suspicious_commandline", "is_kerberos_tgt", "is_kerberos_tgs",
    "ip_subnet_enc", "user_event_count", "user_failed_count", "user_unique_machines",
    "user_unique_ips", "ip_event_count", "hour_deviation", "failed_last_10min",
    "after_hours_flag", "is_weekend", "ip_unique_failed_users", "user_tgs_count",
)

# Correlated-verdict names.
VERDICT_STRONG = "STRONG_CORRELATED_ATTACK"
VERDICT_MODERATE = "MODERATE_CORRELATION_NO_CONFIRMED_COMPROMISE"
VERDICT_LOW = "LOW_CONFIDENCE_ACTIVITY"


@dataclass(frozen=True)
class DetectionConfig:
    """Thresholds of the detection rules, model and reports."""

    contamination: float = 0.03
    brute_force_lifetime: int = 10        # D1: failures per user, strictly more than
    brute_force_window: int = 5           # D1: failures in 10 minutes, at least
    brute_force_min_ips: int = 1          # D1: distinct IPs, strictly more than
    lateral_machines: int = 1             # D3: distinct machines, strictly more than
    stuffing_failures: int = 5            # D5: failures, strictly more than
    priv_esc_failures: int = 0            # D2: failures, strictly more than
    success_after_fail_failures: int = 5  # D8: failures, at least
    spray_ip_users: int = 6               # D6
    enumeration_ip_users: int = 12        # D7
    kerberoast_tgs: int = 6               # D9
    after_hours_start: int = 20
    after_hours_end: int = 6
    window_seconds: int = 600             # W1 trailing window
    window_ties: str = "peers"            # W1: "peers" (all rows of equal time) or "row" (by log_id)
    window_salt: int = 1                  # W1: buckets per window; raise for bursty sources
    priv_esc_mode: str = "strict"         # D2: "strict" (one row) or "correlated"
    priv_esc_seconds: int = 300           # D2 correlated: 4672 within N s of a 4624
    ml_weight: int = 3                    # X3
    trees: int = 100                      # M2
    max_samples: int = 256                # M2 psi
    seed: int = 42
    near_anomaly_minutes: int = 15        # J2
    suspicious_process_pattern: str = SUSPICIOUS_PROCESS_PATTERN
    suspicious_cmdline_pattern: str = SUSPICIOUS_CMDLINE_PATTERN
    rule_weights: tuple = field(default=RULE_WEIGHTS)
    technique_labels: tuple = field(default=TECHNIQUE_LABELS)


DEFAULT = DetectionConfig()
