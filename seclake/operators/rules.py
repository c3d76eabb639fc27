"""Detection rules D1–D9 as boolean column expressions (0/1 ints).

D10 (after-hours privileged) has no flag column; it only adds a
technique label (see ``scoring.with_techniques``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, DetectionConfig

RULE_FLAGS = ("brute_force_flag", "privilege_escalation_flag", "lateral_movement_flag",
              "malicious_process_flag", "credential_stuffing_flag", "password_spray_flag",
              "account_enumeration_flag", "success_after_fail_flag", "kerberoasting_flag")


def _i(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("int")


def rule_columns(cfg: DetectionConfig = DEFAULT, columns: tuple = ()) -> dict:
    c = F.col
    if cfg.priv_esc_mode == "correlated" and "recent_success" in columns:
        # A 4672 shortly after a 4624 of the same user.
        priv = (c("is_privileged") == 1) & (c("recent_success") == 1) \
            & (c("user_failed_count") > cfg.priv_esc_failures)
    else:
        # One row cannot be both 4624 and 4672, so this never fires; kept for parity.
        priv = (c("is_successful_login") == 1) & (c("is_privileged") == 1) \
            & (c("user_failed_count") > cfg.priv_esc_failures)
    return {
        "brute_force_flag": _i(((c("user_failed_count") > cfg.brute_force_lifetime)
                                | (c("failed_last_10min") >= cfg.brute_force_window))
                               & (c("user_unique_ips") > cfg.brute_force_min_ips)),
        "privilege_escalation_flag": _i(priv),
        "lateral_movement_flag": _i(c("user_unique_machines") > cfg.lateral_machines),
        "malicious_process_flag": _i((c("suspicious_process") == 1) | (c("suspicious_commandline") == 1)),
        "credential_stuffing_flag": _i((c("is_successful_login") == 1)
                                       & (c("user_failed_count") > cfg.stuffing_failures)),
        "password_spray_flag": _i((c("ip_unique_failed_users") >= cfg.spray_ip_users)
                                  & (c("is_failed_login") == 1)),
        "account_enumeration_flag": _i((c("ip_unique_failed_users") >= cfg.enumeration_ip_users)
                                       & (c("is_failed_login") == 1)),
        "success_after_fail_flag": _i((c("user_failed_count") >= cfg.success_after_fail_failures)
                                      & (c("user_success_count") >= 1) & (c("is_successful_login") == 1)),
        "kerberoasting_flag": _i((c("user_tgs_count") >= cfg.kerberoast_tgs) & (c("is_kerberos_tgs") == 1)),
    }


def with_rules(df: DataFrame, cfg: DetectionConfig = DEFAULT) -> DataFrame:
    return df.withColumns(rule_columns(cfg, tuple(df.columns)))
