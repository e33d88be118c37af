"""Column roles, vocabulary and thresholds."""

from __future__ import annotations

from dataclasses import dataclass

# The column names of the telemetry schema, by role.
TIME, CELL, PROVINCE, RAT, APP, DEVICE = "time_start", "enb_id", "province", "radio_access_type", "application_category", "imei"
CELL_NAMES = ("enb", "enb_id")
DIRECT = ("msisdn", "imsi")
IDENTIFIERS = ("msisdn", "imsi", "imei")
VOLUMES = ("data_GB_sum", "im_video_GB_sum", "im_audio_GB_sum", "tethering_data_GB_dl_sum")
METRICS = (
    "tp_dl_avg", "tp_ul_avg", "tp_dl_filtered_avg", "cont_rtt_radio_avg", "cont_rtt_internet_avg", "initial_rtt_radio_avg",
    "tcp_retrans_byte_ratio_downlink_avg", "tcp_retrans_byte_ratio_uplink_avg", "http_response_time_avg", "http_sr_avg",
)
KPIS = METRICS + VOLUMES
CATEGORIES = (RAT, PROVINCE, APP, "device_type")
# Key sets of the class, linking and attack measures.
ATTACK_QI = (TIME, PROVINCE, RAT, CELL, APP)
CLASS_SETS = (
    (TIME, CELL), (TIME, CELL, RAT), (TIME, CELL, APP), (TIME, CELL, DEVICE), (TIME, CELL, DEVICE, RAT, APP), (TIME, PROVINCE, DEVICE),
)
LINK_KEYS = ((DEVICE,), (DEVICE, RAT), (DEVICE, PROVINCE, RAT), (DEVICE, CELL), (DEVICE, CELL, APP))
# Sentinels, patterns, digest lengths and ranks of statuses.
RESTRICTED = "RESTRICTED"
TAC_DIGITS = 8
SENSITIVE = r"vpn|\btor\b|dating|health|medic|pharma|relig|church|mosque|gambl|casino|adult|porn|lgbt|politic"
DIGESTS = {32: "md5", 40: "sha1", 64: "sha256", 128: "sha512"}
RANKS = {"PASS": 0, "INFO": 0, "SKIP": 0, "WARN": 1, "FAIL": 2, "ERROR": 2}
LABELLED = ("province", "radio_access_type", "application_category")
SUBJECTS = ("raw", "release_candidate")
DESCRIPTIONS = {
    "time_start": "First timestamp of event window", "msisdn": "Phone number", "imsi": "SIM subscriber identity", "imei": "Device identity",
    "tp_dl_avg": "Throughput metrics", "tp_ul_avg": "Throughput metrics", "tp_dl_filtered_avg": "Throughput metrics",
    "cont_rtt_radio_avg": "Latency metrics", "cont_rtt_internet_avg": "Latency metrics", "initial_rtt_radio_avg": "Latency metrics",
    "tcp_retrans_byte_ratio_downlink_avg": "TCP retransmission ratios", "tcp_retrans_byte_ratio_uplink_avg": "TCP retransmission ratios",
    "http_response_time_avg": "HTTP performance", "http_sr_avg": "HTTP performance", "data_GB_sum": "Total data volume",
    "im_video_GB_sum": "Video download volume", "im_audio_GB_sum": "Audio download volume", "tethering_data_GB_dl_sum": "Tethered-device volume",
    "radio_access_type": "Radio access type (e.g. LTE/NR)", "province": "Origin province", "application_category": "App type used",
    "enb": "eNodeB/gNodeB ID", "enb_id": "eNodeB/gNodeB ID",
}


@dataclass(frozen=True)
class Settings:
    """Thresholds of the transform and of the measures. The defaults are production values; queries state their own."""

    k_min: int = 10
    sig_figs: int = 3
    qi_include_tac: bool = True
    max_share_below_k: float = 0.01
    t_close: float = 0.3
    unicity_warn: float = 0.01
    unicity_fail: float = 0.05
    samples: int = 500
    trials: int = 300
    attacks: int = 1000
    max_users: int = 2000
    targets: int = 200
    max_candidates: int = 3_000_000
    seed: int = 0
    tz_hours: int = 0


def cell_column(columns: list[str]) -> str | None:
    """The cell column under whichever of its names is there."""
    return next((c for c in CELL_NAMES if c in columns), None)


def subscriber_column(columns: list[str], wanted: str | None = None) -> str | None:
    """The column that names subscribers: the one asked for, else the first direct identifier that is there."""
    return wanted or next((c for c in DIRECT if c in columns), None)


def worst(statuses: list[str]) -> str:
    """The first status of the highest rank; SKIP if there are none."""
    return max(statuses, key=RANKS.__getitem__) if statuses else "SKIP"
