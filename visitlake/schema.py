"""Names and table schemas shared by every module."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values
# Wire names, codes and labels that must equal those found in the logs and tables.

LINE_SEPARATOR = "^A"
UNKNOWN = "unknown"
ALL = "all"

EVENTS = [
    (1, "launch event", "e_l"),
    (2, "page view event", "e_pv"),
    (3, "charge request event", "e_crt"),
    (4, "charge success event", "e_cs"),
    (5, "charge refund event", "e_cr"),
    (6, "event duration event", "e_e"),
]
LAUNCH, PAGE_VIEW, CHARGE_REQUEST, CHARGE_SUCCESS, CHARGE_REFUND, ACTIVITY = (e[2] for e in EVENTS)

WEBSITE = "website"
JAVA_SERVER = "java_server"

KPI_NEW_USERS = "new_install_user"
KPI_BROWSER_NEW_USERS = "browser_new_install_user"
KPI_HOURLY_NEW_USERS = "new_users"
KPI_ACTIVE_USERS = "active_users"
KPI_SESSIONS = "sessions"
KPI_SESSION_LENGTH = "sessions_lengths"
STATS_KPIS = (KPI_NEW_USERS, KPI_BROWSER_NEW_USERS)
HOURLY_KPIS = (KPI_HOURLY_NEW_USERS, KPI_ACTIVE_USERS, KPI_SESSIONS, KPI_SESSION_LENGTH)

# (platform, event) -> fields an event of that kind must carry besides its time and platform. Other pairs
# are not accepted.
REQUIRED_FIELDS = {
    (JAVA_SERVER, CHARGE_REFUND): ("u_mid",),
    (JAVA_SERVER, CHARGE_SUCCESS): ("u_mid", "oid"),
    (WEBSITE, CHARGE_REQUEST): ("oid", "cut", "pt", "cua"),
    (WEBSITE, ACTIVITY): ("ca", "ac"),
    (WEBSITE, LAUNCH): (),
    (WEBSITE, PAGE_VIEW): ("p_url",),
}
# What the strict rules ask of website events on top.
STRICT_WEBSITE_FIELDS = ("u_ud", "u_sd")

# Grain name -> whether a date dimension row can be built for it.
DATE_GRAINS = {"year": True, "season": True, "month": True, "week": True, "day": True, "hour": False}

UNKNOWN_COUNTRY = "未知国家"
UNKNOWN_AREA = "未知地区"
# ------------------------------------------------------------ end fixed values

USER_AGENT = "b_iev"

# Columns of the event table that hold strings exactly as they came in.
TEXT_COLUMNS = [
    "ip", "en", "pl", "ver", "u_ud", "u_mid", "u_sd", "c_time", "l", "b_rst", "p_url", "p_ref", "tt",
    "oid", "on", "cua", "cut", "pt", "ca", "ac", "du",
    "browser", "browser_v", "os", "os_v", "country", "province", "city",
]
REGION_COLUMNS = ["country", "province", "city"]
AGENT_COLUMNS = ["browser", "browser_v", "os", "os_v"]
KNOWN_FIELDS = [*TEXT_COLUMNS, "s_time", USER_AGENT]

EVENT_COLUMNS = [
    "time_in_day", "row_hash", "ip", "s_time", "en", "pl", "ver", "u_ud", "u_mid", "u_sd", "c_time", "l", "b_rst",
    "p_url", "p_ref", "tt", "oid", "on", "cua", "cut", "pt", "ca", "ac", "du",
    "browser", "browser_v", "os", "os_v", "country", "province", "city", "extra",
]


def _event_type(name: str) -> T.DataType:
    if name in ("time_in_day", "row_hash", "s_time"):
        return T.LongType()
    if name == "extra":
        return T.MapType(T.StringType(), T.StringType())
    return T.StringType()


EVENT_SCHEMA = T.StructType(
    [T.StructField(c, _event_type(c)) for c in EVENT_COLUMNS] + [T.StructField("dt", T.DateType())]
)

IP_RANGE_SCHEMA = T.StructType([
    T.StructField("begin_ip", T.LongType()),
    T.StructField("end_ip", T.LongType()),
    T.StructField("country", T.StringType()),
    T.StructField("area", T.StringType()),
])

DATE_KEYS = ["year", "season", "month", "week", "day", "type", "calendar"]
PLATFORM_KEYS = ["platform_name", "platform_version"]
BROWSER_KEYS = ["browser_name", "browser_version"]
KPI_KEYS = ["kpi_name"]

# Dimension table -> natural key.
DIM_KEYS = {
    "dimension_date": DATE_KEYS,
    "dimension_platform": PLATFORM_KEYS,
    "dimension_browser": BROWSER_KEYS,
    "dimension_kpi": KPI_KEYS,
}

HOUR_COLUMNS = [f"hour_{h:02d}" for h in range(24)]


@dataclass(frozen=True)
class FactTable:
    """Where the rows of one KPI go, which columns identify a row there and what parts the table by.

    `period` is SQL text over the keys: an upsert rewrites the periods its rows are in and no others.
    """

    table: str
    keys: tuple[str, ...]
    measure: str
    period: str = "0"


# Fact rows of neighbouring date ids lie together.
_BY_DATE_ID = "date_dimension_id div 32"


# KPI -> fact table.
FACT_TABLES = {
    KPI_NEW_USERS: FactTable("stats_user", ("platform_dimension_id", "date_dimension_id"), "new_install_users", _BY_DATE_ID),
    KPI_BROWSER_NEW_USERS: FactTable(
        "stats_device_browser",
        ("platform_dimension_id", "date_dimension_id", "browser_dimension_id"),
        "new_install_users",
        _BY_DATE_ID,
    ),
}

# Reasons for which a raw line is not stored.
BAD_LINE = "bad_line"
NO_PARAMETERS = "no_parameters"
UNKNOWN_EVENT = "unknown_event"
BAD_SERVER_TIME = "bad_server_time"
MISSING_PLATFORM = "missing_platform"
UNKNOWN_PLATFORM = "unknown_platform"
EVENT_NOT_ALLOWED = "event_not_allowed"
MISSING_FIELD = "missing_field"
REJECT_REASONS = (
    BAD_LINE, NO_PARAMETERS, UNKNOWN_EVENT, BAD_SERVER_TIME, MISSING_PLATFORM, UNKNOWN_PLATFORM,
    EVENT_NOT_ALLOWED, MISSING_FIELD,
)
