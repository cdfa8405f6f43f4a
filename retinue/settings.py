"""What a deployment configures: groups, breakdowns, heartbeat rule, search scope."""

from __future__ import annotations

from dataclasses import dataclass, field

# Event names, defaults and key parts that published keys depend on.
VISIT_PREFIX = "visit."
HEARTBEAT_PREFIX = "ientheartbeat."
SEARCH_EVENT = "pay.search2"
REGISTER_TIME = "register_time"
NATION = "nation"
UNKNOWN_VALUE = "XA-NA"
UNMAPPED_ID = "***"
ANY = "*"
NO_GROUP_KEY = "-"
COVER_EVENT = "int1cover.*"
TOTAL_NEW_EVENT = "int1totalnew.*"
VISIT_EVENT = "visit.*"
TOTAL_USER = "TOTAL_USER"
KEY_FILTER = "VF-ALL-0-0"
SAMPLE_RATE = 1.0
HISTORY_ROWS = 91
KEEP_DAYS = 30

# Group-by codes of the search cube: path levels 2, 3, 4, the nation, no grouping.
GRP_CODES = {"ev3": "2", "ev4": "3", "ev5": "4", "nation": "5"}
GRP_NONE = "6"


@dataclass(frozen=True)
class Settings:
    """Group layout of one deployment.

    ``combined`` maps a roll-up group to the groups it unites. ``categories`` maps a
    group to the (roll-up project, category) under which its daily actives are
    published a second time. ``heartbeat_pids`` limits heartbeat events to the listed
    sub-projects; ``None`` counts them everywhere. ``store_client`` names the function that
    connects to an external key-value store; without it metrics stay in the warehouse.
    ``count_inputs`` stores what the daily run read and kept of each input; rows are counted
    before they are filtered, so a Parquet log sorted by event is better read without.
    """

    combined: dict[str, tuple[str, ...]] = field(default_factory=lambda: {"all": ("g1", "g2")})
    breakdown_groups: tuple[str, ...] = ("g1",)
    attributes: tuple[str, ...] = (NATION,)
    page_view_group: str | None = "g1"
    categories: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {"g1": ("all", "1"), "g2": ("all", "2")}
    )
    heartbeat_pids: tuple[str, ...] | None = None
    search_group: str = "g1"
    search_extra_members: tuple[str, ...] = ()
    search_event: str = SEARCH_EVENT
    utc_offset_hours: int = 0
    count_inputs: bool = True
    store_client: str | None = None
    store_options: dict[str, str] = field(default_factory=dict)
