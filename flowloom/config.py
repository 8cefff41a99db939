"""Parameters of the traffic datasets; the defaults are this library's own."""

from __future__ import annotations

import configparser
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class TrafficConfig:
    """Times are seconds. local_subnets are CIDR strings."""

    session_expire_timeout: int = 120
    latency_expire_timeout: int = 5
    store_timeout: int = 20
    nmi_db_update_wait_time: int = 3600
    lrs_min_duration: int = 300
    traffic_ttl: int = 30 * 86400
    ingest_vlan_id: bool = True
    cap_filter: str | None = None
    local_subnets: tuple[str, ...] = ("10.0.0.0/8", "172.16.0.0/16", "192.168.0.0/16")

    @classmethod
    def from_ini(cls, text: str, section: str = "traffic") -> TrafficConfig:
        """From INI text; missing names keep their defaults, subnets are separated by commas."""
        parser = configparser.ConfigParser()
        parser.read_string(text)
        given = dict(parser[section]) if parser.has_section(section) else {}
        values = {}
        for f in fields(cls):
            if f.name in given:
                old, raw = f.default, given[f.name].strip()
                values[f.name] = tuple(x.strip() for x in raw.split(",")) if isinstance(old, tuple) else raw.lower() in ("1", "true", "yes", "on") if isinstance(old, bool) else int(raw) if isinstance(old, int) else raw
        return cls(**values)
