"""Settings: environment over properties over defaults; blank counts as unset."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Config:
    db_url: str = "jdbc:mysql://localhost:3306/logs?serverTimezone=UTC&connectionTimeZone=UTC&forceConnectionTimeZoneToSession=true"
    db_user: str = "root"
    db_password: str = ""
    db_pool_size: int = 8
    source_zone: str = "UTC"
    pipeline_name: str = "app-logs"
    batch_size: int = 5000
    es_host: str = "localhost"
    es_port: int = 9200
    es_scheme: str = "http"
    es_username: str | None = None
    es_password: str | None = None
    es_api_key: str | None = None
    index_sub_batch_size: int = 500
    index_max_bytes: int = 5 * 1024 * 1024
    bulk_max_attempts: int = 4
    bulk_base_delay_ms: int = 1_000
    bulk_max_delay_ms: int = 30_000
    window_seconds: int = 300
    anomaly_spike_multiplier: float = 3.0
    anomaly_min_events: int = 50
    anomaly_failed_login_threshold: int = 20
    anomaly_ema_alpha: float = 0.3
    redis_host: str = "localhost"
    redis_port: int = 6379
    redis_password: str | None = None
    redis_key_prefix: str = "pipeline:anomaly:"
    run_interval_seconds: int = 10
    health_port: int = 8080
    shutdown_grace_seconds: int = 30
    deployment_version: str | None = None
    #: A folder of parquet files to read; without one, the table over JDBC.
    source_path: str | None = None
    source_table: str = "app_logs"
    #: Where state, dead letters and files go.
    state_path: str = "sparkloom-state"
    #: ``http`` sends documents to the index server, ``files`` writes them under the state path.
    sink: str = "http"

    def __post_init__(self):
        for name in ("db_url", "pipeline_name", "es_host", "redis_host"):
            if not (getattr(self, name) or "").strip():
                raise ValueError(f"Invalid configuration: {name.upper()} is empty")
        least = {"batch_size": 1, "index_sub_batch_size": 1, "index_max_bytes": 1, "bulk_max_attempts": 1, "es_port": 1, "window_seconds": 1, "run_interval_seconds": 0}
        for name, bound in least.items():
            if getattr(self, name) < bound:
                raise ValueError(f"Invalid configuration: {name.upper()} is {getattr(self, name)}, the least is {bound}")
        if self.sink not in ("http", "files"):
            raise ValueError(f"Invalid configuration: SINK is {self.sink!r}, neither 'http' nor 'files'")
        if not 0 < self.anomaly_ema_alpha <= 1:
            raise ValueError(f"Invalid configuration: ANOMALY_EMA_ALPHA is {self.anomaly_ema_alpha}, not in (0, 1]")


def load(properties: Mapping[str, str] | None = None, environ: Mapping[str, str] | None = None) -> Config:
    """``db.url`` is DB_URL in the environment and db_url here."""
    environ = os.environ if environ is None else environ
    found = {}
    for f in fields(Config):
        for value in (environ.get(f.name.upper()), (properties or {}).get(f.name.replace("_", "."))):
            if value is not None and value.strip():
                kind = type(f.default)
                try:
                    found[f.name] = kind(value.strip()) if kind in (int, float) else value
                except ValueError as e:
                    raise ValueError(f"Invalid configuration: {f.name.upper()} must be a number") from e
                break
    return Config(**found)


def read_properties(path: str) -> dict[str, str]:
    """A properties file of ``key=value`` lines; # and ! begin comments."""
    out = {}
    with open(path, encoding="utf-8") as f:
        for line in f:
            line = line.strip()
            if line and line[0] not in "#!":
                key, _, value = line.partition("=")
                out[key.strip()] = value.strip()
    return out
