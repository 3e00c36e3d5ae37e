"""Rule parameters and job settings; the defaults are the contract's values."""

from __future__ import annotations

import math
import os
from dataclasses import dataclass

SECOND = 1_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR


@dataclass(frozen=True)
class OrderParams:
    """Timing of the order rules, in milliseconds."""

    wait_ms: int = 2 * MINUTE
    ttl_ms: int = 2 * HOUR
    disorder_ms: int = 2 * MINUTE


@dataclass(frozen=True)
class WindowRule:
    """One sliding-window count rule; an alert needs at least ``min_count``."""

    size_ms: int
    slide_ms: int
    wait_ms: int
    cooldown_ms: int
    threshold: int
    strict: bool

    def __post_init__(self):
        if self.size_ms % self.slide_ms:
            raise ValueError("window size must be a multiple of the slide")

    @property
    def windows(self) -> int:
        """Windows that contain one instant."""
        return self.size_ms // self.slide_ms

    @property
    def cooldown_slots(self) -> int:
        """Slide steps until a window end may alert again."""
        return max(1, math.ceil(self.cooldown_ms / self.slide_ms))

    @property
    def min_count(self) -> int:
        return self.threshold + 1 if self.strict else self.threshold

    @property
    def period_seconds(self) -> int:
        return self.size_ms // SECOND


@dataclass(frozen=True)
class UserParams:
    """The two user rules and the timing of their stream."""

    unpaid: WindowRule = WindowRule(60 * SECOND, 10 * SECOND, 2 * MINUTE, 180 * SECOND, 5, True)
    failure: WindowRule = WindowRule(180 * SECOND, 10 * SECOND, 0, 180 * SECOND, 3, False)
    ttl_ms: int = 10 * MINUTE
    disorder_ms: int = 2 * MINUTE
    # Window ends per time block; no group of the window operators holds more.
    block_slots: int = 2048

    def __post_init__(self):
        for rule in (self.unpaid, self.failure):
            if self.block_slots < max(rule.windows, rule.cooldown_slots):
                raise ValueError("block_slots must cover a window and a cooldown")


@dataclass(frozen=True)
class JobConfig:
    """Connections and run settings of one streaming job, read from the environment."""

    group_id: str
    checkpoint_dir: str | None
    bootstrap_servers: str | None
    mysql_url: str | None
    mysql_user: str | None
    mysql_password: str | None
    mysql_driver: str = "com.mysql.cj.jdbc.Driver"
    # State partitions, fixed by a checkpoint's first run; by default the session's number.
    shuffle_partitions: int | None = None
    trigger_seconds: int = 60
    sink_batch_rows: int = 100
    sink_retries: int = 3
    sink_connections: int = 16
    restarts: int = 3
    # Bounds on one micro-batch, per topic; without them the first one holds all that is retained.
    max_offsets: int | None = None
    max_files: int | None = None
    restart_delay_seconds: int = 30
    # Seconds without a row after which a topic no longer holds the watermark back.
    idle_seconds: int = 30

    @classmethod
    def from_env(cls, group_id: str, env: dict[str, str] | None = None, **overrides) -> "JobConfig":
        env = os.environ if env is None else env
        root = env.get("CHECKPOINT_ROOT")
        url = None
        if env.get("MYSQL_HOST"):
            url = (
                f"jdbc:mysql://{env['MYSQL_HOST']}:{env.get('MYSQL_PORT', '3306')}"
                f"/{env.get('REALTIME_MYSQL_DATABASE', 'realtime')}?useUnicode=true"
                f"&characterEncoding={env.get('MYSQL_CHARSET', 'utf8')}"
                f"&serverTimezone={env.get('MYSQL_TIMEZONE', 'Asia/Shanghai')}"
            )
        values = dict(
            group_id=group_id,
            checkpoint_dir=f"{root.rstrip('/')}/{group_id}/" if root else None,
            bootstrap_servers=env.get("KAFKA_BOOTSTRAP_SERVERS"),
            mysql_url=url,
            mysql_user=env.get("MYSQL_USER"),
            mysql_password=env.get("MYSQL_PASSWORD"),
            shuffle_partitions=int(env["STATE_PARTITIONS"]) if env.get("STATE_PARTITIONS") else None,
            max_offsets=int(env["MAX_OFFSETS_PER_TRIGGER"]) if env.get("MAX_OFFSETS_PER_TRIGGER") else None,
            max_files=int(env["MAX_FILES_PER_TRIGGER"]) if env.get("MAX_FILES_PER_TRIGGER") else None,
            idle_seconds=int(env.get("IDLE_SECONDS") or 30),
        )
        return cls(**{**values, **overrides})
